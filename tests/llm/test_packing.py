"""Packings are whole and valid, and close to the least number of containers."""

import os
import random
from bisect import bisect_left, insort
from collections import Counter

import pytest

from rulelake.llm import packing
from rulelake.llm.encoding import token_counts
from rulelake.llm.packing import packed, plan

DATA = "/root/testdata/sf0.1/documents.parquet"


def placed(histogram, capacity):
    runs, bins = plan(histogram, capacity)
    load, seen = Counter(), Counter()
    for size, lo, hi, first, each in runs:
        for r in range(lo, hi):
            load[first + (r - lo) // each] += size
            seen[size, r] += 1
    assert set(seen.values()) <= {1} and Counter(s for s, _ in seen) == Counter({s: c for s, c in histogram.items() if c})
    assert not load or (max(load.values()) <= capacity and set(load) <= set(range(bins)))
    return bins


@pytest.mark.parametrize("seed", range(12))
def test_plans(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 7, 100, 512, 2048, 8192])
    histogram = Counter(min(capacity, max(1, int(rng.choice([rng.uniform(1, capacity), rng.expovariate(8 / capacity), capacity / 3, capacity / 2 + 1])))) for _ in range(rng.choice([0, 1, 5, 300, 3000])))
    bins = placed(histogram, capacity)
    total = sum(s * c for s, c in histogram.items())
    over_half = sum(c for s, c in histogram.items() if 2 * s > capacity)
    assert bins >= max(-(-total // capacity), over_half)
    assert bins <= 1.35 * max(-(-total // capacity), over_half) + 25
    assert bins <= 1.03 * best_fit(histogram, capacity) + 12


def best_fit(histogram, capacity):
    """The number of containers by best fit of the largest first, item by item."""
    free = []
    for size, n in sorted(histogram.items(), reverse=True):
        for _ in range(n):
            i = bisect_left(free, size)
            left = free.pop(i) - size if i < len(free) else capacity - size
            insort(free, left)
    return len(free)


def test_documents_against_best_fit(spark):
    if not os.path.exists(DATA):
        pytest.skip("no test tables")
    n = [r["n"] for r in token_counts(spark.read.parquet(DATA)).collect()]
    for capacity in (512, 2048, 8192):
        pieces = Counter(min(capacity, x - p * capacity) for x in n for p in range(-(-x // capacity)))
        bins, best = placed(pieces, capacity), best_fit(pieces, capacity)
        print(capacity, "floor", -(-sum(s * c for s, c in pieces.items()) // capacity), "best fit", best, "here", bins)
        assert bins <= 1.01 * best + 2


def test_parts_of_one_size(spark, monkeypatch):
    monkeypatch.setattr(packing, "PART", 7)
    rows = packed(spark.createDataFrame([(i, 3 + i % 2) for i in range(100)], "doc_id long, n int"), {"s": 9}).collect()
    load = Counter()
    for r in rows:
        load[r["bin"]] += r["tokens"]
    assert len({r["doc_id"] for r in rows}) == len(rows) == 100 and max(load.values()) <= 9


def test_a_third_of_one_size():
    assert placed({100: 100_000, 50: 200_000}, 200) == 100_000


def test_items(spark):
    rng = random.Random(4)
    sizes = [(i, rng.choice([0, None, 1, 5, 5, 5, 5, 60, 99, 100, 101, 250, 1000])) for i in range(400)]
    df = spark.createDataFrame([(k, n, "clash", 7, 1) for k, n in sizes], "doc_id long, n int, container string, bin long, piece int")
    rows = packed(df, {"s": 100, "l": 256}).collect()
    for name, capacity in (("s", 100), ("l", 256)):
        own = [r for r in rows if r["container"] == name]
        assert Counter((r["doc_id"], r["tokens"], r["piece"]) for r in own) == Counter(
            (k, min(capacity, (n or 0) - p * capacity), p) for k, n in sizes for p in range(max(1, -(-(n or 0) // capacity)))
        )
        load = Counter()
        for r in own:
            assert (r["bin"] is None) == (r["tokens"] == 0)
            if r["bin"] is not None:
                load[r["bin"]] += r["tokens"]
        assert max(load.values()) <= capacity and len(load) <= 1.1 * sum(load.values()) / capacity + 5


def test_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, n int")
    assert packed(empty, {"s": 10}).count() == 0 and packed(empty, {}).count() == 0
