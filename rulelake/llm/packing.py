"""Filling containers of fixed capacity with items: a linear grouping scheme over the histogram of sizes.

Only the histogram, at most one entry a size up to the capacity, comes to the driver. There, large sizes are rounded up within groups of
equal cardinality; a linear programme over the configurations of the few rounded sizes, solved by column generation, gives
patterns and how many containers follow each; the actual sizes are put into the places of their group; what room is left in
each container is filled with what is left over and the small items, the largest first, each into the fullest container that takes it. The plan is a
list of runs (so many items of one size into consecutive containers), whose length depends on the capacity and not on the
number of items. The items then find their places in parallel by their rank among the items of their size, which is computed
in salted parts, so that a size that a third of the items have is no hot group.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Items above this share of the capacity are large; the large sizes are rounded up to so many; units into which the capacity is divided for the programme.
LARGE, GROUPS, UNITS = 1 / 3, 64, 2048
#: The items of one size are ranked in parts of about so many.
PART = 200_000


def configurations(sizes: list[int], counts: list[int], capacity: int) -> list[tuple[list[int], float]]:
    """Configurations (how many of each size) and how often each is used, for the least total: column generation."""
    g = len(sizes)
    n = np.array(counts, float)
    columns = [np.eye(g)[i] * max(1, capacity // s) for i, s in enumerate(sizes)]
    basis = np.array(columns).T
    x = np.linalg.solve(basis, n)
    for _ in range(40 * g):
        dual = np.linalg.solve(basis.T, np.ones(g))
        best, take = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        usable = [(s, i) for i, s in enumerate(sizes) if dual[i] > 1e-12]
        s_arr, i_arr = np.array([s for s, _ in usable], int), np.array([i for _, i in usable], int)
        for c in range(1, capacity + 1):
            best[c] = best[c - 1]
            fit = s_arr <= c
            if fit.any():
                value = best[c - s_arr[fit]] + dual[i_arr[fit]]
                j = int(value.argmax())
                if value[j] > best[c] + 1e-15:
                    best[c], take[c] = value[j], i_arr[fit][j]
        if best[capacity] <= 1 + 1e-7:
            break
        new, c = np.zeros(g), capacity
        while c > 0:
            if take[c] < 0:
                c -= 1
            else:
                new[take[c]] += 1
                c -= sizes[take[c]]
        direction = np.linalg.solve(basis, new)
        ratio = np.where(direction > 1e-9, x / np.where(direction > 1e-9, direction, 1), np.inf)
        leave = int(ratio.argmin())
        if not np.isfinite(ratio[leave]):
            break
        x = x - ratio[leave] * direction
        x[leave] = ratio[leave]
        basis[:, leave] = new
        x = np.maximum(x, 0)
    return [([int(v) for v in basis[:, j]], float(x[j])) for j in range(g) if x[j] > 1e-9]


class _Runs:
    """The plan: runs of (size, first rank, past the last rank, first container, items a container)."""

    def __init__(self) -> None:
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.used: dict[int, int] = defaultdict(int)

    def add(self, size: int, containers: int, first: int, each: int, items: int | None = None) -> None:
        items = containers * each if items is None else items
        r = self.used[size]
        self.rows.append((size, r, r + items, first, each))
        self.used[size] = r + items


def plan(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Runs (size, rank from, rank before, first container, items a container) and the number of containers.

    Every item of size 1 to ``capacity`` has a place; no container holds more than ``capacity``.
    """
    runs, bins = _Runs(), 0
    sizes = sorted((s for s, c in histogram.items() if c > 0), reverse=True)
    least = max(1, int(capacity * LARGE))
    large = [(s, histogram[s]) for s in sizes if s > least]
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free space -> intervals of containers

    rest = defaultdict(int, {s: histogram[s] for s in sizes if s <= least})
    total = sum(c for _, c in large)
    if total:
        # groups of equal cardinality, by falling size; a size with half a group or more is one of its own, and not rounded
        per, groups, left = -(-total // min(GROUPS, total)), [], 0
        for s, c in large:
            if 2 * c >= per:
                groups.append([[s, c]])
                left = 0
                continue
            while c:
                if not left:
                    groups.append([])
                    left = per
                k = min(c, left)
                groups[-1].append([s, k])
                c, left = c - k, left - k
        unit = max(1, capacity // UNITS)
        merged: dict[int, list[list[int]]] = {}
        for members in groups:  # groups whose rounded sizes are alike are one
            merged.setdefault(-(-members[0][0] // unit), []).extend(members)
        rounded = list(merged)
        most = capacity // unit
        if rounded[0] > most:  # an item that fills a container to less than a unit
            rounded = [min(r, most) for r in rounded]
            again: dict[int, list[list[int]]] = {}
            for r, m in zip(rounded, merged.values()):
                again.setdefault(r, []).extend(m)
            merged, rounded = again, list(again)
        stock = [[list(x) for x in merged[r]] for r in rounded]

        def fill(pattern: list[int], m: int) -> None:
            """``m`` containers of the pattern, each place taken by the actual sizes in order."""
            nonlocal bins
            places = []
            for g, a in enumerate(pattern):
                for _ in range(a):
                    need, place = m, []
                    while need and stock[g]:
                        s, c = stock[g][0]
                        k = min(c, need)
                        place.append((s, k))
                        need -= k
                        if k == c:
                            stock[g].pop(0)
                        else:
                            stock[g][0][1] -= k
                    places.append(place)
            marks = {0, m}
            for place in places:
                at = 0
                for s, k in place:
                    runs.add(s, k, bins + at, 1)
                    at += k
                    marks.add(at)
            marks = sorted(marks)
            at_mark = [0] * len(marks)
            index = {v: i for i, v in enumerate(marks)}
            for place in places:
                at = 0
                for s, k in place:
                    for i in range(index[at], index[at + k]):
                        at_mark[i] += s
                    at += k
            for i in range(len(marks) - 1):
                room[capacity - at_mark[i]].append((bins + marks[i], bins + marks[i + 1]))
            bins += m

        for pattern, times in configurations(rounded, [sum(c for _, c in m) for m in merged.values()], most):
            m = int(times + 1e-9)
            have = [sum(c for _, c in st) for st in stock]
            m = min([m, *[h // a for h, a in zip(have, pattern) if a]])
            if m and sum(a * r for a, r in zip(pattern, rounded)) <= most:
                fill(pattern, m)
        # what the whole numbers leave over, a few containers a group, is placed with the small items
        for st in stock:
            for size, c in st:
                rest[size] += c

    # the rest and the small items, largest first, into the fullest container that takes them
    for s in sorted(rest, reverse=True):
        c = rest[s]
        levels = sorted(f for f in room if f >= s and room[f])
        for f in levels:
            if not c:
                break
            each, kept = f // s, []
            for lo, hi in room.pop(f):
                full = min(hi - lo, c // each) if c else 0
                if full:
                    runs.add(s, full, lo, each)
                    room[f - each * s].append((lo, lo + full))
                    c -= full * each
                lo += full
                if c and lo < hi and c < each:
                    runs.add(s, 1, lo, each, items=c)
                    room[f - c * s].append((lo, lo + 1))
                    c, lo = 0, lo + 1
                if lo < hi:
                    kept.append((lo, hi))
            if kept:
                room[f].extend(kept)
        if c:
            each = capacity // s
            full = c // each
            if full:
                runs.add(s, full, bins, each)
                room[capacity - each * s].append((bins, bins + full))
                bins, c = bins + full, c - full * each
            if c:
                runs.add(s, 1, bins, each, items=c)
                room[capacity - c * s].append((bins, bins + 1))
                bins += 1
    return runs.rows, bins


def _pieces(sizes: DataFrame, key: str, size: str, capacity: Column, keep: list[str]) -> DataFrame:
    """Items as pieces of at most the capacity: only an item that exceeds it is split, into full pieces and the rest."""
    number = F.greatest(F.lit(1), F.ceil(F.col(size) / capacity)).cast("int")
    cut = sizes.withColumn("_piece", F.explode(F.sequence(F.lit(0), number - 1)))
    return cut.select(*keep, key, F.col("_piece").alias("piece"), F.least(capacity, F.col(size) - F.col("_piece") * capacity).cast("int").alias("tokens"))


def packed(sizes: DataFrame, containers: dict[str, int], key: str = "doc_id", size: str = "n") -> DataFrame:
    """(container, bin, key, piece, tokens): every item's place in each kind of container.

    ``containers`` gives the capacity by name, a few. An item is split only if it exceeds the capacity, and then into full pieces and a rest.
    Items of size 0 or null take no space and have a null ``bin``. Items may have equal keys if repeated rows are to count.
    ``sizes`` should be a written table, as it is read for the histogram and for the places.
    """
    spark = sizes.sparkSession
    if not containers:
        return spark.createDataFrame([], f"container string, bin bigint, `{key}` {sizes.schema[key].dataType.simpleString()}, piece int, tokens int")
    names = spark.createDataFrame([(n, int(c)) for n, c in containers.items()], "container string, capacity int")
    items = _pieces(sizes.select(key, F.coalesce(size, F.lit(0)).alias(size)).crossJoin(F.broadcast(names)), key, size, F.col("capacity"), ["container"])
    real = items.where("tokens > 0")
    counts = real.groupBy("container", "tokens").agg(F.count("*").alias("_n")).collect()  # at most a row a size up to the capacity
    histogram: dict[str, dict[int, int]] = {n: {} for n in containers}
    for r in counts:
        histogram[r["container"]][r["tokens"]] = r["_n"]
    salts = spark.createDataFrame([(r["container"], r["tokens"], -(-r["_n"] // PART)) for r in counts], "container string, tokens int, _parts int")
    real = real.join(F.broadcast(salts), ["container", "tokens"]).withColumn("_salt", F.pmod(F.xxhash64(key, "piece"), F.col("_parts")).cast("int")).drop("_parts")
    parts = real.groupBy("container", "tokens", "_salt").agg(F.count("*").alias("_n"))
    plans = {n: plan(histogram[n], int(c))[0] for n, c in containers.items()}

    before = Window.partitionBy("container", "tokens").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumn("_from", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    within = Window.partitionBy("container", "tokens", "_salt").orderBy(key, "piece")
    ranked = real.withColumn("_rank", F.row_number().over(within) - 1).join(offsets, ["container", "tokens", "_salt"]).withColumn("_rank", F.col("_rank") + F.col("_from"))

    kept = [*["container", "tokens"], key, "piece", "_rank"]
    # by container: sorted starts of the runs as size * 2^40 + rank
    lookup = {}
    for n, rows in plans.items():
        a = np.array(rows, np.int64).reshape(-1, 5)
        a = a[np.lexsort((a[:, 1], a[:, 0]))]
        lookup[n] = (a[:, 0] << 40 | a[:, 1], a[:, 1], a[:, 3], a[:, 4])
    shared = spark.sparkContext.broadcast(lookup)
    kind = sizes.schema[key].dataType.simpleString()

    def place(batches):
        runs = shared.value
        for b in batches:
            names = np.array(b.column("container").to_pylist(), object)
            size, rank = b.column("tokens").to_numpy(), b.column("_rank").to_numpy()
            out = np.zeros(len(names), np.int64)
            for n in set(names):
                at = names == n
                starts, low, first, each = runs[n]
                j = np.searchsorted(starts, size[at].astype(np.int64) << 40 | rank[at], "right") - 1
                out[at] = first[j] + (rank[at] - low[j]) // each[j]
            yield pa.RecordBatch.from_arrays([b.column("container"), pa.array(out), b.column(key), b.column("piece"), b.column("tokens")], ["container", "bin", key, "piece", "tokens"])

    schema = f"container string, bin bigint, `{key}` {kind}, piece int, tokens int"
    placed = ranked.select(*kept).mapInArrow(place, schema)
    return placed.unionByName(items.where("tokens <= 0").select("container", F.lit(None).cast("bigint").alias("bin"), key, "piece", "tokens"))
