"""Near-duplicates against all pairs counted one by one."""

import random
import re
from collections import Counter

from rulelake.llm import neardup
from rulelake.llm.neardup import candidates, components, groups, similar_pairs, sketched

SCHEMA = "ref string, emne string, tekst string, _k string, _s long, a string"
rng = random.Random(8)
VOCABULARY = [f"ord{i}" for i in range(400)]


def edited(ws, k):
    ws = list(ws)
    for _ in range(k):
        i = rng.randrange(len(ws))
        ws[i : i + 1] = rng.choice([[], [rng.choice(VOCABULARY)], [ws[i], rng.choice(VOCABULARY)]]) or ["x"]
    if rng.random() < 0.5:
        rng.shuffle(ws)
    return ws


def records():
    base = [[rng.choice(VOCABULARY) for _ in range(rng.randint(15, 60))] for _ in range(60)]
    texts = [" ".join(b) for b in base] + [" ".join(edited(b, rng.randint(0, 5))) for b in base for _ in range(3)]
    texts += [texts[0]] * 40 + ["", " ", None, "...", "a", "A", " ".join(base[1] * 400), " ".join(base[1] * 400 + base[2])]
    rows = [(f"r{i:03}", "emne " + " ".join(t.split()[:2]) if t and i < 240 else None, t) for i, t in enumerate(texts)]
    return rows + rows[:5]


def brute(rows, threshold=0.75):
    bags = {r: Counter(re.findall(r"\w+", f"{e or ''} {t or ''}".lower())) for r, e, t in rows}
    keys = sorted(bags)
    return {(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if bags[a] and bags[b] and sum((bags[a] & bags[b]).values()) / sum((bags[a] | bags[b]).values()) >= threshold}


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, "clash") for r in rows], SCHEMA)


def test_pairs_and_groups(spark):
    rows = records()
    want = brute(rows)
    got = [tuple(r) for r in similar_pairs(frame(spark, rows), "ref", ["emne", "tekst"]).collect()]
    assert len(got) == len(set(got)) and set(got) <= want
    assert len(set(got)) >= 0.99 * len(want) > 800
    root = {}

    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    for a, b in got:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    grouped = {r["ref"]: r["group"] for r in groups(frame(spark, rows), "ref", ["emne", "tekst"]).collect()}
    assert all(grouped[a] == grouped[b] for a, b in got)
    assert {k: find(k) for k in grouped} == grouped


def test_hot_buckets_lose_nothing(spark):
    s = sketched(frame(spark, records()), "ref", ["emne", "tekst"], rows=1)
    assert {tuple(r) for r in candidates(s, rows=1, hot=3).collect()} == {tuple(r) for r in candidates(s, rows=1).collect()}


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (200, 200)]
    got = {r["_v"]: r["_root"] for r in components(spark.createDataFrame(edges, "_a int, _b int")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def test_nothing(spark):
    assert similar_pairs(frame(spark, []), "ref", ["emne", "tekst"]).count() == 0
    assert groups(frame(spark, [("a", None, None), (None, "x", "y")]), "ref", ["emne", "tekst"]).count() == 0


def test_other_words_of_one_signature_have_their_own_keys():
    import numpy as np

    from rulelake.llm.neardup import unseen

    seen = set()
    assert unseen(seen, np.array([5, 5, 5, 6]), np.array([1, 2, 1, 1])).tolist() == [True, True, False, True]
    assert unseen(seen, np.array([5, 5]), np.array([2, 3])).tolist() == [False, True]


def test_copies_are_paired_in_blocks(spark, monkeypatch):
    rows = records()
    monkeypatch.setattr(neardup, "BLOCK", 3)
    got = [tuple(r) for r in similar_pairs(frame(spark, rows), "ref", ["emne", "tekst"]).collect()]
    want = brute(rows)
    assert len(got) == len(set(got)) and set(got) <= want and len(got) >= 0.99 * len(want)


def test_pairs_just_above_the_threshold_are_found(spark):
    rows, want = [], set()
    for i in range(1500):  # 40 words of which 35 or 36 are kept: similarities of 0.778 and 0.818
        own = [f"w{i}_{j}" for j in range(40)]
        keep = 35 + i % 2
        rows += [(f"a{i:04}", None, " ".join(own)), (f"b{i:04}", None, " ".join(own[:keep] + [f"x{i}_{j}" for j in range(40 - keep)]))]
        want.add((f"a{i:04}", f"b{i:04}"))
    got = {tuple(r) for r in similar_pairs(frame(spark, rows), "ref", ["emne", "tekst"]).collect()}
    assert got <= want and len(got) >= 1497


def test_a_long_chain_is_one_component(spark):
    edges = [(i, i + 1) for i in range(3000)]
    got = {r["_root"] for r in components(spark.createDataFrame(edges, "_a int, _b int")).collect()}
    assert got == {0}
