"""Matching by place and text against taking the best pair of all pairs, one after the other."""

import random
import re

from rulelake.operators.matching import covered, scored, scores_by_document
from rulelake.operators.quotes import one_to_one

SCHEMA = "doc string, key string, outcome string, a long, b long, text string, o string"


def grams(text):
    w = re.findall(r"\w+", (text or "").lower())
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)}


def score(x, y):
    g, h = grams(x[5]), grams(y[5])
    t = len(g & h) / len(g | h) if g | h else 0.0
    both = x[3] is not None and y[3] is not None
    q = max(min(x[4], y[4]) - max(x[3], y[3]), 0) / min(x[4] - x[3], y[4] - y[3]) if both else 0
    if q > 0:
        return q + t
    return 0.0 if x[2] != y[2] or (both and t < 0.5) else t


def side(rng, name, n):
    words = [f"w{i}" for i in range(25)]
    base = [[rng.choice(words) for _ in range(rng.randint(3, 14))] for _ in range(6)]
    out = []
    for i in range(n):
        a = rng.choice([None, rng.randint(0, 1500)])
        said = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            said[rng.randrange(len(said))] = rng.choice(words)
        out.append((rng.choice("xy"), f"{name}{i:02}", rng.choice(["ja", "nej"]), a, a and a + rng.randint(1, 40) if a is not None else None, rng.choice([" ".join(said)] * 9 + [None, ""]), "clash"))
    return [(d, k, u, a, (b if b else 3) if a is not None else None, t, o) for d, k, u, a, b, t, o in out]


def test_pairs_and_matches(spark):
    for seed in range(3):
        rng = random.Random(seed)
        state = rng.getstate()
        old = side(rng, "o", 40)
        rng.setstate(state)
        new = side(rng, "n", 45)
        want = {(x[0], x[1], y[1]): round(score(x, y), 9) for x in old for y in new if x[0] == y[0] and score(x, y) >= 0.25}
        got = scored(spark.createDataFrame(old + old[:2], SCHEMA), spark.createDataFrame(new, SCHEMA))
        pairs = {(r["doc"], r["old"], r["new"]): round(r["score"], 9) for r in got.collect()}
        assert pairs == want and want
        taken, used = {}, set()
        for (doc, o, n), s in sorted(want.items(), key=lambda x: (-x[1], x[0][1], x[0][2])):
            if (doc, o) not in used and (doc, n) not in used:
                used |= {(doc, o), (doc, n)}
                taken[doc, o, n] = s
        from pyspark.sql import functions as F

        m = one_to_one(got.withColumn("score", F.round("score", 9)), "old", "new", "score", by=["doc"])
        assert {(r["doc"], r["old"], r["new"]): r["score"] for r in m.collect()} == taken
    none = spark.createDataFrame([], SCHEMA)
    assert scored(none, none).count() == 0


def test_covered_spans(spark):
    rows = [("d", "whole", 0, 1200), ("d", "half", 500, 520), ("d", "edge", 1190, 1210), ("d", "out", 1195, 1300), ("e", "whole", 0, 10), ("d", "none", None, None), ("d", "empty", 5, 5)]
    s = spark.createDataFrame(rows, "doc string, key string, a long, b long")
    got = {(r["outer"], r["inner"]): r["share"] for r in covered(s, s).where("outer <> inner").collect()}
    assert got == {("whole", "half"): 1.0, ("out", "edge"): 0.75}


def test_scores(spark):
    probes = [("d", "p1", "i1", "decision", "ja"), ("d", "p2", "i1", "decision", "ja"), ("d", "p3", "i2", "decision", "nej"), ("d", "p4", "i3", "reject", "ja"), ("d", "p5", "i4", "ignored", "ja"), ("e", "p6", "i5", "decision", "ja")]
    run = [("d", "r1", "ja"), ("d", "r2", "nej"), ("d", "r3", "ja"), ("d", "r4", "ja"), ("d", "r5", "ja"), ("f", "r6", "ja")]
    matches = [("d", "p1", "r2", 0.5), ("d", "p2", "r1", 0.9), ("d", "p4", "r3", 0.4), ("d", "p5", "r4", 0.4)]
    frames = [spark.createDataFrame(probes, "doc string, probe string, item string, role string, f string"), spark.createDataFrame(matches, "doc string, old string, new string, score double"), spark.createDataFrame(run, "doc string, key string, f string")]
    got = {r["doc"]: r.asDict() for r in scores_by_document(*frames, ["f"], ["f"]).collect()}
    assert got["d"] == {"doc": "d", "key_decisions": 2, "found": 1, "false_found": 1, "extra": 1, "split": 1, "ignored": 1, "right_f": 1, "right_all": 1, "right_firm": 1, "unjudged": 1}
    assert got["e"]["key_decisions"] == 1 and got["e"]["found"] == 0 and got["f"]["unjudged"] == 1 and got["f"]["key_decisions"] == 0
