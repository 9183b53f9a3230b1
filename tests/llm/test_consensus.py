"""The mixture finds spammers and the truth that a majority misses."""

import random

import pytest

from rulelake.llm import consensus
from rulelake.llm.consensus import fitted

CLASSES = ["keep", "reject", "merge"]
SCHEMA = "doc string, cand int, judge string, verdict string, _a string, confidence double, _votes int"


def labels(seed=1, items=300):
    rng = random.Random(seed)
    competence = {f"j{i}": c for i, c in enumerate([0.95, 0.9, 0.85, 0.5, 0.02, 0.02, 0.02])}
    truth, rows = {}, []
    for i in range(items):
        t = truth[f"d{i}", 1] = rng.choices(CLASSES, [5, 3, 2])[0]
        for j, c in competence.items():
            rows.append((f"d{i}", 1, j, t if rng.random() < c else "keep" if c < 0.1 else rng.choice(CLASSES)))
    return truth, rows


def test_truth_and_competence(spark):
    truth, rows = labels()
    items, judges = fitted(spark.createDataFrame([(*r, "clash", 0.0, 0) for r in rows], SCHEMA), ["doc", "cand"], "judge", "verdict", CLASSES)
    got = {(r["doc"], r["cand"]): r for r in items.collect()}
    right = sum(got[k]["verdict"] == t for k, t in truth.items()) / len(truth)
    votes = {}
    for doc, cand, _, v in rows:
        votes.setdefault((doc, cand), []).append(v)
    plain = sum(max(CLASSES, key=v.count) == truth[k] for k, v in votes.items()) / len(truth)
    assert right > 0.93 and right > plain + 0.05
    c = {r["judge"]: r["competence"] for r in judges.collect()}
    assert min(c["j0"], c["j1"], c["j2"]) > 0.75 > 0.6 > c["j3"] > 0.3 and max(c["j4"], c["j5"], c["j6"]) < 0.25
    assert all(r["votes"] == 7 and 0 <= r["agreement"] <= 1 and r["confidence"] > 1 / 3 for r in got.values())


def test_odd_votes(spark):
    rows = [("d", 1, "a", "keep"), ("d", 1, None, "keep"), (None, 1, "a", "keep"), ("d", None, "a", "keep"), ("d", 2, "a", "huh"), ("d", 3, "a", None), ("e", 1, "b", "merge")]
    items, judges = fitted(spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA), ["doc", "cand"], "judge", "verdict", CLASSES)
    assert {(r["doc"], r["cand"], r["verdict"], r["agreement"]) for r in items.collect()} == {("d", 1, "keep", None), ("e", 1, "merge", None)}
    assert judges.count() == 2


def test_nothing(spark):
    items, judges = fitted(spark.createDataFrame([], SCHEMA), ["doc", "cand"], "judge", "verdict", CLASSES)
    assert items.count() == 0 and judges.count() == 0


def test_joined_parameters_give_the_same(spark):
    _, rows = labels(3, 60)
    votes = spark.createDataFrame([(*r, "clash", 0.0, 0) for r in rows], SCHEMA).repartition(3)
    a, b = [fitted(votes, ["doc", "cand"], "judge", "verdict", CLASSES, broadcast_annotators=n) for n in (100, 0)]
    for x, y in zip(a, b):
        plain = [sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in t.select(a[0].columns if x is a[0] else a[1].columns).collect()) for t in (x, y)]
        assert plain[0] == plain[1]


def test_the_fit_goes_on_until_nothing_moves(spark, monkeypatch):
    _, rows = labels(4, 80)
    votes = spark.createDataFrame([(*r, "clash", 0.0, 0) for r in rows], SCHEMA)
    steps = []
    step = consensus._Packed.step
    monkeypatch.setattr(consensus._Packed, "step", lambda self, states: steps.append(1) or step(self, states))
    fitted(votes, ["doc", "cand"], "judge", "verdict", CLASSES, tolerance=1e-9)
    assert len(steps) > 30
    monkeypatch.setattr(consensus, "FAILED", 10)
    with pytest.raises(RuntimeError):
        fitted(votes, ["doc", "cand"], "judge", "verdict", CLASSES, tolerance=1e-9)
