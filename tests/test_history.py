"""Type-two history, snapshots and intervals against plain Python, with the cases that data can bring."""

import random
from datetime import date, timedelta

from rulelake.operators.history import OPEN, merge_type2, merge_type2_table, type2_periods, type2_state, type2_versions
from rulelake.operators.intervals import periods_and_gaps
from rulelake.operators.snapshots import snapshot_changes

EVENTS = "slug string, start string, dato string, idx int, wording bigint, ref string, valid_from string, _best string"


def brute_history(rows):
    out, by = [], {}
    for slug, start, dato, idx, w, ref in rows:
        if slug is not None and start is not None:
            by.setdefault(slug, {}).setdefault(start, set()).add((dato or "", idx, w is not None, w or 0, ref, w))
    for slug, starts in by.items():
        last, opened = None, None
        for start in sorted(starts):
            w = max(starts[start])[-1]
            if w != last:
                if last is not None:
                    out.append((slug, opened, start))
                last, opened = w, start
        if last is not None:
            out.append((slug, opened, OPEN))
    return sorted(out)


def periods(state):
    return sorted(tuple(r) for r in type2_periods(state, ["slug"], "wording").collect())


def random_rows(n, seed):
    rng = random.Random(seed)
    return [
        (rng.choice(["a", "b", "hot", "hot", "hot", None]), rng.choice([None, "2010", "2010-01-01", "2011-05-05", f"20{rng.randint(10, 20)}-0{rng.randint(1, 9)}-01"]), rng.choice(["", "2009", "2012-01-01"]), rng.randint(0, 5), rng.choice([None, 1, 2, 3]), f"r{rng.randint(0, 9)}")
        for _ in range(n)
    ]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], EVENTS)


def test_history_equals_a_fold(spark):
    for seed in range(4):
        rows = random_rows(120, seed)
        state = type2_state(frame(spark, rows), ["slug"], "start", ["dato", "idx"], "wording", ["ref"])
        assert periods(state) == brute_history(rows)


ARGS = (["slug"], "start", ["dato", "idx"], "wording", ["ref"])


def versions(dimension):
    return sorted(tuple(r) for r in type2_versions(dimension, ["slug"], "wording").collect())


def test_history_merged_in_any_batches_is_the_same(spark):
    for seed in (7, 8):
        rows = random_rows(90, seed)
        rng = random.Random(seed)
        for batches in ([rows[i::3] for i in range(3)], [rng.sample(rows, 40), rows, rows[:5], []]):
            dimension = None
            for batch in batches:
                dimension = merge_type2(dimension, frame(spark, batch), *ARGS).checkpoint()
            assert versions(dimension) == brute_history(rows)


def test_a_merge_leaves_what_is_before_the_batch(spark):
    rows = [("a", "2010", "", 0, 1, "r1"), ("a", "2012", "", 0, 2, "r2"), ("a", "2014", "", 0, 2, "r3"), ("b", "2011", "", 0, 5, "r4")]
    dimension = merge_type2(None, frame(spark, rows), *ARGS)
    assert sorted((r.slug, r.valid_from, r.opens, r.valid_to) for r in dimension.collect()) == [("a", "2010", True, "2012"), ("a", "2012", True, OPEN), ("a", "2014", False, None), ("b", "2011", True, OPEN)]
    late = merge_type2(dimension, frame(spark, [("a", "2013", "", 0, 3, "r5")]), *ARGS)  # the confirmation of 2014 now opens again
    assert versions(late) == [("a", "2010", "2012"), ("a", "2012", "2013"), ("a", "2013", "2014"), ("a", "2014", OPEN), ("b", "2011", OPEN)]


def test_a_table_is_merged_by_parts(spark, tmp_path):
    rows = [(f"k{i % 20}", f"20{10 + i % 7}", "", i % 3, i % 4 or None, f"r{i}") for i in range(140)]
    path = f"file://{tmp_path}/history"
    for batch in (rows[:100], rows[100:103], rows[103:]):
        merge_type2_table(spark, path, frame(spark, batch), *ARGS, buckets=8)
    assert versions(spark.read.parquet(path)) == brute_history(rows)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "history").glob("_bucket=*/*.parquet")}
    merge_type2_table(spark, path, frame(spark, [("k1", "2030", "", 0, 9, "r")]), *ARGS, buckets=8)
    same = [p for p, t in before.items() if p.exists() and p.stat().st_mtime_ns == t]
    assert len(same) == len(before) - 1


def test_history_of_nothing(spark):
    state = type2_state(frame(spark, []), ["slug"], "start", ["dato", "idx"], "wording", ["ref"])
    assert periods(state) == []


def brute_intervals(rows):
    by = {}
    for k, a, b in rows:
        try:
            a, b = date.fromisoformat(a or "x"), date.fromisoformat(b or OPEN)
        except ValueError:
            continue
        if k is not None and b >= a:
            by.setdefault(k, []).append((a, b))
    out = []
    for k, xs in by.items():
        merged = []
        for a, b in sorted(xs):
            if merged and (merged[-1][1] == date.max or a <= merged[-1][1] + timedelta(1)):
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        out += [(k, "period", str(a), str(b)) for a, b in merged]
        out += [(k, "gap", str(x[1] + timedelta(1)), str(y[0] - timedelta(1))) for x, y in zip(merged, merged[1:])]
    return sorted(out)


def test_intervals_equal_a_sweep(spark):
    rng = random.Random(3)
    day = lambda: str(date(2020, 1, 1) + timedelta(rng.randint(0, 200)))
    for n in (0, 1, 150):
        rows = [(rng.choice(["a", "b", "hot", None]), rng.choice([day(), day(), None, "2020", "2020-02-31"]), rng.choice([day(), day(), day(), None, "?"]) if rng.random() < 0.97 else None) for _ in range(n)]
        rows = [r for r in rows if not (r[2] is None and rng.random() < 0.9)]
        df = spark.createDataFrame([(*r, "clash", 1) for r in rows + rows], "slug string, f string, t string, kind string, _fra int")
        assert sorted(tuple(r) for r in periods_and_gaps(df, ["slug"], "f", "t").collect()) == brute_intervals(rows)


def test_touching_and_next_day_intervals_are_one(spark):
    df = spark.createDataFrame([("a", "2020-01-01", "2020-01-10"), ("a", "2020-01-11", "2020-01-12"), ("a", "2020-01-14", None)], "slug string, f string, t string")
    assert sorted(tuple(r)[1:] for r in periods_and_gaps(df, ["slug"], "f", "t").collect()) == [("gap", "2020-01-13", "2020-01-13"), ("period", "2020-01-01", "2020-01-12"), ("period", "2020-01-14", OPEN)]


SNAP = "at string, delivered int, ref string, emne string, fra string, _snapshot string, kind string"


def changes(spark, rows):
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SNAP)
    return sorted(tuple(r) for r in snapshot_changes(df, "at", "delivered", ["ref"], ["emne", "fra"]).collect())


def test_snapshots(spark):
    rows = [
        ("1", 1, "a", "x", None), ("1", 1, "b", "y  z", ""), ("1", 1, "b", "y z", None), ("1", 1, "gone", "q", None), ("1", 1, None, "q", None),
        ("2", 1, "a", "WRONG", None), ("2", 2, "a", "x ", ""), ("2", 2, "b", "y z", None), ("2", 2, "fresh", None, None),
        ("3", 5, "a", "x", "2020"), ("3", 5, "gone", "q", None), (None, 5, "a", "x", None),
    ]
    assert changes(spark, rows) == [("2", "fresh", "new"), ("2", "gone", "retired"), ("3", "a", "changed"), ("3", "b", "retired"), ("3", "fresh", "retired"), ("3", "gone", "new")]


def test_snapshots_of_nothing_and_of_one(spark):
    assert changes(spark, []) == []
    assert changes(spark, [("1", 1, "a", "x", None)]) == []
