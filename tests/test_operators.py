"""Single operators on hand-written cases."""

import json
import random

import pytest
from pyspark.sql import functions as F

from rulelake.functions.danish import compound_parts, stem
from rulelake.operators.identity import compared, resolved, run_lengths
from rulelake.operators.order import global_rank
from rulelake.operators.quotes import located, one_to_one
from rulelake.operators.temporal import in_force, year_ranges
from rulelake.operators.voting import majority
from rulelake.sources import documents, files
from rulelake.streaming.windows import windowed_counts

V = "slug string, idx int, ref string, dato string, gaelder_fra string, gaelder_til string, effekt string"


def held(spark, rows, *cutoffs):
    v = spark.createDataFrame([("s", i, *r) for i, r in enumerate(rows)], V)
    v = v.withColumn("effective", F.coalesce("gaelder_fra", "dato", F.lit(""))).withColumn("decided", F.coalesce("dato", F.lit("")))
    got = {r["cutoff"]: (r["ref"], r["adopted"]) for r in in_force(v, spark.createDataFrame([(c,) for c in cutoffs], "cutoff string")).collect()}
    return [got.get(c) for c in cutoffs]


@pytest.mark.parametrize(
    "rows, cutoffs, want",
    [
        ([("a", "2010-04-01", None, None, "indfoert"), ("b", "2015-04-01", None, None, "ophaevet")], ["2012-12-31", "2016-12-31"], [("a", "a"), None]),
        ([("a", "2020-01-01", None, None, "indfoert"), ("b", "2024-03-24", "2025-01-01", None, "aendret")], ["2024-12-31", "2025-06-01"], [("a", "a"), ("b", "b")]),
        ([("a", "2020-01-01", None, None, "indfoert"), ("b", "2024-06-01", "2024-01-01", None, "aendret")], ["2024-03-01", "2024-12-31"], [("a", "a"), ("b", "b")]),
        ([("a", "2020-01-01", None, "2023-12-31", "indfoert")], ["2023-06-01", "2024-06-01"], [("a", "a"), None]),
        ([("a", "2016-12-04", "2018-01-01", None, "indfoert"), ("b", "2020-08-16", "2019-01-01", None, "aendret"), ("c", "2019-12-07", None, None, "bekraeftet")], ["2019-12-31", "2020-12-31"], [("c", "a"), ("c", "b")]),
        ([("a", "2015", None, None, "indfoert")], ["2014-12-31", "2015-06-01"], [None, ("a", "a")]),
        ([("a", "2015-01-01", None, None, "indfoert"), ("b", "2016-01-01", None, None, "foreslaaet"), ("c", "2017-01-01", None, None, "trukket")], ["2018-12-31"], [("a", "a")]),
    ],
)
def test_in_force(spark, rows, cutoffs, want):
    assert held(spark, rows, *cutoffs) == want


def test_in_force_equals_a_fold(spark):
    rng = random.Random(5)
    for _ in range(6):
        day = lambda: f"20{rng.randint(10, 14)}-0{rng.randint(1, 9)}-01"
        rows = [(f"r{i}", rng.choice([day(), day(), "2012", None]), rng.choice([None, day()]), rng.choice([None, None, day()]), rng.choice(["indfoert", "aendret", "bekraeftet", "ophaevet", "foreslaaet"])) for i in range(12)]
        cutoffs = [f"20{y}-12-31" for y in range(9, 16)]
        want = []
        order = sorted(range(len(rows)), key=lambda i: (rows[i][2] or rows[i][1] or "", rows[i][1] or "", i))
        for c in cutoffs:
            seen = [rows[i] for i in order if (rows[i][2] or rows[i][1] or "") <= c and (rows[i][1] or "") <= c]
            state = origin = None
            for r in seen:
                if r[4] in ("indfoert", "aendret", "bekraeftet"):
                    state = r
                elif r[4] == "ophaevet":
                    state = None
            if state is None or (state[3] and state[3] < c):
                want.append(None)
                continue
            if state[4] == "bekraeftet":
                for r in seen[: seen.index(state)]:
                    origin = r if r[4] in ("indfoert", "aendret") else None if r[4] == "ophaevet" else origin
            want.append((state[0], (origin or state)[0]))
        assert held(spark, rows, *cutoffs) == want


def test_stems():
    words = "licensgebyret landsholdsdragt stævner mødet beslutningerne hundrede uheldig"
    assert [stem(w) for w in words.split()[:3]] == ["licensgebyr", "landsholdsdrag", "stævn"]
    assert stem("") == "" and stem("af") == "af"


def test_compounds(spark):
    v = spark.createDataFrame([(w,) for w in "landsholdsdragt dragt landshold hold licens gebyr licensgebyr".split()], "word string")
    assert {tuple(r) for r in compound_parts(v).collect()} == {("landsholdsdragt", "landshold"), ("landsholdsdragt", "dragt"), ("licensgebyr", "licens"), ("licensgebyr", "gebyr")}


def test_year_ranges(spark):
    df = spark.createDataFrame([("a", y) for y in ("2015", "2016", "2017", "2019", "2019")] + [("b", None)], "k string, y string")
    assert [tuple(r) for r in year_ranges(df, "k", "y").collect()] == [("a", "2015–2017, 2019")]


def test_quotes(spark):
    text = "indledning om mødet licensgebyret er nu side to 200 kr om året for alle licensgebyret er betalt"
    rows = [("header", "licensgebyret er nu 200 kr om året for alle", text), ("none", "helt andre ord end disse her", text), ("short", "om året", text), ("empty", "", text), ("null", None, None)]
    got = {r["k"]: (r["share"] >= 0.8, r["start"]) for r in located(spark.createDataFrame(rows, "k string, q string, t string"), "k", "q", "t").collect()}
    assert got.get("short") == (True, 10) and "none" not in got and "empty" not in got and "null" not in got
    exact = located(spark.createDataFrame([("x", "er nu side to", text)], "k string, q string, t string"), "k", "q", "t").first()
    assert (exact["share"], exact["start"]) == (1.0, 4)


def test_greedy_matching(spark):
    rng = random.Random(1)
    for _ in range(4):
        pairs = [(i, j, rng.randint(1, 6) / 6) for i in range(7) for j in range(7) if rng.random() < 0.5]
        want, a, b = set(), set(), set()
        for i, j, s in sorted(pairs, key=lambda p: (-p[2], p[0], p[1])):
            if i not in a and j not in b:
                want.add((i, j)), a.add(i), b.add(j)
        got = one_to_one(spark.createDataFrame(pairs, "o int, n int, s double"), "o", "n", "s").collect()
        assert {(r["o"], r["n"]) for r in got} == want


def test_greedy_matching_of_copies_and_ties(spark):
    copies = spark.range(150).select(F.format_string("o%03d", "id").alias("o")).crossJoin(spark.range(150).select(F.format_string("n%03d", "id").alias("n")))
    got = one_to_one(copies.withColumn("s", F.lit(0.5)), "o", "n", "s").collect()
    assert sorted((r["o"], r["n"]) for r in got) == [(f"o{i:03d}", f"n{i:03d}") for i in range(150)]
    rng = random.Random(2)
    for _ in range(3):
        at, to = [[rng.randrange(3) for _ in range(9)] for _ in range(2)]
        level = [[rng.choice([None, 0.5, 0.5, 0.75]) for _ in range(3)] for _ in range(3)]
        pairs = [(g, i, j, s) for g in ("x", "y") for i in range(9) for j in range(9) if (s := level[at[i]][to[j]]) is not None]
        want, a, b = set(), set(), set()
        for g, i, j, s in sorted(pairs, key=lambda p: (-p[3], p[1], p[2])):
            if (g, i) not in a and (g, j) not in b:
                want.add((g, i, j)), a.add((g, i)), b.add((g, j))
        got = one_to_one(spark.createDataFrame(pairs, "g string, o int, n int, s double"), "o", "n", "s", by=["g"]).collect()
        assert {(r["g"], r["o"], r["n"]) for r in got} == want and len(got) == len(want)


def test_aliases_chain_and_circle(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("x", "y"), ("y", "x"), (None, "q")], "src string, dst string")
    assert {r["src"]: r["target"] for r in resolved(df).collect()} == {"a": "d", "b": "d", "c": "d", "x": None, "y": None}


def test_compared(spark):
    a, b = [spark.createDataFrame(r, "k string, v int") for r in ([("a", 1), ("b", None), ("c", 3)], [("a", 2), ("b", None), ("d", 4)])]
    assert {tuple(r) for r in compared(a, b, "k", "v").collect()} == {("a", "changed"), ("c", "retired"), ("d", "new")}


def test_majority(spark):
    rows = [("i", "keep", 3), ("i", "reject", 1), ("i", "reject", 2), ("j", "keep", 2), ("j", "merge", 1), ("j", "keep", 3), ("j", "merge", 4), ("l", "keep", 1)]
    assert {tuple(r) for r in majority(spark.createDataFrame(rows, "i string, v string, o int"), ["i"], "v", "o").collect()} == {("i", "reject", 2), ("j", "merge", 2)}


def test_runs_and_ranks(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate("xxyyyx")] + [("a", 9, None)], "k string, i int, v string")
    assert sorted((r["run"], r["v"], r["rows"]) for r in run_lengths(df, "k", ["i"], "v").collect()) == [(1, "x", 2), (2, "y", 3), (3, "x", 1), (4, None, 1)]
    ranked = global_rank(spark.range(1000).withColumn("x", -F.col("id")), ["x"])
    assert all(r["turn"] == 1000 - r["id"] for r in ranked.collect())
    assert global_rank(spark.range(0), ["id"]).count() == 0


def test_charsets():
    assert documents.decoded_bytes("blåbær".encode()) == "blåbær"
    assert documents.decoded_bytes("blåbær".encode("cp1252")) == "blåbær"
    assert documents.decoded_bytes("﻿ø".encode("utf-16-le")) == "ø"
    assert documents.decoded_bytes("ø".encode("cp865"), "cp865") == "ø"
    assert documents.decoded_bytes("ø".encode(), "ascii") == "ø"
    assert documents.decoded_bytes(None) is None and documents.decoded_bytes(b"") == ""


def test_html(spark):
    page = '<b>Bestyrelse</b><ul><li><a href="a.pdf">Referat  1</a><li><a href="b.pdf">Nr&nbsp;2</a></ul><b></b><b>Kongres</b><a href="c.htm">C</a><a name="x">no</a><script>var a = "<p>";</script>'
    df = spark.createDataFrame([(1, page), (2, None), (3, "")], "id long, html string")
    assert [tuple(r)[1:] for r in documents.html_links(df, "id", "html").collect()] == [(0, "a.pdf", "Referat 1", "Bestyrelse"), (1, "b.pdf", "Nr 2", "Bestyrelse"), (2, "c.htm", "C", "Kongres")]
    texts = {r["id"]: r["text"] for r in documents.html_texts(df, "id", "html").collect()}
    assert texts[1].split("\n")[0] == "Bestyrelse" and "var a" not in texts[1] and texts[2] == texts[3] == ""


def test_page_words(spark):
    df = spark.createDataFrame([("d", "før [Side 3] to ord [Side 4] slut"), ("e", None)], "id string, text string")
    assert [(r["word"], r["page"], r["pos"]) for r in documents.page_words(df, "id", "text").orderBy("pos").collect()] == [("før", None, 0), ("to", 3, 1), ("ord", 3, 2), ("slut", 4, 3)]


def test_sync(spark):
    a = spark.createDataFrame([("A.pdf", 0, 5), ("a.PDF", 1, 6), ("b.pdf", 2, 7)], "name string, place int, size int")
    b = spark.createDataFrame([("a.pdf", 5), ("c.pdf", 1)], "name string, size int")
    assert {tuple(r) for r in documents.synced(a, b).collect()} == {("A.pdf", "both", True), ("b.pdf", "linked", False), ("c.pdf", "local", False)}


def test_nested_files(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x/a.json").write_text(json.dumps({"doc_id": "a", "moededato": "2020-01-01", "retired": [{"id": "a#9", "emne": "x"}], "beslutninger": [{"id": "a#2", "emne": "E", "side": 1, "citat_side": 2}, {"id": "a#1", "emne": "F", "side": 3}]}))
    (tmp_path / "x/b.json").write_text(json.dumps({"doc_id": "b", "beslutninger": []}))
    got = files.extracted_decisions(spark, str(tmp_path / "x")).orderBy("rank").collect()
    assert [(r["ref"], r["page"], r["side_rettet"], r["rank"]) for r in got] == [("a#2", 2, True, 0), ("a#1", 3, False, 1)]
    assert files.retired_ids(spark, str(tmp_path / "x")).count() == 1
    (tmp_path / "r.json").write_text(json.dumps({"kategori": "k", "regler": [{"titel": "T", "slug": "t", "versioner": [{"ref": "a#1"}, {"ref": "a#2"}]}], "udeladt": ["z"]}))
    assert [(r["slug"], r["idx"], r["ref"]) for r in files.filed_versions(spark, str(tmp_path / "r.json")).orderBy("idx").collect()] == [("t", 0, "a#1"), ("t", 1, "a#2")]
    assert [tuple(r) for r in files.one_offs(spark, str(tmp_path / "r.json")).collect()] == [("k", "z")]
    (tmp_path / "s.json").write_text(json.dumps({"aliases": {"old": {"to": "new"}}, "retired": {"dead": {}}}))
    assert {tuple(r) for r in files.slug_registry(spark, str(tmp_path / "s.json")).collect()} == {("old", "new"), ("dead", None)}


def test_run_log_skips_torn_lines(spark, tmp_path):
    good = json.dumps({"time": "t", "command": "c d", "steps": {"x": {"calls": 2}, "y": {"calls": 3}}}, ensure_ascii=False)
    (tmp_path / "runs.jsonl").write_text(good + "\n" + good[:20] + "\n" + good)
    assert files.run_log(spark, str(tmp_path / "runs.jsonl")).agg(F.sum("calls"), F.count("*")).first()[:] == (10, 4)


def test_guarded_write(spark, tmp_path):
    df = spark.createDataFrame([("a<b",)], "x string")
    files.stored(df, str(tmp_path / "eval/out"), within=str(tmp_path / "eval"))
    assert spark.read.json(str(tmp_path / "eval/out")).first()["x"] == "a<b"
    for bad in (str(tmp_path / "data"), str(tmp_path / "eval/../data")):
        with pytest.raises(ValueError):
            files.stored(df, bad, within=str(tmp_path / "eval"))
    assert files.site_payload(df, "x").first()["json"] == '{"x":"a\\u003cb"}'


def test_windows(spark):
    df = spark.createDataFrame([("2024-01-01 00:10:00", "a", 1.0), ("2024-01-01 00:59:59", "a", 2.0), ("2024-01-01 01:00:00", "a", 4.0)], "t string, k string, value double").withColumn("t", F.col("t").cast("timestamp_ntz"))
    assert sorted((str(r["start"]), r["n"], r["total"]) for r in windowed_counts(df, "t", "k").collect()) == [("2024-01-01 00:00:00", 2, 3.0), ("2024-01-01 01:00:00", 1, 4.0)]


def test_answers_are_kept_by_fingerprint(spark):
    from rulelake.operators.asking import answered, fingerprinted

    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None)], "k int, t string")
    none = spark.createDataFrame([], "fingerprint bigint, answer string")
    first = answered(df, "k", ["t"], none, lambda b: [f"re {t}" for t in b["t"]])
    assert {r["k"]: r["answer"] for r in first.collect()} == {1: "re a", 2: "re b", 3: "re a", 4: "re None"}
    kept = fingerprinted(spark.createDataFrame([("a", "kept")], "t string, answer string"), ["t"]).select("fingerprint", "answer")
    got = {r["k"]: r["answer"] for r in answered(df, "k", ["t"], kept, lambda b: ["new"] * len(b), most=1).collect()}
    assert got[1] == got[3] == "kept" and sorted([got[2] or "", got[4] or ""]) == ["", "new"]


def test_pairs_of_all_snapshots(spark):
    from rulelake.plans.changes import snapshot_pairs

    rng = random.Random(4)
    texts = ["a b c d e f", "a b c d e g", "a b c x y z", "k l m n", "k l m o p", "kun to"]
    rows = [(day, 1, "d", "d#99", "", "vedtaget", "k l m n q r") for day in ("2024-01", "2024-02")]  # faulty deliveries, replaced
    rows += [(day, 2, doc, f"{doc}#{i:02d}", "", rng.choice(["vedtaget", "vedtaget ", "trukket"]), rng.choice(texts)) for day in ("2024-01", "2024-02", "2024-03", "2024-04") for doc in "de" for i in range(12) if rng.random() < 0.8]
    want = set()
    for one, two in (("2024-01", "2024-02"), ("2024-02", "2024-03"), ("2024-03", "2024-04")):
        side = lambda day: [(r[2], r[5].strip(), r[3], {tuple(r[6].split()[i : i + 3]) for i in range(len(r[6].split()) - 2)}) for r in rows if r[:2] == (day, 2)]
        scored = [(round(len(g & h) / len(g | h), 9), o, n) for da, ua, o, g in side(one) for db, ub, n, h in side(two) if (da, ua) == (db, ub) and g & h]
        a, b = set(), set()
        for s, o, n in sorted(scored, key=lambda p: (-p[0], p[1], p[2])):
            if s >= 0.25 and o not in a and n not in b:
                want.add((two, o, n, s)), a.add(o), b.add(n)
    got = snapshot_pairs(spark.createDataFrame(rows, "snapshot_date string, delivered_at int, doc_id string, ref string, emne string, udfald string, tekst string")).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want) and len({r[0] for r in want}) == 3


def test_merged_rules_say_all(spark, tmp_path):
    from rulelake.plans.changes import rules_merged_by_name

    titles = [f"Kontingent for {w} klubber" for w in ["store"] * 7 + ["små"]]
    titles[5], titles[6] = "Kontingent for store  klubber", "kontingent for STORE klubber"
    v = [(f"s{i}", "okonomi", t, False, n, j, f"d#{i}{j}", "indfoert", "x", None, "x", "h") for i, t in enumerate(titles) for n in [f"note {max(i, 1)}" if i != 3 else None] for j in range(2 if i == 6 else 1)]
    names = "slug kategori titel vigtig note idx ref effekt tekst kort kort_regel dhash"
    spark.createDataFrame(v, ", ".join(f"{c} {'boolean' if c == 'vigtig' else 'int' if c == 'idx' else 'string'}" for c in names.split())).withColumn("filed_at", F.lit("2021-01-01").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/rule_version.parquet")
    dec = [(r[6], "d", "2020-01-01") for r in v]
    rest = [c for c in "gaelder_fra gaelder_til udfald handling niveau emne tekst side side_rettet".split()]
    spark.createDataFrame(dec, "ref string, doc_id string, dato string").withColumns({c: F.lit(None).cast("string") for c in rest}).write.parquet(f"{tmp_path}/decision.parquet")
    (row,) = rules_merged_by_name(spark, str(tmp_path)).collect()
    assert (row["survivor"], row["merged"], row["versions"]) == ("s6", 7, 8)
    assert row["titles"] == "kontingent for STORE klubber / Kontingent for store klubber / Kontingent for store  klubber"
    assert row["notes"] == "note 6 note 1 note 2 note 4 note 5"


def test_bootstrap_resamples_documents(spark):
    from rulelake.operators.voting import bootstrap, named_unit, poisson_weight

    rng = random.Random(6)
    docs = [(f"d{i}", k := rng.randint(0, 10), 10, max(0, k - rng.randint(-2, 3)), 10) for i in range(40)]
    df = spark.createDataFrame(docs, "doc string, ca int, ja int, cb int, jb int").withColumn("unit", named_unit("doc"))
    drawn = df.crossJoin(spark.range(1, 2001)).select("doc", F.col("id").alias("s"), poisson_weight(F.col("unit"), F.col("id")).alias("w"))
    by_doc = drawn.groupBy("doc").agg(F.avg("w").alias("m"), F.max("w").alias("most")).collect()
    assert all(abs(r["m"] - 1) < 0.15 for r in by_doc) and max(r["most"] for r in by_doc) >= 5
    mean, spread = drawn.groupBy("s").agg(F.sum("w").alias("n")).agg(F.avg("n"), F.var_samp("n")).first()
    assert abs(mean - 40) < 1 and 32 < spread < 48  # independent documents
    got = bootstrap(df, "unit", ("ca", "ja"), ("cb", "jb"), 2000, poisson_weight).first()
    diffs = []
    for _ in range(2000):
        p = [rng.choice(docs) for _ in docs]
        diffs.append(sum(r[1] - r[3] for r in p) / 400)
    diffs.sort()
    assert abs(got["low"] - diffs[49]) < 0.015 and abs(got["high"] - diffs[1949]) < 0.015


def test_earlier_filed_counts_all(spark):
    from rulelake.operators.temporal import earlier_filed

    rng = random.Random(8)
    rows = [(k, i, rng.randrange(1990, 2026), rng.randrange(40)) for k in "ab" for i in range(60)] + [("c", 0, 2001, 5)]
    want = {(k, i): tuple(sum(1 for x, _, g, p in rows if x == k and g < f and (p < o if side == 0 else p > o)) for side in (0, 1)) for k, i, f, o in rows}
    got = earlier_filed(spark.createDataFrame(rows, "k string, i int, f int, o int"), "k", "f", "o").collect()
    assert {(r["k"], r["i"]): (r["before"], r["after"]) for r in got} == want and len(got) == len(rows)
