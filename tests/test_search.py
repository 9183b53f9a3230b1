"""Search and ranking by blocks on small texts."""

import numpy as np

from rulelake.operators.ranking import block_scores, packed_vectors, unbeaten
from rulelake.operators.search import excerpt, searched

TEXTS = [
    ("gebyr", "title", "Kontingent for klubber"), ("gebyr", "history", "gebyret hæves"), ("dommer", "title", "Dommerne ved stævner"), ("dommer", "summary", "Landsholdsdragt til alle dommere"),
    ("dragt", "title", "Dragt"), ("dragt", "summary", "landshold får dragt af klubben"), ("plads", "title", "Nye medlemmer"), ("plads", "note", None), ("x", "summary", ""),
]
GROUPS = [["kontingent", "afgift"], ["optagelse", "nye medlemmer"]]


def found(spark, *queries):
    texts = spark.createDataFrame(TEXTS, "key string, field string, text string")
    got = searched(spark.createDataFrame([(q,) for q in queries], "query string"), texts, GROUPS).collect()
    return {q: [k for _, k in sorted((-r["score"], r["key"]) for r in got if r["query"] == q)] for q in queries}


def test_words_prefixes_errors_concepts_and_compounds(spark):
    got = found(spark, "dommer", "kontingant", "afgift", "optagelse", "landsholdsdragt", "og", "zzzz", "")
    assert got["dommer"] == ["dommer"]  # a prefix of dommerne and dommere
    assert got["kontingant"] == ["gebyr"]  # one letter wrong
    assert got["afgift"] == ["gebyr"] and got["optagelse"] == ["plads"]  # a word and a phrase of the thesaurus
    assert set(got["landsholdsdragt"]) == {"dommer", "dragt"}  # the word, and both parts of the compound
    assert got["og"] == got["zzzz"] == got[""] == []


def test_excerpts(spark):
    texts = spark.createDataFrame([("a", " ".join(f"w{i}" for i in range(30)) + " Dommerne kom"), ("b", "intet"), ("c", None)], "key string, text string")
    (r,) = excerpt(texts, spark.createDataFrame([("q", "dommer")], "query string, term string")).collect()
    assert r["key"] == "a" and r["excerpt"] == "w24 w25 w26 w27 w28 w29 <mark>Dommerne</mark> kom"


def test_blocks_equal_all_pairs(spark):
    rng = np.random.default_rng(1)
    vectors = {f"k{i:02}": {f"t{t}": float(rng.random()) for t in rng.choice(12, rng.integers(0, 6), replace=False)} for i in range(40)}
    cats = {k: "ab"[i % 2] for i, k in enumerate(vectors)}
    keys = spark.createDataFrame(list(cats.items()), "key string, category string")
    rows = packed_vectors(keys, spark.createDataFrame([(k, t, w) for k, v in vectors.items() for t, w in v.items()], "key string, term string, w double"), "key")
    asked = rows.where("key < 'k12'").selectExpr("key as query", "category", "terms", "ws", "array(key) as excluded").select("*", *unbeaten())

    def score(q, k):
        return round(sum(w * vectors[k].get(t, 0.0) for t, w in vectors[q].items()) * (1.3 if cats[q] == cats[k] else 1.0), 9)

    want = {q: sorted(((-score(q, k), k) for k in vectors if k != q))[:5] for q in vectors if q < "k12"}
    got = {}
    for r in block_scores(asked, rows, boost=0.3, k=5).collect():
        got.setdefault(r["query"], []).append((-r["score"], r["key"]))
    assert {q: sorted(v) for q, v in got.items()} == want  # rows without a term in common among them
    pairs = {(r["query"], r["key"]) for r in block_scores(asked, rows, least=0.4).collect()}
    plain = {(q, k) for q in want for k in vectors if k != q and round(score(q, k) / (1.3 if cats[q] == cats[k] else 1.0), 9) >= 0.4}
    assert pairs == plain
    assert block_scores(asked.limit(0), rows, k=5).count() == 0
