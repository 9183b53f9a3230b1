"""Sinks, staged publishing, links of index pages and budgets."""

import pytest

from rulelake.operators.asking import answered_within
from rulelake.sources.documents import html_links, linked_documents
from rulelake.sources.files import manifest, published, selected, stored_arrays


def test_arrays_and_places(spark, tmp_path):
    root = f"file://{tmp_path}"
    df = spark.createDataFrame([("a", 'x "y"\n<z>'), ("b", None)], "id string, title string").repartition(3)
    stored_arrays(df, f"{root}/m", within=root)
    assert {(r["id"], r["title"]) for r in manifest(spark, f"{root}/m").collect()} == {("a", 'x "y"\n<z>'), ("b", None)}
    stored_arrays(df.limit(0), f"{root}/n", within=root)
    assert manifest(spark, f"{root}/n").count() == 0
    with pytest.raises(ValueError):
        stored_arrays(df, f"{root}/../n", within=root)


def test_nothing_is_published_unless_all_is_well(spark, tmp_path):
    root = f"file://{tmp_path}"
    one, two = spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([(2,)], "k int")
    published(spark, {"a": one, "b": one}, lambda t: [], within=root)
    with pytest.raises(ValueError, match="too many"):
        published(spark, {"a": two, "b": two}, lambda t: ["too many"] if t["a"].first()[0] > 1 else [], within=root)
    assert [spark.read.parquet(f"{root}/{n}").first()[0] for n in "ab"] == [1, 1]
    published(spark, {"a": two}, lambda t: [], within=root)
    assert [spark.read.parquet(f"{root}/{n}").first()[0] for n in "ab"] == [2, 1]
    assert not list(tmp_path.glob(".staged*"))


def test_links_by_heading(spark):
    html = '<a href="/ungdom/m.htm">menu</a><a href="/x.htm">lost</a><b>Kongres</b><a href="k.pdf">K</a><a href="k.pdf">again</a><a href="d.pdf">Mindeord over</a><b>Nyt Udvalg!</b><a href="u.pdf">U</a>'
    links = html_links(spark.createDataFrame([(1, html), (2, None), (3, "")], "page int, html string"), "page", "html")
    got = {tuple(r) for r in linked_documents(links, {"kongres": "kongres"}, {"ungdom": "ungdom"}, "Mindeord").collect()}
    assert got == {("/ungdom/m.htm", "menu", "ungdom"), ("k.pdf", "K", "kongres"), ("u.pdf", "U", "nyt-udvalg")}


def test_selected_documents_must_be_there(spark):
    docs = spark.createDataFrame([("a", "A"), ("b", "B")], "id string, title string")
    wanted = spark.createDataFrame([("b", 1), ("a", 2)], "doc string, place int")
    assert sorted(r["place"] for r in selected(docs, wanted, "id", "doc").collect()) == [1, 2]
    with pytest.raises(ValueError, match="c"):
        selected(docs, spark.createDataFrame([("c", 1)], "doc string, place int"), "id", "doc")


def test_a_budget_ends_the_asking(spark):
    df = spark.createDataFrame([(i, f"t{i % 8}") for i in range(20)], "k int, t string")
    none = spark.createDataFrame([], "fingerprint bigint, answer string")
    answers, spent = answered_within(df, "k", ["t"], none, lambda b: [f"re {t}" for t in b["t"]], seconds=600, cost=15, batch=2)
    assert spent["asked"] == 4 and spent["skipped"] == 4 and spent["cost"] == 20.0  # five letters an answer, two answers a batch
    assert answers.where("answer is not null").count() in (8, 9, 10, 11, 12)
    kept = answers.where("answer is not null").select("fingerprint", "answer").distinct()
    whole, more = answered_within(df, "k", ["t"], kept, lambda b: [f"new {t}" for t in b["t"]], seconds=600, cost=1e9)
    assert more["asked"] == 4 and more["skipped"] == 0 and whole.where("answer is null").count() == 0
    assert answered_within(df, "k", ["t"], none, lambda b: ["x"] * len(b), seconds=0, cost=9)[1]["asked"] == 0
