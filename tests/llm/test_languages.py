"""Languages on held-out sentences, paragraphs and odd texts."""

import os

import numpy as np
import pytest

from rulelake.llm.languages import LANGUAGES, detected, mixture, passages, sentences

SCHEMA = "doc_id long, text string, lang string, para int, label string, share double"
DATA = "/root/testdata/sf0.001"


def test_sentences():
    text = "Referat 3.\r\n\r\nMødet blev holdt den 1. august i hallen. Klubben betaler 840 kr. pr. start\nfor det. Am 9. März war nichts. Ende\n \t\n|a|b|\n[Side 3]\nSlut"
    assert sentences(text) == [(0, "Referat 3."), (1, "Mødet blev holdt den 1. august i hallen."), (1, "Klubben betaler 840 kr. pr. start for det."), (1, "Am 9. März war nichts."), (1, "Ende"), (2, "Slut")]
    assert sentences("") == [] and sentences("\n \n") == []


def test_mixture_selects_languages():
    scores = np.array([[0, -50, -60], [-50, 0, -60], [0, -4, -60], [0, -5, -60], [-1, 0, -60], [0, -6, -60]], float)
    post = mixture(scores, np.array([0, 0, 1, 1, 1, 1]), 2)
    assert post.argmax(1).tolist() == [0, 1, 0, 0, 0, 0]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_held_out(spark):
    train = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang").collect()
    said = {
        "da": "Klubben skal betale gebyret inden udgangen af måneden, og bestyrelsen afgør sagen på næste møde.",
        "nb": "Klubben må betale avgiften innen utgangen av måneden, og styret avgjør saken på neste møte etter at fristen er ute.",
        "sv": "Föreningen ska betala avgiften innan månadens slut, och styrelsen avgör frågan på nästa möte.",
        "en": "The club has to pay the fee before the end of the month, and the board will decide the matter.",
        "de": "Der Verein muss die Gebühr bis Ende des Monats zahlen, und der Vorstand entscheidet die Frage.",
    }
    rows = [(r[0], r[1], r[2], 1, "clash", 0.5) for r in train]
    rows += [(10_000 + i, said[x], None, 1, "clash", 0.5) for i, x in enumerate(LANGUAGES)]
    rows += [(20_000, said["da"] + "\n\n" + said["da"] + " " + said["en"], "DA_dk", 1, "", 0.1), (20_001, None, "da", 1, "", 0.1), (20_002, "", None, 1, "", 0.1), (20_003, "… 1 2 3 ½", "da", 1, "", 0.1)]
    rows += [(20_004, (said["sv"] + "\n") * 3000, "??", 1, "", 0.1)]
    got = detected(spark.createDataFrame(rows, SCHEMA)).where("doc_id >= 10000").collect()
    docs = {r["doc_id"]: r for r in got if r["para"] is None}
    assert [docs[10_000 + i]["lang"] for i in range(5)] == list(LANGUAGES)
    assert all(docs[10_000 + i]["confidence"] > 0.9 for i in range(5))
    assert sorted((r["para"], r["lang"]) for r in got if r["doc_id"] == 20_000 and r["para"] is not None) == [(0, "da"), (1, "da"), (1, "en")]
    assert docs[20_000]["label"] == "da" and docs[20_004]["lang"] == "sv" and docs[20_004]["label"] is None
    assert all(docs[k]["lang"] is None and docs[k]["confidence"] == 0 for k in (20_001, 20_002, 20_003))


def test_nothing_to_fit(spark):
    assert detected(spark.createDataFrame([], SCHEMA)).count() == 0
    got = detected(spark.createDataFrame([(1, "Mødet blev holdt i hallen.", None, 1, "x", 0.0)], SCHEMA)).collect()
    assert [(r["doc_id"], r["para"], r["lang"]) for r in got] == [(1, None, None)]


def test_passages(spark):
    da, en = "Klubben skal betale gebyret inden udgangen af måneden.", "The club has to pay the fee before the end of the month."
    train = [(i, " ".join([x] * 3), lang, 1, "", 0.0) for i, (x, lang) in enumerate([(da, "da"), (en, "en")] * 20)]
    text = f"{da} {da}\r\n  {en}\n{en} {da}\n\n{en}"
    got = passages(spark.createDataFrame([*train, (99, text, None, 1, "", 0.0), (98, None, None, 1, "", 0.0)], SCHEMA)).where("doc_id >= 98").orderBy("start").collect()
    assert [(r["para"], r["lang"]) for r in got] == [(0, "da"), (0, "en"), (0, "da"), (1, "en")]
    assert [text[r["start"] : r["end"]] for r in got] == [f"{da} {da}", f"{en}\n{en}", da, en]
