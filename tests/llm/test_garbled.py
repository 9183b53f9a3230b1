"""Texts are garbled by each channel and come back; what only looks odd is left alone."""

import random

from rulelake.llm.garbled import _misread, channels, restored

SCHEMA = "ref string, tekst string, citat string, felt string, _t string, text string"
CLEAN = [
    "Stævnekomiteen pålægger udøverne at aflevere løfterplanen før mødet i Ærø.",
    "Fremover betaler hjælperne 90 kr. for vægtprøven, så længe Åsemark råder over hallen.",
    "Ansøgninger bedømmes af årsmødet, når trænerne når det, og afgøres på næste møde.",
    "Rejser til Østerø refunderes, såfremt dommerne får adgang til prøven.",
]
ODD = ["Øl à 25 kr.", "Mål: 80 cm × 120 cm, ¾ lukket, Ÿ-mærket.", "Æresmedlem †2004, «Règlement», JOÃO AMÂNCIO, SÃO.", "› ‘på mødet’ € 20 ± 5 ‰", "клуб Сокол", "måned på", "Hvad koster det ? Hvem ??", "paa moedet i Aarhus", "a+b- c", "x" * 50_000 + "é", "é" * 50_000]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], SCHEMA)


def through(text, chain):
    for r, w in chain:
        text = _misread(text.encode(r), w)
    return text


CHAINS = [[("utf-8", "cp1252")], [("utf-8", "latin-1")], [("utf-8", "iso8859-15")], [("utf-8", "mac_roman")], [("utf-8", "cp850")], [("utf-8", "cp1251")], [("utf-8", "cp1252")] * 2, [("utf-8", "latin-1"), ("utf-8", "cp1252")], [("utf-8", "cp1252")] * 3,
          [("cp1252", "cp850")], [("cp1252", "cp1251")], [("mac_roman", "cp1252")], [("cp865", "cp1252")]]


def test_channels_are_restored(spark):
    rows = [(f"c{i}", t, None) for i, t in enumerate(CLEAN)] + [(f"o{i}", t, "") for i, t in enumerate(ODD)]
    want = {}
    for i, chain in enumerate(CHAINS):
        for j, t in enumerate(CLEAN):
            rows.append((f"g{i}-{j}", "rent", through(t, chain)))
            want[f"g{i}-{j}"] = t
    for j, t in enumerate(CLEAN):
        rows.append((f"u{j}", t.replace("ø", "+APg-").replace("æ", "+AOY-").replace("å", "+AOU-"), None))
        rows.append((f"l{j}", "".join("�" if c in "æøå" and random.Random(j).random() < 2 else c for c in t), None))
        want[f"u{j}"] = want[f"l{j}"] = t
    got = restored(frame(spark, rows + rows[:3]), "ref", ["tekst", "citat"]).collect()
    assert len(got) == len({(r["ref"], r["felt"]) for r in got})
    assert {r["ref"] for r in got} == set(want)
    assert all(r["felt"] == ("citat" if r["ref"][0] == "g" else "tekst") for r in got)
    wrong = [(r["ref"], r["tekst"], want[r["ref"]]) for r in got if r["tekst"] != want[r["ref"]]]
    assert len(wrong) <= 0.03 * len(want), wrong
    assert all(r["complete"] for r in got if r["tekst"] == want[r["ref"]])


def test_partly_garbled_and_lost(spark):
    rows = [(f"c{i}", t, None) for i, t in enumerate(CLEAN)] + [("p", "Gæst: JOÃO. Et enigt årsmøde kom på mÃ¸det.", None), ("q", "xyz�zyx og �", None)]
    got = {r["ref"]: r for r in restored(frame(spark, rows), "ref", ["tekst", "citat"]).collect()}
    assert got["p"]["tekst"] == "Gæst: JOÃO. Et enigt årsmøde kom på mødet." and got["p"]["complete"]
    assert set(got) == {"p", "q"} and not got["q"]["complete"]


def test_nothing(spark):
    assert restored(frame(spark, []), "ref", ["tekst", "citat"]).count() == 0
    assert restored(frame(spark, [(None, "mÃ¸de", None), ("a", None, "")]), "ref", ["tekst", "citat"]).count() == 0


def test_channels_are_told_apart():
    table = channels()
    assert len({name for name, _, _ in table}) == len(table)
    assert all(not form.isascii() for _, _, forms in table for form in forms)
