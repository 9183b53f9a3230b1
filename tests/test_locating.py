"""Quotes in documents with pages, against a search that reads every document from end to end."""

import random
import re

from rulelake.operators.locating import containing, located_in, occurrences, passages, start_pages, word_blocks
from rulelake.sources.documents import page_words

TEXT = "[Side 1]\nPunkt 5. Det foreslås at alle klubber skal stille med to dommere ved stævner. Debat.\n[Side 2]\nVedtaget: at alle klubber skal stille med to dommere ved stævner.\n"


def words(text):
    return re.findall(r"\w+", (text or "").lower())


def brute(quote, ws, pages, cited):
    q = words(quote)
    if not q or not ws:
        return False, None, None
    if len(q) < 3:
        places = [(i, [pages[i]]) for i in range(len(ws)) if ws[i : i + len(q)] == q]
    else:
        places = [(o[3], o[5]) for o in occurrences(q, ws, pages, 0, -(10**9), 10**9)]
    if not places:
        return False, None, None
    own = [p for p in places if cited is not None and cited in p[1]]
    start = (own or places)[0][0]
    return True, start, cited if own else pages[start]


def located(spark, docs, quotes, block=512):
    frame = spark.createDataFrame([(k, t) for k, t in docs.items()], "doc string, text string")
    w = page_words(frame, "doc", "text").select("doc", "pos", "word", "page")
    blocks = word_blocks(w, block).cache()
    q = spark.createDataFrame([(i, *x, "clash") for i, x in enumerate(quotes)], "key int, doc string, quote string, page int, id string")
    got = {r["key"]: (r["found"], r["pos"], r["page"]) for r in located_in(q, blocks, block=block).collect()}
    known = {}
    for r in w.orderBy("pos").collect():
        known.setdefault(r["doc"], ([], []))[0].append(r["word"])
        known[r["doc"]][1].append(r["page"])
    return got, known, blocks


def test_behaviour(spark):
    docs = {
        "t": TEXT,
        "hyphen": "[Side 2]\nPunkt 4.\n[Side 3]\nDet blev på mødet besluttet at licens-\nopkrævningen for alle aktive løftere hæves til 300 kr fra næste sæson.",
        "header": "[Side 2]\nforeslås følgende: At DSF etablerer et fast løftested, hvor der står\n[Side 3]\n2012-03-30\nfast pro.udstyr mm. til afholdelse af officielle stævner og kurser. Evt. Odense.",
        "coach": "[Side 1]\n4. The head coach.\n5. The head coach must ensure each of his assistant coaches receive a badge.",
        "short": "[Side 1]\nAntidopingpolitikken drøftes.\n[Side 2]\nMødet slutter.\n[Side 3]\nAntidopingpolitikken godkendes.\n",
        "html": "Punkt 5: Divisionsturneringen får nyt navn.",
    }
    q = "at alle klubber skal stille med to dommere ved stævner"
    quotes = [("t", q, 2), ("t", q, 1), ("t", q, 7), ("t", "klubber skal stille med tre kampledere", 1)]
    quotes += [("hyphen", "Det blev på mødet besluttet at licensopkrævningen for alle aktive løftere hæves til 300 kr fra næste sæson", None)]
    quotes += [("header", "At DSF etablerer et fast løftested, hvor der står fast pro.udstyr mm. til afholdelse af officielle stævner og kurser.", 2)]
    quotes += [("coach", "The head coach must ensure each of his assistant coaches receive a badge", None)]
    quotes += [("short", "Antidopingpolitikken godkendes.", 1), ("short", "Antidopingpolitikken", 3), ("short", "Antidopingpolitikken", 2), ("short", "Politikken forkastes.", 2)]
    quotes += [("html", "Divisionsturneringen får nyt navn", None), ("html", "", 1), ("html", None, 1), ("gone", "Divisionsturneringen får nyt navn", 1)]
    got, known, _ = located(spark, docs, quotes)
    assert [got[i][0] for i in range(15)] == [True, True, True, False, True, True, True, True, True, True, False, True, False, False, False]
    assert [got[i][2] for i in (0, 1, 2)] == [2, 1, 1] and got[4][2] == 3 and got[5][2] == 2
    assert got[6][1] == 5 and got[7][1:] == (4, 3) and got[8][1] == 4 and got[9][1:] == (0, 1) and got[11][2] is None
    for i, (doc, quote, page) in enumerate(quotes):
        if doc in known:
            assert got[i] == brute(quote, *known[doc], page), (i, got[i])


def test_against_reading_everything(spark):
    rng = random.Random(6)
    vocabulary = [f"o{i}" for i in range(30)]
    docs = {}
    for d in range(4):
        said = [rng.choice(vocabulary) for _ in range(rng.choice([0, 3, 400, 900]))]
        for _ in range(6):
            i = rng.randrange(len(said) + 1)
            said[i:i] = ["fast", "tekst", "som", "gentages", "ofte", "i", "dokumentet"]
        docs[f"d{d}"] = " ".join(f"[Side {i // 120 + 1}] {w}" if i % 120 == 0 else w for i, w in enumerate(said))
    quotes = []
    for _ in range(120):
        doc = rng.choice(list(docs))
        ws = words(re.sub(r"\[Side \d+\]", " ", docs[doc]))
        n = rng.choice([1, 2, 3, 5, 12, 30])
        i = rng.randrange(max(1, len(ws) - n + 1))
        q = ws[i : i + n]
        for _ in range(rng.choice([0, 0, 1, 2])):
            k = rng.randrange(len(q) + 1)
            q[k : k + rng.choice([0, 1])] = [rng.choice(vocabulary)] * rng.choice([0, 1, 3])
        quotes.append((doc, " ".join(q), rng.choice([None, 1, 2, 5])))
    quotes += [("d0", "fast tekst som gentages ofte i dokumentet", p) for p in (None, 1, 2, 3)]
    for block in (512, 64):
        got, known, _ = located(spark, docs, quotes, block)
        wrong = [(i, quotes[i], got[i], brute(quotes[i][1], *known[quotes[i][0]], quotes[i][2])) for i in got if got[i] != brute(quotes[i][1], *known[quotes[i][0]], quotes[i][2])]
        assert not wrong and len(got) == len(quotes), wrong[:3]


def test_passages_reach_to_the_vote(spark):
    filler = " ".join(f"f{i}" for i in range(700))
    text = f"{filler} her står et citat {filler} vedtaget med 31 stemmer for 7 imod og 2 blanke {filler}"
    quotes = [("d", "her står et citat", None)]
    got, known, blocks = located(spark, {"d": text}, quotes, 64)
    places = spark.createDataFrame([(0, "d", got[0][1], "her står et citat", "31 for, 7 imod, 2 blanke"), (1, "d", got[0][1], "her står et citat", None)], "key int, doc string, pos long, quote string, vote string")
    rows = {r["key"]: r for r in passages(places, blocks, block=64).collect()}
    assert rows[0]["first"] == 600 and rows[0]["words"].startswith("f600 ") and rows[0]["words"].endswith("7 imod og 2 blanke")
    assert rows[1]["last"] == 704 + 400 and rows[1]["words"] == " ".join(known["d"][0][600:1104])


def test_pages_before_a_header():
    assert start_pages(3, ["a", "b", "c"], ["x", "y", "z", "a", "b", "c"], [1, 1, 2, 2, 2, 2], 0) == [2]
    assert start_pages(3, ["a", "b", "q"], ["x", "y", "z", "a", "b", "c"], [1, 1, 2, 2, 2, 2], 0) == [1, 2]


def test_quotes_that_hold_each_other(spark):
    rng = random.Random(3)
    vocabulary = ["a", "b", "c", "d"]
    rows = [(d, f"{d}{i}", "  ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 2, 3, 5, 9]))).upper() or rng.choice([None, "", "..."])) for d in "xy" for i in range(40)]
    a, b = rows[::2], rows[1::2]
    pad = lambda t: f" {' '.join(words(t))} "
    want = {(d, k, m) for d, k, t in a for e, m, u in b if d == e and words(t) and words(u) and (pad(t) in pad(u) or pad(u) in pad(t))}
    frames = [spark.createDataFrame(x, "doc string, key string, quote string") for x in (a, b)]
    got = [tuple(r) for r in containing(*frames).collect()]
    assert set(got) == want and len(got) == len(want)
