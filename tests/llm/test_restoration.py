"""Restoration measured on held-out damage: clean decisions of the test tables are garbled by every channel and restored."""

import glob
import os
import random
import re

import pyarrow.parquet as pq
import pytest

from rulelake.llm.garbled import LETTERS, _misread, restored

DATA = "/root/testdata/sf0.001/decision.parquet"
CHAINS = [[("utf-8", w)] for w in ("cp1252", "latin-1", "iso8859-15", "mac_roman", "cp437", "cp850", "cp865", "cp1251", "koi8-r")]
CHAINS += [[("utf-8", "cp1252")] * 2, [("utf-8", "cp1252")] * 3, [("utf-8", "latin-1"), ("utf-8", "cp1252")]]
CHAINS += [[("cp1252", "cp850")], [("cp1252", "cp1251")], [("mac_roman", "cp1252")], [("cp865", "cp1252")], [("cp850", "cp1252")], [("cp437", "latin-1")]]


def through(text, chain):
    for r, w in chain:
        text = _misread(text.encode(r, "replace"), w)
    return text


def damaged(text, rng, i):
    """A text damaged by one way of several, and the way's name."""
    kind = ("channel", "channel", "channel", "part", "two channels", "lost", "question marks", "seven-bit")[i % 8]
    if kind == "channel":
        return through(text, rng.choice(CHAINS)), kind
    if kind == "part":
        at = rng.randrange(len(text))
        return text[:at] + through(text[at:], rng.choice(CHAINS)), kind
    if kind == "two channels":  # every letter by one of two multi-byte channels, also within a word
        pair = rng.sample(CHAINS[:6], 2)
        return "".join(through(c, rng.choice(pair)) if c in LETTERS else c for c in text), kind
    if kind == "lost":
        return "".join("�" if c in LETTERS else c for c in text), kind
    if kind == "question marks":
        return re.sub(rf"[{LETTERS}]", "?", text), kind
    return text.translate(str.maketrans("æøåÆØÅ", "{|}[\\]")), kind


@pytest.mark.skipif(not glob.glob(DATA), reason="no test tables")
def test_held_out_damage_is_restored(spark):
    path = DATA if os.path.isfile(DATA) else sorted(glob.glob(DATA + "/*.parquet"))[0]
    clean = [t for t in pq.read_table(path, columns=["tekst"])["tekst"].to_pylist() if t and not re.search(rf"[^\x00-\x7f{LETTERS}]|\+A|\?|[{{|}}\[\]\\]", t) and re.search(f"[{LETTERS}]", t)]
    rng = random.Random(5)
    rng.shuffle(clean)
    rows, want, kinds = [(f"c{i}", t, None) for i, t in enumerate(clean[120:])], {}, {}
    for i, t in enumerate(clean[:120]):  # these texts occur only garbled
        bad, kinds[f"g{i}"] = damaged(t, rng, i)
        rows.append((f"g{i}", bad, None))
        want[f"g{i}"] = t
    got = {r["ref"]: r["tekst"] for r in restored(spark.createDataFrame(rows, "ref string, tekst string, citat string"), "ref", ["tekst", "citat"]).collect()}
    changed = {k for k, t, _ in rows if k in want and t != want[k]}
    assert not {k for k in got if k not in want}
    right, of = {}, {}
    for k in changed:
        of[kinds[k]] = of.get(kinds[k], 0) + 1
        right[kinds[k]] = right.get(kinds[k], 0) + (got.get(k) == want[k])
    print({k: f"{right[k]}/{n}" for k, n in of.items()}, len(changed & set(got)) / len(changed))
    words = [(a, b) for k in changed for a, b in zip(want[k].split(), got.get(k, "").split() if len(got.get(k, "").split()) == len(want[k].split()) else [""] * len(want[k].split()))]
    for k in sorted(changed):
        if got.get(k) != want[k]:
            print(kinds[k], [(a, b, c) for a, b, c in zip(dict((x, y) for x, y, _ in rows)[k].split(), (got.get(k) or "").split(), want[k].split()) if b != c][:4])
    print("words", sum(a == b for a, b in words) / len(words))
    assert len(changed & set(got)) >= 0.97 * len(changed)
    certain = [k for k in changed if kinds[k] in ("channel", "part", "two channels")]
    assert sum(got.get(k) == want[k] for k in certain) >= 0.95 * len(certain)
    assert sum(right.values()) >= 0.9 * len(changed)
