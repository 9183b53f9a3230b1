"""Encoding against the tokenizer itself, on whole texts and on chunks of any size."""

import random

import pytest

from rulelake.llm.encoding import decoded, encoded, encoder, token_counts

SCHEMA = "doc_id long, text string, ids string, i int, n int"
rng = random.Random(2)
WORDS = ["rekord", " ", "  ", "\n", "\n\n", "\r\n", "\t", "ø", "Ægte", "123", "4567", "...", "!?", "'s", "don't", "🏋️", "<|endoftext|>", "会", "\xa0", "é"]
TEXTS = ["", None, " ", "\n\n \t", "<|endoftext|>", "a" * 3000, " " * 2500, "x " * 2000, "ab" * 1500 + " " + "cd" * 900, "".join(rng.choice(WORDS) for _ in range(4000))]
TEXTS += ["".join(rng.choice(WORDS) for _ in range(rng.randint(0, 900))) for _ in range(12)]


@pytest.mark.parametrize("chunk, overlap", [(16_384, 1_024), (200, 40), (64, 64)])
def test_ids(spark, chunk, overlap):
    df = spark.createDataFrame([(i, t, "clash", 1, 2) for i, t in enumerate(TEXTS)], SCHEMA)
    want = {i: encoder().encode_ordinary(t or "") for i, t in enumerate(TEXTS)}
    got = encoded(df, chunk=chunk, overlap=overlap)
    assert {r["doc_id"]: list(r["ids"]) for r in got.collect()} == want
    assert {r["doc_id"]: r["n"] for r in token_counts(df, chunk=chunk, overlap=overlap).collect()} == {i: len(x) for i, x in want.items()}
    if chunk == 200:
        assert {r["doc_id"]: r["text"] for r in decoded(got).collect()} == {i: t or "" for i, t in enumerate(TEXTS)}


def test_nothing_and_null_keys(spark):
    assert encoded(spark.createDataFrame([], SCHEMA)).count() == 0
    got = encoded(spark.createDataFrame([(None, "a b", None, 1, 1), (None, "a b", None, 1, 1)], SCHEMA)).collect()
    assert [list(r["ids"]) for r in got] == [encoder().encode_ordinary("a b")] * 2


def test_the_longest_documents_in_chunks(spark):
    import os

    path = "/root/testdata/sf0.01/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("no test tables")
    df = spark.read.parquet(path).where("length(text) > 1500").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    assert max(map(len, texts.values())) > 10 * 1_024
    got = {r["doc_id"]: list(r["ids"]) for r in encoded(df, chunk=1_024, overlap=128).collect()}
    assert got == {k: encoder().encode_ordinary(t) for k, t in texts.items()}


def test_a_word_longer_than_chunks_is_one_piece(spark):
    from rulelake.llm.encoding import _encode_long

    text = "en to " * 100 + "x" * 1000 + " tre" * 100 + "\u0301" * 700 + "9" * 300 + "a's " * 90
    pieces = _encode_long(spark.createDataFrame([(1, text)], "doc_id long, text string"), "doc_id", "text", "/opt/tokenizers", 100, 20).orderBy("i").collect()
    assert len(pieces) > 10
    assert [t for p in pieces for t in p["ids"]] == encoder().encode_ordinary(text)
