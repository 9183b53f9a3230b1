"""Encoding of a corpus with a public byte-level BPE tokenizer: overlapping chunks, stitched where boundaries agree.

A text of at most ``CHUNK`` characters is encoded as it is. A longer one is cut into chunks that overlap, which are pre-tokenised
in parallel, each from its own start. Boundaries between pre-tokens count where they are true whatever comes before: in front of white space, and between a letter
and a digit or a letter or digit and a sign, as no pre-token holds these. The chunks are cut at the first such boundary that two neighbours
both have in their overlap, and their pieces encoded in parallel. Where two chunks have none in common, as within one word longer than the overlap, they are
not cut, and their piece goes on to the next joint that has one: what one task encodes is bounded by the longest pre-token, which
no tokenizer can split, and two chunks.
"""

from __future__ import annotations

import base64
import os
import sys

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import cut, written

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Fixed value: the pattern by which the vocabulary's merges are split.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters of a chunk, and those that it shares with the next.
CHUNK, OVERLAP = 16_384, 1_024


def _ranks(directory: str) -> dict[bytes, int]:
    with open(os.path.join(directory, VOCABULARY), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def encoder(directory: str = TOKENIZERS):
    """The tokenizer of ``directory``; loaded once a worker."""
    kept = sys.__dict__.setdefault("_rulelake_encoders", {})
    if directory not in kept:
        import tiktoken

        kept[directory] = tiktoken.Encoding("byte_bpe_50k", pat_str=PATTERN, mergeable_ranks=_ranks(directory), special_tokens={})
    return kept[directory]


def _lists(rows: list[list[int]]) -> pa.Array:
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    flat = np.fromiter((i for r in rows for i in r), np.int32, int(offsets[-1]))
    return pa.ListArray.from_arrays(offsets, flat)


def _encode_batches(text: str, keep: list[str], count: bool, directory: str):
    def run(batches):
        encode = encoder(directory).encode_ordinary
        for b in batches:
            ids = [encode(t) if t else [] for t in b.column(text).to_pylist()]
            out = pa.array([len(i) for i in ids], pa.int32()) if count else _lists(ids)
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in keep], out], [*keep, "n" if count else "ids"])

    return run


def _schema(df: DataFrame, keep: list[str], last: str) -> str:
    return ", ".join([*[f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keep], last])


def _chunks(df: DataFrame, key: str, text: str, chunk: int, overlap: int) -> DataFrame:
    """Rows of (key, i, last, text): chunk ``i`` has the characters from ``i * chunk`` on and ``overlap`` of the next."""

    def run(batches):
        for b in batches:
            for k, t in zip(b.column(key), b.column(text).to_pylist()):
                n = -(-len(t) // chunk)
                for i in range(n):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k.as_py()], b.schema.field(key).type), pa.array([i], pa.int32()), pa.array([i == n - 1]), pa.array([t[i * chunk : (i + 1) * chunk + overlap]])],
                        [key, "i", "last", text],
                    )

    return df.select(key, text).mapInArrow(run, _schema(df, [key], f"i int, last boolean, `{text}` string"))


#: Where no pre-token can reach across, whatever comes before.
TRUE = r"(?<=[^\s\x1c-\x1f])(?=[ \n\r\t])|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})|(?<=[\p{L}\p{N}])(?=[^\s\p{L}\p{N}\x1c-\x1f])"


def _boundaries(chunks: DataFrame, key: str, text: str, chunk: int, overlap: int) -> DataFrame:
    """Rows of (key, at, head, tail): boundaries near the joint ``at``, counted from it, as the chunk after and before it has them."""

    def run(batches):
        split, true = regex.compile(PATTERN), regex.compile(TRUE)
        for b in batches:
            keys, ats, heads, tails = [], [], [], []
            for k, i, last, t in zip(*[b.column(c).to_pylist() for c in (key, "i", "last", text)]):
                starts = [m.start() for m in split.finditer(t) if m.start() and true.match(t, m.start())]
                if i:
                    keys.append(k), ats.append(i), heads.append([s for s in starts if s < overlap]), tails.append(None)
                if not last:
                    keys.append(k), ats.append(i + 1), heads.append(None), tails.append([s - chunk for s in starts if chunk <= s < chunk + overlap - 4])  # the end of the chunk may cut a contraction
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(keys, b.schema.field(key).type), pa.array(ats, pa.int32()), pa.array(heads, kind), pa.array(tails, kind)], [key, "at", "head", "tail"])

    return chunks.mapInArrow(run, _schema(chunks, [key], "at int, head array<int>, tail array<int>"))


def _encode_long(df: DataFrame, key: str, text: str, directory: str, chunk: int, overlap: int) -> DataFrame:
    """(key, i, ids): the pieces of long texts in order."""
    chunks = written(_chunks(df, key, text, chunk, overlap).repartition(key, "i"), "chunks")  # of long texts only; read twice
    near = _boundaries(chunks, key, text, chunk, overlap).groupBy(key, "at").agg(F.first("head", True).alias("head"), F.first("tail", True).alias("tail"))
    cuts = near.select(key, F.col("at").alias("i"), F.array_min(F.array_intersect("head", "tail")).alias("start"))
    cuts = cut(cuts)  # small: a number a chunk; used twice
    ends = cuts.select(key, (F.col("i") - 1).alias("i"), F.coalesce(F.col("start"), F.lit(0)).alias("end"), F.col("start").isNull().alias("goes_on"))
    own = F.expr(f"substring(`{text}`, coalesce(start, 0) + 1, coalesce(end + {chunk}, length(`{text}`)) - coalesce(start, 0))")
    pieces = chunks.join(cuts, [key, "i"], "left").join(ends, [key, "i"], "left").select(key, "i", "goes_on", ((F.col("i") > 0) & F.col("start").isNull()).alias("follows"), own.alias(text))
    torn = F.col("follows") | F.coalesce(F.col("goes_on"), F.lit(False))
    # the few pieces with a joint that has no cut are put together again, up to the next that has one
    first = F.max(F.when(~F.col("follows"), F.col("i"))).over(Window.partitionBy(key).orderBy("i"))
    joined = pieces.where(torn).withColumn("_f", first).groupBy(key, "_f").agg(F.array_join(F.expr(f"transform(array_sort(collect_list(struct(i, `{text}` as t))), x -> x.t)"), "").alias(text))
    both = pieces.where(~torn).select(key, "i", text).unionByName(joined.select(key, F.col("_f").alias("i"), text))
    return both.mapInArrow(_encode_batches(text, [key, "i"], False, directory), _schema(both, [key, "i"], "ids array<int>"))


def encoded(df: DataFrame, key: str = "doc_id", text: str = "text", *, directory: str = TOKENIZERS, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(key, ids): the token ids of every text, without special tokens; text that looks like one is plain text.

    An empty list for an empty or null text. ``key`` must be unique; rows with a null key are kept as they are, and a long text without a key is
    encoded in one task. Other columns are ignored.
    """
    rows = df.select(key, text)
    short = rows.where(F.col(text).isNull() | (F.length(text) <= chunk) | F.col(key).isNull())
    whole = short.mapInArrow(_encode_batches(text, [key], False, directory), _schema(rows, [key], "ids array<int>"))
    long = rows.where((F.length(text) > chunk) & F.col(key).isNotNull())
    joined = _encode_long(long, key, text, directory, chunk, overlap).groupBy(key).agg(F.expr("flatten(transform(array_sort(collect_list(struct(i, ids))), x -> x.ids))").alias("ids"))
    return whole.unionByName(joined)


def token_counts(df: DataFrame, key: str = "doc_id", text: str = "text", *, directory: str = TOKENIZERS, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(key, n): the number of tokens of every text, by the same way as ``encoded``; 0 for an empty or null text."""
    rows = df.select(key, text)
    short = rows.where(F.col(text).isNull() | (F.length(text) <= chunk) | F.col(key).isNull())
    whole = short.mapInArrow(_encode_batches(text, [key], True, directory), _schema(rows, [key], "n int"))
    long = rows.where((F.length(text) > chunk) & F.col(key).isNotNull())
    joined = _encode_long(long, key, text, directory, chunk, overlap).groupBy(key).agg(F.sum(F.size("ids")).cast("int").alias("n"))
    return whole.unionByName(joined)


def decoded(df: DataFrame, ids: str = "ids", text: str = "text", *, directory: str = TOKENIZERS) -> DataFrame:
    """``df`` with the text of the ids: the raw bytes of the tokens one after the other. An empty text for an empty list, null for null."""
    keep = [c for c in df.columns if c != ids]

    def run(batches):
        by_id = {i: b for b, i in _ranks(directory).items()}
        for b in batches:
            texts = [None if r is None else b"".join(map(by_id.__getitem__, r)).decode("utf-8", "replace") for r in b.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in keep], pa.array(texts, pa.string())], [*keep, text])

    return df.select(*keep, ids).mapInArrow(run, _schema(df, keep, f"`{text}` string"))
