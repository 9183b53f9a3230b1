"""Ranking by term weights: sublinear TF-IDF cosine and BM25, as equi-joins on terms."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import written

#: Queries that are compared with all rows at a time, and rows of a batch compared at a time.
BLOCK, ROWS = 500, 512


def term_counts(df: DataFrame, key: str, words: str) -> DataFrame:
    """(key, term, tf)."""
    return df.select(key, F.explode(words).alias("term")).groupBy(key, "term").agg(F.count("*").alias("tf"))


def idf(counts: DataFrame, total: int) -> DataFrame:
    """(term, idf): smoothed, ln((n + 1) / (df + 1)) + 1."""
    return counts.groupBy("term").agg(F.count("*").alias("df")).select("term", (F.log((F.lit(total) + 1) / (F.col("df") + 1)) + 1).alias("idf"))


def unit_vectors(counts: DataFrame, weights: DataFrame, key: str) -> DataFrame:
    """(key, term, w): (1 + ln tf) * idf, of length 1 per key; terms without an idf do not count."""
    raw = counts.join(weights, "term").select(key, "term", ((1 + F.log("tf")) * F.col("idf")).alias("raw"))
    norm = raw.groupBy(key).agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm")).where("norm > 0")
    return raw.join(norm, key).select(key, "term", (F.col("raw") / F.col("norm")).alias("w"))


def cosine(queries: DataFrame, vectors: DataFrame, query_key: str, key: str) -> DataFrame:
    """(query_key, key, score) of the pairs that share a term."""
    q = queries.select(query_key, "term", F.col("w").alias("_q"))
    return q.join(vectors.select(key, "term", "w"), "term").groupBy(query_key, key).agg(F.sum(F.col("_q") * F.col("w")).alias("score"))


def top(scored: DataFrame, by: str, score: str, tie: str, k: int) -> DataFrame:
    """The k best of each group with their rank, ties by ``tie``."""
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(F.desc(score), tie))).where(F.col("rank") <= k)


def bm25(counts: DataFrame, lengths: DataFrame, queries: DataFrame, key: str, query_key: str, *, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """(query_key, key, score): BM25 of query terms (query_key, term, weight), summed over terms; the terms asked for are few and broadcast."""
    whole = F.broadcast(lengths.agg(F.count("*").alias("_all"), F.coalesce(F.avg("length"), F.lit(1.0)).alias("_mean")))  # one row
    hit = counts.join(F.broadcast(queries), "term")
    df = hit.select(key, "term").distinct().groupBy("term").agg(F.count("*").alias("df"))
    weight = F.log(1 + (F.col("_all") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = F.col("weight") * weight * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("length") / F.col("_mean")))
    return hit.join(df, "term").join(lengths, key).crossJoin(whole).groupBy(query_key, key).agg(F.sum(part).alias("score"))


def packed_vectors(keys: DataFrame, vectors: DataFrame, key: str) -> DataFrame:
    """``keys`` with their vectors (key, term, w) as arrays ``terms`` and ``ws``, empty for a key without terms. A vector is bounded by the terms of one text."""
    lists = vectors.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("term", "w"))).alias("v"))
    return keys.join(lists, key, "left").select(*keys.columns, F.coalesce("v.term", F.array().cast("array<string>")).alias("terms"), F.coalesce("v.w", F.array().cast("array<double>")).alias("ws"))


def block_scores(queries: DataFrame, rows: DataFrame, *, boost: float = 0.0, k: int | None = None, least: float | None = None, same: bool = False) -> DataFrame:
    """Every row against every query by the cosine of their vectors, rounded to nine digits, times 1 + ``boost`` in the query's own category.

    ``queries`` has ``query``, ``category``, ``terms``, ``ws``, ``excluded`` (an array of keys that do not take part), ``own`` (null, or the score to beat) and, with that, ``own_key``;
    ``rows`` has ``key``, ``category``, ``terms``, ``ws``. With ``k`` the result is (query, key, score) of the k best of each query, ties to the lesser key, rows that share no
    term included with score 0; with ``least`` all pairs of at least that score; with neither (query, ahead): how many rows score above
    ``own``, or the same with a lesser key than ``own_key``. With ``same`` only rows of the query's category take part. The queries are a stated set: blocks of them go to all rows in turn, as matrices, so a common term
    is no hot key and nothing is exploded.
    """
    spark = rows.sparkSession
    queries = written(queries, "queries")
    blocks = max(1, -(-queries.count() // BLOCK))
    out = None
    for b in range(blocks):
        own = queries.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == b).collect()
        at = {t: i for i, t in enumerate(sorted({t for q in own for t in q["terms"]}))}
        matrix = np.zeros((len(at), len(own)))
        for j, q in enumerate(own):
            matrix[[at[t] for t in q["terms"]], j] = q["ws"]
        shared = spark.sparkContext.broadcast((at, matrix, [(q["query"], q["category"], set(q["excluded"]), q["own"], q["own_key"] or "") for q in own]))
        part = rows.mapInArrow(_block(shared, boost, k, least, same), "query string, key string, score double")
        out = part if out is None else out.unionByName(part)
    if k is not None:
        return top(out, "query", "score", "key", k).select("query", "key", "score")
    return out if least is not None else out.groupBy("query").agg(F.sum("score").cast("bigint").alias("ahead"))


def unbeaten() -> list[Column]:
    """The columns of queries that have no score to beat."""
    return [F.lit(None).cast("double").alias("own"), F.lit(None).cast("string").alias("own_key")]


def _block(shared, boost: float, k: int | None, least: float | None, same: bool):
    def run(batches):
        at, matrix, own = shared.value
        names, category = np.array([q[0] for q in own], object), np.array([q[1] or "" for q in own], object)
        beat = np.array([np.nan if q[3] is None else q[3] for q in own])
        barred: dict[str, list[int]] = {}
        for j, q in enumerate(own):
            for x in q[2]:
                barred.setdefault(x, []).append(j)
        first = [q[4] for q in own]
        for b in batches:
            for lo in range(0, len(b) if len(own) else 0, ROWS):
                piece = b.slice(lo, ROWS)
                order = np.argsort(np.array(piece.column("key").to_pylist(), object), kind="stable")
                keys = np.array(piece.column("key").to_pylist(), object)[order]
                cats = np.array([c or "" for c in piece.column("category").to_pylist()], object)[order]
                terms, ws = piece.column("terms").to_pylist(), piece.column("ws").to_pylist()
                left = np.zeros((len(keys), len(at)))
                for i, r in enumerate(order):
                    for t, w in zip(terms[r], ws[r]):
                        j = at.get(t)
                        if j is not None:
                            left[i, j] = w
                score = left @ matrix
                score = np.round(score * np.where(cats[:, None] == category[None, :], 1 + boost, 1.0), 9)
                if same:
                    score[cats[:, None] != category[None, :]] = -np.inf
                for i, x in enumerate(keys):
                    for j in barred.get(x, ()):
                        score[i, j] = -np.inf
                if k is not None:
                    best = np.argsort(-score, axis=0, kind="stable")[:k]
                    i, j = best.T.ravel(), np.repeat(np.arange(len(own)), len(best))
                    keep = score[i, j] > -np.inf
                    i, j = i[keep], j[keep]
                elif least is not None:
                    i, j = np.nonzero(score >= least)
                else:
                    ahead = (score > beat) | ((score == beat) & (keys[:, None] < np.array(first, object)[None, :]))
                    yield _rows(names, [""] * len(own), ahead.sum(0).astype(float))
                    continue
                yield _rows(names[j], keys[i], score[i, j])

    return run


def _rows(names, keys, scores) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(names), pa.string()), pa.array(list(keys), pa.string()), pa.array(scores, pa.float64())], ["query", "key", "score"])
