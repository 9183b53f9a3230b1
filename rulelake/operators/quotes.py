"""Quotes and spans: verbatim passages located in texts by trigram votes, overlaps, one-to-one matching."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import words
from ..sources.tables import written

#: The share of trigrams that must line up, and the words before and after a start whose votes count for it.
THRESHOLD, SLACK, GAP = 0.8, 2, 8


def grams(ws, k: int):
    """The runs of ``k`` words of an array of words, in order; empty for fewer. The array is not evaluated once a run."""
    n = F.greatest(F.size(ws) - (k - 1), F.lit(0))
    out = F.slice(ws, 1, n)
    for i in range(2, k + 1):
        out = F.zip_with(out, F.slice(ws, i, n), lambda a, b: F.concat_ws(" ", a, b))
    return out


def trigrams(ws):
    return grams(ws, 3)


def votes_of(quote: list, ws: list, at: int = 0) -> dict[int, set[int]]:
    """The starts that the trigrams of a quote imply by their places among words, the first of which is word ``at``: start -> trigrams, by their place in the quote."""
    places, votes = defaultdict(list), defaultdict(set)
    for j in range(len(quote) - 2):
        places[tuple(quote[j : j + 3])].append(j)
    for i in range(len(ws) - 2):
        for j in places.get((ws[i], ws[i + 1], ws[i + 2]), ()):
            votes[at + i - j].add(j)
    return votes


def pooled(votes: dict[int, set[int]], anchor: int, used: set = frozenset()) -> dict[int, int]:
    """The trigrams that vote near an anchor, from ``SLACK`` before to ``GAP`` after, each with the nearest of its starts; (start, trigram) pairs that are used do not count."""
    near: dict[int, int] = {}
    for s in sorted(range(anchor - SLACK, anchor + GAP + 1), key=lambda s: (abs(s - anchor), s)):
        for j in votes.get(s, ()):
            if (s, j) not in used:
                near.setdefault(j, s)
    return near


def best_start(quote: list, ws: list) -> tuple[float, int] | None:
    """How much of a quote lines up among words, and the word at which it starts; None where nothing does."""
    if len(quote) < 3:
        at = next((i for i in range(len(ws) - len(quote) + 1) if ws[i : i + len(quote)] == quote), None) if quote else None
        return None if at is None else (1.0, at)
    votes = votes_of(quote, ws)
    if not votes:
        return None
    _, _, anchor = max((len(pooled(votes, a)), len(votes[a]), -a) for a in votes)
    near = pooled(votes, -anchor)
    return len(near) / (len(quote) - 2), max(near[min(near)], 0)


def located(df: DataFrame, key: str, quote: str, text: str) -> DataFrame:
    """(key, share, start): how much of a quote lines up in the text of its row, and the word at which it starts; absent where nothing does.

    Each trigram of the quote votes for the start that its place in the text implies; votes near an anchor, from ``SLACK`` before to ``GAP``
    after, are pooled, each trigram once. The best anchor has the most pooled votes, then the most of its own, then is
    earliest. A quote of one or two words is found verbatim only, with share 1. Quote and text stand in one row, so nothing is shuffled.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            at, share, start = [], [], []
            for i, (q, t) in enumerate(zip(b.column("_q").to_pylist(), b.column("_t").to_pylist())):
                found = best_start(q, t)
                if found:
                    at.append(i), share.append(found[0]), start.append(found[1])
            yield pa.RecordBatch.from_arrays([b.column(key).take(pa.array(at, pa.int64())), pa.array(share, pa.float64()), pa.array(start, pa.int32())], [key, "share", "start"])

    return df.select(key, words(quote).alias("_q"), words(text).alias("_t")).mapInArrow(run, f"`{key}` {kind}, share double, start int")


def overlap(a0, a1, b0, b1):
    """Shared part of two half-open spans over the shorter one."""
    return F.greatest(F.least(a1, b1) - F.greatest(a0, b0), F.lit(0)) / F.least(a1 - a0, b1 - b0)


def jaccard(shared, a, b):
    """Shared elements over all, 0 where there are none."""
    return F.when(a + b - shared > 0, shared / (a + b - shared)).otherwise(F.lit(0.0))


def one_to_one(scored: DataFrame, old: str, new: str, score: str, *, by: Sequence[str] = ()) -> DataFrame:
    """Greedy one-to-one pairs within ``by``, best score first, ties to the lesser old and then the lesser new.

    Sides with the same partners at the same scores are one class. A round takes every pair of classes that is the best of both its
    sides, which gives the greedy result, and of such classes the members rank by rank, as far as no other class tied with them has a
    lesser member. Rounds go on until no pair is left, so they do not grow with copies, but with chains of falling scores.
    """
    by = list(by)
    edges = scored.groupBy(*by, F.col(old).alias("_o"), F.col(new).alias("_w")).agg(F.max(score).alias("_s")).where("_s is not null")
    edges = written(edges, "pairs")

    def classes(side: str, other: str, c: str, i: str) -> DataFrame:
        prints = [F.bit_xor(F.xxhash64(other, "_s", F.lit(k))).cast("string") for k in (1, 2)]
        known = edges.groupBy(*by, side).agg(F.concat_ws(" ", F.count("*").cast("string"), *prints).alias(c))
        return written(known.withColumn(i, F.row_number().over(Window.partitionBy(*by, c).orderBy(side))), "members")

    olds, news = classes("_o", "_w", "_a", "_i"), classes("_w", "_o", "_b", "_j")
    left = edges.join(olds.drop("_i"), [*by, "_o"]).join(news.drop("_j"), [*by, "_w"]).select(*by, "_a", "_b", "_s").distinct()
    taken, rounds = None, 0
    while True:
        first_old = olds.groupBy(*by, "_a").agg(F.min("_o").alias("_fo"), F.min("_i").alias("_fi"))
        first_new = news.groupBy(*by, "_b").agg(F.min("_w").alias("_fw"), F.min("_j").alias("_fj"))
        left = written(left.select(*by, "_a", "_b", "_s").join(first_old, [*by, "_a"]).join(first_new, [*by, "_b"]), "pairs")
        of_old, of_new = Window.partitionBy(*by, "_a").orderBy(F.desc("_s"), "_fw"), Window.partitionBy(*by, "_b").orderBy(F.desc("_s"), "_fo")
        best = left.withColumn("_ra", F.row_number().over(of_old)).withColumn("_xa", F.lead(F.struct("_s", "_fw")).over(of_old))
        best = best.withColumn("_rb", F.row_number().over(of_new)).withColumn("_xb", F.lead(F.struct("_s", "_fo")).over(of_new)).where("_ra = 1 and _rb = 1")
        pairs = best.join(olds, [*by, "_a"]).withColumn("_j", F.col("_i") - F.col("_fi") + F.col("_fj")).join(news, [*by, "_b", "_j"])
        free = [F.coalesce((F.col(f"{x}._s") < F.col("_s")) | (F.col(m) < F.col(f"{x}.{f}")), F.lit(True)) for x, m, f in (("_xa", "_w", "_fw"), ("_xb", "_o", "_fo"))]
        pick = written(pairs.where(free[0] & free[1]).select(*by, F.col("_o").alias(old), F.col("_w").alias(new), F.col("_s").alias(score)), "picked")
        if pick.isEmpty():
            break
        taken, rounds = pick if taken is None else taken.unionByName(pick), rounds + 1
        if rounds % 20 == 0:
            taken = written(taken, "picked")
        olds = written(olds.join(pick.select(*by, F.col(old).alias("_o")), [*by, "_o"], "left_anti"), "members")
        news = written(news.join(pick.select(*by, F.col(new).alias("_w")), [*by, "_w"], "left_anti"), "members")
    return taken if taken is not None else scored.select(*by, old, new, F.col(score)).limit(0)
