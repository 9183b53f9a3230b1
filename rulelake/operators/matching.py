"""Decisions matched one to one by where their quotes stand and what they say."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import words
from ..sources.tables import merged, written
from .quotes import jaccard, overlap, trigrams

#: The least score of a match, and the least similarity of texts of which both quotes were located but do not overlap.
LEAST, LOCATED_APART = 0.25, 0.5
#: Words of a document in which spans are looked for together.
REACH = 512


def scored(old: DataFrame, new: DataFrame) -> DataFrame:
    """(doc, old, new, score): the pairs of a document that may match, with a score of at least ``LEAST``.

    Both sides have doc, key, outcome, a, b (the words of the document between which the quote stands, null if it was not located) and text. Where quotes
    overlap the score is the share of the shorter one in common plus the share of word trigrams in common; else the trigrams alone, and then the outcomes must agree, and with both quotes
    located at least half of the trigrams.

    Pairs meet where their spans share a stretch of the document, and on the rarer trigrams of their texts: a similarity of ``LEAST`` needs one of the rarest three
    quarters, so the most common ones of a document, which would bring all its decisions together, are left out without loss.
    """
    sides = []
    for df, n in ((old, "o"), (new, "n")):
        g = df.select("doc", F.col("key").alias(n), F.col("outcome").alias(f"u{n}"), F.col("a").alias(f"a{n}"), F.col("b").alias(f"b{n}"), F.transform(F.array_distinct(trigrams(words("text"))), lambda x: F.xxhash64(x)).alias(f"g{n}"))
        sides.append(written(g.where(F.col("doc").isNotNull() & F.col(n).isNotNull()).dropDuplicates(["doc", n]), "sides"))
    o, n = sides
    spans = [s.where(f"b{x} > a{x}").select("doc", x, F.explode(F.sequence(F.floor(F.col(f"a{x}") / REACH), F.floor((F.col(f"b{x}") - 1) / REACH))).alias("at"), f"a{x}", f"b{x}") for s, x in ((o, "o"), (n, "n"))]
    met = spans[0].join(spans[1], ["doc", "at"]).where("ao < bn and an < bo").select("doc", "o", "n")
    each = [s.select("doc", x, F.size(f"g{x}").alias("k"), F.explode(f"g{x}").alias("gram")) for s, x in ((o, "o"), (n, "n"))]
    often = each[0].select("doc", "gram").unionByName(each[1].select("doc", "gram")).groupBy("doc", "gram").agg(F.count("*").alias("f"))
    rare = []
    for e, x in zip(each, ("o", "n")):
        order = Window.partitionBy("doc", x).orderBy("f", "gram")
        rare.append(e.join(often, ["doc", "gram"]).withColumn("i", F.row_number().over(order)).where(F.col("i") <= F.col("k") - F.ceil(F.col("k") * LEAST) + 1).select("doc", x, "gram"))
    alike = rare[0].join(rare[1], ["doc", "gram"]).select("doc", "o", "n")
    pairs = met.unionByName(alike).distinct().join(o, ["doc", "o"]).join(n, ["doc", "n"])
    text = jaccard(F.size(F.array_intersect("go", "gn")), F.size("go"), F.size("gn"))
    both = F.col("ao").isNotNull() & F.col("an").isNotNull() & (F.col("bo") > F.col("ao")) & (F.col("bn") > F.col("an"))
    quote = F.when(both, overlap(F.col("ao"), F.col("bo"), F.col("an"), F.col("bn"))).otherwise(0.0)
    apart = ~F.col("uo").eqNullSafe(F.col("un")) | (both & (F.col("_t") < LOCATED_APART))
    s = pairs.withColumn("_t", text).withColumn("_q", quote).withColumn("score", F.when(F.col("_q") > 0, F.col("_q") + F.col("_t")).when(apart, 0.0).otherwise(F.col("_t")))
    return s.where(F.col("score") >= LEAST).select("doc", F.col("o").alias("old"), F.col("n").alias("new"), "score")


def covered(outer: DataFrame, inner: DataFrame, least: float = 0.5) -> DataFrame:
    """(doc, outer, inner, share): the spans of a document of which more than ``least`` lies in another; both sides have doc, key, a and b."""
    sides = [df.where("b > a").select("doc", F.col("key").alias(x), F.col("a").alias(f"a{x}"), F.col("b").alias(f"b{x}"), F.explode(F.sequence(F.floor(F.col("a") / REACH), F.floor((F.col("b") - 1) / REACH))).alias("at")) for df, x in ((outer, "outer"), (inner, "inner"))]
    met = sides[0].join(merged(sides[1]), ["doc", "at"]).where("aouter < binner and ainner < bouter").drop("at").distinct()
    share = (F.least("bouter", "binner") - F.greatest("aouter", "ainner")) / (F.col("binner") - F.col("ainner"))
    return met.select("doc", "outer", "inner", share.alias("share")).where(F.col("share") > least)


def scores_by_document(probes: DataFrame, matches: DataFrame, run: DataFrame, fields: list[str], firm: list[str]) -> DataFrame:
    """How a run's decisions do against an answer key, a row a document.

    ``probes`` (doc, probe, item, role, fields of the item) are the wordings that stand for the items of the key, which are decisions, rejects or to be ignored; ``matches`` (doc, old, new,
    score) pair probes with decisions of ``run`` (doc, key, fields) one to one. An item matched by several decisions is found once, by the best match, then the first; the others are
    over-split. Counted are key decisions, found, false (matched rejects), extra, split, ignored, decisions that match nothing, and for found ones the fields that are right, all fields, and the firm ones.
    """
    of = probes.select("doc", F.col("probe").alias("old"), "item", "role", *[F.col(f).alias(f"k_{f}") for f in fields])
    hits = matches.join(of, ["doc", "old"]).join(run.select("doc", F.col("key").alias("new"), *fields), ["doc", "new"])
    best = F.min(F.struct((-F.col("score")).alias("m"), "new", *fields)).alias("x")
    items = hits.groupBy("doc", "item", "role").agg(F.count("*").alias("n"), best, *[F.first(f"k_{f}").alias(f"k_{f}") for f in fields])
    right = {f: F.col(f"x.{f}").eqNullSafe(F.col(f"k_{f}")) for f in fields}

    def every(names):
        out = F.lit(True)
        for f in names:
            out = out & right[f]
        return out

    key = F.col("role") == "decision"
    counts = items.groupBy("doc").agg(
        F.count_if(key).alias("found"),
        F.coalesce(F.sum(F.when(F.col("role") == "reject", F.col("n"))), F.lit(0)).alias("false_found"),
        F.coalesce(F.sum(F.when(key, F.col("n") - 1)), F.lit(0)).alias("extra"),
        F.count_if(key & (F.col("n") > 1)).alias("split"),
        F.coalesce(F.sum(F.when(F.col("role") == "ignored", F.col("n"))), F.lit(0)).alias("ignored"),
        *[F.count_if(key & right[f]).alias(f"right_{f}") for f in fields],
        F.count_if(key & every(fields)).alias("right_all"),
        F.count_if(key & every(firm)).alias("right_firm"),
    )
    wanted = probes.where("role = 'decision'").groupBy("doc").agg(F.count_distinct("item").alias("key_decisions"))
    given = run.groupBy("doc").agg(F.count("*").alias("given")).join(matches.groupBy("doc").agg(F.count("*").alias("matched")), "doc", "left")
    j = wanted.join(given, "doc", "full").join(counts, "doc", "left")
    names = ["found", "false_found", "extra", "split", "ignored", *[f"right_{f}" for f in fields], "right_all", "right_firm"]
    return j.select("doc", F.coalesce("key_decisions", F.lit(0)).alias("key_decisions"), *[F.coalesce(c, F.lit(0)).alias(c) for c in names], (F.coalesce("given", F.lit(0)) - F.coalesce("matched", F.lit(0))).alias("unjudged"))
