"""Names of rules over time: free names, names carried over by shared decisions, and where former names lead."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import written
from .order import global_rank


def unique_slugs(names: DataFrame, taken: DataFrame) -> DataFrame:
    """(key, slug): the first free of base, base-2, base-3 and so on for each of ``names`` (key, base, turn), in the order of ``turn``; none of ``taken`` (slug) is given.

    Names of one base are numbered by their place among them, past the numbers that are taken. Should a base with a number be a base of its own, the
    name whose turn is first keeps what both would have, and for the other's base that number is taken, until no two are alike. No base is gathered in one task but the
    list of its taken numbers.
    """
    ranked = global_rank(names.select("key", "base", "turn"), ["base", "turn", "key"], "_g")
    first = ranked.groupBy("base").agg(F.min("_g").alias("_f"))
    placed = written(ranked.join(first, "base").select("key", "base", "turn", (F.col("_g") - F.col("_f") + 1).alias("_k")), "names")
    bases = placed.select("base").distinct()
    # a taken name is number 1 of the base that it is, and number n of the base before its -n
    number = F.expr("try_cast(regexp_extract(slug, '-([1-9][0-9]*)$', 1) as bigint)")
    own = taken.select(F.col("slug").alias("base"), F.lit(1).cast("bigint").alias("n"))
    barred = own.unionByName(taken.select(F.regexp_replace("slug", "-[0-9]+$", "").alias("base"), number.alias("n")).where("n >= 2"))
    barred = written(barred.join(bases, "base", "left_semi").distinct(), "taken")
    while True:
        gone = barred.groupBy("base").agg(F.array_sort(F.collect_set("n")).alias("_t"))
        # the k-th free number is k and the taken ones before it
        n = F.col("_k") + F.coalesce(F.size(F.expr("filter(transform(_t, (x, i) -> x - i - 1), y -> y < _k)")), F.lit(0))
        given = placed.join(gone, "base", "left").select("key", "base", "turn", n.alias("n"))
        given = written(given.withColumn("slug", F.when(F.col("n") == 1, F.col("base")).otherwise(F.concat_ws("-", "base", F.col("n").cast("string")))), "slugs")
        twice = given.groupBy("slug").agg(F.count("*").alias("c"), F.min(F.struct("turn", "key")).alias("x")).where("c > 1")
        lost = given.join(twice, "slug").where(F.col("key") != F.col("x.key")).select("base", "n").distinct()
        if lost.isEmpty():
            return given.select("key", "slug")
        barred = written(barred.unionByName(lost), "taken")


def carried(previous: DataFrame, new: DataFrame, former: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Names carried from rules to the rules that follow them, by shared decisions.

    ``previous`` (slug, ref), ``new`` (name, ref) and ``former`` (slug, ref) hold the decisions of each. A previous slug goes to the new rule with
    most of its decisions, the first by name on a tie; of several on one rule the one with the largest share is inherited (then the first) and the others
    become its aliases; one with no decision left is orphaned. A new rule without a slug takes up the former slug of whose decisions it holds more
    than half, the one sharing most, then the first. Returns (name, slug, how) of the new rules, ``slug`` null where a new one is to be minted, and
    (slug, fate, to) of the previous ones.
    """
    shared = previous.distinct().join(new.distinct(), "ref").groupBy("slug", "name").agg(F.count("*").alias("n"))
    claim = shared.groupBy("slug").agg(F.min(F.struct((-F.col("n")).alias("m"), "name")).alias("x")).select("slug", "x.name", F.col("x.m").alias("m"))
    heir = claim.groupBy("name").agg(F.min(F.struct("m", "slug")).alias("x")).select("name", F.col("x.slug").alias("heir"))
    fate = previous.select("slug").distinct().join(claim, "slug", "left").join(heir, "name", "left")
    how = F.when(F.col("heir").isNull(), "orphaned").when(F.col("heir") == F.col("slug"), "inherited").otherwise("alias")
    fates = fate.select("slug", how.alias("fate"), F.when(F.col("heir") != F.col("slug"), F.col("heir")).alias("to"))
    whole = former.distinct().groupBy("slug").agg(F.count("*").alias("all"))
    again = former.distinct().join(new.distinct(), "ref").groupBy("slug", "name").agg(F.count("*").alias("n")).join(whole, "slug").where("2 * n > all")
    revived = again.groupBy("name").agg(F.min(F.struct((-F.col("n")).alias("m"), "slug")).alias("x")).select("name", F.col("x.slug").alias("again"))
    every = new.select("name").distinct().join(heir, "name", "left").join(revived, "name", "left")
    kind = F.when(F.col("heir").isNotNull(), "inherited").when(F.col("again").isNotNull(), "revived").otherwise("minted")
    return every.select("name", F.coalesce("heir", "again").alias("slug"), kind.alias("how")), fates


def successors(former: DataFrame, refs: DataFrame, live: DataFrame, held: DataFrame, living: DataFrame) -> DataFrame:
    """(slug, successor, reason): where each former slug's links lead now.

    The live rule that holds most of its decisions; else its present target, while that is live and none of its decisions exists any more; else the only live rule
    of its category with its title; else nowhere. ``former`` has slug, category, name, ``to``; ``refs`` (slug, ref) its decisions; ``live`` has slug,
    category, name; ``held`` (slug, ref) the live rules' decisions; ``living`` (ref) what exists.
    """
    shared = refs.distinct().join(held.distinct().withColumnRenamed("slug", "rule"), "ref").groupBy("slug", "rule").agg(F.count("*").alias("n"))
    holder = shared.groupBy("slug").agg(F.min(F.struct((-F.col("n")).alias("m"), "rule")).alias("x")).select("slug", F.col("x.rule").alias("holder"))
    exists = refs.join(living, "ref", "left_semi").select("slug").distinct().withColumn("exists", F.lit(True))
    names = live.groupBy("category", "name").agg(F.count("*").alias("c"), F.min("slug").alias("namesake")).where("c = 1").drop("c")
    there = live.select(F.col("slug").alias("to"), F.lit(True).alias("there")).distinct()
    j = former.join(holder, "slug", "left").join(exists, "slug", "left").join(names, ["category", "name"], "left").join(there, "to", "left")
    keeps = F.col("there").isNotNull() & F.col("exists").isNull()
    reason = F.when(F.col("holder").isNotNull(), "holder").when(keeps, "kept").when(F.col("namesake").isNotNull(), "namesake").otherwise("retired")
    return j.select("slug", F.coalesce("holder", F.when(keeps, F.col("to")), "namesake").alias("successor"), reason.alias("reason"))
