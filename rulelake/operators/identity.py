"""Identity over changes: aliases, holders, merges and splits, work queues."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import written


def resolved(aliases: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(src, target): where each alias leads in the end; null for one that runs in a circle.

    Pointers are doubled each round, so the rounds grow with the logarithm of the number of aliases. Of several targets of one alias the
    least counts.
    """
    now = written(aliases.where(F.col(src).isNotNull() & F.col(dst).isNotNull()).groupBy(F.col(src).alias("_s")).agg(F.min(dst).alias("_d")), "aliases")
    for _ in range(now.count().bit_length() + 1):
        step = now.select(F.col("_s").alias("_d"), F.col("_d").alias("_e"))
        nxt = written(now.join(step, "_d", "left").select("_s", F.coalesce("_e", "_d").alias("_d"), F.col("_e").isNotNull().alias("_m")), "aliases")
        moved = not nxt.where("_m").isEmpty()
        now = nxt.select("_s", "_d")
        if not moved:
            break
    ends = now.select(F.col("_s").alias("_d")).distinct().withColumn("_c", F.lit(True))
    return now.join(ends, "_d", "left").select(F.col("_s").alias(src), F.when(F.col("_c").isNull(), F.col("_d")).alias("target"))


def holders(members: DataFrame, group: str, holder: str) -> DataFrame:
    """(group, holder, shared): the holder that has the most of each group's members, ties to the first."""
    counts = members.groupBy(group, holder).agg(F.count("*").alias("shared"))
    return counts.groupBy(group).agg(F.min(F.struct((-F.col("shared")).alias("n"), holder)).alias("x")).select(group, F.col(f"x.{holder}").alias(holder), (-F.col("x.n")).alias("shared"))


def compared(before: DataFrame, after: DataFrame, key: str, value: str) -> DataFrame:
    """(key, kind): new, changed and retired keys between two tables with one row a key."""
    j = before.select(key, F.col(value).alias("_o"), F.lit(True).alias("_b")).join(after.select(key, F.col(value).alias("_n"), F.lit(True).alias("_a")), key, "full")
    kind = F.when(F.col("_b").isNull(), "new").when(F.col("_a").isNull(), "retired").when(~F.col("_o").eqNullSafe(F.col("_n")), "changed")
    return j.select(key, kind.alias("kind")).where("kind is not null")


def run_lengths(rows: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """(key, run, value, rows): runs of equal consecutive values."""
    w = Window.partitionBy(key).orderBy(*order)
    start = F.when(F.lag(F.struct(value)).over(w).isNull() | ~F.lag(value).over(w).eqNullSafe(F.col(value)), 1).otherwise(0)
    runs = rows.withColumn("_s", start).withColumn("run", F.sum("_s").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(key, "run", value).agg(F.count("*").alias("rows"))
