"""Orders over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import cut


def global_rank(df: DataFrame, order: list[Column | str], name: str = "turn") -> DataFrame:
    """``df`` with its place in an order over all rows, from 1: ranges are ranked in parallel and shifted by what lies before them.

    The ranges are checkpointed, as sampling them again could draw other bounds. ``order`` should be total; ties are ranked in any order.
    """
    ranges = cut(df.repartitionByRange(*order)).withColumn("_p", F.spark_partition_id())
    sizes = ranges.groupBy("_p").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_from", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")  # a row a partition
    inside = ranges.withColumn("_i", F.row_number().over(Window.partitionBy("_p").orderBy(*order)))
    return inside.join(F.broadcast(before), "_p").withColumn(name, F.col("_i") + F.col("_from")).drop("_p", "_i", "_from")


def _ranges(df: DataFrame, order: list[Column | str]) -> DataFrame:
    """``df`` checkpointed in ranges of an order, with the number ``_p`` of each row's range."""
    return cut(df.repartitionByRange(*order)).withColumn("_p", F.spark_partition_id())


def ranked_within(df: DataFrame, group: str, order: list[Column | str], name: str) -> DataFrame:
    """``df`` with its place ``name`` in its group, from 0. A group may be any part of all rows: ranges are ranked in parallel and shifted by what the ranges before hold of the group."""
    ranges = _ranges(df, [group, *order])
    sizes = ranges.groupBy(group, "_p").agg(F.count("*").alias("_n"))  # a row a range, and one a group
    before = Window.partitionBy(group).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_from", F.coalesce(F.sum("_n").over(before), F.lit(0))).where("_from > 0").select(group, "_p", "_from")
    inside = ranges.withColumn(name, F.row_number().over(Window.partitionBy("_p", group).orderBy(*order)) - 1)
    return inside.join(offsets, [group, "_p"], "left").withColumn(name, F.col(name) + F.coalesce("_from", F.lit(0))).drop("_p", "_from")


def carried_forward(df: DataFrame, group: str, order: list[Column | str], value: str, name: str) -> DataFrame:
    """``df`` with the last value that is not null up to each row of its group's order; null before the first. Ranges as in ``ranked_within``."""
    ranges = _ranges(df, [group, *order])
    upto = Window.partitionBy("_p", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inside = ranges.withColumn(name, F.last(value, True).over(upto))
    ends = ranges.where(F.col(value).isNotNull()).groupBy(group, "_p").agg(F.max_by(F.struct(value), F.struct(*order)).alias("_v"))
    starts = ranges.select(group, "_p").distinct().join(ends, [group, "_p"], "left")
    before = Window.partitionBy(group).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    carried = starts.withColumn("_c", F.last("_v", True).over(before)).where("_c is not null").select(group, "_p", F.col(f"_c.{value}").alias("_c"))
    return inside.join(carried, [group, "_p"], "left").withColumn(name, F.coalesce(name, "_c")).drop("_p", "_c")


def few(rows: DataFrame, key: str, value: str, n: int, *, last: bool = True, salts: int = 32) -> DataFrame:
    """(key, l): the ``n`` greatest, or least, values of each key, ascending. A key's rows are first reduced in salted parts, so a hot key is no hot task."""

    def most(df: DataFrame, *by: str) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(F.desc(value) if last else F.asc(value))
        return df.withColumn("_i", F.row_number().over(w)).where(F.col("_i") <= n).drop("_i")

    salted = rows.select(key, value, F.pmod(F.xxhash64(value), F.lit(salts)).alias("_salt"))
    return most(most(salted, key, "_salt"), key).groupBy(key).agg(F.array_sort(F.collect_list(value)).alias("l"))


def next_smaller(rows: DataFrame, key: str, pos: str, value: str, what: str, *, block: int = 1024) -> DataFrame:
    """(key, what, other): of each row the first later row of its key with a smaller value, by ``what``; rows without one are left out.

    Rows meet only within blocks of positions; a row that finds none there looks for the first later block with a small enough minimum, and meets that one.
    """
    r = rows.select(key, F.col(pos).alias("_i"), F.col(value).alias("_v"), F.col(what).alias("_w"), F.floor(F.col(pos) / block).alias("_b"))
    o = r.select(F.col(key).alias("_k"), F.col("_i").alias("_j"), F.col("_v").alias("_u"), F.col("_w").alias("_x"), F.col("_b").alias("_c"))
    first = F.min(F.struct("_j", "_x")).alias("_y")
    near = r.join(o, (F.col(key) == F.col("_k")) & (F.col("_b") == F.col("_c")) & (F.col("_j") > F.col("_i")) & (F.col("_u") < F.col("_v"))).groupBy(key, "_i", "_w").agg(first)
    o = o.withColumnRenamed("_k", key)
    least = o.groupBy(key, "_c").agg(F.min("_u").alias("_u"))
    rest = r.join(near.select(key, "_i"), [key, "_i"], "left_anti")
    at = rest.join(least, key).where("_c > _b and _u < _v").groupBy(key, "_i", "_v", "_w").agg(F.min("_c").alias("_c"))
    far = at.join(o, [key, "_c"]).where("_u < _v").groupBy(key, "_i", "_w").agg(first)
    return near.unionByName(far).select(key, F.col("_w").alias(what), F.col("_y._x").alias("other"))


def summed_before(df: DataFrame, group: str, order: list[Column | str], value: str, name: str) -> DataFrame:
    """``df`` with the sum of a value over the rows before each in its group's order. Ranges as in ``ranked_within``."""
    ranges = _ranges(df, [group, *order])
    sums = ranges.groupBy(group, "_p").agg(F.sum(value).alias("_n"))
    before = Window.partitionBy(group).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("_from", F.sum("_n").over(before)).where("_from > 0").select(group, "_p", "_from")
    inside = ranges.withColumn(name, F.coalesce(F.sum(value).over(Window.partitionBy("_p", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return inside.join(offsets, [group, "_p"], "left").withColumn(name, F.col(name) + F.coalesce("_from", F.lit(0))).drop("_p", "_from")
