"""Overlapping and gapped intervals of days: continuous periods and the gaps between them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .history import OPEN


def periods_and_gaps(rows: DataFrame, key: Sequence[str], start: str, end: str) -> DataFrame:
    """``kind`` (period or gap), ``fra`` and ``til`` per key; first and last day are both included.

    Dates are ISO strings. A null end is open (``OPEN``). Rows without a key or with a start that is no full date (a bare year is none) are left out, as are
    intervals that end before they start or whose end is no date. Intervals that overlap, nest, touch or follow on the next
    day are one period.

    Intervals are first reduced to the longest a key and start, a combinable aggregate: what is left of a key for the window is
    bounded by the days of the calendar, however many rows the key holds.
    """
    first, last = [F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), c.try_cast("date")) for c in (F.col(start), F.coalesce(end, F.lit(OPEN)))]
    longest = (
        rows.where(" and ".join(f"`{k}` is not null" for k in key))
        .select(*key, first.alias("_fra"), last.alias("_til"))
        .where("_fra is not null and _til >= _fra")
        .groupBy(*key, "_fra")
        .agg(F.max("_til").alias("_til"))
    )
    by_start = Window.partitionBy(*key).orderBy("_fra")
    reach = F.max("_til").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("_reach").isNull() | (F.datediff("_fra", "_reach") > 1), 1).otherwise(0)
    islands = (
        longest.withColumn("_reach", reach)
        .withColumn("_island", F.sum(opens).over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*key, "_island")
        .agg(F.min("_fra").alias("_fra"), F.max("_til").alias("_til"), F.min("_reach").alias("_reach"))
    )
    before = F.lag("_til").over(Window.partitionBy(*key).orderBy("_island"))
    rows_of = F.array(
        F.struct(F.lit("period").alias("kind"), F.col("_fra").alias("fra"), F.col("_til").alias("til")),
        F.struct(F.lit("gap").alias("kind"), F.date_add("_before", 1).alias("fra"), F.date_sub("_fra", 1).alias("til")),
    )
    return (
        islands.withColumn("_before", before)
        .select(*key, F.explode(rows_of).alias("_x"))
        .where("_x.fra is not null")
        .select(*key, F.col("_x.kind").alias("kind"), F.col("_x.fra").cast("string").alias("fra"), F.col("_x.til").cast("string").alias("til"))
    )
