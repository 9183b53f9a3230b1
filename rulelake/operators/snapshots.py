"""What changed between consecutive full snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import row_hash, squeezed
from ..sources.tables import written

#: Up to this many deliveries their list, one short row each, is broadcast; beyond, it is joined like any table.
BROADCAST_DELIVERIES = 100_000


def last_deliveries(rows: DataFrame, snapshot: str, delivered: str) -> DataFrame:
    """Per snapshot the last delivery, the snapshot's place in time and the next snapshot."""
    last = rows.where(F.col(snapshot).isNotNull()).groupBy(snapshot).agg(F.max(delivered).alias(delivered))
    return last.withColumn("_next", F.lead(snapshot).over(Window.orderBy(snapshot)))


def snapshot_changes(rows: DataFrame, snapshot: str, delivered: str, key: Sequence[str], compared: Sequence[str]) -> DataFrame:
    """Each difference of a snapshot from the one before: the key and ``kind``, one of new, changed, retired.

    Of several deliveries of a snapshot only the last counts. Values are compared with runs of white space alike, ends trimmed
    and null like empty. Each row is tagged as the new side of its own snapshot and the old side of the next, and one
    combinable aggregation per (snapshot, key) over the 64-bit row hashes classifies. Repeated rows of a delivery count once;
    should they contradict each other the greatest hash stands for the key. Rows with a null key or snapshot are left out.
    A null time of delivery counts as the earliest. An empty table gives an empty result.
    """
    rows = rows.select(*dict.fromkeys([snapshot, delivered, *key, *compared]))
    last = written(last_deliveries(rows, snapshot, delivered), "deliveries")  # used three times, from one scan of two columns
    small = last.limit(BROADCAST_DELIVERIES + 1).count() <= BROADCAST_DELIVERIES
    last = last.withColumnsRenamed({snapshot: "_snapshot", delivered: "_delivered"})
    valid = rows.join(F.broadcast(last) if small else last, (F.col(snapshot) == F.col("_snapshot")) & F.col(delivered).eqNullSafe(F.col("_delivered")))
    for k in key:
        valid = valid.where(F.col(k).isNotNull())
    hashed = valid.select(F.col("_snapshot"), F.col("_next"), *key, row_hash(*[squeezed(F.col(c).cast("string")) for c in compared]).alias("_h"))
    first = last.agg(F.min("_snapshot").alias("_first"))
    sides = hashed.select(
        *key,
        "_h",
        F.explode(F.array(F.struct(F.col("_snapshot").alias("at"), F.lit(True).alias("new")), F.struct(F.col("_next").alias("at"), F.lit(False).alias("new")))).alias("_side"),
    ).where(F.col("_side.at").isNotNull())
    both = sides.groupBy(F.col("_side.at").alias(snapshot), *key).agg(
        F.max(F.when(F.col("_side.new"), F.col("_h"))).alias("_new"), F.max(F.when(~F.col("_side.new"), F.col("_h"))).alias("_old")
    )
    kind = F.when(F.col("_old").isNull(), "new").when(F.col("_new").isNull(), "retired").when(F.col("_old") != F.col("_new"), "changed")
    return both.join(F.broadcast(first), F.col(snapshot) > F.col("_first")).select(snapshot, *key, kind.alias("kind")).where(F.col("kind").isNotNull())
