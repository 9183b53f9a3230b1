"""History of changing attributes: a type-two dimension built and merged by attribute hashes.

The dimension keeps, for each key and effective date, the row that holds on that date: its hash, where it came from, whether it opened
a version and when that was closed. A batch is merged by comparing its hashes with the versions open at its time; only keys of the batch are
rewritten, and of these only the versions from there on. Every step is safe against a key that holds a
large part of all rows: the state is a combinable aggregate, which leaves at most one row a key and date, so that the window
over a key is bounded by the number of dates in the calendar and never by the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

OPEN = "9999-12-31"


def type2_state(rows: DataFrame, key: Sequence[str], start: str, order: Sequence[str], hash_: str, carry: Sequence[str] = ()) -> DataFrame:
    """One row a key and effective date: of several, the last by ``order`` holds.

    ``hash_`` names a column with the hash of the attributes, null where the entity has none from then on. Rows whose key or
    start is null have no place in a history and are left out. Repeated rows count once; ties in ``order`` are settled by the
    hash and the carried columns, so that the result does not depend on the order of rows. Nulls in ``order`` come first.
    """
    have = [c for c in [*key, start] if c is not None]
    ranked = F.struct(*[F.col(c) for c in order], F.col(hash_).alias("_h"), *[F.col(c).alias(f"_c_{c}") for c in carry])
    best = (
        rows.where(" and ".join(f"`{c}` is not null" for c in have))
        .select(*key, F.col(start).alias("valid_from"), ranked.alias("_best"))
        .groupBy(*key, "valid_from")
        .agg(F.max("_best").alias("_best"))
    )
    return best.select(*key, "valid_from", *[F.col(f"_best.{c}").alias(c) for c in order], F.col("_best._h").alias(hash_), *[F.col(f"_best._c_{c}").alias(c) for c in carry])


def opened(rows: DataFrame, key: Sequence[str], hash_: str) -> DataFrame:
    """A state as a type-two dimension: ``opens`` tells that a row's hash differs from the row before it, ``valid_to`` is when the version
    it opens is closed. Rows that confirm the version before stay, as a late row may come between.
    """
    by_time = Window.partitionBy(*key).orderBy("valid_from")
    before = F.lag(F.struct(F.col(hash_).alias("h"))).over(by_time)
    flagged = rows.withColumn("_before", before).withColumn("opens", F.col("_before").isNull() | ~F.col("_before.h").eqNullSafe(F.col(hash_))).drop("_before")
    later = F.min(F.when(F.col("opens"), F.col("valid_from"))).over(by_time.rowsBetween(1, Window.unboundedFollowing))
    return flagged.withColumn("valid_to", F.when(F.col("opens"), F.coalesce(later, F.lit(OPEN))))


def merge_type2(dimension: DataFrame | None, batch: DataFrame, key: Sequence[str], start: str, order: Sequence[str], hash_: str, carry: Sequence[str] = ()) -> DataFrame:
    """The type-two dimension with a batch of rows merged in: (key, valid_from, order, hash, carry, ``opens``, ``valid_to``).

    Per key of the batch the version that was open when the batch's first row takes effect is looked up; what came before it, and every
    other key, passes through as it is. From that version on the hashes are compared: a row with the same hash confirms it, a changed
    one closes it with an end date and opens the next, and so on to the end. For rows in order that is the current version alone; late
    rows take the versions after them along. The batch may be unordered or repeated and may hold earlier rows again. Rows without a key or start are left
    out. ``None`` stands for an empty dimension.
    """
    key = list(key)
    new = type2_state(batch, key, start, order, hash_, carry)
    if dimension is None:
        return opened(new, key, hash_)
    touched = new.groupBy(*key).agg(F.min("valid_from").alias("_since"))
    marked = dimension.join(touched, key, "left")
    anchors = marked.where("opens and valid_from < _since").groupBy(*key).agg(F.max("valid_from").alias("_anchor"))
    marked = marked.join(anchors, key, "left").withColumn("_again", F.col("_since").isNotNull() & (F.col("valid_from") >= F.coalesce("_anchor", F.lit(""))))
    kept = marked.where(~F.col("_again")).select(dimension.columns)
    again = type2_state(marked.where("_again").select(new.columns).unionByName(new), key, "valid_from", order, hash_, carry)
    return kept.unionByName(opened(again, key, hash_))


def merge_type2_table(spark: SparkSession, path: str, batch: DataFrame, key: Sequence[str], start: str, order: Sequence[str], hash_: str, carry: Sequence[str] = (), *, buckets: int = 256) -> None:
    """``merge_type2`` into a table on disk, which is parted by a hash of the key: only the parts that the batch's keys fall into are read and
    written again. ``buckets`` is set when the table is begun and must stay. A part is replaced as a whole or not at all.
    """
    place = F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
    table = None
    if there:
        parts = [r[0] for r in batch.where(" and ".join(f"`{k}` is not null" for k in key)).select(place).distinct().collect()]  # at most ``buckets``
        table = spark.read.parquet(path).where(F.col("_bucket").isin(parts)).drop("_bucket")
    merged = merge_type2(table, batch, key, start, order, hash_, carry).withColumn("_bucket", place)
    merged.repartition("_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(path)


def type2_versions(dimension: DataFrame, key: Sequence[str], hash_: str, carry: Sequence[str] = ()) -> DataFrame:
    """The versions of a dimension with ``valid_from`` and ``valid_to``; a null hash closed the one before without opening any. The last stays open to ``OPEN``."""
    return dimension.where(F.col("opens") & F.col(hash_).isNotNull()).select(*key, "valid_from", "valid_to", *carry)


def type2_periods(state: DataFrame, key: Sequence[str], hash_: str, carry: Sequence[str] = ()) -> DataFrame:
    """The versions of a state of which nothing is kept: ``type2_versions`` of all its rows at once."""
    return type2_versions(opened(state, key, hash_), key, hash_, carry)
