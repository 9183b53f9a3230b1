"""Parquet tables and the shared folder in which a lineage is cut."""

from __future__ import annotations

import gc
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """The table ``name`` of ``directory``: one Parquet file, or a folder of them."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session, else one of our own.

    Our own is set only where the session names none and runs on this machine alone, as in tests; on a cluster that is an error, as executors
    would each write to their own disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    kept = spark.sparkContext._jsc.sc().getCheckpointDir()
    if not named and kept.isDefined():
        return kept.get()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("a cluster must name its shared folder in spark.checkpoint.dir")
        named = "file://" + tempfile.mkdtemp(prefix="rulelake-")
        removed_at_end(spark, named)
    if not kept.isDefined():
        spark.sparkContext.setCheckpointDir(named)
    return named


def removed_at_end(spark: SparkSession, path: str) -> None:
    """Has the file system remove a path when the session's JVM ends. A path that is not there yet is made, as only what exists can be marked."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(p):
        files.mkdirs(p)
    files.deleteOnExit(p)


def cut(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a reliable checkpoint in the shared folder.

    A checkpoint keeps the size estimated for its plan. Loops of joins use ``written``, as their estimates would multiply.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    A written table survives the loss of executors and is read column by column. It is removed when the session's JVM ends.
    """
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"{what}-{uuid.uuid4().hex}.parquet")
    df.write.parquet(path)
    removed_at_end(spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out.kept_at = path
    return out


def dropped(df: DataFrame) -> None:
    """Removes the files of a ``written`` table that nothing reads any more."""
    spark = df.sparkSession
    p = spark._jvm.org.apache.hadoop.fs.Path(df.kept_at)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def freed(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of plans that nothing refers to any more, as between the steps of a long loop."""
    gc.collect()
    spark._jvm.System.gc()


def merged(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is shuffled and merged whatever size is estimated, as a broadcast passes the driver's memory.

    Spark goes by the bytes of the files: words and equal texts take ten times as many in memory.
    """
    return df.hint("merge")


def small(df: DataFrame, rows: int, size: int = 64 << 20) -> bool:
    """Whether a table has at most so many rows and bytes of text, so that it may be broadcast; no more than a row beyond is read."""
    wide = [c for c, t in df.dtypes if t not in ("bigint", "int", "double", "boolean", "date", "timestamp", "timestamp_ntz")]
    text = sum((F.coalesce(F.octet_length(c if t == "string" else F.to_json(c)), F.lit(0)) for c, t in df.dtypes if c in wide), F.lit(0))
    n, b = df.limit(rows + 1).select(text.cast("bigint").alias("_b")).agg(F.count("*"), F.sum("_b")).first()
    return n <= rows and (b or 0) <= size
