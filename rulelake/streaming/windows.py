"""Event windows with a watermark, and the latest rows of a stream."""

from __future__ import annotations

import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..sources.tables import removed_at_end, shared_dir


def windowed_counts(events: DataFrame, time: str, by: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(start, by, n, total) per tumbling window; in a stream, events later than ``late`` behind the newest are dropped."""
    kind = events.schema[time].dataType.simpleString()
    g = events.withColumn("_t", F.col(time).cast("timestamp"))  # a watermark needs a time with a zone
    g = g.withWatermark("_t", late) if events.isStreaming else g
    counts = g.groupBy(F.window("_t", width).alias("w"), by).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return counts.select(F.col("w.start").cast(kind).alias("start"), by, "n", "total")


def run_to_table(stream: DataFrame, keys: list[str]) -> DataFrame:
    """Runs a stream over what is there now and returns its result as a table in the shared folder.

    Each batch writes the rows that it changed to a folder of its own number, so a batch that is run again replaces what it wrote; of several rows of ``keys``
    the one of the last batch counts. State of windows behind the watermark is dropped.
    """
    spark = stream.sparkSession
    base = os.path.join(shared_dir(spark), f"stream-{uuid.uuid4().hex}")
    out = base + "/out"

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = stream.writeStream.outputMode("update").option("checkpointLocation", base + "/log").trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    removed_at_end(spark, base)
    values = [c for c in stream.columns if c not in keys]
    try:
        rows = spark.read.schema(StructType([*stream.schema.fields, StructField("batch", LongType())])).parquet(out)
    except AnalysisException:  # no batch ran
        return spark.createDataFrame([], stream.schema)
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("x")).select(*keys, "x.*").select(stream.columns)


def followed(stream: DataFrame, key: str, version: str) -> DataFrame:
    """The greatest version of each key of a stream and the number of its rows, late and repeated ones included: (key, latest, rows)."""
    return stream.groupBy(key).agg(F.max(version).alias("latest"), F.count("*").alias("rows"))


def parquet_stream(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """The table ``name`` of ``directory`` as a stream of its files."""
    path = f"{directory}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder = p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()
    return spark.readStream.schema(schema).parquet(path if folder else f"{directory}/{name}.parq*")
