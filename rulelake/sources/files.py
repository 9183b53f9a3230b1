"""The nested JSON files of the data model, and the sinks."""

from __future__ import annotations

import uuid
from pathlib import PurePosixPath

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOC = "id string, organ string, title string, date string, path string, url string, sha256 string"
DECISION = (
    "id string, emne string, kategori string, udfald string, forslagsstiller string, handling string, niveau string, tekst string, citat string, "
    "side int, stemmer string, gaelder_fra string, gaelder_til string, citat_fundet boolean, citat_pos int, citat_side int"
)
EXTRACTION = f"doc_id string, sha256 string, version int, model string, moededato string, next_number int, retired array<struct<id:string,emne:string,reason:string,date:string>>, beslutninger array<struct<{DECISION.replace(' ', ':').replace(',:', ',')}>>"
RULES = (
    "kategori string, version int, input_hash string, model string, regler array<struct<titel:string,slug:string,vigtig:boolean,note:string,"
    "versioner:array<struct<ref:string,effekt:string,tekst:string,kort:string,kort_regel:string,dhash:string>>>>, udeladt array<string>, ikke_tildelt array<string>, inputs map<string,string>"
)
RUN = "time string, cli string, command string, audit string, steps map<string,struct<calls:int,failed:int,skipped:int,cost_usd:double,seconds:double>>"
SLUGS = "aliases map<string,struct<to:string,category:string,title:string,refs:array<string>>>, retired map<string,struct<category:string,title:string,refs:array<string>>>"


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents, one a file, of a fixed schema; keys that lack are null."""
    return spark.read.schema(schema).json(path, multiLine=True)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The list of documents; of several with one id each row is kept."""
    return read_json(spark, path, DOC)


def extracted_decisions(spark: SparkSession, path: str) -> DataFrame:
    """The decisions of extraction files, one a row, with ``rank`` as their place in the file.

    The page is where the quote was located, else the one claimed; ``side_rettet`` tells that both are known and differ.
    """
    files = read_json(spark, path, EXTRACTION)
    rows = files.select("doc_id", "moededato", F.posexplode("beslutninger").alias("rank", "b"))
    differs = F.col("b.side").isNotNull() & F.col("b.citat_side").isNotNull() & (F.col("b.side") != F.col("b.citat_side"))
    return rows.select(F.col("b.id").alias("ref"), "doc_id", F.col("moededato").alias("dato"), "b.*", F.coalesce("b.citat_side", "b.side").alias("page"), differs.alias("side_rettet"), "rank").drop("id")


def selected(docs: DataFrame, selection: DataFrame, key: str, named: str, first: int | None = None) -> DataFrame:
    """The documents of a selection with its columns (such as their place in it), or of its first so many rows; a selected document that is not there is an error."""
    wanted = selection if first is None else selection.limit(first)
    lost = [r[0] for r in wanted.join(docs, F.col(named) == F.col(key), "left_anti").select(named).limit(3).collect()]
    if lost:
        raise ValueError(f"unknown documents: {', '.join(map(str, lost))}")
    return docs.join(wanted, F.col(named) == F.col(key)).drop(named)


def retired_ids(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, EXTRACTION).select("doc_id", F.explode("retired").alias("r")).select("doc_id", "r.*")


def filed_versions(spark: SparkSession, path: str) -> DataFrame:
    """The versions of rule files, one a row, with ``idx`` as their place in the rule."""
    rules = read_json(spark, path, RULES).select("kategori", F.explode("regler").alias("r"))
    return rules.select("kategori", "r.titel", "r.slug", "r.vigtig", "r.note", F.posexplode("r.versioner").alias("idx", "v")).select("kategori", "titel", "slug", "vigtig", "note", "idx", "v.*")


def one_offs(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, RULES).select("kategori", F.explode("udeladt").alias("ref")).distinct()


def slug_registry(spark: SparkSession, path: str) -> DataFrame:
    """(src, dst): former slugs and where they lead; retired ones lead nowhere."""
    files = read_json(spark, path, SLUGS)
    live = files.select(F.explode("aliases").alias("src", "x")).select("src", F.col("x.to").alias("dst"))
    return live.unionByName(files.select(F.explode("retired").alias("src", "x")).select("src", F.lit(None).cast("string").alias("dst")))


def run_log(spark: SparkSession, path: str) -> DataFrame:
    """The steps of a run log, a JSON object a line; cut or broken lines are skipped. Lines end in line feeds only."""
    rows = spark.read.schema(RUN + ", _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").option("lineSep", "\n").json(path)
    kept = rows.where("_corrupt is null and time is not null")
    return kept.select("time", "command", "audit", F.explode("steps").alias("step", "s")).select("time", "command", "audit", "step", "s.*")


def stored(df: DataFrame, path: str, *, within: str, by: list[str] | None = None, format: str = "json", mode: str = "overwrite") -> None:
    """Writes a table below ``within`` and nowhere else; a path outside of it is an error. Overwriting removes what is not rebuilt."""
    root, target = PurePosixPath(within), PurePosixPath(path)
    if ".." in target.parts or root not in (target, *target.parents):
        raise ValueError(f"{path} is not below {within}")
    writer = df.write.mode(mode).format(format)
    (writer.partitionBy(*by) if by else writer).save(path)


def stored_arrays(df: DataFrame, path: str, *, within: str) -> None:
    """Writes each partition as one JSON array of its rows, an object a line, as the readers of nested files take them; a place below ``within`` as in ``stored``."""

    def lines(batches):
        held = None
        yield pa.RecordBatch.from_pydict({"value": ["["]})
        for b in batches:
            rows = b.column("j").to_pylist()
            if rows:
                out = ([held + ","] if held is not None else []) + [r + "," for r in rows[:-1]]
                held = rows[-1]
                yield pa.RecordBatch.from_pydict({"value": out}, schema=pa.schema([("value", pa.string())]))
        yield pa.RecordBatch.from_pydict({"value": ([held] if held is not None else []) + ["]"]})

    rows = df.select(F.to_json(F.struct(*df.columns)).alias("j"))
    stored(rows.mapInArrow(lines, "value string"), path, within=within, format="text")


def append_log(df: DataFrame, path: str, *, within: str) -> None:
    """Appends rows as JSON lines to a log, in files of their own: a line that an earlier run left cut stays alone in its file and is passed over."""
    stored(df, path, within=within, mode="append")


def published(spark: SparkSession, staged: dict[str, DataFrame], checks, *, within: str) -> None:
    """Writes tables beside their places below ``within``, checks them there, and only then puts them in place, in the order given.

    ``checks`` takes the staged tables by name and returns what is wrong; then nothing is put in place and an error is raised.
    """
    fs_of = spark._jvm.org.apache.hadoop.fs.Path
    paths = {}
    for name, df in staged.items():
        paths[name] = f"{within}/.staged-{uuid.uuid4().hex}-{name}"
        stored(df, paths[name], within=within, format="parquet")
    wrong = list(checks({n: spark.read.schema(df.schema).parquet(paths[n]) for n, df in staged.items()}))
    root = fs_of(within).getFileSystem(spark._jsc.hadoopConfiguration())
    if wrong:
        for p in paths.values():
            root.delete(fs_of(p), True)
        raise ValueError("not published: " + "; ".join(map(str, wrong)))
    for name, p in paths.items():
        root.delete(fs_of(f"{within}/{name}"), True)
        root.rename(fs_of(p), fs_of(f"{within}/{name}"))


def site_payload(df: DataFrame, key: str) -> DataFrame:
    """(key, json): each row as JSON that may stand inside a page: no less-than sign is left bare."""
    return df.select(key, F.replace(F.to_json(F.struct(*df.columns)), F.lit("<"), F.lit("\\u003c")).alias("json"))
