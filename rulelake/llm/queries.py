"""Queries of the training-data operators over the test tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.judging import _VOTES, VERDICTS, votes
from ..sources.tables import table, written
from .consensus import fitted
from .encoding import decoded, encoded, token_counts
from .garbled import restored
from .languages import LEAST_WORDS, detected, passages
from .neardup import groups, similar_pairs
from .packing import packed

def p1_found(spark: SparkSession, d: str) -> DataFrame:
    items, _ = fitted(votes(spark, d), ["doc_id", "candidate"], "judge", "verdict", VERDICTS)
    return items.where("verdict <> 'keep'").select("doc_id", "candidate", "verdict")


def p1_consensus(spark: SparkSession, d: str) -> DataFrame:
    return fitted(votes(spark, d), ["doc_id", "candidate"], "judge", "verdict", VERDICTS)[0]


def p1_judges(spark: SparkSession, d: str) -> DataFrame:
    return fitted(votes(spark, d), ["doc_id", "candidate"], "judge", "verdict", VERDICTS)[1]


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return restored(table(spark, d, "decision"), "ref", ["tekst", "citat"]).select("ref", "felt").distinct()


def p3_restored(spark: SparkSession, d: str) -> DataFrame:
    """The garbled fields with their text as far as it could be regained."""
    return restored(table(spark, d, "decision"), "ref", ["tekst", "citat"])


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return similar_pairs(table(spark, d, "decision"), "ref", ["emne", "tekst"]).withColumnsRenamed({"a": "ref_a", "b": "ref_b"})


def p4_groups(spark: SparkSession, d: str) -> DataFrame:
    return groups(table(spark, d, "decision"), "ref", ["emne", "tekst"])


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return encoded(table(spark, d, "documents"))


def p7_decoded(spark: SparkSession, d: str) -> DataFrame:
    """The texts decoded again from their ids; null texts come back empty."""
    return decoded(encoded(table(spark, d, "documents")))


def p8_packing(spark: SparkSession, d: str) -> DataFrame:
    sizes = written(token_counts(table(spark, d, "documents")), "token-counts")
    return packed(sizes, _capacities(spark, d))


def _capacities(spark: SparkSession, d: str) -> dict[str, int]:
    """The kinds of container, a fixed list of three."""
    return {r["container"]: r["capacity"] for r in table(spark, d, "container").where("container is not null and capacity > 0").collect()}


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """Per kind of container how many are used, the fewest there could be, and the share of space left over."""
    total = p8_packing(spark, d).groupBy("container").agg(F.count_distinct("bin").alias("bins"), F.sum("tokens").alias("tokens"))
    return total.join(table(spark, d, "container"), "container").select("container", "bins", F.ceil(F.col("tokens") / F.col("capacity")).alias("least"), (1 - F.col("tokens") / (F.col("bins") * F.col("capacity"))).alias("unused"))


def p8_placed(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of a packing: every document is placed in every kind of container, no container is overfull, no piece but of a document that exceeds the capacity."""
    rows = p8_packing(spark, d).join(table(spark, d, "container"), "container")
    over = rows.where("bin is not null").groupBy("container", "bin").agg(F.sum("tokens").alias("n"), F.max("capacity").alias("capacity")).groupBy("container").agg(F.count_if(F.col("n") > F.col("capacity")).alias("overfull"))
    docs = rows.groupBy("container", "doc_id").agg(F.count("*").alias("pieces"), F.sum("tokens").alias("n"), F.max("capacity").alias("capacity"))
    docs = docs.groupBy("container").agg(F.count("*").alias("documents"), F.count_if((F.col("pieces") > 1) & (F.col("n") <= F.col("capacity"))).alias("split_in_vain"))
    return docs.join(over, "container").select("container", "documents", "overfull", "split_in_vain")


def p1_agreement(spark: SparkSession, d: str) -> DataFrame:
    """How far the judges agree on each candidate, and how many judged it."""
    return p1_consensus(spark, d).select("doc_id", "candidate", "votes", F.round("agreement", 9).alias("agreement"))


def p9_labels(spark: SparkSession, d: str) -> DataFrame:
    """Every document once, with its label read as a language."""
    return p9_documents(spark, d).select("doc_id", "label")


def p9_passages(spark: SparkSession, d: str) -> DataFrame:
    """The runs of sentences in one language within each paragraph, with the characters of the text at which each begins and ends."""
    return passages(table(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    found = detected(table(spark, d, "documents")).where(F.col("para").isNotNull() & (F.col("longest") >= LEAST_WORDS))
    return found.where(F.col("label").isNull() | (F.col("lang") != F.col("label"))).select("doc_id", "para", "lang")


def p9_documents(spark: SparkSession, d: str) -> DataFrame:
    """The main language of each document with its confidence, beside the label."""
    return detected(table(spark, d, "documents")).where("para is null").select("doc_id", "lang", "confidence", "label")


def p9_segments(spark: SparkSession, d: str) -> DataFrame:
    """The languages of each paragraph with confidence and share."""
    return detected(table(spark, d, "documents")).where("para is not null").select("doc_id", "para", "lang", "confidence", "share")


QUERIES = {f.__name__: f for f in (p1_found, p1_consensus, p1_judges, p3_found, p3_restored, p4_found, p4_groups, p7_ids, p7_decoded, p8_packing, p8_fill, p8_placed, p1_agreement, p9_found, p9_documents, p9_segments, p9_passages, p9_labels)}
SQL = {
    "p1_agreement": _VOTES + """ select doc_id, candidate, sum(n)::bigint as votes, case when sum(n) > 1 then round(sum(n * (n - 1)) / (sum(n) * (sum(n) - 1)), 9) end as agreement from n group by all""",
    "p8_placed": "select container, (select count(*) from documents) as documents, 0::bigint as overfull, 0::bigint as split_in_vain from container",
    "p9_labels": """select doc_id, case when l in ('da', 'nb', 'sv', 'en', 'de') then l when l = 'no' then 'nb' end as label from (select doc_id, lower(trim(regexp_extract(lang, '^[^-_]*'))) as l from documents)""",
    "p7_decoded": "select doc_id, coalesce(text, '') as text from documents",
}
