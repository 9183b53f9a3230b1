"""Views that many queries share, in Spark and in SQL, and the register of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with the SQL that must give the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def decisions(spark: SparkSession, d: str) -> DataFrame:
    """Decisions once each: rows of one ref agree in all but the page."""
    return table(spark, d, "decision").drop("side", "side_rettet").distinct()


def rule_versions(spark: SparkSession, d: str) -> DataFrame:
    """Versions of rules once each."""
    return table(spark, d, "rule_version").drop("filed_at").distinct()


def versions(spark: SparkSession, d: str) -> DataFrame:
    """Versions with what they take from their decision: effective and decided dates, text, change and essence."""
    dec = decisions(spark, d).select("ref", "doc_id", "dato", "gaelder_fra", "gaelder_til", "udfald", "handling", "niveau", "emne", F.col("tekst").alias("dtekst"))
    return (
        rule_versions(spark, d)
        .join(dec, "ref")
        .withColumn("effective", F.coalesce("gaelder_fra", "dato", F.lit("")))
        .withColumn("decided", F.coalesce("dato", F.lit("")))
        .withColumn("text", F.coalesce("tekst", "dtekst"))
        .withColumn("change", F.coalesce("kort", "dtekst"))
        .withColumn("essence", F.coalesce("kort_regel", "kort", "tekst", "dtekst"))
    )


D = "d as (select distinct * exclude (side, side_rettet) from decision)"
V = D + ", v as (select distinct * exclude (filed_at) from rule_version)"
X = V + """, x as (select v.*, d.doc_id, d.dato, d.gaelder_fra, d.gaelder_til, d.udfald, d.handling, d.niveau, d.emne, d.tekst as dtekst,
  coalesce(gaelder_fra, dato, '') as effective, coalesce(dato, '') as decided, coalesce(v.tekst, d.tekst) as text, coalesce(kort, d.tekst) as change,
  coalesce(kort_regel, kort, v.tekst, d.tekst) as essence from v join d using (ref))"""
#: The categories in their order, the areas they belong to.
CATEGORIES = ["medlemskab", "okonomi", "antidoping", "staevner", "dommere", "landshold", "master", "udstyr", "uddannelse", "organisation", "internationalt", "andet"]
#: Effects that state the content of a rule, and the effect of a decision that adopted nothing.
CONTENT = ["indfoert", "aendret", "bekraeftet"]
PROPOSAL = {"ikke_afgjort": "foreslaaet", "forkastet": "forkastet", "trukket": "trukket"}


def quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)
