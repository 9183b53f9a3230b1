"""Calls of an outside function on rows, with answers kept by the fingerprint of what was asked."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import row_hash
from ..sources.tables import written


def fingerprinted(df: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """``df`` with ``fingerprint``, a hash of the inputs in which null and empty are alike."""
    return df.withColumn("fingerprint", row_hash(*[F.col(c).cast("string") for c in inputs]))


def answer_status(asked: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    """(key, status): whether the kept answer is current, stale (other inputs) or missing."""
    j = asked.select(key, "fingerprint").join(kept.select(key, F.col("fingerprint").alias("_f")), key, "left")
    return j.select(key, F.when(F.col("_f").isNull(), "missing").when(F.col("_f") == F.col("fingerprint"), "current").otherwise("stale").alias("status"))


def answered(df: DataFrame, key: str, inputs: Sequence[str], kept: DataFrame, ask: Callable[[pd.DataFrame], Sequence[str]], *, most: int | None = None) -> DataFrame:
    """(key, fingerprint, answer): kept answers whose fingerprint is current, and ``ask``'s answers for the rest.

    ``ask`` gets batches of (key, inputs) and returns a text a row; like inputs are asked once. ``kept`` has fingerprint and answer. With ``most`` a run asks
    at most so many distinct inputs, in the order of their fingerprints; the rest has a null answer until a later run.
    """
    rows = fingerprinted(df.select(key, *inputs), inputs)
    open_ = rows.select("fingerprint", *inputs).dropDuplicates(["fingerprint"]).join(kept.select("fingerprint").distinct(), "fingerprint", "left_anti")
    if most is not None:
        open_ = open_.orderBy("fingerprint").limit(most)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"fingerprint": b["fingerprint"], "answer": list(ask(b))})

    new = written(open_.mapInPandas(run, "fingerprint bigint, answer string"), "answers")  # asked once, however often the result is read
    known = kept.groupBy("fingerprint").agg(F.max("answer").alias("answer")).unionByName(new)
    return rows.select(key, "fingerprint").join(known, "fingerprint", "left").select(key, "fingerprint", "answer")


def answered_within(df: DataFrame, key: str, inputs: Sequence[str], kept: DataFrame, ask: Callable[[pd.DataFrame], Sequence[str]], *, seconds: float, cost: float, price: Callable[[str], float] = len, batch: int = 1000) -> tuple[DataFrame, dict]:
    """``answered`` within a time and a cost: batches of distinct inputs are asked until either is spent, and no batch begins after that.

    Returns the answers, null where none was asked for yet, and what was spent: ``asked``, ``skipped``, ``seconds``, ``cost``. ``price`` gives the cost of an answer. A batch that has
    begun is finished, so a limit may be passed by one batch.
    """
    began, spent, asked = time.monotonic(), 0.0, 0
    rows = written(fingerprinted(df.select(key, *inputs), inputs), "asked")
    known = written(kept.select("fingerprint", "answer"), "answers")
    value = F.pandas_udf(_priced(price), "double")
    while time.monotonic() - began < seconds and spent < cost:
        more = answered(rows, key, inputs, known, ask, most=batch).where("answer is not null").select("fingerprint", "answer").distinct()
        new = written(more.join(known, "fingerprint", "left_anti"), "answers")
        n, paid = new.agg(F.count("*"), F.coalesce(F.sum(value("answer")), F.lit(0.0))).first()
        if not n:
            break
        asked, spent, known = asked + n, spent + paid, written(known.unionByName(new), "answers")
    left = rows.select("fingerprint").distinct().join(known, "fingerprint", "left_anti").count()
    best = known.groupBy("fingerprint").agg(F.max("answer").alias("answer"))
    out = rows.select(key, "fingerprint").join(best, "fingerprint", "left").select(key, "fingerprint", "answer")
    return out, {"asked": asked, "skipped": left, "seconds": time.monotonic() - began, "cost": spent}


def _priced(price: Callable[[str], float]):
    def run(answers: pd.Series) -> pd.Series:
        return answers.map(lambda a: float(price(a)))

    return run
