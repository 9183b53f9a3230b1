"""Votes and scores: last answers, majorities, agreement, ratios, resampled intervals."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from math import exp, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_answers(rows: DataFrame, item: Sequence[str], annotator: str, received: str, answer: str) -> DataFrame:
    """Of the answers of an annotator on the same thing the last received; a null time counts as the earliest, ties go to the greater answer."""
    known = rows.where(" and ".join(f"`{c}` is not null" for c in [*item, annotator]))
    return known.groupBy(*item, annotator).agg(F.max(F.struct(received, answer)).alias("_x")).select(*item, annotator, F.col(f"_x.{answer}").alias(answer))


def majority(votes: DataFrame, item: Sequence[str], label: str, order: str, least: int = 2) -> DataFrame:
    """(item, label, votes): the label with the most votes, ties to the one voted first by ``order``; only if it has ``least`` votes.

    Counts per label are combined before they meet, so an item with very many votes is no hot group.
    """
    counts = votes.groupBy(*item, label).agg(F.count("*").alias("_n"), F.min(order).alias("_o"))
    best = counts.groupBy(*item).agg(F.min(F.struct((-F.col("_n")).alias("m"), "_o", label)).alias("_x"))
    return best.select(*item, F.col(f"_x.{label}").alias(label), (-F.col("_x.m")).alias("votes")).where(F.col("votes") >= least)


def ratio(a: Column, b: Column) -> Column:
    """a / b, null for nothing to divide by."""
    return F.try_divide(a.cast("double"), b.cast("double"))


PRIME = 2_147_483_647
#: The places below ``PRIME`` from which a uniform number there is drawn once, twice and so on, so that the draws follow Poisson's law of mean 1.
POISSON = [int(PRIME * sum(exp(-1) / factorial(i) for i in range(k))) for k in range(1, 13)]


def named_unit(name: str) -> Column:
    """A unit for ``poisson_weight``: a start and a step of its own, from the hash of its name."""
    return F.struct(*[(F.conv(F.substring(F.md5(name), at, 15), 16, 10).cast("bigint") % PRIME).alias(c) for c, at in (("u", 1), ("v", 16))])


def poisson_weight(unit: Column, sample: Column) -> Column:
    """How often a ``named_unit`` is taken in a sample, as in drawing with replacement from very many units (Poisson's law of mean 1).

    Units are independent of each other, and so is any sample of any other.
    """
    w = (unit["u"] + sample * unit["v"]) % PRIME
    return sum((F.when(w >= t, 1).otherwise(0) for t in POISSON), F.lit(0))


def bootstrap(scores: DataFrame, unit: str, a: tuple[str, str], b: tuple[str, str], samples: int = 2000, weight: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """Paired bootstrap of the difference of two pooled ratios over units: (difference, low, high, ahead).

    Each unit's part in a resample is a ``weight`` of a fixed rule of the unit and the sample's number, so that every engine draws
    alike. The interval is taken at the index int(q * (n - 1)) of the sorted differences, without interpolation.
    Sums per sample are combinable; nothing but the ``samples`` differences is gathered.
    """
    drawn = scores.select(unit, *a, *b, F.explode(F.sequence(F.lit(1), F.lit(samples))).alias("s"))
    w = (weight or poisson_weight)(F.col(unit), F.col("s"))
    drawn = drawn.withColumn("w", w)
    sums = drawn.groupBy("s").agg(*[F.sum(F.col(c) * F.col("w")).alias(c) for c in dict.fromkeys([*a, *b])])
    diff = sums.select((ratio(F.col(a[0]), F.col(a[1])) - ratio(F.col(b[0]), F.col(b[1]))).alias("d")).where("d is not null")
    listed = diff.agg(F.array_sort(F.collect_list("d")).alias("l"), F.avg(F.when(F.col("d") > 0, 1.0).otherwise(0.0)).alias("ahead"))
    n = F.size("l") - 1
    seen = scores.agg(*[F.sum(c).alias(c) for c in dict.fromkeys([*a, *b])]).select((ratio(F.col(a[0]), F.col(a[1])) - ratio(F.col(b[0]), F.col(b[1]))).alias("difference"))
    at = [F.element_at("l", (F.floor(n * q) + 1).cast("int")).alias(c) for c, q in (("low", 0.025), ("high", 0.975))]
    return listed.select(*at, "ahead").crossJoin(F.broadcast(seen)).select("difference", "low", "high", "ahead")


def b_cubed(rows: DataFrame, a: str, b: str) -> DataFrame:
    """(precision, recall, f1) of grouping ``a`` against grouping ``b``, from counts per pair of groups."""
    both = rows.groupBy(a, b).agg(F.count("*").alias("n"))
    na, nb = both.groupBy(a).agg(F.sum("n").alias("na")), both.groupBy(b).agg(F.sum("n").alias("nb"))
    s = both.join(na, a).join(nb, b).agg(F.sum(F.col("n") * F.col("n") / F.col("na")).alias("p"), F.sum(F.col("n") * F.col("n") / F.col("nb")).alias("r"), F.sum("n").alias("n"))
    p, r = ratio(F.col("p"), F.col("n")), ratio(F.col("r"), F.col("n"))
    return s.select(p.alias("precision"), r.alias("recall"), ratio(2 * p * r, p + r).alias("f1"))
