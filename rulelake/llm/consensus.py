"""Consensus from several annotators' labels by a mixture of competence and spamming.

Each label of an annotator is either truthful, with the annotator's competence as its probability, or a draw from the
annotator's own guess distribution. Expectation-maximisation over the labels yields the posterior of each item's true label,
each annotator's competence and guesses, and the shares of the labels.

While the annotators are few, the labels are packed once, a row an item, into a written table of as many files as its size asks for; an
iteration is one pass over the column of labels in Arrow batches, whose sums per annotator are combined in the task before the only shuffle,
and a few numbers an annotator come to the driver. An item has at most one label an annotator, so a packed row is bounded. Beyond that
number of annotators the parameters are a table: an iteration joins them to the labels and aggregates by item and by annotator, each with
partial aggregates or sorted windows that spill. An annotator that holds a large part of all labels never gathers its rows in one task.

Several starts are followed for a few steps and the likeliest of them to the end. The end is where no competence moves by more than the tolerance;
the likelihood rises at every step, so it is reached, and a fit that has not reached it is an error, never a result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import written

#: Up to this many annotators their parameters (a few numbers each) are sent to the tasks and held by the driver; beyond, they are joined and written.
BROADCAST_ANNOTATORS = 20_000
#: Priors: pseudo-labels for the competence (truthful, guessed), for each guess and for each class.
TRUTHFUL, GUESSED, GUESS, CLASS = 2.0, 1.0, 0.5, 1.0
#: Competences that the fit starts from, the steps after which the likeliest start goes on alone, and the steps after which a fit counts as failed.
STARTS, TRIAL, FAILED = (0.7, 0.9, 0.4), 4, 2_000
#: Labels of a file of the packed table.
LAYOUT = 200_000


class _Packed:
    """EM over a table of packed items, the parameters as arrays: competence by annotator, guesses by annotator and class."""

    def __init__(self, usable: DataFrame, item: list[str], k: int, annotators: list, sizes: np.ndarray) -> None:
        self.k, self.item, self.sizes = k, item, sizes
        spark, kind = usable.sparkSession, usable.schema["_a"].dataType.simpleString()
        index = F.broadcast(spark.createDataFrame(list(zip(annotators, range(len(annotators)))), f"_a {kind}, _i int"))
        parts = max(1, math.ceil(int(sizes.sum()) / LAYOUT))
        coded = usable.join(index, "_a").select(*item, (F.col("_i") * k + F.col("_v")).alias("_code"))
        self.table = written(coded.repartition(parts, *item).groupBy(*item).agg(F.array_sort(F.collect_list("_code")).alias("_codes")), "labels")

    def start(self, competence: float):
        n = len(self.sizes)
        return np.full(n, competence), np.full((n, self.k), 1.0 / self.k), np.full(self.k, 1.0 / self.k), -math.inf

    @staticmethod
    def expected(codes: np.ndarray, first: np.ndarray, k: int, state) -> tuple[np.ndarray, np.ndarray, float]:
        """Posteriors of the items, the probability of each label to be truthful, and the likelihood; ``first`` has each item's first label."""
        competence, guesses, prior, _ = state
        a, v = codes // k, codes % k
        guess = (1 - competence[a]) * guesses[a, v]
        low, gain = np.log(guess), np.log1p(competence[a] / guess)
        z = np.stack([np.add.reduceat(low + np.where(v == t, gain, 0.0), first) + math.log(prior[t]) for t in range(k)], 1)
        top = z.max(1, keepdims=True)
        p = np.exp(z - top)
        total = p.sum(1, keepdims=True)
        p /= total
        of = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(codes)]))
        return p, p[of, v] * competence[a] / (competence[a] + guess), float((top + np.log(total)).sum())

    def step(self, states: list) -> list:
        k, n = self.k, len(self.sizes)
        width = len(states) * (k + 1)

        def sums(batches):
            by, whole, seen = np.zeros((n, width)), np.zeros(width), np.zeros(n, bool)
            for b in batches:
                lists = b.column("_codes")
                codes = lists.flatten().to_numpy().astype(np.int64)
                if not len(codes):
                    continue
                first = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
                seen[np.unique(codes // k)] = True
                for s, state in enumerate(states):
                    p, t, likely = _Packed.expected(codes, first, k, state)
                    at = s * (k + 1)
                    by[:, at] += np.bincount(codes // k, t, n)
                    by[:, at + 1 : at + 1 + k] += np.bincount(codes, 1 - t, n * k).reshape(n, k)
                    whole[at] += likely
                    whole[at + 1 : at + 1 + k] += p.sum(0)
            ids = np.r_[np.nonzero(seen)[0], -1].astype(np.int32)
            rows = np.vstack([by[seen], whole])
            yield pa.RecordBatch.from_arrays([pa.array(ids), *[pa.array(rows[:, i]) for i in range(width)]], ["_i", *[f"x{i}" for i in range(width)]])

        part = self.table.select("_codes").mapInArrow(sums, "_i int, " + ", ".join(f"x{i} double" for i in range(width)))
        total = np.zeros((n + 1, width))
        for r in part.groupBy("_i").agg(*[F.sum(f"x{i}") for i in range(width)]).collect():
            total[r[0]] = r[1:]
        out = []
        for s in range(len(states)):
            x = total[:, s * (k + 1) : (s + 1) * (k + 1)]
            g, q = x[:-1, 1:] + GUESS, x[-1, 1:] + CLASS
            out.append(((x[:-1, 0] + TRUTHFUL) / (self.sizes + TRUTHFUL + GUESSED), g / g.sum(1, keepdims=True), q / q.sum(), float(x[-1, 0])))
        return out

    def moved(self, a, b) -> float:
        return float(np.abs(a[0] - b[0]).max(initial=0.0))

    def items(self, state, classes: Sequence[str]) -> DataFrame:
        k, item, names = self.k, self.item, np.array(classes, object)

        def run(batches):
            for b in batches:
                lists = b.column("_codes")
                codes = lists.flatten().to_numpy().astype(np.int64)
                if not len(codes):
                    continue
                first = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
                p, _, _ = _Packed.expected(codes, first, k, state)
                votes = np.diff(np.r_[first, len(codes)])
                each = np.stack([np.add.reduceat((codes % k == t).astype(np.int64), first) for t in range(k)], 1)
                pairs = votes * (votes - 1)
                agreement = (each * (each - 1)).sum(1) / np.maximum(pairs, 1)
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(c) for c in item], pa.array(names[p.argmax(1)], pa.string()), pa.array(p.max(1)), pa.array(agreement, mask=pairs == 0), pa.array(votes.astype(np.int64))],
                    [*item, "verdict", "confidence", "agreement", "votes"],
                )

        kinds = ", ".join(f"`{c}` {self.table.schema[c].dataType.simpleString()}" for c in item)
        return self.table.select(*item, "_codes").mapInArrow(run, f"{kinds}, verdict string, confidence double, agreement double, votes bigint")

    def annotators(self, state, names: list, like: DataFrame, annotator: str, classes: Sequence[str]) -> DataFrame:
        kind = like.schema["_a"].dataType.simpleString()
        rows = [(a, float(state[0][i]), *map(float, state[1][i]), int(self.sizes[i])) for i, a in enumerate(names)]
        return like.sparkSession.createDataFrame(rows, f"`{annotator}` {kind}, competence double, {', '.join(f'`guess_{c}` double' for c in classes)}, labels bigint")


class _Joined:
    """The same EM for any number of annotators, the parameters as a written table."""

    def __init__(self, usable: DataFrame, item: list[str], k: int) -> None:
        self.k, self.item, self.by_item = k, item, Window.partitionBy(*item)
        self.rows = written(usable, "labels")

    def start(self, competence: float):
        params = self.rows.select("_a").distinct().select("_a", F.lit(competence).alias("_c"), F.array(*[F.lit(1.0 / self.k)] * self.k).alias("_x"))
        return written(params, "annotators"), [1.0 / self.k] * self.k, None, -math.inf

    def expected(self, state) -> DataFrame:
        """The labels with the posterior ``_p`` of their item, its likelihood and its number of labels."""
        guess = (1 - F.col("_c")) * F.element_at("_x", F.col("_v") + 1)
        logs = [F.sum(F.log(F.when(F.col("_v") == t, F.col("_c")).otherwise(0.0) + F.col("_guess"))).over(self.by_item) + math.log(state[1][t]) for t in range(self.k)]
        rows = self.rows.join(state[0], "_a").withColumn("_guess", guess).withColumn("_l", F.array(*logs)).withColumn("_votes", F.count("*").over(self.by_item))
        rows = rows.withColumn("_m", F.array_max("_l")).withColumn("_e", F.expr("transform(_l, x -> exp(x - _m))"))
        return rows.withColumn("_z", F.expr("aggregate(_e, 0D, (s, x) -> s + x)")).withColumn("_p", F.expr("transform(_e, x -> x / _z)"))

    def _step(self, state):
        k = self.k
        rows = self.expected(state).withColumn("_t", F.element_at("_p", F.col("_v") + 1) * F.col("_c") / (F.col("_c") + F.col("_guess")))
        sums = rows.groupBy("_a").agg(
            F.count("*").alias("_n"),
            F.max("_c").alias("_before"),
            F.sum("_t").alias("_s"),
            F.sum((F.col("_m") + F.log("_z")) / F.col("_votes")).alias("_y"),
            *[F.sum(F.when(F.col("_v") == t, 1 - F.col("_t")).otherwise(0.0)).alias(f"_g{t}") for t in range(k)],
            *[F.sum(F.element_at("_p", t + 1) / F.col("_votes")).alias(f"_q{t}") for t in range(k)],
        )
        g = [F.col(f"_g{t}") + GUESS for t in range(k)]
        total = sum(g[1:], g[0])
        competence = (F.col("_s") + TRUTHFUL) / (F.col("_n") + TRUTHFUL + GUESSED)
        new = written(sums.select("_a", competence.alias("_c"), F.array(*[x / total for x in g]).alias("_x"), F.abs(competence - F.col("_before")).alias("_d"), "_y", *[f"_q{t}" for t in range(k)]), "annotators")
        r = new.agg(F.max("_d"), F.sum("_y"), *[F.sum(f"_q{t}") for t in range(k)]).first()
        q = [(v or 0.0) + CLASS for v in r[2:]]
        return new.select("_a", "_c", "_x"), [v / sum(q) for v in q], r[0] or 0.0, -math.inf if r[1] is None else r[1]

    def step(self, states: list) -> list:
        return [self._step(s) for s in states]

    def moved(self, a, b) -> float:
        return b[2]

    def items(self, state, classes: Sequence[str]) -> DataFrame:
        order = F.array(*[F.lit(c) for c in classes])
        rows = self.expected(state).groupBy(*self.item).agg(F.first("_p").alias("_p"), F.count("*").alias("votes"), F.array(*[F.count_if(F.col("_v") == t) for t in range(self.k)]).alias("_c"))
        same = F.expr("aggregate(transform(_c, n -> n * (n - 1)), 0L, (s, x) -> s + x)")
        return rows.select(
            *self.item,
            F.element_at(order, F.array_position("_p", F.array_max("_p")).cast("int")).alias("verdict"),
            F.array_max("_p").alias("confidence"),
            F.when(F.col("votes") > 1, same / (F.col("votes") * (F.col("votes") - 1))).alias("agreement"),
            "votes",
        )

    def annotators(self, state, names, like: DataFrame, annotator: str, classes: Sequence[str]) -> DataFrame:
        sizes = self.rows.groupBy("_a").agg(F.count("*").alias("labels"))
        return state[0].join(sizes, "_a").select(F.col("_a").alias(annotator), F.col("_c").alias("competence"), *[F.element_at("_x", t + 1).alias(f"guess_{c}") for t, c in enumerate(classes)], "labels")


def fitted(votes: DataFrame, item: Sequence[str], annotator: str, label: str, classes: Sequence[str], *, tolerance: float = 1e-3, broadcast_annotators: int = BROADCAST_ANNOTATORS) -> tuple[DataFrame, DataFrame]:
    """The posteriors of the items and the parameters of the annotators, from one fit.

    ``votes`` has one row an item and annotator with one of ``classes``; other labels and rows with nulls are left out. Returns
    items (item columns, ``verdict``, ``confidence``, ``agreement``, ``votes``) and annotators (annotator, ``competence``,
    ``guess_<class>``, ``labels``). ``agreement`` is the share of pairs of annotators that agree, null for a single label. Ties
    between classes go to the first of ``classes``. An empty table gives two empty results. A fit that does not converge raises.
    """
    k, item = len(classes), list(item)
    order = F.array(*[F.lit(c) for c in classes])
    usable = votes.select(*item, F.col(annotator).alias("_a"), (F.array_position(order, F.col(label)) - 1).cast("int").alias("_v")).where(
        "_v >= 0 and _a is not null and " + " and ".join(f"`{c}` is not null" for c in item)
    )
    usable = written(usable, "votes")
    few = sorted(usable.groupBy("_a").agg(F.count("*").alias("_n")).limit(broadcast_annotators + 1).collect())
    names = [r["_a"] for r in few]
    em = _Packed(usable, item, k, names, np.array([r["_n"] for r in few], np.int64)) if len(few) <= broadcast_annotators else _Joined(usable, item, k)
    states = [em.start(c) for c in STARTS]
    for n in count(1):
        if n == TRIAL + 1:
            states = [max(states, key=lambda s: s[3])]
        before, states = states, em.step(states)
        if len(states) == 1 and em.moved(before[0], states[0]) < tolerance:
            break
        if n == FAILED:
            raise RuntimeError(f"the fit has not converged after {FAILED} steps")
    return em.items(states[0], classes), em.annotators(states[0], names, usable, annotator, classes)
