"""What held when: effective order, state in force at cutoffs, adopting decisions, histories and their comparison.

The state at a cutoff is an argmax over the rows that count by then, written as a combinable maximum of structs per entity and
cutoff, so no entity's rows are gathered or sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ORDER = ("effective", "decided", "idx")


def effective_order(versions: DataFrame, key: str = "slug") -> DataFrame:
    """The place ``pos`` of each version in its rule, from 0: by effective date, date of decision, place in the file."""
    return versions.withColumn("pos", F.row_number().over(Window.partitionBy(key).orderBy(*ORDER)) - 1)


def earlier_filed(rows: DataFrame, key: str, filed: str, order: str) -> DataFrame:
    """``rows`` with how many rows of their key filed before them come ``before`` and ``after`` them in an order.

    No row meets another: two places in the order first differ at one bit, so at each bit a row's block counts the rows filed
    earlier on the bit's other side. A row is repeated once a bit of its key's number of rows.
    """
    by = Window.partitionBy(key)
    ranked = rows.withColumn("_r", F.dense_rank().over(by.orderBy(order)) - 1).withColumn("_f", F.dense_rank().over(by.orderBy(filed)))
    bits = F.greatest(F.length(F.bin(F.max("_r").over(by))), F.lit(1))
    each = ranked.withColumn("_id", F.row_number().over(by.orderBy("_f", "_r"))).withColumn("_bits", bits)
    each = each.withColumn("_bit", F.explode(F.sequence(F.lit(0), F.col("_bits") - 1)))
    each = each.withColumn("_one", F.expr("shiftright(_r, _bit) & 1")).withColumn("_block", F.expr("shiftright(shiftright(_r, _bit), 1)"))
    past = Window.partitionBy(key, "_bit", "_block").orderBy("_f").rangeBetween(Window.unboundedPreceding, -1)
    zeros, ones = [F.coalesce(F.sum(F.when(F.col("_one") == v, 1).otherwise(0)).over(past), F.lit(0)) for v in (0, 1)]
    each = each.withColumn("_z", F.when(F.col("_one") == 1, zeros).otherwise(0)).withColumn("_n", F.when(F.col("_one") == 0, ones).otherwise(0))
    kept = [c for c in rows.columns if c != key]
    return each.groupBy(key, "_id").agg(*[F.first(c).alias(c) for c in kept], F.sum("_z").alias("before"), F.sum("_n").alias("after")).drop("_id")


def year_cutoffs(versions: DataFrame, first: str = "decided") -> DataFrame:
    """The last day of every year from the first to the last dated one: a row a year."""
    years = versions.where(F.length(first) >= 4).agg(F.min(F.substring(first, 1, 4)).cast("int").alias("a"), F.max(F.substring(first, 1, 4)).cast("int").alias("b"))
    return years.where("a is not null").select(F.explode(F.sequence("a", "b")).alias("y")).select(F.format_string("%04d-12-31", "y").alias("cutoff"))


def in_force(versions: DataFrame, cutoffs: DataFrame, key: str = "slug", content: Sequence[str] = ("indfoert", "aendret", "bekraeftet"), ends: str = "ophaevet") -> DataFrame:
    """(key, cutoff, ref, adopted): the version of each rule in force at each cutoff and the decision that last changed its content.

    Of the versions that take effect and were decided by the cutoff, the last that states content or abolishes holds; an
    abolition leaves nothing, and so does a passed end date, without falling back. A confirmation is adopted by the last
    introduction or change before it unless an abolition lies between. ``cutoffs`` is a short list and is broadcast.
    """
    # one row a rule and pair of dates is left before rows meet the cutoffs, however many versions a rule has
    dated = (
        versions.where(F.col("effekt").isin(*content, ends))
        .groupBy(key, "effective", "decided")
        .agg(F.max(F.struct("idx", "effekt", "gaelder_til", "ref")).alias("s"), F.max(F.when(F.col("effekt") != "bekraeftet", F.struct("idx", "effekt", "ref"))).alias("o"))
    )
    rows = dated.join(F.broadcast(cutoffs), (F.col("effective") <= F.col("cutoff")) & (F.col("decided") <= F.col("cutoff")))
    last = [F.max(F.when(F.col(c).isNotNull(), F.struct("effective", "decided", c))).alias(c) for c in ("s", "o")]
    state = rows.groupBy(key, "cutoff").agg(*last).select(key, "cutoff", F.col("s.s").alias("s"), F.col("o.o").alias("o"))
    adopted = F.when((F.col("s.effekt") == "bekraeftet") & F.col("o").isNotNull() & (F.col("o.effekt") != ends), F.col("o.ref")).otherwise(F.col("s.ref"))
    held = (F.col("s.effekt") != ends) & (F.col("s.gaelder_til").isNull() | (F.col("s.gaelder_til") >= F.col("cutoff")))
    return state.where(held).select(key, "cutoff", F.col("s.ref").alias("ref"), adopted.alias("adopted"))


def history_changes(before: DataFrame, after: DataFrame, since: DataFrame, key: str = "slug") -> DataFrame:
    """(key, cutoff, since): states that differ between two runs at cutoffs before the first changed decision of the rule.

    ``since`` has the earliest date of a changed decision by key; without one no difference is allowed at any cutoff.
    """
    a, b = before.select(key, "cutoff", F.col("ref").alias("was")), after.select(key, "cutoff", F.col("ref").alias("now"))
    return a.join(b, [key, "cutoff"], "full").where(~F.col("was").eqNullSafe(F.col("now"))).join(since, key, "left").where("since is null or cutoff < since").select(key, "cutoff", "was", "now")


def year_ranges(years: DataFrame, key: str, year: str) -> DataFrame:
    """(key, years): consecutive years as ranges, in order, as in 2015–2017, 2019."""
    d = years.select(key, F.col(year).cast("int").alias("y")).where("y is not null").distinct()
    islands = d.withColumn("i", F.col("y") - F.row_number().over(Window.partitionBy(key).orderBy("y"))).groupBy(key, "i").agg(F.min("y").alias("a"), F.max("y").alias("b"))
    text = F.when(F.col("a") == F.col("b"), F.col("a").cast("string")).otherwise(F.concat(F.col("a").cast("string"), F.lit("–"), F.col("b").cast("string")))
    listed = F.concat_ws(", ", F.expr("transform(array_sort(collect_list(struct(a, t))), x -> x.t)"))
    return islands.withColumn("t", text).groupBy(key).agg(listed.alias("years"))
