"""The general training-data problems over the test tables: 2 (history), 5 (snapshots), 6 (intervals)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import squeezed
from ..operators.history import merge_type2, type2_versions
from ..operators.intervals import periods_and_gaps
from ..operators.snapshots import snapshot_changes
from ..sources.tables import table, written

COMPARED = ["emne", "kategori", "udfald", "handling", "niveau", "tekst", "gaelder_fra", "gaelder_til"]


def rule_wordings(spark: SparkSession, d: str) -> DataFrame:
    """Adopted versions of rules as rows of a history: slug, start, order, hash of the wording, ref.

    Texts are hashed before any shuffle; only hashes travel.
    """
    version = table(spark, d, "rule_version").select("slug", "ref", "idx", "effekt", F.xxhash64(squeezed("tekst")).alias("own"), F.col("tekst").isNull().alias("lent")).distinct()
    decision = (
        table(spark, d, "decision")
        .where("udfald = 'vedtaget' and coalesce(gaelder_fra, dato) is not null")
        .select("ref", F.coalesce("gaelder_fra", "dato").alias("start"), F.coalesce("dato", F.lit("")).alias("dato"), F.when(F.col("tekst").isNotNull(), F.xxhash64(squeezed("tekst"))).alias("words"))
        .distinct()
    )
    wording = F.when(F.col("effekt") == "ophaevet", F.lit(None)).when(F.col("lent"), F.col("words")).otherwise(F.col("own"))
    return version.join(decision, "ref").select("slug", "ref", "start", "dato", "idx", wording.alias("wording"))


WORDING = (["slug"], "start", ["dato", "idx"], "wording", ["ref"])


def _filed(spark: SparkSession, d: str) -> DataFrame:
    """The wordings with the year in which each version was first filed, null times as the earliest."""
    filed = table(spark, d, "rule_version").groupBy("slug", "ref").agg(F.min(F.coalesce(F.year("filed_at"), F.lit(0))).alias("year"))
    return rule_wordings(spark, d).join(filed, ["slug", "ref"])


def _history(spark: SparkSession, d: str) -> DataFrame:
    """The dimension of wordings: what was filed before the last three years of filing, with their batch merged in."""
    rows = written(_filed(spark, d), "wordings")
    last = F.broadcast(rows.agg(F.max("year").alias("last")))  # one row
    rows = rows.join(last, F.lit(True))
    dimension = merge_type2(None, rows.where("year < last - 2"), *WORDING)
    return merge_type2(dimension, rows.where("year >= last - 2"), *WORDING)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return type2_versions(_history(spark, d), ["slug"], "wording")


def p2_wordings(spark: SparkSession, d: str) -> DataFrame:
    """The periods with the words themselves, the text fetched by the version that opened the period."""
    periods = type2_versions(_history(spark, d), ["slug"], "wording", ["ref"])
    version = table(spark, d, "rule_version").select("slug", "ref", squeezed("tekst").alias("own")).distinct()
    decision = table(spark, d, "decision").select("ref", squeezed("tekst").alias("lent")).distinct()
    return periods.join(version, ["slug", "ref"]).join(decision, "ref").select("slug", "valid_from", "valid_to", F.coalesce("own", "lent").alias("tekst"))


def p2_merged(spark: SparkSession, d: str) -> DataFrame:
    """The same periods from batches by the decade of filing, each merged into the dimension of those before it, the latest decade first: late batches throughout."""
    rows = written(_filed(spark, d), "wordings")
    dimension = None
    for low, high in ((2020, 10_000), (2010, 2020), (0, 2010)):
        dimension = written(merge_type2(dimension, rows.where(F.col("year").between(low, high - 1)), *WORDING), "dimension")
    return type2_versions(dimension, ["slug"], "wording")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return snapshot_changes(table(spark, d, "decision_snapshot"), "snapshot_date", "delivered_at", ["ref"], COMPARED)


#: Numbers of a document's refs that are one block of its work.
BLOCK = 1000


def p5_work_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Per document and date the refs that are new, changed and retired, as a work queue; refs are joined by blanks, those of a thousand numbers a row.

    ``ref`` is ``doc_id#n``, so the document needs no join, and block ``n / 1000`` bounds a row however large the document is.
    """
    number = F.expr("try_cast(substring_index(ref, '#', -1) as bigint)")
    found = p5_found(spark, d).select("snapshot_date", "kind", "ref", F.regexp_replace("ref", "#[^#]*$", "").alias("doc_id"), F.floor(F.coalesce(number, F.lit(0)) / BLOCK).alias("block"))
    kinds = [F.concat_ws(" ", F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.col("ref"))))).alias(k) for k in ("new", "changed", "retired")]
    return found.groupBy("snapshot_date", "doc_id", "block").agg(*kinds)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    version = table(spark, d, "rule_version").where("effekt <> 'ophaevet'").select("slug", "ref")
    decision = table(spark, d, "decision").where("udfald = 'vedtaget' and gaelder_fra is not null").select("ref", "gaelder_fra", "gaelder_til").distinct()
    return periods_and_gaps(version.join(decision, "ref"), ["slug"], "gaelder_fra", "gaelder_til")


QUERIES = {f.__name__: f for f in (p2_found, p2_wordings, p2_merged, p5_found, p5_work_blocks, p6_found)}

_SQUEEZE = r"trim(regexp_replace({0}, '[\s\x0b\x{{85}}\x{{1c}}-\x{{1f}}\p{{Z}}]+', ' ', 'g'))"
_P2 = rf"""
d as (select distinct ref, udfald, coalesce(gaelder_fra, dato) as start_, coalesce(dato, '') as dato, tekst from decision where udfald = 'vedtaget'),
v as (select distinct slug, v.ref, idx, start_, d.dato, case when effekt = 'ophaevet' then null else {_SQUEEZE.format("coalesce(v.tekst, d.tekst)")} end as w
      from rule_version v join d using (ref) where start_ is not null),
s as (select *, row_number() over (partition by slug, start_ order by dato desc, idx desc) as n from v),
l as (select *, lag(w) over t as b, row_number() over t as i from s where n = 1 window t as (partition by slug order by start_)),
c as (select *, lead(start_) over (partition by slug order by start_) as e from l where i = 1 or w is distinct from b)
"""
_P2_FOUND = f"with {_P2} select slug, start_ as valid_from, coalesce(e, '9999-12-31') as valid_to from c where w is not null"
_P5 = rf"""
with s as (select snapshot_date as t, delivered_at, ref, {", ".join(f"coalesce({_SQUEEZE.format(c)}, '') as {c}" for c in COMPARED)} from decision_snapshot),
last_ as (select t, max(delivered_at) as delivered_at from s group by t),
order_ as (select t, lead(t) over (order by t) as n, delivered_at from last_),
r as (select distinct s.* exclude (delivered_at), n from s join order_ using (t, delivered_at)),
a as (select * from r where t > (select min(t) from r)),
b as (select * from r where n is not null),
f as (select coalesce(a.t, b.n) as snapshot_date, coalesce(a.ref, b.ref) as ref,
        case when b.ref is null then 'new' when a.ref is null then 'retired' when ({", ".join(f"a.{c}" for c in COMPARED)}) <> ({", ".join(f"b.{c}" for c in COMPARED)}) then 'changed' end as kind
      from a full join b on a.t = b.n and a.ref = b.ref)
"""
SQL = {
    "p2_found": _P2_FOUND,
    "p2_merged": _P2_FOUND,
    "p2_wordings": f"with {_P2} select slug, start_ as valid_from, coalesce(e, '9999-12-31') as valid_to, w as tekst from c where w is not null",
    "p5_found": _P5 + "select * from f where kind is not null",
    "p5_work_blocks": _P5
    + """select snapshot_date, regexp_replace(ref, '#[^#]*$', '') as doc_id, coalesce(try_cast(regexp_extract(ref, '#([0-9]+)$', 1) as bigint), 0) // 1000 as block,
      coalesce(string_agg(ref, ' ' order by ref) filter (kind = 'new'), '') as "new", coalesce(string_agg(ref, ' ' order by ref) filter (kind = 'changed'), '') as changed,
      coalesce(string_agg(ref, ' ' order by ref) filter (kind = 'retired'), '') as retired from f where kind is not null group by all""",
    "p6_found": """
with i as (select distinct slug, try_cast(gaelder_fra as date) as f, try_cast(coalesce(gaelder_til, '9999-12-31') as date) as t
           from rule_version join decision using (ref) where effekt <> 'ophaevet' and udfald = 'vedtaget' and gaelder_fra is not null),
r as (select *, max(t) over (partition by slug order by f, t rows between unbounded preceding and 1 preceding) as reach from i where t >= f),
g as (select *, sum(case when reach is null or f - reach > 1 then 1 else 0 end) over (partition by slug order by f, t rows unbounded preceding) as k from r),
p as (select slug, k, min(f) as f, max(t) as t from g group by slug, k),
q as (select *, lag(t) over (partition by slug order by k) as b from p)
select slug, 'period' as kind, cast(f as varchar) as fra, cast(t as varchar) as til from q
union all select slug, 'gap', cast(cast(b + interval 1 day as date) as varchar), cast(cast(f - interval 1 day as date) as varchar) from q where b is not null""",
}
