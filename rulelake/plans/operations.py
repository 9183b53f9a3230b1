"""Queries on operations: proposed, validated, in conflict, agreed, applied, and what must hold afterwards.

What is proposed comes from the data: a judge's merge of two candidates, a subject or category in which the last snapshot differs from the
decision it is of, rules of one name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import row_hash, squeezed
from ..operators.identity import compared
from ..operators.order import few, ranked_within
from ..operators.slugs import unique_slugs
from ..operators.snapshots import last_deliveries
from ..operators.voting import last_answers
from ..sources.tables import table, written
from .base import CATEGORIES, D, V, X, decisions, query, quoted, rule_versions, versions
from .changes import _RULES, _SQ, _rules
from .names import _FORMER, _former, successors
from .problems import _P5, COMPARED
from .texts import _SLUG, slugified

_LAST = f"""last_ as (select snapshot_date, max(delivered_at) as delivered_at from decision_snapshot where snapshot_date = (select max(snapshot_date) from decision_snapshot) group by 1),
s as (select ref, max({_SQ.format('emne')}) as emne, max({_SQ.format('kategori')}) as kategori from decision_snapshot join last_ using (snapshot_date, delivered_at) group by ref)"""


def _last(spark, d, *columns: str) -> DataFrame:
    """The last delivery of the last snapshot, a row a ref, values with white space alike."""
    snap = table(spark, d, "decision_snapshot").select("snapshot_date", "delivered_at", "ref", *columns)
    last = F.broadcast(last_deliveries(snap, "snapshot_date", "delivered_at").where("_next is null").drop("_next"))  # one row
    return snap.join(last, ["snapshot_date", "delivered_at"]).groupBy("ref").agg(*[F.max(F.coalesce(squeezed(c), F.lit(""))).alias(c) for c in columns])


_OPS = f"""{D}, {_LAST}, ops as (select ref, 'rename' as op, emne as target from s union all select ref, 'move', kategori from s),
val as (select ops.ref, op, target, case when d.ref is null then 'unknown decision' when target = '' then 'no target' when op = 'rename' and target = d.emne then 'same title' when op = 'move' and target not in ({quoted(CATEGORIES)}) then 'unknown category'
  when op = 'move' and target = d.kategori then 'same category' end as error from ops left join d using (ref))"""


def _validated(spark, d) -> DataFrame:
    s = _last(spark, d, "emne", "kategori")
    ops = s.select("ref", F.explode(F.array(*[F.struct(F.lit(o).alias("op"), F.col(c).alias("target")) for o, c in (("rename", "emne"), ("move", "kategori"))])).alias("o")).select("ref", "o.*")
    own = decisions(spark, d).select("ref", "emne", "kategori", F.lit(True).alias("known"))
    move = F.col("op") == "move"
    error = (
        F.when(F.col("known").isNull(), "unknown decision")
        .when(F.col("target") == "", "no target")
        .when(~move & (F.col("target") == F.col("emne")), "same title")
        .when(move & ~F.col("target").isin(CATEGORIES), "unknown category")
        .when(move & (F.col("target") == F.col("kategori")), "same category")
    )
    return ops.join(own, "ref", "left").select("ref", "op", "target", error.alias("error"))


@query(f"with {_OPS} select * from val")
def proposed_changes(spark, d):
    """Every rename and move that the last snapshot implies for its decisions, with the reason for which it cannot be done, null if it can."""
    return _validated(spark, d)


@query(f"with {_OPS}, ok as (select * from val where error is null) select d.ref, coalesce(r.target, d.emne) as emne, coalesce(m.target, d.kategori) as kategori from d left join ok r on r.ref = d.ref and r.op = 'rename' left join ok m on m.ref = d.ref and m.op = 'move' where r.ref is not null or m.ref is not null")
def changes_applied(spark, d):
    """The decisions that a rename or a move changes, as they are afterwards."""
    ok = _validated(spark, d).where("error is null").groupBy("ref").agg(*[F.max(F.when(F.col("op") == o, F.col("target"))).alias(c) for o, c in (("rename", "_e"), ("move", "_k"))])
    return decisions(spark, d).join(ok, "ref").select("ref", F.coalesce("_e", "emne").alias("emne"), F.coalesce("_k", "kategori").alias("kategori"))


_MERGES = r"""a as (select doc_id, judge, output from judge_output where doc_id is not null and judge is not null qualify row_number() over (partition by doc_id, judge order by received_at desc nulls last) = 1),
e as (select doc_id, judge, unnest(output.candidates) as c, generate_subscripts(output.candidates, 1) as pos from a),
u as (select distinct doc_id, judge, c.candidate as candidate, c.duplicate_of as dup from e where c.candidate >= 1 and regexp_replace(lower(c.verdict), '[\s\p{Z}\p{P}\p{S}\x{85}]+', '', 'g') = 'merge'),
known as (select distinct doc_id, c.candidate as dup from e where c.candidate >= 1),
mg as (select u.*, case when u.dup is null then 'a merge needs two' when u.dup = candidate then 'with itself' when known.dup is null then 'unknown candidate' end as error from u left join known on known.doc_id = u.doc_id and known.dup = u.dup)"""


def _merges(spark, d) -> DataFrame:
    answers = last_answers(table(spark, d, "judge_output").select("doc_id", "judge", "received_at", "output"), ["doc_id"], "judge", "received_at", "output")
    each = answers.select("doc_id", "judge", F.explode("output.candidates").alias("c")).where("c.candidate >= 1").select("doc_id", "judge", "c.candidate", F.col("c.duplicate_of").alias("dup"), F.regexp_replace(F.lower("c.verdict"), r"[\s\p{Z}\p{P}\p{S}\x{85}]+", "").alias("v"))
    known = each.select("doc_id", F.col("candidate").alias("dup")).distinct().withColumn("k", F.lit(True))
    error = F.when(F.col("dup").isNull(), "a merge needs two").when(F.col("dup") == F.col("candidate"), "with itself").when(F.col("k").isNull(), "unknown candidate")
    return each.where("v = 'merge'").select("doc_id", "judge", "candidate", "dup").distinct().join(known, ["doc_id", "dup"], "left").select("doc_id", "judge", "candidate", "dup", error.alias("error"))


@query(f"with {_MERGES} select * from mg")
def proposed_merges(spark, d):
    """Every merge of a candidate with another that a judge proposes, with the reason for which it cannot be."""
    return _merges(spark, d)


@query(f"""with {_MERGES}, ok as (select doc_id, judge, least(candidate, dup) as a, greatest(candidate, dup) as b from mg where error is null group by all), t as (select doc_id, judge, a, b, unnest([a, b]) as c from ok),
k as (select doc_id, judge, c from t group by all having count(*) > 1) select distinct t.doc_id, t.judge, a, b from t join k on k.doc_id = t.doc_id and k.judge = t.judge and k.c = t.c""")
def merges_in_conflict(spark, d):
    """The merges of one judge that share a candidate with another of that judge's."""
    ok = _merges(spark, d).where("error is null").select("doc_id", "judge", F.least("candidate", "dup").alias("a"), F.greatest("candidate", "dup").alias("b")).distinct()
    t = ok.withColumn("c", F.explode(F.array("a", "b")))
    twice = t.groupBy("doc_id", "judge", "c").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return t.join(twice, ["doc_id", "judge", "c"]).select("doc_id", "judge", "a", "b").distinct()


@query(f"""with {_RULES}, o as (select *, row_number() over (partition by name order by versions desc, first_, slug) as i from g), sv as (select name, slug as survivor from o where i = 1)
select x.ref, x.slug as was, survivor, row_number() over (partition by survivor order by effective, decided, case when x.slug = survivor then 0 else 1 end, x.slug, idx) - 1 as place, x.slug <> survivor as alias from x join g on g.slug = x.slug join sv using (name)""")
def merged_versions(spark, d):
    """The versions of rules after those of one name are merged: their rule, their place in it in order of effect, and whether their old slug is now an alias."""
    place = F.struct((-F.col("versions")).alias("v"), "first_", "slug").alias("place")
    rules = _rules(spark, d).select("name", "slug", place)
    of = rules.select("name", "slug").join(rules.groupBy("name").agg(F.min("place").alias("p")).select("name", F.col("p.slug").alias("survivor")), "name")
    moved = versions(spark, d).select("slug", "ref", "effective", "decided", "idx").join(of, "slug").withColumn("alias", F.col("slug") != F.col("survivor"))
    return ranked_within(moved, "survivor", ["effective", "decided", "alias", "slug", "idx"], "place").select("ref", F.col("slug").alias("was"), "survivor", "place", "alias")


_PARTS = f"""{X}, p as (select slug, niveau, count(*) as n, min(row(effective, decided, idx)) as first_ from x group by all), k as (select *, row_number() over (partition by slug order by n desc, first_) as i from p)"""


@query(f"""with {_PARTS}, rest as (select slug, niveau, {_SLUG.format("slug || ' ' || niveau")} as base, row_number() over (partition by {_SLUG.format("slug || ' ' || niveau")} order by slug, niveau) as r from k where i > 1),
tk as (select base, rest.slug, niveau, r + case when base in (select slug from v) then 1 else 0 end as num from rest)
select x.ref, x.slug as was, x.niveau as part, case when k.i = 1 then x.slug when num = 1 then base else base || '-' || num end as slug from x join k on k.slug = x.slug and k.niveau = x.niveau left join tk on tk.slug = x.slug and tk.niveau = x.niveau""")
def split_versions(spark, d):
    """The versions of rules after each is split by the level of its decisions: the largest part keeps the slug, the first on a tie, and the others are named anew."""
    x = versions(spark, d)
    first = F.min(F.struct("effective", "decided", "idx")).alias("f")
    parts = x.groupBy("slug", "niveau").agg(F.count("*").alias("n"), first)
    best = parts.groupBy("slug").agg(F.min(F.struct((-F.col("n")).alias("m"), "f", "niveau")).alias("b")).select("slug", F.col("b.niveau").alias("keeps"))
    parts = parts.join(best, "slug").select("slug", "niveau", (F.col("niveau") == F.col("keeps")).alias("kept"))
    new = parts.where("not kept").select(F.struct("slug", "niveau").alias("key"), slugified(F.concat_ws(" ", "slug", "niveau")).alias("base"), F.struct("slug", "niveau").alias("turn"))
    named = unique_slugs(new, rule_versions(spark, d).select("slug")).select("key.slug", "key.niveau", F.col("slug").alias("fresh"))
    of = parts.join(named, ["slug", "niveau"], "left")
    return x.select("ref", "slug", "niveau").join(of, ["slug", "niveau"]).select("ref", F.col("slug").alias("was"), F.col("niveau").alias("part"), F.when(F.col("kept"), F.col("slug")).otherwise(F.col("fresh")).alias("slug"))


@query(f"""with {V}, given as (select slug, ref, count(*) as n from rule_version where filed_at < timestamp '2020-01-01' group by all), held as (select distinct slug, ref from v)
select h.slug, count(*) filter (g.ref is null) as missing, count(*) filter (g.n > 1) as twice from held h left join given g using (slug, ref) group by h.slug having count(*) filter (g.ref is null) > 0 or count(*) filter (g.n > 1) > 0""")
def partition_problems(spark, d):
    """Rules whose versions the files of before 2020 do not partition: how many are in none, how many in several."""
    given = table(spark, d, "rule_version").where("filed_at < timestamp'2020-01-01'").groupBy("slug", "ref").agg(F.count("*").alias("n"))
    j = rule_versions(spark, d).select("slug", "ref").distinct().join(given, ["slug", "ref"], "left")
    return j.groupBy("slug").agg(F.count_if(F.col("n").isNull()).alias("missing"), F.count_if(F.col("n") > 1).alias("twice")).where("missing > 0 or twice > 0")


@query(f"""with {X}, {_LAST}, nn as (select x.*, row_number() over (partition by slug order by effective desc, decided desc, idx desc) as k from x), op as (select slug, emne, min(k) as k from nn where k <= 3 group by all),
ch as (select slug, s.emne as choice from nn left join s using (ref) where k = 1), ti as (select slug, min(titel) as current_ from x group by slug)
select ti.slug, string_agg(op.emne, ' | ' order by op.k) as options, case when bool_or(op.emne = choice) then max(choice) else current_ end as chosen, coalesce(bool_or(op.emne = choice), false) as valid
from ti join op using (slug) join ch using (slug) group by ti.slug, current_""")
def chosen_titles(spark, d):
    """The title of each rule: what the last snapshot calls its latest decision, if that is among the subjects of its last three versions, else its present title."""
    v = versions(spark, d)
    last = few(v.select("slug", F.struct("effective", "decided", "idx", "ref", "emne").alias("x")), "slug", "x", 3).select("slug", F.reverse("l").alias("l"))
    said = last.select("slug", F.array_distinct(F.col("l.emne")).alias("options"), F.col("l")[0]["ref"].alias("ref")).join(_last(spark, d, "emne").withColumnRenamed("emne", "choice"), "ref", "left")
    current = v.groupBy("slug").agg(F.min("titel").alias("current_"))
    valid = F.coalesce(F.array_contains("options", F.col("choice")), F.lit(False))
    return said.join(current, "slug").select("slug", F.concat_ws(" | ", "options").alias("options"), F.when(valid, F.col("choice")).otherwise(F.col("current_")).alias("chosen"), valid.alias("valid"))


@query(_FORMER + " select slug, dst as target from su where successor is null")
def lost_slugs(spark, d):
    """What must not be after an audit: slugs that led to a rule and lead nowhere now."""
    former, gone, live, held, living = _former(spark, d)
    return successors(former, gone, live, held, living).where("successor is null").join(former.select("slug", F.col("to").alias("target")), "slug").select("slug", "target")


@query(f"""with e as (select snapshot_date, min(delivered_at) as a, max(delivered_at) as b from decision_snapshot group by 1 having min(delivered_at) < max(delivered_at)),
s as (select snapshot_date, delivered_at, ref, max(concat_ws('|', {", ".join(f"coalesce({_SQ.format(c)}, '')" for c in COMPARED)})) as h from decision_snapshot group by all),
o as (select s.* from s join e on e.snapshot_date = s.snapshot_date and s.delivered_at = a), n as (select s.* from s join e on e.snapshot_date = s.snapshot_date and s.delivered_at = b),
f as (select coalesce(o.snapshot_date, n.snapshot_date) as snapshot_date, case when o.ref is null then 'new' when n.ref is null then 'retired' when o.h <> n.h then 'changed' end as kind from o full join n on o.snapshot_date = n.snapshot_date and o.ref = n.ref)
select snapshot_date, kind, count(*) as refs from f where kind is not null group by all""")
def delivery_conflicts(spark, d):
    """How the last delivery of a snapshot differs from its first: a stored run may be replaced only on purpose."""
    snap = table(spark, d, "decision_snapshot")
    h = F.max(F.concat_ws("|", *[F.coalesce(squeezed(F.col(c).cast("string")), F.lit("")) for c in COMPARED]))
    rows = snap.groupBy(F.struct("snapshot_date", "ref").alias("k"), "delivered_at").agg(F.xxhash64(h).alias("h"))
    ends = F.broadcast(snap.groupBy("snapshot_date").agg(F.min("delivered_at").alias("a"), F.max("delivered_at").alias("b")).where("a < b"))  # a row a snapshot
    at = rows.join(ends, F.col("k.snapshot_date") == F.col("snapshot_date"))
    return compared(at.where("delivered_at = a"), at.where("delivered_at = b"), "k", "h").groupBy("k.snapshot_date", "kind").agg(F.count("*").alias("refs"))


@query(_P5 + "select * from f where kind is not null")
def snapshots_evolved(spark, d):
    """What changed, snapshot after snapshot: each is a batch that meets the state the ones before have left, and leaves its own."""
    snap = table(spark, d, "decision_snapshot").select("snapshot_date", "delivered_at", "ref", *COMPARED)
    last = last_deliveries(snap, "snapshot_date", "delivered_at").orderBy("snapshot_date").collect()  # a row a snapshot
    live = F.broadcast(spark.createDataFrame([(r["snapshot_date"], r["delivered_at"]) for r in last], snap.select("snapshot_date", "delivered_at").schema))
    hashed = snap.join(live, ["snapshot_date", "delivered_at"]).groupBy("snapshot_date", "ref").agg(F.max(row_hash(*[squeezed(F.col(c).cast("string")) for c in COMPARED])).alias("h"))
    hashed = written(hashed.where("ref is not null"), "snapshots")
    state, out = None, None
    for r in last:
        batch = hashed.where(F.col("snapshot_date") == r["snapshot_date"]).select("ref", "h")
        if state is not None:
            found = compared(state, batch, "ref", "h").select(F.lit(r["snapshot_date"]).alias("snapshot_date"), "ref", "kind")
            out = found if out is None else out.unionByName(found)
        state = batch
    return out if out is not None else hashed.select("snapshot_date", "ref", F.lit("new").alias("kind")).limit(0)
