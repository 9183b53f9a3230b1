"""Queries on the names of rules: minted, carried over, former, and what is wrong with them.

The tables hold no register of former names; a former rule here is one of which nothing was filed since 2015, and what it decided is taken by document.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.identity import resolved
from ..operators.order import ranked_within
from ..operators.slugs import carried, successors, unique_slugs
from ..sources.tables import table, written
from .base import V, X, decisions, query, rule_versions, versions
from .texts import _SLUG, slugified


@query(f"""with {V}, t as (select slug, min(titel) as titel, min(effective) as first_ from (select v.slug, titel, coalesce(gaelder_fra, dato, '') as effective from v join d using (ref)) group by slug),
n as (select slug, {_SLUG.format('titel')} as base, first_ from t), old as (select slug from rule_version group by slug having max(filed_at) < timestamp '2012-01-01'),
g as (select base, list_sort(list(distinct k)) as tk from (select slug as base, 1 as k from old union all select regexp_replace(slug, '-[0-9]+$', ''), try_cast(regexp_extract(slug, '-([1-9][0-9]*)$', 1) as int) from old where try_cast(regexp_extract(slug, '-([1-9][0-9]*)$', 1) as int) >= 2) group by base),
r as (select n.*, row_number() over (partition by n.base order by first_, slug) as k from n), f as (select r.*, tk, k + coalesce(len(list_filter(list_transform(range(1, len(tk) + 1), lambda i: tk[i] - i), lambda y: y < k)), 0) as num from r left join g on g.base = r.base)
select slug, case when num = 1 then base else base || '-' || num end as minted from f""")
def unique_names(spark, d):
    """A name for each rule from its title, the oldest rules first: the first number that is free, none of the names of rules long gone is given again."""
    dec = decisions(spark, d).select("ref", F.coalesce("gaelder_fra", "dato", F.lit("")).alias("effective"))
    t = rule_versions(spark, d).join(dec, "ref").groupBy("slug").agg(F.min("titel").alias("titel"), F.min("effective").alias("first"))
    names = t.select(F.col("slug").alias("key"), slugified(F.col("titel")).alias("base"), F.struct("first", "slug").alias("turn"))
    gone = table(spark, d, "rule_version").groupBy("slug").agg(F.max("filed_at").alias("at")).where("at < timestamp'2012-01-01'").select("slug")
    return unique_slugs(names, gone).select(F.col("key").alias("slug"), F.col("slug").alias("minted"))


_CARRY = f"""with {V}, fl as (select slug, min(filed_at) as f from rule_version group by slug), prev as (select distinct slug, ref from v join fl using (slug) where f >= '2010-01-01' and f < '2016-01-01'), former as (select distinct slug, ref from v join fl using (slug) where f < '2010-01-01'),
nw as (select distinct kategori || ' ' || left(coalesce(dato, ''), 6) as name, ref from v join (select ref, dato from d) using (ref)), sh as (select slug, name, count(*) as n from prev join nw using (ref) group by all),
cl as (select * from sh qualify row_number() over (partition by slug order by n desc, name) = 1), he as (select name, slug as heir from cl qualify row_number() over (partition by name order by n desc, slug) = 1),
fs as (select slug, count(*) as size from former group by slug), ag as (select f.slug, name, count(*) as n from former f join nw using (ref) join fs on fs.slug = f.slug group by f.slug, name, size having 2 * count(*) > size), rv as (select name, slug as again from ag qualify row_number() over (partition by name order by n desc, slug) = 1)"""


def _carried(spark, d):
    v = rule_versions(spark, d)
    filed = table(spark, d, "rule_version").groupBy("slug").agg(F.min("filed_at").alias("f"))
    rows = v.select("slug", "ref").join(filed, "slug")
    old = rows.where("f >= timestamp'2010-01-01' and f < timestamp'2016-01-01'").select("slug", "ref")
    gone = rows.where("f < timestamp'2010-01-01'").select("slug", "ref")
    new = v.join(decisions(spark, d).select("ref", "dato"), "ref").select(F.concat_ws(" ", "kategori", F.substring(F.coalesce("dato", F.lit("")), 1, 6)).alias("name"), "ref").distinct()
    return carried(old, new, gone)


@query(_CARRY + " select name, coalesce(heir, again) as slug, case when heir is not null then 'inherited' when again is not null then 'revived' else 'minted' end as how from (select distinct name from nw) left join he using (name) left join rv using (name)")
def names_of_new_rules(spark, d):
    """The slugs that the rules of a new grouping (by category and decade) take over from the rules filed from 2010 to 2015, revive from those before, or need."""
    return _carried(spark, d)[0]


@query(_CARRY + " select p.slug, case when heir is null then 'orphaned' when heir = p.slug then 'inherited' else 'alias' end as fate, case when heir <> p.slug then heir end as \"to\" from (select distinct slug from prev) p left join cl using (slug) left join he using (name)")
def fates_of_old_slugs(spark, d):
    """What becomes of each slug of the rules filed from 2010 to 2015: inherited, an alias of the slug that its heir has, or orphaned."""
    return _carried(spark, d)[1]


_FORMER = f"""with {X}, mf as (select slug, max(filed_at) as f from rule_version group by slug), ru as (select slug, min(kategori) as category, {_SLUG.format('min(titel)')} as name from x group by slug),
live as (select ru.* from ru join mf using (slug) where f >= '2015-01-01'), fo as (select ru.*, lead(slug) over (partition by category order by slug) as nxt from ru), former as (select fo.slug, category, name, nxt as dst from fo join mf using (slug) where f < '2015-01-01'),
hd as (select distinct slug, doc_id as ref from x), livg as (select distinct regexp_replace(ref, '#[^#]*$', '') as ref from decision_snapshot where snapshot_date = (select max(snapshot_date) from decision_snapshot)),
sh as (select a.slug, b.slug as rule, count(*) as n from hd a join hd b using (ref) where a.slug in (select slug from former) and b.slug in (select slug from live) group by all),
ho as (select slug, rule as holder from sh qualify row_number() over (partition by slug order by n desc, rule) = 1), ex as (select distinct slug from hd where ref in (select ref from livg)),
nm as (select category, name, min(slug) as namesake from live group by all having count(*) = 1),
su as (select f.slug, f.dst, coalesce(holder, case when f.dst in (select slug from live) and ex.slug is null then f.dst end, namesake) as successor,
 case when holder is not null then 'holder' when f.dst in (select slug from live) and ex.slug is null then 'kept' when namesake is not null then 'namesake' else 'retired' end as reason
 from former f left join ho using (slug) left join ex on ex.slug = f.slug left join nm using (category, name))"""


def _former(spark, d):
    """Former slugs with the next slug of their category as their target, the decisions of all by document, live rules, what exists."""
    x = versions(spark, d)
    filed = table(spark, d, "rule_version").groupBy("slug").agg(F.max("filed_at").alias("f"))
    rules = x.groupBy("slug").agg(F.min("kategori").alias("category"), slugified(F.min("titel")).alias("name")).join(filed, "slug")
    held = x.select("slug", F.col("doc_id").alias("ref")).distinct()
    live = rules.where("f >= timestamp'2015-01-01'").select("slug", "category", "name")
    placed = written(ranked_within(rules.select("slug", "category", "name", "f"), "category", ["slug"], "i"), "rules")
    after = placed.select("category", (F.col("i") - 1).alias("i"), F.col("slug").alias("to"))
    former = placed.where("f < timestamp'2015-01-01'").join(after, ["category", "i"], "left").select("slug", "category", "name", "to")
    snap = table(spark, d, "decision_snapshot").select("snapshot_date", "ref")
    last = F.broadcast(snap.agg(F.max("snapshot_date").alias("last")))
    living = snap.join(last, F.col("snapshot_date") == F.col("last")).select(F.regexp_replace("ref", "#[^#]*$", "").alias("ref")).distinct()
    gone = held.join(former.select("slug"), "slug", "left_semi")
    return former, gone, live, held.join(live.select("slug"), "slug", "left_semi"), living


@query(_FORMER + " select slug, successor, reason from su")
def slug_successors(spark, d):
    """Where the links of each former rule lead now, and why."""
    return successors(*_former(spark, d))


@query(_FORMER + """, bad as (select slug, dst, reason, successor from su where (reason = 'holder' and dst is distinct from successor) or (reason <> 'holder' and dst is not null and reason <> 'kept' and dst is distinct from successor and slug in (select slug from ex)))
select slug, case when reason = 'holder' then 'another rule holds most of its decisions' else 'its target holds none of its decisions' end as problem, successor from bad
union all select slug, 'its target is no rule', null from su where dst is not null and dst not in (select slug from live)""")
def former_slug_problems(spark, d):
    """Former slugs whose target is not the rule that holds most of their decisions, holds none of them while some exist, or is no live rule."""
    former, gone, live, held, living = _former(spark, d)
    s = written(former.select("slug", "to").join(successors(former, gone, live, held, living), "slug"), "successors")
    exists = gone.join(living, "ref", "left_semi").select("slug").distinct().withColumn("e", F.lit(True))
    other = ~F.col("to").eqNullSafe(F.col("successor"))
    j = s.join(exists, "slug", "left")
    holder = F.col("reason") == "holder"
    bad = j.where((holder & other) | (~holder & F.col("to").isNotNull() & (F.col("reason") != "kept") & other & F.col("e").isNotNull()))
    one = bad.select("slug", F.when(holder, "another rule holds most of its decisions").otherwise("its target holds none of its decisions").alias("problem"), "successor")
    lost = s.where("to is not null").join(live.select(F.col("slug").alias("to")), "to", "left_anti")
    return one.unionByName(lost.select("slug", F.lit("its target is no rule").alias("problem"), F.lit(None).cast("string").alias("successor")))


@query(f"""with {V}, f as (select min(snapshot_date) as a, max(snapshot_date) as b from decision_snapshot), ret as (select distinct ref from decision_snapshot where snapshot_date = (select a from f) and ref not in (select ref from decision_snapshot where snapshot_date = (select b from f))),
old as (select slug from rule_version group by slug having max(filed_at) < timestamp '2015-01-01'), re as (select distinct regexp_replace(slug, '-[0-9]+$', '') as slug from v)
select 'id in use and retired' as problem, ref as subject from d where ref in (select ref from ret) union all select 'base of a former slug is held by a rule', slug from old where slug in (select slug from re)
union all select 'slug of several titles', slug from v group by slug having count(distinct titel) > 1 union all select 'version of a retired decision', slug || ' ' || ref from v where ref in (select ref from ret)""")
def register_problems(spark, d):
    """Ids in use and retired at once, versions of retired decisions, former slugs that rules hold again, slugs of several titles."""
    snap = table(spark, d, "decision_snapshot").select("snapshot_date", "ref").distinct()
    ends = F.broadcast(snap.agg(F.min("snapshot_date").alias("a"), F.max("snapshot_date").alias("b")))
    at = snap.join(ends, F.lit(True))
    retired = at.where("snapshot_date = a").select("ref").join(at.where("snapshot_date = b").select("ref"), "ref", "left_anti")
    v = rule_versions(spark, d)
    old = table(spark, d, "rule_version").groupBy("slug").agg(F.max("filed_at").alias("f")).where("f < timestamp'2015-01-01'")
    bases = v.select(F.regexp_replace("slug", "-[0-9]+$", "").alias("slug")).distinct()
    found = [
        (decisions(spark, d).join(retired, "ref", "left_semi"), "id in use and retired", F.col("ref")),
        (old.join(bases, "slug", "left_semi"), "base of a former slug is held by a rule", F.col("slug")),
        (v.groupBy("slug").agg(F.count_distinct("titel").alias("n")).where("n > 1"), "slug of several titles", F.col("slug")),
        (v.join(retired, "ref", "left_semi"), "version of a retired decision", F.concat_ws(" ", "slug", "ref")),
    ]
    parts = [df.select(F.lit(p).alias("problem"), s.alias("subject")) for df, p, s in found]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query(_FORMER.replace("with ", "with recursive ", 1) + """, walk as (select slug as src, dst, 1 as hops from former where dst is not null union all select walk.src, f.dst, hops + 1 from walk join former f on f.slug = walk.dst where f.dst is not null)
select src, arg_max(dst, hops) as target from walk group by src""")
def alias_chains(spark, d):
    """Where the targets of former slugs lead in the end, over targets that are former slugs themselves."""
    former = _former(spark, d)[0]
    return resolved(former.select(F.col("slug").alias("src"), F.col("to").alias("dst")))
