"""Queries that score one grouping of decisions into rules against another, taken as the key.

The key is the rules as filed before 2016 with their adopted decisions as events. What is scored groups the decisions that are live in the last snapshot by subject, or by the
title of their rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.temporal import in_force, year_cutoffs
from ..sources.tables import table, written
from .base import X, query, versions
from .history import _CUT, _state
from .texts import _SLUG, slugified


def _key(by: str) -> str:
    return f"""{X}, {_CUT}, fl as (select slug, ref, min(filed_at) as f from rule_version group by all), livg as (select distinct ref from decision_snapshot where snapshot_date = (select max(snapshot_date) from decision_snapshot)),
xk as (select x.* from x join fl using (slug, ref) where f < '2016-01-01'), ev as (select distinct slug as rule, ref from xk where udfald = 'vedtaget'),
pn as (select distinct on (ref) ref, {_SLUG.format(by)} as name from x where ref in (select ref from livg) order by ref, slug), xp as (select x.* exclude (slug), name as slug from x join pn using (ref) qualify row_number() over (partition by ref order by x.slug) = 1),
hc as (select rule, name, count(*) as n from ev join pn using (ref) group by all), ho as (select rule, name as home from hc qualify row_number() over (partition by rule order by n desc, name) = 1),
{_state('xk', 'k')}, {_state('xp', 'p')},
yr as (select ho.rule, c.cutoff, kf.ref as kref, kf.adopted as kad, pf.ref as pref, pf.adopted as pad from ho cross join c left join kf on kf.slug = ho.rule and kf.cutoff = c.cutoff left join pf on pf.slug = ho.home and pf.cutoff = c.cutoff where c.cutoff < '2016-01-01'),
ys as (select rule, count(*) as years, count(*) filter (kref is not distinct from pref) as same_event, count(*) filter (kad is not distinct from pad) as same_content from yr group by rule),
es as (select ev.rule, home, count(*) as events, count(*) filter (pn.name = home) as found, count(*) filter (pn.name <> home) as elsewhere, count(*) filter (pn.name is null) as missing, count(distinct pn.name) as rules from ev left join ho using (rule) left join pn on pn.ref = ev.ref group by all),
ex as (select ho.rule, count(*) as extra from ho join pn on pn.name = ho.home left join ev on ev.rule = ho.rule and ev.ref = pn.ref where ev.ref is null group by all),
sc as (select es.*, coalesce(extra, 0) as extra, coalesce(years, 0) as years, coalesce(same_event, 0) as same_event, coalesce(same_content, 0) as same_content from es left join ex using (rule) left join ys using (rule))"""


def rule_score(key: DataFrame, events: DataFrame, scored: DataFrame, held: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """How a grouping of decisions does against a key, a row a rule of the key.

    ``events`` (rule, ref) are the key's, ``held`` (name, ref) the grouping's, a decision in one group at most; ``key`` and ``scored`` are the versions of each, their rule in
    ``slug``. The group with most of a rule's events is its home, the first on a tie. Counted are events in the home, elsewhere and missing, what else the home holds, the groups that share the
    events, and at how many cutoffs the same decision, or one adopted by the same, is in force.
    """
    joined = events.join(held, "ref", "left")
    counts = joined.where("name is not null").groupBy("rule", "name").agg(F.count("*").alias("n"))
    home = counts.groupBy("rule").agg(F.min(F.struct((-F.col("n")).alias("m"), "name")).alias("x")).select("rule", F.col("x.name").alias("home"))
    own = F.col("name") == F.col("home")
    e = joined.join(home, "rule", "left").groupBy("rule", "home").agg(F.count("*").alias("events"), F.count_if(own).alias("found"), F.count_if(~own).alias("elsewhere"), F.count_if(F.col("name").isNull()).alias("missing"), F.count_distinct("name").alias("rules"))
    size = held.groupBy(F.col("name").alias("home")).agg(F.count("*").alias("size"))
    a = in_force(key, cutoffs).select(F.col("slug").alias("rule"), "cutoff", F.col("ref").alias("kr"), F.col("adopted").alias("ka"))
    b = in_force(scored, cutoffs).select(F.col("slug").alias("home"), "cutoff", F.col("ref").alias("pr"), F.col("adopted").alias("pa"))
    years = home.crossJoin(F.broadcast(cutoffs)).join(a, ["rule", "cutoff"], "left").join(b, ["home", "cutoff"], "left")
    y = years.groupBy("rule").agg(F.count("*").alias("years"), F.count_if(F.col("kr").eqNullSafe(F.col("pr"))).alias("same_event"), F.count_if(F.col("ka").eqNullSafe(F.col("pa"))).alias("same_content"))
    extra = F.coalesce(F.col("size") - F.col("found"), F.lit(0)).alias("extra")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("years", "same_event", "same_content")]
    return e.join(size, "home", "left").join(y, "rule", "left").select("rule", "home", "events", "found", "elsewhere", "missing", "rules", extra, *zero)


def _scores(spark, d, by: str) -> DataFrame:
    x = versions(spark, d)
    filed = table(spark, d, "rule_version").groupBy("slug", "ref").agg(F.min("filed_at").alias("f"))
    snap = table(spark, d, "decision_snapshot").select("snapshot_date", "ref")
    living = snap.join(F.broadcast(snap.agg(F.max("snapshot_date").alias("m"))), F.col("snapshot_date") == F.col("m")).select("ref").distinct()
    key = written(x.join(filed, ["slug", "ref"]).where("f < timestamp'2016-01-01'"), "key")
    one = x.join(living, "ref", "left_semi").groupBy("ref").agg(F.min("slug").alias("slug"))
    scored = written(x.join(one, ["slug", "ref"]).withColumn("slug", slugified(F.col(by))), "scored")
    cutoffs = year_cutoffs(x).where("cutoff < '2016-01-01'")
    events = key.where("udfald = 'vedtaget'").select(F.col("slug").alias("rule"), "ref").distinct()
    return rule_score(key, events, scored, scored.select(F.col("slug").alias("name"), "ref").distinct(), cutoffs)


@query(f"with {_key('emne')} select rule, home, events, found, elsewhere, missing, rules, extra, years, same_event, same_content from sc")
def rule_scores(spark, d):
    """Each rule of the key against the live decisions grouped by subject."""
    return _scores(spark, d, "emne")


def _sums(s: DataFrame) -> DataFrame:
    return s.agg(*[F.sum(c).alias(c) for c in ("events", "found", "missing", "years", "same_content")], F.count_if(F.col("rules") > 1).alias("fragmented"))


_SUMS = "select sum(events) as events, sum(found) as found, sum(missing) as missing, sum(years) as years, sum(same_content) as same_content, count(*) filter (rules > 1) as fragmented from sc"


@query(f"""with bf as (with {_key('emne')} {_SUMS}), af as (with {_key('titel')} {_SUMS})
select bf.fragmented::bigint as fragmented_before, af.fragmented::bigint as fragmented_after, round(bf.found / bf.events, 9) as found_before, round(af.found / af.events, 9) as found_after, round(bf.same_content / bf.years, 9) as content_before, round(af.same_content / af.years, 9) as content_after,
 af.fragmented < bf.fragmented and af.found >= bf.found and af.same_content >= bf.same_content and af.missing <= bf.missing as passes from bf, af""")
def score_gate(spark, d):
    """Whether grouping by the rule's title in place of the subject passes: fragmented rules fall, found events and years of the same content do not, no more events are missing."""
    b, a = [_sums(_scores(spark, d, c)).select(*[F.col(f).alias(f"{f}_{n}") for f in ("events", "found", "missing", "years", "same_content", "fragmented")]) for c, n in (("emne", "b"), ("titel", "a"))]
    share = [F.round(F.col(f"{f}_{n}") / F.col(f"{g}_{n}"), 9).alias(f"{k}_{w}") for f, g, k in (("found", "events", "found"), ("same_content", "years", "content")) for n, w in (("b", "before"), ("a", "after"))]
    passes = F.expr("fragmented_a < fragmented_b and found_a >= found_b and same_content_a >= same_content_b and missing_a <= missing_b")
    return b.crossJoin(F.broadcast(a)).select(F.col("fragmented_b").alias("fragmented_before"), F.col("fragmented_a").alias("fragmented_after"), *share, passes.alias("passes"))
