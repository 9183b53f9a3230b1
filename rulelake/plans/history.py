"""Queries on rules over time and on the consistency of the data."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.order import next_smaller, ranked_within
from ..operators.temporal import ORDER, effective_order, history_changes, in_force, year_cutoffs, year_ranges
from ..sources.tables import table
from .base import CATEGORIES, CONTENT, D, PROPOSAL, V, X, decisions, query, quoted, rule_versions, versions

_CUT = """c as (select printf('%04d-12-31', y) as cutoff from (select unnest(range((select min(left(decided, 4))::int from x where decided <> ''),
  (select max(left(decided, 4))::int from x where decided <> '') + 1)) as y))"""


def _state(x: str = "x", p: str = "") -> str:
    return f"""{p}r as (select slug, cutoff, ref, effekt, gaelder_til, effective, decided, idx from {x} join c on effective <= cutoff and decided <= cutoff where effekt in ('indfoert', 'aendret', 'bekraeftet', 'ophaevet')),
{p}s as (select * from {p}r qualify row_number() over (partition by slug, cutoff order by effective desc, decided desc, idx desc) = 1),
{p}o as (select * from {p}r where effekt <> 'bekraeftet' qualify row_number() over (partition by slug, cutoff order by effective desc, decided desc, idx desc) = 1),
{p}f as (select s.slug, s.cutoff, s.ref, case when s.effekt = 'bekraeftet' and o.effekt in ('indfoert', 'aendret') then o.ref else s.ref end as adopted
  from {p}s s left join {p}o o using (slug, cutoff) where s.effekt <> 'ophaevet' and (s.gaelder_til is null or s.gaelder_til >= s.cutoff))"""


_FORCE = f"with {X}, {_CUT}, {_state()}"


@query(f"with {X} select slug, ref, row_number() over (partition by slug order by effective, decided, idx) - 1 as pos, effective from x")
def effective_order_of_versions(spark, d):
    return ranked_within(versions(spark, d).select("slug", "ref", *ORDER), "slug", list(ORDER), "pos").select("slug", "ref", "pos", "effective")


def _forced(spark, d):
    v = versions(spark, d)
    return in_force(v, year_cutoffs(v))


@query(f"{_FORCE} select slug, cutoff, ref from f")
def in_force_by_year(spark, d):
    return _forced(spark, d).select("slug", "cutoff", "ref")


@query(f"{_FORCE} select slug, cutoff, ref, adopted from f where adopted <> ref")
def adopted_by_year(spark, d):
    return _forced(spark, d).where("adopted <> ref")


@query(f"{_FORCE} select cutoff, count(*) filter (vigtig) as central, count(*) filter (not vigtig) as minor from f join (select distinct slug, vigtig from v) using (slug) group by cutoff")
def rules_in_force_per_year(spark, d):
    rules = rule_versions(spark, d).select("slug", "vigtig").distinct()
    return _forced(spark, d).join(rules, "slug").groupBy("cutoff").agg(F.count_if("vigtig").alias("central"), F.count_if(~F.col("vigtig")).alias("minor"))


@query(f"with {X}, {_CUT} select slug, cutoff, count(*) as versions, max(left(decided, 4)) as last_mentioned from x join c on decided <= cutoff group by all")
def history_by_year(spark, d):
    v = versions(spark, d)
    return v.join(F.broadcast(year_cutoffs(v)), F.col("decided") <= F.col("cutoff")).groupBy("slug", "cutoff").agg(F.count("*").alias("versions"), F.max(F.substring("decided", 1, 4)).alias("last_mentioned"))


@query(f"""with {X}, n as (select *, row_number() over (partition by slug order by effective, decided, idx) - 1 as pos from x)
select left(decided, 4) as year, count(*) filter (vigtig) as central, count(*) as changes from n where (effekt not in ('bekraeftet', 'foreslaaet') or (effekt = 'bekraeftet' and pos = 0)) and decided <> '' group by 1""")
def changes_per_year(spark, d):
    news = ~F.col("effekt").isin("bekraeftet", "foreslaaet") | ((F.col("effekt") == "bekraeftet") & (F.col("pos") == 0))
    v = effective_order(versions(spark, d)).where(news & (F.col("decided") != ""))
    return v.groupBy(F.substring("decided", 1, 4).alias("year")).agg(F.count_if("vigtig").alias("central"), F.count("*").alias("changes"))


@query(f"with {X}, {_CUT} select slug, ref, cutoff, effective from x join c on decided <= cutoff and effective > cutoff where effekt in ('indfoert', 'aendret', 'bekraeftet', 'ophaevet')")
def pending_changes(spark, d):
    v = versions(spark, d)
    return v.where(F.col("effekt").isin(*CONTENT, "ophaevet")).join(F.broadcast(year_cutoffs(v)), (F.col("decided") <= F.col("cutoff")) & (F.col("effective") > F.col("cutoff"))).select("slug", "ref", "cutoff", "effective")


@query(f"""{_FORCE}, g as (select slug, max(case when effekt in ('indfoert', 'aendret', 'bekraeftet') then 1 else 0 end) as content, max(decided) as last_,
  max(case when effekt in ('indfoert', 'aendret', 'bekraeftet') and decided <= '2020-12-31' and effective > '2020-12-31' then 1 else 0 end) as coming from x where decided <= '2020-12-31' group by slug)
select slug, case when f.ref is not null then 'in force' when coming = 1 then 'upcoming' when content = 1 then 'lapsed' else 'proposals only' end as status,
  case when last_ <> '' then 2020 - cast(left(last_, 4) as int) >= 5 end as stale from g left join (select * from f where cutoff = '2020-12-31') f using (slug)""")
def rule_status(spark, d):
    v = versions(spark, d).where("decided <= '2020-12-31'")
    content = F.col("effekt").isin(*CONTENT)
    g = v.groupBy("slug").agg(F.bool_or(content).alias("content"), F.max("decided").alias("last"), F.bool_or(content & (F.col("effective") > "2020-12-31")).alias("coming"))
    now = in_force(v, spark.createDataFrame([("2020-12-31",)], "cutoff string"))
    status = F.when(F.col("ref").isNotNull(), "in force").when(F.col("coming"), "upcoming").when(F.col("content"), "lapsed").otherwise("proposals only")
    stale = F.when(F.col("last") != "", 2020 - F.substring("last", 1, 4).cast("int") >= 5)
    return g.join(now, "slug", "left").select("slug", status.alias("status"), stale.alias("stale"))


@query(f"""with {X}, {_CUT}, filed as (select slug, ref, min(filed_at) as filed_ from rule_version group by all), w as (select x.* from x join filed using (slug, ref) where filed_ < '2016-01-01'),
{_state('w', 'w')}, {_state('x', 'y')},
since as (select slug, min(decided) as since from x join filed using (slug, ref) where filed_ >= '2016-01-01' and left(filed_::varchar, 4) = left(decided, 4) group by slug)
select slug, cutoff, a.ref as was, b.ref as now from wf a full join yf b using (slug, cutoff) left join since using (slug) where a.ref is distinct from b.ref and (since is null or cutoff < since)""")
def history_violations(spark, d):
    v = versions(spark, d)
    filed = table(spark, d, "rule_version").groupBy("slug", "ref").agg(F.min("filed_at").alias("at"))
    early = filed.where("at < timestamp'2016-01-01'").select("slug", "ref")
    before = v.join(early, ["slug", "ref"])
    # a decision filed in a later year was not announced as changed: what it changes in the past is a violation
    prompt = filed.where("at >= timestamp'2016-01-01'")
    since = v.join(prompt, ["slug", "ref"]).where("left(cast(at as string), 4) = left(decided, 4)").groupBy("slug").agg(F.min("decided").alias("since"))
    cutoffs = year_cutoffs(v)
    return history_changes(in_force(before, cutoffs), in_force(v, cutoffs), since)


@query(f"""with {X}, y as (select distinct kategori, cast(left(decided, 4) as int) as y from x where decided <> ''), i as (select *, y - row_number() over (partition by kategori order by y) as i from y),
r as (select kategori, min(y) as a, max(y) as b from i group by kategori, i)
select kategori, string_agg(case when a = b then a::varchar else a || '–' || b end, ', ' order by a) as years from r group by kategori""")
def years_of_categories(spark, d):
    v = versions(spark, d).where("decided <> ''").select("kategori", F.substring("decided", 1, 4).alias("y"))
    return year_ranges(v, "kategori", "y")


# ---- consistency


@query("select id, count(*) as n from doc group by id having count(*) > 1")
def duplicate_documents(spark, d):
    return table(spark, d, "doc").groupBy("id").agg(F.count("*").alias("n")).where("n > 1")


@query(f"""with {V} select 'document listed twice' as problem, id as subject from doc group by id having count(*) > 1
union all select 'decision in several rules', ref from (select distinct slug, ref from v) group by ref having count(*) > 1
union all select 'version of no decision', slug || ' ' || ref from v where ref not in (select ref from d)
union all select 'decision of no document', ref from d where doc_id not in (select id from doc)
union all select 'rule in several categories', slug from (select distinct slug, kategori from v) group by slug having count(*) > 1
union all select 'rule without a slug', ref from v where coalesce(slug, '') = ''""")
def identity_problems(spark, d):
    v, dec, doc = rule_versions(spark, d), decisions(spark, d), table(spark, d, "doc")

    def problem(df, text, subject):
        return df.select(F.lit(text).alias("problem"), subject.alias("subject"))

    twice = [
        problem(doc.groupBy("id").count().where("count > 1"), "document listed twice", F.col("id")),
        problem(v.select("slug", "ref").distinct().groupBy("ref").count().where("count > 1"), "decision in several rules", F.col("ref")),
        problem(v.join(dec, "ref", "left_anti"), "version of no decision", F.concat_ws(" ", "slug", "ref")),
        problem(dec.join(doc, F.col("doc_id") == F.col("id"), "left_anti"), "decision of no document", F.col("ref")),
        problem(v.select("slug", "kategori").distinct().groupBy("slug").count().where("count > 1"), "rule in several categories", F.col("slug")),
        problem(v.where("coalesce(slug, '') = ''"), "rule without a slug", F.col("ref")),
    ]
    out = twice[0]
    for t in twice[1:]:
        out = out.unionByName(t)
    return out


@query(f"with {V} select ref, kategori from d where ref not in (select ref from v)")
def unassigned_decisions(spark, d):
    return decisions(spark, d).join(rule_versions(spark, d), "ref", "left_anti").select("ref", "kategori")


_MISMATCH = f"""with {X} select slug, ref, udfald, handling, effekt from x where case when udfald in ({quoted(PROPOSAL)}) then effekt <> case udfald when 'ikke_afgjort' then 'foreslaaet' else udfald end
  when handling = 'ophaevelse' then effekt not in ('ophaevet', 'aendret') else effekt not in ('indfoert', 'aendret', 'bekraeftet', 'ophaevet') end"""


@query(_MISMATCH)
def effect_mismatches(spark, d):
    expected = F.coalesce(*[F.when(F.col("udfald") == u, e) for u, e in PROPOSAL.items()])
    wrong = F.when(expected.isNotNull(), F.col("effekt") != expected).when(F.col("handling") == "ophaevelse", ~F.col("effekt").isin("ophaevet", "aendret")).otherwise(~F.col("effekt").isin(*CONTENT, "ophaevet"))
    return versions(spark, d).where(wrong).select("slug", "ref", "udfald", "handling", "effekt")


_TRAPS = f"""with {X}, n as (select *, row_number() over (partition by slug order by effective, decided, idx) as pos from x where effekt in ('indfoert', 'aendret', 'bekraeftet')),
l as (select *, lead(ref) over w as next_ref, lead(gaelder_til) over w as next_til, lead(effekt) over w as next_effekt from n window w as (partition by slug order by pos))
select slug, 'confirmed without end' as trap, ref, next_ref as other from l where gaelder_til is not null and next_ref is not null and next_til is null and next_effekt = 'bekraeftet'
union all select a.slug, 'applies from before', a.ref, min_by(b.ref, b.pos) from n a join n b on a.slug = b.slug and b.pos > a.pos and length(a.decided) = 10 and length(b.decided) = 10 and b.decided < a.decided group by all"""


@query(_TRAPS)
def date_traps(spark, d):
    n = effective_order(versions(spark, d).where(F.col("effekt").isin(*CONTENT))).select("slug", "ref", "pos", "decided", "gaelder_til", "effekt")
    w = Window.partitionBy("slug").orderBy("pos")
    nxt = n.withColumn("nx", F.lead(F.struct("ref", "gaelder_til", "effekt")).over(w))
    ends = nxt.where(F.col("gaelder_til").isNotNull() & F.col("nx").isNotNull() & F.col("nx.gaelder_til").isNull() & (F.col("nx.effekt") == "bekraeftet"))
    one = ends.select("slug", F.lit("confirmed without end").alias("trap"), "ref", F.col("nx.ref").alias("other"))
    full = n.where(F.length("decided") == 10).select("slug", "ref", "pos", "decided")
    two = next_smaller(full, "slug", "pos", "decided", "ref").select("slug", F.lit("applies from before").alias("trap"), "ref", "other")
    return one.unionByName(two)


def _hash():
    fields = ["emne", "kategori", "udfald", "handling", "niveau", "tekst", "stemmer", "forslagsstiller", "gaelder_fra", "gaelder_til"]
    one = F.array_join(F.array(*[F.when(F.col(c).isNull(), "null").otherwise(F.expr(f"substring(to_json(array({c})), 2, length(to_json(array({c}))) - 2)")) for c in fields]), ", ")
    return F.substring(F.sha2(F.concat(F.lit("["), one, F.lit("]")), 256), 1, 12)


_HASH = "left(sha256('[' || concat_ws(', ', " + ", ".join(f"coalesce(to_json({c})::varchar, 'null')" for c in ["emne", "kategori", "udfald", "handling", "niveau", "tekst", "stemmer", "forslagsstiller", "gaelder_fra", "gaelder_til"]) + ") || ']'), 12)"


@query(f"with {D} select ref, {_HASH} as dhash from d")
def decision_hashes(spark, d):
    return decisions(spark, d).select("ref", _hash().alias("dhash"))


@query(f"""with {V}, h as (select ref, {_HASH} as now from d), s as (select slug, bool_or(now is null or dhash is null or now <> dhash) as stale, count(*) as versions from v left join h using (ref) group by slug)
select slug, versions from s where stale""")
def stale_rules(spark, d):
    now = decisions(spark, d).select("ref", _hash().alias("now"))
    j = rule_versions(spark, d).join(now, "ref", "left")
    return j.groupBy("slug").agg(F.bool_or(~F.col("now").eqNullSafe(F.col("dhash")) | F.col("dhash").isNull()).alias("stale"), F.count("*").alias("versions")).where("stale").select("slug", "versions")


@query(f"""with {V}, h as (select ref, {_HASH} as now from d) select v.kategori, bool_and(coalesce(now = dhash, false)) as settled, count(*) as held, count(*) filter (coalesce(now <> dhash, true)) as outdated from v left join h using (ref) group by 1""")
def settled_categories(spark, d):
    now = decisions(spark, d).select("ref", _hash().alias("now"))
    same = F.col("now").isNotNull() & F.col("dhash").isNotNull() & (F.col("now") == F.col("dhash"))
    return rule_versions(spark, d).join(now, "ref", "left").groupBy("kategori").agg(F.bool_and(same).alias("settled"), F.count("*").alias("held"), F.count_if(~same).alias("outdated"))


@query(f"""with {D}, l as (select kategori, md5(ref || ' ' || {_HASH}) as h from d) select kategori, sum(('0x' || left(h, 15))::hugeint)::varchar || ' ' || sum(('0x' || substr(h, 16, 15))::hugeint)::varchar as digest, count(*) as decisions from l group by kategori""")
def category_digests(spark, d):
    """The fingerprint of what a category is consolidated from: the sums of two halves of its lines' hashes, which combine in any order; no list is gathered."""
    h = F.md5(F.concat_ws(" ", "ref", _hash()))
    part = [F.sum(F.conv(F.substring(h, at, 15), 16, 10).cast("decimal(38,0)")).cast("string") for at in (1, 16)]
    return decisions(spark, d).groupBy("kategori").agg(F.concat_ws(" ", *part).alias("digest"), F.count("*").alias("decisions"))


@query(f"""with {V}, h as (select ref, {_HASH} as now from d), own as (select v.ref, v.kategori from v join h on v.ref = h.ref and v.dhash = h.now),
o(kategori, n) as (values {", ".join(f"('{c}', {i})" for i, c in enumerate(CATEGORIES))}), b as (select ref, min_by(own.kategori, n) as k from own join o using (kategori) group by ref)
select ref, coalesce(b.k, d.kategori) as home from d left join b using (ref)""")
def home_categories(spark, d):
    now = decisions(spark, d).select("ref", "kategori", _hash().alias("now"))
    at = F.array_position(F.array(*map(F.lit, CATEGORIES)), F.col("kategori"))
    held = rule_versions(spark, d).select("ref", "kategori", "dhash", at.alias("n"))
    first = held.join(now.select("ref", "now"), "ref").where("dhash = now").groupBy("ref").agg(F.min(F.struct("n", "kategori")).alias("x"))
    return now.join(first, "ref", "left").select("ref", F.coalesce("x.kategori", "kategori").alias("home"))
