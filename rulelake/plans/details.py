"""Queries on selections, validation, votes, listings, labels and fingerprints."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import ascii_anchor
from ..operators.order import few, global_rank
from ..operators.snapshots import last_deliveries
from ..operators.temporal import in_force, year_cutoffs
from ..operators.voting import last_answers, majority
from ..sources.files import selected
from ..sources.tables import table
from .base import CATEGORIES, D, V, X, decisions, query, quoted, rule_versions, versions
from .history import _FORCE, _HASH, _hash
from .judging import _VOTES, votes
from .texts import MONTHS, _anchor_sql

# ---- selections and validation


@query("""with s as (select doc_id, row_number() over (order by min(received_at), doc_id) as place from judge_output where doc_id is not null group by doc_id)
select distinct place, id, title from s join doc on id = doc_id""")
def selected_documents(spark, d):
    """The documents that were judged, in the order in which they first were; every one must be in the manifest."""
    judged = table(spark, d, "judge_output").where("doc_id is not null").groupBy("doc_id").agg(F.min("received_at").alias("at"))
    ordered = global_rank(judged, [F.asc("at"), F.asc("doc_id")], "place").select("doc_id", "place")
    return selected(table(spark, d, "doc").select("id", "title").distinct(), ordered, "id", "doc_id").select("place", "id", "title")


@query("select id, title from (select distinct id, title from doc) where regexp_matches(id, '^(bst|kgr)[0-9]{2}0[1-6]20[12]')")
def documents_matching(spark, d):
    """The documents whose id fits a pattern: minutes of the board and congress from the first half of a year."""
    return table(spark, d, "doc").select("id", "title").distinct().where(F.col("id").rlike("^(bst|kgr)[0-9]{2}0[1-6]20[12]"))


@query(f"""with {V}, k as (select v.* from v join d using (ref) where udfald = 'vedtaget'), f as (select * from k qualify row_number() over (partition by ref order by kategori, slug, idx) = 1)
select slug, ref, idx from f""")
def validated_references(spark, d):
    """Versions whose decision is known and adopted, each decision in the first rule only; rules left without any drop out."""
    known = decisions(spark, d).where("udfald = 'vedtaget'").select("ref")
    first = rule_versions(spark, d).join(known, "ref").groupBy("ref").agg(F.min(F.struct("kategori", "slug", "idx")).alias("x"))
    return first.select("x.slug", "ref", "x.idx")


@query(f"""with {D}, last_ as (select max(snapshot_date) as t from decision_snapshot), s as (select distinct regexp_replace(ref, '#[^#]*$', '') as doc_id, kategori from decision_snapshot where snapshot_date = (select t from last_)),
p as (select regexp_replace(ref, '#[^#]*$', '') as doc_id, trim(kategori) as kategori, count(distinct ref) as refs from decision_snapshot where snapshot_date = (select min(snapshot_date) from decision_snapshot) group by all)
select p.doc_id, p.kategori, refs from p anti join (select doc_id, trim(kategori) as kategori from s) using (doc_id, kategori)""")
def emptied_categories(spark, d):
    """Categories of a document that had decisions in the first snapshot and have none in the last, with how many are orphaned."""
    snap = table(spark, d, "decision_snapshot").select("snapshot_date", "ref", F.regexp_replace("ref", "#[^#]*$", "").alias("doc_id"), F.trim("kategori").alias("kategori"))
    ends = F.broadcast(snap.agg(F.min("snapshot_date").alias("a"), F.max("snapshot_date").alias("b")))
    at = snap.join(ends, (F.col("snapshot_date") == F.col("a")) | (F.col("snapshot_date") == F.col("b")))
    now = at.where("snapshot_date = b").select("doc_id", "kategori").distinct()
    return at.where("snapshot_date = a").groupBy("doc_id", "kategori").agg(F.count_distinct("ref").alias("refs")).join(now, ["doc_id", "kategori"], "left_anti")


@query(f"""{_FORCE}, g as (select distinct slug, vigtig from v), e as (select slug, max(effective) as e from x where decided <= '2015-12-31' group by slug),
early as (select distinct cutoff from f join e using (slug) where cutoff <= left(e, 4) || '-12-31'), central as (select distinct cutoff from f join g using (slug) where vigtig) select cutoff from early intersect select cutoff from central""")
def covered_cutoffs(spark, d):
    """The cutoffs at which both the rules decided early and the central rules have something in force."""
    v = versions(spark, d)
    forced = in_force(v, year_cutoffs(v)).select("slug", "cutoff")
    last = v.where("decided <= '2015-12-31'").groupBy("slug").agg(F.max("effective").alias("e"))
    early = forced.join(last, "slug").where(F.col("cutoff") <= F.concat(F.substring("e", 1, 4), F.lit("-12-31"))).select("cutoff")
    return early.intersect(forced.join(v.where("vigtig").select("slug").distinct(), "slug").select("cutoff"))


# ---- votes

_TARGET = r"""with a as (select doc_id, judge, received_at, output from judge_output where doc_id is not null and judge is not null qualify row_number() over (partition by doc_id, judge order by received_at desc nulls last) = 1),
e as (select doc_id, judge, unnest(output.candidates) as c, generate_subscripts(output.candidates, 1) as pos from a),
u as (select doc_id, judge, pos, c.candidate as candidate, c.duplicate_of as dup, c.reason as reason, regexp_replace(lower(c.verdict), '[\s\p{Z}\p{P}\p{S}\x{85}]+', '', 'g') as verdict from e),
k as (select *, case when verdict = 'merge' then 'merge ' || coalesce(dup::varchar, '?') else verdict end as target from u where verdict in ('keep', 'reject', 'merge') and candidate >= 1 qualify row_number() over (partition by doc_id, candidate, judge order by pos desc) = 1),
n as (select doc_id, candidate, target, count(*) as n, min(judge) as o from k group by all), w as (select * from n where n >= 2 qualify row_number() over (partition by doc_id, candidate order by n desc, o) = 1),
r as (select k.doc_id, k.candidate, reason, count(*) as m, min(judge) as o from k join w using (doc_id, candidate, target) where reason is not null group by all),
b as (select * from r qualify row_number() over (partition by doc_id, candidate order by m desc, o) = 1)"""


@query(_TARGET + " select w.doc_id, w.candidate, target, n as votes, reason from w left join b using (doc_id, candidate)")
def majority_targets(spark, d):
    """What most judges want done with each candidate, a merge with its target, and the reason that most of them give; ties to the first judge."""
    answers = last_answers(table(spark, d, "judge_output").select("doc_id", "judge", "received_at", "output"), ["doc_id"], "judge", "received_at", "output")
    each = answers.select("doc_id", "judge", F.posexplode("output.candidates").alias("pos", "c")).select("doc_id", "judge", "pos", "c.candidate", "c.duplicate_of", "c.reason", F.regexp_replace(F.lower("c.verdict"), r"[\s\p{Z}\p{P}\p{S}\x{85}]+", "").alias("verdict"))
    usable = each.where(F.col("verdict").isin("keep", "reject", "merge") & (F.col("candidate") >= 1))
    target = F.when(F.col("verdict") == "merge", F.concat(F.lit("merge "), F.coalesce(F.col("duplicate_of").cast("string"), F.lit("?")))).otherwise(F.col("verdict"))
    last = usable.groupBy("doc_id", "candidate", "judge").agg(F.max(F.struct("pos", target.alias("target"), "reason")).alias("x")).select("doc_id", "candidate", "judge", "x.target", "x.reason")
    won = majority(last, ["doc_id", "candidate"], "target", "judge")
    said = last.where("reason is not null").join(won.select("doc_id", "candidate", "target"), ["doc_id", "candidate", "target"])
    reason = majority(said, ["doc_id", "candidate"], "reason", "judge", least=1).select("doc_id", "candidate", "reason")
    return won.join(reason, ["doc_id", "candidate"], "left").select("doc_id", "candidate", "target", "votes", "reason")


@query(_VOTES + """, gm as (select doc_id, candidate, model, verdict, count(*) as n from vote join judge using (judge) group by all),
mm as (select * from gm qualify row_number() over (partition by doc_id, candidate, model order by n desc, verdict) = 1)
select doc_id, candidate, min(verdict) as verdict from mm group by all having count(distinct model) = (select count(distinct model) from judge) and count(distinct verdict) = 1""")
def agreed_by_all_models(spark, d):
    """Candidates for which every model there is has the same verdict, the one most of its judges give."""
    judges = table(spark, d, "judge").select("judge", "model")
    v = votes(spark, d).join(F.broadcast(judges), "judge")  # a fixed table of forty
    m = majority(v, ["doc_id", "candidate", "model"], "verdict", "verdict", least=1)
    g = m.groupBy("doc_id", "candidate").agg(F.count("*").alias("models"), F.min("verdict").alias("verdict"), F.max("verdict").alias("other"))
    return g.join(F.broadcast(judges.agg(F.count_distinct("model").alias("all"))), F.col("models") == F.col("all")).where("verdict = other").select("doc_id", "candidate", "verdict")


@query("select judge, model, case when not starts_with(model, 'model-') or model = 'model-a' then true else false end as current_, coalesce(effort, '–') as effort from judge")
def judges_current(spark, d):
    """Whether a judge's answers count as made by model-a: a full name must be that of the recorded model, any other name is an alias and fits."""
    ok = ~F.col("model").startswith("model-") | (F.col("model") == "model-a")
    return table(spark, d, "judge").select("judge", "model", ok.alias("current_"), F.coalesce("effort", F.lit("–")).alias("effort"))


@query("""with p as (select user_id, event_type, sum(coalesce((props::json->>'k')::bigint, 0))::bigint as tokens, sum(value) as cost, count(*) as attempts from events group by all)
select user_id, sum(attempts)::bigint as attempts, round(sum(cost), 4) as cost, string_agg(event_type || ' ' || tokens, ', ' order by event_type) as by_model, arg_max(event_type, tokens * 1000 - length(event_type)) as answered_by
from p group by user_id""")
def usage_by_user(spark, d):
    """What each user's attempts add up to: cost, output by model (the kinds of events), and the model that wrote most."""
    k = F.coalesce(F.from_json("props", "map<string,bigint>")["k"], F.lit(0))
    p = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.sum(k).alias("tokens"), F.sum("value").alias("cost"), F.count("*").alias("attempts"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_type", "tokens"))), lambda x: F.concat_ws(" ", x["event_type"], x["tokens"].cast("string"))), ", ")
    most = F.max_by("event_type", F.col("tokens") * 1000 - F.length("event_type"))
    return p.groupBy("user_id").agg(F.sum("attempts").alias("attempts"), F.round(F.sum("cost"), 4).alias("cost"), listed.alias("by_model"), most.alias("answered_by"))


@query("""with c as (select doc_id, candidate, verdict from (%s select * from vote) group by all), g as (select doc_id, count(*) filter (verdict = 'merge') as a, count(*) filter (verdict <> 'keep') as b from c group by 1)
select doc_id, case when b = 0 then '–' else format('{:.1f}', floor(1000.0 * a / b + 0.5) / 10) || ' %%' end as merged from g""" % _VOTES)
def percentages(spark, d):
    """The share of merges among what is not kept, as shown: one decimal, a dash where there is nothing to divide by."""
    c = votes(spark, d).select("doc_id", "candidate", "verdict").distinct().groupBy("doc_id").agg(F.count_if(F.col("verdict") == "merge").alias("a"), F.count_if(F.col("verdict") != "keep").alias("b"))
    return c.select("doc_id", percent(F.col("a"), F.col("b")).alias("merged"))


def percent(a, b):
    """a of b in percent with one decimal, halves up; a dash for nothing to divide by."""
    tenths = F.floor(F.try_divide(1000.0 * a, b) + 0.5) / 10
    return F.when(tenths.isNull(), "–").otherwise(F.concat(F.format_string("%.1f", tenths), F.lit(" %")))


# ---- listings


_RULE = "rr as (select slug, min(titel) as titel, min(kategori) as kategori, bool_or(vigtig) as vigtig from x group by slug)"


@query(f"""{_FORCE}, {_RULE}, oo(kategori, n) as (values {", ".join(f"('{c}', {i})" for i, c in enumerate(CATEGORIES))}), h as (select slug from f where cutoff = '2020-12-31')
select slug, row_number() over (order by n, case when h.slug is null then 1 else 0 end, not vigtig, lower(titel), slug) as turn from rr join oo using (kategori) left join h using (slug)""")
def area_listing(spark, d):
    """The rules as area pages list them: by category in its order, what is in force first, central before minor, then by title."""
    v = versions(spark, d)
    r = v.groupBy("slug").agg(F.min("titel").alias("titel"), F.min("kategori").alias("kategori"), F.bool_or("vigtig").alias("vigtig"))
    held = in_force(v, spark.createDataFrame([("2020-12-31",)], "cutoff string")).select("slug", F.lit(0).alias("held"))
    place = F.array_position(F.array(*map(F.lit, CATEGORIES)), F.col("kategori")).alias("n")
    keyed = r.join(held, "slug", "left").select("slug", place, F.coalesce("held", F.lit(1)).alias("held"), (~F.col("vigtig")).alias("minor"), F.lower("titel").alias("t")).where("n > 0")
    return global_rank(keyed, ["n", "held", "minor", "t", "slug"]).select("slug", "turn")


@query(f"""with {X}, n as (select *, row_number() over (partition by slug order by effective desc, decided desc, idx desc) as k from x)
select slug, string_agg(coalesce(nullif(decided, ''), 'ukendt dato') || ': ' || effekt || ': ' || change, chr(10) order by k desc) as history from n where k <= 6 group by slug""")
def latest_history(spark, d):
    """The last six lines of each rule's history, the oldest first. Six are kept a task before rules are gathered."""
    line = F.concat_ws(": ", F.coalesce(F.nullif("decided", F.lit("")), F.lit("ukendt dato")), "effekt", "change")
    v = versions(spark, d).select("slug", F.struct("effective", "decided", "idx", line.alias("line")).alias("x"))
    return few(v, "slug", "x", 6).select("slug", F.array_join(F.col("l.line"), "\n").alias("history"))


@query(f"""with {X} select slug, ref, case effekt when 'indfoert' then 'indført' when 'aendret' then 'ændret' when 'bekraeftet' then 'bekræftet' when 'ophaevet' then 'ophævet' when 'foreslaaet' then 'foreslået' else effekt end as label,
 case when starts_with(lower(change), label) then coalesce(nullif(ltrim(substr(change, length(label) + 1), ' :–-'), ''), change) else change end as said, label || ': ' || said as line from x""")
def labelled_changes(spark, d):
    """The line of a version in a history: its effect and its change, without the effect's label twice."""
    label = F.coalesce(*[F.when(F.col("effekt") == e, text) for e, text in EFFECTS.items()], F.col("effekt"))
    v = versions(spark, d).select("slug", "ref", "change", label.alias("label"))
    tail = F.expr("ltrim(' :–-', substring(change, length(label) + 1))")
    said = F.when(F.lower("change").startswith(F.col("label")), F.coalesce(F.nullif(tail, F.lit("")), "change")).otherwise(F.col("change"))
    return v.withColumn("said", said).select("slug", "ref", "label", "said", F.concat_ws(": ", "label", "said").alias("line"))


#: How effects are shown.
EFFECTS = {"indfoert": "indført", "aendret": "ændret", "bekraeftet": "bekræftet", "ophaevet": "ophævet", "foreslaaet": "foreslået"}


@query(f"""{_FORCE}, oo as (select f.slug, f.cutoff, f.ref, f.adopted, a.decided as adecided, b.decided as bdecided, a.effekt as aeff, b.niveau, b.stemmer, b.gaelder_til from f join x a on a.slug = f.slug and a.ref = f.adopted join
 (select x.*, d.stemmer from x join d using (ref)) b on b.slug = f.slug and b.ref = f.ref where cutoff = '2020-12-31')
select slug, concat_ws(' · ', niveau, case when aeff = 'bekraeftet' then 'fastslået ' else 'vedtaget ' end || coalesce(nullif(adecided, ''), 'ukendt dato') || coalesce(' (' || stemmer || ')', ''),
 case when ref <> adopted then 'senest bekræftet ' || coalesce(nullif(bdecided, ''), 'ukendt dato') end, 'gælder til ' || gaelder_til) as meta from oo""")
def rule_meta(spark, d):
    """What is said of each rule in force at the end of 2020: level, when and how it was adopted or established, when last confirmed, until when it holds."""
    v = versions(spark, d)
    now = in_force(v, spark.createDataFrame([("2020-12-31",)], "cutoff string"))
    day = F.coalesce(F.nullif("decided", F.lit("")), F.lit("ukendt dato"))
    shown = v.join(decisions(spark, d).select("ref", "stemmer"), "ref").select("slug", "ref", "niveau", "stemmer", "gaelder_til", day.alias("confirmed"))
    origin = v.select("slug", F.col("ref").alias("adopted"), F.col("effekt").alias("ae"), day.alias("since"))
    j = now.join(shown, ["slug", "ref"]).join(origin, ["slug", "adopted"])
    verb = F.concat(F.when(F.col("ae") == "bekraeftet", "fastslået ").otherwise("vedtaget "), "since", F.coalesce(F.concat(F.lit(" ("), "stemmer", F.lit(")")), F.lit("")))
    parts = ["niveau", verb, F.when(F.col("ref") != F.col("adopted"), F.concat(F.lit("senest bekræftet "), "confirmed")), F.concat(F.lit("gælder til "), "gaelder_til")]
    return j.select("slug", F.concat_ws(" · ", *parts).alias("meta"))


# ---- labels and fingerprints


@query(f"with {V}, a as (select slug, {_anchor_sql('lower(slug)')} as anchor from (select distinct case when idx % 2 = 1 then translate(regexp_replace(slug, '-[0-9]+$', ''), 'aeo', 'áéó') else regexp_replace(slug, '-[0-9]+$', '') end as slug from v)) select anchor, count(*) as slugs, min(slug) as first_ from a group by anchor having count(*) > 1")
def anchor_collisions(spark, d):
    """Names of one page that would get the same anchor: here names with and without an accent."""
    plain = F.regexp_replace("slug", "-[0-9]+$", "")
    names = rule_versions(spark, d).select(F.when(F.col("idx") % 2 == 1, F.translate(plain, "aeo", "áéó")).otherwise(plain).alias("slug")).distinct()
    a = names.select("slug", ascii_anchor("slug").alias("anchor"))
    return a.groupBy("anchor").agg(F.count("*").alias("slugs"), F.min("slug").alias("first_")).where("slugs > 1")


@query(f"""with {D} select distinct dato, case when length(dato) = 10 then cast(substr(dato, 9, 2) as int) || '. ' || ([{quoted(MONTHS)}])[cast(substr(dato, 6, 2) as int)] || ' ' || left(dato, 4) else dato end as long_ from d where dato is not null""")
def long_dates(spark, d):
    """Dates as written in full; bare years pass."""
    month = F.element_at(F.array(*map(F.lit, MONTHS)), F.substring("dato", 6, 2).cast("int"))
    text = F.concat_ws(" ", F.concat(F.substring("dato", 9, 2).cast("int").cast("string"), F.lit(".")), month, F.substring("dato", 1, 4))
    return decisions(spark, d).where("dato is not null").select("dato").distinct().select("dato", F.when(F.length("dato") == 10, text).otherwise(F.col("dato")).alias("long_"))


@query(f"""with {X}, m as (select min(left(decided, 4))::int as a, greatest(max(left(decided, 4))::int, 2024) as b from x where decided <> ''), y as (select unnest(range((select a from m), (select b from m) + 1)) as y)
select y::int as year, case when y = 2024 then '2024-06-30' else y || '-12-31' end as cutoff from y""")
def covered_years(spark, d):
    """The years that pages cover, the current one included, with the day each is shown for: today, the 30th of June 2024, or the last."""
    v = versions(spark, d).where("length(decided) >= 4").agg(F.min(F.substring("decided", 1, 4)).cast("int").alias("a"), F.max(F.substring("decided", 1, 4)).cast("int").alias("b"))
    years = v.where("a is not null").select(F.explode(F.sequence("a", F.greatest("b", F.lit(2024)))).alias("year"))
    return years.select("year", F.when(F.col("year") == 2024, "2024-06-30").otherwise(F.concat(F.col("year").cast("string"), F.lit("-12-31"))).alias("cutoff"))


@query("""select judge, left(sha256('{"effort":' || coalesce('"' || effort || '"', 'null') || ',"judge":"' || judge || '","model":"' || model || '"}'), 16) as fingerprint from judge""")
def judge_fingerprints(spark, d):
    """A hash of each row as JSON with its keys in order."""
    return table(spark, d, "judge").select("judge", F.substring(F.sha2(canonical("effort", "judge", "model"), 256), 1, 16).alias("fingerprint"))


def canonical(*columns: str):
    """The columns as one JSON object, the keys in order and nulls kept."""
    return F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})


@query(f"""with {D}, o as (select id, min(organ) as organ from doc group by id)
select ref, left(sha256({_HASH} || '|' || coalesce(dato, '') || '|' || coalesce(organ, '?')), 16) as fingerprint from d left join o on id = doc_id""")
def decision_fingerprints(spark, d):
    """The hash of a decision with its date and organ, by which an incremental run sees that its input changed."""
    organ = table(spark, d, "doc").groupBy(F.col("id").alias("doc_id")).agg(F.min("organ").alias("organ"))
    wide = F.concat_ws("|", _hash(), F.coalesce("dato", F.lit("")), F.coalesce("organ", F.lit("?")))
    return decisions(spark, d).join(organ, "doc_id", "left").select("ref", F.substring(F.sha2(wide, 256), 1, 16).alias("fingerprint"))


# ---- what rule files reflect


_SETTLED = f"""with {V}, h as (select ref, {_HASH} as now from d), built as (select distinct ref, dhash from v), once as (select regexp_replace(ref, '#[^#]*$', '') as doc_id, ref, kategori from d where udfald = 'trukket'),
pend as (select kategori from v left join h using (ref) group by kategori having avg(case when now = dhash then 0.0 else 1.0 end) > 0.02)"""


@query(_SETTLED + """ select ref from h where not exists (select 1 from built b where b.ref = h.ref and b.dhash = h.now) and (ref not in (select ref from once) or (select kategori from d where d.ref = h.ref) in (select kategori from pend))""")
def unreflected_decisions(spark, d):
    """Decisions that no version was built from as they are now and that were not left out on purpose; withdrawn ones count as left out, but not in a
    category with more than 2 % of outdated versions, which is to be consolidated again.
    """
    now = decisions(spark, d).select("ref", "kategori", "udfald", _hash().alias("dhash"))
    built = rule_versions(spark, d).select("ref", "dhash").distinct()
    pending = _pending(spark, d).withColumn("pending", F.lit(True))
    open_ = now.join(built, ["ref", "dhash"], "left_anti").join(F.broadcast(pending), "kategori", "left")
    return open_.where("udfald <> 'trukket' or pending").select("ref")


def _pending(spark, d):
    """The categories that are to be consolidated again, at most as many as there are."""
    now = decisions(spark, d).select("ref", _hash().alias("now"))
    old = F.when(F.col("now") == F.col("dhash"), 0.0).otherwise(1.0)
    return rule_versions(spark, d).join(now, "ref", "left").groupBy("kategori").agg(F.avg(old).alias("outdated")).where("outdated > 0.02").select("kategori")


@query(_SETTLED + " select d.ref, d.kategori from d where ref not in (select ref from v) and ref not in (select ref from once) and kategori not in (select kategori from pend)")
def dropped_decisions(spark, d):
    """Decisions in no rule, not left out on purpose, of categories whose consolidation saw them."""
    rest = decisions(spark, d).where("udfald <> 'trukket'").join(rule_versions(spark, d), "ref", "left_anti")
    return rest.join(F.broadcast(_pending(spark, d)), "kategori", "left_anti").select("ref", "kategori")


@query(f"""with {V}, c as (select ref, slug, kategori, 0 as p from v union all select ref, null, kategori, 1 from d) select ref, slug, kategori from c qualify row_number() over (partition by ref order by p, kategori, slug) = 1""")
def decision_holders(spark, d):
    """Where each decision is held: in a rule first, else among what its category left out; the first of several holds."""
    held = rule_versions(spark, d).select("ref", F.struct(F.lit(0).alias("p"), "kategori", "slug").alias("x"))
    out = decisions(spark, d).select("ref", F.struct(F.lit(1).alias("p"), "kategori", F.lit(None).cast("string").alias("slug")).alias("x"))
    return held.unionByName(out).groupBy("ref").agg(F.min("x").alias("x")).select("ref", "x.slug", "x.kategori")


@query(f"""with {X}, b as (select slug, effekt, kategori, count(*) as n from x group by all), t as (select kategori, sum(n) as n from b group by kategori)
select kategori, effekt, sum(b.n)::bigint as versions, case when t.n = 0 then '–' else format('{{:.1f}}', floor(1000.0 * sum(b.n) / t.n + 0.5) / 10) || ' %' end as share from b join t using (kategori) group by kategori, effekt, t.n""")
def report_figures(spark, d):
    """The figures of a report: versions by category and effect with their share of the category."""
    b = versions(spark, d).groupBy("kategori", "effekt").agg(F.count("*").alias("versions"))
    t = b.groupBy("kategori").agg(F.sum("versions").alias("n"))
    return b.join(t, "kategori").select("kategori", "effekt", "versions", percent(F.col("versions"), F.col("n")).alias("share"))


@query(f"""with {V}, last_ as (select snapshot_date, max(delivered_at) as delivered_at from decision_snapshot where snapshot_date = (select max(snapshot_date) from decision_snapshot) group by 1),
s as (select ref, max(trim(niveau)) as niveau, max(trim(emne)) as emne, max(trim(kategori)) as kategori from decision_snapshot join last_ using (snapshot_date, delivered_at) group by ref)
select ref, d.niveau is distinct from s.niveau as niveau_changed, d.kategori is distinct from s.kategori as kategori_changed, d.emne is distinct from s.emne as emne_changed from d join s using (ref)
 where d.niveau is distinct from s.niveau or d.kategori is distinct from s.kategori""")
def forbidden_changes(spark, d):
    """What a rewrite of texts alone may not have touched: decisions whose level or category differs from the last snapshot, beside their subject."""
    snap = table(spark, d, "decision_snapshot").select("snapshot_date", "delivered_at", "ref", "niveau", "emne", "kategori")
    last = F.broadcast(last_deliveries(snap, "snapshot_date", "delivered_at").where("_next is null").drop("_next"))  # one row
    s = snap.join(last, ["snapshot_date", "delivered_at"]).groupBy("ref").agg(*[F.max(F.trim(c)).alias(f"s_{c}") for c in ("niveau", "emne", "kategori")])
    j = decisions(spark, d).join(s, "ref")
    differs = [(~F.col(c).eqNullSafe(F.col(f"s_{c}"))).alias(f"{c}_changed") for c in ("niveau", "kategori", "emne")]
    return j.select("ref", *differs).where("niveau_changed or kategori_changed")

