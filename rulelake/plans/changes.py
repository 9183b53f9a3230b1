"""Queries on identity, rewrites of rules, incremental work and views."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.text import row_hash, squeezed, words
from ..operators.identity import compared, holders, run_lengths
from ..operators.order import few, global_rank
from ..operators.quotes import jaccard, one_to_one, trigrams
from ..operators.snapshots import last_deliveries
from ..operators.temporal import ORDER, earlier_filed
from ..sources.tables import table, written
from .base import CONTENT, D, V, X, decisions, query, rule_versions, versions
from .texts import _SLUG, slugified

_RULES = f"""{X}, ru as (select slug, min(titel) as titel, min(kategori) as kategori, bool_or(vigtig) as vigtig, count(*) as versions, min(effective) as first_ from x group by slug),
g as (select *, {_SLUG.format('titel')} as name from ru)"""


def _rules(spark, d):
    r = versions(spark, d).groupBy("slug").agg(F.min("titel").alias("titel"), F.min("kategori").alias("kategori"), F.bool_or("vigtig").alias("vigtig"), F.count("*").alias("versions"), F.min("effective").alias("first_"))
    return r.withColumn("name", slugified(F.col("titel")))


@query(f"""with {_RULES}, o as (select *, row_number() over (partition by name order by versions desc, first_, slug) as i from g),
nt as (select name, note, min(i) as i from o join (select distinct slug, note from v where note <> '') using (slug) group by all), ns as (select name, string_agg(note, ' ' order by i, note) as notes from nt group by name),
tt as (select name, titel, min(i) as i from o group by all), ts as (select name, string_agg(titel, ' / ' order by i) as titles from tt group by name)
select name, slug as survivor, merged, versions, vigtig, titles, notes from (select name, count(*) as merged, sum(versions)::bigint as versions, bool_or(vigtig) as vigtig from o group by name having count(*) > 1)
join (select name, slug from o where i = 1) using (name) join ts using (name) left join ns using (name)""")
def rules_merged_by_name(spark, d):
    """Rules merged by their whole name: the survivor has the most versions, then is oldest, then first; the distinct titles and notes of all are joined in that order."""
    place = F.struct((-F.col("versions")).alias("v"), "first_", "slug").alias("place")
    o = _rules(spark, d).select("name", "slug", "titel", "versions", "vigtig", place)
    g = o.groupBy("name").agg(F.min("place").alias("p"), F.count("*").alias("merged"), F.sum("versions").alias("versions"), F.bool_or("vigtig").alias("vigtig")).where("merged > 1")

    def joined(rows, what: str, by: str, name: str):
        distinct = rows.groupBy("name", what).agg(F.min("place").alias("place")).groupBy("name").agg(F.array_sort(F.collect_list(F.struct("place", what))).alias("l"))
        return distinct.select("name", F.concat_ws(by, F.col(f"l.{what}")).alias(name))

    notes = rule_versions(spark, d).where("note <> ''").select("slug", "note").distinct().join(o, "slug")
    both = g.join(joined(o, "titel", " / ", "titles"), "name").join(joined(notes, "note", " ", "notes"), "name", "left")
    return both.select("name", F.col("p.slug").alias("survivor"), "merged", "versions", "vigtig", "titles", "notes")


@query(f"with {X}, c as (select doc_id, slug, count(*) as shared from x group by all) select doc_id, slug, shared from c qualify row_number() over (partition by doc_id order by shared desc, slug) = 1")
def holder_rules(spark, d):
    return holders(versions(spark, d).select("doc_id", "slug"), "doc_id", "slug")


@query(f"""with {X}, c as (select kategori || ' ' || left(decided, 4) as old, slug, count(*) as shared from x group by all), b as (select * from c qualify row_number() over (partition by old order by shared desc, slug) = 1)
select slug, arg_min(old, (-shared * 100000000 + rn)) as inherits, count(*) - 1 as aliases from (select *, row_number() over (order by old) as rn from b) group by slug""")
def carried_slugs(spark, d):
    """Old groups pass to the rule that holds most of their decisions; of several the largest claim is inherited, the others become aliases."""
    v = versions(spark, d).select(F.concat_ws(" ", "kategori", F.substring("decided", 1, 4)).alias("old"), "slug")
    b = holders(v, "old", "slug")
    return b.groupBy("slug").agg(F.min(F.struct((-F.col("shared")).alias("n"), "old")).alias("x"), (F.count("*") - 1).alias("aliases")).select("slug", F.col("x.old").alias("inherits"), "aliases")


_SQ = r"trim(regexp_replace(coalesce({0}, ''), '[\s\x0b\x{{85}}\x{{1c}}-\x{{1f}}\p{{Z}}]+', ' ', 'g'))"
_QUEUE = f"""with {D}, last_ as (select snapshot_date, max(delivered_at) as delivered_at from decision_snapshot where snapshot_date = (select max(snapshot_date) from decision_snapshot) group by 1),
s as (select distinct ref, udfald, {_SQ.format('gaelder_fra')} as f, {_SQ.format('gaelder_til')} as t from decision_snapshot join last_ using (snapshot_date, delivered_at)),
o as (select distinct ref, udfald, {_SQ.format('gaelder_fra')} as f, {_SQ.format('gaelder_til')} as t from d),
k as (select coalesce(o.ref, s.ref) as ref, case when o.ref is null then 'new' when s.ref is null then 'retired' when (trim(o.udfald), o.f, o.t) <> (trim(s.udfald), s.f, s.t) then 'changed' end as kind from o full join s on o.ref = s.ref)"""


@query(_QUEUE + " select kind, count(*) as refs from k where kind is not null group by kind")
def work_kinds(spark, d):
    return _work(spark, d).groupBy("kind").agg(F.count("*").alias("refs"))


def _work(spark, d):
    snap = table(spark, d, "decision_snapshot")
    last = snap.agg(F.max(F.struct("snapshot_date", "delivered_at")).alias("x"))
    now = snap.join(F.broadcast(last), (F.col("snapshot_date") == F.col("x.snapshot_date")) & (F.col("delivered_at") == F.col("x.delivered_at")))
    values = row_hash(squeezed("udfald"), squeezed("gaelder_fra"), squeezed("gaelder_til")).alias("h")
    return compared(decisions(spark, d).select("ref", values), now.select("ref", values).distinct(), "ref", "h")


@query(_QUEUE + """, q as (select regexp_replace(ref, '#[^#]*$', '') as doc_id, count(*) filter (kind = 'new') as new_, count(*) filter (kind = 'changed') as changed, count(*) filter (kind = 'retired') as retired from k where kind is not null group by 1),
dd as (select id, min(date) as date from doc group by id)
select doc_id, date, new_, changed, retired, row_number() over (order by date nulls last, doc_id) as turn from q left join dd on id = doc_id""")
def work_queue(spark, d):
    """The queue of documents with something new, changed or retired, in the order of their dates, the undated last."""
    q = _work(spark, d).groupBy(F.regexp_replace("ref", "#[^#]*$", "").alias("doc_id")).agg(*[F.count_if(F.col("kind") == k).alias(n) for k, n in (("new", "new_"), ("changed", "changed"), ("retired", "retired"))])
    dated = q.join(table(spark, d, "doc").groupBy(F.col("id").alias("doc_id")).agg(F.min("date").alias("date")), "doc_id", "left")
    return global_rank(dated.select("doc_id", "date", "new_", "changed", "retired"), [F.asc_nulls_last("date"), F.asc("doc_id")])


@query(_QUEUE + ", t as (select count(*) as n from o), w as (select count(*) filter (kind = 'retired') as lost, count(*) filter (kind = 'changed') as outdated from k) select lost / n as lost_share, outdated / n as outdated_share, lost / n > 0.1 or outdated / n > 0.5 as stop from w, t")
def rebuild_guard(spark, d):
    n = decisions(spark, d).select("ref").distinct().agg(F.count("*").alias("n"))
    w = _work(spark, d).agg(F.count_if(F.col("kind") == "retired").alias("lost"), F.count_if(F.col("kind") == "changed").alias("outdated")).crossJoin(F.broadcast(n))
    a, b = F.col("lost") / F.col("n"), F.col("outdated") / F.col("n")
    return w.select(a.alias("lost_share"), b.alias("outdated_share"), ((a > 0.1) | (b > 0.5)).alias("stop"))


_PLACES = f"""with {X}, fl as (select slug, ref, min(filed_at) as f from rule_version group by all), y as (select x.*, f from x join fl using (slug, ref))
select a.slug, a.ref, count(b.ref) as place, case when count(b.ref) filter (b.effective > a.effective or (b.effective = a.effective and (b.decided > a.decided or (b.decided = a.decided and b.idx > a.idx)))) > 0 then 'late' else 'last' end as kind
from y a left join y b on a.slug = b.slug and b.f < a.f and true group by all""".replace("count(b.ref) as place", "count(b.ref) filter (b.effective < a.effective or (b.effective = a.effective and (b.decided < a.decided or (b.decided = a.decided and b.idx < a.idx)))) as place")


def _placed(spark, d):
    filed = table(spark, d, "rule_version").groupBy("slug", "ref").agg(F.min("filed_at").alias("f"))
    y = versions(spark, d).join(filed, ["slug", "ref"]).select("slug", "ref", "f", F.struct(*ORDER).alias("o"))
    return earlier_filed(y, "slug", "f", "o").select("ref", "slug", "f", F.col("before").alias("place"), F.when(F.col("after") > 0, "late").otherwise("last").alias("kind"))


@query(_PLACES)
def insertion_points_all(spark, d):
    """Where each version is inserted among those of its rule filed before it, and whether that is behind the last."""
    return _placed(spark, d).select("slug", "ref", "place", "kind")


@query(f"with {V}, r as (select ref from v union select ref from d union select ref from decision_snapshot) select regexp_replace(ref, '#[^#]*$', '') as doc_id, count(*) as ids, max(try_cast(regexp_extract(ref, '#([0-9]+)$', 1) as int)) + 1 as next_number from r group by 1")
def referenced_ids(spark, d):
    """Per document every id that anything still names, and the next free number."""
    r = rule_versions(spark, d).select("ref").union(decisions(spark, d).select("ref")).union(table(spark, d, "decision_snapshot").select("ref")).distinct()
    return r.groupBy(F.regexp_replace("ref", "#[^#]*$", "").alias("doc_id")).agg(F.count("*").alias("ids"), (F.max(F.expr("try_cast(substring_index(ref, '#', -1) as int)")) + 1).alias("next_number"))


@query(f"""with {V}, u as (select d.*, {_SLUG.format('emne')} as name from d where ref not in (select ref from v)), n as (select distinct {_SLUG.format('titel')} as name from v)
select name, case when name in (select name from n) then 'update' when count(*) > 1 then 'new rule' else 'one-off' end as route, count(*) as decisions, arg_min(kategori, coalesce(dato, '') || ' ' || ref) as kategori from u group by name""")
def routed_decisions(spark, d):
    """Where decisions in no rule go: to the rule of that name, to a new rule of several decisions, or aside."""
    v = rule_versions(spark, d)
    u = decisions(spark, d).join(v, "ref", "left_anti").withColumn("name", slugified(F.col("emne")))
    names = v.select(slugified(F.col("titel")).alias("name")).distinct().withColumn("known", F.lit(True))
    g = u.groupBy("name").agg(F.count("*").alias("decisions"), F.min(F.struct(F.concat_ws(" ", F.coalesce("dato", F.lit("")), "ref").alias("o"), "kategori")).alias("x"))
    route = F.when(F.col("known"), "update").when(F.col("decisions") > 1, "new rule").otherwise("one-off")
    return g.join(names, "name", "left").select("name", route.alias("route"), "decisions", F.col("x.kategori").alias("kategori"))


@query(f"""with {X}, n as (select *, row_number() over (partition by slug order by case when effekt in ('indfoert', 'aendret', 'bekraeftet') then 1 else 0 end desc, effective desc, decided desc, idx desc) as k from x)
select slug, ref, essence, text from n where k = 1""")
def latest_contents(spark, d):
    content = F.when(F.col("effekt").isin(*CONTENT), 1).otherwise(0)
    best = versions(spark, d).groupBy("slug").agg(F.max(F.struct(content.alias("c"), "effective", "decided", "idx", "ref", "essence", "text")).alias("x"))
    return best.select("slug", "x.ref", "x.essence", "x.text")


@query(f"""with {X}, n as (select *, row_number() over (partition by slug order by effective, decided, idx) as pos from x), e as (select slug, emne, min(pos) as p from n group by all), k as (select *, row_number() over (partition by slug order by p) as i from e)
select slug, first_, last_, subjects from (select slug, min(decided) as first_, max(decided) as last_ from x group by slug) join (select slug, string_agg(emne, ' | ' order by i) as subjects from k where i <= 6 group by slug) using (slug)""")
def brief_views(spark, d):
    """First and last date and up to six subjects of each rule, in the order in which they first occur."""
    v = versions(spark, d)
    dates = v.groupBy("slug").agg(F.min("decided").alias("first_"), F.max("decided").alias("last_"))
    first = v.groupBy("slug", "emne").agg(F.min(F.struct(*ORDER)).alias("o")).select("slug", F.struct("o", "emne").alias("x"))
    return dates.join(few(first, "slug", "x", 6, last=False), "slug").select("slug", "first_", "last_", F.concat_ws(" | ", F.col("l.emne")).alias("subjects"))


@query(f"""with {X}, n as (select *, row_number() over w as pos, lag(effekt) over w as before from x window w as (partition by slug order by effective, decided, idx)),
r as (select *, sum(case when before is null or before <> effekt then 1 else 0 end) over (partition by slug order by pos) as run from n) select slug, run::bigint as run, effekt, count(*) as rows from r group by all""")
def effect_runs(spark, d):
    return run_lengths(versions(spark, d), "slug", ["effective", "decided", "idx"], "effekt")


@query(f"""with {D} select ref, concat_ws(' · ', replace(niveau, 'bestyrelsesbeslutning', 'bestyrelse'), case handling when 'bekraeftelse' then 'fastslået' else 'vedtaget' end || ' ' || coalesce(case when length(dato) = 10 then substr(dato, 9, 2) || '.' || substr(dato, 6, 2) || '.' || left(dato, 4) else dato end, 'ukendt dato'), stemmer, 'til ' || gaelder_til) as line from d where udfald = 'vedtaget'""")
def meta_lines(spark, d):
    date = F.when(F.length("dato") == 10, F.concat(F.substring("dato", 9, 2), F.lit("."), F.substring("dato", 6, 2), F.lit("."), F.substring("dato", 1, 4))).otherwise(F.coalesce("dato", F.lit("ukendt dato")))
    verb = F.when(F.col("handling") == "bekraeftelse", "fastslået").otherwise("vedtaget")
    line = F.concat_ws(" · ", F.replace("niveau", F.lit("bestyrelsesbeslutning"), F.lit("bestyrelse")), F.concat_ws(" ", verb, date), "stemmer", F.concat(F.lit("til "), F.col("gaelder_til")))
    return decisions(spark, d).where("udfald = 'vedtaget'").select("ref", line.alias("line"))


@query("""select distinct id, case organ when 'kongres' then title else organ end as label, case when url is null then path when lower(path) like '%.pdf' then url || '#page=1' else url end as link, row_number() over (order by date nulls last, id, title) as turn,
 sha256 = (select max(b.sha256) from doc b where b.id = doc.id) as same_content from (select distinct * from doc) doc""")
def document_labels(spark, d):
    doc = table(spark, d, "doc").distinct()
    top = doc.groupBy("id").agg(F.max("sha256").alias("top"))
    link = F.when(F.col("url").isNull(), F.col("path")).when(F.lower("path").endswith(".pdf"), F.concat("url", F.lit("#page=1"))).otherwise(F.col("url"))
    ranked = global_rank(doc.join(top, "id"), [F.asc_nulls_last("date"), F.asc("id"), F.asc("title")])
    return ranked.select("id", F.when(F.col("organ") == "kongres", F.col("title")).otherwise(F.col("organ")).alias("label"), link.alias("link"), "turn", (F.col("sha256") == F.col("top")).alias("same_content"))


def snapshot_pairs(snap):
    """(snapshot_date, old, new, score): decisions of each snapshot paired one to one with those of the one before, best score first.

    The score is the share of word trigrams in common; pairs must share at least one, the document and the outcome. Of several
    deliveries of a snapshot the last counts. Decisions with the same trigrams have score 1 and are paired first, by rank and without
    a join; only what is left comes together by trigrams in common.
    """
    last = F.broadcast(last_deliveries(snap, "snapshot_date", "delivered_at").withColumnsRenamed({"snapshot_date": "_at", "delivered_at": "_delivered"}))  # a row a snapshot
    live = snap.join(last, (F.col("snapshot_date") == F.col("_at")) & F.col("delivered_at").eqNullSafe(F.col("_delivered")))
    live = live.select("_at", "_next", "ref", "doc_id", F.trim("udfald").alias("udfald"), squeezed(F.concat_ws(" ", "emne", "tekst")).alias("t")).withColumn("th", F.xxhash64("t"))
    gramset = F.array_distinct(trigrams(words("t")))
    texts = live.groupBy("doc_id", "th").agg(F.min("t").alias("t")).withColumn("g", F.array_sort(gramset)).where("size(g) > 0")
    texts = written(texts.select("doc_id", "th", "t", F.xxhash64("g").alias("h")), "texts")  # a text's trigrams are hashed once for all snapshots
    rows = live.where("udfald is not null").groupBy("_at", "_next", "ref").agg(F.max(F.struct("doc_id", "udfald", "th")).alias("x"))
    rows = rows.select("_at", "_next", "ref", "x.*").join(texts.select("doc_id", "th", "h"), ["doc_id", "th"]).crossJoin(F.broadcast(last.agg(F.min("_at").alias("_first"))))
    sides = F.array(F.struct(F.when(F.col("_at") > F.col("_first"), F.col("_at")).alias("at"), F.lit(True).alias("new")), F.struct(F.col("_next").alias("at"), F.lit(False).alias("new")))
    rows = rows.withColumn("side", F.explode(sides)).where("side.at is not null").withColumns({"snapshot_date": F.col("side.at"), "is_new": F.col("side.new")})
    alike = ["snapshot_date", "doc_id", "udfald", "h"]
    ranked = rows.select(*alike, "is_new", "ref", "th").withColumn("i", F.row_number().over(Window.partitionBy(*alike, "is_new").orderBy("ref")))
    side = [F.max(F.when(F.col("is_new") == new, F.col("ref"))).alias(c) for c, new in (("old", False), ("new", True))]
    single = F.col("old").isNull() | F.col("new").isNull()
    same = written(ranked.groupBy(*alike, "i").agg(*side, F.max("th").alias("th")).select("snapshot_date", "old", "new", *[F.when(single, F.col(c)).alias(c) for c in ("doc_id", "udfald", "th")]), "same")
    open_ = texts.join(same.where(single).select("doc_id", "th").distinct(), ["doc_id", "th"], "left_semi")
    grams = written(open_.select("doc_id", "th", gramset.alias("g")).select("doc_id", "th", F.size("g").alias("n"), F.explode("g").alias("gram")), "grams")
    where = ["snapshot_date", "doc_id", "udfald"]

    def left(c: str, other: str, n: str):
        return same.where(F.col(other).isNull()).select(*where, "th", c).join(grams, ["doc_id", "th"]).select(*where, "gram", c, F.col("n").alias(n))

    shared = left("old", "new", "no").join(left("new", "old", "nn"), [*where, "gram"]).groupBy("snapshot_date", "old", "new", "no", "nn").agg(F.count("*").alias("shared"))
    scored = shared.select("snapshot_date", "old", "new", F.round(jaccard(F.col("shared"), F.col("no"), F.col("nn")), 9).alias("score")).where("score >= 0.25")
    return same.where(~single).select("snapshot_date", "old", "new", F.lit(1.0).alias("score")).unionByName(one_to_one(scored, "old", "new", "score", by=["snapshot_date"]))


@query()
def matched_decisions(spark, d):
    """Decisions of every snapshot paired one to one with those of the one before within a document, best score first."""
    return snapshot_pairs(table(spark, d, "decision_snapshot"))


@query(f"with {D} select ref, coalesce(d.organ, '?') as organ, case when d.date is not null and left(d.date, 4) <> left(coalesce(x.dato, d.date), 4) then true else false end as year_differs from d x left join (select id, min(organ) as organ, min(date) as date from doc group by id) d on d.id = x.doc_id")
def decision_origins(spark, d):
    doc = table(spark, d, "doc").groupBy("id").agg(F.min("organ").alias("organ"), F.min("date").alias("date"))
    differs = F.coalesce(F.substring("date", 1, 4) != F.substring(F.coalesce("dato", "date"), 1, 4), F.lit(False))
    return decisions(spark, d).join(doc, F.col("id") == F.col("doc_id"), "left").select("ref", F.coalesce("organ", F.lit("?")).alias("organ"), differs.alias("year_differs"))
