"""Queries on what is shown: pages, payloads, excerpts, and on operations and numbering."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.asking import answer_status, answered, fingerprinted
from ..operators.order import ranked_within
from ..operators.snapshots import last_deliveries
from ..sources.files import site_payload
from ..sources.tables import table
from .base import D, V, decisions, query, rule_versions, versions
from .history import _FORCE, _forced


@query(f"""{_FORCE} select f.slug, cutoff, '- **' || x.titel || '**: ' || replace(x.essence, '|', '\\|') || ' (' || case when length(a.decided) = 10 then substr(a.decided, 9, 2) || '.' || substr(a.decided, 6, 2) || '.' || left(a.decided, 4)
 when a.decided = '' then 'ukendt dato' else a.decided end || ')' as line from f join x on x.slug = f.slug and x.ref = f.ref join x a on a.slug = f.slug and a.ref = f.adopted""")
def year_page_lines(spark, d):
    """The line of each rule on the page of each year: title, essence and the date of the decision that adopted it."""
    v = versions(spark, d)
    shown = v.select("slug", "ref", "titel", "essence")
    day = F.when(F.length("decided") == 10, F.concat(F.substring("decided", 9, 2), F.lit("."), F.substring("decided", 6, 2), F.lit("."), F.substring("decided", 1, 4))).when(F.col("decided") == "", "ukendt dato").otherwise(F.col("decided"))
    origin = v.select("slug", F.col("ref").alias("adopted"), day.alias("day"))
    line = F.concat(F.lit("- **"), "titel", F.lit("**: "), F.replace("essence", F.lit("|"), F.lit("\\|")), F.lit(" ("), "day", F.lit(")"))
    return _forced(spark, d).join(shown, ["slug", "ref"]).join(origin, ["slug", "adopted"]).select("slug", "cutoff", line.alias("line"))


@query(f"with {V}, o as (select slug, min(titel) as titel, min(kategori) as kategori, count(*) as versions from v group by slug) select slug, replace(to_json({{'slug': slug, 'titel': titel, 'kategori': kategori, 'versions': versions}})::varchar, '<', '\\u003c') as json from o")
def rule_payloads(spark, d):
    o = rule_versions(spark, d).groupBy("slug").agg(F.min("titel").alias("titel"), F.min("kategori").alias("kategori"), F.count("*").alias("versions"))
    return site_payload(o, "slug")


@query("select id, title, date, turn, (turn - 1) // 5 + 1 as page from (select id, title, date, row_number() over (order by date desc, id, title) as turn from (select distinct id, title, date from doc where length(date) = 10)) where turn <= 20")
def recent_meetings(spark, d):
    """The twenty latest meetings, five a page."""
    top = table(spark, d, "doc").where("length(date) = 10").select("id", "title", "date").distinct().orderBy(F.desc("date"), "id", "title").limit(20)
    turn = F.row_number().over(Window.orderBy(F.desc("date"), "id", "title"))  # twenty rows
    return top.withColumn("turn", turn).select("id", "title", "date", "turn", F.floor((F.col("turn") - 1) / 5 + 1).alias("page"))


@query(f"""with {V}, u as (select ref, doc_id, rank from d where ref not in (select ref from v)), m as (select doc_id, max(try_cast(regexp_extract(ref, '#([0-9]+)$', 1) as int)) as top from d group by doc_id)
select ref, doc_id || '#' || (top + row_number() over (partition by doc_id order by rank, ref)) as new_id from u join m using (doc_id)""")
def assigned_numbers(spark, d):
    """New ids for decisions that match nothing known: numbers go on after the highest ever named and are never used again."""
    dec = decisions(spark, d)
    top = dec.groupBy("doc_id").agg(F.max(F.expr("try_cast(substring_index(ref, '#', -1) as int)")).alias("top"))
    u = ranked_within(dec.join(rule_versions(spark, d), "ref", "left_anti").select("doc_id", "ref", "rank"), "doc_id", ["rank", "ref"], "i").join(top, "doc_id")
    return u.select("ref", F.concat_ws("#", "doc_id", (F.col("top") + F.col("i") + 1).cast("string")).alias("new_id"))


_CAND = "c as (select distinct doc_id, c.candidate as candidate from (select doc_id, unnest(output.candidates) as c from judge_output) where c.candidate >= 1)"


@query(f"""with {_CAND}, n as (select doc_id, candidate, row_number() over (partition by doc_id order by candidate) - 1 as i, count(*) over (partition by doc_id) as n from c)
select doc_id, vote, string_agg(candidate::varchar, ' ' order by (i - (vote - 1) * n // 3 + n) % n) as offered from n, (values (1), (2), (3)) t(vote) group by all""")
def rotated_candidates(spark, d):
    """The candidates of each document as each of three votes is offered them: the list rotated by a third of its length a vote."""
    c = table(spark, d, "judge_output").select("doc_id", F.explode("output.candidates").alias("c")).select("doc_id", "c.candidate").where("candidate >= 1").groupBy("doc_id").agg(F.array_sort(F.collect_set("candidate")).alias("l"))
    v = c.select("doc_id", "l", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("vote")).withColumn("k", F.floor((F.col("vote") - 1) * F.size("l") / 3).cast("int"))
    turned = F.concat(F.slice("l", F.col("k") + 1, F.size("l")), F.slice("l", F.lit(1), F.col("k")))
    return v.select("doc_id", "vote", F.concat_ws(" ", turned.cast("array<string>")).alias("offered"))


@query(f"""with {D}, l as (select snapshot_date, max(delivered_at) as delivered_at from decision_snapshot group by 1),
k as (select snapshot_date, ref, max(trim(regexp_replace(udfald, '\\s+', ' ', 'g'))) as u from decision_snapshot join l using (snapshot_date, delivered_at) group by all)
select snapshot_date, d.ref, case when k.ref is null then 'missing' when k.u = d.udfald then 'current' else 'stale' end as status from (select distinct ref, udfald from d) d cross join (select snapshot_date from l) left join k using (snapshot_date, ref)""")
def answers_kept_by_snapshot(spark, d):
    """Which decisions' answers, kept from each snapshot by its last delivery, are current, stale or missing."""
    snap = table(spark, d, "decision_snapshot")
    last = F.broadcast(last_deliveries(snap, "snapshot_date", "delivered_at").drop("_next"))  # a row a snapshot
    at = F.struct("snapshot_date", "ref").alias("at")
    kept = snap.join(last, ["snapshot_date", "delivered_at"]).groupBy(at).agg(F.max(F.trim(F.regexp_replace("udfald", r"\s+", " "))).alias("udfald"))
    asked = decisions(spark, d).select("ref", "udfald").distinct().crossJoin(last.select("snapshot_date")).select(at, "udfald")
    return answer_status(fingerprinted(asked, ["udfald"]), fingerprinted(kept, ["udfald"]), "at").select("at.snapshot_date", "at.ref", "status")



def _shouted(batch):
    return batch["emne"].fillna("").str.upper().tolist()


@query(f"with {D} select ref, upper(coalesce(emne, '')) as answer from d")
def answers_asked(spark, d):
    """An answer for every decision from an outside function, each distinct subject asked once and the answers kept."""
    none = spark.createDataFrame([], "fingerprint bigint, answer string")
    return answered(decisions(spark, d).select("ref", "emne"), "ref", ["emne"], none, _shouted).select("ref", "answer")
