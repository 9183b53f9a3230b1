"""Queries that locate quotes in minutes. The minutes of a document are the texts of its decisions one after the other, each on the page it is said to be on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import squeezed, words
from ..operators.locating import WHOLE, containing, large_documents, located_in, passages, read_whole, text_blocks
from ..operators.matching import covered, scored, scores_by_document
from ..operators.order import summed_before
from ..operators.quotes import one_to_one
from ..operators.snapshots import last_deliveries
from ..sources.tables import freed, merged, table, written
from .base import D, query
from .texts import _WORDS


def placed_words(said: DataFrame) -> DataFrame:
    """``said`` (doc, rank, ref, page, w: words) with ``n`` words and ``start``, the place of the first among the words of the document."""
    return summed_before(said.withColumn("n", F.size("w")), "doc", [F.asc_nulls_last("rank"), F.asc_nulls_last("ref")], "n", "start")


def blocks_of(placed: DataFrame) -> DataFrame:
    return written(text_blocks(placed), "minutes")


#: The columns of a decision that only tell it apart from others.
_PAGES = ("side", "side_rettet")


def _said(rows: DataFrame) -> DataFrame:
    """(doc, key, rank, page, w, q, v, one): the rows of decisions with the words of their text, quote and vote; ``one`` tells decisions apart, by all columns but the page."""
    all_of = [x for c in rows.columns if c not in _PAGES for x in (F.col(c), F.col(c).isNull())]
    said = [F.concat_ws(" ", words(c)).alias(n) for c, n in (("tekst", "w"), ("citat", "q"), ("stemmer", "v"))]
    one = F.concat_ws(" ", F.xxhash64(*all_of).cast("string"), F.xxhash64(F.lit(1), *reversed(all_of)).cast("string"))
    return rows.select(F.col("doc_id").alias("doc"), F.col("ref").alias("key"), "rank", F.col("side").cast("int").alias("page"), *said, one.alias("one"))


def _read(spark, d, *, cite: bool = True, around: bool = False, whole: int = WHOLE) -> DataFrame:
    """As ``read_whole``, of the decisions of all documents: those of up to ``whole`` bytes in one piece, others by blocks. A decision without a document has no place.

    A decision's page is the least that its rows in the document name.
    """
    rows = table(spark, d, "decision")
    large = large_documents(rows, "doc_id", ["tekst", "citat"], whole)
    nowhere = _said(rows.where("doc_id is null")).select("doc", "key", "rank", "q", "w", "one").distinct()
    small = read_whole(_said(rows.where("doc_id is not null").join(large, "doc_id", "left_anti")), cite, around)
    none = lambda n: F.lit(None).cast(small.schema[n].dataType).alias(n)
    count = lambda c: F.when(F.col(c) == "", 0).otherwise(F.size(F.split(c, " ")))
    out = small.unionByName(nowhere.select("doc", "key", *[none(c) for c in small.columns if c not in ("doc", "key", "n", "m")], count("w").alias("n"), count("q").alias("m")))
    if large.isEmpty():
        return out
    own = written(_said(rows.join(large, "doc_id", "left_semi")).withColumnRenamed("key", "ref"), "rows")
    page = own.groupBy("doc", "ref").agg(F.min("page").alias("page"))
    own = own.drop("page").dropDuplicates(["doc", "ref", "rank", "one"])
    same = own["ref"].eqNullSafe(page["ref"]) & (own["doc"] == page["doc"])
    own = own.join(merged(page), same).select(own["*"], page["page"]).withColumn("w", F.when(F.col("w") == "", F.array().cast("array<string>")).otherwise(F.split("w", " ")))
    placed = written(placed_words(own).withColumn("id", F.monotonically_increasing_id()), "placed")
    blocks = blocks_of(placed)
    freed(spark)
    quotes = placed.select(F.col("id").alias("key"), "doc", F.col("q").alias("quote"), (F.col("page") if cite else F.lit(None).cast("int")).alias("page"))
    at = written(located_in(quotes, blocks).where("found").select(F.col("key").alias("id"), "pos", F.col("page").alias("on")), "located")
    freed(spark)
    far = placed.select("id", "doc", F.col("q").alias("quote"), F.col("v").alias("vote"), "ref", "start", "n", count("q").alias("m")).join(merged(at), "id", "left")
    if around:
        # what is known of a decision goes along, so that its passage is not shuffled to it
        row = F.struct("ref", "start", "n", "m", "on").alias("key")
        of = passages(far.where("pos is not null").select(row, "doc", "pos", "quote", "vote"), blocks, known=["doc", "pos"])
        far = of.select("doc", "pos", "key.*", "first", "last", "words").unionByName(far.where("pos is null").select("doc", "pos", "ref", "start", "n", "m", "on"), allowMissingColumns=True)
    return out.unionByName(far.withColumnRenamed("ref", "key").withColumnRenamed("on", "page").select(small.columns))


_MIN = f"""with {D}, w as (select ref, doc_id, rank, {_WORDS.format('citat')} as q, {_WORDS.format('tekst')} as t from d),
o as (select *, coalesce(sum(len(t)) over (partition by doc_id order by rank, ref rows between unbounded preceding and 1 preceding), 0)::bigint as off from w),
wd as (select doc_id, off + unnest(range(0, len(t))) as p, unnest(t) as word from o),
tg as (select doc_id, p, word || ' ' || lead(word, 1) over (partition by doc_id order by p) || ' ' || lead(word, 2) over (partition by doc_id order by p) as gram from wd),
uq as (select distinct doc_id, array_to_string(q, ' ') as qs, q from w where len(q) >= 3),
qg as (select doc_id, qs, len(q) - 2 as n, unnest(range(0, len(q) - 2)) as j, unnest(list_transform(range(1, len(q) - 1), lambda i: q[i] || ' ' || q[i + 1] || ' ' || q[i + 2])) as gram from uq),
vote as (select doc_id, qs, n, j, p - j as s from qg join tg using (doc_id, gram)), own as (select doc_id, qs, s as anchor, count(*) as own from vote group by all),
srv as (select doc_id, qs, n, j, s, unnest(range(s - 8, s + 3)) as anchor from vote),
pool as (select doc_id, qs, anchor, max(n) as n, count(distinct j) as votes, arg_min(s, j * 1000000000000 + abs(s - anchor) * 10000000000 + s + 5000) as s from srv group by all),
best as (select * from pool join own using (doc_id, qs, anchor) qualify row_number() over (partition by doc_id, qs order by votes desc, own desc, anchor) = 1),
st as (select doc_id, q, min(p) as s from (select distinct doc_id, q from w where len(q) in (1, 2)) x join (select doc_id, p, [word] as q from wd union all select doc_id, p, [word, lead(word) over (partition by doc_id order by p)] from wd) y using (doc_id, q) group by all)"""


@query(_MIN + """ select w.ref, coalesce(b.votes / b.n >= 0.8 - 1e-12, false) or st.s is not null as found, case when b.votes / b.n >= 0.8 - 1e-12 then greatest(b.s, 0) else st.s end as pos
 from w left join best b on b.doc_id = w.doc_id and b.qs = array_to_string(w.q, ' ') and len(w.q) >= 3 left join st on st.doc_id = w.doc_id and st.q = w.q""")
def quotes_in_minutes(spark, d):
    """Whether each decision's quote stands in the minutes, and at which word it first and best does, whatever page is cited."""
    return _read(spark, d, cite=False).select(F.col("key").alias("ref"), F.col("pos").isNotNull().alias("found"), "pos")


@query()
def quote_pages(spark, d):
    """Where each quote stands in the minutes and on which page, the page cited before others."""
    return _read(spark, d).select(F.col("key").alias("ref"), F.col("pos").isNotNull().alias("found"), "pos", "page")


@query()
def quote_passages(spark, d):
    """The passage of the minutes around each quote that stands there, to the end of the decision's vote."""
    return _read(spark, d, cite=True, around=True).where("pos is not null").select(F.col("key").alias("ref"), "first", "last", "words")


# ---- matching by place and text

FIELDS, FIRM = ["udfald", "kategori", "niveau", "handling"], ["udfald", "niveau", "handling"]


def _live(spark, d) -> DataFrame:
    """The snapshots by their last deliveries, with the document and number of each ref."""
    snap = table(spark, d, "decision_snapshot")
    last = F.broadcast(last_deliveries(snap, "snapshot_date", "delivered_at"))  # a row a snapshot
    live = snap.join(last, ["snapshot_date", "delivered_at"]).select("ref", "snapshot_date", "_next", squeezed("tekst").alias("tekst"), squeezed("emne").alias("emne"), *[squeezed(f).alias(f) for f in FIELDS])
    return live.withColumns({"doc": F.regexp_replace("ref", "#[^#]*$", ""), "rank": F.coalesce(F.expr("try_cast(substring_index(ref, '#', -1) as int)"), F.lit(0))})


def _matched(spark, d):
    """The decisions of the snapshot before the last as a run, the wordings of all as probes of a key, and their matches.

    What is live in the last snapshot is a decision of the key, what was left undecided is to be ignored, and the rest are rejects. The minutes are those of the run; a
    probe stands where its text does.
    """
    live = written(_live(spark, d), "live")
    ends = F.broadcast(live.agg(F.max("snapshot_date").alias("z"), F.max(F.when(F.col("_next").isNotNull(), F.col("snapshot_date"))).alias("y")))
    now = live.join(ends, F.col("snapshot_date") == F.col("y")).groupBy("doc", "ref", "rank").agg(F.max(F.struct("tekst", "emne", *FIELDS)).alias("x")).select("doc", "ref", "rank", "x.*")
    placed = written(placed_words(now.withColumn("w", words("tekst")).withColumn("page", F.lit(None).cast("int"))), "run")
    run = placed.select("doc", F.col("ref").alias("key"), F.col("udfald").alias("outcome"), F.col("start").alias("a"), (F.col("start") + F.col("n")).alias("b"), F.concat_ws(" ", "emne", "tekst").alias("text"), *FIELDS)
    items = live.groupBy("ref").agg(F.bool_or(F.col("_next").isNull()).alias("living"), F.max(F.struct("snapshot_date", *FIELDS)).alias("x"))
    role = F.when(F.col("x.udfald") == "ikke_afgjort", "ignored").when(F.col("living"), "decision").otherwise("reject")
    said = live.where("tekst <> ''").groupBy("doc", "ref", "tekst").agg(F.max("emne").alias("emne"))
    p = said.join(items.select("ref", role.alias("role"), *[F.col(f"x.{f}").alias(f) for f in FIELDS]), "ref").withColumn("key", F.concat_ws("|", "ref", F.md5("tekst")))
    p = written(p, "probes")
    at = located_in(p.select("key", "doc", F.col("tekst").alias("quote"), F.lit(None).cast("int").alias("page")), blocks_of(placed)).select("key", F.col("pos").alias("a"))
    probes = written(p.join(at, "key").withColumn("b", F.col("a") + F.greatest(F.size(words("tekst")), F.lit(1))), "located")
    wanted = probes.select("doc", "key", F.col("udfald").alias("outcome"), "a", "b", F.concat_ws(" ", "emne", "tekst").alias("text"))
    pairs = written(scored(wanted, run).withColumn("score", F.round("score", 9)), "scored")
    return run, probes, one_to_one(pairs, "old", "new", "score", by=["doc"])


@query()
def decisions_matched(spark, d):
    """The wordings of all snapshots matched one to one with the decisions of the one before the last, by where they stand in its minutes and what they say."""
    return _matched(spark, d)[2]


@query()
def document_scores(spark, d):
    """How the decisions of the snapshot before the last do against the last as an answer key, by document."""
    run, probes, matches = _matched(spark, d)
    key = probes.select("doc", F.col("key").alias("probe"), F.col("ref").alias("item"), "role", *FIELDS)
    return scores_by_document(key, matches, run.select("doc", "key", *FIELDS), FIELDS, FIRM)


@query(_MIN + """, lo as (select w.doc_id, w.ref, case when b.votes / b.n >= 0.8 - 1e-12 then greatest(b.s, 0) else st.s end as a, greatest(len(w.q), 1) as n
 from w left join best b on b.doc_id = w.doc_id and b.qs = array_to_string(w.q, ' ') and len(w.q) >= 3 left join st on st.doc_id = w.doc_id and st.q = w.q),
sp as (select doc_id, ref, a, a + n as b from lo where a is not null), ot as (select doc_id, ref, off as a, off + len(t) as b from o)
select x.doc_id as doc, x.ref as outer_, y.ref as inner_, (least(x.b, y.b) - greatest(x.a, y.a)) / (y.b - y.a) as share from ot x join sp y on x.doc_id = y.doc_id and x.a < y.b and y.a < x.b where (least(x.b, y.b) - greatest(x.a, y.a)) / (y.b - y.a) > 0.5""")
def covered_quotes(spark, d):
    """The decisions of whose quote more than half lies in a decision's text."""
    read = written(_read(spark, d, cite=False), "read")
    freed(spark)
    outer = read.select("key", "doc", F.col("start").alias("a"), (F.col("start") + F.col("n")).alias("b"))
    inner = read.where("pos is not null").select("key", "doc", F.col("pos").alias("a"), (F.col("pos") + F.greatest("m", F.lit(1))).alias("b"))
    return covered(outer, inner).select("doc", F.col("outer").alias("outer_"), F.col("inner").alias("inner_"), "share")


@query(f"""with {D}, n as (select doc_id, ref, ' ' || array_to_string({_WORDS.format('citat')}, ' ') || ' ' as q, ' ' || array_to_string({_WORDS.format('tekst')}, ' ') || ' ' as e from d)
select a.doc_id as doc, a.ref as a, b.ref as b from n a join n b on a.doc_id = b.doc_id and a.q <> '  ' and b.e <> '  ' and (contains(a.q, b.e) or contains(b.e, a.q))""")
def corrections_matched(spark, d):
    """Which decision a correction of its document means: one whose quote holds what the correction quotes, here the text of each decision, or is held by it."""
    dec = table(spark, d, "decision")
    return containing(*[dec.select(F.col("doc_id").alias("doc"), F.col("ref").alias("key"), F.col(c).alias("quote")) for c in ("citat", "tekst")])
