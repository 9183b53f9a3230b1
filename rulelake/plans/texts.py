"""Queries on words, dates, names and ranking."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.danish import STOP_WORDS, compound_parts, content_words, stems
from ..functions.text import SPELT, ascii_anchor, squeezed, words
from ..operators.order import carried_forward, ranked_within
from ..operators.quotes import jaccard, located, overlap, trigrams
from ..operators.ranking import bm25, block_scores, idf, packed_vectors, term_counts, top, unbeaten, unit_vectors
from ..operators.snapshots import last_deliveries
from ..sources.tables import table, written
from .base import D, V, decisions, query, quoted, rule_versions

_WORDS = r"regexp_extract_all(lower(coalesce({0}, '')), '[\p{{L}}\p{{N}}_]+')"
_STOP = quoted(STOP_WORDS)


@query(f"select doc_id, len(w) as words, len(list_distinct(w)) as distinct_words, coalesce(length(text), 0) / 3.2 as tokens_estimate from (select doc_id, text, {_WORDS.format('text')} as w from documents)")
def document_words(spark, d):
    w = words("text")
    return table(spark, d, "documents").select("doc_id", F.size(w).alias("words"), F.size(F.array_distinct(w)).alias("distinct_words"), (F.coalesce(F.length("text"), F.lit(0)) / 3.2).alias("tokens_estimate"))


@query(f"select word, count(*) as n from (select unnest({_WORDS.format('text')}) as word from documents) where length(word) >= 2 and word not in ({_STOP}) group by word")
def vocabulary(spark, d):
    return table(spark, d, "documents").select(F.explode(content_words(F.col("text"))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


_VOC = f"voc as (select distinct word from (select unnest({_WORDS.format('text')}) as word from documents) where length(word) >= 3 and word not in ({_STOP}))"


def _own_words(spark, d):
    return table(spark, d, "documents").select(F.explode(content_words(F.col("text"))).alias("word")).where(F.length("word") >= 3).distinct()


@query(f"""with {_VOC}, h as (select word, left(word, i::int) as l, substr(word, i::int + 1) as r from (select word, unnest(range(3, length(word) - 3)) as i from voc where length(word) >= 7)),
k as (select * from h where r in (select word from voc)), b as (select word, r, case when l in (select word from voc) then l when right(l, 1) in ('s', 'e') and left(l, -1) in (select word from voc) then left(l, -1) end as l from k)
select distinct word, unnest([l, r]) as part from b where l is not null""")
def compound_words(spark, d):
    return compound_parts(_own_words(spark, d))


@query()
def word_stems(spark, d):
    return stems(_own_words(spark, d))


@query(f"""with t as (select doc_id, {_WORDS.format('text')} as w from documents), g as (select doc_id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) as gram from t where len(w) >= 3)
select gram, count(*) as n, count(distinct doc_id) as documents from g group by gram having count(distinct doc_id) >= 20""")
def frequent_trigrams(spark, d):
    g = table(spark, d, "documents").select("doc_id", F.explode(trigrams(words("text"))).alias("gram"))
    return g.groupBy("doc_id", "gram").agg(F.count("*").alias("n")).groupBy("gram").agg(F.sum("n").alias("n"), F.count("*").alias("documents")).where("documents >= 20")


_SLUG = r"coalesce(nullif(trim(regexp_replace(lower({0}), '[^\p{{L}}\p{{N}}_]+', '-', 'g'), '-'), ''), 'regel')"


def slugified(c):
    return F.coalesce(F.nullif(F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}_]+", "-"), F.lit("-")), F.lit("")), F.lit("regel"))


@query(f"with {V} select distinct titel, {_SLUG.format('titel')} as base from v")
def slugified_titles(spark, d):
    return rule_versions(spark, d).select("titel", slugified(F.col("titel")).alias("base")).distinct()


def _anchor_sql(c):
    for a, b in SPELT.items():
        c = f"replace({c}, '{a}', '{b}')"
    return f"regexp_replace(strip_accents({c}), '[^\\x00-\\x7f]', '', 'g')"


@query(f"with {V} select slug, {_anchor_sql('lower(slug)')} as anchor from (select distinct slug from v)")
def ascii_anchors(spark, d):
    return rule_versions(spark, d).select("slug").distinct().select("slug", ascii_anchor("slug").alias("anchor"))


#: Months by name.
MONTHS = ["januar", "februar", "marts", "april", "maj", "juni", "juli", "august", "september", "oktober", "november", "december"]
_TEXT_DATE = rf"(\d{{1,2}})\.?\s+({'|'.join(MONTHS)})\s+(\d{{4}})"


def parsed_date(title, name):
    """The date of a title or file name: text date, ddmmyyyy, ddmmyy, year. The first form that matches decides, even when it is no date."""
    low, stem = F.lower(F.coalesce(title, F.lit(""))), F.lower(F.coalesce(name, F.lit("")))

    def iso(y, m, day):
        return F.try_to_date(F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd").cast("string")

    # fixed values: the forms of dates in names
    month = F.array_position(F.array(*map(F.lit, MONTHS)), F.regexp_extract(low, _TEXT_DATE, 2)).cast("string")
    eight, six, year = r"(?<![0-9])(\d{2})(\d{2})((?:19|20)\d{2})(?![0-9])", r"(?<![0-9])(\d{2})(\d{2})(\d{2})(?![0-9])", r"(?<![0-9])((?:19|20)\d{2})(?![0-9])"
    both = F.concat_ws(" ", low, stem)
    return (
        F.when(low.rlike(_TEXT_DATE), iso(F.regexp_extract(low, _TEXT_DATE, 3), month, F.regexp_extract(low, _TEXT_DATE, 1)))
        .when(stem.rlike(eight), iso(F.regexp_extract(stem, eight, 3), F.regexp_extract(stem, eight, 2), F.regexp_extract(stem, eight, 1)))
        .when(stem.rlike(six), iso(F.concat(F.lit("20"), F.regexp_extract(stem, six, 3)), F.regexp_extract(stem, six, 2), F.regexp_extract(stem, six, 1)))
        .when(both.rlike(year), F.regexp_extract(both, year, 1))
    )


_ISO = "try_cast({0} || '-' || lpad({1}, 2, '0') || '-' || lpad({2}, 2, '0') as date)::varchar"
_T = f"regexp_extract(t, '{_TEXT_DATE}', ['d', 'm', 'y'])"
_E = r"regexp_extract(s, '(?:^|[^0-9])(\d{2})(\d{2})((?:19|20)\d{2})(?:$|[^0-9])', ['d', 'm', 'y'])"
_S = r"regexp_extract(s, '(?:^|[^0-9])(\d{2})(\d{2})(\d{2})(?:$|[^0-9])', ['d', 'm', 'y'])"
_Y = r"regexp_extract(t || ' ' || s, '(?:^|[^0-9])((?:19|20)\d{2})(?:$|[^0-9])', 1)"


@query(f"""select id, title, case when {_T}.d <> '' then {_ISO.format(_T + '.y', f"list_position([{quoted(MONTHS)}], {_T}.m)::varchar", _T + '.d')}
 when {_E}.d <> '' then {_ISO.format(_E + '.y', _E + '.m', _E + '.d')} when {_S}.d <> '' then {_ISO.format("'20' || " + _S + '.y', _S + '.m', _S + '.d')} else nullif({_Y}, '') end as parsed
 from (select distinct id, title, lower(title) as t, lower(id) as s from doc)""")
def parsed_document_dates(spark, d):
    return table(spark, d, "doc").select("id", "title").distinct().select("id", "title", parsed_date(F.col("title"), F.col("id")).alias("parsed"))


@query("""select id, title, case when y1 is not null and y2 is not null and abs(y1 - y2) > 1 then date else coalesce(said, date) end as meeting,
 case when date is null then 'ukendt dato' when length(date) = 10 then substr(date, 9, 2) || '.' || substr(date, 6, 2) || '.' || left(date, 4) else date end as short_date,
 case when length(date) = 10 then substr(date, 9, 2) || '.' || substr(date, 6, 2) else coalesce(date, '?') end as day_month
 from (select distinct id, title, date, d.dato as said, try_cast(left(d.dato, 4) as int) as y1, try_cast(left(date, 4) as int) as y2 from doc left join (select doc_id, max(dato) as dato from decision group by 1) d on doc_id = id)""")
def meeting_dates(spark, d):
    said = decisions(spark, d).groupBy("doc_id").agg(F.max("dato").alias("said"))
    doc = table(spark, d, "doc").select("id", "title", "date").distinct().join(said, F.col("id") == F.col("doc_id"), "left")
    far = F.abs(F.expr("try_cast(left(said, 4) as int)") - F.expr("try_cast(left(date, 4) as int)")) > 1
    dm = F.concat(F.substring("date", 9, 2), F.lit("."), F.substring("date", 6, 2))
    short = F.when(F.col("date").isNull(), "ukendt dato").when(F.length("date") == 10, F.concat(dm, F.lit("."), F.substring("date", 1, 4))).otherwise(F.col("date"))
    return doc.select("id", "title", F.when(far, F.col("date")).otherwise(F.coalesce("said", "date")).alias("meeting"), short.alias("short_date"), F.when(F.length("date") == 10, dm).otherwise(F.coalesce("date", F.lit("?"))).alias("day_month"))


@query(f"with {D} select doc_id, max(try_cast(regexp_extract(ref, '#([0-9]+)$', 1) as int)) as highest, count(*) as decisions from d group by doc_id")
def highest_numbers(spark, d):
    return decisions(spark, d).groupBy("doc_id").agg(F.max(F.expr("try_cast(substring_index(ref, '#', -1) as int)")).alias("highest"), F.count("*").alias("decisions"))


@query(r"""with l as (select doc_id, i, s from (select doc_id, unnest(range(1, len(w) + 1)) as i, unnest(w) as s from (select doc_id, string_split(text, '[Side ') as w from documents where text like '%[Side %'))),
p as (select doc_id, case when i > 1 then try_cast(regexp_extract(s, '^([0-9]+)\]', 1) as int) end as page, len(regexp_extract_all(lower(case when i > 1 then regexp_replace(s, '^[0-9]+\]', '') else s end), '[\p{L}\p{N}_]+')) as words from l)
select doc_id, page, sum(words)::bigint as words from p group by all having sum(words) > 0""")
def words_by_page(spark, d):
    split = table(spark, d, "documents").where(F.col("text").contains("[Side ")).select("doc_id", F.posexplode(F.split("text", r"\[Side ")).alias("i", "s"))
    page = F.when(F.col("i") > 0, F.expr(r"try_cast(regexp_extract(s, '^([0-9]+)\\]', 1) as int)"))
    n = F.size(words(F.when(F.col("i") > 0, F.regexp_replace("s", r"^[0-9]+\]", "")).otherwise(F.col("s"))))
    return split.select("doc_id", page.alias("page"), n.alias("n")).groupBy("doc_id", "page").agg(F.sum("n").alias("words")).where("words > 0")


@query(r"""with l as (select doc_id, i, s from (select doc_id, unnest(range(1, len(w) + 1)) as i, unnest(w) as s from (select doc_id, string_split(replace(text, chr(13), ''), chr(10)) as w from documents where text is not null))),
h as (select *, last_value(case when regexp_matches(s, '^[0-9]+\. \S') then s end ignore nulls) over (partition by doc_id order by i rows unbounded preceding) as heading from l)
select doc_id, heading, count(*) as lines from h where trim(s, ' ' || chr(9)) <> '' group by all""")
def lines_by_heading(spark, d):
    lines = table(spark, d, "documents").where("text is not null").select("doc_id", F.posexplode(F.split(F.replace("text", F.lit("\r"), F.lit("")), "\n")).alias("i", "s"))
    heading = F.last(F.when(F.col("s").rlike(r"^[0-9]+\. \S"), F.col("s")), True).over(Window.partitionBy("doc_id").orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    return lines.withColumn("heading", heading).where(F.expr("trim(both ' \t' from s) <> ''")).groupBy("doc_id", "heading").agg(F.count("*").alias("lines"))


@query(rf"""with {D}, s as (select ref, trim(regexp_replace(tekst, '[\s\x0b\x{{85}}\x{{1c}}-\x{{1f}}\p{{Z}}]+', ' ', 'g')) as t from d)
select ref, case when length(t) <= 200 then t else regexp_replace(left(t, 200), ' [^ ]*$', '') || ' …' end as short from s""")
def short_texts(spark, d):
    t = decisions(spark, d).select("ref", squeezed("tekst").alias("t"))
    return t.select("ref", F.when(F.length("t") <= 200, F.col("t")).otherwise(F.concat(F.regexp_replace(F.substring("t", 1, 200), " [^ ]*$", ""), F.lit(" …"))).alias("short"))


@query(f"""with {D} select ref, replace(replace(replace(replace(emne, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') as html, replace(emne, '|', '\\|') as cell, replace(to_json(emne)::varchar, '<', '\\u003c') as json from d""")
def escaped_subjects(spark, d):
    c = F.col("emne")
    html = c
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        html = F.replace(html, F.lit(a), F.lit(b))
    json = F.expr("substring(to_json(array(emne)), 2, length(to_json(array(emne))) - 2)")
    return decisions(spark, d).select("ref", html.alias("html"), F.replace(c, F.lit("|"), F.lit("\\|")).alias("cell"), F.replace(json, F.lit("<"), F.lit("\\u003c")).alias("json"))


# ---- quotes

_Q = f"""with {D}, w as (select ref, {_WORDS.format('citat')} as q, {_WORDS.format('tekst')} as t from d),
qg as (select ref, len(q) - 2 as n, unnest(range(0, len(q) - 2)) as j, unnest(list_transform(range(1, len(q) - 1), lambda i: q[i] || ' ' || q[i + 1] || ' ' || q[i + 2])) as gram from w where len(q) >= 3),
tg as (select ref, unnest(range(0, len(t) - 2)) as p, unnest(list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2])) as gram from w where len(t) >= 3),
vote as (select ref, n, j, p - j as s from qg join tg using (ref, gram)), own as (select ref, s as anchor, count(*) as own from vote group by all),
srv as (select ref, n, j, s, unnest(range(s - 8, s + 3)) as anchor from vote),
pool as (select ref, anchor, max(n) as n, count(distinct j) as votes, arg_min(s, j * 1000000 + abs(s - anchor) * 20000 + s + 5000) as s from srv group by all),
best as (select *, row_number() over (partition by ref order by votes desc, own desc, anchor) as k from pool join own using (ref, anchor)),
found as (select ref, votes / n as share, greatest(s, 0) as start from best where k = 1
  union all select ref, 1.0, list_position(case when len(q) = 1 then t else list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]) end, array_to_string(q, ' ')) - 1 from w
  where len(q) in (1, 2) and list_position(case when len(q) = 1 then t else list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]) end, array_to_string(q, ' ')) > 0)"""


@query(_Q + " select ref, share, cast(start as int) as start, share >= 0.8 as found from found")
def quotes_located(spark, d):
    return located(decisions(spark, d), "ref", "citat", "tekst").select("ref", "share", F.col("start").cast("int").alias("start"), (F.col("share") >= 0.8).alias("found"))


@query(_Q + f""", sp as (select f.ref, doc_id, start as a, start + greatest(len(q), 1) as b from found f join w using (ref) join d using (ref) where share >= 0.8),
nx as (select ref, a, b, lead(ref) over (partition by doc_id order by ref) as other, lead(a) over (partition by doc_id order by ref) as c, lead(b) over (partition by doc_id order by ref) as e from sp)
select ref, other, greatest(least(b, e) - greatest(a, c), 0) / least(b - a, e - c) as overlap from nx where other is not null""")
def neighbouring_spans(spark, d):
    dec = decisions(spark, d)
    n = dec.select("ref", "doc_id", F.greatest(F.size(words("citat")), F.lit(1)).alias("n"))
    sp = located(dec, "ref", "citat", "tekst").where("share >= 0.8").join(n, "ref").select("ref", "doc_id", F.col("start").alias("a"), (F.col("start") + F.col("n")).alias("b"))
    placed = ranked_within(sp, "doc_id", ["ref"], "i")
    after = placed.select("doc_id", (F.col("i") - 1).alias("i"), F.struct("ref", "a", "b").alias("o"))
    nx = placed.join(after, ["doc_id", "i"])
    return nx.select("ref", F.col("o.ref").alias("other"), overlap(F.col("a"), F.col("b"), F.col("o.a"), F.col("o.b")).alias("overlap"))


@query(_Q + """, o as (select doc_id, ref, rank, case when share >= 0.8 then start end as pos from d left join found using (ref)),
c as (select *, coalesce(last_value(pos ignore nulls) over (partition by doc_id order by rank, ref rows unbounded preceding), -1) as carried from o)
select doc_id, ref, row_number() over (partition by doc_id order by carried, rank, ref) - 1 as reading from c""")
def reading_order(spark, d):
    dec = decisions(spark, d)
    pos = located(dec, "ref", "citat", "tekst").where("share >= 0.8").select("ref", F.col("start").alias("pos"))
    rows = dec.select("doc_id", "ref", "rank").join(pos, "ref", "left")
    c = carried_forward(rows, "doc_id", ["rank", "ref"], "pos", "carried").select("doc_id", "ref", "rank", F.coalesce("carried", F.lit(-1)).alias("carried"))
    return ranked_within(c, "doc_id", ["carried", "rank", "ref"], "reading").select("doc_id", "ref", "reading")


@query(f"""with {D}, s as (select distinct snapshot_date, ref, trim(emne) || ' ' || trim(tekst) as t from decision_snapshot join (select snapshot_date, max(delivered_at) as delivered_at from decision_snapshot group by 1) using (snapshot_date, delivered_at)),
g as (select ref, t.w as w from (select ref, {_WORDS.format("emne || ' ' || tekst")} as w from d) t), h as (select snapshot_date, ref, {_WORDS.format('min(t)')} as w from s group by all),
a as (select distinct ref, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) as gram from g where len(w) >= 3),
b as (select distinct snapshot_date, ref, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) as gram from h where len(w) >= 3),
na as (select ref, count(*) as n from a group by ref), nb as (select snapshot_date, ref, count(*) as n from b group by all), sh as (select snapshot_date, ref, count(*) as n from a join b using (ref, gram) group by all)
select nb.snapshot_date, nb.ref, round(coalesce(sh.n, 0) / (na.n + nb.n - coalesce(sh.n, 0)), 9) as similarity from na join nb on na.ref = nb.ref left join sh on sh.snapshot_date = nb.snapshot_date and sh.ref = nb.ref""")
def same_ref_similarities(spark, d):
    """How alike each decision and its ref in every snapshot are, by the snapshot's last delivery: shared word trigrams of all."""
    snap = table(spark, d, "decision_snapshot")
    last = F.broadcast(last_deliveries(snap, "snapshot_date", "delivered_at").drop("_next"))  # a row a snapshot
    live = snap.join(last, ["snapshot_date", "delivered_at"]).select("ref", F.struct("snapshot_date", F.concat_ws(" ", F.trim("emne"), F.trim("tekst")).alias("t")).alias("x"))
    s = live.groupBy("ref").agg(F.collect_set("x").alias("l"))  # a ref has a few rows a snapshot; a text is compared once for all of them
    s = s.join(decisions(spark, d).select("ref", F.concat_ws(" ", "emne", "tekst").alias("own")), "ref")
    least = F.expr("transform(array_distinct(l.snapshot_date), s -> struct(s as s, array_min(filter(l, x -> x.snapshot_date = s).t) as t))")
    s = s.select("ref", "own", least.alias("m")).select("ref", "own", "m", F.explode(F.array_distinct(F.col("m.t"))).alias("t"))
    g = s.select("ref", F.expr("filter(m, x -> x.t = t).s").alias("dates"), F.array_distinct(trigrams(words("own"))).alias("ga"), F.array_distinct(trigrams(words("t"))).alias("gb")).where("size(ga) > 0 and size(gb) > 0")
    j = g.select("ref", "dates", F.round(jaccard(F.size(F.array_intersect("ga", "gb")), F.size("ga"), F.size("gb")), 9).alias("similarity"))
    return j.select(F.explode("dates").alias("snapshot_date"), "ref", "similarity")


# ---- ranking

_IDX = f"""n as (select count(*) as n from documents), c as (select doc_id, term, count(*) as tf from (select doc_id, unnest({_WORDS.format('text')}) as term from documents) where length(term) >= 2 and term not in ({_STOP}) group by all),
i as (select term, ln((n + 1) / (count(*) + 1)) + 1 as idf from c, n group by term, n), r as (select doc_id, term, (1 + ln(tf)) * idf as raw from c join i using (term)),
u as (select doc_id, term, raw / sqrt(sum(raw * raw) over (partition by doc_id)) as w from r)"""


def _vectors(spark, d):
    docs = table(spark, d, "documents")
    counts = term_counts(docs.select("doc_id", content_words(F.col("text")).alias("w")), "doc_id", "w")
    return docs, counts, unit_vectors(counts, idf(counts, docs.count()), "doc_id")


@query(f"with {_IDX} select doc_id, count(*) as terms, round(max(w), 9) as heaviest, round(sum(w), 6) as total from u group by doc_id")
def tfidf_vectors(spark, d):
    return _vectors(spark, d)[2].groupBy("doc_id").agg(F.count("*").alias("terms"), F.round(F.max("w"), 9).alias("heaviest"), F.round(F.sum("w"), 6).alias("total"))


_RANKED = f"""with {_IDX}, q as (select doc_id as query, term, w as qw from u where doc_id % 100 = 0),
p as (select query, doc_id, sum(qw * w) as cos from q join u using (term) where query <> doc_id group by all),
s as (select query, p.doc_id, round(cos * case when a.organ = b.organ then 1.3 else 1 end, 9) as score, b.organ = a.organ as own from p join documents a on a.doc_id = query join documents b on b.doc_id = p.doc_id),
k as (select *, row_number() over (partition by query order by score desc, doc_id) as rank from s)"""


def _compared(spark, d):
    """The documents' vectors as rows for ``block_scores``, and every hundredth as a query; keys are numbers in twenty digits, which sort as they count."""
    docs, _, v = _vectors(spark, d)
    key = F.lpad(F.col("doc_id").cast("string"), 20, "0")
    keyed = docs.select(key.alias("key"), F.col("organ").alias("category"))
    rows = written(packed_vectors(keyed, v.select(key.alias("key"), "term", "w"), "key"), "document-vectors")
    return rows, rows.where(F.col("key").cast("bigint") % 100 == 0).select(F.col("key").alias("query"), "category", "terms", "ws", F.array("key").alias("excluded"), *unbeaten())


@query(_RANKED + " select query, doc_id, score, rank from k where rank <= 15")
def candidates_ranked(spark, d):
    rows, asked = _compared(spark, d)
    best = block_scores(asked, rows, boost=0.3, k=15).where("score > 0").select(F.col("query").cast("bigint").alias("query"), F.col("key").cast("bigint").alias("doc_id"), "score")
    return top(best, "query", "score", "doc_id", 15).select("query", "doc_id", "score", "rank")


@query(_RANKED + ", f as (select query, min(rank) as rank from k where own group by query), q2 as (select doc_id as query, rank from documents left join f on query = doc_id where doc_id % 100 = 0) select n as k, avg(case when coalesce(rank <= n, false) then 1.0 else 0.0 end) as recall from q2, (values (3), (5), (8), (10), (15)) t(n) group by n")
def recall_at_k(spark, d):
    """The share of documents asked for of which one of the same body is among the k closest: the place of the best one is a count of those ahead of it."""
    rows, asked = _compared(spark, d)
    own = block_scores(asked, rows, boost=0.3, k=1, same=True).where("score > 0").select("query", F.col("score").alias("own"), F.col("key").alias("own_key"))
    # an own document that ties is behind its like, so the best one is only behind others
    beaten = block_scores(asked.drop("own", "own_key").join(own, "query"), rows, boost=0.3).select("query", (F.col("ahead") + 1).alias("rank"))
    every = asked.select("query").join(beaten, "query", "left")
    each = every.select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.coalesce(F.col("rank") <= k, F.lit(False)).alias("hit")) for k in (3, 5, 8, 10, 15)])).alias("x"))
    return each.groupBy(F.col("x.k").alias("k")).agg(F.avg(F.when(F.col("x.hit"), 1.0).otherwise(0.0)).alias("recall"))


#: Searches of the sample, and their synonyms at half weight.
SEARCHES = [("dopingprøve", ["doping", "kontrol"]), ("dommer", ["dommere", "dommerne"]), ("budget", ["økonomi", "haushalt"]), ("kontingent", ["gebyr", "afgift"])]


def _search_terms():
    return [(q, t, 1.0 if t == q else 0.5) for q, syn in SEARCHES for t in [q, *syn]]


_BM = f"""with c as (select doc_id, term, count(*) as tf from (select doc_id, unnest({_WORDS.format('text')}) as term from documents) where length(term) >= 2 and term not in ({_STOP}) group by all),
l as (select doc_id, coalesce(sum(tf), 0) as length from documents left join c using (doc_id) group by doc_id), m as (select count(*) as n, avg(length) as mean from l),
s(query, stem, weight) as (values {", ".join(f"('{q}', '{t}', {w})" for q, t, w in _search_terms())}), h as (select doc_id, query, c.term, max(weight) as weight, any_value(tf) as tf from c join s on starts_with(c.term, stem) group by all),
f as (select term, count(distinct doc_id) as df from h group by term)
select query, doc_id, round(sum(weight * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean))), 6) as score from h join f using (term) join l using (doc_id), m group by all"""


@query(_BM)
def synonym_search(spark, d):
    """Documents for searches: words that begin with a term or, at half weight, with a synonym."""
    docs = table(spark, d, "documents").select("doc_id", content_words(F.col("text")).alias("w"))
    stems_ = F.array(*[F.lit(t) for _, t, _ in _search_terms()])
    # only words that begin as asked are taken apart
    counts = term_counts(docs.select("doc_id", F.filter("w", lambda w: F.exists(stems_, lambda s: w.startswith(s))).alias("w")), "doc_id", "w")
    lengths = docs.select("doc_id", F.size("w").alias("length"))
    known = counts.select("term").distinct()
    asked = spark.createDataFrame(_search_terms(), "query string, stem string, weight double")
    terms = known.join(F.broadcast(asked), F.expr("startswith(term, stem)")).groupBy("query", "term").agg(F.max("weight").alias("weight"))
    return bm25(counts, lengths, terms, "doc_id", "query").select("query", "doc_id", F.round("score", 6).alias("score"))
