"""Queries that write the tables as the files they come from and read them back: nested JSON, logs, HTML and bytes."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..functions.text import squeezed
from ..sources.documents import html_links, html_texts, linked_documents, page_words, synced
from ..sources.files import append_log, extracted_decisions, filed_versions, manifest, run_log, slug_registry, stored_arrays
from ..sources.tables import removed_at_end, shared_dir, table
from .base import D, V, decisions, query, rule_versions
from .changes import _SQ

#: Numbers of a document, or places of a rule, that one file holds.
BLOCK = 1000


def _place(spark, what: str) -> tuple[str, str]:
    """The shared folder and a new place in it."""
    root = shared_dir(spark)
    path = os.path.join(root, f"{what}-{uuid.uuid4().hex}")
    removed_at_end(spark, path)
    return root, path


@query("select distinct id, organ, title, date, path, url, sha256 from doc")
def manifest_read_back(spark, d):
    root, path = _place(spark, "manifest")
    stored_arrays(table(spark, d, "doc").distinct(), path, within=root)
    return manifest(spark, path)


@query(f"""with {D}, p as (select ref, min(side) as side from decision group by ref), n as (select d.*, side, try_cast(regexp_extract(ref, '#([0-9]+)$', 1) as int) // 1000 as block from d join p using (ref))
select ref, doc_id, dato, emne, udfald, tekst, side as page, row_number() over (partition by doc_id, block order by rank, ref) - 1 as rank from n""")
def decisions_read_back(spark, d):
    """The decisions from extraction files, which hold a thousand numbers of a document each."""
    root, path = _place(spark, "extractions")
    page = table(spark, d, "decision").groupBy("ref").agg(F.min("side").alias("side"))
    rows = decisions(spark, d).join(page, "ref").withColumn("block", F.floor(F.expr("try_cast(substring_index(ref, '#', -1) as int)") / BLOCK))
    fields = ["emne", "kategori", "udfald", "forslagsstiller", "handling", "niveau", "tekst", "citat", "side", "stemmer", "gaelder_fra", "gaelder_til", "citat_fundet"]
    listed = F.array_sort(F.collect_list(F.struct("rank", "ref", F.struct(F.col("ref").alias("id"), *fields).alias("b"))))
    # the date of a meeting is its decision's, so decisions of different dates are in files of their own
    files = rows.withColumn("d", F.coalesce("dato", F.lit(""))).groupBy("doc_id", "block", F.lit(1).alias("version")).agg(F.max("dato").alias("moededato"), listed.alias("l"))
    stored_arrays(files.select("doc_id", "version", "moededato", F.col("l.b").alias("beslutninger")), path, within=root)
    back = extracted_decisions(spark, path)
    return back.join(decisions(spark, d).select("ref", F.col("dato").alias("own")), "ref").select("ref", "doc_id", F.col("own").alias("dato"), "emne", "udfald", "tekst", "page", "rank")


@query(f"with {V} select slug, kategori, titel, vigtig, note, ref, effekt, tekst, kort, kort_regel, dhash, row_number() over (partition by slug, kategori, titel, vigtig, note, idx // 1000 order by idx, ref) - 1 as idx from v")
def rules_read_back(spark, d):
    """The versions from rule files, which hold a thousand places of a rule each."""
    root, path = _place(spark, "rules")
    v = rule_versions(spark, d).withColumn("block", F.floor(F.col("idx") / BLOCK))
    one = F.struct("idx", "ref", F.struct("ref", "effekt", "tekst", "kort", "kort_regel", "dhash").alias("v"))
    rules = v.groupBy("kategori", "slug", "titel", "vigtig", "note", "block").agg(F.array_sort(F.collect_list(one)).alias("l"))
    files = rules.select("kategori", F.array(F.struct("titel", "slug", "vigtig", "note", F.col("l.v").alias("versioner"))).alias("regler"))
    stored_arrays(files, path, within=root)
    return filed_versions(spark, path)


@query("select ts::varchar as time, event_type as command, user_id::varchar as audit, 'ask' as step, 1 as calls, round(value, 6) as cost_usd from events")
def run_log_read_back(spark, d):
    """A run log that two runs have appended to, the first of which was cut off in its last lines."""
    root, path = _place(spark, "log")
    e = table(spark, d, "events")
    step = F.struct(F.lit(1).alias("calls"), F.round("value", 6).alias("cost_usd"))
    rows = e.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("t"), F.col("ts").cast("string").alias("time"), F.col("event_type").alias("command"), F.col("user_id").cast("string").alias("audit"), F.create_map(F.lit("ask"), step).alias("steps"), (F.col("user_id") % 2).alias("run")).drop("t")
    cut = rows.where("run = 0").select(F.expr("left(to_json(struct(time, command, steps)), 40)").alias("value"))
    append_log(rows.where("run = 0").drop("run"), path, within=root)
    cut.write.mode("append").text(path)
    append_log(rows.where("run = 1").drop("run"), path, within=root)
    return run_log(spark, path).select("time", "command", "audit", "step", "calls", "cost_usd")


@query(f"with {V}, r as (select distinct slug, kategori from v) select slug as src, case when hash_ < 8 then regexp_replace(slug, '-[0-9]+$', '') end as dst from (select slug, ('0x' || left(md5(slug), 1))::int as hash_ from r)")
def slug_register_read_back(spark, d):
    """A register of former slugs, half of them aliases and half retired."""
    root, path = _place(spark, "slugs")
    r = rule_versions(spark, d).select("slug", "kategori").distinct().withColumn("live", F.conv(F.substring(F.md5("slug"), 1, 1), 16, 10).cast("int") < 8)
    entry = F.struct(F.regexp_replace("slug", "-[0-9]+$", "").alias("to"), F.col("kategori").alias("category"))
    files = r.select(F.when(F.col("live"), F.create_map("slug", entry)).alias("aliases"), F.when(~F.col("live"), F.create_map("slug", F.struct(F.col("kategori").alias("category")))).alias("retired"))
    stored_arrays(files, path, within=root)
    return slug_registry(spark, path)


def _escaped(c):
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


@query(f"with t as (select distinct id, {_SQ.format('title')} as title from doc) select id || ' ' || k as key, title as text from t, (values (0), (1), (2)) s(k)")
def pages_decoded(spark, d):
    """Titles as HTML pages in bytes of three encodings, one with a mark, one declared, one neither, read back as text."""
    t = table(spark, d, "doc").select("id", squeezed("title").alias("title")).distinct().select("id", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("k"), "title")
    html = F.concat(F.lit("<html><head><style>p {}</style></head><body><p>"), _escaped(F.col("title")), F.lit("</p></body></html>"))
    body = F.when(F.col("k") == 0, F.concat(F.unhex(F.lit("EFBBBF")), F.encode(html, "UTF-8"))).when(F.col("k") == 1, F.encode(html, "ISO-8859-1")).otherwise(F.encode(html, "UTF-8"))
    pages = t.select(F.concat_ws(" ", "id", F.col("k").cast("string")).alias("key"), body.alias("body"), F.when(F.col("k") == 1, "latin-1").alias("charset"))
    return html_texts(pages, "key", "body", "charset")


@query(f"""with l as (select distinct coalesce(url, path) as url, {_SQ.format('title')} as title, organ, id from doc), f as (select url, title, organ from l qualify row_number() over (partition by url order by id, title) = 1)
select url, title, case when organ = 'kongres' then 'congress' when organ = 'ungdom' then 'menu' else organ end as organ from f where not starts_with(title, 'Beslutning')""")
def index_links(spark, d):
    """The documents that index pages link to, by the organ of their heading; those of the youth stand under none, as in a menu. Decisions are passed over."""
    l = table(spark, d, "doc").select(F.coalesce("url", "path").alias("url"), squeezed("title").alias("title"), "organ", "id").distinct()
    first = l.groupBy("url").agg(F.min(F.struct("id", "title", "organ")).alias("x")).select("url", "x.id", "x.title", "x.organ")
    link = F.concat(F.lit('<a href="'), _escaped(F.col("url")), F.lit('">'), _escaped(F.col("title")), F.lit("</a>"))
    head = F.when(F.col("organ") == "ungdom", "").otherwise(F.concat(F.lit("<p><b>"), F.col("organ"), F.lit("</b></p>")))
    # a page for every link, and one of a few links of each organ would do as well: headings hold until the next
    pages = first.select(F.col("id").alias("page"), F.concat(head, link).alias("html"))
    return linked_documents(html_links(pages, "page", "html"), {"Kongres": "congress"}, {"ungdom": "menu", "/": "menu"}, "Beslutning")


@query("""with a as (select lower(id) as l, min_by(id, title) as n, min_by(length(title), title) as size from (select distinct id, title from doc) group by 1), b as (select lower(doc_id) as l, min(doc_id) as n, max(length(doc_id)) as size from decision_snapshot group by 1)
select coalesce(a.n, b.n) as name, case when a.n is null then 'local' when b.n is null then 'linked' else 'both' end as source, a.n is not null and a.size is not distinct from b.size as fresh from a full join b using (l)""")
def documents_synced(spark, d):
    """The documents that are listed and those of which decisions are kept, as a sync of linked and local files sees them."""
    linked = table(spark, d, "doc").select("id", "title").distinct().select(F.col("id").alias("name"), F.col("title").alias("place"), F.length("title").alias("size"))
    local = table(spark, d, "decision_snapshot").select(F.col("doc_id").alias("name"), F.length("doc_id").alias("size")).distinct()
    return synced(linked, local)


@query(r"""with w as (select doc_id, regexp_replace(text, '\[Side [0-9]+\]', '', 'g') as t from documents where text is not null), n as (select doc_id, len(regexp_extract_all(lower(t), '[\p{L}\p{N}_]+')) as words from w)
select doc_id, words from n where words > 0""")
def words_counted(spark, d):
    """The words of each document outside its page marks, each with its place in the text."""
    return page_words(table(spark, d, "documents"), "doc_id", "text").groupBy("doc_id").agg(F.count("*").alias("words"))
