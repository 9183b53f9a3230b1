"""Queries that search the rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.danish import content_words
from ..operators.search import AS_FUZZY, AS_PREFIX, BOOSTS, K1, B, concept_words, excerpt, searched
from .base import CONTENT, X, query, quoted, versions
from .texts import _STOP, _WORDS

#: A thesaurus: words and phrases that should find each other.
THESAURUS = [["gebyr", "afgift", "kontingent"], ["hjælper", "frivillige hjælpere"], ["dommer", "kampleder", "jurymedlem"], ["fordeling", "nye medlemmer"], ["adgang", "udenlandske gæster"]]
SEARCHES = 24


def rule_texts(v):
    """(key, field, text): what is searched of a rule: title, what it says now, its history, its note and its category."""
    content = F.when(F.col("effekt").isin(*CONTENT), 1).otherwise(0)
    g = v.groupBy(F.col("slug").alias("key")).agg(F.min("titel").alias("title"), F.max(F.struct(content.alias("c"), "effective", "decided", "idx", "text")).alias("x"), F.min("note").alias("note"), F.min("kategori").alias("area"))
    fields = F.array(*[F.struct(F.lit(n).alias("field"), c.alias("text")) for n, c in (("title", F.col("title")), ("summary", F.col("x.text")), ("note", F.col("note")), ("area", F.col("area")))])
    return g.select("key", F.explode(fields).alias("f")).select("key", "f.*").unionByName(v.select(F.col("slug").alias("key"), F.lit("history").alias("field"), F.col("change").alias("text")))


def _searches(v):
    """The commonest words of titles, two by two, as searches: a report of the first few."""
    top = v.groupBy("slug").agg(F.min("titel").alias("titel")).select(F.explode(content_words(F.col("titel"))).alias("w")).groupBy("w").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").limit(SEARCHES).collect()
    words = [r["w"] for r in top]
    return v.sparkSession.createDataFrame([(f"{a} {b}",) for a, b in zip(words[::2], words[1::2])], "query string")


_T = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_]+')"
_FIND = f"""with {X}, latest as (select slug, text from (select *, row_number() over (partition by slug order by case when effekt in ({quoted(CONTENT)}) then 1 else 0 end desc, effective desc, decided desc, idx desc, text desc) as k from x) where k = 1),
ru as (select slug as key, min(titel) as title, min(note) as note, min(kategori) as area from x group by slug),
tx as (select key, 'title' as field, title as text from ru union all select slug, 'summary', text from latest union all select key, 'note', note from ru union all select key, 'area', area from ru union all select slug, 'history', change from x),
cw as (select key, field, word, count(*) as n from (select key, field, unnest({_WORDS.format('text')}) as word from tx) where length(word) >= 2 and word not in ({_STOP}) group by all),
voc as (select distinct word from cw), th(part, concept) as (values {", ".join(f"('{p}', '{c}')" for p, c in concept_words(THESAURUS))}),
tw as (select word as w, count(*) as n from (select key, unnest({_WORDS.format('title')}) as word from ru) where length(word) >= 2 and word not in ({_STOP}) group by 1 order by n desc, w limit {SEARCHES}),
rk as (select w, row_number() over (order by n desc, w) as i from tw), qs as (select a.w || ' ' || b.w as query from rk a join rk b on b.i = a.i + 1 where a.i % 2 = 1),
qw as (select distinct query, unnest({_WORDS.format('query')}) as word from qs),
hv as (select word, left(word, i::int) as l, substr(word, i::int + 1) as r from (select word, unnest(range(3, length(word) - 3)) as i from (select word from voc union select word from qw) where length(word) >= 7)),
sp as (select word, r, case when l in (select word from voc where length(word) >= 3) then l when right(l, 1) in ('s', 'e') and left(l, -1) in (select word from voc where length(word) >= 3) then left(l, -1) end as l from hv where r in (select word from voc where length(word) >= 3)),
pt as (select word, word as part from voc union select word, unnest([l, r]) from sp where l is not null and word in (select word from voc)),
tm as (select word, part as term from pt union select word, concept from pt join th using (part)),
bg as (select key, field, concept as term, count(*) as tf from (select key, field, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as part from (select key, field, {_WORDS.format('text')} as w from tx) where len(w) >= 2) join th using (part) group by all),
po as (select key, field, term, sum(tf) as tf from (select key, field, term, sum(n) as tf from cw join tm using (word) group by all union all select * from bg) group by all),
le as (select key, field, sum(n) as n from cw group by all), me as (select field, avg(n) as mean from le group by 1), al as (select count(distinct key) as al from tx),
ask as (select query, word as c, word, 1.0 as factor, 1 as need from qw union select query, l || '+' || r, unnest([l, r]), 0.7, case when l = r then 1 else 2 end from sp join qw using (word) where l is not null),
so as (select query, c, ask.word, factor, need, voc.word as term, case when voc.word = ask.word then 1.0 when length(ask.word) >= 3 and starts_with(voc.word, ask.word) then {AS_PREFIX} * length(ask.word) / (length(ask.word) + 0.3 * (length(voc.word) - length(ask.word)))
  when length(ask.word) >= 5 and not starts_with(voc.word, ask.word) and levenshtein(ask.word, voc.word) <= round(0.2 * length(ask.word)) then {AS_FUZZY} * length(ask.word) / (length(ask.word) + levenshtein(ask.word, voc.word)) end as w from ask, voc),
co as (select query, concept from qw join th on part = word union select query, concept from (select query, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as part from (select query, {_T.format('query')} as w from qs)) join th using (part)),
sg as (select * from so where w is not null union all select query, concept, concept, 0.5, 1, concept, 1.0 from co), bo(field, boost) as (values {", ".join(f"('{f}', {b})" for f, b in BOOSTS.items())}),
hi as (select * from po where term in (select term from sg)), dfs as (select field, term, count(*) as df from hi group by all),
va as (select hi.key, term, sum(boost * ln(1 + (al - df + 0.5) / (df + 0.5)) * tf * {K1 + 1} / (tf + {K1} * ({1 - B} + {B} * coalesce(n, 0) / mean))) as v from hi join dfs using (field, term) left join le using (key, field) join me using (field) join bo using (field), al group by all),
ea as (select query, c, factor, need, key, word, sum(w * v) as s from va join sg using (term) group by all), pa as (select query, c, factor, need, key, sum(s) as s from ea group by all having count(*) >= need),
tt as (select query, key, sum(factor * s) as score from pa group by all)"""


@query(_FIND + " select query, key, round(score, 6) as score from tt qualify score >= 0.12 * max(score) over (partition by query)")
def rule_search(spark, d):
    """What searches of two common title words find among the rules, by field, with prefixes, typing errors, compounds and a thesaurus."""
    v = versions(spark, d)
    return searched(_searches(v), rule_texts(v), THESAURUS)


@query(_FIND + r""", ws as (select key, regexp_extract_all(coalesce(text, ''), '[\p{L}\p{N}_]+') as w from tx where field = 'summary'), ts as (select query, list(distinct word) as t from qw group by 1),
h as (select query, key, w, list_transform(w, lambda x: list_bool_or(list_transform(t, lambda y: starts_with(lower(x), y)))) as h from ws, ts), p as (select *, list_position(h, true) as p from h),
s as (select query, key, w, h, greatest(p - 6, 1) as a from p where p > 0)
select query, key, array_to_string(list_transform(range(a, least(a + 24, len(w) + 1)), lambda i: case when h[i] then '<mark>' || w[i] || '</mark>' else w[i] end), ' ') as excerpt from s""")
def rule_excerpts(spark, d):
    """The words of what each rule says around the first that a search begins, matches marked."""
    v = versions(spark, d)
    asked = _searches(v)
    terms = asked.select("query", F.explode(content_words(F.col("query"))).alias("term")).distinct()
    return excerpt(rule_texts(v).where("field = 'summary'").select("key", "text"), terms)
