"""Queries that rank the rules a decision may belong to: stems, compound parts and weighted titles by TF-IDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.danish import content_words, term_map
from ..operators.ranking import block_scores, idf, packed_vectors, unbeaten, unit_vectors
from ..sources.tables import written
from .base import CATEGORIES, CONTENT, X, decisions, query, quoted, versions
from .texts import _STOP, _WORDS

#: How often the words of a title count, the boost of rules in the decision's own category, how many are offered, the similarity of rules that are shown
#: together, and the numbers of candidates at which recall is measured with the recall wanted.
TITLE, BOOST, OFFERED, SIMILAR, KS, TARGET = 2, 0.3, 15, 0.1, (3, 5, 8, 10, 15), 0.98


def _asked(ref: str) -> Column:
    """The stated set of queries: refs whose number, by their hash, is divisible by 100."""
    return F.conv(F.substring(F.md5(ref), 1, 15), 16, 10).cast("bigint") % 100 == 0


_ASKED = "('0x' || substr(md5({0}), 1, 15))::bigint % 100 = 0"


def profiles(v: DataFrame) -> DataFrame:
    """(slug, category, text, weight): what the ranking reads of a rule: its title, the text and short form of its last version with content (else of its last), and the subject of
    each of its decisions.
    """
    content = F.when(F.col("effekt").isin(*CONTENT), 1).otherwise(0)
    last = v.groupBy("slug").agg(F.min("kategori").alias("category"), F.min("titel").alias("titel"), F.max(F.struct(content.alias("c"), "effective", "decided", "idx", "text", "kort_regel")).alias("x"))
    own = F.array(*[F.struct(c.alias("text"), F.lit(w).alias("weight")) for c, w in ((F.col("titel"), TITLE), (F.col("x.text"), 1), (F.col("x.kort_regel"), 1))])
    fixed = last.select("slug", F.explode(own).alias("t")).select("slug", "t.text", "t.weight")
    return fixed.unionByName(v.groupBy("slug", F.col("emne").alias("text")).agg(F.count("*").cast("int").alias("weight")))


def counted(texts: DataFrame, key: str) -> DataFrame:
    """(key, word, n): weighted counts of the content words of texts (key, text, weight)."""
    return texts.select(key, "weight", F.explode(content_words(F.col("text"))).alias("word")).groupBy(key, "word").agg(F.sum("weight").alias("n"))


def _index(spark, d, stemmed: bool):
    """The versions, the rules, the counts of their terms, the terms of words and the weights of terms."""
    v = versions(spark, d)
    rules = v.groupBy(F.col("slug").alias("key")).agg(F.min("kategori").alias("category"))
    said = written(counted(profiles(v), "slug"), "rule-words")
    asked = decisions(spark, d).where(_asked("ref")).select("ref", F.col("kategori").alias("category"), "emne", "tekst")
    pieces = F.explode(F.array(F.struct(F.col("emne").alias("text"), F.lit(TITLE).alias("weight")), F.struct(F.col("tekst").alias("text"), F.lit(1).alias("weight")))).alias("t")
    questions = written(counted(asked.select("ref", pieces).select("ref", "t.text", "t.weight"), "ref"), "question-words")
    vocabulary = said.select("word").distinct()
    terms = written(term_map(vocabulary.unionByName(questions.select("word")).distinct(), vocabulary, stemmed=stemmed), "terms")
    counts = written(_terms(said, terms, "slug"), "rule-terms")
    weights = written(idf(counts.withColumnRenamed("slug", "key"), rules.count()), "weights")
    return v, asked, rules, counts, _terms(questions, terms, "ref"), terms, weights


def _terms(counts: DataFrame, terms: DataFrame, key: str) -> DataFrame:
    return counts.join(terms, "word").groupBy(key, "term").agg(F.sum(F.col("n") * F.col("times")).alias("tf"))


def _rows(rules: DataFrame, counts: DataFrame, weights: DataFrame) -> DataFrame:
    return written(packed_vectors(rules, unit_vectors(counts.withColumnRenamed("slug", "key"), weights, "key"), "key"), "rule-vectors")


def _queries(keyed: DataFrame, vectors: DataFrame, excluded=None) -> DataFrame:
    q = packed_vectors(keyed.withColumnRenamed("ref", "query"), vectors.withColumnRenamed("ref", "query"), "query")
    none = F.array().cast("array<string>")
    return q.select("query", "category", "terms", "ws", (none if excluded is None else F.coalesce(excluded, none)).alias("excluded"), *unbeaten())


def _ranked(spark, d, *, stemmed: bool, but_own: bool) -> DataFrame:
    v, asked, rules, counts, questions, _, weights = _index(spark, d, stemmed)
    rows = _rows(rules, counts, weights)
    keyed, excluded = asked.select("ref", "category"), None
    if but_own:
        keyed = keyed.join(v.groupBy("ref").agg(F.collect_set("slug").alias("holders")), "ref", "left")
        excluded = F.col("holders")
    q = _queries(keyed, unit_vectors(questions, weights, "ref"), excluded)
    return block_scores(q, rows, boost=BOOST, k=OFFERED).select(F.col("query").alias("ref"), F.col("key").alias("slug"), "score")


_TERMS = f"""prof as (select slug, titel as text, 2 as weight from (select slug, min(titel) as titel from x group by slug)
 union all select slug, unnest([text, kort_regel]), 1 from (select * from x qualify row_number() over (partition by slug order by case when effekt in ('indfoert', 'aendret', 'bekraeftet') then 1 else 0 end desc, effective desc, decided desc, idx desc, text desc) = 1)
 union all select slug, emne, 1 from x),
asked as (select ref, kategori as category, emne, tekst from d where {_ASKED.format('ref')}),
rw as (select slug, word, sum(weight) as n from (select slug, weight, unnest({_WORDS.format('text')}) as word from prof) where length(word) >= 2 and word not in ({_STOP}) group by all),
qw as (select ref, word, sum(weight) as n from (select ref, 2 as weight, unnest({_WORDS.format('emne')}) as word from asked union all select ref, 1, unnest({_WORDS.format('tekst')}) from asked) where length(word) >= 2 and word not in ({_STOP}) group by all),
voc as (select distinct word from rw where length(word) >= 3), every as (select word from rw union select word from qw),
h as (select word, left(word, i::int) as l, substr(word, i::int + 1) as r from (select word, unnest(range(3, length(word) - 3)) as i from every where length(word) >= 7)),
sp as (select word, r, case when l in (select word from voc) then l when right(l, 1) in ('s', 'e') and left(l, -1) in (select word from voc) then left(l, -1) end as l from h where r in (select word from voc)),
tm as (select word, term, count(*) as times from (select word, word as term from every union all select word, unnest([l, r]) from sp where l is not null) group by all),
rt as (select slug, term, sum(n * times) as tf from rw join tm using (word) group by all), qt as (select ref, term, sum(n * times) as tf from qw join tm using (word) group by all),
cnt as (select count(distinct slug) as n from x), wt as (select term, ln((n + 1) / (count(*) + 1)) + 1 as idf from rt, cnt group by term, n),
rv0 as (select slug, term, (1 + ln(tf)) * idf as raw from rt join wt using (term)), rv as (select slug, term, raw / sqrt(sum(raw * raw) over (partition by slug)) as w from rv0),
qv0 as (select ref, term, (1 + ln(tf)) * idf as raw from qt join wt using (term)), qv as (select ref, term, raw / sqrt(sum(raw * raw) over (partition by ref)) as w from qv0),
cat as (select slug, min(kategori) as category from x group by slug), dot as (select ref, slug, sum(qv.w * rv.w) as s from qv join rv using (term) group by all),
sc as (select asked.ref, cat.slug, round(coalesce(s, 0) * case when asked.category = cat.category then 1.3 else 1 end, 9) as score from asked cross join cat left join dot on dot.ref = asked.ref and dot.slug = cat.slug)"""


@query()
def rule_candidates(spark, d):
    """The fifteen rules closest to each decision asked for, by stems and compound parts."""
    return _ranked(spark, d, stemmed=True, but_own=False)


@query(f"with {X}, {_TERMS} select ref, slug, score from sc qualify row_number() over (partition by ref order by score desc, slug) <= 15")
def rule_candidates_by_words(spark, d):
    """``rule_candidates`` by whole words and compound parts, without stems."""
    return _ranked(spark, d, stemmed=False, but_own=False)


@query(f"with {X}, {_TERMS} select ref, slug, score from sc anti join x using (ref, slug) qualify row_number() over (partition by ref order by score desc, slug) <= 15")
def rule_candidates_but_own(spark, d):
    """The fifteen closest rules that do not hold the decision, by words."""
    return _ranked(spark, d, stemmed=False, but_own=True)


def _similar(spark, d) -> DataFrame:
    _, _, rules, counts, _, _, weights = _index(spark, d, False)
    rows = _rows(rules, counts, weights)
    q = rows.where(_asked("key")).select(F.col("key").alias("query"), "category", "terms", "ws", F.array("key").alias("excluded"), *unbeaten())
    return block_scores(q, rows, least=SIMILAR).join(rules.select("key", F.col("category").alias("to")), "key").join(rules.select(F.col("key").alias("query"), F.col("category").alias("of")), "query")


_SIMILAR = f"sim as (select a.slug as query, b.slug as key, round(sum(a.w * b.w), 9) as score from rv a join rv b using (term) where a.slug <> b.slug and {_ASKED.format('a.slug')} group by all having round(sum(a.w * b.w), 9) >= 0.1)"


@query(f"with {X}, {_TERMS}, {_SIMILAR} select query, key, score from sim")
def similar_rules(spark, d):
    """The rules at least 0.1 similar to each rule asked for, by words, in any category."""
    return _similar(spark, d).select("query", "key", "score")


@query(f"with {X}, {_TERMS}, {_SIMILAR} select a.category, key, max(score) as closeness from sim join cat a on a.slug = query join cat b on b.slug = key where a.category <> b.category group by all")
def neighbours_of_categories(spark, d):
    """The rules of other categories near a rule asked for, with the greatest similarity to any."""
    return _similar(spark, d).where(F.col("of") != F.col("to")).groupBy(F.col("of").alias("category"), "key").agg(F.max("score").alias("closeness"))


_NEXT = " ".join(f"when '{c}' then '{CATEGORIES[(i + 1) % len(CATEGORIES)]}'" for i, c in enumerate(CATEGORIES))


@query(f"with {X} select distinct kategori, case kategori {_NEXT} end as relabelled from v where kategori in ({quoted(CATEGORIES)})")
def relabelled_categories(spark, d):
    """The category after each in their order, the first after the last."""
    return versions(spark, d).select("kategori").distinct().select("kategori", relabelled(F.col("kategori")).alias("relabelled")).where("relabelled is not null")


def relabelled(category):
    names = F.array(*map(F.lit, CATEGORIES))
    return F.when(F.array_position(names, category) > 0, F.element_at(names, (F.array_position(names, category) % len(CATEGORIES) + 1).cast("int")))


def _hidden(spark, d, stemmed: bool) -> DataFrame:
    """(ref, slug, category, rank, relabelled): each decision asked for that is in a rule with others too, hidden from it, and the place of that rule among all for it.

    What the rule says without the decision is taken from its counts: the decision's subject is taken off, and where it gave the rule's text the version before
    it does. The weights of terms are those of all rules as they are.
    """
    v, asked, rules, counts, questions, terms, weights = _index(spark, d, stemmed)
    content = F.when(F.col("effekt").isin(*CONTENT), 1).otherwise(0)
    latest = F.struct(content.alias("c"), "effective", "decided", "idx", "text", "kort_regel", "ref")
    two = v.groupBy("slug").agg(F.max(latest).alias("one"), F.count("*").alias("n")).where("n > 1")
    second = v.join(two.select("slug", F.col("one.ref").alias("top")), "slug").where("ref <> top").groupBy("slug").agg(F.max(latest).alias("two"))
    hidden = v.where(_asked("ref")).select("slug", "ref", "emne").join(two.select("slug", "one"), "slug").join(second, "slug").withColumn("id", F.concat_ws(" ", "ref", "slug"))
    hidden = written(hidden, "hidden")
    was = F.col("one.ref") == F.col("ref")
    change = F.array(
        F.struct(F.col("emne").alias("text"), F.lit(-1).alias("weight")),
        *[F.struct(F.when(was, F.col(f"{x}.{c}")).alias("text"), F.lit(w).alias("weight")) for x, w in (("one", -1), ("two", 1)) for c in ("text", "kort_regel")],
    )
    moved = _terms(counted(hidden.select("id", F.explode(change).alias("t")).select("id", "t.text", "t.weight"), "id"), terms, "id")
    before = hidden.select("id", "slug").join(counts, "slug").select("id", "term", "tf")
    left = before.unionByName(moved.select("id", "term", "tf")).groupBy("id", "term").agg(F.sum("tf").alias("tf")).where("tf > 0")
    mine = unit_vectors(left, weights, "id").select("id", "term", F.col("w").alias("mine"))
    asks = unit_vectors(questions, weights, "ref")
    kept = hidden.select("id", "slug", "ref").join(rules.select(F.col("key").alias("slug"), F.col("category").alias("of")), "slug").join(asked.select("ref", "category"), "ref")
    same = mine.join(hidden.select("id", "ref"), "id").join(asks, ["ref", "term"]).groupBy("id").agg(F.sum(F.col("mine") * F.col("w")).alias("s"))
    kept = kept.join(same, "id", "left").withColumn("s", F.coalesce("s", F.lit(0.0)))
    both = kept.select("*", F.explode(F.array(F.struct(F.lit(0).alias("k"), F.col("category").alias("as")), F.struct(F.lit(1).alias("k"), relabelled(F.col("category")).alias("as")))).alias("y"))
    own = F.round(F.col("s") * F.when(F.col("of") == F.col("y.as"), 1 + BOOST).otherwise(1.0), 9)
    both = written(both.select(F.concat_ws(" ", "id", F.col("y.k").cast("string")).alias("query"), F.col("y.as").alias("category"), "ref", "slug", "of", F.col("y.k").alias("k"), own.alias("own")), "asked")
    vectors = both.select("query", "ref").join(asks, "ref").select("query", "term", "w")
    q = packed_vectors(both, vectors, "query").select("query", "category", "terms", "ws", F.array("slug").alias("excluded"), "own", F.col("slug").alias("own_key"))
    ahead = block_scores(q, _rows(rules, counts, weights), boost=BOOST)
    ranks = both.join(ahead, "query").groupBy("ref", "slug", F.col("of").alias("category"))
    return ranks.agg(*[(F.max(F.when(F.col("k") == i, F.col("ahead"))) + 1).alias(c) for i, c in ((0, "rank"), (1, "relabelled"))])


_HIDDEN = f"""{_TERMS}, lt as (select *, row_number() over (partition by slug order by case when effekt in ('indfoert', 'aendret', 'bekraeftet') then 1 else 0 end desc, effective desc, decided desc, idx desc) as k, count(*) over (partition by slug) as many from x),
hid as (select a.slug, a.ref, a.emne, a.k, b.text as t1, b.kort_regel as r1, c.text as t2, c.kort_regel as r2 from lt a join lt b on b.slug = a.slug and b.k = 1 join lt c on c.slug = a.slug and c.k = 2 where {_ASKED.format('a.ref')}),
mv as (select slug, ref, word, sum(weight) as n from (select slug, ref, -1 as weight, unnest({_WORDS.format('emne')}) as word from hid
 union all select slug, ref, -1, unnest({_WORDS.format('t1')} || {_WORDS.format('r1')}) from hid where k = 1 union all select slug, ref, 1, unnest({_WORDS.format('t2')} || {_WORDS.format('r2')}) from hid where k = 1)
 where length(word) >= 2 and word not in ({_STOP}) group by all),
mt as (select slug, ref, term, sum(tf) as tf from (select hid.slug, ref, term, tf from hid join rt using (slug) union all select slug, ref, term, n * times from mv join tm using (word)) group by all having sum(tf) > 0),
mw as (select slug, ref, term, raw / sqrt(sum(raw * raw) over (partition by slug, ref)) as w from (select slug, ref, term, (1 + ln(tf)) * idf as raw from mt join wt using (term))),
ms as (select slug, mw.ref, sum(mw.w * qv.w) as s from mw join qv on qv.ref = mw.ref and qv.term = mw.term group by all),
own as (select hid.slug, hid.ref, k2, case when k2 = 0 then asked.category else case asked.category {_NEXT} end end as as_, coalesce(s, 0) as s, cat.category as of from hid join asked using (ref) join cat on cat.slug = hid.slug left join ms on ms.slug = hid.slug and ms.ref = hid.ref, (values (0), (1)) t(k2)),
rk as (select own.slug, own.ref, of as category, k2, 1 + count(*) filter (round(coalesce(dot.s, 0) * case when o.category = as_ then 1.3 else 1 end, 9) > round(own.s * case when of = as_ then 1.3 else 1 end, 9)
  or (round(coalesce(dot.s, 0) * case when o.category = as_ then 1.3 else 1 end, 9) = round(own.s * case when of = as_ then 1.3 else 1 end, 9) and o.slug < own.slug)) as rank
  from own join cat o on o.slug <> own.slug left join dot on dot.ref = own.ref and dot.slug = o.slug group by all),
hr as (select ref, slug, category, max(rank) filter (k2 = 0) as rank, max(rank) filter (k2 = 1) as relabelled from rk group by all)"""


@query(f"with {X}, {_HIDDEN} select * from hr")
def hidden_ranks(spark, d):
    """The place of each asked decision's own rule with the decision hidden from it, by words; and with the decision's category changed to the next."""
    return _hidden(spark, d, False)


@query()
def hidden_ranks_by_stems(spark, d):
    return _hidden(spark, d, True)


@query(f"with {X}, {_HIDDEN} select n as k, avg(case when rank <= n then 1.0 else 0.0 end) as recall, avg(case when relabelled <= n then 1.0 else 0.0 end) as relabelled, n = (select min(m) from (select m, avg(case when rank <= m then 1.0 else 0.0 end) as a from hr, (values (3), (5), (8), (10), (15)) u(m) group by m) where a >= 0.98) as chosen from hr, (values (3), (5), (8), (10), (15)) t(n) group by n")
def candidate_recall(spark, d):
    """The share of hidden decisions whose rule is among the k best, and whether k is the smallest that reaches the recall wanted; null if none does."""
    h = _hidden(spark, d, False)
    hit = [F.avg(F.when(F.col(c) <= F.col("k"), 1.0).otherwise(0.0)).alias(n) for c, n in (("rank", "recall"), ("relabelled", "relabelled"))]
    each = written(h.select("rank", "relabelled", F.explode(F.array(*map(F.lit, KS))).alias("k")).groupBy("k").agg(*hit), "recall")
    chosen = F.broadcast(each.agg(F.min(F.when(F.col("recall") >= TARGET, F.col("k"))).alias("c")))  # one row
    return each.crossJoin(chosen).select("k", "recall", "relabelled", (F.col("k") == F.col("c")).alias("chosen"))
