"""Search over documents of several fields: prefixes, typing errors, compounds and concepts, ranked by BM25."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.danish import compound_splits, content_words, term_map
from ..sources.tables import written
from .quotes import grams

#: Boosts of the fields; factors of what both parts of a compound, and a concept, find; the share of the best score below which a hit is noise. Fixed values.
BOOSTS, BOTH, CONCEPT, FLOOR = {"title": 3.0, "summary": 1.5, "history": 1.0, "note": 0.5, "area": 1.0}, 0.7, 0.5, 0.12
#: A prefix counts from so many letters on, a typing error from so many, of at most this share of the letters. Fixed values.
PREFIX, FUZZY, SHARE = 3, 5, 0.2
#: Weights of a prefix and of a word with typing errors, and the constants of BM25.
AS_PREFIX, AS_FUZZY, K1, B = 0.375, 0.45, 1.2, 0.7


def concept_words(groups: Sequence[Sequence[str]]) -> list[tuple[str, str]]:
    """(phrase, concept): the words and phrases of a thesaurus with the term of their group."""
    return [(" ".join(p.lower().split()), f"#{i}") for i, g in enumerate(groups) for p in g]


def indexed(texts: DataFrame, groups: Sequence[Sequence[str]]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The index of texts (key, field, text): postings (key, field, term, tf), lengths (key, field, n), and the distinct words.

    A word counts as itself, as the parts of a compound, and as the concepts of these; two words that are a phrase of the thesaurus count as its concept, stop words among
    them included. A posting is combined before it is shuffled, so a common word is no hot key.
    """
    spark = texts.sparkSession
    known = F.broadcast(spark.createDataFrame(concept_words(groups), "part string, concept string"))  # a thesaurus
    counted = texts.select("key", "field", F.explode(content_words(F.col("text"))).alias("word")).groupBy("key", "field", "word").agg(F.count("*").alias("n"))
    counted = written(counted, "words")
    words = written(counted.select("word").distinct(), "vocabulary")
    parts = term_map(words, words, stemmed=False).select("word", F.col("term").alias("part"))
    terms = parts.select("word", F.col("part").alias("term")).unionByName(parts.join(known, "part").select("word", F.col("concept").alias("term"))).distinct()
    phrase = F.explode(grams(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1)), 2)).alias("part")
    pairs = texts.select("key", "field", phrase).join(known, "part").groupBy("key", "field", F.col("concept").alias("term")).agg(F.count("*").alias("tf"))
    postings = counted.join(terms, "word").groupBy("key", "field", "term").agg(F.sum("n").alias("tf")).unionByName(pairs).groupBy("key", "field", "term").agg(F.sum("tf").alias("tf"))
    return written(postings, "postings"), written(counted.groupBy("key", "field").agg(F.sum("n").alias("n")), "lengths"), words


def searched(queries: DataFrame, texts: DataFrame, groups: Sequence[Sequence[str]] = (), boosts: dict[str, float] = BOOSTS) -> DataFrame:
    """(query, key, score): what each of a few ``queries`` (query) finds, rounded to six digits; hits below ``FLOOR`` of a query's best are left out.

    A word finds the terms that are it, begin with it or are it but for typing errors; a compound also what holds both its parts; a word of a concept also what holds the concept,
    once a concept. The queries are broadcast: they are typed by people.
    """
    spark = texts.sparkSession
    postings, lengths, vocabulary = indexed(texts, groups)
    known = F.broadcast(spark.createDataFrame(concept_words(groups), "part string, concept string"))
    word = queries.select("query", F.explode(content_words(F.col("query"))).alias("word")).distinct()
    splits = compound_splits(word.select("word").distinct(), vocabulary).join(word, "word").select("query", F.concat_ws("+", "left", "right").alias("c"), F.explode(F.array("left", "right")).alias("word"), F.lit(BOTH).alias("factor"), F.lit(2).alias("need"))
    splits = splits.withColumn("need", F.when(F.element_at(F.split("c", "[+]"), 1) == F.element_at(F.split("c", "[+]"), 2), 1).otherwise(F.col("need")))
    asked = word.select("query", F.col("word").alias("c"), "word", F.lit(1.0).alias("factor"), F.lit(1).alias("need")).unionByName(splits).distinct()
    v, q = F.col("term"), F.col("word")
    far = F.levenshtein(q, v)
    ahead = (F.length(q) >= PREFIX) & v.startswith(q) & (v != q)
    close = (F.length(q) >= FUZZY) & ~v.startswith(q) & (far <= F.round(SHARE * F.length(q)))
    weight = F.when(v == q, 1.0).when(ahead, AS_PREFIX * F.length(q) / (F.length(q) + 0.3 * (F.length(v) - F.length(q)))).when(close, AS_FUZZY * F.length(q) / (F.length(q) + far))
    terms = vocabulary.select(F.col("word").alias("term")).crossJoin(F.broadcast(asked)).withColumn("w", weight).where("w is not null").select("query", "c", "word", "factor", "need", "term", "w")
    own = word.select("query", F.col("word").alias("part")).join(known, "part").select("query", "concept")
    pair = queries.select("query", F.explode(grams(F.regexp_extract_all(F.lower("query"), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1)), 2)).alias("part")).join(known, "part").select("query", "concept")
    concepts = own.unionByName(pair).distinct().select("query", F.col("concept").alias("c"), F.col("concept").alias("word"), F.lit(CONCEPT).alias("factor"), F.lit(1).alias("need"), F.col("concept").alias("term"), F.lit(1.0).alias("w"))
    sought = written(terms.unionByName(concepts), "sought")

    fields = F.broadcast(spark.createDataFrame(list(boosts.items()), "field string, boost double"))
    mean = F.broadcast(lengths.groupBy("field").agg(F.avg("n").alias("mean")))  # a row a field
    whole = F.broadcast(texts.agg(F.count_distinct("key").alias("all")))
    hits = postings.join(F.broadcast(sought.select("term").distinct()), "term", "left_semi")
    df = hits.groupBy("field", "term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (F.col("all") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    bm = F.col("boost") * idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.coalesce("n", F.lit(0)) / F.col("mean")))
    valued = hits.join(df, ["field", "term"]).join(lengths, ["key", "field"], "left").join(mean, "field").join(fields, "field").crossJoin(whole).groupBy("key", "term").agg(F.sum(bm).alias("v"))
    each = valued.join(F.broadcast(sought), "term").groupBy("query", "c", "factor", "need", "key", "word").agg(F.sum(F.col("w") * F.col("v")).alias("s"))
    part = each.groupBy("query", "c", "factor", "need", "key").agg(F.sum("s").alias("s"), F.count("*").alias("have")).where("have >= need")
    total = part.groupBy("query", "key").agg(F.sum(F.col("factor") * F.col("s")).alias("score"))
    best = total.groupBy("query").agg(F.max("score").alias("top"))
    return total.join(best, "query").where(F.col("score") >= FLOOR * F.col("top")).select("query", "key", F.round("score", 6).alias("score"))


def excerpt(texts: DataFrame, terms: DataFrame, most: int = 24, before: int = 6) -> DataFrame:
    """(query, key, excerpt): of each text (key, text) the words around the first that a query's terms (query, term) begin, those that match in ``<mark>``; absent where none does.

    The terms are broadcast; a text is cut in its own row.
    """
    lists = F.broadcast(terms.groupBy("query").agg(F.collect_set("term").alias("ts")))
    w = texts.select("key", F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1)).alias("ws")).crossJoin(lists)
    w = w.withColumn("hit", F.transform("ws", lambda x: F.exists("ts", lambda t: F.lower(x).startswith(t)))).withColumn("at", F.array_position("hit", True)).where("at > 0")
    start = F.greatest(F.col("at") - before, F.lit(1)).cast("int")
    shown = F.zip_with(F.slice("ws", start, most), F.slice("hit", start, most), lambda x, h: F.when(h, F.concat(F.lit("<mark>"), x, F.lit("</mark>"))).otherwise(x))
    return w.select("query", "key", F.concat_ws(" ", shown).alias("excerpt"))


