"""Danish words: stop words, the public Snowball stemmer, and splitting of compounds."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .text import words

#: Snowball's list of Danish stop words without "uden".
STOP_WORDS = (
    "og i jeg det at en den til er som på de med han af for ikke der var mig sig men et har om vi min havde ham hun "
    "nu over da fra du ud sin dem os op man hans hvor eller hvad skal selv her alle vil blev kunne ind når være dog "
    "noget ville jo deres efter ned skulle denne end dette mit også under have dig anden hende mine alt meget sit "
    "sine vor mod disse hvis din nogle hos blive mange ad bliver hendes været thi jer sådan"
).split()
#: The letters and endings of the stemmer.
VOWELS, S_AFTER, DOUBLED = set("aeiouyæåø"), set("abcdfghjklmnoprtvyzå"), set("bdfgklmnprst")
ENDINGS = "hed ethed ered e erede ende erende ene erne ere en heden eren er heder erer heds es endes erendes enes ernes eres ens hedens erens ers ets erets et eret s".split()
SHORT_ENDINGS = "ig lig elig els løst".split()
PAIRS = ("gd", "dt", "gt", "kt")


def _ends(endings) -> re.Pattern:
    """Finds the longest of the endings, as the leftmost match is the longest."""
    return re.compile(f"(?:{'|'.join(endings)})$")


_REGION = re.compile(f"[{''.join(sorted(VOWELS))}][^{''.join(sorted(VOWELS))}]")
_MAIN, _PAIR, _OTHER, _TWICE = _ends(ENDINGS), _ends(PAIRS), _ends(SHORT_ENDINGS), re.compile(rf"([{''.join(sorted(DOUBLED))}])\1$")


def stem(word: str) -> str:
    """The Danish Snowball stem of a lower-case word.

    Endings count only in the region after the first consonant that follows a vowel, from the third letter on. Steps: the main
    endings, s only after certain letters; the last letter of a pair; the other endings (st of igst first, løst only its t) and the pair that they uncover; a
    doubled consonant.
    """
    if len(word) < 3:
        return word
    m = _REGION.search(word)
    region = max(m.end(), 3) if m else len(word)

    def cut(w: str, ending: re.Pattern, keep: int = 0) -> str:
        m = ending.search(w, region)
        return w[: m.start() + keep] if m else w

    m = _MAIN.search(word, region)
    if m and (m[0] != "s" or word[m.start() - 1] in S_AFTER):
        word = word[: m.start()]
    word = cut(word, _PAIR, 1).removesuffix("st") if word.endswith("igst") else cut(word, _PAIR, 1)
    m = _OTHER.search(word, region)
    if m:
        word = word[:-1] if m[0] == "løst" else cut(word[: m.start()], _PAIR, 1)
    at = len(word) - 1
    return word[:at] if at >= region and _TWICE.search(word) else word


def _stems(batch: pd.Series) -> pd.Series:
    return batch.map(stem, na_action="ignore")


stem_udf = F.pandas_udf(_stems, StringType())


def content_words(text):
    """Lower-case words of at least two letters that are no stop words."""
    stop = F.array(*map(F.lit, STOP_WORDS))
    return F.filter(words(text), lambda w: (F.length(w) >= 2) & ~F.array_contains(stop, w))


def stems(df: DataFrame, word: str = "word") -> DataFrame:
    """(word, stem) of the distinct words of ``df``: each is stemmed once."""
    return df.select(word).where(F.col(word).isNotNull()).distinct().withColumn("stem", stem_udf(word))


def compound_splits(words: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(word, left, right): every way to split each of the distinct ``words`` in two words of ``vocabulary``, both tables of one column ``word``.

    The second part has four letters or more, the first three; a joining s or e may stand between. Splits are made equal to the
    vocabulary by two joins on the parts, never by comparing words with words.
    """
    cut = words.where(F.length("word") >= 7).select("word", F.explode(F.sequence(F.lit(3), F.length("word") - 4)).alias("i"))
    halves = cut.select("word", F.expr("substring(word, 1, i)").alias("left"), F.expr("substring(word, i + 1)").alias("right"))
    known = vocabulary.where(F.length("word") >= 3).select(F.col("word").alias("right"))
    halves = halves.join(known, "right", "left_semi")
    plain = halves.join(known.withColumnRenamed("right", "left"), "left", "left_semi").select("word", "left", "right")
    rest = halves.join(known.withColumnRenamed("right", "left"), "left", "left_anti").where(F.col("left").rlike("[se]$")).withColumn("base", F.expr("substring(left, 1, length(left) - 1)"))
    return plain.unionByName(rest.join(known.withColumnRenamed("right", "base"), "base", "left_semi").select("word", F.col("base").alias("left"), "right"))


def compound_parts(vocabulary: DataFrame) -> DataFrame:
    """(word, part): the parts that the words of ``vocabulary`` (``word``) split into."""
    return compound_splits(vocabulary, vocabulary).select("word", F.explode(F.array("left", "right")).alias("part")).distinct()


def term_map(words: DataFrame, vocabulary: DataFrame, *, stemmed: bool = True) -> DataFrame:
    """(word, term, times): the index terms of each of the distinct ``words``: its stem and the stems of its parts, as often as splits give them."""
    parts = compound_splits(words, vocabulary).select("word", F.explode(F.array("left", "right")).alias("part"))
    every = words.select("word", F.col("word").alias("part")).unionByName(parts)
    if stemmed:
        known = stems(every, "part")
        every = every.join(known, "part").select("word", F.col("stem").alias("part"))
    return every.groupBy("word", F.col("part").alias("term")).agg(F.count("*").alias("times"))
