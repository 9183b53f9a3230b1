"""Texts decoded with the wrong character encoding: found and restored by a noisy channel.

A channel is a chain of steps that encode in one encoding and decode in another; it gives each letter a garbled form. A damaged token
becomes a lattice: from each place lead the forms that some channel has there, and bytes that are lost (replacement characters, question marks
in a word or at the edge of what can be none, a lead byte without the rest) are wildcards. Paths that keep to one channel come first; where all of these
leave odd characters, paths that change the channel within the token are searched, each change at a cost. The paths are scored by the frequencies of
the corpus's own words, which are counted over all texts; of the words that fit a path with wildcards, found by an equi-join on the word with its
non-ASCII letters masked, the most frequent counts. A Viterbi search over the damaged tokens of a field, in which a change of channel costs, picks the
words. A token is garbled if a channel turns it into a word of the corpus, or if it spells out whole multi-byte sequences of the
language's letters, or has lost bytes; signs, foreign words and decomposed letters have no such reading and stay.

The corpus counts are one combinable aggregation; only distinct damaged tokens are decoded; a token that a third of the fields
have is joined by broadcast while the list is small, and otherwise by a join that can be split.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Sequence
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import small, written

#: Letters beyond ASCII that the language writes.
LETTERS = "æøåÆØÅ"
#: Further characters whose multi-byte forms betray a wrong encoding.
SIGNS = "éèêëáàâäöüóñçôÉÄÖÜß–—‘’“”…§½«»€"
#: Encodings in which texts were written, and those in which they were misread.
WRITTEN = ("cp1252", "mac_roman", "cp850", "cp865", "cp437")
MISREAD = ("cp1252", "latin-1", "iso8859-15", "mac_roman", "cp437", "cp850", "cp865", "cp1251", "koi8-r", "cp1250", "iso8859-2", "cp1257", "cp1253")
#: Costs in the search over a field, in nats: a change of channel, a reading that is no known word, and leaving a token as it is (ten times
#: that where another reading is known).
CHANGE, UNKNOWN, AS_IS = 4.0, 5.0, 3.0
#: Cost of reading a character as a lost byte, and of a reading that leaves odd characters.
LOSSY, LEFT = 3.0, 12.0
#: Up to this many distinct damaged tokens, and as many bytes, their readings are broadcast; beyond, they are joined.
BROADCAST_TOKENS, BROADCAST_BYTES = 200_000, 64 << 20
#: Longer tokens are no words: no paths of several channels are sought for them.
LONGEST = 64
#: The letters that a seven-bit national character set puts in place of ASCII signs.
SEVEN_BIT = {"{": "æ", "|": "ø", "}": "å", "[": "Æ", "\\": "Ø", "]": "Å"}
#: No word is of consonants alone, so a question mark after one is no question.
CONSONANTS = "bcdfghjklmnpqrstvwxz"
LOST = "�"


def _misread(data: bytes, encoding: str) -> str:
    """Bytes as characters; a byte that the encoding leaves undefined becomes the control character of the same number."""
    try:
        return data.decode(encoding)
    except UnicodeDecodeError:
        return "".join(_byte(b, encoding) for b in data)


def _byte(b: int, encoding: str) -> str:
    try:
        return bytes([b]).decode(encoding)
    except UnicodeDecodeError:
        return chr(b)


def channels(letters: str = LETTERS, signs: str = SIGNS) -> list[tuple[str, bool, dict[str, str]]]:
    """(name, whether its forms are multi-byte, garbled form -> character), the likelier channels first."""
    chains = [[("utf-8", w)] for w in MISREAD]
    chains += [[("utf-8", w) for w in ws] for n in (2, 3) for ws in product(("cp1252", "latin-1"), repeat=n)]
    chains += [[("utf-8", w)] * 2 for w in MISREAD[2:]]
    chains += [[(r, w)] for r in WRITTEN for w in MISREAD if r != w and {r, w} != {"cp1252", "latin-1"}]
    out, seen = [], set()
    for chain in chains:
        multi = chain[0][0] == "utf-8"
        forms: dict[str, str] = {}
        for x in letters + (signs if multi else ""):
            s = x
            try:
                for r, w in chain:
                    s = _misread(s.encode(r), w)
            except UnicodeEncodeError:
                continue
            if s == x or s.isascii() or all(c in letters for c in s):
                continue
            forms.setdefault(s, x)
        for s, x in list(forms.items()):  # the text was put in lower case after it was garbled
            if multi and s.lower() != s and s.lower() not in forms:
                forms[s.lower()] = x.lower()
        if forms and (key := frozenset(forms.items())) not in seen:
            seen.add(key)
            out.append(("/".join(f"{r}>{w}" for r, w in chain), multi, forms))
    return out


_UTF7 = re.compile(r"\+([A-Za-z0-9+/]{2,})-")


def _utf7(token: str, letters: str) -> str:
    def char(m: re.Match) -> str:
        try:
            s = m[0].encode().decode("utf-7")
        except UnicodeDecodeError:
            return m[0]
        return s if s and all(c in letters + SIGNS for c in s) else m[0]

    return _UTF7.sub(char, token)


def readings(token: str, table: list, letters: str = LETTERS) -> list[tuple[str, str, bool]]:
    """(channels, reading, whether whole multi-byte forms of letters are spelt out); lost bytes stay as wildcards.

    Channels that read a token alike are named together. The names ``lost`` and ``mixed`` stand for readings that fit any channel.
    """
    plain = unicodedata.normalize("NFC", token)
    out: dict[str, tuple[list[str], bool]] = {}

    def add(s: str, channel: str, spelt: bool = False) -> None:
        names, before = out.get(s, ([], False))
        if channel not in ("lost", "mixed") or not names:
            out[s] = (names + [channel], before or spelt)

    if "+" in plain and (s := _utf7(plain, letters)) != plain:
        add(s, "utf-7", True)
    have = set(plain)
    for name, multi, chars, find, forms in table:
        if not have & chars:
            continue
        hits = [forms[m] for m in find.findall(plain)]
        if hits:
            add(find.sub(lambda m: forms[m[0]], plain), name, multi and any(h in letters for h in hits))
    if LOST in plain or "?" in plain:
        add(_MARK.sub(LOST, plain), "lost")
    if have & set(SEVEN_BIT):
        add(plain.translate(str.maketrans(SEVEN_BIT)), "seven-bit")
    for lead in "Ãã├√Г":  # the first byte of the language's letters, without the second
        if lead in plain:
            add(plain.replace(lead, LOST), "lost")
    if len(plain) <= LONGEST and all(any(not c.isascii() and c not in letters for c in s) for s in out):
        for s in mixed(plain, table, letters):
            add(s, "mixed")
    return [(",".join(names), s, spelt) for s, (names, spelt) in out.items()]


#: A question mark that can stand for a letter: within a word, before one, or after a consonant.
_MARK = re.compile(rf"(?<=\w)\?(?=\w)|^\?(?=\w)|(?<=[{CONSONANTS}])\?$", re.IGNORECASE)


def mixed(token: str, table: list, letters: str = LETTERS) -> list[str]:
    """The readings of a token along paths that change the channel, the cheapest first; those that cost two changes more than the cheapest are left out."""
    at: list[dict[tuple[str, str], float]] = [{} for _ in range(len(token) + 1)]
    at[0][("", "")] = 0.0
    for i, c in enumerate(token):
        if not at[i]:
            continue
        forms = [(name, f, x) for name, _, chars, _, known in table if c in chars for f, x in known.items() if token.startswith(f, i)]
        least = min(at[i].values())
        for (said, channel), cost in at[i].items():
            if cost > least + 2 * CHANGE:
                continue
            steps = [(i + len(f), said + x, name, cost + (CHANGE if channel not in ("", name) else 0.0)) for name, f, x in forms]
            if not forms:
                steps.append((i + 1, said + c, channel, cost + (0.0 if c.isascii() or c in letters or c == LOST else LEFT)))
            for j, s, name, total in steps:
                if total < at[j].get((s, name), math.inf):
                    at[j][(s, name)] = total
    best: dict[str, float] = {}
    for (said, _), cost in at[-1].items():
        best[said] = min(cost, best.get(said, math.inf))
    least = min(best.values(), default=0.0)
    return [s for s, cost in sorted(best.items(), key=lambda x: (x[1], x[0])) if s != token and cost <= least + 2 * CHANGE]


def _table(letters: str) -> list:
    out = []
    for name, multi, forms in channels(letters):
        find = re.compile("|".join(re.escape(s) for s in sorted(forms, key=len, reverse=True)))
        out.append((name, multi, {c for s in forms for c in s if not c.isascii()}, find, forms))
    return out


def _letters_only(s: str) -> str:
    """The word in a reading: lower case, without what is no letter at its ends."""
    s = s.lower()
    a, b = 0, len(s)
    while a < b and not (s[a].isalpha() or s[a] == LOST):
        a += 1
    while b > a and not (s[b - 1].isalpha() or s[b - 1] == LOST):
        b -= 1
    return s[a:b]


def _masks(word: str, letters: str) -> list[str]:
    """The word with its non-ASCII letters masked; a lost two-byte character may have left one mark or two."""
    m = "".join(LOST if c in letters or c == LOST else c for c in word)
    short = m.replace(LOST * 2, LOST)
    return [m] if short == m else [m, short]


def suspicious(c: Column, letters: str = LETTERS) -> Column:
    """Whether a text has anything that a wrong encoding could have left."""
    mark = rf"\p{{L}}\?\p{{L}}|(?<![^\s(\"'])\?\p{{L}}|(?<![\p{{L}}\p{{N}}])(?i:[{CONSONANTS}]{{1,3}})\?"
    sign = c.contains("{") | c.contains("|") | c.contains("}") | c.contains("\\")
    # the rare signs are looked for first, which is quick
    return (
        c.rlike(rf"[^\x{{00}}-\x{{7f}}{letters}]")
        | (c.contains("+") & c.rlike(r"\+[A-Za-z0-9+/]{2,}-"))
        | (c.contains("?") & c.rlike(mark))
        | (sign & c.rlike(r"\p{L}[{|}\\]|[{|}\\]\p{L}"))
    )


#: A run of letters, digits and non-ASCII characters, with what a wrong encoding puts between them.
TOKEN = re.compile(
    r"(?:[0-9A-Za-z]|[^\x00-\x7f\xa0]|(?<=[ÃÂ€])\xa0|\+[A-Za-z0-9+/]{2,}-|(?<=[^\W\d_])\?(?=[^\W\d_])"
    rf"""|(?<![^\s("'])\?(?=[^\W\d_])|(?i:(?<=[{CONSONANTS}])\?)|(?<=[^\W\d_])[{{|}}\[\]\\]|[{{|}}\[\]\\](?=[^\W\d_]))+"""
)


def _odd(letters: str) -> re.Pattern:
    """What ``suspicious`` looks for, in a token."""
    return re.compile(rf"[^\x00-\x7f{letters}]|\+[A-Za-z0-9+/]{{2,}}-|[^\W\d_]\?[^\W\d_]|^\?[^\W\d_]|^(?i:[{CONSONANTS}]{{1,3}})\?$|[^\W\d_][{{|}}\\]|[{{|}}\\][^\W\d_]")


#: What may be damage in a field that has a token of the same kind which is odd in itself: question marks at a word's end, brackets in or before a word.
_ALSO = [(re.compile(r"\?"), re.compile(r"\?$")), (re.compile(r"[{|}\\]"), re.compile(r"[\[\]](?=[^\W\d_])|(?<=[^\W\d_])[\[\]]"))]


def damaged_tokens(text: str, odd: re.Pattern) -> list[str]:
    """The distinct tokens of a text that a wrong encoding may have damaged."""
    tokens = list(dict.fromkeys(TOKEN.findall(text)))
    hit = [t for t in tokens if odd.search(t)]
    also = [soft for hard, soft in _ALSO if any(hard.search(t) for t in hit)]
    return [*hit, *[t for t in tokens if t not in hit and any(p.search(t) for p in also)]] if also else hit


#: Letters on each side of a lost one by which it is guessed, the most first; the share that a guess must have to count as restored.
AROUND, CERTAIN = (4, 3, 2, 1), 0.9


def guesses(lost: DataFrame, words: DataFrame, letters: str = LETTERS) -> DataFrame:
    """(``_r``, ``guess``): readings with lost letters that no word fits, each lost letter filled with the one that the corpus's words have most often between
    the same letters, as many on each side as are known there.

    ``words`` has ``_w``, ``_m`` and ``_n``; contexts are keys of an equi-join, in which all letters beyond ASCII are masked alike. ``guess`` is a word and
    whether each of its guesses has a large share.
    """
    low = "".join(sorted({c.lower() for c in letters}))
    edge = max(AROUND)

    def contexts(mask: str) -> Column:
        padded = F.concat(F.lit("^" * edge), mask, F.lit("$" * edge))
        return F.explode(F.array(*[F.struct(F.lit(k).alias("k"), padded.substr(F.col("i") + (edge + 1 - k), F.lit(2 * k + 1)).alias("context")) for k in AROUND])).alias("x")

    letter = words.select("_m", "_n", F.posexplode(F.split("_w", "")).alias("i", "c")).where(F.lit(low).contains(F.col("c")) & (F.col("c") != ""))
    seen = letter.select("c", "_n", contexts("_m")).groupBy("x.context", "c").agg(F.sum("_n").alias("n"))
    holes = lost.select("_r", F.replace("_r", F.lit(LOST * 2), F.lit(LOST)).alias("r")).distinct()
    masked = holes.withColumn("m", F.translate("r", low, LOST * len(low)))
    asked = masked.select("_r", "r", "m", F.posexplode(F.split("r", "")).alias("i", "c")).where(F.col("c") == LOST).select("_r", "r", "i", contexts("m")).select("_r", "r", "i", "x.k", "x.context")
    each = asked.join(seen, "context").groupBy("_r", "r", "i", "k").agg(F.max(F.struct("n", "c")).alias("best"), F.sum("n").alias("all"))
    one = each.groupBy("_r", "r", "i").agg(F.max(F.struct("k", "best", "all")).alias("b"))
    filled = one.groupBy("_r", "r").agg(F.map_from_entries(F.collect_list(F.struct("i", F.col("b.best.c")))).alias("at"), F.min(F.col("b.best.n") / F.col("b.all")).alias("share"))
    word = F.array_join(F.expr(f"transform(split(r, ''), (c, i) -> if(c = '{LOST}', coalesce(at[i], c), c))"), "")
    return filled.select("_r", F.struct(word.alias("_w"), (F.col("share") >= CERTAIN).alias("sure")).alias("guess")).where(~F.col("guess._w").contains(LOST))


def word_counts(texts: DataFrame, text: str, letters: str = LETTERS) -> DataFrame:
    """(``_w``, ``_n``): how often each word with a letter beyond ASCII occurs in all texts, in lower case."""
    low = "".join(sorted({c.lower() for c in letters}))
    word = F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(rf"(?<![^\x{{00}}-\x{{7f}}])(?<![a-z])([a-z]*+[{low}][a-z{low}]*+)(?![^\x{{00}}-\x{{7f}}])"), F.lit(1)))
    return texts.where(F.col(text).isNotNull()).select(word.alias("_w")).groupBy("_w").agg(F.count("*").alias("_n"))


def restored(df: DataFrame, key: str, fields: Sequence[str], *, letters: str = LETTERS) -> DataFrame:
    """(key, ``felt``, ``tekst``, ``complete``): each garbled field of a record with its text restored as far as it can be.

    ``complete`` tells whether every damaged token was, with no letter guessed by a small majority. Null and empty fields are never garbled; nor are rows with a null key.
    Repeated rows count once; a key whose field has several texts has a row for each garbled one. An empty table gives an empty result.
    """
    kind = df.schema[key].dataType.simpleString()
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("felt"), F.col(f).cast("string").alias("text")) for f in fields])).alias("x")
    every = df.where(F.col(key).isNotNull()).select(F.col(key).alias("_k"), each).select("_k", "x.felt", "x.text")
    damaged = written(every.where(suspicious(F.col("text"), letters)).distinct(), "suspicious")

    def tokenise(batches):
        odd = _odd(letters)
        for b in batches:
            at, out = [], []
            for i, text in enumerate(b.column("text").to_pylist()):
                for t in damaged_tokens(text, odd):
                    at.append(i), out.append(t)
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([*[b.column(c).take(at) for c in ("_k", "felt", "_id")], pa.array(out, pa.string())], ["_k", "felt", "_id", "_t"])

    numbered = damaged.withColumn("_id", F.xxhash64("_k", "felt", "text"))
    in_field = numbered.mapInArrow(tokenise, f"_k {kind}, felt string, _id bigint, _t string")
    tokens = in_field.select("_t").distinct()

    def decode(batches):
        table = _table(letters)
        for b in batches:
            cols: dict[str, list] = {c: [] for c in ("_t", "channel", "reading", "_r", "_m", "spelt")}
            for t in b.column("_t").to_pylist():
                for name, reading, spelt in readings(t, table, letters):
                    word = _letters_only(reading)
                    for m in _masks(word, letters):
                        for c, v in zip(cols, (t, name, reading, word, m if len(word) > 1 else None, spelt)):
                            cols[c].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.bool_() if c == "spelt" else pa.string()) for c, v in cols.items()], list(cols))

    read = tokens.mapInArrow(decode, "_t string, channel string, reading string, _r string, _m string, spelt boolean")
    words = word_counts(every, "text", letters).withColumn("_m", F.translate("_w", "".join(sorted({c.lower() for c in letters})), LOST * len({c.lower() for c in letters})))
    words = written(words, "words")  # used for the words that fit and for the letters around lost ones
    # a reading without wildcards must be the word itself; of the words that fit one with wildcards the most frequent wins any search
    likely = [F.expr(f"_w like {r}") for r in (f"replace(_r, '{LOST}', '_')", f"replace(replace(_r, '{LOST * 2}', '{LOST}'), '{LOST}', '_')")]
    fits = (F.col("_r") == F.col("_w")) | (F.col("_r").contains(LOST) & (likely[0] | likely[1]))
    option = ["_t", "channel", "reading", "_r", "spelt"]
    known = written(read.join(words, "_m", "left").groupBy(*option).agg(F.max(F.when(fits, F.struct("_n", "_w"))).alias("word")), "known")
    guessed = guesses(known.where(F.col("word").isNull() & F.col("_r").contains(LOST)), words, letters)
    best = known.join(guessed, "_r", "left").groupBy("_t").agg(F.collect_list(F.struct(*option[1:], "word", "guess")).alias("readings"))
    best = written(best, "readings")
    few = small(best, BROADCAST_TOKENS, BROADCAST_BYTES)
    found = (
        in_field.join(F.broadcast(best) if few else best, "_t")
        .groupBy("_k", "felt", "_id")
        .agg(F.collect_list(F.struct("_t", "readings")).alias("found"))
    )
    joined = numbered.join(found, ["_k", "felt", "_id"])
    odd = _odd(letters)

    def search(batches):
        for b in batches:
            ids, out, done = [], [], []
            for i, (text, found) in enumerate(zip(b.column("text").to_pylist(), b.column("found").to_pylist())):
                r = _viterbi(text, {f["_t"]: f["readings"] for f in found}, odd)
                if r:
                    ids.append(i), out.append(r[0]), done.append(r[1])
            at = pa.array(ids, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("_k").take(at), b.column("felt").take(at), pa.array(out, pa.string()), pa.array(done, pa.bool_())], [key, "felt", "tekst", "complete"])

    return joined.select("_k", "felt", "text", "found").mapInArrow(search, f"`{key}` {kind}, felt string, tekst string, complete boolean")


def _viterbi(text: str, found: dict, odd: re.Pattern) -> tuple[str, bool] | None:
    """The restored text and whether all of it was; None if nothing in the text is garbled."""
    spans, sure, lossy = [], set(), LOST in text
    for m in TOKEN.finditer(text):
        t = m[0]
        if t in found or LOST in t:
            spans.append((m.start(), m.end(), t))
            for r in found.get(t, []):
                if r["word"] is not None or r["spelt"]:
                    sure.add(t)
                    lossy = lossy or r["channel"] == "lost"
    if not sure and LOST not in text:
        return None
    unknown = math.log(1e6)
    best = {None: 0.0}  # per channel the score of the best path so far; none is free to become any
    trail = []
    for _, _, t in spans:
        # a damaged token is not left as it is
        as_is = unknown + AS_IS * (10 if t in sure or (lossy and (LOST in t or "?" in t)) else 1)
        options = [("", t, -as_is, True)]
        for r in found.get(t, []):
            word, guess, said, firm = r["word"], r["guess"], r["reading"], True
            score = math.log(word["_n"] / 1e6) if word is not None else -unknown - (1.0 if r["spelt"] else UNKNOWN)
            if LOST in said and (word is not None or guess is not None):
                firm = word is not None or guess["sure"]
                said = _filled(said, (word or guess)["_w"])
            score -= {"lost": LOSSY, "mixed": CHANGE}.get(r["channel"], 0.0)
            if odd.search(said):
                score -= LEFT
            options.append((r["channel"], said, score, firm))
        now: dict[str | None, tuple[float, str | None, str, bool]] = {}
        top = max(best, key=best.__getitem__)
        for channels, said, score, firm in options:
            if channels in ("lost", "mixed"):
                steps = [(c, s + score, c) for c, s in best.items()]
            else:
                ways = [max((s - (0.0 if c in (None, name) else CHANGE), str(c), c) for c, s in ((name, best.get(name, -math.inf)), (None, best.get(None, -math.inf)), (top, best[top]))) for name in channels.split(",")]
                steps = [(name, s + score, c) for name, (s, _, c) in zip(channels.split(","), ways)]
            for c, s, back in steps:
                if c not in now or s > now[c][0]:
                    now[c] = (s, back, said, firm)
        trail.append(now)
        best = {c: x[0] for c, x in now.items()}
    said: list[tuple[str, bool]] = []
    at = max(best, key=best.__getitem__)
    for level in reversed(trail):
        _, back, word, firm = level[at]
        said.append((word, firm))
        at = back
    parts, last, complete = [], 0, True
    for (a, b, t), (word, firm) in zip(spans, reversed(said)):
        if t[0] in LOST + "?" and word[:1].isalpha() and (not text[:a].strip() or text[:a].rstrip()[-1] in ".!:"):
            word = word[0].upper() + word[1:]  # a lost first letter of a sentence
        parts += [text[last:a], word]
        last = b
        complete = complete and firm and not (t in sure and odd.search(word))
    parts.append(text[last:])
    whole = "".join(parts)
    return whole, complete and LOST not in whole


def _filled(reading: str, word: str) -> str:
    """The reading with its wildcards filled from the word, its own capitals and surroundings kept."""
    core = _letters_only(reading)
    a = reading.lower().find(core)
    before, middle, after = reading[:a], reading[a : a + len(core)], reading[a + len(core) :]
    if len(middle) != len(word):
        middle = middle.replace(LOST * 2, LOST)
    upper = len(middle) > 1 and all(c.isupper() for c in middle if c != LOST) and any(c.isupper() for c in middle)
    out = "".join(((w.upper() if upper else w) if c == LOST else c) for c, w in zip(middle, word))
    return before + out + after
