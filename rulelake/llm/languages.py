"""Languages of documents and of their paragraphs by multilingual mixture inference.

A character n-gram model per language is fitted on a bounded sample of labelled rows, in rounds in which each sentence moves to the
language that likes it best, so that wrong labels and foreign sentences in the sample wear off. Of each document,
expectation-maximisation over its sentences' n-gram likelihoods then estimates the proportions of the languages; the set of
languages is selected by penalised likelihood; the posteriors under the selected set give each sentence its language and
confidence. All documents are processed whole, row by row, with no shuffle: the model is a table of fixed size.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LANGUAGES = ("da", "nb", "sv", "en", "de")
#: The fit takes at most so many labelled rows, of at most so many characters each, in the order of a hash of their keys.
FIT_ROWS, FIT_CHARS = 4_000, 20_000
#: Rounds of the fit and of the mixture; a further language must gain this much log-likelihood, and half the log of the number of sentences.
FIT_ROUNDS, MIX_ROUNDS, PENALTY = 4, 8, 6.0
#: Words of a sentence that counts for a paragraph.
LEAST_WORDS = 8
#: Back-off strengths of the n-gram model.
BACK4, BACK3, BACK2 = 2.0, 2.0, 1.0

# 32 classes: a break, and letters; the rarest share a class
_CLASSES = "abcdefghijklmnoprstuvwyzåäöæøüß"
_TABLE = np.zeros(0x250, np.uint8)
for _i, _c in enumerate(_CLASSES):
    _TABLE[ord(_c)] = _TABLE[ord(_c.upper()[0])] = _i + 1
for _a, _b in (("q", "k"), ("x", "z"), ("é", "e"), ("è", "e"), ("ê", "e"), ("á", "a"), ("à", "a"), ("ó", "o"), ("ñ", "n"), ("ç", "c")):
    _TABLE[ord(_a)] = _TABLE[ord(_a.upper())] = _TABLE[ord(_b)]

_END = re.compile(r"""(?<=[.!?])["'”’»)\]]*\s+(?=["'“‘«(\[„]*[^\W\d_])""")
#: The names of months in the five languages.
_MONTHS = "januari? january februari? february marts mars märz march april maj mai may juni june juli july augusti? september oktober october november december desember dezember"
_MONTH = re.compile(rf"(?:{'|'.join(_MONTHS.split())})\b", re.IGNORECASE)
_DAY = re.compile(r"(?<!\d)[0-3]?\d\.$")
_SHORT = re.compile(r"(?:\b(?:pr|nr|ca|jf|dvs|fx|vgl|bzw|St|Dr|No)|\b\w\.\w)\.$")
_NOT_TEXT = re.compile(r"^\s*(?:\||\[\w+ \d+\]\s*$)|\t\S")


def spans(text: str, placed: bool = True) -> list[tuple[int, str, int, int]]:
    """(paragraph, sentence, start, end): paragraphs are runs of non-blank lines, numbered from 0; rows of tables and page marks are no sentences.

    A sentence has its lines joined by blanks; start and end are its place in the text, 0 if that is not asked for.
    """
    out: list[tuple[int, str, int, int]] = []
    lines: list[tuple[str, int]] = []
    para = -1

    def close() -> None:
        if not lines:
            return
        run = " ".join(line for line, _ in lines)
        begins = list(accumulate((len(line) + 1 for line, _ in lines), initial=0)) if placed else []

        def place(i: int) -> int:
            if not placed:
                return 0
            k = bisect_right(begins, i) - 1
            return lines[k][1] + i - begins[k]

        def add(a: int, b: int) -> None:
            said = run[a:b]
            if "̀" <= max(said, default="") and any("̀" <= c <= "ͯ" for c in said):
                said = unicodedata.normalize("NFC", said)
            out.append((para, said, place(a), place(b - 1) + 1 if b > a else place(a)))

        start = 0
        for m in _END.finditer(run):
            head = run[max(start, m.start() - 8) : m.start()]
            nxt = run[m.end() : m.end() + 1]
            if nxt.islower() or (_DAY.search(head) and _MONTH.match(run, m.end())) or _SHORT.search(head):
                continue
            add(start, m.start())
            start = m.end()
        add(start, len(run))
        lines.clear()

    open_, at = False, 0
    for line in text.split("\n"):
        bare = line.strip()
        if not bare:
            close()
            open_ = False
        else:
            if not open_:
                open_, para = True, para + 1
            if _NOT_TEXT.search(line):
                close()
            else:
                lines.append((bare, at + len(line) - len(line.lstrip())))
        at += len(line) + 1
    close()
    return out


def sentences(text: str) -> list[tuple[int, str]]:
    """(paragraph, sentence), as in ``spans``."""
    return [(p, s) for p, s, _, _ in spans(text, False)]


def _grams(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The codes of the 4-grams of the texts one after the other, and the text that each belongs to."""
    joined = " ".join(texts) + " "
    points = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    codes = _TABLE[np.minimum(points, 0x24F)].astype(np.int32)
    codes[points > 0x24F] = 0
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    codes, owner = codes[keep], owner[keep]
    if len(codes) < 4:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    gram = ((codes[:-3] * 32 + codes[1:-2]) * 32 + codes[2:-1]) * 32 + codes[3:]
    inside = owner[:-3] == owner[3:]
    return gram[inside], owner[3:][inside]


def _plain(text: str) -> str:
    """The spelling without the letters that a foreign keyboard lacks."""
    for a, b in (("æ", "ae"), ("ø", "oe"), ("å", "aa"), ("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss"), ("Æ", "Ae"), ("Ø", "Oe"), ("Å", "Aa"), ("Ä", "Ae"), ("Ö", "Oe"), ("Ü", "Ue")):
        text = text.replace(a, b)
    return text


def _log_table(counts: np.ndarray) -> np.ndarray:
    """Log-probabilities of the last letter of each 4-gram given the three before, with back-off."""
    n4 = counts.reshape(32, 32, 32, 32)
    n3 = n4.sum(0)
    n2 = n3.sum(0)
    n1 = n2.sum(0)
    p1 = (n1 + 0.5) / (n1.sum() + 16)
    p2 = (n2 + BACK2 * p1) / (n2.sum(1, keepdims=True) + BACK2)
    p3 = (n3 + BACK3 * p2) / (n3.sum(2, keepdims=True) + BACK3)
    p4 = (n4 + BACK4 * p3) / (n4.sum(3, keepdims=True) + BACK4)
    return np.log(p4).astype(np.float32).ravel()


def fit(rows: Sequence[tuple[str, int]], languages: int) -> np.ndarray:
    """The model from (text, label) rows: a table of log-probabilities a language."""
    texts, label = [], []
    for text, lang in rows:
        for _, s in sentences(text):
            if len(s) > 20:
                texts.append(s)
                label.append(lang)
    label = np.array(label, np.int32)
    if not texts:
        return np.zeros((languages, 32**4), np.float32)
    gram, owner = _grams(texts)
    gram2, owner2 = _grams([_plain(t) for t in texts])
    now = label
    model = np.zeros((languages, 32**4), np.float32)
    for k in range(FIT_ROUNDS):
        for lang in range(languages):
            a, b = now[owner] == lang, now[owner2] == lang
            model[lang] = _log_table(np.bincount(gram[a], minlength=32**4) + 0.5 * np.bincount(gram2[b], minlength=32**4))
        if k < FIT_ROUNDS - 1:
            scores = np.stack([np.bincount(owner, model[lang][gram], len(texts)) for lang in range(languages)], 1)
            now = scores.argmax(1)
    return model


def mixture(scores: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """Posteriors of the sentences' languages: proportions by document, languages selected by penalised likelihood.

    ``scores`` are log-likelihoods (sentences x languages), ``doc`` the document of each sentence, ascending.
    """
    langs = scores.shape[1]
    if not len(scores):
        return scores.astype(float)
    size = np.maximum(np.bincount(doc, minlength=docs), 1)
    on = np.ones((docs, langs), bool)

    def share() -> tuple[np.ndarray, np.ndarray]:
        pi = on / on.sum(1, keepdims=True)
        for _ in range(MIX_ROUNDS):
            with np.errstate(divide="ignore"):
                z = scores + np.log(pi)[doc]
            z -= z.max(1, keepdims=True)
            post = np.exp(z)
            post /= post.sum(1, keepdims=True)
            pi = np.stack([np.bincount(doc, post[:, j], docs) for j in range(langs)], 1) + 0.05 * on
            pi /= pi.sum(1, keepdims=True)
        return post, pi

    post, pi = share()
    for _ in range(langs - 1):  # drop, document by document, the language that is missed least
        with np.errstate(divide="ignore"):
            z = scores + np.log(pi)[doc]
        full = np.logaddexp.reduce(z, 1)
        loss = np.full((docs, langs), np.inf)
        for j in range(langs):
            rest = np.delete(z, j, 1)
            without = np.logaddexp.reduce(rest, 1)
            # the others share what the dropped language leaves
            lost = np.bincount(doc, np.minimum(full - without, 1e6) + np.log1p(-np.minimum(pi[doc, j], 1 - 1e-9)), docs)
            loss[:, j] = np.where(on[:, j], lost, np.inf)
        worst = loss.argmin(1)
        drop = (loss[np.arange(docs), worst] < PENALTY + 0.5 * np.log(size)) & (on.sum(1) > 1)
        if not drop.any():
            break
        on[np.nonzero(drop)[0], worst[drop]] = False
        post, pi = share()
    return post


def label_language(label: Column | str, languages: Sequence[str] = LANGUAGES) -> Column:
    """The language of a label: its part before ``-`` or ``_`` in lower case, ``no`` as ``nb``; null if it is none of ``languages``."""
    part = F.lower(F.trim(F.regexp_extract(label, r"^([^\-_]*)", 1)))
    part = F.when(part == "no", "nb").otherwise(part)
    return F.when(part.isin(*languages), part)


def _fitted(df: DataFrame, key: str, text: str, label: str, languages: Sequence[str], fit_rows: int):
    """The rows with their label as a language, and the model of the sample, sent to the tasks."""
    rows = df.select(key, text, label_language(label, languages).alias("label"))
    labelled = rows.where(F.col("label").isNotNull())
    # the hash range that holds about twice the sample, so that no task offers more than its part of it
    part = min(1.0, 2 * fit_rows / max(1, labelled.count()))
    near = labelled.where(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int(part * (1 << 30)))
    sample = near.where(F.length(text).between(20, FIT_CHARS)).orderBy(F.pmod(F.xxhash64(key), F.lit(1 << 30)), key).limit(fit_rows)
    at = {lang: i for i, lang in enumerate(languages)}
    model = fit([(r[0], at[r[1]]) for r in sample.select(text, "label").collect()], len(languages))
    return rows, df.sparkSession.sparkContext.broadcast(model)


def _judged(model: np.ndarray, texts: Sequence[str | None], placed: bool = False) -> tuple[np.ndarray, ...]:
    """Of the sentences of texts that are in a language: text, paragraph, words, posteriors of the languages, start and end."""
    found = [spans(t, placed) if t else [] for t in texts]
    said = [s for f in found for _, s, _, _ in f]
    doc = np.repeat(np.arange(len(texts)), [len(f) for f in found])
    para, start, end = [np.array([x[i] for f in found for x in f], np.int64) for i in (0, 2, 3)]
    if not said or not model.any():
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros((0, len(model))), none, none
    words = np.array([sum(any(map(str.isalnum, w)) for w in s.split()) for s in said], np.int64)
    gram, owner = _grams(said)
    scores = np.stack([np.bincount(owner, model[j][gram], len(said)) for j in range(len(model))], 1)
    spelt = np.array([sum(any(map(str.isalpha, w)) for w in s.split()) for s in said], np.int64)
    use = (np.bincount(owner, minlength=len(said)) > 0) & (2 * spelt >= words) & (words > 0)  # lists of numbers are in no language
    return doc[use], para[use], words[use], mixture(scores[use], doc[use], len(texts)), start[use], end[use]


def passages(df: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", *, languages: Sequence[str] = LANGUAGES, fit_rows: int = FIT_ROWS, block: int = 200) -> DataFrame:
    """(key, para, ``start``, ``end``, lang, confidence): the runs of sentences in one language within a paragraph, by the characters of the text they take.

    Cases as in ``detected``; a text without letters has no row.
    """
    rows, shared = _fitted(df, key, text, label, languages, fit_rows)
    kind = df.schema[key].dataType.simpleString()
    names = np.array(languages, object)

    def run(batches):
        for b in batches:
            keys, texts = b.column(key), b.column(text).to_pylist()
            for lo in range(0, len(texts), block):
                doc, para, words, post, start, end = _judged(shared.value, texts[lo : lo + block], True)
                best, sure = post.argmax(1), post.max(1, initial=0.0)
                first = np.ones(len(doc), bool)
                first[1:] = (doc[1:] != doc[:-1]) | (para[1:] != para[:-1]) | (best[1:] != best[:-1])
                at = np.nonzero(first)[0]
                last = np.r_[at[1:], len(doc)] - 1 if len(at) else at
                n = np.add.reduceat(words, at) if len(at) else words
                conf = np.add.reduceat(words * sure, at) / n if len(at) else sure
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(lo, block).take(pa.array(doc[at])), pa.array(para[at].astype(np.int32)), pa.array(start[at]), pa.array(end[last]), pa.array(names[best[at]].tolist(), pa.string()), pa.array(conf.astype(float))],
                    [key, "para", "start", "end", "lang", "confidence"],
                )

    return rows.select(key, text).mapInArrow(run, f"`{key}` {kind}, para int, start bigint, end bigint, lang string, confidence double")


def detected(df: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", *, languages: Sequence[str] = LANGUAGES, fit_rows: int = FIT_ROWS, block: int = 200) -> DataFrame:
    """One row a document (``para`` null) and one a paragraph and language of its sentences.

    Columns: key, ``para``, ``lang``, ``confidence``, ``share`` (of the words of the document or paragraph), ``longest`` (words of the
    longest sentence in that language), ``label`` (the document's, as a language, or null). A document without letters has a row with
    null ``lang`` and confidence 0, and no paragraphs. Null texts count as empty. Repeated rows give repeated results. Without labelled
    rows nothing can be fitted and every language is null.
    """
    rows, shared = _fitted(df, key, text, label, languages, fit_rows)
    kind = df.schema[key].dataType.simpleString()
    names = np.array(languages, object)

    def run(batches):
        for b in batches:
            keys, labels, texts = b.column(key), b.column("label").to_pylist(), b.column(text).to_pylist()
            for lo in range(0, len(texts), block):
                yield from part(shared.value, keys.slice(lo, block), labels[lo : lo + block], texts[lo : lo + block])

    def part(model, keys, labels, texts):
        doc, para, words, post, _, _ = _judged(model, texts)
        out = {c: [] for c in ("i", "para", "lang", "confidence", "share", "longest")}
        known = np.zeros(len(texts), bool)
        if len(doc):
            best = post.argmax(1)
            sure = post.max(1)
            for by, first in ((doc * (2 << 31), False), (doc * (2 << 31) + para + 1, True)):
                group = by * 8 + best
                u, at = np.unique(group, return_inverse=True)
                w = np.bincount(at, words)
                conf = np.bincount(at, words * sure) / w
                _, whole = np.unique(u // 8, return_inverse=True)
                share = w / np.bincount(whole, w)[whole]
                longest = np.zeros(len(u), np.int64)
                np.maximum.at(longest, at, words)
                d = (u // 8) // (2 << 31)
                p = (u // 8) % (2 << 31) - 1
                if not first:  # the document's main language
                    order = np.lexsort((u, -share, d))
                    pick = order[np.unique(d[order], return_index=True)[1]]
                    known[d[pick]] = True
                    p, d, u, conf, share, longest = np.full(len(pick), -1), d[pick], u[pick], conf[pick] * share[pick], share[pick], longest[pick]
                out["i"].append(d), out["para"].append(p), out["lang"].append(u % 8), out["confidence"].append(conf), out["share"].append(share), out["longest"].append(longest)
        none = np.nonzero(~known)[0]
        out["i"].append(none), out["para"].append(np.full(len(none), -1)), out["lang"].append(np.full(len(none), -1)), out["confidence"].append(np.zeros(len(none))), out["share"].append(np.zeros(len(none))), out["longest"].append(np.zeros(len(none), np.int64))
        r = {k: np.concatenate(v) for k, v in out.items()}
        i = pa.array(r["i"].astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [
                keys.take(i),
                pa.array(r["para"].astype(np.int32), mask=r["para"] < 0),
                pa.array([names[int(x)] if x >= 0 else None for x in r["lang"]], pa.string()),
                pa.array(r["confidence"].astype(float)),
                pa.array(r["share"].astype(float)),
                pa.array(r["longest"].astype(np.int32)),
                pa.array(labels, pa.string()).take(i),
            ],
            [key, "para", "lang", "confidence", "share", "longest", "label"],
        )

    return rows.mapInArrow(run, f"`{key}` {kind}, para int, lang string, confidence double, share double, longest int, label string")
