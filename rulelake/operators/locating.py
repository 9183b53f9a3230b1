"""Verbatim quotes located in whole documents, with the page each stands on and the passage around it.

A quote counts as found where 0.8 of its word trigrams line up. So any place where it is found has one of its rarest fifth: only these
trigrams are looked up in the document, and only around the places they point to are the words read and all trigrams counted. What is
common in a document, or repeated in it a million times, is never paired with every quote. Equal quotes of a document are located
once. Large documents are blocks of words, so none is gathered in a task. Those of at most ``WHOLE`` bytes come row by row to one task each, sorted, so that
their texts are shuffled once and nothing is paired outside of it.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.text import words as words_of
from ..sources.tables import freed, merged, small, written
from .quotes import GAP, SLACK, THRESHOLD, grams, pooled, votes_of

#: Words of a block of a document.
BLOCK = 512
#: Words shown before a quote and after it, words within which its vote is looked for, and words between the numbers of a vote.
BEFORE, AFTER, REACH, APART = 100, 400, 2000, 12
#: A document of up to so many bytes of text is read in one piece, and bytes that count for a row besides its texts.
WHOLE, ROW = 1 << 20, 64
#: Distinct quotes of one or two words, and bytes of them, that are broadcast; beyond, they are joined.
BROADCAST_SHORT, BROADCAST_BYTES = 50_000, 8 << 20
#: Words of a part of a large document; what is read around a place lies in its part and the next, else it is gathered block by block.
PART = 4096


def word_blocks(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc, block, ws, pages): the words (doc, pos, word, page) of documents in blocks, each with the first two words of the next, so that every trigram is in one."""
    own = words.select("doc", "pos", "word", "page", F.floor(F.col("pos") / block).alias("block"))
    also = own.where((F.col("pos") % block < 2) & (F.col("block") > 0)).withColumn("block", F.col("block") - 1)
    sorted_ = F.array_sort(F.collect_list(F.struct("pos", "word", "page")))
    return own.unionByName(also).groupBy("doc", "block").agg(sorted_.alias("x")).select("doc", "block", F.col("x.word").alias("ws"), F.col("x.page").alias("pages"))


def text_blocks(placed: DataFrame, block: int = BLOCK) -> DataFrame:
    """As ``word_blocks``, of texts (doc, start, page, w: words) that follow each other; ``start`` is the place of a text's first word. The texts are cut, not their words shuffled."""
    end = F.col("start") + F.size("w")
    each = placed.where("size(w) > 0").withColumn("block", F.explode(F.sequence(F.floor(F.greatest(F.col("start") - 2, F.lit(0)) / block), F.floor((end - 1) / block))))
    low, high = F.greatest("start", F.col("block") * block), F.least(end, (F.col("block") + 1) * block + 2)
    cut = F.slice("w", (low - F.col("start") + 1).cast("int"), (high - low).cast("int"))
    x = F.array_sort(F.collect_list(F.struct("pos", "w", "page")))
    pieces = each.select("doc", "block", low.alias("pos"), cut.alias("w"), "page").groupBy("doc", "block").agg(x.alias("x"))
    pages = F.flatten(F.transform("x", lambda p: F.array_repeat(p["page"], F.size(p["w"]))))
    return pieces.select("doc", "block", F.flatten("x.w").alias("ws"), pages.alias("pages"))


def large_documents(rows: DataFrame, doc: str, texts: list[str], whole: int = WHOLE) -> DataFrame:
    """(``doc``): the documents with more than ``whole`` bytes of text in all their rows, as a written table; null is none."""
    size = sum((F.coalesce(F.octet_length(t), F.lit(0)) for t in texts), F.lit(ROW)).cast("bigint")
    return written(rows.where(F.col(doc).isNotNull()).groupBy(doc).agg(F.sum(size).alias("_n")).where(F.col("_n") > whole).select(doc), "large")


def by_document(batches, doc: str) -> Iterator[tuple]:
    """(document, its rows) of batches that are sorted by document; a row is a tuple of the other columns."""
    now, rows = None, []
    for b in batches:
        columns = [b.column(c).to_pylist() for c in b.schema.names if c != doc]
        for d, *row in zip(b.column(doc).to_pylist(), *columns):
            if d != now and rows:
                yield now, rows
                rows = []
            now = d
            rows.append(row)
    if rows:
        yield now, rows


def _gathered(places: DataFrame, blocks: DataFrame, low: Column, high: Column, block: int) -> DataFrame:
    """``places`` (which have ``doc``) with ``at``, ``ws`` and ``pages``: the words of their document from the block of word ``low`` to that of ``high``, from word ``at`` on."""
    keyed = places.withColumn("_w", F.monotonically_increasing_id()).withColumn("block", F.explode(F.sequence(F.floor(F.greatest(low, F.lit(0)) / block), F.floor(high / block))))
    body = blocks.select("doc", "block", F.slice("ws", 1, block).alias("b"), F.slice("pages", 1, block).alias("p"))
    kept = [c for c in places.columns if c != "doc"]
    joined = keyed.join(merged(body), ["doc", "block"]).groupBy("doc", "_w").agg(*[F.first(c).alias(c) for c in kept], F.array_sort(F.collect_list(F.struct("block", "b", "p"))).alias("x"))
    return joined.select("doc", *kept, (F.col("x")[0]["block"] * block).alias("at"), F.flatten("x.b").alias("ws"), F.flatten("x.p").alias("pages"))


def swept(places: DataFrame, blocks: DataFrame, low: Column, high: Column, read: Callable, types: list[tuple], block: int = BLOCK, part: int = PART) -> DataFrame:
    """What ``read(row, at, ws, pages)`` gives, as rows of ``types``, for each of ``places`` (which have ``doc``): ``ws`` and ``pages`` are the words of its document from
    the block of word ``low`` to that of ``high``, from word ``at`` on, and ``row`` is a dict.

    Words come once with the places of their part and once with those of the part before, sorted before the places, and are not paired with each of them.
    """
    part = -(-part // block) * block
    first = F.floor(F.greatest(low, F.lit(0)) / block)
    asked = places.select("doc", (first * block).cast("bigint").alias("_at"), ((F.floor(high / block) + 1) * block).cast("bigint").alias("_end"), F.struct(*places.columns).alias("_row"), low.alias("_low"), high.alias("_high"))
    asked = asked.withColumn("_part", F.floor(F.col("_at") / part))
    fits = F.col("_end") <= (F.col("_part") + 2) * part
    own = blocks.select("doc", "block", F.slice("ws", 1, block).alias("_b"), F.slice("pages", 1, block).alias("_p"), F.floor(F.col("block") * block / part).alias("_part"))
    words = own.unionByName(own.where("_part > 0").withColumn("_part", F.col("_part") - 1))
    rows = words.unionByName(asked.where(fits).select("doc", "_part", "_at", "_end", "_row"), allowMissingColumns=True)
    rows = rows.repartition("doc", "_part").sortWithinPartitions("doc", "_part", F.col("block").asc_nulls_last())
    schema = pa.schema([(n, t) for n, t, _ in types])

    def made(out: list):
        cols = list(zip(*out)) if out else [[]] * len(types)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)

    def run(batches):
        now, ws, pages, base = None, [], [], 0
        for b in batches:
            out = []
            for doc, p, i, w, g, at, end, row in zip(*[b.column(c).to_pylist() for c in ("doc", "_part", "block", "_b", "_p", "_at", "_end", "_row")]):
                if (doc, p) != now:
                    now, ws, pages, base = (doc, p), [], [], p * part
                if row is None:
                    if i * block - base > len(ws):  # no words from here to there
                        raise ValueError("a document's blocks are not all there")
                    ws += w
                    pages += g
                elif at - base < len(ws):
                    out += read(row, at, ws[at - base : end - base], pages[at - base : end - base])
            yield made(out)

    def run_far(batches):
        for b in batches:
            out = []
            for row, at, ws, pages in zip(*[b.column(c).to_pylist() for c in ("_row", "at", "ws", "pages")]):
                out += read(row, at, ws, pages)
            yield made(out)

    kinds = ", ".join(f"`{n}` {k}" for n, _, k in types)
    far = _gathered(asked.where(~fits).select("doc", "_row", "_low", "_high"), blocks, F.col("_low"), F.col("_high"), block)
    return rows.mapInArrow(run, kinds).unionByName(far.mapInArrow(run_far, kinds))


def start_pages(start: int, quote: list, ws: list, pages: list, at: int) -> list:
    """The pages on which a quote that starts at a word may begin: where its first words do not stand there, those of the words before count too."""
    i = start - at
    first = quote[:3]
    low = i if ws[i : i + len(first)] == first else max(i - GAP, 0)
    return list(dict.fromkeys(pages[low : i + 1]))


def occurrences(quote: list, ws: list, pages: list, at: int, low: int, high: int) -> list[tuple]:
    """(-pooled, -own, anchor, start, page, pages): where a quote of three words or more stands, for starts from ``low`` to ``high``; ``ws`` are the words from ``at`` on."""
    first = max(low - SLACK - at, 0)  # other words vote for no start that counts
    votes = votes_of(quote, ws[first : max(high + GAP + len(quote) - at, 0)], at + first)
    return _standing(quote, votes, [a for a in votes if low <= a <= high], ws, pages, at)


def _standing(quote: list, votes: dict, starts, ws: list, pages: list, at: int) -> list[tuple]:
    anchors = sorted((-len(pooled(votes, a)), -len(votes[a]), a) for a in starts)
    out, used, need = [], set(), THRESHOLD * (len(quote) - 2)
    for p, own, a in anchors:
        if -p < need - 1e-9:
            break
        near = pooled(votes, a, used)
        if len(near) >= need - 1e-9:
            used.update((s, j) for j, s in near.items())
            start = max(near[min(near)], 0)
            out.append((p, own, a, start, pages[start - at], start_pages(start, quote, ws, pages, at)))
    return out


class Document:
    """The words of a document and the pages they stand on, in which quotes are located by their rarest trigrams."""

    def __init__(self, ws: list, pages: list) -> None:
        self.ws, self.pages, self.index, self.single = ws, pages, defaultdict(list), None
        for i, g in enumerate(zip(ws, ws[1:], ws[2:])):
            self.index[g].append(i)

    def places(self, quote: list) -> list[tuple]:
        """As ``occurrences`` over all the document; of a quote of one or two words all places where it stands verbatim."""
        if len(quote) < 3:
            if self.single is None:
                self.single = defaultdict(list)
                for i, w in enumerate(self.ws):
                    self.single[w].append(i)
            at = [i for i in self.single.get(quote[0], ()) if self.ws[i : i + len(quote)] == quote] if quote else []
            return [(0, 0, i, i, self.pages[i], [self.pages[i]]) for i in at]
        own = list(zip(quote, quote[1:], quote[2:]))
        seen = [self.index.get(g, ()) for g in own]
        # as many of the rarest as may not line up, and one more
        seeds = sorted(range(len(own)), key=lambda j: (len(seen[j]), j))[: len(own) - math.ceil(len(own) * THRESHOLD - 1e-9) + 1]
        starts = {i - j for j in seeds for i in seen[j]}
        if not starts:
            return []
        reach = range(-GAP - SLACK, GAP + SLACK + 1)
        near, votes = {s + k for s in starts for k in reach}, defaultdict(set)
        for j, places in enumerate(seen):
            for i in places:
                if i - j in near:
                    votes[i - j].add(j)
        return _standing(quote, votes, [a for a in {s + k for s in starts for k in range(-GAP, SLACK + 1)} if a in votes], self.ws, self.pages, 0)

    def located(self, quote: list, cited: int | None) -> tuple | None:
        """(word, page) at which a quote stands, the page cited before others."""
        places = self.places(quote)
        if not places:
            return None
        own = [p for p in places if cited is not None and cited in p[5]]
        best = min(own or places, key=lambda p: p[:4])
        return best[3], cited if own else best[4]


def located_in(quotes: DataFrame, blocks: DataFrame, *, block: int = BLOCK) -> DataFrame:
    """(key, found, pos, page): of each quote (key, doc, quote, page) whether it stands in its document, at which word, and on which page.

    Of several places the best on the page cited counts, else the best and earliest; the page cited is kept where the quote may begin on it. A quote of one or
    two words must stand verbatim. Null and empty quotes, and those of no document, are not found. ``blocks`` come from ``word_blocks`` and should be written.
    """
    kind = blocks.schema["doc"].dataType.simpleString()
    asked = written(quotes.select("key", "doc", words_of("quote").alias("q"), F.col("page").alias("cited")).withColumn("id", F.xxhash64("doc", "q")), "quotes")
    distinct = asked.where("size(q) > 0").select("doc", "id", "q").dropDuplicates(["doc", "id"])
    # trigrams are hashed with their document: of two with one hash both are looked at, and the words decide
    here = blocks.select("doc", "block", F.posexplode(grams(F.col("ws"), 3)).alias("i", "gram")).where(F.col("i") < block)
    here = here.select(F.xxhash64("doc", "gram").alias("gram"), (F.col("block") * block + F.col("i")).alias("pos"))
    long = written(distinct.where("size(q) > 2"), "long")
    each = long.select("id", F.size("q").alias("n"), F.posexplode(grams(F.col("q"), 3)).alias("j", "gram"), "doc").select("doc", "id", "n", "j", F.xxhash64("doc", "gram").alias("gram"))
    wanted = written(here.join(merged(each.select("gram").distinct()), "gram", "left_semi"), "grams")
    freed(blocks.sparkSession)
    seen = wanted.groupBy("gram").agg(F.count("*").alias("f"))
    rare = Window.partitionBy("doc", "id").orderBy(F.coalesce("f", F.lit(0)), "j")
    missed = F.col("n") - 2 - F.ceil((F.col("n") - 2) * THRESHOLD - 1e-9)
    seeds = each.join(merged(seen), "gram", "left").withColumn("r", F.row_number().over(rare)).where(F.col("r") <= missed + 1)
    starts = seeds.join(merged(wanted), "gram").select("doc", "id", (F.col("pos") - F.col("j")).alias("s")).distinct()
    by = Window.partitionBy("doc", "id").orderBy("s")
    reach = 2 * (GAP + SLACK)
    island = F.sum(F.when(F.col("s") - F.lag("s").over(by) <= reach, 0).otherwise(1)).over(by)
    near = starts.withColumn("k", island).groupBy("doc", "id", "k").agg(F.min("s").alias("lo"), F.max("s").alias("hi"))
    near = written(near, "near")
    freed(blocks.sparkSession)

    def search(x, at, ws, pages):
        return [(x["doc"], x["id"], *o) for o in occurrences(x["q"], ws, pages, at, x["lo"] - GAP, x["hi"] + SLACK)]

    types = [("doc", to_arrow_type(blocks.schema["doc"].dataType), kind), ("id", pa.int64(), "bigint"), ("a", pa.int32(), "int"), ("b", pa.int32(), "int"), ("c", pa.int64(), "bigint")]
    types += [("start", pa.int64(), "bigint"), ("page", pa.int32(), "int"), ("pages", pa.list_(pa.int32()), "array<int>")]
    asked_near = near.join(merged(long), ["doc", "id"]).select("doc", "id", "q", "lo", "hi")
    found = swept(asked_near, blocks, F.col("lo") - 3 * reach, F.col("hi") + F.size("q") + reach, search, types, block)
    place = F.struct("a", "b", "c", "start", "page")
    places = written(found.select("doc", "id", place.alias("x"), "pages").unionByName(_short(distinct.where("size(q) < 3"), blocks, block)), "places")
    best = places.groupBy("doc", "id").agg(F.min("x").alias("x"))
    on = places.select("doc", "id", "x", F.explode("pages").alias("cited")).where("cited is not null").groupBy("doc", "id", "cited").agg(F.min("x").alias("y"))
    j = asked.select("key", "doc", "id", "cited").join(merged(best), ["doc", "id"], "left").join(merged(on), ["doc", "id", "cited"], "left")
    return j.select("key", F.col("x").isNotNull().alias("found"), F.coalesce("y.start", "x.start").alias("pos"), F.when(F.col("y").isNotNull(), F.col("cited")).otherwise(F.col("x.page")).alias("page"))


def _short(distinct: DataFrame, blocks: DataFrame, block: int) -> DataFrame:
    """Places of quotes of one or two words: the first of each page, which is all that can be chosen."""
    out = None
    for n in (1, 2):
        q = distinct.where(F.size("q") == n).select("doc", "id", F.concat_ws(" ", "q").alias("gram"))
        own = grams(F.col("ws"), n)
        at = blocks.join(q.select("doc").distinct(), "doc", "left_semi").select("doc", "block", "pages", F.posexplode(own).alias("i", "gram")).where(F.col("i") < block)
        at = at.select("doc", "gram", (F.col("block") * block + F.col("i")).alias("start"), F.element_at("pages", F.col("i") + 1).alias("page"))
        few = small(q, BROADCAST_SHORT, BROADCAST_BYTES)
        first = at.join(F.broadcast(q) if few else merged(q), ["doc", "gram"]).groupBy("doc", "id", "page").agg(F.min("start").alias("start"))
        x = F.struct(F.lit(0).alias("a"), F.lit(0).alias("b"), F.col("start").alias("c"), F.col("start"), F.col("page"))
        part = first.select("doc", "id", x.alias("x"), F.array("page").alias("pages"))
        out = part if out is None else out.unionByName(part)
    return out


def vote_end(ws: list, wanted: list, trailing: list, after: int) -> int | None:
    """The word after a vote: its numbers in order, each at most ``APART`` words after the one before, then the words that it ends with."""

    def follow(at: int, tokens: list) -> int | None:
        for t in tokens:
            near = ws[at + 1 : at + 1 + APART]
            if t not in near:
                return None
            at += 1 + near.index(t)
        return at

    for i in range(after, min(after + REACH, len(ws))):
        if wanted and ws[i] == wanted[0]:
            at = follow(i, wanted[1:])
            if at is not None:
                end = follow(at, trailing)
                return (at if end is None else end) + 1
    return None


def passage(ws: list, pos: int, n: int, v: list) -> tuple[int, int, str]:
    """(first, last, words) of the passage around a quote of ``n`` words at ``pos``, whose vote has the words ``v``."""
    numbers = [t for t in v if t.isdigit()]
    trailing = v[len(v) - v[::-1].index(numbers[-1]) :] if numbers else []
    after = pos + n
    end = max(after + AFTER, vote_end(ws, numbers or v, trailing, after) or 0)
    first, last = max(pos - BEFORE, 0), min(end, len(ws))
    return first, last, " ".join(ws[first:last])


def passages(places: DataFrame, blocks: DataFrame, *, block: int = BLOCK, known: Sequence[str] = ()) -> DataFrame:
    """(key, first, last, words), and of doc and pos what is ``known``: the words of a document around quotes found at (key, doc, pos, quote, vote): from ``BEFORE`` words before to ``AFTER`` after, or to the
    end of the decision's vote where that stands further on; ``last`` is the word after the passage.
    """
    asked = places.select("doc", "key", F.col("pos"), F.size(words_of("quote")).alias("n"), words_of("vote").alias("v"))

    def cut(x, at, ws, _):
        first, last, said = passage(ws, x["pos"] - at, x["n"], x["v"])
        return [(x["key"], first + at, last + at, said, *[x[c] for c in known])]

    key = places.schema["key"].dataType
    types = [("key", to_arrow_type(key), key.simpleString()), ("first", pa.int64(), "bigint"), ("last", pa.int64(), "bigint"), ("words", pa.string(), "string")]
    types += [(c, to_arrow_type(places.schema[c].dataType), places.schema[c].dataType.simpleString()) for c in known]
    return swept(asked, blocks, F.col("pos") - BEFORE, F.col("pos") + F.col("n") + F.greatest(F.lit(AFTER), REACH + (F.size("v") + 1) * (APART + 1)), cut, types, block)


def read_whole(rows: DataFrame, cite: bool = True, around: bool = False) -> DataFrame:
    """(doc, key, start, n, pos, page, m), with ``around`` first, last and words too: of each decision of documents of at most ``WHOLE`` bytes the place of its text among the
    words of its document, the place and page of its quote, null where it does not stand there, and how many words both have.

    ``rows`` have doc, key, rank, page, w, q, v (words of the text, of the quote and of the vote with blanks between) and one, which tells decisions apart; rows that
    agree in all but the page are one decision, on the least of its key's pages. Decisions follow each other by rank and key.
    """
    kind = rows.schema["key"].dataType
    types = [("doc", pa.string(), "string"), ("key", to_arrow_type(kind), kind.simpleString()), ("start", pa.int64(), "bigint"), ("n", pa.int32(), "int"), ("pos", pa.int64(), "bigint"), ("page", pa.int32(), "int"), ("m", pa.int32(), "int")]
    types += [("first", pa.int64(), "bigint"), ("last", pa.int64(), "bigint"), ("words", pa.string(), "string")] * around
    schema = pa.schema([x[:2] for x in types])

    def decided(rows: list):
        least, kept = {}, {}
        for key, rank, page, w, q, v, one in rows:
            if page is not None:
                least[key] = min(page, least.get(key, page))
            kept[key, rank, one] = (w, q, v)
        order = sorted(kept, key=lambda x: (x[1] is None, x[1] or 0, x[0] is None, x[0] or "", x[2]))
        ws, pages, out = [], [], []
        for x in order:
            w = kept[x][0].split()
            out.append((x[0], least.get(x[0]), len(ws), len(w), *kept[x][1:]))
            ws += w
            pages += [least.get(x[0])] * len(w)
        return Document(ws, pages), out

    def run(batches):
        def made(out):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) if out else [[]] * len(types), schema.types)], schema=schema)

        out, words = [], 0
        for doc, rows in by_document(batches, "doc"):
            document, all_of = decided(rows)
            known: dict = {}
            for key, page, start, n, q, v in all_of:
                cited = page if cite else None
                if (q, cited) not in known:
                    known[q, cited] = document.located(q.split(), cited) or (None, None)
                pos, on = known[q, cited]
                m = len(q.split())
                row = (doc, key, start, n, pos, on, m)
                if around:
                    row += (None, None, None) if pos is None else passage(document.ws, pos, m, v.split())
                out.append(row)
            words += len(document.ws)
            if len(out) > 2000 or words > 200_000:
                yield made(out)
                out, words = [], 0
        yield made(out)

    own = rows.where("doc is not null").select("doc", "key", "rank", "page", "w", "q", "v", "one")
    return own.repartition("doc").sortWithinPartitions("doc").mapInArrow(run, ", ".join(f"`{n}` {k}" for n, _, k in types))


def containing(a: DataFrame, b: DataFrame, whole: int = WHOLE) -> DataFrame:
    """(doc, a, b): quotes of a document of which one holds the other, case, signs and white space aside; both sides have doc, key and quote.

    Documents of up to ``whole`` bytes are read by one task each. In others what holds a quote of three words or more holds its rarest three words in a row, so only those are
    joined, as hashes, and the texts of what they bring together are compared; shorter quotes are joined by their rarest word. Null and empty quotes hold nothing.
    """
    both = a.withColumn("side", F.lit(0)).unionByName(b.withColumn("side", F.lit(1)))
    large = large_documents(both, "doc", ["quote"], whole)
    said = both.where("doc is not null").select("doc", "side", "key", F.concat_ws(" ", words_of("quote")).alias("t")).where("t <> ''")
    return _containing_whole(said.join(large, "doc", "left_anti")).unionByName(_containing_large(said.join(large, "doc", "left_semi")))


def held_in(inner: list[str], outer: list[str]) -> list[tuple[int, int]]:
    """(i, j): which inner texts stand in which outer ones, as words with blanks between."""
    split, grams_of = [t.split() for t in outer], {}
    padded = [f" {t} " for t in outer]
    out = []
    for i, t in enumerate(inner):
        w = t.split()
        n = 3 if len(w) > 2 else 1
        if n not in grams_of:
            index = defaultdict(list)
            for j, x in enumerate(split):
                for g in set(zip(*[x[k:] for k in range(n)])):
                    index[g].append(j)
            grams_of[n] = index
        index, t = grams_of[n], f" {t} "
        rarest = min((index.get(g, ()) for g in zip(*[w[k:] for k in range(n)])), key=len)
        out += [(i, j) for j in rarest if t in padded[j]]
    return out


def _containing_whole(said: DataFrame) -> DataFrame:
    types = [("doc", "doc"), ("a", "key"), ("b", "key")]
    schema = pa.schema([(n, to_arrow_type(said.schema[c].dataType)) for n, c in types])

    def made(out):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) if out else [[]] * 3, schema.types)], schema=schema)

    def run(batches):
        out = []
        for doc, rows in by_document(batches, "doc"):
            keys = defaultdict(set), defaultdict(set)
            for side, key, t in rows:
                keys[side][t].add(key)
            x, y = list(keys[0]), list(keys[1])
            met = dict.fromkeys([(x[i], y[j]) for i, j in held_in(x, y)] + [(x[i], y[j]) for j, i in held_in(y, x)])
            given: set = set()  # a key with several texts may be met several times
            for s, t in met:
                for p in keys[0][s]:
                    for q in keys[1][t]:
                        if (p, q) not in given:
                            given.add((p, q))
                            out.append((doc, p, q))
                if len(out) > 10_000:
                    yield made(out)
                    out = []
        yield made(out)

    rows = said.select("doc", "side", "key", "t").repartition("doc").sortWithinPartitions("doc")
    return rows.mapInArrow(run, ", ".join(f"`{n}` {said.schema[c].dataType.simpleString()}" for n, c in types))


def _containing_large(said: DataFrame) -> DataFrame:
    sides = []
    for k, x in enumerate("ab"):
        own = said.where(F.col("side") == k).select("doc", F.col("key").alias(x), F.concat(F.lit(" "), "t", F.lit(" ")).alias(f"t{x}"))
        sides.append(written(own.distinct().withColumn(f"i{x}", F.monotonically_increasing_id()), "quotes"))

    def met(i: str, o: str, inner: DataFrame, outer: DataFrame) -> DataFrame:
        """(ia, ib): the rows of which the outer one has the rarest words of the inner one."""
        out = None
        for n, size in ((3, "size(w) > 2"), (1, "size(w) < 3")):
            each = [df.select("doc", f"i{x}", F.split(F.trim(f"t{x}"), " ").alias("w")) for df, x in ((inner, i), (outer, o))]
            own, held = [e.select(f"i{x}", "doc", F.explode(F.array_distinct(grams(F.col("w"), n))).alias("gram")).select(f"i{x}", F.xxhash64("doc", "gram").alias("gram")) for e, x in ((each[0].where(size), i), (each[1], o))]
            own = written(own, "grams")
            held = written(held.join(own.select("gram").distinct(), "gram", "left_semi"), "grams")
            freed(said.sparkSession)
            often = held.groupBy("gram").agg(F.count("*").alias("f"))
            # a quote of which a gram is nowhere is held by nothing
            rare = own.join(often, "gram", "left").groupBy(f"i{i}").agg(F.min(F.struct(F.coalesce("f", F.lit(0)).alias("f"), "gram")).alias("x")).where("x.f > 0").select(f"i{i}", F.col("x.gram").alias("gram"))
            part = rare.join(held, "gram").select("ia", "ib")
            out = part if out is None else out.unionByName(part)
        return out

    a, b = sides
    pairs = written(met("a", "b", a, b).unionByName(met("b", "a", b, a)).distinct(), "met")
    freed(said.sparkSession)
    return pairs.join(a, "ia").join(b.drop("doc"), "ib").where(F.col("tb").contains(F.col("ta")) | F.col("ta").contains(F.col("tb"))).select("doc", "a", "b").distinct()
