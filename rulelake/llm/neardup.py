"""Near-duplicate records by SetSketch: banded registers, joint likelihood, exact verification.

A record is the multiset of its words: its elements are (word, how many times so far), so that the Jaccard similarity of two sets is
the share of words in both, counted with repetitions, of the words in either. Each element draws exponentially spaced values;
a register keeps the truncated minimum of its draws as a level, so that sketches merge by maximum. Levels are equal about as
often as the sets are similar. Bands of registers are the keys of the search; the parities of some registers form a short
signature that comes with the key. What passes both is estimated jointly by likelihood from the registers, and then counted.

Only (band key, signature) pairs are shuffled for the search, each distinct pair once, so that a third of the rows being copies
of one text add nothing to a bucket. Pairs are sought between distinct signatures and then between classes of records with the
same words, and only the texts of candidates are fetched.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import dropped, freed, small, written

THRESHOLD = 0.75
#: Bands and registers of a band: the search misses 3.2 pairs of 1,000 at similarity 0.75, 4.4 of 10,000 at 0.78, 8 of 100,000 at 0.8, 2 of 10 million at 0.85.
BANDS, ROWS = 40, 7
#: Bands whose keys are shuffled and compared at a time.
AT_A_TIME = 10
#: Registers whose parities form the signature, and the most bits in which a pair may differ: 19 of 64 lose 7 pairs of 100,000 at similarity 0.75.
SIGNATURE, DIFFER = 64, 19
#: Candidates are compared by so many signatures of further registers together: 54 of 256 bits lose 3 pairs of 100,000 at similarity 0.75.
SIGNATURES, DIFFER_ALL = 4, 54
#: A bucket of more rows is split into blocks of so many signatures, each pair of blocks compared in a task of its own.
HOT = 4096
#: Parameters of the sketch: base, rate and number of levels.
BASE, RATE, LEVELS = 1.001, 20.0, 65_534
#: A worker keeps the draws of at most so many elements.
KEPT = 120_000
#: A task remembers at most so many records whose keys it has given.
REMEMBERED = 1_000_000
#: Up to this many keys of candidates are broadcast to fetch their texts; beyond, they are joined.
BROADCAST_KEYS = 500_000
#: The members of a class of copies are paired in blocks of about so many.
BLOCK = 2_000


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def words(text: str | None) -> list[str]:
    return re.findall(r"\w+", text.lower()) if text else []


class Sketcher:
    """Sketches of word multisets. The draws of an element are kept, as most elements come again."""

    def __init__(self, registers: int) -> None:
        self.m = registers
        with np.errstate(over="ignore"):
            self.seeds = _mixed(np.arange(1, registers + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.clear()

    def clear(self) -> None:
        self.at: dict = {}
        self.levels = np.zeros((1024, self.m), np.uint16)
        self.new: list = []

    def draws(self, elements: list) -> np.ndarray:
        """Levels of elements, one row each."""
        import xxhash

        h = np.fromiter(((xxhash.xxh64_intdigest(e, 0) if isinstance(e, str) else xxhash.xxh64_intdigest(e[0], e[1])) for e in elements), np.uint64, len(elements))
        out = np.empty((len(elements), self.m), np.uint16)
        for lo in range(0, len(h), 2000):
            u = (_mixed(h[lo : lo + 2000, None] ^ self.seeds[None, :]) >> np.uint64(11)).astype(float)
            x = -np.log((u + 0.5) * 2.0**-53) / RATE
            out[lo : lo + 2000] = np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, LEVELS + 1)
        return out

    def index(self, said: list[str]) -> list[int]:
        """Rows of the elements of a text; the first occurrence of a word is the word itself, the next (word, 1) and so on."""
        at = self.at
        count = Counter(said)
        elements = list(count)
        if len(elements) < len(said):
            elements += [(w, i) for w, n in count.items() if n > 1 for i in range(1, n)]
        try:
            return list(map(at.__getitem__, elements))
        except KeyError:
            for e in elements:
                if e not in at:
                    at[e] = len(at)
                    self.new.append(e)
            return list(map(at.__getitem__, elements))

    def settle(self) -> None:
        if self.new:
            n = len(self.at)
            if n > len(self.levels):
                more = np.zeros((max(n, 2 * len(self.levels)), self.m), np.uint16)
                more[: len(self.levels)] = self.levels
                self.levels = more
            self.levels[n - len(self.new) : n] = self.draws(self.new)
            self.new = []

    def sketches(self, texts: list[list[str]]) -> np.ndarray:
        """One row of registers a text, each with at least one word."""
        out = np.zeros((len(texts), self.m), np.uint16)
        for lo in range(0, len(texts), 256):
            if len(self.at) > KEPT:
                self.clear()
            rows = [self.index(t) for t in texts[lo : lo + 256]]
            self.settle()
            for k, r in enumerate(rows):
                if len(r) <= 20_000:
                    self.levels.take(r, axis=0).max(0, out=out[lo + k])
                else:  # very long texts piece by piece: sketches merge
                    for at in range(0, len(r), 20_000):
                        out[lo + k] = np.maximum(out[lo + k], self.levels.take(r[at : at + 20_000], axis=0).max(0))
        return out


def sketcher(registers: int) -> Sketcher:
    kept = sys.__dict__.setdefault("_rulelake_sketchers", {})
    if registers not in kept:
        kept[registers] = Sketcher(registers)
    return kept[registers]


def signatures(sketches: np.ndarray, number: int = 0) -> np.ndarray:
    """The parities of the last registers, or of those so many signatures before them, as numbers."""
    end = sketches.shape[1] - number * SIGNATURE
    return np.packbits((sketches[:, end - SIGNATURE : end] & 1).astype(np.uint8), axis=1).view(np.int64).ravel()


def words_hash(said: list[str]) -> int:
    """A signed 64-bit hash of a multiset of words."""
    import xxhash

    return xxhash.xxh64_intdigest("\0".join(sorted(said))) - (1 << 63)


def band_keys(registers: str, bands: int, rows: int, group: int) -> Column:
    """The keys of the bands of one group, from the low bytes of the registers."""
    own = range(group * AT_A_TIME, min(bands, (group + 1) * AT_A_TIME))
    return F.array(*[F.xxhash64(F.substring(registers, i * rows + 1, rows), F.lit(i)) for i in own])


def joint_likelihood(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """The likeliest Jaccard similarity of pairs of sketches whose sets have ``na`` and ``nb`` elements, by bisection of the score."""
    more, less = (a > b).sum(1), (a < b).sum(1)
    same = a.shape[1] - more - less
    u, v = na / (na + nb), nb / (na + nb)
    lo, hi = np.zeros(len(a)), np.minimum(u / v, v / u)
    step = (BASE - 1) / BASE
    log_b = np.log(BASE)

    def p(x):
        return -np.log1p(-np.clip(x, 0, 1) * step) / log_b

    def likelihood(j):
        x, y = p(u - v * j), p(v - u * j)
        with np.errstate(divide="ignore", invalid="ignore"):
            return sum(np.where(n > 0, n * np.log(np.maximum(q, 1e-12)), 0) for n, q in ((more, x), (less, y), (same, 1 - x - y)))

    for _ in range(40):  # golden section; the likelihood has one maximum
        d = (hi - lo) * 0.381966
        left = likelihood(lo + d) >= likelihood(hi - d)
        hi, lo = np.where(left, hi - d, hi), np.where(left, lo, lo + d)
    return (lo + hi) / 2


def _texts(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    text = F.concat_ws(" ", *[F.col(c).cast("string") for c in columns])
    return df.where(F.col(key).isNotNull()).select(F.col(key).alias("_k"), text.alias("_t"))


def unseen(seen: set, s: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which records have a signature and words that are not yet ``seen``, to which they are added; a full memory begins anew."""
    if len(seen) > REMEMBERED:
        seen.clear()
    new = np.zeros(len(s), bool)
    for i, x in enumerate(zip(s.tolist(), h.tolist())):
        if x not in seen:
            seen.add(x)
            new[i] = True
    return new


#: The further signatures.
_MORE = [f"_s{i}" for i in range(1, SIGNATURES)]


def sketched(df: DataFrame, key: str, columns: Sequence[str], *, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(``_k``, ``_s`` signature, ``_h`` hash of the words, ``_s1`` and so on further signatures, ``_r`` low bytes of the registers): records with words, as a
    written table.

    The registers are null where the same task has given them for the same signature and words, so that copies add no rows to the search.
    """

    def run(batches):
        sketch, seen = sketcher(max(bands * rows, SIGNATURES * SIGNATURE)), set()
        for b in batches:
            said = [words(t) for t in b.column("_t").to_pylist()]
            have = [i for i, w in enumerate(said) if w]
            if not have:
                continue
            said = [said[i] for i in have]
            k = sketch.sketches(said)
            s = signatures(k)
            h = np.fromiter(map(words_hash, said), np.int64, len(said))
            low = k[:, : bands * rows].astype(np.uint8)
            r = pa.array([low[i].tobytes() if new else None for i, new in enumerate(unseen(seen, s, h))], pa.binary())
            more = [pa.array(signatures(k, i)) for i in range(1, SIGNATURES)]
            yield pa.RecordBatch.from_arrays([b.column("_k").take(pa.array(have)), pa.array(s), pa.array(h), *more, r], ["_k", "_s", "_h", *_MORE, "_r"])

    t = _texts(df, key, columns)
    return written(t.mapInArrow(run, f"_k {t.schema['_k'].dataType.simpleString()}, _s bigint, _h bigint, {', '.join(f'{c} bigint' for c in _MORE)}, _r binary"), "sketches")


def candidates(sketches: DataFrame, *, bands: int = BANDS, rows: int = ROWS, differ: int = DIFFER, hot: int = HOT) -> DataFrame:
    """(``_sa``, ``_sb``): pairs of different signatures that share a band and differ in few bits, each once.

    A few bands are shuffled and compared at a time, so that only their keys are on disk.
    """
    out = None
    for g in range(-(-bands // AT_A_TIME)):
        keyed = sketches.where("_r is not null").select(F.explode(band_keys("_r", bands, rows, g)).alias("_b"), "_s")
        scanned = written(keyed.repartition("_b").sortWithinPartitions("_b").mapInArrow(_bucket_scan(differ, hot), "_b bigint, _sa bigint, _sb bigint"), "buckets")
        near = scanned.where("_b is null").select("_sa", "_sb")
        if not scanned.where("_b is not null").isEmpty():
            near = near.unionByName(_hot_pairs(scanned.where("_b is not null").select("_b", F.col("_sa").alias("_s")).distinct(), differ, hot))
        out = near if out is None else out.unionByName(near)
        del keyed
        freed(sketches.sparkSession)
    return out.distinct()


def _bucket_scan(differ: int, hot: int):
    """Pairs of near signatures from rows sorted by band key (a sort by one number is quick): each signature against those after it in its bucket.

    A bucket of more than ``hot`` rows is not compared here; its rows come out with their band key.
    """

    def pairs(b: np.ndarray, s: np.ndarray):
        first = np.ones(len(b), bool)
        first[1:] = (b[1:] != b[:-1]) | (s[1:] != s[:-1])
        b, s = b[first], s[first]
        at, d = np.arange(len(b)), 1
        while True:
            at = at[at + d < len(b)]
            at = at[b[at] == b[at + d]]
            if not len(at):
                return
            near = at[np.bitwise_count((s[at] ^ s[at + d]).view(np.uint64)) <= differ]
            yield s[near], s[near + d]
            d += 1

    def out(b, x, y):
        return pa.RecordBatch.from_arrays([pa.array(b, pa.int64()) if b is not None else pa.nulls(len(x), pa.int64()), pa.array(x), pa.array(y)], ["_b", "_sa", "_sb"])

    def run(batches):
        b = s = np.zeros(0, np.int64)
        burning = None  # the hot bucket that goes on
        for batch in batches:
            nb, ns = batch.column("_b").to_numpy(), batch.column("_s").to_numpy()
            if burning is not None:
                n = int(np.searchsorted(nb, burning, "right"))
                if n:
                    yield out(nb[:n], ns[:n], ns[:n])
                nb, ns = nb[n:], ns[n:]
                if not len(nb):
                    continue
                burning = None
            b, s = np.concatenate([b, nb]), np.concatenate([s, ns])
            if not len(b):
                continue
            tail = int(np.searchsorted(b, b[-1], "left"))
            yield from whole(b[:tail], s[:tail])
            b, s = b[tail:], s[tail:]
            if len(b) > hot:
                burning = int(b[0])
                yield out(b, s, s)
                b = s = np.zeros(0, np.int64)
        yield from whole(b, s)

    def whole(b, s):
        if not len(b):
            return
        alone = np.ones(len(b), bool)
        alone[1:] &= b[1:] != b[:-1]
        alone[:-1] &= b[1:] != b[:-1]
        b, s = b[~alone], s[~alone]
        order = np.lexsort((s, b))
        b, s = b[order], s[order]
        if not len(b):
            return
        starts = np.nonzero(np.r_[True, b[1:] != b[:-1]])[0]
        size = np.diff(np.r_[starts, len(b)])
        large = np.repeat(size > hot, size)
        if large.any():
            yield out(b[large], s[large], s[large])
            b, s = b[~large], s[~large]
        for x, y in pairs(b, s):
            if len(x):
                yield out(None, x, y)

    return run


def _hot_pairs(rows: DataFrame, differ: int, hot: int) -> DataFrame:
    """The near pairs of hot buckets: each is split into blocks of about ``hot`` signatures, and any two blocks meet once, in a task of their own."""
    blocks = rows.groupBy("_b").agg(F.ceil(F.count("*") / hot).cast("int").alias("_n"))
    placed = rows.join(blocks, "_b").withColumn("_i", F.pmod(F.xxhash64("_s"), F.col("_n")).cast("int"))
    left = placed.select("_b", F.col("_i").alias("_x"), F.explode(F.expr("sequence(_i, _n - 1)")).alias("_y"), F.col("_s").alias("_sa"))
    right = placed.select("_b", F.explode(F.expr("sequence(0, _i)")).alias("_x"), F.col("_i").alias("_y"), F.col("_s").alias("_sb"))
    met = left.join(right, ["_b", "_x", "_y"]).where((F.col("_x") < F.col("_y")) | (F.col("_sa") < F.col("_sb")))
    near = met.where(F.bit_count(F.col("_sa").bitwiseXOR(F.col("_sb"))) <= differ)
    return near.select(F.least("_sa", "_sb").alias("_sa"), F.greatest("_sa", "_sb").alias("_sb"))


def similar_classes(df: DataFrame, key: str, columns: Sequence[str], *, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Classes of records with the same words, and the similar pairs of classes.

    Returns records (``_k``, ``_s``, ``_h``), classes (``_s``, ``_h``, ``_c`` least key, ``_n`` keys) and pairs (``_sa``, ``_ha``, ``_a``, ``_sb``, ``_hb``,
    ``_b``, ``similarity``) of classes, verified and checkpointed. A record without words is in no class. Nulls count as empty,
    repeated rows once; a key with several texts is in several classes. An empty table gives empty results.
    """
    table = sketched(df, key, columns, bands=bands, rows=rows)
    near = written(candidates(table, bands=bands, rows=rows), "candidates")
    of = written(table.select("_k", "_s", "_h", *_MORE).distinct(), "records")
    dropped(table)
    classes = written(of.groupBy("_s", "_h").agg(F.min("_k").alias("_c"), F.count("*").alias("_n"), *[F.min(c).alias(c) for c in _MORE]), "records-alike")  # read several times
    named, of = classes.drop(*_MORE), of.drop(*_MORE)
    a, b = [classes.select(F.col("_s").alias(f"_s{x}"), F.col("_h").alias(f"_h{x}"), F.col("_c").alias(f"_{x}"), *[F.col(c).alias(c + x) for c in _MORE]) for x in "ab"]
    columns_of = ["_sa", "_ha", "_a", "_sb", "_hb", "_b"]
    bits = sum((F.bit_count(F.col(f"{c}a").bitwiseXOR(F.col(f"{c}b"))) for c in ["_s", *_MORE]), F.lit(0))
    across = near.join(a, "_sa").join(b, "_sb").where(bits <= DIFFER_ALL).select(columns_of)
    several = named.join(named.groupBy("_s").agg(F.count("*").alias("_m")).where("_m > 1").select("_s"), "_s", "left_semi")
    a, b = [several.select("_s", F.col("_s").alias(f"_s{x}"), F.col("_h").alias(f"_h{x}"), F.col("_c").alias(f"_{x}")) for x in "ab"]
    within = a.join(b, "_s").where("_ha < _hb").select(columns_of)
    both = written(across.unionByName(within), "classes")
    freed(df.sparkSession)

    need = both.select(F.explode(F.array("_a", "_b")).alias("_k")).distinct()
    few = small(need, BROADCAST_KEYS)
    texts = written(_texts(df, key, columns).join(F.broadcast(need) if few else need, "_k", "left_semi").distinct(), "texts")  # for both sides
    registers = max(bands * rows, SIGNATURES * SIGNATURE)
    kind = df.schema[key].dataType.simpleString()

    def verify(batches):
        sketch = sketcher(registers)
        slack = 6 * np.sqrt(threshold * (1 - threshold) / registers)
        for x in batches:
            ia, ib = [x.column(c).dictionary_encode() for c in ("_ta", "_tb")]
            said = [[words(t) for t in i.dictionary.to_pylist()] for i in (ia, ib)]  # a text that is in many pairs is read once
            if not len(ia):
                continue
            levels, n = [sketch.sketches(w) for w in said], [np.array(list(map(len, w)), float) for w in said]
            ia, ib = ia.indices.to_numpy(), ib.indices.to_numpy()
            likely = joint_likelihood(levels[0][ia], levels[1][ib], n[0][ia], n[1][ib])
            bags, hashes = [list(map(Counter, w)) for w in said], [list(map(words_hash, w)) for w in said]
            ha, hb = x.column("_ha").to_numpy(), x.column("_hb").to_numpy()
            keep, sims = [], []
            for i in np.nonzero(likely >= threshold - slack)[0]:
                p, q = ia[i], ib[i]
                a, b = bags[0][p], bags[1][q]
                shared = sum(min(k, b[w]) for w, k in a.items() if w in b)
                s = shared / (n[0][p] + n[1][q] - shared)
                # of a key with several texts only the class's own counts
                if s >= threshold and hashes[0][p] == ha[i] and hashes[1][q] == hb[i]:
                    keep.append(int(i)), sims.append(s)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([*[x.column(c).take(at) for c in columns_of], pa.array(sims, pa.float64())], [*columns_of, "similarity"])

    ta, tb = texts.select(F.col("_k").alias("_a"), F.col("_t").alias("_ta")), texts.select(F.col("_k").alias("_b"), F.col("_t").alias("_tb"))
    # texts without words have no class, so an empty text of a key with several texts is none of these
    joined = both.join(ta.where("_ta <> ''"), "_a").join(tb.where("_tb <> ''"), "_b")
    found = joined.mapInArrow(verify, f"_sa bigint, _ha bigint, _a {kind}, _sb bigint, _hb bigint, _b {kind}, similarity double")
    return of, named, written(found, "similar")


def similar_pairs(df: DataFrame, key: str, columns: Sequence[str], *, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(``a``, ``b``): the pairs of keys, the smaller first, whose records are similar, copies included, each once.

    Every pair given is similar by count. A pair is missed with the probability that the constants ``BANDS``, ``ROWS`` and ``DIFFER`` state: three of 1,000 at
    similarity 0.75, four of 10,000 at 0.78, 8 of 100,000 at 0.8. Copies are paired in blocks, so a class that holds a third of all records is no
    hot key; its pairs are as many as they are.
    """
    of, named, pairs = similar_classes(df, key, columns, threshold=threshold, bands=bands, rows=rows)
    paired = pairs.select(F.explode(F.array(F.struct(F.col("_sa").alias("_s"), F.col("_ha").alias("_h")), F.struct(F.col("_sb").alias("_s"), F.col("_hb").alias("_h")))).alias("x")).select("x.*")
    wanted = named.where("_n > 1").select("_s", "_h").unionByName(paired).distinct()
    sizes = named.join(wanted, ["_s", "_h"], "left_semi").select("_s", "_h", F.ceil(F.col("_n") / BLOCK).cast("int").alias("_m"))
    members = written(of.join(sizes, ["_s", "_h"]).withColumn("_i", F.pmod(F.xxhash64("_k"), F.col("_m")).cast("int")), "members")

    def blocks(first: str, last: str, **names: str) -> DataFrame:
        return members.withColumn("_o", F.explode(F.expr(f"sequence({first}, {last})"))).select("_s", "_h", *[F.col(c).alias(n) for n, c in names.items()])

    alike = blocks("_i", "_m - 1", _x="_i", _y="_o", _ka="_k").join(blocks("0", "_i", _x="_o", _y="_i", _kb="_k"), ["_s", "_h", "_x", "_y"]).where("_x < _y or _ka < _kb")
    ends = [members.select(F.col("_s").alias(f"_s{x}"), F.col("_h").alias(f"_h{x}"), F.col("_i").alias(f"_i{x}"), F.col("_k").alias(f"_k{x}")) for x in "ab"]
    counts = [sizes.select(F.col("_s").alias(f"_s{x}"), F.col("_h").alias(f"_h{x}"), F.col("_m").alias(f"_m{x}")) for x in "ab"]
    met = pairs.select("_sa", "_ha", "_sb", "_hb").join(counts[0], ["_sa", "_ha"]).join(counts[1], ["_sb", "_hb"])
    met = met.withColumn("_ia", F.explode(F.expr("sequence(0, _ma - 1)"))).withColumn("_ib", F.explode(F.expr("sequence(0, _mb - 1)")))
    across = met.join(ends[0], ["_sa", "_ha", "_ia"]).join(ends[1], ["_sb", "_hb", "_ib"]).where("_ka <> _kb")
    both = alike.select("_ka", "_kb").unionByName(across.select("_ka", "_kb"))
    return both.select(F.least("_ka", "_kb").alias("a"), F.greatest("_ka", "_kb").alias("b")).distinct()


def components(edges: DataFrame, a: str = "_a", b: str = "_b") -> DataFrame:
    """(``_v``, ``_root``): connected components of the ends of edges, by alternating large and small stars.

    Each round is two shuffles of the edges, written; the number of rounds grows with the logarithm of the components' size, and rounds go on
    until one changes nothing. No component is gathered in one place: the least neighbour of a vertex is a combinable minimum, joined back.
    """
    e = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    while True:
        sym = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = sym.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        star = large.join(least, "u")
        nxt = star.select(F.greatest("v", "m").alias("u"), F.col("m").alias("v")).unionByName(star.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        nxt = written(nxt, "edges")
        if nxt.exceptAll(e).isEmpty() and e.exceptAll(nxt).isEmpty():
            break
        e = nxt
    roots = e.groupBy("u").agg(F.min("v").alias("_root")).select(F.col("u").alias("_v"), "_root")
    return roots.unionByName(roots.select(F.col("_root").alias("_v"), "_root")).distinct()


def groups(df: DataFrame, key: str, columns: Sequence[str], *, threshold: float = THRESHOLD) -> DataFrame:
    """(key, ``group``, ``links``): the group of each record with words, its least key, and the number of classes similar to its own.

    Copies have one class and are not expanded into pairs.
    """
    of, named, pairs = similar_classes(df, key, columns, threshold=threshold)
    links = pairs.select(F.explode(F.array("_a", "_b")).alias("_c")).groupBy("_c").agg(F.count("*").alias("links"))
    roots = components(pairs).withColumnRenamed("_v", "_c")
    of_class = named.select("_s", "_h", "_c").join(roots, "_c", "left").join(links, "_c", "left")
    return of.join(of_class, ["_s", "_h"]).select(F.col("_k").alias(key), F.coalesce("_root", "_c").alias("group"), F.coalesce("links", F.lit(0)).alias("links"))
