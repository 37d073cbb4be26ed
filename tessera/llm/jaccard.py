"""N-gram Jaccard join: documents whose word-shingle sets are near-equal.

Method.  A text becomes the sorted array of its distinct shingle hashes.
Equal sets collapse to one *set*, known by a 64-bit digest of the array.

1. One pass over the texts gives for each set its size, digest, a few
   min-hash keys, a hashed bitmap signature (its width follows the size) and
   counts of hashed shingles, from which the frequent ones become known.
2. Sets that share a min-hash key are checked against the key's smallest set,
   one pair for each set, then one for each two components that still meet.
   This joins most large groups of copies with as many pairs as sets; it only
   spares work, it decides nothing.
3. A second pass emits the prefix of each set in order (frequent last, then by
   hash): two sets that link must share a prefix shingle.  Shingles of one set
   only are dropped.  A shingle of a few sets gives their pairs, each pair once for a task;
   sizes, rests (see 4) and signatures, joined to a pair once, rule most of them out.
   Shingles whose sets are all one component already are dropped.
4. What is left is dealt into tiles, one a shingle (more where it has many sets, cut
   into blocks), sorted by size.  A set is compared with those of its size band, up
   to 1/threshold of its size.  A pair need come out only at its first common
   shingle, where its overlap is at most what either set has from there on; so a row
   carries that rest, and a pair whose rests are too small for a link is left to an
   earlier tile, or cannot link.  Bit counts of the signatures bound the overlap too;
   only pairs of different components that may still link come out.
5. Such pairs are verified by exact intersection of the sorted arrays, and
   the links give the components.  Steps 4 and 5 run twice, over tiles and listed pairs: first with the
   likeliest partner of each set, so with as many pairs as sets at most, then, among
   the components that this leaves apart, with all pairs.

No pair is lost: prefix, size, rest and bitmap tests are necessary conditions, and
pairs that are not looked at are joined already.  Two different texts count as
equal only if 64-bit hashes collide.

Nulls, empty texts: a null text, or one without words, has an empty set, is
linked with nothing and is its own component.  Ids: one row comes out for each
row that went in; rows that share an id stay separate rows; a null id is kept
and is never the smallest.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textbatch as tb
from .graph import components
from .scratch import IdFilter, arrow_map, written

_U = np.uint64
BANDS, ROWS = 6, 2
SKETCH_BITS = 20
TILE = 4096
_TILE = ("token", "bi", "bj")
#: A shingle of at most so many sets gives pairs, one of more is a tile.
LISTED = 8
_SHARED = ["token", "set_id", "rest", "other"]
PAIRS = 1 << 18
#: Odd multipliers of the min-hash permutations.
_PERM = tb.mix(np.arange(101, 101 + BANDS * ROWS, dtype=_U)) | _U(1)

_PROFILE = "id long, n int, set_id long, keys array<long>, sig binary, slot int, seen long"


def set_digest(u: np.ndarray) -> int:
    """64-bit digest of a sorted array of distinct hashes."""
    with np.errstate(over="ignore"):
        x = np.bitwise_xor.reduce(tb.mix(u + _U(0x51ED270B))) + np.add.reduce(u) * _U(0x2545F4914F6CDD1D)
        return int(tb.mix(np.array([x + _U(len(u))], _U)).view(np.int64)[0])


def signature(u: np.ndarray) -> np.ndarray:
    """Hashed bitmap of a set: a power of two of bits, twice the size or more,
    from 64 to 8192, as 64-bit words.  Halving ORs its two halves."""
    bits = min(8192, max(64, 1 << (2 * len(u) - 1).bit_length()))
    at = u & _U(bits - 1)
    out = np.zeros(bits // 64, _U)
    np.bitwise_or.at(out, (at >> _U(6)).astype(np.int64), _U(1) << (at & _U(63)))
    return out


def min_keys(u: np.ndarray) -> list[int]:
    with np.errstate(over="ignore"):
        mins = (u[None, :] * _PERM[:, None]).min(axis=1).reshape(BANDS, ROWS)
        folded = tb.mix(mins[:, 0] * _U(31) + mins[:, 1] + np.arange(BANDS, dtype=_U))
    return folded.view(np.int64).tolist()


def _profile(k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each text, and rows (slot, seen) of shingles frequent here."""
    sketch, total = np.zeros(1 << SKETCH_BITS, np.int64), 0
    names = ["id", "n", "set_id", "keys", "sig", "slot", "seen"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.int32(), pa.int64()]
    make = lambda cols: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for run in tb.runs(batch.column(1), tb.SPACED):
            rows, parts = [], []
            for i, u in tb.shingle_sets(run, k):
                if len(u):
                    parts.append(u)
                    rows.append((ids[i], len(u), set_digest(u), min_keys(u), signature(u).tobytes()))
                else:
                    rows.append((ids[i], 0, None, None, None))
            if parts:
                u = np.concatenate(parts)
                sketch += np.bincount((u >> _U(64 - SKETCH_BITS)).astype(np.int64), minlength=1 << SKETCH_BITS)
                total += len(u)
            cols = list(zip(*rows))
            yield make([*cols, [None] * len(rows), [None] * len(rows)])
    often = np.flatnonzero(sketch >= 8 + 4 * total / (1 << SKETCH_BITS))
    none = [None] * len(often)
    yield make([none, none, none, none, none, often, sketch[often]])


def _prefixes(k: int, percent: int, heavy, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, set_id, rest) of each set's prefix: ``rest`` is how many shingles the set
    has from the token on in its order.  ``heavy`` has the counts of frequent
    shingles by hash slot; those are last in every set's order."""
    rank, done = heavy.value, set()
    for batch in batches:
        for run in tb.runs(batch.column(0), tb.SPACED):
            tokens, sets, rests = [], [], []
            for _, u in tb.shingle_sets(run, k):
                n = len(u)
                if not n or (key := set_digest(u)) in done:
                    continue
                if len(done) < 200_000:  # spares rows of copies; the rest are merged after the shuffle
                    done.add(key)
                take = n - -(-percent * n // 100) + 1
                w = rank[(u >> _U(64 - SKETCH_BITS)).astype(np.int64)]
                light = u[w == 0]  # sorted by hash already
                if len(light) < take:
                    light = u[np.lexsort((u, w))]
                tokens.append(light[:take])
                sets.append(key)
                rests.append(np.arange(n, n - take, -1, dtype=np.int32))
            if tokens:
                reps = [len(t) for t in tokens]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.repeat(np.array(sets, np.int64), reps)),
                     pa.array(np.concatenate(rests))], ["token", "set_id", "rest"])


def _listed(percent: int, t: np.ndarray, s: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """(a, b, rest) for two sets of one token (rows sorted by token and set, at most ``LISTED``
    a token), ``rest`` the smaller one, if neither rest is too small beside the other."""
    out = []
    for d in range(1, LISTED):
        i = np.flatnonzero(t[d:] == t[:-d])
        if not len(i):
            break
        low, high = np.minimum(n[i], n[i + d]), np.maximum(n[i], n[i + d])
        ok = 100 * low.astype(np.int64) >= percent * high.astype(np.int64)
        out.append((s[i][ok], s[i + d][ok], low[ok]))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (s[:0], s[:0], n[:0])


def _once(a: np.ndarray, b: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each pair once, with its largest rest."""
    order = np.lexsort((rest, b, a))
    a, b, rest = a[order], b[order], rest[order]
    last = np.r_[(a[1:] != a[:-1]) | (b[1:] != b[:-1]), True][:len(a)]
    return a[last], b[last], rest[last]


def _shared(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (token, set_id), each (token, set_id) once: a token of two to
    ``LISTED`` sets gives pairs (set_id, other, rest), a token of more its rows."""
    held = None  # rows of the last token seen; only its last row, given out already, if ``large``
    large = False
    pairs, size = [], 0

    def rows(t, s, n):
        return pa.RecordBatch.from_arrays([pa.array(t), pa.array(s), pa.array(n, pa.int32()), pa.nulls(len(t), pa.int64())], _SHARED)

    def flush():
        a, b, n = _once(*(np.concatenate(c) for c in zip(*pairs)))
        return pa.RecordBatch.from_arrays([pa.nulls(len(a), pa.int64()), pa.array(a), pa.array(n, pa.int32()), pa.array(b)], _SHARED)

    for batch in batches:
        t, s, n = (batch.column(i).to_numpy() for i in range(3))
        if not len(t):
            continue
        if held is not None:
            t, s, n = (np.r_[x, y] for x, y in zip(held, (t, s, n.astype(np.int32))))
        new = np.r_[True, (t[1:] != t[:-1]) | (s[1:] != s[:-1])]
        t, s, n = t[new], s[new], n[new]
        start = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
        many = np.diff(np.r_[start, len(t)])
        of = many > LISTED
        of[0] |= large
        out = np.repeat(of, many)
        whole = np.repeat(~of, many)
        whole[start[-1]:] = False
        if large:
            out[0] = False
        large = bool(of[-1])
        yield rows(t[out], s[out], n[out])
        pairs.append(_listed(percent, t[whole], s[whole], n[whole]))
        size += len(pairs[-1][0])
        cut = len(t) - 1 if large else start[-1]
        held = t[cut:], s[cut:], n[cut:]
        if size > 1 << 20:
            yield flush()
            pairs, size = [], 0
    if held is not None and not large:
        pairs.append(_listed(percent, *held))
    if pairs:
        yield flush()


def _folded(a: np.ndarray, words: int) -> np.ndarray:
    """Signatures (rows) brought to a width of ``words`` by ORing halves."""
    while a.shape[1] > words:
        a = a[:, :a.shape[1] // 2] | a[:, a.shape[1] // 2:]
    return a


def slack(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    """For rows of signatures ``a`` and ``b`` (sets of sizes ``na``, ``nb``): at
    least 0 if the two sets may link.  Bits that are set on one side only bound
    the overlap from above."""
    words = min(a.shape[1], b.shape[1])
    a, b = _folded(a, words), _folded(b, words)
    both = np.bitwise_count(a & b).sum(axis=1, dtype=np.int64)
    only_a = np.bitwise_count(a).sum(axis=1, dtype=np.int64) - both
    only_b = np.bitwise_count(b).sum(axis=1, dtype=np.int64) - both
    return (100 + percent) * np.minimum(na - only_a, nb - only_b) - percent * (na + nb)


class _Rows:
    """Rows of whole tiles, sorted by tile and size."""

    def __init__(self, parts: list[pa.RecordBatch]):
        table = pa.Table.from_batches(parts).combine_chunks()
        get = lambda c: table[c].combine_chunks().to_numpy(zero_copy_only=False)
        keys = [get(c) for c in _TILE]
        self.ids, self.n, self.rest, self.comp, self.block = (get(c) for c in ("set_id", "n", "rest", "comp", "block"))
        self.n, self.rest, self.across = self.n.astype(np.int64), self.rest.astype(np.int64), keys[1] != keys[2]
        change = np.zeros(max(len(self.ids) - 1, 0), bool)
        for k in keys:
            change |= k[1:] != k[:-1]
        self.tile = np.r_[0, np.cumsum(change)]
        sig = table["sig"].combine_chunks().cast(pa.large_binary())
        off = np.frombuffer(sig.buffers()[1], np.int64)[sig.offset:sig.offset + len(sig) + 1]
        data = np.frombuffer(sig.buffers()[2], np.uint8)
        self.words, self.at, self.sig = np.diff(off) // 8, np.zeros(len(sig), np.int64), {}
        for w in np.unique(self.words).tolist():
            rows = np.flatnonzero(self.words == w)
            self.at[rows] = np.arange(len(rows))
            self.sig[w] = data[off[rows][:, None] + np.arange(8 * w)].view(_U)

    def followers(self, percent: int) -> np.ndarray:
        """How many of the next rows are in a row's size band: at most 1 / threshold of its size."""
        key = (self.tile << 32) + self.n
        return np.searchsorted(key, (self.tile << 32) + 100 * self.n // percent, side="right") - np.arange(len(key)) - 1

    def slack(self, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
        out = np.empty(len(i), np.int64)
        kind = self.words[i] * 256 + self.words[j]
        for k in np.unique(kind).tolist():
            own = np.flatnonzero(kind == k)
            step = max(1, (1 << 20) // max(k // 256, k % 256))  # about 8 MB of signatures at once
            for lo in range(0, len(own), step):
                p = own[lo:lo + step]
                out[p] = slack(self.sig[k // 256][self.at[i[p]]], self.n[i[p]], self.sig[k % 256][self.at[j[p]]], self.n[j[p]], percent)
        return out


def _tile_pairs(percent: int, rows: _Rows, out: dict, best_only: bool) -> None:
    """Candidate pairs of some tiles: rows with the next rows of their size band,
    of other blocks where a tile has two.  ``best_only``: the likeliest partner of each set."""
    here = np.arange(len(rows.ids))
    many = rows.followers(percent)
    upto = np.cumsum(many)
    lo = 0
    while lo < len(here):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + PAIRS, side="right")))
        i = np.repeat(here[lo:hi], many[lo:hi])
        j = i + 1 + np.arange(len(i)) - np.repeat(upto[lo:hi] - many[lo:hi] - (upto[lo - 1] if lo else 0), many[lo:hi])
        lo = hi
        ok = (rows.comp[i] != rows.comp[j]) & (~rows.across[i] | (rows.block[i] != rows.block[j]))
        ok &= (100 + percent) * np.minimum(rows.rest[i], rows.rest[j]) >= percent * (rows.n[i] + rows.n[j])
        i, j = i[ok], j[ok]
        a, b = np.minimum(rows.ids[i], rows.ids[j]), np.maximum(rows.ids[i], rows.ids[j])
        order = np.lexsort((b, a))  # a pair meets in many tiles
        once = np.r_[True, (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])][:len(order)]
        i, j, a, b = (x[order[once]] for x in (i, j, a, b))
        spare = rows.slack(i, j, percent)
        near = spare >= 0
        i, j, a, b, likely = i[near], j[near], a[near], b[near], spare[near] / (rows.n[i[near]] + rows.n[j[near]])
        if not best_only:
            out.update(dict.fromkeys(zip(a.tolist(), b.tolist()), 0.0))
            continue
        own, other, likely = np.r_[rows.ids[i], rows.ids[j]], np.r_[rows.ids[j], rows.ids[i]], np.r_[likely, likely]
        order = np.lexsort((other, likely, own))
        last = order[np.r_[own[order][1:] != own[order][:-1], True]] if len(own) else order
        for x, y, z in zip(own[last].tolist(), other[last].tolist(), likely[last].tolist()):
            if x not in out or z > out[x][1]:
                out[x] = (y, z)


def _tiles(percent: int, best_only: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs (set, partner) from rows sorted by tile and size, some whole
    tiles at a time (one tile has at most two blocks).  ``best_only``: one row for each
    set here, with its likeliest partner of another component."""
    out: dict = {}
    held: list[pa.RecordBatch] = []

    def flush():
        cols = [list(out), *zip(*out.values())] if best_only and out else [*zip(*out), list(out.values())] if out else [[], [], []]
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64()))], ["a", "b", "likely"])

    for batch in batches:
        if not len(batch):
            continue
        keys = [batch.column(c).to_numpy() for c in _TILE]
        change = np.zeros(len(batch) - 1, bool)
        for k in keys:
            change |= k[1:] != k[:-1]
        if held and any(held[-1].column(c)[-1].as_py() != batch.column(c)[0].as_py() for c in _TILE):
            _tile_pairs(percent, _Rows(held), out, best_only)
            held = []
        cuts = np.flatnonzero(change)
        if len(cuts):
            _tile_pairs(percent, _Rows([*held, batch.slice(0, int(cuts[-1]) + 1)]), out, best_only)
            held = []
            batch = batch.slice(int(cuts[-1]) + 1)
        held.append(batch)
        if len(out) > 200_000:
            yield flush()
    if held:
        _tile_pairs(percent, _Rows(held), out, best_only)
    yield flush()


def _possible(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs with sizes and signatures those that may link, and how likely."""
    for batch in batches:
        cols = {c: batch.column(c).to_pylist() for c in ("na", "sa", "nb", "sb")}
        keep, likely = [], []
        for i, (m, x, n, y) in enumerate(zip(cols["na"], cols["sa"], cols["nb"], cols["sb"])):
            if 100 * min(m, n) >= percent * max(m, n):
                spare = slack(np.frombuffer(x, _U)[None], np.array([m]), np.frombuffer(y, _U)[None], np.array([n]), percent)[0]
                if spare >= 0:
                    keep.append(i)
                    likely.append(spare / (m + n))
        yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(keep, pa.int64())) for c in ("a", "b")), pa.array(likely, pa.float64())],
                                         ["a", "b", "likely"])


def _arrays(k: int, wanted, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(set_id, arr) of the wanted texts, each set once for a task if it can."""
    done: set = set()
    for batch in batches:
        hit = np.flatnonzero(wanted.value.test(batch.column(1).to_numpy().view(_U)))
        if not len(hit):
            continue
        for run in tb.runs(batch.column(0).take(pa.array(hit)), tb.SPACED):
            keys, arrs = [], []
            for _, u in tb.shingle_sets(run, k):
                if len(u) and (key := set_digest(u)) not in done:
                    if len(done) < 200_000:
                        done.add(key)
                    keys.append(key)
                    arrs.append(packed(u))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(arrs, pa.binary())], ["set_id", "arr"])


def packed(u: np.ndarray) -> bytes:
    """The upper six bytes of sorted hashes: only two sets at a time are compared by
    them, so that unlike shingles agree is still as good as impossible."""
    return (u >> _U(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8")[:, 0]


def _overlaps(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that link, by exact intersection, from rows (a, b, side, arr) sorted by pair and side."""
    pair, first = None, None
    for batch in batches:
        keep = []
        for a, b, side, arr in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "side", "arr"))):
            if (a, b) != pair:
                pair, first = (a, b), None
            if side == 0:
                first = unpacked(arr)
            elif first is not None:
                p, q, first = first, unpacked(arr), None  # a set may come twice: once is enough
                p, q = (p, q) if len(p) <= len(q) else (q, p)
                at = np.searchsorted(q, p)
                at[at == len(q)] = 0
                common = int((q[at] == p).sum())
                if 100 * common >= percent * (len(p) + len(q) - common):
                    keep.append(pair)
        yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in keep], pa.int64()) for i in (0, 1)], ["a", "b"])


def _may_link(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and signatures do not rule out, with their ``likely``."""
    known = sets.select("set_id", "n", "sig")
    signed = pairs.join(known.toDF("a", "na", "sa"), "a").join(known.toDF("b", "nb", "sb"), "b")
    return written(arrow_map(signed, partial(_possible, percent), "a long, b long, likely double"), "jac-possible")


def _verified(spark: SparkSession, texts: DataFrame, left: DataFrame, sets: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) of sets that link: the sorted arrays of both sides are sent to each pair."""
    ends = left.select(F.col("a").alias("set_id"), "a", "b", F.lit(0).alias("side")).union(left.select("b", "a", "b", F.lit(1)))
    needed = sets.join(ends.select("set_id").distinct(), "set_id").select(F.xxhash64("rep").alias("h"))
    wanted = spark.sparkContext.broadcast(IdFilter.of(needed, F.col("h")))
    arrays = arrow_map(texts.select("text", F.xxhash64("id").alias("h")), partial(_arrays, k, wanted), "set_id long, arr binary")
    sided = arrays.join(ends, "set_id").select("a", "b", "side", "arr").repartition("a", "b").sortWithinPartitions("a", "b", "side")
    links = written(arrow_map(sided, partial(_overlaps, percent), "a long, b long"), "jac-links")
    wanted.unpersist()
    return links


def _one_each(pairs: DataFrame, by: str) -> DataFrame:
    """Of pairs (a, b) with their components (ca, cb): the one of greatest ``by``
    for each two components."""
    return (pairs.groupBy(F.least("ca", "cb").alias("x"), F.greatest("ca", "cb").alias("y"))
            .agg(F.max_by(F.struct("a", "b"), F.struct(by, "a", "b")).alias("p")).select("p.a", "p.b"))


def _apart(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """Pairs of sets of different components, with those as ca and cb."""
    one = comps.select(F.col("node").alias("a"), F.col("label").alias("la"))
    two = comps.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    return (pairs.join(one, "a", "left").join(two, "b", "left")
            .withColumn("ca", F.coalesce("la", "a")).withColumn("cb", F.coalesce("lb", "b")).where("ca <> cb"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       k: int = 5, percent: int = 75) -> DataFrame:
    """(id_col, n_shingles, component_id) for each row of ``docs``: the number
    of distinct ``k``-word shingles, and the smallest id that links reach,
    where sets link at a Jaccard similarity of ``percent`` / 100 or more."""
    if not 50 <= percent <= 100:
        raise ValueError("percent must lie between 50 and 100")
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    profile = written(arrow_map(texts, partial(_profile, k), _PROFILE), "jac-profile")
    rows = profile.where("slot is null").select("id", "n", "set_id", "keys", "sig")
    sets = written(rows.where("n > 0").groupBy("set_id")
                   .agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("sig").alias("sig")),
                   "jac-sets")

    may_link = lambda pairs: _may_link(pairs, sets, percent)
    verified = lambda pairs: _verified(spark, texts, pairs, sets, k, percent)

    # Groups of copies: each set with the smallest set of the key that it shares most often, then components that meet.
    keyed = sets.select("set_id", F.explode("keys").alias("key"))
    hubs = keyed.groupBy("key").agg(F.min("set_id").alias("b"), F.max("set_id").alias("top")).where("b <> top").select("key", "b")
    met = written(keyed.join(hubs, "key").where("set_id <> b").groupBy(F.col("set_id").alias("a"), "b").count(), "jac-met")
    links = [verified(may_link(written(met.groupBy("a").agg(F.max_by("b", F.struct("count", "b")).alias("b")), "jac-copies")))]
    apart = _apart(met, components(links[0]))
    links.append(verified(may_link(written(_one_each(apart, "count"), "jac-copies"))))

    heavy = profile.where("slot is not null").groupBy("slot").agg(F.sum("seen").alias("seen")).toPandas()  # at most 2**SKETCH_BITS rows
    rank = np.zeros(1 << SKETCH_BITS, np.int64)
    rank[heavy["slot"].to_numpy(np.int64)] = heavy["seen"].to_numpy(np.int64)
    rank = spark.sparkContext.broadcast(np.minimum(rank, 2**31 - 1).astype(np.int32))
    schema = "token long, set_id long, rest int"
    prefixes = arrow_map(texts.select("text"), partial(_prefixes, k, percent, rank), schema)
    shared = arrow_map(prefixes.repartition("token").sortWithinPartitions("token", "set_id"), partial(_shared, percent), schema + ", other long")
    shared = written(shared, "jac-shared")
    listed = shared.where("other is not null").groupBy(F.col("set_id").alias("a"), F.col("other").alias("b")).agg(F.max("rest").alias("rest"))
    shared = shared.where("other is null").drop("other")
    near = None
    for best_only in (True, False):
        comps = components(reduce(DataFrame.union, links))
        each = sets.select("set_id", "n").join(comps.withColumnRenamed("node", "set_id"), "set_id", "left").select("set_id", "n", F.coalesce("label", "set_id").alias("comp"))
        if near is None:  # the signatures of listed pairs are looked at once, for both rounds
            near = (listed.join(each.toDF("a", "na", "ca"), "a").join(each.toDF("b", "nb", "cb"), "b").where("ca <> cb")
                    .where((100 + percent) * F.col("rest").cast("long") >= percent * (F.col("na") + F.col("nb")))
                    .where(100 * F.least("na", "nb").cast("long") >= percent * F.greatest("na", "nb")))
            near = may_link(near.select("a", "b"))
        known = written(shared.join(each, "set_id"), "jac-known")
        mixed = (known.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count("*").alias("members"),
                                            F.min("n").alias("least"), F.max("rest").alias("most"))
                 .where("x <> y").select("token", F.ceil(F.col("members") / TILE).cast("int").alias("blocks"), "least", "most"))
        # rows whose rest may do for a link with the smallest set here that is not too small
        can = ((100 + percent) * F.least("rest", "most").cast("long")
               >= percent * (F.col("n") + F.greatest("least", F.ceil(F.col("n") * percent / 100))))
        placed = (known.join(mixed, "token").where(can).drop("least", "most").join(sets.select("set_id", "sig"), "set_id")
                  .withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
                  .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                  .withColumn("bi", F.least("block", "other")).withColumn("bj", F.greatest("block", "other")))
        dealt = placed.select(*_TILE, "set_id", "n", "rest", "comp", "block", "sig").repartition(*_TILE).sortWithinPartitions(*_TILE, "n")
        found = arrow_map(dealt, partial(_tiles, percent, best_only), "a long, b long, likely double")
        if best_only:
            found = found.union(near).union(near.select("b", "a", "likely")).groupBy("a").agg(F.max_by("b", F.struct("likely", "b")).alias("b"))
        else:
            found = found.select("a", "b").union(_apart(near, comps).select("a", "b"))
        pairs = written(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "jac-candidates")
        if not pairs.take(1):
            break
        links.append(verified(pairs))  # tiles and lists have looked at the signatures
    labels = components(reduce(DataFrame.union, links))

    member = (rows.join(labels.withColumnRenamed("node", "set_id"), "set_id", "left")
              .select("id", "n", F.coalesce("label", "set_id").alias("comp")))
    # written, so that the join deals out both sides for itself and Spark can split a huge component
    first = written(sets.join(labels.withColumnRenamed("node", "set_id"), "set_id", "left")
                    .groupBy(F.coalesce("label", "set_id").alias("comp")).agg(F.min("rep").alias("least")), "jac-least")
    return (member.join(first, "comp", "left")
            .select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"),
                    F.coalesce("least", "id").alias("component_id")))
