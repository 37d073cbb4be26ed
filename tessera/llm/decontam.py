"""Benchmark decontamination: prefix-filtered set join of documents with the
word windows of benchmark items.

Method.  An item's windows are its runs of ``window`` words (a shorter item is
one window).  A window is a set of shingles of up to ``k`` words; it occurs in
a document only if all of them do, so at a containment of 1 its necessary
prefix is one shingle: its rarest.  Rarity is counted over all documents, in a
pass of its own.  The join looks up each document shingle among the prefix
shingles; a match at offset o fixes the only place where the window can start
(positional bound) and end (length bound); the window's words are then
compared one by one.

Scale.  Items are a query set taken in blocks: a block has a bounded number of
windows (``block_windows``), is collected and broadcast, and the documents pass
by it in their own partitions, with no shuffle of texts and no row per match.
Most benchmarks are one block; more blocks are chained, and after every second
one the rows are written, so memory stays that of two blocks.

Nulls, empty texts: a null text has no words; an item without words has no
windows.  A null item id counts as the id "null"; rows that share an item id
count as one item.  Documents come out row by row, repeated rows too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbatch as tb
from .scratch import arrow_map, row_and_text, text_of, written

_U = np.uint64
CHUNK = 4096
_FOUND = "n_words long, begins array<long>, ends array<long>, items array<string>"


def _item_chunks(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items as runs of at most ``CHUNK`` windows: id, window length, words."""
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for run in tb.runs(batch.column(1), tb.ALNUM):
            rows = []
            for i in range(run.rows):
                w = run.word[run.first[i]:run.first[i + 1]]
                size = min(window, len(w))
                for at in range(0, len(w) - size + 1 if size else 0, CHUNK):
                    rows.append((ids[run.row0 + i], size, w[at:at + CHUNK + size - 1].view(np.int64)))
            cols = list(zip(*rows)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()),
                                              pa.array(cols[2], pa.list_(pa.int64()))], ["item", "size", "words"])


@dataclass
class Windows:
    """The distinct windows of a block: their words (zero-filled), lengths,
    shingles by offset (``valid`` marks those there are) and items."""

    words: np.ndarray
    size: np.ndarray
    shingle: np.ndarray
    valid: np.ndarray
    items: list[list[str]]
    k: int

    @staticmethod
    def of(rows, window: int, k: int) -> "Windows":
        words, sizes, item = [np.zeros((0, window), _U)], [np.zeros(0, np.int64)], []
        for r in rows:
            w = np.array(r["words"], np.int64).view(_U)
            n = len(w) - r["size"] + 1
            block = np.zeros((n, window), _U)
            for j in range(r["size"]):
                block[:, j] = w[j:j + n]
            words.append(block)
            sizes.append(np.full(n, r["size"], np.int64))
            item += [r["items"]] * n
        every = np.column_stack([np.concatenate(words), np.concatenate(sizes).astype(_U)])
        table, back = np.unique(every, axis=0, return_inverse=True)
        items: list[set] = [set() for _ in table]
        for i, u in enumerate(back.ravel().tolist()):
            items[u].update(item[i])
        size, table = table[:, -1].astype(np.int64), np.ascontiguousarray(table[:, :-1])
        offsets = np.arange(window)
        valid = offsets[None, :] <= (size - np.minimum(size, k))[:, None]
        shingle = np.zeros((len(table), window), _U)
        for length in np.unique(size).tolist():
            at, kk = np.flatnonzero(size == length), min(length, k)
            for o in range(length - kk + 1):
                shingle[at, o] = tb.shingle_of([table[at, o + j] for j in range(kk)])
        return Windows(table, size, shingle, valid, [sorted(s) for s in items], k)


def _count(ks: list[int], lookup, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each shingle of the block occurs in these documents."""
    table = lookup.value
    seen = np.zeros(len(table.hashes), np.int64)
    for batch in batches:
        for run in tb.runs(batch.column(0), tb.ALNUM):
            for k in ks:
                _, i = table.find(tb.shingles(run.word, k))
                seen += np.bincount(i, minlength=len(seen))
    at = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["at", "seen"])


@dataclass
class PrefixIndex:
    """Windows by their rarest shingle and its offset."""

    windows: Windows
    lookup: tb.Lookup
    start: np.ndarray
    owner: np.ndarray
    offset: np.ndarray

    @staticmethod
    def of(w: Windows, table: tb.Lookup, seen: np.ndarray) -> "PrefixIndex":
        at = np.searchsorted(table.hashes, w.shingle)
        often = np.where(w.valid, seen[np.minimum(at, len(table.hashes) - 1)], np.iinfo(np.int64).max)
        offset = often.argmin(axis=1)
        token = w.shingle[np.arange(len(offset)), offset]
        order = np.argsort(token, kind="stable")
        prefixes = tb.Lookup(token)
        return PrefixIndex(w, prefixes, np.searchsorted(token[order], prefixes.hashes), order, offset[order])

    def occurrences(self, run: tb.Run) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row in the run, first word, window) of every occurrence."""
        w, out = self.windows, [[np.zeros(0, np.int64)] * 3]
        stop = np.r_[self.start[1:], len(self.owner)]
        for k in np.unique(np.minimum(w.size, w.k)).tolist():
            found, token = self.lookup.find(tb.shingles(run.word, k))
            while len(found):  # in slices, for shingles with many windows
                many = (stop - self.start)[token]
                cut = max(1, int(np.searchsorted(np.cumsum(many), 1_000_000)))
                pos = np.repeat(found[:cut], many[:cut])
                nth = np.arange(len(pos)) - np.repeat(np.cumsum(many[:cut]) - many[:cut], many[:cut])
                slot = np.repeat(self.start[token[:cut]], many[:cut]) + nth
                win, begin = self.owner[slot], pos - self.offset[slot]
                row = np.searchsorted(run.first, pos, side="right") - 1
                ok = (np.minimum(w.size[win], w.k) == k) & (begin >= run.first[row]) & (begin + w.size[win] <= run.first[row + 1])
                row, begin, win = row[ok], begin[ok], win[ok]
                for j in range(w.words.shape[1]):
                    same = (j >= w.size[win]) | (run.word[np.minimum(begin + j, len(run.word) - 1)] == w.words[win, j])
                    row, begin, win = row[same], begin[same], win[same]
                out.append([row, begin, win])
                found, token = found[cut:], token[cut:]
        return tuple(np.concatenate(c) for c in zip(*out))


def _merge(begins: list[int], ends: list[int]) -> tuple[list[int], list[int]]:
    out: list[list[int]] = []
    for b, e in sorted(zip(begins, ends)):
        if out and b <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([b, e])
    return [x[0] for x in out], [x[1] for x in out]


def _match(index, field: str | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ix: PrefixIndex = index.value
    names = ["n_words", "begins", "ends", "items"]
    for batch in batches:
        n_words = np.zeros(len(batch), np.int64)
        begins, ends, items = (batch.column(c).to_pylist() for c in names[1:])
        for run in tb.runs(text_of(batch, field), tb.ALNUM):
            n_words[run.row0:run.row0 + run.rows] = np.diff(run.first)
            row, begin, win = ix.occurrences(run)
            order = np.argsort(row, kind="stable")
            rows, first = np.unique(row[order], return_index=True)
            for r, at in zip(rows.tolist(), np.split(order, first[1:])):
                b = np.unique(np.column_stack([begin[at] - run.first[r], ix.windows.size[win[at]]]), axis=0)
                i = run.row0 + r
                begins[i], ends[i] = _merge(begins[i] + b[:, 0].tolist(), ends[i] + (b[:, 0] + b[:, 1]).tolist())
                items[i] = sorted({*items[i], *(x for u in np.unique(win[at]).tolist() for x in ix.windows.items[u])})
        new = dict(zip(names, [pa.array(n_words), pa.array(begins, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64())),
                               pa.array(items, pa.list_(pa.string()))]))
        yield pa.RecordBatch.from_arrays([new.get(c, batch.column(c)) for c in batch.schema.names], batch.schema.names)


def benchmark_hits(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                   item_text: str = "text", carry: list[str] | None = None, window: int = 13, k: int = 5,
                   block_windows: int = 500_000) -> DataFrame:
    """``row`` (struct of the ``carry`` columns; all, if not given), ``n_words``,
    ``begins`` and ``ends`` (merged word ranges inside occurrences of windows)
    and ``items`` (sorted distinct ids, as text, of the items that occur)."""
    spark = docs.sparkSession
    chunks = written(arrow_map(items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"),
                                            F.col(item_text).cast("string").alias("text")),
                               partial(_item_chunks, window), "item string, size int, words array<long>")
                     .groupBy("size", "words").agg(F.collect_set("item").alias("items")), "dec-items")  # items that repeat count once
    total = chunks.agg(F.sum(F.size("words") - F.col("size") + 1)).first()[0] or 0
    blocks = -(-total // block_windows)
    none = F.array().cast("array<long>")
    columns, field = row_and_text(docs, text_col, carry)
    out = docs.select(*columns, F.lit(0).cast("long").alias("n_words"), none.alias("begins"), none.alias("ends"), F.array().cast("array<string>").alias("items"))
    for b in range(max(1, blocks)):
        own = chunks.where(F.pmod(F.xxhash64("words"), F.lit(max(1, blocks))) == b).collect()  # bounded: about block_windows
        windows = Windows.of(own, window, k)
        table = tb.Lookup(windows.shingle[windows.valid])
        seen = np.zeros(max(1, len(table.hashes)), np.int64)
        if len(table.hashes):
            ks = np.unique(np.minimum(windows.size, k)).tolist()
            counted = arrow_map(docs.select(F.col(text_col).cast("string").alias("text")),
                                partial(_count, ks, spark.sparkContext.broadcast(table)), "at long, seen long")
            for r in counted.groupBy("at").agg(F.sum("seen").alias("seen")).toLocalIterator():
                seen[r["at"]] = r["seen"]
        index = spark.sparkContext.broadcast(PrefixIndex.of(windows, table, seen))
        out = arrow_map(out, partial(_match, index, field), out.schema)
        if b % 2 and b < blocks - 1:
            out = written(out, "dec-rows")
    return out.drop("text")


def contamination(docs: DataFrame, items: DataFrame, carry: list[str] | None = None, **options) -> DataFrame:
    """``row``, n_words, n_hit, n_items, items_sha256 and contaminated: at
    least one word in twenty lies in occurrences of benchmark windows."""
    hits = benchmark_hits(docs, items, carry=carry, **options)
    n_hit = F.aggregate(F.arrays_zip("begins", "ends"), F.lit(0).cast("long"), lambda acc, x: acc + x["ends"] - x["begins"])
    return (hits.withColumn("n_hit", n_hit)
            .select("row", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                    ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated")))
