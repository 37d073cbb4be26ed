"""Nearest neighbours by a block matrix join with int8 product tiles.

Method.  Every vector is scaled to length one and quantised to int8 with its own
step; the length of the rounding error is kept.  Queries are taken in blocks and
sent to the candidates, which stay where they are.  A task multiplies a block of
queries with tiles of its candidates in int8 (as exact small integers in single
precision).  The product gives the cosine up to

    |q . c - qq . cc| <= |q - qq| * |cc| + |q| * |c - cc|

so a pair whose upper bound lies under the query's k-th greatest lower bound so
far cannot be among its k nearest.  The pairs that are left are computed again in
double precision from the original vectors and kept in a list of k for each
query; the lists of all tasks are merged at the end, k rows of each by query.

The result is exact: the bounds only rule out pairs.  A block of queries has a
fixed size (``block`` vectors), whatever the number of queries; more blocks mean
more passes by the candidates, never more memory.

Nulls and the like: vectors that are null, empty or all zero, that hold nulls or
non-finite numbers, or whose id is null, take no part.  Vectors of another
dimension than the query are not candidates for it.  A query is no candidate of
its own: rows with the query's id are left out.  Rows that repeat an id with
other vectors are candidates each, and one pair of ids counts once, at its best
score; ties go to the smaller id.  Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import arrow_map, written

TILE = 2048
_PAIRS = "query_id long, vec_id long, score double"


class Block:
    """Vectors of one dimension: as given, their norms, int8 forms and errors."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])  # by powers of two, so that no square overflows
        self.ids, self.x = ids, x
        self.norm = np.sqrt(np.einsum("ij,ij->i", x, x))
        unit = x / self.norm[:, None]
        step = np.abs(unit).max(axis=1) / 127
        q = np.rint(unit / step[:, None]).astype(np.int8)
        back = q * step[:, None]
        self.q, self.step = q.astype(np.float32), step
        self.err = np.sqrt(((unit - back) ** 2).sum(axis=1)) + 1e-9
        self.size = np.sqrt((back ** 2).sum(axis=1))


def nearest(queries: Block, cands: Block, best: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """``best`` (scores and ids, k for each query) with the candidates merged in."""
    scores, ids = best
    exact = 1 << 24  # sums of int8 products up to here are exact in single precision
    ok = queries.q.shape[1] * 127 * 127 < exact
    a, b = (queries.q, cands.q) if ok else (queries.q.astype(np.float64), cands.q.astype(np.float64))
    about = (a @ b.T).astype(np.float64) * queries.step[:, None] * cands.step[None, :]
    slack = queries.err[:, None] * cands.size[None, :] + cands.err[None, :]
    own = queries.ids[:, None] == cands.ids[None, :]
    about[own] = -np.inf
    low = about - slack
    floor = scores[:, -1]
    own_id, nth_id = np.unique(cands.ids, return_inverse=True)
    if len(own_id) < len(cands.ids):  # one bound for each id, its best, as results count an id once
        order = np.argsort(nth_id, kind="stable")
        low = np.maximum.reduceat(low[:, order], np.searchsorted(nth_id[order], np.arange(len(own_id))), axis=1)
    if low.shape[1] >= k:
        floor = np.maximum(floor, -np.partition(-low, k - 1, axis=1)[:, k - 1])
    row, col = np.nonzero((about + slack >= floor[:, None]) & ~own)
    for lo in range(0, len(row), 1 << 16):
        r, c = row[lo:lo + (1 << 16)], col[lo:lo + (1 << 16)]
        s = np.einsum("ij,ij->i", queries.x[r], cands.x[c]) / (queries.norm[r] * cands.norm[c])
        keep = s >= scores[r, -1]
        r, s, i = r[keep], s[keep], cands.ids[c[keep]]
        if not len(r):
            continue
        touched, back = np.unique(r, return_inverse=True)
        allr = np.r_[np.repeat(np.arange(len(touched)), k), back]
        alls, alli = np.r_[scores[touched].ravel(), s], np.r_[ids[touched].ravel(), i]
        order = np.lexsort((alli, -alls, allr))
        allr, alls, alli = allr[order], alls[order], alli[order]
        seen = np.zeros(len(allr), bool)  # one entry for each id, its best
        twice = np.lexsort((np.arange(len(allr)), alli, allr))
        seen[twice[1:]] = (alli[twice][1:] == alli[twice][:-1]) & (allr[twice][1:] == allr[twice][:-1]) & np.isfinite(alls[twice][1:])
        allr, alls, alli = allr[~seen], alls[~seen], alli[~seen]
        nth = np.arange(len(allr)) - np.searchsorted(allr, allr)
        top = nth < k
        scores[touched[allr[top]], nth[top]], ids[touched[allr[top]], nth[top]] = alls[top], alli[top]
    return scores, ids


def _matrix(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, vectors) by dimension, of the rows that can take part."""
    col = batch.column("vec")
    data = np.asarray(col.flatten().to_numpy(zero_copy_only=False), np.float64)
    size = np.diff(col.offsets.to_numpy())
    first = np.cumsum(size) - size
    for d in np.unique(size).tolist():
        at = np.flatnonzero(size == d)
        if d:
            x = data[first[at][:, None] + np.arange(d)]
            yield at, x


def _search(k: int, blocks, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    queries: dict[int, Block] = blocks.value
    best = {d: (np.full((len(b.ids), k), -np.inf), np.zeros((len(b.ids), k), np.int64)) for d, b in queries.items()}
    for batch in batches:
        ids = batch.column("vec_id").to_numpy()
        for at, x in _matrix(batch):
            if x.shape[1] not in queries:
                continue
            q = queries[x.shape[1]]
            for lo in range(0, len(at), TILE):
                cands = Block(ids[at[lo:lo + TILE]], x[lo:lo + TILE])
                for q0 in range(0, len(q.ids), TILE):
                    part = Block.__new__(Block)
                    part.__dict__ = {name: v[q0:q0 + TILE] for name, v in q.__dict__.items()}
                    scores, found = best[x.shape[1]]
                    nearest(part, cands, (scores[q0:q0 + TILE], found[q0:q0 + TILE]), k)
    for d, b in queries.items():
        scores, found = best[d]
        r, c = np.nonzero(np.isfinite(scores))
        yield pa.RecordBatch.from_arrays([pa.array(b.ids[r]), pa.array(found[r, c]), pa.array(scores[r, c])],
                                         ["query_id", "vec_id", "score"])


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
                       vec_col: str = "embedding", block: int = 16384) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of ``vectors`` of largest
    cosine with each row for which ``is_query`` holds."""
    spark = vectors.sparkSession
    v = F.col(vec_col).cast("array<double>")
    fit = (vectors.where(F.col(id_col).isNotNull())
           .select(F.col(id_col).cast("long").alias("vec_id"), v.alias("vec"), F.coalesce(is_query, F.lit(False)).alias("q"))
           .where(F.col("vec").isNotNull() & F.exists("vec", lambda x: x != 0)
                  & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))))
    queries = written(fit.where("q").select("vec_id", "vec"), "ann-queries")
    total = queries.count()
    blocks = -(-total // block)
    parts = []
    for n in range(blocks):
        own = queries.where(F.pmod(F.xxhash64("vec_id", "vec"), F.lit(blocks)) == n).toArrow()  # about ``block`` rows
        index = {}
        for batch in own.combine_chunks().to_batches():
            for at, x in _matrix(batch):
                index[x.shape[1]] = Block(batch.column("vec_id").to_numpy()[at], x)
        found = arrow_map(fit.select("vec_id", "vec"), partial(_search, k, spark.sparkContext.broadcast(index)), _PAIRS)
        parts.append(written(found, "ann-pairs") if blocks > 1 else found)
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    pairs = reduce(DataFrame.union, parts)
    one = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return (best.withColumn("rank", F.row_number().over(one)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
