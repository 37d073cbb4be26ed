"""Toxicity by a factorization machine over hashed terms.

Method.  A text's terms are the 64-bit hashes of its distinct words and of the
first 4 and 5 bytes of longer words (stems, for inflected insults).  The
machine scores the selected terms that are present:

    bias + sum of w[i] + sum over pairs i < j of <v[i], v[j]>

so it learns single insults as well as pairs, such as an insult with a mention
of a group, that are harmless apart.  The score is the logistic of that sum.

Terms are selected on the sample: those whose association with the label is
significant given how many terms are tested (log-likelihood ratio), and the most
frequent ones, which take part in pairs only.  Mini-batch gradient steps with L1
on w and L2 on v fit the machine.

The machine is fitted on a bounded sample: at most ``toxic`` texts of label 1 and
``other`` texts of label 0 (the smallest hashes of the id), whose terms are counted
by Spark; the driver receives the selected terms only.  Rows that repeat an id, or
have none, teach as one: the text of smallest hash.  Scoring reads every whole text
once.

Nulls and the like: a null or empty text has no terms and the score of the bias.
Null labels teach nothing; an id with several labels has their maximum.  With no
labels, or labels of one class only, the score is that class's share (0 with
none).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textbatch as tb
from .sampling import per_class
from .scratch import arrow_map, row_and_text, text_of, written

_U = np.uint64
STEMS = (4, 5)


def _terms(run: tb.Run, keep: tb.Lookup | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row in the run, term) of the distinct terms of each row, in order; with
    ``keep``, terms are indices of the kept ones."""
    row = np.repeat(np.arange(run.rows), np.diff(run.first))
    rows, terms = [], []
    for h in (run.word, *run.stem):
        at = np.flatnonzero(h)
        if keep is not None:
            at, idx = keep.find(h)
            terms.append(idx.astype(np.int64))
        else:
            terms.append(h[at].view(np.int64))
        rows.append(row[at])
    r, t = np.concatenate(rows), np.concatenate(terms)
    order = np.lexsort((t, r))
    r, t = r[order], t[order]
    new = np.r_[True, (r[1:] != r[:-1]) | (t[1:] != t[:-1])][:len(r)]
    return r[new], t[new]


def _sample_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, label, terms) with the distinct terms of each sampled text."""
    for batch in batches:
        labels = batch.column(1).to_numpy(zero_copy_only=False)
        for run in tb.runs(batch.column(0), tb.ALNUM, stems=STEMS):
            r, t = _terms(run)
            first = np.searchsorted(r, np.arange(run.rows + 1))
            terms = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(t, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(labels[run.row0:run.row0 + run.rows], pa.int32()), terms], ["label", "terms"])


@dataclass
class Machine:
    terms: tb.Lookup
    bias: float
    w: np.ndarray
    v: np.ndarray

    def scores(self, row: np.ndarray, term: np.ndarray, rows: int) -> np.ndarray:
        """Scores of ``rows`` texts whose selected terms are (row, term)."""
        total = np.full(rows, self.bias)
        if len(row):
            own, first = np.unique(row, return_index=True)
            v = self.v[term]
            s, q = np.add.reduceat(v, first, axis=0), np.add.reduceat(v * v, first, axis=0)
            total[own] += np.add.reduceat(self.w[term], first) + 0.5 * (s * s - q).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _soft(w: np.ndarray, by: float) -> np.ndarray:
    return np.sign(w) * np.maximum(np.abs(w) - by, 0)


def train(x: list[np.ndarray], y: np.ndarray, terms: np.ndarray, single: np.ndarray, factors: int = 8, steps: int = 1500,
          epochs: int = 20, rate: float = 6.0, l1: float = 3e-5, decay: float = 1e-3, batch: int = 256, seed: int = 3) -> Machine:
    """A machine for texts ``x`` (indices into the sorted ``terms``) and labels
    ``y``; only terms marked in ``single`` have a weight of their own."""
    rng, m = np.random.default_rng(seed), len(terms)
    w, v, bias = np.zeros(m), rng.normal(0, 0.02, (m, factors)), -3.0
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    per_epoch = -(-len(y) // batch)
    epochs = max(epochs, -(-steps // per_epoch))
    for epoch in range(epochs):
        slower = 1 / (1 + 4 * epoch / epochs)
        order = rng.permutation(len(y))
        for lo in range(0, len(y), batch):
            at = order[lo:lo + batch]
            n = np.array([len(x[i]) for i in at])
            t, row = np.concatenate([x[i] for i in at]), np.repeat(np.arange(len(at)), n)
            vt, real = v[t], np.flatnonzero(n)
            s, q, lin = np.zeros((len(at), factors)), np.zeros((len(at), factors)), np.zeros(len(at))
            if len(real):
                first = (np.cumsum(n) - n)[real]
                s[real], q[real] = np.add.reduceat(vt, first, axis=0), np.add.reduceat(vt * vt, first, axis=0)
                lin[real] = np.add.reduceat(w[t], first)
            p = 1 / (1 + np.exp(-np.clip(bias + lin + 0.5 * (s * s - q).sum(axis=1), -30, 30)))
            e = weight[at] * (p - y[at]) / len(at)
            step, dv = e[row, None] * (s[row] - vt), decay * v
            for f in range(factors):
                dv[:, f] += np.bincount(t, step[:, f], m)
            w = _soft(w - rate * slower * np.bincount(t, e[row], m) * single, rate * slower * l1)
            v -= 0.2 * slower * dv / max(1.0, float(np.sqrt((dv * dv).sum())))
            bias -= 0.3 * e.sum()
    return Machine(tb.Lookup(terms.view(_U)), float(bias), w, v)


def fit(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", label_col: str = "toxic",
        toxic: int = 4000, other: int = 16000, strongest: int = 4096, frequent: int = 256) -> Machine:
    """A machine from at most ``toxic`` + ``other`` labelled texts."""
    spark = docs.sparkSession
    nothing = lambda share: Machine(tb.Lookup(np.zeros(0, _U)), float(np.log(share / (1 - share))), np.zeros(0), np.zeros((0, 1)))
    clean = (labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_id"))
             .agg(F.max((F.col(label_col) > 0).cast("int")).alias("_label")))
    sample, classes = per_class(clean, "_label", {1: toxic, 0: other}, 2, F.xxhash64("_id"))
    if len(classes) < 2:
        return nothing(1 - 1e-9 if classes == [1] else 1e-9)
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    joined = own.join(F.broadcast(sample), own.id.eqNullSafe(sample._id))
    texts = joined.groupBy("_id", "_label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))  # at most toxic + other rows
    rows = written(arrow_map(texts.select("text", "_label"), _sample_terms, "label int, terms array<long>"), "tox-sample")
    n1, n0 = rows.agg(F.sum("label"), F.sum(1 - F.col("label"))).first()
    if not n1 or not n0:
        return nothing(1 - 1e-9 if n1 else 1e-9)
    a, b, share = F.col("a"), F.col("b"), n1 / (n1 + n0)
    gain = lambda n, p: F.when(n > 0, n * F.log(n / (a + b) / p)).otherwise(0.0)
    tested = written(rows.select("label", F.explode("terms").alias("term")).groupBy("term")
                     .agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b")).where(a + b >= 3)
                     .select("term", (a + b).alias("df"), (2 * (gain(a, share) + gain(b, 1 - share))).alias("g")), "tox-terms")
    enough = 2 * np.log(2 * max(1, tested.count())) - 6
    strong = {r[0] for r in tested.where(F.col("g") >= float(enough)).orderBy(F.desc("g"), "term").limit(strongest).select("term").collect()}
    often = {r[0] for r in tested.orderBy(F.desc("df"), "term").limit(frequent).select("term").collect()}
    terms = np.unique(np.array(sorted(strong | often), np.int64).view(_U)).view(np.int64)
    if not len(terms):
        return nothing(share)
    x, y = [], []
    for r in arrow_map(rows, partial(_selected, spark.sparkContext.broadcast(terms)), "label int, at array<int>").toLocalIterator():
        x.append(np.array(r["at"], np.int64))
        y.append(r["label"])
    order = sorted(range(len(y)), key=lambda i: (y[i], x[i].tolist()))  # the same sample gives the same machine
    return train([x[i] for i in order], np.array([y[i] for i in order]), terms, np.isin(terms, list(strong)))


def _selected(kept, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keep = tb.Lookup(kept.value.view(_U))
    for batch in batches:
        at = [np.sort(keep.find(np.array(t, np.int64).view(_U))[1]) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at, pa.list_(pa.int32()))], ["label", "at"])


def _score(machine, field: str | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    m: Machine = machine.value
    for batch in batches:
        out = np.zeros(len(batch))
        for run in tb.runs(text_of(batch, field), tb.ALNUM, stems=STEMS):
            out[run.row0:run.row0 + run.rows] = m.scores(*_terms(run, m.terms), run.rows)
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out)], ["row", "score"])


def score(docs: DataFrame, machine: Machine, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``row`` (struct of the ``carry`` columns; all, if not given) and score (0
    to 1, higher: toxic likelier) for every row and whole text."""
    columns, field = row_and_text(docs, text_col, carry)
    rows = docs.select(*columns)
    return arrow_map(rows, partial(_score, docs.sparkSession.sparkContext.broadcast(machine), field),
                     T.StructType([rows.schema["row"]]).add("score", "double"))
