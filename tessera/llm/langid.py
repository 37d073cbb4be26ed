"""Language identification with error-correcting output codes.

Method.  Each language has a codeword.  For each bit a binary classifier over
hashed byte n-grams (2, 3 and 4 bytes of the text; A-Z as a-z, all other ASCII
as one blank) tells the languages with that bit from those without: its weight
for an n-gram is the log ratio of the two groups' mean n-gram frequencies.  A
text's margin for a bit is the mean weight of its n-grams times their number,
the number counting up to ``EVIDENCE``.  Decoding adds up, for each codeword,
the logistic losses of the margins, each bit weighted by how well it did on the
sample; the codeword of least loss wins, its share of exp(-loss) is the score,
and a score lead below ``AMBIGUOUS`` over the next is flagged.

Up to seven languages have all distinct splits as bits; more have random splits,
the best of several draws by least distance between codewords.

The classifiers are fitted on a bounded sample: at most ``per_language`` texts of
each language (the smallest hashes of the id and text), of which only hashed
counts reach the driver.  Prediction reads every whole text in one pass.

Nulls and the like: a text that is null or has no letter is ``und`` with score
0.  Labels that are null teach nothing; with no labels at all every text is
``und``; with one language every other text has that one, score 1.  Equal
losses go to the first language in sorted order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textbatch as tb
from .sampling import per_class
from .scratch import arrow_map, row_and_text, text_of

GRAMS = (2, 3, 4)
BITS = 16
EVIDENCE = 60
AMBIGUOUS = 0.2
PIECE = 1 << 18

#: Bytes as the n-grams see them: letters in lower case, bytes from 0x80, else a blank.
_SEEN = np.full(256, 0x20, np.uint32)
_SEEN[0x61:0x7B] = np.arange(0x61, 0x7B)
_SEEN[0x41:0x5B] = np.arange(0x61, 0x7B)
_SEEN[0x80:] = np.arange(0x80, 0x100)


def gram_slots(b: np.ndarray, n: int) -> np.ndarray:
    """Hash slots of the n-grams of bytes ``b`` (uint32, as seen)."""
    if len(b) < n:
        return np.zeros(0, np.uint32)
    acc = np.full(len(b) - n + 1, n, np.uint32)
    for j in range(n):
        acc = acc * np.uint32(0x01000193) + b[j:j + len(acc)]
    acc = (acc ^ (acc >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return acc >> np.uint32(32 - BITS)


def _gram_runs(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, slots, row starts among the slots) by pieces of text;
    the slot 2**BITS marks n-grams across two rows."""
    data, off = tb.text_bytes(column)
    lo, end = int(off[0]), int(off[-1])
    while lo < end:
        hi = min(end, lo + PIECE)
        r0 = int(np.searchsorted(off, lo, side="right")) - 1
        r1 = int(np.searchsorted(off, hi, side="left"))
        starts = np.maximum(off[r0:r1], lo) - lo
        more = min(end, hi + max(GRAMS) - 1)
        seen = _SEEN[data[lo:more]]
        ends = off[r0 + 1:r1 + 1] - lo
        for n in GRAMS:
            slots = gram_slots(seen, n)[:hi - lo].astype(np.int64)
            for back in range(1, n):
                at = ends - back
                slots[at[(at >= 0) & (at < len(slots))]] = 1 << BITS
            yield r0, r1 - r0, slots, starts
        lo = hi


def _row_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (rows of an array) by segment; empty ones are 0."""
    out = np.zeros((len(starts), *values.shape[1:]), values.dtype)
    real = np.flatnonzero(np.r_[starts[1:], len(values)] > starts)
    real = real[starts[real] < len(values)]
    if len(real):
        out[real] = np.add.reduceat(values, starts[real], axis=0)
    return out


def code_matrix(k: int, seed: int = 7) -> np.ndarray:
    """Codewords of -1 and 1, a row for each of ``k`` languages."""
    if k <= 1:
        return np.zeros((k, 0), np.float32)
    if k <= 7:
        splits = [s for size in range(1, k) for s in combinations(range(1, k), size)]
        code = -np.ones((k, len(splits)), np.float32)
        for bit, s in enumerate(splits):
            code[list(s), bit] = 1
        return code
    rng, best, least = np.random.default_rng(seed), None, -1
    for _ in range(50):
        code = rng.choice([-1, 1], size=(k, 10 * int(np.ceil(np.log2(k))))).astype(np.float32)
        apart = (code.shape[1] - code @ code.T) / 2 + np.eye(k) * code.shape[1]
        used = (np.abs(code.sum(axis=0)) < k).all()
        if used and apart.min() > least:
            best, least = code, apart.min()
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weight: np.ndarray
    trust: np.ndarray

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """Weighted loss of each codeword (columns) for each text (rows)."""
        return (np.logaddexp(0, -margins[:, None, :] * self.code[None]) * self.trust).sum(axis=2)

    def margins(self, sums: np.ndarray, count: np.ndarray) -> np.ndarray:
        count = np.maximum(count, 1)[:, None]
        return sums / count * np.minimum(count, EVIDENCE)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashed n-gram counts of sampled texts, each as slots and counts."""
    for batch in batches:
        label = batch.column(1).to_pylist()
        for i in range(len(batch)):
            total = np.zeros((1 << BITS) + 1, np.int64)
            for _, _, slots, _ in _gram_runs(batch.column(0).slice(i, 1)):
                total += np.bincount(slots, minlength=len(total))
            at = np.flatnonzero(total[:-1])
            yield pa.RecordBatch.from_arrays([pa.array([label[i]]), pa.array([at], pa.list_(pa.int32())),
                                              pa.array([total[at]], pa.list_(pa.int64()))], ["label", "at", "n"])


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        per_language: int = 400, languages: int = 500) -> Model:
    """A model from the rows of ``docs`` with a language and a text, of at most
    ``per_language`` texts for each of at most ``languages`` languages."""
    rows = docs.select(F.col(lang_col).cast("string").alias("label"), F.col(text_col).cast("string").alias("text"),
                       F.xxhash64(id_col, text_col).alias("tie")).where("label is not null and text is not null")
    sample, names = per_class(rows, "label", per_language, languages, F.col("tie"))
    code = code_matrix(len(names))
    if code.shape[1] == 0:
        return Model(names, code, np.zeros(((1 << BITS) + 1, 0), np.float32), np.zeros(0, np.float32))
    texts = [(names.index(r["label"]), np.array(r["at"], np.int64), np.array(r["n"], np.float64))
             for r in arrow_map(sample.select("text", "label"), _counts, "label string, at array<int>, n array<long>").toLocalIterator()]
    freq = np.zeros((len(names), 1 << BITS))
    for label, at, n in texts:
        freq[label, at] += n / max(1.0, n.sum() ** 0.5)  # a long text counts for more, not in proportion
    freq = (freq + 1e-3) / (freq + 1e-3).sum(axis=1, keepdims=True)
    weight = np.zeros(((1 << BITS) + 1, code.shape[1]), np.float32)
    for bit in range(code.shape[1]):
        one, zero = freq[code[:, bit] > 0].mean(axis=0), freq[code[:, bit] < 0].mean(axis=0)
        weight[:-1, bit] = np.clip(np.log(one / zero), -4, 4)
    right, seen = np.zeros(code.shape[1]), np.zeros(len(names))
    for label, at, n in texts:
        right += (n @ weight[at] * code[label] > 0)
    trust = np.clip(2 * right / max(1, len(texts)) - 1, 0.05, 1)
    return Model(names, code, weight, (trust / trust.mean()).astype(np.float32))


def _predict(model, field: str | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    m: Model = model.value
    names = np.array(m.languages + ["und"], object)
    und = len(m.languages)
    for batch in batches:
        sums, count = np.zeros((len(batch), m.code.shape[1]), np.float64), np.zeros(len(batch), np.int64)
        if m.code.shape[1]:
            for r0, n, slots, starts in _gram_runs(text_of(batch, field)):
                sums[r0:r0 + n] += _row_sums(m.weight[slots], starts)
                count[r0:r0 + n] += _row_sums((slots < 1 << BITS).astype(np.int64), starts)
        if und:
            odds = np.exp(-(loss := m.losses(m.margins(sums, count))) + loss.min(axis=1, keepdims=True))
            odds /= odds.sum(axis=1, keepdims=True)
            best = loss.argmin(axis=1)
            score = odds[np.arange(len(best)), best]
            lead = score - (np.sort(odds, axis=1)[:, -2] if und > 1 else 0)
        else:
            best, score, lead = (np.zeros(len(batch), t) for t in (np.int64, np.float64, np.float64))
        letters = batch.column("letters").to_numpy(zero_copy_only=False).astype(bool)
        best = np.where(letters, best, und)
        score = np.where(letters & (und > 0), score, 0.0)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(names[best], pa.string()), pa.array(score), pa.array(~letters | (lead < AMBIGUOUS))],
            ["row", "lang_pred", "score", "ambiguous"])


def predict(docs: DataFrame, model: Model, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``row`` (struct of the ``carry`` columns; all, if not given), lang_pred,
    score and ambiguous, for every row and whole text."""
    columns, field = row_and_text(docs, text_col, carry)
    rows = docs.select(*columns, F.coalesce(F.col(text_col).cast("string").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    schema = (T.StructType([rows.schema["row"]]).add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean"))
    return arrow_map(rows, partial(_predict, docs.sparkSession.sparkContext.broadcast(model), field), schema)
