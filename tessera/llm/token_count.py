"""Token counts by count-only Viterbi over a unigram vocabulary.

Method.  An Aho-Corasick automaton gives the vocabulary pieces that end at each
position; for each position the best score and the number of pieces on that path
are carried along, nothing else.  Ties go as in the tokenizer: pieces are tried
by where they start, and a later one must be strictly better, so of equal paths
the one whose last piece is longest stays.  A character that is no piece costs
the least score less 10; with byte fallback it counts its UTF-8 bytes, without
it a run of such characters counts once.  Scores are summed in double precision.

The text is normalised as the vocabulary file's tokenizer does: a blank in front
(of texts that are not empty), and blanks written as U+2581.  No piece has that
mark behind another character, and none has a character that is no piece, so the
best path passes every word start and every unknown character: words are counted
one by one and kept in a bounded memory of each Python worker.  (For a vocabulary
of another kind the whole text is one word.)

The vocabulary is read from a sentencepiece file on the driver, its path is a
parameter.  The file here is of a BPE model; its pieces and scores serve as a
unigram vocabulary, as no public unigram file is at hand.

Nulls, empty texts: no tokens.  Rows come out as they went in, repeated or not.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from math import inf
from operator import add

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import arrow_map

MARK = "▁"
UNKNOWN_PENALTY = 10.0
KEPT = 400_000


@dataclass
class Vocabulary:
    pieces: dict[str, float]
    byte_fallback: bool

    @staticmethod
    def read(path: str) -> "Vocabulary":
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        normal = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        return Vocabulary({sp.id_to_piece(i): sp.get_score(i) for i in normal}, any(sp.is_byte(i) for i in range(sp.get_piece_size())))


class Counter:
    """Counts the tokens of texts; keeps the counts of at most ``KEPT`` words."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick
        pieces = vocabulary.pieces
        self.vocabulary, self.fallback = vocabulary, vocabulary.byte_fallback
        self.unknown = min(pieces.values(), default=0.0) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p in pieces if len(p) == 1}
        #: Two characters that follow each other in no piece are always cut apart.
        self.pairs = {p[i:i + 2] for p in pieces for i in range(len(p) - 1)}
        self.by_word = self.fallback and all(MARK not in p.lstrip(MARK) for p in pieces)
        self.kept: dict[str, int] = {}
        self.parts: dict[str, int] = {}

    def best(self, w: str) -> int:
        """Pieces on the best path through ``w``."""
        n = len(w)
        score, count = [0.0] + [-inf] * n, [0] * (n + 1)
        if not self.automaton:
            return self._closed(w, 0, n, score, count, [False] * (n + 1))
        if self.single.issuperset(w):
            for end, (length, piece) in self.automaton.iter(w):
                to = end + 1
                s = score[to - length] + piece
                if s > score[to]:
                    score[to] = s
                    count[to] = count[to - length] + 1
            return count[n]
        unknown, at = [False] * (n + 1), 0
        for end, (length, piece) in self.automaton.iter(w):
            if at < end:
                self._closed(w, at, end, score, count, unknown)
                at = end
            to = end + 1
            s = score[to - length] + piece
            if s > score[to]:
                score[to], count[to], unknown[to] = s, count[to - length] + 1, False
        return self._closed(w, at, n, score, count, unknown)

    def _closed(self, w, lo, hi, score, count, unknown) -> int:
        """Tries the characters of ``w[lo:hi]`` that are no piece as unknown
        ones, each after all pieces that end with it, as it starts last."""
        for at in range(lo, hi):
            if w[at] not in self.single and (s := score[at] + self.unknown) > score[at + 1]:
                score[at + 1], unknown[at + 1] = s, True
                count[at + 1] = count[at] + (len(w[at].encode("utf-8", "surrogatepass")) if self.fallback else not unknown[at])
        return int(count[hi])

    def word(self, w: str) -> int:
        """Pieces of a word, by the parts between pairs that no piece has."""
        if not self.fallback:
            return self.best(w)
        if self.pairs.issuperset(map(add, w, w[1:])):
            return self._part(w)
        lo, total = 0, 0
        for i in range(1, len(w) + 1):
            if i == len(w) or w[i - 1:i + 1] not in self.pairs:
                total += self._part(w[lo:i])
                lo = i
        return total

    def _part(self, w: str) -> int:
        n = self.parts.get(w)
        if n is None:
            n = self.best(w)
            if len(w) <= 64:
                self.parts[w] = n
        return n

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        if not self.by_word:
            return self.word(MARK + text.replace(" ", MARK))
        kept = self.kept
        if len(kept) > KEPT:
            kept.clear()
        if len(self.parts) > KEPT:
            self.parts.clear()
        words = text.replace(MARK, " ").split(" ")
        if "" in words:
            return self._with_runs(words)
        new = set(words).difference(kept)
        extra = {}  # words too long to keep
        for w in new:
            (kept if len(w) <= 64 else extra)[w] = self.word(MARK + w)
        if extra:
            return sum(kept[w] if w in kept else extra[w] for w in words)
        return sum(map(kept.__getitem__, words))

    def _with_runs(self, words: list[str]) -> int:
        """As above where blanks come in runs: a run and its word are one."""
        total, marks = 0, 0
        for i, w in enumerate(words):
            marks += 1
            if w or i == len(words) - 1:
                total += self.word(MARK * marks + w)
                marks = 0
        return total


_COUNTERS: dict[int, Counter] = {}


def _count(vocabulary, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key = id(vocabulary.value)  # the value is kept by the worker, and so is its counter
    counter = _COUNTERS.get(key) or _COUNTERS.setdefault(key, Counter(vocabulary.value))
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array([counter(t.as_py()) for t in batch.column("text")], pa.int64())], ["row", "n_tokens"])


def count_tokens(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``row`` (struct of the ``carry`` columns; all, if not given) and n_tokens
    for every row and whole text."""
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.struct(*[docs[c] for c in carry or docs.columns]).alias("row"))
    return arrow_map(rows, partial(_count, docs.sparkSession.sparkContext.broadcast(vocabulary)),
                     T.StructType([rows.schema["row"]]).add("n_tokens", "long"))
