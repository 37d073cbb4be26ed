"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

Method.  A text is encoded by a byte-level BPE of ``tokenizers`` (A, with a blank
in front) and by a sentencepiece model (B, which puts the blank there itself).
Coarse cuts come from A's character offsets and from the spans of B's proto, both
brought to byte offsets of blank + text.  A coarse span as long as the token's
decoded bytes is exact.  Where several tokens share a character, or B falls back
to bytes (such pieces have empty spans but the last), the spans between exact
cuts are refined by the lengths of the decoded bytes.  At last the decoded bytes
must join to the text's bytes; a text for which either side does not has no tokens.

Offsets where tokens of both sides end cut them into groups; each stretch between
neighbouring ends of either side is one link, the A and B token that overlap there.

Segments.  Texts are cut at single blanks between characters that are not white
space.  No token of either side spans such a blank: A's pattern starts a new word
at it, and no piece of B has its blank mark behind another character (checked on
the vocabulary; a pair of another kind is not cut).  So a segment has the same
tokens alone as in its text, repeated segments are aligned once (a bounded memory
of each Python worker keeps them), and a very long text is handled in parts.

Counts of id pairs.  ``pair_counts`` counts for each linked id pair the documents
that hold it, summed up batch by batch before the shuffle.  ``link_scores`` brings
the counts back to the documents: pairs held by more than 1 / ``heavy`` of all
(document, pair) rows are fewer than ``heavy`` and go out as a broadcast, the rest
is joined by pair, each with few rows, so no pair is a hot key.

Nulls and the like: a null or empty text has no tokens: zeros, no groups.  Rows
come out as they went in, repeated or not; a repeated row counts as a document of
its own.  The tokenizer files are read on the driver and sent to the workers, so
their paths need to exist only there.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import arrow_map, written

MARK = "▁"
PART = 1 << 20
#: Segments kept by a worker, and the links of all of them; new segments encoded as one line.
KEPT, KEPT_LINKS = 400_000, 4_000_000
LINE = 200
_CUT = re.compile(r"(?<=\S) (?=\S)")
_MEASURES = ("n_a", "n_b", "n_groups", "n_links")


@dataclass(frozen=True)
class TokenizerPair:
    """The contents of the two tokenizer files."""

    a: bytes
    b: bytes

    @staticmethod
    def read(a_path: str, b_path: str) -> "TokenizerPair":
        with open(a_path, "rb") as a, open(b_path, "rb") as b:
            return TokenizerPair(a.read(), b.read())


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: those
    below U+0100 stand for themselves, the others in order for the bytes left."""
    from tokenizers.pre_tokenizers import ByteLevel
    chars = sorted(ByteLevel.alphabet())
    own = {c: ord(c) for c in chars if ord(c) < 256}
    rest = [b for b in range(256) if b not in own.values()]
    return own | dict(zip((c for c in chars if ord(c) >= 256), rest))


def _flat(parts: list, dtype) -> np.ndarray:
    return np.concatenate([np.asarray(p, dtype) for p in parts]) if parts else np.zeros(0, dtype)


class _Rows:
    """Rows of numbers that grow at the end."""

    def __init__(self, width: int, dtype=np.int64):
        self.n, self.data = 0, np.zeros((1024, width), dtype)

    def add(self, rows: np.ndarray) -> None:
        need = self.n + len(rows)
        if need > len(self.data):
            grown = np.zeros((max(need, 2 * len(self.data)), self.data.shape[1]), self.data.dtype)
            grown[:self.n] = self.data[:self.n]
            self.data = grown
        self.data[self.n:need] = rows.reshape(len(rows), -1)
        self.n = need


class Aligner:
    """Both tokenizers, and the alignments of the segments seen of late."""

    def __init__(self, pair: TokenizerPair):
        import sentencepiece
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker for each core
        self.a = Tokenizer.from_str(pair.a.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pair.b)
        byte_of = byte_alphabet()
        vocab = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(byte_of[c] for c in token)
        n = self.b.get_piece_size()
        piece = [self.b.id_to_piece(i) for i in range(n)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(piece)]
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.base = n  # a pair of ids (a, b) is the number a * base + b
        self.cut = self._cuts_are_safe(piece)
        self.forget()

    def _cuts_are_safe(self, piece: list[str]) -> bool:
        import json

        from sentencepiece import sentencepiece_model_pb2
        form = json.loads(self.a.to_str())
        pre = form["pre_tokenizer"] or {}
        plain = form["normalizer"] is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(self.b.serialized_model_proto())
        norm = model.normalizer_spec
        same = norm.add_dummy_prefix and not norm.remove_extra_whitespaces and norm.escape_whitespaces and not norm.precompiled_charsmap
        return bool(plain and same and not model.trainer_spec.treat_whitespace_as_suffix
                    and not any(MARK in p.lstrip(MARK) for i, p in enumerate(piece) if not (self.b.is_byte(i) or self.b.is_control(i))))

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.groups: list[str] = []
        #: Of each segment: tokens of A and B, groups, links, where its links start, whether it came back whole.
        self.known, self.pairs = _Rows(6), _Rows(1)

    def parts(self, text: str) -> Iterator[list[str]]:
        """The segments of a text, those of about ``PART`` characters at a time."""
        at = 0
        while self.cut and len(text) - at > PART:
            m = _CUT.search(text, at + PART)
            if m is None:
                break
            yield self._segments(text[at:m.start()])
            at = m.end()
        yield self._segments(text[at:])

    def _segments(self, text: str) -> list[str]:
        return _CUT.split(text) if self.cut else [text]

    def _spans(self, lines: list[str], raw: list[bytes]):
        """For both sides: ids, how many of each line, and where the coarse spans start
        and end in the bytes of all lines, one after the other."""
        size = np.array([len(r) for r in raw], np.int64)
        base = np.cumsum(size) - size
        codes = self.a.encode_batch([" " + s for s in lines], add_special_tokens=False)
        to_byte = np.r_[np.flatnonzero((np.frombuffer(b"".join(raw), np.uint8) & 0xC0) != 0x80), int(size.sum())]
        chars = np.array([len(s) + 1 for s in lines], np.int64)
        many = np.array([len(c) for c in codes], np.int64)
        spans = np.array([x for c in codes for x in c.offsets], np.int64).reshape(-1, 2) + np.repeat(np.cumsum(chars) - chars, many)[:, None]
        yield np.array([i for c in codes for i in c.ids], np.int64), many, to_byte[spans[:, 0]], to_byte[spans[:, 1]], self.a_bytes, self.a_size
        pieces = [p.pieces for p in self.b.encode(lines, return_type="proto", num_threads=1)]
        many = np.array([len(p) for p in pieces], np.int64)
        shift = np.repeat(base + 1, many)
        ids, lo, hi = (np.array([f(q) for p in pieces for q in p], np.int64) for f in (attrgetter("id"), attrgetter("begin"), attrgetter("end")))
        yield ids, many, lo + shift, hi + shift, self.b_bytes, self.b_size

    def _token_ends(self, lines: list[str]):
        """For both sides: ids and byte ends of the tokens of the lines that come back
        whole; and which do."""
        raw = [(" " + s).encode("utf-8", "surrogatepass") for s in lines]
        size = np.array([len(r) for r in raw], np.int64)
        base, ok, sides = np.cumsum(size) - size, np.ones(len(lines), bool), []
        for ids, many, lo, hi, decoded, length in self._spans(lines, raw):
            first = np.r_[0, np.cumsum(many)]
            listed = [decoded[t] for t in ids.tolist()]
            if b"".join(listed) != b"".join(raw):
                ok &= np.array([b"".join(listed[f:g]) == r for f, g, r in zip(first.tolist(), first[1:].tolist(), raw)], bool)
            own = length[ids]
            exact = hi - lo == own
            some = many > 0
            exact[first[:-1][some]] = True  # a line's first token starts at its first byte
            lo[first[:-1][some]] = base[some]
            run = np.maximum.accumulate(np.where(exact, np.arange(len(ids)), 0))  # the last exact cut up to each token
            before = np.cumsum(own) - own
            sides.append((ids, many, lo[run] + before - before[run] + own))
        return [(ids[keep], end[keep]) for ids, many, end in sides for keep in (np.repeat(ok, many),)], ok

    def learn(self, segments: list[str]) -> None:
        """Align segments that are not known yet, as one batch: those that may stand
        between single blanks many a line, the others one a line."""
        plain = [s for s in segments if s and not s[0].isspace() and not s[-1].isspace() and MARK not in s] if self.cut else []
        other = [s for s in segments if not s or s[0].isspace() or s[-1].isspace() or MARK in s] if self.cut else segments
        segments = plain + other
        lines = [plain[i:i + LINE] for i in range(0, len(plain), LINE)]
        stop = np.cumsum([1 + len(s.encode("utf-8", "surrogatepass")) for s in segments])
        ends, ok = self._token_ends([" ".join(x) for x in lines] + other)
        ok = np.repeat(ok, [*map(len, lines), *[1] * len(other)])
        if not ok[:len(plain)].all() or any(not np.isin(stop[ok], end).all() for _, end in ends):
            ends, ok = self._token_ends(segments)
        (a, a_end), (b, b_end) = ends
        both = np.concatenate([a_end, b_end])
        both.sort(kind="stable")
        twice = both[1:] == both[:-1]
        cuts, links = both[1:][twice], both[np.r_[True, ~twice][:len(both)]]
        of = lambda at: np.diff(np.r_[0, np.searchsorted(at, stop, side="right")])
        measures = np.column_stack([of(a_end), of(b_end), of(cuts), of(links)])
        self.groups += self._texts(a, a_end, b, b_end, cuts, measures)
        self.number.update(zip(segments, range(self.known.n, self.known.n + len(segments))))
        start = self.pairs.n + np.cumsum(measures[:, 3]) - measures[:, 3]
        self.known.add(np.column_stack([measures, start, ok]))
        self.pairs.add(a[np.searchsorted(a_end, links)] * self.base + b[np.searchsorted(b_end, links)])

    def _texts(self, a, a_end, b, b_end, cuts, measures) -> list[str]:
        """The groups of each segment as text: ``a1,a2|b1;a3|b2,b3``."""
        ga, gb = np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end)
        last_a, last_b = cuts[ga] == a_end, cuts[gb] == b_end
        # each token's number with the mark behind it, in order of groups, A before B
        mark = np.r_[a, b] * 3 + np.r_[last_a.astype(np.int64), 2 * last_b.astype(np.int64)]
        order = np.argsort(np.r_[2 * ga, 2 * gb + 1], kind="stable")
        mark = mark[order]
        used, at = np.unique(mark, return_inverse=True)
        names = [f"{u // 3}{',|;'[u % 3]}" for u in used.tolist()]
        words = [names[i] for i in at.tolist()]
        upto = np.cumsum(measures[:, 0] + measures[:, 1]).tolist()
        return ["".join(words[f:g])[:-1] for f, g in zip([0, *upto], upto)]

    def align(self, texts: list[str | None], detail: bool = False) -> Iterator:
        """For each text (measures, hex digest of the groups, sorted linked pairs,
        how often each, the groups' texts or None), or None: no tokens."""
        lo = 0
        while lo < len(texts):  # some texts at a time, of about ``PART`` characters
            hi, chars = lo, 0
            while hi < len(texts) and (hi == lo or chars + len(texts[hi] or "") <= PART):
                chars += len(texts[hi] or "")
                hi += 1
            if chars <= PART:
                cut = [self._segments(t) if t else None for t in texts[lo:hi]]
                self._know([s for c in cut if c for s in c])
                yield from (self._finish([self._sums(c, detail)], detail) if c else None for c in cut)
            else:
                yield self._finish(self._in_parts(texts[lo], detail), detail)
            lo = hi

    def _in_parts(self, text: str, detail: bool) -> Iterator:
        for segments in self.parts(text):
            self._know(segments)
            yield self._sums(segments, detail)

    def _know(self, segments: list[str]) -> None:
        """Learn the segments that are not known; before that forget what was, if it is much."""
        if len(self.number) > KEPT or self.pairs.n > KEPT_LINKS:
            self.forget()
        fresh = list(dict.fromkeys(s for s in segments if s not in self.number))
        if fresh:
            self.learn(fresh)

    def _sums(self, segments: list[str], detail: bool):
        """(measures, pairs, how often, groups) of segments that follow each other, or None."""
        at = [self.number[s] for s in segments]
        used, often = np.unique(np.array(at, np.int64), return_counts=True)
        known = self.known.data[used]
        if not known[:, 5].all():
            return None
        size = known[:, 3]
        slot = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(known[:, 4], size)
        pairs, times = _summed(self.pairs.data[slot, 0], np.repeat(often, size))
        return (known[:, :4] * often[:, None]).sum(axis=0), pairs, times, ";".join([self.groups[i] for i in at])

    @staticmethod
    def _finish(parts, detail: bool):
        total, sha, pairs, times, groups = np.zeros(4, np.int64), hashlib.sha256(), [], [], []
        for n, part in enumerate(parts):
            if part is None:
                return None
            total += part[0]
            sha.update((";" + part[3] if n else part[3]).encode())
            pairs.append(part[1])
            times.append(part[2])
            if detail:
                groups += part[3].split(";")
        p, t = (pairs[0], times[0]) if len(pairs) == 1 else _summed(np.concatenate(pairs), np.concatenate(times))
        return total.tolist(), sha.hexdigest(), p, t, groups if detail else None


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their numbers."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][:len(keys)])
    return keys[first], np.add.reduceat(n, first) if len(first) else n


_NUMBERS = (*_MEASURES, "groups_sha256", "pairs", "times", "groups")


def _lists(arrays: list, kind: pa.DataType) -> pa.ListArray:
    offsets = np.r_[0, np.cumsum([len(x) for x in arrays])].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(_flat(arrays, np.int64)) if kind == pa.int64() else pa.array([x for g in arrays for x in g], kind))


def _align(pair, detail: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    aligner = Aligner(pair.value)
    nothing = ([0, 0, 0, 0], "", [], [], [])
    for batch in batches:
        kept = batch.drop_columns(["text"])
        rows, done, links = [], 0, 0
        for i, got in enumerate(aligner.align(batch.column("text").to_pylist(), detail)):
            rows.append(nothing if got is None else got)
            links += len(rows[-1][2])
            if links > 1_000_000 or i + 1 == len(batch):
                measures, sha, pairs, times, groups = zip(*rows)
                cols = [*(pa.array(c, pa.int64()) for c in zip(*measures)), pa.array(sha), _lists(pairs, pa.int64()), _lists(times, pa.int64())]
                cols += [_lists(groups, pa.string())] if detail else []
                own = kept.slice(done, len(rows))
                yield pa.RecordBatch.from_arrays([*own.columns, *cols], [*own.schema.names, *_NUMBERS[:len(cols)]])
                rows, done, links = [], i + 1, 0


def align(docs: DataFrame, tokenizers: TokenizerPair, text_col: str = "text", carry: list[str] | None = None, detail: bool = False) -> DataFrame:
    """``row`` (struct of the ``carry`` columns; all but the text, if not given),
    ``key`` (a number of the row's own), n_a, n_b, n_groups, n_links,
    ``groups_sha256`` of the groups' texts joined by ``;`` (empty: no tokens),
    ``pairs`` and ``times``: the sorted distinct linked id pairs, each as
    ``a * (size of B's vocabulary) + b``, and how often each is linked.
    ``detail`` adds ``groups``, the groups' texts.  The rows are written once."""
    spark = docs.sparkSession
    names = carry if carry is not None else [c for c in docs.columns if c != text_col]
    row = F.struct(*[docs[c] for c in names]) if names else F.struct(F.lit(None).cast("int").alias("none"))
    given = docs.select(F.monotonically_increasing_id().alias("key"), row.alias("row"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([*given.schema.fields[:2], *T._parse_datatype_string(
        "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>" + ", groups array<string>" * detail).fields])
    return written(arrow_map(given, partial(_align, spark.sparkContext.broadcast(tokenizers), detail), schema), "aln-rows")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs, n = np.unique(batch.column(0).flatten().to_numpy(), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], ["pair", "docs"])


def pair_counts(aligned: DataFrame, base: int) -> DataFrame:
    """(pair, docs, best) of all linked id pairs: how many rows hold each, and
    whether that is the most of any pair of its A id."""
    counts = written(arrow_map(aligned.select("pairs"), _counted, "pair long, docs long").groupBy("pair").agg(F.sum("docs").alias("docs")), "aln-counts")
    a = F.expr(f"pair div {base}")
    most = counts.groupBy(a.alias("a")).agg(F.max("docs").alias("most"))
    return written(counts.withColumn("a", a).join(most, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best")), "aln-pairs")


def _scored(heavy, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, n_best, count_sum) of the heavy pairs, and (key, pair, times) of the others."""
    known, docs, best = heavy.value
    for batch in batches:
        key, pairs = batch.column(0).to_numpy(), batch.column(1)
        size = np.diff(pairs.offsets.to_numpy())
        flat, times = pairs.flatten().to_numpy(), batch.column(2).flatten().to_numpy()
        at = np.minimum(np.searchsorted(known, flat), max(len(known) - 1, 0))
        hit = known[at] == flat if len(known) else np.zeros(len(flat), bool)
        row = np.repeat(np.arange(len(key)), size)
        add = lambda w: np.bincount(row[hit], weights=w, minlength=len(key))[:len(key)].astype(np.int64)
        n_best = add(times[hit] * best[at[hit]]) if hit.any() else np.zeros(len(key), np.int64)
        # counts may be large: sums in whole numbers, not in doubles
        total = np.zeros(len(key), np.int64)
        np.add.at(total, row[hit], times[hit] * docs[at[hit]])
        rest = np.flatnonzero(~hit)
        n, m = len(key), len(rest)
        none = lambda k: pa.nulls(k, pa.int64())
        join = lambda x, y: pa.concat_arrays([x, y])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[key, key[row[rest]]]), join(pa.array(n_best), none(m)), join(pa.array(total), none(m)),
             join(none(n), pa.array(flat[rest])), join(none(n), pa.array(times[rest]))], ["key", "n_best", "count_sum", "pair", "times"])


def link_scores(aligned: DataFrame, pairs: DataFrame, heavy: int = 1 << 17) -> DataFrame:
    """(key, n_best, count_sum): the links of each row whose pair is the most
    frequent of its A id, and the sum of the links' counts."""
    spark = aligned.sparkSession
    total = pairs.agg(F.sum("docs")).first()[0] or 0
    often = F.col("docs") > total / heavy  # fewer than ``heavy`` pairs
    got = pairs.where(often).orderBy("pair").toPandas()
    table = (got["pair"].to_numpy(np.int64), got["docs"].to_numpy(np.int64), got["best"].to_numpy(bool))
    scored = written(arrow_map(aligned.where(F.size("pairs") > 0).select("key", "pairs", "times"), partial(_scored, spark.sparkContext.broadcast(table)),
                               "key long, n_best long, count_sum long, pair long, times long"), "aln-scores")
    rare = (scored.where("pair is not null").select("key", "pair", "times").join(pairs.where(~often), "pair")
            .groupBy("key").agg(F.sum(F.col("times") * F.col("best").cast("long")).alias("n_best"), F.sum(F.col("times") * F.col("docs")).alias("count_sum")))
    return scored.where("pair is null").select("key", "n_best", "count_sum").union(rare).groupBy("key").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def alignment_counts(docs: DataFrame, tokenizers: TokenizerPair, text_col: str = "text", carry: list[str] | None = None, heavy: int = 1 << 17) -> DataFrame:
    """``row``, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    import sentencepiece
    base = sentencepiece.SentencePieceProcessor(model_proto=tokenizers.b).get_piece_size()
    aligned = align(docs, tokenizers, text_col, carry)
    scores = link_scores(aligned, pair_counts(aligned, base), heavy)
    zero = F.lit(0).cast("long")
    return aligned.drop("pairs", "times").join(scores, "key", "left").select(
        "row", *_MEASURES, F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
