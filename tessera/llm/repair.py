"""Conversation structure repair: the cheapest edits that make a conversation well formed.

A conversation is well formed if its role initials read ``(s?(ua)+)?``: perhaps a
system turn, then pairs of a user and an assistant turn, or nothing at all.  Edits:
Keep costs 0; Rerole, to user or assistant, 3; Delete 4 (and must be taken for
blank and duplicate rows); Insert of an empty user or assistant turn 3; a truncated
row that is kept or reroled adds 3.  Of equally cheap repairs the one whose edit
initials, in order, are least in ASCII is taken.

Method.  Secondary-sorted streaming: rows without their texts are dealt by
conversation and sorted by turn, last turn first, and ``mapInPandas`` carries the
state of a dynamic programme over the rows still to come from batch to batch: the
least cost of the rest from each of the four places in the grammar (nothing yet,
after a system, a user, an assistant turn).  From a place each edit leads to one next
place, so the least initial among the cheapest edits is the right choice at every
step, and a row needs only one two-byte back pointer.  Back pointers of a
conversation are followed when its first row has come.  A giant conversation spills:
its back pointers go out as rows of a written table, ``block`` of them each, and a
second stream follows them, first block first, carrying the place in the grammar.
So a task holds one block, whatever the conversation.  A last stream, dealt by
conversation and sorted by turn, applies the edits to the texts.

What a row is.  Rows of one conversation go by turn (null first), rows of one turn by
a digest of role and text; equal rows are interchangeable, are aggregated before the
stream, and all but the first are duplicates.  A row's first fault counts: blank (only
ASCII white space), duplicate (role and text seen earlier), truncated (the last
character that is not white space is not ``.``, ``!`` or ``?``).

Nulls and the like: a null role or text is one space; a null conversation id is one
conversation; null turns come first and count for no gap.  A role that is empty, or of
another initial, can only be reroled or deleted.  A conversation without rows has no
row in the results of this module.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from collections import deque
from collections.abc import Iterator
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import pandas_map, written

BLOCK = 1 << 20
KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 3, 4, 3, 3
#: Places in the grammar: nothing yet, after a system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The place behind a user or assistant turn put at each place, and that turn's role.
_NEXT = (USER, USER, ASSISTANT, USER)
_ROLE = ("user", "user", "assistant", "user")
#: Codes of a back pointer (three bits a place): the edit, where Keep of a system turn at the start is one of its own.
_DELETE, _INSERT, _KEEP, _KEEP_SYSTEM, _REROLE = range(5)
_LETTER = "DIKKR"
_WHITE = " \t\n\x0b\x0c\r"
_OK, _GONE, _SHORT = 0, 1, 2


def _with_inserts(options: list[list[tuple[int, int]]]) -> tuple[tuple[int, ...], int]:
    """Least costs from each place and the back pointer, from the (cost, code)
    options of each place that use no insert here."""
    bare = [min(o)[0] if o else 1 << 60 for o in options]
    user, assistant = min(bare[USER], INSERT + bare[ASSISTANT]), min(bare[ASSISTANT], INSERT + bare[USER])
    best = (min(bare[START], INSERT + user), min(bare[SYSTEM], INSERT + user), user, assistant)
    pointer = 0
    for place, cost in enumerate(best):
        codes = [code for c, code in options[place] if c == cost]
        if INSERT + best[_NEXT[place]] == cost:
            codes.append(_INSERT)
        if codes:  # of two edits of one cost that of the lesser initial: their codes are in that order
            pointer |= min(codes) << 3 * place
    return best, pointer


#: Behind the last row: done at the start and after an assistant turn, else turns are inserted.
_END, _END_POINTER = _with_inserts([[(0, 7)], [], [], [(0, 7)]])


class Programme:
    """The steps of the dynamic programme.  Costs are kept less their minimum,
    of which there are few combinations, so steps are looked up, not computed."""

    def __init__(self):
        self.steps: dict = {}

    def step(self, rest: tuple[int, ...], initial: str, state: int) -> tuple[tuple[int, ...], int, int]:
        """(costs from here less their minimum, that minimum, back pointer) of a row."""
        key = (rest, initial if initial in ("s", "u", "a") else "", state)
        got = self.steps.get(key)
        if got is None:
            options = []
            for place in range(4):
                own = [(DELETE + rest[place], _DELETE)]
                if state != _GONE:
                    more = CUT_SHORT if state == _SHORT else 0
                    own.append((REROLE + more + rest[_NEXT[place]], _REROLE))
                    if initial == _ROLE[place][0]:
                        own.append((KEEP + more + rest[_NEXT[place]], _KEEP))
                    elif place == START and initial == "s":
                        own.append((KEEP + more + rest[SYSTEM], _KEEP_SYSTEM))
                options.append(own)
            best, pointer = _with_inserts(options)
            low = min(best)
            got = self.steps[key] = (tuple(c - low for c in best), low, pointer)
        return got


def follow(pointers, place: int, last: bool) -> tuple[str, int]:
    """The edits' initials along back pointers in row order, and the place behind them."""
    out = []
    for p in pointers:
        while (code := p >> 3 * place & 7) == _INSERT:
            out.append("I")
            place = _NEXT[place]
        out.append(_LETTER[code])
        if code == _KEEP_SYSTEM:
            place = SYSTEM
        elif code != _DELETE:
            place = _NEXT[place]
    if last:
        while _END_POINTER >> 3 * place & 7 == _INSERT:
            out.append("I")
            place = _NEXT[place]
    return "".join(out), place


def _order(rows: DataFrame) -> DataFrame:
    """The rows with roles and texts free of nulls, and ``digest``, which orders the rows of a turn."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    digest = F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)))
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       role.alias("role"), text.alias("text"), digest.alias("digest"))


def _keys() -> list[Column]:
    """pandas has no long column with nulls: ids and turns go as a flag and a number."""
    return [F.col("conv_id").isNotNull().alias("has_conv"), F.coalesce("conv_id", F.lit(0)).alias("conv"),
            F.col("turn").isNotNull().alias("has_turn"), F.coalesce("turn", F.lit(0)).alias("nth")]


def faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, initial, copies, blank, duplicate, truncated) of the
    distinct rows; ``duplicate``: the same role and text were in an earlier turn."""
    body = F.rtrim("text", F.lit(_WHITE))
    narrow = _order(rows).select("conv_id", "turn", "digest", F.substring("role", 1, 1).alias("initial"), (body == "").alias("blank"),
                                 (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("short"))
    once = written(narrow.groupBy("conv_id", "turn", "digest").agg(*[F.first(c).alias(c) for c in ("initial", "blank", "short")], F.count("*").alias("copies")), "rep-rows")
    when = F.struct(F.col("turn").isNotNull(), "turn")
    seen = (once.groupBy("conv_id", "digest").agg(F.min(when).alias("first"), F.count("*").alias("n")).where("n > 1")
            .select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), "first"))
    joined = once.join(seen, once.conv_id.eqNullSafe(seen.c) & (once.digest == seen.d), "left")
    return joined.select("conv_id", "turn", "digest", "initial", "copies", "blank",
                         (~F.col("blank") & F.coalesce(when > F.col("first"), F.lit(False))).alias("duplicate"),
                         (~F.col("blank") & F.col("short")).alias("truncated"))


_PLAN = ("has_conv boolean, conv long, block int, has_turn boolean, nth long, digest binary, pointers binary, audit string, "
         "blank long, duplicate long, truncated long, illegal long, cost long")
_PLAN_NAMES = [c.split()[0] for c in _PLAN.split(", ")]
_LEGAL = ("su", "ua", "au")


def _plan(size: int, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Back pointers and totals of conversations whose rows come last turn first.
    A conversation of up to ``size`` back pointers has one row, with its audit."""
    programme, conv, out = Programme(), None, []

    def flush(last: bool):
        """A row for the block so far; the last one (of the first rows) has the totals."""
        audit = follow(reversed(pointers), START, True)[0] if last and not block else None
        totals = [blank, duplicate, truncated, illegal, cost + rest[START]] if last else [None] * 5
        out.append((*conv, block, *at, b"" if audit is not None else pointers.tobytes(), audit, *totals))

    for batch in batches:
        for has, key, has_turn, nth, digest, initial, copies, is_blank, is_dup, is_short in zip(*(batch[c].tolist() for c in batch.columns)):
            if (has, key) != conv:
                if conv is not None:
                    flush(True)
                conv, block, pointers, rest, cost, later = (has, key), 0, array("H"), _END, 0, None
                blank = duplicate = truncated = illegal = 0
            gone = is_blank or is_dup
            if is_blank:
                blank += copies
            else:
                duplicate += copies - 1 + is_dup
                truncated += is_short and not is_dup
            illegal += (later is not None and initial + later not in _LEGAL) + (copies - 1) * (initial * 2 not in _LEGAL)
            later = initial
            for left in range(copies, 0, -1):  # the first copy comes last here
                if len(pointers) == size:
                    flush(False)
                    block, pointers = block + 1, array("H")
                at = (has_turn, nth, bytes(digest))
                rest, low, pointer = programme.step(rest, initial, _GONE if gone or left > 1 else _SHORT if is_short else _OK)
                cost += low
                pointers.append(pointer)
        if out:
            yield pd.DataFrame(out, columns=_PLAN_NAMES)
            out.clear()
    if conv is not None:
        flush(True)
        yield pd.DataFrame(out, columns=_PLAN_NAMES)


def _follow_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Audits of spilled blocks, sorted by conversation, first rows' block first."""
    conv, place = None, START
    for batch in batches:
        audits = []
        for has, key, block, data in zip(batch["has_conv"], batch["conv"], batch["block"], batch["pointers"]):
            if (has, key) != conv:
                conv, place = (has, key), START
            pointers = array("H")
            pointers.frombytes(bytes(data))
            audit, place = follow(reversed(pointers), place, block == 0)
            audits.append(audit)
        yield batch[["has_conv", "conv", "block", "has_turn", "nth", "digest"]].assign(audit=audits)


def plan(rows: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Totals (conv_id, blank, duplicate, truncated, illegal, cost), one row for each
    conversation, and the audits in pieces (conv_id, block, turn, digest, audit): the
    edits from the row of that turn and digest on; greater blocks come first."""
    keyed = faults(rows).select(*_keys(), "digest", "initial", "copies", "blank", "duplicate", "truncated")
    dealt = keyed.repartition("has_conv", "conv").sortWithinPartitions("has_conv", "conv", F.desc("has_turn"), F.desc("nth"), F.desc("digest"))
    plans = written(pandas_map(dealt, partial(_plan, block), _PLAN), "rep-plans")
    spilled = plans.where("audit is null").select("has_conv", "conv", "block", "has_turn", "nth", "digest", "pointers")
    followed = pandas_map(spilled.repartition("has_conv", "conv").sortWithinPartitions("has_conv", "conv", F.desc("block")), _follow_blocks,
                          "has_conv boolean, conv long, block int, has_turn boolean, nth long, digest binary, audit string")
    pieces = written(plans.where("audit is not null").select(followed.columns).union(followed), "rep-audits")
    conv_id = F.when(F.col("has_conv"), F.col("conv")).alias("conv_id")
    return (plans.where("cost is not null").select(conv_id, "blank", "duplicate", "truncated", "illegal", "cost"),
            pieces.select(conv_id, "block", F.when(F.col("has_turn"), F.col("nth")).alias("turn"), "digest", "audit"))


_REPAIRED = "has_conv boolean, conv long, position long, role string, text string, edit string"
_REPAIRED_NAMES = [c.split()[0] for c in _REPAIRED.split(", ")]


def _apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The repaired rows of conversations whose rows come in order, the pieces of
    the audit ahead of the rows that they are for."""
    conv, out, script, at, place, position = None, [], deque(), 0, START, 0

    def put(role: str, text: str, edit: str):
        nonlocal position, place
        out.append((*conv, position, role, text, edit))
        position += 1
        place = SYSTEM if edit == "K" and place == START and role[:1] == "s" else _NEXT[place]

    def edit() -> str | None:
        nonlocal at
        while script and at == len(script[0]):
            script.popleft()
            at = 0
        if not script:
            return None
        at += 1
        return script[0][at - 1]

    def inserts():
        while (e := edit()) == "I":
            put(_ROLE[place], "", "I")
        return e

    for batch in batches:
        for has, key, audit, role, text in zip(*(batch[c].tolist() for c in ("has_conv", "conv", "audit", "role", "text"))):
            if (has, key) != conv:
                if conv is not None:
                    inserts()
                conv, at, place, position = (has, key), 0, START, 0
                script.clear()
            if audit is not None:
                script.append(audit)
                continue
            e = inserts()
            if e == "K":
                put(role, text, e)
            elif e == "R":
                put(_ROLE[place], text, e)
        if out:
            yield pd.DataFrame(out, columns=_REPAIRED_NAMES)
            out.clear()
    if conv is not None:
        inserts()
        if out:
            yield pd.DataFrame(out, columns=_REPAIRED_NAMES)


def repaired(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """The repaired rows (has_conv, conv, position, role, text, edit), those of a
    conversation together and in order; ``conv`` counts only where ``has_conv``."""
    none = F.lit(None).cast("string")
    texts = _order(rows).select(*_keys(), "digest", F.lit(-1).alias("block"), none.alias("audit"), "role", "text")
    scripts = pieces.select(*_keys(), "digest", "block", "audit", none.alias("role"), none.alias("text"))
    dealt = scripts.union(texts).repartition("has_conv", "conv").sortWithinPartitions("has_conv", "conv", "has_turn", "nth", "digest", F.desc("block"))
    return pandas_map(dealt, _apply, _REPAIRED)


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    conv, sha, names = None, None, ["has_conv", "conv", "repaired_sha256"]
    for batch in batches:
        done = []
        for has, key, role, text in zip(batch["has_conv"], batch["conv"], batch["role"], batch["text"]):
            if (has, key) != conv:
                if conv is not None:
                    done.append((*conv, sha.hexdigest()))
                conv, sha = (has, key), hashlib.sha256()
                line = f"{role}:{text}"
            else:
                line = f"\n{role}:{text}"
            sha.update(line.encode("utf-8", "surrogatepass"))
        yield pd.DataFrame(done, columns=names)
    if conv is not None:
        yield pd.DataFrame([(*conv, sha.hexdigest())], columns=names)


def digests(repaired_rows: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of ``repaired`` rows, still in its order: the hash
    of their ``role:text``, joined by newlines."""
    got = pandas_map(repaired_rows, _digests, "has_conv boolean, conv long, repaired_sha256 string")
    return got.select(F.when(F.col("has_conv"), F.col("conv")).alias("conv_id"), "repaired_sha256")


def report(rows: DataFrame, every: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row for each conversation of ``every`` (its column conv_id): gaps in the
    turns, faults, cost, audit and the hash of the repaired conversation."""
    totals, pieces = plan(rows, block)
    audits = pieces.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("block")).alias("b"), "audit"))), lambda x: x["audit"]), "").alias("audit"))
    gaps = rows.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"))
    out = every.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    for part in (gaps, totals, audits, digests(repaired(rows, pieces))):
        own = part.withColumnRenamed("conv_id", "_conv")
        out = out.join(own, out.conv_id.eqNullSafe(own["_conv"]), "left").drop("_conv")
    zero = F.lit(0).cast("long")
    return out.select("conv_id", *[F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) damaged by crc32 of ``conv_id:turn`` mod 20:
    0 drops the row, 1 empties its text, 2 removes ``.!?``, 3 repeats it, 4 makes its
    role user.  Nulls count as one space, in the key too."""
    blank = F.lit(" ")
    kind = F.crc32(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")]).cast("binary")) % 20
    text = F.coalesce("text", blank)
    hurt = rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"),
                       F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"), kind.alias("kind"))
    return (hurt.where("kind <> 0").withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
            .select("conv_id", "turn", "role", "text"))
