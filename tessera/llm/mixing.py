"""Mixing sources to target weights by Pfair scheduling.

Method.  A source's rows are put in a hashed order and cut into blocks of equal
size (rows, or units such as characters: a row belongs to the block in which it
starts).  With target weight w, a source's block j (from 1) is released at slot
floor((j - 1) / w) and due by slot ceil(j / w).  Each slot goes to the released
block of earliest deadline.  As the weights add up to one, no deadline is missed,
so after any number of slots t a source has had between t * w - 1 and t * w + 1
blocks, and never differs from its target by a block or more.

Scale.  Weights are exact fractions, nothing is rounded.  When a source ends, the
weights of the rest are scaled up and a next phase begins, with the same bound;
nothing is repeated and nothing is left out.  The driver schedules the blocks, not
the rows: it holds two numbers for each block (12 bytes), and sends them to the
tasks as a lookup table of ``PIECE`` blocks a row.  Weights that repeat within
``period`` slots are scheduled for one period only.  More than ``SOURCES`` sources
are an error.  The hashed order is made in buckets of a source, so a source that
holds most rows is ordered by many tasks.

Nulls and the like: a null source is a source of its own, named "null".  A target
that no row has is left out and the rest scaled up; a source without a target, or
with a weight of 0, comes after all the others, in proportion to size.  Negative
weights are an error.  Rows of size 0 or null count as size 1.  Equal rows come out
as often as they went in.  No rows: no rows.
"""

from __future__ import annotations

import heapq
import math
from array import array
from collections.abc import Iterator
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import written

SOURCES = 2000
PIECE = 2048
_TABLE = "source string, piece long, slots array<long>, phases array<int>"


def earliest_deadline(parts: dict[str, int], blocks: dict[str, int], length: int) -> list[str]:
    """The source of each slot by earliest deadline among the released blocks
    (ties: the heavier source, then by name), for weights in proportion to
    ``parts``, up to the slot in which a source has had all its blocks, and for
    ``length`` slots at most."""
    period = sum(parts.values())
    coming = [(0, s, 1) for s in sorted(parts)]
    heapq.heapify(coming)
    ready: list = []
    out = []
    for slot in range(length):
        while coming and coming[0][0] <= slot:
            _, s, j = heapq.heappop(coming)
            heapq.heappush(ready, (-(-j * period // parts[s]), -parts[s], s, j))
        _, _, s, j = heapq.heappop(ready)
        out.append(s)
        if j == blocks[s]:
            break
        heapq.heappush(coming, (j * period // parts[s], s, j + 1))
    return out


def phases(weights: dict[str, Fraction], blocks: dict[str, int], period: int) -> Iterator[tuple[int, dict, dict, list[str]]]:
    """(first slot, blocks already had, exact targets, source of each slot) of
    each phase; a phase ends with the slot in which one of its sources ends.
    Weights that repeat within ``period`` slots are scheduled for one period."""
    unit = math.lcm(*(w.denominator for w in weights.values()))
    whole = {s: int(w * unit) for s, w in weights.items()}
    had, base = dict.fromkeys(weights, 0), 0
    while live := sorted(s for s in weights if had[s] < blocks[s]):
        common = math.gcd(*(whole[s] for s in live))
        parts = {s: whole[s] // common for s in live}
        total, left = sum(parts.values()), {s: blocks[s] - had[s] for s in live}
        if total <= period:
            again = min((left[s] - 1) // parts[s] for s in live)  # whole periods before the one in which a source ends
            slots = earliest_deadline(parts, dict.fromkeys(live, 0), total) * again
            slots += earliest_deadline(parts, {s: left[s] - again * parts[s] for s in live}, total)
        else:
            slots = earliest_deadline(parts, left, sum(left.values()))
        yield base, dict(had), {s: Fraction(parts[s] * len(slots), total) for s in live}, slots
        for s in slots:
            had[s] += 1
        base += len(slots)


def mix(rows: DataFrame, source_col: str, weights: dict[str, float] | float, block: int, size: Column | None = None,
        period: int = 2000, seed: int = 11) -> DataFrame:
    """``row`` (struct of all columns of ``rows``), phase, block (from 0 in the
    source), slot (from 0) and at (units into the block): sorted by slot and at,
    the rows are the mixed sequence.  ``block`` is a block's size in units of
    ``size`` (rows, if not given).  ``weights`` has a target for each source, or
    is the power of the sources' sizes that gives the targets."""
    if isinstance(weights, dict) and any(w < 0 for w in weights.values()):
        raise ValueError("weights must not be negative")
    spark = rows.sparkSession
    units = F.lit(1).cast("long") if size is None else F.greatest(F.coalesce(size.cast("long"), F.lit(1)), F.lit(1))
    columns = [rows[c] for c in rows.columns]
    buckets = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keyed = (rows.select(F.struct(*columns).alias("row"), F.coalesce(rows[source_col].cast("string"), F.lit("null")).alias("source"),
                         units.alias("units"), F.xxhash64(*columns, F.lit(seed)).alias("key"))
             .withColumn("bucket", F.floor(F.shiftrightunsigned("key", 32) * buckets / float(1 << 32)).cast("int")))
    sums = written(keyed.groupBy("source", "bucket").agg(F.sum("units").alias("units")), "mix-sums")  # sources * buckets rows
    totals = {r["source"]: r["units"] for r in sums.groupBy("source").agg(F.sum("units").alias("units")).limit(SOURCES + 1).collect()}
    if len(totals) > SOURCES:
        raise ValueError(f"{source_col} has more than {SOURCES} values")
    blocks = {s: -(-n // block) for s, n in totals.items()}
    wanted = weights if isinstance(weights, dict) else {s: n ** weights for s, n in totals.items()}
    targets = {s: Fraction(w) for s, w in wanted.items() if s in blocks and w > 0}
    others = {s: Fraction(n) for s, n in blocks.items() if s not in targets}
    slot_of, phase_of, slot, number = {s: array("q") for s in blocks}, {s: array("i") for s in blocks}, 0, 0
    for group in (targets, others):
        for _, _, _, slots in phases(group, blocks, period):
            for s in slots:
                slot_of[s].append(slot)
                phase_of[s].append(number)
                slot += 1
            number += 1
    table = [(s, lo // PIECE, slot_of[s][lo:lo + PIECE].tolist(), phase_of[s][lo:lo + PIECE].tolist())
             for s in sorted(blocks) for lo in range(0, blocks[s], PIECE)]

    before = lambda w: F.coalesce(F.sum("units").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sums.select("source", "bucket", before(Window.partitionBy("source").orderBy("bucket")).alias("offset"))
    placed = (keyed.withColumn("start", before(Window.partitionBy("source", "bucket").orderBy("key")))
              .join(F.broadcast(offsets), ["source", "bucket"])  # at most SOURCES * buckets rows
              .withColumn("start", F.col("start") + F.col("offset")).withColumn("block", F.floor(F.col("start") / block)))
    lookup = F.broadcast(spark.createDataFrame(table, _TABLE).withColumnRenamed("source", "of"))
    nth = (F.col("block") % PIECE + 1).cast("int")
    return (placed.join(lookup, (F.col("source") == F.col("of")) & (F.floor(F.col("block") / PIECE) == F.col("piece")))
            .select("row", F.element_at("phases", nth).alias("phase"), "block", F.element_at("slots", nth).alias("slot"),
                    (F.col("start") - F.col("block") * block).alias("at")))
