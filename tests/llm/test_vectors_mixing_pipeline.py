"""Neighbours, mixing and the pipeline against brute force."""

import random
from fractions import Fraction

import numpy as np
import pytest

import brute
import corpus_pipeline
from tessera.llm import ann, mixing
from tessera.llm.queries import QUERIES
from tessera.llm.scratch import written

SF = "/root/testdata/sf0.001"


def neighbours(rows, queries, k):
    """{query id: [(id, score)]} by brute force over (id, vector)."""
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, x in ok:
        if q in queries:
            best = out.setdefault(q, {})
            for i, y in ok:
                if i != q and len(y) == len(x):
                    best[i] = max(best.get(i, -9), float(x @ y / np.sqrt((x @ x) * (y @ y))))
    return {q: sorted(((i, s) for i, s in b.items()), key=lambda t: (-round(t[1], 12), t[0]))[:k] for q, b in out.items()}


def found(frame):
    out = {}
    for r in frame.collect():
        out.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    return {q: [b[i + 1] for i in range(len(b))] for q, b in out.items()}


def same(got, expected):
    assert got.keys() == {q for q, b in expected.items() if b}
    for q, own in got.items():
        assert [i for i, _ in own] == [i for i, _ in expected[q]]
        assert np.allclose([s for _, s in own], [s for _, s in expected[q]], atol=1e-12)


def test_neighbours_match_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    same(found(QUERIES["op3_block_matrix_ann"](spark, SF)), neighbours(rows, {i for i, _ in rows if i % 50 == 0}, 5))


@pytest.mark.parametrize("block", [16384, 7])
def test_neighbours_edge_cases(spark, block):
    rng = np.random.default_rng(2)
    rows = [(i, rng.integers(-3, 4, 6).astype(float).tolist()) for i in range(150)]
    rows += [(200, [0.0] * 6), (201, None), (202, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (203, [float("nan")] * 6), (204, [float("inf")] + [1.0] * 5), (205, []),
             (None, [1.0] * 6), (210, [1e300, -1e300, 0.0, 0.0, 0.0, 1e300]), (220, [1.0, 2.0]), (230, [2.0, 4.0]), (0, [9.0, 9.0, 9.0, 9.0, 9.0, 9.0])]
    rows += [(300 + i, [1.0, 2.0, 3.0, 1.0, 1.0, 1.0]) for i in range(20)]  # one vector many times
    schema = "vec_id long, embedding array<double>, score string"
    frame = spark.createDataFrame([(*r, "clash") for r in rows], schema)
    from pyspark.sql import functions as F
    same(found(ann.nearest_neighbours(frame, F.col("vec_id") % 10 == 0, block=block)),
         _scaled(rows))
    assert ann.nearest_neighbours(frame.where("false"), F.col("vec_id") % 10 == 0).count() == 0


def test_neighbours_where_an_id_repeats(spark):
    from pyspark.sql import functions as F
    rows = [(0, [1.0, 0.0])] + [(1, [1.0, 0.1 + i / 1000]) for i in range(40)] + [(i, [1.0, float(i)]) for i in range(2, 9)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    got = found(ann.nearest_neighbours(frame, F.col("vec_id") == 0))
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5]
    same(got, neighbours(rows, {0}, 5))


def _scaled(rows):
    small = [(i, [x / 1e300 for x in v] if i == 210 else v) for i, v in rows]
    return neighbours(small, {i for i, _ in rows if i is not None and i % 10 == 0}, 5)


def test_schedule_stays_within_a_block():
    rng = random.Random(1)
    for _ in range(30):
        names = [f"s{i}" for i in range(rng.randint(1, 8))]
        weights = {s: Fraction(rng.randint(1, 50)) for s in names}
        blocks = {s: rng.randint(1, 300) for s in names}
        had, spans = dict.fromkeys(names, 0), list(mixing.phases(weights, blocks, 100))
        for i, (start, before, parts, slots) in enumerate(spans):
            assert before == had
            end = (spans[i + 1][0] if i + 1 < len(spans) else sum(blocks.values())) - start
            count = dict.fromkeys(parts, 0)
            for t in range(end):
                count[slots[t % len(slots)]] += 1
                assert all(abs(count[s] - Fraction(parts[s], len(slots)) * (t + 1)) < 1 for s in parts)
            for s in parts:
                had[s] += count[s]
        assert had == blocks


def test_schedule_stays_within_a_block_of_the_exact_weights():
    many = {f"s{i}": Fraction(1, 2 * 1499) for i in range(1499)} | {"half": Fraction(1, 2)}
    for weights, blocks in ((dict(a=Fraction(0.5 ** 0.5), b=Fraction(3 ** -0.5), c=Fraction(1, 9_000)), dict(a=60_000, b=60_000, c=60_000)),
                            (dict(a=Fraction(1, 3), b=Fraction(1, 3_001)), dict(a=20_000, b=20_000)), (many, dict.fromkeys(many, 4_000))):
        (start, before, _, slots), count = next(mixing.phases(weights, blocks, 2000)), dict.fromkeys(weights, 0)
        assert start == 0 and not any(before.values())
        total, some = sum(weights.values()), sorted(weights)[:3]
        for t, s in enumerate(slots, 1):
            count[s] += 1
            assert all(abs(count[s] - float(weights[s] * t / total)) < 1 for s in (some if t % 1000 else weights))
        assert max(count.values()) == max(blocks.values())


def check_mix(rows, got, size, block):
    """Every row once; blocks of a source in order; a slot has one block."""
    assert sorted(str(r.row) for r in got) == sorted(map(str, rows))
    owner, starts = {}, {}
    for r in got:
        assert owner.setdefault(r.slot, (r.row.source, r.block)) == (r.row.source, r.block)
        starts.setdefault(r.row.source, []).append((r.block * block + r["at"], r.slot, size(r.row)))
    for own in starts.values():
        own.sort()
        assert [s for s, _, _ in own] == [sum(n for _, _, n in own[:i]) for i in range(len(own))]
        assert [slot for _, slot, _ in own] == sorted(slot for _, slot, _ in own)


def test_mix_matches_its_definition(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice("aaab") if i % 9 else None, rng.choice([None, 0, 1, 5, 40]), "x") for i in range(300)] + [(7, "b", 5, "x")] * 4
    frame = spark.createDataFrame(rows, "doc_id long, source string, n int, slot string")
    from pyspark.sql import functions as F
    size = lambda r: max(1, r.n or 1)
    for weights, unit, block in (({"a": 0.7, "b": 0.2, "null": 0.1, "gone": 5.0}, F.col("n"), 30), ({"b": 1.0}, None, 4), (0.5, F.col("n"), 10)):
        got = mixing.mix(frame, "source", weights, block, unit).collect()
        check_mix(frame.collect(), got, size if unit is not None else (lambda r: 1), block)
        if weights == {"b": 1.0}:  # sources without a target come last
            assert max(r.slot for r in got if r.row.source == "b") < min(r.slot for r in got if r.row.source != "b")
    assert mixing.mix(frame.where("false"), "source", 0.5, 10).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(frame, "source", {"a": -1.0}, 10)


def test_mix_query_keeps_every_document(spark, docs_rows):
    got = QUERIES["op1_pfair_mix"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs_rows)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(100_001, None, "en", "src1", 0), (100_002, "", None, None, None), (100_003, "123 !!", "en", "src1", 6),
                                   (100_004, docs.first().text, "en", "src1", 5), (100_004, docs.first().text, "en", "src1", 5)], docs.schema)
    docs, columns, kept = docs.union(extra), docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = written(stage(spark, docs, SF), "test-stage")
        rows = docs.collect()
        after = {r.doc_id for r in rows}
        kept.append(len(after))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        if name == "language ID":
            assert before.keys() - after == {i for i, t in before.items() if not any(c.isalpha() for c in t or "")}
        elif name == "n-gram Jaccard join":
            ids = sorted(before)
            assert after == {ids[c] for _, c in brute.jaccard_components([before[i] for i in ids])} and len(rows) == len(after)
        elif name == "benchmark decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            dirty = {i for i, t in before.items() for n, hit, _ in [brute.contamination(t, items)] if hit and 20 * hit >= n}
            assert before.keys() - after == dirty and dirty
        elif name.startswith("mixing"):
            assert after == before.keys() and len({(r.slot, r["at"]) for r in rows}) == len(rows)
    empty = docs.select(*columns).where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_near_copies_go_by_row_and_not_by_id(spark):
    words = lambda tag: " ".join(f"{tag}{i}" for i in range(30))
    rows = [(3, words("a")), (5, words("a")), (5, words("b")), (None, words("c")), (None, words("d")), (None, words("d")), (None, words("b")),
            (7, words("e")), (7, words("f")), (8, None), (8, None), (9, words("a") + " more")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], spark.read.parquet(f"{SF}/documents.parquet").schema)
    for n in (1, 5):
        got = corpus_pipeline.drop_near_copies(spark, docs.repartition(n), SF)
        assert got.columns == docs.columns
        assert sorted((str(r.doc_id), str(r.text)[0]) for r in got.collect()) == sorted(
            [("3", "a"), ("5", "b"), ("None", "c"), ("None", "d"), ("7", "e"), ("7", "f"), ("8", "N"), ("8", "N")])
