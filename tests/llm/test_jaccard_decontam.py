"""Set joins against brute force, and their edge cases."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import brute
from tessera.llm import decontam
from tessera.llm import textbatch as tb
from tessera.llm.jaccard import jaccard_components, set_digest, signature, slack

SF = "/root/testdata/sf0.001"
ALPHABET = "aB \n\té€x0.-\x00Z"


def components(spark, rows, schema="doc_id long, text string", **options):
    got = jaccard_components(spark.createDataFrame(rows, schema), **options).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(ALPHABET, max_size=60)), max_size=12), st.integers(1, 40))
def test_word_hashes_match_regex_words(texts, run_bytes):
    import pyarrow as pa
    for table, words in ((tb.SPACED, brute.spaced), (tb.ALNUM, brute.alnum)):
        by_word, rows = {}, 0
        for run in tb.runs(pa.array(texts, pa.string()), table, run_bytes=run_bytes):
            for i in range(run.rows):
                own = run.word[run.first[i]:run.first[i + 1]].tolist()
                expected = words(texts[run.row0 + i])
                assert len(own) == len(expected)
                assert all(by_word.setdefault(w, h) == h for w, h in zip(expected, own))
                rows += 1
        assert rows == len(texts) and len(set(by_word.values())) == len(by_word)


def test_long_text_is_hashed_in_pieces():
    import pyarrow as pa
    text = "A" * 6_000_000 + " b " * 700_000
    (run,) = tb.runs(pa.array([text]), tb.SPACED)
    assert len(run.word) == 700_001 and len(np.unique(run.word)) == 2


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=80), st.sets(st.integers(0, 2**64 - 1), max_size=80), st.data())
def test_bitmap_bound_never_rules_out_a_link(a, extra, data):
    b = {x for x in a if data.draw(st.booleans())} | extra or {1}
    u, v = (np.array(sorted(s), np.uint64) for s in (a, b))
    spare = slack(signature(u)[None], np.array([len(u)]), signature(v)[None], np.array([len(v)]), 75)[0]
    common = len(a & b)
    assert spare >= 175 * common - 75 * (len(a) + len(b))
    assert (set_digest(u) == set_digest(v)) == (a == b)


def test_components_match_brute_force(spark, docs_rows):
    ids = sorted(docs_rows)
    expected = [(i, n, ids[c]) for i, (n, c) in zip(ids, brute.jaccard_components([docs_rows[i].text for i in ids]))]
    got = jaccard_components(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == expected


def test_near_copy_groups_and_chains_match_brute_force(spark):
    rng = random.Random(4)
    texts = []
    for _ in range(6):  # families that drift, so that some links only exist by way of others
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice((6, 20, 60, 200)))]
        for _ in range(40):
            base[rng.randrange(len(base))] = f"w{rng.randrange(400)}"
            texts.append(" ".join(base))
    common = " ".join(f"c{i}" for i in range(30))
    texts += [f"{common} x{i} y{i} z{i}" for i in range(60)]  # one frequent passage, nearly all of each text
    expected = [(i, n, c) for i, (n, c) in enumerate(brute.jaccard_components(texts))]
    assert components(spark, list(enumerate(texts))) == sorted(expected, key=str)


def test_tile_blocks_keep_all_links(spark, monkeypatch):
    import tessera.llm.jaccard as j
    monkeypatch.setattr(j, "TILE", 7)
    rng = random.Random(5)
    common = [f"c{i}" for i in range(40)]
    texts = [" ".join([*common, *(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(14)))]) for _ in range(80)]
    expected = [(i, n, c) for i, (n, c) in enumerate(brute.jaccard_components(texts))]
    assert components(spark, list(enumerate(texts))) == sorted(expected, key=str)


def test_long_sets_near_the_threshold_match_brute_force(spark):
    """Heavily edited copies of long texts: many pairs just above and below the threshold, signatures of many widths."""
    rng = random.Random(9)
    texts = []
    for size in (90, 700, 3000):
        base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        for share in (0.0, 0.01, 0.02, 0.025, 0.03, 0.03, 0.035, 0.04, 0.05):
            texts.append(" ".join(f"e{rng.randrange(10**6)}" if rng.random() < share else w for w in base))
    expected = [(i, n, c) for i, (n, c) in enumerate(brute.jaccard_components(texts))]
    assert components(spark, list(enumerate(texts))) == sorted(expected, key=str)


def test_jaccard_edge_cases(spark):
    rows = [(1, None, 9), (2, "", 9), (3, " \t", 9), (4, "A b", 9), (5, "a B", 9), (5, "a B", 9), (None, "a b", 9), (7, "a b c d e f", 9)]
    got = components(spark, rows, "doc_id long, text string, n int")
    assert got == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (5, 1, 4), (None, 1, 4), (7, 2, 7)], key=str)
    assert components(spark, []) == []
    with pytest.raises(ValueError):
        components(spark, [], percent=10)


def hits(spark, docs, items, **options):
    frame = spark.createDataFrame(docs, "doc_id long, text string, n_words string")
    got = decontam.contamination(frame, spark.createDataFrame(items, "item_id long, text string"), carry=["doc_id"], **options)
    return {r.row.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got.collect()}


def expected_hits(docs, items):
    out = {}
    for i, text, _ in docs:
        n, hit, found = brute.contamination(text, [("null" if k is None else k, t) for k, t in items])
        out[i] = (n, hit, len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), hit > 0 and 20 * hit >= n)
    return out


@pytest.mark.parametrize("block_windows", [500_000, 60])
def test_contamination_matches_brute_force(spark, docs_rows, block_windows):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = [(i, r.text, "clash") for i, r in docs_rows.items()]
    if block_windows == 60:
        items, docs = items[:6], docs[:60]
    assert hits(spark, docs, items, block_windows=block_windows) == expected_hits(docs, items)


def test_contamination_edge_cases(spark):
    long = " ".join(f"w{i}" for i in range(40))
    items = [(1, long), (1, long), (2, "short ITEM"), (3, None), (4, "..."), (None, "é ü"), (6, "a a a a a a a a a a a a a a a a a")]
    docs = [(1, None, ""), (2, "", ""), (3, "x " + long + " y", ""), (4, "a short item, É ü é ü", ""), (5, " ".join(f"w{i}" for i in range(12)), ""),
            (6, "a " * 60, ""), (7, ("z " * 400) + long, ""), (8, "w3 " * 50 + " ".join(f"w{i}" for i in range(5, 18)), "")]
    assert hits(spark, docs, items) == expected_hits(docs, items)
    assert hits(spark, docs, []) == expected_hits(docs, [])
    assert hits(spark, [], items) == {}


def test_tiles_give_a_pair_at_its_first_common_shingles_only():
    """Every link comes out; a pair far from the threshold does not meet again in each tile of a shared shingle."""
    from types import SimpleNamespace

    import pyarrow as pa
    from tessera.llm.jaccard import SKETCH_BITS, _prefixes, _tiles
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(50):  # from near copies to texts that share two thirds of the passage
        own = list(base)
        for at in rng.sample(range(len(own)), rng.choice((0, 1, 2, 4, 6))):
            own[at] = f"x{i}_{at}"
        texts.append(" ".join(own))
    sets = {set_digest(u): set(u.tolist()) for run in tb.runs(pa.array(texts), tb.SPACED) for _, u in tb.shingle_sets(run, 5)}
    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    for u in sets.values():
        for x in u:
            counts[x >> (64 - SKETCH_BITS)] += 1
    heavy = SimpleNamespace(value=np.where(counts >= 8, counts, 0))
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    tiles = {}
    for out in _prefixes(5, 75, heavy, iter([batch])):
        for token, s, rest in zip(*(c.to_pylist() for c in out.columns)):
            tiles.setdefault(token, {})[s] = rest
    given, shared = [], 0
    for token, rows in tiles.items():
        own = sorted(rows, key=lambda s: len(sets[s]))
        shared += len(own) * (len(own) - 1) // 2
        one = pa.RecordBatch.from_pydict({
            "token": pa.array([token] * len(own), pa.int64()), "bi": pa.array([0] * len(own), pa.int32()), "bj": pa.array([0] * len(own), pa.int32()),
            "set_id": pa.array(own, pa.int64()), "n": pa.array([len(sets[s]) for s in own], pa.int32()), "rest": pa.array([rows[s] for s in own], pa.int32()),
            "comp": pa.array(own, pa.int64()), "block": pa.array([0] * len(own), pa.int32()),
            "sig": pa.array([signature(np.array(sorted(sets[s]), np.uint64)).tobytes() for s in own], pa.binary())})
        for got in _tiles(75, False, iter([one])):
            given += zip(got.column("a").to_pylist(), got.column("b").to_pylist())
    ids = sorted(sets)
    links = {(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert links <= set(given) and len(links) > 50
    assert 3 * len(given) < shared


@pytest.mark.parametrize("rows_a_batch", [1, 3, 7, 100, 10_000])
def test_shingles_of_few_sets_give_each_pair_once_and_no_rows(rows_a_batch):
    """Only shingles of many sets go on as rows, for which signatures travel; where batches end makes no difference."""
    import pyarrow as pa
    from tessera.llm.jaccard import LISTED, _shared
    rng = random.Random(6)
    sizes = [1, 2, LISTED - 1, LISTED, LISTED + 1, 40, 1, 3] * 4
    rests = {(t, s): rng.randrange(60, 100) for t, n in enumerate(sizes) for s in rng.sample(range(50), n)}
    rows = sorted((t, s, r) for (t, s), r in rests.items() for _ in range(rng.choice((1, 1, 3))))  # copies of a text repeat rows
    batches = [pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[i:i + rows_a_batch]), (pa.int64(), pa.int64(), pa.int32()))],
                                          ["token", "set_id", "rest"]) for i in range(0, len(rows), rows_a_batch)]
    got = [r for b in _shared(75, iter(batches)) for r in b.to_pylist()]
    large = [(r["token"], r["set_id"], r["rest"]) for r in got if r["other"] is None]
    assert sorted(large) == [(t, s, r) for (t, s), r in sorted(rests.items()) if sizes[t] > LISTED]
    expected = {}
    for t, n in enumerate(sizes):
        own = sorted(s for u, s in rests if u == t) if n <= LISTED else []
        for i, a in enumerate(own):
            for b in own[i + 1:]:
                low, high = sorted((rests[t, a], rests[t, b]))
                if 100 * low >= 75 * high:
                    expected[a, b] = max(low, expected.get((a, b), 0))
    pairs = [(r["set_id"], r["other"], r["rest"]) for r in got if r["other"] is not None]
    assert sorted(pairs) == [(*p, r) for p, r in sorted(expected.items())]
