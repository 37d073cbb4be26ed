"""Fitted operators: held-out accuracy, interactions and edge cases."""

import numpy as np
import pytest

from tessera.llm import langid, toxicity
from tessera.llm.queries import QUERIES

SF01 = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang").collect()}
    got = QUERIES["op9_language_ecoc"](spark, SF01).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and docs[r.doc_id] is not None]
    assert len(held) > 100
    assert sum(r.lang_pred == docs[r.doc_id] for r in held) >= 0.97 * len(held)


def test_language_edge_cases(spark):
    rows = [(1, "the cat sat on the mat and the dog", "en", 1.0), (2, "der hund und die katze sind auf dem", "de", 1.0),
            (3, None, "en", 1.0), (4, "", None, 1.0), (5, "12 34 !!", "de", 1.0), (6, "the dog", None, 1.0), (6, "the dog", None, 1.0)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    model = langid.fit(docs)
    got = langid.predict(docs, model).collect()
    assert len(got) == len(rows) and got[0].row.score == 1.0
    named = {r.row.doc_id: (r.lang_pred, r.score) for r in got}
    assert [named[i][0] for i in (1, 2, 3, 4, 5, 6)] == ["en", "de", "und", "und", "und", "en"]
    assert named[3][1] == named[4][1] == named[5][1] == 0.0
    empty = docs.where("false")
    assert langid.predict(empty, model).count() == 0
    untaught = langid.predict(docs, langid.fit(empty)).collect()
    assert {r.lang_pred for r in untaught} == {"und"}
    one = langid.predict(docs, langid.fit(docs.where("lang = 'en'"))).collect()
    assert {(r.lang_pred, r.score) for r in one} == {("en", 1.0), ("und", 0.0)}


def test_language_long_text_in_pieces_is_the_sum_of_its_ngrams(spark):
    text = "the cat and the dog " * 40_000
    docs = spark.createDataFrame([(1, text, "en"), (2, "der hund und die katze " * 30, "de")], "doc_id long, text string, lang string")
    assert {r.row.doc_id: r.lang_pred for r in langid.predict(docs, langid.fit(docs)).collect()} == {1: "en", 2: "de"}


@pytest.mark.parametrize("k", [2, 4, 7, 12, 40])
def test_codewords_are_distinct_and_every_bit_splits(k):
    code = langid.code_matrix(k)
    assert len({tuple(r) for r in code}) == k
    assert (np.abs(code.sum(axis=0)) < k).all()


def test_machine_learns_a_pair_that_no_single_term_shows():
    rng = np.random.default_rng(1)
    a, b = rng.random(4000) < 0.3, rng.random(4000) < 0.3
    y = (a & b).astype(int)
    x = [np.flatnonzero([a[i], b[i], *(rng.random(6) < 0.3)]) for i in range(len(y))]
    terms = np.arange(8, dtype=np.int64)
    score = {}
    for name, single in (("pairs", np.zeros(8, bool)), ("both", np.ones(8, bool))):
        m = toxicity.train(x, y, terms, single)
        row, term = np.repeat(np.arange(len(x)), [len(t) for t in x]), np.concatenate(x)
        score[name] = m.scores(row, term, len(x))
        assert ((score[name] >= 0.5) == (y == 1)).mean() > 0.97
    m = toxicity.train(x, y, terms, np.ones(8, bool))
    alone = m.scores(np.array([0, 1, 2, 2]), np.array([0, 1, 0, 1]), 3)
    assert alone[0] < 0.5 and alone[1] < 0.5 and alone[2] > 0.5


def test_toxicity_held_out(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    got = QUERIES["op2_toxicity_fm"](spark, SF01).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    held = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert sum(p == 1 for p, y in held if y == 0) <= 0.02 * len(held)
    assert sum(p == 1 for p, y in held if y == 1) >= 0.6 * sum(y == 1 for _, y in held)


def test_toxicity_edge_cases(spark):
    rows = [(i, ("vile scum " if i % 4 == 0 else "nice day ") + f"word{i} other{i % 5}", 0.5) for i in range(200)]
    rows += [(900, None, 0.5), (901, "", 0.5), (902, "scum", 0.5), (902, "scum", 0.5), (None, "scum", 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)] + [(900, 1), (5, None)], "doc_id long, toxic int")
    machine = toxicity.fit(docs, labels)
    got = toxicity.score(docs, machine).collect()
    assert len(got) == len(rows)
    by = {r.row.doc_id: r.score for r in got}
    assert by[0] > 0.7 and by[1] < 0.3 and by[None] > 0.5 and by[900] == by[901]
    assert toxicity.score(docs.where("false"), machine).count() == 0
    for none in (labels.where("false"), labels.where("toxic = 0")):
        assert all(r.score < 1e-6 for r in toxicity.score(docs, toxicity.fit(docs, none)).collect())
    assert all(r.score > 1 - 1e-6 for r in toxicity.score(docs, toxicity.fit(docs, labels.where("toxic = 1"))).collect())


def test_toxicity_sample_has_one_text_an_id(spark, monkeypatch):
    rows = [(i, ("vile scum " if i % 4 == 0 else "nice day ") + f"other{i % 5}") for i in range(100)]
    rows += [(None if i % 2 else 4, f"flood other{i % 5}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(100)] + [(None, 0)], "doc_id long, toxic int")
    fitted, train = [], toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda x, y, *a, **b: fitted.append(y) or train(x, y, *a, **b))
    by = {r.row.text: r.score for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert len(fitted[0]) == 101 and fitted[0].sum() == 25
    assert by["vile scum other3"] > 0.7 and by["nice day other1"] < 0.3
