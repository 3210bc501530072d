import random
from pathlib import Path

import numpy as np
import pytest

from slotwise.llm.common import fold
from slotwise.llm.quality import STATISTICS, isotonic, score_quality, statistics
from slotwise.llm.toxicity import score_toxicity, unlike, without_toxic

from tests.llm.conftest import words

SF = Path("/root/testdata/sf0.01")


def labels(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, quality int, toxic int, text string")


def held_out_shares(scored, truth, column):
    rows = scored.filter("held_out").join(truth.filter(f"{column} IS NOT NULL"), "doc_id").collect()
    right = np.mean([r.predicted == r[column] for r in rows])
    ones, zeros = ([r.score for r in rows if r[column] == y] for y in (1, 0))
    order = np.mean([(a > b) + 0.5 * (a == b) for a in ones for b in zeros])
    return right, order


@pytest.mark.skipif(not SF.exists(), reason="driver tables are not here")
def test_quality_of_held_out_documents(spark, make):
    truth = spark.read.parquet(f"{SF}/labels.parquet")
    scored = score_quality(spark.read.parquet(f"{SF}/documents.parquet"), truth, fold(3) == 1)
    right, order = held_out_shares(scored, truth, "quality")
    assert right > 0.95 and order > 0.98


def toxic_corpus():
    draw = random.Random(8)
    insults = ["gruvak", "gruvatig", "blarnu", "blarnuster", "snorf"]
    rows, marks = [], []
    for i in range(400):
        text = words(60, i, 4000).split()
        toxic = i % 8 == 0
        for _ in range(3 * toxic):
            text.insert(draw.randrange(60), draw.choice(insults))
        rows.append((i, " ".join(text)))
        marks.append((i, None, int(toxic)))
    return rows, marks


def test_toxicity_of_held_out_documents(spark, make):
    rows, marks = toxic_corpus()
    # Copies of one toxic text are no evidence for all its words.
    copies = [(1000 + i, rows[0][1]) for i in range(60)]
    marks += [(1000 + i, None, 1) for i in range(60)]
    truth = labels(spark, marks)
    scored = score_toxicity(make(rows + copies), truth, fold(5) == 0)
    right, order = held_out_shares(scored, truth, "toxic")
    assert right > 0.97 and order > 0.98
    kept = without_toxic(make(rows), truth, fold(5) == 0)
    assert kept.columns == ["doc_id", "text", "kept", "h"]
    left = {r.doc_id for r in kept.collect()}
    clean = {i for i in range(400) if i % 8}
    assert len(clean - left) <= 4 and len(left - clean) <= 4


@pytest.mark.parametrize("score", [score_quality, score_toxicity])
def test_odd_rows(spark, make, score):
    docs = make([(1, None), (2, ""), (3, "one"), (None, "a b"), (4, words(60_000, 1)), (3, "one"), (6, "\x00 \n")])
    truth = labels(spark, [(1, 1, 1), (3, 0, 0), (3, None, None), (None, 1, 1), (99, 1, 0), (4, 1, 0)])
    got = score(docs, truth, fold(5) == 0).collect()
    assert len(got) == 7
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    nothing = score(docs, labels(spark, []), fold(5) == 0).collect()
    assert [(r.score, r.predicted) for r in nothing] == [(0.5, 1)] * 7
    assert score(make([]), truth, fold(5) == 0).count() == 0


def test_toxic_filter_without_labels_keeps_all(spark, make):
    docs = make([(1, "a"), (2, None)])
    assert without_toxic(docs, labels(spark, []), fold(5) == 0).count() == 2


def test_statistics():
    assert statistics("").tolist() == [0.0] * len(STATISTICS) == statistics(" \n").tolist()
    for text in ("a", "A!! B!!\n\nA!! B!!", "1 2 3 | # é", "x" * 100_000):
        assert np.isfinite(statistics(text)).all()


def test_isotonic_regression_pools_violators():
    x, y = isotonic(np.array([1.0, 2, 3, 4]), np.array([10.0, 10, 10, 10]), np.array([0.0, 6, 4, 10]))
    assert x.tolist() == [1, 2, 3, 4] and (np.diff(y) >= 0).all()
    assert y[1] == y[2] == pytest.approx(10.5 / 21)


def test_one_of_each_group_of_copies_whatever_the_order(spark):
    text = "one two three four five"
    rows = [(3, text, 0), (1, text, 1), (2, text + " six", 0), (9, "", 0), (8, "", 1), (5, "other words", 0), (5, "other words", 1)]
    kept = [
        sorted(tuple(r) for r in unlike(spark.createDataFrame(order, "doc_id long, text string, label int").repartition(3)).collect())
        for order in (rows, rows[::-1])
    ]
    assert kept[0] == kept[1]
    # The sixth word may hold a least hash of its own.
    assert [r for r in kept[0] if r[0] != 2] == [(1, text, 1), (5, "other words", 0), (8, "", 1)]
