import math
import random
from pathlib import Path

import numpy as np
import pytest

from slotwise.llm.common import ship
from slotwise.llm.embedding_whitening import leading, polar, whiten
from slotwise.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def symmetric(values, seed=1):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return (q * np.array(values, float)) @ q.T


@pytest.mark.parametrize(
    "values",
    [
        [3, 1, -2, 0.5], [5, 5, 5, 1, 1], [1e8, 1, 1e-6, 0], [1, 1 + 1e-9, 2, 3], [0, 0, 0], [7], [-1, 0, 1], [4] * 6,
        list(range(40)), [2.0**-k for k in range(50)], [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13],
    ],
)
def test_components_by_divide_and_conquer(values):
    for matrix in (symmetric(values), np.diag(np.array(values, float))):
        got, vectors = leading(matrix, 8)
        want = np.sort(np.linalg.eigvalsh(matrix))[::-1][:8]
        size = max(1e-300, np.abs(values).max())
        assert np.abs(got - want).max() <= 1e-13 * size * len(values)
        assert np.abs(matrix @ vectors - vectors * got).max() <= 1e-12 * size
        assert np.abs(vectors.T @ vectors - np.eye(len(got))).max() <= 1e-13


def test_polar_factor_is_the_sign():
    matrix = symmetric([5, 1e-9, -3, -1e-7, 2])
    u = polar(matrix)
    assert np.abs(u @ u - np.eye(5)).max() < 1e-12 and np.trace(u) == pytest.approx(1)


def plain(rows, most=8):
    """n, deviations, whitened up to sign, shares: exact whole numbers and a library eigensolver."""
    kept = [(i, v) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    x = [[math.floor(1024 * c) + 100000 for c in v] for _, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in x]
    z = np.array([[(n * a - s) / n for a, s in zip(v, sums)] for v in x])
    covariance = z.T @ z / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    return [i for i, _ in kept], n, deviation, z @ vectors / np.sqrt(values), values / np.trace(covariance)


def held(df, rows):
    ids, n, deviation, want, share = plain(rows)
    collected = df.collect()
    got = {(r.vec_id, r.component): r for r in collected}
    assert len(collected) == len(ids) * want.shape[1] and set(got) == {(i, k + 1) for i in ids for k in range(want.shape[1])}
    for k in range(want.shape[1]):
        mine = np.array([got[i, k + 1].whitened for i in ids])
        assert min(np.abs(mine - want[:, k]).max(), np.abs(mine + want[:, k]).max()) < 1e-6
        assert got[ids[0], k + 1].explained == pytest.approx(share[k], rel=1e-9)
    assert [int(got[i, 1].deviation) for i in ids] == deviation
    assert {r.n for r in got.values()} == {n} and max(r.identity_error for r in got.values()) < 1e-8


def make(spark, rows, kind="double"):
    ship(spark)
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], f"vec_id long, embedding array<{kind}>, n int, whitened string")


def test_whitening_agrees_with_plain_version(spark):
    draw = random.Random(4)
    rows = [(i, [draw.gauss(j, 1 + j) for j in range(12)]) for i in range(150)]
    rows += [(500, None), (501, [math.nan] * 12), (502, [math.inf] + [0.0] * 11), (503, [None] + [1.0] * 11), (504, []), rows[7]]
    held(whiten(make(spark, [*rows, (600, [1.0, 2.0])])), rows)


def test_deviations_beyond_64_bits_are_exact(spark):
    draw = random.Random(5)
    rows = [(i, [draw.uniform(-9e12, 9e12) for _ in range(3)]) for i in range(40)]
    held(whiten(make(spark, rows)), rows)


def test_defined_results_in_the_corners(spark):
    assert whiten(make(spark, [])).count() == whiten(make(spark, [(1, None)])).count() == 0
    one = whiten(make(spark, [(1, [1.0, 2.0])])).collect()
    assert [(r.component, r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in one] == [(1, 1, 0, None, 0.0, 0.0), (2, 1, 0, None, 0.0, 0.0)]
    flat = whiten(make(spark, [(1, [1.0, 5.0]), (2, [3.0, 5.0]), (2, [3.0, 5.0]), (None, [1.0, 5.0])], "float")).collect()
    by = {r.component: [x for x in flat if x.component == r.component] for r in flat}
    assert sorted(round(r.whitened, 9) for r in by[1]) == [-1, -1, 1, 1] and {r.whitened for r in by[2]} == {None}
    assert {r.explained for r in by[1]} == {1.0} and {r.identity_error for r in flat} == {0.0}


@pytest.mark.skipif(not Path(SF).exists(), reason="driver tables are not here")
def test_query_on_the_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    df = QUERIES["op11_embedding_whitening"](spark, SF)
    assert dict(df.dtypes)["deviation"] == "bigint" and dict(df.dtypes)["n"] == "bigint"
    held(df, rows)
