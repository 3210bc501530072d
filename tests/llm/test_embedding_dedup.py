import math
import random

import numpy as np
import pytest

from slotwise.llm.common import ship
from slotwise.llm.embedding_dedup import near_vectors, quantised, unit, upper_bounds

from tests.llm.test_simhash_dedup import plain_roots

SCHEMA = "vec_id long, embedding array<double>, label int, node string, copies int"


def table(spark, rows, schema=SCHEMA):
    ship(spark)
    return spark.createDataFrame([(*r, "x", 7) for r in rows], schema)


def fine(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def cosine(a, b):
    a, b = (np.array(x, float) / np.abs(x).max() for x in (a, b))
    return float(a @ b / math.sqrt(a @ a) / math.sqrt(b @ b))


def plain(rows, least=0.93):
    """Every pair, one after the other."""

    def linked(a, b):
        (_, x, p), (_, y, q) = rows[a], rows[b]
        return p is not None and p == q and fine(x) and fine(y) and len(x) == len(y) and cosine(x, y) >= least

    pairs = [[a != b and linked(a, b) for b in range(len(rows))] for a in range(len(rows))]
    roots = plain_roots(len(rows), lambda a, b: pairs[a][b])
    out = []
    for k, (vec_id, *_) in enumerate(rows):
        ids = [rows[m][0] for m in range(len(rows)) if roots[m] == roots[k] and rows[m][0] is not None]
        component = min(ids, default=None)
        out.append((vec_id, sum(pairs[k]), component, vec_id == component))
    return out


def near(draw, centre, spread):
    return [c + draw.gauss(0, spread) for c in centre]


def key(row):
    return tuple((v is None, v) for v in row)


def some_rows():
    draw = random.Random(3)
    rows, k = [], 0
    for label in (0, 1, 2):
        for _ in range(12):
            centre = [draw.gauss(0, 1) for _ in range(16)]
            for _ in range(draw.choice([1, 2, 5])):
                rows.append((k, near(draw, centre, draw.choice([0.02, 0.25, 0.4])), label))
                k += 1
    rows += [(900 + i, rows[0][1], 0) for i in range(20)] + [rows[0], rows[1]]
    rows += [(950, [2.5 * x for x in rows[0][1]], 0), (951, rows[0][1], 1), (952, rows[0][1], None)]
    rows += [(960, None, 0), (961, [], 0), (962, [0.0] * 16, 0), (963, [float("nan")] * 16, 0), (964, [float("inf")] + [1.0] * 15, 0)]
    rows += [(965, [None] + [1.0] * 15, 0), (966, [1e300] * 16, 1), (967, [1e-300] * 16, 1), (968, [1.0] * 3, 1), (969, [2.0] * 3, 1)]
    return rows + [(None, [1.0] * 16, 2), (None, [3.0] * 16, 2), (None, [-1.0] * 16, 2)]


@pytest.mark.parametrize("cells", [64, 1 << 18])
def test_links_agree_with_brute_force(spark, cells):
    rows = some_rows()
    got = [tuple(r) for r in near_vectors(table(spark, rows), cells=cells).collect()]
    assert sorted(got, key=key) == sorted(plain(rows), key=key)


def test_a_dense_group_over_many_tiles(spark):
    draw = random.Random(9)
    centre = [draw.gauss(0, 1) for _ in range(8)]
    rows = [(i, near(draw, centre, 0.3), 4) for i in range(300)]
    got = [tuple(r) for r in near_vectors(table(spark, rows), cells=8 * 40).collect()]
    assert sorted(got) == sorted(plain(rows))


def test_float_vectors_and_empty_table(spark):
    schema = SCHEMA.replace("double", "float")
    rows = [(1, [1.0, 0.0], 1), (2, [0.5, 0.0], 1), (3, [0.0, 1.0], 1)]
    got = sorted(tuple(r) for r in near_vectors(table(spark, rows, schema)).collect())
    assert got == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
    assert near_vectors(table(spark, [], schema)).count() == 0


@pytest.mark.parametrize("size", [1, 7, 64, 1500])
def test_bounds_hold(size):
    units = unit(np.random.default_rng(size).standard_normal((60, size)))
    forms = quantised(units)
    bounds = upper_bounds(forms, forms)
    true = units @ units.T
    assert (bounds + 1e-5 >= true).all() and (bounds - true).max() < 0.1
