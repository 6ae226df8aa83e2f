"""Hard negatives against brute force, and on odd rows."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellwise.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, score string, id string, rows string"


@pytest.mark.parametrize("low, high, dim", [(-150, 150, 64), (-3, 9, 5), (5, 90, 3), (-(2**20), 2**20, 64), (-(2**27), 2**28, 7), (0, 1, 0)])
def test_packed_products_are_exact(low, high, dim):
    draw = np.random.default_rng(5)
    anchors, rows = draw.integers(low, high, (37, dim)), draw.integers(low, high, (101, dim))
    norm = float(np.sqrt((anchors.astype(float) ** 2).sum(axis=1).max()))
    packed = negatives.Packed(rows, norm)
    assert packed.in_doubles == (packed.width <= 53)
    want = [[sum(int(x) * int(y) for x, y in zip(a, r)) for r in rows] for a in anchors]
    assert packed.products(anchors).tolist() == want


def test_several_rows_share_an_integer():
    unit = np.random.default_rng(1).normal(size=(100, 64))
    whole = np.floor(256 * unit / np.linalg.norm(unit, axis=1, keepdims=True)).astype(np.int64)
    assert negatives.Packed(whole, 256.0).fields >= 2


def brute(rows, k=5):
    """All answers, by definition; rows are (id, vector, label), each once."""
    usable = {
        (i, tuple(math.floor(256 * x) for x in v), lab)
        for i, v, lab in rows
        if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    found = []
    for a, v, own in (r for r in usable if r[0] % 100 == 0):
        scored = [
            (-sum(x * y for x, y in zip(v, w)), i, lab) for i, w, lab in usable if len(w) == len(v) and (i, w, lab) != (a, v, own)
        ]
        for less, p, _ in sorted(x for x in scored if x[2] == own)[:k]:
            band = sorted(x for x in scored if x[2] != own and 80 * -less <= 100 * -x[0] <= 100 * -less)
            found += [(a, p, rank + 1, i, -less, -s) for rank, (s, i, _) in enumerate(band[:k])]
    return sorted(found)


def answers(spark, rows, **options):
    vectors = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    got = negatives.mined(vectors, F.col("vec_id") % 100 == 0, **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def drawn(n, seed, labels=3, dim=6):
    rng = random.Random(seed)
    return [(i, [float(np.float32(rng.gauss(0, 0.3))) for _ in range(dim)], rng.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("block", [16, 50, 10_000])
def test_against_brute_force(spark, block):
    rows = drawn(420, 3)
    # A third of the rows are one vector: scores tie within and across labels.
    rows[::3] = [(i, rows[0][1], lab) for i, _, lab in rows[::3]]
    assert answers(spark, rows, block=block) == brute(rows) != []


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = drawn(120, 4)
    odd = [
        (100, None, 1), (100, [nan] * 6, 1), (100, [inf] + [0.5] * 5, 1), (100, [None] + [0.5] * 5, 1), (None, [0.5] * 6, 1),
        (200, [0.5] * 6, None), (300, [], 1), (301, [], 1), (302, [], 2), (400, [0.0] * 6, 1), (500, [0.5] * 3, 0), (501, [0.5] * 3, 0),
        (502, [0.25] * 3, 1), (600, [0.5] * 6, 7), (-100, [0.5] * 6, 2), (100, rows[100][1], rows[100][2]), (7, rows[7][1], rows[7][2]),
    ]
    assert answers(spark, rows + odd) == brute(rows + odd)


def test_a_negative_positive_has_no_negatives(spark):
    rows = [(0, [1.0], 0), (1, [-1.0], 0), (2, [-1.0], 1), (3, [-0.9], 1)]
    assert answers(spark, rows) == []


def test_large_components(spark):
    rows = [(i, [float(2**19) * (i % 7 - 3), float(i), -(2.0**18)], i % 2) for i in range(0, 300, 5)]
    assert answers(spark, rows) == brute(rows) != []


def test_no_rows(spark):
    assert answers(spark, []) == []
    assert answers(spark, [(5, [0.1], 1)]) == []
    assert answers(spark, [(0, [0.1], 1)]) == []
