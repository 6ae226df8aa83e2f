"""Nearest neighbours: what the hashing finds, without any other source of answers."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellwise.llm import neighbours

N, DIM, K = 20_400, 24, 20


@pytest.fixture(scope="module")
def cloud(spark):
    """Vectors around a few hundred centres, of uneven norms."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(300, DIM))
    made = centres[rng.integers(0, 300, N)] + 0.4 * rng.normal(size=(N, DIM))
    made *= rng.uniform(0.8, 1.2, size=(N, 1))
    return made, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(made)], "vec_id long, embedding array<double>")


def recall(rows, made, every):
    got = defaultdict(set)
    for r in rows:
        got[r.query_id].add(r.vec_id)
    asked = np.arange(0, N, every)
    scores = made[asked] @ made.T
    scores[np.arange(len(asked)), asked] = -np.inf
    true = np.argsort(-scores, axis=1, kind="stable")[:, :K]
    assert set(got) == set(asked.tolist()) and all(len(g) == K for g in got.values())
    return np.mean([len(got[q] & set(t)) / K for q, t in zip(asked.tolist(), true.tolist())])


def test_recall_of_the_hashing(cloud):
    made, df = cloud
    assert N > 4 * neighbours.SAMPLE
    rows = neighbours.nearest(df, F.col("vec_id") % 40 == 0).collect()
    assert recall(rows, made, 40) >= 0.9


def test_nothing_but_visited_buckets_answers(cloud):
    made, df = cloud
    scale = float(np.sqrt((made**2).sum(axis=1).max())) * (1 + 1e-12)
    narrow = neighbours.Hashing(DIM, scale, 2, 3)
    narrow.visits = 3
    rows = neighbours.nearest(df, F.col("vec_id") % 400 == 0, hashing=narrow).collect()
    assert recall(rows, made, 400) < 0.9


def test_scores_do_not_depend_on_blocks(spark, monkeypatch):
    rng = np.random.default_rng(6)
    made = [(i, rng.normal(size=6).tolist()) for i in range(600)]
    df = spark.createDataFrame(made, "vec_id long, embedding array<double>")
    whole = neighbours.nearest(df, F.col("vec_id") % 20 == 0).collect()
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    assert sorted(whole) == sorted(neighbours.nearest(df, F.col("vec_id") % 20 == 0).collect())


def test_queries_that_find_too_few_meet_all_rows(spark):
    rng = np.random.default_rng(7)
    made = [(i, rng.normal(size=6).tolist()) for i in range(200)]
    df = spark.createDataFrame(made, "vec_id long, embedding array<double>")
    blind = neighbours.Hashing(6, 10.0, 2, 6)
    blind.visits = 0
    rows = neighbours.nearest(df, F.col("vec_id") % 20 == 0, hashing=blind).collect()
    assert len(rows) == 10 * K
    vectors = np.array([v for _, v in made])
    for q in range(0, 200, 20):
        scores = (vectors * vectors[q]).sum(axis=1)
        scores[q] = -np.inf
        mine = [r.vec_id for r in sorted((r for r in rows if r.query_id == q), key=lambda r: r["rank"])]
        assert mine == sorted(range(200), key=lambda i: (-scores[i], i))[:K]


def test_repeated_ids_and_rows(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 2.0]), (3, [1.0, 1.0]), (3, [1.0, 1.0]), (5, [2.0, 1.0]), (5, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, neighbours.nearest(df, F.col("vec_id") % 20 == 0).collect()))
    # Two vectors of query 0, a list for each; id 5 is a candidate with both of its vectors.
    assert got == sorted(
        [(0, 1, 5, 2.0), (0, 2, 3, 1.0), (0, 3, 5, 1.0)] + [(0, 1, 5, 4.0), (0, 2, 3, 2.0), (0, 3, 5, 2.0)]
    )
