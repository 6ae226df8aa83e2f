"""Small inputs must not start jobs whose input is empty: each takes memory of the driver."""

from __future__ import annotations

import pytest

from cellwise.llm import components as stars
from cellwise.llm import passages


@pytest.fixture
def tables(monkeypatch):
    """Names of the tables that the operators write."""
    names: list[str] = []

    def noted(made):
        def written(df, purpose):
            names.append(purpose)
            return made(df, purpose)

        return written

    for module in (stars, passages):
        monkeypatch.setattr(module, "written", noted(module.written))
    return names


def test_no_links_take_no_round(spark, tables):
    pairs = spark.createDataFrame([(1, 1), (None, 2)], "x long, y long")
    assert stars.components(pairs, "x", "y").collect() == []
    assert tables == ["links"]


def test_stars_take_one_round(spark, tables):
    pairs = spark.createDataFrame([(2, 1), (3, 1), (5, 4), (5, 4)], "x long, y long")
    found = {tuple(r) for r in stars.components(pairs, "x", "y").collect()}
    assert found == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4)}
    assert tables == ["links", "links"]


def test_texts_without_mixed_buckets_stop_early(spark, tables):
    line = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame(
        [(1, line), (2, line + " end"), (3, "few words"), (4, None)], "doc_id long, text string"
    )
    found = {r["doc_id"]: r["n_removed"] for r in passages.cleaned(docs).collect()}
    assert found[1] == 0 and found[2] > 50 and found[3] == 0 and found[4] == 0
    assert "similar-lines" in tables and "mixed-shingles" not in tables and "shingle-rows" not in tables
