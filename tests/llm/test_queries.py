"""The registered queries and the pipeline on the smallest tables."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
import corpus_pipeline
from cellwise.llm.queries import ORACLES, QUERIES
from tests.twins import database, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def results(spark):
    """Every query's result, computed once."""
    found = {}

    def of(name):
        if name not in found:
            found[name] = registered.queries()[name](spark, SF_DIR).persist()
        return found[name]

    yield of
    for df in found.values():
        df.unpersist()


def test_all_are_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(registered.queries())
    assert set(ORACLES) <= set(registered.oracle_sql())


@pytest.mark.parametrize("name", ORACLES)
def test_twins(results, name):
    assert differences(results(name), database(SF_DIR), ORACLES[name]) == []


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ("op4_nearest", "op6_main_text", "op11_negatives", "op12_spelling")])
def test_one_row_per_document(spark, results, name):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = results(name)
    assert got.count() == docs.count()
    assert got.select("doc_id").exceptAll(docs.select("doc_id")).count() == 0


def test_language_held_out(spark, results):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").filter("lang is not null")
    both = results("op1_language").filter("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert both.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95


def test_quality_held_out(spark, results):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    both = results("op8_quality").filter("held_out").join(labels, "doc_id")
    # Ten to twenty rows at the smallest scale: few errors, and better than one answer for all.
    right = both.filter("quality = predicted").count()
    assert right >= 0.8 * both.count() and right >= both.filter("quality = 1").count()


def test_toxic_documents_are_told(spark, results):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").withColumnRenamed("toxic", "label")
    both = results("op5_toxicity").join(labels, "doc_id")
    right = both.filter("toxic and label = 1").count()
    assert right >= 0.8 * both.filter("toxic").count()


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "passages", "decontamination", "mixing"]
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF_DIR)
        assert after.columns == docs.columns
        assert after.select("doc_id").exceptAll(before.select("doc_id")).count() == 0
        before = after
    mixed = corpus_pipeline.run(spark, SF_DIR)
    assert mixed.count() == before.count() > 0.5 * docs.count()


def test_pipeline_of_nothing(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_on_odd_rows(spark, odd_docs):
    """All four filters keep odd rows whole, but for copies."""
    docs = odd_docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == odd_docs.columns
    assert {1, 6, 7} <= {r.doc_id for r in docs.select("doc_id").collect()}
