"""Registered queries of this package: one per operator, with the parameters used in production."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwise.llm import (
    decontamination,
    html,
    language,
    mixing,
    negatives,
    neighbours,
    passages,
    quality,
    rules,
    simhash,
    spelling,
    tokens,
    toxicity,
)
from cellwise.llm.oracles import ORACLES

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

__all__ = ["ORACLES", "QUERIES"]


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(n: int) -> Column:
    """Remainder by which documents are dealt to training and held-out sets."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def spread() -> Column:
    """An even number per row, by which bounded training samples are drawn."""
    return F.xxhash64(F.col("doc_id"), F.lit("sample"))


@query
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold(3) == 1, F.lit(False))
    model = language.fit(docs.filter(~held_out), sample_key=spread())
    return language.identify(docs.withColumn("held_out", held_out), model, keep=("doc_id", "held_out"))


@query
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = mixing.label_weights(table(spark, sf_dir, "labels"))
    return mixing.mix(table(spark, sf_dir, "documents"), quality=weights)


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, F.col("vec_id") % 20 == 0)


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), sample_key=spread())
    return toxicity.severities(docs, model)


@query
def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html.main_text(pages, html.fit(pages))


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold(5) == 0, F.lit(False))
    labels = table(spark, sf_dir, "labels").filter(~held_out)
    model = quality.fit(docs, labels, sample_key=spread())
    return quality.scored(docs.withColumn("held_out", held_out), model, keep=("doc_id", "held_out"))


@query
def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return passages.cleaned(docs)


@query
def op10_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"))


@query
def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mined(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)


@query
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(table(spark, sf_dir, "documents")))


@query
def op13_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.line_cleaned(table(spark, sf_dir, "documents")).drop("cleaned")
