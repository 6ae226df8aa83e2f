"""From raw documents to a training mix, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet into
the shared folder and reads it again as the next stage's ``docs``. All but the last return the
columns of ``documents``; the last returns the mix: one row per document left, with the words
taken of it. Any stage's failure can be repeated from the table before it.

Null and empty texts pass every filter; repeated rows are judged alike, except that near-duplicate
removal keeps one row of a group; empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cellwise.llm import decontamination, mixing, passages, simhash, toxicity
from cellwise.llm.queries import spread, table
from cellwise.session import written


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity is below the limit, by a model of the labelled ones."""
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), sample_key=spread())
    return toxicity.without_toxic(docs, model)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    return simhash.keep_first(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that stand in an earlier document."""
    return passages.deduplicated(docs)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold less of the benchmark than the limit."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document."""
    return mixing.mix(docs, quality=mixing.label_weights(table(spark, sf_dir, "labels")))


STAGES = [
    ("toxicity", remove_toxic),
    ("near_duplicates", remove_near_duplicates),
    ("passages", cut_repeated_passages),
    ("decontamination", remove_contaminated),
    ("mixing", mix_sources),
]

# A fitted classifier and fingerprints by XXH64 are not SQL; tests/llm checks the stages by hand.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
