"""Tiles of any date are stored by the stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from workload.queries import stream_update


def test_tiles_beyond_a_fixed_date(spark, tmp_path):
    def save(df, name):
        df.write.parquet(f"{tmp_path}/{name}.parquet")

    save(spark.range(5).selectExpr("id AS r_regionkey", "concat('region ', id) AS r_name"), "region")
    save(spark.range(25).selectExpr("id AS n_nationkey", "concat('nation ', id) AS n_name", "id % 5 AS n_regionkey"), "nation")
    save(spark.range(5).selectExpr("id AS s_suppkey", "concat('supplier ', id) AS s_name"), "supplier")
    tiles = spark.range(2).select(
        (F.col("id") * 40_000).alias("vec_id"), F.lit(1).alias("label"),
        F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: i.cast("double")).alias("embedding"),
    )
    save(tiles, "embeddings")
    found = stream_update(spark, str(tmp_path)).groupBy("valid_date").agg(F.sum("count").alias("n")).collect()
    assert sorted(str(r.valid_date) for r in found) == ["2020-01-01", "2129-07-08"]
    assert len({r.n for r in found}) == 1
