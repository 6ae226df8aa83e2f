from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from cellwise.operators import quality
from cellwise.operators.merge import compare, upsert
from cellwise.schema import DATASETS, coverage_table, stats_schema
from cellwise.sources.sinks import _replace_partitions, append_qa, write_stats

GOOD = {
    "iso3": "AAA", "pcode": "P1", "valid_date": date(2020, 3, 1), "issued_date": date(2020, 1, 1),
    "leadtime": 2, "adm_level": 1, "mean": 2.0, "median": 2.0, "min": 1.0, "max": 3.0,
    "count": 5, "sum": 10.0, "std": 0.5,
}
FORECAST = stats_schema(DATASETS["seas5"])
OBSERVED = stats_schema(DATASETS["era5"])
AS_OF = date(2020, 6, 1)


def table(spark, schema, *changes):
    made = [{**GOOD, **c} for c in changes]
    return spark.createDataFrame([tuple(m[n] for n in schema.names) for m in made], schema)


@pytest.mark.parametrize(
    ("rule", "change"),
    [
        ("min_max", {"min": 4.0, "mean": None, "median": None}),
        ("mean_between", {"mean": 3.5}),
        ("median_between", {"median": 0.5}),
        ("std_nonneg", {"std": -0.1}),
        ("count_nonneg", {"count": -1}),
        ("adm_level", {"adm_level": 5}),
        ("iso3", {"iso3": "A1A"}),
        ("issued_le_valid", {"issued_date": date(2020, 4, 1), "leadtime": None}),
        ("leadtime_range", {"leadtime": 7, "issued_date": date(2019, 8, 1)}),
        ("leadtime_months", {"leadtime": 3}),
        ("leadtime_months", {"leadtime": 1, "issued_date": date(2019, 2, 1)}),
    ],
)
def test_each_rule(spark, rule, change):
    checked = quality.validate(table(spark, FORECAST, {}, change), AS_OF).collect()
    assert [list(r.violations) for r in checked] == [[], [rule]]


def test_future_dates(spark):
    df = table(spark, OBSERVED, {}, {"valid_date": date(2020, 6, 1)}, {"valid_date": date(2020, 6, 2)})
    checked = quality.validate(df, AS_OF).collect()
    assert [list(r.violations) for r in checked] == [[], [], ["not_future"]]


def test_empty_zone_passes(spark):
    empty = {k: None for k in ("mean", "median", "min", "max", "std")} | {"count": 0, "sum": 0.0}
    assert list(quality.validate(table(spark, FORECAST, empty), AS_OF).first().violations) == []


def test_one_bad_row_holds_back_its_country_and_chunk(spark, rows):
    made = table(
        spark, OBSERVED,
        {}, {"pcode": "P2", "adm_level": 2, "std": -1.0}, {"pcode": "P3", "count": -1, "mean": 9.0},
        {"iso3": "BBB", "pcode": "Q1"},
    )
    checked = quality.validate(made, AS_OF).withColumn("chunk_id", F.lit(0))
    checked = checked.unionByName(checked.filter("pcode = 'P1'").withColumn("chunk_id", F.lit(1)))
    failed = quality.failed_units(checked, ["iso3", "chunk_id"])
    assert rows(failed, "iso3", "chunk_id", "adm_level", "rule") == [("AAA", 0, 1, "mean_between")]
    kept = quality.passed(checked, failed, ["iso3", "chunk_id"])
    assert rows(kept, "iso3", "chunk_id", "pcode") == [("AAA", 1, "P1"), ("BBB", 0, "Q1")]


def test_duplicate_keys(spark):
    df = table(spark, FORECAST, {"leadtime": None}, {"leadtime": None}, {})
    checked = quality.with_duplicate_rule(
        quality.validate(df, AS_OF), ["valid_date", "pcode", "leadtime"]
    )
    assert sorted((r.leadtime or -1, list(r.violations)) for r in checked.collect()) == [
        (-1, ["duplicate_key"]), (-1, ["duplicate_key"]), (2, []),
    ]


def test_coverage(spark, rows):
    known = spark.createDataFrame([("BDI",), ("AFG",)], "iso3 string")
    lists = coverage_table(spark, list(DATASETS.values()))
    assert rows(quality.with_coverage(known, lists, "floodscan")) == [("BDI",)]
    assert rows(quality.with_coverage(known, lists, "era5")) == [("AFG",), ("BDI",)]


def test_upsert_with_null_keys(spark, rows):
    schema = "pcode string, leadtime int, mean int"
    old = spark.createDataFrame([("a", None, 1), ("a", 1, 2), ("b", 1, 3)], schema)
    new = spark.createDataFrame([("a", None, 9), ("c", None, 8)], schema)
    merged = upsert(old, new, ["pcode", "leadtime"])
    expected = [("a", 1, 2), ("a", None, 9), ("b", 1, 3), ("c", None, 8)]
    assert rows(merged) == expected
    assert rows(upsert(merged, new, ["pcode", "leadtime"])) == expected


def test_stats_sink_is_idempotent_and_touches_only_its_months(spark, rows, tmp_path):
    spec, path = DATASETS["seas5"], str(tmp_path / "stats")
    write_stats(table(spark, FORECAST, {}, {"valid_date": date(2020, 5, 1), "pcode": "P9"}), spec, path)
    kept_file = sorted((tmp_path / "stats/dataset=seas5/month=2020-05-01").glob("*.parquet"))
    change = table(spark, FORECAST, {"mean": 2.5}, {"pcode": "P2"})
    for _ in range(2):
        write_stats(change, spec, path)
        got = rows(spark.read.parquet(path), "pcode", "valid_date", "mean")
        assert got == [
            ("P1", date(2020, 3, 1), 2.5), ("P2", date(2020, 3, 1), 2.0), ("P9", date(2020, 5, 1), 2.0),
        ]
    assert sorted((tmp_path / "stats/dataset=seas5/month=2020-05-01").glob("*.parquet")) == kept_file
    write_stats(table(spark, OBSERVED, {}), DATASETS["era5"], path)
    assert spark.read.parquet(path).groupBy("dataset").count().count() == 2


def test_null_partitions_survive(spark, rows, tmp_path):
    path, schema = str(tmp_path / "t"), "iso3 string, pcode string, area int"
    _replace_partitions(spark.createDataFrame([(None, "a", 1), ("X", "b", 2)], schema), path, ["iso3"], ["pcode"])
    _replace_partitions(spark.createDataFrame([(None, "c", 3)], schema), path, ["iso3"], ["pcode"])
    assert rows(spark.read.parquet(path), "iso3", "pcode", "area") == [
        (None, "a", 1), (None, "c", 3), ("X", "b", 2),
    ]


def test_qa_log_grows(spark, tmp_path):
    path = str(tmp_path / "qa")
    failed = spark.createDataFrame([("AAA", 1, "min_max")], "iso3 string, adm_level int, rule string")
    for _ in range(2):
        append_qa(quality.qa_rows(failed, "era5"), path)
    assert spark.read.parquet(path).count() == 2


def test_compare(spark):
    schema = "pcode string, mean double"
    base = spark.createDataFrame([("a", 10.0), ("b", 10.0), ("c", 0.0), ("d", 1.0)], schema)
    other = spark.createDataFrame([("a", 10.1), ("b", 12.0), ("c", 0.0), ("d", 2.0)], schema)
    found = compare({"db": base, "zs": other}, "db", ["pcode"], ["mean"]).collect()
    assert [(r.pcode, r.max_difference) for r in found] == [("d", 66.6667), ("b", 18.1818)]
