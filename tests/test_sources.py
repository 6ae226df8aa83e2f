from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from cellwise.operators.grid import Grid, in_box
from cellwise.plans import runs
from cellwise.schema import DATASETS, TILES, stats_schema
from cellwise.sources import catalog, tables
from cellwise.sources import tiles as tile_source
from tests.scenes import box, counting, tile, zone, zones

GRID = Grid(0.0, 4.0, 1.0, 4, 4)


def tiles(spark, *changes):
    made = [tile("d", f"p_{i}.tif", date(2024, 2, 9), GRID, counting(1, 4, 4), **{"leadtime": 3, **c}) for i, c in enumerate(changes)]
    return spark.createDataFrame(made, TILES)


@pytest.mark.parametrize(
    ("kind", "day"),
    [("daily", date(2024, 2, 9)), ("monthly", date(2024, 2, 1)), ("forecast", date(2024, 2, 1))],
)
def test_valid_date(spark, kind, day):
    row = tile_source.with_valid_date(tiles(spark, {}), kind).first()
    assert (row.valid_date, row.leadtime, list(row.missing)) == (day, 3, [])


@pytest.mark.parametrize(
    ("kind", "attribute"),
    [
        ("daily", "year_valid"), ("daily", "month_valid"), ("daily", "date_valid"),
        ("monthly", "year_valid"), ("monthly", "month_valid"), ("forecast", "leadtime"),
    ],
)
def test_missing_attribute(spark, rows, kind, attribute):
    dated = tile_source.with_valid_date(tiles(spark, {}, {attribute: None}), kind)
    assert dated.filter("valid_date IS NULL").count() == 1
    assert rows(tile_source.missing_attributes(dated)) == [("p_1.tif", attribute)]


def test_tiles_of_one_raster_fit_together(spark, rows):
    halves = tiles(spark, {"width": 2, "height": 2, "data": [1.0, 2.0, 3.0, float("nan")]},
                   {"width": 2, "height": 2, "x0": 2.0, "y0": 2.0, "data": [5.0, 6.0, 7.0, 8.0]})
    cells = tile_source.tiles_to_cells(halves, ["path"], GRID)
    assert rows(cells, "row", "col", "value") == [
        (0, 0, 1), (0, 1, 2), (1, 0, 3), (1, 1, None), (2, 2, 5), (2, 3, 6), (3, 2, 7), (3, 3, 8),
    ]
    centre = tile_source.with_centres(cells, GRID).filter("row = 3 AND col = 2").first()
    assert (centre.x, centre.y) == (2.5, 0.5)


def test_box_includes_both_ends(spark, rows):
    cells = tile_source.tiles_to_cells(tiles(spark, {}), ["path"], GRID)
    assert rows(in_box(cells, GRID, (0.5, 1.5, 1.5, 3.4)), "row", "col") == [(1, 0), (1, 1), (2, 0), (2, 1)]


def test_grid_template_and_bands(spark, rows):
    assert tile_source.grid_of(tiles(spark, {})) == GRID
    with pytest.raises(ValueError, match="no tiles"):
        tile_source.grid_of(tiles(spark, {}).filter("false"))
    bands = spark.createDataFrame([(1,), (2,), (3,)], "band int")
    assert rows(bands.select(tile_source.band_name(F.col("band")))) == [("MFED",), ("MFED",), ("SFED",)]


def test_catalog(spark, rows):
    names = ["a/x_2024-01-02_lt0.tif", "a/x_2024-01-02_lt1.tif", "a/x_2024-13-45.tif", "a/readme.txt", "b/x_2024-02-01.tif"]
    paths = spark.createDataFrame([(n,) for n in names], "path string")
    files = catalog.file_catalog(paths)
    assert files.count() == 3
    assert rows(catalog.undated_files(paths)) == [("a/readme.txt",), ("a/x_2024-13-45.tif",)]
    days = spark.createDataFrame([(date(2024, 1, 2),), (date(2024, 2, 1),)], "valid_date date")
    chosen = catalog.select_files(files, "a/", days)
    assert chosen.count() == 2
    report = catalog.selection_report(chosen, days).first()
    assert (report.n_files, report.n_dates_found, report.n_dates, report.complete) == (2, 1, 2, False)
    assert catalog.latest_date(files, "a/").first()[0] == date(2024, 1, 2)
    assert catalog.latest_date(files, "c/").first()[0] is None


def test_listed_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "x_2024-01-02.tif").write_bytes(b"x")
    assert catalog.file_catalog(catalog.listed_files(spark, str(tmp_path))).count() == 1


def test_tagged_csv(spark, rows, tmp_path):
    path = tmp_path / "plans.csv"
    path.write_text("locations,endDate\n#country+code,#date+end\nAFG|NGA,2024-12-31\n,2025-01-01\n")
    read = tables.read_tagged_csv(spark, str(path), "locations string, endDate string")
    assert rows(read) == [("AFG|NGA", "2024-12-31"), (None, "2025-01-01")]


def test_zone_layers_are_pruned(spark, tmp_path):
    path = str(tmp_path / "zones")
    made = zones(spark, zone("AAA", 0, 0, "A", box(0, 0, 1, 1)), zone("BBB", 1, 0, "B", box(0, 0, 1, 1)))
    tables.write_zones(made, path)
    one = tables.read_zones(spark, path, ["BBB"], 1)
    assert [r.pcode for r in one.collect()] == ["B"]
    assert "PartitionFilters: [" in one._jdf.queryExecution().executedPlan().toString()
    assert len(one.inputFiles()) == 2
    assert tables.read_zones(spark, path).count() == 2


def test_stats_slice_is_pushed_down(spark, tmp_path):
    path = str(tmp_path / "stats")
    made = spark.createDataFrame([("AAA", 1, date(2024, 1, 5), 2, date(2024, 1, 1))],
                                 "iso3 string, adm_level int, valid_date date, leadtime int, month date")
    made.write.partitionBy("month").parquet(path)
    found = tables.read_stats(spark, path, "AAA", 1, date(2024, 1, 5), 2)
    assert found.count() == 1
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = found._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [isnotnull(month" in plan and "EqualTo(iso3,AAA)" in plan


def test_name_columns(spark):
    assert tables.name_column(["ADM1_PCODE", "ADM1_REF", "ADM1_FR", "ADM1_EN"], 1) == "ADM1_FR"
    with pytest.raises(ValueError, match="no name column"):
        tables.name_column(["ADM1_PCODE"], 1)
    layer = spark.createDataFrame([("c", "n", "x")], "ADM1_PCODE string, ADM1_FR string, other string")
    row = tables.standard_names(layer, 1).first()
    assert (row.pcode, row["name"], row.name_language) == ("c", "n", "FR")


def test_lookup_of_layers(spark, rows):
    zero = spark.createDataFrame([("AAA", "c0", "n0")], "ISO3 string, ADM0_PCODE string, ADM0_EN string")
    one = spark.createDataFrame([("AAA", "c0", "n0", "c1", "n1")],
                                "ISO3 string, ADM0_PCODE string, ADM0_EN string, ADM1_PCODE string, ADM1_EN string")
    made = tables.admin_lookup([(zero, 0), (one, 1)])
    assert rows(made, "ADM_LEVEL", "ADM0_NAME", "ADM1_NAME", "NAME_LANGUAGE") == [
        (0, "n0", None, "EN"), (1, "n0", "n1", "EN"),
    ]


def test_keep_first_and_last(spark, rows):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z"), (None, 1, "n")], "k string, o int, v string")
    assert rows(tables.first_per_key(df, ["k"], ["o"]), "k", "v") == [(None, "n"), ("a", "y"), ("b", "z")]
    assert rows(tables.last_per_key(df, ["k"], ["o"]), "k", "v") == [(None, "n"), ("a", "x"), ("b", "z")]


def test_stats_schemas():
    assert stats_schema(DATASETS["era5"]).names[:4] == ["iso3", "pcode", "valid_date", "adm_level"]
    assert stats_schema(DATASETS["seas5"]).names[:6] == [
        "iso3", "pcode", "valid_date", "issued_date", "leadtime", "adm_level",
    ]
    assert DATASETS["floodscan"].key == ["valid_date", "pcode", "band"]
    assert len(DATASETS["floodscan"].coverage) == 54


def dates(df):
    return [r.valid_date for r in df.orderBy("valid_date").collect()]


def test_calendars(spark):
    assert len(dates(runs.calendar(spark, date(2024, 2, 1), date(2024, 3, 1), "D"))) == 30
    expected = runs.calendar(spark, date(2024, 1, 15), date(2024, 3, 2), "M")
    assert dates(expected) == [date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)]
    planned = runs.planned_dates(spark.range(1), F.lit(date(2024, 1, 15)), F.lit(date(2024, 3, 2)), "M")
    assert dates(planned) == [date(2024, 2, 1), date(2024, 3, 1)]
    with pytest.raises(ValueError, match="frequency"):
        runs.calendar(spark, date(2024, 1, 1), date(2024, 1, 2), "W")


def test_run_plan(spark):
    spec = DATASETS["seas5"]
    plan = runs.run_plan(spark, spec, date(1989, 6, 2))
    assert dates(plan)[0] == date(1981, 1, 1) and dates(plan)[-1] == date(1989, 6, 1)
    assert [r["count"] for r in plan.groupBy("chunk_id").count().orderBy("chunk_id").collect()] == [100, 2]
    stored = spark.createDataFrame([(date(1981, m, 1),) for m in (1, 2, 4)], "issued_date date")
    newest = spark.createDataFrame([(date(1981, 5, 1),)], "latest date")
    both = runs.run_plan(spark, spec, date(1981, 6, 2), stored, newest, backfill=True)
    assert dates(both) == [date(1981, 3, 1), date(1981, 5, 1), date(1981, 6, 1)]
    summary = runs.run_summary(both, "seas5", "dev").first()
    assert (summary.n_chunks, summary.n_dates, summary.n_missing) == (1, 3, 0)
    with pytest.raises(ValueError, match="statistics table"):
        runs.run_plan(spark, spec, date(1981, 6, 2), backfill=True)
