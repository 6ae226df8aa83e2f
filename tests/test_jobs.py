"""The jobs end to end, on tiles stored as files."""

from __future__ import annotations

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cellwise.operators.grid import Grid, Sizes
from cellwise.plans import jobs, metadata
from cellwise.schema import DATASETS, TILES
from cellwise.session import shared_dir
from cellwise.sources.tiles import (
    read_tiles,
    tiles_near,
    tiles_of_dates,
    tiles_to_cells,
    write_tiles,
)
from cellwise.streaming import updates
from tests.scenes import box, counting, tile, zone, zones

GRID = Grid(0.0, 10.0, 1.0, 10, 10)
AS_OF = date(2024, 6, 1)
NAN = float("nan")


@pytest.fixture(scope="module")
def world(spark):
    """BDI on the left with two levels, AFG on the right with one, XXX off the raster."""
    layer = zones(
        spark,
        zone("BDI", 0, 0, "B", box(0.1, 0.1, 5.1, 9.9)),
        zone("BDI", 1, 0, "B1", box(0.1, 0.1, 5.1, 4.9)),
        zone("BDI", 1, 1, "B2", box(0.1, 5.1, 5.1, 9.9)),
        zone("BDI", 1, 2, "B3", box(0.3, 0.3, 0.7, 0.7)),
        zone("BDI", 2, 0, "B11", box(0.1, 0.1, 2.1, 4.9)),
        zone("AFG", 0, 0, "A", box(5.2, 0.1, 9.9, 9.9)),
        zone("XXX", 0, 0, "X", box(50, 50, 60, 60)),
    )
    countries = spark.createDataFrame([("BDI", 1), ("AFG", 0), ("XXX", 0)], "iso3 string, max_adm_level int")
    return layer, countries


def months(spec, n, first=2024, **changed):
    """Monthly tiles of counting values, a step higher every month."""
    return [
        tile(spec.name, f"{spec.prefix}2024-{m:02d}-01.tif", date(2024, m, 1), GRID, counting(100 * m, 10, 10), **changed)
        for m in range(1, n + 1)
    ]


def stored(spark, made, tmp_path, name="tiles"):
    path = str(tmp_path / name)
    write_tiles(spark.createDataFrame(made, TILES), path)
    return read_tiles(spark, path)


def run(spark, spec, tiles, world, tmp_path, **options):
    layer, countries = world
    stats, qa = str(tmp_path / "stats"), str(tmp_path / "qa")
    report = jobs.run_statistics(
        spark, spec, tiles, layer, countries, stats, qa, AS_OF, resolution=0.5, **options
    )
    return report, spark.read.parquet(stats), spark.read.parquet(qa)


def test_archive_update_and_backfill(spark, world, tmp_path, rows):
    spec = DATASETS["era5"]
    tiles = stored(spark, months(spec, 4), tmp_path)
    part = tiles.filter("month_valid IN (1, 3)")
    report, stats, qa = run(spark, spec, part, world, tmp_path)
    assert (report["n_files"], report["n_failed"], report["n_undated"]) == (2, 0, 0)
    assert (report["n_chunks"], report["last_date"]) == (6, date(2024, 5, 1))
    assert stats.count() == 2 * 5
    assert rows(qa.distinct(), "iso3", "adm_level", "stack_trace") == [("XXX", None, "no_cells_in_bounds")]

    _, stats, _ = run(spark, spec, tiles, world, tmp_path, update=True)
    assert rows(stats.select("valid_date").distinct()) == [(date(2024, m, 1),) for m in (1, 3, 4)]

    _, stats, _ = run(spark, spec, tiles, world, tmp_path, update=True, backfill=True)
    names = ["valid_date", "pcode", "mean", "median", "min", "max", "count", "sum", "std"]
    filled = rows(stats, *names)
    assert len(filled) == 4 * 5
    _, full, _ = run(spark, spec, tiles, world, tmp_path / "fresh")
    assert rows(full, *names) == filled

    b1 = stats.filter("pcode = 'B1' AND valid_date = '2024-01-01'").first()
    source = [100 + r * 10 + c for r in range(5, 10) for c in range(5)]
    assert (b1["count"], b1["min"], b1["max"]) == (100, min(source), max(source))
    assert b1["mean"] == pytest.approx(sum(source) / 25)
    empty = stats.filter("pcode = 'B3' AND valid_date = '2024-01-01'").first()
    assert (empty["count"], empty["sum"], empty["mean"]) == (0, 0, None)


def test_forecast_skips_empty_slices(spark, world, tmp_path, rows):
    spec = DATASETS["seas5"]
    left_blank = [[NAN if c < 6 else 1.0 for c in range(10)] for _ in range(10)]
    made = [
        tile("seas5", f"{spec.prefix}2024-01-01_lt{k}.tif", date(2024, 1 + k, 1), GRID,
             left_blank if k == 2 else counting(1, 10, 10), leadtime=k)
        for k in range(3)
    ]
    _, stats, _ = run(spark, spec, stored(spark, made, tmp_path), world, tmp_path)
    assert rows(stats.groupBy("iso3", "leadtime").count()) == [
        ("AFG", 0, 1), ("AFG", 1, 1), ("AFG", 2, 1), ("BDI", 0, 4), ("BDI", 1, 4),
    ]
    assert rows(stats.select("issued_date").distinct()) == [(date(2024, 1, 1),)]


def test_bands_and_coverage(spark, world, tmp_path, rows):
    spec = DATASETS["floodscan"]
    made = [
        tile("floodscan", f"{spec.prefix}2024-01-0{d}_{b}.tif", date(2024, 1, d), GRID, counting(d, 10, 10), band=b)
        for d in (1, 2) for b in (1, 2)
    ]
    report, stats, _ = run(spark, spec, stored(spark, made, tmp_path), world, tmp_path)
    assert report["complete"] is False
    assert rows(stats.groupBy("iso3", "band").count()) == [("BDI", "MFED", 8), ("BDI", "SFED", 8)]


def test_bad_country_is_held_back(spark, world, tmp_path, rows):
    """A forecast whose leadtime is out of range for one country's only valued slice."""
    spec = DATASETS["seas5"]
    right_only = [[NAN if c < 6 else 1.0 for c in range(10)] for _ in range(10)]
    made = [
        tile("seas5", f"{spec.prefix}2024-01-01_lt0.tif", date(2024, 1, 1), GRID, counting(1, 10, 10), leadtime=0),
        tile("seas5", f"{spec.prefix}2024-01-01_lt9.tif", date(2024, 10, 1), GRID, right_only, leadtime=9),
        tile("seas5", f"{spec.prefix}2024-01-01_ltx.tif", date(2024, 2, 1), GRID, right_only, leadtime=None),
    ]
    report, stats, qa = run(spark, spec, stored(spark, made, tmp_path), world, tmp_path)
    assert report["n_failed"] == 1
    assert rows(stats.select("iso3").distinct()) == [("BDI",)]
    assert ("AFG", 0, "leadtime_range") in rows(qa, "iso3", "adm_level", "stack_trace")
    assert qa.filter("iso3 IS NULL AND error LIKE '%lacks leadtime'").count() == 1


def test_no_files(spark, world, tmp_path):
    spec = DATASETS["era5"]
    old = [tile("era5", f"{spec.prefix}1970-01-01.tif", date(1970, 1, 1), GRID, counting(0, 10, 10))]
    with pytest.raises(ValueError, match="no file"):
        run(spark, spec, stored(spark, old, tmp_path), world, tmp_path)


def test_countries_without_pixels(spark, tmp_path, rows):
    """Bounds that hold a centre while no zone does: zero rows and a warning, or nothing at all."""
    corner = zone("AAA", 0, 0, "A", [(0.1, 0.1), (0.9, 0.1), (0.1, 0.6)])
    layer = zones(spark, corner, zone("BBB", 0, 0, "B", box(3, 3, 6, 6)))
    countries = spark.createDataFrame([("AAA", 0), ("BBB", 0)], "iso3 string, max_adm_level int")
    tiles = stored(spark, months(DATASETS["era5"], 1), tmp_path)
    for strict, expected in ((False, [("A", 0), ("B", 9)]), (True, [("B", 9)])):
        out = tmp_path / str(strict)
        jobs.run_statistics(spark, DATASETS["era5"], tiles, layer, countries, str(out / "s"), str(out / "q"),
                            AS_OF, resolution=None, strict_empty=strict)
        assert rows(spark.read.parquet(str(out / "s")), "pcode", "count") == expected
        assert ("AAA", 0, "no_pixels") in rows(spark.read.parquet(str(out / "q")), "iso3", "adm_level", "stack_trace")


def test_simplified_zones(spark, tmp_path):
    """A bump lower than the tolerance takes its pixel with it; the window stays."""
    bump = [(1.8, 2.4), (1.5, 2.7), (1.2, 2.4)]
    ring = [(0.2, 0.2), (4.8, 0.2), (4.8, 2.4), *bump, (0.2, 2.4)]
    layer = zones(spark, zone("AAA", 0, 0, "A", ring))
    countries = spark.createDataFrame([("AAA", 0)], "iso3 string, max_adm_level int")
    plain = jobs.layers(layer, countries, GRID, None)
    thin = jobs.layers(layer, countries, GRID, None, tolerance=0.35)
    assert (plain.zone_map.count(), thin.zone_map.count()) == (11, 10)
    assert plain.spans.first().r_lo == thin.spans.first().r_lo == 7


def test_test_run_takes_its_countries(spark, world, tmp_path, rows):
    tiles = stored(spark, months(DATASETS["era5"], 1), tmp_path)
    _, stats, _ = run(spark, DATASETS["era5"], tiles, world, tmp_path, test=True)
    assert rows(stats.select("iso3").distinct()) == [("BDI",)]


def test_stream_handles_each_file_once(spark, world, tmp_path, rows):
    spec = DATASETS["era5"]
    layer, countries = world
    fixed = jobs.layers(layer, countries, GRID, None)
    folder, store, log, state = (str(tmp_path / n) for n in ("in", "out", "qa", "state"))

    def handle(batch):
        tiles = jobs.dated_tiles(batch.withColumn("chunk_id", F.lit(0)), spec)
        jobs.store(jobs.statistics(tiles, fixed, spec, "chunk_id"), spec, store, log, AS_OF)

    for month in (1, 2):
        made = months(spec, 2)[month - 1 : month]
        spark.createDataFrame(made, TILES).coalesce(1).write.mode("append").parquet(folder)
        tiles = updates.arriving_tiles(spark, folder, files_per_batch=1)
        updates.keep_updated(tiles, handle, state).awaitTermination()
        found = spark.read.parquet(store)
        assert rows(found.select("valid_date").distinct()) == [(date(2024, m, 1),) for m in range(1, month + 1)]
        assert found.count() == 5 * month


def test_only_planned_months_and_near_tiles_are_read(spark, tmp_path):
    spec = DATASETS["era5"]
    tiles = stored(spark, months(spec, 5), tmp_path).filter("dataset = 'era5'")
    plan = spark.createDataFrame([(date(2024, 2, 1), 0)], "valid_date date, chunk_id int")
    chosen = tiles_of_dates(tiles, spec.prefix, plan)
    assert [r.month_valid for r in chosen.collect()] == [2]
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    text = chosen._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "file_month#" in text.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    quarters = [
        tile("era5", f"q{x}{y}", date(2024, 1, 1), Grid(float(x), float(y), 1.0, 5, 5), counting(0, 5, 5))
        for x in (0, 5) for y in (5, 10)
    ]
    sizes = Sizes(0, 0, 0, (5, 7), (2, 4))
    near = tiles_near(spark.createDataFrame(quarters, TILES), sizes, GRID)
    assert [r.path for r in near.collect()] == ["q05"]


def test_metadata_job(spark, world, tmp_path, rows):
    layer, _ = world
    named = layer.withColumn("name_language", F.lit("EN"))
    boundaries = spark.createDataFrame(
        [("BDI", 3, "2024", "u", 1), ("BDI", 0, "2023", "v", 2), ("AFG", 0, "2024", "w", 3), ("ZZZ", 1, "2024", "z", 4)],
        "iso_3 string, src_lvl int, src_update string, o_shp string, listed int",
    )
    plans = spark.createDataFrame(
        [("Humanitarian RESPONSE plan", date(2024, 12, 31), " BDI |ZZZ|"), ("humanitarian response plan", date(2020, 1, 1), "AFG"), (None, date(2025, 1, 1), "AFG")],
        "categories string, endDate date, locations string",
    )
    codes = spark.createDataFrame(
        [("BDI", "1", "a"), ("BDI", "1", None), ("BDI", "2", "b"), ("BDI", "3", "c"), ("AFG", "2", "d")],
        "location string, admin_level string, pcode string",
    )
    iso3 = metadata.iso3_table(boundaries, plans, codes, {"floodscan": ["BDI"]}, AS_OF, "listed")
    assert rows(iso3, "iso3", "has_active_hrp", "max_adm_level", "floodscan", "adm1_pcode_count", "adm2_pcode_count", "total_pcodes") == [
        ("AFG", False, 0, False, None, None, 1), ("BDI", True, 2, True, 1, 1, 3),
    ]
    sources = [
        metadata.RasterSource("era5", GRID, 0.5),
        metadata.RasterSource("floodscan", GRID, None, ("BDI",)),
    ]
    paths = str(tmp_path / "iso3"), str(tmp_path / "polygon")
    for _ in range(2):
        jobs.run_metadata(iso3, named, sources, *paths)
    table = spark.read.parquet(paths[1])
    assert table.count() == 6
    found = {r.pcode: r for r in table.collect()}
    b1 = found["B1"]
    assert (b1.era5_n_intersect_raw_pixels, b1.era5_n_upsampled_pixels, b1.era5_frac_raw_pixels) == (25, 100, 25)
    assert (found["B3"].era5_n_upsampled_pixels, found["A"].floodscan_n_upsampled_pixels) == (0, None)
    assert found["B"].area > found["B1"].area > 0
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir", "/"))


def halves(spec, day, overlap=0):
    """One raster as a left and a right file."""
    values = counting(100, 10, 10)
    left = Grid(0.0, 10.0, 1.0, 5 + overlap, 10)
    right = Grid(5.0, 10.0, 1.0, 5, 10)
    name = f"{spec.prefix}{day}"
    return [
        tile(spec.name, f"{name}_l.tif", day, left, [row[: 5 + overlap] for row in values]),
        tile(spec.name, f"{name}_r.tif", day, right, [row[5:] for row in values]),
    ]


def test_rasters_of_several_files(spark, world, tmp_path, rows):
    spec = DATASETS["era5"]
    _, whole, _ = run(spark, spec, stored(spark, months(spec, 1), tmp_path, "one"), world, tmp_path / "a")
    parts = stored(spark, halves(spec, date(2024, 1, 1)), tmp_path, "two")
    report, split, _ = run(spark, spec, parts, world, tmp_path / "b")
    assert rows(split) == rows(whole) and report["n_conflicts"] == 0


@pytest.mark.parametrize("case", ["overlap", "appended twice", "revision"])
def test_a_slice_stored_twice_is_left_out(spark, world, tmp_path, rows, case):
    spec = DATASETS["era5"]
    first = {
        "overlap": halves(spec, date(2024, 1, 1), overlap=1),
        "appended twice": months(spec, 1) * 2,
        "revision": months(spec, 1) + [(r[0], r[1].replace(".tif", "_rev.tif"), *r[2:]) for r in months(spec, 1)],
    }[case]
    report, stats, qa = run(spark, spec, stored(spark, first + months(spec, 2)[1:], tmp_path), world, tmp_path)
    assert report["n_conflicts"] == 1
    assert rows(stats.select("valid_date").distinct()) == [(date(2024, 2, 1),)]
    assert qa.filter("error = 'conflicting_tiles: 2024-01-01'").count() == 1


def test_differing_resolution_is_an_error(spark, world, tmp_path):
    spec = DATASETS["era5"]
    fine = tile(spec.name, f"{spec.prefix}2024-02-01.tif", date(2024, 2, 1), Grid(0.0, 10.0, 0.5, 20, 20), counting(1, 20, 20))
    with pytest.raises(ValueError, match="resolution"):
        run(spark, spec, stored(spark, [*months(spec, 1), fine], tmp_path), world, tmp_path)


def test_cells_off_the_grid_are_an_error(spark):
    wide = spark.createDataFrame(months(DATASETS["era5"], 1), TILES)
    with pytest.raises(Exception, match="beyond the grid"):
        tiles_to_cells(wide, ["path"], Grid(0.0, 10.0, 1.0, 9, 10)).collect()


def test_shared_pcode_is_stored_for_both_countries(spark, tmp_path, rows):
    layer = zones(spark, zone("AAA", 0, 0, "P", box(0.1, 0.1, 4.9, 9.9)), zone("BBB", 0, 0, "P", box(5.1, 0.1, 9.9, 9.9)))
    countries = spark.createDataFrame([("AAA", 0), ("BBB", 0)], "iso3 string, max_adm_level int")
    report, stats, _ = run(spark, DATASETS["era5"], stored(spark, months(DATASETS["era5"], 1), tmp_path), (layer, countries), tmp_path)
    assert report["n_failed"] == 0 and rows(stats, "iso3", "pcode") == [("AAA", "P"), ("BBB", "P")]


def test_first_run_may_be_a_backfill_and_may_store_nothing(spark, world, tmp_path):
    spec = DATASETS["era5"]
    tiles = stored(spark, months(spec, 2), tmp_path)
    report, stats, _ = run(spark, spec, tiles, world, tmp_path, backfill=True)
    # All months from 1981 to May 2024 were missing.
    assert report["n_missing"] == 43 * 12 + 5 and stats.count() == 2 * 5
    # A month of infinities breaks a rule, so all is held back; the table then has a folder only.
    bad = [tile(spec.name, f"{spec.prefix}2024-01-01.tif", date(2024, 1, 1), GRID, [[float("inf")] * 10] * 10)]
    held = stored(spark, bad, tmp_path, "bad")
    layer, countries = world
    paths = str(tmp_path / "s2"), str(tmp_path / "q2")
    for part in (held, tiles):
        jobs.run_statistics(spark, spec, part, layer, countries, *paths, AS_OF, resolution=None)
    assert spark.read.parquet(paths[0]).filter("valid_date = '2024-02-01'").count() == 5


def test_a_run_leaves_no_tables(spark, world, tmp_path):
    base = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(base.iterdir()) if base.exists() else set()
    run(spark, DATASETS["era5"], stored(spark, months(DATASETS["era5"], 1), tmp_path), world, tmp_path)
    assert set(base.iterdir()) == before


def test_slice_in_two_batches(spark, world, tmp_path, rows):
    """The halves of a raster arrive apart; the statistics are those of the whole."""
    spec = DATASETS["era5"]
    layer, countries = world
    fixed = jobs.layers(layer, countries, GRID, None)
    folder = str(tmp_path / "arriving")
    for part in halves(spec, date(2024, 1, 1)):
        spark.createDataFrame([part], TILES).coalesce(1).write.mode("append").parquet(folder)
    stats, qa = str(tmp_path / "s"), str(tmp_path / "q")
    everything = jobs.dated_tiles(spark.read.schema(TILES).parquet(folder), spec)

    def handle(batch):
        tiles = updates.touched_slices(jobs.dated_tiles(batch, spec), everything, spec.slice_keys)
        found = jobs.statistics(tiles.withColumn("chunk_id", F.lit(0)), fixed, spec, "chunk_id")
        jobs.store(found, spec, stats, qa, AS_OF)

    updates.keep_updated(updates.arriving_tiles(spark, folder, 1), handle, str(tmp_path / "state")).awaitTermination()
    whole = stored(spark, months(spec, 1), tmp_path)
    jobs.run_statistics(spark, spec, whole, layer, countries, str(tmp_path / "s2"), qa, AS_OF, resolution=None)
    assert rows(spark.read.parquet(stats)) == rows(spark.read.parquet(str(tmp_path / "s2")))
