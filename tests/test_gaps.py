from __future__ import annotations

from datetime import date, timedelta

from cellwise.plans.runs import dates_of_intervals, missing_intervals

START, END = date(2020, 1, 1), date(2020, 1, 10)
STATS = "iso3 string, adm_level int, valid_date date, valid long"


def day(n):
    return date(2020, 1, n)


def gaps(spark, rows, levels, start=START, end=END, frequency="D"):
    stats = spark.createDataFrame([(*r, 1) for r in rows], STATS)
    known = spark.createDataFrame(levels, "iso3 string, adm_level int")
    return missing_intervals(stats, known, start, end, frequency)


def test_a_country_that_failed_alone_has_a_gap(spark):
    rows = [("AAA", 0, day(n)) for n in range(1, 11)]
    rows += [("BBB", 0, day(n)) for n in (1, 2, 2, 5, 9)] + [("BBB", 0, date(2019, 5, 5)), ("BBB", 0, None), (None, 0, day(3))]
    found = gaps(spark, rows, [("AAA", 0), ("BBB", 0), ("BBB", 0), ("BBB", 1), (None, 0)])
    assert sorted(map(tuple, found.collect())) == [
        ("BBB", 0, day(3), day(4), 2),
        ("BBB", 0, day(6), day(8), 3),
        ("BBB", 0, day(10), day(10), 1),
        ("BBB", 1, day(1), day(10), 10),
    ]


def test_intervals_fill_exactly_what_is_missing(spark):
    have = {("AAA", 0, day(n)) for n in (2, 3, 7)} | {("BBB", 1, day(n)) for n in (1, 10)}
    found = gaps(spark, sorted(have), [("AAA", 0), ("BBB", 1)])
    fill = {tuple(r) for r in dates_of_intervals(found, "D").collect()}
    every = {(c, lv, START + timedelta(n)) for c, lv in (("AAA", 0), ("BBB", 1)) for n in range(10)}
    assert fill == every - have
    after = gaps(spark, sorted(have | fill), [("AAA", 0), ("BBB", 1)])
    assert after.count() == 0


def test_months_and_empty_tables(spark):
    rows = [("AAA", 0, date(2020, m, 1)) for m in (1, 2, 6)]
    months = gaps(spark, rows, [("AAA", 0)], date(2020, 1, 1), date(2020, 8, 1), "M")
    assert sorted(map(tuple, months.collect())) == [
        ("AAA", 0, date(2020, 3, 1), date(2020, 5, 1), 3),
        ("AAA", 0, date(2020, 7, 1), date(2020, 8, 1), 2),
    ]
    assert {r.valid_date.month for r in dates_of_intervals(months, "M").collect()} == {3, 4, 5, 7, 8}
    assert [tuple(r) for r in gaps(spark, [], [("AAA", 0)]).collect()] == [("AAA", 0, START, END, 10)]
    assert gaps(spark, rows, []).count() == 0
