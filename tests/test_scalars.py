import datetime as dt

from adpulse.functions import scalars as sc
from adpulse.operators.ingest import area_columns


def test_time_of_day_boundaries(spark):
    hours = [4, 5, 11, 12, 16, 17, 20, 21, None]
    df = spark.createDataFrame([(h,) for h in hours], "h int")
    got = [r[0] for r in df.select(sc.time_of_day("h")).collect()]
    assert got == ["night", "morning", "morning", "afternoon", "afternoon", "evening", "evening",
                   "night", "night"]


def test_keyword_flag_null_is_false(spark):
    df = spark.createDataFrame([(None,), ("Great BONUS",), ("benefits apply",), ("none",)], "d string")
    assert [r[0] for r in df.select(sc.keyword_flag("d")).collect()] == [False, True, True, False]


def test_flag_to_bool_three_valued(spark):
    df = spark.createDataFrame([("1",), ("0",), ("x",), (None,), ("2",)], "f string")
    assert [r[0] for r in df.select(sc.flag_to_bool("f")).collect()] == [True, False, None, None, False]


def test_clamp_and_ceil_step(spark):
    xs = [0.1, 0.25, 3.0, 3.01, 6.25, 7.0, None]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(sc.ceil_step(sc.clamp("x", 0.25, 6.25), 0.25)).collect()]
    assert got == [0.25, 0.25, 3.0, 3.25, 6.25, 6.25, None]


def test_place_name_fallback(spark):
    rows = [("A", "t", "r"), (None, "T", "r"), ("", None, "R"), ("  ", "", None)]
    df = spark.createDataFrame(rows, "city string, town string, road string")
    got = [r[0] for r in df.select(sc.place_name_fallback("city", "town", "road")).collect()]
    assert got == ["A", "T", "R", None]


def test_remaining_days_always_positive(spark):
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 31), dt.date(2024, 2, 29), dt.date(2023, 12, 15)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert [r[0] for r in df.select(sc.remaining_days("d")).collect()] == [31, 1, 1, 17]


def test_area_only_when_four_parts(spark):
    rows = [(["US", "CA", "LA County", "LA"],), (["US", "CA", "LA"],), ([],), (None,)]
    df = spark.createDataFrame(rows, "a array<string>")
    got = [tuple(r) for r in df.select(*area_columns("a").values()).collect()]
    assert got[0] == ("US", "CA", "LA County", "LA")
    assert got[1:] == [(None,) * 4] * 3


def test_guarded_ratios(spark):
    df = spark.createDataFrame([(10.0, 0.0), (10.0, 4.0), (1.0, -1.0)], "n double, d double")
    got = df.select(sc.ratio_if_positive("n", "d"), sc.ratio_nullif("n", "d")).collect()
    assert [tuple(r) for r in got] == [(None, None), (2.5, 2.5), (None, -1.0)]
