import datetime as dt

from pyspark.sql import functions as F

from aerolake.codes import CODE_NOT_FOUND, JUSTIFICATIONS
from aerolake.functions import (day_period, decode, delay_minutes, in_box, orient,
                                parse_coordinates, parse_local_time, route_key, valid_local_time,
                                weekday_label)
from aerolake.functions.times import calendar_parts
from conftest import rows


def test_decode_null_known_unknown(spark):
    df = spark.createDataFrame([(None,), ("AA",), ("??",)], "c string")
    out = rows(df.select(decode("c", JUSTIFICATIONS, CODE_NOT_FOUND)))
    assert out == [(None,), (JUSTIFICATIONS["AA"],), (CODE_NOT_FOUND,)]


def test_decode_shared_label_codes(spark):
    df = spark.createDataFrame([("OA",), ("XB",)], "c string")
    assert rows(df.select(decode("c", JUSTIFICATIONS, CODE_NOT_FOUND))) == [("AUTORIZADO",)] * 2


def test_parse_local_time_lenient(spark):
    texts = ["2021-01-15 10:00:00", "15/01/2021 10:00", "2021-01-15", "2021-01-15 10:00:00.5",
             "2021-02-30 10:00:00", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = [r[0] for r in rows(df.select(parse_local_time("t")))]
    assert out == [dt.datetime(2021, 1, 15, 10, 0), None, None, None, None, None]


def test_gap_and_overlap_detected(spark):
    df = spark.createDataFrame([("2018-11-04 00:30:00",), ("2018-02-17 23:30:00",),
                                ("2021-06-01 12:00:00",)], "t string")
    out = [r[0] for r in rows(df.select(valid_local_time(parse_local_time("t"))))]
    assert out == [False, False, True]


def test_delay_minutes_threshold_edges(spark):
    planned = "2021-03-10 10:00:00"
    reals = ["2021-03-10 10:15:00", "2021-03-10 10:15:59", "2021-03-10 10:16:00",
             "2021-03-10 09:50:30"]
    df = spark.createDataFrame([(planned, r) for r in reals], "p string, r string")
    out = [r[0] for r in rows(df.select(delay_minutes(parse_local_time("p"), parse_local_time("r"))))]
    assert out == [15, 15, 16, -9]          # truncation toward zero


def test_delay_minutes_counts_real_time_across_dst(spark):
    # DST ended 2018-02-18 00:00 → 2018-02-17 23:00; 22:30 → 23:30 local is 2 real hours.
    df = spark.createDataFrame([("2018-02-17 22:30:00", "2018-02-18 00:30:00")], "p string, r string")
    assert rows(df.select(delay_minutes(parse_local_time("p"), parse_local_time("r")))) == [(180,)]


def test_calendar_parts_iso_weekday(spark):
    df = spark.createDataFrame([("2024-01-01 05:00:00",), ("2024-01-07 23:59:00",)], "t string")
    parts = calendar_parts(parse_local_time("t"))
    out = rows(df.select(parts["ano"], parts["dia_sem"], parts["hora"]))
    assert out == [(2024, 1, 5), (2024, 7, 23)]


def test_day_period_bounds(spark):
    hours = [0, 5, 6, 11, 12, 17, 18, 23, None]
    df = spark.createDataFrame([(h,) for h in hours], "h int")
    out = [r[0] for r in rows(df.select(day_period("h")))]
    assert out == ["Madrugada"] * 2 + ["Manhã"] * 2 + ["Tarde"] * 2 + ["Noite"] * 3


def test_weekday_label_correct_mapping(spark):
    df = spark.createDataFrame([(1,), (7,), (3,), (None,)], "d int")
    assert [r[0] for r in rows(df.select(weekday_label("d")))] == ["Seg", "Dom", "Qua", "Dom"]


def test_route_key_null(spark):
    df = spark.createDataFrame([("A", "B"), (None, "B")], "o string, d string")
    assert [r[0] for r in rows(df.select(route_key("o", "d")))] == ["A-B", None]


COORDS = [
    ("-46.47, -23.43", "auto", (-46.47, -23.43), True),
    ("-23.43,-46.47", "auto", (-46.47, -23.43), True),
    ("-23.43,-46.47", "lat,lon", (-46.47, -23.43), True),
    (" -46.47 ,  -23.43 ", "lon,lat", (-46.47, -23.43), True),
    ("-9.13, 38.77", "auto", None, False),
    (None, "auto", None, False),
    ("", "auto", None, False),
    ("-46.47", "auto", None, False),
    ("a,b", "auto", None, False),
    ("1d,2", "auto", None, False),
    ("-30,-30", "auto", (-30.0, -30.0), True),
]


def test_coordinates_fixture_cases(spark):
    for text, fmt, expected, valid in COORDS:
        df = spark.createDataFrame([(text,)], "t string")
        a, b = parse_coordinates(F.col("t"))
        lon, lat = orient(a, b, fmt)
        got = rows(df.select(lon, lat, in_box(lon, lat)))[0]
        assert bool(got[2]) is valid, (text, fmt, got)
        if expected is not None:
            assert (got[0], got[1]) == expected, (text, fmt, got)
