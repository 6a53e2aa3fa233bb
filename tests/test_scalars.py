import datetime as dt
import math


from tabclass.functions import day_of_week, haversine_km, hour_of_day, parse_timestamp, year_diff


def test_calendar(spark):
    df = spark.createDataFrame([("2024-01-07 13:45:00", "1990-12-31")], "t string, d string")
    r = df.select(
        hour_of_day(parse_timestamp("t")).alias("h"),
        day_of_week(parse_timestamp("t")).alias("w"),
        year_diff(parse_timestamp("t"), parse_timestamp("d")).alias("age"),
    ).first()
    assert (r.h, r.w, r.age) == (13, 1, 34)  # 2024-01-07 is a Sunday; month/day ignored


def test_bad_timestamp_is_null(spark):
    df = spark.createDataFrame([("not a time",), ("2024-02-30 00:00:00",)], "t string")
    assert [r[0] for r in df.select(parse_timestamp("t")).collect()] == [None, None]


def test_parse_with_format(spark):
    df = spark.createDataFrame([("07/01/2024 10:00",)], "t string")
    r = df.select(parse_timestamp("t", "dd/MM/yyyy HH:mm").alias("x")).first()
    assert r.x.replace(tzinfo=None) == dt.datetime(2024, 1, 7, 10, 0)


def test_haversine_properties(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0, 0.0, 0.0), (10.0, 20.0, -30.0, 40.0), (0.0, 0.0, 0.0, 180.0), (90.0, 0.0, -90.0, 0.0)],
        "a double, b double, c double, d double",
    )
    rows = df.select(
        haversine_km("a", "b", "c", "d").alias("x"), haversine_km("c", "d", "a", "b").alias("y")
    ).collect()
    assert rows[0].x == 0.0
    assert all(abs(r.x - r.y) < 1e-9 for r in rows)
    half = math.pi * 6371.0
    assert abs(rows[2].x - half) < 1e-6 and abs(rows[3].x - half) < 1e-6
    assert not any(math.isnan(r.x) for r in rows)
