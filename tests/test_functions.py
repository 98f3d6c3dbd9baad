from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ampflow.config import AGE_BAND, MARKET_BAND, TENURE_BAND, BoundingBox
from ampflow.functions import calendar, measures, parsing


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("2025-03-01T10:11:12", datetime(2025, 3, 1, 10, 11, 12)),
        ("2025-03-01 10:11:12.5", datetime(2025, 3, 1, 10, 11, 12, 500000)),
        ("2025-03-01T10:11:12+02:00", datetime(2025, 3, 1, 10, 11, 12)),
        ("2025-02-30 00:00:00", None),
        ("soon", None),
        (None, None),
    ],
)
def test_safe_timestamp(spark, text, expected):
    assert one(spark, parsing.safe_timestamp(F.lit(text).cast("string"))) == expected


@pytest.mark.parametrize(
    "text,expected",
    [("1.755", "1.76"), ("-1.755", "-1.76"), ("99999999.99", "99999999.99"), ("100000000", None), ("abc", None), ("", None)],
)
def test_safe_decimal(spark, text, expected):
    got = one(spark, parsing.safe_decimal(F.lit(text), 10, 2))
    assert (None if got is None else str(got)) == expected


@pytest.mark.parametrize(
    "email,ok",
    [("a.b+c@x-y.ch", True), ("a@b", False), ("@b.ch", False), ("a@b.c", False), ("a b@c.ch", False), (None, None)],
)
def test_email(spark, email, ok):
    assert one(spark, parsing.is_valid_email(F.lit(email).cast("string"))) is ok


def test_minutes_count_boundaries(spark):
    def minutes(a, b):
        return one(spark, calendar.minutes_between(F.lit(a).cast("timestamp_ntz"), F.lit(b).cast("timestamp_ntz")))

    assert minutes("2025-01-01 00:00:59", "2025-01-01 00:01:01") == 1
    assert minutes("2025-01-01 00:00:01", "2025-01-01 00:00:59") == 0
    assert minutes("2024-12-31 23:59:59", "2025-01-01 00:00:00") == 1
    assert minutes("2025-01-01 00:10:00", "2025-01-01 00:00:00") == -10


def test_times_ignore_the_session_zone(spark):
    """The clock change of 2025-03-30 in Zurich must not shorten a zone-less interval."""
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Zurich")
        a, b = (F.lit(t).cast("timestamp_ntz") for t in ("2025-03-30 01:30:00", "2025-03-30 03:30:00"))
        assert one(spark, calendar.minutes_between(a, b)) == 120
        assert one(spark, calendar.hours_between(a, b)) == 2.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_hours_keep_fractions_and_sign(spark):
    a, b = (F.lit(t).cast("timestamp_ntz") for t in ("2025-01-01 00:00:00", "2025-01-01 00:30:00.9"))
    assert one(spark, calendar.hours_between(a, b)) == pytest.approx(1800.9 / 3600)
    assert one(spark, calendar.hours_between(b, a)) == pytest.approx(-1800.9 / 3600)


def test_strip_timezone_reads_utc(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        df = spark.sql("SELECT 1 AS id, TIMESTAMP '2025-01-01 09:00:00+09:00' AS ts, TIMESTAMP_NTZ '2025-01-01 09:00:00' AS n")
        out = parsing.strip_timezone(df)
        assert dict(out.dtypes) == {"id": "int", "ts": "timestamp_ntz", "n": "timestamp_ntz"}
        assert tuple(out.first()) == (1, datetime(2025, 1, 1, 0, 0), datetime(2025, 1, 1, 9, 0))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    "spec,value,label",
    [
        (TENURE_BAND, 29, "New (< 30 days)"),
        (TENURE_BAND, 30, "Recent (30-90 days)"),
        (TENURE_BAND, 365, "Veteran (1+ year)"),
        (TENURE_BAND, -5, "New (< 30 days)"),
        (TENURE_BAND, None, "Veteran (1+ year)"),
        (AGE_BAND, 729, "Established (1-2 years)"),
        (AGE_BAND, None, "Mature (2+ years)"),
        (MARKET_BAND, 1, "Emerging Market"),
        (MARKET_BAND, 2, "Small Market"),
        (MARKET_BAND, 9, "Medium Market"),
        (MARKET_BAND, 10, "Large Market"),
    ],
)
def test_bands(spark, spec, value, label):
    assert one(spark, measures.band(F.lit(value).cast("int"), spec)) == label


@pytest.mark.parametrize(
    "lat,lon,outside",
    [
        (45.817995, 5.955911, False),
        (47.808455, 10.492294, False),
        (47.808456, 10.0, True),
        (46.0, 5.9, True),
        (None, 8.0, True),
        (46.0, None, True),
        (None, 99.0, True),
    ],
)
def test_bounding_box(spark, lat, lon, outside):
    box = BoundingBox()
    assert one(spark, measures.outside_box(F.lit(lat).cast("double"), F.lit(lon).cast("double"), box)) is outside


def test_rounding_modes(spark):
    df = spark.createDataFrame([(1, 32), (3, 32), (0, 0)], "part int, whole int")
    out = df.select(measures.percent(F.col("part"), F.col("whole")), measures.percent_half_even(F.col("part"), F.col("whole")))
    assert [tuple(r) for r in out.collect()] == [(3.13, 3.12), (9.38, 9.38), (None, None)]


def test_flags_are_two_valued(spark):
    df = spark.createDataFrame([(True, None), (None, None), (False, True)], "a boolean, b boolean")
    flags = [F.col("a"), F.col("b")]
    out = df.select(measures.any_of(flags), measures.all_of(flags), measures.count_of(flags))
    assert [tuple(r) for r in out.collect()] == [(True, False, 1), (False, False, 0), (True, False, 1)]


def test_month_label(spark):
    assert one(spark, calendar.month_label(F.lit("2025-03-09 00:00:00").cast("timestamp_ntz"))) == "3-2025"
    assert one(spark, calendar.date_key(F.lit(date(2025, 3, 9)))) == 20250309


def test_haversine(spark):
    km = one(spark, measures.haversine_km(*[F.lit(x) for x in (0.0, 0.0, 0.0, 180.0)]))
    assert km == pytest.approx(6371 * 3.141592653589793)
    assert one(spark, measures.haversine_km(*[F.lit(None).cast("double")] * 4)) is None
