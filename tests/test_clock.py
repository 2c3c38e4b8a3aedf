import pytest
from pyspark.sql import functions as F

from hourfold.functions import clock, text


def value(spark, expr):
    out = spark.range(1).select(expr.alias("v")).first()["v"]
    return str(out) if hasattr(out, "year") else out


def ts(s):
    return F.lit(s).cast("timestamp_ntz")


@pytest.mark.parametrize("earlier, later, want", [
    ("2024-01-01 00:00:59", "2024-01-01 00:01:00", 1),
    ("2024-01-01 00:00:00", "2024-01-01 00:00:59.999", 0),
    ("2024-01-01 08:00:30", "2024-01-01 00:00:10", -480),
    ("2023-12-31 23:59:59", "2024-01-01 01:00:00", 61),
])
def test_minutes_crossed_counts_boundaries(spark, earlier, later, want):
    assert value(spark, clock.minutes_crossed(ts(earlier), ts(later))) == want


def test_floors_keep_the_wall_clock(spark):
    t = ts("2024-03-10 02:34:56.789123")
    assert value(spark, clock.hour_floor(t)) == "2024-03-10 02:00:00"
    assert value(spark, clock.minute_floor(t)) == "2024-03-10 02:34:00"
    assert value(spark, clock.millisecond_floor(t)) == "2024-03-10 02:34:56.789000"


def test_floors_do_not_depend_on_the_session_timezone(spark):
    """02:30 does not exist in New York on that day."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        t = spark.range(1).select(F.lit("2024-03-10 02:34:56").cast("timestamp_ntz").alias("t"))
        out = t.select(
            clock.hour_floor(F.col("t")).cast("string").alias("h"),
            clock.plus_hours(F.col("t"), 1).cast("string").alias("p"),
            clock.minutes_crossed(ts("2024-03-10 00:00:00"), F.col("t")).alias("m"),
        ).first()
        assert tuple(out) == ("2024-03-10 02:00:00", "2024-03-10 03:34:56", 154)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_month_codes(spark):
    assert value(spark, clock.month_code(ts("2009-07-31 23:59:59"))) == "0907"
    assert value(spark, clock.month_first(F.lit("0907"))) == "2009-07-01 00:00:00"


def test_window_of_a_batch(spark):
    b = ts("2024-01-01 00:00:00")
    assert value(spark, clock.window_start(b, F.lit(-4))) == "2023-12-31 19:00:00"
    assert value(spark, clock.window_end(b, F.lit(8))) == "2024-01-01 08:00:00"
    assert value(spark, clock.window_end(b, F.lit(None).cast("int"))) is None
    assert value(spark, clock.run_threshold(b, F.lit(8))) == "2024-01-01 07:50:00"


@pytest.mark.parametrize("minutes, hours, rest", [(-470.0, 8, 10.0), (257.4, -4, 17.4), (59.0, 0, 59.0)])
def test_offset_split_rounds_down(spark, minutes, hours, rest):
    assert value(spark, clock.offset_hours(F.lit(minutes))) == hours
    assert value(spark, clock.offset_rest(F.lit(minutes))) == pytest.approx(rest)


def test_text_keys(spark):
    assert value(spark, text.account_key(F.lit("UsEr1 "))) == "user1 "
    assert value(spark, text.account_key(F.lit("UsEr1 "), trim_trailing=True)) == "user1"
    assert value(spark, text.status_is(F.lit("wait"), "Wait")) is True
