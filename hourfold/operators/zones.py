"""Zone maps: of every source, game and day of wagers how many there are, and when the first and last were.

Readings of sources, the choice of days to read and the question whether a window can hold anything are
answered from them, at a row per source, game, load and day instead of a scan of the wagers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import SOURCE_KEYS
from ..functions import clock
from ..functions.joins import hour_join

ZONE_KEYS = [*SOURCE_KEYS, "GameTypeSourceId"]


def day_of(t: Column) -> Column:
    """Midnight of the day; wagers without a time lie in a day of their own that no window meets."""
    return F.coalesce(F.date_trunc("day", t), F.lit("1900-01-01 00:00:00")).cast("timestamp_ntz")


def build(wagers: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Zones of wagers: ``by`` (the Day where not given), source, game, first and last time, number."""
    if by is None:
        wagers, by = wagers.withColumn("Day", day_of(F.col("wagerstime"))), ["Day"]
    return wagers.groupBy(*by, *ZONE_KEYS).agg(
        F.min("wagerstime").alias("first_t"), F.max("wagerstime").alias("last_t"), F.count(F.lit(1)).alias("n")
    )


def newest(zones: DataFrame) -> DataFrame:
    """Newest wager of each source and game."""
    return zones.groupBy(*ZONE_KEYS).agg(F.max("last_t").alias("newest"))


def windows_with_rows(windows: DataFrame, zones: DataFrame) -> DataFrame:
    """Windows [start_t, end_t) of sources that may hold wagers: within the first and last of one of their days.

    The others are empty for certain. Joined by source and day, so a window costs a row per day it meets.
    """
    days = zones.groupBy(*SOURCE_KEYS, "Day").agg(F.min("first_t").alias("first_t"), F.max("last_t").alias("last_t"))
    last = F.timestamp_add("MICROSECOND", F.lit(-1), F.col("end_t"))
    each = F.sequence(day_of(F.col("start_t")), day_of(last), F.expr("interval 1 day"))
    met = windows.filter("start_t < end_t").withColumn("Day", F.explode(each)).alias("w")
    same = F.col("w.Day") == F.col("z.Day")
    for key in SOURCE_KEYS:
        same = same & F.col(f"w.{key}").eqNullSafe(F.col(f"z.{key}"))
    overlap = (F.col("z.first_t") < F.col("w.end_t")) & (F.col("z.last_t") >= F.col("w.start_t"))
    found = hour_join(met, days.alias("z"), same & overlap, "left_semi")
    return found.select(*windows.columns).distinct()


def readings_until(zones: DataFrame, utc: Column) -> DataFrame:
    """Zones of what had been loaded by an hour."""
    return zones.filter(F.col("Loaded") <= clock.as_ntz(utc))
