"""Conditions that must hold before an hour may run. Each gate is evaluated once; callers retry."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import SUCCESS, UPDATING
from ..functions import clock
from ..sources.tables import on_server


def gate_lookup_fresh(hours: DataFrame, update_status: DataFrame) -> DataFrame:
    """(current, ready) per hour: a finished lookup update at or after the hour exists.

    The latest finished update answers for every hour, so it is one scalar.
    """
    done = update_status.filter(F.col("LookUpNewStatus") == 1)
    latest = done.select(F.max("LookUpNewUpdateTime")).scalar()
    return hours.select(
        "current", F.coalesce(latest >= F.col("current"), F.lit(False)).alias("ready")
    )


def gate_lag_done(hours: DataFrame, lag_run_status: DataFrame) -> DataFrame:
    """(current, ready) per hour: the lag check of that hour finished."""
    done = lag_run_status.filter(F.col("Status") == SUCCESS)
    done = done.select(F.col("DatePlayed").alias("current"), F.lit(True).alias("done")).distinct()
    return hours.join(done, "current", "left").select(
        "current", F.coalesce("done", F.lit(False)).alias("ready")
    )


def mark_lag_run(lag_run_status: DataFrame, finished: DataFrame) -> DataFrame:
    """Lag-run markers with the finished hours (DatePlayed) turned to Success."""
    done = finished.select("DatePlayed", F.lit(SUCCESS).alias("new")).distinct()
    return lag_run_status.join(done, "DatePlayed", "left").select(
        "DatePlayed", F.coalesce("new", "Status").alias("Status")
    )


def open_lag_run(hours: DataFrame) -> DataFrame:
    """Markers of lag runs that have begun."""
    return hours.select("DatePlayed", F.lit(UPDATING).alias("Status"))


def in_current_month(lookup: DataFrame, current: Column | dt.datetime) -> DataFrame:
    month = clock.month_code(clock.as_ntz(current))
    return lookup.filter(F.col("MonthDB").isNull() | (F.col("MonthDB") == month))


def ambiguous_mappings(
    lookup: DataFrame, current: Column | dt.datetime, link_server: str | None = None
) -> DataFrame:
    """Sources of games that the current month maps more than once.

    Counting looks at the output-clock month and at all servers; the listing at all months.
    """
    twice = (
        in_current_month(lookup, current)
        .groupBy("GameTypeSourceId").agg(F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") >= 2) & F.col("GameTypeSourceId").isNotNull())
    )
    named = ["LinkServerName", "DBName", "MonthDB", "TableName", "Type"]
    hit = lookup.join(twice, "GameTypeSourceId", "left_semi")
    return on_server(hit.select(*named).distinct(), link_server)


def missing_timezones(
    lookup: DataFrame, type_timezone: DataFrame, link_server: str | None = None
) -> DataFrame:
    """Types in the lookup that have no timezone row."""
    types = on_server(lookup, link_server).select("Type").distinct()
    return types.join(type_timezone.select("Type").distinct(), "Type", "left_anti")


def heal_timezones(
    lookup: DataFrame,
    raw_data_info: DataFrame,
    missing: DataFrame,
    current: Column | dt.datetime,
) -> DataFrame:
    """Timezone rows for missing Types, as declared by any server's current source.

    A Type that declares two timezones yields two rows; ``conflicting_timezones`` shows them.
    """
    present = in_current_month(lookup, current).select("Type").distinct()
    wanted = missing.select("Type").distinct().join(present, "Type", "left_semi")
    found = raw_data_info.select("Type", "Timezone").distinct()
    return found.join(wanted, "Type", "left_semi").select(
        "Type", "Timezone", clock.as_ntz(current).alias("UpdateTime"),
        F.lit(SUCCESS).alias("Status"),
    )


def conflicting_timezones(timezones: DataFrame) -> DataFrame:
    """Types with more than one timezone."""
    per_type = timezones.groupBy("Type").agg(
        F.min("Timezone").alias("lowest"), F.max("Timezone").alias("highest")
    )
    return per_type.filter(F.col("lowest") != F.col("highest"))
