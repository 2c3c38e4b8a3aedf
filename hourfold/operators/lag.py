"""Late sources: status of every hour, the later re-check, and alerts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..constants import RERUN, SUCCESS, UNDECIDED, WAIT, Settings
from ..functions import clock, text
from ..functions.joins import hour_join
from ..schemas import columns

LAG = columns("lag_status")


def latest_observation(obs: DataFrame, as_of: Column | dt.datetime | None = None) -> DataFrame:
    """Newest observation of each Type; among equal batch times the largest reading.

    A maximum over (Batch_time, table_max) instead of a ranking window: it combines before the
    shuffle, so a Type with most of the history costs one row per task.
    """
    if as_of is not None:
        obs = obs.filter(F.col("Batch_time") <= clock.as_ntz(as_of))
    newest = F.max(F.struct("Batch_time", "table_max")).alias("o")
    return obs.groupBy("Type").agg(newest).select("Type", "o.Batch_time", "o.table_max")


def latest_per_hour(
    obs: DataFrame, types: DataFrame, first: Column | dt.datetime, last: Column | dt.datetime
) -> DataFrame:
    """Newest observation at or before every hour in [first, last], for every listed Type.

    Observations are first reduced to one row per (Type, hour that sees them); hours without any
    come from the calendar. So the window that carries them forward holds one row per hour of
    the calendar for each Type, whatever the number of observations.
    """
    low, high = clock.as_ntz(first), clock.as_ntz(last)
    floor = clock.hour_floor(F.col("Batch_time"))
    seen = F.when(floor == F.col("Batch_time"), floor).otherwise(clock.plus_hours(floor, 1))
    readings = obs.join(types.select("Type").distinct(), "Type", "left_semi").select(
        "Type", F.greatest(seen, low).alias("utc"), F.struct("Batch_time", "table_max").alias("o")
    )
    hours = types.select("Type").distinct().select(
        "Type", F.explode(F.sequence(low, high, F.expr("interval 1 hour"))).alias("utc"),
        F.lit(None).alias("o"),
    )
    per_hour = readings.unionByName(hours).groupBy("Type", "utc").agg(F.max("o").alias("o"))
    so_far = (
        Window.partitionBy("Type").orderBy("utc")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    filled = per_hour.filter(F.col("utc") <= high).withColumn("newest", F.max("o").over(so_far))
    return filled.select("Type", "utc", "newest.Batch_time", "newest.table_max")


def lag_structure(lookup: DataFrame, game_lookup: DataFrame) -> DataFrame:
    """(Type, LinkServerName, Category) of everything the lookup lists."""
    listed = lookup.select("Type", "LinkServerName").distinct()
    kinds = game_lookup.select(F.col("RawDataType").alias("Type"), "Category").distinct()
    return listed.join(kinds, "Type", "left").select("Type", "LinkServerName", "Category")


def lag_status(
    structure: DataFrame,
    obs: DataFrame,
    type_timezone: DataFrame,
    target_types: DataFrame,
    first: Column | dt.datetime,
    last: Column | dt.datetime,
    settings: Settings = Settings(),
) -> DataFrame:
    """Lag rows of every hour in [first, last] (UTC).

    Only target Types are judged: Success once the reading reached the threshold, Wait before,
    undecided without a reading or a timezone. All others are Success at once.
    """
    targets = target_types.select("Type", F.lit(True).alias("is_target")).distinct()
    zones = type_timezone.select("Type", "Timezone").distinct()
    readings = latest_per_hour(
        obs.join(targets, "Type", "left_semi"), structure.select("Type"), first, last
    )
    listed = structure.join(targets, "Type", "left").join(zones, "Type", "left")
    due = clock.run_threshold(F.col("utc"), F.col("Timezone"), settings.slack_minutes)
    # A Type that was never observed has no threshold either.
    judged = F.col("is_target") & F.col("Batch_time").isNotNull()
    rows = readings.join(listed, "Type").withColumn("threshold", F.when(judged, due))
    reached = F.col("table_max") >= F.col("threshold")
    status = (
        F.when(F.col("is_target").isNull(), SUCCESS)
        .when(reached, SUCCESS).when(~reached, WAIT).otherwise(UNDECIDED)
    )
    return rows.select(
        clock.utc_to_output(F.col("utc")).alias("DatePlayed"), "LinkServerName", "Type",
        "Category", status.alias("Status"), F.col("table_max").alias("Table_max"),
        F.col("threshold").alias("Run_threshold"),
    )


def recheck_lag(lag: DataFrame, obs: DataFrame) -> DataFrame:
    """Lag rows after a later look: waiting hours whose source caught up become ReRun.

    Readings are cut to milliseconds. Rows that share a waiting row's Type and threshold get the
    new reading too; a Type without an observation gets none.
    """
    newest = latest_observation(obs).select(
        "Type", clock.millisecond_floor(F.col("table_max")).alias("reading")
    )
    waiting = (
        lag.filter(text.status_is(F.col("Status"), WAIT) & F.col("Run_threshold").isNotNull())
        .select("Type", "Run_threshold").distinct().join(newest, "Type", "left")
        .withColumn("looked_at", F.lit(True))
    )
    joined = hour_join(lag, waiting, ["Type", "Run_threshold"], "left")
    reading = F.when(F.col("looked_at"), F.col("reading")).otherwise(F.col("Table_max"))
    caught_up = text.status_is(F.col("Status"), WAIT) & (reading >= F.col("Run_threshold"))
    return joined.select(
        "DatePlayed", "LinkServerName", "Type", "Category",
        F.when(caught_up, RERUN).otherwise(F.col("Status")).alias("Status"),
        reading.alias("Table_max"), "Run_threshold",
    )


def waiting_types(lag: DataFrame, min_hours: int) -> DataFrame:
    """Types with at least ``min_hours`` waiting rows, and since when."""
    held = lag.filter(text.status_is(F.col("Status"), WAIT))
    per_type = held.groupBy("Type").agg(
        F.count(F.lit(1)).alias("n_wait"), F.min("DatePlayed").alias("since")
    )
    return per_type.filter(F.col("n_wait") >= min_hours)


def undecided_hours(lag: DataFrame) -> DataFrame:
    """Hours per Type that stay undecided: neither held back nor ever redone."""
    open_rows = lag.filter(text.status_is(F.col("Status"), UNDECIDED))
    return open_rows.groupBy("Type").agg(F.count(F.lit(1)).alias("n_undecided"))
