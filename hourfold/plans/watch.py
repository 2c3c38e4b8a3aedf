"""The lag check of an hour, its ten-minute re-check, and the timezone analysis."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..constants import OUTPUT_UTC_OFFSET_HOURS, Settings
from ..operators import alerts, gates, lag, timezones


@dataclass
class LagResult:
    lag_status: DataFrame
    lag_runs: DataFrame
    alert_rows: DataFrame


def run_lag_check(
    lookup: DataFrame,
    game_lookup: DataFrame,
    obs: DataFrame,
    type_timezone: DataFrame,
    target_types: DataFrame,
    stored_lag: DataFrame,
    stored_runs: DataFrame,
    utc: dt.datetime,
    settings: Settings = Settings(),
) -> LagResult:
    """Lag rows of one hour next to the stored ones, the finished marker, and alerts."""
    seen = obs.filter(F.col("Batch_time") <= F.lit(str(utc)).cast("timestamp_ntz"))
    rows = lag.lag_status(
        lag.lag_structure(lookup, game_lookup), seen, type_timezone, target_types, utc, utc, settings
    )
    current = utc + dt.timedelta(hours=OUTPUT_UTC_OFFSET_HOURS)
    hour = rows.sparkSession.range(1).select(
        F.lit(str(current)).cast("timestamp_ntz").alias("DatePlayed")
    )
    finished = gates.mark_lag_run(gates.open_lag_run(hour), hour)
    # The rows of an hour replace those of an earlier check of it.
    other = ~F.col("DatePlayed").eqNullSafe(F.lit(str(current)).cast("timestamp_ntz"))
    both = stored_lag.filter(other).unionByName(rows)
    return LagResult(
        both, stored_runs.filter(other).unionByName(finished), alerts.lag_alerts(both, settings.alert_hours)
    )


def run_recheck(stored_lag: DataFrame, obs: DataFrame) -> DataFrame:
    """Stored lag rows after a look at the newest observations."""
    return lag.recheck_lag(stored_lag, obs)


def run_observe(
    wagers: DataFrame | None,
    lookup: DataFrame,
    obs: DataFrame,
    server_lookup: DataFrame,
    batch_utc: dt.datetime,
    settings: Settings = Settings(),
    zone_rows: DataFrame | None = None,
) -> DataFrame:
    """Observation history with the readings of this batch; Batch_time is UTC, as its readers expect.

    Readings come from the zones of the wagers where there are any. Else only wagers from the stored readings
    on are read; sources only grow, so a new reading is the larger of the stored one and what is found.
    """
    if zone_rows is not None:
        observed = timezones.observe_zones(zone_rows, lookup, batch_utc, settings)
        return timezones.append_observations(obs, observed, server_lookup, batch_utc)
    known = timezones.known_readings(obs, lookup, server_lookup)
    observed = timezones.observe_source_max(
        timezones.unseen(wagers, known), lookup, batch_utc, settings
    )
    observed = timezones.at_least(observed, known)
    return timezones.append_observations(obs, observed, server_lookup, batch_utc)


@dataclass
class TimezoneResult:
    type_timezone: DataFrame
    changes: DataFrame
    alert_rows: DataFrame
    merged: bool


def run_timezone_analysis(
    obs: DataFrame,
    first_servers: list[str],
    second_servers: list[str],
    lookup: DataFrame,
    raw_data_info: DataFrame,
    game_lookup: DataFrame,
    type_timezone: DataFrame,
    at: dt.datetime,
) -> TimezoneResult:
    """Infer, choose, compare and, where nothing changed, merge."""
    declared = timezones.declared_timezones(lookup, raw_data_info)
    category = timezones.type_category(game_lookup)
    first = obs.filter(F.col("Server").isin(first_servers))
    second = timezones.second_path(obs, first_servers, second_servers)
    chosen = timezones.stack_paths(*[
        timezones.choose_timezone(timezones.infer_timezone(o), declared, category)
        for o in (first, second)
    ])
    changes = timezones.timezone_changes(chosen, type_timezone)
    merged = changes.isEmpty()
    new = timezones.merge_timezones(chosen, type_timezone, at) if merged else type_timezone
    return TimezoneResult(new, changes, alerts.timezone_alerts(changes), merged)
