"""Stored state: runs that read their state tables from a folder and keep what they change there.

Every state table is replaced by key (``sinks.keyed``), so the runs of several servers, and a redo beside an
hourly run, keep each other's rows. Rows that depend on stored ones go through ``keyed.update``, which works
them out again if another run has written the same keys meanwhile.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..constants import OUTPUT_UTC_OFFSET_HOURS, Settings
from ..functions import clock
from ..operators import lag, zones
from ..sinks import files, keyed
from ..sinks.wagers import WagerTable
from . import hourly, watch

_STATE = {"batch_status": "batch_status", "type_timezone": "type_timezone", "lag_status": "lag_status",
          "lag_runs": "lag_run_status", "isolated": "isolated_types"}


class Store:
    """State tables and rollup below one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.rollup = f"{self.root}/rollup"
        self.wagers = WagerTable(spark, f"{self.root}/wagers")

    def table(self, name: str) -> keyed.Keyed:
        return files.state_table(f"{self.root}/state", name)

    def read(self, name: str) -> DataFrame:
        return keyed.read(self.spark, self.table(name))

    def put(self, name: str, rows: DataFrame) -> None:
        """Rows in place of those of the same keys."""
        keyed.put(self.spark, self.table(name), files.stored(rows, name))

    def save(self, changes: dict[str, DataFrame]) -> None:
        for name, rows in changes.items():
            if not rows.isEmpty():
                self.put(name, rows)

    def inputs(self, base: hourly.Inputs) -> hourly.Inputs:
        """``base`` with the stored state tables."""
        return replace(base, **{field: self.read(name) for field, name in _STATE.items()})

    def maintain(self, keep_seconds: float = 86_400) -> None:
        """Merges versions and deletes what nobody reads any more."""
        for table in [files.rollup_table(self.rollup), *map(self.table, files.STATE_KEYS)]:
            keyed.compact(self.spark, table)
            keyed.expire(self.spark, table, keep_seconds)
        self.wagers.maintain(keep_seconds)


def run_hour(store: Store, base: hourly.Inputs, batch_utc: dt.datetime) -> hourly.Result:
    """One batch hour on stored state."""
    result = hourly.run_hour(store.inputs(base), batch_utc, store.rollup)
    store.save(result.changes)
    return result


def run_redo(store: Store, base: hourly.Inputs, batch_utc: dt.datetime, **options: bool) -> hourly.Result:
    """Every failed hour that the lag check has cleared, on stored state."""
    result = hourly.run_redo(store.inputs(base), batch_utc, store.rollup, **options)
    store.save(result.changes)
    return result


def observe_and_check(
    store: Store, wagers: DataFrame | None, lookup: DataFrame, game_lookup: DataFrame, server_lookup: DataFrame,
    type_timezone: DataFrame, targets: DataFrame, utc: dt.datetime, settings: Settings = Settings(),
) -> DataFrame:
    """The readings of an hour, its lag rows and the finished marker, stored; gives the alert rows.

    Without ``wagers`` the readings come from the zones of the store's own, as loaded by that hour. A second run
    of the hour replaces its rows. Readings that come late are seen by ``recheck``.
    """
    at, current = clock.as_ntz(utc), utc + dt.timedelta(hours=OUTPUT_UTC_OFFSET_HOURS)
    history = watch.run_observe(wagers, lookup, store.read("tz_observations").filter(F.col("Batch_time") < at),
                                server_lookup, utc, settings,
                                None if wagers is not None else zones.readings_until(store.wagers.current(), at))
    store.put("tz_observations", history.filter(F.col("Batch_time") == at))
    result = watch.run_lag_check(
        lookup, game_lookup, store.read("tz_observations"), type_timezone, targets,
        store.read("lag_status"), store.read("lag_run_status"), utc, settings,
    )
    alert_rows = files.stored(result.alert_rows, "alerts")
    own = F.col("DatePlayed") == clock.as_ntz(current)
    store.save({"lag_status": result.lag_status.filter(own), "lag_run_status": result.lag_runs.filter(own)})
    return alert_rows


def recheck(store: Store) -> None:
    """Waiting hours whose source has caught up become ReRun, as of the newest stored readings."""
    def change(old: DataFrame) -> tuple[DataFrame, DataFrame]:
        rows = files.stored(lag.recheck_lag(old, store.read("tz_observations")), "rechecked")
        moved = rows.subtract(old.select(*rows.columns))
        return moved, moved

    keyed.update(store.spark, store.table("lag_status"), change)


def analyse_timezones(
    store: Store, first_servers: list[str], second_servers: list[str], lookup: DataFrame, raw_data_info: DataFrame,
    game_lookup: DataFrame, at: dt.datetime,
) -> watch.TimezoneResult:
    """Infers and compares timezones from the stored readings; where nothing changed, stores what is merged."""
    results = []

    def change(old: DataFrame) -> tuple[DataFrame, DataFrame]:
        results.append(watch.run_timezone_analysis(
            store.read("tz_observations"), first_servers, second_servers, lookup, raw_data_info, game_lookup, old, at
        ))
        new = results[-1].type_timezone if results[-1].merged else old.limit(0)
        return new, new

    keyed.update(store.spark, store.table("type_timezone"), change)
    return results[-1]
