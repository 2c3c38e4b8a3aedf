"""One batch hour and one redo.

The driver looks at one row per gate; all rows stay with the executors. A run that dies can be
started again: rollup rows are replaced by key. A result has the state tables as they are after the run,
and in ``changes`` the rows that the run puts, by table; ``plans.store`` keeps those.
"""

from __future__ import annotations

import datetime as dt
import time
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..constants import FAIL, LEDGER_KEYS, OUTPUT_UTC_OFFSET_HOURS, Settings
from ..functions import clock
from ..functions.failures import FAILURES, is_transient
from ..functions.joins import hour_join
from ..operators import alerts, gates, ledger, manifest, redo, rollup, routing
from ..sinks import files
from ..sources import tables
from .isolation import failing


@dataclass
class Inputs:
    """The tables a run reads.

    ``excluded`` holds the excluded Types, ``unreadable`` sources without read right, ``isolated`` Types that
    failed alone before, ``chosen`` which copy of a lookup table is read.
    """

    wagers: DataFrame
    lookup: DataFrame
    excluded: DataFrame
    type_timezone: DataFrame
    raw_data_info: DataFrame
    site_group: DataFrame
    server_lookup: DataFrame
    lookup_updates: DataFrame
    lag_status: DataFrame
    lag_runs: DataFrame
    batch_status: DataFrame
    settings: Settings = field(default_factory=Settings)
    unreadable: DataFrame | None = None
    isolated: DataFrame | None = None
    chosen: dict[str, str] = field(default_factory=dict)


LOOKUPS = (
    "type_timezone", "raw_data_info", "site_group", "server_lookup", "lag_status",
    "batch_status",
)


def read_inputs(
    spark: SparkSession,
    folder: str,
    backup: str,
    wagers: DataFrame,
    unreadable: str | None = None,
    settings: Settings = Settings(),
) -> Inputs:
    """Inputs from ``folder``, a Parquet table per logical name.

    A table that can't be opened, or has a file that can't be read, falls back to its copy in ``backup``, the
    excluded Types to the fixed ids; ``unreadable`` is a CSV file.
    """
    chosen: dict[str, str] = {}

    def read(name: str) -> DataFrame:
        table, chosen[name] = tables.choose_copy(spark, name, f"{folder}/{name}", f"{backup}/{name}")
        return table

    return Inputs(
        wagers=wagers, lookup=read("source_lookup"),
        excluded=tables.excluded_or_fallback(spark, f"{folder}/game_lookup"),
        lookup_updates=read("lookup_update_status"), lag_runs=read("lag_run_status"),
        settings=settings, unreadable=unreadable and tables.read_unreadable(spark, unreadable),
        **{name: read(name) for name in LOOKUPS}, chosen=chosen,
    )


@dataclass
class Result:
    """State tables after a run; ``blocked`` names the gate that stopped it."""

    batch_status: DataFrame
    type_timezone: DataFrame
    lag_status: DataFrame
    blocked: str | None = None
    alert_rows: DataFrame | None = None
    changes: dict[str, DataFrame] = field(default_factory=dict)


def _one_hour(inputs: Inputs, current: dt.datetime) -> DataFrame:
    one = inputs.batch_status.sparkSession.range(1)
    return one.select(clock.as_ntz(current).alias("current"))


def closed_gate(inputs: Inputs, current: dt.datetime) -> tuple[str, DataFrame] | None:
    """The first gate that lets no server through, with its alert rows."""
    hour = _one_hour(inputs, current)
    fresh = gates.gate_lookup_fresh(hour, inputs.lookup_updates)
    if not fresh.first()["ready"]:
        return "lookup", alerts.gate_alerts(fresh, "Lookup update")
    lag_gate = gates.gate_lag_done(hour, inputs.lag_runs)
    if not lag_gate.first()["ready"]:
        return "lag", alerts.gate_alerts(lag_gate, "Lag check")
    return None


def ambiguous_servers(inputs: Inputs, current: dt.datetime) -> DataFrame | None:
    """Ambiguous sources where there are any; they stop their own server only."""
    twice = gates.ambiguous_mappings(inputs.lookup, current)
    return None if twice.isEmpty() else twice


def listed_games(inputs: Inputs, twice: DataFrame | None) -> DataFrame:
    """Lookup rows to work on: without excluded games and without stopped servers."""
    listed = tables.drop_excluded(inputs.lookup, inputs.excluded, inputs.settings)
    if twice is None:
        return listed
    stopped = twice.select("LinkServerName").distinct()
    return listed.join(stopped, "LinkServerName", "left_anti").select(*listed.columns)


def _found_timezones(inputs: Inputs, current: dt.datetime) -> DataFrame:
    missing = gates.missing_timezones(inputs.lookup, inputs.type_timezone)
    return gates.heal_timezones(inputs.lookup, inputs.raw_data_info, missing, current)


def healed_timezones(inputs: Inputs, current: dt.datetime) -> DataFrame:
    """Stored timezones plus those that the sources of missing Types declare."""
    return inputs.type_timezone.unionByName(_found_timezones(inputs, current), allowMissingColumns=True)


def _held(inputs: Inputs, lag_rows: DataFrame, work: DataFrame) -> DataFrame:
    """What is not run: Types whose source is late, or may not be read."""
    held = ledger.not_ready(lag_rows)
    if inputs.unreadable is None:
        return held
    closed = tables.exclude_unreadable(work, inputs.unreadable, "left_semi")
    return held.unionByName(closed.select(*held.columns)).distinct()


def _stored_hours(spark, path: str, due: DataFrame) -> DataFrame:
    """What the sink now holds for the due keys, read from the folders of their days only."""
    low, high = due.select(F.min("DatePlayed"), F.max("DatePlayed")).first()
    if low is None:
        low = high = "1970-01-01 00:00:00"
    return files.read_rollup(spark, path, clock.as_ntz(low), clock.as_ntz(high))


Place = tuple[str, int]  # LinkServerName, Type


def _of(places: list[Place]) -> Column:
    """Whether a row belongs to one of some Types of some servers."""
    types: dict[str, list[int]] = {}
    for server, one in places:
        types.setdefault(server, []).append(one)
    test = F.lit(False)
    for server, own in types.items():
        test = test | ((F.col("LinkServerName") == server) & F.col("Type").isin(own))
    return test


def _write(routed: DataFrame, due: DataFrame, path: str, alone: list[Place]) -> list[Place]:
    """Types that could not be read; the rows of the others are stored.

    One job writes all. If it fails, the Types, few per game provider and sorted by server, are halved until
    those stand alone whose source can't be read. A folder that can't be written fails them all at once.
    """
    places = [tuple(r) for r in due.select("LinkServerName", "Type").distinct().collect()]
    places.sort(key=str)
    if not files.can_write(routed.sparkSession, path):
        return places

    def attempt(part: list[Place]) -> None:
        whole = len(part) == len(places)
        files.write_rollup(*((routed, due) if whole else (routed.filter(_of(part)), due.filter(_of(part)))), path)

    return failing(places, attempt, alone)


def _write_and_judge(
    inputs: Inputs, work: DataFrame, routed: DataFrame, due: DataFrame, held: DataFrame, path: str
) -> tuple[DataFrame, DataFrame]:
    """Ledger rows of the work after writing it, and the Types that fail, or no longer fail, alone.

    The seconds are those of the whole run: all Types share its jobs.
    """
    spark, began = work.sparkSession, time.monotonic()
    alone = [] if inputs.isolated is None else [
        (r["LinkServerName"], r["Type"]) for r in inputs.isolated.filter("NOT healthy").collect()
    ]
    failed = _write(routed, due, path, alone)
    lost = _of(failed)
    stored = _stored_hours(spark, path, due.filter(~lost)) if failed else _stored_hours(spark, path, due)
    outcome = ledger.batch_outcome(
        work, stored.filter(~lost), held, inputs.server_lookup,
        work.filter(lost).select("LinkServerName", "Type", "DatePlayed"), time.monotonic() - began,
    )
    rows = [(*p, False) for p in failed] + [(*p, True) for p in alone if p not in failed]
    apart = spark.createDataFrame(rows, "LinkServerName string, Type int, healthy boolean")
    return outcome, apart


def run_hour(inputs: Inputs, batch_utc: dt.datetime, rollup_path: str) -> Result:
    """Gates, manifest, rollup, routing, write and ledger of one batch hour.

    If a table other than the wagers can't be read, the hour fails as behind a closed gate.
    """
    current = batch_utc + dt.timedelta(hours=OUTPUT_UTC_OFFSET_HOURS)
    try:
        closed = closed_gate(inputs, current)
        if closed is None:
            return _run_open_hour(inputs, batch_utc, current, rollup_path)
    except FAILURES as err:
        if is_transient(err):
            raise
        closed = "inputs", None
    fails = ledger.clone_last_as_fail(inputs.batch_status, current)
    return Result(
        ledger.put_rows(inputs.batch_status, fails), inputs.type_timezone, inputs.lag_status,
        closed[0], closed[1], {"batch_status": fails},
    )


def _run_open_hour(inputs: Inputs, batch_utc: dt.datetime, current: dt.datetime, rollup_path: str) -> Result:
    twice = ambiguous_servers(inputs, current)
    listed = listed_games(inputs, twice)
    found = files.stored(_found_timezones(inputs, current), "found_timezones")
    zones = inputs.type_timezone.unionByName(found, allowMissingColumns=True)
    source_spans = files.stored(manifest.spans(
        manifest.list_sources(listed), zones, batch_utc, batch_utc, inputs.settings
    ), "spans")
    # Every later step asks for these again.
    work = files.stored(manifest.expand(source_spans, inputs.settings), "work")
    held = files.stored(_held(
        inputs, inputs.lag_status.filter(F.col("DatePlayed") == clock.as_ntz(current)), work
    ), "held")
    if inputs.unreadable is not None:
        source_spans = tables.exclude_unreadable(source_spans, inputs.unreadable)
    # Held Types and Types without a window keep what is stored of them.
    due = routing.expected_destinations(ledger.runnable(work, held), inputs.server_lookup)
    rows = rollup.hourly_rollup(
        tables.within_batches(inputs.wagers, [(batch_utc, batch_utc)]), source_spans,
        manifest.game_list(listed), inputs.settings,
    )
    routed = routing.route(
        rollup.without_held(rows, held), inputs.site_group, inputs.server_lookup
    )
    outcome, apart = _write_and_judge(inputs, work, routed, due, held, rollup_path)
    started = ledger.start_status(work, inputs.server_lookup).distinct()
    put = ledger.apply_status(started, outcome)
    status = ledger.put_rows(inputs.batch_status, put)
    apart = apart.withColumn("since", clock.as_ntz(current))
    changes = {"batch_status": put, "type_timezone": found, "isolated_types": apart}
    if twice is None:
        return Result(status, zones, inputs.lag_status, changes=changes)
    names = inputs.server_lookup.join(twice, "LinkServerName", "left_semi").select("Server")
    stopped = inputs.batch_status.join(names.distinct(), "Server", "left_semi")
    fails = ledger.clone_last_as_fail(stopped.select(*ledger.LEDGER), current)
    changes["batch_status"] = ledger.put_rows(put, fails)
    return Result(
        ledger.put_rows(status, fails), zones, inputs.lag_status, "mapping",
        alerts.mapping_alerts(twice, current), changes,
    )


def _batches(wanted: DataFrame) -> list[tuple[dt.datetime, dt.datetime]]:
    """First and last batch hour (UTC) of each run of days in which hours are redone."""
    days = wanted.select(clock.output_to_utc(F.col("UpDateTime")).cast("date").alias("d")).distinct()
    out: list[tuple[dt.datetime, dt.datetime]] = []
    for day in sorted(r["d"] for r in days.collect()):  # a row per day of the calendar
        first = dt.datetime.combine(day, dt.time())
        last = first + dt.timedelta(hours=23)
        if out and first - out[-1][1] <= dt.timedelta(days=1):
            out[-1] = out[-1][0], last
        else:
            out.append((first, last))
    return out


def run_redo(
    inputs: Inputs,
    batch_utc: dt.datetime,
    rollup_path: str,
    all_destinations: bool = False,
    close_failed: bool = False,
) -> Result:
    """Every failed hour that the lag check has cleared, in one job.

    Held rows are those of the redone hour, not of the present one. A gate that is closed for the
    present hour stops the redo without a trace in the ledger.
    """
    servers, settings = inputs.server_lookup, inputs.settings
    current = batch_utc + dt.timedelta(hours=OUTPUT_UTC_OFFSET_HOURS)
    closed = closed_gate(inputs, current)
    if closed is not None:
        return Result(
            inputs.batch_status, inputs.type_timezone, inputs.lag_status, closed[0], closed[1]
        )
    wanted = files.stored(
        redo.redo_candidates(inputs.batch_status, servers, inputs.lag_status), "redo"
    )
    if wanted.isEmpty():
        return Result(inputs.batch_status, inputs.type_timezone, inputs.lag_status)
    running = ledger.mark_running(inputs.batch_status, wanted.select(*LEDGER_KEYS))
    listed = listed_games(inputs, ambiguous_servers(inputs, current))
    found = _found_timezones(inputs, current)
    zones = inputs.type_timezone.unionByName(found, allowMissingColumns=True)
    work = files.stored(redo.redo_manifest(wanted, listed, zones, servers, settings), "redo_work")
    held = files.stored(_held(inputs, inputs.lag_status, work), "redo_held")
    free = ledger.runnable(work, held)
    wagers = tables.within_windows(inputs.wagers, free)
    if wagers is None:  # too many scattered hours for literals
        wagers = tables.within_batches(inputs.wagers, _batches(wanted))
    routed = redo.redo_rollup(
        wanted, free, wagers, manifest.game_list(listed),
        inputs.site_group, servers, settings, all_destinations,
    )
    due = routing.expected_destinations(free, servers).select(
        "LinkServerName", "Server", "Type", "Destination", "DatePlayed"
    ).distinct()
    if not all_destinations:
        asked = wanted.withColumnRenamed("UpDateTime", "DatePlayed")
        due = hour_join(due, asked, ["Server", "Type", "Destination", "DatePlayed"], "left_semi")
    outcome, apart = _write_and_judge(inputs, work, routed, due, held, rollup_path)
    outcome = outcome if all_destinations else redo.redo_outcome(wanted, outcome)
    outcome = files.stored(outcome, "redo_outcome")
    # What no source is listed for any more stays failed.
    asked = hour_join(running, wanted, LEDGER_KEYS, "left_semi")
    lost = hour_join(asked, outcome, LEDGER_KEYS, "left_anti").withColumn("Status", F.lit(FAIL))
    updates = outcome.unionByName(lost.select(*outcome.columns))
    status = ledger.apply_status(running, updates)
    lag_rows = redo.close_redo(inputs.lag_status, updates, servers, close_failed)
    put = ledger.apply_status(hour_join(running, updates, LEDGER_KEYS, "left_semi"), updates)
    changed = {
        "batch_status": put, "type_timezone": found, "isolated_types": apart.withColumn("since", clock.as_ntz(current)),
        "lag_status": lag_rows.subtract(inputs.lag_status.select(*lag_rows.columns)),
    }
    return Result(status, zones, lag_rows, changes=changed)
