"""Failed hours whose source has caught up: find them, run them again, close them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..constants import EMPTY, FAIL, LEDGER_KEYS, RERUN, SUCCESS, Settings
from ..functions import clock, text
from ..functions.joins import fact_join, hour_join
from . import ledger, manifest, rollup, routing


def redo_candidates(status: DataFrame, server_lookup: DataFrame, lag: DataFrame) -> DataFrame:
    """Failed ledger rows whose hour the lag check has cleared.

    A semi-join: several lag rows for one hour (one per category) still give one redo.
    """
    cleared = lag.filter(text.status_is(F.col("Status"), SUCCESS, RERUN)).select(
        "LinkServerName", "Type", F.col("DatePlayed").alias("UpDateTime")
    )
    names = server_lookup.select("Server", "LinkServerName").distinct()
    due = cleared.join(names, "LinkServerName").select("Server", "Type", "UpDateTime").distinct()
    failed = status.filter(text.status_is(F.col("Status"), FAIL))
    hits = hour_join(failed, due, ["Server", "Type", "UpDateTime"], "left_semi")
    return hits.select(*status.columns)


def redo_manifest(
    candidates: DataFrame,
    lookup: DataFrame,
    type_timezone: DataFrame,
    server_lookup: DataFrame,
    settings: Settings = Settings(),
) -> DataFrame:
    """Manifest of all candidate (server, Type, hour) pairs, built once for all of them."""
    names = server_lookup.select("Server", "LinkServerName").distinct()
    wanted = candidates.join(names, "Server").select(
        "LinkServerName", "Type", clock.output_to_utc(F.col("UpDateTime")).alias("batch_utc")
    )
    return manifest.schedule_for(manifest.list_sources(lookup), type_timezone, wanted, settings)


def redo_rollup(
    candidates: DataFrame,
    work: DataFrame,
    wagers: DataFrame,
    games: DataFrame,
    site_group: DataFrame,
    server_lookup: DataFrame,
    settings: Settings = Settings(),
    all_destinations: bool = False,
) -> DataFrame:
    """Routed rows of the redone hours, for the destinations that failed.

    ``work`` is the redo manifest without held rows. ``all_destinations`` sends a redone hour to
    every destination.
    """
    routed = routing.route(
        rollup.rollup_of_windows(wagers, work, games, settings), site_group, server_lookup
    )
    if all_destinations:
        return routed
    keys = candidates.select(
        "Server", "Type", "Destination", F.col("UpDateTime").alias("DatePlayed")
    ).distinct()
    asked = fact_join(routed, keys, ["Server", "Type", "Destination", "DatePlayed"], "left_semi")
    return asked.select(*routed.columns)


def redo_outcome(candidates: DataFrame, outcome: DataFrame) -> DataFrame:
    """Ledger rows of the redo, limited to what was asked for."""
    asked = candidates.select(*LEDGER_KEYS).distinct()
    return hour_join(outcome, asked, LEDGER_KEYS, "left_semi").select(*ledger.LEDGER)


def close_redo(
    lag: DataFrame, outcome: DataFrame, server_lookup: DataFrame, close_failed: bool = False
) -> DataFrame:
    """Lag rows with the redone hours set to Success.

    An hour closes once none of its redone destinations failed; ``close_failed`` closes it anyway.
    """
    names = server_lookup.select("Server", "LinkServerName").distinct()
    per_hour = outcome.join(names, "Server").groupBy(
        "LinkServerName", "Type", F.col("UpDateTime").alias("DatePlayed")
    ).agg(F.min(F.col("Status").isin(SUCCESS, EMPTY)).alias("ended_well"))
    closed = per_hour if close_failed else per_hour.filter("ended_well")
    closed = closed.select("LinkServerName", "Type", "DatePlayed", F.lit(SUCCESS).alias("closed"))
    return hour_join(lag, closed, ["LinkServerName", "Type", "DatePlayed"], "left").select(
        "DatePlayed", "LinkServerName", "Type", "Category",
        F.coalesce("closed", "Status").alias("Status"), "Table_max", "Run_threshold",
    )
