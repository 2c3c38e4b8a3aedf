"""The status ledger: Running, then Success / Empty / Fail per (Server, Type, Destination, hour).

Ledger changes are functions from the old ledger to the new one; sinks decide how it is stored.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import EMPTY, FAIL, LEDGER_KEYS, RUNNING, SUCCESS
from ..functions import clock, text
from ..functions.joins import hour_join
from ..schemas import columns
from .manifest import LISTED_BY_DAY
from .routing import expected_destinations

LEDGER = columns("batch_status")


def _ledger_rows(
    df: DataFrame, status: Column | str, seconds: Column | None = None, more: Sequence[str] = ()
) -> DataFrame:
    status = status if isinstance(status, Column) else F.lit(status)
    seconds = F.lit(None) if seconds is None else seconds
    return df.select(
        "Server", "Type", "Destination", status.alias("Status"),
        seconds.cast("double").alias("Exe_Time_sec"), "UpDateTime", *more,
    )


def start_status(manifest: DataFrame, server_lookup: DataFrame) -> DataFrame:
    """A Running row per manifest source and destination; where the manifest lists hours by day, so do the rows."""
    due = expected_destinations(manifest, server_lookup)
    listed = [c for c in LISTED_BY_DAY if c in manifest.columns]
    return _ledger_rows(due.withColumn("UpDateTime", F.col("DatePlayed")), RUNNING, more=listed)


def not_ready(lag_status: DataFrame) -> DataFrame:
    """Types held back because their source is late."""
    held = lag_status.filter(text.status_is(F.col("Status"), "Wait"))
    return held.select("LinkServerName", "Type", "DatePlayed").distinct()


def runnable(manifest: DataFrame, held: DataFrame) -> DataFrame:
    """Manifest rows that may be read: not held back and with a known window."""
    free = hour_join(manifest, held, ["LinkServerName", "Type", "DatePlayed"], "left_anti")
    return free.filter(F.col("start_t").isNotNull()).select(*manifest.columns)


def batch_outcome(
    manifest: DataFrame,
    routed: DataFrame,
    held: DataFrame,
    server_lookup: DataFrame,
    failures: DataFrame | None = None,
    seconds: float | None = None,
) -> DataFrame:
    """Final ledger rows, one per (Server, Type, Destination, hour).

    Fail if any of the Type's sources is held, has no window or is in ``failures``
    (LinkServerName, Type, DatePlayed); else Success if a row was routed, else Empty.
    """
    bad = manifest.filter(F.col("start_t").isNull()).select("LinkServerName", "Type", "DatePlayed")
    for more in (held, failures):
        if more is not None:
            bad = bad.unionByName(more.select("LinkServerName", "Type", "DatePlayed"))
    bad = bad.distinct().withColumn("bad", F.lit(True))
    arrived = (
        routed.groupBy("LinkServerName", "Type", "DatePlayed", "Destination")
        .agg(F.lit(True).alias("arrived"))
    )
    due = manifest.select("LinkServerName", "Type", "DatePlayed").distinct()
    due = expected_destinations(due, server_lookup)
    hour = ["LinkServerName", "Type", "DatePlayed"]
    joined = hour_join(hour_join(due, bad, hour, "left"), arrived, [*hour, "Destination"], "left")
    status = F.when(F.col("bad"), FAIL).when(F.col("arrived"), SUCCESS).otherwise(EMPTY)
    return _ledger_rows(
        joined.withColumn("UpDateTime", F.col("DatePlayed")), status, F.lit(seconds)
    )


def apply_status(ledger: DataFrame, updates: DataFrame) -> DataFrame:
    """Ledger with Status and time replaced where ``updates`` has the key.

    An update without a Destination column (or with NULL in it) applies to all destinations.
    """
    if "Destination" not in updates.columns:
        updates = updates.withColumn("Destination", F.lit(None).cast("string"))
    new = F.struct(F.col("Status"), F.col("Exe_Time_sec"))
    wide = ["Server", "Type", "UpDateTime"]
    exact = updates.filter(F.col("Destination").isNotNull()).groupBy(*LEDGER_KEYS).agg(
        F.max(new).alias("exact")
    )
    for_all = updates.filter(F.col("Destination").isNull()).groupBy(*wide).agg(
        F.max(new).alias("for_all")
    )
    joined = hour_join(hour_join(ledger, for_all, wide, "left"), exact, LEDGER_KEYS, "left")
    old = F.struct("Status", "Exe_Time_sec")
    merged = joined.withColumn("now", F.coalesce("exact", "for_all", old))
    return merged.select(
        "Server", "Type", "Destination", F.col("now.Status").alias("Status"),
        F.col("now.Exe_Time_sec").alias("Exe_Time_sec"), "UpDateTime",
    )


def put_rows(ledger: DataFrame, rows: DataFrame) -> DataFrame:
    """Ledger with ``rows`` added in place of rows of the same key, so that a re-run adds nothing."""
    kept = hour_join(ledger, rows.select(*LEDGER_KEYS).distinct(), LEDGER_KEYS, "left_anti")
    return kept.select(*LEDGER).unionByName(rows.select(*LEDGER))


def mark_running(ledger: DataFrame, keys: DataFrame) -> DataFrame:
    """Set the listed rows to Running and clear their time."""
    updates = keys.select(*LEDGER_KEYS).distinct().withColumn("Status", F.lit(RUNNING))
    return apply_status(ledger, updates.withColumn("Exe_Time_sec", F.lit(None).cast("double")))


def clone_last_as_fail(
    ledger: DataFrame, current: Column | dt.datetime, server: str | None = None
) -> DataFrame:
    """Rows of each server's last hour that ended well, repeated as Fail at ``current``.

    The hour needs one Success or Empty row; all its rows are repeated.
    """
    rows = ledger if server is None else ledger.filter(F.col("Server") == server)
    good = rows.filter(F.col("Status").isin(SUCCESS, EMPTY))
    last = good.groupBy("Server").agg(F.max("UpDateTime").alias("UpDateTime"))
    return _ledger_rows(
        rows.join(last, ["Server", "UpDateTime"], "left_semi").withColumn(
            "UpDateTime", clock.as_ntz(current)
        ),
        FAIL, F.col("Exe_Time_sec"),
    )


def fail_all_types(
    lookup: DataFrame, link_server: str, server: str, current: Column | dt.datetime
) -> DataFrame:
    """A Fail row for every Type the lookup places on one linked server."""
    types = lookup.filter(F.col("LinkServerName") == link_server).select("Type").distinct()
    return types.select(
        F.lit(server).alias("Server"), "Type", F.lit(FAIL).alias("Status"),
        clock.as_ntz(current).alias("UpDateTime"),
    )
