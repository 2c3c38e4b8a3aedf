"""Readers for the fact table, the lookup tables and the list of unreadable sources."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..constants import EXCLUDED_HALLS, FALLBACK_EXCLUDED_TYPES, Settings
from ..functions import clock
from ..functions.failures import FAILURES, is_transient
from ..schemas import conform

# Provider clocks lie between UTC-12 and UTC+14.
WEST, EAST = -12, 14


def read_table(
    spark: SparkSession, name: str, path: str, fmt: str = "parquet", **options: str
) -> DataFrame:
    """A logical table from any Spark source format; ``path`` is unused where options name the table."""
    reader = spark.read.format(fmt).options(**options)
    return conform(reader.load(path) if path else reader.load(), name)


def can_read(df: DataFrame) -> bool:
    """Whether every file of a lookup table can be read, found out by reading them all in one job.

    Spark opens a table by its folder and the footer of a file; a file that is broken shows when it is read.
    """
    try:
        df.write.format("noop").mode("overwrite").save()
        return True
    except FAILURES as err:
        if is_transient(err):
            raise
        return False


def _opened(spark: SparkSession, name: str, path: str, *args: str, **kwargs: str) -> DataFrame | None:
    """A lookup table that can be read to its end, or None."""
    try:
        read = read_table(spark, name, path, *args, **kwargs)
    except (*FAILURES, ValueError) as err:
        if is_transient(err):
            raise
        return None
    return read if can_read(read) else None


def choose_copy(
    spark: SparkSession, name: str, primary: str, backup: str, **kwargs: str
) -> tuple[DataFrame, str]:
    """A lookup table, and which copy it is: "backup" where the primary can't be opened or read to its end."""
    read = _opened(spark, name, primary, **kwargs)
    return (read, "primary") if read is not None else (read_table(spark, name, backup, **kwargs), "backup")


def read_with_fallback(
    spark: SparkSession, name: str, primary: str, backup: str, **kwargs: str
) -> DataFrame:
    """The primary copy of a lookup table, or the backup where the primary can't be read."""
    return choose_copy(spark, name, primary, backup, **kwargs)[0]


def read_wagers(
    spark: SparkSession,
    path: str,
    first_batch: dt.datetime,
    last_batch: dt.datetime,
    fmt: str = "parquet",
    **options: str,
) -> DataFrame:
    """Wagers that any source may hold for the batches; the literal bounds reach the scan.

    Laid out in directories by Type and MonthDB, the month test also drops whole directories.
    """
    wagers = read_table(spark, "wagers", path, fmt, **options)
    return within_batches(wagers, [(first_batch, last_batch)])


def within_batches(
    wagers: DataFrame, batches: list[tuple[dt.datetime, dt.datetime]]
) -> DataFrame:
    """Wagers that any source may hold for ranges [first, last] of batch hours (UTC).

    The bounds are literals, so they reach the scan and prune months; none are kept for no ranges.
    """
    t, keep = F.col("wagerstime"), F.lit(False)
    months: set[str] = set()
    for first, last in batches:
        low, high = first + dt.timedelta(hours=WEST - 1), last + dt.timedelta(hours=EAST)
        keep = keep | ((t >= clock.as_ntz(low)) & (t < clock.as_ntz(high)))
        months |= _months(low, high)
    return wagers.filter(keep & (F.col("MonthDB").isNull() | F.col("MonthDB").isin(sorted(months))))


def runs_of_hours(hours: DataFrame) -> tuple[DataFrame, DataFrame]:
    """First and last hours of the runs of consecutive hours of each Type (Type, start_t).

    An hour opens a run if the hour before it is missing, and closes one if the next is; two joins by
    equality, whatever the length of the runs. Sorted, the n-th opening belongs to the n-th closing hour.
    """
    each = hours.select("Type", "start_t").filter("start_t IS NOT NULL").distinct()

    def without(step: int) -> DataFrame:
        shifted = each.select("Type", clock.plus_hours(F.col("start_t"), step).alias("start_t"))
        return each.join(shifted.hint("merge"), ["Type", "start_t"], "left_anti")

    return without(1), without(-1)


def within_windows(wagers: DataFrame, hours: DataFrame, most: int = 200) -> DataFrame | None:
    """Wagers of the listed local hours (Type, start_t), as literal intervals that reach the scan.

    Consecutive hours of a Type are one interval. None if there are more than ``most`` intervals.
    """
    found = []
    for edges in runs_of_hours(hours):
        rows = edges.limit(most + 1).collect()
        if len(rows) > most:
            return None
        found.append(sorted((r["Type"], r["start_t"]) for r in rows))
    t, by_type, months = F.col("wagerstime"), {}, set()
    for (one, first), (_, last) in zip(*found, strict=True):
        end = last + dt.timedelta(hours=1)
        inside = (t >= clock.as_ntz(first)) & (t < clock.as_ntz(end))
        by_type[one] = by_type[one] | inside if one in by_type else inside
        months |= _months(first, end)
    keep = F.lit(False)
    for one, inside in by_type.items():
        keep = keep | ((F.col("Type") == one) & inside)
    return wagers.filter(keep & (F.col("MonthDB").isNull() | F.col("MonthDB").isin(sorted(months))))


def _months(low: dt.datetime, high: dt.datetime) -> set[str]:
    days = (high - low).days + 1
    return {(low + dt.timedelta(days=d)).strftime("%y%m") for d in range(days + 1)}


def read_unreadable(spark: SparkSession, path: str) -> DataFrame:
    """CSV list of sources without read right; header names may carry blanks."""
    return conform(spark.read.csv(path, header=True), "unreadable_sources")


def excluded_types(game_lookup: DataFrame, halls: tuple[str, ...] = EXCLUDED_HALLS) -> DataFrame:
    """Types played in the excluded halls."""
    hit = game_lookup.filter(F.col("GameHallName").isin(*halls))
    return hit.select(F.col("RawDataType").alias("Type")).distinct()


def fallback_excluded_types(spark: SparkSession) -> DataFrame:
    """The fixed ids, for when the game lookup cannot be read."""
    return spark.createDataFrame([(t,) for t in FALLBACK_EXCLUDED_TYPES], "Type int")


def excluded_or_fallback(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Excluded Types by the game lookup at ``path``, or the fixed ids where it can't be read."""
    games = _opened(spark, "game_lookup", path, fmt)
    return fallback_excluded_types(spark) if games is None else excluded_types(games)


def drop_excluded(lookup: DataFrame, excluded: DataFrame, settings: Settings) -> DataFrame:
    """Lookup rows whose game is not excluded; rows without a game id stay."""
    ids = excluded.select(F.col("Type").alias(settings.exclude_key)).distinct()
    return lookup.join(ids, settings.exclude_key, "left_anti").select(*lookup.columns)


def on_server(df: DataFrame, link_server: str | None) -> DataFrame:
    """Rows of one linked server, or all of them."""
    return df if link_server is None else df.filter(F.col("LinkServerName") == link_server)


def site_members(site_group: DataFrame, group: str) -> DataFrame:
    return site_group.filter(F.col("SiteType") == group).select("Siteid").distinct()


def site_filter(site_group: DataFrame, mode: str) -> DataFrame:
    """Sites named by an exclusion mode."""
    kind = F.col("SiteType")
    keep: dict[str, Column] = {
        "ungrouped": kind.isNull(),
        "first_group": kind == "Noah1",
        "both_groups": kind.isin("Noah1", "Noah2"),
    }
    return site_group.filter(keep[mode]).select("Siteid").distinct()


def without_sites(rollup: DataFrame, sites: DataFrame) -> DataFrame:
    """Rollup rows outside the listed sites (off in the hourly run, offered to callers)."""
    ids = sites.select(F.col("Siteid").alias("SiteId"))
    return rollup.join(ids, "SiteId", "left_anti").select(*rollup.columns)


def exclude_unreadable(
    sources: DataFrame, unreadable: DataFrame, how: str = "left_anti"
) -> DataFrame:
    """Sources (or manifest rows) that are not on the no-read-right list; with "left_semi" those that are."""
    s, u = sources.alias("s"), unreadable.alias("u")
    same = (
        (F.col("s.LinkServerName") == F.col("u.LinkServerName"))
        & (F.col("s.DBName") == F.col("u.DBName"))
        & F.col("s.MonthDB").eqNullSafe(F.col("u.MonthDB"))
        & (F.col("s.TableName") == F.col("u.TableName"))
        & (F.col("s.Type") == F.col("u.Type"))
    )
    return s.join(u, same, how)
