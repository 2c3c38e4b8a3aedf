"""Which source is read for which batch hour, and over which provider-local window."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import OUTPUT_UTC_OFFSET_HOURS, SOURCE_KEYS, Settings
from ..functions import clock

MANIFEST_COLUMNS = [
    "batch_utc", *SOURCE_KEYS, "Timezone", "start_t", "end_t", "read_month", "DatePlayed",
    "is_shared_db",
]
LISTED_BY_DAY = ["day", "n_hours", "hours"]
# Days of sources that a task expands: their groups by day, a few a source day, stay within some tens of megabytes.
DAYS_PER_TASK = 100_000
# More tasks would weigh on the driver; beyond, tasks are larger and their groups spill.
MOST_TASKS = 50_000


def list_sources(lookup: DataFrame) -> DataFrame:
    """One row per physical source; the games it holds are left to ``game_list``."""
    return lookup.select(*SOURCE_KEYS).distinct()


def game_list(lookup: DataFrame) -> DataFrame:
    """Games of each Type on each server, one row per game.

    Rows instead of one list value: a Type may own most games, and no task has to hold them all.
    """
    listed = lookup.filter(F.col("Type").isNotNull() & F.col("GameTypeSourceId").isNotNull())
    return listed.select("LinkServerName", "Type", "GameTypeSourceId").distinct()


def game_counts(games: DataFrame) -> DataFrame:
    return games.groupBy("LinkServerName", "Type").agg(F.count(F.lit(1)).alias("n_games"))


def physical_name(settings: Settings) -> Column:
    """Database and view that hold a manifest row's data."""
    db = F.concat_ws("", "DBName", F.when(F.col("MonthDB").isNotNull(), F.col("read_month")))
    return F.concat_ws(".", "LinkServerName", db, F.concat(F.lit("VW_"), "TableName"))


def _with_timezone(sources: DataFrame, type_timezone: DataFrame) -> DataFrame:
    zones = type_timezone.select("Type", "Timezone").distinct()
    return sources.join(zones, "Type", "left")


def _windows(df: DataFrame, settings: Settings, more: Sequence[str] = ()) -> DataFrame:
    return df.select(
        "batch_utc", *SOURCE_KEYS, "Timezone",
        clock.window_start(F.col("batch_utc"), F.col("Timezone")).alias("start_t"),
        clock.window_end(F.col("batch_utc"), F.col("Timezone")).alias("end_t"),
        "read_month",
        clock.utc_to_output(F.col("batch_utc")).alias("DatePlayed"),
        (F.col("DBName") == settings.shared_db).alias("is_shared_db"),
        *more,
    )


def spans(
    sources: DataFrame,
    type_timezone: DataFrame,
    first_batch: Column | dt.datetime,
    last_batch: Column | dt.datetime,
    settings: Settings = Settings(),
) -> DataFrame:
    """Every source with its timezone and the batch hours [low, high] it serves within [first, last].

    A month database serves only the hours whose window starts in its month; ``read_month`` names
    the database that is read for them. A Type without a timezone keeps its hours, with the month
    taken on the output clock.
    """
    first, last = clock.as_ntz(first_batch), clock.as_ntz(last_batch)
    # The window of batch b starts at b + timezone - 1h.
    back = 1 - F.coalesce(F.col("Timezone"), F.lit(OUTPUT_UTC_OFFSET_HOURS))
    opens = clock.month_first(F.col("MonthDB"))
    closes = F.timestamp_add("MONTH", F.lit(1), opens)
    whole = F.col("MonthDB").isNull()
    bounded = _with_timezone(sources, type_timezone).select(
        *SOURCE_KEYS, "Timezone", clock.plus_hours(closes, back - 1).alias("final"),
        clock.month_code(closes).alias("next_month"),
        F.when(whole, first).otherwise(F.greatest(first, clock.plus_hours(opens, back))).alias("low"),
        F.when(whole, last).otherwise(F.least(last, clock.plus_hours(closes, back - 1))).alias("high"),
    )
    same_month = F.struct("low", "high", F.col("MonthDB").alias("read_month"))
    if settings.month_of == "end":
        # The window of a month's final hour ends in the next month.
        before = F.struct(
            "low", F.least("high", clock.plus_hours(F.col("final"), -1)).alias("high"),
            F.col("MonthDB").alias("read_month"),
        )
        at_end = F.struct(
            F.greatest("low", "final").alias("low"), "high", F.col("next_month").alias("read_month")
        )
        parts = F.when(whole, F.array(same_month)).otherwise(F.array(before, at_end))
    else:
        parts = F.array(same_month)
    served = bounded.select(*SOURCE_KEYS, "Timezone", F.inline(parts))
    return served.filter(F.col("low") <= F.col("high"))


def pieces(
    source_spans: DataFrame, days: int = 30, keys: Sequence[str] = (*SOURCE_KEYS, "Timezone", "low"), parts: int | None = None
) -> DataFrame:
    """Spans cut into pieces of at most ``days`` days, dealt over the tasks by ``keys`` before their hours are expanded.

    Few spans would lie in one task, and a source without month databases may serve years of hours.
    """
    parts = parts or int(source_spans.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    high = F.col("high")
    each = source_spans.withColumn("low", F.explode(F.sequence("low", "high", F.expr(f"interval {days} days"))))
    each = each.withColumn("high", F.least(high, clock.plus_hours(F.col("low"), 24 * days - 1)))
    return each.repartition(parts, *keys)


def day_tasks(source_spans: DataFrame, most: int = DAYS_PER_TASK) -> int:
    """Into how many tasks the days of the spans are dealt, so that a task expands about ``most`` of them.

    Not less than the session's number of tasks.
    """
    n_days = source_spans.agg(F.sum(F.datediff("high", "low") + 1)).first()[0] or 0
    least = int(source_spans.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, min(MOST_TASKS, n_days // most + 1))


def expand(source_spans: DataFrame, settings: Settings = Settings(), by_day: bool = False) -> DataFrame:
    """One manifest row per source and batch hour it serves.

    ``by_day`` lists the same hours in one row per source and output day: the row of the first hour, with the
    ``day``, the number of its hours, ``n_hours``, and each of them as a bit of ``hours``.
    """
    if by_day:
        return _expand_days(source_spans, settings)
    each_hour = F.explode(F.sequence("low", "high", F.expr("interval 1 hour")))
    return _windows(source_spans.withColumn("batch_utc", each_hour), settings)


def _expand_days(source_spans: DataFrame, settings: Settings) -> DataFrame:
    """A span's hours are without gaps: its first and its last day are cut, the days between are whole."""
    low, high = F.col("low"), F.col("high")
    more = F.floor(clock.seconds_between(low, high) / 3600).cast("int")
    first, last = clock.utc_to_output(low), clock.utc_to_output(clock.plus_hours(low, more))
    bounded = source_spans.withColumns({
        "first_day": F.unix_date(F.to_date(first)), "first_hour": F.hour(first),
        "last_day": F.unix_date(F.to_date(last)), "last_hour": F.hour(last),
    })
    day = F.col("day")
    each_day = bounded.withColumn("day", F.explode(F.sequence("first_day", "last_day"))).withColumns({
        "opens": F.when(day == F.col("first_day"), F.col("first_hour")).otherwise(0),
        "closes": F.when(day == F.col("last_day"), F.col("last_hour")).otherwise(23),
    })
    since_low = (day - F.col("first_day")) * 24 + F.col("opens") - F.col("first_hour")
    listed = each_day.withColumns({
        "batch_utc": clock.plus_hours(low, since_low), "day": F.date_from_unix_date("day"),
        "n_hours": F.col("closes") - F.col("opens") + 1, "hours": clock.hour_bits(F.col("opens"), F.col("closes")),
    })
    return _windows(listed, settings, LISTED_BY_DAY)


def intervals(source_spans: DataFrame) -> DataFrame:
    """The manifest without its hours: of every span its first and last batch, window and output hour.

    Costs a row per source, however many hours it serves; ``expand`` gives the hours.
    """
    low, high = F.col("low"), F.col("high")
    return source_spans.select(
        "*", low.alias("first_batch"), high.alias("last_batch"),
        (clock.minutes_crossed(low, high) / 60 + 1).cast("bigint").alias("n_hours"),
        clock.window_start(low, F.col("Timezone")).alias("first_start"),
        clock.window_end(high, F.col("Timezone")).alias("last_end"),
        clock.utc_to_output(low).alias("first_output"), clock.utc_to_output(high).alias("last_output"),
    )


def schedule(
    sources: DataFrame,
    type_timezone: DataFrame,
    first_batch: Column | dt.datetime,
    last_batch: Column | dt.datetime,
    settings: Settings = Settings(),
) -> DataFrame:
    """Manifest of every source for every batch hour in [first, last]."""
    return expand(spans(sources, type_timezone, first_batch, last_batch, settings), settings)


def schedule_for(
    sources: DataFrame, type_timezone: DataFrame, wanted: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Manifest of scattered (LinkServerName, Type, batch_utc) pairs, as a redo needs."""
    pairs = wanted.select("LinkServerName", "Type", "batch_utc").distinct()
    zone = F.coalesce(F.col("Timezone"), F.lit(OUTPUT_UTC_OFFSET_HOURS))
    starts = clock.window_start(F.col("batch_utc"), zone)
    named_by = starts if settings.month_of == "start" else clock.plus_hours(starts, 1)
    whole = F.col("MonthDB").isNull()
    due = (
        _with_timezone(sources, type_timezone).join(pairs, ["LinkServerName", "Type"])
        .filter(whole | (F.col("MonthDB") == clock.month_code(starts)))
        .withColumn("read_month", F.when(~whole, clock.month_code(named_by)))
    )
    return _windows(due, settings)


def resolve_duplicate_mappings(lookup: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Games mapped once, plus the non-legacy rows of games mapped more than once."""
    counts = lookup.groupBy("GameTypeSourceId").agg(F.count(F.lit(1)).alias("n_rows"))
    keep = (F.col("n_rows") == 1) | (F.col("DBName") != settings.legacy_db)
    return lookup.join(counts, "GameTypeSourceId").filter(keep).select(*lookup.columns)
