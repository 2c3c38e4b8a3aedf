"""Each Type's timezone: observed readings, the offset they imply, the choice and the merge."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import INFERRED_CATEGORY, SUCCESS, UPDATING, Settings
from ..functions import clock, ordered
from . import zones
from .manifest import game_list, list_sources
from .rollup import in_game_list

OBSERVATION = ["Batch_time", "Server", "Type", "table_max", "utc0", "diff_min"]


def observe_source_max(
    wagers: DataFrame,
    lookup: DataFrame,
    batch_utc: Column | dt.datetime,
    settings: Settings = Settings(),
) -> DataFrame:
    """Newest wager of every listed (LinkServerName, Type), and how far it lies behind UTC.

    One row per pair even when its sources are empty. The game test of shared databases runs on
    per-game maxima, after the scan has been reduced.
    """
    per_game = wagers.groupBy(
        "LinkServerName", "DBName", "MonthDB", "TableName", "Type", "GameTypeSourceId"
    ).agg(F.max("wagerstime").alias("newest"))
    return _readings(per_game, lookup, batch_utc, settings)


def observe_zones(
    zone_rows: DataFrame, lookup: DataFrame, batch_utc: Column | dt.datetime, settings: Settings = Settings()
) -> DataFrame:
    """``observe_source_max`` from the zones of wagers, which are not read."""
    return _readings(zones.newest(zone_rows), lookup, batch_utc, settings)


def _readings(
    per_game: DataFrame, lookup: DataFrame, batch_utc: Column | dt.datetime, settings: Settings
) -> DataFrame:
    sources, games = list_sources(lookup), game_list(lookup)
    per_source = in_game_list(per_game, games, settings).groupBy(
        "LinkServerName", "DBName", "MonthDB", "TableName", "Type"
    ).agg(F.max("newest").alias("newest"))
    s, m = sources.alias("s"), per_source.alias("m")
    same = F.col("s.MonthDB").eqNullSafe(F.col("m.MonthDB"))
    for key in ("LinkServerName", "DBName", "TableName", "Type"):
        same = same & (F.col(f"s.{key}") == F.col(f"m.{key}"))
    utc0 = clock.as_ntz(batch_utc)
    per_type = s.join(m, same, "left").groupBy("s.LinkServerName", "s.Type").agg(
        F.max("m.newest").alias("table_max")
    )
    return per_type.select(
        "LinkServerName", "Type", "table_max", utc0.alias("utc0"),
        clock.minutes_crossed(F.col("table_max"), utc0).alias("diff_min"),
    )


def known_readings(obs: DataFrame, lookup: DataFrame, server_lookup: DataFrame) -> DataFrame:
    """Largest stored reading of every listed (LinkServerName, Type); NULL where there is none yet."""
    names = server_lookup.select("Server", "LinkServerName").distinct()
    stored = obs.join(names, "Server").groupBy("LinkServerName", "Type").agg(
        F.max("table_max").alias("known")
    )
    listed = lookup.select("LinkServerName", "Type").distinct()
    return listed.join(stored, ["LinkServerName", "Type"], "left")


def unseen(wagers: DataFrame, known: DataFrame, most: int = 1000) -> DataFrame:
    """Wagers that may lie beyond ``known_readings``: all those of a Type that lacks one.

    A Type's bound is the least reading of its servers, as a literal that reaches the scan. More than
    ``most`` Types are read without a bound.
    """
    per_type = known.groupBy("Type").agg(
        F.min("known").alias("low"), F.bool_and(F.col("known").isNotNull()).alias("all_known")
    )
    rows = per_type.filter("all_known").limit(most + 1).collect()
    if not rows or len(rows) > most:
        return wagers
    t = F.col("wagerstime")
    keep = ~F.col("Type").isin([r["Type"] for r in rows])
    for r in rows:
        keep = keep | ((F.col("Type") == r["Type"]) & (t >= clock.as_ntz(r["low"])))
    return wagers.filter(keep)


def at_least(observed: DataFrame, known: DataFrame) -> DataFrame:
    """Observed readings, or the known ones where those are later."""
    joined = observed.join(known, ["LinkServerName", "Type"], "left")
    joined = joined.withColumn("table_max", F.greatest("table_max", "known"))
    return joined.withColumn(
        "diff_min", clock.minutes_crossed(F.col("table_max"), F.col("utc0"))
    ).select(*observed.columns)


def append_observations(
    obs: DataFrame, observed: DataFrame, server_lookup: DataFrame, batch_time: Column | dt.datetime
) -> DataFrame:
    """Observation history with one more batch; empty sources stay NULL."""
    names = server_lookup.select("LinkServerName", "Server").distinct()
    new = observed.join(names, "LinkServerName").withColumn("Batch_time", clock.as_ntz(batch_time))
    return obs.select(*OBSERVATION).unionByName(new.select(*OBSERVATION))


def updates_only(obs: DataFrame) -> DataFrame:
    """Observations whose reading differs from the one before it; a Type's first one is dropped.

    Two empty readings in a row count as different.
    """
    day = F.col("Batch_time").cast("date")
    order = ["Batch_time", "Server", "table_max"]
    marked = _with_previous(obs, order, day)
    return marked.filter("moved").select(
        "Type", "Batch_time", "table_max", "table_max_lag", "diff_min"
    )


def _with_previous(obs: DataFrame, order: list[str], day: Column) -> DataFrame:
    marked = ordered.previous_value(
        obs.select("Type", "Batch_time", "Server", "table_max", "diff_min"),
        ["Type"], order, "table_max", "table_max_lag", "is_first", day,
    )
    same = F.col("table_max") == F.col("table_max_lag")
    return marked.withColumn("moved", ~F.col("is_first") & ~F.coalesce(same, F.lit(False)))


def infer_timezone(obs: DataFrame) -> DataFrame:
    """Offset per Type from the mean delay of its fresh readings.

    n is NULL for a Type with no fresh reading at all and 0 where the fresh ones are empty.
    """
    marked = _with_previous(
        obs, ["Batch_time", "Server", "table_max"], F.col("Batch_time").cast("date")
    )
    delay = F.when(F.col("moved"), F.col("diff_min"))
    per_type = marked.groupBy("Type").agg(
        F.avg(delay).alias("diff_min"),
        F.when(F.bool_or("moved"), F.count(delay)).alias("n"),
        F.var_samp(delay).alias("variance"),
    )
    return per_type.select(
        "Type", "diff_min", "n", "variance",
        clock.offset_rest(F.col("diff_min")).alias("sth_left"),
        clock.offset_hours(F.col("diff_min")).alias("timezone"),
    )


def declared_timezones(lookup: DataFrame, raw_data_info: DataFrame) -> DataFrame:
    """Timezones declared by the sources of the listed Types."""
    declared = raw_data_info.select("Type", F.col("Timezone").alias("Timezone_DBA")).distinct()
    return declared.join(lookup.select("Type").distinct(), "Type", "left_semi")


def type_category(game_lookup: DataFrame) -> DataFrame:
    return game_lookup.select(F.col("RawDataType").alias("Type"), "Category").distinct()


def choose_timezone(inferred: DataFrame, declared: DataFrame, category: DataFrame) -> DataFrame:
    """Inferred offset for the category that trusts it, else the declared one.

    Several categories or declarations give several rows; NULL means undecided.
    """
    own = inferred.select("Type", F.col("timezone").alias("found"))
    joined = own.join(declared, "Type", "left").join(category, "Type", "left")
    distrust = ~F.col("Category").eqNullSafe(INFERRED_CATEGORY) | F.col("found").isNull()
    chosen = F.when(distrust, F.col("Timezone_DBA")).otherwise(F.col("found"))
    return joined.select("Type", chosen.cast("int").alias("Timezone"))


def second_path(obs: DataFrame, first_servers: list[str], second_servers: list[str]) -> DataFrame:
    """Second-path observations of Types that the first path never observed.

    NOT IN semantics: a first-path row without a Type excludes everything, and a second-path row
    without one only passes when the first path is empty. The two counts settle those cases, so
    the join itself is a plain anti-join.
    """
    first = obs.filter(F.col("Server").isin(first_servers)).select("Type")
    second = obs.filter(F.col("Server").isin(second_servers))
    n_rows = first.select(F.count(F.lit(1))).scalar()
    n_null = first.select(F.count_if(F.col("Type").isNull())).scalar()
    known = second.join(first.distinct(), "Type", "left_anti").select(*obs.columns)
    return known.filter((n_rows == 0) | ((n_null == 0) & F.col("Type").isNotNull()))


def stack_paths(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.unionByName(second)


def timezone_changes(chosen: DataFrame, current: DataFrame) -> DataFrame:
    """Known Types whose chosen timezone is not the stored one; NULL counts as a change."""
    old = current.select("Type", F.col("Timezone").alias("Timezone_old"))
    joined = chosen.select("Type", "Timezone").join(old, "Type")
    return joined.filter(~F.col("Timezone").eqNullSafe(F.col("Timezone_old")))


def merge_timezones(chosen: DataFrame, current: DataFrame, at: Column | dt.datetime) -> DataFrame:
    """Timezone table after a confirmed analysis: new Types added, observed ones refreshed.

    Types that were not observed stay Updating, which is how a stale Type shows. Callers merge
    only when ``timezone_changes`` is empty.
    """
    new = chosen.groupBy("Type").agg(F.max("Timezone").alias("new_tz"), F.lit(True).alias("seen"))
    joined = current.join(new, "Type", "full_outer")
    seen = F.col("seen").isNotNull()
    return joined.select(
        "Type",
        F.when(seen, F.col("new_tz")).otherwise(F.col("Timezone")).alias("Timezone"),
        F.when(seen, clock.as_ntz(at)).otherwise(F.col("UpdateTime")).alias("UpdateTime"),
        F.when(seen, SUCCESS).otherwise(UPDATING).alias("Status"),
    )
