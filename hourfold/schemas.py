"""Logical tables: column names and types, and the check that a DataFrame has them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Wall-clock columns are TIMESTAMP_NTZ: a provider-local reading has no zone of its own.
TABLES: dict[str, str] = {
    "wagers": (
        "LinkServerName string, DBName string, MonthDB string, TableName string, Type int, "
        "wagerstime timestamp_ntz, GameAccount string, SiteId int, GameTypeSourceId int, "
        "betamount decimal(18,4), PayOff decimal(18,4)"
    ),
    "source_lookup": (
        "LinkServerName string, GameTypeSourceId int, DBName string, MonthDB string, "
        "TableName string, Type int"
    ),
    "game_lookup": "RawDataType int, GameHallName string, Category string",
    "type_timezone": "Type int, Timezone int, UpdateTime timestamp_ntz, Status string",
    "raw_data_info": "Type int, Timezone int",
    "hourly_rollup": (
        "DatePlayed timestamp_ntz, GameAccount string, SiteId int, GameTypeSourceId int, "
        "Commissionable decimal(28,4), WagersCount bigint, PayOff decimal(28,4), WinsCount bigint"
    ),
    "batch_status": (
        "Server string, Type int, Destination string, Status string, Exe_Time_sec double, "
        "UpDateTime timestamp_ntz"
    ),
    "lag_status": (
        "DatePlayed timestamp_ntz, LinkServerName string, Type int, Category string, "
        "Status string, Table_max timestamp_ntz, Run_threshold timestamp_ntz"
    ),
    "lag_run_status": "DatePlayed timestamp_ntz, Status string",
    # Batch_time is UTC, like utc0; table_max is on the provider's clock.
    "tz_observations": (
        "Batch_time timestamp_ntz, Server string, Type int, table_max timestamp_ntz, "
        "utc0 timestamp_ntz, diff_min bigint"
    ),
    "lookup_update_status": "LookUpNewUpdateTime timestamp_ntz, LookUpNewStatus int",
    "site_group": "Siteid int, SiteType string",
    "server_lookup": "Server string, LinkServerName string, GroupRouted boolean",
    "lag_target_types": "Type int",
    "isolated_types": "LinkServerName string, Type int, since timestamp_ntz, healthy boolean",
    "alert_recipients": (
        "Email string, Department string, name string, HourlyMail string, LookupMail string"
    ),
    "unreadable_sources": (
        "LinkServerName string, DBName string, MonthDB string, TableName string, Type int, "
        "query_string string"
    ),
}

# Text columns in which a blank means "none".
BLANK_IS_NULL = {"MonthDB", "SiteType", "Category"}


def fields(table: str) -> list[tuple[str, str]]:
    """(column, type) pairs of a logical table."""
    return [tuple(item.split(" ", 1)) for item in TABLES[table].split(", ")]


def columns(table: str) -> list[str]:
    return [name for name, _ in fields(table)]


def conform(df: DataFrame, table: str, keep_extra: bool = False) -> DataFrame:
    """Select the table's columns by name, trim blanks off the names and cast to the table's types."""
    by_name = {c.strip().lower(): c for c in df.columns}
    missing = [c for c in columns(table) if c.lower() not in by_name]
    if missing:
        raise ValueError(f"{table}: missing columns {missing}")
    out = []
    for name, kind in fields(table):
        col = F.col(f"`{by_name[name.lower()]}`").cast(kind)
        if name in BLANK_IS_NULL:
            col = F.when(F.trim(col) != "", col)
        out.append(col.alias(name))
    if keep_extra:
        known = {c.lower() for c in columns(table)}
        out += [F.col(f"`{c}`") for c in df.columns if c.strip().lower() not in known]
    return df.select(*out)
