"""Hour-level tables derived from ``events``: five Types on three linked servers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions import clock
from ..operators import lag, routing
from . import fixed_rows, given

# Where each Type lives: Type, event type, server, database, has month databases, table.
PLACES = [
    (22, "click", "S1", "_DbMonth", True, "TblA"),
    (23, "view", "S1", "_DbMonth", True, "TblB"),
    (97, "purchase", "S2", "_DbShared", False, "TblC"),
    (98, "signup", "S2", "_DbShared", False, "TblD"),
    (39, "error", "S3", "_DbPlain", False, "TblE"),
]
# Listed games: Type, games. Month databases are listed for the months of the events; that of the month
# before them holds one game of Type 22.
LISTED = [
    (22, [220, 221, 222, 223]),
    (23, [230, 231, 232, 233]),
    (97, [970, 971, 972]),
    (98, [980]),
    (39, [390]),
]
BEFORE = (22, 220)
ZONES = [(22, 0), (23, 8), (97, -4), (98, 8)]
DECLARED = [(22, 0), (23, 8), (97, -4), (98, 8), (39, 7)]
CATEGORIES = [(22, "HallA", "機率"), (23, "HallA", "機率"), (97, "HallB", "機率"), (98, "HallC", "真人")]
SERVERS = [("10", "S1", False), ("20", "S2", True), ("30", "S3", False)]
TARGETS = [22, 23, 97, 39]
FIRST_PATH, SECOND_PATH = ["10", "30"], ["20"]
# The run that looks back on the month.
AFTER_UTC, AFTER = "2024-01-31 00:00:00", "2024-01-31 08:00:00"
# A batch hour in the middle of the month.
BATCH = dt.datetime(2024, 1, 15, 6)
# Hours (UTC) whose sources are observed and checked one after the other.
CHECKED = [BATCH - dt.timedelta(hours=h) for h in (2, 1, 0)]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "events")


def _of_event(position: int) -> str:
    """SQL for a column of PLACES looked up by event type; unknown events live with the last row."""
    def literal(value: object) -> str:
        return f"'{value}'" if isinstance(value, str) else str(value)

    cases = " ".join(f"WHEN '{row[1]}' THEN {literal(row[position])}" for row in PLACES[:-1])
    return f"CASE event_type {cases} ELSE {literal(PLACES[-1][position])} END"


def wagers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as wagers: mixed-case accounts, NULL and zero bets, NULL and negative payoffs."""
    placed = events(spark, sf_dir).selectExpr(
        "event_id AS eid", "user_id", "ts", "CAST(value AS decimal(18,2)) AS amount",
        *[f"{_of_event(i)} AS {name}" for i, name in enumerate(
            ["Type", "event_type", "LinkServerName", "DBName", "monthly", "TableName"])],
    )
    return placed.selectExpr(
        "LinkServerName", "DBName",
        "IF(monthly, lpad(CAST((year(ts) * 100 + month(ts)) % 10000 AS string), 4, '0'), NULL) "
        "AS MonthDB",
        "TableName", "Type", "ts AS wagerstime",
        "concat(IF(eid % 2 = 0, 'User', 'USER'), CAST(user_id AS string)) AS GameAccount",
        "CAST(user_id % 8 AS int) AS SiteId",
        "CAST(Type * 10 + eid % 4 AS int) AS GameTypeSourceId",
        "CAST(CASE eid % 10 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE amount END AS decimal(18,2)) "
        "AS betamount",
        "CAST(CASE WHEN eid % 7 = 0 THEN NULL WHEN eid % 3 = 0 THEN amount ELSE -amount END "
        "AS decimal(18,2)) AS PayOff",
    )


def arrived(spark: SparkSession, sf_dir: str, utc: dt.datetime) -> DataFrame:
    """Wagers that were there at an hour."""
    return wagers(spark, sf_dir).filter(F.col("wagerstime") < clock.as_ntz(utc))


def event_months(spark: SparkSession, sf_dir: str) -> list[str]:
    """The month before the first event, and every month from the first to the last event."""
    first, last = hour_range(spark, sf_dir)
    numbers = range(first.year * 12 + first.month - 2, last.year * 12 + last.month)
    return [f"{n // 12 % 100:02d}{n % 12 + 1:02d}" for n in numbers]


def source_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    place, months = {p[0]: p for p in PLACES}, event_months(spark, sf_dir)
    listed = [(t, game, month) for t, games in LISTED for game in games for month in (months[1:] if place[t][4] else [None])]
    rows = [
        (place[t][2], game, place[t][3], month, place[t][5], t) for t, game, month in [(*BEFORE, months[0]), *listed]
    ]
    return fixed_rows(spark, rows, "LinkServerName string, GameTypeSourceId int, DBName string, MonthDB string, "
        "TableName string, Type int",
    )


def type_timezone(spark: SparkSession) -> DataFrame:
    rows = fixed_rows(spark, ZONES, "Type int, Timezone int")
    return rows.withColumn("UpdateTime", clock.as_ntz("2024-01-01 00:00:00")).withColumn(
        "Status", F.lit("Success")
    )


def raw_data_info(spark: SparkSession) -> DataFrame:
    return fixed_rows(spark, DECLARED, "Type int, Timezone int")


def game_lookup(spark: SparkSession) -> DataFrame:
    return fixed_rows(spark, CATEGORIES, "RawDataType int, GameHallName string, Category string")


def server_lookup(spark: SparkSession) -> DataFrame:
    return fixed_rows(spark, SERVERS, "Server string, LinkServerName string, GroupRouted boolean")


def site_group(spark: SparkSession) -> DataFrame:
    rows = [(s, {6: "Noah1", 7: "Noah2"}.get(s)) for s in range(8)]
    return fixed_rows(spark, rows, "Siteid int, SiteType string")


def lag_target_types(spark: SparkSession) -> DataFrame:
    return fixed_rows(spark, [(t,) for t in TARGETS], "Type int")


def hour_range(spark: SparkSession, sf_dir: str) -> tuple[dt.datetime, dt.datetime]:
    """First and last hour with an event: one row, as a caller of a run would give it."""
    span = events(spark, sf_dir).agg(F.min("ts"), F.max("ts")).first()
    first, last = (t.replace(minute=0, second=0, microsecond=0) for t in span)
    return first, last


def batch_range(spark: SparkSession, sf_dir: str) -> tuple[dt.datetime, dt.datetime]:
    """First and last batch hour in which a Type of any timezone has its events read."""
    (first, last), zones = hour_range(spark, sf_dir), [z for _, z in ZONES]
    return first + dt.timedelta(hours=1 - max(zones)), last + dt.timedelta(hours=1 - min(zones))


def observations(spark: SparkSession, sf_dir: str, both_paths: bool = False) -> DataFrame:
    """Hourly readings: newest wager so far, on the provider's clock, at the end of the hour.

    ``both_paths`` repeats the readings of server 10 with Type 22 on server 20.
    """
    wagered = events(spark, sf_dir).select(
        F.expr(_of_event(0)).alias("Type"), clock.hour_floor(F.col("ts")).alias("h"), "ts"
    )
    first, last = hour_range(spark, sf_dir)
    places = fixed_rows(spark, [
        (p[0], s, dict(ZONES).get(p[0], 0)) for p in PLACES for s, link, _ in SERVERS if link == p[2]
    ], "Type int, Server string, zone int")
    hours = F.sequence(clock.as_ntz(first), clock.as_ntz(last), F.expr("interval 1 hour"))
    calendar = places.select(
        "Type", F.explode(hours).alias("h"),
        F.lit(None).cast("timestamp_ntz").alias("ts"),
    )
    per_hour = wagered.unionByName(calendar).groupBy("Type", "h").agg(F.max("ts").alias("newest"))
    # One row per hour of the calendar for each Type.
    so_far = (
        Window.partitionBy("Type").orderBy("h")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = per_hour.withColumn("so_far", F.max("newest").over(so_far)).join(places, "Type")
    utc0 = clock.plus_hours(F.col("h"), 1)
    reading = clock.plus_hours(F.col("so_far"), F.col("zone"))
    if both_paths:
        also = F.when(F.col("Type") == 22, F.array("Server", F.lit("20"))).otherwise(F.array("Server"))
        running = running.withColumn("Server", F.explode(also))
    return running.select(
        utc0.alias("Batch_time"), "Server", "Type", reading.alias("table_max"), utc0.alias("utc0"),
        clock.minutes_crossed(reading, utc0).alias("diff_min"),
    )


def lag_hours(spark: SparkSession, sf_dir: str, targets: DataFrame | None = None) -> DataFrame:
    """Lag rows of all hours with readings."""
    first, last = hour_range(spark, sf_dir)
    return lag.lag_status(
        lag.lag_structure(source_lookup(spark, sf_dir), game_lookup(spark)),
        observations(spark, sf_dir), type_timezone(spark),
        lag_target_types(spark) if targets is None else targets,
        first + dt.timedelta(hours=1), last + dt.timedelta(hours=1),
    )


def batch_status(lag_rows: DataFrame, servers: DataFrame) -> DataFrame:
    """A ledger to go with lag rows: waiting hours failed, the others ended well."""
    due = routing.expected_destinations(lag_rows, servers)
    waited = F.col("Status") == "Wait"
    return due.select(
        "Server", "Type", "Destination", F.when(waited, "Fail").otherwise("Success").alias("Status"),
        F.when(~waited, F.lit(1.5)).alias("Exe_Time_sec"), F.col("DatePlayed").alias("UpDateTime"),
    )


def lookup_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signups stand for lookup updates, some of them unfinished."""
    rows = events(spark, sf_dir).filter(F.col("event_type") == "signup")
    done = F.when(F.col("event_id") % 3 == 0, 0).otherwise(1)
    return rows.select(F.col("ts").alias("LookUpNewUpdateTime"), done.alias("LookUpNewStatus"))


def output_hours(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Output-clock hours in which anything happened."""
    hour = clock.utc_to_output(clock.hour_floor(F.col("ts")))
    return events(spark, sf_dir).select(hour.alias(name)).distinct()


def purchase_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    bought = events(spark, sf_dir).filter(F.col("event_type") == "purchase")
    return bought.select(clock.utc_to_output(clock.hour_floor(F.col("ts"))).alias("DatePlayed")).distinct()
