"""Manifest and ledger rows of every hour of all order dates."""

import datetime as dt

from pyspark.sql import functions as F

from hourfold.constants import SOURCE_KEYS
from hourfold.functions import clock
from hourfold.operators import ledger, manifest
from hourfold.queries import QUERIES, _listed_spans
from hourfold.testbed import GIVEN, from_orders as od
from conftest import got

SF_DIR = "/root/testdata/sf0.001"
#: The first months, so that few rows are collected; sums are over all.
FIRST = "1992-04-01"


def hours_listed(rows, keys):
    """Keys and time of each hour that the days of ``rows`` list."""
    return {
        (*(r[k] for k in keys), str(dt.datetime.combine(r.day, dt.time(h))))
        for r in rows for h in range(24) if r.hours >> h & 1
    }


def test_pieces_keep_every_hour(spark, table):
    lookup = table("source_lookup", [
        ("S", 1, "Whole", None, "T", 1), ("S", 2, "Month", "2402", "T", 2), ("S", 3, "Whole", None, "T", 3),
    ], ["LinkServerName", "GameTypeSourceId", "DBName", "MonthDB", "TableName", "Type"])
    zones = table("type_timezone", [(1, -4), (2, 8)], ["Type", "Timezone"])
    sources = manifest.list_sources(lookup)
    spans = manifest.spans(sources, zones, dt.datetime(2024, 1, 3, 5), dt.datetime(2024, 5, 2, 7))
    whole = got(manifest.expand(spans))
    assert len(whole) == 2 * (24 * 120 + 3) + 24 * 29
    for days in (1, 7, 30):
        assert got(manifest.expand(manifest.pieces(spans, days))) == whole


def test_manifest_lists_every_hour(spark):
    rows, work = QUERIES["q_manifest"](spark, SF_DIR), manifest.expand(_listed_spans(spark, SF_DIR))
    assert rows.agg(F.sum("n_hours")).first()[0] == work.count()
    rows, work = (df.filter(F.col(c) < FIRST).collect() for df, c in ((rows, "day"), (work, "DatePlayed")))
    assert hours_listed(rows, SOURCE_KEYS) == {(*(w[k] for k in SOURCE_KEYS), str(w.DatePlayed)) for w in work}


def test_every_hour_starts_as_running(spark):
    keys = ["Server", "Type", "Destination", "Status"]
    rows = QUERIES["q_start_status"](spark, SF_DIR)
    started = ledger.start_status(manifest.expand(_listed_spans(spark, SF_DIR)), od.server_lookup(spark))
    assert rows.agg(F.sum("n_rows")).first()[0] == started.count()
    rows, started = (df.filter(F.col(c) < FIRST).collect() for df, c in ((rows, "day"), (started, "UpDateTime")))
    assert hours_listed(rows, keys) == {(*(s[k] for k in keys), str(s.UpDateTime)) for s in started}


def odd_spans(table):
    """Spans of Types with several sources and timezones, one without, that begin within an hour and end within a day."""
    lookup = table("source_lookup", [
        ("S", 1, "Whole", None, "T", 1), ("S", 2, "Month", "2402", "T", 2), ("S", 3, "Month", "2403", "T", 2),
        ("S", 4, "Other", "2402", "T", 2), ("V", 5, "Month", "2402", "T", 2), ("V", 6, "Whole", None, "T", 3),
        ("S", 7, "Month", "2402", "T", 4), ("S", 8, "Whole", None, "T", None),
    ], ["LinkServerName", "GameTypeSourceId", "DBName", "MonthDB", "TableName", "Type"])
    zones = table("type_timezone", [(1, -4), (2, 8), (2, -12), (3, 12)], ["Type", "Timezone"])
    sources = manifest.list_sources(lookup)
    first = dt.datetime(2024, 1, 30, 5, 30, 10)
    spans = [
        manifest.spans(sources, zones, first, last)
        for last in (first, dt.datetime(2024, 1, 30, 16, 31), dt.datetime(2024, 3, 2, 5, 30, 9))
    ]
    return spans[0].unionByName(spans[1]).unionByName(spans[2])


def test_days_list_the_hours_of_the_manifest(spark, table):
    spans = odd_spans(table)
    keys = [*SOURCE_KEYS, "Timezone", "read_month"]
    hours = manifest.expand(spans).withColumn("day", F.to_date("DatePlayed"))
    want = hours.groupBy(*keys, "day").agg(
        F.count(F.lit(1)), clock.hours_of_day("DatePlayed"), F.min("batch_utc"), F.min("start_t"), F.min("end_t"),
        F.min("DatePlayed"), F.bool_and("is_shared_db"),
    )
    for days in (1, 7, 30):
        listed = manifest.expand(manifest.pieces(spans, days, ["Type"], 3), by_day=True)
        out = listed.groupBy(*keys, "day").agg(
            F.sum("n_hours"), F.bit_or("hours"), F.min("batch_utc"), F.min("start_t"), F.min("end_t"),
            F.min("DatePlayed"), F.bool_and("is_shared_db"),
        )
        assert got(out) == got(want)
    whole = manifest.expand(spans.filter("Type = 3"), by_day=True)
    assert whole.count() == 1 + 2 + 33  # a row a day of a span, not an hour


def test_running_rows_by_day_are_those_of_the_hours(spark, table):
    spans = odd_spans(table)
    servers = table("server_lookup", [("10", "S", True), ("10", "V", False), ("20", "V", None)],
                    ["Server", "LinkServerName", "GroupRouted"])
    keys = ["Server", "Type", "Destination", "Status"]
    hours = ledger.start_status(manifest.expand(spans), servers).groupBy(*keys, F.to_date("UpDateTime").alias("day"))
    days = ledger.start_status(manifest.expand(spans, by_day=True), servers).groupBy(*keys, "day")
    assert got(days.agg(F.sum("n_hours"), F.bit_or("hours"))) == got(
        hours.agg(F.count(F.lit(1)), clock.hours_of_day("UpDateTime")))


def test_tasks_grow_with_the_days(spark, table):
    spans = odd_spans(table)
    assert manifest.day_tasks(spans) == manifest.day_tasks(spans.limit(0)) == 8
    n_days = manifest.expand(spans, by_day=True).count()
    assert n_days / 20 < manifest.day_tasks(spans, most=10) <= n_days / 10 + 1


def test_running_rows_of_repeated_keys(spark, tmp_path):
    """Suppliers that come twice or with another nation, and nulls; the days of a Type are grouped where they are made."""
    day = dt.datetime(2024, 1, 30)
    supplier = [
        (1, "a", 3, 5.0), (1, "a", 3, 5.0), (1, "b", 13, 5.0), (2, "c", 14, -1.0), (3, "d", None, 1.0),
        (None, "e", 4, 1.0), (4, "f", 7, None),
    ]
    shipped = [(1, 0), (1, 0), (None, 2), (2, 40)]
    lines = [(k, part, day + dt.timedelta(days=n)) for k in (1, 2, 3, 4, 5, None) for part, n in shipped]
    kinds = "l_suppkey bigint, l_partkey bigint, l_shipdate timestamp_ntz"
    spark.createDataFrame(supplier, GIVEN["supplier"]).write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame(lines, kinds).write.parquet(f"{tmp_path}/lineitem.parquet")
    rows = QUERIES["q_start_status"](spark, str(tmp_path))
    started = ledger.start_status(manifest.expand(_listed_spans(spark, str(tmp_path))), od.server_lookup(spark))
    keys = ["Server", "Type", "Destination", "Status"]
    want = started.groupBy(*keys, F.to_date("UpDateTime").alias("day")).agg(
        F.count(F.lit(1)), clock.hours_of_day("UpDateTime"))
    assert got(rows) == got(want)
    assert rows.columns == [*keys, "day", "n_rows", "hours"] and rows.count() > 200
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(Type#" in plan and "hashpartitioning(Server#" not in plan
