import datetime as dt
import os

import pytest
from conftest import got
from pyspark.sql import functions as F

from hourfold.operators import manifest
from hourfold.plans import hourly, watch
from hourfold.sinks import files
from hourfold.sources import tables

UTC = dt.datetime(2024, 2, 1, 2)
T, T1 = "2024-02-01 10:00:00", "2024-02-01 11:00:00"


def routed(spark, rows):
    """(Destination, LinkServerName, Type, DatePlayed, account)"""
    raw = spark.createDataFrame(rows, "Destination string, LinkServerName string, Type int, d string, GameAccount string")
    return raw.selectExpr(
        "CAST(d AS timestamp_ntz) AS DatePlayed", "GameAccount", "1 AS SiteId", "2 AS GameTypeSourceId",
        "CAST(3 AS decimal(28,2)) AS Commissionable", "CAST(1 AS bigint) AS WagersCount",
        "CAST(0 AS decimal(28,2)) AS PayOff", "CAST(0 AS bigint) AS WinsCount", "LinkServerName", "Type",
        "Destination",
    )


def keys(df):
    return df.select(*files.KEYS).distinct()


def held_rows(spark, path):
    return got(files.read_rollup(spark, path).select("Destination", "Type", "DatePlayed", "GameAccount"))


@pytest.mark.parametrize("layout", ["day", "hour"])
def test_rollup_sink_replaces_by_key(spark, tmp_path, layout):
    path = str(tmp_path / "r")
    first = routed(spark, [
        ("DS_Server", "S1", 1, T, "a"), ("DS_Server", "S1", 1, T, "b"), ("DS_Server", "S1", 2, T, "c"),
        ("DS_Server", "S1", 1, T1, "d"), ("Noah1_Server", "S1", 1, T, "a"),
        ("DS_Server", "S1", 1, "2024-02-02 00:00:00", None),
    ])
    want = got(first.select("Destination", "Type", "DatePlayed", "GameAccount"))
    for _ in range(2):
        files.write_rollup(first, keys(first), path, layout)
        assert held_rows(spark, path) == want
    # One key changes, one key ends up empty; the rest of their partitions stays.
    again = routed(spark, [("DS_Server", "S1", 1, T, "z")])
    due = keys(routed(spark, [("DS_Server", "S1", 1, T, "x"), ("Noah1_Server", "S1", 1, T, "x")]))
    files.write_rollup(again, due, path, layout)
    assert held_rows(spark, path) == [
        ("DS_Server", 1, "2024-02-01 10:00:00", "z"), ("DS_Server", 1, T1, "d"),
        ("DS_Server", 1, "2024-02-02 00:00:00", None), ("DS_Server", 2, T, "c"),
    ]


def test_writing_reads_nothing_back(spark, tmp_path):
    """A second write replaces rows that can no longer be read."""
    path = tmp_path / "r"
    rows = routed(spark, [("DS_Server", "S1", 1, T, "a"), ("DS_Server", "S1", 2, T, "b")])
    files.write_rollup(rows, keys(rows), str(path))
    for part in (path / "rows").rglob("*.parquet"):
        part.write_bytes(b"broken")
    files.write_rollup(rows, keys(rows), str(path))
    assert held_rows(spark, str(path)) == [("DS_Server", 1, T, "a"), ("DS_Server", 2, T, "b")]


def test_a_version_that_was_not_announced_is_not_read(spark, tmp_path):
    path = str(tmp_path / "r")
    first = routed(spark, [("DS_Server", "S1", 1, T, "a")])
    files.write_rollup(first, keys(first), path)
    other = routed(spark, [("DS_Server", "S1", 1, T, "z")])
    files.write_rollup(other, keys(other), path, version="9" * 20)
    assert held_rows(spark, path) == [("DS_Server", 1, T, "z")]
    (announced,) = [p for p in (tmp_path / "r" / "announced").glob("*.parquet")
                    if "9" * 20 in str(spark.read.parquet(str(p)).collect())]
    announced.unlink()
    assert held_rows(spark, path) == [("DS_Server", 1, T, "a")]


def test_reading_hours_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "r")
    rows = routed(spark, [("DS_Server", "S1", 1, T, "a"), ("DS_Server", "S1", 1, "2024-02-03 10:00:00", "b")])
    files.write_rollup(rows, keys(rows), path)
    at = F.lit(T).cast("timestamp_ntz")
    read = files.read_rollup(spark, path, at, at)
    assert [r["GameAccount"] for r in read.collect()] == ["a"]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_snapshots_show_the_newest_announced_version(spark, tmp_path):
    root = str(tmp_path / "state")
    assert files.read_snapshot(spark, root) is None
    for version in (1, 2, 2):
        files.write_snapshot(spark.range(version), root, version)
    spark.range(9).write.parquet(f"{root}/version=3")  # written, never announced
    assert files.read_snapshot(spark, root).count() == 2


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    folder = files.shared_dir(spark, "x")
    assert folder.startswith(f"{named.rstrip('/')}/x-" if named else "/")
    assert folder != files.shared_dir(spark, "x")
    assert files.stored(spark.range(3), "y").count() == 3
    kept = files.stored(spark.range(3), "z").inputFiles()[0].removeprefix("file:")
    assert os.path.exists(kept)
    files.clean(spark)
    assert not os.path.exists(kept)


@pytest.fixture
def inputs(table):
    """Type 22 in a month database, 97 in the shared one on a group server, 39 without timezone."""
    def make(**changes):
        base = dict(
            wagers=table("wagers", [
                ("S1", "_DbMonth", "2402", "A", 22, "2024-02-01 01:30:00", "Ann", 1, 220, "5", "1"),
                ("S2", "_DbShared", None, "C", 97, "2024-02-01 09:30:00", "bob", 6, 970, "7", None),
                ("S2", "_DbShared", None, "C", 97, "2024-02-01 09:30:00", "bob", 6, 973, "7", None),
            ]),
            lookup=table("source_lookup", [
                ("S1", 220, "_DbMonth", "2402", "A", 22), ("S1", 220, "_DbMonth", "2401", "A", 22),
                ("S1", 35, "_DbMonth", "2402", "X", 35), ("S2", 970, "_DbShared", None, "C", 97),
                ("S3", 390, "_DbPlain", None, "E", 39),
            ]),
            excluded=table("lag_target_types", [(35,)]),
            type_timezone=table("type_timezone", [(22, 0, T, "Success")]),
            raw_data_info=table("raw_data_info", [(97, 8), (22, 3)]),
            site_group=table("site_group", [(6, "Noah1"), (7, "Noah2")]),
            server_lookup=table("server_lookup", [("10", "S1", False), ("20", "S2", True), ("30", "S3", False)]),
            lookup_updates=table("lookup_update_status", [(T, 1)]),
            lag_status=table("lag_status", [(T, "S1", 22, None, "Success", None, None)]),
            lag_runs=table("lag_run_status", [(T, "Success")]),
            batch_status=table("batch_status", [("10", 22, "DS_Server", "Success", 1.0, "2024-02-01 09:00:00")]),
        )
        return hourly.Inputs(**{**base, **changes})

    return make


def ledger_rows(df, at=T):
    rows = df.filter(F.col("UpDateTime") == F.lit(at).cast("timestamp_ntz"))
    return got(rows.select("Server", "Type", "Destination", "Status"))


def test_an_hour_from_gates_to_ledger_and_again(spark, inputs, tmp_path):
    path = str(tmp_path / "rollup")
    book = inputs().batch_status
    for _ in range(2):
        result = hourly.run_hour(inputs(batch_status=book), UTC, path)
        book = files.stored(result.batch_status, "book")
        assert result.blocked is None
        assert held_rows(spark, path) == [
            ("DS_Server", 22, T, "ann"), ("DS_Server", 97, T, "bob"), ("Noah1_Server", 97, T, "bob")]
        assert ledger_rows(result.batch_status) == [
            ("10", 22, "DS_Server", "Success"), ("20", 97, "DS_Server", "Success"),
            ("20", 97, "Noah1_Server", "Success"), ("20", 97, "Noah2_Server", "Empty"),
            ("30", 39, "DS_Server", "Fail"),
        ]
    # The timezone of 97 was declared by its source and healed.
    assert got(result.type_timezone.select("Type", "Timezone")) == [(22, 0), (97, 8)]


def test_a_second_run_keeps_held_and_unknown_types(spark, table, inputs, tmp_path):
    path = str(tmp_path / "rollup")
    hourly.run_hour(inputs(), UTC, path)
    before = held_rows(spark, path)
    late = table("lag_status", [(T, "S2", 97, None, "Wait", None, None)])
    nowhere = table("raw_data_info", [(97, 8)])
    zones = table("type_timezone", [(97, 8, T, "Success")])
    again = hourly.run_hour(inputs(lag_status=late, type_timezone=zones, raw_data_info=nowhere), UTC, path)
    assert held_rows(spark, path) == before
    assert {r[3] for r in ledger_rows(again.batch_status) if r[1] in (22, 97)} == {"Fail"}


def test_an_unreadable_type_fails_alone(spark, inputs, tmp_path):
    fact = str(tmp_path / "fact")
    inputs().wagers.write.partitionBy("Type").parquet(fact)
    for part in (tmp_path / "fact" / "Type=97").glob("*.parquet"):
        part.write_bytes(b"not parquet")
    schema = inputs().wagers.schema
    wagers = spark.read.schema(schema).parquet(fact).select(*schema.names)
    result = hourly.run_hour(inputs(wagers=wagers), UTC, str(tmp_path / "r"))
    assert ledger_rows(result.batch_status) == [
        ("10", 22, "DS_Server", "Success"), ("20", 97, "DS_Server", "Fail"), ("20", 97, "Noah1_Server", "Fail"),
        ("20", 97, "Noah2_Server", "Fail"), ("30", 39, "DS_Server", "Fail")]
    assert held_rows(spark, str(tmp_path / "r")) == [("DS_Server", 22, T, "ann")]


def test_sources_without_read_right_fail_alone(spark, table, inputs, tmp_path):
    closed = table("unreadable_sources", [("S2", "_DbShared", None, "C", 97, None)])
    result = hourly.run_hour(inputs(unreadable=closed), UTC, str(tmp_path / "r"))
    assert {(r[1], r[3]) for r in ledger_rows(result.batch_status)} == {(22, "Success"), (97, "Fail"), (39, "Fail")}
    assert held_rows(spark, str(tmp_path / "r")) == [("DS_Server", 22, T, "ann")]


def test_inputs_fall_back_to_copies(spark, inputs, tmp_path):
    """No lookup and no game lookup in the folder: the copy and the fixed ids serve."""
    state, folder, backup = inputs(), tmp_path / "main", tmp_path / "copy"
    for name in hourly.LOOKUPS:
        getattr(state, name).write.parquet(str(folder / name))
    state.lookup_updates.write.parquet(str(folder / "lookup_update_status"))
    state.lag_runs.write.parquet(str(folder / "lag_run_status"))
    state.lookup.write.parquet(str(backup / "source_lookup"))
    (tmp_path / "closed.csv").write_text("LinkServerName ,DBName,MonthDB,TableName,Type,query_string\nS2,_DbShared,,C,97,x\n")
    read = hourly.read_inputs(spark, str(folder), str(backup), state.wagers, str(tmp_path / "closed.csv"))
    assert got(read.lookup) == got(state.lookup)
    assert got(read.excluded) == got(tables.fallback_excluded_types(spark))
    result = hourly.run_hour(read, UTC, str(tmp_path / "r"))
    assert {(r[1], r[3]) for r in ledger_rows(result.batch_status) if r[1] != 35} == {(22, "Success"), (97, "Fail"), (39, "Fail")}


def test_fact_scans_are_bounded(spark, inputs, tmp_path):
    """Literal bounds on the time and the month reach the scan."""
    fact = str(tmp_path / "fact")
    inputs().wagers.write.partitionBy("MonthDB").parquet(fact)
    schema = inputs().wagers.schema
    wagers = spark.read.schema(schema).parquet(fact).select(*schema.names)
    read = tables.within_batches(wagers, [(UTC, UTC), (UTC + dt.timedelta(days=9), UTC + dt.timedelta(days=9))])
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(isnull(MonthDB" in plan and "GreaterThanOrEqual(wagerstime,2024-01-31T13:00" in plan
    assert tables.within_batches(wagers, []).isEmpty()


@pytest.mark.parametrize("gate, change", [
    ("lookup", lambda t: {"lookup_updates": t("lookup_update_status", [("2024-02-01 09:59:00", 1)])}),
    ("lag", lambda t: {"lag_runs": t("lag_run_status", [(T, "Updating")])}),
])
def test_a_closed_gate_fails_the_hour(spark, table, inputs, tmp_path, gate, change):
    result = hourly.run_hour(inputs(**change(table)), UTC, str(tmp_path / "none"))
    assert result.blocked == gate and result.alert_rows.count() == 1
    assert ledger_rows(result.batch_status) == [("10", 22, "DS_Server", "Fail")]
    assert files.read_existing(spark, str(tmp_path / "none")) is None


def test_an_ambiguous_server_stops_alone(spark, table, inputs, tmp_path):
    lookup = table("source_lookup", [
        ("S1", 220, "_DbMonth", "2402", "A", 22), ("S1", 220, "_DbMonth", "2402", "B", 23),
        ("S2", 970, "_DbShared", None, "C", 97)])
    result = hourly.run_hour(inputs(lookup=lookup), UTC, str(tmp_path / "r"))
    assert result.blocked == "mapping" and got(result.alert_rows.select("LinkServerName", "n_sources")) == [("S1", 2)]
    assert ledger_rows(result.batch_status) == [
        ("10", 22, "DS_Server", "Fail"), ("20", 97, "DS_Server", "Success"),
        ("20", 97, "Noah1_Server", "Success"), ("20", 97, "Noah2_Server", "Empty")]
    assert held_rows(spark, str(tmp_path / "r")) == [("DS_Server", 97, T, "bob"), ("Noah1_Server", 97, T, "bob")]


def test_a_closed_gate_stops_the_redo_quietly(table, inputs, tmp_path):
    state = inputs(lag_runs=table("lag_run_status", [(T, "Updating")]))
    result = hourly.run_redo(state, UTC, str(tmp_path / "none"))
    assert result.blocked == "lag" and got(result.batch_status) == got(state.batch_status)


def test_a_failed_write_is_a_failed_hour(inputs, tmp_path):
    blocker = tmp_path / "file"
    blocker.write_text("not a folder")
    result = hourly.run_hour(inputs(), UTC, str(blocker / "below"))
    assert {r[3] for r in ledger_rows(result.batch_status)} == {"Fail"}


def test_late_hour_is_held_then_redone_once(spark, table, inputs, tmp_path):
    path = str(tmp_path / "rollup")
    late = table("lag_status", [(T, "S2", 97, None, "Wait", None, None), (T, "S1", 22, None, "Success", None, None)])
    before = hourly.run_hour(inputs(lag_status=late), UTC, path)
    assert [r for r in ledger_rows(before.batch_status) if r[1] == 97] == [
        ("20", 97, d, "Fail") for d in ("DS_Server", "Noah1_Server", "Noah2_Server")]
    assert held_rows(spark, path) == [("DS_Server", 22, T, "ann")]

    book = files.stored(before.batch_status, "book")
    zones = files.stored(before.type_timezone, "zones")
    waiting = hourly.run_redo(inputs(batch_status=book, type_timezone=zones, lag_status=late), UTC, path)
    assert got(waiting.batch_status) == got(book)

    cleared = table("lag_status", [(T, "S2", 97, None, "ReRun", None, None), (T, "S1", 22, None, "Success", None, None)])
    after = hourly.run_redo(inputs(batch_status=book, type_timezone=zones, lag_status=cleared), UTC, path)
    want = [("DS_Server", 22, T, "ann"), ("DS_Server", 97, T, "bob"), ("Noah1_Server", 97, T, "bob")]
    assert held_rows(spark, path) == want
    assert [r for r in ledger_rows(after.batch_status) if r[1] == 97] == [
        ("20", 97, "DS_Server", "Success"), ("20", 97, "Noah1_Server", "Success"), ("20", 97, "Noah2_Server", "Empty")]
    assert got(after.lag_status.select("Type", "Status")) == [(22, "Success"), (97, "Success")]

    # Redoing the same failure again leaves the same rows.
    hourly.run_redo(inputs(batch_status=book, type_timezone=zones, lag_status=cleared), UTC, path)
    assert held_rows(spark, path) == want


def test_redo_heals_timezones(spark, table, inputs, tmp_path):
    """The source of the redone Type declares a timezone that isn't stored."""
    path = str(tmp_path / "rollup")
    cleared = table("lag_status", [(T, "S2", 97, None, "ReRun", None, None)])
    book = table("batch_status", [("20", 97, "DS_Server", "Fail", 1.0, T)])
    after = hourly.run_redo(inputs(batch_status=book, lag_status=cleared), UTC, path)
    assert ledger_rows(after.batch_status) == [("20", 97, "DS_Server", "Success")]
    assert held_rows(spark, path) == [("DS_Server", 97, T, "bob")]
    assert (97, 8) in got(after.type_timezone.select("Type", "Timezone"))


def test_redo_touches_only_the_failed_destination(spark, table, inputs, tmp_path):
    path = str(tmp_path / "rollup")
    cleared = table("lag_status", [(T, "S2", 97, None, "ReRun", None, None)])
    zones = table("type_timezone", [(97, 8, T, "Success")])
    book = table("batch_status", [
        ("20", 97, "DS_Server", "Success", 1.0, T), ("20", 97, "Noah1_Server", "Fail", 1.0, T)])
    state = inputs(batch_status=book, type_timezone=zones, lag_status=cleared)
    hourly.run_redo(state, UTC, path)
    assert held_rows(spark, path) == [("Noah1_Server", 97, T, "bob")]
    hourly.run_redo(state, UTC, path, all_destinations=True)
    assert held_rows(spark, path) == [("DS_Server", 97, T, "bob"), ("Noah1_Server", 97, T, "bob")]


def test_lag_check_then_recheck(table):
    lookup = table("source_lookup", [("S1", 22, "d", None, "t", 22), ("S1", 98, "d", None, "u", 98)])
    games = table("game_lookup", [(22, "h", "x")])
    obs = table("tz_observations", [
        (str(UTC), "10", 22, "2024-02-01 01:40:00", None, None), ("2024-02-01 03:00:00", "10", 22, str(UTC), None, None)])
    zones = table("type_timezone", [(22, 0)], only=["Type", "Timezone"])
    none = table("lag_status", [("2024-02-01 09:00:00", "S1", 22, "x", "Wait", None, None)])
    result = watch.run_lag_check(
        lookup, games, obs, zones, table("lag_target_types", [(22,)]), none,
        table("lag_run_status", [("2024-02-01 09:00:00", "Success")]), UTC)
    now = result.lag_status.filter(F.col("DatePlayed") == F.lit(T).cast("timestamp_ntz"))
    assert got(now.select("Type", "Status")) == [(22, "Wait"), (98, "Success")]
    assert got(result.lag_runs)[-1] == (T, "Success") and result.alert_rows.isEmpty()
    assert got(watch.run_recheck(now, obs).select("Type", "Status")) == [(22, "ReRun"), (98, "Success")]


def test_observe_then_lag_check_twice(table):
    """The check sees the reading of its own hour, and a second check replaces the first."""
    lookup = table("source_lookup", [("S1", 22, "d", None, "t", 22)])
    fact = table("wagers", [("S1", "d", None, "t", 22, "2024-02-01 01:59:00", "a", 1, 22, "1", "1")])
    servers, zones = table("server_lookup", [("10", "S1", False)]), table("type_timezone", [(22, 0)], only=["Type", "Timezone"])
    obs = watch.run_observe(fact, lookup, table("tz_observations", []), servers, UTC)
    games, targets = table("game_lookup", [(22, "h", "x")]), table("lag_target_types", [(22,)])
    rows, runs = table("lag_status", []), table("lag_run_status", [])
    for _ in range(2):
        result = watch.run_lag_check(lookup, games, obs, zones, targets, rows, runs, UTC)
        rows, runs = files.stored(result.lag_status, "lag"), files.stored(result.lag_runs, "runs")
        assert got(rows.select("DatePlayed", "Type", "Status")) == [(T, 22, "Success")]
        assert got(runs) == [(T, "Success")]


def test_timezone_analysis_merges_only_without_changes(table):
    obs = table("tz_observations", [
        (f"2024-02-01 {h:02d}:00:00", s, t, f"2024-02-01 {h - 1:02d}:50:00", f"2024-02-01 {h:02d}:00:00", 10)
        for h in range(1, 9) for s, t in (("10", 22), ("20", 22), ("20", 97))])
    args = (
        obs, ["10"], ["20"], table("source_lookup", [("S1", 1, "d", None, "t", t) for t in (22, 97)]),
        table("raw_data_info", [(22, 4), (97, 5)]), table("game_lookup", [(22, "h", "機率")]),
    )
    same = watch.run_timezone_analysis(*args, table("type_timezone", [(22, 0, T, "Success")]), UTC)
    assert same.merged and got(same.type_timezone.select("Type", "Timezone", "Status")) == [
        (22, 0, "Success"), (97, 5, "Success")]
    moved = watch.run_timezone_analysis(*args, table("type_timezone", [(22, 8, T, "Success")]), UTC)
    assert not moved.merged and got(moved.type_timezone.select("Timezone")) == [(8,)]
    assert [r["body"] for r in moved.alert_rows.collect()] == ["Timezone of Type 22 changed from 8 to 0; not merged"]


def test_observation_run(table):
    lookup = table("source_lookup", [("S1", 22, "d", None, "t", 22)])
    fact = table("wagers", [("S1", "d", None, "t", 22, "2024-02-01 01:40:00", "a", 1, 22, "1", "1")])
    old = table("tz_observations", [("2024-02-01 01:00:00", "10", 22, None, None, None)])
    out = watch.run_observe(fact, lookup, old, table("server_lookup", [("10", "S1", False)]), UTC)
    assert got(out)[-1] == (str(UTC), "10", 22, "2024-02-01 01:40:00", str(UTC), 20)
    # A stored reading bounds what is read, and stays where nothing newer is found.
    known = table("tz_observations", [(str(UTC), "10", 22, "2024-02-01 01:50:00", None, None)])
    out = watch.run_observe(fact, lookup, known, table("server_lookup", [("10", "S1", False)]), UTC + dt.timedelta(hours=1))
    assert got(out)[-1] == ("2024-02-01 03:00:00", "10", 22, "2024-02-01 01:50:00", "2024-02-01 03:00:00", 70)
    assert manifest.list_sources(lookup).count() == 1
