from conftest import got
from pyspark.sql import functions as F

from hourfold.operators import alerts, gates, ledger, manifest
from hourfold.sinks import files
from hourfold.sources import tables

T = "2024-02-01 08:00:00"
LEDGER = ["Server", "Type", "Destination", "Status"]


def plan(spark, table):
    """Two sources of Type 1, and one of each Type 2 to 4; Type 4 has no timezone."""
    rows = table("source_lookup", [
        ("S2", 1, "_Db", None, "A", 1), ("S2", 1, "_Db", None, "B", 1), ("S2", 2, "_Db", None, "C", 2),
        ("S1", 3, "_Db", None, "D", 3), ("S1", 4, "_Db", None, "E", 4),
    ])
    tz = table("type_timezone", [(1, 0), (2, 0), (3, 0)], only=["Type", "Timezone"])
    at = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    return manifest.schedule(manifest.list_sources(rows), tz, at, at)


def servers(table):
    return table("server_lookup", [("10", "S1", False), ("20", "S2", True)])


def routed(spark, rows):
    df = spark.createDataFrame(rows, "LinkServerName string, Type int, Destination string")
    return df.withColumn("DatePlayed", F.lit(T).cast("timestamp_ntz"))


def test_outcome_per_type_and_destination(spark, table):
    held = table("lag_status", [(T, "S1", 3, None, "wait", None, None), (T, "S2", 2, None, "Success", None, None)])
    out = ledger.batch_outcome(
        plan(spark, table), routed(spark, [("S2", 1, "DS_Server"), ("S2", 1, "DS_Server")]),
        ledger.not_ready(held), servers(table),
    )
    assert got(out.select(*LEDGER)) == [
        ("10", 3, "DS_Server", "Fail"), ("10", 4, "DS_Server", "Fail"),
        ("20", 1, "DS_Server", "Success"), ("20", 1, "Noah1_Server", "Empty"),
        ("20", 1, "Noah2_Server", "Empty"), ("20", 2, "DS_Server", "Empty"),
        ("20", 2, "Noah1_Server", "Empty"), ("20", 2, "Noah2_Server", "Empty"),
    ]


def test_one_failed_source_fails_its_type(spark, table):
    failures = routed(spark, [("S2", 1, "x")])
    held = ledger.not_ready(table("lag_status", [(T, "S9", 9, None, "Wait", None, None)]))
    out = ledger.batch_outcome(
        plan(spark, table), routed(spark, [("S2", 1, "DS_Server")]), held, servers(table), failures, 2.5
    )
    rows = out.filter("Type = 1").select("Status", "Exe_Time_sec").distinct()
    assert got(rows) == [("Fail", 2.5)]


def test_ledger_has_a_row_per_source_and_destination(spark, table):
    started = ledger.start_status(plan(spark, table), servers(table))
    assert started.count() == 3 * 3 + 2
    assert started.filter("Status <> 'Running' OR Exe_Time_sec IS NOT NULL").isEmpty()


def book(table, rows):
    return table("batch_status", rows)


def test_updates_by_destination_and_for_all(table):
    old = book(table, [
        ("20", 1, d, "Running", None, T) for d in ("DS_Server", "Noah1_Server")
    ] + [("20", 2, "DS_Server", "Running", None, T), ("20", 3, "DS_Server", "Running", None, T)])
    new = book(table, [
        ("20", 1, None, "Fail", 1.0, T), ("20", 1, "DS_Server", "Success", 2.0, T),
        ("20", 2, "DS_Server", "Empty", None, T), ("20", 3, "DS_Server", "Success", 2.0, "2024-02-01 09:00:00"),
    ])
    assert got(ledger.apply_status(old, new).select(*LEDGER, "Exe_Time_sec")) == [
        ("20", 1, "DS_Server", "Success", 2.0), ("20", 1, "Noah1_Server", "Fail", 1.0),
        ("20", 2, "DS_Server", "Empty", None), ("20", 3, "DS_Server", "Running", None),
    ]


def test_mark_running_clears_the_time_of_listed_rows(table):
    old = book(table, [("20", 1, "DS_Server", "Fail", 3.0, T), ("20", 2, "DS_Server", "Fail", 3.0, T)])
    keys = old.filter("Type = 1")
    out = ledger.mark_running(old, keys.unionByName(keys))
    assert got(out.select(*LEDGER, "Exe_Time_sec")) == [
        ("20", 1, "DS_Server", "Running", None), ("20", 2, "DS_Server", "Fail", 3.0)]


def test_clone_repeats_all_rows_of_the_last_good_hour(table):
    early, late, now = "2024-02-01 08:00:00", "2024-02-01 09:00:00", "2024-02-01 10:00:00"
    old = book(table, [
        ("20", 1, "DS_Server", "Success", 3.0, early), ("20", 2, "DS_Server", "Fail", 4.0, early),
        ("20", 1, "DS_Server", "Fail", 5.0, late), ("10", 1, "DS_Server", "Empty", 6.0, late),
    ])
    assert got(ledger.clone_last_as_fail(old, now)) == [
        ("10", 1, "DS_Server", "Fail", 6.0, now), ("20", 1, "DS_Server", "Fail", 3.0, now),
        ("20", 2, "DS_Server", "Fail", 4.0, now),
    ]
    assert ledger.clone_last_as_fail(old, now, server="10").count() == 1


def test_fail_all_types(spark, table):
    rows = table("source_lookup", [("S1", 1, "d", None, "t", 7), ("S1", 2, "d", None, "t", 7), ("S2", 1, "d", None, "t", 8)])
    assert got(ledger.fail_all_types(rows, "S1", "10", T)) == [("10", 7, "Fail", T)]


def hours(spark, *stamps):
    return spark.createDataFrame([(s,) for s in stamps], "c string").selectExpr("CAST(c AS timestamp_ntz) AS current")


def test_lookup_gate(spark, table):
    updates = table("lookup_update_status", [("2024-02-01 08:30:00", 1), ("2024-02-01 11:00:00", 0)])
    current = hours(spark, "2024-02-01 08:00:00", "2024-02-01 09:00:00")
    assert got(gates.gate_lookup_fresh(current, updates)) == [
        ("2024-02-01 08:00:00", True), ("2024-02-01 09:00:00", False)]
    assert got(gates.gate_lookup_fresh(current, updates.limit(0))) == [
        ("2024-02-01 08:00:00", False), ("2024-02-01 09:00:00", False)]


def test_lag_gate_and_markers(spark, table):
    opened = gates.open_lag_run(hours(spark, T, "2024-02-01 09:00:00").withColumnRenamed("current", "DatePlayed"))
    marked = gates.mark_lag_run(opened, opened.limit(0).unionByName(opened.filter(F.col("DatePlayed") == F.lit(T).cast("timestamp_ntz"))))
    assert got(marked) == [(T, "Success"), ("2024-02-01 09:00:00", "Updating")]
    gate = gates.gate_lag_done(hours(spark, T, "2024-02-01 09:00:00"), marked)
    assert got(gate) == [(T, True), ("2024-02-01 09:00:00", False)]
    assert [r["body"] for r in alerts.gate_alerts(gate, "Lag check").collect()] == [
        "Lag check not ready at 2024-02-01 09:00:00.000"]


def test_ambiguous_mappings(table):
    rows = table("source_lookup", [
        ("S1", 1, "a", "2402", "t", 1), ("S2", 1, "b", None, "t", 2), ("S1", 1, "a", "2401", "t", 1),
        ("S1", 2, "a", "2402", "t", 1), ("S1", 2, "a", "2401", "t", 1),
        ("S1", None, "n", None, "t", 3), ("S1", None, "n", None, "u", 3),
    ])
    hit = gates.ambiguous_mappings(rows, T)
    assert got(hit) == [("S1", "a", "2401", "t", 1), ("S1", "a", "2402", "t", 1), ("S2", "b", None, "t", 2)]
    assert got(gates.ambiguous_mappings(rows, T, "S2")) == [("S2", "b", None, "t", 2)]
    assert gates.ambiguous_mappings(rows, "2024-01-15 00:00:00").count() == 3
    assert gates.ambiguous_mappings(rows.filter("GameTypeSourceId IS NULL"), T).isEmpty()


def test_missing_and_healed_timezones(table):
    rows = table("source_lookup", [
        ("S1", 1, "a", "2402", "t", 1), ("S1", 2, "a", "2402", "t", 2), ("S2", 3, "a", "2401", "t", 3),
        ("S2", 4, "a", None, "t", 4),
    ])
    known = table("type_timezone", [(1, 0)], only=["Type", "Timezone"])
    info = table("raw_data_info", [(1, 5), (2, 8), (2, 8), (3, 8), (4, -4), (4, 0)])
    missing = gates.missing_timezones(rows, known)
    assert got(missing) == [(2,), (3,), (4,)]
    assert got(gates.missing_timezones(rows, known, "S1")) == [(2,)]
    healed = gates.heal_timezones(rows, info, missing, T)
    assert got(healed.select("Type", "Timezone", "Status")) == [(2, 8, "Success"), (4, -4, "Success"), (4, 0, "Success")]
    assert got(gates.conflicting_timezones(healed)) == [(4, -4, 0)]


def people(table):
    return table("alert_recipients", [
        ("a@x", "DS", "ann", "Send", "Send"), ("b@x", "DS", "bob", "Hold", None),
        ("c@x", "DBA", "ann", "Send", None), ("a@x", "DS", "ann", "Send", "Send"),
    ])


def test_recipients(table):
    def picked(mode):
        return [r[0] for r in got(alerts.select_recipients(people(table), mode, "ann").select("Email").distinct())]

    assert picked("hourly_all") == ["a@x", "c@x"] and picked("hourly_department") == ["a@x"]
    assert picked("lookup") == ["a@x"] and picked("owner") == ["a@x"]


def test_recipient_lines_keep_every_address(spark, table):
    chosen = alerts.select_recipients(people(table), "hourly_all")
    assert got(alerts.recipient_lines(chosen)) == [("hourly_all", "a@x, c@x")]
    many = spark.range(500).select(F.lit("m").alias("mode"), F.concat(F.col("id"), F.lit("@x")).alias("Email"))
    for digits in (None, 0, 1, 2):
        lines = [r["recipients"].split(", ") for r in alerts.recipient_lines(many, digits, per_line=7).collect()]
        assert sorted(map(len, lines)) == [500 % 7, *[7] * (500 // 7)]
        assert sorted(sum(lines, [])) == sorted(f"{i}@x" for i in range(500))


def test_unreadable_sources(spark, table, tmp_path):
    (tmp_path / "no.csv").write_text(
        "LinkServerName ,DBName,MonthDB,TableName,Type,query_string\n"
        "S1,a,2402,t,1,x\nS2,b,,u,2,x\n"
    )
    unreadable = tables.read_unreadable(spark, str(tmp_path / "no.csv"))
    assert unreadable.columns[0] == "LinkServerName"
    rows = table("source_lookup", [
        ("S1", 1, "a", "2402", "t", 1), ("S1", 1, "a", "2401", "t", 1), ("S2", 1, "b", None, "u", 2),
    ])
    left = tables.exclude_unreadable(manifest.list_sources(rows), unreadable)
    assert got(left) == [("S1", "a", "2401", "t", 1)]


def test_backup_copy_is_read_when_the_primary_is_gone(spark, table, tmp_path):
    rows = table("raw_data_info", [(1, 5)])
    rows.write.parquet(str(tmp_path / "backup"))
    read = tables.read_with_fallback(spark, "raw_data_info", str(tmp_path / "none"), str(tmp_path / "backup"))
    assert got(read) == [(1, 5)]


def test_backup_copy_is_read_when_a_file_is_broken(spark, table, tmp_path):
    """A file that opens by its schema and fails when it is read."""
    rows = table("raw_data_info", [(i, i) for i in range(50)])
    for name in ("main", "backup"):
        rows.repartition(4).write.parquet(str(tmp_path / name))
    read, which = tables.choose_copy(spark, "raw_data_info", str(tmp_path / "main"), str(tmp_path / "backup"))
    assert which == "primary" and read.count() == 50
    files.damage(spark, str(tmp_path / "main"))
    read, which = tables.choose_copy(spark, "raw_data_info", str(tmp_path / "main"), str(tmp_path / "backup"))
    assert which == "backup" and read.count() == 50


def test_wagers_reader_prunes_and_pushes_down(spark, table, tmp_path):
    import datetime as dt

    fact = table("wagers", [
        ("S1", "a", "2312", "t", 1, "2023-12-31 23:30:00", "x", 1, 1, "1", "1"),
        ("S1", "a", "2401", "t", 1, "2024-01-01 10:30:00", "x", 1, 1, "1", "1"),
        ("S1", "a", "2402", "t", 1, "2024-02-01 10:30:00", "x", 1, 1, "1", "1"),
        ("S2", "b", None, "u", 2, "2024-01-01 00:30:00", "x", 1, 1, "1", "1"),
        ("S2", "b", None, "u", 2, "2024-01-03 00:30:00", "x", 1, 1, "1", "1"),
    ])
    fact.write.partitionBy("Type", "MonthDB").parquet(str(tmp_path / "w"))
    hour = dt.datetime(2024, 1, 1)
    read = tables.read_wagers(spark, str(tmp_path / "w"), hour, hour)
    assert got(read.select("Type", "wagerstime")) == [
        (1, "2023-12-31 23:30:00"), (1, "2024-01-01 10:30:00"), (2, "2024-01-01 00:30:00")]
    shown = read._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(wagerstime), GreaterThanOrEqual(wagerstime" in shown
    assert "MonthDB" in shown.split("PartitionFilters: ")[1].split("PushedFilters")[0]
