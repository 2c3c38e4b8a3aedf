import pytest
from pyspark.sql import functions as F

from conftest import got
from hourfold.operators import timezones as tz, zones
from hourfold.sinks import keyed
from hourfold.sinks.wagers import WagerTable

A, B = "2024-01-10 05:00:00", "2024-01-10 06:00:00"
LOOKUP = [("S1", 1, "_Db", None, "T", 22), ("S1", 2, "_Db", None, "T", 22), ("S2", 9, "_DbShared", None, "U", 97)]


def bet(t, place=("S1", "_Db", None, "T", 22), game=1, account="a"):
    return (*place, t, account, 1, game, "1.0", "0.5")


U = ("S2", "_DbShared", None, "U", 97)


@pytest.fixture
def held(spark, tmp_path):
    return WagerTable(spark, str(tmp_path / "w"))


def same_as_scan(held, wagers, lookup):
    """Zones are those of the wagers, and give the readings of a scan."""
    days = held.current().groupBy("Day", *zones.ZONE_KEYS).agg(F.min("first_t"), F.max("last_t"), F.sum("n"))
    assert got(days) == got(zones.build(wagers).select(*days.columns[:-3], "first_t", "last_t", "n"))
    assert got(tz.observe_zones(held.current(), lookup, B)) == got(tz.observe_source_max(wagers, lookup, B))
    assert got(held.read()) == got(wagers)


def test_loads_are_replaced_and_only_changed_days_indexed(spark, table, held):
    first = [bet("2024-01-08 01:00:00"), bet("2024-01-09 02:00:00"), bet("2024-01-09 03:00:00", U, 9), bet(None)]
    later = [bet("2024-01-09 23:59:59.999999"), bet("2024-01-10 00:00:00", U, 8), bet("2024-01-10 04:00:00", U, None)]
    lookup = table("source_lookup", LOOKUP)
    assert held.load(table("wagers", first), A) == 3
    assert held.load(table("wagers", later), B) == 2
    assert held.refresh() == 0
    same_as_scan(held, table("wagers", first + later), lookup)
    # The first load again: one day is gone, the other days are written anew.
    assert held.load(table("wagers", first[1:]), A) == 3
    same_as_scan(held, table("wagers", first[1:] + later), lookup)
    low, high = (F.lit(f"2024-01-{t}").cast("timestamp_ntz") for t in ("09 03:00:00", "10 00:00:00"))
    assert got(held.read(low, high).select("Type", "wagerstime")) == [
        (22, "2024-01-09 23:59:59.999999"), (97, "2024-01-09 03:00:00"), (97, "2024-01-10 00:00:00")]


def test_zones_that_do_not_match_are_not_used(spark, table, held, monkeypatch):
    """A run that dies between wagers and zones: readers look at its days, the next run mends them."""
    lookup, one, two = table("source_lookup", LOOKUP), [bet("2024-01-08 01:00:00")], [bet("2024-01-08 02:00:00"), bet("2024-01-09 01:00:00")]
    held.load(table("wagers", one), A)
    monkeypatch.setattr(held, "refresh", lambda: 0)
    held.load(table("wagers", two), A)
    same_as_scan(held, table("wagers", two), lookup)
    monkeypatch.undo()
    assert held.refresh() == 2 and held.refresh() == 0
    same_as_scan(held, table("wagers", two), lookup)


def test_merged_versions_keep_their_zones(spark, table, held):
    rows = [bet(f"2024-01-{9 + k % 2:02d} 0{k}:00:00", account=f"u{k}") for k in range(3)]
    for k, row in enumerate(rows):
        held.load(table("wagers", [row]), f"2024-01-10 0{k}:00:00")
    for part in (held.facts, held.zones):
        keyed.compact(spark, part, fanout=3)
        keyed.expire(spark, part, keep_seconds=0)
    assert len(keyed.live(spark, held.facts)) == 1 and held.refresh() == 0
    same_as_scan(held, table("wagers", rows), table("source_lookup", LOOKUP))


def test_windows(spark, table):
    """Windows without a wager's day or outside of its first and last are left out; ends are open."""
    wagers = table("wagers", [bet("2024-01-09 03:00:00"), bet("2024-01-09 05:30:00"), bet("2024-01-09 23:30:00", U, 9), bet(None)])
    ranges = [("02", "03"), ("03", "04"), ("04", "05"), ("05", "06"), ("06", "07"), ("23", "24")]
    raw = [(*p, a, b) for p in (("S1", "_Db", None, "T", 22), U) for a, b in ranges]
    ddl = "LinkServerName string, DBName string, MonthDB string, TableName string, Type int, a string, b string"
    windows = spark.createDataFrame(raw, ddl).selectExpr(
        "*", "CAST('2024-01-09' AS timestamp_ntz) + make_dt_interval(0, CAST(a AS int)) AS start_t",
        "CAST('2024-01-09' AS timestamp_ntz) + make_dt_interval(0, CAST(b AS int)) AS end_t")
    found = zones.windows_with_rows(windows, zones.build(wagers))
    assert got(found.select("Type", "a")) == [(22, "03"), (22, "04"), (22, "05"), (97, "23")]
    assert zones.windows_with_rows(windows, zones.build(wagers.limit(0))).isEmpty()


def test_an_empty_table(table, held):
    lookup = table("source_lookup", LOOKUP)
    same_as_scan(held, table("wagers", []), lookup)
    assert held.load(table("wagers", []), A) == 0
    same_as_scan(held, table("wagers", []), lookup)
