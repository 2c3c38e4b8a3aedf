from decimal import Decimal

from conftest import got
from pyspark.sql import functions as F

from hourfold.constants import Settings
from hourfold.operators import manifest, rollup, routing
from hourfold.sources import tables

B = "2024-02-01 00:00:00"


def lookup(table, rows):
    return table("source_lookup", rows)


def zones(table, rows):
    return table("type_timezone", rows, only=["Type", "Timezone"])


def hour(spark, s):
    return F.lit(s).cast("timestamp_ntz")


def test_month_edge_reads_the_month_of_the_window_start(spark, table):
    sources = manifest.list_sources(lookup(table, [
        ("S1", 1, "_DbMonth", "2401", "T", 22), ("S1", 2, "_DbMonth", "2402", "T", 22),
    ]))
    plan = manifest.schedule(sources, zones(table, [(22, 0)]), hour(spark, B),
                             hour(spark, "2024-02-01 01:00:00"))
    rows = got(plan.select("batch_utc", "MonthDB", "start_t", "read_month", "DatePlayed"))
    assert rows == [
        ("2024-02-01 00:00:00", "2401", "2024-01-31 23:00:00", "2401", "2024-02-01 08:00:00"),
        ("2024-02-01 01:00:00", "2402", "2024-02-01 00:00:00", "2402", "2024-02-01 09:00:00"),
    ]


def test_month_edge_as_is_names_the_month_of_the_window_end(spark, table):
    settings = Settings(month_of="end")
    rows = lookup(table, [("S1", 1, "_DbMonth", "2401", "T", 22), ("S1", 1, "_DbMonth", "2402", "T", 22)])
    sources, games, tz = manifest.list_sources(rows), manifest.game_list(rows), zones(table, [(22, 0)])
    first, last = hour(spark, "2024-01-31 23:00:00"), hour(spark, "2024-02-01 01:00:00")
    as_is = manifest.spans(sources, tz, first, last, settings)
    plan = manifest.expand(as_is, settings)
    named = plan.select("batch_utc", "MonthDB", manifest.physical_name(settings).alias("n"))
    assert got(named) == [
        ("2024-01-31 23:00:00", "2401", "S1._DbMonth2401.VW_T"),
        ("2024-02-01 00:00:00", "2401", "S1._DbMonth2402.VW_T"),
        ("2024-02-01 01:00:00", "2402", "S1._DbMonth2402.VW_T"),
    ]
    pairs = plan.select("LinkServerName", "Type", "batch_utc")
    assert got(manifest.schedule_for(sources, tz, pairs, settings)) == got(plan)
    # The last hour of January lies in January's database: read by start, missed as is.
    fact = table("wagers", [
        ("S1", "_DbMonth", "2401", "T", 22, "2024-01-31 23:30:00", "a", 1, 1, "5", "1"),
        ("S1", "_DbMonth", "2401", "T", 22, "2024-01-31 22:30:00", "b", 1, 1, "5", "1"),
    ])
    for most in (0, 9):
        late = rollup.hourly_rollup(fact, as_is, games, settings, most)
        assert got(late.select("GameAccount")) == [("b",)]
        whole = rollup.hourly_rollup(fact, manifest.spans(sources, tz, first, last), games, most=most)
        assert got(whole.select("GameAccount")) == [("a",), ("b",)]


def test_type_without_timezone_keeps_a_row_without_window(spark, table):
    sources = manifest.list_sources(lookup(table, [
        ("S1", 1, "_DbPlain", None, "T", 39), ("S1", 2, "_DbMonth", "2402", "U", 40),
        ("S1", 2, "_DbMonth", "2401", "U", 40),
    ]))
    plan = manifest.schedule(sources, zones(table, [(22, 0)]), hour(spark, B), hour(spark, B))
    assert got(plan.select("Type", "MonthDB", "start_t")) == [(39, None, None), (40, "2402", None)]


def test_two_timezones_give_two_windows(spark, table):
    sources = manifest.list_sources(lookup(table, [("S1", 1, "_DbPlain", None, "T", 22)]))
    plan = manifest.schedule(sources, zones(table, [(22, 0), (22, 8), (22, 8)]), hour(spark, B), hour(spark, B))
    assert got(plan.select("Timezone")) == [(0,), (8,)]


def test_windows_of_two_timezones_do_not_mix(spark, table):
    """Both windows belong to one batch; each is summed and judged by itself."""
    rows = lookup(table, [("S1", 1, "_DbPlain", None, "T", 22)])
    spans = manifest.spans(
        manifest.list_sources(rows), zones(table, [(22, 0), (22, 8)]), hour(spark, B), hour(spark, B))
    fact = table("wagers", [
        ("S1", "_DbPlain", None, "T", 22, "2024-01-31 23:30:00", "a", 1, 1, "5", "0"),
        ("S1", "_DbPlain", None, "T", 22, "2024-02-01 07:30:00", "a", 1, 1, "7", "0")])
    for most in (0, 9):
        out = rollup.hourly_rollup(fact, spans, manifest.game_list(rows), most=most)
        assert [r[0] for r in got(out.select("Commissionable"))] == [Decimal("5.0000"), Decimal("7.0000")]
        assert out.select("DatePlayed").distinct().count() == 1


def test_scattered_hours_equal_the_range(spark, table):
    sources = manifest.list_sources(lookup(table, [
        ("S1", 1, "_DbMonth", "2401", "T", 22), ("S1", 1, "_DbMonth", "2402", "T", 22),
        ("S2", 3, "_DbPlain", None, "U", 23),
    ]))
    tz = zones(table, [(22, -4)])
    first, last = hour(spark, "2024-01-31 20:00:00"), hour(spark, "2024-02-01 06:00:00")
    whole = manifest.schedule(sources, tz, first, last)
    pairs = whole.select("LinkServerName", "Type", "batch_utc")
    again = manifest.schedule_for(sources, tz, pairs.unionByName(pairs))
    assert got(again) == got(whole) and whole.count() == 22


def test_blank_month_means_none(spark):
    from hourfold.schemas import conform

    raw = spark.createDataFrame(
        [("S1", "1", "_Db", " ", "T", "22")],
        "`LinkServerName ` string, GameTypeSourceId string, DBName string, MonthDB string, "
        "TableName string, Type string",
    )
    row = conform(raw, "source_lookup").first()
    assert row["MonthDB"] is None and row["Type"] == 22


WAGERS = [
    # One account in two spellings, NULL payoff, NULL and zero bets.
    ("S1", "_DbPlain", None, "T", 22, "2024-01-31 23:00:00", "User1", 1, 220, "5", None),
    ("S1", "_DbPlain", None, "T", 22, "2024-01-31 23:59:59.999", "USER1", 1, 220, None, "2.5"),
    ("S1", "_DbPlain", None, "T", 22, "2024-01-31 23:10:00", "user2", 1, 220, None, "9"),
    ("S1", "_DbPlain", None, "T", 22, "2024-01-31 23:10:00", "user3", 1, 220, "0", "9"),
    ("S1", "_DbPlain", None, "T", 22, "2024-02-01 00:00:00", "user1", 1, 220, "7", "0"),
    # Another table of the same Type: negative bets must not cancel across sources.
    ("S1", "_DbPlain", None, "T2", 22, "2024-01-31 23:10:00", "user1", 1, 220, "-50", "0"),
    ("S1", "_DbPlain", None, "T2", 22, "2024-01-31 23:10:00", "user4", 1, 999, "1", "1"),
    # A shared database: only listed games count.
    ("S2", "_DbShared", None, "U", 97, "2024-01-31 23:10:00", "user1", 7, 970, "3", "-3"),
    ("S2", "_DbShared", None, "U", 97, "2024-01-31 23:10:00", "user1", 7, 973, "4", "-4"),
    ("S2", "_DbShared", None, "U", 97, "2024-01-31 23:10:00", None, 7, None, "4", "-4"),
]
LOOKUP = [
    ("S1", 220, "_DbPlain", None, "T", 22), ("S1", 220, "_DbPlain", None, "T2", 22),
    ("S2", 970, "_DbShared", None, "U", 97),
]


def month(spark, table, settings=Settings()):
    rows = lookup(table, LOOKUP)
    spans = manifest.spans(
        manifest.list_sources(rows), zones(table, [(22, 0), (97, 0)]), hour(spark, B), hour(spark, B)
    )
    return table("wagers", WAGERS), spans, manifest.game_list(rows)


def test_rollup_sums_counts_and_drops(spark, table):
    fact, spans, games = month(spark, table)
    rows = got(rollup.report_rows(rollup.hourly_rollup(fact, spans, games)))
    d = "2024-02-01 08:00:00"
    assert rows == [
        (d, "user1", 1, 220, Decimal("5.0000"), 2, Decimal("2.5000"), 1),
        (d, "user1", 7, 970, Decimal("3.0000"), 1, Decimal("-3.0000"), 0),
        (d, "user4", 1, 999, Decimal("1.0000"), 1, Decimal("1.0000"), 1),
    ]


def test_both_rollup_forms_agree(spark, table):
    fact, spans, games = month(spark, table)
    by_span = rollup.hourly_rollup(fact, spans, games)
    by_window = rollup.rollup_of_windows(fact, manifest.expand(spans), games)
    assert got(by_span) == got(by_window)


def test_large_sources_and_lists_give_the_same_rows(spark, table):
    """Bounds of no and of two rows stand for tables too large to broadcast."""
    fact, spans, games = month(spark, table)
    want = got(rollup.hourly_rollup(fact, spans, games))
    for most in (0, 2):
        assert got(rollup.hourly_rollup(fact, spans, games, most=most)) == want
        assert got(rollup.rollup_of_windows(fact, manifest.expand(spans), games, most=most)) == want


def test_trailing_blanks_are_an_option(spark, table):
    fact = table("wagers", [
        ("S1", "_DbPlain", None, "T", 22, "2024-01-31 23:00:00", a, 1, 220, "5", "0")
        for a in ("a", "A ")
    ])
    _, spans, games = month(spark, table)
    assert rollup.hourly_rollup(fact, spans, games).count() == 2
    assert rollup.hourly_rollup(fact, spans, games, Settings(trim_accounts=True)).count() == 1


def test_routing_to_destinations(spark, table):
    rows = spark.createDataFrame(
        [("S1", 6, "a"), ("S2", 6, "b"), ("S2", 7, "c"), ("S2", 5, "d"), ("S2", 9, "e"), ("S2", 4, "f")],
        "LinkServerName string, SiteId int, tag string",
    )
    sites = table("site_group", [(6, "Noah1"), (7, "Noah2"), (7, "Noah2"), (5, None), (4, "Noah1"), (4, "Noah2")])
    servers = table("server_lookup", [("10", "S1", False), ("20", "S2", True)])
    routed = routing.route(rows, sites, servers).select("tag", "Server", "Destination")
    assert got(routed) == [
        ("a", "10", "DS_Server"), ("b", "20", "DS_Server"), ("b", "20", "Noah1_Server"),
        ("c", "20", "DS_Server"), ("c", "20", "Noah2_Server"), ("d", "20", "DS_Server"),
        ("e", "20", "DS_Server"), ("f", "20", "DS_Server"), ("f", "20", "Noah1_Server"),
        ("f", "20", "Noah2_Server"),
    ]


def test_site_lists(spark, table):
    sites = table("site_group", [(6, "Noah1"), (7, "Noah2"), (5, None)])
    assert got(tables.site_members(sites, "Noah1")) == [(6,)]
    assert got(tables.site_filter(sites, "ungrouped")) == [(5,)]
    assert got(tables.site_filter(sites, "first_group")) == [(6,)]
    assert got(tables.site_filter(sites, "both_groups")) == [(6,), (7,)]


def test_duplicate_mappings(spark, table):
    rows = lookup(table, [
        ("S1", 1, "_DbLegacy", None, "T", 22), ("S1", 2, "_DbLegacy", None, "T", 22),
        ("S1", 2, "_DbPlain", None, "T", 22), ("S1", None, "_DbPlain", None, "T", 22),
    ])
    kept = manifest.resolve_duplicate_mappings(rows).select("GameTypeSourceId", "DBName")
    assert got(kept) == [(1, "_DbLegacy"), (2, "_DbPlain")]


def test_excluded_games_and_null_ids(spark, table):
    rows = lookup(table, [
        ("S1", 35, "_DbPlain", None, "T", 22), ("S1", None, "_DbPlain", None, "T", 22),
        ("S1", 1, "_DbPlain", None, "T", 35),
    ])
    excluded = tables.fallback_excluded_types(spark)
    assert got(excluded) == [(139,), (35,), (67,), (68,)]
    assert got(tables.drop_excluded(rows, excluded, Settings()).select("GameTypeSourceId", "Type")) == [
        (None, 22), (1, 35)]
    by_type = tables.drop_excluded(rows, excluded, Settings(exclude_key="Type"))
    assert got(by_type.select("GameTypeSourceId")) == [(None,), (35,)]
    halls = table("game_lookup", [(1, "SE", "x"), (1, "SE", "y"), (2, "Other", "x"), (3, "PS2", None)])
    assert got(tables.excluded_types(halls)) == [(1,), (3,)]


def test_rollup_is_additive_over_hours(spark, table):
    """Hour by hour and all at once give the same rows."""
    fact, _, games = month(spark, table)
    sources = manifest.list_sources(lookup(table, LOOKUP))
    tz = zones(table, [(22, 0), (97, -4)])
    first, last = "2024-01-31 22:00:00", "2024-02-01 08:00:00"
    whole = rollup.hourly_rollup(fact, manifest.spans(sources, tz, hour(spark, first), hour(spark, last)), games)
    single = []
    for h in ("2024-02-01 00:00:00", "2024-02-01 01:00:00", "2024-02-01 04:00:00"):
        single += got(rollup.hourly_rollup(fact, manifest.spans(sources, tz, hour(spark, h), hour(spark, h)), games))
    assert sorted(single, key=str) == sorted(got(whole), key=str) and len(single) == 4


def test_heavy_sources_are_spread(spark):
    """40 % of the rows in one Type: no task of the join reads twice the median, and no row is lost."""
    from hourfold.functions.joins import heavy_keys, spread_join

    rows = spark.range(60_000).selectExpr(
        "CAST(IF(id % 5 < 2, 0, 1 + id % 97) AS int) AS Type", "id", "concat('u', id % 7001) AS account")
    side = spark.range(120).selectExpr("CAST(id AS int) AS Type", "id * 10 AS zone")
    heavy = {r["Type"]: r["_parts"] for r in heavy_keys(rows, ["Type"], 8).collect()}
    assert set(heavy) == {0} and heavy[0] >= 8
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        joined = spread_join(rows, side, ["Type"], ["id", "account"])
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        assert sum(sizes) == 60_000 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
        plain = sorted(r["count"] for r in rows.join(side.hint("merge"), "Type").groupBy(F.spark_partition_id()).count().collect())
        assert plain[-1] > 4 * plain[len(plain) // 2]
        assert joined.filter("zone <> Type * 10").isEmpty() and joined.select("id").distinct().count() == 60_000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
