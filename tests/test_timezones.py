import datetime as dt
import random

import pandas as pd
from conftest import got

from hourfold.operators import timezones as tz

H = [f"2024-02-01 {h:02d}:00:00" for h in range(24)]


def observations(table, rows):
    """(Batch_time, Server, Type, table_max, diff_min)"""
    return table("tz_observations", rows, only=["Batch_time", "Server", "Type", "table_max", "diff_min"])


def random_history(n=400, seed=3):
    rng, base, rows = random.Random(seed), dt.datetime(2024, 2, 1), []
    for i in range(n):
        batch = base + dt.timedelta(hours=rng.randrange(24 * 9))
        reading = rng.choice([None, base + dt.timedelta(hours=rng.randrange(4))])
        rows.append((str(batch), f"s{i}", rng.choice([1, 1, 1, 1, 2, 3]), reading and str(reading),
                     reading and rng.randrange(-500, 500)))
    return rows + [(H[1], "s", 7, H[0], 5), (H[1], "s", 8, None, None), (H[2], "s", 8, None, None)]


def expected(rows):
    """The definition in pandas: shift per Type, keep rows after the first that differ."""
    df = pd.DataFrame(rows, columns=["Batch_time", "Server", "Type", "table_max", "diff_min"])
    df["diff_min"] = df["diff_min"].astype(float)
    out, stats = [], {}
    for kind, part in df.groupby("Type"):
        part = part.sort_values(["Batch_time", "Server"]).reset_index(drop=True)
        part["before"] = part["table_max"].shift(1)
        differs = (part["table_max"] != part["before"]) | part["table_max"].isna()
        kept = part[(part.index != 0) & differs]
        out += [(kind, r.Batch_time, r.table_max if isinstance(r.table_max, str) else None,
                 r.before if isinstance(r.before, str) else None) for r in kept.itertuples()]
        stats[kind] = (kept["diff_min"].mean(), kept["diff_min"].count() if len(kept) else None,
                       kept["diff_min"].var())
    return out, stats


def test_fresh_readings_match_pandas(spark, table):
    rows = random_history()
    want, stats = expected(rows)
    obs = observations(table, rows)
    have = got(tz.updates_only(obs).select("Type", "Batch_time", "table_max", "table_max_lag"))
    assert sorted(have, key=str) == sorted(want, key=str)
    for r in tz.infer_timezone(obs).collect():
        mean, n, var = stats[r["Type"]]
        assert r["n"] == n
        for mine, other in ((r["diff_min"], mean), (r["variance"], var)):
            assert (mine is None and pd.isna(other)) or abs(mine - other) < 1e-6
        assert r["timezone"] == (None if pd.isna(mean) else int(-1 * (mean // 60)))


def test_count_is_null_without_fresh_readings_and_zero_with_empty_ones(table):
    obs = observations(table, [(H[1], "s", 7, H[0], 5), (H[1], "s", 8, None, None), (H[2], "s", 8, None, None)])
    assert got(tz.infer_timezone(obs).select("Type", "n", "timezone")) == [(7, None, None), (8, 0, None)]


def test_observed_maximum_per_source_type(spark, table):
    lookup = table("source_lookup", [
        ("S1", 1, "_DbMonth", "2401", "T", 22), ("S1", 1, "_DbMonth", "2402", "T", 22),
        ("S2", 970, "_DbShared", None, "U", 97), ("S3", 5, "_DbPlain", None, "V", 39),
    ])
    fact = table("wagers", [
        ("S1", "_DbMonth", "2401", "T", 22, "2024-01-31 23:00:30", "a", 1, 1, "1", "1"),
        ("S1", "_DbMonth", "2402", "T", 22, "2024-02-01 07:59:59", "a", 1, 2, "1", "1"),
        ("S2", "_DbShared", None, "U", 97, "2024-02-01 09:00:00", "a", 1, 970, "1", "1"),
        ("S2", "_DbShared", None, "U", 97, "2024-02-01 11:00:00", "a", 1, 973, "1", "1"),
        ("S9", "_DbPlain", None, "V", 39, "2024-02-01 11:00:00", "a", 1, 5, "1", "1"),
    ])
    seen = tz.observe_source_max(fact, lookup, H[8])
    assert got(seen) == [
        ("S1", 22, "2024-02-01 07:59:59", H[8], 1), ("S2", 97, "2024-02-01 09:00:00", H[8], -60),
        ("S3", 39, None, H[8], None),
    ]
    names = table("server_lookup", [("10", "S1", False), ("20", "S2", True), ("30", "S3", False)])
    none = table("tz_observations", [(H[1], "10", 22, None, H[1], None)])
    grown = tz.append_observations(none, seen, names, H[16])
    assert grown.count() == 4 and grown.filter("Server = '30' AND table_max IS NULL AND diff_min IS NULL").count() == 1


def inferred(spark, rows):
    return spark.createDataFrame(rows, "Type int, timezone int")


def test_choice_between_inferred_and_declared(spark, table):
    category = spark.createDataFrame(
        [(1, "機率"), (2, "真人"), (3, "機率"), (5, "機率"), (5, "x")], "Type int, Category string")
    declared = spark.createDataFrame([(1, 5), (2, 6), (3, 7), (4, 8), (5, 9)], "Type int, Timezone_DBA int")
    chosen = tz.choose_timezone(
        inferred(spark, [(1, 0), (2, 0), (3, None), (4, 0), (5, 0), (6, 0)]), declared, category)
    assert got(chosen) == [(1, 0), (2, 6), (3, 7), (4, 8), (5, 0), (5, 9), (6, None)]


def test_second_path_keeps_not_in_semantics(table):
    def second(*rows):
        return got(tz.second_path(observations(table, [(H[1], s, t, None, None) for s, t in rows]),
                                  ["a", "b"], ["c"]).select("Type"))

    assert second(("a", 1), ("c", 1), ("c", 2), ("d", 3)) == [(2,)]
    assert second(("a", 1), ("b", None), ("c", 2)) == []
    assert second(("a", 1), ("c", None), ("c", 2)) == [(2,)]
    assert second(("c", None), ("c", 2)) == [(None,), (2,)]


def test_changes_and_merge(spark, table):
    old = table("type_timezone", [
        (1, 8, H[0], "Success"), (2, None, H[0], "Success"), (3, 5, H[0], "Success"), (4, 1, H[0], "Success")])
    chosen = spark.createDataFrame([(1, 8), (2, 3), (3, None), (9, 2)], "Type int, Timezone int")
    assert got(tz.timezone_changes(chosen, old)) == [(2, 3, None), (3, None, 5)]
    same = spark.createDataFrame([(1, 8), (9, 2)], "Type int, Timezone int")
    assert tz.timezone_changes(same, old).isEmpty()
    assert got(tz.merge_timezones(same, old, H[9])) == [
        (1, 8, H[9], "Success"), (2, None, H[0], "Updating"), (3, 5, H[0], "Updating"),
        (4, 1, H[0], "Updating"), (9, 2, H[9], "Success"),
    ]


def test_declared_and_category(table):
    info = table("raw_data_info", [(1, 5), (1, 5), (1, 6), (2, 7)])
    lookup = table("source_lookup", [("S1", 1, "d", None, "t", 1)])
    assert got(tz.declared_timezones(lookup, info)) == [(1, 5), (1, 6)]
    games = table("game_lookup", [(1, "h", "x"), (1, "k", "x"), (1, "k", None)])
    assert got(tz.type_category(games)) == [(1, None), (1, "x")]
