import random

import pytest
from pyspark.sql import functions as F

from conftest import got
from hourfold.sinks import keyed
from hourfold.sinks.keyed import Keyed

DDL = "k int, d timestamp_ntz, v string"


@pytest.fixture
def held(tmp_path):
    return Keyed(str(tmp_path / "t"), ("k", "d"), DDL, "d")


def rows(spark, pairs):
    raw = spark.createDataFrame([(k, f"2024-01-{1 + k % 28:02d} 00:00:00", v) for k, v in pairs], "k int, d string, v string")
    return raw.withColumn("d", F.col("d").cast("timestamp_ntz"))


def put(spark, table, pairs, empty=(), **kinds):
    new = rows(spark, [p for p in pairs if p[0] not in empty])
    return keyed.write(table, new, rows(spark, pairs), **kinds)


def values(spark, table, **kinds):
    return {r["k"]: r["v"] for r in keyed.read(spark, table, **kinds).collect()}


def folders(table, kind="rows"):
    import pathlib

    where = pathlib.Path(table.path) / kind
    return sorted(p.name for p in where.iterdir() if p.name[0] not in "._") if where.exists() else []


def test_levels_are_merged_and_rows_stay(spark, held):
    """Random writes with merges in between hold what the last write of each key said."""
    pick, want = random.Random(3), {}
    for step in range(14):
        pairs = [(k, f"{step}") for k in pick.sample(range(12), 3)]
        empty = {pairs[0][0]} if step % 3 == 2 else set()
        put(spark, held, pairs, empty)
        want |= dict(pairs)
        want = {k: v for k, v in want.items() if k not in empty}
        keyed.compact(spark, held, fanout=3)
        assert len(keyed.live(spark, held)) <= 2 * 3
    assert values(spark, held) == want
    assert max(a.level for a in keyed.live(spark, held)) == 2
    at = F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")
    assert values(spark, held, first=at, last=at) == {k: v for k, v in want.items() if k == 4}
    keyed.expire(spark, held, keep_seconds=0)
    assert values(spark, held) == want
    assert len(folders(held)) == len(keyed.live(spark, held)) == len(folders(held, "announced"))


@pytest.mark.parametrize("step", ["rows", "keys", "announced", "delete"])
def test_a_crash_between_steps_changes_nothing(spark, held, monkeypatch, step):
    for i in range(4):
        put(spark, held, [(i, "old"), (9, str(i))])
    before = values(spark, held)

    def dies(*_, **__):
        raise RuntimeError("died")

    with monkeypatch.context() as patch:
        if step == "rows":
            patch.setattr(keyed, "_put", dies)
        elif step == "keys":
            patch.setattr(keyed, "_bounds", dies)
        elif step == "announced":
            patch.setattr(keyed, "_publish", dies)
        else:
            keyed.compact(spark, held, fanout=2)
            real, calls = keyed._delete, []

            def delete(session, path):
                calls.append(path)
                if len(calls) > 3:
                    dies()
                real(session, path)

            patch.setattr(keyed, "_delete", delete)
        with pytest.raises(RuntimeError, match="died"):
            keyed.expire(spark, held, keep_seconds=0) if step == "delete" else keyed.compact(spark, held, fanout=2)
    assert values(spark, held) == before
    keyed.compact(spark, held, fanout=2)
    keyed.expire(spark, held, keep_seconds=0)
    assert values(spark, held) == before and len(folders(held)) <= 2


def test_a_late_announcement_keeps_its_rank(spark, held):
    """A version that was written before a merge and announced after it wins over older rows only."""
    put(spark, held, [(1, "old"), (2, "old")], version="00000000000000000001-a")
    put(spark, held, [(2, "new")], version="00000000000000000003-c")
    keyed.compact(spark, held, fanout=2)
    put(spark, held, [(1, "late"), (2, "late")], version="00000000000000000002-b")
    assert values(spark, held) == {1: "late", 2: "new"}
    keyed.compact(spark, held, fanout=1)
    put(spark, held, [(3, "x")])
    keyed.compact(spark, held, fanout=1)
    assert values(spark, held) == {1: "late", 2: "new", 3: "x"}


def test_readers_keep_what_they_have_pinned(spark, held):
    put(spark, held, [(1, "a")])
    put(spark, held, [(2, "b")])
    with keyed.pinned(spark, held) as versions:
        reader = keyed.read(spark, held, versions=versions)
        keyed.compact(spark, held, fanout=2)
        assert keyed.expire(spark, held, keep_seconds=0) == []
        assert got(reader.select("k", "v")) == [(1, "a"), (2, "b")]
    assert len(keyed.expire(spark, held, keep_seconds=0)) == 2
    assert keyed.expire(spark, held, keep_seconds=0) == [] and values(spark, held) == {1: "a", 2: "b"}
    # What was written but not announced is kept for a while.
    rows(spark, [(5, "x")]).write.parquet(f"{held.path}/rows/version=lost")
    assert keyed.expire(spark, held) == []
    assert keyed.expire(spark, held, keep_seconds=0) == ["lost"]


def adds(spark, text, keys):
    """A change that appends ``text`` to the stored values of ``keys``."""
    def change(old):
        known = {r["k"]: r["v"] for r in old.collect()}
        new = rows(spark, [(k, known.get(k, "") + text) for k in keys])
        return new, new

    return change


def test_two_writers(spark, held):
    """Each writer works while the other one commits: other keys pass, the same key is worked out again."""
    assert keyed.update(spark, held, adds(spark, "a", [1, 2])) == 1

    def meanwhile(own, other):
        calls = []

        def change(old):
            out = own(old)
            if not calls:
                calls.append(1)
                keyed.update(spark, held, other)
            return out

        return change

    assert keyed.update(spark, held, meanwhile(adds(spark, "b", [1]), adds(spark, "c", [3]))) == 1
    assert values(spark, held) == {1: "ab", 2: "a", 3: "c"}
    assert keyed.update(spark, held, meanwhile(adds(spark, "d", [1]), adds(spark, "e", [1, 2]))) == 2
    assert values(spark, held) == {1: "abed", 2: "ae", 3: "c"}
    keyed.compact(spark, held, fanout=2)
    assert keyed.update(spark, held, adds(spark, "f", [1])) == 1
    assert values(spark, held) == {1: "abedf", 2: "ae", 3: "c"}


def test_a_busy_key_ends_in_an_error(spark, held, monkeypatch):
    monkeypatch.setattr(keyed, "ATTEMPTS", 2)

    def change(old):
        put(spark, held, [(1, "other")])
        keyed.update(spark, held, adds(spark, "x", [1])) if not nested else None
        return rows(spark, [(1, "mine")]), rows(spark, [(1, "mine")])

    nested = []
    with pytest.raises(RuntimeError, match="2 times"):
        keyed.update(spark, held, change)


def test_many_versions_in_one_write(spark, held):
    new = rows(spark, [(k, str(k)) for k in range(30)])
    keyed.write_versions(held, new, new, F.col("k").cast("string"))
    assert len(keyed.live(spark, held)) == 30 and len(values(spark, held)) == 30
    keyed.compact(spark, held)
    keyed.expire(spark, held, keep_seconds=0)
    assert len(folders(held)) == 1 and values(spark, held) == {k: str(k) for k in range(30)}
    assert keyed.read(spark, Keyed(held.path + "/none", ("k", "d"), DDL)).isEmpty()
