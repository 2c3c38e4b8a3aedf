import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import got
from hourfold.plans import hourly, store
from hourfold.plans.isolation import failing
from hourfold.sinks import files
from test_sinks_plans import T, UTC, held_rows, inputs, ledger_rows  # noqa: F401


def test_bad_units_are_found_in_few_attempts():
    pick = random.Random(2)
    for many, bad in ((1, 0), (1, 1), (40, 1), (64, 3), (200, 2), (7, 7)):
        units, attempts, done = list(range(many)), [], []
        broken = set(pick.sample(units, bad))

        def attempt(part):
            attempts.append(part)
            if broken & set(part):
                raise PySparkException("bad data")
            done.extend(part)

        assert sorted(failing(units, attempt)) == sorted(broken)
        assert sorted(done) == sorted(set(units) - broken)
        assert len(attempts) <= 1 + 2 * bad * max(1, many.bit_length())
        attempts.clear()
        done.clear()
        # Those that failed before don't fail the others again.
        assert sorted(failing(units, attempt, broken)) == sorted(broken)
        assert len(attempts) <= bad + 1 and sorted(done) == sorted(set(units) - broken)


def test_failures_of_the_cluster_are_not_blamed_on_the_data():
    calls = []

    def flaky(part):
        calls.append(part)
        if len(calls) == 1:
            raise PySparkException("Job aborted: ExecutorLostFailure (executor 1 exited)")

    assert failing([1, 2, 3], flaky) == [] and calls == [[1, 2, 3]] * 2

    def dead(part):
        raise PySparkException("FetchFailed")

    with pytest.raises(PySparkException):
        failing([1, 2], dead)


def broken_fact(spark, state, tmp_path, one):
    fact = str(tmp_path / "fact")
    state.wagers.write.partitionBy("Type").parquet(fact)
    for part in (tmp_path / "fact" / f"Type={one}").glob("*.parquet"):
        part.write_bytes(b"not parquet")
    return spark.read.schema(state.wagers.schema).parquet(fact).select(*state.wagers.columns)


def test_a_type_that_fails_is_kept_apart_until_it_is_read_again(spark, inputs, tmp_path):
    held, base = store.Store(spark, str(tmp_path / "state")), inputs()
    for name in ("type_timezone", "lag_status", "batch_status"):
        held.put(name, getattr(base, name))
    held.put("lag_run_status", base.lag_runs)
    broken = inputs(wagers=broken_fact(spark, base, tmp_path, 97))
    for wagers in (broken, broken):
        store.run_hour(held, wagers, UTC)
        assert got(held.read("isolated_types").select("Type", "healthy")) == [(97, False)]
        assert [r for r in ledger_rows(held.read("batch_status")) if r[1] != 39] == [
            ("10", 22, "DS_Server", "Success"), *[("20", 97, d, "Fail") for d in ("DS_Server", "Noah1_Server", "Noah2_Server")]]
        assert held_rows(spark, held.rollup) == [("DS_Server", 22, T, "ann")]
    store.run_hour(held, base, UTC)
    assert got(held.read("isolated_types").select("Type", "healthy")) == [(97, True)]
    assert {(r[1], r[3]) for r in ledger_rows(held.read("batch_status")) if r[2] == "DS_Server"} == {
        (22, "Success"), (97, "Success"), (39, "Fail")}
    # What is stored of other hours, and the healed timezone, stays.
    assert held.read("batch_status").filter(F.col("UpDateTime") < F.lit(T).cast("timestamp_ntz")).count() == 1
    assert got(held.read("type_timezone").select("Type", "Timezone")) == [(22, 0), (97, 8)]
    before = got(held.read("batch_status")), held_rows(spark, held.rollup)
    held.maintain(keep_seconds=0)
    assert before == (got(held.read("batch_status")), held_rows(spark, held.rollup))


def test_a_lookup_that_cannot_be_read_fails_the_hour(spark, inputs, tmp_path):
    base = inputs()
    base.lookup.write.parquet(str(tmp_path / "lookup"))
    for part in (tmp_path / "lookup").glob("*.parquet"):
        part.write_bytes(b"not parquet")
    lookup = spark.read.schema(base.lookup.schema).parquet(str(tmp_path / "lookup"))
    result = hourly.run_hour(inputs(lookup=lookup), UTC, str(tmp_path / "r"))
    assert result.blocked == "inputs" and ledger_rows(result.batch_status) == [("10", 22, "DS_Server", "Fail")]


def test_a_late_hour_is_redone_on_stored_state(spark, table, inputs, tmp_path):
    held = store.Store(spark, str(tmp_path / "state"))
    late = [(T, "S2", 97, None, "Wait", None, "2024-02-01 09:50:00"), (T, "S1", 22, None, "Success", None, None)]
    base = inputs()
    for name, rows in (("type_timezone", base.type_timezone), ("batch_status", base.batch_status),
                       ("lag_run_status", base.lag_runs), ("lag_status", table("lag_status", late))):
        held.put(name, rows)
    store.run_hour(held, base, UTC)
    assert held_rows(spark, held.rollup) == [("DS_Server", 22, T, "ann")]
    store.run_redo(held, base, UTC)  # nothing has cleared yet
    assert {r[3] for r in ledger_rows(held.read("batch_status")) if r[1] == 97} == {"Fail"}
    held.put("tz_observations", table("tz_observations", [("2024-02-01 03:00:00", "20", 97, "2024-02-01 10:00:00", None, None)]))
    store.recheck(held)
    assert got(held.read("lag_status").select("Type", "Status")) == [(22, "Success"), (97, "ReRun")]
    store.run_redo(held, base, UTC)
    assert held_rows(spark, held.rollup) == [
        ("DS_Server", 22, T, "ann"), ("DS_Server", 97, T, "bob"), ("Noah1_Server", 97, T, "bob")]
    assert got(held.read("lag_status").select("Type", "Status")) == [(22, "Success"), (97, "Success")]
    assert [r[3] for r in ledger_rows(held.read("batch_status")) if r[1] == 97] == ["Success", "Success", "Empty"]
    assert files.can_write(spark, held.rollup) and dt.datetime(2024, 2, 1, 2) == UTC
