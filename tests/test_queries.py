"""Every registered query against its DuckDB twin."""

import pathlib
import shutil
import subprocess
import sys

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_file
from hourfold.queries import QUERIES
from hourfold.testbed import GIVEN

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in GIVEN:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield con
    con.close()


def normal(rows):
    def one(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
            return None
        return str(v) if hasattr(v, "year") else v

    out = [tuple(one(v) for v in row) for row in rows]
    return sorted(out, key=lambda r: tuple((v is not None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_duckdb(spark, duck, name):
    df = entry_file.queries()[name](spark, SF_DIR)
    names = sorted(df.columns)
    cursor = duck.execute(entry_file.oracle_sql()[name])
    order = [c[0] for c in cursor.description]
    assert sorted(order) == names
    want = [tuple(row[order.index(c)] for c in names) for row in cursor.fetchall()]
    have = [tuple(r) for r in df.select(*names).collect()]
    assert normal(have) == normal(want)


def test_entry_runs(spark):
    assert entry_file.entry(spark).columns == [
        "DatePlayed", "GameAccount", "SiteId", "GameTypeSourceId", "Commissionable", "WagersCount",
        "PayOff", "WinsCount",
    ]
    assert not entry_file.entry(spark).isEmpty()


def test_month_totals_per_type(spark):
    """Totals worked out beforehand for the month of events."""
    from pyspark.sql import functions as F

    from hourfold.queries import _rollup

    totals = _rollup(spark, SF_DIR).groupBy("Type").agg(
        F.count(F.lit(1)), F.sum("Commissionable"), F.sum("WagersCount"), F.sum("PayOff"),
        F.sum("WinsCount"),
    )
    assert sorted((r[0], r[1], str(r[2]), r[3], str(r[4]), r[5]) for r in totals.collect()) == [
        (22, 1588, "81641.52", 1592, "-25529.28", 448),
        (23, 1596, "77494.38", 1598, "-21697.20", 466),
        (97, 1218, "61635.42", 1223, "-17367.80", 350),
        (98, 363, "18101.15", 363, "-3996.03", 108),
    ]


def test_every_event_of_a_known_timezone_has_a_batch(spark):
    """The first and the last hours of the events too, whatever the Type's timezone."""
    from hourfold.queries import _manifest
    from hourfold.testbed import from_events as ev

    work = _manifest(spark, SF_DIR).filter("start_t IS NOT NULL").select("Type", "start_t").distinct()
    hours = ev.wagers(spark, SF_DIR).selectExpr("Type", "date_trunc('hour', wagerstime) AS start_t")
    without = hours.filter("Type <> 39").join(work, ["Type", "start_t"], "left_anti")
    assert without.isEmpty()


def test_lag_totals_when_all_types_are_targets(spark):
    from hourfold.testbed import fixed_rows, from_events as ev

    targets = fixed_rows(spark, [(t,) for t in (22, 23, 39, 97, 98)], "Type int")
    counts = ev.lag_hours(spark, SF_DIR, targets).groupBy("Type", "Status").count()
    assert sorted(tuple(r) for r in counts.collect()) == [
        (22, "Success", 255), (22, "Wait", 465), (23, "Success", 263), (23, "Wait", 457),
        (39, "TBD", 720), (97, "Success", 264), (97, "Wait", 456), (98, "Success", 262),
        (98, "Wait", 458),
    ]


def test_inferred_timezones(spark):
    rows = entry_file.queries()["q_infer_timezone"](spark, SF_DIR).collect()
    have = {r["Type"]: (r["diff_min"], r["n"], r["variance"], r["sth_left"], r["timezone"]) for r in rows}
    assert have == {
        22: (18.747059, 680, 221.600139, 18.747059, 0),
        23: (-461.552553, 666, 213.441595, 18.447447, 8),
        39: (18.37223, 677, 212.06834, 18.37223, 0),
        97: (257.373512, 672, 190.943738, 17.373512, -4),
        98: (-461.767883, 685, 202.181423, 18.232117, 8),
    }


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_without_the_document_operators(tmp_path, pipeline):
    """The entry imports, with the library's queries, where ``hourfold/llm`` is missing, with or without its pipeline."""
    root = pathlib.Path(entry_file.__file__).resolve().parent
    shutil.copytree(root / "hourfold", tmp_path / "hourfold", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", *["corpus_pipeline.py"] * (pipeline and (root / "corpus_pipeline.py").exists())):
        shutil.copy(root / name, tmp_path)
    code = "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.LIBRARY_QUERIES) and not set(e.oracle_sql()) - set(e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert done.stdout.strip() == "True", done.stderr
