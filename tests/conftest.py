import pathlib
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("hourfold-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """Literal rows as a logical table; timestamps are given as text."""
    from hourfold.schemas import fields

    def make(name, rows, only=None):
        kinds = [(c, k) for c, k in fields(name) if only is None or c in only]
        raw = spark.createDataFrame(rows, ", ".join(
            f"{c} {'string' if k.startswith(('timestamp', 'decimal')) else k}" for c, k in kinds
        ))
        return raw.selectExpr(*[f"CAST({c} AS {k}) AS {c}" for c, k in kinds])

    return make


def got(df):
    """Rows as a sorted list of tuples, timestamps as text."""
    out = [tuple(str(v) if hasattr(v, "year") else v for v in row) for row in df.collect()]
    return sorted(out, key=lambda r: tuple((v is not None, str(v)) for v in r))
