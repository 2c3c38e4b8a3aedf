"""Parquet sinks that can be run again: rollup and state tables replaced by key, snapshots, scratch tables."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..constants import LEDGER_KEYS
from ..schemas import TABLES
from . import keyed
from .keyed import Keyed, read_existing

KEYS = ["Destination", "LinkServerName", "Type", "DatePlayed"]
STORED = [
    "DatePlayed", "GameAccount", "SiteId", "GameTypeSourceId", "Commissionable", "WagersCount",
    "PayOff", "WinsCount", "LinkServerName", "Type", "Destination",
]
_made: list[str] = []
LAYOUTS = {"day": ["Destination", "date"], "hour": ["Destination", "date", "hour"]}
# Keys of the state tables, and the column that dates their rows.
STATE_KEYS = {
    "batch_status": (tuple(LEDGER_KEYS), "UpDateTime"),
    "lag_status": (("DatePlayed", "LinkServerName", "Type"), "DatePlayed"),
    "lag_run_status": (("DatePlayed",), "DatePlayed"),
    "tz_observations": (("Batch_time", "Server", "Type"), "Batch_time"),
    "type_timezone": (("Type",), None),
    "isolated_types": (("LinkServerName", "Type"), None),
}


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder that all executors see.

    It lies in the folder the cluster names for checkpoints. Where none is named it lies next to the tables
    of the warehouse; on a cluster that must be on a shared file system.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
        alone = spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster")
        where = spark._jvm.org.apache.hadoop.fs.Path(base)
        if not alone and where.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme() == "file":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors see")
    _made.append(f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def clean(spark: SparkSession) -> None:
    """Delete the folders that this process took with ``shared_dir``; what reads them is used up."""
    jvm = spark._jvm
    while _made:
        path = jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows read back from a new table in the shared folder, without their lineage."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _rows_schema() -> str:
    kinds = {
        "DatePlayed": "timestamp_ntz", "GameAccount": "string", "SiteId": "int", "GameTypeSourceId": "int",
        "Commissionable": "decimal(38,4)", "WagersCount": "bigint", "PayOff": "decimal(38,4)",
        "WinsCount": "bigint", "LinkServerName": "string", "Type": "int", "Destination": "string",
    }
    return ", ".join(f"{c} {kinds[c]}" for c in STORED)


def damage(spark: SparkSession, path: str) -> None:
    """Overwrites one file of a scratch table, to see what a reader makes of it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    name = max(s.getPath().getName() for s in fs.listStatus(where) if s.getPath().getName().endswith(".parquet"))
    out = fs.create(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"), True)
    out.writeUTF("not a table")
    out.close()


def can_write(spark: SparkSession, path: str) -> bool:
    """Whether a table may have its folders at ``path``."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/pending")
    try:
        return where.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(where)
    except Py4JJavaError:
        return False


def rollup_table(path: str, layout: str = "day") -> Keyed:
    """The rollup at ``path``. An hourly run has a version of its own, so folders by day do; "hour" cuts them finer."""
    return Keyed(path, tuple(KEYS), _rows_schema(), "DatePlayed", tuple(LAYOUTS[layout]))


def write_rollup(
    routed: DataFrame, due: DataFrame, path: str, layout: str = "day", version: str | None = None
) -> None:
    """Replace the rows of every ``due`` key (KEYS) by the routed ones, whatever was there before."""
    keyed.write(rollup_table(path, layout), routed, due, version)


def read_rollup(
    spark: SparkSession, path: str, first: Column | None = None, last: Column | None = None
) -> DataFrame:
    """Stored rollup rows, of the output hours [first, last] where given; only their folders are read."""
    return keyed.read(spark, rollup_table(path), first, last)


def state_table(root: str, name: str) -> Keyed:
    """A stored state table; its rows are replaced by key."""
    keys, dated = STATE_KEYS[name]
    return Keyed(f"{root.rstrip('/')}/{name}", keys, TABLES[name], dated)


def write_snapshot(df: DataFrame, root: str, version: int) -> None:
    """A state table as a new version next to the old ones; readers see it once it is announced.

    ``version`` grows from run to run (the batch hour as a number will do). The announcement is a
    separate one-row table, so a half-written version is never read, and a repeated run replaces
    its own version.
    """
    df.write.mode("overwrite").parquet(f"{root}/version={version}")
    announced = df.sparkSession.range(1).select(F.lit(version).cast("bigint").alias("version"))
    announced.write.mode("append").parquet(f"{root}_announced")


def read_snapshot(spark: SparkSession, root: str) -> DataFrame | None:
    """The newest announced version."""
    announced = read_existing(spark, f"{root}_announced")
    if announced is None:
        return None
    newest = announced.agg(F.max("version")).first()[0]
    return spark.read.parquet(f"{root}/version={newest}")
