"""Logical tables derived from the star-schema test tables, for queries, tests and bench."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# The given tables, so that reading them needs no schema inference.
GIVEN = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}
_ARROW = {"int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}


def fixed_rows(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A handful of literal rows as a local relation, whose size the optimizer knows."""
    fields = [item.split(" ") for item in ddl.split(", ")]
    columns = {
        name: pa.array([row[i] for row in rows], _ARROW[kind])
        for i, (name, kind) in enumerate(fields)
    }
    return spark.createDataFrame(pa.table(columns))


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(GIVEN[name]).parquet(f"{sf_dir}/{name}.parquet")
