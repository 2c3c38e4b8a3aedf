"""Lookup-sized tables derived from ``lineitem``, ``supplier`` and ``customer``.

Suppliers stand for Types and parts for games, so the lookup grows with the order lines: one row
per Type, game and month (or per Type and game where a Type has no month databases).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import clock
from . import fixed_rows, given

CURRENT = "1998-06-15 08:00:00"
SERVER = "S3"
SERVERS = [("10", "S0", False), ("20", "S1", True), ("30", "S2", False), ("40", "S3", True), ("50", "S4", False)]


def source_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations 0-4 keep one shared database, 5-9 a legacy one, the others a database per month."""
    supplier = given(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    lines = given(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_shipdate")
    nation = F.col("s_nationkey")
    placed = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.concat(F.lit("S"), (nation % 5).cast("string")).alias("LinkServerName"),
        F.col("l_partkey").cast("int").alias("GameTypeSourceId"),
        F.when(nation < 5, "_DbShared").when(nation < 10, "_DbLegacy").otherwise("_DbMonth")
        .alias("DBName"),
        F.when(nation >= 10, clock.month_code(F.col("l_shipdate"))).alias("MonthDB"),
        F.concat(F.lit("Tbl"), nation.cast("string")).alias("TableName"),
        F.col("l_suppkey").cast("int").alias("Type"),
    )
    return placed.distinct()


def batch_range(spark: SparkSession, sf_dir: str) -> tuple[dt.datetime, dt.datetime]:
    """Batch hours (UTC) from the first to the last day with an order line."""
    span = given(spark, sf_dir, "lineitem").agg(F.min("l_shipdate"), F.max("l_shipdate")).first()
    first, last = (dt.datetime.combine(t.date(), dt.time()) for t in span)
    return first, last + dt.timedelta(hours=23)


def server_lookup(spark: SparkSession) -> DataFrame:
    return fixed_rows(spark, SERVERS, "Server string, LinkServerName string, GroupRouted boolean")


def game_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four nations stand for the excluded halls; categories repeat and some are missing."""
    supplier, nation = given(spark, sf_dir, "supplier"), given(spark, sf_dir, "nation")
    halls = {1: "SE", 2: "3Sing", 3: "TGP2", 4: "PS2"}
    hall = F.col("n_name")
    for key, name in halls.items():
        hall = F.when(F.col("n_nationkey") == key, name).otherwise(hall)
    category = F.when(F.col("s_acctbal") < 0, None).when(F.col("n_regionkey") < 2, "機率").otherwise("真人")
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").cast("int").alias("RawDataType"), hall.alias("GameHallName"),
        category.alias("Category"),
    )


def type_timezone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers in the red have no stored timezone."""
    supplier = given(spark, sf_dir, "supplier").filter(F.col("s_acctbal") >= 0)
    return supplier.select(
        F.col("s_suppkey").cast("int").alias("Type"),
        (F.col("s_nationkey") - 12).cast("int").alias("Timezone"),
    )


def raw_data_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared timezones; suppliers of region 0 declare two."""
    supplier, nation = given(spark, sf_dir, "supplier"), given(spark, sf_dir, "nation")
    zone = (F.col("s_nationkey") - 12).cast("int")
    zones = F.when(F.col("n_regionkey") == 0, F.array(zone, zone + 1)).otherwise(F.array(zone))
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").cast("int").alias("Type"), F.explode(zones).alias("Timezone")
    )


def unreadable_sources(lookup: DataFrame, supplier: DataFrame) -> DataFrame:
    """Sources of suppliers in the red."""
    red = supplier.filter(F.col("s_acctbal") < 0).select(F.col("s_suppkey").cast("int").alias("Type"))
    named = lookup.select("LinkServerName", "DBName", "MonthDB", "TableName", "Type").distinct()
    return named.join(red, "Type", "left_semi")


def alert_recipients(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = given(spark, sf_dir, "customer")
    return customer.select(
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("Email"),
        F.when(F.col("c_mktsegment") == "BUILDING", "DS").otherwise("DBA").alias("Department"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_acctbal") >= 0, "Send").otherwise("Hold").alias("HourlyMail"),
        F.when(F.col("c_nationkey") < 12, "Send").otherwise("Hold").alias("LookupMail"),
    )


def order_wagers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as wagers of customers on part sizes, by ship month."""
    line = given(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_extendedprice", "l_returnflag", "l_shipdate"
    )
    part = given(spark, sf_dir, "part").select("p_partkey", "p_size")
    customer = given(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    buyer = given(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(
        customer, F.col("o_custkey") == F.col("c_custkey")
    )
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return (
        line.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(buyer, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.trunc("l_shipdate", "month").alias("month_start"), F.col("c_name").alias("GameAccount"),
            F.col("c_nationkey").alias("SiteId"), F.col("p_size").alias("GameTypeSourceId"),
            price.alias("betamount"),
            F.when(F.col("l_returnflag") == "R", price).otherwise(-price).alias("paid"),
        )
    )
