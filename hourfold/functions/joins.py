"""Joins whose strategy must not rest on the optimizer's size estimate.

Tables keyed by Type and hour come from expanding few rows over many hours. The optimizer only
sees the few rows and would broadcast the expansion, which grows with the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# A broadcast of this many narrow rows stays within some tens of megabytes.
BROADCAST_ROWS = 500_000


def hour_join(left: DataFrame, right: DataFrame, on: list[str] | Column, how: str) -> DataFrame:
    """Join of two tables keyed by Type and hour, always by shuffle."""
    return left.join(right.hint("merge"), on, how)


def fits(df: DataFrame, most: int = BROADCAST_ROWS) -> bool:
    """Whether a table has at most ``most`` rows; counting stops one row past the bound."""
    return df.limit(most + 1).count() <= most


def fact_join(
    fact: DataFrame,
    right: DataFrame,
    on: list[str] | Column,
    how: str,
    most: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join of fact-sized rows with a table keyed by Type and hour.

    The right side is counted, up to the bound: within it, it is broadcast and the fact rows stay
    where they are; beyond it, both sides are shuffled.
    """
    side = F.broadcast(right) if fits(right, most) else right.hint("merge")
    return fact.join(side, on, how)


def heavy_keys(rows: DataFrame, keys: list[str], parts: int) -> DataFrame:
    """Keys with more rows than a fair share, and into how many parts each is cut.

    A share is a quarter of the rows of one of ``parts`` tasks, so there are at most 4 * ``parts`` such keys
    whatever the data: few enough to pass the driver and to be broadcast.
    """
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_many"))
    total = counts.agg(F.sum("_many")).first()[0] or 0
    share = max(1, total // (4 * parts))
    heavy = counts.filter(F.col("_many") > share).select(
        *keys, F.ceil(F.col("_many") / share).cast("int").alias("_parts")
    )
    return rows.sparkSession.createDataFrame(heavy.collect(), heavy.schema)


def spread_join(
    rows: DataFrame, side: DataFrame, keys: list[str], by: list[str], how: str = "inner", counted: DataFrame | None = None
) -> DataFrame:
    """Join of two tables that are both shuffled, where a key may hold a large part of ``rows``.

    Heavy keys are cut by a hash of the columns ``by``, and the other side's rows of those keys repeated for
    every part; other keys stay whole. ``counted`` are rows with the same keys that are cheaper to count.
    Keys must not be null.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = F.broadcast(heavy_keys(rows if counted is None else counted, keys, parts))
    cut = F.coalesce(F.pmod(F.xxhash64(*by), F.col("_parts")).cast("int"), F.lit(0))
    placed = rows.join(heavy, keys, "left").withColumn("_part", cut).drop("_parts")
    each = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    repeated = side.join(heavy, keys, "left").withColumn("_part", F.explode(each)).drop("_parts")
    return placed.join(repeated.hint("merge"), [*keys, "_part"], how).drop("_part")
