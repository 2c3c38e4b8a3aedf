"""The row before, per key, without putting a whole key into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .joins import hour_join

_BUCKET, _CARRY, _LAST = "__bucket", "__carry", "__last"


def previous_value(
    df: DataFrame, keys: list[str], order: list[str], value: str, name: str, is_first: str,
    bucket: Column,
) -> DataFrame:
    """Value of the row before, per key in ``order``, and whether there is no row before.

    A window over the key alone would sort a hot key's whole history in one task. Here the window
    runs inside (key, bucket), and one row per (key, bucket) hands the last value to the next
    bucket. ``bucket`` must not decrease along ``order``.
    """
    inside = Window.partitionBy(*keys, _BUCKET).orderBy(*order)
    in_bucket = F.lag(F.struct(F.col(value).alias("v"))).over(inside)
    rows = df.withColumn(_BUCKET, bucket).withColumn(_LAST, in_bucket)
    ranked = [F.col(c).alias(f"k{i}") for i, c in enumerate(order)]
    endings = rows.groupBy(*keys, _BUCKET).agg(
        F.max(F.struct(*ranked, F.col(value).alias("v"))).alias("ending")
    )
    buckets = Window.partitionBy(*keys).orderBy(_BUCKET)
    carry = endings.select(*keys, _BUCKET, F.lag("ending").over(buckets).alias(_CARRY))
    out = hour_join(rows, carry, [*keys, _BUCKET], "inner")
    before = F.when(F.col(_LAST).isNotNull(), F.col(f"{_LAST}.v")).otherwise(F.col(f"{_CARRY}.v"))
    first = F.col(_LAST).isNull() & F.col(_CARRY).isNull()
    return out.withColumn(name, before).withColumn(is_first, first).drop(_BUCKET, _LAST, _CARRY)
