"""Alert rows and their recipients. Delivery is left to whatever reads these tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F, Window

from ..constants import LAG_ALERT_HOURS
from ..functions import clock, text
from .lag import waiting_types

#: Addresses that one task numbers.
SHARD = 10_000
_HOUR = "yyyy-MM-dd HH:00:00.000"


def lag_alerts(lag: DataFrame, min_hours: int = LAG_ALERT_HOURS) -> DataFrame:
    """One alert per Type that has waited for ``min_hours`` hours or more."""
    body = text.message(
        "Type %s has not been updated since %s", F.col("Type"), F.date_format("since", _HOUR)
    )
    return waiting_types(lag, min_hours).select("Type", "n_wait", "since", body.alias("body"))


def gate_alerts(gate: DataFrame, what: str) -> DataFrame:
    """One alert per hour that a gate (current, ready) did not let through."""
    body = text.message(f"{what} not ready at %s", F.date_format("current", _HOUR))
    return gate.filter(~F.col("ready")).select("current", body.alias("body"))


def mapping_alerts(ambiguous: DataFrame, current: Column | dt.datetime) -> DataFrame:
    """One alert per server whose lookup maps a game twice."""
    now = clock.as_ntz(current)
    per_server = ambiguous.groupBy("LinkServerName").agg(F.count(F.lit(1)).alias("n_sources"))
    body = text.message("Lookup of %s is ambiguous at %s", F.col("LinkServerName"),
                        F.date_format(now, _HOUR))
    return per_server.select("LinkServerName", "n_sources", body.alias("body"))


def timezone_alerts(changes: DataFrame) -> DataFrame:
    body = text.message(
        "Timezone of Type %s changed from %s to %s; not merged",
        F.col("Type"), F.col("Timezone_old"), F.col("Timezone"),
    )
    return changes.select("Type", body.alias("body"))


def select_recipients(recipients: DataFrame, mode: str, owner: str | None = None) -> DataFrame:
    """Addresses that a kind of alert goes to, one per row."""
    hourly, unit = F.col("HourlyMail") == "Send", F.col("Department") == "DS"
    tests = {
        "hourly_all": hourly,
        "hourly_department": unit & hourly,
        "lookup": F.col("LookupMail") == "Send",
        "owner": unit & (F.col("name") == owner),
    }
    return recipients.filter(tests[mode]).select(F.lit(mode).alias("mode"), "Email")


def recipient_lines(selected: DataFrame, shard_digits: int | None = None, per_line: int = 50) -> DataFrame:
    """Addresses joined to text, ``per_line`` in each line but the last of a mode, every address kept.

    Addresses are numbered by their hash. Shards, named by the hash's first hex digits, are numbered each on
    its own; the addresses in the shards before it are added, a sum over one row per shard. There are as
    many shards as keep one at about ``SHARD`` addresses, so no task sees the whole list.
    """
    rows = selected.distinct().withColumn("hash", F.md5(F.col("Email")))
    if shard_digits is None:
        many = rows.count()
        shard_digits = next(d for d in range(32) if many <= SHARD * 16**d)
    rows = rows.withColumn("shard", F.substring("hash", 1, shard_digits))
    before = Window.partitionBy("mode").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("mode", "shard").count().withColumn("first", F.coalesce(F.sum("count").over(before), F.lit(0)))
    nth = F.row_number().over(Window.partitionBy("mode", "shard").orderBy("hash", "Email"))
    numbered = rows.withColumn("nth", nth).join(sizes.select("mode", "shard", "first"), ["mode", "shard"])
    line = F.floor((F.col("first") + F.col("nth") - 1) / per_line)
    lines = numbered.groupBy("mode", line.alias("line")).agg(F.array_sort(F.collect_list("Email")).alias("emails"))
    return lines.select("mode", F.concat_ws(", ", "emails").alias("recipients"))
