"""Which destinations a rollup row goes to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import GROUP_DESTINATIONS, MAIN_DESTINATION
from ..functions.joins import fact_join


def _array_of(main: Column, groups: dict[str, Column]) -> Column:
    narrow = [F.when(test, F.lit(GROUP_DESTINATIONS[g])) for g, test in groups.items()]
    return F.array_compact(F.array(main, *narrow))


def with_server(df: DataFrame, server_lookup: DataFrame) -> DataFrame:
    """Add the ledger's Server name and whether the server feeds the group destinations."""
    return df.join(_servers(server_lookup), "LinkServerName")


def _servers(server_lookup: DataFrame) -> DataFrame:
    return server_lookup.select("LinkServerName", "Server", "GroupRouted").distinct()


def expected_destinations(manifest: DataFrame, server_lookup: DataFrame) -> DataFrame:
    """Manifest rows times the one or three destinations of their server."""
    main, groups = F.lit(MAIN_DESTINATION), [F.lit(name) for name in GROUP_DESTINATIONS.values()]
    # Two constant arrays, as their rows are many.
    all_of = F.when(F.col("GroupRouted"), F.array(main, *groups)).otherwise(F.array(main))
    return with_server(manifest, server_lookup).withColumn("Destination", F.explode(all_of))


def route(rollup: DataFrame, site_group: DataFrame, server_lookup: DataFrame) -> DataFrame:
    """Every row to the main destination, and to a group destination where its site is a member.

    One pass over the rollup: a row's destinations are worked out side by side and exploded.
    """
    kind = F.col("SiteType")
    groups = site_group.groupBy(F.col("Siteid").alias("SiteId")).agg(
        *[F.coalesce(F.bool_or(kind == g), F.lit(False)).alias(f"in_{g}") for g in GROUP_DESTINATIONS]
    )
    marked = fact_join(rollup, _servers(server_lookup), "LinkServerName", "inner")
    marked = fact_join(marked, groups, "SiteId", "left")
    tests = {g: F.col("GroupRouted") & F.col(f"in_{g}") for g in GROUP_DESTINATIONS}
    return marked.withColumn(
        "Destination", F.explode(_array_of(F.lit(MAIN_DESTINATION), tests))
    ).select(*rollup.columns, "Server", "Destination")


def destination_counts(routed: DataFrame) -> DataFrame:
    """Rows and bets per destination, hour and Type."""
    return routed.groupBy("Destination", "DatePlayed", "Type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("Commissionable").alias("Commissionable")
    )
