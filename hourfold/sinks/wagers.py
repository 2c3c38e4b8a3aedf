"""Stored wagers with zone maps that follow them.

A load puts wagers into day folders of a version of its own; running it again replaces them. Zones are kept
by load and day next to the version order that they were made from, so they are made anew only for loads
and days that changed, whichever writer did it. A crash between the two leaves zones that don't match: readers
never use those, but look at the wagers of these days instead, and the next ``refresh`` mends them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import clock
from ..operators import zones
from ..schemas import TABLES, columns, conform
from . import files, keyed
from .keyed import Keyed

_KEYS = ("Loaded", "Day")
_MADE_FROM = [*_KEYS, "made_from"]
_ZONE = (
    "LinkServerName string, DBName string, MonthDB string, TableName string, Type int, GameTypeSourceId int, "
    "first_t timestamp_ntz, last_t timestamp_ntz, n bigint, made_from string"
)
_KEY_DDL = "Loaded timestamp_ntz, Day timestamp_ntz"


class WagerTable:
    """Wagers and their zones below one folder."""

    def __init__(self, spark: SparkSession, root: str):
        root = root.rstrip("/")
        self.spark = spark
        self.facts = Keyed(f"{root}/facts", _KEYS, f"{TABLES['wagers']}, {_KEY_DDL}", "Day", ("date",))
        self.zones = Keyed(f"{root}/zones", _KEYS, f"{_ZONE}, {_KEY_DDL}", "Day")

    def load(self, rows: DataFrame, at: dt.datetime | str) -> int:
        """Wagers that arrived with the load of an hour, in place of what an earlier try of it left.

        ``rows`` are read twice, for their days and for themselves. Gives the number of days indexed.
        """
        own = F.col("Loaded") == clock.as_ntz(at)
        placed = conform(rows, "wagers").withColumns({"Loaded": clock.as_ntz(at), "Day": zones.day_of(F.col("wagerstime"))})
        before = self._held().filter(own)
        keyed.put(self.spark, self.facts, placed, placed.select(*_KEYS).unionByName(before.select(*_KEYS)))
        return self.refresh()

    def refresh(self) -> int:
        """Makes the zones of loads and days that have none, or were written since. Gives their number."""
        stale = files.stored(self._stale(self._held()), "stale")
        many = stale.count()
        if many:
            keyed.put(self.spark, self.zones, files.stored(self._made(stale), "zones"))
        return many

    def current(self) -> DataFrame:
        """Zones of what is stored; days that aren't indexed are read."""
        held = files.stored(self._held(), "held")
        made = keyed.read(self.spark, self.zones)
        rows = made.join(held.select(*_MADE_FROM), _MADE_FROM, "left_semi")
        stale = self._stale(held)
        if not stale.isEmpty():
            rows = rows.unionByName(self._made(stale))
        return rows.filter("n > 0").drop("made_from")

    def read(self, first: Column | None = None, last: Column | None = None) -> DataFrame:
        """Wagers of the times [first, last] where given; only their days are opened."""
        days = [None if t is None else zones.day_of(t) for t in (first, last)]
        rows = keyed.read(self.spark, self.facts, *days)
        for bound, within in ((first, Column.__ge__), (last, Column.__le__)):
            if bound is not None:
                rows = rows.filter(within(F.col("wagerstime"), bound))
        return rows.select(*columns("wagers"))

    def maintain(self, keep_seconds: float = 86_400) -> None:
        for table in (self.facts, self.zones):
            keyed.compact(self.spark, table)
            keyed.expire(self.spark, table, keep_seconds)

    def _held(self) -> DataFrame:
        """Loads and days with the version that holds them, and the one that they were written by."""
        keys = keyed.newest_keys(self.spark, self.facts, keyed.live(self.spark, self.facts))
        return keys.select(*_KEYS, F.col("origin").alias("made_from"), "version")

    def _stale(self, held: DataFrame) -> DataFrame:
        made = keyed.read(self.spark, self.zones).select(*_MADE_FROM).distinct()
        return held.join(made, _MADE_FROM, "left_anti")

    def _made(self, stale: DataFrame) -> DataFrame:
        """Zones of some loads and days; one without wagers has a row of number 0."""
        low, high = stale.agg(F.min("Day"), F.max("Day")).first()
        days = [None if t is None else clock.as_ntz(t) for t in (low, high)]
        rows = keyed.rows_of(self.spark, self.facts, stale.select(*_KEYS, "version"), *days)
        built = stale.select(*_MADE_FROM).join(zones.build(rows, list(_KEYS)), list(_KEYS), "left")
        return built.withColumn("n", F.coalesce("n", F.lit(0)).cast("bigint")).select(*self.zones.columns)
