"""Tables whose rows are replaced by key, kept as versions that are merged level by level.

A write puts rows, and the keys it answers for, into folders of a version of its own, and announces them
when both are complete. A key's rows are those of the newest announced version that names it, so a key that
is named without rows is empty. Nothing is read back, carried over or deleted, a run that dies changes
nothing, and writers of different keys don't meet.

* ``put`` and ``update`` number their announcements, and a number can be taken once. ``update`` is for rows that depend
  on stored ones: a writer that comes second looks at what was announced since it read. If that names none
  of its keys it takes the next number, else it works its rows out again from the new state.
* ``compact`` merges all versions of a level, once there are ``FANOUT`` of them, into one of the next level,
  and announces it together with the names of those it replaces. A merged key keeps the rank of the version
  that it came from, so a version that is announced late still finds its place. A row is rewritten once a
  level, about log(versions) times; a reader opens at most ``FANOUT`` versions a level.
* ``expire`` deletes what was replaced, or never announced, for longer than readers take. A reader that takes
  longer holds a pin.

A crash between any two steps leaves folders that nobody reads, and announcements of which both the old and
the new ones give the same rows. Key columns must not be null. The file system must create links (file:)
or rename (others, as HDFS does) without replacing what is there.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.joins import BROADCAST_ROWS, fact_join

#: Versions of a level that are merged.
FANOUT = 8
#: Attempts of a writer whose keys others write at the same time.
ATTEMPTS = 20
_ANNOUNCED = "version string, rank string, replaces array<string>, low timestamp_ntz, high timestamp_ntz"


@dataclass(frozen=True)
class Keyed:
    """A table: its folder, key columns, columns with types, the key column that dates rows, and folder columns."""

    path: str
    keys: tuple[str, ...]
    ddl: str
    dated: str | None = None
    folders: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [c.split(" ", 1)[0] for c in self.ddl.split(", ")]

    def kinds(self, names: tuple[str, ...] | list[str]) -> str:
        return ", ".join(c for c in self.ddl.split(", ") if c.split(" ", 1)[0] in names)


@dataclass(frozen=True)
class Announced:
    """An announced version; ``rank`` orders versions, ``low`` and ``high`` bound the dates of its keys."""

    version: str
    rank: str
    replaces: tuple[str, ...]
    low: object
    high: object
    file: str

    @property
    def level(self) -> int:
        return int(self.version.rsplit("~", 1)[1]) if "~" in self.version else 0


def read_existing(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None where nothing was written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as err:
        if err.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _listed(spark: SparkSession, path: str) -> dict[str, float]:
    """Names in a folder with the seconds of their last change."""
    fs, where = _file_system(spark, path)
    if not fs.exists(where):
        return {}
    return {s.getPath().getName(): s.getModificationTime() / 1000 for s in fs.listStatus(where)}


def _delete(spark: SparkSession, path: str) -> None:
    fs, where = _file_system(spark, path)
    fs.delete(where, True)


def _publish(spark: SparkSession, source: str, target: str) -> bool:
    """Gives a complete file its name, unless the name is taken."""
    fs, to = _file_system(spark, target)
    fs.mkdirs(to.getParent())
    if fs.getScheme() != "file":
        return not fs.exists(to) and fs.rename(_file_system(spark, source)[1], to)
    paths = spark._jvm.java.nio.file.Paths
    local = [spark._jvm.java.io.File(_file_system(spark, p)[1].toUri().getPath()).getPath() for p in (target, source)]
    try:
        spark._jvm.java.nio.file.Files.createLink(*[paths.get(p, spark.sparkContext._gateway.new_array(spark._jvm.java.lang.String, 0)) for p in local])
    except Py4JJavaError as err:
        if "FileAlreadyExists" in err.java_exception.getClass().getName():
            return False
        raise
    return True


def announce(spark: SparkSession, table: Keyed, rows: DataFrame, name: str) -> bool:
    """Announces the versions of ``rows`` in one file; False if another file has that name."""
    pending = f"{table.path}/pending/{uuid.uuid4().hex}"
    rows.coalesce(1).write.parquet(pending)
    (part,) = [n for n in _listed(spark, pending) if n.endswith(".parquet")]
    done = _publish(spark, f"{pending}/{part}", f"{table.path}/announced/{name}.parquet")
    _delete(spark, pending)
    return done


def announcements(spark: SparkSession, table: Keyed) -> list[Announced]:
    """Every announced version: one per run, or fewer where they are merged."""
    if not _listed(spark, f"{table.path}/announced"):
        return []
    rows = spark.read.schema(_ANNOUNCED).parquet(f"{table.path}/announced").select("*", "_metadata.file_name").collect()
    return [
        Announced(r["version"], r["rank"] or r["version"], tuple(r["replaces"] or ()), r["low"], r["high"], r["file_name"])
        for r in rows
    ]


def live(spark: SparkSession, table: Keyed) -> list[Announced]:
    """Announced versions that none replaces."""
    every = announcements(spark, table)
    replaced = {v for a in every for v in a.replaces}
    return [a for a in every if a.version not in replaced]


def new_version() -> str:
    return f"{time.time_ns():020d}-{uuid.uuid4().hex}"


def _put(table: Keyed, rows: DataFrame, due: DataFrame, version: str, origin: str | None = None) -> DataFrame:
    """Writes the folders of a version; gives its announcement but for the rank."""
    spark = rows.sparkSession
    kept = rows.selectExpr(*[f"CAST({c} AS {kind}) AS {c}" for c, kind in (x.split(" ", 1) for x in table.ddl.split(", "))])
    if "date" in table.folders:
        kept = kept.withColumn("date", F.col(table.dated).cast("date"))
    if "hour" in table.folders:
        kept = kept.withColumn("hour", F.hour(table.dated))
    kept = kept.hint("rebalance", *[F.col(c) for c in table.folders or table.keys[:1]])
    writer = kept.write.mode("overwrite")
    (writer.partitionBy(*table.folders) if table.folders else writer).parquet(f"{table.path}/rows/version={version}")
    keys = due.select(*table.keys, *([origin] if origin else [])).distinct()
    keys.write.mode("overwrite").parquet(f"{table.path}/keys/version={version}")
    named = spark.read.schema(table.kinds(table.keys)).parquet(f"{table.path}/keys/version={version}")
    return _bounds(table, named.groupBy()).withColumns({
        "version": F.lit(version), "rank": F.lit(None).cast("string"), "replaces": F.lit(None).cast("array<string>")
    })


def _bounds(table: Keyed, grouped) -> DataFrame:
    dated = F.col(table.dated) if table.dated else F.lit(None)
    dated = dated.cast("timestamp_ntz")
    return grouped.agg(F.min(dated).alias("low"), F.max(dated).alias("high"))


def write(table: Keyed, rows: DataFrame, due: DataFrame, version: str | None = None) -> str:
    """Replace the rows of every ``due`` key by ``rows``, whatever was there before."""
    version = version or new_version()
    announcement = _put(table, rows, due, version)
    announce(rows.sparkSession, table, announcement, version)
    return version


def write_versions(table: Keyed, rows: DataFrame, due: DataFrame, split: Column) -> None:
    """Like one ``write`` for each value of ``split``, a text, in one job: a backfill of many hours."""
    spark, first = rows.sparkSession, new_version()
    version = F.concat(F.lit(f"{first}-"), split)
    kept = rows.selectExpr(*[f"CAST({c} AS {kind}) AS {c}" for c, kind in (x.split(" ", 1) for x in table.ddl.split(", "))])
    kept = kept.withColumn("version", version)
    if "date" in table.folders:
        kept = kept.withColumn("date", F.col(table.dated).cast("date"))
    if "hour" in table.folders:
        kept = kept.withColumn("hour", F.hour(table.dated))
    kept.hint("rebalance", F.col("version")).write.mode("append").partitionBy("version", *table.folders).parquet(f"{table.path}/rows")
    keys = due.select(*table.keys).distinct().withColumn("version", version)
    keys.hint("rebalance", F.col("version")).write.mode("append").partitionBy("version").parquet(f"{table.path}/keys")
    written = spark.read.schema(f"{table.kinds(table.keys)}, version string").parquet(f"{table.path}/keys")
    written = written.filter(F.col("version").startswith(first))
    announce(spark, table, _bounds(table, written.groupBy("version")).withColumns({
        "rank": F.lit(None).cast("string"), "replaces": F.lit(None).cast("array<string>")
    }), first)


def _folder(spark: SparkSession, table: Keyed, kind: str, ddl: str, versions: list[str]) -> DataFrame:
    paths = [f"{table.path}/{kind}/version={v}" for v in versions]
    known = [p for p in paths if _exists(spark, p)] if kind == "rows" else paths
    reader = spark.read.schema(f"{ddl}, version string")
    if not known:
        return spark.createDataFrame([], f"{ddl}, version string")
    return reader.option("basePath", f"{table.path}/{kind}").parquet(*known)


def _exists(spark: SparkSession, path: str) -> bool:
    fs, where = _file_system(spark, path)
    return fs.exists(where)


def newest_keys(spark: SparkSession, table: Keyed, versions: list[Announced]) -> DataFrame:
    """Each key with the version whose rows count, and the rank (origin) that it has among versions."""
    named = _folder(spark, table, "keys", f"{table.kinds(table.keys)}, origin string", [a.version for a in versions])
    ranks = spark.createDataFrame([(a.version, a.rank) for a in versions] or [], "version string, rank string")
    # One row a live version.
    ranked = named.join(F.broadcast(ranks), "version")
    best = F.max(F.struct(F.coalesce("origin", "rank").alias("origin"), "version"))
    return ranked.groupBy(*table.keys).agg(best.alias("best")).select(*table.keys, "best.origin", "best.version")


def read(
    spark: SparkSession, table: Keyed, first: Column | None = None, last: Column | None = None,
    versions: list[Announced] | None = None,
) -> DataFrame:
    """Stored rows, dated within [first, last] where given; only their versions and folders are opened."""
    versions = live(spark, table) if versions is None else versions
    if versions and table.dated and (first is not None or last is not None):
        low, high = spark.range(1).select(
            *[F.lit(None).cast("timestamp_ntz") if b is None else b.cast("timestamp_ntz") for b in (first, last)]
        ).first()
        versions = [
            a for a in versions if a.low is not None and (low is None or a.high >= low) and (high is None or a.low <= high)
        ]
    if not versions:
        return spark.createDataFrame([], table.ddl)
    keys = newest_keys(spark, table, versions).drop("origin")
    for bound, within in ((first, Column.__ge__), (last, Column.__le__)):
        if bound is not None:
            keys = keys.filter(within(F.col(table.dated), bound))
    return rows_of(spark, table, keys, first, last)


def rows_of(
    spark: SparkSession, table: Keyed, keys: DataFrame, first: Column | None = None, last: Column | None = None
) -> DataFrame:
    """Rows of some of the ``newest_keys``, dated within [first, last] where given; only their versions are opened."""
    extra = "".join(f", {name} {kind}" for name, kind in (("date", "date"), ("hour", "int")) if name in table.folders)
    holding = keys.groupBy("version").count().collect()  # a row a live version at most
    rows = _folder(spark, table, "rows", f"{table.ddl}{extra}", sorted(r["version"] for r in holding))
    for bound, within in ((first, Column.__ge__), (last, Column.__le__)):
        if bound is not None:
            rows = rows.filter(within(F.col(table.dated), bound))
            if "date" in table.folders:
                rows = rows.filter(within(F.col("date"), bound.cast("date")))
    few = sum(r["count"] for r in holding) <= BROADCAST_ROWS
    side = F.broadcast(keys) if few else keys.hint("merge")
    return rows.join(side, [*table.keys, "version"], "left_semi").select(*table.columns)


def _names(spark: SparkSession, table: Keyed, newer: list[Announced], version: str) -> bool:
    """Whether one of the ``newer`` versions names a key of ``version``."""
    kinds = table.kinds(table.keys)
    theirs = _folder(spark, table, "keys", kinds, [a.version for a in newer]).drop("version")
    mine = _folder(spark, table, "keys", kinds, [version]).drop("version")
    return not theirs.join(mine, list(table.keys), "left_semi").isEmpty()


def _next_number(announced: list[Announced]) -> str:
    taken = (a.file.split(".")[0] for a in announced)
    return f"{1 + max((int(n) for n in taken if n.isdigit()), default=0):020d}"


def _numbered(announcement: DataFrame, version: str, seen: list[Announced]) -> DataFrame:
    """Versions are named by the clock; another writer's clock may be ahead."""
    rank = max([version, *[f"{a.rank}+" for a in seen]])
    return announcement.withColumn("rank", F.lit(rank))


def put(spark: SparkSession, table: Keyed, rows: DataFrame, due: DataFrame | None = None) -> None:
    """``rows`` in place of all rows of their keys, or of the ``due`` ones, behind whatever others have announced by then."""
    version = new_version()
    announcement = _put(table, rows, rows if due is None else due, version)
    while True:
        seen = announcements(spark, table)
        if announce(spark, table, _numbered(announcement, version, seen), _next_number(seen)):
            return


def update(spark: SparkSession, table: Keyed, change: Callable[[DataFrame], tuple[DataFrame, DataFrame]]) -> int:
    """Writes what ``change`` makes of the stored rows: new rows, and the keys they replace. Gives the attempts.

    ``change`` is called again if another writer has meanwhile written one of those keys.
    """
    for attempt in range(1, ATTEMPTS + 1):
        seen = announcements(spark, table)
        gone = {v for a in seen for v in a.replaces}
        rows, due = change(read(spark, table, versions=[a for a in seen if a.version not in gone]))
        version = new_version()
        announcement = _put(table, rows, due, version)
        known = {a.version for a in seen}
        while True:
            if announce(spark, table, _numbered(announcement, version, seen), _next_number(seen)):
                return attempt
            seen = announcements(spark, table)
            newer = [a for a in seen if a.version not in known and not a.replaces]
            if _names(spark, table, newer, version):
                break
            known |= {a.version for a in seen}
        for kind in ("rows", "keys"):
            _delete(spark, f"{table.path}/{kind}/version={version}")
    raise RuntimeError(f"{table.path}: others wrote the same keys {ATTEMPTS} times")


def compact(spark: SparkSession, table: Keyed, fanout: int = FANOUT) -> list[str]:
    """Merges the levels that have ``fanout`` versions; gives the new versions. Rows read stay the same."""
    made, level = [], 0
    while True:
        versions = live(spark, table)
        own = [a for a in versions if a.level == level]
        if len(own) >= max(2, fanout):
            made.append(_merge(spark, table, versions, own, level + 1))
        elif not any(a.level > level for a in versions):
            return made
        level += 1


def _merge(spark: SparkSession, table: Keyed, versions: list[Announced], own: list[Announced], level: int) -> str:
    names = [a.version for a in own]
    # What a newer version holds need not be kept.
    keys = newest_keys(spark, table, versions).filter(F.col("version").isin(names))
    extra = "".join(f", {name} {kind}" for name, kind in (("date", "date"), ("hour", "int")) if name in table.folders)
    rows = _folder(spark, table, "rows", f"{table.ddl}{extra}", names)
    rows = fact_join(rows, keys, [*table.keys, "version"], "left_semi").select(*table.columns)
    version = f"{new_version()}~{level}"
    announcement = _put(table, rows, keys, version, "origin")
    replaces = F.array(*[F.lit(n) for n in names])
    announce(spark, table, announcement.withColumns({"replaces": replaces, "rank": F.lit(max(a.rank for a in own))}), version)
    return version


@contextmanager
def pinned(spark: SparkSession, table: Keyed) -> Iterator[list[Announced]]:
    """The live versions, which ``expire`` leaves alone for as long as the block runs."""
    pin = f"{table.path}/pins/{uuid.uuid4().hex}"
    try:
        versions = live(spark, table)
        spark.createDataFrame([(a.version,) for a in versions], "version string").coalesce(1).write.parquet(pin)
        # What was replaced between reading and pinning may be gone: read again until both agree.
        while {a.version for a in live(spark, table)} != {a.version for a in versions}:
            versions = live(spark, table)
            spark.createDataFrame([(a.version,) for a in versions], "version string").coalesce(1).write.mode("append").parquet(pin)
        yield versions
    finally:
        _delete(spark, pin)


def expire(spark: SparkSession, table: Keyed, keep_seconds: float = 86_400, pin_seconds: float = 7 * 86_400) -> list[str]:
    """Deletes versions that were replaced, or written but never announced, more than ``keep_seconds`` ago.

    Pinned ones stay, unless the pin is older than ``pin_seconds``. Gives the deleted versions.
    """
    now = time.time()
    pins = [f"{table.path}/pins/{name}" for name, changed in _listed(spark, f"{table.path}/pins").items() if now - changed < pin_seconds]
    held = {r["version"] for r in spark.read.schema("version string").parquet(*pins).collect()} if pins else set()
    # Folders first: what is announced after this listing isn't among them.
    folders = {kind: _listed(spark, f"{table.path}/{kind}") for kind in ("rows", "keys")}
    changed = _listed(spark, f"{table.path}/announced")
    every = announcements(spark, table)
    replaced_at = {v: changed.get(a.file, now) for a in every for v in a.replaces}
    known = {a.version for a in every}
    gone = set()
    for kind, listed in folders.items():
        for name, when in listed.items():
            version = name.removeprefix("version=")
            if not name.startswith("version=") or version in held:
                continue
            dead_since = replaced_at.get(version) if version in known or version in replaced_at else when
            if dead_since is not None and now - dead_since >= keep_seconds:
                gone.add(version)
    # Announcements go first, so that none names a folder that isn't there.
    by_file: dict[str, set[str]] = {}
    for a in every:
        by_file.setdefault(a.file, set()).add(a.version)
    for file, versions in by_file.items():
        if versions <= gone:
            _delete(spark, f"{table.path}/announced/{file}")
    for version in gone:
        for kind in ("rows", "keys"):
            _delete(spark, f"{table.path}/{kind}/version={version}")
    return sorted(gone)
