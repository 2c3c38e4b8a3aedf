"""Line deduplication against levelled sorted runs of line hashes.

A run is a Parquet table of line keys (two 64-bit hashes) sorted by hash inside hash partitions, with
the documents that hold the line and its owner, the largest id among them. Batches of documents come
in descending order of ids. Each is merge-joined with the runs: keys that no run holds enter the
batch's own run with their owner, keys that are known only add to the count, as a larger id owns
them already. When a level holds ``fanout`` runs they are merged into one run of the next level, so
n batches leave about log(n) runs and a key is rewritten about log(n) times. In the end the documents
are merge-joined with the keys of many documents, and lose the lines that others own. Everything is
built from DataFrame functions.

Defined results: null or empty text is one empty line; a key shorter than ``shortest`` code points
is never dropped; each row is a document, so a repeated row counts again, and rows that share the
largest doc_id all keep the line; a null doc_id is smaller than any other; columns beyond doc_id and
text pass through unchanged, whatever their names. An empty table gives an empty table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sinks.files import shared_dir, stored

SHORTEST = 20
#: A line of at least so many documents is kept in one of them only.
DOCUMENTS_FROM = 3
#: Batches that the documents of one call come in.
BATCHES = 4
#: Runs of a level that are merged.
FANOUT = 3
_BLANK = " \t\n\x0b\x0c\r"  # fixed value: [\x20\x09-\x0D]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RUN = "high bigint, low bigint, owner bigint, docs bigint"
_LEAST = -(2**63)


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _lowered(text: Column) -> Column:
    """A-Z lower-cased; lower() is faster and does the same where all characters are ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _LOWER)
    )


def keys(text: Column, shortest: int = SHORTEST) -> Column:
    """Per line the hashes of its key, null if the key is short."""

    def key(line: Column) -> Column:
        bare = F.btrim(line, F.lit(_BLANK))
        return F.when(
            F.char_length(bare) >= shortest,
            F.struct(F.xxhash64(bare).alias("high"), F.xxhash64(F.lit(1), bare).alias("low")),
        )

    return F.transform(lines(_lowered(text)), key)


def held_lines(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """A row per document and different line key: owner (the document's id), high, low."""
    found = F.explode(F.array_distinct(F.array_compact(keys(F.col("text"), shortest))))
    owner = F.coalesce(F.col("doc_id"), F.lit(_LEAST))
    return docs.select(owner.alias("owner"), found.alias("key")).select("owner", "key.high", "key.low")


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("high", "low").agg(F.max("owner").alias("owner"), F.sum("docs").alias("docs"))


class LineRuns:
    """The runs of one store, by level; each a table in the shared folder."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[DataFrame]] = [[]]

    def _write(self, rows: DataFrame) -> DataFrame:
        path = shared_dir(self.spark, "line_run")
        rows.select("high", "low", "owner", "docs").sortWithinPartitions("high", "low").write.parquet(path)
        return self.spark.read.schema(_RUN).parquet(path)

    def _rows(self) -> DataFrame:
        runs = [run for level in self.levels for run in level]
        return reduce(DataFrame.union, runs) if runs else self.spark.createDataFrame([], _RUN)

    def merged(self) -> DataFrame:
        """A row per key: its owner, and how many documents hold it."""
        return _summed(self._rows())

    def new(self, held: DataFrame) -> DataFrame:
        """The rows of ``held`` whose keys are in no run."""
        known = self._rows().select("high", "low").hint("merge")
        return held.join(known, ["high", "low"], "left_anti")

    def add(self, held: DataFrame) -> None:
        """A batch of held_lines(), whose owners are smaller than those of earlier batches."""
        batch = _summed(held.withColumn("docs", F.lit(1).cast("bigint")))
        if any(self.levels):
            known = self._rows().filter("owner IS NOT NULL").select("high", "low", F.lit(True).alias("known"))
            batch = batch.join(known.hint("merge"), ["high", "low"], "left")
            batch = batch.withColumn("owner", F.when(F.col("known").isNull(), F.col("owner")))
        self.levels[0].append(self._write(batch))
        for level, runs in enumerate(self.levels):
            if len(runs) >= self.fanout:
                if level + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[level + 1].append(self._write(_summed(reduce(DataFrame.union, runs))))
                self.levels[level] = []


def ingest(spark: SparkSession, held: DataFrame, batches: int = BATCHES, fanout: int = FANOUT) -> LineRuns:
    """Runs of all of ``held``, which comes in ``batches`` ranges of ids, the largest first."""
    runs = LineRuns(spark, fanout)
    shares = [i / batches for i in range(1, batches)]
    cuts = held.agg(F.percentile_approx("owner", shares, 1000)).first()[0] or []
    bounds = [None, *sorted(set(cuts)), None]
    for low, high in reversed(list(zip(bounds, bounds[1:]))):
        part = held if low is None else held.filter(F.col("owner") > low)
        runs.add(part if high is None else part.filter(F.col("owner") <= high))
    return runs


def dropped_keys(docs: DataFrame, shortest: int = SHORTEST, documents_from: int = DOCUMENTS_FROM) -> DataFrame:
    """Per document that loses lines: its id as ``owner``, and the keys that others own."""
    spark = docs.sparkSession
    held = stored(held_lines(docs, shortest), "held_lines")
    many = ingest(spark, held).merged().filter(F.col("docs") >= documents_from)
    # Written, so that the join below deals both sides itself and can split a line of many documents.
    many = stored(many.select("high", "low", F.col("owner").alias("keeper")), "repeated_lines")
    lost = held.join(many.hint("merge"), ["high", "low"]).filter(F.col("owner") < F.col("keeper"))
    return lost.groupBy("owner").agg(F.collect_set(F.struct("high", "low")).alias("lost"))


def dedup_lines(docs: DataFrame, shortest: int = SHORTEST, documents_from: int = DOCUMENTS_FROM) -> DataFrame:
    """The struct ``doc``, a row of ``docs``, with ``kept`` (text), ``n_lines`` and ``n_dropped``.

    Lines of at least ``documents_from`` documents stay only in the largest doc_id.
    """
    lost = dropped_keys(docs, shortest, documents_from)
    rows = docs.select(
        F.struct(*docs.columns).alias("doc"),
        F.coalesce(F.col("doc_id"), F.lit(_LEAST)).alias("owner"),
        F.coalesce(F.col("text"), F.lit("")).alias("body"),
    ).join(lost, "owner", "left")
    with_keys = F.zip_with(
        lines(F.col("body")), keys(F.col("body"), shortest),
        lambda line, key: F.struct(line.alias("line"), key.alias("key")),
    )
    staying = F.filter(
        with_keys, lambda x: ~F.coalesce(F.array_contains(F.col("lost"), x["key"]), F.lit(False))
    )
    kept = F.when(
        F.col("lost").isNotNull(), F.transform(staying, lambda x: x["line"])
    ).otherwise(lines(F.col("body")))
    return rows.select("doc", kept.alias("staying"), F.size(lines(F.col("body"))).alias("n_lines")).select(
        "doc", F.array_join("staying", "\n").alias("kept"),
        F.col("n_lines").cast("bigint").alias("n_lines"),
        (F.col("n_lines") - F.size("staying")).cast("bigint").alias("n_dropped"),
    )


def with_kept_text(docs: DataFrame) -> DataFrame:
    """``docs`` with the kept lines as text, and n_chars of it where there is such a column."""
    out = dedup_lines(docs)
    replaced = {
        "text": F.when(F.col("doc.text").isNotNull(), F.col("kept")).alias("text"),
        "n_chars": F.char_length("kept").cast("bigint").alias("n_chars"),
    }
    return out.select([replaced.get(c, F.col("doc")[c].alias(c)) for c in docs.columns])
