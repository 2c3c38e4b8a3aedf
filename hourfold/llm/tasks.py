"""What the operators share: tables, Arrow batches, and lookups of the pieces between white space."""

from __future__ import annotations

import atexit
import pathlib
import shutil
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"

#: Bytes of text that a task works on at a time.
SLICE_BYTES = 8_000_000
#: Different pieces of text that a task remembers.
REMEMBERED = 300_000

_KINDS = {
    "bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(),
    "boolean": pa.bool_(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()),
    "array<bigint>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()),
}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(DOCUMENTS).parquet(f"{sf_dir}/documents.parquet")


def ship(spark: SparkSession) -> None:
    """Hands this package's code to the executors, once per session; Spark's file server carries it."""
    context, package = spark.sparkContext, pathlib.Path(__file__).resolve().parents[1]
    if getattr(context, "_shipped", None) != package:
        folder = tempfile.mkdtemp()  # of the driver, which serves the file as long as it runs
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        name = f"{folder}/{package.name}"
        context.addPyFile(shutil.make_archive(name, "zip", package.parent, package.name))
        context._shipped = package


def map_arrow(df: DataFrame, run: Callable, ddl: str) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(run, ddl)


def map_groups(df: DataFrame, key: str, run: Callable, ddl: str) -> DataFrame:
    ship(df.sparkSession)
    return df.groupBy(key).applyInPandas(run, ddl)


def map_group_tables(df: DataFrame, key: str, run: Callable, ddl: str) -> DataFrame:
    """Like ``map_groups`` with Arrow tables, which keep integers next to nulls."""
    ship(df.sparkSession)
    return df.groupBy(key).applyInArrow(run, ddl)


def arrow_schema(ddl: str) -> pa.Schema:
    fields = [item.strip().split(" ", 1) for item in ddl.split(", ")]
    return pa.schema([(name, _KINDS[kind]) for name, kind in fields])


def record_batch(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    arrays = [
        c if isinstance(c, pa.Array) else pa.array(c, f.type)
        for c, f in zip(columns, schema, strict=True)
    ]
    return pa.record_batch(arrays, schema=schema)


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[slice]:
    """Consecutive slices of about ``most`` bytes, each of one text at least."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        done = upto[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(upto, done + most, "right")))
        yield slice(start, stop)
        start = stop


def map_batches(df: DataFrame, setup: Callable, columns: Callable, ddl: str) -> DataFrame:
    """The first column of ``df``, and the columns of ``ddl`` made from its second one.

    ``setup()`` runs once per task, ``columns(setup(), array)`` for slices of the Arrow batches.
    """
    key = df.schema[0]
    ddl = f"{key.name} {key.dataType.simpleString()}, {ddl}"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = setup()
        for batch in batches:
            texts = pa.types.is_string(batch.schema.field(1).type)
            for part in slices(batch.column(1)) if texts else [slice(0, len(batch))]:
                keys, values = (c.slice(part.start, part.stop - part.start) for c in batch.columns)
                yield record_batch([keys, *columns(state, values)], schema)

    return map_arrow(df, run, ddl)


class Pieces:
    """Looks up what belongs to each piece between ASCII white space, learning each piece once.

    ``learn`` gives the bytes of a list of pieces: any number of values of ``dtype`` for each.
    """

    def __init__(self, learn: Callable[[list[str]], list[bytes]], dtype: str, most: int = REMEMBERED):
        self.learn, self.dtype, self.most = learn, np.dtype(dtype), most
        self.known: dict[str, bytes] = {}

    def _bytes(self, pieces: list[str]) -> list[bytes]:
        new = [p for p in pieces if p not in self.known]
        if len(self.known) + len(new) > self.most:
            self.known, new = {}, pieces
        if new:
            self.known.update(zip(new, self.learn(new), strict=True))
        return list(map(self.known.__getitem__, pieces))

    def ragged(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The values of all texts in a row, and where each text's values begin and end."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = split.flatten().dictionary_encode()
        found = self._bytes(coded.dictionary.to_pylist())
        flat = np.frombuffer(b"".join(found), self.dtype)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize
        starts = np.cumsum(sizes) - sizes
        codes = coded.indices.to_numpy()
        many = sizes[codes]
        upto = np.r_[0, np.cumsum(many)]
        values = flat[np.repeat(starts[codes] - upto[:-1], many) + np.arange(upto[-1])]
        offsets = split.offsets.to_numpy()
        return values, upto[offsets - offsets[0]]

    def of(self, texts: pa.Array) -> list[np.ndarray]:
        """The values of each text."""
        values, bounds = self.ragged(texts)
        at = bounds.tolist()
        return [values[i:j] for i, j in zip(at, at[1:])]
