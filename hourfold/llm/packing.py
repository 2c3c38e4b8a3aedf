"""Best-fit packing of documents into sequences, certified by lower bounds.

Documents become pieces of at most ``capacity`` tokens. Pieces are dealt at random into groups of
about ``group_rows``; each group is packed by best-fit decreasing, and dual feasible functions give
a lower bound on the sequences it needs. A group that meets its bound is certified and hands on only
its emptiest sequence, what its rounding up has cost; a group with a gap hands on every sequence
with room to spare. What was handed on is dealt anew, so documents of different groups meet, and
packed again; a new round counts only if it needs fewer sequences than before. Every piece is placed
exactly once at every moment, so stopping early only costs space.

Defined results: null or empty text is one piece, the closing token; equal pieces are told apart by
a running number, so repeated rows are packed as often as they occur; an empty table packs to none.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..sinks.files import stored
from .bpe import encoder
from .tasks import arrow_schema, map_arrow, map_group_tables, record_batch, slices

CAPACITY = 4096
GROUP_ROWS = 20_000
ROUNDS = 5
END = 1
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, slot bigint"
_PLACED = "sequence_id bigint, offset bigint, open boolean"


def cut(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """A row per piece: the document's ids and ``end``, cut where longer than ``capacity``."""
    schema = arrow_schema(PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, last = encoder(path), np.array([end], "<u4")
        slot = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch.column(1)):
                many = part.stop - part.start
                keys = batch.column(0).slice(part.start, many).to_pylist()
                rows = []
                for key, ids in zip(keys, own.encode(batch.column(1).slice(part.start, many)), strict=True):
                    ids = np.append(ids, last)
                    for piece, start in enumerate(range(0, len(ids), capacity)):
                        held = ids[start : start + capacity]
                        rows.append((key, piece, start, len(held), zlib.crc32(held), slot))
                        slot += 1
                yield record_batch(list(map(list, zip(*rows, strict=True))), schema)

    return map_arrow(docs.select("doc_id", "text"), run, PIECES)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each length, which must come in descending order."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]  # sequences by their free space
    some = 0  # bit k is set if a sequence has k tokens free
    made = 0
    for i, size in enumerate(lengths.tolist()):
        fits = some >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            own = waiting[free].pop()
            if not waiting[free]:
                some &= ~(1 << free)
        else:
            free, own, made = capacity, made, made + 1
        bins[i], offsets[i] = own, capacity - free
        left = free - size
        if left:
            waiting[left].append(own)
            some |= 1 << left
    return bins, offsets


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """No packing of the lengths takes fewer sequences: the best of two families of bounds.

    A dual feasible function maps lengths so that what fits into one sequence still does; the sum of
    the mapped lengths over the capacity is then a bound. The first family, for each s up to half
    the capacity, counts lengths over capacity - s as a whole sequence and those under s as nothing;
    the second rounds (k + 1) times the length to whole k-ths of the capacity.
    """
    if not len(lengths):
        return 0
    counts = np.bincount(lengths, minlength=capacity + 1)
    number = np.r_[0, np.cumsum(counts)]
    volume = np.r_[0, np.cumsum(counts * np.arange(capacity + 1))]
    small = np.arange(capacity // 2 + 1)
    whole = number[-1] - number[capacity - small + 1]
    middle = volume[capacity - small + 1] - volume[small]
    best = math.ceil((whole * capacity + middle).max() / capacity)
    sizes = np.arange(capacity + 1)
    for k in range(1, 25):
        scaled = (k + 1) * sizes
        exact = scaled % capacity == 0
        mapped = np.where(exact, sizes * k, scaled // capacity * capacity)  # times k
        best = max(best, math.ceil(int((counts * mapped).sum()) / (k * capacity)))
    return best


def _pack_group(rows: pa.Table, capacity: int, number: int, schema: pa.Schema) -> pa.Table:
    order = [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("slot", "ascending")]
    rows = rows.sort_by(order)
    lengths = rows.column("length").to_numpy()
    bins, offsets = best_fit(lengths, capacity)
    free = capacity - np.bincount(bins, weights=lengths).astype(np.int64)
    if len(free) > lower_bound(lengths, capacity):
        released = free > 0
    else:
        released = np.arange(len(free)) == free.argmax()
        released &= free > 0
    first = number << 52 | rows.column("own_group")[0].as_py() << 20
    placed = [pa.array(c) for c in (first + bins, offsets, released[bins])]
    return pa.Table.from_arrays([*rows.drop_columns("own_group").columns, *placed], schema=schema)


def _round(rows: DataFrame, number: int, capacity: int, group_rows: int, many: int) -> DataFrame:
    groups = max(1, math.ceil(many / group_rows))
    dealt = F.pmod(F.xxhash64("slot", F.lit(number)), F.lit(groups))
    rows = rows.select(*[c.split(" ")[0] for c in PIECES.split(", ")]).withColumn("own_group", dealt)

    ddl = f"{PIECES}, {_PLACED}"
    schema = arrow_schema(ddl)
    return map_group_tables(rows, "own_group", lambda group: _pack_group(group, capacity, number, schema), ddl)


def pack(
    pieces: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, rounds: int = ROUNDS
) -> DataFrame:
    """``pieces`` with sequence_id, any number, and offset.

    A group's rows are in one task's memory; a group has at most 2^20 rows.
    """
    many = pieces.count()
    placed = stored(_round(pieces, 0, capacity, group_rows, many), "packed")
    closed = [placed.filter(~F.col("open"))]
    waiting = placed.filter("open")
    for number in range(1, rounds):
        many, before = waiting.agg(F.count("*"), F.count_distinct("sequence_id")).first()
        if before <= 1:
            break
        again = stored(_round(waiting, number, capacity, group_rows, many), "packed")
        if again.agg(F.count_distinct("sequence_id")).first()[0] >= before:
            break
        closed.append(again.filter(~F.col("open")))
        waiting = again.filter("open")
    for rows in closed:
        waiting = waiting.unionByName(rows)
    return waiting.drop("slot", "open")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Where each piece of each document goes."""
    return pack(stored(cut(docs, path, capacity), "pieces"), capacity)


def certificate(packed: DataFrame, capacity: int = CAPACITY) -> tuple[int, int]:
    """Sequences used, and a lower bound for any packing, from the counts of each length."""
    counts = packed.groupBy("length").count().collect()  # at most ``capacity`` rows
    lengths = np.repeat(
        np.array([r["length"] for r in counts], np.int64), np.array([r["count"] for r in counts], np.int64)
    )
    return packed.agg(F.count_distinct("sequence_id")).first()[0], lower_bound(lengths, capacity)
