"""Exact top-k search by inner product with a table of distances to pivots.

A vector gets one more component, so that all have the same norm M, and a query gets a zero there. Then
|q - v|^2 = |q|^2 + M^2 - 2 q.v: the best inner products are the nearest vectors, and by the triangle
inequality | |q - p| - |v - p| | is a lower bound of |q - v| for every pivot p. Distances of all vectors
to all pivots are computed once and stored with the vectors, in blocks. A block's candidates are
evaluated in the order of their largest bound, and a query stops as soon as the next bound rules out
a place among its best k. What a query is known to reach from the start are its scores with the pivots.

Queries meet vectors in blocks: each block of vectors sees all blocks of queries. Only pivots and one
norm go through the driver. Scores are integers, and exact: bounds are widened by more than rounding.

Defined results: vectors that are null, or hold null or non-finite components, and rows without
vec_id take no part; rows with the same vec_id are one, with the least vector; a query meets vectors
of its own length only; ties go to the smaller vec_id; fewer than k candidates give as many rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sinks.files import stored
from .tasks import arrow_schema, map_arrow, record_batch

K = 10
PIVOTS = 48
#: Rows of a block of vectors, and of queries.
VECTORS, QUERIES = 8192, 512
SCALE = 1024
_BLOCKS = "width int, block bigint, ids binary, vectors binary, distances binary"
_FOUND = "query_id bigint, vec_id bigint, score bigint"
_EXACT = 2.0**52  # integers up to here are exact as doubles


def quantised(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def whole_vectors(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and its integer vector, one row per id."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: F.coalesce(F.abs(v.cast("double")) < float("inf"), F.lit(False)))
    good = rows.filter(F.col("vec_id").isNotNull() & x.isNotNull() & finite)
    return good.groupBy("vec_id").agg(F.min(quantised(x, scale)).alias("vector"))


class Pivots:
    """Pivots by the length of the vectors, and the largest norm."""

    def __init__(self, rows: list, largest: float):
        self.square = largest
        self.by_width: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for width in {len(r["vector"]) for r in rows}:
            own = [r for r in rows if len(r["vector"]) == width]
            vectors = np.array([r["vector"] for r in own], np.float64).reshape(len(own), width)
            self.by_width[width] = np.array([r["vec_id"] for r in own], np.int64), vectors

    def _extra(self, vectors: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.square - (vectors * vectors).sum(1), 0))

    def of(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        return self.by_width.get(width, (np.zeros(0, np.int64), np.zeros((0, width))))

    def from_vectors(self, vectors: np.ndarray) -> np.ndarray:
        """Distances of vectors to the pivots."""
        pivots = self.of(vectors.shape[1])[1]
        along = vectors @ pivots.T + np.outer(self._extra(vectors), self._extra(pivots))
        return np.sqrt(np.maximum(2 * self.square - 2 * along, 0))

    def from_queries(self, queries: np.ndarray) -> np.ndarray:
        pivots = self.of(queries.shape[1])[1]
        own = (queries * queries).sum(1)[:, None]
        return np.sqrt(np.maximum(own + self.square - 2 * queries @ pivots.T, 0))


def choose_pivots(vectors: DataFrame, many: int = PIVOTS) -> Pivots:
    """``many`` vectors that a hash of their ids picks."""
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    largest = vectors.agg(F.max(square)).first()[0] or 0.0
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(many).collect()
    return Pivots(rows, largest * (1 + 1e-12))


def blocks(vectors: DataFrame, pivots: Pivots, rows: int, queries: bool) -> DataFrame:
    """Blocks of at most ``rows`` vectors of one length with their distances to the pivots."""
    schema = arrow_schema(_BLOCKS)

    def block(width: int, held: list[tuple], number: int) -> pa.RecordBatch:
        ids = np.array([i for i, _ in held], np.int64)
        data = np.array([v for _, v in held], np.int64).reshape(len(held), width)
        measure = pivots.from_queries if queries else pivots.from_vectors
        distances = measure(data.astype(np.float64))
        return record_batch([[width], [number], [ids.tobytes()], [data.tobytes()], [distances.tobytes()]], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        waiting: dict[int, list[tuple]] = {}
        for batch in batches:
            for key, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held = waiting.setdefault(len(vector), [])
                held.append((key, vector))
                if len(held) == rows:
                    yield block(len(vector), waiting.pop(len(vector)), number)
                    number += 1
        for width, held in waiting.items():
            yield block(width, held, number)
            number += 1

    return map_arrow(vectors.select("vec_id", "vector"), run, _BLOCKS)


def search(
    queries: tuple[np.ndarray, ...], vectors: tuple[np.ndarray, ...], pivots: Pivots, k: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its id, and the ids and scores of its best k in the block."""
    (q_ids, q, q_far), (v_ids, v, v_far) = queries, vectors
    # Products of doubles are fast, and exact while no partial sum can pass 2^52.
    reach = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * max(1, q.shape[1])
    q, v = (q.astype(np.float64), v.astype(np.float64)) if reach < _EXACT else (q, v)
    squares = (q.astype(np.float64) ** 2).sum(1) + pivots.square
    p_ids, p = pivots.of(q.shape[1])
    by_pivot = v_far.T.copy()
    for i, own in enumerate(q_ids.tolist()):
        bound = np.zeros(len(v_ids))
        for far, column in zip(q_far[i].tolist(), by_pivot, strict=True):
            np.maximum(bound, np.abs(column - far), out=bound)
        most = (squares[i] - bound * bound) / 2 + 1 + 1e-9 * squares[i]
        most[v_ids == own] = -np.inf
        others = (p @ q[i].astype(np.float64))[p_ids != own]
        # Another block may hold the k-th best; pivots are vectors too.
        least = np.sort(others)[-k] - 1e-9 * squares[i] - 1 if len(others) >= k else -np.inf
        order = np.flatnonzero(most >= least)
        order = order[np.argsort(-most[order])]
        order = order[most[order] > -np.inf]
        ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, step = 0, 4 * k
        while at < len(order) and (len(scores) < k or most[order[at]] >= scores[-1]):
            now = order[at : at + step]
            ids = np.concatenate([ids, v_ids[now]])
            scores = np.concatenate([scores, (v[now] @ q[i]).astype(np.int64)])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            at, step = at + step, 2 * step
        yield own, ids, scores


def top_k(rows: DataFrame, is_query: Column, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank from 1, vec_id and score of each query's best ``k`` among the other rows."""
    vectors = stored(whole_vectors(rows, scale), "vectors")
    pivots = choose_pivots(vectors)
    held = stored(blocks(vectors, pivots, VECTORS, False), "vector_blocks")
    asked = stored(blocks(vectors.filter(is_query), pivots, QUERIES, True), "query_blocks")
    shared = rows.sparkSession.sparkContext.broadcast(pivots)
    schema = arrow_schema(_FOUND)
    # Every block of vectors meets every block of queries of the same length, by their numbers.
    asked = asked.select("width", *[F.col(c).alias(f"q_{c}") for c in ("ids", "vectors", "distances")])
    meetings = asked.join(held.select("width", "block"), "width")
    pairs = meetings.join(held.select("block", "ids", "vectors", "distances"), "block")

    def unpacked(width: int, ids: bytes, vectors: bytes, distances: bytes) -> tuple[np.ndarray, ...]:
        ids = np.frombuffer(ids, np.int64)
        shape = len(ids), -1 if len(distances) else 0
        return ids, np.frombuffer(vectors, np.int64).reshape(len(ids), width), np.frombuffer(distances).reshape(shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                width = row["width"]
                queries = unpacked(width, row["q_ids"], row["q_vectors"], row["q_distances"])
                found = list(search(queries, unpacked(width, row["ids"], row["vectors"], row["distances"]), shared.value, k))
                yield record_batch([
                    np.repeat([i for i, _, _ in found], [len(x) for _, x, _ in found]).astype(np.int64),
                    np.concatenate([x for _, x, _ in found]), np.concatenate([s for _, _, s in found]),
                ], schema)

    found = map_arrow(pairs.select("width", "q_ids", "q_vectors", "q_distances", "ids", "vectors", "distances"), run, _FOUND)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int"), "vec_id", "score"
    )
