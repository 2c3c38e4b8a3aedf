"""Approximate nearest neighbours by inner product along several shifted Hilbert curves.

Vectors are put on a sphere (one more component gives all vectors of a norm band the same norm, a query
gets a zero there), so that the best inner products are the nearest points. For each curve the points are
projected on a few random orthonormal directions, spread evenly over a grid by quantiles of a sample,
shifted, and numbered along a Hilbert curve. Spark sorts all curves at once by range partitions; a curve is
cut into blocks, and a query meets its own block and the blocks next to it. There, 8-bit codes of the
vectors are compared; the best of all curves merge, and their scores are computed anew from the original
vectors. Blocks grow with the 2/3 power of the number of vectors, as neighbours of vectors without structure
are spread along a curve the wider the more vectors there are; no block and no list grows with a group of
equal vectors.

Equal vectors are one point: only the k + 1 least ids of a point can be among the k best of any query, ties
going to the smaller id, so a point carries those, and its queries share one search.

Fitted on a bounded sample: the quantiles, from at most ``SAMPLE`` points of each norm band, chosen by a
hash of their ids. Every vector is indexed. Through the driver go the sample's projections, the bands' sizes
and the number of points of each sorted partition.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and rows without
vec_id take no part; rows with the same vec_id are one, with the least vector; a query meets vectors of its
own length only; ties go to the smaller vec_id; fewer than k candidates give as many rows; an empty table
gives an empty table. Vectors of very different norms (bands of a factor of two) are searched band by band.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sinks.files import stored
from .tasks import arrow_schema, map_arrow, record_batch, ship

K = 20
CURVES = 16
#: Directions of a curve, and bits of a coordinate on its grid.
DIRECTIONS, BITS = 8, 7
#: Points of a norm band that the quantiles come from.
SAMPLE = 4096
#: Least and most points of a block. Beyond the most, a query meets more neighbouring blocks.
LEAST_BLOCK, MOST_BLOCK = 256, 1 << 19
#: Points that a query keeps of each curve, and of all curves.
KEPT = 32
SEED = 11
_ENTRY = "width int, band int, curve int, place bigint, asks boolean, point bigint, code binary"
_NEAR = "query bigint, point bigint, likeness double"


def whole_vectors(rows: DataFrame) -> DataFrame:
    """vec_id and its vector of floats, one row per id."""
    x = F.col("embedding").cast("array<float>")
    finite = F.forall(x, lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False)))
    good = rows.filter(F.col("vec_id").isNotNull() & x.isNotNull() & finite & F.exists(x, lambda v: v != 0.0))
    return good.groupBy("vec_id").agg(F.min(x).alias("vector"))


def _norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))


def points(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """One row per different vector: point (its least id), its k + 1 least ids, and whether a query has it."""
    digest = F.concat(F.hex(F.xxhash64("vector")), F.hex(F.xxhash64(F.lit(1), "vector")))
    held = vectors.select("vec_id", "vector", digest.alias("digest"), is_query.alias("asked"))
    place = F.row_number().over(Window.partitionBy("digest").orderBy("vec_id"))
    least = held.drop("asked").withColumn("place", place).filter(F.col("place") <= k + 1).groupBy("digest").agg(
        F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("vector").alias("vector")
    )
    asked = held.filter("asked").groupBy("digest").agg(F.lit(True).alias("asked"))
    # Bands meet at sqrt(1/2) times powers of two, away from vectors of norm one.
    band = F.floor(F.log2(_norm(F.col("vector"))) + 0.5).cast("int")
    return least.join(asked, "digest", "left").select(
        F.col("ids")[0].alias("point"), "ids", "vector", "digest", F.size("vector").alias("width"), band.alias("band"),
        F.coalesce("asked", F.lit(False)).alias("asked"),
    )


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Number along the Hilbert curve of each row of grid coordinates below 2^bits."""
    axes = [column.astype(np.int64) for column in cells.T]
    for bit in (1 << b for b in range(bits - 1, 0, -1)):
        low = bit - 1
        for i in range(len(axes)):
            high = axes[i] & bit != 0
            swap = np.where(high, 0, (axes[0] ^ axes[i]) & low)
            axes[0] = axes[0] ^ np.where(high, low, swap)
            if i:
                axes[i] = axes[i] ^ swap
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    flip = np.zeros_like(axes[0])
    for bit in (1 << b for b in range(bits - 1, 0, -1)):
        flip ^= np.where(axes[-1] & bit != 0, bit - 1, 0)
    number = np.zeros_like(axes[0])
    for b in range(bits - 1, -1, -1):
        for axis in axes:
            number = number << 1 | ((axis ^ flip) >> b & 1)
    return number


def directions(width: int, curve: int) -> tuple[np.ndarray, np.ndarray]:
    """Random orthonormal directions over ``width`` components and one more, and the curve's shift."""
    pick = np.random.default_rng([SEED, width, curve])
    many = min(DIRECTIONS, width + 1)
    basis = np.linalg.qr(pick.normal(size=(width + 1, many)))[0]
    return basis, pick.random(many)


def projections(vectors: np.ndarray, norm: float, curves: int, asks: bool) -> list[np.ndarray]:
    """Coordinates of vectors, or of queries, on the sphere of ``norm``, for each curve."""
    if asks:
        on = np.c_[vectors * (norm / np.sqrt((vectors * vectors).sum(1)))[:, None], np.zeros(len(vectors))]
    else:
        on = np.c_[vectors, np.sqrt(np.maximum(norm * norm - (vectors * vectors).sum(1), 0))]
    return [on @ directions(vectors.shape[1], c)[0] for c in range(curves)]


class Grid:
    """Size, largest norm and quantiles of each length of vectors and norm band."""

    def __init__(self, bands: dict[tuple[int, int], tuple[int, float]], curves: int):
        self.bands, self.curves = bands, curves
        self.edges: dict[tuple[int, int], list[np.ndarray]] = {}

    def fit(self, key: tuple[int, int], vectors: np.ndarray) -> None:
        levels = np.linspace(0, 1, (1 << BITS) + 1)
        along = projections(vectors, self.bands[key][1], self.curves, False)
        self.edges[key] = [np.quantile(x, levels, axis=0) for x in along]

    def numbers(self, key: tuple[int, int], vectors: np.ndarray, asks: bool) -> np.ndarray:
        """Place of each vector along each curve."""
        out = []
        for curve, x in enumerate(projections(vectors, self.bands[key][1], self.curves, asks)):
            edges, shift = self.edges[key][curve], directions(vectors.shape[1], curve)[1]
            spread = [np.searchsorted(edges[:, j], x[:, j]) / len(edges) for j in range(x.shape[1])]
            cells = ((np.stack(spread, 1) + shift) / 2 * (1 << BITS)).astype(np.int64)
            out.append(hilbert(np.clip(cells, 0, (1 << BITS) - 1), BITS))
        return np.stack(out, 1)

    def block(self, key: tuple[int, int]) -> tuple[int, int]:
        """Points of a block, and how many blocks to either side a query meets."""
        wide = max(LEAST_BLOCK, math.ceil(self.bands[key][0] ** (2 / 3)))
        return min(wide, MOST_BLOCK), -(-wide // MOST_BLOCK)


def fit_grid(held: DataFrame, curves: int = CURVES) -> Grid:
    sizes = held.groupBy("width", "band").agg(F.count("*").alias("many"), F.max(_norm(F.col("vector"))).alias("norm"))
    grid = Grid({(r["width"], r["band"]): (r["many"], r["norm"]) for r in sizes.collect()}, curves)
    place = F.row_number().over(Window.partitionBy("width", "band").orderBy(F.xxhash64("point"), "point"))
    for width, band in grid.bands:
        of = held.filter((F.col("width") == width) & (F.col("band") == band))
        sample = of.withColumn("nth", place).filter(F.col("nth") <= SAMPLE).select("vector").collect()
        grid.fit((width, band), np.array([r["vector"] for r in sample], np.float64))
    return grid


def entries(held: DataFrame, grid: Grid) -> DataFrame:
    """Every point on every curve, and every query's point on every curve of every band of its length."""
    shared = held.sparkSession.sparkContext.broadcast(grid)
    schema = arrow_schema(_ENTRY)

    def codes(vectors: np.ndarray) -> list[bytes]:
        """8-bit components with the step before them."""
        step = np.abs(vectors).max(1) / 127
        whole = np.rint(vectors / step[:, None]).astype(np.int8)
        return [s.tobytes() + row.tobytes() for s, row in zip(step.astype("<f8"), whole)]

    def rows(key: tuple[int, int], ids: np.ndarray, vectors: np.ndarray, asks: bool) -> pa.RecordBatch:
        own, curves = shared.value, shared.value.curves
        places, many = own.numbers(key, vectors, asks), len(ids) * curves
        return record_batch([
            np.full(many, key[0], np.int32), np.full(many, key[1], np.int32),
            np.tile(np.arange(curves, dtype=np.int32), len(ids)), places.ravel(), np.full(many, asks),
            np.repeat(ids, curves), [c for c in codes(vectors) for _ in range(curves)],
        ], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            point, width, band, asked = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            lists = batch.column(4)
            starts, flat = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py(), lists.flatten().to_numpy()
            for key in sorted(set(zip(width.tolist(), band.tolist()))):
                own = np.flatnonzero((width == key[0]) & (band == key[1]))
                vectors = flat[starts[own][:, None] + np.arange(key[0])].astype(np.float64)
                yield rows(key, point[own], vectors, False)
                asking = asked[own]
                for other in shared.value.bands:
                    if asking.any() and other[0] == key[0]:
                        yield rows(other, point[own][asking], vectors[asking], True)

    return map_arrow(held.select("point", "width", "band", "asked", "vector"), run, _ENTRY)


def blocks(placed: DataFrame, grid: Grid) -> DataFrame:
    """The entries with their block; a query's entry once for each block that it meets."""
    order = ["width", "band", "curve", "place", "asks", "point"]
    ddl = f"{_ENTRY}, part int, nth bigint"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Numbers the points of each curve within the partition, whose rows come sorted."""
        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            width, band, curve, asks = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2, 4))
            starts = np.flatnonzero(np.r_[True, (np.diff(width) != 0) | (np.diff(band) != 0) | (np.diff(curve) != 0)])
            nth = np.zeros(len(batch), np.int64)
            for i, j in zip(starts, np.r_[starts[1:], len(batch)]):
                key = int(width[i]), int(band[i]), int(curve[i])
                upto = seen.get(key, 0) + np.cumsum(~asks[i:j])
                nth[i:j] = upto - ~asks[i:j]
                seen[key] = int(upto[-1])
            yield record_batch([*batch.columns, np.full(len(batch), part, np.int32), nth], schema)

    ranged = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = stored(map_arrow(ranged, run, ddl), "curves")
    counts = numbered.groupBy("part", "width", "band", "curve").agg(F.count_if(~F.col("asks")).alias("many")).collect()
    upto: dict[tuple[int, int, int], int] = {}
    firsts = []  # by partition and curve, how many points of the curve lie in earlier partitions
    for part, *key, many in sorted(map(tuple, counts)):
        first = upto.get(tuple(key), 0)
        firsts.append((part, *key, first))
        upto[tuple(key)] = first + many
    sized = {key: grid.block(key) for key in grid.bands}
    rows = []
    for part, width, band, curve, first in firsts:
        wide, reach = sized[width, band]
        rows.append((part, width, band, curve, first, wide, reach, -(-upto[width, band, curve] // wide)))
    known = numbered.sparkSession.createDataFrame(
        rows, "part int, width int, band int, curve int, first bigint, wide bigint, reach bigint, blocks bigint"
    )
    own = F.least(F.floor((F.col("first") + F.col("nth")) / F.col("wide")), F.col("blocks") - 1).cast("bigint")
    met = F.sequence(F.greatest(own - F.col("reach"), F.lit(0)), F.least(own + F.col("reach"), F.col("blocks") - 1))
    chosen = F.when(F.col("asks"), met).otherwise(F.array(own))
    # One row per sorted partition and curve: as many as shuffle partitions and curves, whatever the data.
    return numbered.join(F.broadcast(known), ["part", "width", "band", "curve"]).select(
        "width", "band", "curve", F.explode(chosen).alias("block"), "asks", "point", "code"
    )


def _nearest(table: pa.Table, kept: int) -> pa.Table:
    """Per query of one block the ``kept`` points of the largest inner product of codes."""
    asks = table.column("asks").to_numpy(zero_copy_only=False)
    ids = table.column("point").to_numpy()
    raw = np.frombuffer(b"".join(table.column("code").to_pylist()), np.uint8).reshape(len(ids), -1)
    step, whole = raw[:, :8].copy().view("<f8").ravel(), raw[:, 8:].view(np.int8).astype(np.float32)
    q, v = np.flatnonzero(asks), np.flatnonzero(~asks)
    found = []
    for i in range(0, len(q) if len(v) else 0, 256):
        some = q[i : i + 256]
        scores = (whole[some] @ whole[v].T).astype(np.float64) * step[some][:, None] * step[v]
        best = np.argpartition(-scores, min(kept, len(v)) - 1, axis=1)[:, :kept]
        found.append((np.repeat(ids[some], best.shape[1]), ids[v][best].ravel(), np.take_along_axis(scores, best, 1).ravel()))
    columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
    return pa.table([pa.array(c) for c in columns], schema=arrow_schema(_NEAR))


def candidates(met: DataFrame, kept: int = KEPT) -> DataFrame:
    """Per query's point the ``kept`` points that look nearest over all curves."""
    ship(met.sparkSession)
    near = met.groupBy("width", "band", "curve", "block").applyInArrow(lambda t: _nearest(t, kept), _NEAR)
    once = near.repartition("query").groupBy("query", "point").agg(F.max("likeness").alias("likeness"))
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("likeness"), "point"))
    return once.withColumn("nth", place).filter(F.col("nth") <= kept).select("query", "point")


def nearest(rows: DataFrame, is_query: Column, k: int = K, curves: int = CURVES) -> DataFrame:
    """query_id, rank from 1, vec_id and score of the ``k`` nearest rows found for each query."""
    vectors = stored(whole_vectors(rows), "vectors")
    held = stored(points(vectors, is_query, k), "points")
    grid = fit_grid(held, curves)
    near = candidates(blocks(entries(held, grid), grid), max(KEPT, k + 1))
    # Scores of a point's queries with other points, each sum taken in the order of the components.
    product = F.aggregate(
        F.zip_with("vector", "other", lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x
    )
    scored = (
        near.join(held.select("point", "ids", F.col("vector").alias("other")), "point")
        .join(held.select(F.col("point").alias("query"), "digest", "vector"), "query")
        .select("query", "digest", F.explode("ids").alias("vec_id"), product.alias("score"))
    )
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    best = scored.withColumn("nth", place).filter(F.col("nth") <= k + 1).groupBy("query", "digest").agg(
        F.sort_array(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("best")
    )
    # Every query of the point: the same list without its own id.
    digest = F.concat(F.hex(F.xxhash64("vector")), F.hex(F.xxhash64(F.lit(1), "vector")))
    asking = vectors.filter(is_query).select(F.col("vec_id").alias("query_id"), digest.alias("digest"))
    others = F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("query_id")), 1, k)
    return asking.join(best, "digest").select("query_id", F.posexplode(others).alias("nth", "found")).select(
        "query_id", (F.col("nth") + 1).cast("int").alias("rank"), F.col("found.vec_id").alias("vec_id"),
        F.col("found.score").alias("score"),
    )
