"""Scores of documents by the difference of two cross-entropies.

Two models of the same kind are counted over the ids of one vocabulary: single ids, and pairs of
neighbours. The target model is counted over the documents with a good
label, the background model over all documents. The models are matched: the background's
counts are scaled to the target's number of tokens, so smoothing weighs the same in both. A
document's score is the mean over its tokens of the target's loss less the background's: the lower,
the more the document is like the target. A document is scored without itself: its own counts are
taken out of both models first.

The counts cover every document, and every document is scored. Counts of single ids are as many as the
vocabulary and are broadcast. Counts of pairs are exact and grow with the input, so they stay a table:
documents are dealt into blocks of about ``BLOCK`` ids, each block names each of its pairs once with
its own counts, the counts of a pair are summed over the blocks, and each block gets the sums of its
own pairs back. The most common pair is a row per block.

Defined results: null or empty texts have no tokens and a null score; without a labelled document the
target model is uniform; documents with several labels are targets if one of them is good; repeated
rows count as often as they occur; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ..sinks.files import stored
from .bpe import encoder
from .tasks import arrow_schema, map_arrow, record_batch, ship, slices

#: Ids of the documents that are counted and scored together; a document of more is alone.
BLOCK = 1 << 22
#: Weight of the pair estimate against that of the single id.
PAIR_WEIGHT = 0.6
#: Added to every count of a single id.
SMOOTHING = 0.1
_ENCODED = "doc_id bigint, is_target boolean, ids binary, block bigint"
_COUNTS = "place int, target bigint, background bigint"
_PAIRS = "block bigint, pair bigint, target bigint, background bigint"
_SENT = 1 << 16  # rows of a batch of pairs
SCORES = (
    "doc_id bigint, n_tokens bigint, is_target boolean, target_loss double, background_loss double, "
    "score double"
)


def pair_places(ids: np.ndarray) -> np.ndarray:
    """A number for each pair of neighbours, equal for equal pairs only."""
    return (ids[:-1].astype(np.uint64) << np.uint64(32) | ids[1:].astype(np.uint64)).view(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The task's documents with the number of their block in place of that of their ids."""
    number, held = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        blocks = []
        for many in batch.column(3).to_pylist():
            if held and held + many > most:
                number, held = number + 1, 0
            held += many + 1  # empty documents fill a block too
            blocks.append(number)
        yield record_batch([*batch.columns[:3], blocks], arrow_schema(_ENCODED))


def encoded(docs: DataFrame, labels: DataFrame, path: str, most: int = BLOCK) -> DataFrame:
    """doc_id, is_target, the packed ids and the block of every document, written once.

    Labels meet the packed ids rather than the texts, and by the same join whatever their number.
    """
    ddl = "doc_id bigint, ids binary, many bigint"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, packer = encoder(path), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in slices(batch.column(1)):
                keys, texts = (c.slice(part.start, part.stop - part.start) for c in batch.columns)
                ids = own.encode(texts)
                yield record_batch([keys, [packer.compress(x) for x in ids], list(map(len, ids))], schema)

    ids = map_arrow(docs.select("doc_id", "text"), run, ddl)
    good = labels.filter("quality = 1").select("doc_id").distinct().withColumn("is_target", F.lit(True))
    is_target = F.coalesce("is_target", F.lit(False)).alias("is_target")
    named = ids.join(good.hint("merge"), "doc_id", "left").select("doc_id", is_target, "ids", "many")
    return stored(map_arrow(named, partial(_blocks, most=most), _ENCODED), "ids")


def _unpacked(packed: pa.Array | pa.ChunkedArray) -> Iterator[np.ndarray]:
    unpacker = zstandard.ZstdDecompressor()
    return (np.frombuffer(unpacker.decompress(x.as_buffer()), "<u4") for x in packed)


def _count(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Counts of the single ids of the task's documents."""
    counts = np.zeros((2, size), np.int64)
    for batch in batches:
        for target, ids in zip(batch.column(0).to_pylist(), _unpacked(batch.column(1)), strict=True):
            np.add.at(counts[1], ids, 1)
            if target:
                np.add.at(counts[0], ids, 1)
    held = np.flatnonzero(counts[1])
    yield record_batch([held.astype(np.int32), counts[0, held], counts[1, held]], arrow_schema(_COUNTS))


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the pairs of each block; a block that is read in parts gives a pair's counts in parts."""
    rows = (
        row for batch in batches
        for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _unpacked(batch.column(2)), strict=True)
    )
    for block, members in groupby(rows, itemgetter(0)):
        found = [(target, pair_places(ids)) for _, target, ids in members]
        pairs, background = np.unique(np.concatenate([p for _, p in found]), return_counts=True)
        held, many = np.unique(np.concatenate([p for t, p in found if t] or [pairs[:0]]), return_counts=True)
        target = np.zeros(len(pairs), np.int64)
        target[np.searchsorted(pairs, held)] = many
        for at in range(0, len(pairs), _SENT):
            part = slice(at, at + _SENT)
            blocks = np.full(len(pairs[part]), block)
            yield record_batch([blocks, pairs[part], target[part], background[part]], arrow_schema(_PAIRS))


class Models:
    """Counts of single ids in both models, [target, background] first."""

    def __init__(self, single: np.ndarray):
        self.single, self.tokens = single, single.sum(1)

    def losses(self, ids: np.ndarray, is_target: bool, pairs: np.ndarray, totals: np.ndarray) -> tuple[float, float]:
        """Mean loss per token of a document under each model without it.

        ``totals`` are the counts in both models of ``pairs``, which ascend and hold those of the document.
        """
        size = self.single.shape[1]
        _, at, own = np.unique(ids, return_inverse=True, return_counts=True)
        held, pair_at, pair_own = np.unique(pair_places(ids), return_inverse=True, return_counts=True)
        totals = totals[:, np.searchsorted(pairs, held)]
        out = []
        goal = max(1, self.tokens[0] - (len(ids) if is_target else 0))
        for row in (0, 1):
            mine = row == 1 or is_target
            tokens = self.tokens[row] - mine * len(ids)
            scale = goal / max(1, tokens)
            single = (self.single[row, ids] - mine * own[at]) * scale
            both = ((totals[row] - mine * pair_own) * scale)[pair_at]
            alone = (single + SMOOTHING) / (tokens * scale + SMOOTHING * size)
            before = single[:-1]
            follows = np.where(before > 0, both / np.maximum(before, 1e-9), alone[1:])
            likely = np.r_[alone[:1], PAIR_WEIGHT * follows + (1 - PAIR_WEIGHT) * alone[1:]]
            out.append(float(-np.log(likely).mean()))
        return out[0], out[1]


def train(texts: DataFrame, size: int) -> Models:
    """Over all rows of ``encoded()``, ids of a vocabulary of ``size``."""
    counted = map_arrow(texts.select("is_target", "ids"), partial(_count, size=size), _COUNTS)
    table = counted.groupBy("place").agg(
        F.sum("target").alias("target"), F.sum("background").alias("background")
    ).toArrow()  # at most a row per id
    counts = np.zeros((2, size), np.int64)
    place = table["place"].to_numpy()
    counts[0, place], counts[1, place] = table["target"].to_numpy(), table["background"].to_numpy()
    return Models(counts)


def pair_totals(texts: DataFrame) -> DataFrame:
    """block, pair and the pair's counts over all blocks, for every pair of every block."""
    counted = map_arrow(texts.select("block", "is_target", "ids"), _count_pairs, _PAIRS)
    everywhere = Window.partitionBy("pair")
    return counted.select(
        "block", "pair", *(F.sum(c).over(everywhere).alias(c) for c in ("target", "background"))
    )


def score(texts: DataFrame, models: Models) -> DataFrame:
    ship(texts.sparkSession)
    shared = texts.sparkSession.sparkContext.broadcast(models)  # a number per id, twice
    schema = arrow_schema(SCORES)

    def run(docs: pa.Table, counts: pa.Table) -> pa.Table:
        pairs = counts["pair"].to_numpy()
        order = np.argsort(pairs)
        pairs = pairs[order]
        totals = np.stack([counts[c].to_numpy()[order] for c in ("target", "background")])
        targets, sizes, losses = docs["is_target"], [], []
        for target, ids in zip(targets.to_pylist(), _unpacked(docs["ids"]), strict=True):
            sizes.append(len(ids))
            losses.append(shared.value.losses(ids, target, pairs, totals) if len(ids) else (None, None))
        return pa.Table.from_batches([record_batch([
            docs["doc_id"].combine_chunks(), sizes, targets.combine_chunks(), [a for a, _ in losses],
            [b for _, b in losses], [None if a is None else a - b for a, b in losses],
        ], schema)])

    return texts.groupBy("block").cogroup(pair_totals(texts).groupBy("block")).applyInArrow(run, SCORES)


def cross_entropy_differences(docs: DataFrame, labels: DataFrame, path: str, block: int = BLOCK) -> DataFrame:
    texts = encoded(docs, labels, path, block)
    return score(texts, train(texts, len(encoder(path).vocabulary.pieces)))
