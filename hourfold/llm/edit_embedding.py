"""Document fingerprints from a randomised embedding of edit distance into Hamming distance.

A pointer walks over the characters of a text. At each step of the walk the embedding takes the
pointer's place, and a random bit, shared by all texts and set by the step and the character there,
says whether the pointer moves on. Two walks over texts with few edits fall into step again soon
after each edit, so the embeddings differ in few places. The fingerprint samples the embedding: all of
the first ``SAMPLES`` steps, then as many random steps of each following octave, so that texts of any
length share their samples; each is four bits of a hash of the three characters at the pointer,
written as a hexadecimal digit. Samples weigh as many steps as they stand for. A text's walk ends
with its last character; a fingerprint ends there too.

All walks of a batch go in lockstep, one NumPy operation per step for all of them.

Near-duplicates are found by banding: bands are windows of the fingerprints of ``WALKS`` independent walks,
documents that agree in one are candidates, and every pair of candidates is verified by edit distance,
computed by bit-parallel rows. Edits all over a text put walks out of step, so a low likeness of two
fingerprints rules nothing out; what stays are stretches of neighbouring samples.

Defined results: null text is empty text, with an empty fingerprint, which is like itself only; equal
texts have equal fingerprints. Documents are ordered by doc_id (null first), rows that share it by a
hash of their text; the next document of the last one is the first. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from ..sinks.files import stored
from . import links
from .tasks import arrow_schema, map_arrow, map_batches, record_batch, ship, slices

#: Samples of the first steps and of each octave.
SAMPLES = 64
OCTAVES = 24
#: Steps after which the random bits come again.
PERIOD = 1 << 14
_CLASSES = 256
#: Characters of texts that walk together, in a task.
TOGETHER = 6_000_000
#: Walks whose fingerprints are banded, digits of a band, and digits from one band to the next.
WALKS, BAND_DIGITS, BAND_STEP = 2, 8, 4
SIMILARITY = 0.8
_DEALT = "range bigint, behind boolean, doc_id bigint, order bigint, tie bigint, packed binary"
_LEAST = -(2**63)  # in the place of a null doc_id
_END = 255  # a sample beyond the text
_DIGITS = np.frombuffer(b"0123456789abcdef", np.uint8)
_VALUES = np.full(256, _END, np.uint8)
_VALUES[_DIGITS] = np.arange(16)


class Walk:
    """The shared randomness."""

    def __init__(self, seed: int = 20):
        random = np.random.default_rng(seed)
        # int64, so that a step is a plain addition
        self.moves = random.integers(0, 2, (PERIOD, _CLASSES), dtype=np.int64)
        self.moves[-1] = 1  # no character holds the pointer for a whole period
        steps = [np.arange(SAMPLES)]
        for octave in range(OCTAVES):
            first = SAMPLES << octave
            steps.append(first + np.sort(random.choice(first, SAMPLES, replace=False)))
        self.steps = np.concatenate(steps)
        self.weights = np.r_[np.ones(SAMPLES), np.repeat(2.0 ** np.arange(OCTAVES), SAMPLES)]
        self.salts = random.integers(0, 1 << 32, (len(self.steps), 2), dtype=np.uint32) | np.uint32(1)

    def samples(self, texts: list[str]) -> np.ndarray:
        """A row of samples per text."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        order = np.argsort(-lengths, kind="stable")
        # Behind each text two empty places; a pointer may run on until the next round-up.
        joined = "\0\0".join(texts) + "\0" * 130
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        grams = codes * np.uint32(2654435761)
        grams[:-1] += codes[1:] * np.uint32(2246822519)
        grams[:-2] += codes[2:] * np.uint32(3266489917)
        grams ^= grams >> np.uint32(15)
        classes = (codes * np.uint32(2654435761) >> np.uint32(24)).astype(np.uint8)
        starts = np.r_[0, np.cumsum(lengths + 2)[:-1]]
        found = np.full((len(self.steps), len(texts)), _END, np.uint8)
        who = order[lengths[order] > 0]
        at, ends = starts[who], (starts + lengths)[who]
        own, move = np.empty(len(who), np.uint8), np.empty(len(who), np.int64)
        step = sample = 0
        while len(who):
            for step in range(step, step + 64):
                if sample < len(self.steps) and step == self.steps[sample]:
                    inside = at < ends
                    gram = (grams[at] ^ self.salts[sample, 0]) * self.salts[sample, 1]
                    found[sample, who] = np.where(inside, gram >> np.uint32(28), _END)
                    sample += 1
                np.take(classes, at, out=own, mode="clip")
                np.take(self.moves[step % PERIOD], own, out=move, mode="clip")
                np.add(at, move, out=at)
            step += 1
            going = at < ends
            if not going.all():
                who, at, ends = who[going], at[going], ends[going]
                own, move = own[: len(who)], move[: len(who)]
        return np.ascontiguousarray(found.T)

    def text(self, samples: np.ndarray) -> str:
        inside = samples[samples != _END]
        return _DIGITS[inside].tobytes().decode()

    def likeness(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of rows of samples: the share of steps in which embeddings agree, less the agreement by chance."""
        either = (a != _END) | (b != _END)
        equal = (a == b) & (a != _END)
        weights = self.weights[: a.shape[1]]
        total = either @ weights
        share = np.divide(equal @ weights, total, out=np.ones(len(a)), where=total > 0)
        return np.clip((share - 1 / 16) / (15 / 16), 0, 1)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and the fingerprint of its text."""

    def columns(walk: Walk, texts: pa.Array) -> list:
        return [[walk.text(x) for x in walk.samples([t or "" for t in texts.to_pylist()])]]

    return map_batches(docs.select("doc_id", "text"), shared_walk, columns, "fingerprint string")


def _in_order(docs: DataFrame) -> DataFrame:
    """Rows dealt into ranges of doc_id, each range sorted and followed by the first row of the next.

    That row has ``behind`` set; the last range is followed by the first row of all. Texts travel
    compressed. What goes through the driver is a cut and the key of the first row per range.
    """
    spark = docs.sparkSession
    ship(spark)
    order = F.coalesce(F.col("doc_id"), F.lit(_LEAST)).alias("order")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), order)
    rows = rows.withColumn("tie", F.xxhash64("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / parts for i in range(1, parts)]
    cuts = rows.agg(F.percentile_approx("order", shares, 100 * parts)).first()[0] if shares else None
    cuts = np.array(sorted(set(cuts or [])), np.int64)

    @F.pandas_udf("bigint")
    def range_of(order: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, order.to_numpy()))

    keyed = rows.select("order", "tie", range_of("order").alias("range"))
    first = keyed.groupBy("range").agg(F.min(F.struct("order", "tie")).alias("at")).collect()
    opening = sorted((r["range"], r["at"]["order"], r["at"]["tie"]) for r in first)
    before = {own[1:]: previous[0] for previous, own in zip([*opening[-1:], *opening], opening)}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row to its range, and the first row of a range also to the one before."""
        packer, schema = zstandard.ZstdCompressor(level=1), arrow_schema(_DEALT)
        for batch in batches:
            for part in slices(batch.column(3)):
                keys, orders, ties, texts = (c.slice(part.start, part.stop - part.start) for c in batch.columns)
                orders, ties = orders.to_pylist(), ties.to_pylist()
                previous = [before.get(x) for x in zip(orders, ties, strict=True)]
                again = [i for i, p in enumerate(previous) if p is not None]
                rows = np.r_[np.arange(len(orders)), again].astype(int).tolist()
                packed = [packer.compress(t.as_buffer()) for t in texts]
                keys = keys.to_pylist()
                yield record_batch([
                    np.searchsorted(cuts, orders).tolist() + [previous[i] for i in again],
                    [False] * len(orders) + [True] * len(again), *([c[i] for i in rows] for c in (keys, orders, ties, packed)),
                ], schema)

    dealt = map_arrow(rows.select("doc_id", "order", "tie", "text"), deal, _DEALT)
    return dealt.repartition(parts, "range").sortWithinPartitions("range", "behind", "order", "tie")


EDITED = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def edited(text: str, following: str) -> str:
    """The last half replaced by as much of the beginning of another text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how like they and the next one's are."""
    schema = arrow_schema(EDITED)

    def made(walk: Walk, rows: list[tuple]) -> pa.RecordBatch:
        """Of all rows but those that only follow; the last row only follows."""
        texts = [r[3] for r in rows]
        mine = [i for i in range(len(rows) - 1) if not rows[i][1]]
        changed = [edited(texts[i], texts[i + 1]) for i in mine]
        samples = walk.samples(texts + changed)
        own, other = samples[mine], samples[len(texts) :]
        after = samples[[i + 1 for i in mine]]
        return record_batch([
            [rows[i][2] for i in mine], [len(texts[i]) for i in mine],
            [hashlib.sha256(t.encode()).hexdigest() for t in changed],
            [walk.text(x) for x in own], [walk.text(x) for x in other],
            walk.likeness(own, other).tolist(), walk.likeness(own, after).tolist(),
        ], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, rows, size = shared_walk(), [], 0
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            for *row, packed in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                row.append(unpacker.decompress(packed).decode())
                if rows and rows[-1][1] and row[1] and rows[-1][0] == row[0]:
                    continue  # the row that follows, once more
                rows.append(row)
                size += 2 * len(row[3])
                if size > TOGETHER and len(rows) > 1:
                    yield made(walk, rows)
                    rows = rows[-1:]
                    size = 2 * len(row[3])
        if rows:
            yield made(walk, rows)

    ordered = _in_order(docs).select("range", "behind", "doc_id", "packed")
    return map_arrow(ordered, run, EDITED)


def edit_distance(a: str, b: str, most: int) -> int:
    """Levenshtein distance, or ``most`` + 1 if it is larger; one row of the table is two integers.

    The common beginning and end are left out first.
    """
    if abs(len(a) - len(b)) > most:
        return most + 1
    start, longest = 0, min(len(a), len(b))
    while start < longest and a[start] == b[start]:
        start += 1
    end = 0
    while end < longest - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    if not a or not b:
        return len(a) + len(b)
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full, last = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, distance = full, 0, len(a)
    for i, c in enumerate(b):
        same = places.get(c, 0)
        diagonal = ((same & up) + up ^ up) | same | down
        rises, falls = down | ~(diagonal | up) & full, diagonal & up
        distance += bool(rises & last) - bool(falls & last)
        if distance - (len(b) - 1 - i) > most:
            return most + 1
        rises = rises << 1 | 1
        up, down = (falls << 1 | ~(diagonal | rises)) & full, rises & diagonal & full
    return distance


def band_keys(fingerprint: str, walk: int, digits: int = BAND_DIGITS, step: int = BAND_STEP) -> list[int]:
    """A key per window of neighbouring samples, which edits upset together."""
    out = []
    for at in range(0, max(1, len(fingerprint) - digits + 1), step):
        key = f"{walk},{at},{fingerprint[at : at + digits]}"
        out.append(int.from_bytes(hashlib.blake2b(key.encode(), digest_size=8).digest(), "little", signed=True))
    return out


def linked(payloads: list[str], threshold: float = SIMILARITY) -> list[tuple[int, int]]:
    """Pairs of texts whose edit distance is at most (1 - threshold) of the longer one.

    A payload is a fingerprint, a line end and the text. Pairs are verified in descending order of their
    likeness, unless others connect them already.
    """
    prints, texts = zip(*(p.split("\n", 1) for p in payloads))
    walk, n = shared_walk(), len(texts)
    samples = np.full((n, max(map(len, prints), default=0)), _END, np.uint8)
    for row, own in zip(samples, prints, strict=True):
        row[: len(own)] = _VALUES[np.frombuffer(own.encode(), np.uint8)]
    close = []
    for i in range(n - 1):
        like = walk.likeness(np.broadcast_to(samples[i], samples[i + 1 :].shape), samples[i + 1 :])
        close += [(-x, i, i + 1 + k) for k, x in enumerate(like.tolist())]
    find, join = links.union_find(n)
    out = []
    for _, i, j in sorted(close):
        most = int((1 - threshold) * max(len(texts[i]), len(texts[j])) + 1e-9)
        if find(i) != find(j) and edit_distance(texts[i], texts[j], most) <= most:
            join(i, j)
            out.append((i, j))
    return out


@lru_cache(WALKS)
def shared_walk(walk: int = 0) -> Walk:
    return Walk(20 + walk)


def near_duplicate_classes(docs: DataFrame) -> DataFrame:
    """doc_id and class_id: components of the texts that bands bring together and edit distance verifies.

    A class is named by its smallest doc_id, null if none of its rows has one.
    """

    def columns(_: None, texts: pa.Array) -> list:
        texts = [t or "" for t in texts.to_pylist()]
        marks = [[w.text(x) for x in w.samples(texts)] for w in map(shared_walk, range(WALKS))]
        digests = [hashlib.md5(t.encode()).hexdigest() for t in texts]
        keys = [[key for walk, m in enumerate(own) for key in band_keys(m, walk)] for own in zip(*marks)]
        return [digests, keys, marks[0]]

    ddl = "digest string, keys array<bigint>, mark string"
    made = stored(map_batches(docs.select("doc_id", "text"), lambda: None, columns, ddl), "bands")
    nodes = made.groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), F.first("keys").alias("keys"), F.first("mark").alias("mark")
    )
    bands = nodes.select(F.explode("keys").alias("key"), F.col("digest").alias("id"))

    def payloads(ids: DataFrame) -> DataFrame:
        text = F.coalesce("text", F.lit(""))
        texts = docs.groupBy(F.md5(text).alias("id")).agg(F.first(text).alias("text"))
        marks = nodes.select(F.col("digest").alias("id"), "mark").join(ids, "id")
        return texts.join(marks, "id").select("id", F.concat_ws("\n", "mark", "text").alias("payload"))

    roots = links.components(links.verified_links(links.groups(bands), payloads, linked))
    named = nodes.join(roots.withColumnRenamed("id", "digest"), "digest", "left").select(
        "digest", "doc_id", F.coalesce("root", "digest").alias("root")
    )
    classes = named.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return made.select("doc_id", "digest").join(
        named.join(classes, "root").select("digest", "class_id"), "digest"
    ).select("doc_id", "class_id")
