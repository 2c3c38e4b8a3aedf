"""Runs of repeated words in every text, and the text with the repetitions collapsed.

A run is a stretch of consecutive words with smallest period q that is at least ``TIMES`` periods and
``SHORTEST`` words long and that no neighbouring word extends. For each period q the grid of every q-th word
is laid over the text: a run of three periods holds three consecutive grid points, whose words are then
equal. Those triples, found on the whole grid of all periods (about n log n points), are extended to both
sides by longest common extensions. A stretch that several periods find belongs to the smallest.

Longest common extensions need no full suffix array. Of the suffixes only those that begin at places of a
difference cover modulo 31 are sorted (6 of 31); two places are compared word by word until both have
reached the cover, at most 30 words on, and the rest is the least common prefix between two places of the
sorted sample, by a sparse table. The structure is built for texts that have triples at all, once forwards
and once backwards.

Everything happens within the task that holds a text; memory is a small multiple of the longest text.

Defined results: null, empty and blank text has no words, no runs and collapses to an empty text; repeated
rows give repeated results; with ``planted`` (see there) a null doc_id plants nothing; columns beyond
doc_id and text are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .tasks import arrow_schema, map_arrow, record_batch, slices

SHORTEST, TIMES = 24, 3
#: A perfect difference set; every residue but 0 is the difference of just one pair.
COVER, MODULUS = (1, 5, 11, 24, 25, 27), 31
#: Grid points, and pairs of places, that are worked on at a time.
POINTS, PAIRS = 1 << 18, 1 << 16
RUNS = "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint"
_DDL = f"doc_id bigint, {RUNS}, runs_sha256 string, collapsed_sha256 string"


def _steps_to_cover() -> np.ndarray:
    """By two residues, the least number of steps after which both lie in the cover."""
    inside = np.isin(np.arange(2 * MODULUS) % MODULUS, COVER)
    steps = np.zeros((MODULUS, MODULUS), np.int64)
    for x in range(MODULUS):
        for y in range(MODULUS):
            steps[x, y] = np.flatnonzero(inside[x : x + MODULUS] & inside[y : y + MODULUS])[0]
    return steps


_STEPS = _steps_to_cover()


class Extensions:
    """Longest common extensions to the right of any two places of ``words``, an array of codes from 0."""

    def __init__(self, words: np.ndarray):
        n = self.n = len(words)
        self.padded = np.r_[words.astype(np.int64) + 1, np.zeros(MODULUS, np.int64)]  # 0 is past the end
        at = np.flatnonzero(np.isin(np.arange(n) % MODULUS, COVER))
        self.index = np.zeros(n + 1, np.int64)
        self.index[at] = np.arange(len(at))
        blocks = self.padded[at[:, None] + np.arange(MODULUS)]
        order = np.lexsort(blocks.T[::-1])
        new = (np.diff(blocks[order], axis=0) != 0).any(1)
        rank = np.empty(len(at), np.int64)
        rank[order] = np.cumsum(np.r_[0, new])[: len(at)]
        # A sample's next block begins at a sample again: double the blocks until all differ.
        levels, step = [rank], MODULUS
        while len(at) and rank.max() + 1 < len(at):
            after = at + step
            second = np.where(after < n, rank[self.index[np.minimum(after, n)]] + 1, 0)
            rank = np.unique(rank * (len(at) + 1) + second, return_inverse=True)[1]
            levels.append(rank)
            step *= 2
        self.rank = rank
        order = np.argsort(rank)
        self.table = [self._neighbours(at[order[:-1]], at[order[1:]], levels)]
        while 2 << (len(self.table) - 1) <= len(self.table[0]):
            half, last = 1 << (len(self.table) - 1), self.table[-1]
            self.table.append(np.minimum(last[:-half], last[half:]))

    def _neighbours(self, a: np.ndarray, b: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common words of the pairs of suffixes that stand next to each other in the sorted sample."""
        same = np.zeros(len(a), np.int64)
        for level in reversed(range(len(levels))):
            x, y, rank = a + same, b + same, levels[level]
            equal = (np.maximum(x, y) < self.n) & (rank[self.index[np.minimum(x, self.n)]] == rank[self.index[np.minimum(y, self.n)]])
            same += np.where(equal, MODULUS << level, 0)
        window = np.arange(MODULUS)
        for i in range(0, len(a), PAIRS):
            x, y = (a + same)[i : i + PAIRS], (b + same)[i : i + PAIRS]
            same[i : i + PAIRS] += (self.padded[x[:, None] + window] == self.padded[y[:, None] + window]).argmin(1)
        return same

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For pairs of different places up to the end, the number of words that agree from there on."""
        parts = [self._some(a[i : i + PAIRS], b[i : i + PAIRS]) for i in range(0, len(a), PAIRS)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def _some(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        steps = _STEPS[a % MODULUS, b % MODULUS]
        window = np.arange(MODULUS)
        equal = self.padded[a[:, None] + window] == self.padded[b[:, None] + window]
        equal |= window >= steps[:, None]
        out = np.where(equal.all(1), steps, equal.argmin(1))
        on = np.flatnonzero(equal.all(1) & (np.maximum(a, b) + steps < self.n))
        ranks = [self.rank[self.index[place[on] + steps[on]]] for place in (a, b)]
        low, high = np.minimum(*ranks), np.maximum(*ranks)
        power = np.frexp(high - low)[1] - 1  # of two, at most the distance
        for level in np.unique(power):
            own = power == level
            row = self.table[level]
            out[on[own]] += np.minimum(row[low[own]], row[high[own] - (1 << level)])
        return out


def grid(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places i and periods q with i a multiple of q and i + 2q < n, in slices of about ``POINTS``."""
    periods = np.arange(1, n // TIMES + 1)
    many = (n - 1) // periods - 1
    upto = np.r_[0, np.cumsum(many)]
    first = 0
    while first < len(periods):
        last = max(first + 1, int(np.searchsorted(upto, upto[first] + POINTS, "right")) - 1)
        period = np.repeat(periods[first:last], many[first:last])
        nth = np.arange(upto[last] - upto[first]) - np.repeat(upto[first:last] - upto[first], many[first:last])
        yield nth * period, period
        first = last


def runs(words: np.ndarray) -> np.ndarray:
    """Rows of start, length and period of every run of ``words``, by start, then period."""
    n, found = len(words), [np.zeros((0, 3), np.int64)]
    if n < SHORTEST:
        return found[0]
    ahead = back = None
    for place, period in grid(n):
        word = words[place]
        triple = np.flatnonzero((word == words[place + period]) & (word == words[place + 2 * period]))
        if not len(triple):
            continue
        if ahead is None:
            ahead, back = Extensions(words), Extensions(words[::-1])
        i, q = place[triple], period[triple]
        start = i - back(n - i - q, n - i)
        end = i + q + ahead(i, i + q)
        long = end - start >= np.maximum(SHORTEST, TIMES * q)
        found.append(np.unique(np.stack([start, end - start, q], 1)[long], axis=0))
    # By start, length and period: of the periods of one stretch the first is the smallest.
    every = np.unique(np.concatenate(found), axis=0)
    new = np.r_[True, (np.diff(every[:, :2], axis=0) != 0).any(1)][: len(every)]
    every = every[new]
    return every[np.lexsort((every[:, 2], every[:, 0]))]


def planted(words: np.ndarray, doc_id: int | None) -> np.ndarray:
    """The words, of a tenth of the ids with a stretch repeated from a place that the id gives to the end."""
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    first = g % n
    period = 1 + (n - first) // (3 + g % 8)
    return np.r_[words[:first], words[first + np.arange(n - first) % period]]


def collapsed(words: np.ndarray, of: np.ndarray) -> np.ndarray:
    """The words that no run holds behind its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, of[:, 0] + of[:, 2], 1)
    np.add.at(change, of[:, 0] + of[:, 1], -1)
    return words[np.cumsum(change[:-1]) == 0]


def strongest(of: np.ndarray) -> tuple[int, int, int, int] | tuple[None, None, None, None]:
    """Start, length, period and thousandths of length / period of the run that repeats most often."""
    if not len(of):
        return None, None, None, None
    start, length, period = max(of.tolist(), key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))
    return start, length, period, 1000 * length // period


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Codes of all words in a row, where each text's words begin and end, and the words of the codes."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = split.flatten()
    real = pc.not_equal(flat, "")
    upto = np.r_[0, np.cumsum(real.to_numpy(zero_copy_only=False))]
    coded = flat.filter(real).dictionary_encode()
    offsets = split.offsets.to_numpy()
    return coded.indices.to_numpy(), upto[offsets - offsets[0]], coded.dictionary


def run_digests(docs: DataFrame, plant: bool = True) -> DataFrame:
    """Per document its number of runs, the strongest one, and digests of all runs and the collapsed text."""
    schema = arrow_schema(_DDL)

    def digest(data: bytes) -> str:
        return hashlib.sha256(data).hexdigest()

    def work(keys: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        codes, bounds, names = split_words(texts)
        rows, kept, at = [], [], bounds.tolist()
        for key, i, j in zip(keys.to_pylist(), at[:-1], at[1:], strict=True):
            words = planted(codes[i:j], key) if plant else codes[i:j]
            of = runs(words)
            kept.append(collapsed(words, of) if len(of) else words)
            listed = "".join(f"{start},{length},{period}\n" for start, length, period in of.tolist())
            rows.append((key, len(of), *strongest(of), digest(listed.encode())))
        held = names.take(pa.array(np.concatenate([np.zeros(0, np.int64), *kept])))
        lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, kept)]).astype(np.int32), held)
        texts = [digest(t.as_buffer()) for t in pc.binary_join(lists, " ").cast(pa.binary())]
        return record_batch([*map(list, zip(*rows, strict=True)), texts], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                yield work(*(c.slice(part.start, part.stop - part.start) for c in batch.columns))

    return map_arrow(docs.select("doc_id", "text"), run, _DDL)
