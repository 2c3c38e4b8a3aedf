"""BPE encoding and decoding with a pair occurrence index.

A task gathers the different words of its batch, lays their symbols side by side in one array and
indexes every adjacent pair by its merge rank: rank -> all positions where the pair stands. Ranks
are taken in ascending order from a heap; a rank's positions are merged all at once, and the pairs
that arise left and right of them are added to the lists of their ranks. A merge's parts are always
made by earlier merges (checked when the vocabulary is read), so no list is needed again once its
rank is done, and the result equals merging each word by itself.

Vocabularies are files of the tokenizers library (BPE model with an end-of-word suffix, NFC and
lower case, byte-level symbols); the path is a parameter and must be readable on every executor.

Defined results: null text is empty text; empty text has no ids and decodes to empty text; the
strings of special tokens become their ids wherever they stand; repeated rows give repeated results;
columns beyond doc_id and text are ignored. Characters assigned after Unicode 15.1 may be taken for
letters where the library doesn't know them yet.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterable
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from .tasks import Pieces, map_batches, slices

#: Different pieces whose ids a worker remembers, about 200 bytes each.
REMEMBERED = 1_000_000
_NONE = np.iinfo(np.int64).max


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if printable, else one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Symbols, merges and special tokens of one file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or spec.get("decoder") or model["unk_token"]:
            raise ValueError(f"{path}: not a vocabulary of the kind this module encodes with")
        ids, suffix = model["vocab"], model["end_of_word_suffix"]
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pieces = [""] * (max([*ids.values(), *self.special.values()]) + 1)
        for piece, i in [*ids.items(), *self.special.items()]:
            self.pieces[i] = piece
        symbols = byte_symbols()
        self.inner = np.array([ids[s] for s in symbols], np.int32)
        self.last = np.array([ids[s + suffix] for s in symbols], np.int32)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.left = np.array([ids[a] for a, _ in merges], np.int64)
        self.right = np.array([ids[b] for _, b in merges], np.int64)
        self.made = np.array([ids[a + b] for a, b in merges], np.int64)
        first = np.full(len(self.pieces), -1)
        first[self.made[::-1]] = np.arange(len(merges))[::-1]
        rank = np.arange(len(merges))
        if len(set(self.made.tolist())) < len(merges) or (
            np.maximum(first[self.left], first[self.right]) >= rank
        ).any():
            raise ValueError(f"{path}: a merge comes before one that makes its parts")
        codes = self.left << 32 | self.right
        self._order = np.argsort(codes)
        self._codes = codes[self._order]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, _NONE where there is none."""
        codes = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self._codes, codes), len(self._codes) - 1)
        return np.where(self._codes[at] == codes, self._order[at], _NONE)


def _by_rank(ranks: np.ndarray, positions: np.ndarray) -> Iterable[tuple[int, np.ndarray]]:
    """The positions of each rank."""
    known = ranks != _NONE
    ranks, positions = ranks[known], positions[known]
    if not len(ranks):
        return
    order = np.argsort(ranks, kind="stable")
    ranks, positions = ranks[order], positions[order]
    starts = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1]])
    yield from zip(ranks[starts].tolist(), np.split(positions, starts[1:]), strict=True)


def merge_words(vocabulary: Vocabulary, words: list[bytes]) -> list[bytes]:
    """The ids of each word as little-endian unsigned 32-bit integers; words aren't empty."""
    if not words:
        return []
    data = np.frombuffer(b"".join(words), np.uint8)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes)
    starts, n = ends - sizes, len(data)
    # Position n stands for "no neighbour"; its symbol is in no pair.
    token = np.append(vocabulary.inner[data].astype(np.int64), -1)
    token[ends - 1] = vocabulary.last[data[ends - 1]]
    after, before = np.arange(1, n + 2), np.arange(-1, n)
    after[ends - 1] = n
    before[starts] = n

    touched = np.full(n + 1, -1)
    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def add(positions: np.ndarray) -> None:
        found = vocabulary.ranks(token[positions], token[after[positions]])
        for rank, where in _by_rank(found, positions):
            if rank not in index:
                index[rank] = []
                heapq.heappush(active, rank)
            index[rank].append(where)

    inside = np.arange(n)
    add(inside[after[:n] < n])
    while active:
        rank = heapq.heappop(active)
        at = np.concatenate(index.pop(rank))
        left, right = vocabulary.left[rank], vocabulary.right[rank]
        second = after[at]
        stands = (token[at] == left) & (token[second] == right)
        at, second = at[stands], second[stands]
        if left == right and len(at) > 1:  # in a run of equal symbols every other pair counts
            order = np.argsort(at)
            at, second = at[order], second[order]
            opens = np.r_[True, second[:-1] != at[1:]]
            first = np.maximum.accumulate(np.where(opens, np.arange(len(at)), 0))
            taken = (np.arange(len(at)) - first) % 2 == 0
            at, second = at[taken], second[taken]
        if not len(at):
            continue
        following = after[second]
        token[at], token[second] = vocabulary.made[rank], -1
        after[at] = following
        before[following] = at
        # A position comes once into a list: a symbol just made may be the one before another.
        touched[at] = rank
        previous = before[at]
        add(np.concatenate([previous[(previous < n) & (touched[previous] != rank)], at[following < n]]))

    kept = token[:n] >= 0
    counts = np.add.reduceat(kept, starts, dtype=np.int64)
    ids = token[:n][kept].astype("<u4").tobytes()
    stops = (np.cumsum(counts) * 4).tolist()
    return [ids[a:b] for a, b in zip([0, *stops], stops)]


class Encoder:
    """Encodes texts; remembers the ids of pieces between white space."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._pieces = Pieces(self._learn, "<u4", REMEMBERED)
        self._special = regex.compile("|".join(map(regex.escape, vocabulary.special)) or r"(?!)")
        self._lines = regex.compile(vocabulary.words.pattern + r"|\n")

    def _normal(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        # Each character by itself: a sigma at the end of a word is an ordinary one.
        return "".join(map(str.lower, text)) if "Σ" in text else text.lower()

    def _learn(self, pieces: list[str]) -> list[bytes]:
        """No piece holds a line end, so they are normalised and split in one go, a line each."""
        split = self._lines.findall(self._normal("\n".join(pieces)))
        words = dict.fromkeys(split)
        words.pop("\n", None)
        ids = dict(zip(words, merge_words(self.vocabulary, [w.encode() for w in words]), strict=True))
        ids["\n"] = b""
        ends = [i for i, w in enumerate(split) if w == "\n"]
        parts = list(map(ids.__getitem__, split))
        return [b"".join(parts[i:j]) for i, j in zip([0, *ends], [*ends, len(split)], strict=True)]

    def encode(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        """Ids of each text, unsigned 32-bit; null is empty text."""
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        out: list[np.ndarray] = []
        for at in slices(texts):
            part = texts.slice(at.start, at.stop - at.start)
            made = self._pieces.of(part)
            for mark in {s[:2] for s in self.vocabulary.special}:
                held = pc.fill_null(pc.match_substring(part, mark), False)
                for i in np.flatnonzero(held.to_numpy(zero_copy_only=False)):
                    made[i] = self._with_special(part[int(i)].as_py())
            out += made
        return out

    def _with_special(self, text: str) -> np.ndarray:
        """Special tokens are found before the text is normalised."""
        marks = [m.span() for m in self._special.finditer(text)]
        between = zip([0, *(b for _, b in marks)], [*(a for a, _ in marks), len(text)], strict=True)
        plain = self._pieces.of(pa.array([text[a:b] for a, b in between], pa.string()))
        own = [np.array([self.vocabulary.special[text[a:b]]], np.uint32) for a, b in marks]
        return np.concatenate([x for pair in zip(plain, [*own, plain[0][:0]], strict=True) for x in pair])

    def decode(self, ids: np.ndarray) -> str:
        return " ".join(map(self.vocabulary.pieces.__getitem__, ids.tolist()))


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """One per Python worker and vocabulary, so that tasks of a worker share what is remembered."""
    return Encoder(Vocabulary(path))


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and the ids of its text."""

    def columns(own: Encoder, texts: pa.Array) -> list:
        return [pa.array([x.view("<i4") for x in own.encode(texts)], pa.list_(pa.int32()))]

    return map_batches(docs.select("doc_id", "text"), partial(encoder, path), columns, "ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the text of its ids, symbols joined by a space; null ids give a null text."""

    def columns(own: Encoder, ids: pa.Array) -> list:
        return [[None if x is None else own.decode(np.array(x, np.int64)) for x in ids.to_pylist()]]

    return map_batches(encoded.select("doc_id", "ids"), partial(encoder, path), columns, "text string")


def round_trip_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the text they decode to."""

    def columns(own: Encoder, texts: pa.Array) -> list:
        ids = own.encode(texts)
        sha = hashlib.sha256
        return [
            list(map(len, ids)), [sha(x).hexdigest() for x in ids],
            [sha(own.decode(x).encode()).hexdigest() for x in ids],
        ]

    return map_batches(
        docs.select("doc_id", "text"), partial(encoder, path), columns,
        "n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    )
