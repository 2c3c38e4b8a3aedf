"""Language identification by mixtures: expectation-maximisation over a document's words.

Training counts, per language, the three-letter windows of words (letters in lower case, with a mark
before and after each word), hashed into ``BUCKETS``. A piece of text has a likelihood under each
language, from its windows. A document is a mixture of languages: EM estimates the proportions from
the likelihoods of its pieces. Languages enter the document's set one at a time, the one that gains
most first, as long as the gain in log likelihood exceeds a penalty; the language with the largest
proportion is the prediction, its share of the document's letters the score.

Window likelihoods overlap, and so count each letter up to three times; they are divided by three.

Learned from: documents of the training folds with a language and a text. Nothing but the text is
looked at in predictions. The model has ``BUCKETS`` numbers per language, whatever the input; its
counts cover all training documents.

Defined results: a text that is null or has no letter, or a model that has learned no language, give
``und`` and 0; ties go to the language that comes first by name; rows that are repeated are
counted and predicted as often; a null doc_id belongs to no fold: such rows train nothing and are not
held out; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .tasks import Pieces, arrow_schema, map_arrow, record_batch, ship, slices

BUCKETS = 1 << 16
FOLDS = 5
UNDETERMINED = "und"
#: Added to every count.
SMOOTHING = 0.2
#: Log likelihood that a further language must gain, per unit of log(pieces).
PENALTY = 3.0
STEPS = 12
_COUNTS = "lang string, bucket int, many bigint"


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def windows(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the windows of all pieces, and to which piece each belongs."""
    lowered = "\n".join(pieces).lower()
    codes = np.frombuffer(f"\n{lowered}\n".encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds, code = np.unique(codes, return_inverse=True)
    letter = np.array([chr(c).isalpha() for c in kinds.tolist()])[code]
    marked = np.where(letter, codes, 0)
    hashed = (
        marked[:-2] * np.uint32(2654435761) + marked[1:-1] * np.uint32(2246822519)
        + marked[2:] * np.uint32(3266489917)
    )
    hashed ^= hashed >> np.uint32(15)
    hashed *= np.uint32(668265263)
    owner = np.cumsum(codes == 10)[1:-1] - 1
    inside = letter[1:-1]
    return (hashed[inside] >> np.uint32(16)).astype(np.int64) % BUCKETS, owner[inside]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per language and bucket of the task's documents."""
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in slices(batch.column(1)):
            many = part.stop - part.start
            langs = batch.column(0).slice(part.start, many).dictionary_encode()
            split = pc.ascii_split_whitespace(batch.column(1).slice(part.start, many))
            coded = split.flatten().dictionary_encode()
            pieces = coded.dictionary.to_pylist()
            bucket, owner = windows(pieces)
            offsets = split.offsets.to_numpy()
            lang_of = np.repeat(langs.indices.to_numpy(), np.diff(offsets))
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                seen = np.bincount(coded.indices.to_numpy()[lang_of == i], minlength=len(pieces))
                found = np.bincount(bucket, seen[owner], BUCKETS)
                totals[lang] = totals.get(lang, 0) + found.astype(np.int64)
    schema = arrow_schema(_COUNTS)
    for lang, found in totals.items():
        held = np.flatnonzero(found)
        yield record_batch([[lang] * len(held), held.astype(np.int32), found[held]], schema)


class Model:
    """Languages, and the log probability of each bucket's windows in each."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        smoothed = counts + SMOOTHING
        self.scores = (np.log(smoothed) - np.log(smoothed.sum(0))).astype(np.float32) / 3


def train(docs: DataFrame, fold_out: int = 0) -> Model:
    """From all documents with a language whose fold isn't ``fold_out``."""
    own = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id")) != fold_out))
    counted = map_arrow(own.select("lang", "text"), _count, _COUNTS)
    table = counted.groupBy("lang", "bucket").agg(F.sum("many").alias("many")).toArrow()
    langs = sorted(pc.unique(table["lang"]).to_pylist())
    counts = np.zeros((BUCKETS, len(langs)))
    place = pc.index_in(table["lang"], pa.array(langs, pa.string())).to_numpy()
    counts[table["bucket"].to_numpy(), place] = table["many"].to_numpy()
    return Model(langs, counts)


def mixture(scores: np.ndarray, letters: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Proportion of each language, from the log likelihoods of pieces under each."""
    n, many = scores.shape
    chosen = [int(scores.sum(0).argmax())]
    current, shares = scores[:, chosen[0]], None
    price = penalty * np.log(n + 1)
    while len(chosen) < many:
        best = None
        for other in range(many):
            # No mixture of the set with one more gains more than the pieces that it explains better.
            if other in chosen or np.maximum(scores[:, other] - current, 0).sum() <= price:
                continue
            weights, total = _mix(scores[:, [*chosen, other]])
            if best is None or total.sum() > best[2].sum():
                best = other, weights, total
        if best is None or best[2].sum() - current.sum() <= price:
            break
        chosen.append(best[0])
        shares, current = best[1], best[2]
    out = np.zeros(many)
    if shares is None:
        out[chosen[0]] = 1.0
        return out
    held = np.exp(scores[:, chosen] - scores[:, chosen].max(1, keepdims=True)) * shares
    held /= held.sum(1, keepdims=True)
    out[chosen] = letters @ held / letters.sum()
    return out


def _mix(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the languages by expectation-maximisation, and each piece's log likelihood."""
    top = scores.max(1, keepdims=True)
    likely = np.exp(scores - top)
    weights = np.full(scores.shape[1], 1 / scores.shape[1])
    for _ in range(STEPS):
        joint = likely * weights
        weights = (joint / joint.sum(1, keepdims=True)).mean(0)
        weights = np.maximum(weights, 1e-9)
    return weights, np.log(likely @ weights) + top[:, 0]


class Predictor:
    """A model with the pieces of text that a task remembers."""

    def __init__(self, model: Model):
        self.model, self.width = model, len(model.langs) + 1
        self.pieces = Pieces(self._learn, "<f4")

    def _learn(self, pieces: list[str]) -> list[bytes]:
        """Letters of a piece, and its log likelihood in each language; nothing without letters."""
        bucket, owner = windows(pieces)
        letters = np.bincount(owner, minlength=len(pieces))
        values = np.empty((len(pieces), self.width), np.float32)
        values[:, 0] = letters
        for i in range(self.width - 1):
            values[:, i + 1] = np.bincount(owner, self.model.scores[bucket, i], len(pieces))
        return [v.tobytes() if many else b"" for v, many in zip(values, letters.tolist(), strict=True)]

    def of(self, texts: pa.Array) -> tuple[list[str], list[float], list[str]]:
        """lang_pred, score and languages of each text."""
        langs = self.model.langs
        named, shares, sets = [], [], []
        for values in self.pieces.of(texts):
            values = values.reshape(-1, self.width)
            if not len(values) or not langs:
                named.append(UNDETERMINED), shares.append(0.0), sets.append("")
                continue
            found = mixture(values[:, 1:].astype(np.float64), values[:, 0].astype(np.float64))
            first = int(found.argmax())
            named.append(langs[first]), shares.append(min(1.0, float(found[first])))
            sets.append(",".join(lang for lang, x in zip(langs, found, strict=True) if x > 0))
        return named, shares, sets


def predictions(docs: DataFrame, model: Model, fold_out: int = 0) -> DataFrame:
    """doc_id, held_out, lang_pred, score, and the languages of the document's set, comma-joined."""
    ddl = "doc_id bigint, held_out boolean, lang_pred string, score double, langs string"
    schema = arrow_schema(ddl)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers per language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(shared.value)
        for batch in batches:
            for part in slices(batch.column(2)):
                keys, held, texts = (c.slice(part.start, part.stop - part.start) for c in batch.columns)
                yield record_batch([keys, held, *predictor.of(texts)], schema)

    held_out = F.coalesce(fold(F.col("doc_id")) == fold_out, F.lit(False)).alias("held_out")
    return map_arrow(docs.select("doc_id", held_out, "text"), run, ddl)


def identify(docs: DataFrame) -> DataFrame:
    return predictions(docs, train(docs))


def identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` in whose text a language was found, each judged by its own text.

    Texts without a letter go, and all texts if no language could be learned.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs))
    ship(docs.sparkSession)

    @F.pandas_udf("boolean")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predictor = Predictor(shared.value)
        for batch in batches:
            texts = pa.array(batch, pa.string())
            parts = [predictor.of(texts.slice(p.start, p.stop - p.start))[0] for p in slices(texts)]
            yield pd.Series([lang != UNDETERMINED for part in parts for lang in part], dtype=bool)

    return docs.filter(found("text"))
