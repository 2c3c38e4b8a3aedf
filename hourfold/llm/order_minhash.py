"""Near-duplicate classes by Order MinHash, verified by banded alignment.

A document's words (lower-cased runs of letters, digits and underscores) give its shingles of five
words, each labelled with its occurrence: the second time that a shingle comes it is another symbol.
A sketch takes the ``KEPT`` labelled shingles that are least under its hash function and retains them
in the order of the text, so texts with the same shingles in another order agree less often. Equal
sketches make a bucket. A text with a tenth of its words changed one by one keeps 0.6 of its
shingles; sketches of two agree then in about a sixth of the cases, and 20 of them miss such a pair
once in forty, one with a twentieth of its words changed once in two hundred thousand.

Documents with equal words are one node. The members of a bucket are compared by their sizes and by the
labelled pairs of neighbouring words that they have in common, which bound an alignment from above. Pairs
that may reach the threshold are verified: their words are aligned within the band that the threshold
allows, and the similarity is matched / (all - matched). It is at least that of the aligned five-word
shingles. Classes are the components of the links. Of a large bucket, texts that are not connected within its
blocks are compared with those of other components that share one of their rarest pairs of neighbouring words, as
similar texts do.

Defined results: texts under five words are one shingle; texts without words are classed with equal
texts only; null text is empty text; rows are told apart by doc_id and text, so one id may hold different
texts; a class is named by its smallest doc_id, which is null if all its rows are without one; an empty
table gives an empty one; columns beyond doc_id and text are ignored.
"""

from __future__ import annotations

import bisect
import hashlib

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sinks.files import stored
from . import links
from .tasks import Pieces, arrow_schema, map_arrow, map_batches, record_batch

WORDS = 5
SIMILARITY = 0.8
SKETCHES = 20
KEPT = 2
_COLUMNS = 4096  # of the matrix that counts common shingles
_BITS = 4096  # words of a text that are aligned at a time
_LONG = 1000  # words of a text whose shingles are tried before it is aligned
_SLOTS = 1 << 20  # counters of word pairs


def _mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit integers well mixed (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_PLACES = _mixed(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)
_SALTS = _mixed(np.arange(101, 165, dtype=np.uint64))
_LINES = regex.compile(r"\w+|\n")


def word_pieces() -> Pieces:
    """32-bit hashes of the words of a text."""

    def learn(pieces: list[str]) -> list[bytes]:
        out, own = [], bytearray()
        for word in _LINES.findall("\n".join(pieces).lower()):
            if word == "\n":
                out.append(bytes(own))
                own = bytearray()
            else:
                own += xxhash.xxh32_intdigest(word).to_bytes(4, "little")
        out.append(bytes(own))
        return out

    return Pieces(learn, "<u4")


def labelled_shingles(words: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles in text order, and those of the shingles with their occurrences."""
    words = words.astype(np.uint64)
    many = max(1, len(words) - size + 1)
    plain = np.zeros(many, np.uint64)
    for place in range(min(size, len(words))):
        plain += (words[place : place + many] + np.uint64(1)) * _PLACES[place]
    plain = _mixed(plain)
    order = np.argsort(plain, kind="stable")
    ordered = plain[order]
    place = np.arange(many)
    first = np.maximum.accumulate(np.where(np.r_[True, ordered[1:] != ordered[:-1]], place, 0))
    seen = np.empty(many, np.uint64)
    seen[order] = place - first
    return plain, np.where(seen > 0, _mixed(plain + seen * _PLACES[63]), plain)


def sketch(words: np.ndarray, sketches: int = SKETCHES, kept: int = KEPT) -> list[int]:
    """A 64-bit key per sketch function; none for a text without words."""
    if not len(words):
        return []
    plain, labelled = labelled_shingles(words)
    order = (labelled ^ _SALTS[:sketches, None]) * _PLACES[:sketches, None]
    order ^= order >> np.uint64(32)
    kept = min(kept, len(plain))
    least = np.argpartition(order, kept - 1, axis=1)[:, :kept] if kept < len(plain) else np.tile(
        np.arange(kept), (sketches, 1)
    )
    least.sort(axis=1)  # text order
    key = np.arange(1, sketches + 1, dtype=np.uint64)
    for place in range(kept):
        key = _mixed(key * _PLACES[place] + plain[least[:, place]])
    return key.view(np.int64).tolist()


def chained(a: np.ndarray, b: np.ndarray, threshold: float = SIMILARITY) -> int:
    """Most symbols that an alignment of two sequences, each of distinct symbols, can match.

    Matches lie within the band outside of which no alignment reaches the threshold.
    """
    _, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    band = (1 - threshold) / (1 + threshold) * (len(a) + len(b))
    inside = np.abs(at_a - at_b) <= band
    at_b = at_b[inside][np.argsort(at_a[inside])]
    if (at_b[1:] > at_b[:-1]).all():
        return len(at_b)
    ends: list[int] = []  # least end of an ascending chain of each length
    for x in at_b.tolist():
        place = bisect.bisect_left(ends, x)
        ends[place : place + 1] = [x]
    return len(ends)


def aligned(a: np.ndarray, b: np.ndarray, threshold: float = SIMILARITY) -> int:
    """Most words that an alignment of two texts within the band of the threshold can match.

    Bit-parallel: a bit of a row is 0 where a word more of ``b`` adds a match. ``b`` is worked through in parts
    that hand their carries on, so memory grows with the length of ``a`` alone.
    """
    band = int((1 - threshold) / (1 + threshold) * (len(a) + len(b))) + 1
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    first = int(differ[0]) if len(differ) else n
    a, b, n = a[first:], b[first:], n - first
    differ = np.flatnonzero(a[len(a) - n :] != b[len(b) - n :])
    last = n - 1 - int(differ[-1]) if len(differ) else n
    words, others, carry = a[: len(a) - last].tolist(), b[: len(b) - last].tolist(), bytearray(len(a) - last)
    matched = first + last
    for low in range(0, len(others) if words else 0, _BITS):
        places: dict[int, int] = {}
        part = others[low : low + _BITS]
        for place, word in enumerate(part):
            places[word] = places.get(word, 0) | 1 << place
        row = full = (1 << len(part)) - 1
        reach = low + len(part) + band
        # Rows above the band hand their carry on as it is.
        for i in range(max(0, low - band), len(words)):
            match = places.get(words[i], 0) if i < reach else 0
            if match or carry[i]:
                added = row + (row & match) + carry[i]
                carry[i] = added >> len(part)
                row = added & full | row & ~match
        matched += len(part) - row.bit_count()
    return matched


def _common(symbols: list[np.ndarray]) -> np.ndarray:
    """How many symbols each two of some sets of symbols have in common."""
    n = len(symbols)
    owner = np.repeat(np.arange(n), list(map(len, symbols)))
    _, symbol, count = np.unique(np.concatenate(symbols), return_inverse=True, return_counts=True)
    shared = count[symbol] > 1
    owner, symbol = owner[shared], (np.cumsum(count > 1) - 1)[symbol[shared]]
    common = np.zeros((n, n), np.float32)
    by_symbol = np.argsort(symbol, kind="stable")
    owner, symbol = owner[by_symbol], symbol[by_symbol]
    for start in range(0, int(symbol[-1]) + 1 if len(symbol) else 0, _COLUMNS):
        low, high = np.searchsorted(symbol, [start, start + _COLUMNS])
        has = np.zeros((n, _COLUMNS), np.float32)
        has[owner[low:high], symbol[low:high] - start] = 1
        common += has @ has.T
    return common


def similar(a: np.ndarray, b: np.ndarray, threshold: float = SIMILARITY) -> bool:
    """Whether an alignment of two texts reaches the threshold."""
    least = threshold / (1 + threshold) * (len(a) + len(b)) - 1e-9
    if min(len(a), len(b)) >= _LONG:
        # Quicker for long texts. Aligned shingles begin with matched words, and the last one has four more.
        chain = chained(labelled_shingles(a)[1], labelled_shingles(b)[1], threshold)
        if chain and chain + WORDS - 1 >= least:
            return True
    return aligned(a, b, threshold) >= least


def linked(
    texts: list[np.ndarray], threshold: float = SIMILARITY, roots: list | None = None, keys: list | None = None
) -> list[tuple[int, int]]:
    """Pairs of word sequences that are similar; pairs that others connect are left out.

    Of m matched words at least m - 1 - e neighbours match, where e words are without a match: each of these
    parts one pair at most. Matched words are words in common. Texts of the same of the ``roots`` are connected already; where ``keys`` are given,
    pairs have one in common.
    """
    n, sizes = len(texts), np.array(list(map(len, texts)))
    common = _common([labelled_shingles(w, 2)[1] for w in texts])
    both = sizes[:, None] + sizes[None, :]
    least = np.ceil(threshold / (1 + threshold) * both - 1e-6)
    may = (np.minimum(sizes[:, None], sizes[None, :]) >= least) & (common >= 3 * least - both - 1)
    if n > 2:
        may &= _common([labelled_shingles(w, 1)[1] for w in texts]) >= least
    find, join = links.union_find(n)
    if roots is not None:
        _, root, first = *np.unique(roots, return_inverse=True), {}
        may &= root[:, None] != root[None, :]
        for k, r in enumerate(root.tolist()):
            join(k, first.setdefault(r, k))
    if keys is not None:
        may &= _common([np.unique(k) for k in keys]) > 0
    left, right = np.nonzero(np.triu(may, 1))
    out = []
    for k in np.argsort(-(common / both)[left, right], kind="stable").tolist():
        a, b = int(left[k]), int(right[k])
        if find(a) != find(b) and similar(texts[a], texts[b], threshold):
            join(a, b)
            out.append((a, b))
    return out


def rarest(words: np.ndarray, often: np.ndarray) -> np.ndarray:
    """Labelled pairs of neighbouring words, the rarest first, of which any two similar texts share one.

    ``often`` counts pairs by hash. A text of n words shares at least 0.6 n - 1 pairs with a similar one (see
    ``linked``; least if that has 0.8 n words), so all but that many and one more are enough, in any one order.
    """
    pairs = labelled_shingles(words, 2)[1]
    order = np.lexsort((pairs, often[(pairs % np.uint64(len(often))).astype(np.int64)]))
    shared = (3 * SIMILARITY - 1 - (1 - SIMILARITY)) / 2 * len(words) - 1
    return pairs[order[: max(1, len(pairs) - int(np.ceil(shared - 1e-6)) + 1)]]


def _by_rare_pairs(rows: DataFrame) -> DataFrame:
    """symbol, id and root: ``rarest`` of every payload of ``rows``, in one order for all, but pairs that no other has."""

    def slots(pairs: np.ndarray) -> np.ndarray:
        return (pairs % np.uint64(_SLOTS)).astype(np.int64)

    def count(batches):
        total = np.zeros(_SLOTS, np.int64)
        for batch in batches:
            for p in batch.column(0).to_pylist():
                np.add.at(total, slots(labelled_shingles(np.frombuffer(p, "<u4"), 2)[1]), 1)
        used = np.flatnonzero(total)
        yield record_batch([used, total[used]], arrow_schema("slot bigint, many bigint"))

    counts = map_arrow(rows.select("payload"), count, "slot bigint, many bigint")
    # As Arrow and small integers: there may be a counter a slot.
    found = counts.groupBy("slot").agg(F.least(F.sum("many"), F.lit(65535)).alias("many")).filter("many > 1").toArrow()
    often = np.ones(_SLOTS, np.uint16)
    often[found["slot"].to_numpy()] = found["many"].to_numpy()

    def shared(payload: bytes) -> list[int]:
        pairs = rarest(np.frombuffer(payload, "<u4"), often)
        return pairs[often[slots(pairs)] > 1].view(np.int64).tolist()

    def columns(_, payloads: pa.Array) -> list:
        return [list(map(shared, payloads.to_pylist()))]

    made = map_batches(rows.select(F.concat("id", "root").alias("own"), "payload"), lambda: None, columns, "symbols array<bigint>")
    # Digests have 16 bytes.
    return made.select(
        F.explode("symbols").alias("symbol"), F.substring("own", 1, 16).alias("id"), F.substring("own", 17, 16).alias("root")
    )


def digests(words: list[np.ndarray], texts: pa.Array) -> list[bytes]:
    """Equal for equal words; texts without words are told apart by what they hold instead."""
    return [
        hashlib.blake2b(w.tobytes() if len(w) else b"\0" + (t.as_py() or "").encode(), digest_size=16).digest()
        for w, t in zip(words, texts, strict=True)
    ]


def text_key(text: Column) -> Column:
    """Tells the texts of rows with the same doc_id apart."""
    return F.md5(F.coalesce(text, F.lit("")))


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, digest (equal for equal words) and the keys of its sketches."""

    def columns(words: Pieces, texts: pa.Array) -> list:
        found = words.of(texts)
        own = [hashlib.md5((t or "").encode()).hexdigest() for t in texts.to_pylist()]
        return [own, digests(found, texts), [sketch(w) for w in found]]

    ddl = "text_key string, digest binary, keys array<bigint>"
    return map_batches(docs.select("doc_id", "text"), word_pieces, columns, ddl)


def _words_of(docs: DataFrame, nodes: DataFrame, ids: DataFrame) -> DataFrame:
    """id and payload, the words of the nodes among ``ids``, read again from the document that stands for each."""
    wanted = nodes.join(ids.withColumnRenamed("id", "digest"), "digest")
    texts = docs.select("doc_id", "text")
    same = texts["doc_id"].eqNullSafe(wanted["first.doc_id"]) & (text_key(texts["text"]) == wanted["first.text_key"])
    texts = texts.join(wanted, same).select("digest", "text")

    def columns(words: Pieces, values: pa.Array) -> list:
        return [[w.tobytes() for w in words.of(values)]]

    found = map_batches(texts, word_pieces, columns, "payload binary")
    return found.groupBy(F.col("digest").alias("id")).agg(F.first("payload").alias("payload"))


def _similar(payloads: list[bytes], roots: list | None = None, keys: list | None = None) -> list[tuple[int, int]]:
    return linked([np.frombuffer(p, "<u4") for p in payloads], SIMILARITY, roots, keys)


def _components(docs: DataFrame, nodes: DataFrame, block: int = links.BLOCK) -> DataFrame:
    """id and root of the components of all similar nodes that share a bucket."""
    bands = nodes.select(F.explode("keys").alias("key"), F.col("digest").alias("id"))
    members = stored(links.buckets(bands, block), "buckets")
    # Of both comparisons: the texts are read and exchanged once.
    words = stored(_words_of(docs, nodes.select("digest", "first"), members.select("id").distinct()), "words")
    roots = links.components(links.verified_links(links.blocks(members), lambda ids: words, _similar))
    if members.filter("blocks > 1").isEmpty():
        return roots
    unsettled = stored(links.unsettled(members, roots, block), "unsettled")
    if unsettled.isEmpty():
        return roots
    texts = unsettled.groupBy("id").agg(F.first("root").alias("root"), F.collect_set("key").alias("keys"))
    held = stored(words.join(texts, "id"), "held")
    direct = unsettled.filter("few").select(F.col("key").alias("symbol"), "id", "root")
    others = held.join(unsettled.filter("NOT few").select("id").distinct(), "id", "left_semi")
    groups = links.across(direct, block).union(links.across(_by_rare_pairs(others), block)).dropDuplicates(["members"])
    found = stored(links.verified_links(groups, lambda ids: held, _similar), "links")
    if found.isEmpty():
        return roots
    return links.components(found.union(roots.select("id", "root")))


def _named_classes(docs: DataFrame, block: int = links.BLOCK) -> tuple[DataFrame, DataFrame]:
    """Rows of ``docs`` by doc_id, text_key and digest, and for each digest the row that its class is named by."""
    made = stored(sketches(docs), "sketches")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    nodes = stored(made.groupBy("digest").agg(F.min(row).alias("first"), F.first("keys").alias("keys")), "nodes")
    roots = _components(docs, nodes, block).select(F.col("id").alias("digest"), "root")
    nodes = nodes.select("digest", "first").join(roots, "digest", "left")
    nodes = nodes.withColumn("root", F.coalesce("root", "digest"))
    classes = nodes.groupBy("root").agg(F.min("first").alias("named"))
    return made.drop("keys"), nodes.join(classes, "root").select("digest", "first", "named")


def near_duplicate_classes(docs: DataFrame, block: int = links.BLOCK) -> DataFrame:
    """doc_id and class_id, the smallest doc_id of its class, for every row of ``docs``.

    Buckets of more than ``block`` different texts are cut.
    """
    made, named = _named_classes(docs, block)
    return made.join(named, "digest").select("doc_id", F.col("named.doc_id").alias("class_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that classes are named by: of each the one of the smallest doc_id, then text_key.

    Rows are told apart by doc_id and text. Of rows that share both, the least by a hash of all columns stays.
    """
    def row_key(doc_id: Column, own: Column) -> Column:
        """One column, so that the join and the window after it need one exchange of the texts."""
        return F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("-")), own)).alias("_row_key")

    named = _named_classes(docs)[1]
    kept = named.filter("first = named").select(row_key(F.col("first.doc_id"), F.col("first.text_key")))
    hashed = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    place = F.row_number().over(Window.partitionBy("_row_key").orderBy(F.xxhash64(*hashed)))
    rows = docs.select("*", row_key(F.col("doc_id"), text_key(F.col("text")))).join(kept, "_row_key", "left_semi")
    return rows.withColumn("_nth_of_equal", place).filter("_nth_of_equal = 1").select(*docs.columns)
