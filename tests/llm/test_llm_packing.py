import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from hourfold.llm import packing
from hourfold.llm.queries import VOCABULARY
from document_fixtures import awkward, docs_of, sample  # noqa: F401


def least_bins(lengths, capacity):
    """By trying all ways."""
    best = len(lengths)

    def place(i, free):
        nonlocal best
        if len(free) >= best:
            return
        if i == len(lengths):
            best = len(free)
            return
        for k in range(len(free)):
            if free[k] >= lengths[i]:
                free[k] -= lengths[i]
                place(i + 1, free)
                free[k] += lengths[i]
        place(i + 1, [*free, capacity - lengths[i]])

    place(0, [])
    return best


def test_bounds_never_exceed_the_best_packing():
    pick = random.Random(4)
    for _ in range(150):
        lengths = np.array(sorted((pick.randrange(1, 31) for _ in range(7)), reverse=True))
        bins, offsets = packing.best_fit(lengths, 30)
        true = least_bins(lengths.tolist(), 30)
        assert packing.lower_bound(lengths, 30) <= true <= bins.max() + 1
        for b in range(bins.max() + 1):
            held = sorted(zip(offsets[bins == b], lengths[bins == b]))
            assert [o for o, _ in held] == [0, *np.cumsum([n for _, n in held])[:-1]]
            assert sum(n for _, n in held) <= 30


def test_bounds_beyond_the_sum():
    assert packing.lower_bound(np.array([16] * 5), 30) == 5
    assert packing.lower_bound(np.array([11] * 6), 30) == 3
    assert packing.lower_bound(np.zeros(0, np.int64), 30) == 0


def check(rows, texts, capacity):
    library = Tokenizer.from_file(VOCABULARY)
    want = []
    for key, text in texts:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            held = np.array(ids[start : start + capacity], "<u4")
            want.append((key, piece, start, len(held), zlib.crc32(held.tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=str) == sorted(want, key=str)
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in held.values():
        spans.sort()
        assert [o for o, _ in spans] == [0, *np.cumsum([n for _, n in spans])[:-1]]
        assert sum(n for _, n in spans) <= capacity
    return len(held)


@pytest.mark.parametrize("group_rows", [20_000, 40])
def test_all_documents_are_packed_near_the_bound(spark, sample, group_rows):
    pieces = packing.stored(packing.cut(sample, VOCABULARY), "pieces")
    packed = packing.pack(pieces, group_rows=group_rows)
    used = check(packed.collect(), [(r.doc_id, r.text) for r in sample.collect()], 4096)
    assert packing.certificate(packed)[0] == used
    assert used <= packing.certificate(packed)[1] + 1


def test_awkward_documents(docs_of, awkward):
    rows = packing.pack_documents(docs_of(awkward), VOCABULARY).collect()
    check(rows, [(r[0], r[1]) for r in awkward], 4096)
    assert packing.pack_documents(docs_of([]), VOCABULARY).collect() == []


def test_large_ids_next_to_a_null_one(docs_of):
    ids = [2**53 + i for i in range(1, 40, 2)] + [None, -(2**62) - 1]
    rows = [(key, f"text number {i}") for i, key in enumerate(ids)]
    packed = packing.pack_documents(docs_of(rows), VOCABULARY).collect()
    check(packed, rows, 4096)
