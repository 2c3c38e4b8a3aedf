import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from hourfold.llm import periodic_runs as pr
from document_fixtures import awkward, docs_of, sample  # noqa: F401


def plain_runs(words, shortest=24, times=3):
    """Every maximal stretch by trying each period on its own."""
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            start, end = i, j + q
            if end - start >= max(shortest, times * q):
                found.setdefault((start, end), q)  # periods come in ascending order
            i = j
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_row(doc_id, text):
    """The contract, word by word."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
    drop = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else None
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        digest("".join(f"{s},{m},{q}\n" for s, m, q in found)),
        digest(" ".join(w for i, w in enumerate(words) if i not in drop)),
    )


def order(rows):
    return sorted(rows, key=str)


def test_cover_is_a_perfect_difference_set():
    differences = sorted((a - b) % pr.MODULUS for a in pr.COVER for b in pr.COVER if a != b)
    assert differences == list(range(1, pr.MODULUS))


@pytest.mark.parametrize("n,letters,seed", [(1, 1, 0), (40, 1, 1), (300, 2, 2), (500, 3, 3), (700, 50, 4), (400, 1, 5)])
def test_extensions(n, letters, seed):
    pick = np.random.default_rng(seed)
    words = pick.integers(0, letters, n)
    words[n // 2 :] = words[: n - n // 2]
    extend = pr.Extensions(words)
    a, b = pick.integers(0, n + 1, 3000), pick.integers(0, n + 1, 3000)
    a, b = a[a != b], b[a != b]
    got = extend(a, b)
    for i, j, many in zip(a.tolist(), b.tolist(), got.tolist()):
        want = 0
        while max(i, j) + want < n and words[i + want] == words[j + want]:
            want += 1
        assert many == want


def test_grid_has_every_triple_once(monkeypatch):
    for points in (7, 1 << 18):
        monkeypatch.setattr(pr, "POINTS", points)
        for n in (24, 25, 100):
            got = sorted((int(i), int(q)) for place, period in pr.grid(n) for i, q in zip(place, period))
            assert got == sorted((i, q) for q in range(1, n // 3 + 1) for i in range(0, n, q) if i + 2 * q < n)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.integers(1, 12), st.integers(0, 10**6)), max_size=12))
def test_runs_equal_brute_force(parts):
    """Words made of repeated random pieces, some inside others."""
    words = []
    for size, times, seed in parts:
        piece = [random.Random(seed + i).randrange(3) for i in range(size)]
        words += piece * times
    words += words[: len(words) // 2] * 2
    assert [tuple(r) for r in pr.runs(np.array(words, np.int64)).tolist()] == plain_runs(words)


@pytest.mark.parametrize("seed", range(4))
def test_long_texts(seed):
    pick = random.Random(seed)
    words = [pick.randrange(3000) for _ in range(3000)]
    for _ in range(4):
        at, size = pick.randrange(2000), pick.randrange(1, 200)
        words[at:at] = words[at : at + size] * pick.randrange(3, 7)
    words += [7] * pick.randrange(100)
    assert [tuple(r) for r in pr.runs(np.array(words)).tolist()] == plain_runs(words)


def test_whole_table(spark, sample):
    got = pr.run_digests(sample).collect()
    want = [plain_row(r.doc_id, r.text) for r in sample.collect()]
    assert order(map(tuple, got)) == order(want)
    assert sum(r.n_runs > 0 for r in got) >= 0.05 * len(got)


def test_awkward_rows(spark, awkward, docs_of):
    rows = [r[:2] for r in awkward] + [
        (i, t) for i in range(100, 160) for t in (" a\x0bb\x1fc\x0cd \t" * 30, "one two three four five " * 4, " x y" * 20)
    ]
    for plant in (True, False):
        got = pr.run_digests(docs_of([(*r, None, None, None) for r in rows]), plant).collect()
        want = [plain_row(i if plant else None, t) for i, t in rows]
        assert order(tuple(r)[1:] for r in got) == order(r[1:] for r in want)
    assert pr.run_digests(docs_of([])).collect() == []
