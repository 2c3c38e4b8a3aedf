import random
from collections import Counter

import numpy as np
import pytest
import regex

from hourfold.llm import links, order_minhash as om
from document_fixtures import awkward, docs_of, sample, words  # noqa: F401


def words_of(text):
    return regex.findall(r"\w+", (text or "").lower())


def matched(a, b):
    """Longest common subsequence, by its table."""
    line = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, line[j + 1] = line[j + 1], before + 1 if x == y else max(line[j], line[j + 1])
    return line[-1]


def alike(a, b):
    """Similarity of 0.8 or more; what words they have in common is tried first."""
    both = len(a) + len(b)
    if (Counter(a) & Counter(b)).total() * 1.8 < 0.8 * both - 1e-9:
        return False
    return matched(a, b) * 1.8 >= 0.8 * both - 1e-9


def brute_classes(rows):
    """Classes of the graph of all pairs of texts that are alike."""
    held = [words_of(t) for _, t in rows]
    find, join = links.union_find(len(rows))
    for j in range(len(rows)):
        for i in range(j):
            same = rows[i][1] == rows[j][1] or held[i] and held[i] == held[j]
            shares = same or set(zip(held[i], held[i][1:])) & set(zip(held[j], held[j][1:]))
            if shares and find(i) != find(j) and (same or alike(held[i], held[j])):
                join(i, j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), key), key)
    return {key: least[find(i)] for i, (key, _) in enumerate(rows)}


def edited(text, seed, many):
    pick, w = random.Random(seed), text.split(" ")
    for _ in range(many):
        w[pick.randrange(len(w))] = f"new{pick.randrange(10**6)}"
    return " ".join(w)


def test_classes_equal_those_of_all_pairs(sample):
    rows = [(r.doc_id, r.text) for r in sample.collect()]
    got = {r.doc_id: r.class_id for r in om.near_duplicate_classes(sample).collect()}
    assert got == brute_classes(rows)


def test_planted_groups(docs_of):
    base = [" ".join(words(s, 150)) for s in range(30)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(1000 + 10 * i + k, edited(base[i], 31 * i + k, 1 + k % 3)) for i in range(20) for k in range(6)]
    rows += [(5000 + k, base[7]) for k in range(50)] + [(6000, base[9].upper().replace(" ", ", "))]
    got = {r.doc_id: r.class_id for r in om.near_duplicate_classes(docs_of(rows)).collect()}
    assert got == brute_classes(rows)
    assert got[6000] == 9 and {got[5000 + k] for k in range(50)} == {7}


def test_a_bucket_larger_than_a_block_loses_no_link(spark, docs_of):
    """Blocks of four: most pairs of a group meet across blocks."""
    base = " ".join(words(77, 200))
    texts = [edited(base, k, 1 + k % 4) for k in range(60)]
    bands = [(band, str(i).encode()) for i in range(60) for band in range(2)]
    groups = links.groups(spark.createDataFrame(bands, "key bigint, id binary"), block=4)
    met = {(a, b) for r in groups.collect() for a in r.members for b in r.members if a < b}
    assert len(met) == 60 * 59 // 2
    assert max(len(r.members) for r in groups.collect()) <= 40
    assert len({t for t in texts}) == 60


def test_order_counts():
    """The same shingles in another order make another sketch more often, and align worse."""
    first, second = words(1, 60), words(2, 60)
    pieces = om.word_pieces()
    import pyarrow as pa

    a, b = pieces.of(pa.array([" ".join(first + second), " ".join(second + first)]))
    equal = sum(x == y for x, y in zip(om.sketch(a), om.sketch(b), strict=True))
    assert equal < om.SKETCHES * 0.7
    la, lb = om.labelled_shingles(a)[1], om.labelled_shingles(b)[1]
    assert om.chained(la, lb, 0.0) == 56 and om.linked([a, b]) == []


def test_alignment_is_the_longest_common_subsequence(monkeypatch):
    """Also across parts, and where the band cuts: a pair that reaches the threshold lies within it."""
    pick = random.Random(11)
    for bits in (4096, 7):
        monkeypatch.setattr(om, "_BITS", bits)
        for _ in range(300):
            a = [pick.randrange(9) for _ in range(pick.randrange(0, 60))]
            b = [x for x in a if pick.random() > 0.1]
            for _ in range(pick.randrange(4)):
                b.insert(pick.randrange(len(b) + 1), pick.randrange(9))
            want, at = matched(a, b), [np.array(x, "<u4") for x in (a, b)]
            assert om.aligned(*at, 0.0) == want
            assert om.aligned(*at) <= want and (om.aligned(*at) == want or want * 1.8 < 0.8 * (len(a) + len(b)))


@pytest.mark.parametrize("share", [0.03, 0.05, 0.08, 0.1])
def test_copies_with_scattered_edits_are_found(spark, docs_of, share):
    """A share of the words of a copy is changed, dropped or added, all over the text."""
    pick, rows = random.Random(int(share * 100)), []
    for k in range(60):
        base = words(k, 60 + 8 * k)
        copy = list(base)
        for _ in range(int(share * len(base))):
            at, kind = pick.randrange(len(copy)), pick.randrange(4)
            copy[at : at + (kind < 3)] = [f"new{pick.randrange(10**6)}"] * (kind != 0)
        assert alike(base, copy)
        rows += [(k, " ".join(base)), (1000 + k, " ".join(copy))]
    got = {r.doc_id: r.class_id for r in om.near_duplicate_classes(docs_of(rows)).collect()}
    assert sum(got[1000 + k] == k for k in range(60)) >= 54
    assert all(got[k] == k for k in range(60)) and all(c % 1000 == d % 1000 for d, c in got.items())


def test_chain_is_the_longest_common_subsequence():
    pick = random.Random(5)
    for _ in range(200):
        a = pick.sample(range(40), pick.randrange(1, 20))
        b = pick.sample(range(40), pick.randrange(1, 20))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert om.chained(np.array(a, np.uint64), np.array(b, np.uint64), 0.0) == table[-1][-1]


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 102), (102, 101), (5, 5), (200, 201), (201, 200)]
    got = {r.id: r.root for r in links.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert {got[i] for i in range(1, 41)} == {0} and got[101] == got[102] == 100 and got[201] == 200


def test_awkward_documents(docs_of, awkward):
    got = [(r.doc_id, r.class_id) for r in om.near_duplicate_classes(docs_of(awkward)).collect()]
    assert len(got) == len(awkward)
    by_id = dict(got)
    assert by_id[2] == 1 and by_id[5] == 4 and by_id[6] == 6 and by_id[9] == 9 and by_id[3] == 3
    docs = docs_of(awkward)
    kept = om.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 3, 4, 6, 7, None, 8, 9, 10, 11, 12], key=str)
    assert om.near_duplicate_classes(docs_of([])).collect() == []


def test_rarest_pairs_are_shared_by_all_similar_texts():
    """In any order of the pairs."""
    pick, met = random.Random(3), 0
    for seed in range(3000):
        a = [pick.randrange(30) for _ in range(pick.randrange(1, 40))]
        b = list(a)
        for _ in range(pick.randrange(1, 9)):
            at, kind = pick.randrange(len(b) + 1), pick.randrange(3)
            b[at : at + (kind < 2)] = [pick.randrange(30)] * (kind > 0)
        wa, wb = np.array(a, "<u4"), np.array(b, "<u4")
        if len(b) and a != b and om.similar(wa, wb):
            often = np.random.default_rng(seed).integers(0, 5, 97)
            assert set(om.rarest(wa, often).tolist()) & set(om.rarest(wb, often).tolist())
            met += 1
    assert met > 500


def test_large_buckets_keep_all_links_in_rows_that_grow_with_their_size(spark, docs_of):
    """A chain of edits, copies of one text, and unlike texts, all with a common passage that makes large buckets."""
    passage, rows = " ".join(words(500, 60)), []
    for k in range(40):  # unlike but for the passage
        rows.append((k, f"{passage} {' '.join(words(600 + k, 60))}"))
    chain = (passage + " " + " ".join(words(700, 60))).split()
    for k in range(40):  # only neighbours, two or three steps apart, are similar
        chain[60:] = [w if (3 * i + k) % 13 > 1 else f"step{k}x{i}" for i, w in enumerate(chain[60:])]
        rows.append((100 + k, " ".join(chain)))
    base = f"{passage} {' '.join(words(800, 60))}"
    rows += [(200 + k, edited(base, k, 1 + k % 5)) for k in range(60)]
    want = {r.doc_id: r.class_id for r in om.near_duplicate_classes(docs_of(rows), 10**6).collect()}  # all pairs of a bucket
    assert len({want[100 + k] for k in range(40)}) < 20 and {want[200 + k] for k in range(60)} == {200}
    for block in (4, 16):
        got = {r.doc_id: r.class_id for r in om.near_duplicate_classes(docs_of(rows), block).collect()}
        assert got == want, block
    bands = [(band, i.to_bytes(16)) for i in range(400) for band in range(3)]
    members = links.buckets(spark.createDataFrame(bands, "key bigint, id binary"), 8)
    assert links.blocks(members, 2).selectExpr("sum(size(members))").first()[0] < 3 * 400 * 1.3


def test_across_meets_all_pairs_of_different_roots(spark):
    rows = [(s, bytes([i]), bytes([200 if i < 60 else i // 3])) for s in (1, 2) for i in range(100) if s == 1 or i % 3]
    groups = links.across(spark.createDataFrame(rows, "symbol bigint, id binary, root binary"), 8)
    met = {(a, b) for r in groups.collect() for a in r.members for b in r.members if a < b}
    assert {(a, b) for _, a, ra in rows for _, b, rb in rows if a < b and ra != rb} <= met
    assert len([1 for a, b in met if b < bytes([60])]) < 60 * 59 // 4


def test_ids_with_many_symbols_in_common_meet_a_few_times(spark):
    """As variants of one text, too far apart for a link, have most of their rare word pairs in common."""
    pick = random.Random(9)
    has = {s: {i for i in range(300) if pick.random() < 0.98} for s in range(60)} | {60 + i: {i, i + 1} for i in range(299)}
    rows = [(s, i.to_bytes(2), (500 if i < 100 else i).to_bytes(2)) for s, own in has.items() for i in sorted(own)]
    groups = links.across(spark.createDataFrame(rows, "symbol bigint, id binary, root binary"), 64).collect()
    met = {(a, b) for r in groups for a in r.members for b in r.members if a < b}
    roots = {i: root for _, i, root in rows}
    assert {(a, b) for a in roots for b in roots if a < b and roots[a] != roots[b]} <= met
    assert sum(len(r.members) for r in groups) < 300 * 6 * 10  # of six blocks, and 60 symbols
