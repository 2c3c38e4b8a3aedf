import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from hourfold.llm import language_id as li
from document_fixtures import awkward, docs_of  # noqa: F401

EN = "the quick brown fox and the lazy dog were walking together through this whole city "
FR = "le renard brun et le chien paresseux marchaient ensemble à travers toute cette ville "


@pytest.fixture(scope="module")
def two_languages(docs_of):
    rows = [(i, (EN if i % 2 else FR) * 3, "en" if i % 2 else "fr") for i in range(60)]
    return li.train(docs_of(rows))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    rows = li.identify(docs).collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {d for d in lang if zlib.crc32(str(d).encode()) % 5 == 0}
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows) and len(rows) == len(lang)


def test_mixtures_are_told_from_single_languages(two_languages, docs_of):
    mixed = EN * 3 + FR * 2
    rows = li.predictions(docs_of([(1, EN), (2, FR), (3, mixed), (4, EN.upper())]), two_languages).collect()
    by_id = {r.doc_id: r for r in rows}
    assert [by_id[i].lang_pred for i in (1, 2, 3, 4)] == ["en", "fr", "en", "en"]
    assert [by_id[i].langs for i in (1, 2, 3, 4)] == ["en", "fr", "en,fr", "en"]
    assert by_id[1].score == 1 and 0.5 < by_id[3].score < 0.7


def test_training_counts_are_those_of_a_plain_loop(docs_of):
    rows = [(3, EN, "en"), (4, FR + "Où? été!", "fr"), (5, EN, None), (7, None, "en")]
    model = li.train(docs_of(rows), fold_out=-1)
    assert model.langs == ["en", "fr"]
    counts = np.zeros((li.BUCKETS, 2))
    for _, text, lang in rows[:2]:
        for bucket in li.windows([text.replace("\n", " ")])[0]:
            counts[bucket, model.langs.index(lang)] += 1
    assert np.allclose(model.scores, li.Model(["en", "fr"], counts).scores)


def test_em_recovers_proportions():
    pick = np.random.default_rng(1)
    scores = np.where(pick.random((400, 1)) < 0.7, [[-5.0, -15.0]], [[-15.0, -5.0]])
    shares = li.mixture(scores, np.ones(400))
    assert abs(shares[0] - (scores[:, 0] > -10).mean()) < 0.01 and abs(shares.sum() - 1) < 1e-9


def test_awkward_documents(two_languages, docs_of, awkward):
    rows = li.identify(docs_of(awkward)).collect()
    assert len(rows) == len(awkward)
    by_id = {r.doc_id: r for r in rows}
    assert all((by_id[i].lang_pred, by_id[i].score) == ("und", 0) for i in (1, 2, 3, 9, 10))
    assert by_id[7].lang_pred in ("en", "fr") and by_id[None].held_out is False
    docs = docs_of(awkward)
    kept = li.identified(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {4, 5, 6, 7, None, 8, 11, 12}


def test_nothing_learned(docs_of):
    rows = li.identify(docs_of([(1, EN, None), (2, None, "en")])).collect()
    assert [(r.lang_pred, r.score) for r in rows] == [("und", 0), ("und", 0)]
    assert li.identify(docs_of([])).collect() == []


def plain_windows(piece):
    """Buckets of a word's three-letter windows, letter by letter."""
    marks = [0, *(ord(c) if c.isalpha() else 0 for c in piece.lower()), 0]
    out = []
    for before, own, after in zip(marks, marks[1:], marks[2:]):
        if own:
            h = (before * 2654435761 + own * 2246822519 + after * 3266489917) % 2**32
            h = (h ^ h >> 15) * 668265263 % 2**32
            out.append((h >> 16) % li.BUCKETS)
    return out


def plain_predictions(rows):
    """lang_pred and score of each row, from counts in dictionaries and EM over lists."""
    def held_out(doc_id):
        return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0

    def pieces_of(text):
        return [w for p in re.split(r"[\x20\x09-\x0D]+", text or "") if (w := plain_windows(p))]

    counts = {}
    for doc_id, text, lang in rows:
        if doc_id is not None and not held_out(doc_id) and text is not None and lang is not None:
            own = counts.setdefault(lang, Counter())
            for piece in pieces_of(text):
                own.update(piece)
    langs = sorted(counts)
    totals = {lang: sum(counts[lang].values()) + li.SMOOTHING * li.BUCKETS for lang in langs}

    def likelihood(piece, lang):
        return sum(math.log((counts[lang][w] + li.SMOOTHING) / totals[lang]) for w in piece) / 3

    def mixed(scores, chosen):
        """Shares of the chosen languages, and the log likelihood of each piece."""
        shares = [1 / len(chosen)] * len(chosen)
        for _ in range(li.STEPS):
            new = [0.0] * len(chosen)
            for s in scores:
                top = max(s[c] for c in chosen)
                joint = [math.exp(s[c] - top) * x for c, x in zip(chosen, shares)]
                for i, x in enumerate(joint):
                    new[i] += x / sum(joint) / len(scores)
            shares = [max(x, 1e-9) for x in new]
        tops = [max(s[c] for c in chosen) for s in scores]
        return shares, [math.log(sum(math.exp(s[c] - t) * x for c, x in zip(chosen, shares))) + t for s, t in zip(scores, tops)]

    out = []
    for doc_id, text, _ in rows:
        pieces = pieces_of(text)
        if not pieces or not langs:
            out.append((doc_id, held_out(doc_id), "und", 0.0))
            continue
        scores = [[likelihood(p, lang) for lang in langs] for p in pieces]
        sums = [sum(s[i] for s in scores) for i in range(len(langs))]
        chosen, shares, now = [sums.index(max(sums))], [1.0], max(sums)
        while len(chosen) < len(langs):
            ways = [(mixed(scores, [*chosen, i]), i) for i in range(len(langs)) if i not in chosen]
            (new, likely), i = max(ways, key=lambda way: sum(way[0][1]))
            if sum(likely) - now <= li.PENALTY * math.log(len(pieces) + 1):
                break
            chosen, shares, now = [*chosen, i], new, sum(likely)
        held = [0.0] * len(chosen)
        for s, piece in zip(scores, pieces):
            top = max(s[c] for c in chosen)
            joint = [math.exp(s[c] - top) * x for c, x in zip(chosen, shares)]
            for k, x in enumerate(joint):
                held[k] += len(piece) * x / sum(joint)
        best = max(held)
        named = min((c for c, x in zip(chosen, held) if x == best))
        out.append((doc_id, held_out(doc_id), langs[named], best / sum(held)))
    return out


def test_predictions_equal_a_plain_version(docs_of, awkward):
    """Texts of one and of several languages, some of them learned from, and the awkward rows."""
    pick = random.Random(12)
    parts = {"en": EN.split(), "fr": FR.split(), "de": "der schnelle braune Fuchs und der faule Hund liefen durch die ganze Stadt".split()}
    rows = []
    for key in range(120):
        lang = pick.choice(sorted(parts))
        words = [pick.choice(parts[lang]) for _ in range(pick.randrange(1, 40))]
        if key % 4 == 0:
            words += [pick.choice(parts[pick.choice(sorted(parts))]) for _ in range(pick.randrange(60))]
        rows.append((key, " ".join(words), None if key % 7 == 0 else lang))
    rows += [r[:3] for r in awkward if r[0] not in (6, 8)]
    key = lambda r: (str(r[0]), r[2])
    got = sorted(((r.doc_id, r.held_out, r.lang_pred, r.score) for r in li.identify(docs_of([(*r, None, None) for r in rows])).collect()), key=key)
    want = sorted(plain_predictions(rows), key=key)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], atol=1e-4)
