import hashlib
import random

import numpy as np

from hourfold.llm import edit_embedding as ee
from document_fixtures import awkward, docs_of, sample, words  # noqa: F401


def slow_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance_equals_the_table():
    pick = random.Random(2)
    for _ in range(400):
        a = "".join(pick.choice("abcß") for _ in range(pick.randrange(30)))
        b = "".join(pick.choice("abcß") for _ in range(pick.randrange(30)))
        if pick.random() < 0.5 and a:
            b = a[: len(a) // 2] + pick.choice("abc") + a[len(a) // 2 + 1 :]
        true, most = slow_distance(a, b), pick.randrange(30)
        assert ee.edit_distance(a, b, most) == (true if true <= most else most + 1)


def test_walk_is_that_of_single_steps():
    """The lockstep embedding against one text at a time."""
    walk = ee.Walk()
    texts = ["", "a", "some text of a few words", "x" * 400, "\U0001f600 emoji and ä"]
    for text, got in zip(texts, walk.samples(texts), strict=True):
        codes = [ord(c) for c in text] + [0, 0]
        at, seen = 0, []
        for step in range(10_000):
            if at >= len(text):
                break
            place = np.flatnonzero(walk.steps == step)
            if len(place):
                a, b, c = (np.uint32(x) for x in codes[at : at + 3])
                with np.errstate(over="ignore"):
                    gram = a * np.uint32(2654435761) + b * np.uint32(2246822519) + c * np.uint32(3266489917)
                    gram ^= gram >> np.uint32(15)
                    seen.append(int((gram ^ walk.salts[place[0], 0]) * walk.salts[place[0], 1] >> np.uint32(28)))
            with np.errstate(over="ignore"):
                kind = int(np.uint32(codes[at]) * np.uint32(2654435761) >> np.uint32(24))
            at += int(walk.moves[step % ee.PERIOD, kind])
        assert got[: len(seen)].tolist() == seen and (got[len(seen) :] == 255).all()


def test_likeness_follows_edits():
    walk = ee.Walk()
    text = " ".join(words(5, 500))
    close = text.replace(text[1000:1010], "", 1)
    half = text[: len(text) // 2] + " ".join(words(6, 500))[: len(text) // 2]
    other = " ".join(words(7, 500))
    s = walk.samples([text, close, half, other, "", ""])
    near = [float(walk.likeness(s[:1], s[i : i + 1])[0]) for i in range(4)]
    assert near[0] == 1 and near[0] > near[1] > near[2] > near[3] and near[1] > 0.7 and near[3] < 0.2
    assert walk.likeness(s[4:5], s[5:6])[0] == 1 and walk.likeness(s[4:5], s[:1])[0] == 0


def expected(rows):
    texts = {}
    for key, text in rows:
        texts.setdefault(key, text or "")
    order = sorted(texts, key=lambda k: (k is not None, k))
    out = {}
    for i, key in enumerate(order):
        text, after = texts[key], texts[order[(i + 1) % len(order)]]
        half = len(text) // 2
        out[key] = len(text), hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()
    return out


def test_edited_texts_of_all_documents(spark, sample):
    rows = ee.edited_fingerprints(sample).collect()
    want = expected([(r.doc_id, r.text) for r in sample.collect()])
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in rows} == want and len(rows) == len(want)
    assert np.mean([r.near_edited for r in rows]) > 0.4 > 0.05 > np.mean([r.near_next for r in rows])


def test_awkward_documents(docs_of, awkward):
    rows = ee.edited_fingerprints(docs_of(awkward)).collect()
    assert len(rows) == len(awkward)
    prints = {}
    for r in rows:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        prints.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    assert prints[1] == prints[2] == {""} and prints[4] == prints[5]


def test_few_rows(docs_of):
    assert ee.edited_fingerprints(docs_of([])).collect() == []
    (only,) = ee.edited_fingerprints(docs_of([(5, "abcd")])).collect()
    assert (only.n_chars, only.edited_sha256) == (4, hashlib.sha256(b"abab").hexdigest())


def test_near_duplicate_classes(docs_of, awkward):
    base = [" ".join(words(seed, 120)) for seed in range(40)]
    rows = [(100 + i, t) for i, t in enumerate(base)]
    rows += [(200 + i, t.replace("a", "o", 3) + " end") for i, t in enumerate(base[:20])] + [(300, base[3])]
    got = {r.doc_id: r.class_id for r in ee.near_duplicate_classes(docs_of(rows)).collect()}
    assert all(got[200 + i] == 100 + i for i in range(20)) and got[300] == 103
    assert all(got[100 + i] == 100 + i for i in range(40))
    got = [(r.doc_id, r.class_id) for r in ee.near_duplicate_classes(docs_of(awkward)).collect()]
    assert len(got) == len(awkward) and dict(got)[5] == 4 and dict(got)[2] == 1


def scattered(text, rate, pick):
    """A ``rate`` of the characters replaced, left out or followed by another one, all over the text."""
    out = []
    for c in text:
        kind = pick.randrange(3) if pick.random() < rate else None
        out.append({None: c, 0: "", 1: pick.choice("abcdefgh "), 2: c + pick.choice("abcdefgh ")}[kind])
    return "".join(out)


def test_recall_of_scattered_edits(docs_of):
    """Pairs of edit similarity 0.8 and more, up to 20 % edits, and no pair below it."""
    pick, rows, pairs = random.Random(8), [], {}
    for size in (40, 150, 400):
        for rate in (0.03, 0.06, 0.1, 0.13, 0.16, 0.2):
            for _ in range(6):
                key, text = len(rows), " ".join(words(pick.random(), size))
                rows += [(key, text), (key + 1, scattered(text, rate, pick))]
                most = max(len(text), len(rows[-1][1])) * 0.2
                pairs[key] = ee.edit_distance(text, rows[-1][1], 10**6) <= most
    got = {r.doc_id: r.class_id for r in ee.near_duplicate_classes(docs_of(rows)).collect()}
    found = {key: got[key + 1] == key for key in pairs}
    near = [key for key, true in pairs.items() if true]
    assert len(near) >= 90 and sum(found[key] for key in near) >= 0.95 * len(near)
    assert not any(found[key] for key in pairs if not pairs[key])


def test_rows_without_id_are_classed_by_their_text(docs_of):
    text = " ".join(words(77, 100))
    got = ee.near_duplicate_classes(docs_of([(None, text), (3, text + " end"), (None, "else"), (4, text)])).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted([(None, 3), (3, 3), (None, None), (4, 3)], key=str)
