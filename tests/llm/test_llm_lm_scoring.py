import math
import random
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from hourfold.llm import lm_scoring as lm
from hourfold.llm.queries import VOCABULARY
from document_fixtures import awkward, docs_of, words  # noqa: F401

LABELS = "doc_id bigint, quality int, toxic int"


def brute(docs, good):
    """Losses of each document by plain counting."""
    library = Tokenizer.from_file(VOCABULARY)
    size = library.get_vocab_size()
    ids = {d: library.encode(t or "", add_special_tokens=False).ids for d, t in docs}

    def pairs(x):
        return lm.pair_places(np.array(x, np.uint32)).tolist() if x else []

    def counts(members):
        return Counter(i for d in members for i in ids[d]), Counter(p for d in members for p in pairs(ids[d]))

    out = {}
    for d, x in ids.items():
        if not x:
            out[d] = (None, None)
            continue
        target, background = counts([o for o in good if o != d and o in ids]), counts([o for o in ids if o != d])
        goal = max(1, sum(target[0].values()))
        losses = []
        for single, pair in (target, background):
            tokens = sum(single.values())
            scale = goal / max(1, tokens)

            def alone(i):
                return (single[i] * scale + lm.SMOOTHING) / (tokens * scale + lm.SMOOTHING * size)

            total = -math.log(alone(x[0]))
            for a, b, p in zip(x, x[1:], pairs(x)):
                follows = min(pair[p] / single[a], 1) if single[a] else alone(b)
                total -= math.log(lm.PAIR_WEIGHT * follows + (1 - lm.PAIR_WEIGHT) * alone(b))
            losses.append(total / len(x))
        out[d] = tuple(losses)
    return out


def test_losses_equal_plain_counting(spark, docs_of):
    rows = [(i, " ".join(words(i, 30 + i))) for i in range(25)] + [(90, None), (91, ""), (92, "a")]
    labels = spark.createDataFrame([(i, int(i % 3 == 0), 0) for i in range(25)] + [(3, 0, 1), (None, 1, 0)], LABELS)
    got = lm.cross_entropy_differences(docs_of(rows), labels, VOCABULARY).collect()
    want = brute(rows, [i for i in range(25) if i % 3 == 0])
    assert len(got) == len(rows)
    for r in got:
        target, background = want[r.doc_id]
        if target is None:
            assert (r.n_tokens, r.target_loss, r.background_loss, r.score) == (0, None, None, None)
        else:
            assert r.target_loss == pytest.approx(target) and r.background_loss == pytest.approx(background)
            assert r.score == pytest.approx(target - background)


def test_documents_like_the_target_score_lower(spark, docs_of):
    rows = [(i, " ".join(words(i, 60, ["river", "stone", "field"]))) for i in range(30)]
    rows += [(100 + i, " ".join(words(i, 60, ["engine", "wheel", "metal"]))) for i in range(30)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(15)] + [(100, 0, 0)], LABELS)
    got = {r.doc_id: r.score for r in lm.cross_entropy_differences(docs_of(rows), labels, VOCABULARY).collect()}
    assert max(got[i] for i in range(15, 30)) < min(got[100 + i] for i in range(30))


def test_awkward_documents(spark, docs_of, awkward):
    labels = spark.createDataFrame([], LABELS)
    got = lm.cross_entropy_differences(docs_of(awkward), labels, VOCABULARY).collect()
    assert len(got) == len(awkward) and all(r.score is None or math.isfinite(r.score) for r in got)
    assert lm.cross_entropy_differences(docs_of([]), labels, VOCABULARY).collect() == []


def test_pairs_are_told_apart(spark, docs_of, monkeypatch):
    every = np.array([(a, b) for a in range(1200) for b in range(1200)], np.uint32)
    assert len(np.unique(lm.pair_places(every.reshape(-1))[::2])) == len(every)

    # More pairs than 2^20 buckets hold apart, over several blocks, against counts of the pairs themselves.
    pick = random.Random(6)
    rows = [(i, " ".join("".join(pick.choices("abcdefghij", k=3)) for _ in range(900))) for i in range(60)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 60, 4)], LABELS)
    got = lm.cross_entropy_differences(docs_of(rows), labels, VOCABULARY, 5_000).collect()
    monkeypatch.setattr(lm, "pair_places", lambda x: np.array([int(a) * 2**32 + int(b) for a, b in zip(x, x[1:])]))
    want = brute(rows, range(0, 60, 4))
    assert len(got) == len(rows)
    for r in got:
        assert (r.target_loss, r.background_loss) == pytest.approx(want[r.doc_id], abs=1e-9)
