import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as cp
from hourfold.llm import bpe, links, order_minhash, secret_scan
from hourfold.llm.queries import VOCABULARY
from hourfold.sinks.files import stored
from test_llm_line_dedup import brute as line_brute
from test_llm_order_minhash import brute_classes
from document_fixtures import awkward, docs_of, sample, words  # noqa: F401


def test_each_stage_against_a_plain_version(spark, sample):
    """Every stage's rows from its own input; the last one packs exactly what is left."""
    docs = sample
    for name, stage in cp.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        made = stage(spark, docs, "/root/testdata/sf0.001")
        assert made.columns == sample.columns
        docs = stored(made, name)
        after = {r.doc_id: r for r in docs.collect()}
        if name == "language_id":
            assert set(after) == {d for d, r in before.items() if any(c.isalpha() for c in r.text or "")}
        elif name == "line_dedup":
            want = line_brute([(d, r.text) for d, r in before.items()])
            assert {d: r.text for d, r in after.items()} == {d: t for d, _, _, t in want}
        elif name == "near_duplicates":
            classes = brute_classes([(d, r.text) for d, r in before.items()])
            assert set(after) == {d for d, c in classes.items() if d == c}
        else:
            assert set(after) == set(before)
            for d, r in after.items():
                assert r.text == secret_scan.redacted(before[d].text, secret_scan.scan(before[d].text)[1])
                assert not secret_scan.base_spans(r.text) and r.n_chars == len(r.text)
    packed = cp.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001").collect()
    own = bpe.Encoder(bpe.Vocabulary(VOCABULARY))
    lengths = {r.doc_id: len(own.encode([r.text])[0]) + 1 for r in docs.collect()}
    held = {}
    for r in packed:
        held[r.doc_id] = held.get(r.doc_id, 0) + r.length
    assert held == lengths
    used = len({r.sequence_id for r in packed})
    assert used <= np.ceil(sum(lengths.values()) / 4096) + 1


def test_awkward_documents_pass_all_stages(spark, docs_of, awkward):
    docs = docs_of(awkward, clashing=False)
    for name, stage in cp.STAGES:
        docs = stored(stage(spark, docs, ""), name)
    assert docs.count() > 0
    empty = docs_of([], clashing=False)
    for _, stage in cp.STAGES:
        empty = stage(spark, empty, "")
    assert empty.collect() == []


def test_stages_judge_rows_by_their_own_text(spark, docs_of):
    """Different texts under one doc_id, or under none, are different documents; repeated rows are one."""
    one, other, third = ("the quick brown fox jumps over the lazy dog " * 5 + f"{i} " + f"word{i} " * 40 for i in range(3))
    rows = [(1, one), (1, other), (2, ""), (2, third), (3, third + " end"), (1, one), (None, other), (None, "alone with its words here")]
    docs = docs_of([(*r, "en") for r in rows], clashing=False)
    for name, stage in cp.STAGES[:1] + cp.STAGES[2:3]:
        docs = stored(stage(spark, docs, ""), name)
    got = sorted(((r.doc_id, r.text) for r in docs.collect()), key=str)
    assert got == sorted([(1, one), (1, other), (2, third), (None, "alone with its words here")], key=str)


def test_variants_too_far_apart_are_compared_in_few_rows(spark, docs_of, monkeypatch):
    """Their buckets are large and hold no large component; each text is handed to a comparison a few times."""
    pick, base = random.Random(4), words(900, 150)
    rows = [(k, " ".join(w if pick.random() > 0.08 else f"own{k}x{i}" for i, w in enumerate(base))) for k in range(700)]
    docs = docs_of(rows, clashing=False)
    want = {r.class_id for r in order_minhash.near_duplicate_classes(docs, 10**6).collect()}  # all pairs of a bucket
    many, verified = [], links.verified_links

    def counted(found, *rest):
        many.append(found.agg(F.sum(F.size("members"))).first()[0])
        return verified(found, *rest)

    monkeypatch.setattr(links, "verified_links", counted)
    kept = cp.near_duplicates(spark, docs, "")
    assert {r.doc_id for r in kept.collect()} == want and 100 < len(want) < 700
    assert len(many) == 2 and many[1] < 700 * 20
