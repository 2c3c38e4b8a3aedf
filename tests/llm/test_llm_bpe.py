import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from hourfold.llm import bpe
from hourfold.llm.queries import VOCABULARY
from document_fixtures import awkward, docs_of  # noqa: F401


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def own():
    return bpe.Encoder(bpe.Vocabulary(VOCABULARY))


def ids_of(library, texts):
    return [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_same_ids_as_the_library_on_random_text(library, own):
    pick = random.Random(3)
    texts = [
        "".join(pick.choice("aeehtn ß'sśΣİK 1२<|>.\n日本\U0001f389é") for _ in range(pick.randrange(80)))
        for _ in range(2000)
    ]
    assert [x.tolist() for x in own.encode(texts)] == ids_of(library, texts)


def test_runs_of_equal_symbols_special_tokens_and_odd_white_space(library, own):
    texts = [
        "hehehehehe heheheshou " + "a" * 333, "<|endoftext|>x<|startoftext|> <|endof", "ΑΣ ΑΣΑ'S I'LL 's''t don't",
        "é é", "a\x1cb\x85c d", "", "  ", "'re'", "...!!!'s",
    ]
    assert [x.tolist() for x in own.encode(texts)] == ids_of(library, texts)


def test_what_is_remembered_may_be_dropped_at_any_time(library):
    small = bpe.Encoder(bpe.Vocabulary(VOCABULARY))
    small._pieces.most = 5
    texts = ["one two three four five six seven", "eight nine two", "one ten eleven twelve"]
    for _ in range(2):
        assert [x.tolist() for x in small.encode(texts)] == ids_of(library, texts)


def test_merge_words_equals_merging_one_pair_at_a_time():
    vocabulary = bpe.Vocabulary(VOCABULARY)

    def one_by_one(word):
        ids = [*vocabulary.inner[list(word[:-1])], vocabulary.last[word[-1]]]
        while len(ids) > 1:
            ranks = vocabulary.ranks(np.array(ids[:-1]), np.array(ids[1:]))
            best = int(ranks.argmin())
            if ranks[best] == np.iinfo(np.int64).max:
                break
            ids[best : best + 2] = [int(vocabulary.made[ranks[best]])]
        return ids

    pick = random.Random(8)
    some = ["".join(pick.choice("thenatiosr") for _ in range(pick.randrange(1, 24))).encode() for _ in range(300)]
    for word, ids in zip(some, bpe.merge_words(vocabulary, some), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == one_by_one(word)


def test_round_trip_of_awkward_documents(library, docs_of, awkward):
    rows = bpe.round_trip_digests(docs_of(awkward), VOCABULARY).collect()
    assert len(rows) == len(awkward)
    expected = []
    for (key, text, *_), ids in zip(awkward, ids_of(library, [r[1] or "" for r in awkward]), strict=True):
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append((
            key, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest(),
        ))
    assert sorted(map(tuple, rows), key=str) == sorted(expected, key=str)


def test_encode_then_decode(library, docs_of):
    docs = docs_of([(1, "Hello wörld's end"), (2, None)])
    encoded = bpe.encode_documents(docs, VOCABULARY)
    decoded = {r.doc_id: r.text for r in bpe.decode_documents(encoded, VOCABULARY).collect()}
    ids = library.encode("Hello wörld's end", add_special_tokens=False).ids
    assert decoded == {1: library.decode(ids, skip_special_tokens=False), 2: ""}


def test_empty_table(docs_of):
    assert bpe.round_trip_digests(docs_of([]), VOCABULARY).collect() == []
