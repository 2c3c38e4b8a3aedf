import hashlib
import random
import re
from collections import Counter

import pytest

from hourfold.llm import pii
from document_fixtures import awkward, docs_of, sample  # noqa: F401


@pytest.fixture
def untrained(monkeypatch):
    """Base spans only: training takes some seconds."""
    monkeypatch.setattr(pii, "EXAMPLES", 10**9)


def luhn(text):
    digits = [int(c) for c in text if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits)) % 10 == 0


def digits(text):
    return sum(c in "0123456789" for c in text)


def brute(text):
    """The base spans by the plain patterns."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [
        ("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
        if all(int(p) <= 255 for p in m[0].split("."))
    ]
    out += [
        ("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
        if 13 <= digits(m[0]) <= 19 and luhn(m[0])
    ]
    out += [
        ("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= digits(m[0]) <= 15
    ]
    return out


def check(rows, texts):
    assert len(rows) == len(texts)
    want = {d: brute(t or "") for d, t in texts}
    for r in rows:
        base = want[r.doc_id]
        counts = Counter(kind for kind, _, _ in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(counts[k] for k in pii.KINDS)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert not joined or r.spans.startswith(joined)


def test_whole_table(sample):
    check(pii.find_personal_data(sample).collect(), [(r.doc_id, r.text) for r in sample.collect()])


def test_random_texts(docs_of, untrained):
    pick = random.Random(6)
    parts = ["a@b.co", "@", ".", "x_y@z.w", "1.2.3.4", "256.1.1.1", "4111111111111111", "4111 1111-1111 1111", "+1 (555) 010-9999", "+", "-",
             " ", "  ", "12", "0", "9", "é", "\U0001f600", "a@b.c@d.e", "_", "007.08.09.010", "\n", "(", ")", "1234567890123456789",
             " joe(at)mail.com ", " DE44 5001 0517 5407 3249 31 ", " 00:1B:44:11:3A:B7 "]
    rows = [(i, "".join(pick.choice(parts) for _ in range(pick.randrange(30)))) for i in range(1500)]
    check(pii.find_personal_data(docs_of(rows)).collect(), rows)


def test_long_texts_take_linear_time(docs_of, untrained):
    """The plain patterns would search some of these for hours."""
    rows = [
        (1, "1" * 100_000), (2, "a" * 200_000 + "@"), (3, "1 " * 60_000), (4, "+" + "1" * 100_000), (5, "1." * 8_000),
        (6, "a@b.c " * 300), (7, "+1" + " " * 100_000),
    ]
    found = {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone) for r in pii.find_personal_data(docs_of(rows)).collect()}
    assert found == {i: (0, 0, 0, 0) for i in (1, 2, 3, 4, 7)} | {5: (0, 2_000, 0, 0), 6: (300, 0, 0, 0)}


def test_awkward_documents(docs_of, awkward, untrained):
    check(pii.find_personal_data(docs_of(awkward)).collect(), [r[:2] for r in awkward])
    assert pii.find_personal_data(docs_of([])).collect() == []


def test_trees_select_what_resembles_confirmed_spans(docs_of):
    """Numbers in a phone's place and form are found without the plus; order numbers are left alone."""
    pick = random.Random(11)

    def number():
        return f"({pick.randrange(200, 999)}) 555-{pick.randrange(1000, 9999)}"

    rows = [(i, f"please call me at +1 {number()} today") for i in range(400)]
    rows += [(1000 + i, f"the order no. {pick.randrange(10**9, 10**10)} has left the building") for i in range(400)]
    selector = pii.train(docs_of(rows))
    assert selector.trees and 0 < selector.thresholds["number"] <= 1
    asked = docs_of([(1, f"call me at 1 {number()} now"), (2, "the order no. 1234567890 has left"), (3, "nothing")])
    found = {r.doc_id: r for r in pii.with_spans(asked, selector).collect()}
    assert len(found[1].more) == 1 and not found[2].more and not found[3].more
    clean = {r.doc_id: r.text for r in pii.redacted(asked, selector).collect()}
    assert clean[1] == "call me at [PII] now" and clean[3] == "nothing"


def test_numbers_without_a_check_digit_are_left_alone(docs_of):
    """Half of the numbers in the same place and form are cards."""
    pick = random.Random(12)
    numbers = ["".join(pick.choice("0123456789") for _ in range(16)) for _ in range(9000)]
    cards, others = [n for n in numbers if luhn(n)][:400], [n for n in numbers if not luhn(n)][:400]
    rows = [(i, f"the number {n} was noted") for i, n in enumerate(cards + others)]
    found = {r.doc_id: (r.n_card, r.spans) for r in pii.find_personal_data(docs_of(rows)).collect()}
    assert all(found[i] == (1, "card:11:27") for i in range(400))
    assert all(found[400 + i] == (0, "") for i in range(400))


def test_redaction_merges_spans(docs_of):
    none = pii.Selector([], [], {}, [])
    (row,) = pii.redacted(docs_of([(1, "\U0001f600 mail a@b.co or 10.0.0.1!")]), none).collect()
    assert row.text == "\U0001f600 mail [PII] or [PII]!"


def test_plan_has_no_python(spark, untrained):
    from hourfold.llm.queries import QUERIES

    for name in ("op6_pii", "op10_line_dedup"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def iban(pick):
    body = "".join(pick.choice("0123456789") for _ in range(18))
    code = f"DE{98 - int(body + '131400') % 97:02d}{body}"
    return " ".join(code[i : i + 4] for i in range(0, len(code), 4))


def test_each_generator_selects_its_own_form(docs_of):
    pick = random.Random(13)

    def device(size=2):
        return ":".join("".join(pick.choice("0123456789ABCDEF") for _ in range(size)) for _ in range(6))

    def code():
        return "QX" + "".join(pick.choice("0123456789") for _ in range(14))

    rows = [(i, f"write to joe{i}(at)mail{i % 7}[dot]com soon") for i in range(200)]
    rows += [(1000 + i, f"see item{i}(at)shelf.4{i} there") for i in range(200)]
    rows += [(2000 + i, f"my bank account is {iban(pick)} as ever") for i in range(200)]
    rows += [(3000 + i, f"the part {code()} is in stock") for i in range(200)]
    rows += [(4000 + i, f"the client has {device()} on it") for i in range(200)]
    rows += [(5000 + i, f"the ratio was {device(1)} in all") for i in range(200)]
    rows += [(6000 + i, f"please call me at +1 (555) 555-{1000 + i} today") for i in range(200)]
    rows += [(7000 + i, f"the order no. {10**9 + 7 * i} has left the building") for i in range(200)]
    selector = pii.train(docs_of(rows))
    assert set(selector.thresholds) == {"number", "address", "account", "device"}
    number = iban(pick)
    asked = docs_of([
        (1, "write to ann(at)post[dot]com soon"), (2, f"my bank account is {number} as ever"),
        (3, "the client has 00:1B:44:11:3A:B7 on it"), (4, f"the part {code()} is in stock"),
        (5, "the ratio was 1:2:3:4:5:6 in all"),
    ])
    clean = {r.doc_id: r.text for r in pii.redacted(asked, selector).collect()}
    assert clean[1] == "write to [PII] soon" and clean[2] == "my bank account is [PII] as ever"
    assert clean[3] == "the client has [PII] on it"
    assert "[PII]" not in clean[4] and "[PII]" not in clean[5]


def test_rare_examples_are_found_in_the_whole_table(docs_of):
    rows = [(i, f"please call me at +1 (555) 555-{1000 + i} today") for i in range(60)]
    rows += [(1000 + i, f"the order no. {10**9 + 7 * i} has left the building") for i in range(1500)]
    selector = pii.train(docs_of(rows), sample=60)
    assert selector.trees and "number" in selector.thresholds


def test_thresholds_bear_single_counter_examples():
    rows = [("number", 99, 0, 1), ("number", 98, 500, 500), ("number", 60, 1, 10), ("device", 70, 9, 10)]
    assert pii.thresholds(rows) == {"number": 0.98}
