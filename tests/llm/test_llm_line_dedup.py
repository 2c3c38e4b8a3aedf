import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hourfold.llm import line_dedup as ld
from document_fixtures import awkward, docs_of, sample  # noqa: F401

BLANK = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    """(n_lines, n_dropped, kept text) per row."""
    def key(line):
        return line.strip(BLANK).translate(LOWER)

    many, keeper = Counter(), {}
    for doc_id, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            many[k] += 1
            keeper[k] = max(keeper.get(k, -1), -1 if doc_id is None else doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines
            if len(key(x)) < 20 or many[key(x)] < 3 or keeper[key(x)] == (-1 if doc_id is None else doc_id)
        ]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def got(docs):
    rows = ld.dedup_lines(docs).select("doc.doc_id", "n_lines", "n_dropped", "kept").collect()
    return sorted(map(tuple, rows), key=str)


def test_whole_table(sample):
    rows = [(r.doc_id, r.text) for r in sample.collect()]
    want = brute(rows)
    assert sum(r[2] for r in want) > 0
    assert got(sample) == sorted(want, key=str)


def test_keys(docs_of, awkward):
    shared = "This line is shared by many documents"
    rows = [(r[0], r[1]) for r in awkward] + [
        (21, f"one\n{shared}\n{shared}"), (22, f"\t {shared.upper()} \r\ntwo"), (23, f"{shared}\n\nthree"),
        (24, f"É{shared}\nshort line"), (25, f"é{shared}\nshort line"), (26, f"É{shared}\nshort line"),
        (27, " " + shared), (23, f"{shared}\n\nthree"), (28, "ÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉ"), (29, "ÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉ"), (30, "ÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉ"),
    ]
    assert got(docs_of(rows)) == sorted(brute(rows), key=str)


def test_columns_pass_through(docs_of, awkward):
    docs = docs_of(awkward)
    out = ld.with_kept_text(docs)
    assert out.columns == docs.columns
    by_id = {r.doc_id: r for r in out.collect()}
    assert by_id[4].high == "other" and by_id[1].text is None and by_id[4].n_chars == 35


def test_empty_table(docs_of):
    assert got(docs_of([])) == []


@pytest.mark.parametrize("batches", [1, 5])
def test_runs_hold_counts_and_owners_whatever_the_batches(spark, sample, batches):
    held = ld.held_lines(sample)
    runs = ld.ingest(spark, held, batches=batches, fanout=2)
    want = held.groupBy("high", "low").agg(F.max("owner").alias("owner"), F.count("*").alias("docs"))
    assert runs.merged().exceptAll(want).count() == want.exceptAll(runs.merged()).count() == 0
    assert runs.new(held).count() == 0
    assert sum(map(len, runs.levels)) <= 3


def test_new_lines_are_those_no_run_holds(spark, docs_of):
    runs = ld.LineRuns(spark)
    first = ld.held_lines(docs_of([(9, "a line of more than twenty characters")]))
    assert runs.new(first).count() == 1
    runs.add(first)
    second = ld.held_lines(docs_of([(8, "A LINE of more than twenty characters\nanother line of so many characters")]))
    assert runs.new(second).count() == 1


def test_query_digest(spark):
    from hourfold.llm.queries import QUERIES

    rows = QUERIES["op10_line_dedup"](spark, "/root/testdata/sf0.001").collect()
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = {d: (a, b, hashlib.sha256(t.encode()).hexdigest()) for d, a, b, t in brute([(r.doc_id, r.text) for r in table])}
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in rows} == want
