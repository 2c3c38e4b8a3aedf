import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourfold.llm import hilbert_neighbours as hn

DDL = "vec_id bigint, embedding array<float>, rank string, score string, point string, query string, block string, digest string"


def brute(rows, k=20):
    """Exact search over rows that count."""
    held = {}
    for key, vector in rows:
        if key is None or vector is None or any(x is None or not np.isfinite(x) for x in vector) or not any(vector):
            continue
        whole = [float(np.float32(x)) for x in vector]
        held[key] = min(held.get(key, whole), whole)
    out = []
    for q in held:
        if q % 20 == 0:
            scores = []
            for i, v in held.items():
                if i != q and len(v) == len(held[q]):
                    total = 0.0
                    for a, b in zip(held[q], v):
                        total += a * b
                    scores.append((-total, i))
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def search(spark, rows):
    table = spark.createDataFrame(
        [(i, None if v is None else [None if x is None else float(x) for x in v], *[""] * 6) for i, v in rows], DDL
    )
    return sorted(map(tuple, hn.nearest(table, F.col("vec_id") % 20 == 0).collect()))


def test_curve_visits_neighbouring_cells():
    for many, bits in ((2, 4), (3, 3), (5, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=many)))
        number = hn.hilbert(cells, bits)
        assert sorted(number.tolist()) == list(range(len(cells)))
        steps = np.abs(np.diff(cells[np.argsort(number)], axis=0)).sum(1)
        assert (steps == 1).all()


def test_small_table_is_searched_whole(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    got = sorted(map(tuple, hn.nearest(table, F.col("vec_id") % 20 == 0).collect()))
    assert got == brute([(r.vec_id, r.embedding) for r in table.collect()])


def test_copies_ties_and_norms(spark):
    """Many equal vectors, and vectors of very different norms, are found exactly in a small table."""
    pick = np.random.default_rng(5)
    rows = [(i, (pick.normal(size=6) * 2.0 ** (i % 3 * 4)).round(2).tolist()) for i in range(150)]
    rows += [(1000 + i, rows[7][1]) for i in range(300)] + [(2000 + i, rows[2][1]) for i in range(3)]
    pick.shuffle(rows)
    assert search(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (0, [1, 2]), (20, [0.5, -0.25]), (40, None), (60, [1, None]), (80, [1, float("nan")]), (100, [float("inf"), 1]),
        (None, [1, 2]), (7, [1, 2]), (8, [3, 4]), (8, [3, 4]), (8, [2, 4]), (120, [1, 2, 3]), (140, []), (9, [0, 0]),
        (160, [0, 0]), (180, [-1e-30, 5e-30]), (200, [3e30, 1]),
    ]
    assert search(spark, rows) == brute(rows)
    assert search(spark, []) == []
    assert search(spark, [(20, [1, 1])]) == []


@pytest.mark.parametrize("folder", ["sf0.1"])
def test_recall_of_small_blocks(spark, monkeypatch, folder):
    """Blocks of a few hundredths of the table: most neighbours are found, and every score is exact."""
    monkeypatch.setattr(hn, "LEAST_BLOCK", 100)
    monkeypatch.setattr(hn, "MOST_BLOCK", 100)
    table = spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet")
    got = hn.nearest(table, F.col("vec_id") % 20 == 0).toPandas()
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    want = {(q, i): s for q, _, i, s in brute(rows)}
    found = {(q, i): s for q, i, s in zip(got["query_id"], got["vec_id"], got["score"])}
    assert len(got) == len(found) == len(want)
    assert sum(pair in found for pair in want) >= 0.95 * len(want)
    assert all(found[pair] == s for pair, s in want.items() if pair in found)
    assert (got.sort_values(["query_id", "rank"]).groupby("query_id")["score"].diff().dropna() <= 0).all()
