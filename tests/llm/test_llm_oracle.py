import duckdb
import pytest

from hourfold.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    df = QUERIES[name](spark, SF_DIR)
    cursor = con.execute(ORACLE[name])
    order = [c[0] for c in cursor.description]
    assert sorted(order) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*order).collect())) == sorted(map(tuple, cursor.fetchall()))
