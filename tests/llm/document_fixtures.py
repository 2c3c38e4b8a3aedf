import random

import pytest
from pyspark.sql import functions as F

DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use for columns of their own.
CLASHING = ("key", "keys", "owner", "order", "range", "high", "low", "kept", "lost", "doc", "body", "group",
            "digest", "root", "id", "payload", "ids", "spans", "candidates", "email", "is_target")


def words(seed, many, names="alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()):
    pick = random.Random(seed)
    return [pick.choice(names) + str(pick.randrange(40)) for _ in range(many)]


@pytest.fixture(scope="session")
def awkward():
    """Rows that operators must bear: nulls, empty and very long texts, ties and repeated rows."""
    long = " ".join(words(1, 20_000))
    return [
        (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \n\t\n ", None, "a", 5),
        (4, "plain words of no great length here", "en", "b", 35), (5, "plain words of no great length here", "en", "b", 35),
        (6, long, "en", "a", len(long)), (6, long, "en", "a", len(long)),
        (7, "écrit en français, œuvre \U0001f600 déjà vu", "fr", None, 1), (None, "no id at all here", "en", "a", 3),
        (8, "x" * 50_000, None, "a", 1), (9, "!!! ... ???", "en", "a", 11), (10, "0" * 5_000, "en", "a", 1),
        (11, "\u0000\u001c   end", "en", "a", 2), (12, "The next line\nThe next line\nThe next line", "en", "a", 1),
    ]


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows, clashing=True):
        df = spark.createDataFrame([(*r, *(None,) * (5 - len(r))) for r in rows], DDL)
        return df.withColumns({c: F.lit("other") for c in CLASHING}) if clashing else df

    return make


@pytest.fixture(scope="session")
def sample(spark):
    """The whole documents table of the smallest size."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
