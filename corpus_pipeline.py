"""From documents to packed training sequences, in five stages.

Each stage gets what its predecessor kept, as a table that was written and read again, and its
decisions take effect: texts without a language go, lines that many documents share stay in one of
them, one document of each near-duplicate class stays, secrets give way to a mark, and what is left is
packed into sequences. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hourfold.llm import language_id, line_dedup, order_minhash, packing, secret_scan
from hourfold.llm.queries import VOCABULARY
from hourfold.llm.tasks import documents
from hourfold.sinks.files import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.identified(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.with_kept_text(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return order_minhash.one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.without_secrets(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, VOCABULARY)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secrets),
    ("packing", sequences),
]

#: SQL can express neither the language model nor the sketches; tests run a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir).select(docs.columns), name)
    return STAGES[-1][1](spark, docs, sf_dir)
