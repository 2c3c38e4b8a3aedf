"""The registered queries of the numbered operators, over whole tables, and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    bpe, conversation_repair, edit_embedding, hilbert_neighbours, language_id, line_dedup, lm_scoring, order_minhash,
    packing, periodic_runs, pii, pivot_topk, secret_scan,
)
from .tasks import documents

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

#: The vocabulary that the token queries encode with.
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_edit_embedding(spark: SparkSession, d: str) -> DataFrame:
    return edit_embedding.edited_fingerprints(documents(spark, d))


@query
def op2_bpe_round_trip(spark: SparkSession, d: str) -> DataFrame:
    return bpe.round_trip_digests(documents(spark, d), VOCABULARY)


@query
def op3_lm_scoring(spark: SparkSession, d: str) -> DataFrame:
    labels = spark.read.schema("doc_id bigint, quality int, toxic int").parquet(f"{d}/labels.parquet")
    return lm_scoring.cross_entropy_differences(documents(spark, d), labels, VOCABULARY)


@query
def op4_pivot_topk(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.read.schema("vec_id bigint, embedding array<float>").parquet(f"{d}/embeddings.parquet")
    return pivot_topk.top_k(rows, F.col("vec_id") % 100 == 0)


@query
def op5_order_minhash(spark: SparkSession, d: str) -> DataFrame:
    """Class of every document; one document of each class is kept."""
    classes = order_minhash.near_duplicate_classes(documents(spark, d))
    return classes.withColumn("kept", F.col("doc_id") == F.col("class_id"))


@query
def op6_pii(spark: SparkSession, d: str) -> DataFrame:
    return pii.find_personal_data(documents(spark, d))


@query
def op7_language_id(spark: SparkSession, d: str) -> DataFrame:
    return language_id.identify(documents(spark, d))


@query
def op8_best_fit_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(documents(spark, d), VOCABULARY)


@query
def op9_secret_scan(spark: SparkSession, d: str) -> DataFrame:
    return secret_scan.find_secrets(documents(spark, d))


@query
def op10_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    out = line_dedup.dedup_lines(documents(spark, d))
    return out.select("doc.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_hilbert_neighbours(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.read.schema("vec_id bigint, embedding array<float>").parquet(f"{d}/embeddings.parquet")
    return hilbert_neighbours.nearest(rows, F.col("vec_id") % 20 == 0)


@query
def op12_conversation_repair(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.read.schema("conv_id bigint, turn bigint, role string, text string").parquet(f"{d}/conversations.parquet")
    return conversation_repair.repair(conversation_repair.damaged(rows))


@query
def op13_periodic_runs(spark: SparkSession, d: str) -> DataFrame:
    return periodic_runs.run_digests(documents(spark, d))


ORACLE["op4_pivot_topk"] = """
    WITH whole AS (
      SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
      WHERE vec_id IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    scored AS (
      SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM whole q JOIN whole c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 100 = 0),
    placed AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank
      FROM scored)
    SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= 10"""

ORACLE["op10_line_dedup"] = """
    WITH parts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    numbered AS (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS pos FROM parts),
    keyed AS (
      SELECT doc_id, pos, lines[pos] AS line,
             translate(trim(lines[pos], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
      FROM numbered),
    many AS (
      SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
      GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
    judged AS (
      SELECT k.*, m.key IS NOT NULL AND k.doc_id < m.keeper AS dropped
      FROM keyed k LEFT JOIN many m ON m.key = k.key)
    SELECT doc_id, count(*) AS n_lines,
           CAST(sum(CASE WHEN dropped THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
    FROM judged GROUP BY doc_id"""
