"""Catalog, code and vector views of the given tables, as DataFrames and as SQL for the cross-check.

The select lists are shared text, so both engines derive the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DIM = 64

# `part` as a catalog without vectors: about 150 (league, team) buckets, odd flag texts, some NULL leagues.
CATALOG = [
    "p_partkey AS product_id",
    "CASE WHEN p_size = 50 THEN NULL ELSE p_type END AS league",
    "p_brand AS team",
    "concat('maker ', CAST(p_partkey % 12 AS STRING)) AS brand",
    "concat('tone ', CAST(p_size % 9 AS STRING)) AS color",
    "p_name AS product_name",
    "concat('tier ', CAST(p_partkey % 6 AS STRING)) AS price_band",
    "CASE p_size % 5 WHEN 0 THEN ' TRUE ' WHEN 1 THEN 'false' WHEN 2 THEN 'yes' "
    "WHEN 3 THEN concat('True', chr(9)) END AS is_hot_market",
    "CASE p_size % 4 WHEN 0 THEN '0-7d' WHEN 1 THEN '8-30d' WHEN 2 THEN '31-90d' ELSE '91+d' END "
    "AS launch_age_bucket",
    "CAST(p_size % 16 AS INT) AS c1",
    "CAST((p_partkey * 7 + p_size) % 12 AS INT) AS c2",
    "CAST((p_partkey * 13) % 10 AS INT) AS c3",
]
CATALOG_WIDTH = 16

# `lineitem` as a large code table with a taxonomy of its own.
LINES = [
    "CAST(((l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey) * 10000 + l_suppkey AS BIGINT) AS product_id",
    "l_returnflag AS league",
    "concat(l_linestatus, CAST(l_suppkey % 10 AS STRING)) AS team",
    "CAST(l_partkey % 64 AS INT) AS c1",
    "CAST(l_suppkey % 32 AS INT) AS c2",
    "CAST(l_linenumber AS INT) AS c3",
]
LINES_WIDTH = 64
LEVELS = ["c1", "c2", "c3"]

# `embeddings` as a catalog with vectors; lengths differ from one, and some rows are malformed.
VECTOR_TAGS = [
    "vec_id AS product_id",
    "concat('G', CAST(label % 3 AS STRING)) AS league",
    "concat('T', CAST(label AS STRING)) AS team",
    "CASE WHEN vec_id % 6 = 0 THEN 'true' ELSE 'false' END AS is_hot_market",
]
_SCALED = "transform(embedding, x -> CAST(x * CAST(1 + vec_id % 5 AS DOUBLE) AS FLOAT))"
VECTORS = f"{_SCALED} AS content_embedding"
DAMAGED = f"""CASE vec_id % 17
  WHEN 3 THEN NULL
  WHEN 5 THEN slice({_SCALED}, 1, {DIM - 1})
  WHEN 7 THEN concat(slice({_SCALED}, 1, {DIM - 1}), array(CAST(NULL AS FLOAT)))
  WHEN 9 THEN concat(slice({_SCALED}, 1, {DIM - 1}), array(CAST('NaN' AS FLOAT)))
  ELSE {_SCALED} END AS content_embedding"""


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def catalog(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").selectExpr(*CATALOG)


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr(*LINES)


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").selectExpr(*VECTOR_TAGS, VECTORS)


def damaged_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").selectExpr(*VECTOR_TAGS, DAMAGED)


# ---- the same in SQL --------------------------------------------------------------------

_SCALED_SQL = "list_transform(embedding, lambda x: CAST(x * CAST(1 + vec_id % 5 AS DOUBLE) AS FLOAT))"
CATALOG_SQL = f"cat AS MATERIALIZED (SELECT {', '.join(CATALOG)} FROM part)"
LINES_SQL = f"big AS MATERIALIZED (SELECT {', '.join(LINES)} FROM lineitem)"
VECTORS_SQL = f"""emb AS MATERIALIZED (
  SELECT {', '.join(VECTOR_TAGS)}, {_SCALED_SQL} AS content_embedding FROM embeddings)"""
DAMAGED_SQL = f"""emb AS MATERIALIZED (
  SELECT {', '.join(VECTOR_TAGS)}, CASE vec_id % 17
    WHEN 3 THEN NULL
    WHEN 5 THEN list_slice(scaled, 1, {DIM - 1})
    WHEN 7 THEN list_concat(list_slice(scaled, 1, {DIM - 1}), [CAST(NULL AS FLOAT)])
    WHEN 9 THEN list_concat(list_slice(scaled, 1, {DIM - 1}), [CAST('nan' AS FLOAT)])
    ELSE scaled END AS content_embedding
  FROM (SELECT *, {_SCALED_SQL} AS scaled FROM embeddings))"""
VALID_SQL = f"""valid AS MATERIALIZED (
  SELECT * FROM emb WHERE content_embedding IS NOT NULL AND len(content_embedding) = {DIM}
    AND len(list_filter(content_embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIM})"""
UNIT_SQL = """unit AS MATERIALIZED (
  SELECT * EXCLUDE (content_embedding, norm), list_transform(content_embedding,
    lambda x: CASE WHEN norm > 0 THEN CAST(CAST(CAST(x AS DOUBLE) / norm AS FLOAT) AS DOUBLE) ELSE 0.0 END) AS v
  FROM (SELECT *, sqrt(list_sum(list_transform(content_embedding,
    lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS norm FROM valid))"""
MAPPING_SQL = """mapping AS MATERIALIZED (
  SELECT *, CAST(row_number() OVER (PARTITION BY c1, c2, c3 ORDER BY product_id) - 1 AS INT) AS dedup FROM cat)"""


def flag_sql(column: str) -> str:
    text = f"lower(regexp_replace({column}, '^\\s+|\\s+$', '', 'g'))"
    return f"CASE WHEN {text} = 'true' THEN true WHEN {text} = 'false' THEN false END"


def with_sql(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"
