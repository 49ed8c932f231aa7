"""Queries on what the jobs write: published versions, the mapping, report texts, file lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from codeloom.functions.names import EMBEDDING, PRODUCT_ID
from codeloom.operators.training import probe_rows
from codeloom.params import PrepParams, QuantizerParams, RunParams
from codeloom.plans import lookup as lk
from codeloom.plans.pipeline import run_assignment, run_evaluation
from codeloom.session import new_table_path
from codeloom.sources.catalog import read_assignments, read_mapping, read_taxonomy, source_files
from codeloom.sources.tables import publish_assignment, save_artifact, write_full_mapping
from codeloom.workload.quantized import CODED_SQL, CODES, DEPTH, LLOYD, SEED, WIDTH, prepared, residual_sql, seeded_model
from codeloom.workload.relational import COMPARE_SQL, hashed, mapping, pairs, register
from codeloom.workload.views import (
    CATALOG_SQL,
    DAMAGED_SQL,
    DIM,
    LEVELS,
    MAPPING_SQL,
    UNIT_SQL,
    VALID_SQL,
    VECTORS_SQL,
    catalog,
    damaged_vectors,
    vectors,
    with_sql,
)


@register(
    "evaluate_published",
    with_sql(*residual_sql(LLOYD), CODED_SQL)
    + f"""SELECT (SELECT count(*) FROM coded) AS n_published, count(*) AS n,
      round(count(*) FILTER (n_t > 1) / CAST(count(*) AS DOUBLE), 8) AS collision_rate, max(n_t) AS worst_case_bucket,
      round(CAST(1 AS DOUBLE) - count(DISTINCT c1) / CAST({WIDTH} AS DOUBLE), 8) AS dead_code_rate_1,
      round(CAST(1 AS DOUBLE) - count(DISTINCT c2) / CAST({WIDTH} AS DOUBLE), 8) AS dead_code_rate_2,
      TRUE AS same_as_tables FROM (SELECT c1, c2, count(*) OVER (PARTITION BY c1, c2) AS n_t FROM coded)""",
)
def evaluate_published(spark, sf):
    """Assign a written catalog, publish, evaluate the published version; the figures come from the JSON report it wrote."""
    source, output = new_table_path(spark, "catalog"), new_table_path(spark, "output")
    damaged_vectors(spark, sf).write.parquet(source)
    params = RunParams(
        prep=PrepParams(embedding_dim=DIM), quantizer=QuantizerParams(W=WIDTH, L=DEPTH, d=DIM), code_version="first"
    )
    save_artifact(spark, seeded_model(spark, sf, LLOYD), output, "first", "set-1", {})
    published = run_assignment(spark, source, output, params)
    run_evaluation(spark, source, output, params)
    base = f"{output}/report/code_version=first"
    text = spark.read.text(f"{base}/json", wholetext=True).withColumnRenamed("value", "report")

    def told(path: str, kind: str):
        return F.get_json_object("report", f"$.{path}").cast(kind)

    table = spark.read.parquet(f"{base}/collision").agg(F.max("collision_rate").alias("rate")).first()["rate"]
    return text.select(
        F.lit(published.count()).cast("long").alias("n_published"),
        told("collision.global.n", "long").alias("n"),
        F.round(told("collision.global.collision_rate", "double"), 8).alias("collision_rate"),
        told("collision.global.worst_case_bucket", "long").alias("worst_case_bucket"),
        *[
            F.round(told(f"utilization.global.{code}.dead_code_rate", "double"), 8).alias(f"dead_code_rate_{at + 1}")
            for at, code in enumerate(CODES)
        ],
        (told("collision.global.collision_rate", "double") == F.lit(table)).alias("same_as_tables"),
    )


@register(
    "set_version_kept",
    with_sql(CATALOG_SQL, MAPPING_SQL)
    + """SELECT product_id, dedup, CASE WHEN c1 % 2 = 0 THEN 'even' ELSE 'odd' END AS embedding_set_version, 'v7' AS code_version FROM mapping""",
)
def set_version_kept(spark, sf):
    """A set version that the rows carry is not replaced by that of the run."""
    path = new_table_path(spark, "published")
    own = F.when(F.col("c1") % 2 == 0, "even").otherwise("odd")
    codes = mapping(spark, sf).select(PRODUCT_ID, *LEVELS, "dedup", own.alias("embedding_set_version"))
    publish_assignment(codes, path, "v7", "of the run", len(LEVELS))
    return read_assignments(spark, path, "v7").select(PRODUCT_ID, "dedup", "embedding_set_version", "code_version")


@register(
    "mapping_written",
    with_sql(CATALOG_SQL, MAPPING_SQL)
    + """SELECT product_id, concat(c1, '-', c2, '-', c3, '-', dedup) AS code_id, league, (SELECT count(*) FROM mapping) AS n_written FROM mapping""",
)
def mapping_written(spark, sf):
    """The stored mapping, with the number of rows that was observed while it was written."""
    path = new_table_path(spark, "mapping")
    source = catalog(spark, sf).drop(*LEVELS)
    written = write_full_mapping(mapping(spark, sf).select(PRODUCT_ID, *LEVELS, "dedup"), source, path)
    return read_mapping(spark, path).select(PRODUCT_ID, "code_id", "league", F.lit(written).cast("long").alias("n_written"))


@register("taxonomy_only", with_sql(VECTORS_SQL) + "SELECT product_id, league, team, is_hot_market FROM emb")
def taxonomy_only(spark, sf):
    """Every column of a written catalog but the vector."""
    path = new_table_path(spark, "catalog")
    vectors(spark, sf).write.parquet(path)
    return read_taxonomy(spark, path)


@register(
    "source_file_list",
    with_sql(CATALOG_SQL) + "SELECT 'c3=' || c3 AS folder, TRUE AS has_files, TRUE AS has_bytes FROM cat GROUP BY c3",
)
def source_file_list(spark, sf):
    """The files of a catalog in folders, by name and size, without a look at their content."""
    path = new_table_path(spark, "catalog")
    catalog(spark, sf).select(PRODUCT_ID, "c3").write.partitionBy("c3").parquet(path)
    listed = source_files(spark, f"{path}/c3=*")
    folder = F.substring_index("name", "/", 1).alias("folder")
    return listed.groupBy(folder).agg((F.count(F.lit(1)) > 0).alias("has_files"), (F.min("size") > 0).alias("has_bytes"))


@register(
    "index_not_built",
    with_sql(*COMPARE_SQL)
    + """SELECT pa AS product_id_a, pb AS product_id_b, CAST(NULL AS DOUBLE) AS cosine_similarity,
      CASE WHEN b.product_id IS NOT NULL THEN 'Embedding index not built.' END AS cosine_unavailable_reason,
      CASE WHEN b.product_id IS NULL THEN concat('product_id(s) not found: ', pb) END AS error FROM sides""",
)
def index_not_built(spark, sf):
    compared = lk.compare(pairs(spark, sf), mapping(spark, sf))
    return compared.select("product_id_a", "product_id_b", "cosine_similarity", "cosine_unavailable_reason", "error")


@register(
    "table_or_sample",
    with_sql(DAMAGED_SQL, VALID_SQL, UNIT_SQL)
    + f"""SELECT product_id, TRUE AS in_table, row_number() OVER (ORDER BY {hashed('product_id', SEED, 'init')}, product_id) <= 100 AS in_sample FROM unit""",
)
def table_or_sample(spark, sf):
    """Rows for a start or a reset: the whole table, or an exact number of its rows by hash."""
    rows = prepared(spark, sf).select(PRODUCT_ID, EMBEDDING)
    total = rows.count()
    whole = probe_rows(rows, None, total, SEED, "init").select(PRODUCT_ID, F.lit(True).alias("in_table"))
    sample = probe_rows(rows, 100, total, SEED, "init").select(PRODUCT_ID, F.lit(True).alias("drawn"))
    joined = whole.join(sample, PRODUCT_ID, "left")
    return joined.select(PRODUCT_ID, "in_table", F.coalesce("drawn", F.lit(False)).alias("in_sample"))
