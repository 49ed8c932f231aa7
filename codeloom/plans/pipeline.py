"""The three jobs end to end: train, assign and publish, evaluate."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom.functions.names import ID_VERSION, LEAGUE, PRODUCT_ID, TEAM, level_columns
from codeloom.operators.prepare import prepare
from codeloom.operators.quantize import Artifact, add_dedup_index, assign_codes
from codeloom.operators.resume import forget
from codeloom.operators.sampling import add_sample_weight, with_split
from codeloom.operators.training import EpochStats, history_frame, train_quantizer
from codeloom.params import RunParams
from codeloom.plans.quality import base_counts, report_tables
from codeloom.session import stored
from codeloom.sources.catalog import read_assignments, read_catalog
from codeloom.sources.tables import (
    artifact_exists,
    artifact_path,
    assert_unique,
    load_artifact,
    publish_assignment,
    save_artifact,
    write_report,
)

Columns = dict[str, Column | str] | None


def run_training(
    spark: SparkSession, source: str, output: str, params: RunParams = RunParams(),
    columns: Columns = None, warm_start: str | None = None,
) -> tuple[str, list[EpochStats]]:
    """Prepare, split, weight, train, save. `warm_start` names an earlier version under `output`.

    Epochs are kept under `training/` until the artifact is complete: a job that was stopped goes on when it is run again.
    """
    if artifact_exists(spark, output, params.code_version):
        raise FileExistsError(f"version {params.code_version} already exists under {output}")
    prior = load_artifact(spark, output, warm_start) if warm_start else None
    with split_rows(spark, source, params, columns) as rows:
        return train_version(spark, rows, output, params, prior)


@contextmanager
def split_rows(spark: SparkSession, source: str, params: RunParams, columns: Columns = None) -> Iterator[DataFrame]:
    """Prepared rows with `is_val`, as a table inside the block."""
    prep = params.prep
    ready = prepare(read_catalog(spark, source, columns), prep.embedding_dim)
    split = with_split(ready, prep.val_fraction, prep.split_seed, list(prep.strata_columns))
    with stored(split, "split", ["is_val"]) as rows:
        yield rows


def train_version(
    spark: SparkSession, rows: DataFrame, output: str, params: RunParams, prior: Artifact | None = None
) -> tuple[str, list[EpochStats]]:
    """Weight and train on split rows, save the artifact with its history."""
    prep, weights = params.prep, params.weights
    state = f"{output.rstrip('/')}/training/{ID_VERSION}={params.code_version}"
    train = add_sample_weight(
        rows.where(~F.col("is_val")),
        weights.hot_bucket_top_k, weights.hot_bucket_weight, weights.hot_market_weight,
    )
    artifact, history = train_quantizer(
        train, rows.where("is_val"), prep.embedding_dim, params.quantizer, params.training, prior, state
    )
    path = artifact_path(output, params.code_version)
    history_frame(spark, history).coalesce(1).write.mode("overwrite").parquet(f"{path}/history")
    save_artifact(spark, artifact, output, params.code_version, prep.embedding_set_version, artifact.metadata)
    forget(spark, state)
    return path, history


def run_assignment(
    spark: SparkSession, source: str, output: str, params: RunParams = RunParams(), columns: Columns = None
) -> DataFrame:
    """Code every valid row, break collisions, publish; returns the published version."""
    artifact = load_artifact(spark, output, params.code_version)
    ready = prepare(read_catalog(spark, source, columns), params.prep.embedding_dim)
    with stored(assign_codes(ready, artifact), "codes") as coded:
        assert_unique(coded)
        slotted = add_dedup_index(coded, level_columns(artifact.num_levels))
        publish_assignment(
            slotted, output, params.code_version, params.prep.embedding_set_version, artifact.num_levels
        )
    return read_assignments(spark, output, params.code_version)


def joined_assignments(assignments: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Published rows that found a source row, with its taxonomy."""
    return assignments.join(taxonomy, PRODUCT_ID, "inner")


def run_evaluation(
    spark: SparkSession, source: str, output: str, params: RunParams = RunParams(), columns: Columns = None
) -> dict:
    """Count once, write the report tables and texts, return the nested report."""
    fields = list(dict.fromkeys([LEAGUE, TEAM, *params.evaluation.taxonomy_fields]))
    taxonomy = read_catalog(spark, source, columns).select(PRODUCT_ID, *fields)
    published = read_assignments(spark, output, params.code_version)
    levels = level_columns(params.quantizer.L)
    report = f"{output.rstrip('/')}/report/code_version={params.code_version}"
    with stored(base_counts(joined_assignments(published, taxonomy), levels, fields), "counts") as counts:
        tables = report_tables(
            counts, params.quantizer.W, params.quantizer.L, params.quantizer.d,
            params.evaluation.hot_bucket_top_k, params.evaluation.taxonomy_fields, base=counts,
        )
        return write_report(spark, tables, report)
