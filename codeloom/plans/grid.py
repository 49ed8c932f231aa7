"""A sweep over configurations: every one trained, then all coded in one scan and counted in one aggregation."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom.functions.arrays import list_of, matrix_of
from codeloom.functions.kernels import quantize_rows, run_layers
from codeloom.functions.names import EMBEDDING, LEAGUE, TEAM, level_columns
from codeloom.operators.prepare import prepare
from codeloom.operators.quantize import BATCH_ROWS, INTS, Artifact
from codeloom.params import RunParams
from codeloom.plans.pipeline import Columns, split_rows, train_version
from codeloom.plans.quality import collision, collision_hot, collision_verdict, report_tables, utilization_hot
from codeloom.plans.sweep import run_sweep, run_verdict
from codeloom.session import stored
from codeloom.sources.catalog import read_catalog
from codeloom.sources.tables import artifact_exists, load_artifact, write_report

Config = tuple[int, int, int]


def code_grid(df: DataFrame, artifacts: dict[Config, Artifact], keep: list[str], column: str = EMBEDDING) -> DataFrame:
    """`keep`, W, L, d and codes (array) of every row under every model: one scan, no shuffle.

    The models are broadcast together; their size is that of the grid, not of the rows. The vector leaves with the scan.
    """
    for artifact in artifacts.values():
        artifact.check_input(True)
    models = df.sparkSession.sparkContext.broadcast([(list(a.codebooks), a.weights) for a in artifacts.values()])

    @F.arrow_udf(INTS)
    def run(vectors: pa.Array) -> pa.Array:
        parts = []
        for start in range(0, len(vectors), BATCH_ROWS):
            x = matrix_of(vectors.slice(start, BATCH_ROWS))
            codes = [quantize_rows(run_layers(x, weights, "encoder")[-1], books)[0] for books, weights in models.value]
            parts.append(np.concatenate(codes, axis=1))
        return list_of(np.concatenate(parts)) if parts else pa.array([], type=pa.list_(pa.int32()))

    cells, start = [], 1
    for w, depth, d in artifacts:
        codes = F.slice("codes_", start, depth).alias("codes")
        cells.append(F.struct(F.lit(w).alias("W"), F.lit(depth).alias("L"), F.lit(d).alias("d"), codes))
        start += depth
    return df.select(*keep, run(F.col(column)).alias("codes_")).select(*keep, F.inline(F.array(*cells)))


def grid_counts(coded: DataFrame, fields: list[str]) -> DataFrame:
    """Rows of each configuration, taxonomy and tuple of codes; combined before the one shuffle."""
    return coded.groupBy("W", "L", "d", *fields, "codes").agg(F.count(F.lit(1)).alias("n"))


def counts_of(counts: DataFrame, config: Config, fields: list[str]) -> DataFrame:
    """The counts of one configuration with a column per level."""
    w, depth, d = config
    own = counts.where((F.col("W") == w) & (F.col("L") == depth) & (F.col("d") == d))
    return own.select(*fields, *[F.col("codes")[i].alias(name) for i, name in enumerate(level_columns(depth))], "n")


def version_of(params: RunParams, config: Config) -> str:
    return "{}-W{}-L{}-d{}".format(params.code_version, *config)


def run_grid(
    spark: SparkSession, source: str, output: str, configs: list[Config], params: RunParams = RunParams(), columns: Columns = None,
) -> DataFrame:
    """Train, code and evaluate every (W, L, d); one verdict row each, as `select_config` takes them.

    The catalog is prepared and split once for the whole grid and coded in one scan for all models. Only the training reads its
    rows once per configuration. A sweep that was stopped keeps its finished configurations, and goes on within the others.
    """
    versions = {c: replace(params, code_version=version_of(params, c), quantizer=replace(params.quantizer, W=c[0], L=c[1], d=c[2])) for c in configs}
    missing = {c: own for c, own in versions.items() if not artifact_exists(spark, output, own.code_version)}
    if missing:
        with split_rows(spark, source, params, columns) as rows:
            for own in missing.values():
                train_version(spark, rows, output, own)
    artifacts = {c: load_artifact(spark, output, own.code_version) for c, own in versions.items()}
    fields = list(dict.fromkeys([LEAGUE, TEAM, *params.evaluation.taxonomy_fields]))
    ready = prepare(read_catalog(spark, source, columns), params.prep.embedding_dim)
    top_k = params.evaluation.hot_bucket_top_k
    with stored(grid_counts(code_grid(ready, artifacts, fields), fields), "grid", ["W", "L", "d"]) as counts:

        def verdict(w: int, depth: int, d: int) -> DataFrame:
            base, levels = counts_of(counts, (w, depth, d), fields), level_columns(depth)
            tables = report_tables(base, w, depth, d, top_k, params.evaluation.taxonomy_fields, base=base)
            write_report(spark, tables, f"{output.rstrip('/')}/report/code_version={version_of(params, (w, depth, d))}")
            crowding = collision_verdict(collision(base, levels), collision_hot(base, levels, top_k))
            return run_verdict(utilization_hot(base, levels, w, top_k), crowding)

        return run_sweep(spark, configs, verdict, f"{output.rstrip('/')}/sweep/code_version={params.code_version}")
