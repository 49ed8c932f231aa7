"""Frozen artifacts and the assignment of codes to rows."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeloom.functions.arrays import list_of, matrix_of
from codeloom.functions.kernels import quantize_rows, run_layers
from codeloom.functions.names import DEDUP, EMBEDDING, PRODUCT_ID, level_columns
from codeloom.operators.ranking import HOT_ROWS, ranked

BATCH_ROWS = 8192


@dataclass(frozen=True)
class Artifact:
    """A trained quantizer. Without weights the codebooks act on the normalised vector itself."""

    codebooks: np.ndarray  # levels x W x d
    weights: dict[str, np.ndarray] = field(default_factory=dict)
    d_in: int = 0
    normalize: bool = True
    embedding_set_version: str = ""
    code_version: str = ""
    metadata: dict[str, str] = field(default_factory=dict)

    @property
    def num_levels(self) -> int:
        return self.codebooks.shape[0]

    @property
    def width(self) -> int:
        return self.codebooks.shape[1]

    def with_codebooks(self, codebooks: np.ndarray) -> Artifact:
        return replace(self, codebooks=np.asarray(codebooks, dtype=np.float64))

    def check_input(self, normalized: bool) -> None:
        if normalized != self.normalize:
            raise ValueError("the artifact was trained on differently prepared vectors")


def model_function(spark: SparkSession, artifact: Artifact, step, result: T.DataType):
    """An Arrow function over vectors; the model (a few MB: widths, not rows) is broadcast once."""
    model = spark.sparkContext.broadcast((list(artifact.codebooks), artifact.weights))

    @F.arrow_udf(result)
    def run(vectors: pa.Array) -> pa.Array:
        books, weights = model.value
        parts = []
        for start in range(0, len(vectors), BATCH_ROWS):
            x = matrix_of(vectors.slice(start, BATCH_ROWS))
            parts.append(step(x, books, weights))
        if not parts:
            return pa.array([], type=pa.list_(pa.float64()))
        return list_of(np.concatenate(parts))

    return run


def _codes(x, books, weights):
    return quantize_rows(run_layers(x, weights, "encoder")[-1], books)[0]


def _latent(x, books, weights):
    return run_layers(x, weights, "encoder")[-1]


def _decoded(x, books, weights):
    z = run_layers(x, weights, "encoder")[-1]
    _, residuals = quantize_rows(z, books)
    return run_layers(z - residuals[-1], weights, "decoder")[-1]


def _errors(x, books, weights):
    """Squared norm of the residual after every level."""
    z = run_layers(x, weights, "encoder")[-1]
    _, residuals = quantize_rows(z, books)
    return np.stack([np.einsum("ij,ij->i", r, r) for r in residuals[1:]], axis=1)


INTS = T.ArrayType(T.IntegerType())
DOUBLES = T.ArrayType(T.DoubleType())


def _level_picks(column: str, num_levels: int) -> list[Column]:
    return [F.col(column)[i].alias(name) for i, name in enumerate(level_columns(num_levels))]


def assign_codes(
    df: DataFrame, artifact: Artifact, keep: list[str] | None = None, column: str = EMBEDDING,
    normalized: bool = True,
) -> DataFrame:
    """product_id, c1..cL for every prepared row. One pass, no shuffle; the vector is not kept."""
    artifact.check_input(normalized)
    run = model_function(df.sparkSession, artifact, _codes, INTS)
    keep = [PRODUCT_ID] if keep is None else keep
    coded = df.select(*keep, run(F.col(column)).alias("codes_"))
    return coded.select(*keep, *_level_picks("codes_", artifact.num_levels))


def encode(df: DataFrame, artifact: Artifact, column: str = EMBEDDING, out: str = "latent") -> DataFrame:
    run = model_function(df.sparkSession, artifact, _latent, DOUBLES)
    return df.withColumn(out, run(F.col(column)))


def reconstruct(df: DataFrame, artifact: Artifact, column: str = EMBEDDING, out: str = "decoded") -> DataFrame:
    """The vector the codes stand for: sum of codewords through the decoder."""
    run = model_function(df.sparkSession, artifact, _decoded, DOUBLES)
    return df.withColumn(out, run(F.col(column)))


def reconstruction_error(df: DataFrame, artifact: Artifact, column: str = EMBEDDING) -> DataFrame:
    """One row: n and the mean squared error per element."""
    from codeloom.functions.scalars import squared_distance

    decoded = reconstruct(df, artifact, column)
    per_row = squared_distance(column, "decoded") / F.size(column)
    return decoded.select(per_row.alias("mse")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("mse").alias("reconstruction_mse")
    )


def level_errors(df: DataFrame, artifact: Artifact, column: str = EMBEDDING) -> DataFrame:
    """Mean squared residual norm after each level."""
    run = model_function(df.sparkSession, artifact, _errors, DOUBLES)
    errors = df.select(run(F.col(column)).alias("errors"))
    exploded = errors.select(F.posexplode("errors").alias("pos", "error"))
    return exploded.groupBy((F.col("pos") + 1).alias("level")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("error").alias("mean_error")
    )


def add_dedup_index(df: DataFrame, levels: list[str], key: str = PRODUCT_ID, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Zero-based slot inside the code tuple, by ascending product id. Safe for a huge tuple."""
    placed = ranked(df, levels, [key], rank="rank_", hot_rows=hot_rows)
    return placed.withColumn(DEDUP, (F.col("rank_") - 1).cast("int")).drop("rank_")


def max_dedup(df: DataFrame, levels: list[str]) -> DataFrame:
    """One row: the largest slot (0 on an empty table) and the worst bucket size, from the tuple counts."""
    top = F.coalesce(F.max("size") - 1, F.lit(0)).cast("int")
    sizes = df.groupBy(*levels).agg(F.count(F.lit(1)).alias("size"))
    return sizes.agg(top.alias("max_dedup"), (top + 1).alias("worst_case_bucket"))
