"""Published codes, full mapping, vector index, artifacts and report files."""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from codeloom.functions.names import (
    DEDUP,
    EMBEDDING,
    ID_STRING,
    ID_VERSION,
    METADATA_COLUMNS,
    PRODUCT_ID,
    SET_VERSION,
    discover_levels,
    output_columns,
)
from codeloom.functions.scalars import id_string
from codeloom.operators.prepare import is_valid, l2_normalize
from codeloom.operators.quantize import Artifact
from codeloom.sources.catalog import assignments_path, file_name, source_files

# ---- published codes --------------------------------------------------------------------


def published_columns(df: DataFrame, version: str, set_version: str, num_levels: int) -> DataFrame:
    """Codes and slots with both version tags; a set version already in the data is kept."""
    tagged = df.withColumn(ID_VERSION, F.lit(version))
    if SET_VERSION not in df.columns:
        tagged = tagged.withColumn(SET_VERSION, F.lit(set_version))
    return tagged.select(*output_columns(num_levels))


def publish_assignment(
    df: DataFrame, output_path: str, version: str, set_version: str, num_levels: int
) -> str:
    """Write one version. A rerun replaces that version and leaves the others alone."""
    path = assignments_path(output_path)
    (
        published_columns(df, version, set_version, num_levels)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(ID_VERSION)
        .parquet(path)
    )
    return path


def duplicate_keys(df: DataFrame, key: str = PRODUCT_ID) -> DataFrame:
    """Keys that occur more than once; must be empty before publishing."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def assert_unique(df: DataFrame, key: str = PRODUCT_ID) -> None:
    if not duplicate_keys(df, key).isEmpty():
        raise ValueError(f"'{key}' is not unique")


# ---- full mapping -----------------------------------------------------------------------


def full_mapping(assignments: DataFrame, source: DataFrame, metadata: list[str] | None = None) -> DataFrame:
    """Codes, id string and catalog metadata; products without metadata stay."""
    levels = discover_levels(assignments.columns)
    wanted = [c for c in (METADATA_COLUMNS if metadata is None else metadata)]
    codes = assignments.select(PRODUCT_ID, *levels, DEDUP)
    joined = codes.join(source.select(PRODUCT_ID, *wanted), PRODUCT_ID, "left")
    return joined.select(PRODUCT_ID, id_string(levels).alias(ID_STRING), *levels, DEDUP, *wanted)


def write_full_mapping(assignments: DataFrame, source: DataFrame, path: str) -> int:
    """Write the mapping; the row count is observed during the write."""
    seen = Observation("mapping")
    rows = full_mapping(assignments, source).observe(seen, F.count(F.lit(1)).alias("rows"))
    rows.write.mode("overwrite").parquet(path)
    return int(seen.get["rows"])


# ---- vector index -----------------------------------------------------------------------


def index_counts(source: DataFrame, dim: int) -> DataFrame:
    """Raw and valid rows of every source file."""
    flagged = source.select(
        file_name(F.col("_metadata.file_path")).alias("name"),
        is_valid(dim).alias("valid"),
    )
    return flagged.groupBy("name").agg(
        F.count(F.lit(1)).alias("raw_rows"), F.count_if("valid").alias("valid_rows")
    )


def _builds(spark: SparkSession, index_path: str) -> dict[int, bool]:
    """The numbers of the builds of an index, and whether each is finished: its facts are written last."""
    base = index_path.rstrip("/")
    where = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
    return {int(n[6:]): _is_complete(spark, f"{base}/{n}/meta") for n in names if n.startswith("build=")}


def index_build(spark: SparkSession, index_path: str) -> str | None:
    """Folder of the newest finished build; None if there is none."""
    finished = [number for number, done in _builds(spark, index_path).items() if done]
    return f"{index_path.rstrip('/')}/build={max(finished)}" if finished else None


def build_index(
    spark: SparkSession, source_path: str, index_path: str, dim: int = 128, force: bool = False,
    columns: dict[str, str] | None = None,
) -> DataFrame:
    """Write normalised valid vectors by key, the file list and one row of build facts.

    Without `force` an existing index is an error. Every build has a folder of its own and counts from the moment its
    facts are there, so a build that breaks off leaves the one before as it was. That one stays for its readers
    until the next build; older ones are deleted. Counts are observed during the write.
    """
    builds = _builds(spark, index_path)
    if any(builds.values()) and not force:
        raise FileExistsError(f"the index {index_path} already exists; pass force to replace it")
    named = columns or {}
    raw = spark.read.parquet(source_path).select(
        F.col(named.get(PRODUCT_ID, PRODUCT_ID)).alias(PRODUCT_ID),
        F.col(named.get(EMBEDDING, EMBEDDING)).alias(EMBEDDING),
    )
    listed = source_files(spark, source_path)
    if listed.isEmpty():
        raise FileNotFoundError(f"no parquet files under {source_path}")
    base = f"{index_path.rstrip('/')}/build={max(builds, default=0) + 1}"
    seen = Observation("index")
    valid = is_valid(dim)
    counted = raw.observe(
        seen, F.count(F.lit(1)).alias("raw_rows"), F.count_if(valid).alias("valid_rows")
    )
    listed.write.parquet(f"{base}/files")  # before the vectors are read: a file that changes meanwhile makes the index stale
    l2_normalize(counted.where(valid), checked=True).write.parquet(f"{base}/vectors")
    meta = spark.range(1).select(
        F.lit(dim).alias("dim"),
        F.lit(seen.get["valid_rows"]).cast("long").alias("n_rows"),
        F.lit(True).alias("normalized"),
        F.lit(source_path).alias("embedding_source"),
        F.current_timestamp().alias("built_at"),
        F.lit(seen.get["raw_rows"] - seen.get["valid_rows"]).cast("long").alias("dropped_invalid"),
    )
    meta.write.parquet(f"{base}/meta")
    before = max((number for number, done in builds.items() if done), default=None)
    for number in builds:
        if number != before:
            where = spark._jvm.org.apache.hadoop.fs.Path(f"{index_path.rstrip('/')}/build={number}")
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return spark.read.parquet(f"{base}/meta")


def read_index(spark: SparkSession, index_path: str) -> DataFrame:
    build = index_build(spark, index_path)
    if build is None:
        raise FileNotFoundError(f"no finished index at {index_path}")
    return spark.read.parquet(f"{build}/vectors")


def changed_files(recorded: DataFrame, current: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Files added, removed or changed in size or modification time."""
    a, b = recorded.alias("a"), current.alias("b")
    seconds = F.abs(
        F.unix_micros(F.col("a.modified")).cast("double") - F.unix_micros(F.col("b.modified")).cast("double")
    ) / 1e6
    state = (
        F.when(F.col("a.name").isNull(), "added")
        .when(F.col("b.name").isNull(), "removed")
        .when((F.col("a.size") != F.col("b.size")) | (seconds > tolerance), "changed")
    )
    joined = a.join(b, F.col("a.name") == F.col("b.name"), "full")
    return joined.select(F.coalesce("a.name", "b.name").alias("name"), state.alias("state")).where(
        F.col("state").isNotNull()
    )


def index_exists(spark: SparkSession, index_path: str) -> bool:
    return index_build(spark, index_path) is not None


def is_stale(spark: SparkSession, index_path: str, source_path: str) -> bool:
    """True if there is no index or its source files differ from the recorded ones."""
    if not index_exists(spark, index_path):
        return True
    recorded = spark.read.parquet(f"{index_build(spark, index_path)}/files")
    return not changed_files(recorded, source_files(spark, source_path)).isEmpty()


# ---- artifacts --------------------------------------------------------------------------


def artifact_path(output_path: str, version: str) -> str:
    return f"{output_path.rstrip('/')}/artifact/{ID_VERSION}={version}"


def _is_complete(spark: SparkSession, table_path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{table_path}/_SUCCESS")
    return bool(where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where))


def artifact_exists(spark: SparkSession, output_path: str, version: str) -> bool:
    return _is_complete(spark, f"{artifact_path(output_path, version)}/meta")


def codebook_frame(spark: SparkSession, artifact: Artifact) -> DataFrame:
    """level, code, vector: one row per codeword."""
    rows = [
        (level + 1, code, [float(x) for x in vector])
        for level, book in enumerate(artifact.codebooks)
        for code, vector in enumerate(book)
    ]
    return spark.createDataFrame(rows, "level int, code int, vector array<double>")


def save_artifact(
    spark: SparkSession, artifact: Artifact, output_path: str, version: str, set_version: str,
    metadata: dict[str, str] | None = None,
) -> str:
    """Three parquet tables per version. A version is written once and then only read.

    `meta` is written last and marks the version as complete; a write that broke off can be repeated.
    """
    base = artifact_path(output_path, version)
    if artifact_exists(spark, output_path, version):
        raise FileExistsError(f"the artifact {base} already exists")
    writer = {"mode": "overwrite"}
    codebook_frame(spark, artifact).coalesce(1).write.parquet(f"{base}/codebooks", **writer)
    weights = [
        (name, list(array.shape), [float(x) for x in array.reshape(-1)])
        for name, array in sorted(artifact.weights.items())
    ]
    spark.createDataFrame(weights, "name string, shape array<int>, numbers array<double>").coalesce(
        1
    ).write.parquet(f"{base}/params", **writer)
    facts = {**artifact.metadata, **(metadata or {})}
    meta = spark.range(1).select(
        F.lit(artifact.d_in).alias("d_in"),
        F.lit(artifact.width).alias("W"),
        F.lit(artifact.num_levels).alias("L"),
        F.lit(int(artifact.codebooks.shape[2])).alias("d"),
        F.lit(artifact.normalize).alias("normalize"),
        F.lit(set_version).alias(SET_VERSION),
        F.lit(version).alias(ID_VERSION),
        F.current_timestamp().alias("trained_at"),
        F.lit(json.dumps(facts, sort_keys=True)).alias("metadata"),
    )
    meta.write.parquet(f"{base}/meta", **writer)
    return base


def load_artifact(spark: SparkSession, output_path: str, version: str) -> Artifact:
    base = artifact_path(output_path, version)
    meta = spark.read.parquet(f"{base}/meta").drop(ID_VERSION).first()
    books = np.zeros((meta["L"], meta["W"], meta["d"]))
    for row in spark.read.parquet(f"{base}/codebooks").select("level", "code", "vector").collect():
        books[row["level"] - 1, row["code"]] = row["vector"]
    weights = {
        row["name"]: np.asarray(row["numbers"]).reshape(row["shape"])
        for row in spark.read.parquet(f"{base}/params").select("name", "shape", "numbers").collect()
    }
    for array in (books, *weights.values()):
        array.setflags(write=False)
    return Artifact(
        codebooks=books, weights=weights, d_in=meta["d_in"], normalize=meta["normalize"],
        embedding_set_version=meta[SET_VERSION], code_version=version,
        metadata=json.loads(meta["metadata"]),
    )


# ---- report and result files ------------------------------------------------------------


def write_report(spark: SparkSession, tables: dict[str, DataFrame], path: str) -> dict:
    """Tidy tables as parquet, and the rendered JSON and Markdown texts. Returns the nested dict."""
    from codeloom.plans.quality import report_dict, to_json, to_markdown

    base = path.rstrip("/")
    for name, table in tables.items():
        table.coalesce(1).write.mode("overwrite").parquet(f"{base}/{name}")
    stored = {name: spark.read.parquet(f"{base}/{name}") for name in tables}
    report = report_dict(stored)
    for label, text in (("json", to_json(report)), ("markdown", to_markdown(report))):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{base}/{label}")
    return report


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def code_filter(levels: list[str], tokens: list[int]) -> Column:
    """c1 = t1 AND c2 = t2 ...; one token more than levels also fixes the slot."""
    if not tokens or len(tokens) > len(levels) + 1:
        raise ValueError(f"expected 1 to {len(levels) + 1} tokens, got {len(tokens)}")
    condition = F.lit(True)
    for name, token in zip([*levels, DEDUP], tokens):
        condition = condition & (F.col(name) == F.lit(token))
    return condition
