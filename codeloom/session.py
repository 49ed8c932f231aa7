"""Session settings and the shared folder for tables that outlive a stage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(
    cpus: int | str = "*", app: str = "codeloom", memory: str = "8g", **settings: str
) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own. Dots in settings are written as __."""
    cores = str(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8" if cores == "*" else cores)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by spark.checkpoint.dir.

    Only a local master may fall back to a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        named = current.get() if current.isDefined() else None
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="codeloom-")
    return _LOCAL_FOLDERS[app]


def new_table_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/codeloom/{label}-{uuid.uuid4().hex}"


def _written(df: DataFrame, path: str, partition_by: list[str] | None) -> DataFrame:
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_and_read(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Cut the lineage by writing a table to the shared folder and reading it back."""
    return _written(df, new_table_path(df.sparkSession, label), partition_by)


@contextmanager
def stored(df: DataFrame, label: str, partition_by: list[str] | None = None) -> Iterator[DataFrame]:
    """The same for a table that is only needed inside the block; it is deleted afterwards."""
    spark = df.sparkSession
    path = new_table_path(spark, label)
    try:
        yield _written(df, path, partition_by)
    finally:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
