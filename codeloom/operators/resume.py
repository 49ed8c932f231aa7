"""State of a training run after each epoch, so that a run that was stopped goes on where it was.

An epoch is one small parquet table, whose success marker is written last: without it the epoch does not count. A state
belongs to one set of rows and settings, named by a fingerprint in its path, so other runs never meet it.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STATE_SCHEMA = "name string, shape array<int>, numbers array<double>, facts string"


def fingerprint(*parts: object) -> str:
    return hashlib.md5(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


def rows_checksum(*columns: str) -> Column:
    """Sum of the rows' hashes: the same for the same rows in any order."""
    return F.sum(F.xxhash64(*columns).cast("decimal(20,0)"))


def arrays_digest(arrays: dict[str, np.ndarray]) -> str:
    return fingerprint([(k, a.shape, hashlib.md5(np.ascontiguousarray(a).tobytes()).hexdigest()) for k, a in sorted(arrays.items())])


def _folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def complete_epochs(spark: SparkSession, path: str) -> list[int]:
    where, files = _folder(spark, f"{path}/epoch=*/_SUCCESS")
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in files.globStatus(where) or [])


def save_epoch(spark: SparkSession, path: str, epoch: int, arrays: dict[str, np.ndarray], facts: dict) -> None:
    """Write an epoch; earlier ones are deleted once it is complete."""
    rows = [(k, list(a.shape), [float(x) for x in a.reshape(-1)], None) for k, a in sorted(arrays.items())]
    table = spark.createDataFrame([*rows, ("facts", None, None, json.dumps(facts, default=lambda x: x.item()))], STATE_SCHEMA)
    table.coalesce(1).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
    for earlier in complete_epochs(spark, path):
        if earlier < epoch:
            where, files = _folder(spark, f"{path}/epoch={earlier}")
            files.delete(where, True)


def last_epoch(spark: SparkSession, path: str) -> tuple[dict[str, np.ndarray], dict] | None:
    epochs = complete_epochs(spark, path)
    if not epochs:
        return None
    table: DataFrame = spark.read.schema(STATE_SCHEMA).parquet(f"{path}/epoch={epochs[-1]}")
    arrays, facts = {}, {}
    for row in table.collect():
        if row["facts"] is not None:
            facts = json.loads(row["facts"])
        else:
            arrays[row["name"]] = np.asarray(row["numbers"], dtype=np.float64).reshape(row["shape"])
    return arrays, facts


def forget(spark: SparkSession, path: str) -> None:
    where, files = _folder(spark, path)
    files.delete(where, True)
