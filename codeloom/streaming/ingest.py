"""New products through a frozen artifact, slots appended to existing buckets.

Published slots never move. This equals a full recompute only when new ids sort after the old ones of
their bucket; a recompute (add_dedup_index on the whole table) renumbers later members instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from codeloom.functions.names import DEDUP, PRODUCT_ID, level_columns
from codeloom.operators.prepare import prepare
from codeloom.operators.quantize import Artifact, add_dedup_index, assign_codes
from codeloom.session import stored


def coded_stream(source: DataFrame, artifact: Artifact, dim: int) -> DataFrame:
    """Prepared and coded rows; works on a stream and on a table alike (stateless)."""
    return assign_codes(prepare(source, dim), artifact)


def append_slots(new: DataFrame, published: DataFrame | None, levels: list[str]) -> DataFrame:
    """Slots for coded rows that are not published yet, after the last slot of their tuple.

    An id that comes twice within `new` counts once, with its smallest code tuple, so a replay gives the same. Only the tuples of this batch are looked up in the
    published table, and what is joined back is one row per tuple.
    """
    chosen = F.min(F.struct(*levels)).alias("codes_")
    fresh = new.groupBy(PRODUCT_ID).agg(chosen).select(PRODUCT_ID, *[F.col("codes_")[c].alias(c) for c in levels])
    if published is None:
        return add_dedup_index(fresh.select(PRODUCT_ID, *levels), levels)
    # The published table is first cut to the ids and tuples of this batch, with the batch as the small
    # side: a batch below Spark's broadcast size then leaves the published table unshuffled.
    seen = published.select(PRODUCT_ID).join(new.select(PRODUCT_ID), PRODUCT_ID, "left_semi")
    fresh = fresh.join(seen, PRODUCT_ID, "left_anti")
    ranked = add_dedup_index(fresh.select(PRODUCT_ID, *levels), levels)
    touched = new.select(*levels)
    heads = (
        published.select(*levels, DEDUP)
        .join(touched, levels, "left_semi")
        .groupBy(*levels)
        .agg((F.max(DEDUP) + 1).alias("next_"))
    )
    placed = ranked.join(heads, levels, "left")
    slot = F.col(DEDUP) + F.coalesce("next_", F.lit(0))
    return placed.select(PRODUCT_ID, *levels, slot.cast("int").alias(DEDUP))


def read_batches(spark: SparkSession, path: str, num_levels: int, before: int | None = None) -> DataFrame | None:
    """Rows of the batches written so far, without batch `before` and later ones."""
    levels = level_columns(num_levels)
    schema = ", ".join([f"{PRODUCT_ID} bigint", *[f"{c} int" for c in levels], f"{DEDUP} int", "batch bigint"])
    if not _exists(spark, path):
        return None
    table = spark.read.schema(schema).parquet(path)
    return table if before is None else table.where(F.col("batch") < before)


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where))


def slot_writer(path: str, num_levels: int, seed_table: DataFrame | None = None):
    """foreachBatch function. A batch overwrites its own folder, so a replayed batch changes nothing."""
    levels = level_columns(num_levels)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = read_batches(spark, path, num_levels, before=batch_id)
        columns = [PRODUCT_ID, *levels, DEDUP]
        if seed_table is not None:
            base = seed_table.select(*columns)
            known = base if known is None else base.unionByName(known.select(*columns))
        with stored(batch.select(PRODUCT_ID, *levels), "stream") as coded:
            slots = append_slots(coded, known, levels)
            slots.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")

    return write


def ingest(
    source: DataFrame, artifact: Artifact, dim: int, path: str, checkpoint: str, published: DataFrame | None = None
) -> DataStreamWriter:
    """A stream of catalog rows to slotted codes under `path`; start it with the trigger you need."""
    return (
        coded_stream(source, artifact, dim)
        .writeStream.foreachBatch(slot_writer(path, artifact.num_levels, published))
        .option("checkpointLocation", checkpoint)
    )
