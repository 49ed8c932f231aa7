"""Slots of a stream kept as streaming state: nothing that is published is read again.

Two stateful steps follow the frozen quantizer. The first, keyed by a hash bucket of the id, remembers the ids it has seen
and lets each pass once. The second, keyed by the code tuple, remembers the next free slot. Both start from a published
table if there is one. State lives in the checkpoint, so the work of a batch depends on the batch and not on what was
ingested before, and a batch that is repeated after a failure starts from the same state and gives the same slots.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from codeloom.functions.names import DEDUP, PRODUCT_ID, level_columns
from codeloom.operators.quantize import Artifact
from codeloom.streaming.ingest import coded_stream

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Buckets of ids; each is one key of the first step. It is part of the state, so it must not change under a checkpoint.
ID_BUCKETS = 4096
#: Rows of one key that a task sorts at once. A key with more in one batch is numbered piece by piece.
SORTED_ROWS = 4_000_000


def pieces(rows: Iterator[pd.DataFrame], columns: list[str], most: int) -> Iterator[pd.DataFrame]:
    """Rows of a key, sorted by `columns`, in pieces of at least `most` rows but for the last."""
    held, size = [], 0
    for part in rows:
        held.append(part[columns])
        size += len(part)
        if size >= most:
            yield pd.concat(held).sort_values(columns)
            held, size = [], 0
    if size:
        yield pd.concat(held).sort_values(columns)


class FirstArrival(StatefulProcessor):
    """Lets an id pass once; of several rows in one batch the one with the smallest codes."""

    def __init__(self, levels: list[str], most: int = SORTED_ROWS):
        self.columns, self.most = [PRODUCT_ID, *levels], most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", f"{PRODUCT_ID} long", "present boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for piece in pieces(rows, self.columns, self.most):
            once = piece.drop_duplicates(PRODUCT_ID)
            fresh = []
            for number in once[PRODUCT_ID].tolist():
                fresh.append(not self.seen.containsKey((number,)))
                if fresh[-1]:
                    self.seen.updateValue((number,), (True,))
            yield once[np.array(fresh, bool)]

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        for number in initialState[PRODUCT_ID].tolist():
            self.seen.updateValue((number,), (True,))

    def close(self) -> None:
        pass


class NextSlot(StatefulProcessor):
    """Numbers the rows of a code tuple, by id within a batch, after those of the batches before."""

    def __init__(self, levels: list[str], most: int = SORTED_ROWS):
        self.levels, self.most = levels, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.free = handle.getValueState("free", "slot long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        slot = self.free.get()[0] if self.free.exists() else 0
        for piece in pieces(rows, [PRODUCT_ID], self.most):
            numbered = {PRODUCT_ID: piece[PRODUCT_ID].to_numpy()}
            numbered |= {name: np.full(len(piece), code, np.int32) for name, code in zip(self.levels, key)}
            yield pd.DataFrame(numbered | {DEDUP: np.arange(slot, slot + len(piece), dtype=np.int32)})
            slot += len(piece)
        self.free.update((int(slot),))

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self.free.update((int(initialState["slot"].max()),))

    def close(self) -> None:
        pass


def check_provider(spark: SparkSession) -> None:
    if spark.conf.get(PROVIDER) != ROCKSDB:
        raise ValueError(f"streaming state of this kind needs {PROVIDER}={ROCKSDB}")


def slots_by_state(
    coded: DataFrame, levels: list[str], published: DataFrame | None = None, buckets: int = ID_BUCKETS, most: int = SORTED_ROWS
) -> DataFrame:
    """A stream of product_id and codes to product_id, codes and slot.

    An id counts at its first arrival, or not at all if it is published. Ids that come together in a tuple are numbered
    in order. `published` is read once, when the stream starts without a checkpoint.
    """
    check_provider(coded.sparkSession)
    bucket = F.pmod(F.xxhash64(PRODUCT_ID), F.lit(buckets)).alias("bucket")
    known = heads = None
    if published is not None:
        known = published.select(bucket, PRODUCT_ID).groupBy("bucket")
        heads = published.groupBy(*levels).agg((F.max(DEDUP) + 1).cast("long").alias("slot")).groupBy(*levels)
    codes = ", ".join(f"{name} int" for name in levels)
    usable = coded.where(F.col(PRODUCT_ID).isNotNull()).select(bucket, PRODUCT_ID, *levels)
    fresh = usable.groupBy("bucket").transformWithStateInPandas(
        FirstArrival(levels, most), f"{PRODUCT_ID} long, {codes}", "Append", "None", initialState=known
    )
    return fresh.groupBy(*levels).transformWithStateInPandas(
        NextSlot(levels, most), f"{PRODUCT_ID} long, {codes}, {DEDUP} int", "Append", "None", initialState=heads
    )


def ingest_by_state(
    source: DataFrame, artifact: Artifact, dim: int, path: str, checkpoint: str, published: DataFrame | None = None
) -> DataStreamWriter:
    """A stream of catalog rows to slotted codes, appended to the table at `path` exactly once."""
    levels = level_columns(artifact.num_levels)
    slots = slots_by_state(coded_stream(source, artifact, dim), levels, published)
    return slots.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
