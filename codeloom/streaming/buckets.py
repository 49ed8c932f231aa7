"""Published slots stored by hash bucket, so that a batch reads only the buckets its rows fall into.

Two tables grow batch by batch: the slots, bucketed by the hash of the id, and the next free slot of each code tuple,
bucketed by the hash of the tuple. A batch writes a run of its own, a folder `run=<first>-<last>` with a folder for each
bucket. When `fan` runs of one size follow each other, they are merged into one run with one sorted file per bucket,
as in a log-structured merge tree, so a row is written again only log(batches) times and a bucket has few files.

A run counts once its job has left `_SUCCESS`, and only in later batches; a run inside another finished one is
passed over. So a batch or a merge that broke half-way is not seen, and its repetition overwrites it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom.functions.names import DEDUP, PRODUCT_ID
from codeloom.operators.quantize import add_dedup_index
from codeloom.plans.lookup import requested_id
from codeloom.session import stored

BUCKETS = 1024
FAN = 8
SLOTS, HEADS = "slots", "heads"


class SlotTable:
    """Slots of code tuples at `path`. `buckets` is part of the layout and stays as it is for the life of the table."""

    def __init__(self, spark: SparkSession, path: str, levels: list[str], buckets: int = BUCKETS, fan: int = FAN):
        self.spark, self.path, self.levels, self.buckets, self.fan = spark, path.rstrip("/"), levels, buckets, fan
        codes = ", ".join(f"{name} int" for name in levels)
        self.schemas = {SLOTS: f"{PRODUCT_ID} bigint, {codes}, {DEDUP} int, bucket int", HEADS: f"{codes}, next bigint, bucket int"}

    def bucket(self, *columns: str) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(self.buckets)).cast("int").alias("bucket")

    # ---- runs -----------------------------------------------------------------------------

    def _fs(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _finished(self, table: str) -> list[tuple[int, int]]:
        where, fs = self._fs(f"{self.path}/{table}")
        if not fs.exists(where):
            return []
        found = []
        for status in fs.listStatus(where):
            name = status.getPath().getName()
            if name.startswith("run=") and fs.exists(self._fs(f"{self.path}/{table}/{name}/_SUCCESS")[0]):
                first, last = name.removeprefix("run=").split("-")
                found.append((int(first), int(last)))
        return found

    def runs(self, table: str, before: int | None = None) -> list[tuple[int, int]]:
        """The finished runs of the batches before `before`, without those that a merged run holds."""
        found = [r for r in self._finished(table) if before is None or r[1] < before]
        return sorted(r for r in found if not any(o != r and o[0] <= r[0] and r[1] <= o[1] for o in found))

    def _read(self, table: str, runs: list[tuple[int, int]], buckets: list[int] | None = None) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], self.schemas[table])
        parts = None
        for first, last in runs:
            part = self.spark.read.schema(self.schemas[table]).parquet(f"{self.path}/{table}/run={first}-{last}")
            parts = part if parts is None else parts.unionByName(part)
        return parts if buckets is None else parts.where(F.col("bucket").isin(buckets))

    def _write(self, df: DataFrame, table: str, first: int, last: int, order: list[str]) -> None:
        dealt = df.repartition("bucket").sortWithinPartitions("bucket", *order)
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{table}/run={first}-{last}")

    def _touched(self, df: DataFrame) -> list[int]:
        """Numbers of the buckets, at most as many as there are buckets."""
        return sorted(r["bucket"] for r in df.select("bucket").distinct().collect())

    # ---- batches --------------------------------------------------------------------------

    def append(self, batch: DataFrame, number: int) -> None:
        """Slots for the coded rows of batch `number` whose ids are not there yet, after the last slot of their tuple.

        An id that comes twice counts once, with its smallest codes. Rows without an id are left out. Batches have
        rising numbers; repeating the last one changes nothing.
        """
        levels = self.levels
        chosen = F.min(F.struct(*levels)).alias("codes_")
        rows = batch.where(F.col(PRODUCT_ID).isNotNull()).groupBy(F.col(PRODUCT_ID).cast("long").alias(PRODUCT_ID)).agg(chosen)
        coded = rows.select(PRODUCT_ID, *[F.col("codes_")[c].cast("int").alias(c) for c in levels], self.bucket(PRODUCT_ID))
        with stored(coded, "batch") as coded:
            seen = self._read(SLOTS, self.runs(SLOTS, number), self._touched(coded)).select("bucket", PRODUCT_ID)
            fresh = coded.join(seen, ["bucket", PRODUCT_ID], "left_anti").select(PRODUCT_ID, *levels)
            ranked = add_dedup_index(fresh, levels).withColumn("bucket", self.bucket(*levels))
            with stored(ranked, "fresh") as ranked:
                heads = self._read(HEADS, self.runs(HEADS, number), self._touched(ranked))
                heads = heads.groupBy("bucket", *levels).agg(F.max("next").alias("next"))
                slot = (F.col(DEDUP) + F.coalesce("next", F.lit(0))).cast("int")
                placed = ranked.join(heads, ["bucket", *levels], "left").select(PRODUCT_ID, *levels, slot.alias(DEDUP), "bucket")
                with stored(placed, "placed") as placed:
                    self._write(placed.withColumn("bucket", self.bucket(PRODUCT_ID)), SLOTS, number, number, [PRODUCT_ID])
                    after = placed.groupBy("bucket", *levels).agg((F.max(DEDUP) + 1).cast("long").alias("next"))
                    self._write(after, HEADS, number, number, levels)
        self.merge(number)

    def merge(self, number: int) -> None:
        """Merge the newest `fan` runs, up to batch `number`, while they are of one size."""
        for table, order in ((SLOTS, [PRODUCT_ID]), (HEADS, self.levels)):
            while True:
                runs = self.runs(table, number + 1)[-self.fan :]
                if len(runs) < self.fan or len({last - first for first, last in runs}) > 1:
                    break
                merged = self._read(table, runs)
                if table == HEADS:
                    merged = merged.groupBy("bucket", *self.levels).agg(F.max("next").alias("next"))
                self._write(merged, table, runs[0][0], runs[-1][1], order)
            self._drop_merged(table, number)

    def _drop_merged(self, table: str, number: int) -> None:
        """Delete the runs inside a merged run of the batches before `number`; that batch itself may be repeated."""
        found = self._finished(table)
        for first, last in found:
            if any(o != (first, last) and o[0] <= first and last <= o[1] < number for o in found):
                where, fs = self._fs(f"{self.path}/{table}/run={first}-{last}")
                fs.delete(where, True)

    # ---- reading --------------------------------------------------------------------------

    def read(self, before: int | None = None) -> DataFrame:
        """All slots of the batches before `before`, or of all."""
        return self._read(SLOTS, self.runs(SLOTS, before)).drop("bucket")

    def find(self, ids: DataFrame, id_column: str = PRODUCT_ID) -> DataFrame:
        """Codes and slots of the asked ids; only their buckets are read."""
        asked = ids.select(requested_id(ids, id_column).alias(PRODUCT_ID)).where(F.col(PRODUCT_ID).isNotNull()).distinct()
        asked = asked.withColumn("bucket", self.bucket(PRODUCT_ID))
        inside = self._read(SLOTS, self.runs(SLOTS), self._touched(asked))
        return inside.join(asked, ["bucket", PRODUCT_ID], "left_semi").drop("bucket")


def bucket_writer(path: str, levels: list[str], buckets: int = BUCKETS, fan: int = FAN):
    """foreachBatch function for a stream of coded rows."""

    def write(batch: DataFrame, number: int) -> None:
        SlotTable(batch.sparkSession, path, levels, buckets, fan).append(batch, number)

    return write
