"""Rank rows inside groups when one group may hold a large part of the table.

A plain window sorts each group in one task. Here the groups above a row limit are cut
into chunks along the sort key; each chunk is ranked on its own and shifted by the size of
the chunks before it. The result is the same row_number, from one shuffle of the rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A group is split when it has more rows than this and more than 1/GROUP_SHARE of the table,
# so there are at most GROUP_SHARE such groups and about as many chunks: both fit a broadcast.
HOT_ROWS = 2_000_000
GROUP_SHARE = 1000
SKETCH_ITEMS = 20_000
# Sampled sort keys for each chunk; chunks then differ by about a sixteenth.
CUT_SAMPLES = 256


def hot_groups(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> tuple[list[Row], int]:
    """Groups above the limit with their exact row counts, and the limit itself.

    A frequent-items sketch (no shuffle of rows) names the candidates; it cannot miss a group of
    more than about 1/5000 of the table. The candidates are then counted exactly.
    """
    rows = df.count()
    limit = max(hot_rows, rows // GROUP_SHARE)
    if rows <= limit:
        return [], limit
    key_hash = F.xxhash64(*keys)
    sketch = df.select(key_hash.alias("key_hash")).agg(
        F.expr(f"approx_top_k(key_hash, {2 * GROUP_SHARE}, {SKETCH_ITEMS})").alias("top")
    )
    candidates = [item["item"] for item in sketch.first()["top"] if item["count"] > limit]
    if not candidates:
        return [], limit
    counted = (
        df.where(key_hash.isin(candidates))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("total"))
        .where(F.col("total") > limit)
    )
    return counted.collect(), limit


def _same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def _cut_points(df: DataFrame, keys: list[str], order: list[str], hot: list[Row], limit: int) -> DataFrame:
    """One row per hot group: total, and the sorted bounds of the whole sort key.

    The bounds come from a sample by hash of the sort key, about CUT_SAMPLES distinct keys for each `limit` rows
    with their counts; rows with equal sort keys are combined before the shuffle and never cut apart.
    """
    spark = df.sparkSession
    key_fields = [df.schema[k] for k in keys]
    listed = spark.createDataFrame(
        [(*[row[k] for k in keys], row["total"]) for row in hot], T.StructType([*key_fields, T.StructField("total_", T.LongType())])
    )
    share = min(1.0, CUT_SAMPLES / limit)
    picked = df.where(F.pmod(F.xxhash64(*order, F.lit("cut")), F.lit(1 << 30)) < int(share * (1 << 30))).select(
        *keys, F.struct(*[F.col(c) for c in order]).alias("at_")
    )
    sample = (
        picked.join(F.broadcast(listed), _same_keys(picked, listed, keys), "left_semi")
        .groupBy(*keys, "at_")
        .agg(F.count(F.lit(1)).alias("n_"))
    )
    before = Window.partitionBy(*keys).orderBy("at_").rowsBetween(Window.unboundedPreceding, -1)
    piece = F.floor(F.coalesce(F.sum("n_").over(before), F.lit(0)) / F.lit(max(1.0, share * limit)))
    bounds = sample.withColumn("piece_", piece).groupBy(*keys, "piece_").agg(F.max("at_").alias("cut_"))
    known = bounds.groupBy(*keys).agg(F.sort_array(F.collect_list("cut_")).alias("cuts_"))
    both = listed.join(known, _same_keys(listed, known, keys), "left").select(*[listed[k] for k in keys], "total_", "cuts_")
    return spark.createDataFrame(both.collect(), both.schema)


def _chunk(at: Column, cuts: str = "cuts_", most: int = 1 << 16) -> Column:
    """Number of sorted bounds below the sort key, found by halving; there may be up to `most` of them."""
    steps = F.array(*[F.lit(1 << bit) for bit in range(most.bit_length() - 1, -1, -1)])
    asked = F.array(F.struct(F.col(cuts).alias("cuts"), at.alias("at")))  # made once per row

    def search(x: Column) -> Column:
        def further(low: Column, step: Column) -> Column:
            found = (low + step <= F.size(x["cuts"])) & (F.element_at(x["cuts"], low + step) < x["at"])
            return F.when(found, low + step).otherwise(low)

        return F.aggregate(steps, F.lit(0), further)

    return F.element_at(F.transform(asked, search), 1)


def _with_chunk(df: DataFrame, cuts: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Adds `total_`, null outside of the hot groups, and `chunk_`, the number of bounds below the sort key.

    A joined array is copied into its row, so a row meets every side-th bound of its group first and then the block
    between two of these: with n bounds it carries twice the root of n, not n.
    """
    side = F.ceil(F.sqrt(F.size("cuts_"))).cast("int")
    split = cuts.withColumn("side_", side).withColumn(
        "blocks_", F.transform(F.sequence(F.lit(1), F.size("cuts_"), F.col("side_")), lambda at: F.slice("cuts_", at, F.col("side_")))
    )
    renamed = [F.col(k).alias(f"key_{i}_") for i, k in enumerate(keys)]
    heads = split.select(*renamed, "total_", F.transform("blocks_", lambda block: block[0]).alias("heads_"))
    blocks = split.select(*renamed, "side_", F.posexplode("blocks_").alias("before_", "block_"))
    most = split.agg(F.max("side_")).first()[0] or 1
    at = F.struct(*[F.col(c) for c in order])

    def same(rows: DataFrame) -> Column:
        return reduce(lambda a, b: a & b, [rows[k].eqNullSafe(F.col(f"key_{i}_")) for i, k in enumerate(keys)])

    near = (
        df.join(F.broadcast(heads), same(df), "left")
        .withColumn("near_", F.when(F.col("heads_").isNotNull(), _chunk(at, "heads_", most) - 1))
        .select(*[df[c] for c in df.columns], "total_", "near_")
    )
    inner = F.col("before_") * F.col("side_") + _chunk(at, "block_", most)
    return (
        near.join(F.broadcast(blocks), same(near) & (F.col("near_") == F.col("before_")), "left")
        .withColumn("chunk_", F.when(F.col("block_").isNull(), 0).otherwise(inner))
        .select(*[near[c] for c in df.columns], "total_", "chunk_")
    )


def ranked(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    rank: str = "rank",
    size: str | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add the 1-based rank of a row in its group by `order`, and the group size if named.

    The order columns may have any type that Spark sorts; the first of them may be constant. Rows that agree in all
    of them stay in one chunk. The input should be a table or a cheap plan: finding the hot groups reads the key columns.
    """
    hot, limit = hot_groups(df, keys, hot_rows)
    if not hot:
        group = Window.partitionBy(*keys)
        out = df.withColumn(rank, F.row_number().over(group.orderBy(*order)).cast("long"))
        return out.withColumn(size, F.count(F.lit(1)).over(group)) if size else out

    cuts = _cut_points(df, keys, order, hot, limit)
    tagged = _with_chunk(df, cuts, keys, order)
    per_chunk = (
        tagged.where(F.col("total_").isNotNull())
        .groupBy(*keys, "chunk_")
        .agg(F.count(F.lit(1)).alias("rows_"))
    )
    running = Window.partitionBy(*keys).orderBy("chunk_").rowsBetween(Window.unboundedPreceding, -1)
    shifts = per_chunk.select(
        *keys, "chunk_", F.coalesce(F.sum("rows_").over(running), F.lit(0)).alias("shift_")
    )
    group = Window.partitionBy(*keys, "chunk_")
    local = tagged.withColumn("local_", F.row_number().over(group.orderBy(*order)))
    if size:
        local = local.withColumn("chunk_rows_", F.count(F.lit(1)).over(group))
    joined = local.join(F.broadcast(shifts), _same_keys(local, shifts, [*keys, "chunk_"]), "left")
    columns = [local[c] for c in df.columns]
    columns.append((local["local_"] + F.coalesce(shifts["shift_"], F.lit(0))).cast("long").alias(rank))
    if size:
        columns.append(F.coalesce(local["total_"], local["chunk_rows_"]).alias(size))
    return joined.select(*columns)


def first_in_group(df: DataFrame, keys: list[str], order: list[str], limit: int, salts: int = 64) -> DataFrame:
    """The first `limit` rows of each group, with their rank.

    Two levels: salted groups keep their own first rows (pruned before the shuffle), so no task
    sorts more than salts * limit rows of one group at the end.
    """
    # Spark prunes before the shuffle only up to this limit.
    prunes = "spark.sql.optimizer.windowGroupLimitThreshold"
    if int(df.sparkSession.conf.get(prunes)) < limit:
        df.sparkSession.conf.set(prunes, str(limit))
    salted = df.withColumn("salt_", F.pmod(F.xxhash64(*order), F.lit(salts)))
    near = Window.partitionBy(*keys, "salt_").orderBy(*order)
    kept = salted.withColumn("near_", F.row_number().over(near)).where(F.col("near_") <= limit)
    final = Window.partitionBy(*keys).orderBy(*order)
    return (
        kept.drop("salt_", "near_")
        .withColumn("rank", F.row_number().over(final))
        .where(F.col("rank") <= limit)
    )
