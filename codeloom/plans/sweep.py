"""Configuration grid, capacity arithmetic, selection, run comparison and id churn."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom.functions.names import DEDUP, PRODUCT_ID

# Widths, depths and latent sizes of the planned grid.
GRID_WIDTHS = (256, 512, 1024)
GRID_LEVELS = (3, 4)
GRID_LATENT = 32
EXTRA_LATENT = 64


def grid_rows(
    widths: tuple[int, ...] = GRID_WIDTHS, depths: tuple[int, ...] = GRID_LEVELS, d: int = GRID_LATENT
) -> list[tuple[int, int, int]]:
    return [(w, depth, d) for w in widths for depth in depths]


def grid_frame(spark: SparkSession, rows: list[tuple[int, int, int]] | None = None) -> DataFrame:
    return spark.createDataFrame(rows or grid_rows(), "W int, L int, d int")


def _with_totals(grid: DataFrame, totals: DataFrame) -> DataFrame:
    """Attach one row of totals to every grid row by a constant key."""
    return grid.withColumn("one", F.lit(1)).join(F.broadcast(totals.withColumn("one", F.lit(1))), "one").drop("one")


def capacity(grid: DataFrame, items: DataFrame) -> DataFrame:
    """Cells W^L, headroom over the rows of `items`, and rows per level-1 code."""
    totals = items.agg(F.count(F.lit(1)).cast("double").alias("n_items"))
    cells = F.pow(F.col("W").cast("double"), F.col("L"))
    return _with_totals(grid, totals).select(
        "W", "L", cells.alias("cells"),
        F.try_divide(cells, F.col("n_items")).alias("headroom"),
        (F.col("n_items") / F.col("W")).alias("items_per_code"),
    )


def capacity_bounds(
    grid: DataFrame, base: DataFrame, factor: float = 10.0, least: float = 1000.0, most: float = 10_000.0
) -> DataFrame:
    """Floor: W^L at least `factor` times the largest bucket and above the rows in all. Ceiling: rows
    per code between `least` and `most`."""
    sizes = base.groupBy("league", "team").agg(F.sum("n").alias("rows"))
    known = F.col("league").isNotNull() & F.col("team").isNotNull()
    totals = sizes.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("n_items"),
        F.coalesce(F.max(F.when(known, F.col("rows"))), F.lit(0)).alias("largest_bucket"),
    )
    cells = F.pow(F.col("W").cast("double"), F.col("L"))
    per_code = F.col("n_items") / F.col("W")
    return _with_totals(grid, totals).select(
        "W", "L", "n_items", "largest_bucket", cells.alias("cells"), per_code.alias("items_per_code"),
        ((cells >= factor * F.col("largest_bucket")) & (cells >= F.col("n_items"))).alias("floor_ok"),
        per_code.between(least, most).alias("ceiling_ok"),
    )


def run_verdict(utilization_hot: DataFrame, verdict: DataFrame) -> DataFrame:
    """One row: do all hot-bucket utilization records pass, and do the collisions."""
    hot = utilization_hot.agg(
        F.coalesce(F.bool_and("passes"), F.lit(False)).alias("hot_utilization_passes"),
        F.count_if(F.col("passes")).alias("passing_records"),
        F.count(F.lit(1)).alias("records"),
    )
    both = hot.withColumn("one", F.lit(1)).join(
        verdict.select(F.col("passes").alias("collision_passes"), F.lit(1).alias("one")), "one"
    )
    return both.drop("one")


def select_config(results: DataFrame) -> DataFrame:
    """The smallest (W, L, d) that passes both checks; no row if none does."""
    passing = results.where(F.col("hot_utilization_passes") & F.col("collision_passes"))
    return passing.orderBy("W", "L", "d").limit(1)


def extra_run(chosen: DataFrame, d: int = EXTRA_LATENT) -> DataFrame:
    """The added run on the chosen width and depth with the other latent size."""
    return chosen.select("W", "L", F.lit(d).alias("d"))


def long_metrics(table: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    cells = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
    return table.select(*keys, F.inline(F.array(*cells)))


def compare_runs(first: DataFrame, second: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """Metric by metric, two runs side by side."""
    a = long_metrics(first, keys, metrics).withColumnRenamed("value", "value_a")
    b = long_metrics(second, keys, metrics).withColumnRenamed("value", "value_b")
    joined = a.join(b, [*keys, "metric"], "full")
    return joined.withColumn("difference", F.col("value_b") - F.col("value_a"))


def run_sweep(
    spark: SparkSession, configs: list[tuple[int, int, int]], run: Callable[[int, int, int], DataFrame], path: str
) -> DataFrame:
    """One report partition per configuration; `run` returns a verdict row of a trained run."""
    for w, depth, d in configs:
        row = run(w, depth, d).withColumns({"W": F.lit(w), "L": F.lit(depth), "d": F.lit(d)})
        row.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run/W={w}/L={depth}/d={d}")
    paths = [f"{path.rstrip('/')}/run/W={w}/L={depth}/d={d}" for w, depth, d in configs]
    return spark.read.parquet(*paths)


def dual_write(old: DataFrame, new: DataFrame, levels: list[str]) -> DataFrame:
    """Old and new codes of every product side by side."""
    columns = [*levels, DEDUP]
    a = old.select(PRODUCT_ID, F.lit(True).alias("in_old"), *[F.col(c).alias(f"old_{c}") for c in columns])
    b = new.select(PRODUCT_ID, F.lit(True).alias("in_new"), *[F.col(c).alias(f"new_{c}") for c in columns])
    joined = a.join(b, PRODUCT_ID, "full")
    return joined.withColumns(
        {"in_old": F.coalesce("in_old", F.lit(False)), "in_new": F.coalesce("in_new", F.lit(False))}
    )


def churn(both: DataFrame, levels: list[str]) -> DataFrame:
    """Share of common products whose prefix of each length changed, and whose full id changed. One row
    per prefix length; length L + 1 is the id with its slot."""
    columns = [*levels, DEDUP]
    same = F.lit(True)
    cells = []
    for length, name in enumerate(columns, start=1):
        same = same & F.col(f"old_{name}").eqNullSafe(F.col(f"new_{name}"))
        cells.append(F.struct(F.lit(length).alias("prefix_length"), (~same).alias("changed")))
    common = F.col("in_old") & F.col("in_new")
    long = both.select("in_old", "in_new", F.inline(F.array(*cells)))
    return long.groupBy("prefix_length").agg(
        F.count_if(common).alias("common"),
        F.count_if(F.col("in_new") & ~F.col("in_old")).alias("added"),
        F.count_if(F.col("in_old") & ~F.col("in_new")).alias("removed"),
        F.count_if(common & F.col("changed")).alias("changed"),
        F.try_divide(F.count_if(common & F.col("changed")).cast("double"), F.count_if(common).cast("double")).alias(
            "changed_share"
        ),
    )
