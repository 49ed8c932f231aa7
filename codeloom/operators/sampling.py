"""Split, hot buckets, row weights and samples. Every choice is a seeded hash of the row key."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codeloom.functions.names import HOT_MARKET, LEAGUE, PRODUCT_ID, TEAM
from codeloom.functions.scalars import leading_bits, parse_flag, seeded_md5, seeded_uniform
from codeloom.session import write_and_read

# A top-K list up to this length is sent to every task.
BROADCAST_ROWS = 10_000
# Sizes and thresholds of up to this many strata are sent to every task, so that no row is moved to meet them.
BROADCAST_STRATA = 200_000


HASH_SPACE = float(16**15)
# Half-widths, in standard deviations, of the range in which the threshold of a stratum is looked for.
REACHES = (6.0, 60.0, float("inf"))


def _few(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= BROADCAST_STRATA else table


def _on(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"{c}__"]) for c in keys])


def _hash_number(key: Column | str, seed: int) -> Column:
    """60 bits of the seeded hash as a number."""
    return leading_bits(seeded_md5(key, seed), 15)


def _thresholds(keyed: DataFrame, sizes: DataFrame, strata: list[str], key: str, reach: float, rows: int) -> DataFrame:
    """The last validation row (hash, key) of every stratum, if it lies within `reach`.

    Hashes are uniform, so the k-th smallest of n is near k/n of the range. Rows below that
    neighbourhood are only counted; of a stratum with n rows about sqrt(n) are sorted, so a stratum
    with a third of the table is no burden.
    """
    n, k = F.col("size__").cast("double"), F.col("wanted__").cast("double")
    width = reach * F.sqrt(k * (n - k) / n) + reach if math.isfinite(reach) else F.lit(HASH_SPACE) * n
    low = F.greatest(F.lit(0.0), (k - width) / n) * HASH_SPACE
    high = F.least(F.lit(1.0), (k + width) / n) * HASH_SPACE
    near = keyed.join(_few(sizes, rows), _on(keyed, sizes, strata)).select(
        *[sizes[f"{c}__"] for c in strata], "wanted__", "hash_", key,
        (F.col("hash_") < F.floor(low)).alias("below"), (F.col("hash_") > F.ceil(high)).alias("above"),
    )
    names = [f"{c}__" for c in strata]
    below = near.groupBy(*names).agg(F.count_if("below").alias("below_rows"))
    below = below.select(*[F.col(c).alias(f"{c}__") for c in names], "below_rows")
    inside = near.where(~F.col("below") & ~F.col("above"))
    place = F.row_number().over(Window.partitionBy(*names).orderBy("hash_", key))
    placed = inside.withColumn("place", place)
    found = placed.join(below, _on(placed, below, names))
    return found.where(F.col("place") + F.col("below_rows") == F.col("wanted__")).select(
        *names, F.struct("hash_", key).alias("last_")
    )


def with_split(
    df: DataFrame,
    val_fraction: float,
    seed: int,
    strata: list[str],
    key: str = PRODUCT_ID,
    reaches: tuple[float, ...] | None = None,
) -> DataFrame:
    """Add the boolean `is_val`: an exact share of every stratum, in seeded hash order.

    The count per stratum is floor(n * f + 0.5), at least 1 and at most n - 1; a stratum of one row
    trains. Keys and strata are read to find one threshold per stratum; the rows are then marked
    where they are. Above `BROADCAST_STRATA` strata Spark chooses the joins by itself.
    """
    keyed = df.select(*strata, key, _hash_number(key, seed).alias("hash_"))
    counted = df.groupBy(*strata).agg(F.count(F.lit(1)).alias("size__")).where(F.col("size__") > 1)
    share = F.floor(F.col("size__") * F.lit(float(val_fraction)) + F.lit(0.5))
    wanted = F.greatest(F.lit(1), F.least(share, F.col("size__") - 1)).alias("wanted__")
    sizes = write_and_read(
        counted.select(*[F.col(c).alias(f"{c}__") for c in strata], "size__", wanted), "split-sizes"
    )
    n_strata = sizes.count()
    limits = None
    for reach in reaches or REACHES:
        missing = sizes
        if limits is not None:
            known = limits.select(*[F.col(f"{c}__").alias(f"{c}____") for c in strata])
            same = reduce(lambda a, b: a & b, [sizes[f"{c}__"].eqNullSafe(known[f"{c}____"]) for c in strata])
            missing = sizes.join(known, same, "left_anti")
            if missing.isEmpty():
                break
        found = write_and_read(_thresholds(keyed, missing, strata, key, reach, n_strata), "split-limits")
        limits = found if limits is None else limits.unionByName(found)
    mine = F.struct(_hash_number(df[key], seed).alias("hash_"), df[key].alias(key))
    chosen = F.coalesce(mine <= F.col("last_"), F.lit(False))
    return df.join(_few(limits, n_strata), _on(df, limits, strata), "left").select(
        *[df[c] for c in df.columns], chosen.alias("is_val")
    )


def stratified_train_val_split(
    df: DataFrame,
    val_fraction: float,
    seed: int,
    strata: list[str],
    key: str = PRODUCT_ID,
) -> tuple[DataFrame, DataFrame]:
    flagged = with_split(df, val_fraction, seed, strata, key)
    return flagged.where(~F.col("is_val")).drop("is_val"), flagged.where("is_val").drop("is_val")


def top_k_hot_buckets(df: DataFrame, top_k: int, keys: tuple[str, str] = (LEAGUE, TEAM)) -> DataFrame:
    """The K largest (league, team) buckets; ties by name, rows without league or team left out."""
    known = df.where(F.col(keys[0]).isNotNull() & F.col(keys[1]).isNotNull())
    return (
        known.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("bucket_count"))
        .orderBy(F.desc("bucket_count"), *keys)
        .limit(top_k)
    )


def flag_hot_bucket_membership(
    df: DataFrame, hot: DataFrame, top_k: int | None = None, keys: tuple[str, str] = (LEAGUE, TEAM)
) -> DataFrame:
    """Add `is_hot_bucket`. The list is broadcast when its length K is known to be small."""
    marks = hot.select(*keys, F.lit(True).alias("hot_"))
    if top_k is not None and top_k <= BROADCAST_ROWS:
        marks = F.broadcast(marks)
    joined = df.join(marks, list(keys), "left")
    return joined.select(*[df[c] for c in df.columns], F.col("hot_").isNotNull().alias("is_hot_bucket"))


def add_sample_weight(
    df: DataFrame, top_k: int, hot_bucket_weight: float, hot_market_weight: float
) -> DataFrame:
    """Add `sample_weight`: the product of the bucket factor and the market factor."""
    flagged = flag_hot_bucket_membership(df, top_k_hot_buckets(df, top_k), top_k)
    bucket = F.when(F.col("is_hot_bucket"), float(hot_bucket_weight)).otherwise(1.0)
    market = F.when(parse_flag(HOT_MARKET), float(hot_market_weight)).otherwise(1.0)
    return flagged.withColumn("sample_weight", bucket * market).drop("is_hot_bucket")


#: Rates from here on are drawn by rejection, smaller ones by the inverse distribution.
LARGE_RATE = 10.0
#: Trials of a draw; each is accepted with a probability above 0.85, so all fail once in 10^19 draws.
TRIALS = 24


def small_poisson(rate: Column, uniform: Column) -> Column:
    """Inverse Poisson distribution, summed up from 0: at most 60 steps below LARGE_RATE."""
    start = F.struct(F.exp(-rate).alias("mass"), F.exp(-rate).alias("below"), F.lit(0).cast("long").alias("copies"))
    reach = F.ceil(rate + 12.0 * F.sqrt(rate) + 12.0).cast("int")

    def step(state: Column, i: Column) -> Column:
        mass = state["mass"] * rate / i.cast("double")
        return F.struct(
            mass.alias("mass"), (state["below"] + mass).alias("below"),
            (state["copies"] + (uniform >= state["below"]).cast("long")).alias("copies"),
        )

    return F.aggregate(F.sequence(F.lit(1), reach), start, step, lambda state: state["copies"])


def log_factorial(k: Column) -> Column:
    """Exact up to 20, beyond that by Stirling's series with three terms (error below 10^-12)."""
    x = k.cast("double") + 1.0
    series = (x - 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + 1.0 / (12.0 * x) - 1.0 / (360.0 * x * x * x) + 1.0 / (1260.0 * F.pow(x, F.lit(5.0)))
    return F.when(k <= 20, F.log(F.factorial(k.cast("int")).cast("double"))).otherwise(series)


def large_poisson(rate: Column, uniform: Callable[[Column, str], Column]) -> Column:
    """A Poisson draw by transformed rejection with squeeze, in constant time for any rate from LARGE_RATE on.

    `uniform(trial, name)` gives the numbers of a trial in (0, 1). The first accepted trial counts.
    """
    # Fixed values of the published method (W. Hoermann, 1993).
    b = 0.931 + 2.53 * F.sqrt(rate)
    a = -0.059 + 0.02483 * b
    inverse_alpha = 1.1239 + 1.1328 / (b - 3.4)
    squeeze = 0.9277 - 3.6224 / (b - 2.0)

    def trial(number: Column) -> Column:
        def judge(p: Column) -> Column:
            u, v = p["u"] - 0.5, p["v"]
            us = 0.5 - F.abs(u)
            k = F.floor((2.0 * p["a"] / us + p["b"]) * u + rate + 0.43)
            exact = F.log(v * p["inverse_alpha"] / (p["a"] / (us * us) + p["b"])) <= k * F.log(rate) - rate - log_factorial(k)
            taken = (us >= 0.07) & (v <= p["squeeze"]) | (k >= 0) & ~((us < 0.013) & (v > us)) & exact
            return F.when(taken, k)

        # An array of one, so that the numbers are computed once.
        numbers = F.struct(
            uniform(number, "u").alias("u"), uniform(number, "v").alias("v"), a.alias("a"), b.alias("b"),
            inverse_alpha.alias("inverse_alpha"), squeeze.alias("squeeze"),
        )
        return F.transform(F.array(numbers), judge)[0]

    found = F.aggregate(
        F.sequence(F.lit(0), F.lit(TRIALS - 1)), F.lit(None).cast("long"),
        lambda state, number: F.when(state.isNotNull(), state).otherwise(trial(number)),
    )
    return F.coalesce(found, F.floor(rate))


def resample_copies(
    df: DataFrame, rows: float, total_weight: float, *seed: object,
    weight: str = "sample_weight", key: str = PRODUCT_ID,
) -> DataFrame:
    """Weighted draws with replacement as Poisson copies; the total is `rows` in expectation.

    The time for a row does not depend on its rate. `copies` is a LONG.
    """
    rate = F.col(weight).cast("double") * F.lit(float(rows) / float(total_weight))
    bound = df.withColumn("rate_", rate).withColumn("uniform_", seeded_uniform(key, *seed)).withColumn("key_", F.col(key).cast("string"))
    tail = "".join(f":{part}" for part in seed)

    def uniform(p: Column):
        def of(trial: Column, name: str) -> Column:
            mixed = F.md5(F.concat(p["key_"], F.lit(tail + ":"), trial.cast("string"), F.lit(f":{name}")))
            return (leading_bits(mixed, 13).cast("double") + 0.5) / F.lit(float(16**13))

        return of

    # Bind the numbers once per row; a plain reference would be evaluated again in every step.
    draw = F.transform(
        F.array(F.struct("rate_", "uniform_", "key_")),
        lambda p: F.when(p["rate_"] >= LARGE_RATE, large_poisson(p["rate_"], uniform(p)))
        .when(p["rate_"] > 0, small_poisson(p["rate_"], p["uniform_"]))
        .otherwise(F.lit(0).cast("long")),
    )[0]
    return bound.withColumn("copies", draw).drop("rate_", "uniform_", "key_")


def thin(df: DataFrame, fraction: float, *seed: object, key: str = PRODUCT_ID) -> DataFrame:
    """About `fraction` of the rows by seeded hash: a filter, without a sort or shuffle."""
    return df.where(seeded_uniform(key, *seed) < F.lit(float(fraction)))


def uniform_sample(
    df: DataFrame, rows: int, *seed: object, key: str = PRODUCT_ID, total: int | None = None
) -> DataFrame:
    """Exactly min(rows, N) rows without replacement: those with the smallest seeded hash.

    A threshold on the hash drops nearly everything before the sort, so the final task sees about
    `rows` rows. It is only used after a count shows that enough rows are below it.
    """
    total = df.count() if total is None else total
    if total <= rows:
        return df
    hashed = df.withColumn("hash_", seeded_md5(key, *seed))
    margin = rows + 8.0 * math.sqrt(rows) + 64.0
    while margin < total:
        below = hashed.where(leading_bits(F.col("hash_"), 13) < F.lit(int(16**13 * (margin / total))))
        if below.count() >= rows:
            hashed = below
            break
        margin *= 2
    return hashed.orderBy("hash_", key).limit(rows).drop("hash_")
