"""Quality diagnostics as re-aggregations of one count table.

`base_counts` reduces the joined rows to counts per (taxonomy fields, c1..cL); every metric below
starts from it, so the rows are shuffled once. All group-bys are sums with map-side combine: a tuple
or taxon that holds a third of the rows is one row per task by then.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codeloom.functions.names import LEAGUE, TEAM, level_columns
from codeloom.functions.scalars import parse_flag
from codeloom.operators.sampling import BROADCAST_ROWS

BUCKET = (LEAGUE, TEAM)


def base_counts(df: DataFrame, levels: list[str], fields: list[str]) -> DataFrame:
    return df.groupBy(*fields, *levels).agg(F.count(F.lit(1)).alias("n"))


def hot_buckets(base: DataFrame, top_k: int) -> DataFrame:
    known = base.where(F.col(LEAGUE).isNotNull() & F.col(TEAM).isNotNull())
    return (
        known.groupBy(*BUCKET)
        .agg(F.sum("n").alias("bucket_count"))
        .orderBy(F.desc("bucket_count"), *BUCKET)
        .limit(top_k)
    )


def _in_buckets(base: DataFrame, hot: DataFrame, top_k: int) -> DataFrame:
    marks = hot.select(*BUCKET)
    return base.join(F.broadcast(marks) if top_k <= BROADCAST_ROWS else marks, list(BUCKET), "left_semi")


# ---- utilization ------------------------------------------------------------------------


def code_usage(base: DataFrame, levels: list[str], width: int, scope: tuple[str, ...] = ()) -> DataFrame:
    """Rows per (scope, level, code); codes outside [0, W) and NULL are left out."""
    pairs = [F.struct(F.lit(name).alias("level"), F.col(name).cast("int").alias("code")) for name in levels]
    long = base.select(*scope, "n", F.inline(F.array(*pairs)))
    return (
        long.where((F.col("code") >= 0) & (F.col("code") < width))
        .groupBy(*scope, "level", "code")
        .agg(F.sum("n").alias("used"))
    )


def usage_dense(base: DataFrame, levels: list[str], width: int) -> DataFrame:
    """The usage vector of every level at full width, zeros included."""
    names = F.array(*[F.lit(name) for name in levels])
    grid = base.sparkSession.range(width).select(
        F.explode(names).alias("level"), F.col("id").cast("int").alias("code")
    )
    counts = code_usage(base, levels, width)
    return grid.join(counts, ["level", "code"], "left").select(
        "level", "code", F.coalesce("used", F.lit(0)).cast("long").alias("used")
    )


def utilization_from_usage(usage: DataFrame, width: int, scope: tuple[str, ...] = ()) -> DataFrame:
    """Entropy and shares per (scope, level) from the code counts; ln N - sum(n ln n) / N."""
    n = F.col("used").cast("double")
    sums = usage.groupBy(*scope, "level").agg(
        F.sum("used").alias("scope_size"),
        F.count(F.lit(1)).alias("live"),
        F.sum(n * F.ln(n)).alias("n_ln_n"),
        F.max("used").alias("top"),
    )
    size = F.col("scope_size").cast("double")
    entropy = F.greatest(F.lit(0.0), F.ln(size) - F.col("n_ln_n") / size)
    return sums.select(
        *scope, "level", "scope_size",
        ((F.lit(width) - F.col("live")) / F.lit(float(width))).alias("dead_code_rate"),
        entropy.alias("entropy"),
        (F.col("top") / size).alias("max_code_share"),
    )


def _finish_utilization(joined: DataFrame, keep: list[str], width: int) -> DataFrame:
    """Fill empty scopes with their fixed record and apply the pass rule."""
    size = F.coalesce("scope_size", F.lit(0)).cast("long")
    filled = joined.select(
        *keep, "level", size.alias("scope_size"), F.lit(width).alias("W"),
        F.coalesce("dead_code_rate", F.lit(1.0)).alias("dead_code_rate"),
        F.coalesce("entropy", F.lit(0.0)).alias("entropy"),
        F.exp(F.coalesce("entropy", F.lit(0.0))).alias("ppl"),
        F.coalesce("max_code_share", F.lit(0.0)).alias("max_code_share"),
    )
    empty = F.col("scope_size") == 0
    utilization = F.when(empty, 0.0).otherwise(F.col("ppl") / F.lit(float(width)))
    qualifies = ~empty & (F.col("scope_size") >= 4 * width)
    spread = (F.col("dead_code_rate") <= 0.10) & (F.col("max_code_share") <= F.lit(10.0 / width))
    passes = ~empty & spread & (~qualifies | (utilization >= 0.5))
    return filled.select(
        *keep, "level", "scope_size", "W", "dead_code_rate", "entropy", "ppl",
        utilization.alias("normalized_utilization"), "max_code_share",
        qualifies.alias("scope_qualifies"), passes.alias("passes"),
    )


def utilization(base: DataFrame, levels: list[str], width: int) -> DataFrame:
    """One record per level over all rows."""
    found = utilization_from_usage(code_usage(base, levels, width), width)
    names = base.sparkSession.createDataFrame([(name,) for name in levels], "level string")
    return _finish_utilization(names.join(found, "level", "left"), [], width)


def utilization_hot(base: DataFrame, levels: list[str], width: int, top_k: int) -> DataFrame:
    """One record per (hot bucket, level), all buckets in one grouped pass."""
    hot = hot_buckets(base, top_k)
    usage = code_usage(_in_buckets(base, hot, top_k), levels, width, BUCKET)
    found = utilization_from_usage(usage, width, BUCKET)
    targets = hot.select("*", F.explode(F.array(*[F.lit(name) for name in levels])).alias("level"))
    joined = targets.join(found, [*BUCKET, "level"], "left")
    return _finish_utilization(joined, [*BUCKET, "bucket_count"], width)


def with_small_scope_ratio(records: DataFrame) -> DataFrame:
    """PPL / min(W, S): the reading for scopes that cannot reach U = 1. 0 for an empty scope."""
    cap = F.least(F.col("W").cast("long"), F.col("scope_size")).cast("double")
    return records.withColumn(
        "small_scope_ratio", F.when(F.col("scope_size") > 0, F.col("ppl") / cap).otherwise(0.0)
    )


def hot_rollup(hot_records: DataFrame) -> DataFrame:
    """Mean and max over the hot buckets per level."""
    return hot_records.groupBy("level").agg(
        F.count(F.lit(1)).alias("buckets"),
        F.avg("dead_code_rate").alias("mean_dead_code_rate"),
        F.max("dead_code_rate").alias("max_dead_code_rate"),
        F.avg("max_code_share").alias("mean_max_code_share"),
        F.max("max_code_share").alias("max_max_code_share"),
    )


# ---- collisions -------------------------------------------------------------------------

QUANTILES = {"p50": 0.5, "p90": 0.9, "p99": 0.99}


def size_histogram(base: DataFrame, levels: list[str], scope: tuple[str, ...] = ()) -> DataFrame:
    """How many tuples have each bucket size. At most sqrt(2N) sizes exist per scope."""
    per_tuple = base.groupBy(*scope, *levels).agg(F.sum("n").alias("bucket_size"))
    whole = F.lit(True)
    for name in levels:
        whole = whole & F.col(name).isNotNull()
    return per_tuple.groupBy(*scope, "bucket_size").agg(
        F.count(F.lit(1)).alias("buckets"), F.count_if(whole).alias("whole_buckets")
    )


def collision_from_histogram(histogram: DataFrame, scope: tuple[str, ...] = ()) -> DataFrame:
    """Rates and row quantiles from the size histogram.

    A quantile is the value at index floor((n - 1) q + 0.5) of the sorted rows (nearest rank, no
    interpolation). The running window has one row per distinct size, not per table row.
    """
    rows = F.col("bucket_size") * F.col("whole_buckets")
    over = Window.partitionBy(*scope)
    running = over.orderBy("bucket_size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = histogram.withColumn("upto", F.sum(rows).over(running)).withColumn("whole", F.sum(rows).over(over))
    size, count = F.col("bucket_size"), F.col("buckets")
    crowded = size > 1
    n = F.coalesce(F.sum(size * count), F.lit(0))
    total = n.cast("double")

    def quantile(q: float) -> Column:
        index = F.floor((F.col("whole") - 1) * F.lit(q) + F.lit(0.5))
        return F.min(F.when(F.col("upto") > index, size)).cast("double")

    return placed.groupBy(*scope).agg(
        n.alias("n"),
        F.try_divide(F.sum(F.when(crowded, size * count).otherwise(0)).cast("double"), total).alias("collision_rate"),
        F.try_divide(F.sum((size - 1) * count).cast("double"), total).alias("dedup_fraction"),
        F.coalesce(F.max(size), F.lit(0)).alias("worst_case_bucket"),
        *[quantile(q).alias(name) for name, q in QUANTILES.items()],
    )


def collision(base: DataFrame, levels: list[str]) -> DataFrame:
    """One record over all rows; an empty table gives n = 0 and NULL rates."""
    return collision_from_histogram(size_histogram(base, levels))


def collision_hot(base: DataFrame, levels: list[str], top_k: int) -> DataFrame:
    """One record per hot bucket; collisions are counted inside the bucket."""
    hot = hot_buckets(base, top_k)
    histogram = size_histogram(_in_buckets(base, hot, top_k), levels, BUCKET)
    found = collision_from_histogram(histogram, BUCKET)
    return found


def collision_verdict(
    overall: DataFrame, hot: DataFrame, max_bucket: int = 300, p99_ratio: float = 2.0
) -> DataFrame:
    """Worst bucket within `max_bucket` and hot p99 within `p99_ratio` of the global p99. One row."""
    worst = hot.agg(F.max("p99").alias("hot_p99"), F.max("worst_case_bucket").alias("hot_worst"))
    joined = overall.select("worst_case_bucket", F.col("p99").alias("global_p99"), F.lit(1).alias("one")).join(
        F.broadcast(worst.withColumn("one", F.lit(1))), "one", "left"
    )
    small = F.col("worst_case_bucket") <= max_bucket
    calm = F.coalesce(F.col("hot_p99") <= F.col("global_p99") * F.lit(p99_ratio), F.lit(True))
    return joined.select(
        "worst_case_bucket", "hot_worst", "global_p99", "hot_p99",
        small.alias("worst_ok"), calm.alias("hot_p99_ok"), (small & calm).alias("passes"),
    )


# ---- taxonomy alignment -----------------------------------------------------------------


def prefix_counts(base: DataFrame, levels: list[str], fields: list[str]) -> DataFrame:
    """Counts per (field, prefix length, taxon, prefix), all in one group-by.

    Every (field, length) is a projection of its own in a union, so a task combines the rows of one
    of them before the single shuffle. A NULL code makes every prefix that contains it one NULL
    prefix, as string concatenation does.
    """
    variants = []
    for field in fields:
        for length in range(1, len(levels) + 1):
            whole = reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in levels[:length]])
            cells = [
                F.when(whole, F.col(name).cast("int")) if i < length else F.lit(None).cast("int")
                for i, name in enumerate(levels)
            ]
            variants.append(
                base.select(
                    F.lit(field).alias("taxonomy_field"),
                    F.lit(length).alias("prefix_length"),
                    F.col(field).cast("string").alias("taxon"),
                    *[cell.alias(f"k{i + 1}") for i, cell in enumerate(cells)],
                    "n",
                )
            )
    keys = [f"k{i + 1}" for i in range(len(levels))]
    long = reduce(DataFrame.unionByName, variants)
    return long.groupBy("taxonomy_field", "prefix_length", "taxon", *keys).agg(F.sum("n").alias("n"))


def alignment(base: DataFrame, levels: list[str], fields: list[str]) -> DataFrame:
    """share_prefix, chance baseline, lift and purity for every (field, prefix length)."""
    section = ["taxonomy_field", "prefix_length"]
    keys = [f"k{i + 1}" for i in range(len(levels))]
    counts = prefix_counts(base, levels, fields).withColumn(
        "known", F.when(F.col("taxon").isNotNull(), F.col("n"))
    )
    n = F.col("n").cast("double")
    # Totals per taxon and per prefix in one grouping-sets pass, so the counts are made once.
    both = counts.groupingSets(
        [[*section, "taxon"], [*section, *keys]], *section, "taxon", *keys
    ).agg(
        F.grouping("taxon").alias("by_prefix"),
        F.sum(n).alias("rows"),
        F.sum(n * (n - 1)).alias("pairs"),
        F.sum("known").alias("known"),
        F.max("known").alias("modal"),
    )
    by_prefix = F.col("by_prefix") == 1
    rows = F.col("rows")
    # n_g * share_g; rows without taxon and taxa of one row add 0
    shared = F.when(~by_prefix & F.col("known").isNotNull() & (rows > 1), F.col("pairs") / (rows - 1))
    sums = both.groupBy(*section).agg(
        F.sum(F.coalesce(shared, F.lit(0.0))).alias("shared"),
        F.sum(F.when(by_prefix, rows).otherwise(0.0)).alias("total"),
        F.sum(F.when(by_prefix, rows * rows).otherwise(0.0)).alias("squares"),
        F.sum(F.when(by_prefix, F.coalesce("modal", F.lit(0))).otherwise(0)).alias("modal"),
    )
    share = F.col("shared") / F.col("total")
    baseline = F.col("squares") / (F.col("total") * F.col("total"))
    return sums.select(
        *section,
        share.alias("share_prefix"),
        baseline.alias("baseline"),
        F.when(baseline > 0, share / baseline).otherwise(F.lit(float("inf"))).alias("lift"),
        (F.col("modal") / F.col("total")).alias("prefix_purity"),
    )


# ---- cold start -------------------------------------------------------------------------


def is_cold(market: str = "is_hot_market", age: str = "launch_age_bucket", youngest: str = "0-7d") -> Column:
    """Recent launches: flagged for a hot market or in the youngest age bucket."""
    return F.coalesce(parse_flag(market), F.lit(False)) | F.coalesce(F.col(age) == youngest, F.lit(False))


def cold_start(
    df: DataFrame, levels: list[str], cold: Column, field: str = TEAM, min_mates: int = 1, fallback_levels: int = 2
) -> DataFrame:
    """How often the tuple-mates of a cold row share its taxon, and the lift over chance. One row.

    A cold row with fewer than `min_mates` tuple-mates is judged by its mates of the shorter prefix.
    Counts are joined to counts; rows are never paired.
    """
    counts = df.groupBy(*levels, field).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(cold).alias("cold")
    )
    short = levels[: min(fallback_levels, len(levels))]
    by_tuple = counts.groupBy(*levels).agg(F.sum("n").alias("tuple_n"))
    by_short = counts.groupBy(*short).agg(F.sum("n").alias("short_n"))
    by_short_field = counts.groupBy(*short, field).agg(F.sum("n").alias("short_same"))
    asked = counts.where((F.col("cold") > 0) & F.col(field).isNotNull())
    judged = (
        asked.join(by_tuple, levels, "left")
        .join(by_short, short, "left")
        .join(by_short_field, [*short, field], "left")
    )
    near = F.col("tuple_n") - 1 >= max(min_mates, 1)
    mates = F.when(near, F.col("tuple_n") - 1).otherwise(F.col("short_n") - 1)
    same = F.when(near, F.col("n") - 1).otherwise(F.col("short_same") - 1)
    share = F.try_divide(same.cast("double"), mates.cast("double"))
    scored = judged.select("cold", share.alias("share"), near.alias("near"))
    found = scored.agg(
        F.coalesce(F.sum("cold"), F.lit(0)).alias("cold_items"),
        F.coalesce(F.sum(F.when(F.col("share").isNotNull(), F.col("cold"))), F.lit(0)).alias("judged_items"),
        F.coalesce(F.sum(F.when(~F.col("near"), F.col("cold"))), F.lit(0)).alias("fallback_items"),
        F.try_divide(
            F.sum(F.col("cold") * F.col("share")),
            F.sum(F.when(F.col("share").isNotNull(), F.col("cold"))).cast("double"),
        ).alias("purity"),
    )
    per_taxon = counts.groupBy(field).agg(F.sum("n").cast("double").alias("n_g"))
    chance = per_taxon.agg(
        F.sum("n_g").alias("total"),
        F.sum(F.when(F.col(field).isNotNull(), F.col("n_g") * F.col("n_g")).otherwise(0.0)).alias("squares"),
    )
    baseline = F.try_divide(F.col("squares"), F.col("total") * F.col("total"))
    both = found.withColumn("one", F.lit(1)).join(F.broadcast(chance.withColumn("one", F.lit(1))), "one")
    return both.select(
        "cold_items", "judged_items", "fallback_items", "purity",
        baseline.alias("baseline"), F.try_divide(F.col("purity"), baseline).alias("lift"),
    )


# ---- the report -------------------------------------------------------------------------


def report_tables(
    df: DataFrame, width: int, num_levels: int, d: int, top_k: int = 20,
    fields: tuple[str, ...] = BUCKET, base: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All sections as tidy tables. Pass `base` as a written table to count the rows only once."""
    levels = level_columns(num_levels)
    if base is None:
        base = base_counts(df, levels, list(dict.fromkeys([*BUCKET, *fields])))
    tables = {
        "utilization": utilization(base, levels, width),
        "utilization_hot": utilization_hot(base, levels, width, top_k),
        "collision": collision(base, levels),
        "collision_hot": collision_hot(base, levels, top_k),
        "alignment": alignment(base, levels, list(fields)),
    }
    tag = {"run_W": width, "run_L": num_levels, "run_d": d}
    return {
        name: table.withColumns({key: F.lit(value) for key, value in tag.items()})
        for name, table in tables.items()
    }


def report_dict(tables: dict[str, DataFrame]) -> dict:
    """The few dozen report rows as one nested dict."""

    def rows(name: str) -> list[dict]:
        return [row.asDict() for row in tables[name].collect()]

    def bare(record: dict, *drop: str) -> dict:
        return {k: v for k, v in record.items() if k not in ("run_W", "run_L", "run_d", *drop)}

    by_level = sorted(rows("utilization"), key=lambda r: int(r["level"][1:]))
    first = by_level[0]
    hot: dict[tuple, dict] = {}
    for row in sorted(rows("utilization_hot"), key=lambda r: (-r["bucket_count"], r[LEAGUE], r[TEAM])):
        entry = hot.setdefault(
            (row[LEAGUE], row[TEAM]),
            {LEAGUE: row[LEAGUE], TEAM: row[TEAM], "bucket_count": row["bucket_count"]},
        )
        entry[row["level"]] = bare(row, "level", LEAGUE, TEAM, "bucket_count")
    place = {key: i for i, key in enumerate(hot)}
    crowded = sorted(rows("collision_hot"), key=lambda r: place.get((r[LEAGUE], r[TEAM]), len(place)))
    aligned = sorted(rows("alignment"), key=lambda r: (r["taxonomy_field"], r["prefix_length"]))
    return {
        "run_config": {"W": first["run_W"], "L": first["run_L"], "d": first["run_d"]},
        "utilization": {
            "global": {row["level"]: bare(row, "level") for row in by_level},
            "hot_buckets": list(hot.values()),
            "level_cols": [row["level"] for row in by_level],
        },
        "collision": {
            "global": bare(rows("collision")[0]),
            "hot_buckets": [bare(row) for row in crowded],
        },
        "taxonomy_alignment": [bare(row) for row in aligned],
    }


def to_json(report: dict) -> str:
    return json.dumps(report, indent=2, default=str)


def to_markdown(report: dict) -> str:
    run, use, crowd = report["run_config"], report["utilization"], report["collision"]["global"]
    # Headings and line formats of the report text.
    heading = "# Code report — W={W}, L={L}, d={d}"
    level_line = (
        "- **{level}**: U={normalized_utilization:.3f}, dead_code_rate={dead_code_rate:.3f}, "
        "M={max_code_share:.4f}, scope_size={scope_size}, passes={passes}"
    )
    bucket_line = "- {league}/{team} (n={bucket_count}):"
    inner_line = "    - {level}: dead_code_rate={dead_code_rate:.3f}, M={max_code_share:.4f}, passes={passes}"
    collision_line = (
        "- collision_rate={collision_rate:.4f}, dedup_fraction={dedup_fraction:.4f}, "
        "worst_case_bucket={worst_case_bucket}, p50/p90/p99={p50:.1f}/{p90:.1f}/{p99:.1f}"
    )
    alignment_line = (
        "- {taxonomy_field} @ l={prefix_length}: lift={lift:.2f} (share={share_prefix:.4f}, "
        "baseline={baseline:.4f}), purity={prefix_purity:.3f}"
    )
    text = [heading.format(**run), "", "## Utilization (global)"]
    text += [level_line.format(level=name, **use["global"][name]) for name in use["level_cols"]]
    text += ["", "## Utilization (hot buckets)"]
    for bucket in use["hot_buckets"]:
        text.append(bucket_line.format(**bucket))
        text += [inner_line.format(level=name, **bucket[name]) for name in use["level_cols"]]
    text += ["", "## Collision (global)"]
    text.append(collision_line.format(**crowd) if crowd["n"] else "- no rows")
    text += ["", "## Taxonomy-prefix alignment"]
    text += [alignment_line.format(**row) for row in report["taxonomy_alignment"]]
    return "\n".join(text)
