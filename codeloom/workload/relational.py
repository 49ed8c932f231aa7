"""Registered queries on the catalog and code views, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom.functions.names import HOT_MARKET, PRODUCT_ID
from codeloom.functions.scalars import id_string, parse_flag, prefix_number, prefix_string
from codeloom.operators import sampling
from codeloom.operators.quantize import add_dedup_index, max_dedup
from codeloom.operators.ranking import ranked
from codeloom.plans import lookup as lk
from codeloom.plans import quality as ql
from codeloom.plans import sweep as sw
from codeloom.session import new_table_path, stored
from codeloom.sources.catalog import read_assignments
from codeloom.sources.prefixes import read_prefix_table, write_prefix_table
from codeloom.sources.tables import code_filter, full_mapping, publish_assignment, write_csv
from codeloom.streaming.buckets import SlotTable
from codeloom.streaming.ingest import append_slots
from codeloom.workload.views import (
    CATALOG_SQL,
    CATALOG_WIDTH,
    LEVELS,
    LINES_SQL,
    LINES_WIDTH,
    MAPPING_SQL,
    catalog,
    flag_sql,
    lines,
    table,
    with_sql,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
TOP_K = 20
BUCKET = ["league", "team"]


def register(name: str, sql: str | None = None):
    def keep(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLE[name] = sql
        return query

    return keep


def rounded(df: DataFrame, digits: int = 8) -> DataFrame:
    return df.select(
        *[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def mapping(spark: SparkSession, sf: str) -> DataFrame:
    return add_dedup_index(catalog(spark, sf), LEVELS)


def hashed(key: str, *seed: object) -> str:
    tail = "".join(f":{part}" for part in seed)
    return f"md5(concat(CAST({key} AS VARCHAR), '{tail}'))"


# ---- preparation ------------------------------------------------------------------------


@register(
    "parse_flags",
    with_sql(CATALOG_SQL)
    + f"SELECT product_id, {flag_sql('is_hot_market')} AS flag FROM cat",
)
def parse_flags(spark, sf):
    return catalog(spark, sf).select(PRODUCT_ID, parse_flag(HOT_MARKET).alias("flag"))


@register(
    "stratified_split",
    with_sql(CATALOG_SQL)
    + f"""SELECT product_id, league, team, r <= CASE WHEN n < 2 THEN 0
      ELSE greatest(1, least(CAST(floor(n * 0.1 + 0.5) AS BIGINT), n - 1)) END AS is_val
    FROM (SELECT *, row_number() OVER (PARTITION BY league, team ORDER BY {hashed('product_id', 42)}, product_id) AS r,
      count(*) OVER (PARTITION BY league, team) AS n FROM cat)""",
)
def stratified_split(spark, sf):
    narrow = catalog(spark, sf).select(PRODUCT_ID, *BUCKET)
    return sampling.with_split(narrow, 0.1, 42, BUCKET)


def hot_sql(source: str) -> str:
    return f"""hot AS MATERIALIZED (SELECT league, team, count(*) AS bucket_count FROM {source}
  WHERE league IS NOT NULL AND team IS NOT NULL GROUP BY league, team
  ORDER BY bucket_count DESC, league, team LIMIT {TOP_K})"""


HOT_SQL = hot_sql("cat")


@register("hot_buckets", with_sql(CATALOG_SQL, HOT_SQL) + "SELECT * FROM hot")
def hot_buckets(spark, sf):
    return sampling.top_k_hot_buckets(catalog(spark, sf), TOP_K)


@register(
    "hot_membership",
    with_sql(CATALOG_SQL, HOT_SQL)
    + """SELECT product_id, EXISTS (SELECT 1 FROM hot h WHERE h.league = cat.league AND h.team = cat.team)
      AS is_hot_bucket FROM cat""",
)
def hot_membership(spark, sf):
    df = catalog(spark, sf)
    flagged = sampling.flag_hot_bucket_membership(df, sampling.top_k_hot_buckets(df, TOP_K), TOP_K)
    return flagged.select(PRODUCT_ID, "is_hot_bucket")


WEIGHT_SQL = f"""weighted AS MATERIALIZED (SELECT cat.product_id,
  CAST(CASE WHEN hot.league IS NULL THEN 1.0 ELSE 5.0 END * CASE WHEN {flag_sql('is_hot_market')} THEN 5.0 ELSE 1.0 END
    AS DOUBLE) AS sample_weight
  FROM cat LEFT JOIN hot ON cat.league = hot.league AND cat.team = hot.team)"""


@register("sample_weights", with_sql(CATALOG_SQL, HOT_SQL, WEIGHT_SQL) + "SELECT * FROM weighted")
def sample_weights(spark, sf):
    return sampling.add_sample_weight(catalog(spark, sf), TOP_K, 5.0, 5.0).select(PRODUCT_ID, "sample_weight")


# One row with so large a weight that it is drawn about as often as there are rows.
RAISED = "sample_weight * CASE WHEN product_id = 7 THEN CAST(100000000 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END"


def drawn_sql(weight: str, rows: str) -> str:
    """Poisson copies in SQL: the distribution summed up below a rate of 10, the first accepted trial from there on."""
    number = lambda text: f"(CAST(CAST(('0x' || substr({text}, 1, 13)) AS BIGINT) AS DOUBLE) + {{half}}) / {float(16**13)}"
    trial = lambda name: number(f"md5(concat(CAST(product_id AS VARCHAR), ':42:0:', CAST(t AS VARCHAR), ':{name}'))").format(half=0.5)
    return with_sql(
        CATALOG_SQL, HOT_SQL, WEIGHT_SQL,
        f"raised AS (SELECT product_id, {weight} AS sample_weight FROM weighted)",
        "totals AS (SELECT CAST(count(*) AS DOUBLE) AS n, sum(sample_weight) AS w FROM raised)",
        f"""rates AS MATERIALIZED (SELECT product_id, sample_weight, sample_weight * ({rows} / w) AS rate,
          {number(hashed('product_id', 42, 0)).format(half=0.0)} AS u FROM raised, totals)""",
        "distinct_rates AS (SELECT DISTINCT rate FROM rates WHERE rate < 10)",
        """cdf AS MATERIALIZED (SELECT rate, k, sum(exp(-rate + k * ln(rate) - CASE WHEN k < 2 THEN 0 ELSE lgamma(k + 1) END))
          OVER (PARTITION BY rate ORDER BY k) AS below FROM distinct_rates, unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 12) AS BIGINT))) AS g(k))""",
        f"""trials AS (SELECT product_id, rate, t, {trial('u')} - 0.5 AS u, {trial('v')} AS v, 0.931 + 2.53 * sqrt(rate) AS b
          FROM rates, unnest(range(0, 24)) AS g(t) WHERE rate >= 10)""",
        "shaped AS (SELECT *, -0.059 + 0.02483 * b AS a, 0.5 - abs(u) AS us FROM trials)",
        "tried AS (SELECT *, floor((2 * a / us + b) * u + rate + 0.43) AS k FROM shaped)",
        """taken AS (SELECT product_id, CAST(arg_min(k, t) AS BIGINT) AS copies FROM tried
          WHERE (us >= 0.07 AND v <= 0.9277 - 3.6224 / (b - 2)) OR (k >= 0 AND NOT (us < 0.013 AND v > us)
            AND ln(v * (1.1239 + 1.1328 / (b - 3.4)) / (a / (us * us) + b)) <= k * ln(rate) - rate - lgamma(CASE WHEN k >= 0 THEN k + 1 ELSE 1 END))
          GROUP BY product_id)""",
    ) + """SELECT r.product_id, r.sample_weight, count(c.k) AS copies FROM rates r
      LEFT JOIN cdf c ON c.rate = r.rate AND r.u >= c.below AND c.k < ceil(r.rate + 12 * sqrt(r.rate) + 12) WHERE r.rate < 10 GROUP BY ALL
      UNION ALL SELECT product_id, sample_weight, copies FROM rates JOIN taken USING (product_id)"""


def drawn(spark: SparkSession, sf: str, weight: str, rows: int | None = None) -> DataFrame:
    weighted = sampling.add_sample_weight(catalog(spark, sf), TOP_K, 5.0, 5.0).selectExpr(PRODUCT_ID, f"{weight} AS sample_weight")
    totals = weighted.agg(F.count(F.lit(1)).alias("n"), F.sum("sample_weight").alias("w")).first()
    return sampling.resample_copies(weighted, rows or totals["n"], totals["w"], 42, 0)


@register("resample_copies", drawn_sql(RAISED, "n"))
def resample_copies(spark, sf):
    return drawn(spark, sf, RAISED)


MIXED_RATES = (
    "sample_weight * CASE WHEN product_id = 7 THEN CAST(1000000 AS DOUBLE) WHEN product_id % 3 = 0 THEN CAST(0.01 AS DOUBLE) "
    "ELSE CAST(1 + product_id % 50 AS DOUBLE) END"
)


@register("resample_many", drawn_sql(MIXED_RATES, "1e6"))
def resample_many(spark, sf):
    """A million draws: rates from below one to about a million."""
    return drawn(spark, sf, MIXED_RATES, 1_000_000)


@register(
    "uniform_sample",
    with_sql(LINES_SQL)
    + f"SELECT product_id, league, team FROM big ORDER BY {hashed('product_id', 3)}, product_id LIMIT 500",
)
def uniform_sample(spark, sf):
    return sampling.uniform_sample(lines(spark, sf).select(PRODUCT_ID, *BUCKET), 500, 3)


# ---- codes, ids, slots ------------------------------------------------------------------

SLOT = "CAST(row_number() OVER (PARTITION BY c1, c2, c3 ORDER BY product_id) - 1 AS INT)"


@register("dedup_slots", with_sql(LINES_SQL) + f"SELECT product_id, c1, c2, c3, {SLOT} AS dedup FROM big")
def dedup_slots(spark, sf):
    return add_dedup_index(lines(spark, sf).select(PRODUCT_ID, *LEVELS), LEVELS)


@register(
    "dedup_slots_split",
    with_sql(LINES_SQL) + "SELECT product_id, c3, CAST(row_number() OVER (PARTITION BY c3 ORDER BY product_id) - 1 AS INT) AS dedup FROM big",
)
def dedup_slots_split(spark, sf):
    """Seven groups, each above the limit: all are cut along the key and ranked chunk by chunk."""
    return add_dedup_index(lines(spark, sf).select(PRODUCT_ID, "c3"), ["c3"], hot_rows=100)


@register(
    "slots_by_text",
    with_sql(LINES_SQL)
    + """SELECT product_id, league, row_number() OVER (PARTITION BY league ORDER BY 'all', team, 'k' || CAST(product_id AS VARCHAR)) AS place,
      count(*) OVER (PARTITION BY league) AS league_size FROM big""",
)
def slots_by_text(spark, sf):
    """Three groups cut along a sort key of texts whose first column is constant."""
    texts = lines(spark, sf).select(
        PRODUCT_ID, "league", "team", F.lit("all").alias("first"), F.concat(F.lit("k"), F.col(PRODUCT_ID).cast("string")).alias("name")
    )
    placed = ranked(texts, ["league"], ["first", "team", "name"], rank="place", size="league_size", hot_rows=100)
    return placed.select(PRODUCT_ID, "league", "place", "league_size")


@register(
    "max_dedup",
    with_sql(LINES_SQL)
    + f"""SELECT CAST(coalesce(max(d), 0) AS INT) AS max_dedup, CAST(coalesce(max(d), 0) + 1 AS INT) AS worst_case_bucket
      FROM (SELECT {SLOT} AS d FROM big)""",
)
def worst_slot(spark, sf):
    return max_dedup(lines(spark, sf), LEVELS)


@register(
    "bucket_size_per_row",
    with_sql(LINES_SQL) + "SELECT product_id, count(*) OVER (PARTITION BY c1, c2, c3) AS bucket_size FROM big",
)
def bucket_size_per_row(spark, sf):
    placed = ranked(lines(spark, sf).select(PRODUCT_ID, *LEVELS), LEVELS, [PRODUCT_ID], size="bucket_size")
    return placed.select(PRODUCT_ID, "bucket_size")


@register(
    "id_strings",
    with_sql(CATALOG_SQL, MAPPING_SQL)
    + f"""SELECT product_id, concat(c1, '-', c2, '-', c3, '-', dedup) AS code_id, concat(c1, '_', c2) AS prefix,
      CAST((c1 * {CATALOG_WIDTH} + c2) AS BIGINT) AS feature_2, CAST((c1 * {CATALOG_WIDTH} + c2) * {CATALOG_WIDTH} + c3 AS BIGINT)
      AS feature_3 FROM mapping""",
)
def id_strings(spark, sf):
    return mapping(spark, sf).select(
        PRODUCT_ID, id_string(LEVELS).alias("code_id"), prefix_string(LEVELS[:2]).alias("prefix"),
        prefix_number(LEVELS[:2], CATALOG_WIDTH).alias("feature_2"),
        prefix_number(LEVELS, CATALOG_WIDTH).alias("feature_3"),
    )


@register(
    "code_filter", with_sql(LINES_SQL) + "SELECT product_id, c1, c2, c3 FROM big WHERE c1 = 5 AND c2 = 7"
)
def filtered_codes(spark, sf):
    return lines(spark, sf).where(code_filter(LEVELS, [5, 7])).select(PRODUCT_ID, *LEVELS)


@register(
    "metadata_for_ids",
    with_sql(CATALOG_SQL)
    + """SELECT product_id, league, team, product_name FROM cat
      WHERE product_id IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 45)""",
)
def metadata_for_ids(spark, sf):
    asked = table(spark, sf, "lineitem").where("l_quantity >= 45").select(F.col("l_partkey").alias(PRODUCT_ID))
    return catalog(spark, sf).join(asked, PRODUCT_ID, "left_semi").select(PRODUCT_ID, *BUCKET, "product_name")


@register(
    "publish_roundtrip",
    with_sql(CATALOG_SQL, MAPPING_SQL)
    + """SELECT product_id, c1, c2, c3, dedup, 'set-1' AS embedding_set_version, v AS code_version
      FROM mapping, (VALUES ('v1'), ('v2')) AS versions(v)""",
)
def publish_roundtrip(spark, sf):
    path = new_table_path(spark, "published")
    codes = mapping(spark, sf).select(PRODUCT_ID, *LEVELS, "dedup")
    for version in ("v1", "v2", "v2"):
        publish_assignment(codes, path, version, "set-1", len(LEVELS))
    return read_assignments(spark, path)


@register(
    "full_mapping",
    with_sql(CATALOG_SQL, MAPPING_SQL, "known AS (SELECT * FROM cat WHERE league IS NOT NULL)")
    + """SELECT m.product_id, concat(m.c1, '-', m.c2, '-', m.c3, '-', m.dedup) AS code_id, m.c1, m.c2, m.c3, m.dedup,
      k.league, k.team, k.brand, k.color, k.product_name, k.price_band, k.is_hot_market, k.launch_age_bucket
      FROM mapping m LEFT JOIN known k USING (product_id)""",
)
def mapped(spark, sf):
    source = catalog(spark, sf).where("league IS NOT NULL").drop(*LEVELS)
    return full_mapping(mapping(spark, sf).select(PRODUCT_ID, *LEVELS, "dedup"), source)


@register(
    "joined_counts",
    with_sql(CATALOG_SQL, "taxonomy AS (SELECT product_id, league, team FROM cat WHERE team <> 'Brand#1')")
    + """SELECT t.league, t.team, c.c1, count(*) AS n FROM cat c JOIN taxonomy t USING (product_id)
      GROUP BY t.league, t.team, c.c1""",
)
def joined_counts(spark, sf):
    df = catalog(spark, sf)
    taxonomy = df.where("team <> 'Brand#1'").select(PRODUCT_ID, *BUCKET)
    joined = df.select(PRODUCT_ID, "c1").join(taxonomy, PRODUCT_ID, "inner")
    return ql.base_counts(joined, ["c1"], BUCKET)


# ---- quality ----------------------------------------------------------------------------


def base(df: DataFrame) -> DataFrame:
    return ql.base_counts(df, LEVELS, BUCKET)


def usage_sql(source: str, scope: str = "") -> str:
    cells = " UNION ALL ".join(
        f"SELECT {scope} '{c}' AS level, {c} AS code, count(*) AS used FROM {source} GROUP BY {scope} code" for c in LEVELS
    )
    return f"usage AS MATERIALIZED ({cells})"


def records_sql(width: int, scope: str = "", name: str = "records") -> str:
    return f"""{name} AS MATERIALIZED (SELECT {scope} level, CAST(sum(used) AS BIGINT) AS scope_size, {width} AS "W",
      ({width} - count(*)) / {width}.0e0 AS dead_code_rate, -sum(p * ln(p)) AS entropy, exp(-sum(p * ln(p))) AS ppl,
      exp(-sum(p * ln(p))) / {width}.0e0 AS normalized_utilization, max(p) AS max_code_share,
      sum(used) >= 4 * {width} AS scope_qualifies
      FROM (SELECT *, used / CAST(sum(used) OVER (PARTITION BY {scope} level) AS DOUBLE) AS p FROM usage)
      GROUP BY {scope} level)"""


def record_columns(width: int) -> str:
    return f"""level, scope_size, "W", round(dead_code_rate, 8) AS dead_code_rate, round(entropy, 8) AS entropy,
      round(ppl, 8) AS ppl, round(normalized_utilization, 8) AS normalized_utilization,
      round(max_code_share, 8) AS max_code_share, scope_qualifies,
      dead_code_rate <= 0.10 AND max_code_share <= 10.0e0 / {width}
        AND (NOT scope_qualifies OR normalized_utilization >= 0.5) AS passes"""


@register(
    "utilization_global",
    with_sql(LINES_SQL, usage_sql("big"), records_sql(LINES_WIDTH)) + f"SELECT {record_columns(LINES_WIDTH)} FROM records",
)
def utilization_global(spark, sf):
    return rounded(ql.utilization(base(lines(spark, sf)), LEVELS, LINES_WIDTH))




def hot_rows_sql(source: str) -> str:
    return f"hot_rows AS MATERIALIZED (SELECT {source}.* FROM {source} JOIN hot USING (league, team))"


HOT_ROWS_SQL = hot_rows_sql("cat")
HOT_RECORDS = with_sql(
    CATALOG_SQL, HOT_SQL, HOT_ROWS_SQL, usage_sql("hot_rows", "league, team,"),
    records_sql(CATALOG_WIDTH, "league, team,"),
)


@register(
    "utilization_hot",
    HOT_RECORDS
    + f"SELECT league, team, bucket_count, {record_columns(CATALOG_WIDTH)} FROM records JOIN hot USING (league, team)",
)
def utilization_hot(spark, sf):
    return rounded(ql.utilization_hot(base(catalog(spark, sf)), LEVELS, CATALOG_WIDTH, TOP_K))


@register(
    "small_scope_ratio",
    HOT_RECORDS
    + f"""SELECT league, team, level, round(ppl / least({CATALOG_WIDTH}, scope_size), 8) AS small_scope_ratio FROM records""",
)
def small_scope_ratio(spark, sf):
    records = ql.utilization_hot(base(catalog(spark, sf)), LEVELS, CATALOG_WIDTH, TOP_K)
    return rounded(ql.with_small_scope_ratio(records).select(*BUCKET, "level", "small_scope_ratio"))


@register(
    "hot_rollup",
    HOT_RECORDS
    + """SELECT level, count(*) AS buckets, round(avg(dead_code_rate), 8) AS mean_dead_code_rate,
      round(max(dead_code_rate), 8) AS max_dead_code_rate, round(avg(max_code_share), 8) AS mean_max_code_share,
      round(max(max_code_share), 8) AS max_max_code_share FROM records GROUP BY level""",
)
def hot_rollup(spark, sf):
    return rounded(ql.hot_rollup(ql.utilization_hot(base(catalog(spark, sf)), LEVELS, CATALOG_WIDTH, TOP_K)))


@register(
    "usage_dense",
    with_sql(CATALOG_SQL, usage_sql("cat"))
    + f"""SELECT l.level, CAST(g.k AS INT) AS code, coalesce(u.used, 0) AS used
      FROM (VALUES ('c1'), ('c2'), ('c3')) AS l(level), range(0, {CATALOG_WIDTH}) AS g(k)
      LEFT JOIN usage u ON u.level = l.level AND u.code = g.k""",
)
def usage_dense(spark, sf):
    return ql.usage_dense(base(catalog(spark, sf)), LEVELS, CATALOG_WIDTH)


def collision_sql(source: str, scope: str = "") -> str:
    sizes = f"""sizes AS MATERIALIZED (SELECT {scope} n_t, row_number() OVER ({'PARTITION BY ' + scope.rstrip(', ') if scope else ''}
        ORDER BY n_t) - 1 AS i, count(*) OVER ({'PARTITION BY ' + scope.rstrip(', ') if scope else ''}) AS n
      FROM (SELECT {scope} count(*) OVER (PARTITION BY {scope} c1, c2, c3) AS n_t FROM {source}))"""
    quantiles = ", ".join(
        f"CAST(max(n_t) FILTER (i = CAST(floor((n - 1) * {q}e0 + 0.5) AS BIGINT)) AS DOUBLE) AS {name}"
        for name, q in ql.QUANTILES.items()
    )
    grouped = f"GROUP BY {scope.rstrip(', ')}" if scope else ""
    return f"""{sizes},
    collisions AS MATERIALIZED (SELECT {scope} count(*) AS n,
      count(*) FILTER (n_t > 1) / CAST(count(*) AS DOUBLE) AS collision_rate,
      sum((n_t - 1) / CAST(n_t AS DOUBLE)) / count(*) AS dedup_fraction, max(n_t) AS worst_case_bucket, {quantiles}
      FROM sizes {grouped})"""


COLLISION_COLUMNS = """n, round(collision_rate, 8) AS collision_rate, round(dedup_fraction, 8) AS dedup_fraction,
  worst_case_bucket, p50, p90, p99"""


@register("collision_global", with_sql(LINES_SQL, collision_sql("big")) + f"SELECT {COLLISION_COLUMNS} FROM collisions")
def collision_global(spark, sf):
    return rounded(ql.collision(base(lines(spark, sf)), LEVELS))


@register(
    "collision_hot",
    with_sql(CATALOG_SQL, HOT_SQL, HOT_ROWS_SQL, collision_sql("hot_rows", "league, team,"))
    + f"SELECT league, team, {COLLISION_COLUMNS} FROM collisions",
)
def collision_hot(spark, sf):
    return rounded(ql.collision_hot(base(catalog(spark, sf)), LEVELS, TOP_K))


def verdict_sql(source: str) -> str:
    return f"""SELECT o.worst_case_bucket, h.hot_worst, o.p99 AS global_p99, h.hot_p99, o.worst_case_bucket <= 300 AS worst_ok,
      h.hot_p99 <= 2 * o.p99 AS hot_p99_ok, o.worst_case_bucket <= 300 AND h.hot_p99 <= 2 * o.p99 AS passes
    FROM (WITH {collision_sql(source)} SELECT * FROM collisions) o,
      (WITH {collision_sql('hot_rows', 'league, team,')}
        SELECT max(p99) AS hot_p99, max(worst_case_bucket) AS hot_worst FROM collisions) h"""


@register("collision_verdict", with_sql(CATALOG_SQL, HOT_SQL, HOT_ROWS_SQL) + verdict_sql("cat"))
def collision_verdict(spark, sf):
    counts = base(catalog(spark, sf))
    return ql.collision_verdict(ql.collision(counts, LEVELS), ql.collision_hot(counts, LEVELS, TOP_K))


def alignment_sql(source: str) -> str:
    parts = []
    for field in BUCKET:
        for length in range(1, len(LEVELS) + 1):
            cols = ", ".join(LEVELS[:length])
            parts.append(
                f"""SELECT '{field}' AS taxonomy_field, {length} AS prefix_length, share AS share_prefix, baseline,
          share / baseline AS lift, purity AS prefix_purity FROM (SELECT
          (SELECT coalesce(sum(CASE WHEN n_g > 1 THEN pairs / CAST(n_g - 1 AS DOUBLE) ELSE 0 END), 0)
             / CAST((SELECT count(*) FROM {source}) AS DOUBLE) FROM
             (SELECT g, sum(n) AS n_g, sum(n * (n - 1)) AS pairs FROM
               (SELECT {field} AS g, {cols}, count(*) AS n FROM {source} WHERE {field} IS NOT NULL GROUP BY ALL) GROUP BY g)) AS share,
          (SELECT sum(power(n / CAST((SELECT count(*) FROM {source}) AS DOUBLE), 2)) FROM
             (SELECT {cols}, count(*) AS n FROM {source} GROUP BY ALL)) AS baseline,
          (SELECT sum(m) / CAST((SELECT count(*) FROM {source}) AS DOUBLE) FROM
             (SELECT {cols}, max(n) AS m FROM (SELECT {field} AS g, {cols}, count(*) AS n FROM {source}
                WHERE {field} IS NOT NULL GROUP BY ALL) GROUP BY {cols})) AS purity)"""
            )
    return (
        "SELECT taxonomy_field, prefix_length, round(share_prefix, 10) AS share_prefix, round(baseline, 10) AS baseline, "
        "round(lift, 10) AS lift, round(prefix_purity, 10) AS prefix_purity FROM (" + " UNION ALL ".join(parts) + ")"
    )


@register("alignment", with_sql(CATALOG_SQL) + alignment_sql("cat"))
def alignment(spark, sf):
    return rounded(ql.alignment(base(catalog(spark, sf)), LEVELS, BUCKET), 10)


@register("alignment_lines", with_sql(LINES_SQL) + alignment_sql("big"))
def alignment_lines(spark, sf):
    return rounded(ql.alignment(base(lines(spark, sf)), LEVELS, BUCKET), 10)


@register(
    "cold_start",
    with_sql(
        CATALOG_SQL,
        f"""flagged AS MATERIALIZED (SELECT *, coalesce({flag_sql('is_hot_market')}, false) OR launch_age_bucket = '0-7d'
          AS cold FROM cat)""",
        """scored AS (SELECT cold,
          count(*) OVER (PARTITION BY c1, c2, c3) - 1 AS mates, count(*) OVER (PARTITION BY c1, c2, c3, team) - 1 AS same,
          count(*) OVER (PARTITION BY c1, c2) - 1 AS mates2, count(*) OVER (PARTITION BY c1, c2, team) - 1 AS same2
          FROM flagged)""",
        """cold_rows AS (SELECT mates < 1 AS fallback, CASE WHEN mates >= 1 THEN same / CAST(mates AS DOUBLE)
          WHEN mates2 >= 1 THEN same2 / CAST(mates2 AS DOUBLE) END AS share FROM scored WHERE cold)""",
        """chance AS (SELECT sum(n * n) / CAST(sum(n) * sum(n) AS DOUBLE) AS baseline
          FROM (SELECT team, count(*) AS n FROM cat GROUP BY team))""",
    )
    + """SELECT count(*) AS cold_items, count(share) AS judged_items, count(*) FILTER (fallback) AS fallback_items,
      round(avg(share), 8) AS purity, round(any_value(baseline), 8) AS baseline,
      round(avg(share) / any_value(baseline), 8) AS lift FROM cold_rows, chance""",
)
def cold_start(spark, sf):
    return rounded(ql.cold_start(catalog(spark, sf), LEVELS, ql.is_cold()))


def _yes(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'True' ELSE 'False' END"


REPORT_SQL = (
    with_sql(
        LINES_SQL, hot_sql("big"), hot_rows_sql("big"),
        usage_sql("big"), records_sql(LINES_WIDTH, "", "all_records"),
        usage_sql("hot_rows", "league, team,").replace("usage AS", "hot_usage AS"),
        records_sql(LINES_WIDTH, "league, team,", "hot_records").replace("FROM usage)", "FROM hot_usage)"),
        f"g AS (SELECT {record_columns(LINES_WIDTH)} FROM all_records)",
        f"h AS (SELECT league, team, {record_columns(LINES_WIDTH)} FROM hot_records)",
        "ordered AS (SELECT *, row_number() OVER (ORDER BY bucket_count DESC, league, team) AS place FROM hot)",
        collision_sql("big"),
        f"aligned AS ({alignment_sql('big')})",
        f"""parts(a, b, c, line) AS (
          SELECT 0, 0, 0, '# Code report — W={LINES_WIDTH}, L={len(LEVELS)}, d=32' UNION ALL SELECT 1, 0, 0, ''
          UNION ALL SELECT 2, 0, 0, '## Utilization (global)'
          UNION ALL SELECT 3, 0, CAST(substr(level, 2) AS INT), printf('- **%s**: U=%.3f, dead_code_rate=%.3f, M=%.4f, scope_size=%d, passes=%s',
            level, normalized_utilization, dead_code_rate, max_code_share, scope_size, {_yes('passes')}) FROM g
          UNION ALL SELECT 4, 0, 0, '' UNION ALL SELECT 5, 0, 0, '## Utilization (hot buckets)'
          UNION ALL SELECT 6, place, 0, printf('- %s/%s (n=%d):', league, team, bucket_count) FROM ordered
          UNION ALL SELECT 6, place, CAST(substr(level, 2) AS INT), printf('    - %s: dead_code_rate=%.3f, M=%.4f, passes=%s',
            level, dead_code_rate, max_code_share, {_yes('passes')}) FROM h JOIN ordered USING (league, team)
          UNION ALL SELECT 7, 0, 0, '' UNION ALL SELECT 8, 0, 0, '## Collision (global)'
          UNION ALL SELECT 9, 0, 0, printf('- collision_rate=%.4f, dedup_fraction=%.4f, worst_case_bucket=%d, p50/p90/p99=%.1f/%.1f/%.1f',
            collision_rate, dedup_fraction, worst_case_bucket, p50, p90, p99) FROM collisions
          UNION ALL SELECT 10, 0, 0, '' UNION ALL SELECT 11, 0, 0, '## Taxonomy-prefix alignment'
          UNION ALL SELECT 12, CASE taxonomy_field WHEN 'league' THEN 0 ELSE 1 END, prefix_length,
            printf('- %s @ l=%d: lift=%.2f (share=%.4f, baseline=%.4f), purity=%.3f', taxonomy_field, prefix_length, lift,
              share_prefix, baseline, prefix_purity) FROM aligned)""",
    )
    + "SELECT CAST(row_number() OVER (ORDER BY a, b, c) - 1 AS INT) AS line_number, line FROM parts"
)


@register("report_text", REPORT_SQL)
def report_text(spark, sf):
    """The Markdown report of the code table, line by line."""
    with stored(base(lines(spark, sf)), "counts") as counts:
        tables = ql.report_tables(counts, LINES_WIDTH, len(LEVELS), 32, TOP_K, base=counts)
        text = ql.to_markdown(ql.report_dict(tables)).split("\n")
    return spark.createDataFrame(list(enumerate(text)), "line_number int, line string")


# ---- lookups ----------------------------------------------------------------------------

# One query per part: prefixes, exact ids and unusable texts.
QUERY_TEXT = (
    "CASE p_partkey % 7 WHEN 0 THEN concat(CAST(p_size % 16 AS STRING), '-', CAST(p_partkey % 12 AS STRING)) "
    "WHEN 1 THEN concat(CAST(p_size % 16 AS STRING), ', ', CAST((p_partkey * 7 + p_size) % 12 AS STRING), ' / ', "
    "CAST((p_partkey * 13) % 10 AS STRING)) "
    "WHEN 2 THEN concat('x', CAST(p_size AS STRING), ' 1') WHEN 3 THEN '  ' "
    "WHEN 4 THEN concat(CAST(p_size % 16 AS STRING), '-', CAST((p_partkey * 7 + p_size) % 12 AS STRING), '-', "
    "CAST((p_partkey * 13) % 10 AS STRING), '-0') "
    "WHEN 5 THEN concat('+', CAST(p_size % 16 AS STRING)) ELSE '1-2-3-4-5' END"
)
LIMIT = 20
PARSED_SQL = [
    f"asked AS MATERIALIZED (SELECT p_partkey AS query_id, {QUERY_TEXT} AS query FROM part)",
    """pieces AS MATERIALIZED (SELECT *, list_filter(string_split_regex(query, '[\\s,/\\-]+'), lambda x: x <> '') AS p FROM asked)""",
    """parsed AS MATERIALIZED (SELECT *, CASE WHEN error IS NULL THEN list_transform(p, lambda x: CAST(replace(x, '+', '') AS BIGINT)) END AS tokens
      FROM (SELECT *, CASE WHEN len(p) = 0 THEN 'Query is empty.'
        WHEN len(list_filter(p, lambda x: NOT regexp_full_match(x, '[+]?[0-9]+(_[0-9]+)*'))) > 0
          THEN concat('''', list_filter(p, lambda x: NOT regexp_full_match(x, '[+]?[0-9]+(_[0-9]+)*'))[1], ''' is not an integer token.')
        WHEN len(p) > 4 THEN concat('Too many tokens (', len(p), '); expected at most 4 (c1..c3 + dedup).') END AS error FROM pieces))""",
]
MATCH_SQL = """matches AS MATERIALIZED (SELECT q.query_id, m.product_id FROM parsed q JOIN mapping m ON q.error IS NULL AND m.c1 = q.tokens[1]
  AND (len(q.tokens) < 2 OR m.c2 = q.tokens[2]) AND (len(q.tokens) < 3 OR m.c3 = q.tokens[3]) AND (len(q.tokens) < 4 OR m.dedup = q.tokens[4]))"""


def asked_queries(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").selectExpr("p_partkey AS query_id", f"{QUERY_TEXT} AS query")


@register(
    "parse_queries",
    with_sql(*PARSED_SQL)
    + "SELECT query_id, query, error, CAST(len(tokens) AS INT) AS token_count, array_to_string(tokens, '-') AS token_key FROM parsed",
)
def parse_queries(spark, sf):
    parsed = lk.parse_queries(asked_queries(spark, sf), len(LEVELS))
    return parsed.select("query_id", "query", "error", F.size("tokens").alias("token_count"), "token_key").withColumn(
        "token_count", F.when(F.col("error").isNull(), F.col("token_count"))
    )


SUMMARY_SQL = (
    with_sql(CATALOG_SQL, MAPPING_SQL, *PARSED_SQL, MATCH_SQL)
    + f"""SELECT q.query_id, q.query, CAST(CASE WHEN q.error IS NULL THEN least(len(q.tokens), 3) ELSE 0 END AS INT) AS matched_levels,
      coalesce(q.error IS NULL AND len(q.tokens) = 4, false) AS is_exact, count(m.product_id) AS total_count,
      count(m.product_id) > {LIMIT} AS truncated, q.error
      FROM parsed q LEFT JOIN matches m USING (query_id) GROUP BY ALL"""
)
ROWS_SQL = (
    with_sql(CATALOG_SQL, MAPPING_SQL, *PARSED_SQL, MATCH_SQL)
    + f"""SELECT query_id, CAST(rank AS INT) AS rank, product_id, c.team, c.product_name FROM
      (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY product_id) AS rank FROM matches)
      JOIN cat c USING (product_id) WHERE rank <= {LIMIT}"""
)


@register("prefix_summary", SUMMARY_SQL)
def prefix_summary(spark, sf):
    return lk.by_prefix(asked_queries(spark, sf), mapping(spark, sf), LIMIT)[0]


@register("prefix_rows", ROWS_SQL)
def prefix_rows(spark, sf):
    rows = lk.by_prefix(asked_queries(spark, sf), mapping(spark, sf), LIMIT)[1]
    return rows.select("query_id", "rank", PRODUCT_ID, "team", "product_name")


def sorted_answers(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    path = new_table_path(spark, "prefixes")
    write_prefix_table(mapping(spark, sf), path)
    rows, layout = read_prefix_table(spark, path)
    return lk.by_prefix(asked_queries(spark, sf), rows, LIMIT, layout=layout)


@register("prefix_range_summary", SUMMARY_SQL)
def prefix_range_summary(spark, sf):
    """The same on a mapping stored sorted by its packed key."""
    return sorted_answers(spark, sf)[0]


@register("prefix_range_rows", ROWS_SQL)
def prefix_range_rows(spark, sf):
    return sorted_answers(spark, sf)[1].select("query_id", "rank", PRODUCT_ID, "team", "product_name")


@register(
    "lookup",
    with_sql(CATALOG_SQL, MAPPING_SQL, "asked AS (SELECT DISTINCT o_custkey * 3 AS product_id FROM orders)")
    + """SELECT m.product_id, concat(m.c1, '-', m.c2, '-', m.c3, '-', m.dedup) AS code_id, m.c1, m.c2, m.c3, m.dedup, m.bucket_size,
      m.league, m.team, m.brand, m.launch_age_bucket
      FROM (SELECT *, count(*) OVER (PARTITION BY c1, c2, c3) AS bucket_size FROM mapping) m JOIN asked USING (product_id)""",
)
def lookup(spark, sf):
    ids = table(spark, sf, "orders").select((F.col("o_custkey") * 3).cast("string").alias(PRODUCT_ID))
    found = lk.lookup(ids, mapping(spark, sf))
    return found.select(PRODUCT_ID, "code_id", *LEVELS, "dedup", "bucket_size", *BUCKET, "brand", "launch_age_bucket")


@register(
    "tuple_mates",
    with_sql(CATALOG_SQL, MAPPING_SQL, "asked AS (SELECT DISTINCT s_suppkey AS product_id FROM supplier)")
    + f"""SELECT query_id, CAST(rank AS INT) AS rank, product_id FROM (SELECT a.product_id AS query_id, b.product_id,
      row_number() OVER (PARTITION BY a.product_id ORDER BY b.product_id) AS rank
      FROM mapping a JOIN asked USING (product_id) JOIN mapping b ON a.c1 = b.c1 AND a.c2 = b.c2 AND a.c3 = b.c3)""",
)
def tuple_mates(spark, sf):
    ids = table(spark, sf, "supplier").select(F.col("s_suppkey").alias(PRODUCT_ID))
    return lk.tuple_mates(ids, mapping(spark, sf)).select("query_id", "rank", PRODUCT_ID)


# Pairs of parts, also with a part that has the same codes but for the last, and with unknown ones.
PAIRS = [
    "p_partkey AS product_id_a",
    "CASE p_partkey % 4 WHEN 0 THEN p_partkey WHEN 1 THEN p_partkey + 60 WHEN 2 THEN p_partkey * 3 ELSE p_partkey + 240 END AS product_id_b",
]


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").selectExpr(*PAIRS)


COMPARE_SQL = [
    CATALOG_SQL, MAPPING_SQL,
    f"pairs AS MATERIALIZED (SELECT {', '.join(PAIRS)} FROM part)",
    "vec AS MATERIALIZED (SELECT vec_id AS product_id, embedding AS e FROM embeddings)",
    """sides AS MATERIALIZED (SELECT p.product_id_a AS pa, p.product_id_b AS pb, a, b, va.e AS ea, vb.e AS eb
      FROM pairs p LEFT JOIN mapping a ON a.product_id = p.product_id_a LEFT JOIN mapping b ON b.product_id = p.product_id_b
      LEFT JOIN vec va ON va.product_id = p.product_id_a LEFT JOIN vec vb ON vb.product_id = p.product_id_b)""",
]
_DOT = "list_sum(list_transform(list_zip({0}, {1}), lambda t: CAST(t[1] AS DOUBLE) * CAST(t[2] AS DOUBLE)))"
COSINE_SQL = f"{_DOT.format('ea', 'eb')} / (sqrt({_DOT.format('ea', 'ea')}) * sqrt({_DOT.format('eb', 'eb')}))"
DEPTH_SQL = "CASE WHEN a.c1 <> b.c1 THEN 0 WHEN a.c2 <> b.c2 THEN 1 WHEN a.c3 <> b.c3 THEN 2 ELSE 3 END"


@register(
    "compare",
    with_sql(*COMPARE_SQL)
    + f"""SELECT pa AS product_id_a, pb AS product_id_b,
      CAST(CASE WHEN b.product_id IS NULL THEN 0 ELSE {DEPTH_SQL} END AS INT) AS shared_prefix_depth,
      coalesce({DEPTH_SQL} = 3 AND b.product_id IS NOT NULL, false) AS same_code_tuple,
      coalesce({DEPTH_SQL} = 3 AND b.product_id IS NOT NULL AND a.dedup = b.dedup, false) AS same_code_id,
      CASE WHEN b.product_id IS NOT NULL AND ea IS NOT NULL AND eb IS NOT NULL THEN round({COSINE_SQL}, 6) END AS cosine_similarity,
      CASE WHEN b.product_id IS NOT NULL AND (ea IS NULL OR eb IS NULL) THEN concat('No embedding in index for product_id(s): ',
        concat_ws(', ', CASE WHEN ea IS NULL THEN CAST(pa AS VARCHAR) END, CASE WHEN eb IS NULL THEN CAST(pb AS VARCHAR) END),
        ' (dropped as invalid, or index is stale).') END AS cosine_unavailable_reason,
      CASE WHEN b.product_id IS NOT NULL THEN a.league IS NOT DISTINCT FROM b.league END AS league_match,
      CASE WHEN b.product_id IS NOT NULL THEN a.brand IS NOT DISTINCT FROM b.brand END AS brand_match,
      CASE WHEN b.product_id IS NOT NULL THEN {flag_sql('a.is_hot_market')} IS NOT DISTINCT FROM {flag_sql('b.is_hot_market')} END AS is_hot_market_match,
      CASE WHEN b.product_id IS NULL THEN concat('product_id(s) not found: ', pb) END AS error FROM sides""",
)
def compare(spark, sf):
    index = table(spark, sf, "embeddings").selectExpr("vec_id AS product_id", "embedding AS content_embedding")
    out = lk.compare(pairs(spark, sf), mapping(spark, sf), index)
    return rounded(
        out.select(
            "product_id_a", "product_id_b", "shared_prefix_depth", "same_code_tuple", "same_code_id",
            "cosine_similarity", "cosine_unavailable_reason", "league_match", "brand_match", "is_hot_market_match", "error",
        ),
        6,
    )


@register(
    "metadata_agreement",
    with_sql(*COMPARE_SQL)
    + "SELECT product_id_a, product_id_b, field, value_a, value_b, match FROM ("
    + " UNION ALL ".join(
        f"""SELECT pa AS product_id_a, pb AS product_id_b, '{f}' AS field, a.{f} AS value_a, b.{f} AS value_b,
        {flag_sql('a.' + f) if f == 'is_hot_market' else 'a.' + f} IS NOT DISTINCT FROM
        {flag_sql('b.' + f) if f == 'is_hot_market' else 'b.' + f} AS match FROM sides WHERE b.product_id IS NOT NULL"""
        for f in ("league", "team", "brand", "color", "price_band", "is_hot_market")
    )
    + ")",
)
def metadata_agreement(spark, sf):
    return lk.agreement_long(lk.compare(pairs(spark, sf), mapping(spark, sf)))


@register(
    "csv_export",
    with_sql(CATALOG_SQL, MAPPING_SQL)
    + """SELECT CAST(product_id AS VARCHAR) AS product_id, CAST(c1 AS VARCHAR) AS c1, CAST(c2 AS VARCHAR) AS c2, CAST(c3 AS VARCHAR) AS c3,
      CAST(dedup AS VARCHAR) AS dedup, product_name FROM mapping""",
)
def csv_export(spark, sf):
    path = new_table_path(spark, "csv")
    write_csv(mapping(spark, sf).select(PRODUCT_ID, *LEVELS, "dedup", "product_name"), path)
    return spark.read.option("header", True).csv(path)


# Lines 1 to 4 of an order are published; then all lines arrive, the published ones again.
@register(
    "append_slots",
    with_sql(
        LINES_SQL,
        f"done AS MATERIALIZED (SELECT product_id, c1, c2, {SLOT.replace(', c3', '')} AS dedup FROM big WHERE c3 <= 4)",
        "heads AS (SELECT c1, c2, max(dedup) + 1 AS first_free FROM done GROUP BY c1, c2)",
    )
    + f"""SELECT b.product_id, b.c1, b.c2, CAST(b.dedup + coalesce(h.first_free, 0) AS INT) AS dedup
      FROM (SELECT product_id, c1, c2, {SLOT.replace(', c3', '')} AS dedup FROM big WHERE c3 > 4) b
      LEFT JOIN heads h USING (c1, c2)""",
)
def appended(spark, sf):
    codes = lines(spark, sf)
    published = add_dedup_index(codes.where("c3 <= 4").select(PRODUCT_ID, "c1", "c2"), ["c1", "c2"])
    return append_slots(codes.select(PRODUCT_ID, "c1", "c2"), published, ["c1", "c2"])


@register(
    "bucketed_slots",
    with_sql(
        LINES_SQL,
        f"first AS (SELECT product_id, c1, c2, CAST({SLOT.replace(', c3', '')} AS INT) AS dedup FROM big WHERE c3 <= 2)",
        f"second AS (SELECT product_id, c1, c2, {SLOT.replace(', c3', '')} + coalesce((SELECT count(*) FROM first f WHERE f.c1 = b.c1 AND f.c2 = b.c2), 0) AS dedup "
        "FROM big b WHERE c3 IN (3, 4))",
        f"third AS (SELECT product_id, c1, c2, {SLOT.replace(', c3', '')} + coalesce((SELECT count(*) FROM big f WHERE f.c3 <= 4 AND f.c1 = b.c1 AND f.c2 = b.c2), 0) AS dedup "
        "FROM big b WHERE c3 > 4)",
    )
    + """SELECT product_id, c1, c2, CAST(dedup AS INT) AS dedup
      FROM (SELECT * FROM first UNION ALL SELECT * FROM second UNION ALL SELECT * FROM third)""",
)
def bucketed_slots(spark, sf):
    """Three batches into a table of hash buckets, the last one with everything once more, merged after each second batch."""
    codes = lines(spark, sf).select(PRODUCT_ID, "c1", "c2", "c3")
    slots = SlotTable(spark, new_table_path(spark, "slot-table"), ["c1", "c2"], buckets=16, fan=2)
    for number, part in enumerate([codes.where("c3 <= 2"), codes.where("c3 in (3, 4)"), codes]):
        slots.append(part, number)
    return slots.read()


# ---- sweep and versions -----------------------------------------------------------------

GRID_SQL = "grid AS (SELECT * FROM (VALUES (256), (512), (1024)) AS w(W), (VALUES (3), (4)) AS l(L))"


@register(
    "capacity",
    with_sql(GRID_SQL, "items AS (SELECT count(*) AS n FROM lineitem)")
    + """SELECT W AS "W", L AS "L", power(CAST(W AS DOUBLE), L) AS cells, round(power(CAST(W AS DOUBLE), L) / n, 6) AS headroom,
      round(n / CAST(W AS DOUBLE), 8) AS items_per_code FROM grid, items""",
)
def capacity(spark, sf):
    out = sw.capacity(sw.grid_frame(spark), table(spark, sf, "lineitem"))
    return out.withColumns({"headroom": F.round("headroom", 6), "items_per_code": F.round("items_per_code", 8)})


@register(
    "capacity_bounds",
    with_sql(
        LINES_SQL, GRID_SQL,
        "items AS (SELECT sum(n) AS n, max(n) AS big FROM (SELECT count(*) AS n FROM big GROUP BY league, team))",
    )
    + """SELECT W AS "W", L AS "L", CAST(n AS BIGINT) AS n_items, big AS largest_bucket, power(CAST(W AS DOUBLE), L) AS cells,
      round(n / CAST(W AS DOUBLE), 8) AS items_per_code, power(CAST(W AS DOUBLE), L) >= 10 * big AND power(CAST(W AS DOUBLE), L) >= n AS floor_ok,
      n / CAST(W AS DOUBLE) BETWEEN 1000 AND 10000 AS ceiling_ok FROM grid, items""",
)
def capacity_bounds(spark, sf):
    out = sw.capacity_bounds(sw.grid_frame(spark), base(lines(spark, sf)))
    return out.withColumn("items_per_code", F.round("items_per_code", 8))


def verdict_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The verdict of two widths on the same codes, over all levels; the wider one leaves half its codes dead."""
    counts = base(lines(spark, sf))
    crowding = ql.collision_verdict(ql.collision(counts, LEVELS), ql.collision_hot(counts, LEVELS, TOP_K))
    rows = None
    for width in SWEEP_WIDTHS:
        row = sw.run_verdict(ql.utilization_hot(counts, LEVELS, width, TOP_K), crowding)
        row = row.withColumns({"W": F.lit(width), "L": F.lit(3), "d": F.lit(32)})
        rows = row if rows is None else rows.unionByName(row)
    return rows


SWEEP_WIDTHS = (LINES_WIDTH, 2 * LINES_WIDTH)
SWEEP_SQL = with_sql(
    LINES_SQL, hot_sql("big"), hot_rows_sql("big"), usage_sql("hot_rows", "league, team,"),
    *[records_sql(w, "league, team,", f"records_{w}") for w in SWEEP_WIDTHS],
    f"crowding AS MATERIALIZED ({verdict_sql('big')})",
    "verdicts AS ("
    + " UNION ALL ".join(
        f"""SELECT {w} AS "W", 3 AS "L", 32 AS d, count(*) FILTER (passes) AS passing_records, count(*) AS records,
        bool_and(passes) AS hot_utilization_passes, (SELECT passes FROM crowding) AS collision_passes
        FROM (SELECT {record_columns(w)} FROM records_{w})"""
        for w in SWEEP_WIDTHS
    )
    + ")",
)


@register("sweep_verdicts", SWEEP_SQL + "SELECT * FROM verdicts")
def sweep_verdicts(spark, sf):
    return verdict_rows(spark, sf)


@register(
    "select_config",
    SWEEP_SQL
    + """SELECT * FROM verdicts WHERE hot_utilization_passes AND collision_passes ORDER BY "W", "L", d LIMIT 1""",
)
def select_config(spark, sf):
    return sw.select_config(verdict_rows(spark, sf))


# A second set of codes for the same rows: other widths, some products gone, some new.
OTHER_CODES = [
    "product_id", "league", "team", "c1",
    "CAST(CASE WHEN product_id % 9 = 0 THEN (c2 + 1) % 12 ELSE c2 END AS INT) AS c2",
    "CAST(CASE WHEN product_id % 4 = 0 THEN 0 ELSE c3 END AS INT) AS c3",
]
OTHER_SQL = f"other AS MATERIALIZED (SELECT {', '.join(OTHER_CODES)} FROM cat)"


def other_codes(spark: SparkSession, sf: str) -> DataFrame:
    return catalog(spark, sf).selectExpr(*OTHER_CODES)


@register(
    "compare_runs",
    with_sql(
        CATALOG_SQL, OTHER_SQL, usage_sql("cat"), records_sql(CATALOG_WIDTH),
        usage_sql("other").replace("usage AS", "usage_b AS"),
        records_sql(CATALOG_WIDTH, "", "records_b").replace("FROM usage)", "FROM usage_b)"),
    )
    + " UNION ALL ".join(
        f"""SELECT a.level, '{m}' AS metric, round(CAST(a.{m} AS DOUBLE), 8) AS value_a, round(CAST(b.{m} AS DOUBLE), 8) AS value_b
        FROM records a JOIN records_b b USING (level)"""
        for m in ("dead_code_rate", "entropy", "max_code_share", "scope_size")
    ),
)
def compare_runs(spark, sf):
    first = ql.utilization(base(catalog(spark, sf)), LEVELS, CATALOG_WIDTH)
    second = ql.utilization(base(other_codes(spark, sf)), LEVELS, CATALOG_WIDTH)
    metrics = ["dead_code_rate", "entropy", "max_code_share", "scope_size"]
    return rounded(sw.compare_runs(first, second, ["level"], metrics).drop("difference"))


OLD_NEW_SQL = [
    CATALOG_SQL, MAPPING_SQL, OTHER_SQL,
    "old_ids AS MATERIALIZED (SELECT product_id, c1, c2, c3, dedup FROM mapping WHERE league IS DISTINCT FROM 'PROMO')",
    f"new_ids AS MATERIALIZED (SELECT product_id, c1, c2, c3, {SLOT} AS dedup FROM other WHERE league IS DISTINCT FROM 'SMALL')",
]


def old_and_new(spark: SparkSession, sf: str) -> DataFrame:
    old = mapping(spark, sf).where("NOT (league <=> 'PROMO')")
    new = add_dedup_index(other_codes(spark, sf).where("NOT (league <=> 'SMALL')"), LEVELS)
    return sw.dual_write(old, new, LEVELS)


@register(
    "dual_write",
    with_sql(*OLD_NEW_SQL)
    + """SELECT coalesce(o.product_id, n.product_id) AS product_id, o.product_id IS NOT NULL AS in_old, n.product_id IS NOT NULL AS in_new,
      o.c1 AS old_c1, o.c2 AS old_c2, o.c3 AS old_c3, o.dedup AS old_dedup, n.c1 AS new_c1, n.c2 AS new_c2, n.c3 AS new_c3, n.dedup AS new_dedup
      FROM old_ids o FULL JOIN new_ids n ON o.product_id = n.product_id""",
)
def dual_write(spark, sf):
    return old_and_new(spark, sf)


@register(
    "churn",
    with_sql(*OLD_NEW_SQL, "both_ids AS MATERIALIZED (SELECT o.product_id AS po, n.product_id AS pn, o.c1 <> n.c1 AS x1, o.c2 <> n.c2 AS x2, o.c3 <> n.c3 AS x3, o.dedup <> n.dedup AS x4 FROM old_ids o FULL JOIN new_ids n ON o.product_id = n.product_id)")
    + " UNION ALL ".join(
        f"""SELECT {i} AS prefix_length, count(*) FILTER (po IS NOT NULL AND pn IS NOT NULL) AS common,
        count(*) FILTER (po IS NULL) AS added, count(*) FILTER (pn IS NULL) AS removed, count(*) FILTER ({c}) AS changed,
        round(count(*) FILTER ({c}) / CAST(count(*) FILTER (po IS NOT NULL AND pn IS NOT NULL) AS DOUBLE), 8) AS changed_share FROM both_ids"""
        for i, c in enumerate(["x1", "x1 OR x2", "x1 OR x2 OR x3", "x1 OR x2 OR x3 OR x4"], start=1)
    ),
)
def churn(spark, sf):
    return rounded(sw.churn(old_and_new(spark, sf), LEVELS))
