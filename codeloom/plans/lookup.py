"""The three lookup queries as joins of request tables with the mapping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeloom.functions.names import (
    COMPARE_FIELDS,
    DEDUP,
    EMBEDDING,
    HOT_MARKET,
    ID_STRING,
    PRODUCT_ID,
    check_mapping,
    metadata_columns,
)
from codeloom.functions.scalars import (
    cosine,
    id_string,
    parse_flag,
    shared_depth,
    split_tokens,
    strip,
    token_error,
    token_numbers,
)
from codeloom.operators.ranking import first_in_group, ranked
from codeloom.sources.prefixes import PrefixLayout

# Request tables up to this many rows are sent to every task; they are counted first.
REQUEST_ROWS = 100_000


def sized(requests: DataFrame) -> bool:
    """True if a request table is small. Without this a join planned from the size of the mapping
    would shuffle the mapping."""
    return requests.limit(REQUEST_ROWS + 1).count() <= REQUEST_ROWS


def hinted(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def requested_id(df: DataFrame, column: str) -> Column:
    """A request key as LONG; text that is not a whole number asks for nothing."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return F.regexp_replace(strip(column), r"(?<=\d)_(?=\d)", "").try_cast("bigint")
    return F.col(column).try_cast("bigint")


def bucket_sizes(mapping: DataFrame, tuples: DataFrame, levels: list[str], small: bool = False) -> DataFrame:
    """Rows of the mapping in each of the asked code tuples."""
    asked = tuples.select(*levels).distinct()
    inside = mapping.select(*levels).join(hinted(asked, small), levels, "left_semi")
    return inside.groupBy(*levels).agg(F.count(F.lit(1)).alias("bucket_size"))


def lookup(ids: DataFrame, mapping: DataFrame, id_column: str = PRODUCT_ID) -> DataFrame:
    """Codes, slot, id string, bucket size and metadata of the asked ids; unknown ids give no row.

    Requests are made distinct first, so a repeated id is fetched once.
    """
    levels = check_mapping(mapping.columns)
    asked = (
        ids.select(requested_id(ids, id_column).alias(PRODUCT_ID))
        .where(F.col(PRODUCT_ID).isNotNull())
        .distinct()
    )
    small = sized(asked)
    meta = metadata_columns(mapping.columns)
    found = mapping.select(PRODUCT_ID, *levels, DEDUP, *meta).join(hinted(asked, small), PRODUCT_ID, "left_semi")
    counts = bucket_sizes(mapping, found, levels, small)
    return found.join(hinted(counts, small), levels, "left").select(PRODUCT_ID, id_string(levels).alias(ID_STRING), *levels, DEDUP, "bucket_size", *meta)


def parse_queries(queries: DataFrame, num_levels: int, column: str = "query") -> DataFrame:
    """Add tokens, an error text (NULL if usable) and a key that equal queries share."""
    split = queries.withColumn("pieces_", split_tokens(column))
    checked = split.withColumn("error", token_error(F.col("pieces_"), num_levels))
    tokens = F.when(F.col("error").isNull(), token_numbers(F.col("pieces_")))
    return (
        checked.withColumn("tokens", tokens)
        .withColumn("token_key", F.array_join(F.col("tokens").cast("array<string>"), "-"))
        .drop("pieces_")
    )


def prefix_matches(
    mapping: DataFrame, asked: DataFrame, levels: list[str], counts: list[int], keep: list[str], small: bool = False,
    layout: PrefixLayout | None = None,
) -> DataFrame:
    """token_key and the columns `keep` of every match, for queries with the token counts `counts`.

    One scan: a row is compared by its prefixes of all asked lengths. With a layout the prefixes are parts of the packed
    key, and a small table of requests also limits the scan to the ranges it asks for.
    """
    columns = [*levels, DEDUP]
    counts = counts or [1]
    if layout is None:
        codes = F.array(*[F.col(c).cast("long") for c in columns])
        parts = {k: F.slice(codes, 1, k) for k in counts}
        wanted = F.col("tokens")
    else:
        parts = {k: layout.prefix(k) for k in counts}
        wanted = F.coalesce(*[F.when(F.size("tokens") == k, layout.value("tokens", k)) for k in counts])
    short = asked.select("token_key", F.size("tokens").alias("count_"), wanted.alias("part_")).where("part_ is not null")
    if layout is not None and small:
        ends = [F.when(F.col("count_") == k, F.shiftleft(F.col("part_") + more, layout.below(k)) - more) for more in (0, 1) for k in counts]
        low, high = F.coalesce(*ends[: len(counts)]), F.coalesce(*ends[len(counts) :])
        mapping = mapping.where(layout.inside([tuple(r) for r in short.select(low, high).distinct().collect()]))
    prefixes = F.explode(F.array(*[F.struct(F.lit(k).alias("count_"), part.alias("part_")) for k, part in parts.items()]))
    rows = mapping.select(*keep, prefixes.alias("prefix_")).select(*keep, "prefix_.count_", "prefix_.part_")
    return rows.join(hinted(short, small), ["count_", "part_"]).select("token_key", *keep)


def by_prefix(
    queries: DataFrame, mapping: DataFrame, limit: int = 1000, query_id: str = "query_id", column: str = "query",
    layout: PrefixLayout | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Products under a code prefix, for a table of queries.

    Returns (summary, rows). Summary: one row per query with total, truncated flag, matched levels and
    error. Rows: the first `limit` products of each query by id, with metadata. The totals count all
    matches. Equal queries are answered once; each of the two reads the mapping once. `layout` belongs to a mapping
    that `sources.prefixes` has stored sorted.
    """
    levels = check_mapping(mapping.columns)
    parsed = parse_queries(queries, len(levels), column)
    asked = parsed.where(F.col("error").isNull()).select("token_key", "tokens").distinct()
    # At most L + 1 rows: how many different queries there are of each token count.
    found = {row["k"]: row["count"] for row in asked.groupBy(F.size("tokens").alias("k")).count().collect()}
    meta = metadata_columns(mapping.columns)
    matches = prefix_matches(mapping, asked, levels, sorted(found), [PRODUCT_ID, *meta], sum(found.values()) <= REQUEST_ROWS, layout)
    totals = matches.groupBy("token_key").agg(F.count(F.lit(1)).alias("matched"))
    size = F.size("tokens")
    total = F.coalesce("matched", F.lit(0)).cast("long")
    usable = parsed.where(F.col("error").isNull()).join(totals, "token_key", "left").select(
        query_id, column, F.least(size, F.lit(len(levels))).alias("matched_levels"), (size == len(levels) + 1).alias("is_exact"),
        total.alias("total_count"), (total > limit).alias("truncated"), "error",
    )
    # Not in the join: they have no key, so they would all meet in one task.
    unusable = parsed.where(F.col("error").isNotNull()).select(
        query_id, column, F.lit(0).alias("matched_levels"), F.lit(False).alias("is_exact"),
        F.lit(0).cast("long").alias("total_count"), F.lit(False).alias("truncated"), "error",
    )
    first = first_in_group(matches, ["token_key"], [PRODUCT_ID], limit)
    rows = parsed.where(F.col("error").isNull()).select(query_id, "token_key").join(first, "token_key").select(
        query_id, F.col("rank").cast("int").alias("rank"), PRODUCT_ID, *meta
    )
    return usable.unionByName(unusable), rows


def tuple_mates(ids: DataFrame, mapping: DataFrame, limit: int | None = None, id_column: str = PRODUCT_ID) -> DataFrame:
    """The products that share the full code tuple of each asked product, by id, with metadata.

    All of them, or the first `limit`; `total_count` always counts all, `truncated` tells if some are missing.
    """
    levels = check_mapping(mapping.columns)
    asked = ids.select(requested_id(ids, id_column).alias(PRODUCT_ID)).distinct()
    own = mapping.join(asked, PRODUCT_ID, "left_semi").select(F.col(PRODUCT_ID).alias("query_id"), *levels)
    tuples = own.select(*levels).distinct()
    members = mapping.join(tuples, levels, "left_semi")
    totals = members.groupBy(*levels).agg(F.count(F.lit(1)).alias("total_count"))
    if limit is None:
        first = ranked(members, levels, [PRODUCT_ID])
    else:
        first = first_in_group(members, levels, [PRODUCT_ID], limit)
    meta = metadata_columns(mapping.columns)
    rows = own.join(first, levels).join(totals, levels)
    return rows.select(
        "query_id", F.col("rank").cast("int").alias("rank"), PRODUCT_ID, *meta, "total_count",
        (F.lit(False) if limit is None else F.col("total_count") > limit).alias("truncated"),
    )


def _listed(missing_a: Column, missing_b: Column, a: Column, b: Column) -> Column:
    return F.concat_ws(", ", F.when(missing_a, a.cast("string")), F.when(missing_b, b.cast("string")))


def compare(
    pairs: DataFrame, mapping: DataFrame, vectors: DataFrame | None = None, a: str = "product_id_a", b: str = "product_id_b"
) -> DataFrame:
    """Ids, shared prefix depth, cosine and metadata agreement for pairs of products.

    Each distinct id is looked up once; the pairs are then joined to the two sides. `vectors` is the
    index table; without it the cosine is NULL with a reason.
    """
    levels = check_mapping(mapping.columns)
    typed = pairs.withColumns({"key_a": requested_id(pairs, a), "key_b": requested_id(pairs, b)})
    ids = typed.select(F.col("key_a").alias(PRODUCT_ID)).union(typed.select("key_b")).distinct()
    found = lookup(ids, mapping)
    fields = [f for f in COMPARE_FIELDS if f in found.columns]
    wanted = [PRODUCT_ID, ID_STRING, *levels, "bucket_size", *fields]
    has_index = vectors is not None
    if has_index:
        small = sized(ids)
        narrow = vectors.select(PRODUCT_ID, EMBEDDING).join(hinted(ids, small), PRODUCT_ID, "left_semi")
        found = found.join(narrow, PRODUCT_ID, "left")
        wanted.append(EMBEDDING)

    def side(tag: str) -> DataFrame:
        return found.select(*[F.col(c).alias(f"{c}__{tag}") for c in wanted])

    joined = typed.join(side("a"), F.col("key_a") == F.col(f"{PRODUCT_ID}__a"), "left").join(
        side("b"), F.col("key_b") == F.col(f"{PRODUCT_ID}__b"), "left"
    )
    lost_a, lost_b = F.col(f"{PRODUCT_ID}__a").isNull(), F.col(f"{PRODUCT_ID}__b").isNull()
    both = ~lost_a & ~lost_b
    # The texts of the error and of the reasons.
    error = F.when(~both, F.concat(F.lit("product_id(s) not found: "), _listed(lost_a, lost_b, F.col(a), F.col(b))))
    depth = F.when(
        both, shared_depth([F.col(f"{c}__a") for c in levels], [F.col(f"{c}__b") for c in levels])
    ).otherwise(0)
    if has_index:
        no_a, no_b = F.col(f"{EMBEDDING}__a").isNull(), F.col(f"{EMBEDDING}__b").isNull()
        similarity = F.when(both, cosine(f"{EMBEDDING}__a", f"{EMBEDDING}__b"))
        reason = F.when(
            both & (no_a | no_b),
            F.concat(
                F.lit("No embedding in index for product_id(s): "),
                _listed(no_a, no_b, F.col("key_a"), F.col("key_b")),
                F.lit(" (dropped as invalid, or index is stale)."),
            ),
        )
    else:
        similarity = F.lit(None).cast("double")
        reason = F.when(both, F.lit("Embedding index not built."))
    agreement = []
    for field in COMPARE_FIELDS:
        if field not in fields:
            agreement.append(F.when(both, True).alias(f"{field}_match"))
            continue
        x, y = F.col(f"{field}__a"), F.col(f"{field}__b")
        if field == HOT_MARKET:
            x, y = parse_flag(x), parse_flag(y)
        agreement.append(F.when(both, x.eqNullSafe(y)).alias(f"{field}_match"))
    return joined.select(
        a, b,
        F.col(f"{ID_STRING}__a").alias("code_id_a"), F.col(f"{ID_STRING}__b").alias("code_id_b"),
        F.col("bucket_size__a").alias("bucket_size_a"), F.col("bucket_size__b").alias("bucket_size_b"),
        depth.cast("int").alias("shared_prefix_depth"),
        (both & (depth == len(levels))).alias("same_code_tuple"),
        (both & F.col(f"{ID_STRING}__a").eqNullSafe(F.col(f"{ID_STRING}__b"))).alias("same_code_id"),
        similarity.alias("cosine_similarity"), reason.alias("cosine_unavailable_reason"),
        *agreement,
        *[F.col(f"{f}__{t}").alias(f"{f}_{t}") for f in fields for t in ("a", "b")],
        error.alias("error"),
    )


def agreement_long(compared: DataFrame, a: str = "product_id_a", b: str = "product_id_b") -> DataFrame:
    """Metadata agreement with one row per (pair, field)."""
    cells = []
    for field in COMPARE_FIELDS:
        known = f"{field}_a" in compared.columns
        value = (lambda t: F.col(f"{field}_{t}").cast("string")) if known else (lambda t: F.lit(None).cast("string"))
        cells.append(
            F.struct(
                F.lit(field).alias("field"), value("a").alias("value_a"), value("b").alias("value_b"),
                F.col(f"{field}_match").alias("match"),
            )
        )
    return compared.where(F.col("error").isNull()).select(a, b, F.inline(F.array(*cells)))
