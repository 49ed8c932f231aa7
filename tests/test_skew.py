"""One key, query or batch that holds a large part of the rows."""

from pyspark.sql import functions as F

from codeloom.operators.quantize import add_dedup_index
from codeloom.operators.ranking import hot_groups, ranked
from codeloom.operators import sampling
from codeloom.operators.sampling import thin
from codeloom.plans import lookup as L
from codeloom.streaming.ingest import append_slots

LEVELS = ["c1", "c2"]


def skewed(spark, rows=6000):
    hot = F.col("id") % 3 == 0
    return spark.range(rows).select(
        F.col("id").alias("product_id"),
        F.when(hot, 7).otherwise((F.col("id") % 50).cast("int")).alias("c1"),
        F.when(hot, 7).otherwise((F.col("id") % 41).cast("int")).alias("c2"),
    )


def test_hot_groups_are_found_and_counted(spark):
    found, limit = hot_groups(skewed(spark), LEVELS, hot_rows=1000)
    assert limit == 1000 and [(r.c1, r.c2, r.total) for r in found] == [(7, 7, 2000 + 2)]
    assert hot_groups(skewed(spark), LEVELS)[0] == []


def test_prefix_query_on_the_hot_tuple(spark):
    mapping = add_dedup_index(skewed(spark), LEVELS, hot_rows=1000)
    queries = spark.createDataFrame([(1, "7-7"), (2, "7"), (3, "7-7-5")], "query_id int, query string")
    for large in (False, True):
        kept = L.REQUEST_ROWS
        L.REQUEST_ROWS = 0 if large else kept
        try:
            summary, rows = L.by_prefix(queries, mapping, 30)
            totals = {r.query_id: (r.total_count, r.truncated) for r in summary.collect()}
            got = [r.product_id for r in rows.where("query_id = 1").orderBy("rank").collect()]
            sizes = {r.bucket_size for r in L.lookup(mapping.where("c1 = 7 AND c2 = 7"), mapping).collect()}
        finally:
            L.REQUEST_ROWS = kept
        ids = sorted(r.product_id for r in mapping.where("c1 = 7 AND c2 = 7").collect())
        assert totals[1] == (len(ids), True) and totals[3] == (1, False)
        assert got == ids[:30] and sizes == {len(ids)}


def test_a_batch_that_lands_in_one_bucket(spark):
    published = add_dedup_index(skewed(spark, 3000), LEVELS)
    new = skewed(spark).where("product_id >= 2900")
    got = append_slots(new, published, LEVELS)
    assert got.count() == 3000
    together = published.select(got.columns).union(got)
    expected = add_dedup_index(skewed(spark), LEVELS).select(got.columns)
    assert together.exceptAll(expected).isEmpty()


def test_thin_keeps_about_the_fraction_and_is_repeatable(spark):
    df = spark.range(20000).withColumnRenamed("id", "product_id")
    first = thin(df, 0.25, 1, "x")
    assert 4700 < first.count() < 5300
    assert first.exceptAll(thin(df.repartition(9), 0.25, 1, "x")).isEmpty()


def test_hot_groups_are_cut_on_any_sort_key(spark):
    """A constant first column, texts with nulls and a date; a key that many rows share is not cut apart."""
    text = F.when(F.col("id") % 97 == 0, None).otherwise(F.concat(F.lit("x"), F.md5(F.col("id").cast("string"))))
    rows = spark.range(9000).select(
        "id", F.when(F.col("id") % 3 == 0, None).otherwise((F.col("id") % 50).cast("int")).alias("g"), F.lit("same").alias("first"),
        text.alias("name"), F.date_add(F.lit("2024-01-01"), (F.col("id") % 700).cast("int")).alias("day"),
    )
    order = ["first", "name", "day", "id"]
    plain = ranked(rows, ["g"], order, size="n")
    cut = ranked(rows, ["g"], order, size="n", hot_rows=100)
    assert cut.schema == plain.schema and cut.count() == 9000
    assert plain.exceptAll(cut).isEmpty() and cut.exceptAll(plain).isEmpty()


def test_chunks_of_a_hot_group_are_even(spark):
    from codeloom.operators import ranking

    rows = spark.range(40000).select(F.lit(1).alias("g"), F.lit(0).alias("first"), F.md5(F.col("id").cast("string")).alias("name"))
    hot, limit = hot_groups(rows, ["g"], hot_rows=2000)
    cuts = ranking._cut_points(rows, ["g"], ["first", "name"], hot, limit)
    chunks = rows.join(cuts, "g").select(ranking._chunk(F.struct("first", "name")).alias("c")).groupBy("c").count().collect()
    assert 18 <= len(chunks) <= 23 and max(r["count"] for r in chunks) < 2 * limit


def test_a_sort_key_that_a_third_of_the_rows_share(spark):
    rows = spark.range(6000).select(
        F.lit(1).alias("g"), F.when(F.col("id") % 3 == 0, "tie").otherwise(F.md5(F.col("id").cast("string"))).alias("name")
    )
    got = ranked(rows, ["g"], ["name"], hot_rows=500)
    ranks = sorted(r["rank"] for r in got.collect())
    assert ranks == list(range(1, 6001))
    ties = sorted(r["rank"] for r in got.where("name = 'tie'").collect())
    assert ties == list(range(4001, 6001))


def test_split_with_few_and_with_many_strata(spark, monkeypatch):
    rows = skewed(spark, 3000).withColumn("wide", F.sequence(F.lit(1), F.lit(20)))
    few = sampling.with_split(rows, 0.2, 5, ["c1"])
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    monkeypatch.setattr(sampling, "BROADCAST_STRATA", 0)
    many = sampling.with_split(rows, 0.2, 5, ["c1"])
    assert few.exceptAll(many).isEmpty() and many.count() == 3000
    assert few.where("is_val AND c1 = 7").count() == round(few.where("c1 = 7").count() * 0.2)


def joined_columns(df):
    """Names of the columns that come out of any join of the plan."""
    names, todo = set(), [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        todo += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Join":
            names |= {node.output().apply(i).name() for i in range(node.output().size())}
    return names


def test_a_row_does_not_carry_all_bounds_of_its_group(spark):
    """Three groups, one of them null, with some 100 bounds each; a row of one bound's key counts those below it."""
    from codeloom.operators import ranking

    rows = spark.range(12000).select(
        "id", F.when(F.col("id") % 4 > 1, None).otherwise(F.col("id") % 4).alias("g"), F.lit("a").alias("first"),
        F.when(F.col("id") % 50 == 0, None).otherwise(F.md5(F.col("id").cast("string"))).alias("name"),
    )
    order = ["first", "name", "id"]
    hot, limit = hot_groups(rows, ["g"], hot_rows=40)
    cuts = ranking._cut_points(rows, ["g"], order, hot, limit)
    got = {r["id"]: (r["g"], r["chunk_"]) for r in ranking._with_chunk(rows, cuts, ["g"], order).collect()}
    bounds = {r["g"]: [tuple(c) for c in r["cuts_"]] for r in cuts.collect()}
    assert len(got) == 12000 and min(map(len, bounds.values())) > 50
    nulls_first = lambda key: [(v is not None, v) for v in key]
    for r in rows.where("id % 7 = 0").collect():
        below = sum(nulls_first(c) < nulls_first([r[k] for k in order]) for c in bounds[r["g"]])
        assert got[r["id"]] == (r["g"], below)
    placed = ranked(rows, ["g"], order, size="n", hot_rows=40)
    assert {"cuts_", "blocks_"}.isdisjoint(joined_columns(placed))
    plain = ranked(rows, ["g"], order, size="n")
    assert placed.schema == plain.schema and plain.exceptAll(placed).isEmpty() and placed.exceptAll(plain).isEmpty()
