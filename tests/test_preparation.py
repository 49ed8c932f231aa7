import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from codeloom.functions.scalars import parse_flag
from codeloom.operators.prepare import drop_invalid_embeddings, l2_normalize, prepare, reject_counts
from codeloom.operators.ranking import first_in_group, ranked
from codeloom.operators.sampling import (
    add_sample_weight,
    flag_hot_bucket_membership,
    resample_copies,
    stratified_train_val_split,
    top_k_hot_buckets,
    uniform_sample,
    with_split,
)
from codeloom.sources.catalog import read_catalog, read_taxonomy

VECTORS = "product_id long, content_embedding array<double>"


def test_read_catalog_projects_five_columns(spark, tmp_path):
    rows = [
        (i, [float(i), 1.0, 1.0, 1.0], "A" if i < 10 else "B", f"team_{i % 4}", "true" if i % 5 == 0 else "false", "x", "y")
        for i in range(20)
    ]
    schema = VECTORS + ", league string, team string, is_hot_market string, brand string, product_name string"
    path = str(tmp_path / "catalog")
    spark.createDataFrame(rows, schema).write.parquet(path)
    catalog = read_catalog(spark, path)
    assert catalog.columns == ["product_id", "content_embedding", "league", "team", "is_hot_market"]
    assert catalog.count() == 20
    assert "content_embedding" not in read_taxonomy(spark, path).columns
    with pytest.raises(ValueError):
        read_catalog(spark, path, {"league": "no_such_column"})


def bad_rows(spark):
    return spark.createDataFrame(
        [
            (0, [1.0, 1.0, 1.0, 1.0]), (1, None), (2, [1.0, 2.0]), (3, [1.0, 1.0, 1.0, 1.0]),
            (4, [1.0, None, 1.0, 1.0]), (5, [1.0, float("nan"), 1.0, 1.0]), (6, [1.0, float("-inf"), 1.0, 1.0]),
        ],
        VECTORS,
    )


def test_invalid_vectors_are_dropped_and_counted(spark):
    df = bad_rows(spark)
    assert {r.product_id for r in drop_invalid_embeddings(df, 4).collect()} == {0, 3}
    counts = reject_counts(df, 4).first().asDict()
    assert counts == {
        "raw_rows": 7, "valid_rows": 2, "null_vector": 1, "wrong_length": 1, "null_element": 1,
        "not_finite": 2, "dropped_invalid": 5,
    }
    assert {r.product_id for r in prepare(df, 4).collect()} == {0, 3}


@pytest.mark.parametrize("checked", [True, False])
def test_normalised_vectors_have_length_one_and_zero_stays_zero(spark, checked):
    df = spark.createDataFrame([(0, [3.0, 4.0]), (1, [0.0, 0.0])], VECTORS)
    rows = {r.product_id: r.content_embedding for r in l2_normalize(df, checked=checked).collect()}
    assert math.isclose(np.linalg.norm(rows[0]), 1.0, rel_tol=1e-6)
    assert rows[1] == [0.0, 0.0]


def test_normalise_leaves_unchecked_oddities_alone(spark):
    rows = {r.product_id: r.content_embedding for r in l2_normalize(bad_rows(spark)).collect()}
    assert rows[1] is None
    assert len(rows[2]) == 2 and rows[4][1] is None


def test_flags_parse_only_true_and_false(spark):
    texts = ["true", " FALSE\t", "\nTrue ", "yes", "1", "t", "", None, " true "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.f for r in df.select("i", parse_flag("t").alias("f")).orderBy("i").collect()]
    assert got == [True, False, True, None, None, None, None, None, True]


def test_split_is_exact_disjoint_and_complete(spark):
    df = spark.createDataFrame([(i, "A" if i < 100 else "B", "t1") for i in range(200)], "product_id long, league string, team string")
    train, val = stratified_train_val_split(df, 0.1, 42, ["league", "team"])
    assert {r.league: r["count"] for r in val.groupBy("league").count().collect()} == {"A": 10, "B": 10}
    assert train.intersect(val).isEmpty()
    assert train.union(val).exceptAll(df).isEmpty() and train.count() + val.count() == 200


def test_split_of_small_strata_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, "solo"), (2, "pair"), (3, "pair"), (4, None), (5, None)], "product_id long, league string"
    )
    val = with_split(df, 0.1, 42, ["league"]).where("is_val")
    assert sorted((r.league or "-") for r in val.collect()) == ["-", "pair"]


def test_split_does_not_depend_on_partitions_or_on_the_search_range(spark):
    df = spark.range(5000).select(
        F.col("id").alias("product_id"), F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 2).alias("league")
    )
    reference = {r.product_id for r in with_split(df, 0.2, 7, ["league"]).where("is_val").collect()}
    everything = (float("inf"),)
    too_narrow_at_first = (0.0, 0.01, float("inf"))
    for parts, reaches in ((1, (6.0, 60.0)), (16, everything), (4, too_narrow_at_first)):
        again = with_split(df.repartition(parts), 0.2, 7, ["league"], reaches=reaches).where("is_val")
        assert {r.product_id for r in again.collect()} == reference


@pytest.mark.parametrize("hot_rows", [2_000_000, 500, 11])
def test_rank_of_a_group_with_a_third_of_the_rows(spark, hot_rows):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") + 100).alias("k"),
        (F.col("id") * F.lit(2654435761) % F.lit(1 << 40)).alias("product_id"),
    )
    got = ranked(df, ["k"], ["product_id"], size="n", hot_rows=hot_rows).toPandas()
    expected = got.groupby("k").product_id.rank(method="first").astype("int64")
    assert (got["rank"] == expected).all()
    assert (got.n == got.groupby("k").product_id.transform("size")).all()
    assert len(got) == 9000


def test_first_in_group_equals_a_plain_sort(spark):
    df = spark.range(3000).select((F.col("id") % 2).alias("g"), (F.lit(3000) - F.col("id")).alias("product_id"))
    got = {(r.g, r.rank): r.product_id for r in first_in_group(df, ["g"], ["product_id"], 5).collect()}
    assert got == {(g, i + 1): (2 if g == 0 else 1) + 2 * i for g in (0, 1) for i in range(5)}


def buckets(spark):
    rows = [(i, "A" if i < 6 else "B", "t1" if i < 6 else "t2", "true" if i % 2 == 0 else "false") for i in range(10)]
    return spark.createDataFrame(rows, "product_id long, league string, team string, is_hot_market string")


def test_hot_buckets_and_membership(spark):
    df = buckets(spark)
    hot = top_k_hot_buckets(df, 1)
    assert [tuple(r) for r in hot.collect()] == [("A", "t1", 6)]
    for top_k in (1, None):
        flags = {(r.league, r.is_hot_bucket) for r in flag_hot_bucket_membership(df, hot, top_k).collect()}
        assert flags == {("A", True), ("B", False)}


def test_sample_weight_multiplies_both_factors(spark):
    weighted = add_sample_weight(buckets(spark), 1, 3.0, 2.0)
    got = {(r.league, r.is_hot_market): r.sample_weight for r in weighted.collect()}
    assert got == {("A", "true"): 6.0, ("A", "false"): 3.0, ("B", "true"): 2.0, ("B", "false"): 1.0}


def test_resampling_follows_the_weights(spark):
    df = spark.range(20000).select(
        F.col("id").alias("product_id"), F.when(F.col("id") % 4 == 0, 5.0).otherwise(1.0).alias("sample_weight")
    )
    total = 20000 / 4 * 5 + 20000 * 3 / 4
    drawn = resample_copies(df, 20000, total, 1, 0)
    means = {r.sample_weight: r.m for r in drawn.groupBy("sample_weight").agg(F.avg("copies").alias("m")).collect()}
    assert means[5.0] == pytest.approx(2.5, rel=0.05) and means[1.0] == pytest.approx(0.5, rel=0.05)
    assert drawn.exceptAll(resample_copies(df.repartition(7), 20000, total, 1, 0)).isEmpty()


@pytest.mark.parametrize("rate", [0.0, 0.3, 9.9, 10.0, 30.0, 745.0, 1e6, 1e12])
def test_draws_follow_the_distribution(spark, rate):
    """Mean and variance of a Poisson draw are its rate; the shape is compared where it is narrow."""
    n = 4000
    df = spark.range(n).selectExpr("id AS product_id", "1.0D AS sample_weight")
    copies = [r.copies for r in resample_copies(df, n * rate, n, 5, 1).collect()]
    mean = sum(copies) / n
    variance = sum((c - mean) ** 2 for c in copies) / (n - 1)
    assert abs(mean - rate) <= 5 * math.sqrt(rate / n) and abs(variance - rate) <= 0.15 * rate
    if 0 < rate <= 30:
        mass, low = math.exp(-rate), 0.0
        for k in range(60):
            assert abs(sum(c <= k for c in copies) / n - (low := low + mass)) < 0.035
            mass *= rate / (k + 1)


def test_uniform_sample_size(spark):
    df = spark.range(1000).withColumnRenamed("id", "product_id")
    assert uniform_sample(df, 100, 3).distinct().count() == 100
    assert uniform_sample(df, 5000, 3).count() == 1000


def test_uniform_sample_of_a_large_table_equals_the_sort(spark):
    from codeloom.functions.scalars import seeded_md5

    df = spark.range(1_200_000).withColumnRenamed("id", "product_id")
    got = {r.product_id for r in uniform_sample(df, 50, 3).collect()}
    plain = df.withColumn("h", seeded_md5("product_id", 3)).orderBy("h").limit(50)
    assert got == {r.product_id for r in plain.collect()}
