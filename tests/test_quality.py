import math

import pytest
from pyspark.sql import functions as F

from codeloom.functions.names import discover_levels, level_columns, output_columns
from codeloom.operators.quantize import add_dedup_index, max_dedup
from codeloom.plans import quality as Q

LEVELS = ["c1", "c2", "c3"]
CODED = "product_id long, c1 int, c2 int, c3 int, league string, team string"


def usage(spark, counts):
    rows = [("c1", i, n) for i, n in enumerate(counts) if n]
    return spark.createDataFrame(rows, "level string, code int, used long")


def record(spark, counts, width):
    found = Q.utilization_from_usage(usage(spark, counts), width)
    names = spark.createDataFrame([("c1",)], "level string")
    return Q._finish_utilization(names.join(found, "level", "left"), [], width).first()


def test_uniform_usage(spark):
    r = record(spark, [10, 10, 10, 10], 4)
    assert (r.scope_size, r.dead_code_rate, r.max_code_share) == (40, 0.0, 0.25)
    assert r.entropy == pytest.approx(math.log(4)) and r.ppl == pytest.approx(4) and r.normalized_utilization == pytest.approx(1)
    assert r.scope_qualifies and r.passes


def test_collapsed_usage(spark):
    r = record(spark, [100, 0, 0, 0], 4)
    assert r.dead_code_rate == 0.75 and r.entropy == pytest.approx(0, abs=1e-12) and r.ppl == pytest.approx(1)
    assert not r.passes


def test_small_scope(spark):
    r = record(spark, [1] * 100 + [0] * 412, 512)
    assert not r.scope_qualifies and r.dead_code_rate > 0.10 and not r.passes


def test_empty_scope_is_a_fixed_record(spark):
    r = record(spark, [], 8)
    assert tuple(r)[1:] == (0, 8, 1.0, 0.0, 1.0, 0.0, 0.0, False, False)


def rows_of(spark, sizes, league="A", team="t"):
    out, pid = [], 0
    for code, size in enumerate(sizes):
        for _ in range(size):
            out.append((pid, code, 0, 0, league, team))
            pid += 1
    return spark.createDataFrame(out, CODED)


def test_collision_numbers(spark):
    base = Q.base_counts(rows_of(spark, [3, 2, 1]), LEVELS, ["league", "team"])
    r = Q.collision(base, LEVELS).first()
    assert (r.n, r.worst_case_bucket, r.p50, r.p90, r.p99) == (6, 3, 3.0, 3.0, 3.0)
    assert r.collision_rate == pytest.approx(5 / 6) and r.dedup_fraction == pytest.approx(0.5)


def test_collision_of_an_empty_table_and_of_one_code(spark):
    empty = Q.base_counts(spark.createDataFrame([], CODED), LEVELS, ["league", "team"])
    r = Q.collision(empty, LEVELS).first()
    assert r.n == 0 and r.collision_rate is None and r.p99 is None
    assert Q.collision(Q.base_counts(rows_of(spark, [50]), LEVELS, ["league", "team"]), LEVELS).first().collision_rate == 1.0


def test_quantiles_match_the_sorted_rows(spark):
    sizes = [1] * 37 + [2] * 11 + [5] * 7 + [40, 3, 3, 9]
    r = Q.collision(Q.base_counts(rows_of(spark, sizes), LEVELS, ["league", "team"]), LEVELS).first()
    rows = sorted(s for s in sizes for _ in range(s))
    for name, q in (("p50", 0.5), ("p90", 0.9), ("p99", 0.99)):
        assert r[name] == rows[math.floor((len(rows) - 1) * q + 0.5)]


def test_hot_buckets_count_collisions_inside(spark):
    a = rows_of(spark, [3, 1], "A", "t1")
    b = rows_of(spark, [2], "B", "t2").withColumn("product_id", F.col("product_id") + 100)
    base = Q.base_counts(a.union(b), LEVELS, ["league", "team"])
    hot = {r.team: r for r in Q.collision_hot(base, LEVELS, 2).collect()}
    assert (hot["t1"].n, hot["t1"].worst_case_bucket, hot["t1"].collision_rate) == (4, 3, 0.75)
    assert (hot["t2"].n, hot["t2"].worst_case_bucket) == (2, 2)
    use = Q.utilization_hot(base, LEVELS, 4, 1).collect()
    assert len(use) == 3 and {r.bucket_count for r in use} == {4}


def test_perfect_alignment(spark):
    rows = [(i, 0 if i < 20 else 1, i % 2, 0, "L", "a" if i < 20 else "b") for i in range(40)]
    base = Q.base_counts(spark.createDataFrame(rows, CODED), LEVELS, ["league", "team"])
    got = {(r.taxonomy_field, r.prefix_length): r for r in Q.alignment(base, LEVELS, ["league", "team"]).collect()}
    assert len(got) == 6
    r = got["team", 1]
    assert (r.share_prefix, r.baseline, r.lift, r.prefix_purity) == (1.0, 0.5, 2.0, 1.0)
    assert got["league", 1].prefix_purity == 1.0 and got["league", 1].lift < 1.0


def test_alignment_keeps_null_taxa_in_n_only_and_merges_null_prefixes(spark):
    rows = [(0, 1, 1, 1, "L", "a"), (1, 1, 1, 1, "L", "a"), (2, 1, 1, 1, "L", None), (3, 2, 2, 2, "L", "b"),
            (4, None, 1, 1, "L", "a"), (5, None, 2, 1, "L", "a")]
    base = Q.base_counts(spark.createDataFrame(rows, CODED), LEVELS, ["league", "team"])
    r = {x.prefix_length: x for x in Q.alignment(base, LEVELS, ["team"]).collect()}[2]
    # taxon a: prefixes (1,1) twice and NULL twice; taxon b has one row
    assert r.share_prefix == pytest.approx(4 / 6 * (2 + 2) / (4 * 3))
    assert r.baseline == pytest.approx((3 * 3 + 1 + 2 * 2) / 36)
    assert r.prefix_purity == pytest.approx((2 + 1 + 2) / 6)


def test_dedup_slots_follow_product_id(spark):
    rows = [(5, 0, 0, 0), (2, 0, 0, 0), (9, 0, 0, 0), (3, 1, 1, 1), (1, 1, 1, 1), (7, 2, 2, 2)]
    df = spark.createDataFrame(rows, "product_id long, c1 int, c2 int, c3 int")
    for hot_rows in (2_000_000, 1):
        got = {r.product_id: r.dedup for r in add_dedup_index(df, LEVELS, hot_rows=hot_rows).collect()}
        assert got == {2: 0, 5: 1, 9: 2, 1: 0, 3: 1, 7: 0}
    assert max_dedup(df, LEVELS).first().max_dedup == 2
    assert max_dedup(df.limit(0), LEVELS).first().max_dedup == 0


def test_cold_start_counts_mates_without_self(spark):
    rows = [(0, 1, 1, 1, "L", "a"), (1, 1, 1, 1, "L", "a"), (2, 1, 1, 1, "L", "b"), (3, 1, 1, 2, "L", "a"), (4, 9, 9, 9, "L", "b")]
    df = spark.createDataFrame(rows, CODED)
    r = Q.cold_start(df, LEVELS, F.col("product_id").isin(0, 3, 4)).first()
    # 0: one of two mates; 3: falls back to the prefix (1,1), two of three; 4: no mates at all
    assert (r.cold_items, r.judged_items, r.fallback_items) == (3, 2, 2)
    assert r.purity == pytest.approx((0.5 + 2 / 3) / 2)
    assert r.baseline == pytest.approx((9 + 4) / 25)


def test_report_renders(spark):
    tables = Q.report_tables(rows_of(spark, [3, 2, 1]), 4, 3, 2, top_k=3)
    report = Q.report_dict(tables)
    assert report["run_config"] == {"W": 4, "L": 3, "d": 2}
    assert set(report["utilization"]["global"]) == {"c1", "c2", "c3"}
    text = Q.to_markdown(report)
    assert "collision_rate=0.8333" in text and "p50/p90/p99=3.0/3.0/3.0" in text
    assert Q.to_json(report).startswith("{")


def test_dense_usage_sums_to_the_rows(spark):
    base = Q.base_counts(rows_of(spark, [3, 2, 1]), LEVELS, ["league", "team"])
    dense = Q.usage_dense(base, LEVELS, 5).groupBy("level").agg(F.sum("used").alias("s"), F.count("*").alias("k"))
    assert {(r.s, r.k) for r in dense.collect()} == {(6, 5)}


def test_column_lists():
    assert output_columns(2) == ["product_id", "c1", "c2", "dedup", "embedding_set_version", "code_version"]
    assert discover_levels(["c2", "x", "c1", "c10x"]) == level_columns(2)
    for bad in (["x"], ["c1", "c3"]):
        with pytest.raises(ValueError):
            discover_levels(bad)
