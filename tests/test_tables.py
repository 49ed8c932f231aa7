import numpy as np
import pytest
from pyspark.sql import functions as F

from codeloom.functions.kernels import fresh_weights
from codeloom.operators.quantize import Artifact
from codeloom.plans import sweep as S
from codeloom.sources import tables as B
from codeloom.sources.catalog import read_assignments, read_mapping, source_files, synthetic_catalog

CODES = "product_id long, c1 int, c2 int, dedup int"


def coded(spark, rows):
    return spark.createDataFrame(rows, CODES)


def test_publish_replaces_one_version_only(spark, tmp_path):
    out = str(tmp_path / "out")
    B.publish_assignment(coded(spark, [(1, 0, 0, 0)]), out, "01", "set-a", 2)
    B.publish_assignment(coded(spark, [(1, 5, 5, 0), (2, 5, 5, 1)]), out, "v2", "set-a", 2)
    B.publish_assignment(coded(spark, [(1, 7, 7, 0)]), out, "v2", "set-b", 2)
    assert read_assignments(spark, out).count() == 2
    row = read_assignments(spark, out, "v2").first()
    assert (row.c1, row.embedding_set_version, row.code_version) == (7, "set-b", "v2")
    assert read_assignments(spark, out, "01").first().c1 == 0
    plan = read_assignments(spark, out, "v2")._jdf.queryExecution().executedPlan().toString()
    assert "code_version" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_publish_keeps_a_set_version_of_the_data(spark):
    df = coded(spark, [(1, 0, 0, 0)]).withColumn("embedding_set_version", F.lit("own"))
    assert B.published_columns(df, "v", "other", 2).first().embedding_set_version == "own"


def test_duplicate_keys_are_refused(spark):
    B.assert_unique(coded(spark, [(1, 0, 0, 0), (2, 0, 0, 0)]))
    with pytest.raises(ValueError):
        B.assert_unique(coded(spark, [(1, 0, 0, 0), (1, 0, 0, 1)]))


def test_mapping_schema_is_checked(spark, mapping, tmp_path):
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    mapping.write.parquet(good)
    assert read_mapping(spark, good).count() == 11
    mapping.drop("c2").write.parquet(bad)
    with pytest.raises(ValueError):
        read_mapping(spark, bad)


def test_index_build_counts_and_staleness(spark, tmp_path):
    source, index = str(tmp_path / "src"), str(tmp_path / "index")
    good = synthetic_catalog(spark, 30, 2, 1, 2, dim=8, partitions=2).select("product_id", "content_embedding")
    bad = spark.createDataFrame([(100, None), (101, [1.0])], "product_id long, content_embedding array<float>")
    good.union(bad).write.parquet(source)
    assert B.is_stale(spark, index, source)
    meta = B.build_index(spark, source, index, 8).first()
    assert (meta.dim, meta.n_rows, meta.dropped_invalid, meta.normalized) == (8, 30, 2, True)
    assert B.read_index(spark, index).count() == 30
    assert not B.is_stale(spark, index, source)
    with pytest.raises(Exception, match="exist"):
        B.build_index(spark, source, index, 8)
    counts = B.index_counts(spark.read.parquet(source), 8).agg(F.sum("raw_rows"), F.sum("valid_rows")).first()
    assert tuple(counts) == (32, 30)
    bad.write.mode("append").parquet(source)
    assert B.is_stale(spark, index, source)
    assert B.build_index(spark, source, index, 8, force=True).first().dropped_invalid == 4
    assert not B.is_stale(spark, index, source)
    assert source_files(spark, source).columns == ["name", "size", "modified"]


def test_a_broken_build_leaves_the_index_before(spark, tmp_path):
    source, index = str(tmp_path / "src"), str(tmp_path / "index")
    rows = synthetic_catalog(spark, 30, 2, 1, 2, dim=8, partitions=2).select("product_id", "content_embedding")
    rows.where("product_id < 20").write.parquet(source)
    B.build_index(spark, source, index, 8)
    first = B.index_build(spark, index)
    rows.where("product_id >= 20").write.mode("append").parquet(source)
    # A build that broke off after its vectors, before its facts.
    rows.limit(1).write.parquet(f"{index}/build=2/vectors")
    assert B.index_build(spark, index) == first and B.read_index(spark, index).count() == 20 and B.is_stale(spark, index, source)
    assert B.build_index(spark, source, index, 8, force=True).first().n_rows == 30
    assert B.index_build(spark, index).endswith("build=3") and B.read_index(spark, index).count() == 30
    assert spark.read.parquet(f"{first}/vectors").count() == 20  # still there for its readers
    B.build_index(spark, source, index, 8, force=True)
    assert sorted(p.name for p in (tmp_path / "index").iterdir()) == ["build=3", "build=4"]


def test_artifact_round_trip_and_immutability(spark, tmp_path):
    out = str(tmp_path / "out")
    model = Artifact(codebooks=np.random.default_rng(0).normal(size=(2, 4, 3)), weights=fresh_weights(8, 3, 0), d_in=8)
    B.save_artifact(spark, model, out, "7", "set", {"note": "x"})
    back = B.load_artifact(spark, out, "7")
    assert np.array_equal(back.codebooks, model.codebooks) and back.metadata == {"note": "x"}
    assert all(np.array_equal(back.weights[k], model.weights[k]) for k in model.weights)
    assert (back.code_version, back.embedding_set_version, back.normalize) == ("7", "set", True)
    with pytest.raises(ValueError):
        back.codebooks[0, 0, 0] = 1.0
    with pytest.raises(Exception, match="exist"):
        B.save_artifact(spark, model, out, "7", "set")


def test_csv_export(spark, mapping, tmp_path):
    path = str(tmp_path / "csv")
    B.write_csv(mapping, path)
    assert spark.read.option("header", True).csv(path).count() == 11


def test_synthetic_catalog_is_skewed_and_repeatable(spark):
    a = synthetic_catalog(spark, 4000, 20, 3, 4, dim=16, partitions=3)
    b = synthetic_catalog(spark, 4000, 20, 3, 4, dim=16, partitions=11)
    assert a.exceptAll(b).isEmpty()
    share = a.agg(F.avg((F.col("league") == "North").cast("double"))).first()[0]
    assert share == pytest.approx(80 / 92, abs=0.03)
    assert a.select("league", "team").distinct().count() == 32
    assert a.where("is_hot_market = 'true' AND launch_age_bucket <> '0-7d'").isEmpty()
    norms = a.selectExpr("sqrt(aggregate(content_embedding, 0D, (s, x) -> s + x * x)) AS n").agg(F.min("n"), F.max("n")).first()
    assert norms[0] == pytest.approx(1, abs=1e-5) and norms[1] == pytest.approx(1, abs=1e-5)


def test_capacity_table(spark):
    got = {(r.W, r.L): r for r in S.capacity(S.grid_frame(spark, [(512, 3, 32), (256, 3, 32)]), spark.range(4000)).collect()}
    assert got[512, 3].cells == 512**3 and got[512, 3].items_per_code == pytest.approx(4000 / 512)
    assert got[256, 3].headroom == pytest.approx(256**3 / 4000)
    assert len(S.grid_rows()) == 6


def results(spark, rows):
    return spark.createDataFrame(rows, "W int, L int, d int, hot_utilization_passes boolean, collision_passes boolean")


def test_selection_takes_the_smallest_that_passes_or_none(spark):
    rows = [(512, 3, 32, True, False), (512, 4, 32, True, True), (1024, 3, 32, True, True), (256, 4, 32, False, True)]
    chosen = S.select_config(results(spark, rows))
    assert tuple(chosen.first())[:3] == (512, 4, 32)
    assert tuple(S.extra_run(chosen).first()) == (512, 4, 64)
    assert S.select_config(results(spark, rows[:1])).isEmpty()


def test_sweep_writes_one_partition_per_run(spark, tmp_path):
    def run(w, depth, d):
        return spark.createDataFrame([(w > 4, True)], "hot_utilization_passes boolean, collision_passes boolean")

    table = S.run_sweep(spark, [(4, 2, 8), (8, 2, 8), (16, 2, 8)], run, str(tmp_path / "sweep"))
    assert table.count() == 3 and tuple(S.select_config(table).select("W", "L", "d").first()) == (8, 2, 8)


def test_run_comparison(spark):
    a = spark.createDataFrame([("c1", 0.5, 10)], "level string, entropy double, top int")
    b = spark.createDataFrame([("c1", 0.75, 7)], "level string, entropy double, top int")
    got = {r.metric: (r.value_a, r.value_b, r.difference) for r in S.compare_runs(a, b, ["level"], ["entropy", "top"]).collect()}
    assert got == {"entropy": (0.5, 0.75, 0.25), "top": (10.0, 7.0, -3.0)}


def test_churn(spark):
    old = coded(spark, [(1, 0, 0, 0), (2, 0, 1, 0), (3, 1, 1, 0), (9, 1, 1, 1)])
    new = coded(spark, [(1, 0, 0, 0), (2, 0, 2, 0), (3, 2, 1, 0), (7, 1, 1, 0)])
    got = {r.prefix_length: r for r in S.churn(S.dual_write(old, new, ["c1", "c2"]), ["c1", "c2"]).collect()}
    assert [got[i].changed for i in (1, 2, 3)] == [1, 2, 2]
    assert (got[1].common, got[1].added, got[1].removed) == (3, 1, 1)
    assert got[2].changed_share == pytest.approx(2 / 3)
