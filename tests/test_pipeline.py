import numpy as np
import pytest
from pyspark.sql import functions as F

from codeloom.functions.names import level_columns
from codeloom.operators.prepare import prepare
from codeloom.operators.quantize import Artifact, add_dedup_index, assign_codes
from codeloom.params import EvalParams, PrepParams, QuantizerParams, RunParams, TrainParams, WeightParams
from codeloom.plans import grid
from codeloom.plans.pipeline import run_assignment, run_evaluation, run_training
from codeloom.sources.catalog import read_catalog, read_taxonomy, synthetic_catalog
from codeloom.sources.tables import load_artifact, write_full_mapping
from codeloom.streaming.ingest import append_slots, coded_stream, ingest, read_batches

PARAMS = RunParams(
    prep=PrepParams(embedding_dim=128, embedding_set_version="set-v1"),
    weights=WeightParams(5, 3.0, 3.0),
    quantizer=QuantizerParams(
        W=16, L=2, d=8, gamma=0.9, kmeans_iterations=5, dead_code_reset_threshold=0.02, dead_code_reset_every=2
    ),
    training=TrainParams(batch_size=256, max_epochs=4, patience=3, min_delta=1e-5, seed=0),
    evaluation=EvalParams(hot_bucket_top_k=5),
    code_version="run-v1",
)


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("run")
    source, output = str(base / "source"), str(base / "output")
    synthetic_catalog(spark, 4000, 20, 3, 4, partitions=4).write.parquet(source)
    path, history = run_training(spark, source, output, PARAMS)
    return source, output, path, history


def test_end_to_end(spark, trained, tmp_path):
    source, output, path, history = trained
    assert 0 < len(history) <= 4
    assert history[-1].val_reconstruction <= history[0].val_reconstruction * 1.5
    assert spark.read.parquet(f"{path}/history").count() == len(history)

    published = run_assignment(spark, source, output, PARAMS)
    assert published.count() == 4000
    assert set(published.columns) == {"product_id", "c1", "c2", "dedup", "embedding_set_version", "code_version"}
    slots = published.groupBy("c1", "c2").agg(F.count("*").alias("n"), F.max("dedup").alias("m"), F.countDistinct("dedup").alias("k"))
    assert slots.where("n <> m + 1 OR n <> k").isEmpty()

    report = run_evaluation(spark, source, output, PARAMS)
    assert report["run_config"] == {"W": 16, "L": 2, "d": 8}
    assert set(report["utilization"]["global"]) == {"c1", "c2"}
    assert len(report["utilization"]["hot_buckets"]) == 5 and len(report["collision"]["hot_buckets"]) == 5
    assert 0 <= report["collision"]["global"]["collision_rate"] <= 1 and report["collision"]["global"]["n"] == 4000
    assert len(report["taxonomy_alignment"]) == 4
    assert all(r["lift"] > 1 for r in report["taxonomy_alignment"] if r["prefix_length"] == 1)

    assert write_full_mapping(published, read_taxonomy(spark, source), str(tmp_path / "mapping")) == 4000


def test_a_second_run_cannot_replace_the_artifact(spark, trained):
    source, output, _, _ = trained
    with pytest.raises(Exception, match="exist"):
        run_training(spark, source, output, PARAMS)


def model(dim=8):
    return Artifact(codebooks=np.random.default_rng(0).normal(size=(2, 3, dim)) * 0.5, d_in=dim)


@pytest.mark.parametrize("files", [3])
def test_stream_equals_the_batch_on_ascending_ids(spark, tmp_path, files):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    catalog = synthetic_catalog(spark, 60, 3, 1, 2, dim=8).select("product_id", "content_embedding")
    for i in range(files):
        low, high = i * 20 - (5 if i else 0), (i + 1) * 20  # five ids are delivered again
        catalog.where(F.col("product_id").between(max(low, 0), high - 1)).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(catalog.schema).option("maxFilesPerTrigger", 1).parquet(source)
        query = ingest(stream, model(), 8, out, str(tmp_path / "cp")).trigger(availableNow=True).start()
        query.awaitTermination(120)
    got = read_batches(spark, out, 2).drop("batch")
    expected = add_dedup_index(coded_stream(catalog, model(), 8), level_columns(2))
    assert got.count() == 60 and got.exceptAll(expected.select(got.columns)).isEmpty()


def test_published_slots_never_move(spark):
    levels = ["c1"]
    published = spark.createDataFrame([(10, 1, 0), (20, 1, 1), (5, 2, 0)], "product_id long, c1 int, dedup int")
    new = spark.createDataFrame([(1, 1), (3, 1), (3, 1), (20, 1), (9, 3)], "product_id long, c1 int")
    got = {r.product_id: r.dedup for r in append_slots(new, published, levels).collect()}
    assert got == {1: 2, 3: 3, 9: 0}


def test_warm_started_retrain(spark, trained):
    source, output, _, history = trained
    from dataclasses import replace

    params = replace(PARAMS, code_version="run-v2", training=replace(PARAMS.training, max_epochs=1))
    _, more = run_training(spark, source, output, params, warm_start="run-v1")
    assert more[0].val_reconstruction < history[0].val_reconstruction * 1.2
    assert load_artifact(spark, output, "run-v2").codebooks.shape == (2, 16, 8)


def test_a_sweep_runs(spark, trained, tmp_path, monkeypatch):
    source, output = trained[0], str(tmp_path / "out")
    from dataclasses import replace

    params = replace(PARAMS, training=replace(PARAMS.training, max_epochs=1))
    configs = [(16, 2, 8), (8, 1, 4)]
    table = grid.run_grid(spark, source, output, configs, params)
    rows = {(r.W, r.L, r.d): r for r in table.collect()}
    assert set(rows) == set(configs) and all(r.records == 5 * k[1] for k, r in rows.items())
    # Codes of the one scan are those of each model alone.
    ready = prepare(read_catalog(spark, source), 128)
    models = {c: load_artifact(spark, output, grid.version_of(params, c)) for c in configs}
    coded = grid.code_grid(ready, models, ["product_id"])
    for config in configs:
        alone = assign_codes(ready, models[config])
        names = [F.col("codes")[i].alias(c) for i, c in enumerate(level_columns(config[1]))]
        own = coded.where((F.col("W") == config[0]) & (F.size("codes") == config[1])).select("product_id", *names)
        assert own.count() == 4000 and own.exceptAll(alone).isEmpty()
    assert coded._jdf.queryExecution().toString().count("FileScan") == 1
    # A second run trains nothing.
    monkeypatch.setattr(grid, "train_version", None)
    again = grid.run_grid(spark, source, output, configs, params)
    assert {(r.W, r.L, r.d): r for r in again.collect()} == rows
