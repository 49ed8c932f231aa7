import os
import subprocess
import sys
from dataclasses import replace
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from codeloom.functions.kernels import (
    batch_step,
    codebooks_from,
    ema_codebooks,
    fresh_weights,
    nearest,
    quantize_rows,
    run_layers,
)
from codeloom.operators import resume
from codeloom.operators import training as T
from codeloom.operators.quantize import (
    Artifact,
    assign_codes,
    encode,
    level_errors,
    reconstruct,
    reconstruction_error,
)
from codeloom.params import QuantizerParams, TrainParams


def vectors(spark, rows, parts=4):
    data = [(i, [float(x) for x in row]) for i, row in enumerate(rows)]
    return spark.createDataFrame(data, "product_id long, content_embedding array<double>").repartition(parts)


def clusters(n=80, d=4, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, d)) * 5
    return np.repeat(centres, n // 4, axis=0) + rng.normal(size=(n, d)) * 0.05


def test_nearest_takes_the_lowest_of_equal_codes():
    book = np.array([[9.0, 9.0], [1.0, 0.0], [1.0, 0.0], [0.0, 1.0]])
    code, distance = nearest(np.array([[1.0, 0.1], [0.5, 0.5]]), book)
    assert code.tolist() == [1, 1] and distance[0] == pytest.approx(0.01)


def test_gradients_match_finite_differences():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(12, 16))
    weights = fresh_weights(16, 4, 1)
    z = run_layers(x, weights, "encoder")[-1]
    books = [z[:8] + 0.01, rng.normal(size=(8, 4)) * 0.05]
    codes, residuals = quantize_rows(z, books)
    fixed = sum(book[codes[:, level]] for level, book in enumerate(books))
    beta = 0.25

    def loss(w):
        now = run_layers(x, w, "encoder")[-1]
        passed = now + (fixed - z)  # straight through: value fixed, slope one
        out = run_layers(passed, w, "decoder")[-1]
        first = now - books[0][codes[:, 0]]
        return ((out - x) ** 2).sum() / 16 + beta * (first**2).sum() / 4

    step = batch_step(x, weights, books, beta)
    for name in ("encoder.w0", "encoder.b2", "encoder.w2", "decoder.w1", "decoder.b0"):
        flat = weights[name].reshape(-1)
        for at in (0, len(flat) // 2, len(flat) - 1):
            kept = flat[at]
            flat[at] = kept + 1e-6
            up = loss(weights)
            flat[at] = kept - 1e-6
            down = loss(weights)
            flat[at] = kept
            assert step["gradients"][name].reshape(-1)[at] == pytest.approx((up - down) / 2e-6, rel=1e-4, abs=1e-7)


def test_shapes_and_code_range(spark):
    weights = fresh_weights(16, 4, 0)
    books = np.random.default_rng(0).normal(size=(2, 8, 4))
    model = Artifact(codebooks=books, weights=weights, d_in=16)
    df = vectors(spark, np.random.default_rng(1).normal(size=(10, 16)))
    assert {len(r.latent) for r in encode(df, model).collect()} == {4}
    assert {len(r.decoded) for r in reconstruct(df, model).collect()} == {16}
    codes = assign_codes(df, model)
    assert codes.columns == ["product_id", "c1", "c2"]
    assert codes.where("c1 < 0 OR c1 >= 8 OR c2 < 0 OR c2 >= 8").isEmpty() and codes.count() == 10


def test_codes_do_not_depend_on_partitions(spark):
    rows = np.random.default_rng(5).normal(size=(300, 8))
    model = Artifact(codebooks=np.random.default_rng(6).normal(size=(3, 16, 8)), d_in=8)
    first = assign_codes(vectors(spark, rows, 1), model)
    for parts in (4, 16):
        assert first.exceptAll(assign_codes(vectors(spark, rows, parts), model)).isEmpty()
    expected, residuals = quantize_rows(rows, list(model.codebooks))
    got = {r.product_id: (r.c1, r.c2, r.c3) for r in first.collect()}
    assert all(got[i] == tuple(expected[i]) for i in range(300))
    mse = reconstruction_error(vectors(spark, rows), model).first()
    assert mse.n == 300 and mse.reconstruction_mse == pytest.approx((residuals[-1] ** 2).mean())
    errors = {r.level: r.mean_error for r in level_errors(vectors(spark, rows), model).collect()}
    assert errors[2] == pytest.approx((residuals[2] ** 2).sum(axis=1).mean())


def test_assignment_refuses_rows_prepared_differently(spark):
    model = Artifact(codebooks=np.zeros((1, 2, 4)), d_in=4)
    with pytest.raises(ValueError):
        assign_codes(vectors(spark, clusters()), model, normalized=False)


def test_kmeans_error_never_rises_and_beats_a_random_codebook(spark):
    rows = clusters()
    books, sizes, log = T.fit_codebooks(vectors(spark, rows).persist(), "content_embedding", 4, 1, 10, 1)
    errors = [step["sse"] for step in log]
    assert all(b <= a + 1e-9 for a, b in zip(errors, errors[1:]))
    assert sizes.sum() == 80
    random_book = np.random.default_rng(0).normal(0, 0.01, (4, 4))
    assert nearest(rows, books[0])[1].sum() < nearest(rows, random_book)[1].sum()


def test_kmeans_with_fewer_rows_than_codes(spark):
    books, sizes, _ = T.fit_codebooks(vectors(spark, clusters()[:3]), "content_embedding", 8, 2, 2, 1)
    assert books.shape == (2, 8, 4) and sizes[0].sum() == 3


def test_residual_levels_lower_the_error(spark):
    rows = np.random.default_rng(2).normal(size=(200, 6))
    books, _, _ = T.fit_codebooks(vectors(spark, rows).persist(), "content_embedding", 8, 3, 5, 4)
    _, residuals = quantize_rows(rows, list(books))
    norms = [(r**2).sum() for r in residuals]
    assert norms[0] > norms[1] > norms[2] > norms[3]


def test_ema_keeps_a_settled_codebook_and_moves_to_new_data():
    centres = np.random.default_rng(0).normal(size=(1, 4, 3))
    sizes = np.full((1, 4), 195.0)
    sums = centres * sizes[:, :, None]
    assert np.allclose(codebooks_from(sizes, sums), centres, rtol=1e-6)
    counts = np.full((1, 4), 50.0)
    _, _, same = ema_codebooks(sizes, sums, counts, centres * counts[:, :, None], 0.99)
    assert np.allclose(same, centres, rtol=1e-6)
    _, _, moved = ema_codebooks(sizes, sums, counts, (centres + 5) * counts[:, :, None], 0.5)
    assert (moved > centres).all()


def test_dead_codes_are_reseeded_from_the_error_pool():
    model = Artifact(codebooks=np.array([[[0.0] * 4, [100.0] * 4, [100.0] * 4, [100.0] * 4]]))
    sizes = np.full((1, 4), 10.0)
    sums = model.codebooks * sizes[:, :, None]
    usage = np.array([[50.0, 0, 0, 0]])
    pool = np.random.default_rng(0).normal(size=(10, 4)) * 50
    books, sizes2, sums2, done = T.reset_dead(model, sizes, sums, usage, {1: pool}, 0.1, relative=False)
    assert done == [3] and np.array_equal(books[0][1:], pool[:3]) and np.array_equal(books[0][0], model.codebooks[0][0])
    assert np.allclose(sums2, books * sizes2[:, :, None])
    assert T.reset_dead(model, sizes, sums, usage, {}, 0.1)[3] == [0]


def test_uniform_usage_is_not_dead_at_the_default_threshold():
    assert not T.dead_codes(np.full(512, 10.0), 0.01).any()
    assert T.dead_codes(np.full(512, 10.0), 0.01, relative=False).all()


def test_error_pool_is_the_largest_distances(spark):
    rows = np.random.default_rng(2).normal(size=(60, 4))
    model = Artifact(codebooks=np.random.default_rng(3).normal(size=(2, 4, 4)))
    pools = T.collect_pools(T.level_rows(vectors(spark, rows), model), 5)
    _, residuals = quantize_rows(rows, list(model.codebooks))
    for level in (1, 2):
        worst = np.argsort(-(residuals[level] ** 2).sum(axis=1), kind="stable")[:5]
        assert np.allclose(pools[level], residuals[level - 1][worst])


SMALL = QuantizerParams(W=8, L=2, d=4, gamma=0.9, kmeans_iterations=3, dead_code_reset_threshold=0.05)


def weighted(spark, n=400, parts=4):
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(6, 16))
    rows = centres[np.arange(n) % 6] + rng.normal(size=(n, 16)) * 0.1
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    return vectors(spark, rows, parts).withColumn("sample_weight", F.lit(1.0))


def test_one_step_is_the_same_on_one_and_on_many_partitions(spark):
    rows = weighted(spark).select("product_id", "content_embedding", F.lit(1).alias("copies"))
    results = []
    for parts in (1, 7):
        model = T.initial_model(weighted(spark, parts=parts), 16, SMALL, 3)
        T.gradient_round(rows.repartition(parts).select("content_embedding", "copies"), model, SMALL, 1e-3)
        results.append(model)
    for name in results[0].names():
        assert np.allclose(results[0].weights[name], results[1].weights[name], atol=1e-9)
    assert np.allclose(results[0].books, results[1].books, atol=1e-9)


def test_local_round_on_one_partition_is_plain_minibatch_training(spark):
    rows = weighted(spark, parts=1).select("content_embedding", F.lit(1).alias("copies"), "product_id")
    model = T.initial_model(weighted(spark, parts=1), 16, SMALL, 3)
    before = model.copy()
    out = T.local_round(rows, model, SMALL, 1e-3, 400, 1, 0)
    exact = before.copy()
    T.gradient_round(rows.select("content_embedding", "copies"), exact, SMALL, 1e-3)
    assert out["rows"] == 400 and model.step == 1
    for name in model.names():
        assert np.allclose(model.weights[name], exact.weights[name], atol=1e-9)
    assert np.allclose(model.books, exact.books, atol=1e-9)


def test_training_does_not_depend_on_files_or_cores(spark):
    settings = TrainParams(lr=3e-3, batch_size=64, max_epochs=2, min_delta=0.0, seed=1, shards=4, rows_per_round=250)
    runs = []
    for parts in (1, 6):
        train = weighted(spark, parts=parts)
        runs.append(T.train_quantizer(train, train.drop("sample_weight"), 16, SMALL, settings)[1])
    for a, b in zip(*runs):
        assert abs(a.val_reconstruction - b.val_reconstruction) < 1e-9 and abs(a.train_loss - b.train_loss) < 1e-9
        assert a.dead_codes_reset == b.dead_codes_reset


def test_training_from_another_folder(tmp_path):
    """The workers have no copy of the package."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = (
        f"import sys; sys.path.insert(0, {root!r})\n"
        "import __spark_entry__ as e\n"
        "from codeloom.session import local_session\n"
        f"spark = local_session(2, 'away', '2g', spark__checkpoint__dir={str(tmp_path / 'shared')!r})\n"
        "print('epochs', e.queries()['train_history'](spark, '/root/testdata/sf0.001').count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "epochs 2" in done.stdout, done.stderr[-2000:]


@pytest.mark.parametrize("mode", ["sync", "local"])
def test_training_lowers_the_error(spark, mode):
    train = weighted(spark)
    settings = TrainParams(lr=3e-3, batch_size=200, max_epochs=5, patience=5, min_delta=0.0, seed=1, mode=mode, rows_per_round=250)
    artifact, history = T.train_quantizer(train, train.drop("sample_weight"), 16, SMALL, settings)
    errors = [h.val_reconstruction for h in history]
    assert min(errors[1:]) < errors[0]
    assert artifact.codebooks.shape == (2, 8, 4)
    again, more = T.train_quantizer(
        train, train.drop("sample_weight"), 16, SMALL,
        TrainParams(lr=1e-3, batch_size=200, max_epochs=1, seed=1, mode=mode), warm_start=artifact,
    )
    assert more[0].val_reconstruction < errors[0]


def test_warm_start_needs_equal_shapes(spark):
    wrong = Artifact(codebooks=np.zeros((1, 8, 4)), weights=fresh_weights(16, 4, 0), d_in=16)
    with pytest.raises(ValueError):
        T.initial_model(weighted(spark), 16, SMALL, 0, warm_start=wrong)


def test_early_stop(spark):
    train = weighted(spark, 100)
    settings = TrainParams(lr=0.0, max_epochs=9, patience=2, min_delta=1.0, seed=1)
    _, history = T.train_quantizer(
        train, train.drop("sample_weight"), 16, QuantizerParams(W=4, L=1, d=4, kmeans_iterations=1, dead_code_reset=False), settings
    )
    assert len(history) == 3


class Stopped(Exception):
    pass


@pytest.mark.parametrize("mode", ["local", "sync"])
def test_a_stopped_training_goes_on(spark, tmp_path, monkeypatch, mode):
    settings = TrainParams(lr=3e-3, batch_size=200, max_epochs=4, patience=4, min_delta=0.0, seed=1, mode=mode, shards=4, rows_per_round=250)
    train, state = weighted(spark), str(tmp_path / "state")

    def run(path=None, training=settings, rows=train):
        return T.train_quantizer(rows, rows.drop("sample_weight"), 16, SMALL, training, state_path=path)

    whole, history = run()
    check, calls = T.validation, []

    def stops(*given):
        calls.append(1)
        if len(calls) == 3:
            raise Stopped
        return check(*given)

    with monkeypatch.context() as m:
        m.setattr(T, "validation", stops)
        with pytest.raises(Stopped):
            run(state)
    folder = next(Path(state).iterdir())
    assert resume.complete_epochs(spark, str(folder)) == [1]
    # What a broken write leaves behind does not count.
    (folder / "epoch=2").mkdir()
    with monkeypatch.context() as m:
        m.setattr(T, "initial_model", None)
        again, more = run(state)
        # A run that had ended only returns its result.
        m.setattr(T, "local_round", None)
        m.setattr(T, "gradient_round", None)
        assert run(state)[1] == more
    assert [h.epoch for h in more] == [0, 1, 2, 3]
    for a, b in zip(history, more):
        np.testing.assert_allclose(
            [a.train_loss, a.val_reconstruction, a.val_normalized_utilization], [b.train_loss, b.val_reconstruction, b.val_normalized_utilization],
            rtol=1e-9,
        )
        assert a.dead_codes_reset == b.dead_codes_reset
    np.testing.assert_allclose(whole.codebooks, again.codebooks, rtol=1e-8, atol=1e-10)
    # Other rows or settings do not meet this state.
    one = replace(settings, max_epochs=1)
    assert len(run(state, replace(one, lr=1e-3))[1]) == 1 and len(run(state, one, train.where("product_id > 0"))[1]) == 1
    assert len(list(Path(state).iterdir())) == 3


def test_an_early_stop_stays_one(spark, tmp_path):
    settings = TrainParams(lr=0.0, max_epochs=9, patience=2, min_delta=1.0, seed=1)
    train, state = weighted(spark), str(tmp_path / "state")
    runs = [T.train_quantizer(train, train.drop("sample_weight"), 16, SMALL, settings, state_path=state)[1] for _ in range(2)]
    assert runs[0] == runs[1] and len(runs[0]) < 9


def test_one_barrier_job_takes_the_steps_of_many_jobs(spark, monkeypatch):
    """With more tasks than rows in a slice, an empty slice, and dead codes in between."""
    train = weighted(spark)
    settings = TrainParams(lr=3e-3, batch_size=64, max_epochs=3, patience=3, min_delta=0.0, seed=1, mode="sync")
    runs = []
    for tasks in (0, 1, 3):
        with monkeypatch.context() as m:
            m.setattr(T, "barrier_tasks", lambda *given: tasks)
            m.setattr(T, "gradient_round" if tasks else "barrier_rounds", None)
            runs.append(T.train_quantizer(train, train.drop("sample_weight"), 16, SMALL, settings))
    (plain, first), *others = runs
    for artifact, history in others:
        for a, b in zip(first, history, strict=True):
            assert abs(a.train_loss - b.train_loss) < 1e-9 and abs(a.val_reconstruction - b.val_reconstruction) < 1e-9
            assert a.dead_codes_reset == b.dead_codes_reset
        np.testing.assert_allclose(plain.codebooks, artifact.codebooks, rtol=1e-7, atol=1e-9)
        for name, values in plain.weights.items():
            np.testing.assert_allclose(values, artifact.weights[name], rtol=1e-7, atol=1e-9)


def test_barrier_steps_with_empty_tasks_and_slices(spark):
    few = weighted(spark, parts=1).where("product_id < 3").withColumn("copies", F.lit(1)).withColumn("slice", F.lit(2))
    model = T.initial_model(weighted(spark, parts=1), 16, SMALL, 3)
    exact = model.copy()
    told = T.barrier_rounds(few, model, SMALL, 1e-3, 4, 4, 1)
    T.gradient_round(few.select("content_embedding", "copies"), exact, SMALL, 1e-3)
    assert [s["rows"] for s in told] == [0.0, 0.0, float(few.count()), 0.0] and model.step == 1
    for name in model.names():
        np.testing.assert_allclose(model.weights[name], exact.weights[name], atol=1e-12)
    before = model.copy()
    none = T.barrier_rounds(few.where("product_id < 0"), model, SMALL, 1e-3, 2, 3, 1)
    assert [s["rows"] for s in none] == [0.0, 0.0]
    np.testing.assert_array_equal(before.books, model.books)


def test_barrier_tasks_are_bounded_by_what_they_exchange(spark):
    assert T.barrier_tasks(spark, 1000) == spark.sparkContext.defaultParallelism
    assert T.barrier_tasks(spark, T.GATHERED_BYTES // 22) == 2 and T.barrier_tasks(spark, T.GATHERED_BYTES) == 0
    assert T.state_length(16, SMALL) == sum(int(np.prod(s)) for s in T._state_shapes(T.initial_model(weighted(spark), 16, SMALL, 3)))


def test_start_vectors_are_different_while_there_are_any(spark):
    rnd = np.random.default_rng(4)
    twelve = rnd.normal(0.0, 1.0, (12, 6))
    rows = twelve[np.r_[np.zeros(200, int), rnd.integers(0, 12, 388), np.arange(12)]]
    table = vectors(spark, rows).repartition(5).persist()
    few = T.spread_centres(table, "content_embedding", [], 8, 3)
    assert len(np.unique(few, axis=0)) == 8
    many = T.spread_centres(table, "content_embedding", [], 16, 3)
    assert many.shape == (16, 6) and len(np.unique(many, axis=0)) == 12
    again = T.spread_centres(vectors(spark, rows).repartition(2), "content_embedding", [], 8, 3)
    np.testing.assert_array_equal(few, again)
    after = T.spread_centres(table, "content_embedding", [few], 16, 3)
    assert len(np.unique(after, axis=0)) == len(np.unique(T.quantize_rows(rows, [few])[1][-1], axis=0))
    with pytest.raises(ValueError):
        T.spread_centres(table.where("product_id < 0"), "content_embedding", [], 4, 3)


def test_a_spread_start_finds_far_clusters(spark):
    """Sixteen clusters of very different sizes: a start by hash misses the small ones."""
    rnd = np.random.default_rng(9)
    centres = rnd.normal(0.0, 50.0, (16, 4))
    rows = np.concatenate([c + rnd.normal(0.0, 0.1, (600 if i < 2 else 5, 4)) for i, c in enumerate(centres)])
    table = vectors(spark, rows).persist()
    errors = [T.fit_codebooks(table, "content_embedding", 16, 1, 1, 5, start=start)[2][0]["sse"] for start in ("spread", "rows")]
    assert errors[0] < 0.01 * errors[1]
