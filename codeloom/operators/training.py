"""Training as Spark jobs: k-means start, averaged updates, dead-code reset, early stop.

The driver holds the model (widths, a few MB) and never a row. Each job broadcasts the model, every
task reduces its rows to one state of that size, and Spark adds the states block by block.
"""

from __future__ import annotations

import base64
import hashlib
import math
from dataclasses import asdict, dataclass, replace
from itertools import groupby, repeat

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext, StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeloom.functions.arrays import list_of, matrix_of
from codeloom.functions.kernels import (
    adamw,
    batch_step,
    code_sums,
    codebooks_from,
    ema_codebooks,
    fresh_weights,
    nearest,
    quantize_rows,
    run_layers,
)
from codeloom.functions.names import EMBEDDING, PRODUCT_ID
from codeloom.functions.scalars import leading_bits, seeded_md5, seeded_uniform
from codeloom.operators.quantize import Artifact, encode
from codeloom.operators.ranking import first_in_group
from codeloom.operators.resume import arrays_digest, fingerprint, last_epoch, rows_checksum, save_epoch
from codeloom.operators.sampling import resample_copies, thin, uniform_sample
from codeloom.params import QuantizerParams, TrainParams
from codeloom.session import stored

BLOCK = 4096
# What the tasks of a barrier stage may send each other in one step, all together.
GATHERED_BYTES = 64 << 20
DOUBLES = T.ArrayType(T.DoubleType())


# ---- sums of vectors by key -------------------------------------------------------------


def add_vectors(partials: DataFrame, key: str, vector: str, *sums: str) -> DataFrame:
    """Element-wise sum of the vectors of each key, in the JVM."""
    total = Summarizer.sum(array_to_vector(F.col(vector)))
    return partials.groupBy(key).agg(
        vector_to_array(total).alias(vector), *[F.sum(name).alias(name) for name in sums]
    )


def _sum_states(partials: DataFrame) -> np.ndarray:
    """Sum of equally long state vectors that came in as numbered blocks."""
    rows = add_vectors(partials, "block", "values").collect()
    return np.concatenate([np.asarray(r["values"]) for r in sorted(rows, key=lambda r: r["block"])])


def _state_blocks(state: np.ndarray) -> pa.RecordBatch:
    starts = range(0, len(state), BLOCK)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.arange(len(starts), dtype=np.int32)),
            pa.array([state[s : s + BLOCK] for s in starts], type=pa.list_(pa.float64())),
        ],
        names=["block", "values"],
    )


STATE_SCHEMA = T.StructType(
    [T.StructField("block", T.IntegerType()), T.StructField("values", DOUBLES)]
)


def _pack(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.asarray(p, dtype=np.float64).reshape(-1) for p in parts])


def _unpack(flat: np.ndarray, shapes: list[tuple[int, ...]]) -> list[np.ndarray]:
    out, at = [], 0
    for shape in shapes:
        size = int(np.prod(shape)) if shape else 1
        out.append(flat[at : at + size].reshape(shape))
        at += size
    return out


# ---- k-means on one level ---------------------------------------------------------------


def code_partials(df: DataFrame, column: str, books: list[np.ndarray]) -> DataFrame:
    """Rows (code, vec, n, sse) of the last of `books`, at most W per task.

    `vec` sums the residuals that reach the last level, so sum(vec) / sum(n) is the new centre.
    """
    model = df.sparkSession.sparkContext.broadcast(books)
    width, dim = books[-1].shape

    def reduce_rows(batches):
        earlier, last = model.value[:-1], model.value[-1]
        count, total, error = np.zeros(width), np.zeros((width, dim)), np.zeros(width)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = matrix_of(batch.column(0))
            rows = quantize_rows(rows, earlier)[1][-1]
            code, distance = nearest(rows, last)
            n, s = code_sums(rows, code, width)
            count += n
            total += s
            error += np.bincount(code, weights=distance, minlength=width)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(used.astype(np.int32)),
                list_of(total[used]),
                pa.array(count[used]),
                pa.array(error[used]),
            ],
            names=["code", "vec", "n", "sse"],
        )

    schema = "code int, vec array<double>, n double, sse double"
    return df.select(column).mapInArrow(reduce_rows, schema)


def lloyd_step(df: DataFrame, column: str, books: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, float]:
    """One k-means iteration of the last level: new centres, row counts, squared error before it.

    A code without rows keeps its centre.
    """
    centres = books[-1].copy()
    counts = np.zeros(len(centres))
    error = 0.0
    for row in add_vectors(code_partials(df, column, books), "code", "vec", "n", "sse").collect():
        centres[row["code"]] = np.asarray(row["vec"]) / row["n"]
        counts[row["code"]] = row["n"]
        error += row["sse"]
    return centres, counts, error


def starting_centres(
    df: DataFrame, column: str, books: list[np.ndarray], width: int, *seed: object, key: str = PRODUCT_ID,
    total: int | None = None,
) -> np.ndarray:
    """W different rows by seeded hash, as residuals after `books`; repeated if there are fewer rows."""
    picked = uniform_sample(df.select(key, column), width, *seed, key=key, total=total)
    hashed = picked.withColumn("hash_", seeded_md5(key, *seed)).orderBy("hash_", key)
    rows = np.asarray([row[column] for row in hashed.collect()], dtype=np.float64)
    if len(rows) == 0:
        raise ValueError("no rows to start the codebook from")
    rows = quantize_rows(rows, books)[1][-1]
    return rows[np.arange(width) % len(rows)]


def _first_of_race(
    df: DataFrame, column: str, books: list[np.ndarray], chosen: np.ndarray | None, draws: int, key: str, *seed: object
) -> np.ndarray:
    """Up to `draws` different residuals, drawn without replacement by squared distance to `chosen` (None: evenly).

    Every row runs an exponential race at the rate of its distance; the first ones are the draw. Equal vectors run as
    one, whose time is the earliest of its rows, so a vector counts with its rows. Each task keeps `draws` vectors.
    """
    shared = df.sparkSession.sparkContext.broadcast((books, chosen))

    def run(batches):
        earlier, known = shared.value
        times, held = np.zeros(0), None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = quantize_rows(matrix_of(batch.column(0)), earlier)[1][-1] + 0.0
            rate = np.ones(len(rows)) if known is None else nearest(rows, known)[1]
            lot = -np.log1p(-batch.column(1).to_numpy(zero_copy_only=False))
            last = times[-1] if len(times) == draws else np.inf
            able = np.flatnonzero(rate > 0)
            able = able[lot[able] / rate[able] <= last]
            both = np.r_[times, lot[able] / rate[able]]
            held = rows[able] if held is None else np.concatenate([held, rows[able]])
            order = np.argsort(both, kind="stable")
            both, held = both[order], np.ascontiguousarray(held[order])
            same = held.view(np.dtype((np.void, held.dtype.itemsize * held.shape[1]))).reshape(-1)
            first = np.sort(np.unique(same, return_index=True)[1])[:draws]
            times, held = both[first], held[first]
        if len(times):
            yield pa.RecordBatch.from_arrays([pa.array(times), list_of(held)], names=["time", "vec"])

    lots = df.select(column, seeded_uniform(key, *seed).alias("lot"))
    fastest = lots.mapInArrow(run, "time double, vec array<double>").groupBy("vec").agg(F.min("time").alias("time"))
    rows = fastest.orderBy("time", "vec").limit(draws).collect()
    return np.asarray([row["vec"] for row in rows], dtype=np.float64)


def _spread_choice(points: np.ndarray, weights: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Indices of up to `width` of the different `points`: drawn by weight and distance, the best of a few draws each time."""
    rng = np.random.default_rng(seed)
    trials = 2 + int(math.log(width))
    picked = [int(rng.choice(len(points), p=weights / weights.sum()))]
    gap = points - points[picked[0]]
    near = np.einsum("ij,ij->i", gap, gap)
    while len(picked) < min(width, len(points)):
        mass = weights * near
        options = rng.choice(len(points), trials, p=mass / mass.sum())
        gaps = points[None, :, :] - points[options][:, None, :]
        nearer = np.minimum(near, np.einsum("kij,kij->ki", gaps, gaps))
        best = int((nearer * weights).sum(axis=1).argmin())
        near = nearer[best]
        picked.append(int(options[best]))
    return np.asarray(picked)


def spread_centres(
    df: DataFrame, column: str, books: list[np.ndarray], width: int, *seed: object, key: str = PRODUCT_ID,
    rounds: int = 3,
) -> np.ndarray:
    """W different residuals after `books` that lie apart; repeated only if there are fewer different ones.

    One row, then `rounds` draws of W by squared distance to all chosen so far, one scan each; at most 1 + rounds * W
    candidates, weighted by the rows nearest to them, from which the driver picks W.
    """
    chosen = _first_of_race(df, column, books, None, 1, key, *seed, "start", 0)
    if len(chosen) == 0:
        raise ValueError("no rows to start the codebook from")
    for turn in range(1, rounds + 1):
        more = _first_of_race(df, column, books, chosen, width, key, *seed, "start", turn)
        if len(more) == 0:
            break
        chosen = np.concatenate([chosen, more])
    weights = np.ones(len(chosen))
    for row in code_partials(df, column, [*books, chosen]).groupBy("code").agg(F.sum("n").alias("n")).collect():
        weights[row["code"]] = max(1.0, row["n"])
    mixed = int.from_bytes(hashlib.md5(repr(seed).encode()).digest()[:8], "big")
    picked = chosen[_spread_choice(chosen, weights, width, mixed)]
    return picked[np.arange(width) % len(picked)]


def fit_codebooks(
    df: DataFrame, column: str, width: int, levels: int, iterations: int, seed: int, key: str = PRODUCT_ID,
    start: str = "rows",
) -> tuple[np.ndarray, np.ndarray, list[dict]]:
    """k-means level by level on the residuals of the level before.

    Returns codebooks, row counts per code, and the squared error of every iteration. `df` is read
    once per iteration, so hand in a table or a persisted sample. start: "rows" takes W rows by hash, "spread"
    different residuals that lie apart.
    """
    if start not in ("rows", "spread"):
        raise ValueError(f"unknown start {start!r}")
    books: list[np.ndarray] = []
    sizes, log = [], []
    total = df.count()
    for level in range(levels):
        if start == "spread":
            centres = spread_centres(df, column, books, width, seed, level + 1, key=key)
        else:
            centres = starting_centres(df, column, books, width, seed, level + 1, key=key, total=total)
        counts = np.zeros(width)
        for iteration in range(iterations):
            new, counts, error = lloyd_step(df, column, [*books, centres])
            log.append({"level": level + 1, "iteration": iteration, "sse": error})
            settled = np.array_equal(new, centres)
            centres = new
            if settled:
                break
        books.append(centres)
        sizes.append(counts)
    return np.stack(books), np.stack(sizes), log


# ---- usage, error pools, dead codes -----------------------------------------------------


def level_rows(df: DataFrame, artifact: Artifact, column: str = EMBEDDING, key: str = PRODUCT_ID) -> DataFrame:
    """One row per (row, level): code, squared distance and the residual that met the codebook."""
    model = df.sparkSession.sparkContext.broadcast((list(artifact.codebooks), artifact.weights))

    def run(batches):
        books, weights = model.value
        for batch in batches:
            if batch.num_rows == 0:
                continue
            z = run_layers(matrix_of(batch.column(1)), weights, "encoder")[-1]
            codes, residuals = quantize_rows(z, books)
            for level in range(len(books)):
                after = residuals[level + 1]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(np.full(batch.num_rows, level + 1, dtype=np.int32)),
                        pa.array(codes[:, level]),
                        pa.array(np.einsum("ij,ij->i", after, after)),
                        list_of(residuals[level]),
                    ],
                    names=["key", "level", "code", "distance", "residual"],
                )

    schema = T.StructType(
        [
            T.StructField(key, df.schema[key].dataType),
            T.StructField("level", T.IntegerType()),
            T.StructField("code", T.IntegerType()),
            T.StructField("distance", T.DoubleType()),
            T.StructField("residual", DOUBLES),
        ]
    )
    return df.select(key, column).mapInArrow(run, schema)


def high_error_pool(rows: DataFrame, pool_rows: int, key: str = PRODUCT_ID) -> DataFrame:
    """The rows with the largest quantization error of each level, ranked; ties by key."""
    ordered = rows.withColumn("closeness", -F.col("distance"))
    return first_in_group(ordered, ["level"], ["closeness", key], pool_rows).drop("closeness")


def dead_codes(usage: np.ndarray, threshold: float, relative: bool = True) -> np.ndarray:
    """Mask of codes used too little. Relative: against the fair share 1/W; else a plain share."""
    share = usage / max(float(usage.sum()), 1.0)
    return share < (threshold / len(usage) if relative else threshold)


def reset_dead(
    artifact: Artifact, sizes: np.ndarray, sums: np.ndarray, usage: np.ndarray,
    pools: dict[int, np.ndarray], threshold: float, relative: bool = True,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """Give each dead code a vector of the error pool; the running sum stays vector x size.

    Level numbers in `pools` start at 1. Returns codebooks, sizes, sums and the reset count per level.
    """
    books, sizes, sums = artifact.codebooks.copy(), sizes.copy(), sums.copy()
    done = []
    for level in range(len(books)):
        pool = pools.get(level + 1)
        dead = np.flatnonzero(dead_codes(usage[level], threshold, relative))
        if pool is None or len(pool) == 0 or len(dead) == 0:
            done.append(0)
            continue
        fresh = pool[np.arange(len(dead)) % len(pool)]
        typical = max(float(sizes[level].mean()), 1e-5)
        books[level][dead] = fresh
        sizes[level][dead] = typical
        sums[level][dead] = fresh * typical
        done.append(len(dead))
    return books, sizes, sums, done


def collect_pools(rows: DataFrame, pool_rows: int, key: str = PRODUCT_ID) -> dict[int, np.ndarray]:
    pools: dict[int, list] = {}
    for row in high_error_pool(rows, pool_rows, key).orderBy("level", "rank").collect():
        pools.setdefault(row["level"], []).append(row["residual"])
    return {level: np.asarray(vectors) for level, vectors in pools.items()}


# ---- one round --------------------------------------------------------------------------


@dataclass
class Model:
    """Everything a round changes. Sizes and sums belong together: sum = vector x size."""

    weights: dict[str, np.ndarray]
    m: dict[str, np.ndarray]
    v: dict[str, np.ndarray]
    step: int
    sizes: np.ndarray
    sums: np.ndarray
    books: np.ndarray

    def names(self) -> list[str]:
        return sorted(self.weights)

    def copy(self) -> Model:
        def same(d):
            return {k: a.copy() for k, a in d.items()}

        return Model(
            same(self.weights), same(self.m), same(self.v), self.step,
            self.sizes.copy(), self.sums.copy(), self.books.copy(),
        )

    def arrays(self, name: str) -> dict[str, np.ndarray]:
        """Every array under its own name, for a table."""
        parts = {"weights": self.weights, "m": self.m, "v": self.v}
        named = {f"{name}/{part}/{k}": a for part, d in parts.items() for k, a in d.items()}
        return named | {f"{name}/sizes": self.sizes, f"{name}/sums": self.sums, f"{name}/books": self.books}

    @staticmethod
    def from_arrays(name: str, arrays: dict[str, np.ndarray], step: int) -> Model:
        def part(label):
            start = f"{name}/{label}/"
            return {k.removeprefix(start): a for k, a in arrays.items() if k.startswith(start)}

        return Model(
            part("weights"), part("m"), part("v"), step, arrays[f"{name}/sizes"], arrays[f"{name}/sums"], arrays[f"{name}/books"]
        )


def _repeated(batch: pa.RecordBatch) -> np.ndarray:
    """Vectors of a batch, each as often as its copies say."""
    return np.repeat(matrix_of(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False), axis=0)


def gradient_sums(
    rows: DataFrame, model: Model, quantizer: QuantizerParams
) -> tuple[np.ndarray, dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Sums over all `rows` (vector, copies): (rows, reconstruction, quantization per level), gradients, code counts, code sums."""
    names, shapes = model.names(), _state_shapes(model)
    shared = rows.sparkSession.sparkContext.broadcast((model.weights, list(model.books)))
    beta = quantizer.beta
    length = sum(int(np.prod(s)) for s in shapes)

    def run(batches):
        weights, books = shared.value
        state = np.zeros(length)
        for batch in batches:
            x = _repeated(batch)
            if len(x) == 0:
                continue
            out = batch_step(x, weights, books, beta)
            head = np.array([len(x), out["reconstruction"], *out["quantization"]])
            state += _pack([head, *[out["gradients"][n] for n in names], out["counts"], out["sums"]])
        yield _state_blocks(state)

    total = _sum_states(rows.mapInArrow(run, STATE_SCHEMA))
    head, *rest = _unpack(total, shapes)
    return head, dict(zip(names, rest)), rest[len(names)], rest[len(names) + 1]


def gradient_round(rows: DataFrame, model: Model, quantizer: QuantizerParams, lr: float) -> dict[str, float]:
    """One exact step on all `rows` (vector, copies): Spark sums the gradients, the driver steps."""
    head, total, counts, sums = gradient_sums(rows, model, quantizer)
    n = head[0]
    if n == 0:
        return {"rows": 0.0, "loss": 0.0}
    model.step += 1
    adamw(model.weights, model.m, model.v, {name: g / n for name, g in total.items()}, model.step, lr)
    model.sizes, model.sums, model.books = ema_codebooks(
        model.sizes, model.sums, counts, sums, quantizer.gamma
    )
    loss = (head[1] + (1 + quantizer.beta) * head[2:].sum()) / n
    return {"rows": float(n), "loss": float(loss), "usage": counts}


def barrier_tasks(spark, state_length: int) -> int:
    """Tasks for `barrier_rounds`: at most the cores, and no more than may exchange their states. 0: no barrier stage here.

    Every task gets the states of all tasks through the driver, so their sum has a limit.
    """
    if spark.conf.get("spark.dynamicAllocation.enabled", "false") == "true":
        return 0  # Spark runs no barrier stage then
    # Eight bytes a number, in base64.
    return min(spark.sparkContext.defaultParallelism, GATHERED_BYTES // (11 * state_length))


def _state_shapes(model: Model) -> list[tuple[int, ...]]:
    """Head (rows, reconstruction, quantization per level), gradients by name, code counts, code sums."""
    levels, width, _ = model.books.shape
    return [(2 + levels,)] + [model.weights[n].shape for n in model.names()] + [(levels, width), model.books.shape]


def state_length(d_in: int, quantizer: QuantizerParams) -> int:
    """Numbers in the sums of one step."""
    weights = sum(a.size for a in fresh_weights(d_in, quantizer.d, 0).values())
    return 2 + quantizer.L + weights + quantizer.L * quantizer.W * (1 + quantizer.d)


def barrier_rounds(
    rows: DataFrame, model: Model, quantizer: QuantizerParams, lr: float, rounds: int, tasks: int, seed: int
) -> list[dict[str, object]]:
    """`gradient_round` for every slice 0 .. rounds - 1 of `rows` (vector, copies, key, slice), in one job.

    A barrier stage holds the rows by a seeded hash, each task's sorted by slice. After a slice all tasks gather
    the sums of all, add them in task order and take the same step; the first returns the model and
    what each step saw. If an executor is lost, Spark runs the whole stage again from the model broadcast.
    """
    names, shapes = model.names(), _state_shapes(model)
    shared = rows.sparkSession.sparkContext.broadcast(
        (model.weights, model.m, model.v, model.step, model.sizes, model.sums, model.books)
    )
    beta, gamma = quantizer.beta, quantizer.gamma
    length = sum(int(np.prod(shape)) for shape in shapes)

    def run(batches):
        context = BarrierTaskContext.get()
        weights, m, v, *rest = shared.value
        mine = Model({k: a.copy() for k, a in weights.items()}, {k: a.copy() for k, a in m.items()}, {k: a.copy() for k, a in v.items()}, *rest)
        seen = []

        def step(state: np.ndarray) -> None:
            told = context.allGather(base64.b64encode(state.tobytes()).decode("ascii"))
            total = np.zeros(length)
            for text in told:
                total += np.frombuffer(base64.b64decode(text))
            head, *parts = _unpack(total, shapes)
            counts, sums = parts[len(names)], parts[len(names) + 1]
            if head[0]:
                mine.step += 1
                adamw(mine.weights, mine.m, mine.v, {n: g / head[0] for n, g in zip(names, parts)}, mine.step, lr)
                mine.sizes, mine.sums, mine.books = ema_codebooks(mine.sizes, mine.sums, counts, sums, gamma)
            seen.append(np.concatenate([head, counts.reshape(-1)]))

        at, state = 0, np.zeros(length)
        for batch in batches:
            slices = batch.column(2).to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(np.diff(slices)) + 1), len(slices)]
            for begin, end in zip(edges, edges[1:]):
                if end == begin:
                    continue
                while at < slices[begin]:  # slices this task has no rows of are steps too
                    step(state)
                    at, state = at + 1, np.zeros(length)
                x = _repeated(batch.slice(begin, end - begin))
                if len(x):
                    out = batch_step(x, mine.weights, list(mine.books), beta)
                    head = np.array([len(x), out["reconstruction"], *out["quantization"]])
                    state += _pack([head, *[out["gradients"][n] for n in names], out["counts"], out["sums"]])
        while at < rounds:
            step(state)
            at, state = at + 1, np.zeros(length)
        if context.partitionId() == 0:
            arrays = [mine.weights[n] for n in names] + [mine.m[n] for n in names] + [mine.v[n] for n in names]
            yield _state_blocks(_pack([np.array([mine.step]), *arrays, mine.sizes, mine.sums, *seen]))

    mixed = seeded_md5(PRODUCT_ID, seed, "task")
    placed = rows.select(EMBEDDING, "copies", "slice", mixed.alias("place"), PRODUCT_ID)
    ordered = placed.repartition(tasks, "place").sortWithinPartitions("slice", "place", PRODUCT_ID)
    blocks = ordered.select(EMBEDDING, "copies", "slice").mapInArrow(run, STATE_SCHEMA, barrier=True).collect()
    if not blocks:  # no rows at all: Spark plans no stage
        return [{"rows": 0.0, "loss": 0.0, "usage": np.zeros(model.books.shape[:2])} for _ in range(rounds)]
    flat = np.concatenate([np.asarray(r["values"]) for r in sorted(blocks, key=lambda r: r["block"])])
    levels, width, _ = model.books.shape
    kinds = [(1,)] + [model.weights[n].shape for n in names] * 3 + [(levels, width), model.books.shape]
    kinds += [(2 + levels + levels * width,)] * rounds
    (step,), *parts = _unpack(flat, kinds)
    k = len(names)
    for i, group in enumerate((model.weights, model.m, model.v)):
        for name, array in zip(names, parts[i * k : (i + 1) * k]):
            group[name] = array.copy()
    model.step, model.sizes, model.sums = int(step), parts[3 * k].copy(), parts[3 * k + 1].copy()
    if any(head[0] for head in parts[3 * k + 2 :]):
        model.books = codebooks_from(model.sizes, model.sums)
    out = []
    for told in parts[3 * k + 2 :]:
        n, head = told[0], told[: 2 + levels]
        loss = (head[1] + (1 + beta) * head[2:].sum()) / n if n else 0.0
        out.append({"rows": float(n), "loss": float(loss), "usage": told[2 + levels :].reshape(levels, width)})
    return out


def local_round(
    rows: DataFrame, model: Model, quantizer: QuantizerParams, lr: float, batch_size: int, shards: int, seed: int
) -> dict[str, object]:
    """Every shard is stepped through in minibatches; Spark averages the states by row count.

    A row belongs to a shard, and has its place in it, by a seeded hash of its key. So neither the cores nor the
    files decide which rows form a batch.
    """
    names = model.names()
    # Plain dicts and arrays: a broadcast value is read without this package on the executors.
    shared = rows.sparkSession.sparkContext.broadcast(
        (model.weights, model.m, model.v, model.step, model.sizes, model.sums, model.books)
    )
    beta, gamma = quantizer.beta, quantizer.gamma
    levels, width, _ = model.books.shape
    shapes = [(3,), (levels, width)]
    shapes += [model.weights[n].shape for n in names] * 3
    shapes += [(levels, width), model.books.shape]
    length = sum(int(np.prod(s)) for s in shapes)

    def run(batches):
        weights, m, v, *rest = shared.value
        mine = Model({k: a.copy() for k, a in weights.items()}, {k: a.copy() for k, a in m.items()}, {k: a.copy() for k, a in v.items()}, *rest)
        loss, steps, seen = 0.0, 0, 0
        usage = np.zeros((levels, width))
        held, waiting = [], 0

        def step(x):
            nonlocal loss, steps, seen, usage
            out = batch_step(x, mine.weights, list(mine.books), beta)
            mine.step += 1
            scaled = {n: g / len(x) for n, g in out["gradients"].items()}
            adamw(mine.weights, mine.m, mine.v, scaled, mine.step, lr)
            mine.sizes, mine.sums, mine.books = ema_codebooks(
                mine.sizes, mine.sums, out["counts"], out["sums"], gamma
            )
            usage += out["counts"]
            loss += out["reconstruction"] + (1 + beta) * sum(out["quantization"])
            steps += 1
            seen += len(x)

        for batch in batches:
            x = _repeated(batch)
            held.append(x)
            waiting += len(x)
            while waiting >= batch_size:
                x = np.concatenate(held)
                step(x[:batch_size])
                held, waiting = [x[batch_size:]], len(x) - batch_size
        if waiting:
            step(np.concatenate(held))
        if not seen:
            return
        parts = [np.array([seen, loss, steps * seen]), usage]
        for group in (mine.weights, mine.m, mine.v):
            parts += [group[n] * seen for n in names]
        parts += [mine.sizes * seen, mine.sums * seen]
        yield _state_blocks(_pack(parts))

    def run_shards(batches):
        """A task may hold several shards, one after the other."""


        def pieces():
            for batch in batches:
                numbers = batch.column(2).to_numpy(zero_copy_only=False)
                edges = [0, *(np.flatnonzero(np.diff(numbers)) + 1), len(numbers)]
                for begin, end in zip(edges, edges[1:]):
                    if end > begin:
                        yield numbers[begin], batch.slice(begin, end - begin)

        for _, shard in groupby(pieces(), key=lambda piece: piece[0]):
            yield from run(batch for _, batch in shard)

    mixed = seeded_md5(PRODUCT_ID, seed, "shard")
    placed = rows.select(
        EMBEDDING, "copies", F.pmod(leading_bits(mixed, 13), F.lit(shards)).cast("int").alias("shard"), mixed.alias("place"), PRODUCT_ID
    )
    sorted_rows = placed.repartition(shards, "shard").sortWithinPartitions("shard", "place", PRODUCT_ID)
    partials = sorted_rows.select(EMBEDDING, "copies", "shard").mapInArrow(run_shards, STATE_SCHEMA)
    blocks = add_vectors(partials, "block", "values").collect()
    if not blocks:
        return {"rows": 0.0, "loss": 0.0, "usage": np.zeros((levels, width))}
    flat = np.concatenate([np.asarray(r["values"]) for r in sorted(blocks, key=lambda r: r["block"])])
    assert len(flat) == length
    head, usage, *rest = _unpack(flat, shapes)
    n = head[0]
    k = len(names)
    for at, group in enumerate((model.weights, model.m, model.v)):
        for i, name in enumerate(names):
            group[name] = rest[at * k + i] / n
    model.sizes, model.sums = rest[3 * k] / n, rest[3 * k + 1] / n
    model.books = codebooks_from(model.sizes, model.sums)
    model.step += max(1, round(head[2] / n))
    return {"rows": float(n), "loss": float(head[1] / n), "usage": usage}


def validation(df: DataFrame, artifact: Artifact, column: str = EMBEDDING) -> tuple[float, np.ndarray]:
    """Reconstruction error per element and the level-1 usage histogram, in one pass."""
    shared = df.sparkSession.sparkContext.broadcast((list(artifact.codebooks), artifact.weights))
    width = artifact.width

    def run(batches):
        books, weights = shared.value
        state = np.zeros(2 + width)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = matrix_of(batch.column(0))
            z = run_layers(x, weights, "encoder")[-1]
            codes, residuals = quantize_rows(z, books)
            miss = run_layers(z - residuals[-1], weights, "decoder")[-1] - x
            state[0] += len(x)
            state[1] += float((miss * miss).sum()) / x.shape[1]
            state[2:] += np.bincount(codes[:, 0], minlength=width)
        yield _state_blocks(state)

    total = _sum_states(df.select(column).mapInArrow(run, STATE_SCHEMA))
    n = total[0]
    return (float(total[1] / n) if n else float("nan")), total[2:]


# ---- the whole run ----------------------------------------------------------------------


@dataclass(frozen=True)
class EpochStats:
    epoch: int
    train_loss: float
    val_reconstruction: float
    val_dead_code_rate: float
    val_normalized_utilization: float
    dead_codes_reset: list[int]


HISTORY_SCHEMA = (
    "epoch int, train_loss double, val_reconstruction double, val_dead_code_rate double, "
    "val_normalized_utilization double, dead_codes_reset array<int>"
)


def history_frame(spark, history: list[EpochStats]) -> DataFrame:
    return spark.createDataFrame([tuple(asdict(h).values()) for h in history], HISTORY_SCHEMA)


def _usage_summary(counts: np.ndarray) -> tuple[float, float]:
    share = counts[counts > 0] / max(counts.sum(), 1.0)
    effective = float(np.exp(-(share * np.log(share)).sum())) if len(share) else 0.0
    return float((counts == 0).mean()), effective / len(counts)


def initial_model(
    probe: DataFrame, d_in: int, quantizer: QuantizerParams, seed: int, warm_start: Artifact | None = None
) -> Model:
    """Fresh weights and k-means codebooks on the latent rows of a probe, or a prior artifact."""
    shape = (quantizer.L, quantizer.W, quantizer.d)
    if warm_start is not None:
        if warm_start.codebooks.shape != shape or warm_start.d_in != d_in or not warm_start.weights:
            raise ValueError("the warm-start artifact has other shapes than this run")
        weights = {k: a.copy() for k, a in warm_start.weights.items()}
        books = warm_start.codebooks.copy()
        sizes = np.ones(shape[:2])
    else:
        weights = fresh_weights(d_in, quantizer.d, seed)
        books = np.random.default_rng(seed + 1).normal(0.0, 0.01, shape)
        sizes = np.ones(shape[:2])
        if quantizer.kmeans_init:
            start = Artifact(codebooks=books, weights=weights, d_in=d_in)
            latent = encode(probe, start).select(PRODUCT_ID, "latent")
            if quantizer.init_probe_rows is not None:  # a sorted sample is one partition
                latent = latent.repartition(max(1, quantizer.init_probe_rows // 4096), PRODUCT_ID)
            latent = latent.persist(StorageLevel.MEMORY_AND_DISK)
            books, counts, _ = fit_codebooks(
                latent, "latent", quantizer.W, quantizer.L, quantizer.kmeans_iterations, seed,
                start=quantizer.kmeans_start,
            )
            latent.unpersist()
            sizes = np.full(shape[:2], max(float(counts[0].sum()) / quantizer.W, 1e-5))
    zeros = {k: np.zeros_like(a) for k, a in weights.items()}
    return Model(
        weights, zeros, {k: np.zeros_like(a) for k, a in weights.items()}, 0,
        sizes, books * sizes[:, :, None], books,
    )


def sliced_rows(train: DataFrame, seed: int, rounds: int) -> DataFrame:
    """Key, vector and weight with the slice a row belongs to, by seeded hash."""
    columns = train.select(PRODUCT_ID, EMBEDDING, "sample_weight")
    if rounds == 1:
        return columns.withColumn("slice", F.lit(0))
    mixed = leading_bits(seeded_md5(PRODUCT_ID, seed, "slice"), 13)
    sliced = columns.withColumn("slice", F.pmod(mixed, F.lit(rounds)).cast("int"))
    spread = F.pmod(F.shiftright(mixed, 24), F.lit(64))
    return sliced.repartition("slice", spread)


def probe_rows(table: DataFrame, rows: int | None, total: int, *seed: object) -> DataFrame:
    """All rows, or a uniform sample of the whole table if a number is asked for."""
    named = table.select(PRODUCT_ID, EMBEDDING)
    return named if rows is None else uniform_sample(named, rows, *seed, total=total)


def train_quantizer(
    train: DataFrame,
    val: DataFrame,
    d_in: int,
    quantizer: QuantizerParams = QuantizerParams(),
    training: TrainParams = TrainParams(),
    warm_start: Artifact | None = None,
    state_path: str | None = None,
) -> tuple[Artifact, list[EpochStats]]:
    """Train on prepared rows with `sample_weight`; returns the best state by validation error.

    With a `state_path` every epoch is written there, and a run with the same rows, settings (but for the number of epochs and
    the patience) and start goes on after the last complete one.
    """
    if quantizer.d >= d_in:
        raise ValueError("the latent width d must stay below the embedding width")
    weights = [F.count(F.lit(1)).alias("n"), F.sum("sample_weight").alias("w")]
    totals = train.agg(*weights).first()
    if training.sample_rows and totals["n"] > training.sample_rows:
        train = thin(train, training.sample_rows / totals["n"], training.seed, "sample")
        totals = train.agg(*weights).first()
    if not totals["n"]:
        raise ValueError("no training rows")
    per_round = training.batch_size if training.mode == "sync" else training.rows_per_round
    rounds = max(1, math.ceil(totals["n"] / per_round))
    tasks = 0
    if training.mode == "sync":
        tasks = barrier_tasks(train.sparkSession, state_length(d_in, quantizer))
    # One job per round reads its own folder; one job per epoch reads all rows.
    layout = ["slice"] if rounds > 1 and not tasks else None
    with stored(sliced_rows(train, training.seed, rounds), "train", layout) as table:
        with stored(val.select(PRODUCT_ID, EMBEDDING), "val") as held_out:
            state = None
            if state_path:
                sums = [
                    table.agg(rows_checksum(PRODUCT_ID, EMBEDDING, "sample_weight")).first()[0],
                    held_out.agg(rows_checksum(PRODUCT_ID, EMBEDDING)).first()[0],
                ]
                settings = {k: v for k, v in asdict(training).items() if k not in ("max_epochs", "patience")}
                start = warm_start and arrays_digest({"": warm_start.codebooks, **warm_start.weights})
                name = fingerprint(sums, totals["n"], rounds, d_in, asdict(quantizer), settings, start)
                state = f"{state_path.rstrip('/')}/run={name}"
            return _epochs(
                table, held_out, totals["n"], totals["w"], rounds, d_in, quantizer, training, warm_start, state, tasks
            )


def _epochs(
    table: DataFrame, held_out: DataFrame, n_rows: int, weight_sum: float, rounds: int, d_in: int,
    quantizer: QuantizerParams, training: TrainParams, warm_start: Artifact | None, state: str | None,
    tasks: int = 0,
) -> tuple[Artifact, list[EpochStats]]:
    spark = table.sparkSession
    before = last_epoch(spark, state) if state else None
    history: list[EpochStats] = []
    if before is None:
        probe = probe_rows(table, quantizer.init_probe_rows, n_rows, training.seed, "init")
        model = initial_model(probe, d_in, quantizer, training.seed, warm_start)
        best, best_error, stale = model.copy(), float("inf"), 0
    else:
        arrays, facts = before
        model, best = (Model.from_arrays(name, arrays, facts[f"{name}_step"]) for name in ("model", "best"))
        best_error, stale = facts["best_error"], facts["stale"]
        history = [EpochStats(**h) for h in facts["history"]]

    # In local mode one step of all shards together covers batch_size rows.
    local_batch = max(1, training.batch_size // training.shards)

    def frozen(state: Model) -> Artifact:
        return Artifact(codebooks=state.books, weights=state.weights, d_in=d_in)

    def one_round(epoch: int, part: int) -> dict[str, object]:
        drawn = resample_copies(table.where(F.col("slice") == part), n_rows, weight_sum, training.seed, epoch)
        rows = drawn.where("copies > 0").select(EMBEDDING, "copies", PRODUCT_ID)
        if training.mode == "sync":
            return gradient_round(rows, model, quantizer, training.lr)
        return local_round(
            rows, model, quantizer, training.lr, local_batch, training.shards, training.seed + 7919 * epoch + part
        )

    for epoch in range(len(history), training.max_epochs):
        if stale and stale >= training.patience:
            break
        usage = np.zeros(model.books.shape[:2])
        losses = []
        if tasks:
            drawn = resample_copies(table, n_rows, weight_sum, training.seed, epoch)
            rows = drawn.where("copies > 0").select(EMBEDDING, "copies", "slice", PRODUCT_ID)
            steps = barrier_rounds(rows, model, quantizer, training.lr, rounds, tasks, training.seed)
        else:
            steps = map(one_round, repeat(epoch), range(rounds))
        for out in steps:
            if out["rows"]:
                losses.append((out["loss"], out["rows"]))
                usage += out["usage"]

        reset = [0] * quantizer.L
        if quantizer.dead_code_reset and (epoch + 1) % quantizer.dead_code_reset_every == 0:
            limit, relative = quantizer.dead_code_reset_threshold, quantizer.dead_threshold_relative
            if any(dead_codes(level, limit, relative).any() for level in usage):
                probe = probe_rows(table, quantizer.reset_probe_rows, n_rows, training.seed, "reset", epoch)
                # No level can use more rows than it has codes.
                pool_rows = min(quantizer.W, quantizer.reset_pool_rows or quantizer.W)
                pools = collect_pools(level_rows(probe, frozen(model)), pool_rows)
                model.books, model.sizes, model.sums, reset = reset_dead(
                    frozen(model), model.sizes, model.sums, usage, pools, limit, relative
                )

        error, counts = validation(held_out, frozen(model))
        dead_rate, utilization = _usage_summary(counts)
        weight = sum(n for _, n in losses) or 1.0
        history.append(
            EpochStats(epoch, sum(l * n for l, n in losses) / weight, error, dead_rate, utilization, reset)
        )
        if error < best_error - training.min_delta:
            best, best_error, stale = model.copy(), error, 0
        else:
            stale += 1
        if state:
            facts = {
                "model_step": model.step, "best_step": best.step, "best_error": best_error, "stale": stale,
                "history": [asdict(h) for h in history],
            }
            save_epoch(spark, state, epoch, model.arrays("model") | best.arrays("best"), facts)
    artifact = replace(
        frozen(best),
        metadata={"trained_epochs": str(len(history)), "best_val_reconstruction": repr(best_error)},
    )
    return artifact, history
