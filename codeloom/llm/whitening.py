"""Whitening of embeddings by FEAST contour integration (operator 13).

Entries become whole numbers, so that counts, sums and deviations are exact. The fit list holds each distinct vector
once; Spark adds its counts and sums, then the products of the centred vectors. Only those sums reach the driver: one
matrix as wide as the vectors are long, whatever the number of rows.

There the largest eigenvalues are found interval by interval. The inertia of V - sI (signs of the pivots of a symmetric
factorisation) counts the eigenvalues below s, so intervals with a few eigenvalues each are cut by bisection, with edges
where no eigenvalue is near. On an interval, Gauss-Legendre quadrature of the complex shifted solves (zI - V)^-1 Y along
a circle around it projects a random block Y onto the interval's eigenvectors, Rayleigh-Ritz extracts them, and the
projection is repeated until the residuals are at the rounding level. An interval is done only if it gave as many
components as its inertia counts say; else its block grows, at last to the whole space.

The whitened rows are one scan of the input with the components, 16 vectors, sent along.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeloom.session import stored

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
#: Entries from here on have no exact whole number after scaling.
TOO_LARGE = float(1 << 46)
NODES = 8
#: Eigenvalues that are worked on at once, unless they lie closer together than the edges can be told apart.
GROUP = 6
MOST_PASSES = 30
SEED = 11
BUNCH = (1 + math.sqrt(17)) / 8


# ---- eigenvectors of a symmetric matrix -------------------------------------------------


def eigenvalues_below(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are below `shift`: the negative pivots of a factorisation with complete pivoting."""
    a = matrix - shift * np.eye(len(matrix))
    below = 0
    while len(a):
        diagonal = np.abs(np.diagonal(a))
        off = np.abs(a)
        np.fill_diagonal(off, 0.0)
        single = int(diagonal.argmax())
        row, column = divmod(int(off.argmax()), len(a))
        if diagonal[single] >= BUNCH * off[row, column]:
            if not diagonal[single]:
                break  # what is left is zero
            pivot = [single]
            below += bool(a[single, single] < 0)
        else:
            pivot = [row, column]  # its determinant is negative, so one of its eigenvalues is
            below += 1
        rest = np.delete(np.arange(len(a)), pivot)
        beside = a[np.ix_(rest, pivot)]
        a = a[np.ix_(rest, rest)] - beside @ np.linalg.solve(a[np.ix_(pivot, pivot)], beside.T)
        a = (a + a.T) / 2
    return below


def intervals(matrix: np.ndarray, wanted: int) -> Iterator[tuple[float, float, int]]:
    """Intervals from the top that hold the `wanted` largest eigenvalues, each with its number of eigenvalues."""
    size = len(matrix)
    high = float(np.abs(matrix).sum(axis=1).max())
    margin = 1e-3 * high
    waiting = [(-high - margin, high + margin, 0, size)]  # low, high, eigenvalues below low and below high
    found = 0
    while waiting and found < wanted:
        low, top, under_low, under_top = waiting.pop()
        inside = under_top - under_low
        if not inside:
            continue
        if inside <= GROUP or top - low <= 1e-9 * high:
            found += inside
            yield low, top, inside
            continue
        edge = under_edge = None
        for share in (0.5, 0.4, 0.6, 0.3, 0.7, 0.45, 0.55, 0.35, 0.65):
            guess, near = low + share * (top - low), 1e-3 * (top - low)
            under_edge = eigenvalues_below(matrix, guess - near)
            edge = guess
            if under_edge == eigenvalues_below(matrix, guess + near):
                break  # no eigenvalue near the edge
        else:
            under_edge = eigenvalues_below(matrix, edge)
        waiting.append((low, edge, under_low, under_edge))
        waiting.append((edge, top, under_edge, under_top))


def project(matrix: np.ndarray, block: np.ndarray, low: float, high: float) -> np.ndarray:
    """The block's part in the eigenvectors of an interval, by quadrature of the resolvent on a circle around it."""
    centre, radius = (low + high) / 2, (high - low) / 2
    out = np.zeros_like(block)
    for node, weight in zip(*np.polynomial.legendre.leggauss(NODES)):
        turn = np.exp(0.5j * np.pi * (1 - node))  # the upper half; the lower one gives the conjugate
        solved = np.linalg.solve((centre + radius * turn) * np.eye(len(matrix)) - matrix, block.astype(complex))
        out += weight / 2 * (radius * turn * solved).real
    return out


def rayleigh_ritz(matrix: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    basis, _ = np.linalg.qr(block)
    values, turned = np.linalg.eigh(basis.T @ matrix @ basis)
    return values, basis @ turned


def inside_interval(matrix: np.ndarray, low: float, high: float, count: int) -> np.ndarray:
    """The `count` eigenvectors with eigenvalues between low and high, as columns."""
    size, norm = len(matrix), float(np.abs(matrix).sum(axis=1).max())
    columns = min(size, count + count // 2 + 4)
    start = np.random.default_rng(SEED).standard_normal((size, size))
    while True:
        block, before = start[:, :columns], math.inf
        for _ in range(MOST_PASSES):
            values, vectors = rayleigh_ritz(matrix, block if columns == size else project(matrix, block, low, high))
            if columns == size:
                chosen = np.sort(np.argsort(np.abs(values - (low + high) / 2))[:count])
                return vectors[:, chosen]
            chosen = (values > low) & (values < high)
            kept = vectors[:, chosen]
            residual = np.abs(matrix @ kept - kept * values[chosen]).max(initial=0.0)
            if chosen.sum() == count and (residual <= 1e-15 * norm or residual >= before / 2):
                if residual <= 1e-12 * norm:
                    return kept
                break
            before = residual if chosen.sum() == count else math.inf
            block = vectors
        columns = min(size, 2 * columns)  # the inertia says that some are missed


def largest_components(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors as columns; the largest entry of each is positive.

    Values that are zero up to rounding are returned as zero.
    """
    size = len(matrix)
    wanted = min(wanted, size)
    trace = float(np.trace(matrix))
    if not wanted or not np.abs(matrix).max() > 0:
        return np.zeros(wanted), np.eye(size)[:, :wanted]
    found = [inside_interval(matrix, *interval) for interval in intervals(matrix, wanted)]
    values, vectors = rayleigh_ritz(matrix, np.concatenate(found, axis=1))
    values, vectors = values[::-1][:wanted], vectors[:, ::-1][:, :wanted]
    vectors = vectors / np.sqrt((vectors * vectors).sum(axis=0))
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(wanted)])
    return np.where(values > size * 1e-14 * trace, values, 0.0), vectors * signs


# ---- sums by Spark ----------------------------------------------------------------------


def whole_numbers(df: DataFrame, vector: str, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """The rows with a usable vector, of one entry at least, and `x_`, its entries as whole numbers."""
    usable = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(TOO_LARGE / scale), F.lit(False)))
    numbers = F.transform(vector, lambda c: F.floor(c.cast("double") * scale) + F.lit(shift).cast("long"))
    return df.where(F.coalesce(usable & (F.size(vector) > 0), F.lit(False))).withColumn("x_", numbers)


def by_length(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, row numbers and matrix of the rows of each vector length."""
    lists = batch.column(column)
    lengths = np.diff(lists.offsets.to_numpy())
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        same = lists.take(pa.array(rows)) if len(rows) < len(lists) else lists
        yield int(length), rows, same.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), int(length))


def total_of(fit: DataFrame, step, shape) -> dict[int, np.ndarray]:
    """Sums over the fit list of the matrix that `step` makes of the rows of one length; the sums are as large as one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for length, _, x in by_length(batch, 0):
                made = step(length, x)
                sums[length] = sums[length] + made if length in sums else made
        for length, made in sums.items():
            cells = np.arange(made.size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(made.size, length, np.int32)), pa.array(cells), pa.array(made.reshape(-1))],
                names=["length", "cell", "value"],
            )

    kind = "long" if shape is None else "double"
    added = fit.mapInArrow(run, f"length int, cell long, value {kind}").groupBy("length", "cell").agg(F.sum("value").alias("value"))
    cells: dict[int, dict[int, float]] = {}
    for row in added.collect():
        cells.setdefault(row["length"], {})[row["cell"]] = row["value"]
    return {length: np.array([found[i] for i in range(len(found))]).reshape((-1,) if shape is None else shape(length)) for length, found in cells.items()}


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n as double; the whole part of the mean is taken off exactly."""
    whole = sums // n
    return (x - whole).astype(np.float64) - (sums - n * whole) / n


def fit_model(fit: DataFrame, components: int = COMPONENTS) -> dict[int, dict]:
    """Per vector length: n, sums, eigenvalues, eigenvectors, share of the variance, identity error.

    `fit` has one column of distinct whole-number vectors.
    """
    counted = total_of(fit, lambda length, x: np.concatenate([[len(x)], x.sum(axis=0)]).astype(np.int64), None)
    known = {length: (int(c[0]), c[1:].astype(np.int64)) for length, c in counted.items()}

    def products(length, x):
        y = centred(x, *known[length])
        return y.T @ y

    models = {}
    for length, total in total_of(fit, products, lambda length: (length, length)).items() if known else ():
        n, sums = known[length]
        covariance = total / n
        values, vectors = largest_components((covariance + covariance.T) / 2, components)
        trace = float(np.trace(covariance))
        models[length] = {
            "n": n, "sums": sums, "values": values, "vectors": vectors, "explained": values / trace if trace > 0 else np.zeros(len(values)),
            "scaled": np.where(values > 0, vectors / np.sqrt(np.where(values > 0, values, 1.0)), 0.0),
        }

    def whitened_products(length, x):
        model = models[length]
        w = np.concatenate([np.ones((len(x), 1)), centred(x, model["n"], model["sums"]) @ model["scaled"]], axis=1)
        return w.T @ w

    checked = total_of(fit, whitened_products, lambda length: (1 + min(components, length),) * 2) if models else {}
    for length, total in checked.items():
        total = total / models[length]["n"]
        covariance = total[1:, 1:] - np.outer(total[0, 1:], total[0, 1:])
        used = models[length]["values"] > 0
        models[length]["error"] = float(np.abs(covariance - np.eye(len(used)))[np.ix_(used, used)].max(initial=0.0))
    return models


def squared_deviation(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """Sum over the dimensions of (n x - sums)^2, exact."""
    whole = sums // n
    small, rest = x - whole, [int(s) for s in sums - n * whole]
    most = int(np.abs(small).max(initial=0)) * n + n
    if most * most * max(1, x.shape[1]) < 1 << 63:
        d = n * small - np.array(rest, dtype=np.int64)
        return pa.array((d * d).sum(axis=1)).cast(pa.decimal128(38, 0))
    from decimal import Decimal

    exact = [sum((n * a - b) ** 2 for a, b in zip(row, rest)) for row in small.tolist()]
    return pa.array([Decimal(v) if v < 10**38 else None for v in exact], pa.decimal128(38, 0))


def whiten(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT
) -> DataFrame:
    """Key, component, n, deviation, whitened, explained and identity_error: a row per usable vector and component.

    Vectors that are null or hold null, NaN, infinite or (beyond 2^46 after scaling) not exactly whole entries are left
    out. Vectors of different lengths are fitted apart. Equal vectors count once in the fit, but every row is returned,
    those with null or repeated keys too. A component without variance has whitened null and explained 0 and does not
    count in identity_error. Equal eigenvalues have any orthonormal basis of their space. Empty vectors have no
    component and give no row, nor does an empty table. Other columns are left out, whatever their names. A deviation
    is a decimal of 38 digits, null beyond them.
    """
    rows = whole_numbers(df.select(F.col(key).alias("key_"), F.col(vector).alias("vector_")), "vector_", scale, shift)
    with stored(rows.select("x_").distinct(), "whiten") as fit:
        models = fit_model(fit, components)
    model = df.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, at, x in by_length(batch, 1):
                m = model.value.get(length)
                count = len(m["values"]) if m else 0
                if not count:
                    continue
                white = (centred(x, m["n"], m["sums"]) @ m["scaled"]).reshape(-1)
                row = np.repeat(np.arange(len(at)), count)
                flat = np.tile(m["values"] <= 0, len(at))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(at[row])), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(at))),
                        pa.array(np.full(len(row), m["n"])), squared_deviation(x, m["n"], m["sums"]).take(pa.array(row)),
                        pa.array(white, mask=flat), pa.array(np.tile(m["explained"], len(at))), pa.array(np.full(len(row), m["error"])),
                    ],
                    names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    return rows.select("key_", "x_").mapInArrow(run, schema)
