"""Near-duplicate vectors by a subspace pigeonhole join (operator 2).

For unit vectors, cosine >= c means a squared distance of at most 2 - 2c. The vectors are turned by a fixed random
rotation and cut into `parts` blocks of neighbouring dimensions; a pair within the whole budget is within the
block's share of it, in proportion to its dimensions, in at least one block. So each block is joined on its own by
range: a block's space is cut at zero along its first axes, every vector has a home cell and visits those cells that
a ball of the block's radius around it touches. Inside a cell both sides are sorted along one more axis, and only
vectors within the radius on it are compared. Candidates are confirmed with the whole vectors in double
precision. A pair counts in the first block that finds it, so the union needs no further pass over the pairs: tasks
return the number of links of each vector and a spanning forest of the links they found, never the pairs.

Equal vectors are joined once, as one with a weight. A cell with more vectors at home than a task should hold is dealt
out by a hash; what visits it streams past each part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeloom.llm.minhash import forest
from codeloom.llm.shared import components, saved

COSINE = 0.95
PARTS = 8
HOME_ROWS = 2048
CELL_ROWS = 4096
MOST_AXES = 6
#: Visitors, in order of an axis, that are compared at once with the home vectors around them.
STRIP = 128
SEED = 7
#: Slack of the single-precision filters; the decisions are made in double precision.
SLACK = 1e-5


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """An orthogonal matrix that depends on the seed only."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def cuts(dim: int, parts: int) -> np.ndarray:
    return np.linspace(0, dim, min(parts, dim) + 1).round().astype(int)


def unit(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    if not len(v):
        return v
    big = np.abs(v).max(axis=1, keepdims=True)
    v = v / big
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def visited(first: np.ndarray, radius2: float) -> list[int]:
    """Cells, as bits of the signs of the first axes, that a ball around a point touches; home comes first."""
    home = int(((first >= 0) << np.arange(len(first))).sum())
    found = [(home, 0.0)]
    for axis, cost in enumerate(first * first):
        if cost <= radius2:
            found += [(cell ^ (1 << axis), spent + cost) for cell, spent in found if spent + cost <= radius2]
    return [cell for cell, _ in found]


def lifted(points: np.ndarray, left: bool) -> np.ndarray:
    """Points with two more components, so that a left times a right one is their squared distance."""
    squares, ones = (points * points).sum(axis=1), np.ones(len(points))
    parts = [-2 * points, squares[:, None], ones[:, None]] if left else [points, ones[:, None], squares[:, None]]
    return np.concatenate(parts, axis=1).astype(np.float32)


def clean_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """Representatives of equal usable vectors: rep, weight, values."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    usable = F.col(vector).isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    plain = F.transform(v, lambda x: x + F.lit(0.0))  # no negative zeros
    return rows.where(usable & F.col(key).isNotNull()).groupBy(plain.alias("v")).agg(
        F.min(F.col(key).cast("long")).alias("rep"), F.count(F.lit(1)).alias("weight")
    )


def joined(reps: DataFrame, kind: str, dim: int, n: int, cosine: float, parts: int, home_rows: int, cell_rows: int) -> DataFrame:
    """Rows (a, b, links): edges of forests with null links, and link counts of a with null b, from every task.

    kind: the type of the components as given, "<f4" or "<f8"; so they travel.
    """
    edges = cuts(dim, parts)
    axes = max(1, min(MOST_AXES, math.ceil(math.log2(max(2, n / cell_rows)))))
    budget = 2 - 2 * cosine
    turn = rotation(dim)
    share = [budget * (b - a) / dim + SLACK for a, b in zip(edges, edges[1:])]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids, weights = part.column(0).to_pylist(), part.column(1).to_pylist()
                given = np.array(part.column(2).to_pylist()).astype(kind)
                turned = unit(given) @ turn
                out = []
                for i, vec in enumerate(ids):
                    raw = given[i].tobytes()
                    for block, (a, b) in enumerate(zip(edges, edges[1:])):
                        cells = visited(turned[i, a : min(b, a + axes)], share[block])
                        out.append((block, cells[0], 0, vec, weights[i], raw))
                        out += [(block, cell, 1, vec, weights[i], raw) for cell in cells]
                cols = list(zip(*out))
                kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, kinds)], names=["block", "cell", "side", "vec", "weight", "raw"]
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task's rows come sorted by cell and side: first those at home, then the visitors in batches.
        state = {"cell": None}

        def close() -> Iterator[pa.RecordBatch]:
            if state["cell"] is not None and state.get("counts") is not None:
                hit = np.flatnonzero(state["counts"])
                ends = state["forest"]
                a = np.r_[state["ids"][hit], np.array([e[0] for e in ends], np.int64)]
                b = pa.array([None] * len(hit) + [e[1] for e in ends], pa.int64())
                links = pa.array([*state["counts"][hit].tolist(), *[None] * len(ends)], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), b, links], names=["a", "b", "links"])

        def start(cell) -> None:
            state.clear()
            state.update(cell=cell, home=[], ids=None, counts=None, forest=[])

        def settle() -> None:
            if state["ids"] is None:
                state["ids"] = np.array([h[0] for h in state["home"]], np.int64)
                state["u"] = unit(np.frombuffer(b"".join([h[1] for h in state["home"]]), kind).reshape(-1, dim))
                block = state["cell"][0]
                a, b = edges[block], edges[block + 1]
                turned = state["u"] @ turn
                # In order of the block's last axis, which is cut into cells last of all, if at all.
                line = np.argsort(turned[:, b - 1], kind="stable")
                state["ids"], state["u"], state["t"] = state["ids"][line], state["u"][line], turned[line]
                state["line"], state["x"] = state["t"][:, b - 1].copy(), lifted(state["t"][:, a:b], left=True)
                state["home"] = None
                state["forest"], state["parent"] = [], {}
                state["counts"] = np.zeros(len(state["ids"]), np.int64)

        def visit(ids: np.ndarray, weights: np.ndarray, u: np.ndarray) -> None:
            """Links of the vectors at home with visitors, found in this block and in none before it."""
            settle()
            if not len(state["ids"]):
                return
            block = state["cell"][0]
            t = u @ turn
            a, b = edges[block], edges[block + 1]
            reach, limit = math.sqrt(share[block] + 2 * SLACK), np.float32(share[block] + 2 * SLACK)
            y, line = lifted(t[:, a:b], left=False), t[:, b - 1]
            order = np.argsort(line, kind="stable")
            i, j = [], []
            for low in range(0, len(order), STRIP):
                strip = order[low : low + STRIP]
                # Only home vectors within the block's radius along the axis can be near one of the strip.
                first = np.searchsorted(state["line"], line[strip[0]] - reach, "left")
                last = np.searchsorted(state["line"], line[strip[-1]] + reach, "right")
                if first < last:
                    p, q = np.nonzero(state["x"][first:last] @ y[strip].T <= limit)
                    i.append(p + first)
                    j.append(strip[q])
            if not i:
                return
            i, j = np.concatenate(i), np.concatenate(j)
            for low in range(0, len(i), 1 << 16):
                p, q = i[low : low + (1 << 16)], j[low : low + (1 << 16)]
                p, q = (z[state["ids"][p] != ids[q]] for z in (p, q))
                cos = np.einsum("ij,ij->i", state["u"][p], u[q])
                good = cos >= cosine
                p, q = p[good], q[good]
                # The order of the ends must not matter, so that both count the pair in the same block.
                square = (state["t"][p] - t[q]) ** 2
                sums = np.add.reduceat(square, edges[:-1], axis=1) <= np.array(share)
                good = sums.argmax(1) == block
                p, q = p[good], q[good]
                np.add.at(state["counts"], p, weights[q])
                union(p, ids[q])

        def union(p: np.ndarray, other: np.ndarray) -> None:
            """Adds edges that join what the forest of this cell has not joined."""
            parent = state["parent"]

            def top(x):
                while parent.setdefault(x, x) != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            mine = state["ids"][p]
            for x, y in zip(mine.tolist(), other.tolist()):
                rx, ry = top(x), top(y)
                if rx != ry:
                    parent[max(rx, ry)] = min(rx, ry)
                    state["forest"].append((x, y))

        for batch in batches:
            cells = list(zip(*[batch.column(c).to_pylist() for c in range(3)]))
            sides = np.array(batch.column(3).to_pylist(), np.int64)
            ids, weights, raws = (batch.column(c) for c in (4, 5, 6))
            at = 0
            while at < len(cells):
                if cells[at] != state["cell"]:
                    yield from close()
                    start(cells[at])
                end = at
                while end < len(cells) and cells[end] == cells[at] and sides[end] == sides[at]:
                    end += 1
                for low in range(at, end, 2048):
                    size = min(2048, end - low)
                    part = [c.slice(low, size) for c in (ids, weights, raws)]
                    if sides[at] == 0:
                        state["home"] += zip(part[0].to_pylist(), part[2].to_pylist())
                    else:
                        u = unit(np.frombuffer(b"".join(part[2].to_pylist()), kind).reshape(-1, dim))
                        visit(part[0].to_numpy(), part[1].to_numpy(), u)
                at = end
        yield from close()

    placed = reps.select("rep", "weight", "v").mapInArrow(
        place, "block int, cell int, side int, vec long, weight long, raw binary"
    )
    salts = (
        placed.where("side = 0").groupBy("block", "cell").agg(F.ceil(F.count(F.lit(1)) / home_rows).cast("int").alias("salts"))
    )  # at most parts * 2^axes rows
    cell = placed.join(F.broadcast(salts), ["block", "cell"])
    hashed = F.array(F.pmod(F.xxhash64("vec"), F.col("salts")).cast("int"))
    dealt = cell.withColumn("salt", F.explode(F.when(F.col("side") == 0, hashed).otherwise(F.sequence(F.lit(0), F.col("salts") - 1))))
    dealt = dealt.select("block", "cell", "salt", "side", "vec", "weight", "raw")
    return (
        dealt.repartition("block", "cell", "salt").sortWithinPartitions("block", "cell", "salt", "side")
        .mapInArrow(compare, "a long, b long, links long")
    )


def near_vectors(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE, parts: int = PARTS,
    home_rows: int = HOME_ROWS, cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Key, n_links, component_id and kept of every row.

    Two rows are linked if the cosine of their vectors, in double precision, is at least `cosine`. Vectors that are
    null, empty, all zero, or hold a null, NaN or infinite component have no links; vectors of different lengths are
    compared within their length. Rows with a null key have no links and are kept. Rows with equal keys count as
    different vectors under one name. Other columns are ignored.
    """
    reps = saved(clean_vectors(rows, key, vector), "vectors")
    sizes = {r["dim"]: r["n"] for r in reps.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")).collect()}
    kind = "<f4" if rows.schema[vector].dataType.elementType.simpleString() == "float" else "<f8"
    found = None
    for dim, n in sorted(sizes.items()):
        part = joined(reps.where(F.size("v") == dim), kind, dim, n, cosine, parts, home_rows, cell_rows)
        found = part if found is None else found.unionByName(part)
    ids = rows.select(F.col(key).alias("id"), F.transform(F.col(vector), lambda x: x.cast("double") + F.lit(0.0)).alias("v"))
    if found is None:
        return ids.select(F.col("id").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("id").cast("long").alias("component_id"), F.lit(True).alias("kept"))
    found = saved(found, "links")
    counts = found.where("links is not null").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    tree = components(found.where("b is not null").select("a", "b")).select(F.col("id").alias("rep"), "component_id")
    known = reps.join(counts, "rep", "left").join(tree, "rep", "left").select(
        F.col("v"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component_id", "rep").alias("component_id")
    )
    own = F.col("id").cast("long")
    linked = F.col("id").isNotNull()
    out = ids.join(known, "v", "left").select(
        F.col("id").alias(key), F.when(linked, F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).alias("n_links"),
        F.when(linked, F.coalesce("component_id", own)).alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("component_id") == F.col(key), F.lit(True)))
