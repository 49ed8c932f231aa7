"""Queries on the network path, with weights and codebooks that both engines compute from a formula."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom.functions.kernels import HIDDEN, layer_names
from codeloom.functions.names import EMBEDDING, PRODUCT_ID
from codeloom.functions.scalars import leading_bits, seeded_md5
from codeloom.operators import quantize as qz
from codeloom.operators import training as tr
from codeloom.params import QuantizerParams
from codeloom.workload.quantized import CODES, prepared, register
from codeloom.workload.relational import hashed, rounded
from codeloom.workload.views import DAMAGED_SQL, DIM, UNIT_SQL, VALID_SQL, with_sql

LATENT, WIDTH, DEPTH = 8, 16, 2
SIZES = {"encoder": (DIM, *HIDDEN, LATENT), "decoder": (LATENT, *HIDDEN[::-1], DIM)}
FIRST = {"encoder": 1, "decoder": 11}


def formula_model() -> qz.Artifact:
    """Sines of the indices, scaled by the fan in; codewords are cosines."""
    weights = {}
    for part, sizes in SIZES.items():
        for k, ((w, b), n_in, n_out) in enumerate(zip(layer_names(part), sizes, sizes[1:])):
            i, j, p = np.arange(n_in)[:, None], np.arange(n_out)[None, :], float(FIRST[part] + k)
            weights[w] = np.sin(p + i * 12.9898 + j * 78.233) / np.sqrt(float(n_in))
            weights[b] = np.cos(p + np.arange(n_out) * 3.7) * 0.1
    level, code, k = np.ogrid[1 : DEPTH + 1, 0:WIDTH, 0:LATENT]
    return qz.Artifact(codebooks=np.cos(level * 5.0 + code * 1.3 + k * 0.7) * 0.3, weights=weights, d_in=DIM)


def dense_sql(name: str, source: str, part: str, k: int) -> str:
    n_in, n_out = SIZES[part][k : k + 2]
    p = f"CAST({FIRST[part] + k} AS DOUBLE)"
    total = f"sum(x.x * w.w) + any_value(cos({p} + w.j * CAST(3.7 AS DOUBLE)) * CAST(0.1 AS DOUBLE))"
    if k + 1 < len(SIZES[part]) - 1:
        total = f"greatest(CAST(0 AS DOUBLE), {total})"
    return f"""{name} AS MATERIALIZED (SELECT x.product_id, w.j AS i, {total} AS x FROM {source} x JOIN (
        SELECT i, j, sin({p} + i * CAST(12.9898 AS DOUBLE) + j * CAST(78.233 AS DOUBLE)) / sqrt(CAST({n_in} AS DOUBLE)) AS w
        FROM range(0, {n_in}) AS a(i), range(0, {n_out}) AS b(j)) w ON x.i = w.i GROUP BY x.product_id, w.j)"""


def network_sql() -> list[str]:
    """CTEs latent, code1.., rest1.. and decoded."""
    parts = [DAMAGED_SQL, VALID_SQL, UNIT_SQL, f"e0 AS MATERIALIZED (SELECT product_id, i - 1 AS i, v[i] AS x FROM unit, range(1, {DIM + 1}) AS g(i))"]
    parts += [dense_sql(f"e{k + 1}", f"e{k}", "encoder", k) for k in range(3)]
    parts.append("rest0 AS MATERIALIZED (SELECT product_id, list(x ORDER BY i) AS v FROM e3 GROUP BY product_id)")
    for level in range(1, DEPTH + 1):
        parts.append(
            f"""book{level} AS MATERIALIZED (SELECT CAST(code AS INT) AS code, list(cos({level} * CAST(5 AS DOUBLE) + code * CAST(1.3 AS DOUBLE)
            + k * CAST(0.7 AS DOUBLE)) * CAST(0.3 AS DOUBLE) ORDER BY k) AS v FROM range(0, {WIDTH}) AS c(code), range(0, {LATENT}) AS d(k) GROUP BY code)"""
        )
        parts.append(
            f"""code{level} AS MATERIALIZED (SELECT product_id, arg_min(code, row(d, code)) AS code FROM
            (SELECT r.product_id, b.code, list_distance(r.v, b.v) AS d FROM rest{level - 1} r, book{level} b) GROUP BY product_id)"""
        )
        parts.append(
            f"""rest{level} AS MATERIALIZED (SELECT r.product_id, list_transform(list_zip(r.v, b.v), lambda t: t[1] - t[2]) AS v
            FROM rest{level - 1} r JOIN code{level} USING (product_id) JOIN book{level} b USING (code))"""
        )
    parts.append(
        f"""d0 AS MATERIALIZED (SELECT a.product_id, i - 1 AS i, a.v[i] - b.v[i] AS x
        FROM rest0 a JOIN rest{DEPTH} b USING (product_id), range(1, {LATENT + 1}) AS g(i))"""
    )
    parts += [dense_sql(f"d{k + 1}", f"d{k}", "decoder", k) for k in range(3)]
    parts.append("miss AS MATERIALIZED (SELECT product_id, i, d.x - e.x AS x FROM d3 d JOIN e0 e USING (product_id, i))")
    return parts


@register("encode_network", with_sql(*network_sql()[:7]) + "SELECT product_id, CAST(i AS INT) AS position, round(x, 6) AS value FROM e3")
def encode_network(spark: SparkSession, sf: str) -> DataFrame:
    latent = qz.encode(prepared(spark, sf), formula_model()).select(PRODUCT_ID, F.posexplode("latent").alias("position", "value"))
    return latent.withColumn("value", F.round("value", 6))


@register(
    "assign_network",
    with_sql(*network_sql()[:-5]) + "SELECT product_id, code1.code AS c1, code2.code AS c2 FROM code1 JOIN code2 USING (product_id)",
)
def assign_network(spark: SparkSession, sf: str) -> DataFrame:
    return qz.assign_codes(prepared(spark, sf), formula_model()).select(PRODUCT_ID, *CODES)


@register("decode_network", with_sql(*network_sql()) + "SELECT product_id, CAST(i AS INT) AS position, round(x, 6) AS value FROM d3")
def decode_network(spark: SparkSession, sf: str) -> DataFrame:
    decoded = qz.reconstruct(prepared(spark, sf), formula_model()).select(PRODUCT_ID, F.posexplode("decoded").alias("position", "value"))
    return decoded.withColumn("value", F.round("value", 6))


def fresh_model() -> tr.Model:
    start = formula_model()
    zeros = {k: np.zeros_like(a) for k, a in start.weights.items()}
    books = start.codebooks
    return tr.Model(dict(start.weights), zeros, dict(zeros), 0, np.ones(books.shape[:2]), books.copy(), books.copy())


def step_sums(spark: SparkSession, sf: str):
    model = fresh_model()
    rows = prepared(spark, sf).select(EMBEDDING, F.lit(1).alias("copies"))
    return tr.gradient_sums(rows, model, QuantizerParams(W=WIDTH, L=DEPTH, d=LATENT))


@register(
    "loss_network",
    with_sql(*network_sql())
    + f"""SELECT CAST(n AS DOUBLE) AS n, round(rec / n, 8) AS reconstruction, round(q1 / n, 8) AS quantization_1, round(q2 / n, 8) AS quantization_2,
      round((rec + CAST(1.25 AS DOUBLE) * (q1 + q2)) / n, 8) AS loss FROM (SELECT (SELECT count(*) FROM unit) AS n, (SELECT sum(x * x) / {DIM} FROM miss) AS rec,
      (SELECT sum(list_inner_product(v, v)) / {LATENT} FROM rest1) AS q1, (SELECT sum(list_inner_product(v, v)) / {LATENT} FROM rest2) AS q2)""",
)
def loss_network(spark: SparkSession, sf: str) -> DataFrame:
    """The loss terms of one batch of all rows."""
    head = step_sums(spark, sf)[0]
    n, rec, q1, q2 = (float(x) for x in head)
    row = (n, rec / n, q1 / n, q2 / n, (rec + 1.25 * (q1 + q2)) / n)
    return rounded(spark.createDataFrame([row], "n double, reconstruction double, quantization_1 double, quantization_2 double, loss double"))


@register(
    "gradient_network",
    with_sql(*network_sql())
    + f"SELECT CAST(i AS INT) AS position, round(CAST(2 AS DOUBLE) / {DIM} * sum(x) / (SELECT count(*) FROM unit), 8) AS gradient FROM miss GROUP BY i",
)
def gradient_network(spark: SparkSession, sf: str) -> DataFrame:
    """The gradient of the decoder's last offsets."""
    head, gradients, _, _ = step_sums(spark, sf)
    values = gradients[layer_names("decoder")[-1][1]] / head[0]
    return rounded(spark.createDataFrame([(i, float(x)) for i, x in enumerate(values)], "position int, gradient double"))


@register(
    "usage_network",
    with_sql(*network_sql()[:-5])
    + " UNION ALL ".join(f"SELECT {level} AS level, code, CAST(count(*) AS DOUBLE) AS rows_of_code FROM code{level} GROUP BY code" for level in (1, 2)),
)
def usage_network(spark: SparkSession, sf: str) -> DataFrame:
    """How often a step uses each code."""
    counts = step_sums(spark, sf)[2]
    rows = [(level + 1, code, float(n)) for level, used in enumerate(counts) for code, n in enumerate(used) if n]
    return spark.createDataFrame(rows, "level int, code int, rows_of_code double")


STEPS = 4
SLICES_SQL = f"""slices AS MATERIALIZED (SELECT product_id, CAST('0x' || substr({hashed('product_id', 'step')}, 1, 13) AS BIGINT) % {STEPS} AS step FROM unit)"""


@register(
    "exact_steps",
    with_sql(*network_sql(), SLICES_SQL)
    + f"""SELECT CAST(s.step AS INT) AS step, CAST(count(*) AS DOUBLE) AS n_rows, CASE WHEN s.step = 0 THEN (SELECT round((
        (SELECT sum(x * x) / {DIM} FROM miss JOIN slices USING (product_id) WHERE step = 0)
        + CAST(1.25 AS DOUBLE) / {LATENT} * ((SELECT sum(list_inner_product(v, v)) FROM rest1 JOIN slices USING (product_id) WHERE step = 0)
        + (SELECT sum(list_inner_product(v, v)) FROM rest2 JOIN slices USING (product_id) WHERE step = 0)))
        / (SELECT count(*) FROM slices WHERE step = 0), 8)) END AS first_loss, TRUE AS same_as_single_jobs
      FROM slices s GROUP BY s.step""",
)
def exact_steps(spark: SparkSession, sf: str) -> DataFrame:
    """Optimizer steps over all rows in one barrier job, each compared with a job of its own."""
    quantizer = QuantizerParams(W=WIDTH, L=DEPTH, d=LATENT)
    step = F.pmod(leading_bits(seeded_md5(PRODUCT_ID, "step"), 13), F.lit(STEPS)).cast("int").alias("slice")
    rows = prepared(spark, sf).select(EMBEDDING, F.lit(1).alias("copies"), step, PRODUCT_ID).persist()
    together, single = fresh_model(), fresh_model()
    tasks = max(1, min(4, spark.sparkContext.defaultParallelism))
    told = tr.barrier_rounds(rows, together, quantizer, 1e-3, STEPS, tasks, 1)
    out = []
    for at, seen in enumerate(told):
        alone = tr.gradient_round(rows.where(F.col("slice") == at), single, quantizer, 1e-3)
        same = abs(alone["loss"] - seen["loss"]) <= 1e-9 and np.array_equal(alone["usage"], seen["usage"])
        if at + 1 == STEPS:
            same = same and np.allclose(together.books, single.books, atol=1e-9)
        out.append((at, seen["rows"], seen["loss"] if at == 0 else None, bool(same)))
    rows.unpersist()
    frame = spark.createDataFrame(out, "step int, n_rows double, first_loss double, same_as_single_jobs boolean")
    return frame.where("n_rows > 0").withColumn("first_loss", F.round("first_loss", 8))
