"""Small numpy steps that run inside Spark tasks on one Arrow batch at a time."""

from __future__ import annotations

import numpy as np

# Hidden widths of the encoder (the decoder mirrors them).
HIDDEN = (256, 128)


def nearest(rows: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the closest codeword and the squared distance; ties go to the lowest code.

    The matrix form loses digits, so rows with a close runner-up are measured again directly.
    """
    half = 0.5 * np.einsum("ij,ij->i", book, book)
    score = rows @ book.T
    np.subtract(half, score, out=score)
    code = score.argmin(axis=1)
    best = score[np.arange(len(rows)), code]
    slack = 1e-9 * (np.abs(best) + np.einsum("ij,ij->i", rows, rows) + 1e-30)
    close = np.flatnonzero((score <= (best + slack)[:, None]).sum(axis=1) > 1)
    if len(close):
        # All close candidates in one step, by row, distance and code; the first of a row wins.
        at, among = np.nonzero(score[close] <= (best + slack)[close][:, None])
        gap = book[among] - rows[close[at]]
        order = np.lexsort((among, np.einsum("ij,ij->i", gap, gap), at))
        first = order[np.r_[True, np.diff(at[order]) > 0]]
        code[close[at[first]]] = among[first]
    left = rows - book[code]
    return code, np.einsum("ij,ij->i", left, left)


def quantize_rows(rows: np.ndarray, books: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Codes of every level, and the residual before level 1, 2, ..., and after the last."""
    residuals = [rows]
    codes = np.empty((len(rows), len(books)), dtype=np.int32)
    for level, book in enumerate(books):
        code, _ = nearest(residuals[-1], book)
        codes[:, level] = code
        residuals.append(residuals[-1] - book[code])
    return codes, residuals


def layer_names(part: str) -> list[tuple[str, str]]:
    return [(f"{part}.w{i}", f"{part}.b{i}") for i in range(len(HIDDEN) + 1)]


def fresh_weights(d_in: int, d: int, seed: int) -> dict[str, np.ndarray]:
    """Uniform in +-1/sqrt(fan in), for weights and offsets."""
    rng = np.random.default_rng(seed)
    out: dict[str, np.ndarray] = {}
    for part, widths in (("encoder", (d_in, *HIDDEN, d)), ("decoder", (d, *HIDDEN[::-1], d_in))):
        for (w, b), fan_in, fan_out in zip(layer_names(part), widths, widths[1:]):
            reach = 1.0 / np.sqrt(fan_in)
            out[w] = rng.uniform(-reach, reach, (fan_in, fan_out))
            out[b] = rng.uniform(-reach, reach, fan_out)
    return out


def run_layers(x: np.ndarray, weights: dict[str, np.ndarray], part: str) -> list[np.ndarray]:
    """Input, hidden activations and output of one network. No weights: the identity."""
    seen = [x]
    names = [pair for pair in layer_names(part) if pair[0] in weights]
    for i, (w, b) in enumerate(names):
        y = seen[-1] @ weights[w] + weights[b]
        seen.append(np.maximum(y, 0.0) if i + 1 < len(names) else y)
    return seen


def back_layers(
    grad: np.ndarray, seen: list[np.ndarray], weights: dict[str, np.ndarray], part: str, out: dict[str, np.ndarray]
) -> np.ndarray:
    """Chain rule through run_layers; returns the gradient of the input."""
    names = [pair for pair in layer_names(part) if pair[0] in weights]
    for i in reversed(range(len(names))):
        w, b = names[i]
        if i + 1 < len(names):
            grad = grad * (seen[i + 1] > 0)
        out[w] = seen[i].T @ grad
        out[b] = grad.sum(axis=0)
        grad = grad @ weights[w].T
    return grad


def batch_step(
    x: np.ndarray, weights: dict[str, np.ndarray], books: list[np.ndarray], beta: float
) -> dict[str, object]:
    """Loss sums, gradient sums and code statistics of one batch (sums over rows, not means).

    The value passed on is the sum of codewords. Only level 1 sees the encoder output itself, later
    levels see a detached residual: so the reconstruction gradient reaches the encoder once, and
    only the commitment term of level 1 has a gradient.
    """
    encoder = run_layers(x, weights, "encoder")
    z = encoder[-1]
    codes, residuals = quantize_rows(z, books)
    decoder = run_layers(z - residuals[-1], weights, "decoder")
    miss = decoder[-1] - x
    gradients: dict[str, np.ndarray] = {}
    back = back_layers(2.0 / x.shape[1] * miss, decoder, weights, "decoder", gradients)
    back = back + beta * 2.0 / z.shape[1] * residuals[1]
    back_layers(back, encoder, weights, "encoder", gradients)
    counts, sums = [], []
    for level, book in enumerate(books):
        count, total = code_sums(residuals[level], codes[:, level], len(book))
        counts.append(count)
        sums.append(total)
    return {
        "gradients": gradients,
        "reconstruction": float((miss * miss).sum()) / x.shape[1],
        "quantization": [float((r * r).sum()) / z.shape[1] for r in residuals[1:]],
        "counts": np.stack(counts),
        "sums": np.stack(sums),
    }


def code_sums(rows: np.ndarray, code: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Row count and vector sum of every code."""
    count = np.bincount(code, minlength=width).astype(np.float64)
    order = np.argsort(code, kind="stable")
    total = np.zeros((width, rows.shape[1]))
    used = np.flatnonzero(count)
    if len(used):
        starts = np.concatenate([[0], np.cumsum(count[used]).astype(np.int64)[:-1]])
        total[used] = np.add.reduceat(rows[order], starts, axis=0)
    return count, total


# Optimizer constants and the smoothing term of the codebook update.
ADAM_B1, ADAM_B2, ADAM_EPS, WEIGHT_DECAY = 0.9, 0.999, 1e-8, 0.01
EMA_EPS = 1e-5


def adamw(
    weights: dict[str, np.ndarray], m: dict[str, np.ndarray], v: dict[str, np.ndarray],
    gradients: dict[str, np.ndarray], step: int, lr: float,
) -> None:
    """One decoupled-decay Adam step, in place. `step` counts from 1."""
    for name, g in gradients.items():
        m[name] = ADAM_B1 * m[name] + (1 - ADAM_B1) * g
        v[name] = ADAM_B2 * v[name] + (1 - ADAM_B2) * g * g
        scaled = (m[name] / (1 - ADAM_B1**step)) / (np.sqrt(v[name] / (1 - ADAM_B2**step)) + ADAM_EPS)
        weights[name] = weights[name] * (1 - lr * WEIGHT_DECAY) - lr * scaled


def ema_codebooks(
    sizes: np.ndarray, sums: np.ndarray, counts: np.ndarray, totals: np.ndarray, gamma: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Decay the running size and sum of every code and derive the codebooks (levels x W x d)."""
    sizes = gamma * sizes + (1 - gamma) * counts
    sums = gamma * sums + (1 - gamma) * totals
    return sizes, sums, codebooks_from(sizes, sums)


def codebooks_from(sizes: np.ndarray, sums: np.ndarray) -> np.ndarray:
    n = sizes.sum(axis=1, keepdims=True)
    smoothed = (sizes + EMA_EPS) / (n + sizes.shape[1] * EMA_EPS) * n
    return sums / np.maximum(smoothed, EMA_EPS)[:, :, None]
