"""Licences, phrases and whitening against plain versions."""

import random
import re
from collections import Counter
from decimal import Decimal

import numpy as np
import pytest

from codeloom.llm import licences, phrases, whitening

DOCS = "doc_id long, text string, lang string, labels string, n_words int, n long, chunk string, rank string"


def docs_of(spark, texts, langs=None):
    rows = [(i, t, (langs or [None] * len(texts))[i], "clash", 1, 2, "c", "r") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


# Licences.


def plain_licences(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    found = []
    for phrase, label in licences.BASE_PHRASES.items():
        parts = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    at = [i for i, _ in found]
    return len(words), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({label for _, label in found}))


def random_text(rnd, size):
    words = ["MIT", "mit", "License", "license", "apache", "general", "public", "licenses", "é", "x1", "ſ", "İ", "gpl", "the"]
    gaps = [" ", "  ", "\n", "-", ". ", "_", "\t", "/", "\x00", ""]
    return "".join(rnd.choice(words) + rnd.choice(gaps) for _ in range(size))


def test_licences_of_random_texts(spark):
    rnd = random.Random(4)
    texts = [random_text(rnd, rnd.randint(0, 60)) for _ in range(300)] + [None, "", " ", "mit license " * 50_000, "mit license", "mit license"]
    got = {r["doc_id"]: r for r in licences.digests(licences.scan_licences(docs_of(spark, texts))).collect()}
    for i, text in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == plain_licences(text)
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert len(got) == len(texts)


@pytest.mark.parametrize(
    "text,labels,score",
    [
        ("Licensed under the Apache License, Version 2.0.", "apache", 0.5),
        ("Licensed under CC BY-NC 4.0.", "cc-by-nc", 0.8),
        ("GNU Lesser General Public License", "gpl,lgpl", 0.8),
        ("# SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0 */", "apache,gpl,mit", 1.0),
        ("License: BSD-3-Clause\nnext line and more", "bsd", 1.0),
        ("License: MIT. It is free", "mit", 1.0),
        ("license: the one you know", "", 0.0),
        ("license: (mit", "", 0.0),
        ("license: mit and foo-9", "", 0.0),
        ("license: mit or", "mit", 1.0),
        ("license: mit with apache-2.0", "", 0.0),
        ("license: ", "", 0.0),
    ],
)
def test_labels_beyond_the_base(text, labels, score):
    found = licences.Scanner().scan(text.encode())
    assert (",".join(found[5]), found[8]) == (labels, score)


def plain_permission(tree):
    if isinstance(tree, str):
        return licences.licence(tree)[1]
    sign, left, right = tree
    if sign == "with":
        return min(5, plain_permission(left) + 1)
    return (max if sign == "or" else min)(plain_permission(left), plain_permission(right))


def random_tree(rnd, depth):
    if not depth or rnd.random() < 0.3:
        one = rnd.choice(["mit", "gpl-2.0-only", "agpl-3.0", "cc0-1.0", "lgpl-2.1+", "licenseref-own"])
        return ("with", one, "gcc-exception-3.1") if rnd.random() < 0.2 else one
    return rnd.choice(["and", "or"]), random_tree(rnd, depth - 1), random_tree(rnd, depth - 1)


def written(tree, above=0):
    if isinstance(tree, str):
        return [tree]
    binds = licences.BINDS[tree[0]]
    out = [*written(tree[1], binds), tree[0], *written(tree[2], binds)]
    return ["(", *out, ")"] if binds < above else out


def test_expressions_as_their_trees():
    rnd = random.Random(5)
    for _ in range(500):
        tree = random_tree(rnd, 4)
        tokens = written(tree)
        assert licences.evaluate(tokens)[1] == plain_permission(tree)
        assert licences.expression_at("  " + " ".join(tokens) + "; rest", 0) == tokens
    assert licences.evaluate([]) is None and licences.evaluate(["mit", "mit"]) is None
    deep = ["("] * 5000 + ["mit"] + [")"] * 5000
    assert licences.evaluate(deep)[0] == {"mit"}


# Phrases.


def plain_phrases(texts, langs, top):
    counts, total = {}, Counter()
    for text, lang in zip(texts, langs):
        lang = lang or "und"
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in (1, 2, 3):
                counts.setdefault(lang, Counter()).update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    rows = set()
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= 10}
        out = []
        for p, a in candidates.items():
            longer = [b for q, b in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * b >= 50 * a for b in longer):
                continue
            score, _, l, r = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            out.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(out)[:top], 1):
            rows.add((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return rows


def phrase_texts(rnd, n):
    words = ["a", "b", "c", "É", "New", "york", "city", "d\x00d", "𝄞", "ﬀ", "zz"]
    return ["".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "\t", " ", ", ", ".", "\n", "\x0b "]) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("chunk_words,top", [(1 << 20, 2000), (50, 7), (1, 2000)])
def test_phrases_of_random_texts(spark, chunk_words, top):
    rnd = random.Random(6)
    texts = phrase_texts(rnd, 150) + [None, "", " ", "New York city New York city " * 400, "lone", "x y " * 12, "x y " * 12]
    langs = [rnd.choice(["en", "de", None, "und"]) for _ in texts]
    got = phrases.mine_phrases(docs_of(spark, texts, langs), top=top, chunk_words=chunk_words)
    assert {tuple(r) for r in got.collect()} == plain_phrases(texts, langs, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_no_phrases(spark):
    assert phrases.mine_phrases(docs_of(spark, [])).count() == 0
    assert phrases.mine_phrases(docs_of(spark, [None, "", "a b c"])).count() == 0


def test_phrases_when_the_bit_table_is_full(spark, monkeypatch):
    """It then admits every pair, and the join alone decides."""
    monkeypatch.setattr(phrases, "bit_table", lambda pairs: b"\xff" * (phrases.BIT_TABLE // 8 + 4096))
    texts = phrase_texts(random.Random(7), 100)
    got = phrases.mine_phrases(docs_of(spark, texts))
    assert {tuple(r) for r in got.collect()} == plain_phrases(texts, [None] * len(texts), 2000)


def test_bit_table_holds_its_pairs(spark):
    rnd = random.Random(8)
    pairs = [(rnd.randrange(1 << 62),) for _ in range(500)]
    table = np.frombuffer(phrases.bit_table(spark.createDataFrame(pairs, "pair long")), np.uint8)
    assert phrases.has_bit(table, phrases.bit_of(np.array(pairs)[:, 0])).all()
    assert phrases.has_bit(table, phrases.bit_of(np.arange(10_000) * 77_777_777)).mean() < 0.01


def test_packed_codes():
    import pyarrow as pa

    for codes in (np.array([], np.int32), np.array([-1, 0, 5, 2**31 - 1, -1], np.int32), np.arange(100_000, dtype=np.int32)):
        assert (phrases.unpacked(pa.scalar(phrases.packed(codes), pa.binary())) == codes).all()


def test_tiles_are_counted_alike(monkeypatch):
    rng = np.random.default_rng(1)
    left, right = (rng.zipf(1.2, 100_000) % 100_000).astype(np.int32), (rng.zipf(1.2, 100_000) % 100_000).astype(np.int32)
    truth = Counter(zip(left.tolist(), right.tolist()))
    for dense in (1, 500, 1 << 13, 1 << 30):
        monkeypatch.setattr(phrases, "DENSE", dense)
        for first in (0, 1_000_000):
            pairs, c = phrases.count_pairs(left + np.int32(first), right + np.int32(first))
            a, b = (pairs >> 31) - first, (pairs & (1 << 31) - 1) - first
            assert dict(zip(zip(a.tolist(), b.tolist()), c.tolist())) == truth and len(a) == len(truth)
    assert [len(x) for x in phrases.count_pairs(left[:0], right[:0])] == [0, 0]


def test_a_score_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    a, l, r = 3_000_000_000, 3_000_000_001, 4_000_000_000
    row = spark.createDataFrame([(a, [l], [r])], "f long, firsts array<long>, lasts array<long>").select(phrases.lowest_cut(2).alias("c")).first()["c"]
    assert row["score"] == 10**6 * a * a // (l * r) and row["l"] == l and row["r"] == r
    assert F  # the column functions above need a session


# Whitening.

VECTORS = "vec_id long, embedding array<float>, n int, component string, x_ int"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c", 2) for i, v in rows], VECTORS)


def plain_whitening(rows):
    x = {i: np.floor(64 * np.asarray(v, np.float32).astype(np.float64)).astype(np.int64) + 1_000_000 for i, v in rows}
    fit = np.unique(np.stack(list(x.values())), axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    return x, n, sums, values[::-1], vectors[:, ::-1], float(np.trace(covariance))


def test_whitening(spark):
    rng = np.random.default_rng(3)
    mixing = rng.standard_normal((24, 24)) * np.linspace(3, 0.2, 24)
    rows = [(i, [float(v) for v in rng.standard_normal(24) @ mixing]) for i in range(500)]
    rows += [(500 + i, rows[0][1]) for i in range(200)] + [(None, rows[1][1]), (3, rows[3][1])]
    bad = [(900, None), (901, []), (902, [1.0, None] + [0.0] * 22), (903, [float("nan")] + [0.0] * 23), (904, [float("inf")] + [0.0] * 23), (905, [1e30] * 24)]
    got = whitening.whiten(vectors_of(spark, rows + bad)).collect()
    assert len(got) == 16 * len(rows)
    x, n, sums, values, vectors, trace = plain_whitening(rows)
    turned = {}
    for r in got:
        j, i = r["component"] - 1, r["vec_id"]
        assert r["n"] == n and r["deviation"] == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[i], sums))
        assert abs(r["explained"] - values[j] / trace) <= 1e-9 * values[j] / trace and r["identity_error"] < 1e-9
        plain = (x[i] - sums / n) @ vectors[:, j] / np.sqrt(values[j])
        sign = turned.setdefault(j, 1 if abs(r["whitened"] - plain) < abs(r["whitened"] + plain) else -1)
        assert abs(r["whitened"] - sign * plain) < 1e-8


def test_whitening_of_odd_tables(spark):
    assert whitening.whiten(vectors_of(spark, [])).count() == 0
    assert whitening.whiten(vectors_of(spark, [(1, None), (2, [])])).count() == 0
    one = whitening.whiten(vectors_of(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"]) for r in one] == [(1, 0, None, 0.0)] * 4
    mixed = whitening.whiten(vectors_of(spark, [(1, [0.0, 1.0]), (2, [1.0, 0.0]), (3, [5.0]), (4, [9.0])])).collect()
    assert sorted((r["vec_id"], r["component"], r["n"]) for r in mixed) == [(1, 1, 2), (1, 2, 2), (2, 1, 2), (2, 2, 2), (3, 1, 2), (4, 1, 2)]
    assert all(abs(abs(r["whitened"]) - 1) < 1e-9 for r in mixed if r["component"] == 1)
    assert [r["whitened"] for r in mixed if r["component"] == 2] == [None, None]


def test_a_deviation_beyond_64_bits():
    exact = whitening.squared_deviation(np.array([[1_000_003, 1_000_000]]), 3_000_000_000, np.array([3_000_000_000_000_007, 3_000_000_000_000_000]))
    assert exact.to_pylist() == [Decimal((3 * 3_000_000_000 - 7) ** 2)]


@pytest.mark.parametrize("size", [1, 2, 5, 16, 17, 40, 90])
def test_components_and_inertia(size):
    rng = np.random.default_rng(size)
    spectra = [rng.random(size), np.r_[np.ones(size - size // 2), np.zeros(size // 2)], 10.0 ** -np.arange(size), np.ones(size), np.zeros(size), np.r_[1e9, rng.random(size - 1)]]
    for spectrum in spectra:
        q, _ = np.linalg.qr(rng.standard_normal((size, size)))
        matrix = (q * spectrum) @ q.T
        matrix = (matrix + matrix.T) / 2
        truth = np.sort(spectrum)[::-1][:16]
        values, vectors = whitening.largest_components(matrix, 16)
        assert np.abs(values - truth).max() <= 1e-12 * max(1, truth[0])
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
        assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-12 * max(1, truth[0])
        for shift in rng.uniform(-0.5, 1.5, 5):
            assert whitening.eigenvalues_below(matrix, shift) == (np.linalg.eigvalsh(matrix) < shift).sum()
