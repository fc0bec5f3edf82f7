from __future__ import annotations

import math
import random

import numpy as np

from clickloom.llm import whitening


def brute(vectors):
    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(col) for col in zip(*x, strict=True)]
    return x, n, sums, [sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]


def test_products_are_exact():
    rng = np.random.default_rng(1)
    for top, rows in ((1, 3), (9, 64), (1 << 17, 130), (1 << 40, 70), ((1 << 62) + 5, 9)):
        u = rng.integers(0, top, (rows, 5), dtype=np.uint64, endpoint=True)
        want = u.astype(object).T @ u.astype(object)
        assert (whitening.products(u).astype(object) == want).all()
    x = rng.integers(-(1 << 50), 1 << 50, (77, 4))
    whole = np.column_stack([np.ones(77, np.int64), x]).astype(object)
    assert (whitening.block_sums(x) == whole.T @ whole).all()


def test_whitening_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 50)
    rng = random.Random(2)
    mix = [[rng.gauss(0, 1) for _ in range(10)] for _ in range(10)]
    vectors = [[sum(a * b for a, b in zip(row, z, strict=True)) * 0.3 for row in mix] for z in ([rng.gauss(0, 1) for _ in range(10)] for _ in range(400))]
    docs = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>").repartition(3)
    found = {(r.vec_id, r.component): r for r in whitening.whitened(docs).collect()}
    x, n, sums, deviations = brute(vectors)
    assert len(found) == 8 * n
    centred = np.array(x) - np.array(sums) / n
    values = np.sort(np.linalg.eigvalsh(centred.T @ centred / n))[::-1]
    white = np.array([[found[i, c].whitened for c in range(1, 9)] for i in range(n)])
    assert np.abs(white.T @ white / n - np.eye(8)).max() < 1e-9 and np.abs(white.mean(axis=0)).max() < 1e-9
    for (i, c), r in found.items():
        assert (r.n, r.deviation) == (n, deviations[i]) and r.identity_error < 1e-9
        assert abs(r.explained / (values[c - 1] / values.sum()) - 1) < 1e-9
    # each component is an eigenvector: whitened times the root of e is the projection on it
    back = np.linalg.lstsq(centred, white * np.sqrt(values[:8]), rcond=None)[0]
    assert np.abs(back.T @ back - np.eye(8)).max() < 1e-6


def test_whitening_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.25], 7), (1, [0.5, -0.25], 7), (None, [1.0, 2.0], 8), (2, None, 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 1), (5, [None, 1.0], 1), (6, [], 1), (7, [1.0], 1), (8, [1e300, 0.0], 1), (9, [-200.0, 3.5], 1)]
    docs = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, v int").withColumnRenamed("v", "n")
    found = whitening.whitened(docs).collect()
    kept = [rows[i] for i in (0, 1, 2, 10)]
    _, n, _, deviations = brute([r[1] for r in kept])
    assert sorted((str(r.vec_id), r.component, r.n, r.deviation) for r in found) == sorted((str(k[0]), c, n, d) for k, d in zip(kept, deviations, strict=True) for c in (1, 2))
    assert whitening.whitened(docs.limit(0)).collect() == []
    alone = whitening.whitened(docs.where("vec_id = 9")).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in sorted(alone)] == [(1, 1, 0, None, 0.0, 0.0), (2, 1, 0, None, 0.0, 0.0)]
    huge = spark.createDataFrame([(1, [1e12]), (2, [-1e12]), (3, [0.0])], "vec_id bigint, embedding array<float>")
    assert {r.deviation for r in whitening.whitened(huge).collect()} == {None, 0} or all(r.n == 3 for r in whitening.whitened(huge).collect())


def test_whitening_does_not_depend_on_how_rows_are_dealt(spark):
    rng = random.Random(3)
    docs = spark.createDataFrame([(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(300)], "vec_id bigint, embedding array<float>")
    sums = [whitening.scatter(whitening.usable_vectors(docs.repartition(k), "vec_id", "embedding")) for k in (1, 7)]
    assert (sums[0] == sums[1]).all()
