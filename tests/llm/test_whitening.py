"""Whitening against numpy on the whole list."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from adperf.llm import queries, whitening

FIELDS = "vec_id long, embedding array<float>, key string, copies int, whitened string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, "x") for i, v in rows], FIELDS)


def plain(rows, weights="one"):
    """(list of (id, x), n, S, eigenvalues, eigenvectors, trace) of rows (id, vector)."""
    rows = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    rows = [(i, tuple(math.floor(256 * float(np.float32(c))) for c in v)) for i, v in rows]
    fit = sorted({x for _, x in rows}) if weights == "one" else [x for _, x in rows]
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array(fit, float) - np.array(sums) / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    return rows, n, sums, values[::-1], vectors[:, ::-1], np.trace(covariance)


def check(found, rows, weights="one"):
    rows, n, sums, values, vectors, trace = plain(rows, weights)
    by_id = {}
    for r in found:
        by_id.setdefault((r.vec_id, r.component), []).append(r)
    assert len(found) == 4 * len(rows)
    signs = {}
    for i, x in rows:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        for k in range(4):
            same = by_id[(i, k + 1)]
            wanted = (np.array(x) - np.array(sums) / n) @ vectors[:, k] / math.sqrt(values[k])
            hits = [r for r in same if r.deviation == deviation and abs(abs(r.whitened) - abs(wanted)) < 1e-8]
            assert hits and all(r.n == n for r in same)
            assert abs(same[0].explained - values[k] / trace) <= 1e-10 and same[0].identity_error <= 1e-8
            if abs(wanted) > 1e-6 and len(same) == 1:
                assert signs.setdefault(k, hits[0].whitened * wanted > 0) == (hits[0].whitened * wanted > 0)


def test_test_table_equals_numpy(spark, small):
    rows = [(r.vec_id, r.embedding) for r in small("embeddings").collect()]
    check(queries.QUERIES["op12_embedding_whitening"](spark, "/root/testdata/sf0.001").collect(), rows)


@pytest.mark.parametrize("weights", ["one", "count"])
def test_copies_nulls_and_hot_vectors(spark, weights, monkeypatch):
    rng = np.random.default_rng(3)
    base = [[float(np.float32(c)) for c in v] for v in rng.normal(size=(60, 6)) * [3, 2, 1.5, 1, 0.7, 0.3]]
    rows = [(i, v) for i, v in enumerate(base)] + [(100 + i, base[0]) for i in range(200)] + [(400 + i, base[i % 7]) for i in range(70)]
    rows += [(7, base[9]), (None, base[3]), (900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (902, [float("nan")] * 6), (903, [float("inf")] + [0.0] * 5), (904, [1e30] + [0.0] * 5)]
    rows += [(905, []), (906, [1.0, 2.0])]
    kept = [(i, v) for i, v in rows if i not in (904, 905, 906)]
    monkeypatch.setattr(whitening, "HOT", 10)  # so that vectors are joined in both ways
    check(whitening.whiten(table(spark, rows).repartition(5), weights=weights).collect(), kept, weights)


def test_without_variance(spark):
    found = whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert len(found) == 4 and all(r.whitened is None and r.explained is None and r.identity_error is None and r.deviation == 0 and r.n == 1 for r in found)
    flat = whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [3.0, 2.0])])).collect()
    assert [(r.component, None if r.whitened is None else abs(round(r.whitened, 9)), r.explained) for r in sorted(flat, key=lambda r: (r.vec_id, r.component))] == [
        (1, 1.0, 1.0), (2, None, 0.0)] * 2


def test_large_entries_are_exact(spark):
    rows = [(1, [1e12, 0.0]), (2, [1e6, 3.0]), (3, [0.0, 1.0]), (4, [5.0, 2.0])]
    found = {(r.vec_id, r.component): r for r in whitening.whiten(table(spark, rows)).collect()}
    xs = [[math.floor(256 * float(np.float32(c))) for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*xs)]
    for (i, _), x in zip(rows, xs):
        exact = sum((4 * c - s) ** 2 for c, s in zip(x, sums))
        assert found[(i, 1)].deviation == (exact if exact < 2**63 else None)


def test_empty_tables(spark):
    none = table(spark, [(1, [1.0])]).limit(0)
    for t in (none, table(spark, [(1, None)]), table(spark, [(1, [])])):
        assert whitening.whiten(t).count() == 0
    one = whitening.whiten(table(spark, [(1, [1.0])]).withColumn("embedding", F.col("embedding").cast("array<double>")))
    assert one.count() == 1
