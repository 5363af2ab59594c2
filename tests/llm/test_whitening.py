from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from railfeed.llm import whitening as W


def _brute(rows, components=16):
    """Exact covariance by fractions, products of centred values; rows of (vec_id, vector)."""
    kept = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[k] for x in fit) for k in range(d)]
    y = np.array([[n * x[k] - sums[k] for k in range(d)] for x in fit], object)
    v = y.T @ y
    v = np.array([[float(Fraction(int(v[i, j]), n**3)) for j in range(d)] for i in range(d)])
    far = {(i, sum((n * x[k] - sums[k]) ** 2 for k in range(d))) for i, x in kept}
    return kept, fit, n, sums, v, far


def _check(rows, got):
    kept, fit, n, sums, v, far = _brute(rows)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(16, len(sums))
    assert len(got) == k * len(kept) and {r.n for r in got} == {n}
    assert {(r.vec_id, int(r.deviation)) for r in got} == far
    by = {}
    for r in got:
        by.setdefault(r.component, {}).setdefault(r.vec_id, r)
    assert sorted(by) == list(range(1, k + 1))
    for c, rows_ in by.items():
        e, u = values[c - 1], vectors[:, c - 1]
        want = {i: float(((np.array(x) - np.array(sums) / n) @ u) / math.sqrt(e)) for i, x in kept}
        sign = math.copysign(1, sum(want[i] * rows_[i].whitened for i in want))
        assert max(abs(want[i] - sign * rows_[i].whitened) for i in want) < 1e-6
        assert abs(rows_[kept[0][0]].explained / (e / np.trace(v)) - 1) < 1e-9
    errors = {r.identity_error for r in got}
    assert len(errors) == 1 and errors.pop() < 1e-9


def test_query_equals_exact_fractions(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    _check(rows, W.op12_embedding_whitening(spark, sf_dir).collect())


def test_whitened_rows_have_the_identity_as_covariance(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    wide = W.whiten(df).join(W.grid(df), "vec_id").groupBy("x").pivot("component").agg(F.max("whitened")).drop("x").toPandas().to_numpy()
    assert np.abs(np.cov(wide.T, bias=True) - np.eye(16)).max() < 1e-9


def test_polarised_sums_are_exact_for_large_and_small_values(spark):
    rng = np.random.default_rng(1)
    for top in (3, 10**6, 10**12):
        x = rng.integers(-top, top, (300, 5))
        fit = spark.createDataFrame([(r,) for r in x.tolist()], "x ARRAY<BIGINT>").repartition(4)
        sums = W.dimension_sums(fit, 5)
        assert sums == [int(s) for s in x.astype(object).sum(axis=0)]
        centre = [s // 300 for s in sums]
        z = x.astype(object) - np.array(centre, object)
        got = W.squared_sums(fit, centre)
        for i in range(5):
            for j in range(i, 5):
                want = z[:, i] if i == j else z[:, i] + z[:, j]
                assert got[i, j] == int((want * want).sum())
        y = x.astype(object) * 300 - np.array(sums, object)
        cov = W.covariance(300, [s - 300 * c for s, c in zip(sums, centre)], got)
        assert all(cov[i, j] == float(Fraction(int((y[:, i] * y[:, j]).sum()), 300**3)) for i in range(5) for j in range(5))


def test_the_driver_gets_one_number_per_pair_of_dimensions(spark):
    fit = spark.range(500).select(F.array(*[(F.col("id") * k) % 97 for k in range(1, 7)]).alias("x")).repartition(8)
    assert len(W.squared_sums(fit, [40] * 6)) == 6 * 7 // 2


def _vectors(n, d, seed=0):
    rng = np.random.default_rng(seed)
    return [[float(c) for c in v] for v in rng.normal(0, 2, (n, d)) * np.arange(1, d + 1)]


@pytest.mark.parametrize("copies", [1, 400])
def test_copies_count_once_in_the_fit(spark, copies):
    vectors = _vectors(60, 4)
    rows = [*enumerate(vectors), *[(1000 + i, vectors[0]) for i in range(copies)]]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>").repartition(5)
    _check(rows, W.whiten(df).collect())


def test_odd_rows(spark):
    vectors = _vectors(40, 3)
    rows = [*enumerate(vectors), (100, None), (101, [1.0, None, 2.0]), (102, [float("nan"), 1.0, 1.0]), (103, [1.0, float("-inf"), 1.0]), (104, [])]
    schema = "vec_id BIGINT, embedding ARRAY<DOUBLE>, x STRING, component STRING, n STRING, at STRING"
    df = spark.createDataFrame([(i, v, "a", "b", "c", "d") for i, v in rows + [(5, vectors[5])]], schema)
    got = W.whiten(df).collect()
    _check([*rows, (5, vectors[5])], [r for r in got if r.vec_id != 104])
    assert [(r.whitened, r.deviation, r.n) for r in got if r.vec_id == 104] == [(None, None, 40)] * 3
    # another length: no deviation and no value; a NULL id: a row like any other
    more = df.unionAll(spark.createDataFrame([(200, [1.0, 2.0], "", "", "", ""), (None, vectors[0], "", "", "", "")], schema))
    got = {(r.vec_id, r.component): r for r in W.whiten(more).collect()}
    assert got[200, 1].whitened is None and got[200, 1].deviation is None and got[200, 1].n == 40
    assert got[None, 1].whitened == got[0, 1].whitened
    assert W.whiten(df.where("false")).count() == 0 and W.whiten(df.where("vec_id > 99")).where("vec_id <> 104").count() == 0


def test_directions_without_variance_are_null(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    assert [(r.n, r.deviation, r.whitened, r.explained) for r in W.whiten(one).collect()] == [(1, 0, None, 0.0)] * 4
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(9)], "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    got = W.whiten(flat).collect()
    assert {r.component for r in got if r.whitened is not None} == {1} and got[0].identity_error < 1e-9


def test_huge_entries_do_not_fail(spark):
    rows = [(i, [float(i), 1e300 if i == 3 else -float(i * i)]) for i in range(8)]
    got = W.whiten(spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>")).collect()
    assert len(got) == 16 and all(r.deviation is not None for r in got)
