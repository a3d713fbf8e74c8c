"""Whitening against a plain eigendecomposition of the whole fit list."""

import math

import numpy as np
import pytest
from conftest import SF_SMALL

from quarry.llm import whitening
from quarry.llm.queries import W


def expected(vectors):
    x = np.floor(256.0 * np.array(vectors, dtype=float))
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    away = fit - sums / n
    values, basis = np.linalg.eigh(away.T @ away / n)
    return x, n, sums, values[::-1], basis[:, ::-1]


def test_query_by_brute_force(spark):
    rows = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()}
    ids = sorted(rows)
    x, n, sums, values, basis = expected([rows[i] for i in ids])
    got = {(r.vec_id, r.component): r for r in W["op13_whitening"](spark, SF_SMALL).collect()}
    assert len(got) == 4 * len(ids)
    signs = {}
    for i, row in zip(ids, x):
        for c in range(4):
            r = got[i, c + 1]
            want = float((row - sums / n) @ basis[:, c]) / math.sqrt(values[c])
            signs.setdefault(c, 1 if r.whitened * want > 0 else -1)
            assert r.whitened == pytest.approx(signs[c] * want, rel=1e-9, abs=1e-10)
            assert r.n == n and r.deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums))
            assert r.explained == pytest.approx(values[c] / values.sum(), rel=1e-10)
            assert 0 <= r.identity_error < 1e-10


def test_updates_and_merges_keep_the_scatter():
    rng = np.random.default_rng(0)
    for trial in range(60):
        d, n = int(rng.integers(1, 9)), int(rng.integers(1, 40))
        x = rng.integers(-3, 4, (n, d)) * 10.0 ** rng.integers(0, 4)
        if trial % 3 == 0:
            x[:, :d // 2] = 0
        first, second = whitening.Spectrum.empty(d), whitening.Spectrum.empty(d)
        for v in x[:n // 2]:
            first.add(v)
        for v in x[n // 2:]:
            second.add(v)
        first.merge(second)
        scatter = (x - x.mean(0)).T @ (x - x.mean(0))
        assert np.abs(first.basis * first.values @ first.basis.T - scatter).max() < 1e-11 * max(1, np.abs(scatter).max())
        assert np.abs(first.basis.T @ first.basis - np.eye(d)).max() < 1e-10
        assert first.n == n and np.allclose(first.mean, x.mean(0))


def test_many_tasks_give_the_same(spark, monkeypatch):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding")

    def rows():
        return {(r.vec_id, r.component): r.whitened for r in whitening.whiten(df).collect()}
    one = rows()
    monkeypatch.setattr(whitening, "TASK_ROWS", 20)
    monkeypatch.setattr(whitening, "FAN_IN", 3)
    many = rows()
    assert one.keys() == many.keys()
    assert max(abs(one[k] - many[k]) for k in one) < 1e-9


def test_odd_rows(spark):
    schema = "vec_id long, embedding array<double>, id string, x string, n string"
    inf, nan = float("inf"), float("nan")
    rows = [(1, [0.5, 0.25]), (1, [0.5, 0.25]), (None, [1.0, -0.5]), (2, [-1.0, 0.0]), (3, [0.001, 0.0]),
            (4, None), (5, [None, 1.0]), (6, [inf, 1.0]), (7, [nan, 0.0]), (8, []), (9, [1.0]), (10, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], schema)
    out = whitening.whiten(df)
    got = out.collect()
    assert sorted((str(r.vec_id), r.component) for r in got) == sorted((i, c) for i in ("1", "1", "None", "2", "3") for c in (1, 2))
    assert {r.n for r in got} == {4}
    assert max(r.identity_error for r in got) < 1e-9
    assert whitening.whiten(df.limit(0)).collect() == []
    assert whitening.whiten(df.where("vec_id = 4")).collect() == []


def test_no_variance_and_great_numbers(spark):
    schema = "vec_id long, embedding array<double>"
    same = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.5, 0.5])], schema)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same] == [(1, 0, None, None, None)] * 4
    line = whitening.whiten(spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 1.0])], schema)).collect()
    assert {(r.vec_id, r.component): r.whitened is None for r in line} == {(1, 1): False, (1, 2): True, (2, 1): False, (2, 2): True}
    great = whitening.whiten(spark.createDataFrame([(1, [1e300]), (2, [0.0]), (3, [1.0])], schema)).collect()
    assert {r.vec_id: r.deviation is None for r in great} == {1: True, 2: True, 3: True}
    assert max(r.identity_error for r in great) < 1e-9
