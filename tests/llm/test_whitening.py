"""Whitening against exact sums and the eigenvectors of a double solver."""

from __future__ import annotations

import math
import os
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pytest

from ledgerloom.llm import eigen, whitening
from ledgerloom.llm.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def with_spectrum(values, seed=1):
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))
    a = q * np.array(values) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(1, 40, 40),
        [5.0] * 6 + [3.0] * 4 + [1.0],  # repeated
        [1.0, 1 + 1e-10, 1 + 3e-10, 2.0, 2 + 1e-9, 7.0],  # closer than float32 can tell
        [10.0**-k for k in range(0, 24, 2)],  # far below float32's rounding
        [3.0, 2.0, 0.0, 0.0],
        [4.0],
    ],
)
def test_eigenvectors_to_double_precision(values):
    a = with_spectrum(values)
    found, x = eigen.eigh(a)
    assert (np.diff(found) <= 0).all()
    size = np.linalg.norm(a)
    np.testing.assert_allclose(found, np.linalg.eigvalsh(a)[::-1], atol=4e-15 * size)
    off = (np.array(eigen.product(x.T, x)).sum(0) - np.eye(len(a)))
    assert np.abs(off).max() < 2e-15
    high, low = eigen.product(a, x)
    assert np.abs((high - x * found) + low).max() < 4e-15 * size


def test_close_eigenvectors_beat_single_precision():
    """The wanted vectors are known; float32 cannot tell them apart."""
    turn = np.array([[0.6, -0.8, 0], [0.8, 0.6, 0], [0, 0, 1]])
    a = turn * np.array([1 + 2.0**-30, 1.0, 0.5]) @ turn.T
    _, x = eigen.eigh((a + a.T) / 2)
    assert abs(abs(x[:, 0] @ turn[:, 0]) - 1) < 1e-12
    assert abs(x[:, 0] @ turn[:, 1]) < 1e-6  # 2**-53 of the matrix over the gap


def test_products_have_twice_the_digits():
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(5, 70)), rng.normal(size=(70, 4))
    high, low = eigen.product(a, b)
    for i in range(5):
        for j in range(4):
            exact = sum(Fraction(float(x)) * Fraction(float(y)) for x, y in zip(a[i], b[:, j], strict=True))
            assert abs(exact - Fraction(float(high[i, j])) - Fraction(float(low[i, j]))) < 1e-25


def brute(rows):
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in rows], object)
    n, sums = len(x), x.sum(0)
    deviation = [sum(int(d) ** 2 for d in n * r - sums) for r in x]
    centred = ((n * x - sums) / n).astype(np.float64)
    return deviation, centred, centred.T @ centred / n


def test_given_table(spark):
    got = QUERIES["op11_whitening"](spark, SF).toPandas()
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas().sort_values("vec_id")
    entries = [list(map(float, e)) for e in rows["embedding"]]
    deviation, centred, covariance = brute(entries)
    values, x = np.linalg.eigh(covariance)
    values, x = values[::-1], x[:, ::-1]
    assert len(got) == len(rows) * 32 and set(got["n"]) == {len(rows)}
    assert got["identity_error"].max() < 1e-10
    wide = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    own = centred @ x[:, :32] / np.sqrt(values[:32])
    sign = np.sign((wide * own).sum(0))
    np.testing.assert_allclose(wide, own * sign, atol=1e-9)
    first = got.drop_duplicates("vec_id").sort_values("vec_id")
    assert first["deviation"].tolist() == deviation
    shares = got.drop_duplicates("component").sort_values("component")["explained"]
    np.testing.assert_allclose(shares, values[:32] / values.sum(), rtol=1e-12)


KIND = "vec_id long, embedding array<double>, size string, whitened int"


def whitened(spark, rows):
    df = spark.createDataFrame([(i, v, "x", 7) for i, v in rows], KIND).repartition(3)
    return df, whitening.whiten(df, whitening.fit(df)).collect()


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    good = [(1, [1.0, 2.0, 0.5]), (1, [1.0, 2.0, 0.5]), (None, [0.0, -2.5, 0.5]), (4, [3.0, 1.0, 0.5])]
    bad = [(5, None), (6, [1.0, None, 2.0]), (7, [inf, 0.0, 1.0]), (8, [nan, 0.0, 1.0]), (9, [1e300, 0.0, 1.0])]
    other = [(20, [1.0, 1.0]), (21, [2.0, 5.0]), (22, []), (23, [])]  # empty ones have no components
    _, got = whitened(spark, good + bad + other)
    assert sorted((r.vec_id is None, r.vec_id or 0, len(r.whitened)) for r in got) == sorted(
        [(False, 1, 3), (False, 1, 3), (True, 0, 3), (False, 4, 3), (False, 20, 2), (False, 21, 2)]
    )
    deviation, _, _ = brute([v for _, v in good])
    ours = [r for r in got if len(r.whitened) == 3]
    assert sorted(int(r.deviation) for r in ours) == sorted(deviation)
    assert {r.n for r in ours} == {4}
    for r in ours:  # the third dimension is constant
        assert r.whitened[2] is None and r.whitened[0] is not None
        assert r.explained[2] < 1e-12 and abs(sum(r.explained) - 1) < 1e-12 and r.identity_error < 1e-9


def test_constant_and_empty_tables(spark):
    _, got = whitened(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])
    assert [(r.whitened, r.explained, r.identity_error) for r in got] == [([None, None], [0.0, 0.0], None)] * 2
    assert whitened(spark, [(1, None)])[1] == []
    assert whitened(spark, [])[1] == []


def test_large_entries_are_exact(spark):
    rows = [(i, [2.0**50 * (i + 1), -(2.0**55) / (i + 2), float(i)]) for i in range(5)]
    _, got = whitened(spark, rows)
    deviation, _, _ = brute([v for _, v in rows])
    assert {r.vec_id: r.deviation for r in got} == {
        i: Decimal(d) if d < 10**38 else None for (i, _), d in zip(rows, deviation, strict=True)
    }


def test_partitions_do_not_matter(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    some = whitening.fit(df.repartition(7))
    other = whitening.fit(df.coalesce(1))
    (a,), (b,) = some.values(), other.values()
    assert a.sums == b.sums and a.n == b.n
    np.testing.assert_allclose(a.values, b.values, rtol=1e-12)
