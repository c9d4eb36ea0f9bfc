"""Whitening against exact sums, determinants and numpy's eigenvectors."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tablehouse.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, label int"


def frame(spark, rows, kind="double"):
    return spark.createDataFrame([(i, None if v is None else [None if e is None else float(e) for e in v], 0) for i, v in rows], SCHEMA.replace("double", kind))


def brute(vectors):
    f = np.floor(64 * np.array(vectors, float))
    x = [[int(e) + 1_000_000 for e in row] for row in f]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * e - s) ** 2 for e, s in zip(row, sums)) for row in x]
    values, axes = np.linalg.eigh(np.cov(f.T, bias=True).reshape(len(sums), -1))
    return n, deviation, values[::-1], axes[:, ::-1], f - f.mean(0)


def check(df, vectors, ids, loose=1e-9):
    n, deviation, values, axes, centred = brute(vectors)
    most = min(32, len(values))
    rows = {(r.vec_id, r.component): r for r in df.collect()}
    assert len(rows) == n * most
    whole = centred @ axes[:, :most] / np.sqrt(np.maximum(values[:most], 1e-300))
    for k in range(most):
        real = values[k] > 1e-9 * max(values[0], 1e-300)
        mine = np.array([rows[i, k + 1].whitened if real else 0.0 for i in ids])
        if real and (k == 0 or values[k - 1] - values[k] > 1e-6 * values[0]) and (k + 1 == len(values) or values[k] - values[k + 1] > 1e-6 * values[0]):
            assert min(np.abs(mine - whole[:, k]).max(), np.abs(mine + whole[:, k]).max()) < 1e-6
        for i, d in zip(ids, deviation):
            r = rows[i, k + 1]
            assert (r.n, r.deviation) == (n, d) and (r.whitened is not None) == real
            assert r.explained == pytest.approx(max(values[k], 0) / values.sum(), rel=1e-6, abs=1e-12)
    errors = {r.identity_error for r in rows.values()}
    assert len(errors) == 1 and errors.pop() < loose


def test_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = table.collect()
    check(whitening.whiten(table), [r.embedding for r in rows], [r.vec_id for r in rows])


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    good = [(i, rng.standard_normal(5) * 10.0 ** rng.integers(-1, 3)) for i in range(40)]
    bad = [(100, None), (101, [1, 2, None, 4, 5]), (102, [math.nan] * 5), (103, [math.inf, 0, 0, 0, 0]), (104, [1e300, 0, 0, 0, 0]), (105, []), (106, [1.0, 2.0]), (107, [1.0] * 6)]
    df = frame(spark, good + bad).selectExpr("*", "'x' as value", "1 as pos", "2 as dim", "3 as component", "4 as n")
    check(whitening.whiten(df.repartition(3)), [v for _, v in good], [i for i, _ in good])
    assert whitening.whiten(df.filter("false")).count() == 0
    assert whitening.whiten(df.filter("vec_id >= 100 and vec_id <= 105")).count() == 0


def test_repeated_and_null_ids(spark):
    rows = [(1, [0.5, 1.0]), (1, [0.5, 1.0]), (None, [3.0, -1.0]), (2, [-2.0, 0.25])]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert sorted(str(r.vec_id) for r in got) == sorted(["1"] * 4 + ["None"] * 2 + ["2"] * 2)
    assert {r.n for r in got} == {4}


def test_no_spread_and_rank(spark):
    got = whitening.whiten(frame(spark, [(i, [1.0, 2.0, 3.0]) for i in range(4)])).collect()
    assert len(got) == 12 and {(r.deviation, r.whitened, r.explained, r.identity_error) for r in got} == {(0, None, None, None)}
    rng = np.random.default_rng(2)
    flat = [(i, [a, b, a + b, a - b]) for i, (a, b) in enumerate(rng.integers(-50, 50, (30, 2)))]  # rank 2 of 4
    check(whitening.whiten(frame(spark, flat)), [v for _, v in flat], [i for i, _ in flat])


def test_equal_eigenvalues(spark):
    """A cross of points: all eigenvalues are one root, whose vectors must be orthonormal."""
    rows = [(2 * i + (s < 0), [s * 2.0 if j == i else 0.0 for j in range(6)]) for i in range(6) for s in (1, -1)]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert {r.identity_error < 1e-12 for r in got} == {True}
    assert all(r.explained == pytest.approx(1 / 6, rel=1e-12) for r in got)


def test_far_apart_and_close_roots():
    """Roots over 1e24 apart and pairs that differ by one part in 1e12."""
    want = [10**24, 10**12 + 1, 10**12, 7, 7, 0]
    c = [1]
    for r in want:  # times (x - r), lowest first
        c = [a - r * b for a, b in zip([0, *c], [*c, 0])]
    got = whitening.Roots(c).largest(6)
    flat = [Fraction(t, 1 << s) for t, s, many in got for _ in range(many)]
    assert len(flat) == 5 and all(abs(a / b - 1) < Fraction(1, 2**100) for a, b in zip(flat, want))


def test_characteristic(spark):
    rng = np.random.default_rng(3)
    b = rng.integers(-1000, 1000, (9, 9))
    m = (b @ b.T).astype(object)
    m[0, :] = m[:, 0] = 0  # a zero column: no pivot in the reduction
    got = whitening.characteristic(spark, m)

    def determinant(a):
        a, out = [[Fraction(int(v)) for v in row] for row in a], Fraction(1)
        for k in range(len(a)):
            p = next((i for i in range(k, len(a)) if a[i][k]), None)
            if p is None:
                return Fraction(0)
            if p != k:
                a[k], a[p], out = a[p], a[k], -out
            out *= a[k][k]
            for i in range(k + 1, len(a)):
                q = a[i][k] / a[k][k]
                a[i] = [x - q * y for x, y in zip(a[i], a[k])]
        return out

    for x in range(-4, 6):
        assert sum(c * x**i for i, c in enumerate(got)) == determinant(x * np.eye(9, dtype=int).astype(object) - m)


def test_large_entries_are_exact():
    rng = np.random.default_rng(4)
    f = np.floor(rng.uniform(-(2.0**61), 2.0**61, (50, 3)))
    want = [[sum(int(a) * int(b) for a, b in zip(f[:, i], f[:, j])) for j in range(3)] for i in range(3)]
    assert whitening.gram(f).tolist() == want


def test_too_many_dimensions(spark, monkeypatch):
    monkeypatch.setattr(whitening, "MAX_DIM", 3)
    with pytest.raises(Exception, match="at most 3"):
        whitening.whiten(frame(spark, [(1, [1.0] * 4), (2, [2.0] * 4)]))


def test_primes():
    got = whitening.primes_beyond(1 << 200)
    assert math.prod(got) > 1 << 200 and all(whitening.is_prime(p) for p in got) and got[0] == 2**31 - 1
    sieve = [p for p in range(2, 2000) if all(p % q for q in range(2, int(p**0.5) + 1))]
    assert [p for p in range(2000) if whitening.is_prime(p)] == sieve
