"""Operator 11: embedding whitening by the exact characteristic polynomial.

Entries become integers, floor(64 * c) + 1000000.  Covariance does not see the added million,
so the sums work on f = floor(64 * c).

    scatter     per task the exact sums of f and f f^T, added up in Spark as limbs of 40 bits:
                M = n * sum(f f^T) - sum(f) sum(f)^T is n^2 times the covariance, in integers
    polynomial  det(xI - M) modulo primes below 2^31, a block of primes per task, each by
                reduction to Hessenberg form; Chinese remaindering gives its integer coefficients
    roots       all roots are real and none is negative, so the sign changes of the coefficients shifted to
                t count those above t exactly (Descartes).  Bisection on dyadic numbers
                isolates a root, which sign bisection narrows to `BITS` bits; roots that never part are one root of that multiplicity
    components  inverse iteration on M - root in fixed point with `POINT` fractional bits, a task per
                root; the vectors of a multiple root are made orthonormal
    whiten      a last pass writes (n x - S) . v / sqrt(root) of every row; the pass before sums its covariance

Only matrices of the vectors' dimension (`MAX_DIM` at most) reach the driver.

Defined cases: rows whose vector is null, holds null or non-finite entries, or an entry whose x is
no 64-bit integer, are dropped.  Of vectors of several lengths those of the most frequent length
(of equally frequent ones the longest) are the fit list, the others are dropped, empty vectors too.
Null and repeated vec_ids are rows like any other.  A component of eigenvalue 0 has no whitened
value (null) and no part in the identity error; if all are 0, explained is null.  The first largest entry of
a component is positive.  A deviation beyond 64 bits is null.  Further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablehouse.llm.common import fit, mix, prepare

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32
MAX_DIM = 1024
LIMB = 40
BITS, POINT, TURNS = 160, 224, 3
PRIMES_EACH = 8


# ---- vectors ---------------------------------------------------------------------------


def vectors(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length of the vectors: their rows and the matrix of floor(64 * c), integers as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    held = ~column.is_null().to_numpy(zero_copy_only=False)
    off = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)  # null entries become NaN
    with np.errstate(over="ignore", invalid="ignore"):
        f = np.floor(SCALE * values)
        good = np.abs(f) < 2.0**62
    bad = np.concatenate(([0], np.cumsum(~good)))
    sizes = np.diff(off)
    held &= (bad[off[1:]] == bad[off[:-1]]) & (sizes > 0)
    out = {}
    for d in np.unique(sizes[held]):
        rows = np.flatnonzero(held & (sizes == d))
        out[int(d)] = rows, f[off[rows][:, None] + np.arange(d)]
    return out


def gram(f: np.ndarray) -> np.ndarray:
    """f^T f in exact integers (as objects)."""
    most = float(np.abs(f).max(initial=0.0))
    if most * most * len(f) < 2.0**53:
        return (f.T @ f).astype(np.int64).astype(object)
    x, parts = f.astype(np.int64), []
    for _ in range(4):  # signed limbs of 18 bits; products of 1000 rows stay below 2^53
        parts.append((x & 0x3FFFF).astype(np.float64) if len(parts) < 3 else x.astype(np.float64))
        x = x >> 18
    out = np.zeros((f.shape[1],) * 2, object)
    for at in range(0, len(f), 1 << 16):
        for i, a in enumerate(parts):
            for j, b in enumerate(parts):
                out += (a[at : at + (1 << 16)].T @ b[at : at + (1 << 16)]).astype(np.int64).astype(object) << (18 * (i + j))
    return out


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and dimension: count, sums and the upper triangle of products, in limbs."""
    held: dict[int, list] = {}
    for batch in batches:
        for d, (_, f) in vectors(batch.column("embedding")).items():
            if d > MAX_DIM:
                raise ValueError(f"vectors of {d} entries, at most {MAX_DIM}")
            total = np.array([int(v) for v in f.sum(0)], object) if np.abs(f).max() * len(f) < 2.0**53 else f.astype(np.int64).astype(object).sum(0)
            kept = held.setdefault(d, [0, 0, 0])
            held[d] = [kept[0] + len(f), kept[1] + total, kept[2] + gram(f)]
    for d, (n, total, products) in held.items():
        value = [n, *total, *products[np.triu_indices(d)]]
        limb = 0
        while value:
            high = [v >> LIMB for v in value]
            last = all(-1 <= h <= 0 for h in high) and all(-(1 << LIMB) <= v < (1 << LIMB) for v in value)
            low = value if last else [v & ((1 << LIMB) - 1) for v in value]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(low), d, np.int32)), pa.array(np.arange(len(low), dtype=np.int32)),
                pa.array(np.full(len(low), limb, np.int32)), pa.array(low, pa.int64())], names=["dim", "pos", "limb", "value"])
            value, limb = (None if last else high), limb + 1


class Scatter:
    """What the fit list amounts to: count n, sums, and n^2 times the covariance, in integers."""

    def __init__(self, n: int, total: np.ndarray, matrix: np.ndarray):
        self.n, self.total, self.matrix = n, total, matrix

    @property
    def dim(self) -> int:
        return len(self.total)


def scatter(embeddings: DataFrame) -> Scatter | None:
    """The exact scatter of the most frequent dimension, None if no vector remains."""
    sums = fit(embeddings, embedding="array<double>").mapInArrow(_sums, "dim int, pos int, limb int, value long")
    sums = sums.groupBy("dim", "pos", "limb").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).persist()
    counts: dict[int, int] = {}
    for r in sums.filter("pos = 0").collect():
        counts[r.dim] = counts.get(r.dim, 0) + (int(r.value) << (LIMB * r.limb))
    if not counts:
        sums.unpersist()
        return None
    n, d = max((c, d) for d, c in counts.items())
    value = [0] * (1 + d + d * (d + 1) // 2)
    for r in sums.filter(F.col("dim") == d).select("pos", "limb", "value").collect():
        value[r.pos] += int(r.value) << (LIMB * r.limb)
    sums.unpersist()
    total = np.array(value[1 : d + 1], object)
    products = np.zeros((d, d), object)
    products[np.triu_indices(d)] = value[d + 1 :]
    products = np.triu(products, 1).T + products
    return Scatter(n, total, n * products - np.outer(total, total))


# ---- characteristic polynomial ---------------------------------------------------------


def is_prime(p: int) -> bool:
    """Miller-Rabin with bases that decide every number below 3.4e14."""
    if p < 2 or any(p % q == 0 for q in (2, 3, 5, 7, 11, 13, 17)):
        return p in (2, 3, 5, 7, 11, 13, 17)
    odd, twos = p - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for a in (2, 3, 5, 7, 11, 13, 17):
        x = pow(a, odd, p)
        if x not in (1, p - 1) and not any((x := x * x % p) == p - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """The largest primes below 2^31, as many as it takes for their product to exceed `bound`."""
    out, product, p = [], 1, 1 << 31
    while product <= bound:
        p -= 1
        if is_prime(p):
            out.append(p)
            product *= p
    return out


def coefficient_bound(matrix: np.ndarray) -> int:
    """No coefficient is larger: elementary symmetric means of non-negative roots (Maclaurin)."""
    d = len(matrix)
    mean = -(-int(np.trace(matrix)) // d)
    return max(math.comb(d, k) * mean**k for k in range(d + 1))


def polynomial_mod(matrix: np.ndarray, primes: list[int]) -> np.ndarray:
    """Coefficients of det(xI - matrix) modulo each prime, lowest first; all primes side by side."""
    d, p = len(matrix), np.array(primes, np.int64)
    h = np.array([[[int(v) % q for v in row] for row in matrix] for q in primes], np.int64)
    each, q2, q3 = np.arange(len(p)), p[:, None], p[:, None, None]
    for k in range(d - 2):
        pivot = k + 1 + np.argmax(h[:, k + 1 :, k] != 0, axis=1)
        order = np.tile(np.arange(d), (len(p), 1))
        order[each, pivot], order[:, k + 1] = k + 1, pivot
        h = np.take_along_axis(np.take_along_axis(h, order[:, :, None], 1), order[:, None, :], 2)
        inverse = np.array([pow(int(v), -1, int(q)) if v else 0 for v, q in zip(h[:, k + 1, k], p)], np.int64)
        u = h[:, k + 2 :, k] * inverse[:, None] % q2
        h[:, k + 2 :, :] = (h[:, k + 2 :, :] - u[:, :, None] * h[:, k + 1, None, :] % q3) % q3
        h[:, :, k + 1] = (h[:, :, k + 1] + (h[:, :, k + 2 :] * u[:, None, :] % q3).sum(2)) % q2
    polys = [np.zeros((len(p), d + 1), np.int64)]
    polys[0][:, 0] = 1
    for k in range(1, d + 1):
        new = np.zeros_like(polys[0])
        new[:, 1:] = polys[k - 1][:, :-1]
        new = (new - h[:, k - 1, k - 1, None] * polys[k - 1]) % q2
        down = np.ones(len(p), np.int64)
        for i in range(1, k):
            down = down * h[:, k - i, k - i - 1] % p
            new = (new - (h[:, k - i - 1, k - 1] * down % p)[:, None] * polys[k - i - 1]) % q2
        polys.append(new)
    return polys[d]


def characteristic(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Integer coefficients of det(xI - matrix), lowest first, for a matrix without negative eigenvalues."""
    d, primes = len(matrix), primes_beyond(2 * coefficient_bound(matrix))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.column(0).to_pylist():
                mine = primes[b * PRIMES_EACH : (b + 1) * PRIMES_EACH]
                yield pa.RecordBatch.from_arrays([pa.array(mine, pa.int64()), pa.array(polynomial_mod(matrix, mine).tolist(), pa.list_(pa.int64()))], names=["prime", "coefficients"])

    n = -(-len(primes) // PRIMES_EACH)
    found = spark.range(0, n, 1, n).mapInArrow(blocks, "prime long, coefficients array<long>").collect()
    value, modulus = [0] * (d + 1), 1
    for r in sorted(found, key=lambda r: r.prime):
        inverse = pow(modulus, -1, r.prime)
        value = [v + modulus * ((c - v) * inverse % r.prime) for v, c in zip(value, r.coefficients)]
        modulus *= r.prime
    return [v - modulus if 2 * v > modulus else v for v in value]


# ---- roots -----------------------------------------------------------------------------


class Roots:
    """Roots of an integer polynomial all of whose roots are real and not negative."""

    def __init__(self, coefficients: list[int]):
        self.zeros = next(i for i, c in enumerate(coefficients) if c)
        self.c = coefficients[self.zeros :]
        self.top = max(-self.c[-2], 0).bit_length() + 1 if len(self.c) > 1 else 1  # the sum of the roots is below 2^top
        self.seen: dict[tuple[int, int], int] = {}

    def _scaled(self, s: int) -> list[int]:
        d = len(self.c) - 1
        return [c << (s * (d - i)) for i, c in enumerate(self.c)]

    def above(self, t: int, s: int) -> int:
        """How many roots exceed t / 2^s, with their multiplicities."""
        if (t, s) not in self.seen:
            c = self._scaled(s)
            for i in range(len(c) - 1):  # the polynomial about t, by repeated synthetic division
                for j in range(len(c) - 2, i - 1, -1):
                    c[j] += t * c[j + 1]
            signs = [v > 0 for v in c if v]
            self.seen[t, s] = sum(a != b for a, b in zip(signs, signs[1:]))
        return self.seen[t, s]

    def largest(self, most: int) -> list[tuple[int, int, int]]:
        """The largest distinct positive roots with at least `most` in all: (t, s, multiplicity), root t / 2^s."""
        out, done, d = [], 0, len(self.c) - 1
        while done < min(most, d):
            low, high, s = 0, 1 << self.top, 0
            while True:  # the (done + 1)th root lies above low / 2^s and not above high / 2^s
                if self.above(low, s) - self.above(high, s) == 1 or low.bit_length() > BITS:
                    break
                if high - low == 1:
                    low, high, s = 2 * low, 2 * high, s + 1
                middle = (low + high) // 2
                if self.above(middle, s) > done:
                    low = middle
                else:
                    high = middle
            many = self.above(low, s) - self.above(high, s)
            if many == 1:
                low, high, s = self._narrow(low, high, s)
            out.append((low + high, s + 1, many))
            done += many
        return out

    def _sign(self, t: int, s: int) -> int:
        value = 0
        for i, c in enumerate(reversed(self.c)):
            value = value * t + (c << (s * i))
        return (value > 0) - (value < 0)

    def _narrow(self, low: int, high: int, s: int) -> tuple[int, int, int]:
        """A simple root above low and not above high, to `BITS` bits by signs alone."""
        at_high = self._sign(high, s)
        if at_high == 0:
            return high, high, s
        while low.bit_length() <= BITS:
            if high - low == 1:
                low, high, s = 2 * low, 2 * high, s + 1
            middle = (low + high) // 2
            sign = self._sign(middle, s)
            if sign == 0:
                return middle, middle, s
            if sign == at_high:
                high = middle
            else:
                low = middle
        return low, high, s


# ---- eigenvectors ----------------------------------------------------------------------


class Shifted:
    """matrix - root in fixed point, factored with row exchanges."""

    def __init__(self, matrix: np.ndarray, t: int, s: int):
        d = len(matrix)
        a = np.array([[int(v) << POINT for v in row] for row in matrix], object)
        root = t << (POINT - s) if s <= POINT else t >> (s - POINT)
        for i in range(d):
            a[i, i] -= root
        self.order = np.arange(d)
        for k in range(d):
            pivot = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
            if pivot != k:
                a[[k, pivot]], self.order[[k, pivot]] = a[[pivot, k]], self.order[[pivot, k]]
            if not a[k, k]:
                a[k, k] = 1  # the root itself to all bits: one unit in the last place off
            a[k + 1 :, k] = (a[k + 1 :, k] << POINT) // a[k, k]
            a[k + 1 :, k + 1 :] -= (a[k + 1 :, k, None] * a[k, None, k + 1 :]) >> POINT
        self.a = a

    def solve(self, b: np.ndarray) -> np.ndarray:
        x = b[self.order].copy()
        for k in range(len(x)):
            x[k + 1 :] -= (self.a[k + 1 :, k] * x[k]) >> POINT
        for k in range(len(x) - 1, -1, -1):
            x[k] = (x[k] << POINT) // self.a[k, k]
            x[:k] -= (self.a[:k, k] * x[k]) >> POINT
        return x


def _unit(x: np.ndarray) -> np.ndarray:
    length = math.isqrt(sum(int(v) * int(v) for v in x)) or 1
    return np.array([(int(v) << POINT) // length for v in x], object)


def eigenvectors(matrix: np.ndarray, t: int, s: int, many: int) -> list[np.ndarray]:
    """`many` orthonormal eigenvectors of the root t / 2^s, as doubles."""
    d, shifted = len(matrix), Shifted(matrix, t, s)
    found: list[np.ndarray] = []
    for i in range(many):
        x = np.array([int(v) for v in mix(np.arange(1, d + 1, dtype=np.uint64) + np.uint64(i * d))], object) - (1 << 63)
        for _ in range(TURNS):
            x = _unit(x)
            for v in found + found:
                x = x - ((v * (int((x * v).sum()) >> POINT)) >> POINT)
            x = _unit(shifted.solve(x))
        for v in found + found:
            x = x - ((v * (int((x * v).sum()) >> POINT)) >> POINT)
        found.append(_unit(x))
    out = []
    for x in found:
        v = np.array([int(e) / (1 << POINT) for e in x])
        out.append(-v if v[np.argmax(np.abs(v))] < 0 else v)
    return out


class Components:
    """The first components of a scatter: vectors, eigenvalues (of n^2 times the covariance) and shares."""

    def __init__(self, spark: SparkSession, data: Scatter, most: int = COMPONENTS):
        self.n, self.total, d = data.n, data.total, data.dim
        self.most = min(most, d)
        trace = int(np.trace(data.matrix))
        roots = Roots(characteristic(spark, data.matrix)).largest(self.most) if trace else []
        matrix = data.matrix

        def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in batch.column(0).to_pylist():
                    found = eigenvectors(matrix, *roots[i])
                    yield pa.RecordBatch.from_arrays([pa.array([i] * len(found), pa.int64()), pa.array(range(len(found)), pa.int32()),
                                                      pa.array([v.tolist() for v in found], pa.list_(pa.float64()))], names=["root", "copy", "vector"])

        rows = spark.range(0, len(roots), 1, len(roots)).mapInArrow(solve, "root long, copy int, vector array<double>").collect() if roots else []
        rows = sorted(rows, key=lambda r: (r.root, r.copy))[: self.most]
        self.vectors = np.array([r.vector for r in rows]).reshape(len(rows), d).T
        self.root = np.array([roots[r.root][0] / (1 << roots[r.root][1]) for r in rows])
        self.share = [roots[r.root][0] / (trace << roots[r.root][1]) for r in rows] + [0.0 if trace else None] * (self.most - len(rows))
        self.error = None

    def project(self, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Deviations (objects, exact) and whitened values of rows of floor(64 * c)."""
        most = int(np.abs(f).max(initial=0.0)) * self.n + max((abs(int(t)) for t in self.total), default=0)
        if most < 2**62:
            y = f.astype(np.int64) * self.n - self.total.astype(np.int64)
        else:
            y = f.astype(np.int64).astype(object) * self.n - self.total
        deviation = (y * y).sum(1) if most * most * max(len(self.total), 1) < 2**62 else (y.astype(object) ** 2).sum(1)
        return deviation, y.astype(np.float64) @ (self.vectors / np.sqrt(self.root))


def _second_moments(model: Components) -> Callable:
    """Per task the sums of products of whitened values, whose mean is 0 by construction."""
    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, d = len(model.root), len(model.total)
        total = np.zeros((r, r))
        for batch in batches:
            found = vectors(batch.column("embedding"))
            if d in found:
                _, w = model.project(found[d][1])
                total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(r * r, dtype=np.int32)), pa.array(total.ravel())], names=["pos", "value"])
    return moments


def _rows(model: Components) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d, r, most = len(model.total), len(model.root), model.most
        for batch in batches:
            found = vectors(batch.column("embedding"))
            if d not in found:
                continue
            kept, f = found[d]
            deviation, w = model.project(f)
            deviation = pa.array([int(v) if v < 2**63 else None for v in deviation], pa.int64())
            whitened = np.full((len(kept), most), np.nan)
            whitened[:, :r] = w
            each = pa.array(np.repeat(np.arange(len(kept)), most))
            component = np.tile(np.arange(1, most + 1, dtype=np.int32), len(kept))
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(pa.array(kept)).take(each), pa.array(component), deviation.take(each),
                pa.array(whitened.ravel(), mask=component > r), pa.array(model.share, pa.float64()).take(pa.array(component - 1))],
                names=["vec_id", "component", "deviation", "whitened", "explained"])
    return rows


def components(embeddings: DataFrame, most: int = COMPONENTS) -> Components | None:
    """The fitted components with their identity error, None if no vector remains."""
    spark = prepare(embeddings.sparkSession)
    data = scatter(embeddings)
    if data is None:
        return None
    model = Components(spark, data, most)
    r = len(model.root)
    if r:
        sums = fit(embeddings, embedding="array<double>").mapInArrow(_second_moments(model), "pos int, value double").groupBy("pos").agg(F.sum("value").alias("value"))
        cov = np.zeros(r * r)
        for row in sums.collect():
            cov[row.pos] = row.value / data.n
        model.error = float(np.abs(cov.reshape(r, r) - np.eye(r)).max())
    return model


def whiten(embeddings: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for each remaining row and component."""
    model = components(embeddings, most)
    rows = fit(embeddings, vec_id="long", embedding="array<double>")
    schema = "vec_id long, component int, deviation long, whitened double, explained double"
    found = rows.mapInArrow(_rows(model), schema) if model else embeddings.sparkSession.createDataFrame([], schema)
    return found.select("vec_id", "component", F.lit(model.n if model else 0).cast("long").alias("n"), "deviation", "whitened", "explained",
                        F.lit(model.error if model else None).cast("double").alias("identity_error"))
