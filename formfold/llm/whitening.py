"""Whitening of integer vectors by the exact characteristic polynomial of their scatter.

1. Each entry c becomes the integer x = floor(scale * c) + shift.  The fit list holds every
   distinct vector once; its sums and products are integers, added up without rounding.
   Products are of x - shift, which changes no covariance and keeps them small.
2. C = n * sum(x x') - S S' is n * n times the covariance V.  Its characteristic polynomial is
   computed modulo primes of 31 bits, by reduction to Hessenberg form, as many primes as the
   bound of the coefficients asks for, dealt over Spark's tasks; remaindering puts the
   coefficients together, exactly.
3. All roots are real, so the sign changes of the polynomial shifted by a say exactly how many
   roots, counted with their multiplicity, lie above a.  Bisection isolates the largest roots and
   narrows each to 2 ** -`bits` of the trace.
4. A component is a null vector of C - root, by inverse iteration on an LU decomposition in
   integers of several hundred bits, a task a root.  Roots that stay together at that width
   count as equal: their components are an orthonormal basis of their common space.

What depends on the rows runs in tasks; the driver holds numbers of size dimensions squared.

A vector that is null or holds null or non-finite entries takes no part.  A vector shorter than
the longest counts as followed by zeros.  Rows of equal or null vec_id keep a row each.  Entries
beyond 64 bits after scaling are taken as the nearest 64-bit integer.  Components of eigenvalue 0
have no unit variance and are left out; so a table without rows, with one distinct vector or with
empty vectors gives no row.  Other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formfold.llm.shared import stage
from formfold.llm.vectors import matrix

LIMB = 32
EXACT = 2 ** 53


# ---- integer sums -----------------------------------------------------------------

def integers(column, dims: int) -> np.ndarray:
    """Rows of 64-bit integers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def products(rows: np.ndarray) -> np.ndarray:
    """rows' * rows as Python integers, without rounding."""
    total = np.zeros((rows.shape[1], rows.shape[1]), object)
    size = np.maximum(np.abs(rows.astype(float)).max(1, initial=0), 1)
    small = size < 2 ** 26
    for most in (2 ** 13, 2 ** 20, 2 ** 26):  # by size, so that one long vector does not slow the others
        some = rows[small & (size < most) & (size >= {2 ** 13: 0, 2 ** 20: 2 ** 13, 2 ** 26: 2 ** 20}[most])]
        step = EXACT // most ** 2
        for i in range(0, len(some), step):
            part = some[i:i + step].astype(float)
            total += (part.T @ part).astype(np.int64).astype(object)
    for row in rows[~small].astype(object):
        total += np.outer(row, row)
    return total


def scatter(fit: DataFrame, dims: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, sums, sums of products) of the vectors in `y`, as Python integers."""
    def partial(batches):
        total = np.zeros((dims + 1, dims + 1), object)
        for b in batches:
            for s in range(0, b.num_rows, 20_000):
                rows = integers(b.column(0).slice(s, 20_000), dims)
                total += products(np.column_stack([np.ones(len(rows), np.int64), rows]))
        out = []
        for i in range(dims + 1):
            for j in range(i, dims + 1):
                value, limb = int(total[i, j]), 0
                sign, value = (-1, -value) if value < 0 else (1, value)
                while value:
                    out.append((i, j, limb, sign * (value & (2 ** LIMB - 1))))
                    value, limb = value >> LIMB, limb + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[k] for x in out], pa.int32() if k < 3 else pa.int64()) for k in range(4)], names=["i", "j", "limb", "value"])

    sums = fit.mapInArrow(partial, "i int, j int, limb int, value long").groupBy("i", "j", "limb").agg(F.sum("value").alias("value"))
    whole = np.zeros((dims + 1, dims + 1), object)
    for r in sums.toArrow().to_pylist():  # some limbs for each pair of dimensions
        whole[r["i"], r["j"]] += r["value"] << (LIMB * r["limb"])
    whole += np.triu(whole, 1).T
    return whole[0, 0], whole[0, 1:], whole[1:, 1:]


# ---- characteristic polynomial ----------------------------------------------------

def is_prime(n: int) -> bool:
    """Exact below 3,215,031,751 by these bases."""
    if n < 2 or any(n % p == 0 for p in (2, 3, 5, 7)):
        return n in (2, 3, 5, 7)
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for a in (2, 3, 5, 7):
        x = pow(a, odd, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_for(bound: int) -> list[int]:
    """The largest primes below 2 ** 31 whose product is above the bound."""
    out, product, p = [], 1, 2 ** 31 - 1
    while product <= bound:
        if is_prime(p):
            out.append(p)
            product *= p
        p -= 2
    return out


def inverse(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """x ** (p - 2): the inverse modulo each prime, 0 for 0."""
    out, power, left = np.ones_like(x), x.copy(), p - 2
    while left.any():
        out = np.where(left & 1, out * power % p, out)
        power = power * power % p
        left = left >> 1
    return out


def hessenberg(a: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Similar matrices (primes, d, d) with zeros below the first subdiagonal, modulo each prime."""
    a, d, cube = a.copy(), a.shape[1], p[:, None, None]
    each = np.arange(len(a))
    for k in range(d - 2):
        pivot = k + 1 + (a[:, k + 1:, k] != 0).argmax(1)
        rows, below = a[each, pivot].copy(), a[:, k + 1].copy()
        a[each, pivot], a[:, k + 1] = below, rows
        columns, beside = a[each, :, pivot].copy(), a[:, :, k + 1].copy()
        a[each, :, pivot], a[:, :, k + 1] = beside, columns
        factor = a[:, k + 2:, k] * inverse(a[:, k + 1, k], p)[:, None] % p[:, None]
        a[:, k + 2:] = (a[:, k + 2:] - factor[:, :, None] * a[:, None, k + 1] % cube) % cube
        a[:, :, k + 1] = (a[:, :, k + 1] + (a[:, :, k + 2:] * factor[:, None] % cube).sum(2)) % p[:, None]
    return a


def polynomials(a: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Coefficients of det(t - a) modulo each prime, the leading 1 first."""
    h, d, col = hessenberg(a, p), a.shape[1], p[:, None]
    made = [np.zeros((len(p), d + 1), np.int64)]  # ascending powers
    made[0][:, 0] = 1
    for k in range(1, d + 1):
        last = made[-1]
        new = np.roll(last, 1, axis=1) - h[:, k - 1, k - 1, None] * last % col
        chain = np.ones(len(p), np.int64)
        for i in range(1, k):
            chain = chain * h[:, k - i, k - i - 1] % p
            new = new - (chain * h[:, k - i - 1, k - 1] % p)[:, None] * made[k - i - 1] % col
        made.append(new % col)
    return made[-1][:, ::-1]


def remaindered(residues: np.ndarray, primes: list[int]) -> list[int]:
    """The integers from 0 up that have these residues (primes, numbers)."""
    product = math.prod(primes)
    weights = [product // p * pow(product // p, -1, p) for p in primes]
    return [sum(int(r) * w for r, w in zip(column, weights)) % product for column in residues.T]


def characteristic(spark: SparkSession, c: np.ndarray) -> list[int]:
    """Coefficients of det(t - c), the leading 1 first, of a positive semidefinite integer matrix.

    Their signs alternate, and the k-th is at most binomial(d, k) * (trace / d) ** k.
    """
    d, trace = len(c), int(np.trace(c))
    bound = max(math.comb(d, k) * trace ** k // d ** k for k in range(d + 1)) + 1
    primes = primes_for(bound)

    def reduced(batches):
        for b in batches:
            p = b.column(0).to_numpy()
            for i in range(0, len(p), 32):
                some = p[i:i + 32].astype(np.int64)
                a = np.stack([(c % int(q)).astype(np.int64) for q in some])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some), pa.array(list(polynomials(a, some)), pa.list_(pa.int64()))], names=["prime", "residues"])

    dealt = spark.createDataFrame([(p,) for p in primes], "prime long").repartition(min(len(primes), 64))
    found = {r["prime"]: r["residues"] for r in dealt.mapInArrow(reduced, "prime long, residues array<long>").toArrow().to_pylist()}
    residues = np.array([found[p] for p in primes])
    # of -1 ** k * coefficient, which is not negative
    residues[:, 1::2] = -residues[:, 1::2] % np.array(primes)[:, None]
    return [x if k % 2 == 0 else -x for k, x in enumerate(remaindered(residues, primes))]


# ---- roots ------------------------------------------------------------------------

def above(coefficients: list[int], a: int) -> int:
    """How many roots, with multiplicity, are larger than a; exact where all roots are real."""
    shifted = list(coefficients)
    for n in range(len(shifted) - 1, 0, -1):
        for i in range(1, n + 1):
            shifted[i] += shifted[i - 1] * a
    signs = [x > 0 for x in shifted if x]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def value(coefficients: list[int], a: int) -> int:
    out = 0
    for x in coefficients:
        out = out * a + x
    return out


def largest_roots(coefficients: list[int], trace: int, k: int, bits: int) -> list[tuple[Fraction, int]]:
    """(root, multiplicity) of the k largest positive roots, falling; a root is known to
    trace * 2 ** -bits, and roots that near to each other are one."""
    scale = max(0, bits - trace.bit_length())
    c = [x << (scale * i) for i, x in enumerate(coefficients)]
    width = max(1, trace >> bits) if not scale else 1
    high = (trace << scale) + 1
    out, found = [], 0
    open_ = [(0, high, above(c, 0), 0)]  # (low, high], how many are above low, and above high
    while open_ and found < k:
        low, high, n_low, n_high = open_.pop()
        if n_low == n_high:
            continue
        if n_low - n_high == 1 or high - low <= width:
            while high - low > width:
                middle = (low + high) // 2
                y = value(c, middle)
                # the sign of the polynomial tells whether an even or odd number is above
                if y and (y < 0) == bool((n_high + 1) % 2):
                    low = middle
                else:
                    high = middle
            out.append((Fraction(high, 1 << scale), n_low - n_high))
            found += n_low - n_high
            continue
        middle = (low + high) // 2
        n = above(c, middle)
        open_ += [(low, middle, n_low, n), (middle, high, n, n_high)]
    return out


# ---- components -------------------------------------------------------------------

def null_vectors(c: np.ndarray, root: Fraction, count: int, bits: int) -> np.ndarray:
    """An orthonormal basis (count, d) of the space in which c acts as the root, by inverse
    iteration in fixed point with `bits` bits behind the point."""
    d, one = len(c), 1 << bits
    a = c * one
    a[np.arange(d), np.arange(d)] -= root.numerator * one // root.denominator
    order, factors = np.arange(d), []
    for k in range(d):
        pivot = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
        a[[k, pivot]], order[[k, pivot]] = a[[pivot, k]], order[[pivot, k]]
        if len(factors):
            for f in factors:
                f[[k, pivot]] = f[[pivot, k]]
        a[k, k] = a[k, k] or 1
        f = np.zeros(d, object)
        f[k + 1:] = a[k + 1:, k] * one // a[k, k]
        a[k + 1:, k + 1:] -= np.outer(f[k + 1:], a[k, k + 1:]) >> bits
        factors.append(f)

    def solved(b):
        x = b[order] * one
        for k in range(d):
            x[k + 1:] -= factors[k][k + 1:] * x[k] >> bits
        for k in range(d - 1, -1, -1):
            x[k] = x[k] * one // a[k, k]
            x[:k] -= a[:k, k] * x[k] >> bits
        return unit(x)

    def unit(x):
        x = x * one // max(1, max(abs(v) for v in x))
        return x * one // max(1, math.isqrt(sum(v * v for v in x)))

    basis = []
    for m in range(count):
        x = np.array([(one >> 8) * (1 + (7919 * (m + 1) * (i + 1) ** 2 + 104_729 * i * m) % 251) for i in range(d)], object)
        for _ in range(3):
            x = solved(x)
            for _ in range(2):
                for u in basis:
                    x = x - (u * (sum(u * x) >> bits) >> bits)
            x = unit(x)
        basis.append(x)
    return np.array([[float(Fraction(int(v), one)) for v in x] for x in basis])


class Whitening:
    """Components of a fit list: n, sums (of x - shift), vectors (components, dims), eigenvalues
    of the covariance and their shares of its trace."""

    def __init__(self, spark: SparkSession, n: int, sums: np.ndarray, squares: np.ndarray, components: int, bits: int = 160):
        c = n * squares - np.outer(sums, sums)
        trace, d = int(np.trace(c)), len(c)
        self.n, self.sums, self.vectors = n, sums, np.zeros((0, d))
        self.eigenvalues, self.explained = np.zeros(0), np.zeros(0)
        if not trace:
            return
        roots = largest_roots(characteristic(spark, c), trace, components, bits)
        inner = 2 * bits + trace.bit_length() + 64

        def solve(batches):
            for b in batches:
                for i in b.column(0).to_pylist():
                    found = null_vectors(c, *roots[i], inner)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([i] * len(found), pa.int32()), pa.array(list(found), pa.list_(pa.float64()))], names=["root", "vector"])

        dealt = spark.createDataFrame([(i,) for i in range(len(roots))], "root int").repartitionByRange(len(roots), "root")
        solved = dealt.mapInArrow(solve, "root int, vector array<double>").toArrow().to_pylist()
        solved.sort(key=lambda r: r["root"])
        solved = solved[:components]
        self.vectors = np.array([r["vector"] for r in solved])
        self.eigenvalues = np.array([float(roots[r["root"]][0] / n ** 2) for r in solved])
        self.explained = np.array([float(roots[r["root"]][0] / trace) for r in solved])

    def centred(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(n * x - S as doubles, the sum of its squares as integers) of each row."""
        most = self.n * max(1, int(np.abs(rows.astype(float)).max(initial=0))) + max(abs(int(s)) for s in self.sums)
        if most ** 2 * rows.shape[1] < 2 ** 62:
            z = self.n * rows - self.sums.astype(np.int64)
            return z.astype(float), (z * z).sum(1).astype(object)
        z = self.n * rows.astype(object) - self.sums
        return z.astype(float), (z * z).sum(1)

    def project(self, z: np.ndarray) -> np.ndarray:
        return z @ self.vectors.T / self.n / np.sqrt(self.eigenvalues)


def identity_error(fit: DataFrame, w: Whitening, dims: int) -> float:
    """Largest entry of the covariance of the whitened fit list minus the identity."""
    k = len(w.vectors)

    def partial(batches):
        total = np.zeros((k + 1, k + 1))
        for b in batches:
            for s in range(0, b.num_rows, 20_000):
                x = w.project(w.centred(integers(b.column(0).slice(s, 20_000), dims))[0])
                x = np.column_stack([np.ones(len(x)), x])
                total += x.T @ x
        i, j = np.triu_indices(k + 1)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["i", "j", "value"])

    sums = fit.mapInArrow(partial, "i long, j long, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))
    whole = np.zeros((k + 1, k + 1))
    for r in sums.toArrow().to_pylist():
        whole[r["i"], r["j"]] = whole[r["j"], r["i"]] = r["value"]
    mean = whole[0, 1:] / w.n  # the rows are centred already: what is left is rounding
    return float(np.abs(whole[1:, 1:] / w.n - np.outer(mean, mean) - np.eye(k)).max())


def scaled(embedding: Column, scale: int) -> Column:
    return F.transform(embedding, lambda c: F.floor(c.cast("double") * F.lit(float(scale))))


SCHEMA = ("vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, "
          "identity_error double, eigenvalue double")


def whiten(vectors: DataFrame, components: int = 16, scale: int = 64) -> DataFrame:
    """A row for each vector and component: n vectors of the fit list, the vector's deviation
    (sum of (n * x - S) ** 2, exact), its whitened coordinate, the component's share of the
    variance, and how far the whitened fit list is from unit covariance.  A shift of x by a
    constant changes none of them."""
    spark = vectors.sparkSession
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(
        F.col("embedding").isNotNull() & ~F.exists("embedding", bad))
    dims = rows.agg(F.max(F.size("embedding"))).first()[0]
    if not dims:
        return spark.createDataFrame([], SCHEMA)
    y = scaled(F.col("embedding"), scale)
    whole = F.when(F.size("embedding") == dims, y).otherwise(
        F.concat(y, F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("embedding"))))
    rows = rows.select("vec_id", whole.alias("y"))
    fit = stage(rows.select("y").distinct(), "fit-list")
    w = Whitening(spark, *scatter(fit, dims), components)
    if not len(w.vectors):
        return spark.createDataFrame([], SCHEMA)
    error, k = identity_error(fit, w, dims), len(w.vectors)

    def project(batches):
        for b in batches:
            for s in range(0, b.num_rows, 4000):
                part = b.slice(s, 4000)
                z, deviation = w.centred(integers(part.column(1), dims))
                n = part.num_rows
                deviation = pa.array([int(x) for x in deviation], pa.decimal128(38, 0))
                at = pa.array(np.repeat(np.arange(n), k))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                     pa.array(np.full(n * k, w.n)), deviation.take(at), pa.array(w.project(z).reshape(-1)),
                     pa.array(np.tile(w.explained, n)), pa.array(np.full(n * k, error)), pa.array(np.tile(w.eigenvalues, n))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "eigenvalue"])

    return rows.mapInArrow(project, SCHEMA)
