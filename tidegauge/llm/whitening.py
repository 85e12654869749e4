"""Embedding whitening by the exact characteristic polynomial of the integer scatter.

Entries become integers, so the scatter ``M = n * sum(x x') - S S'`` of the distinct
vectors, n squared times their covariance, is known exactly. Its characteristic polynomial
is computed modulo many primes, each by a reduction to Hessenberg form in a task of its own,
and put together by Chinese remaindering. All its roots are real, so sign changes of the
shifted polynomial count the roots above any point: the largest ones are isolated and
narrowed by bisection in whole numbers. Inverse iteration in decimal arithmetic then
finds the null space of ``M - root``, one task for each component.

What the driver and every task hold is the scatter and the polynomial, whose size follows
from the dimension of the vectors, whatever the number of rows.
"""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence
from decimal import Decimal, localcontext
from fractions import Fraction
from math import ceil, log2

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import written

SCALE = 256
#: Bits of a root behind its first one.
ROOT_BITS = 128
#: Digits of the null-space arithmetic: those of a root, doubled for what pivots cancel.
DIGITS = 80
LIMB = 40


# --- Integer vectors -----------------------------------------------------------


def integer_vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``floor(256 c)`` of every entry, one after another, the length of each row's vector
    and whether it is usable: not null, and all entries finite and a long when scaled."""
    column = column.cast(pa.list_(pa.float64()))
    length = np.diff(column.offsets.to_numpy())
    present = column.is_valid().to_numpy(zero_copy_only=False)
    values = column.values.slice(column.offsets[0].as_py(), int(length.sum()))
    scaled = np.floor(SCALE * values.fill_null(float("nan")).to_numpy(zero_copy_only=False))
    fits = np.abs(scaled) < 2.0**62
    bad = np.concatenate([[0], np.cumsum(~fits)])
    end = np.cumsum(length)
    usable = present & (bad[end] == bad[end - length])
    return np.where(fits, scaled, 0).astype(np.int64), length, usable


def _matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """The usable vectors of ``dim`` entries as rows, and where they stand in the column."""
    x, length, usable = integer_vectors(column)
    at = np.flatnonzero(usable & (length == dim))
    begin = (np.cumsum(length) - length)[at]
    return x[begin[:, None] + np.arange(dim)], at


def _packed(row: np.ndarray) -> bytes:
    """A vector in the narrowest of 2 and 8 bytes an entry: equal vectors, equal bytes."""
    narrow = row.size and -32768 <= row.min() and row.max() <= 32767
    return row.astype("<i2" if narrow else "<i8").tobytes()


def _unpacked(column: pa.Array, dim: int) -> np.ndarray:
    cells = [c.as_buffer() for c in column]
    if all(c.size == 2 * dim for c in cells):
        return np.frombuffer(b"".join(cells), "<i2").reshape(-1, dim).astype(np.int64)
    return np.array(
        [np.frombuffer(c, "<i2" if c.size == 2 * dim else "<i8") for c in cells], np.int64
    ).reshape(-1, dim)


def fit_list(rows: DataFrame, vector: str) -> DataFrame:
    """Each distinct usable integer vector once: ``dim``, ``x``. Repeated vectors fall
    together in each task before the shuffle."""
    schema = pa.schema([("dim", pa.int32()), ("x", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, length, usable = integer_vectors(batch.column(0))
            end = np.cumsum(length)
            at = np.flatnonzero(usable & (length > 0))
            cells = [_packed(x[end[i] - length[i] : end[i]]) for i in at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(length[at], pa.int32()), pa.array(cells, pa.binary())], schema=schema
            )

    return rows.select(vector).mapInArrow(run, "dim int, x binary").distinct()


# --- Exact scatter -------------------------------------------------------------


def exact_gram(x: np.ndarray) -> np.ndarray:
    """``x' x`` as whole numbers of any size. Entries are cut into signed limbs so short that
    products of doubles and their sums stay exact."""
    largest = int(np.abs(x).max(initial=0))
    if largest**2 * len(x) < 1 << 53:
        d = x.astype(np.float64)
        return (d.T @ d).astype(np.int64).astype(object)
    bits = 20
    total = np.zeros((x.shape[1],) * 2, object)
    for block in np.array_split(x, -(-len(x) // 4096)):
        limbs, rest = [], block
        while rest.any():
            low = ((rest + (1 << bits - 1)) & ((1 << bits) - 1)) - (1 << bits - 1)
            limbs.append(low.astype(np.float64))
            rest = (rest - low) >> bits
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                total += (a.T @ b).astype(np.int64).astype(object) << (bits * (i + j))
    return total


def scatter(fit: DataFrame, dim: int) -> tuple[int, list[int], np.ndarray]:
    """Number of vectors, their sums, and ``n * sum(x x') - S S'``, all exact.

    Each task sums its own vectors; the totals travel in limbs of 40 bits, a few numbers for
    each pair of dimensions and task, and are summed before they reach the driver.
    """
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("limb", pa.int32()), ("part", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A leading column of ones makes the sums and the count part of the products.
        total = np.zeros((dim + 1, dim + 1), object)
        for batch in batches:
            x = _unpacked(batch.column(0), dim)
            total += exact_gram(np.hstack([np.ones((len(x), 1), np.int64), x]))
        rows = []
        for i in range(dim + 1):
            for j in range(i, dim + 1):
                value, limb = int(total[i, j]), 0
                while value:
                    part = value & ((1 << LIMB) - 1) if value > 0 else -(-value & ((1 << LIMB) - 1))
                    rows.append((i, j, limb, part))
                    value, limb = (value - part) >> LIMB, limb + 1
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
        )

    parts = fit.where(F.col("dim") == dim).select("x").mapInArrow(run, "i int, j int, limb int, part long")
    sums = parts.groupBy("i", "j", "limb").agg(F.sum("part").alias("part")).toArrow().to_pydict()
    total = np.zeros((dim + 1, dim + 1), object)
    for i, j, limb, part in zip(sums["i"], sums["j"], sums["limb"], sums["part"], strict=True):
        total[i, j] += part << (LIMB * limb)
    total = np.triu(total) + np.triu(total, 1).T
    n, s = int(total[0, 0]), total[0, 1:]
    return n, [int(v) for v in s], n * total[1:, 1:] - np.outer(s, s)


# --- Characteristic polynomial --------------------------------------------------


def _is_prime(n: int) -> bool:
    """Miller-Rabin; these bases decide every number below 3.2e9."""
    if n < 8 or not n % 2:
        return n in (2, 3, 5, 7)
    odd, twos = n - 1, 0
    while not odd % 2:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        if not any((x := x * x % n) == n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_for(bits: int) -> list[int]:
    """Primes of 31 bits, from the largest down, whose product has more than ``bits`` bits."""
    found, n, held = [], (1 << 31) - 1, 0.0
    while held <= bits + 1:
        if _is_prime(n):
            found.append(n)
            held += log2(n)
        n -= 2
    return found


def charpoly_mod(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients of ``det(t - matrix)`` modulo a prime of 31 bits, constant term first."""
    h = np.asarray(matrix % p, np.int64)
    d = len(h)
    # Similar rows and columns: everything below the subdiagonal becomes zero.
    for m in range(1, d - 1):
        nonzero = np.flatnonzero(h[m:, m - 1])
        if not len(nonzero):
            continue
        i = m + int(nonzero[0])
        h[[i, m]] = h[[m, i]]
        h[:, [i, m]] = h[:, [m, i]]
        u = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1 :] = (h[m + 1 :] - u[:, None] * h[m] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * u % p).sum(axis=1)) % p
    # Polynomials of the leading blocks, each from all before it.
    poly = np.zeros((d + 1, d + 1), np.int64)
    poly[0, 0] = 1
    for m in range(d):
        factors, below = np.zeros(m + 1, np.int64), 1
        factors[m] = h[m, m]
        for i in range(m - 1, -1, -1):
            below = below * int(h[i + 1, i]) % p
            factors[i] = int(h[i, m]) * below % p
        mixed = (factors[:, None] * poly[: m + 1] % p).sum(axis=0) % p
        poly[m + 1] = (np.concatenate([[0], poly[m, :-1]]) - mixed) % p
    return poly[d].tolist()


def remainder(residues: Sequence[int], primes: Sequence[int]) -> int:
    """The one number, next to zero, that leaves these residues."""
    product = 1
    for p in primes:
        product *= p
    value = sum(r * (product // p) * pow(product // p, -1, p) for r, p in zip(residues, primes, strict=True))
    value %= product
    return value - product if value > product // 2 else value


def charpoly(spark, matrix: np.ndarray) -> list[int]:
    """The exact coefficients, constant term first: a task per few primes, then a group per
    coefficient. The matrix has no negative eigenvalue, so its trace bounds them all."""
    d = len(matrix)
    bound = d * log2(1 + int(np.trace(matrix)) / d) + 2
    primes = primes_for(ceil(bound) + 1)

    def reduce(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for p in frame["prime"].tolist():
                yield pd.DataFrame({"degree": range(d + 1), "prime": p, "residue": charpoly_mod(matrix, p)})

    def combine(frame: pd.DataFrame) -> pd.DataFrame:
        value = remainder(frame["residue"].tolist(), frame["prime"].tolist())
        return pd.DataFrame({"degree": [frame["degree"].iloc[0]], "value": [str(value)]})

    dealt = spark.createDataFrame([(p,) for p in primes], "prime long").repartition(
        max(1, len(primes) // 8)
    )
    residues = dealt.mapInPandas(reduce, "degree int, prime long, residue long")
    found = residues.groupBy("degree").applyInPandas(combine, "degree int, value string").collect()
    return [int(r["value"]) for r in sorted(found, key=lambda r: r["degree"])]


# --- Roots ---------------------------------------------------------------------


def roots_above(coefficients: Sequence[int], numerator: int, bits: int) -> int:
    """How many roots of a polynomial with real roots only lie above ``numerator / 2**bits``:
    the sign changes of its coefficients when shifted there (Descartes; exact here)."""
    d = len(coefficients) - 1
    c = [v << (bits * (d - i)) for i, v in enumerate(coefficients)]
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            c[k] += numerator * c[k + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def _value(coefficients: Sequence[int], numerator: int, bits: int) -> int:
    d, total = len(coefficients) - 1, 0
    for i in range(d, -1, -1):
        total = total * numerator + (coefficients[i] << (bits * (d - i)))
    return total


def isolate(coefficients: Sequence[int], k: int) -> tuple[Fraction, int, int]:
    """The ``k``-th largest root (from 1), to ``ROOT_BITS`` bits: a point above it by less
    than that, how many roots lie above this point, and how many share its interval."""
    top = max(1, -coefficients[-2])  # the trace: no root is larger
    low, high, bits = -1, top, 0
    below, above = len(coefficients) - 1, 0  # roots above either end
    while True:
        if high - low == 1:
            if bits and max(1, abs(high)).bit_length() > ROOT_BITS:
                break
            low, high, bits = 2 * low, 2 * high, bits + 1
        middle = (low + high) // 2
        if below - above == 1:
            # One simple root inside: behind it the value has the sign of as many factors
            # as there are roots above.
            value = _value(coefficients, middle, bits)
            beyond = value == 0 or (value > 0) == (above % 2 == 0)
            low, high = (low, middle) if beyond else (middle, high)
            continue
        count = roots_above(coefficients, middle, bits)
        if count >= k:
            low, below = middle, count
        else:
            high, above = middle, count
    return Fraction(high, 1 << bits), above, below - above


# --- Components ----------------------------------------------------------------


def _solver(matrix: np.ndarray, root: Decimal):
    """Solves ``(matrix - root) v = b`` for many b by elimination with row pivots."""
    d = len(matrix)
    a = np.array([[Decimal(int(v)) for v in row] for row in matrix], object)
    a[np.arange(d), np.arange(d)] -= root
    tiny = (abs(root) + 1) * Decimal(10) ** (20 - DIGITS)
    order = np.arange(d)
    for k in range(d):
        best = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
        if best != k:
            a[[k, best]] = a[[best, k]]
            order[[k, best]] = order[[best, k]]
        if abs(a[k, k]) < tiny:
            a[k, k] = tiny
        a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(a[k + 1 :, k], a[k, k + 1 :])

    def solve(b: np.ndarray) -> np.ndarray:
        v = b[order].copy()
        for k in range(d):
            v[k] -= (a[k, :k] * v[:k]).sum() if k else 0
        for k in range(d - 1, -1, -1):
            v[k] = (v[k] - ((a[k, k + 1 :] * v[k + 1 :]).sum() if k < d - 1 else 0)) / a[k, k]
        return v

    return solve


def component(matrix: np.ndarray, coefficients: Sequence[int], k: int) -> tuple[Decimal, list[float]]:
    """The ``k``-th largest eigenvalue and a unit vector of it, its largest entry positive.

    Equal eigenvalues get an orthonormal basis of their space, the same in every task: the
    vectors before this one in the space are found again and projected out.
    """
    with localcontext() as context:
        context.prec = DIGITS
        root, above, shared = isolate(coefficients, k)
        value = Decimal(root.numerator) / Decimal(root.denominator)
        solve = _solver(matrix, value)
        found: list[np.ndarray] = []
        for nth in range(above, k):
            rng = random.Random(nth)
            v = np.array([Decimal(rng.randint(1, 1 << 30)) for _ in range(len(matrix))], object)
            for _ in range(3):
                v = solve(v)
                for _ in range(2 if shared > 1 else 0):
                    for other in found:
                        v = v - (v * other).sum() * other
                v = v / (v * v).sum().sqrt()
            found.append(v)
        v = found[-1]
        largest = max(range(len(v)), key=lambda i: abs(v[i]))
        return value, [float(x if v[largest] > 0 else -x) for x in v]


def components(spark, matrix: np.ndarray, wanted: int) -> list[tuple[Decimal, list[float]]]:
    """The components of the largest positive eigenvalues, ``wanted`` at most. The zero
    roots, which cannot be whitened, are the factor ``t ** z`` of the polynomial."""
    coefficients = charpoly(spark, matrix)
    rank = len(coefficients) - 1 - next(i for i, v in enumerate(coefficients) if v)
    wanted = min(wanted, rank)
    if not wanted:
        return []
    nonzero = coefficients[len(coefficients) - 1 - rank :]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for k in frame["id"].tolist():
                value, v = component(matrix, nonzero, k)
                yield pd.DataFrame({"k": [k], "value": [str(value)], "v": [v]})

    tasks = spark.range(1, wanted + 1, numPartitions=wanted)
    rows = tasks.mapInPandas(run, "k long, value string, v array<double>").collect()
    return [(Decimal(r["value"]), list(r["v"])) for r in sorted(rows, key=lambda r: r["k"])]


# --- Whitening -----------------------------------------------------------------

WHITENED = "component int, n long, deviation long, whitened double, explained double"


def _deviation(x: np.ndarray, n: int, sums: Sequence[int]) -> list[int | None]:
    """``sum((n x - S) ** 2)`` of each row, exactly; null beyond a long."""
    reach = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
    if reach**2 * x.shape[1] < 1 << 63:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    wide = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(axis=1)
    return [int(v) if v < 1 << 63 else None for v in wide]


def whiten(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", wanted: int = 4) -> DataFrame:
    """Every usable vector on the leading components of the distinct ones: a row per vector
    and component with the id, ``component`` (from 1), ``n`` (distinct vectors),
    ``deviation`` (null where it is beyond a long), ``whitened`` (unit variance over the
    distinct vectors), ``explained`` and ``identity_error``.

    Rows whose vector is null or empty, or holds a null, a non-finite entry or one beyond a
    long when scaled, are left out, and so are vectors of another length than most distinct
    ones have (of equally frequent lengths the longest counts). Components of eigenvalue
    zero are not whitened and give no rows: one distinct vector alone gives none, as does an
    empty table. Ids may be null or repeated. Columns but ``id`` and ``vector`` are not read.
    """
    spark = rows.sparkSession
    given = rows.select(id, vector)
    kind = f"`{id}` {dict(given.dtypes)[id]}, {WHITENED}"
    fit = written(fit_list(given, vector), "whitening-fit")
    most = fit.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    found: list[tuple[Decimal, list[float]]] = []
    n, dim, sums, trace = 0, 0, [0], 1
    if most is not None:
        dim = most["dim"]
        n, sums, matrix = scatter(fit, dim)
        trace = max(1, int(np.trace(matrix)))
        found = components(spark, matrix, wanted)
    if not found:
        return given.sparkSession.createDataFrame([], f"{kind}, identity_error double")
    mean = np.array([s / n for s in sums])
    axes = np.array([v for _, v in found]).T / np.array([float(e.sqrt() / n) for e, _ in found])
    explained = np.array([float(e / trace) for e, _ in found])
    k = len(found)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(((_unpacked(batch.column(0), dim) - mean) @ axes).tolist(), pa.list_(pa.float64()))],
                names=["w"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, at = _matrix(batch.column(1), dim)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(at, k))),
                    pa.array(np.tile(np.arange(1, k + 1), len(at)), pa.int32()),
                    pa.array(np.full(len(at) * k, n), pa.int64()),
                    pa.array([v for v in _deviation(x, n, sums) for _ in range(k)], pa.int64()),
                    pa.array(((x - mean) @ axes).ravel()),
                    pa.array(np.tile(explained, len(at))),
                ],
                names=[id, "component", "n", "deviation", "whitened", "explained"],
            )

    whitened_fit = fit.where(F.col("dim") == dim).select("x").mapInArrow(project, "w array<double>")
    off = [
        F.abs(F.covar_pop(F.col("w")[i], F.col("w")[j]) - (1.0 if i == j else 0.0))
        for i in range(k)
        for j in range(i, k)
    ]
    error = whitened_fit.agg(F.greatest(*off, F.lit(0.0)).alias("error")).first()["error"]
    return given.mapInArrow(run, kind).withColumn("identity_error", F.lit(float(error)))
