"""Whitening of embeddings by components whose eigenvalues come from an exact characteristic polynomial.

Every entry is quantised to a whole number, so that the scatter of the distinct
vectors is a matrix of integers, summed without rounding: in tasks, then per cell
in one aggregate. Its characteristic polynomial is computed modulo primes, a prime
at a time in tasks, by reduction to Hessenberg form, and put together by Chinese
remaindering; there are as many primes as a bound on the coefficients asks for.
All roots of the polynomial are real, so the sign changes of its coefficients,
moved to a point, count the roots beyond that point. Bisection by these counts
isolates the largest roots, multiple ones with their number, and carries them to
``DIGITS`` digits. The vectors of each root span the null space of the scatter
less the root and come from inverse iteration in decimal arithmetic, a root at a
time in tasks.

What reaches the driver are one number per pair of dimensions, the polynomial and
the components: all bounded by the dimension, whatever the number of rows.

Cases: rows whose vector is NULL, or has a NULL or non-finite entry, or an entry
whose whole number does not fit a long, give no rows. The dimension is the most
common length of a vector (of equally common ones the least); vectors of another
length give no rows. Repeated rows are all answered and count once in the fit.
Components are those of positive variance, so an empty table, one distinct
vector or empty vectors give no rows. A deviation that does not fit a long is
NULL. Only the id and the vector are read, so other columns may have any name.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cdclake.llm.common import stored, table

#: An entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Significant digits of the roots and of the arithmetic that finds the components.
DIGITS, PRECISION = 60, 120
#: Primes below this bound, so that a product of two remainders fits a long.
PRIME_BOUND = 1 << 31


# --- whole numbers and their sums ---

def whole_numbers(vectors: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """floor(SCALE * c) of every usable vector, one row each, and which vectors are usable."""
    lists = vectors.cast(pa.list_(pa.float64()))
    lengths = np.diff(lists.offsets.to_numpy())
    usable = ~np.asarray(lists.is_null()) & (lengths == size)
    if not size or not usable.any():
        return np.zeros((0, size), np.int64), usable & False
    rows = lists.filter(pa.array(usable)).flatten()
    nulls = np.asarray(rows.is_null()).reshape(-1, size)
    scaled = np.floor(rows.fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, size) * SCALE)
    fits = ~nulls.any(axis=1) & (np.abs(scaled) < 2.0**63 - 2.0**21).all(axis=1)
    usable[np.flatnonzero(usable)[~fits]] = False
    return scaled[fits].astype(np.int64), usable


def common_length(vectors: DataFrame, column: str) -> int | None:
    lengths = vectors.where(F.col(column).isNotNull()).groupBy(F.size(column).alias("size")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.desc("n"), "size").first()
    return most["size"] if most else None


def fit_list(vectors: DataFrame, column: str, size: int) -> DataFrame:
    """Each distinct vector of whole numbers once, as ``x``. Equal vectors of a task meet before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, _ = whole_numbers(batch.column(0), size)
            # The bytes of eight-byte numbers, the most significant ones mostly alike, pack well.
            data = rows.astype("<i8").tobytes()
            lists = [data[i : i + 8 * size] for i in range(0, len(data), 8 * size)] if size else []
            yield pa.RecordBatch.from_arrays([pa.array(lists, pa.binary())], ["x"])

    return vectors.select(column).mapInArrow(run, "x binary").distinct()


def _rows(column: pa.Array, size: int) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, "<i8").reshape(-1, size)


def exact_product(rows: np.ndarray) -> np.ndarray:
    """``rows`` transposed times ``rows``, as Python integers: in doubles while every sum is exact there."""
    most = int(np.abs(rows).max(initial=0))
    if most * most * len(rows) < 1 << 53:
        x = rows.astype(np.float64)
        return (x.T @ x).astype(np.int64).astype(object)
    if len(rows) > 1:
        half = len(rows) // 2
        if most * most * half < 1 << 53 or most < 1 << 26:
            return exact_product(rows[:half]) + exact_product(rows[half:])
    x = rows.astype(object)
    return x.T @ x


def scatter(fit: DataFrame, size: int) -> tuple[int, list[int], np.ndarray]:
    """The number n of vectors, the sum of each dimension, and n times the sum of products less the products of the sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        total, count = np.zeros((size + 1, size + 1), object), 0
        for batch in batches:
            rows = _rows(batch.column(0), size)
            if len(rows):
                # A column of ones gives the sums and the number along with the products.
                total = total + exact_product(np.hstack([rows, np.ones((len(rows), 1), np.int64)]))
                count += len(rows)
        if count:
            i, j = np.triu_indices(size + 1)
            values = [str(v) for v in total[i, j]]
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(values)], ["i", "j", "v"])

    cells = fit.mapInArrow(run, "i int, j int, v string").groupBy("i", "j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    full = np.zeros((size + 1, size + 1), object)
    for r in cells.collect():
        full[r["i"], r["j"]] = full[r["j"], r["i"]] = int(r["v"])
    n, sums = full[size, size], full[:size, size]
    return n, list(sums), n * full[:size, :size] - np.outer(sums, sums)


# --- characteristic polynomial ---

def primes(count: int, below: int = PRIME_BOUND) -> list[int]:
    """The ``count`` greatest primes below a bound."""

    def is_prime(n: int) -> bool:
        # These bases decide it for every n below 3,215,031,751.
        odd, twos = n - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        for base in (2, 3, 5, 7):
            x = pow(base, odd, n)
            if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
                return False
        return True

    found, n = [], below - 1 if below % 2 == 0 else below
    while len(found) < count:
        if is_prime(n):
            found.append(n)
        n -= 2
    return found


def _inverse(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """The inverse modulo each prime; 0 for 0."""
    result, power, base = np.ones_like(x), p - 2, x.copy()
    while power.any():
        result = np.where(power & 1, result * base % p, result)
        base, power = base * base % p, power >> 1
    return result


def polynomials_modulo(matrix: np.ndarray, moduli: list[int]) -> np.ndarray:
    """Characteristic polynomial of an integer matrix modulo each prime; highest coefficient first.

    Row and column steps reduce the matrix to Hessenberg form, from which the
    polynomials of its leading blocks follow one after the other.
    """
    size, count = len(matrix), len(moduli)
    p = np.array(moduli, np.int64)
    h = np.stack([(matrix % q).astype(np.int64) for q in moduli]) if size else np.zeros((count, 0, 0), np.int64)
    every, p2, p3 = np.arange(count), p[:, None], p[:, None, None]
    for k in range(size - 2):
        pivot = k + 1 + np.argmax(h[:, k + 1 :, k] != 0, axis=1)
        h[every, k + 1], h[every, pivot] = h[every, pivot], h[every, k + 1].copy()
        h[every, :, k + 1], h[every, :, pivot] = h[every, :, pivot], h[every, :, k + 1].copy()
        factor = h[:, k + 2 :, k] * _inverse(h[:, k + 1, k], p)[:, None] % p2
        h[:, k + 2 :, k:] = (h[:, k + 2 :, k:] - factor[:, :, None] * h[:, None, k + 1, k:] % p3) % p3
        # Products are reduced one by one, so that their sum fits a long.
        back = h[:, :, k + 2 :] * factor[:, None, :] % p3
        h[:, :, k + 1] = (h[:, :, k + 1] + back.sum(axis=2)) % p2
    polys = np.zeros((count, size + 1, size + 1), np.int64)
    polys[:, 0, 0] = 1  # lowest coefficient first here
    for k in range(1, size + 1):
        weights, run = np.zeros((count, k), np.int64), np.ones(count, np.int64)
        for i in range(k - 1, -1, -1):
            weights[:, i] = h[:, i, k - 1] * run % p
            run = run * h[:, i, i - 1] % p if i else run
        polys[:, k, 1 : k + 1] = polys[:, k - 1, :k]
        taken = (weights[:, :, None] * polys[:, :k, :k] % p3).sum(axis=1)
        polys[:, k, :k] = (polys[:, k, :k] - taken) % p2
    return polys[:, size, ::-1]


def coefficient_bound(matrix: np.ndarray) -> int:
    """No coefficient exceeds it: the k-th is at most (size over k) times the k-th power of the mean eigenvalue."""
    size = len(matrix)
    mean = int(sum(matrix[i, i] for i in range(size))) // max(size, 1) + 1
    return max(math.comb(size, k) * mean**k for k in range(size + 1))


def remaindered(residues: list[np.ndarray], moduli: list[int]) -> list[int]:
    """The integers, of either sign, that have these remainders."""
    whole = math.prod(moduli)
    parts = [whole // q * pow(whole // q, -1, q) for q in moduli]
    values = [sum(int(r[k]) * part for r, part in zip(residues, parts)) % whole for k in range(len(residues[0]))]
    return [v - whole if 2 * v > whole else v for v in values]


def characteristic_polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Coefficients, highest first, of a matrix without negative eigenvalues."""
    bound, moduli = 2 * coefficient_bound(matrix), []
    moduli = primes(bound.bit_length() // 30 + 1)
    digits = [[str(v) for v in row] for row in matrix]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = np.array([[int(v) for v in row] for row in digits], object)
        for batch in batches:
            for at in range(0, len(batch), 16):
                some = batch["p"].tolist()[at : at + 16]
                yield pd.DataFrame({"p": some, "r": list(polynomials_modulo(whole, some))})

    tasks = max(1, min(len(moduli) // 16, spark.sparkContext.defaultParallelism))
    listed = spark.createDataFrame([(p,) for p in moduli], "p bigint").repartition(tasks)
    found = listed.mapInPandas(run, "p bigint, r array<bigint>").collect()
    return remaindered([r["r"] for r in found], [r["p"] for r in found])


# --- roots ---

def moved(poly: list[int], a: int, s: int) -> list[int]:
    """Coefficients, up to a positive factor, of the polynomial moved so that a / 2**s becomes 0."""
    n = len(poly) - 1
    c = [v << (s * k) for k, v in enumerate(poly)]
    for i in range(n):
        for k in range(1, n - i + 1):
            c[k] += a * c[k - 1]
    return c


def roots_above(poly: list[int], a: int, s: int) -> int:
    """Roots greater than a / 2**s of a polynomial whose roots are all real: exactly the sign changes."""
    signs = [v > 0 for v in moved(poly, a, s) if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def sign_at(poly: list[int], a: int, s: int) -> int:
    value = 0
    for k, v in enumerate(poly):
        value = value * a + (v << (s * k))
    return (value > 0) - (value < 0)


def largest_roots(poly: list[int], count: int, digits: int = DIGITS) -> list[tuple[decimal.Decimal, int]]:
    """The greatest positive roots in falling order, and how often each occurs, until ``count`` are found.

    Each is known to ``digits`` digits; roots that agree in all of them are one.
    """
    poly = list(poly)
    while poly and poly[-1] == 0:
        poly.pop()  # a root 0
    if len(poly) < 2:
        return []
    bits = math.ceil(digits * math.log2(10)) + 2
    total = len(poly) - 1
    found: list[tuple[decimal.Decimal, int]] = []
    # The roots beyond high / 2**s are those found. The sum of all roots bounds the greatest.
    above, high, s = 0, -poly[1] // poly[0] + 1, 0
    while above < min(count, total):
        # Narrowed until one root, or roots that agree in all digits, lie in (low, high], and low is not 0.
        low, inside = 0, total - above
        while not low or (inside > 1 and (high - low) << bits > low):
            if high - low <= 1:
                low, high, s = low * 2, high * 2, s + 1
            middle = (low + high) // 2
            more = roots_above(poly, middle, s) - above
            if more:
                low, inside = middle, more
            else:
                high = middle
        below = low, s
        if inside == 1:
            # One root in (low, high]: from here its sign is enough.
            right = sign_at(poly, high, s)
            if right == 0:
                low = high
            while low < high and (high - low) << bits > max(low, 1):
                if high - low <= 1:
                    low, high, s = low * 2, high * 2, s + 1
                middle = (low + high) // 2
                at = sign_at(poly, middle, s)
                if at == 0:
                    low = high = middle
                elif at == right:
                    high = middle
                else:
                    low = middle
        with decimal.localcontext() as context:
            context.prec = digits + 20
            found.append((decimal.Decimal(low + high) / decimal.Decimal(1 << (s + 1)), inside))
        above += inside
        high, s = below
    return found


# --- components ---

def null_vectors(matrix: list[list[int]], root: decimal.Decimal, count: int) -> list[np.ndarray]:
    """``count`` unit vectors, at right angles, that the matrix less the root takes to 0, by inverse iteration."""
    with decimal.localcontext() as context:
        context.prec, context.Emax, context.Emin = PRECISION, decimal.MAX_EMAX, decimal.MIN_EMIN
        size, zero = len(matrix), decimal.Decimal(0)
        a = np.array([[decimal.Decimal(v) for v in row] for row in matrix], object)
        for i in range(size):
            a[i, i] -= root
        least = max(abs(v) for v in a.ravel()) * decimal.Decimal(10) ** -(PRECISION - 10) or decimal.Decimal(1)
        order = np.arange(size)
        for k in range(size):
            pivot = k + int(np.argmax(np.abs(a[k:, k])))
            if pivot != k:
                a[[k, pivot]], order[[k, pivot]] = a[[pivot, k]], order[[pivot, k]]
            if abs(a[k, k]) < least:
                a[k, k] = least
            if k + 1 < size:
                a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
                a[k + 1 :, k + 1 :] = a[k + 1 :, k + 1 :] - np.outer(a[k + 1 :, k], a[k, k + 1 :])

        def solve(b: np.ndarray) -> np.ndarray:
            x = b[order].copy()
            for k in range(1, size):
                x[k] -= sum(a[k, :k] * x[:k], zero)
            for k in range(size - 1, -1, -1):
                x[k] = (x[k] - sum(a[k, k + 1 :] * x[k + 1 :], zero)) / a[k, k]
            return x

        rng = np.random.default_rng(1)
        found: list[np.ndarray] = []
        for _ in range(count):
            x = np.array([decimal.Decimal(int(v)) for v in rng.integers(-1000, 1000, size)], object)
            for _ in range(3):
                x = solve(x)
                for other in found:
                    x = x - other * sum(x * other, zero)
                x = x / sum(x * x, zero).sqrt()
            found.append(x)
        return found


@dataclass
class Whitening:
    """What turns whole numbers into whitened values: one row of ``weights`` per component."""

    n: int
    sums: list[int]
    weights: np.ndarray
    explained: list[float]


def components(spark: SparkSession, n: int, sums: list[int], matrix: np.ndarray, count: int) -> Whitening:
    """The greatest ``count`` components of positive variance of a scatter."""
    size = len(matrix)
    trace = int(sum(matrix[i, i] for i in range(size)))
    if not trace:
        return Whitening(n, sums, np.zeros((0, size)), [])
    roots = largest_roots(characteristic_polynomial(spark, matrix), count)
    digits = [[str(v) for v in row] for row in matrix]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = [[int(v) for v in row] for row in digits]
        for batch in batches:
            for place, root, times in zip(batch["place"], batch["root"], batch["times"]):
                vectors = null_vectors(whole, decimal.Decimal(root), int(times))
                with decimal.localcontext() as context:
                    context.prec = PRECISION
                    # The variance is root / n**2, its square root the length a unit of whitened value has.
                    scaled = [[float(v * n / decimal.Decimal(root).sqrt()) for v in x] for x in vectors]
                yield pd.DataFrame({"place": place, "weights": scaled})

    listed = spark.createDataFrame(
        [(k, str(root), times) for k, (root, times) in enumerate(roots)], "place int, root string, times int"
    )
    tasks = min(len(roots), spark.sparkContext.defaultParallelism)
    solved = listed.repartition(tasks).mapInPandas(run, "place int, weights array<double>").collect()
    weights = [r["weights"] for r in sorted(solved, key=lambda r: r["place"])]
    shares = [float(root / trace) for root, times in roots for _ in range(times)]
    return Whitening(n, sums, np.array(weights[:count]), shares[:count])


# --- applying them ---

def _whitened(rows: np.ndarray, w: Whitening) -> np.ndarray:
    # Sums are divided as integers first, so that the rest of the mean keeps its digits.
    base = np.array([s // w.n for s in w.sums], np.int64)
    rest = np.array([s % w.n / w.n for s in w.sums])
    return ((rows - base).astype(np.float64) - rest) @ w.weights.T


def _deviations(rows: np.ndarray, w: Whitening) -> list[int | None]:
    """Sum over the dimensions of (n x - sum) squared, exactly; None beyond a long."""
    most = int(np.abs(rows).max(initial=0)) * w.n + max(map(abs, w.sums), default=0)
    if most * most * max(len(w.sums), 1) < 1 << 63:
        apart = w.n * rows - np.array(w.sums, np.int64)
        return (apart * apart).sum(axis=1).tolist()
    apart = w.n * rows.astype(object) - np.array(w.sums, object)
    return [v if v < 1 << 63 else None for v in (apart * apart).sum(axis=1).tolist()]


def identity_error(fit: DataFrame, w: Whitening) -> float:
    """Greatest absolute entry of the whitened fit list's covariance less the identity."""
    size, count = len(w.sums), len(w.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        total, products = np.zeros(count), np.zeros((count, count))
        for batch in batches:
            rows = _rows(batch.column(0), size)
            if len(rows):
                z = _whitened(rows, w)
                total, products = total + z.sum(axis=0), products + z.T @ z
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(count + count * count), pa.int32()), pa.array(np.concatenate([total, products.ravel()]))], ["k", "v"]
        )

    cells = fit.mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).orderBy("k").collect()
    found = np.array([r["v"] for r in cells]) / w.n
    mean, products = found[:count], found[count:].reshape(count, count)
    return float(np.abs(products - np.outer(mean, mean) - np.eye(count)).max())


def whiten(vectors: DataFrame, column: str = "embedding", count: int = COMPONENTS) -> tuple[DataFrame, Whitening | None, float | None]:
    """``vec_id``, ``deviation`` and ``whitened`` (an array, component by component) of every usable row; the fit and its error.

    The frame is None where there is no component.
    """
    spark = vectors.sparkSession
    size = common_length(vectors, column)
    if not size:
        return None, None, None
    fit = stored(fit_list(vectors, column, size), "fit-list")
    n, sums, matrix = scatter(fit, size)
    w = components(spark, n, sums, matrix, count) if n else None
    if w is None or not len(w.weights):
        return None, w, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, usable = whole_numbers(batch.column(1), size)
            values = _whitened(rows, w)
            offsets = np.arange(0, values.size + 1, len(w.weights), dtype=np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).filter(pa.array(usable)), pa.array(_deviations(rows, w), pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel())),
            ], ["vec_id", "deviation", "whitened"])

    rows = vectors.select("vec_id", column).mapInArrow(run, "vec_id bigint, deviation bigint, whitened array<double>")
    return rows, w, identity_error(fit, w)


RESULT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whitened_rows(vectors: DataFrame, column: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component."""
    rows, w, error = whiten(vectors, column, count)
    if rows is None:
        return vectors.sparkSession.createDataFrame([], RESULT)
    shares = F.array(*[F.lit(x) for x in w.explained])
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "vec_id", (F.col("place") + 1).cast("int").alias("component"), F.lit(w.n).cast("bigint").alias("n"), "deviation",
        "whitened", F.get(shares, F.col("place")).alias("explained"), F.lit(error).alias("identity_error"),
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened_rows(table(spark, sf_dir, "embeddings"))
