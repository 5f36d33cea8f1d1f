"""Whitening of embeddings, with components from the exact characteristic polynomial.

Entries become integers, so the scatter matrix of the distinct vectors (n times the sum of products, less the
product of the sums) is an integer matrix, summed without rounding. Its characteristic
polynomial is computed modulo many primes, each by reduction to Hessenberg form, in tasks of their
own; Chinese remaindering puts the coefficients together. They are known to be non-negative
up to sign and bounded by Maclaurin's inequality, which tells how many primes are
needed. All roots are real, so the sign changes of the polynomial shifted to a point count the roots
above it exactly, with their multiplicities; bisection isolates the largest ones, and the sign of the value narrows
each down to far more digits than a double holds. A component is what inverse
iteration makes of the null space of (matrix - root), in decimal arithmetic with as many digits.

What reaches the driver depends on the number of dimensions only: one integer per pair of
dimensions and one polynomial per prime.

Defined results: vectors that are null or empty or hold a null, NaN or infinite entry are left
out; rows with equal ids or equal vectors are all returned, while an equal vector counts once in the
fit; a null id stays null; vectors of different lengths fail with an error; components whose root is zero
(fewer distinct vectors than components, a constant table) are left out, so that an empty or
constant table gives no rows; equal roots get some orthogonal basis. A deviation beyond
a long fails. Other columns are ignored.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm.common import cut_lineage

COMPONENTS = 4
SCALE = 256
# Primes lie below this, so that a product of two residues fits a long.
PRIMES_BELOW = 2**31
# Bits of a root before and behind the point: at least so many together, and so many behind it.
ROOT_BITS, LEAST_FRACTION_BITS = 160, 64
_GUARD_DIGITS = 30
_ITERATIONS = 3

_RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, x array<long>) of the rows of `vectors(vec_id, embedding)` whose entries are all finite numbers."""
    entries = F.col("embedding")
    broken = F.exists(entries, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    x = F.transform(entries, lambda c: F.floor(c.cast("double") * F.lit(float(SCALE))))
    kept = vectors.filter(entries.isNotNull() & (F.size(entries) > 0) & ~broken)
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _products(x: np.ndarray) -> np.ndarray:
    """x' x without rounding: in doubles, longs or Python's integers, whichever is sure to hold the sums."""
    most = len(x) * int(np.abs(x).max(initial=0)) ** 2
    if most < 2**53:
        return (x.astype(np.float64).T @ x.astype(np.float64)).astype(np.int64)
    return x.T @ x if most < 2**63 else x.astype(object).T @ x.astype(object)


def _moments(fit: DataFrame, dim: int) -> tuple[list[list[int]], list[int]]:
    """Sums of products and sums, exact. Tasks send one number per pair of dimensions."""
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("total", pa.decimal128(38, 0))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, sums = np.zeros((dim, dim), object), np.zeros(dim, object)
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0))
                products += _products(x)
                sums += x.sum(axis=0, dtype=object)
        rows = [(i, j, Decimal(int(products[i, j]))) for i in range(dim) for j in range(i, dim)]
        rows += [(i, -1, Decimal(int(sums[i]))) for i in range(dim)]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    tasks = fit.mapInArrow(run, "i int, j int, total decimal(38,0)")
    products, sums = [[0] * dim for _ in range(dim)], [0] * dim
    for i, j, total in tasks.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        if j < 0:
            sums[i] = int(total)
        else:
            products[i][j] = products[j][i] = int(total)
    return products, sums


def primes(count: int, below: int = PRIMES_BELOW) -> list[int]:
    """The largest primes below a bound."""
    sieve = np.ones(math.isqrt(below) + 2, bool)
    sieve[:2] = False
    for k in range(2, math.isqrt(len(sieve)) + 1):
        sieve[k * k :: k] = False
    small, found, at = np.flatnonzero(sieve), [], below
    while len(found) < count:
        at -= 1
        if at < 2:
            raise ValueError(f"fewer than {count} primes below {below}")
        if (at % small[small * small <= at]).all():
            found.append(at)
    return found


def polynomial_modulo(matrix: list[list[int]], prime: int) -> list[int]:
    """Coefficients, constant first, of det(x - matrix) modulo a prime."""
    h = np.array([[value % prime for value in row] for row in matrix], np.int64)
    dim = len(h)
    for m in range(1, dim - 1):
        below = np.flatnonzero(h[m:, m - 1])
        if not len(below):
            continue
        pivot = m + below[0]
        if pivot != m:
            h[[m, pivot]] = h[[pivot, m]]
            h[:, [m, pivot]] = h[:, [pivot, m]]
        factor = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, prime) % prime
        h[m + 1 :] = (h[m + 1 :] - factor[:, None] * h[m]) % prime
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * factor % prime).sum(axis=1)) % prime
    # Polynomials of the leading blocks: each from all before it, through the products along the lower diagonal.
    blocks = np.zeros((dim + 1, dim + 1), np.int64)
    blocks[0, 0] = 1
    for k in range(1, dim + 1):
        weights, product = np.zeros(k, np.int64), 1
        for i in range(k - 1, -1, -1):
            weights[i] = int(h[i, k - 1]) * product % prime
            product = product * int(h[i, i - 1]) % prime if i else 0
        blocks[k, 1:] = blocks[k - 1, :-1]
        blocks[k] = (blocks[k] - (weights[:, None] * blocks[:k] % prime).sum(axis=0)) % prime
    return blocks[dim].tolist()


def coefficient_bound(matrix: list[list[int]]) -> int:
    """No coefficient of the polynomial of a matrix without negative roots is larger: they are sums of products of
    k roots, which are largest when all roots equal their mean."""
    dim, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    return max(math.comb(dim, k) * (trace**k // dim**k + 1) for k in range(dim + 1))


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients, constant first, of det(x - matrix) for a symmetric integer matrix without negative roots."""
    bound = 2 * coefficient_bound(matrix) + 1
    moduli = primes(bound.bit_length() // (PRIMES_BELOW.bit_length() - 2) + 1)
    schema = pa.schema([("prime", pa.int64()), ("rest", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(0).to_pylist()
            rests = [polynomial_modulo(matrix, prime) for prime in found]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(rests, schema.field("rest").type)], schema=schema)

    tasks = spark.createDataFrame([(prime,) for prime in moduli], "prime long")
    tasks = tasks.repartition(min(len(moduli), spark.sparkContext.defaultParallelism))
    known, value = 1, [0] * (len(matrix) + 1)
    for prime, rest in sorted(tasks.mapInArrow(run, "prime long, rest array<long>").collect()):
        inverse = pow(known, -1, prime)
        value = [v + known * ((r - v) * inverse % prime) for v, r in zip(value, rest, strict=True)]
        known *= prime
    return [v - known if 2 * v > known else v for v in value]


def roots_above(polynomial: list[int], point: int) -> int:
    """How many roots, with multiplicity, lie above a point, if all are real: the sign changes of the shifted polynomial."""
    shifted = list(polynomial)
    for stop in range(len(shifted) - 1):
        for k in range(len(shifted) - 2, stop - 1, -1):
            shifted[k] += point * shifted[k + 1]
    signs = [value > 0 for value in shifted if value]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def largest_roots(polynomial: list[int], count: int, upper: int) -> tuple[list[tuple[int, int]], int]:
    """The largest positive roots, up to `count` with multiplicity, and the bits behind the point.

    A root is (low, n): it lies in (low, low + 1] / 2^bits, as do n roots in all. No root may be above `upper`.
    """
    bits = max(LEAST_FRACTION_BITS, ROOT_BITS - upper.bit_length())
    degree = len(polynomial) - 1
    wide = [c << bits * (degree - k) for k, c in enumerate(polynomial)]
    above = {0: roots_above(wide, 0), upper << bits: 0}

    def value_sign(point: int) -> int:
        total = 0
        for c in reversed(wide):
            total = total * point + c
        return (total > 0) - (total < 0)

    found: list[tuple[int, int]] = []
    while len(found) < min(count, above[0]):
        nth = len(found) + 1
        low = max(p for p, n in above.items() if n >= nth)
        high = min(p for p, n in above.items() if n < nth)
        while high - low > 1 and above[low] - above[high] > 1:
            mid = (low + high) // 2
            above[mid] = roots_above(wide, mid)
            low, high = (mid, high) if above[mid] >= nth else (low, mid)
        together = above[low] - above[high]
        right = -1 if above[high] % 2 else 1
        while high - low > 1:  # one root left: the sign of the value tells its side
            mid = (low + high) // 2
            sign = value_sign(mid)
            low, high = (mid - 1, mid) if sign == 0 else (low, mid) if sign == right else (mid, high)
        found += [(low, together)] * min(together, count - len(found))
    return found, bits


def _solver(matrix: list[list[int]], root: Decimal) -> Callable[[list[Decimal]], list[Decimal]]:
    """Solves (matrix - root) y = b, by elimination with the largest pivots; a pivot of zero becomes a tiny one."""
    dim = len(matrix)
    rows = [[Decimal(v) - root if i == j else Decimal(v) for j, v in enumerate(row)] for i, row in enumerate(matrix)]
    order = list(range(dim))
    tiny = max(abs(v) for row in rows for v in row).scaleb(-decimal.getcontext().prec)
    for k in range(dim):
        pivot = max(range(k, dim), key=lambda i: abs(rows[i][k]))
        rows[k], rows[pivot], order[k], order[pivot] = rows[pivot], rows[k], order[pivot], order[k]
        rows[k][k] = rows[k][k] or tiny
        for i in range(k + 1, dim):
            if factor := rows[i][k] / rows[k][k]:
                rows[i][k] = factor
                for j in range(k + 1, dim):
                    rows[i][j] -= factor * rows[k][j]

    def solve(b: list[Decimal]) -> list[Decimal]:
        y = [b[i] for i in order]
        for i in range(dim):
            y[i] -= sum((rows[i][j] * y[j] for j in range(i)), Decimal(0))
        for i in reversed(range(dim)):
            y[i] = (y[i] - sum((rows[i][j] * y[j] for j in range(i + 1, dim)), Decimal(0))) / rows[i][i]
        return y

    return solve


def _unit(v: list[Decimal], others: list[list[Decimal]]) -> list[Decimal]:
    for other in others:
        part = sum(a * b for a, b in zip(v, other, strict=True))
        v = [a - part * b for a, b in zip(v, other, strict=True)]
    size = sum(a * a for a in v).sqrt()
    return [a / size for a in v]


@dataclass
class Whitening:
    """Whitening of x: (n x - sums) . vector / length, for each vector."""

    n: int
    sums: list[int]
    vectors: np.ndarray  # a unit eigenvector of the covariance per row
    lengths: np.ndarray  # n times the square root of its eigenvalue
    explained: np.ndarray  # its share of the trace
    identity_error: float = 0.0

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whitened values, squared deviations) of rows of integers."""
        widest = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums))
        kind = np.int64 if x.shape[1] * widest * widest < 2**63 else object
        deviations = x.astype(kind) * self.n - np.array(self.sums, kind)
        return deviations.astype(np.float64) @ self.vectors.T / self.lengths, (deviations * deviations).sum(axis=1)


def components(spark: SparkSession, matrix: list[list[int]], count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit eigenvectors, square roots of the eigenvalues, shares of the trace) of a scatter matrix, largest first."""
    dim, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    if not trace:
        return np.empty((0, dim)), np.empty(0), np.empty(0)
    roots, bits = largest_roots(characteristic_polynomial(spark, matrix), count, trace)
    with decimal.localcontext() as context:
        context.prec = math.ceil((trace.bit_length() + bits) * math.log10(2)) + _GUARD_DIGITS
        vectors: list[list[Decimal]] = []
        lengths, shares = [], []
        for k, (low, _) in enumerate(roots):
            root = Decimal(2 * low + 1) / Decimal(2 << bits)
            same = [vectors[i] for i in range(k) if roots[i][0] == low]  # of a root that occurs more than once
            solve = _solver(matrix, root) if not same else solve
            v = _unit([Decimal(1) / (1 + i + k * dim) for i in range(dim)], same)
            for _ in range(_ITERATIONS):
                v = _unit(solve(v), same)
            if max(v, key=abs) < 0:
                v = [-a for a in v]
            vectors.append(v)
            lengths.append(float(root.sqrt()))
            shares.append(float(root / trace))
        return np.array([[float(a) for a in v] for v in vectors]).reshape(-1, dim), np.array(lengths), np.array(shares)


def _mean_products(fit: DataFrame, whiten: Whitening, centre: np.ndarray) -> np.ndarray:
    """Means over the fit list of the products of (whitened - centre), with a 1 put before it: row 0 holds the means themselves."""
    size = len(whiten.lengths) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                w = whiten(_matrix(batch.column(0)))[0] - centre
                w = np.column_stack([np.ones(len(w)), w])
                total += w.T @ w
        yield pa.RecordBatch.from_pydict({"at": np.arange(size * size, dtype=np.int32), "total": total.ravel()})

    rows = fit.mapInArrow(run, "at int, total double").groupBy("at").agg(F.sum("total").alias("total")).collect()
    out = np.zeros(size * size)
    for at, total in rows:
        out[at] = total / whiten.n
    return out.reshape(size, size)


def fitted(integers: DataFrame, count: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors of (vec_id, x); None if there are none."""
    spark = integers.sparkSession
    fit = cut_lineage(integers.select("x").distinct(), "whitening-fit")
    seen = fit.agg(F.count(F.lit(1)).alias("n"), F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most")).first()
    n, dim = seen["n"], seen["most"]
    if not n:
        return None
    if seen["least"] != dim:
        raise ValueError(f"vectors have {seen['least']} to {dim} entries")
    products, sums = _moments(fit, dim)
    scatter = [[n * products[i][j] - sums[i] * sums[j] for j in range(dim)] for i in range(dim)]
    whiten = Whitening(n, sums, *components(spark, scatter, count))
    if len(whiten.lengths):
        mean = _mean_products(fit, whiten, np.zeros(len(whiten.lengths)))[0, 1:]
        covariance = _mean_products(fit, whiten, mean)[1:, 1:]
        whiten.identity_error = float(np.abs(covariance - np.eye(len(covariance))).max())
    return whiten


def whitened(vectors: DataFrame, count: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every usable row and component."""
    integers = integer_vectors(vectors)
    whiten = fitted(integers, count)
    if whiten is None or not len(whiten.lengths):
        return vectors.sparkSession.createDataFrame([], _RESULT)
    found = len(whiten.lengths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values, deviations = whiten(_matrix(batch.column(1)))
                rows = batch.num_rows * found
                each = np.repeat(np.arange(batch.num_rows), found)
                yield pa.RecordBatch.from_pydict(
                    {
                        "vec_id": batch.column(0).take(pa.array(each)),
                        "component": np.tile(np.arange(1, found + 1, dtype=np.int32), batch.num_rows),
                        "n": np.full(rows, whiten.n, np.int64),
                        "deviation": pa.array(deviations[each], pa.int64()),
                        "whitened": values.ravel(),
                        "explained": np.tile(whiten.explained, batch.num_rows),
                        "identity_error": np.full(rows, whiten.identity_error),
                    }
                )

    return integers.mapInArrow(run, _RESULT)
