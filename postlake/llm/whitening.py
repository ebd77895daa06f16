"""Whitening by the exact characteristic polynomial of the integer scatter.

Vectors become integers, and tasks sum their products without rounding. The characteristic polynomial
of the scatter is found modulo many primes, each by a reduction to Hessenberg form in a task, and put
together by Chinese remaindering. It has real roots only, so sign changes after a shift count the roots
above a point exactly: roots are isolated and refined as integers. Components are null vectors of the
scatter less a root, by inverse iteration in integers of as many bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from decimal import Decimal
from math import comb, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.session import cut_lineage, shuffle_partitions

SCALE, SHIFT = 1024, 100_000
#: Entries beyond this size count as this size.
_MOST = 1 << 62
#: Bits behind the point of a root, and of a component's entries.
ROOT_BITS = 128
VECTOR_BITS = 256
_LIMB = 30
_HALF = 20
_BLOCK = 4096


@dataclass
class Whitening:
    """A fit: ``n`` vectors of ``width``, ``sums`` of their integers less SHIFT, eigenvalues of n * n
    times the covariance as (root * 2**ROOT_BITS), ``trace`` of the same, and unit components by row."""

    width: int
    n: int = 0
    sums: list[int] = field(default_factory=list)
    trace: int = 0
    roots: list[int] = field(default_factory=list)
    components: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def explained(self) -> list[float]:
        return [root / (self.trace << ROOT_BITS) for root in self.roots]

    def scales(self) -> np.ndarray:
        """Square roots of the covariance's eigenvalues, times n."""
        return np.array([isqrt(root << ROOT_BITS) / (1 << ROOT_BITS) for root in self.roots])


def _integers(column: pa.Array, width: int) -> np.ndarray:
    values = np.array(column.flatten(), np.float64).reshape(-1, width)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(values * SCALE), -_MOST, _MOST).astype(np.int64)


def exact_gram(values: np.ndarray) -> np.ndarray:
    """Sums of products of the columns as Python integers; at most _BLOCK rows."""
    most = int(np.abs(values).max(initial=0))
    if most * most * max(1, len(values)) < 1 << 53:
        return (values.T.astype(np.float64) @ values.astype(np.float64)).astype(np.int64).astype(object)
    halves = []
    while values.any():
        low = (values + (1 << _HALF - 1)) % (1 << _HALF) - (1 << _HALF - 1)
        halves.append(low.astype(np.float64))
        values = (values - low) >> _HALF
    total = np.zeros((halves[0].shape[1],) * 2, object)
    for i, a in enumerate(halves):
        for j, b in enumerate(halves):
            total += (a.T @ b).astype(np.int64).astype(object) << _HALF * (i + j)
    return total


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """(place, digit) in base 2**_LIMB; the last digit holds the sign."""
    at = 0
    while value not in (0, -1):
        value, digit = value >> _LIMB, value & (1 << _LIMB) - 1
        yield at, digit
        at += 1
    if value:
        yield at, value


def scatter(vectors: DataFrame, width: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, sums, products) of the integer vectors, exact. Each task sends one row per pair of dimensions
    and limb, combined before the shuffle; what reaches the driver is bounded by the width squared."""

    def run(batches):
        n, sums, products = 0, [0] * width, np.zeros((width, width), object)
        for batch in batches:
            for start in range(0, batch.num_rows, _BLOCK):
                values = _integers(batch.column("vector").slice(start, _BLOCK), width)
                n += len(values)
                sums = [a + int(b) for a, b in zip(sums, values.sum(axis=0, dtype=object))]
                products = products + exact_gram(values)
        entries = [(-1, -1, n), *((i, -1, value) for i, value in enumerate(sums))]
        entries += [(i, j, int(products[i, j])) for i in range(width) for j in range(i, width)]
        rows = [(i, j, at, digit) for i, j, value in entries for at, digit in _limbs(value)]
        columns = list(zip(*rows)) or [()] * 4
        names = ("i", "j", "limb", "digit")
        yield pa.record_batch({name: pa.array(column, pa.int64()) for name, column in zip(names, columns)})

    parts = vectors.mapInArrow(run, "i BIGINT, j BIGINT, limb BIGINT, digit BIGINT")
    n, sums, products = 0, [0] * width, [[0] * width for _ in range(width)]
    for i, j, limb, digit in parts.groupBy("i", "j", "limb").agg(F.sum("digit")).collect():
        value = digit << _LIMB * limb
        if i < 0:
            n += value
        elif j < 0:
            sums[i] += value
        else:
            products[i][j] += value
            if i != j:
                products[j][i] += value
    return n, sums, products


def primes() -> Iterator[int]:
    """Primes below 2**31, falling."""
    for number in range((1 << 31) - 1, 3, -2):
        odd, twos = number - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        for base in (2, 3, 5, 7):  # enough for every number below 3.2e9
            x = pow(base, odd, number)
            if x in (1, number - 1):
                continue
            for _ in range(twos - 1):
                x = x * x % number
                if x == number - 1:
                    break
            else:
                break
        else:
            yield number


def polynomial_mod(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(x - matrix) modulo ``p``, from the constant up."""
    h = matrix.copy()
    size = len(h)
    for m in range(1, size - 1):
        below = np.flatnonzero(h[m:, m - 1])
        if not len(below):
            continue
        pivot = m + int(below[0])
        if pivot != m:
            h[[m, pivot]] = h[[pivot, m]]
            h[:, [m, pivot]] = h[:, [pivot, m]]
        factors = h[m + 1:, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1:] = (h[m + 1:] - factors[:, None] * h[m]) % p
        h[:, m] = (h[:, m] + (h[:, m + 1:] * factors % p).sum(axis=1)) % p
    minors = np.zeros((size + 1, size + 1), np.int64)  # of the leading blocks
    minors[0, 0] = 1
    for k in range(1, size + 1):
        minors[k, 1:] = minors[k - 1, :-1]
        weights = np.zeros(k, np.int64)
        below = 1
        for i in range(k - 1, -1, -1):
            weights[i] = int(h[i, k - 1]) * below % p
            if i:
                below = below * int(h[i, i - 1]) % p
        minors[k] = (minors[k] - (weights[:, None] * minors[:k] % p).sum(axis=0)) % p
    return minors[size]


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(x - matrix), from the constant up, for a positive semidefinite matrix of
    integers. Each prime is a row of its own; the matrix rides with the function."""
    size = len(matrix)
    trace = sum(matrix[i][i] for i in range(size))
    # The k-th coefficient is largest where all roots are equal.
    most = max(comb(size, k) * (trace // size + 1) ** k for k in range(size + 1))
    chosen, product = [], 1
    for prime in primes():
        chosen.append(prime)
        product *= prime
        if product > 2 * most:
            break

    def run(batches):
        values = np.array(matrix, object)
        for batch in batches:
            found = [polynomial_mod((values % p).astype(np.int64), p).tolist() for p in batch.column("prime").to_pylist()]
            yield pa.record_batch({"prime": batch.column("prime"), "coefficients": pa.array(found, pa.list_(pa.int64()))})

    rows = spark.createDataFrame([(p,) for p in chosen], "prime BIGINT")
    rows = rows.repartition(min(len(chosen), shuffle_partitions(spark)))
    modulus, coefficients = 1, [0] * (size + 1)
    for prime, residues in rows.mapInArrow(run, "prime BIGINT, coefficients ARRAY<BIGINT>").collect():
        inverse = pow(modulus, -1, prime)
        coefficients = [c + modulus * ((r - c) * inverse % prime) for c, r in zip(coefficients, residues)]
        modulus *= prime
    return [c - modulus if 2 * c > modulus else c for c in coefficients]


def _above(coefficients: list[int], point: int) -> int:
    """How many roots of a polynomial without complex roots are greater than ``point``."""
    shifted = list(coefficients)
    for start in range(len(shifted) - 1):
        for at in range(len(shifted) - 2, start - 1, -1):
            shifted[at] += point * shifted[at + 1]
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _value(coefficients: list[int], point: int) -> int:
    total = 0
    for c in reversed(coefficients):
        total = total * point + c
    return total


def largest_roots(coefficients: list[int], count: int, bits: int = ROOT_BITS) -> list[int]:
    """The ``count`` largest positive roots, falling, equal ones repeated, times 2**bits and rounded up,
    of a monic polynomial that has only real roots, none of them negative."""
    while coefficients[0] == 0 and len(coefficients) > 1:
        coefficients = coefficients[1:]
    degree = len(coefficients) - 1
    scaled = [c << bits * (degree - at) for at, c in enumerate(coefficients)]
    top = 1 - scaled[-2] if degree else 0  # roots are positive and sum to this less one
    found: list[int] = []
    open_ = [(0, top, degree, 0)]
    while open_ and len(found) < count:
        low, high, above_low, above_high = open_.pop()
        inside = above_low - above_high
        if inside == 0:
            continue
        if high - low <= 1:
            found += [high] * inside
        elif inside == 1:
            right = _value(scaled, high)
            if right == 0:
                low = high - 1
            while high - low > 1:
                middle = (low + high) // 2
                value = _value(scaled, middle)
                low, high = (low, middle) if value == 0 or (value > 0) == (right > 0) else (middle, high)
            found.append(high)
        else:
            middle = (low + high) // 2
            above = _above(scaled, middle)
            open_ += [(low, middle, above_low, above), (middle, high, above, above_high)]
    return found[:count]


def _solve(matrix: np.ndarray, right: np.ndarray) -> np.ndarray:
    """matrix * x = right by elimination with row pivots, in integers; a vanishing pivot counts as one."""
    size = len(matrix)
    both = np.concatenate([matrix, right], axis=1)
    for k in range(size):
        best = k + max(range(size - k), key=lambda at: abs(both[k + at, k]))
        if best != k:
            both[[k, best]] = both[[best, k]]
        both[k, k] = both[k, k] or 1
        if k + 1 < size:
            both[k + 1:, k:] -= both[k + 1:, k:k + 1] * both[k:k + 1, k:] // both[k, k]
    x = right * 0
    for k in range(size - 1, -1, -1):
        x[k] = (both[k, size:] - both[k, k + 1:size] @ x[k + 1:]) // both[k, k]
    return x


def _orthonormal(columns: np.ndarray) -> np.ndarray:
    """Columns of length 2**VECTOR_BITS, at right angles."""
    done = []
    for at in range(columns.shape[1]):
        column = columns[:, at] << VECTOR_BITS
        for _ in range(2):
            for other in done:
                column = column - (other * ((column @ other) >> VECTOR_BITS) >> VECTOR_BITS)
        length = isqrt(int(column @ column)) or 1
        done.append((column << VECTOR_BITS) // length)
    return np.stack(done, axis=1)


def null_vectors(matrix: list[list[int]], root: int, count: int) -> np.ndarray:
    """``count`` unit vectors, by row, that ``matrix`` maps to root / 2**ROOT_BITS times themselves."""
    size = len(matrix)
    shifted = np.array(matrix, object) << ROOT_BITS
    for at in range(size):
        shifted[at, at] -= root
    start = np.random.default_rng(size).integers(-(1 << 20), 1 << 20, (size, count)).astype(object)
    columns = _orthonormal(start)
    for _ in range(2):
        columns = _orthonormal(_solve(shifted, columns << VECTOR_BITS))
    vectors = np.array([[entry / (1 << VECTOR_BITS) for entry in row] for row in columns.T])
    largest = vectors[np.arange(count), np.abs(vectors).argmax(axis=1)]
    return vectors * np.sign(largest)[:, None]


def _usable(vectors: DataFrame, vector_col: str, id_col: str | None = None) -> DataFrame:
    """(id, vector) of rows whose vector is not null, not empty and holds finite entries only."""
    keep = [vectors[id_col].cast("long").alias("id")] if id_col else []
    rows = vectors.select(*keep, vectors[vector_col].cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.coalesce(finite, F.lit(False)) & (F.size("vector") > 0))


def fit(vectors: DataFrame, count: int = 8, vector_col: str = "embedding") -> Whitening:
    """The first ``count`` components of the usable vectors; fewer where the covariance has a smaller
    rank. Equal eigenvalues get some orthonormal basis of their space. Repeated rows count each time.
    Of several widths the one most rows have is fitted (ties: the widest). Without a usable vector
    there is no component."""
    rows = _usable(vectors, vector_col)
    widths = rows.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    if widths is None:
        return Whitening(0)
    width = widths["width"]
    n, sums, products = scatter(rows.where(F.size("vector") == width), width)
    matrix = [[n * products[i][j] - sums[i] * sums[j] for j in range(width)] for i in range(width)]
    model = Whitening(width, n, sums, sum(matrix[i][i] for i in range(width)))
    if model.trace == 0:
        return model
    model.roots = largest_roots(characteristic_polynomial(vectors.sparkSession, matrix), count)
    found, at = [], 0
    while at < len(model.roots):
        equal = model.roots.count(model.roots[at])
        found.append(null_vectors(matrix, model.roots[at], equal))
        at += equal
    model.components = np.concatenate(found)
    return model


def transform(vectors: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, deviation, whitened): for each usable row of the fitted width the exact squared distance
    from the mean times n * n (DECIMAL(38, 0), NULL beyond it) and its entry per component.

    Rows whose vector is null, of another width or holds a null or non-finite entry go. Null and
    repeated ids keep a row each. Other columns are not carried, so that none clashes. Entries beyond
    2**62 / 1024 in size count as that. An empty table gives no rows.
    """
    width, n, components = model.width, model.n, model.components
    divisors = model.scales()
    sums = np.array(model.sums, object)
    most_sum = max(map(abs, model.sums), default=0)

    def run(batches):
        for batch in batches:
            values = _integers(batch.column("vector"), width)
            most = n * int(np.abs(values).max(initial=0)) + most_sum
            small = most * most * width < 1 << 63
            off = values * n - sums.astype(np.int64) if small else values.astype(object) * n - sums
            squared = (off * off).sum(axis=1)
            if small:
                deviation = pa.array(squared).cast(pa.decimal128(38, 0))
            else:
                deviation = pa.array([Decimal(d) if d < 10 ** 38 else None for d in squared], pa.decimal128(38, 0))
            whitened = off.astype(np.float64) @ components.T / divisors
            offsets = pa.array(np.arange(len(values) + 1) * len(components), pa.int32())
            yield pa.record_batch({
                id_col: batch.column("id"), "deviation": deviation,
                "whitened": pa.ListArray.from_arrays(offsets, pa.array(whitened.ravel())),
            })

    shape = f"{id_col} BIGINT, deviation DECIMAL(38, 0), whitened ARRAY<DOUBLE>"
    rows = _usable(vectors, vector_col, id_col)
    if not model.roots:
        return vectors.sparkSession.createDataFrame([], shape)
    return rows.where(F.size("vector") == width).mapInArrow(run, shape)


def identity_error(whitened: DataFrame, count: int) -> float | None:
    """The largest entry, in size, of the covariance of ``whitened`` less the identity; ``whitened`` is
    read once."""
    pairs = [(i, j) for i in range(count) for j in range(i, count)]
    columns = [F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]) for i, j in pairs]
    if not columns:
        return None
    row = whitened.agg(*columns).first()
    return max(abs(value - (i == j)) for (i, j), value in zip(pairs, row)) if row[0] is not None else None


def whiten(vectors: DataFrame, count: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row per usable vector and
    component, components by falling eigenvalue from 1; see ``fit`` and ``transform``. The whitened
    rows are written once, so that their covariance is that of the rows returned."""
    model = fit(vectors, count, vector_col)
    rows = cut_lineage(transform(vectors, model, id_col, vector_col))
    error = identity_error(rows, len(model.roots))
    shares = F.array(*[F.lit(share) for share in model.explained()]).cast("array<double>")
    entries = rows.select(id_col, "deviation", F.posexplode("whitened").alias("_at", "whitened"))
    return entries.select(
        id_col, (F.col("_at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("_at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )
