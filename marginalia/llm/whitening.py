"""Embedding whitening by an exact characteristic polynomial.

Entries become integers, so the scatter matrix n * sum(x x') - S S' is an
integer matrix. Its characteristic polynomial is computed modulo many primes
(reduction to Hessenberg form, one prime a row of a distributed table) and put
together by Chinese remaindering. All its roots are real, so the sign changes
of the shifted polynomial count the roots above any point exactly, repeated
ones included: bisection isolates each eigenvalue to any precision. A component is
found by inverse iteration near the null space, in fixed-point arithmetic of
far more digits than a double has. Vectors themselves are only read by tasks:
what reaches the driver are numbers of the matrix.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import _arrow_schema, materialize

SCALE, SHIFT = 1024, 100_000
# Primes below 2**31: products of two residues fit a signed 64-bit number.
PRIME_BITS = 31
# Relative precision of an eigenvalue, fixed-point digits beyond the point and rounds of inverse iteration, in bits.
ROOT_BITS, FIXED_BITS, ROUNDS = 112, 320, 4
# Integers up to here are exact as doubles.
_EXACT = 1 << 53


class Component(NamedTuple):
    """An eigenvalue of the integer scatter (between two neighbouring fractions) and its unit vector."""

    value: float
    vector: list[float]


# -- integer scatter ----------------------------------------------------------------------------------------------

def _valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, y): scaled integers of the rows whose vector is there and holds finite numbers only."""
    v = F.col(vector_col).cast("array<double>")
    whole = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col(id_col).alias("vec_id"), v.alias("v")).where(whole & (F.size("v") > 0))
    return rows.select("vec_id", F.transform("v", lambda c: F.floor(c * F.lit(float(SCALE)))).alias("y"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _products(y: np.ndarray) -> np.ndarray:
    """y' y in whole numbers, as Python integers."""
    if y.size and float(np.abs(y).max()) ** 2 * len(y) < _EXACT:
        z = y.astype(np.float64)
        return (z.T @ z).astype(np.int64).astype(object)
    z = y.astype(object)
    return z.T @ z


def scatter(rows: DataFrame, dims: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, sums, n * sum(y y') - sums sums') of the rows (y), exact; entries of y up to 2**40 in size."""
    pairs = [(i, j) for i in range(dims) for j in range(i, dims)]
    schema = "cell int, total string"
    arrow = _arrow_schema(rows.sparkSession, schema)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, squares = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
        for batch in batches:
            if batch.num_rows:
                y = _matrix(batch.column(0))
                n += len(y)
                sums += y.sum(axis=0, dtype=object)
                squares += _products(y)
        if n:
            cells = [n, *sums, *(squares[i, j] for i, j in pairs)]
            yield pa.RecordBatch.from_pydict({"cell": list(range(len(cells))), "total": list(map(str, cells))}, schema=arrow)

    parts = rows.select("y").mapInArrow(add, schema)
    total = parts.groupBy("cell").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    if not total:
        return 0, [], []
    cells = [int(v) for _, v in sorted((r["cell"], r["total"]) for r in total)]
    n, sums = cells[0], cells[1:dims + 1]
    m = [[0] * dims for _ in range(dims)]
    for (i, j), v in zip(pairs, cells[dims + 1:]):
        m[i][j] = m[j][i] = n * v - sums[i] * sums[j]
    return n, sums, m


# -- characteristic polynomial ------------------------------------------------------------------------------------

def _is_prime(n: int) -> bool:
    """Exact below 3.2e9: Miller-Rabin to the bases 2, 3, 5, 7."""
    if any(n % p == 0 for p in (2, 3, 5, 7)):
        return n in (2, 3, 5, 7)
    d, s = n - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for a in (2, 3, 5, 7):
        x = pow(a, d, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(s - 1)):
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """The largest primes of PRIME_BITS bits whose product exceeds ``bound``."""
    out, product, p = [], 1, (1 << PRIME_BITS) - 1
    while product <= bound:
        if _is_prime(p):
            out.append(p)
            product *= p
        p -= 2
    return out


def polynomial_mod(m: list[list[int]], p: int) -> list[int]:
    """Coefficients of det(x - m) modulo the prime ``p``, the lowest first."""
    h = np.array([[v % p for v in row] for row in m], np.int64)
    d = len(h)
    for k in range(d - 2):
        pivots = np.flatnonzero(h[k + 1:, k])
        if not len(pivots):
            continue
        i = k + 1 + int(pivots[0])
        if i != k + 1:
            h[[i, k + 1]] = h[[k + 1, i]]
            h[:, [i, k + 1]] = h[:, [k + 1, i]]
        u = h[k + 2:, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2:] = (h[k + 2:] - u[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2:] * u % p).sum(axis=1)) % p
    # leading minors of x - h, one from those before
    minors = [np.array([1], np.int64)]
    for k in range(d):
        own = np.zeros(k + 2, np.int64)
        own[1:] = minors[k]
        own[:-1] -= minors[k] * int(h[k, k]) % p
        below = 1
        for i in range(k - 1, -1, -1):
            below = below * int(h[i + 1, i]) % p
            if not below:
                break
            own[:i + 1] -= minors[i] * (below * int(h[i, k]) % p) % p
        minors.append(own % p)
    return minors[d].tolist()


def characteristic_polynomial(df: DataFrame, m: list[list[int]]) -> list[int]:
    """Coefficients of det(x - m) of a positive semidefinite integer matrix, the lowest first.

    Signs alternate, and the k-th elementary symmetric function of the
    eigenvalues is at most binom(d, k) * (trace / d)**k: enough primes are taken to
    exceed that. Each is a row of a table; ``df`` only names the session.
    """
    spark, d = df.sparkSession, len(m)
    trace = sum(m[i][i] for i in range(d))
    bound = max(math.comb(d, k) * trace ** k // d ** k + 1 for k in range(d + 1))
    primes = primes_beyond(bound)
    shared = spark.sparkContext.broadcast(m)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ps = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_pydict({"p": ps, "c": [polynomial_mod(shared.value, p) for p in ps]}, schema=arrow)

    schema = "p long, c array<long>"
    arrow = _arrow_schema(spark, schema)
    table = spark.createDataFrame([(p,) for p in primes], "p long").repartition(min(len(primes), 64))
    value, modulus = [0] * (d + 1), 1
    for r in table.mapInArrow(reduce, schema).collect():
        p, inverse = r["p"], pow(modulus, -1, r["p"])
        # signs alternate: what is put together are the nonnegative symmetric functions
        value = [x + modulus * (((c if (d - k) % 2 == 0 else -c) - x) * inverse % p) for k, (x, c) in enumerate(zip(value, r["c"]))]
        modulus *= p
    return [x if (d - k) % 2 == 0 else -x for k, x in enumerate(value)]


# -- roots --------------------------------------------------------------------------------------------------------

def roots_above(poly: list[int], num: int, bits: int) -> int:
    """Roots above num / 2**bits of a polynomial with real roots only, repeated ones counted: sign changes of its shift."""
    d = len(poly) - 1
    c = [v << bits * (d - k) for k, v in enumerate(poly)]
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            c[k] += num * c[k + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def isolate(poly: list[int], k: int) -> tuple[int, int]:
    """(num, bits): the k-th largest root lies above num / 2**bits and at most 2**-bits higher."""
    low, high = 0, 1
    while roots_above(poly, high, 0) >= k:
        low, high = high, high * 2
    bits = max(0, ROOT_BITS - low.bit_length())
    low, high = low << bits, high << bits
    while high - low > 1:
        middle = (low + high) // 2
        if roots_above(poly, middle, bits) >= k:
            low = middle
        else:
            high = middle
    return low, bits


# -- components ---------------------------------------------------------------------------------------------------

def _factor(a: list[list[int]]) -> tuple[list[list[int]], list[int]]:
    """LU factors in place, in fixed point, with the rows' order."""
    d, order = len(a), list(range(len(a)))
    for k in range(d):
        i = max(range(k, d), key=lambda r: abs(a[r][k]))
        a[k], a[i], order[k], order[i] = a[i], a[k], order[i], order[k]
        if not a[k][k]:
            a[k][k] = 1  # the smallest fixed-point number: the point was the root itself
        row, pivot = a[k], a[k][k]
        for r in range(k + 1, d):
            own = a[r]
            f = own[k] = (own[k] << FIXED_BITS) // pivot
            if f:
                for j in range(k + 1, d):
                    own[j] -= f * row[j] >> FIXED_BITS
    return a, order


def _solve(lu: list[list[int]], order: list[int], b: list[int]) -> list[int]:
    d = len(lu)
    x = [b[i] for i in order]
    for r in range(d):
        x[r] -= sum(lu[r][j] * x[j] for j in range(r)) >> FIXED_BITS
    for r in range(d - 1, -1, -1):
        x[r] = ((x[r] << FIXED_BITS) - sum(lu[r][j] * x[j] for j in range(r + 1, d))) // lu[r][r]
    return x


def _unit(x: list[int]) -> list[int]:
    """Length one, in fixed point."""
    norm = math.isqrt(sum(v * v for v in x)) or 1
    return [(v << FIXED_BITS) // norm for v in x]


def components_of(m: list[list[int]], poly: list[int], k: int) -> Component:
    """The k-th component. Of an eigenvalue that occurs several times, each is orthogonal to those numbered before it."""
    num, bits = isolate(poly, k)
    first = roots_above(poly, num + 1, bits) + 1
    d = len(m)
    # halfway between the fractions
    a = [[(v << FIXED_BITS) - (((2 * num + 1) << FIXED_BITS) >> bits + 1 if i == j else 0) for j, v in enumerate(row)]
         for i, row in enumerate(m)]
    lu, order = _factor(a)
    found: list[list[int]] = []
    for own in range(first, k + 1):
        r = random.Random(own)
        x = _unit([r.getrandbits(64) - (1 << 63) for _ in range(d)])
        for _ in range(ROUNDS):
            x = _unit(_solve(lu, order, x))
            for y in found:
                dot = sum(p * q for p, q in zip(x, y)) >> FIXED_BITS
                x = [p - (dot * q >> FIXED_BITS) for p, q in zip(x, y)]
            x = _unit(x)
        found.append(x)
    x = found[-1]
    if max(x, key=abs) < 0:
        x = [-v for v in x]
    return Component((2 * num + 1) / (1 << bits + 1), [v / (1 << FIXED_BITS) for v in x])


def principal(df: DataFrame, m: list[list[int]], most: int) -> list[Component]:
    """Up to ``most`` components of positive eigenvalues; each is found by a task of its own."""
    poly = characteristic_polynomial(df, m)
    rank = roots_above(poly, 0, 0)
    if not rank:
        return []
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast((m, poly))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ks = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_pydict({"k": ks, "c": [json.dumps(components_of(*shared.value, k)) for k in ks]}, schema=arrow)

    schema = "k long, c string"
    arrow = _arrow_schema(spark, schema)
    table = spark.range(1, min(most, rank) + 1).repartitionByRange(min(most, rank), "id")
    return [Component(*json.loads(r["c"])) for r in sorted(table.mapInArrow(find, schema).collect(), key=lambda r: r["k"])]


# -- whitening ----------------------------------------------------------------------------------------------------

def _projected(rows: DataFrame, n: int, sums: list[int], found: list[Component]) -> DataFrame:
    """(vec_id, deviation, w) of rows (vec_id, y): centred as integers before anything is multiplied."""
    id_type = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, deviation decimal(38,0), w array<double>"
    arrow = _arrow_schema(rows.sparkSession, schema)
    axes = np.array([[v / math.sqrt(c.value) for v in c.vector] for c in found]).reshape(len(found), len(sums)).T

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            y = _matrix(batch.column(1))
            # n y - S in 64 bits where that is sure to hold it, in Python integers elsewhere
            size = n * int(np.abs(y).max()) + max(map(abs, sums))
            z = n * y - np.array(sums) if size < 1 << 62 else n * y.astype(object) - np.array(sums, object)
            if size * size * len(sums) < 1 << 63:
                deviation = (z * z).sum(axis=1)
            else:
                deviation = (z.astype(object) ** 2).sum(axis=1)
            w = z.astype(np.float64) @ axes
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([str(v) for v in deviation]).cast(pa.decimal128(38, 0)),
                                              pa.array(list(w), pa.list_(pa.float64()))], schema=arrow)

    return rows.mapInArrow(project, schema)


def _identity_error(white: DataFrame, k: int) -> float:
    """Largest absolute entry of the covariance of ``w`` minus the identity; centred before multiplying."""
    w = [F.get("w", F.lit(i)) for i in range(k)]
    means = white.agg(*[F.avg(x) for x in w]).first()
    centred: list[Column] = [x - F.lit(float(a)) for x, a in zip(w, means)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    covariance = white.agg(*[F.avg(centred[i] * centred[j]) for i, j in pairs]).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(covariance, pairs))


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = 8) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every remaining row and component.

    Rows whose vector is null, empty or holds a null or non-finite entry are left out, and so are
    rows of another length than most rows have (of lengths equally frequent, the least counts).
    An entry c becomes floor(1024 c) + 100000 (the shift changes no covariance and is left out inside);
    entries up to 2**30 in size are handled exactly. Components of eigenvalue zero are left out:
    equal vectors, a single one or an empty table give no rows. Repeated rows and ids count as often as they occur;
    extra columns aren't read.
    """
    rows = _valid(vectors, id_col, vector_col)
    common = rows.groupBy(F.size("y").alias("d")).count().orderBy(F.desc("count"), "d").first()
    names = "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
    dims = common["d"] if common else 0
    rows = rows.where(F.size("y") == dims)
    n, sums, m = scatter(rows, dims) if dims else (0, [], [])
    found = principal(vectors, m, most) if n else []
    if not found:
        kind = rows.schema["vec_id"].dataType.simpleString()
        return vectors.sparkSession.createDataFrame([], f"vec_id {kind}, component int, n long, deviation decimal(38,0), "
                                                        "whitened double, explained double, identity_error double")
    white = materialize(_projected(rows, n, sums, found), "whitened")
    trace = sum(m[i][i] for i in range(dims))
    explained = F.array(*[F.lit(c.value / trace) for c in found])
    error = _identity_error(white, len(found))
    out = white.select("vec_id", "deviation", F.posexplode("w").alias("k", "whitened"))
    return out.select("vec_id", (F.col("k") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                      F.element_at(explained, F.col("k") + 1).alias("explained"),
                      F.lit(error).alias("identity_error")).select(*names)
