"""Embedding whitening by an exact characteristic polynomial.

Every entry c becomes the integer ``floor(64 * c) + 1000000``.  The fit list is every distinct integer vector once; with
n vectors and sums S, its scatter ``M = n * sum(x x') - S S'`` is an exact integer matrix, and the covariance is M / n**2.

1. *Scatter*: each task adds products of its rows exactly (float64 products of small integers, whole numbers beyond);
   the partial sums are cut into limbs of 40 bits, so Spark's long sums are exact at every size.
2. *Polynomial*: the characteristic polynomial of M modulo one prime is a Hessenberg reduction of small integers; Spark
   deals the primes to tasks, as many as the coefficients' bound ``binomial(d, k) * (trace / d)**k`` asks for, and Chinese
   remaindering gives the integer coefficients.
3. *Roots*: M is symmetric, so all roots are real and Descartes' count of the sign changes of the polynomial shifted to a
   is exactly the number of roots above a.  Bisection by this count isolates the largest roots; a root alone in its
   interval is bisected further by the polynomial's exact sign, to `PRECISION` bits.  Roots that the precision cannot part
   stay one cluster.
4. *Components*: M minus the root, in fixed point of `WORKING` bits, is eliminated with pivoting and solved a few times
   (inverse iteration into the null space).  Vectors of one cluster are made orthogonal between steps.

What reaches the driver is d by d numbers and the polynomial, whatever the number of rows.

Defined edge cases: rows whose vector is null, empty, or holds null or non-finite entries are dropped; vectors of another
length than the most frequent one (ties: the longer one) too; repeated rows and null ids stay as rows and count once in the
fit list; entries whose 64-fold leaves the range of 62 bits are set to its end; directions without variance (eigenvalue
zero) have no component, so an empty table, one vector, or equal vectors give an empty result; a deviation that no long
holds is null; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm.common import map_arrow, staged

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
#: Bits to which a root is known, relative to its size.
PRECISION = 192
#: Bits of the fixed point in which components are solved for.
WORKING = 320
LIMB = 40
_END = 2**62


# ---- integer vectors --------------------------------------------------------------------------------------------


def grid(vector: str) -> Column:
    """The integer vector of a valid row, else null."""
    entry = lambda c: c.cast("double")
    finite = lambda c: c.isNotNull() & ~F.isnan(entry(c)) & (F.abs(entry(c)) < float("inf"))
    valid = F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(vector, finite)
    step = lambda c: F.floor(F.least(F.greatest(entry(c) * SCALE, F.lit(-float(_END))), F.lit(float(_END))))
    return F.when(valid, F.transform(vector, lambda c: step(c).cast("long") + F.lit(OFFSET).cast("long")))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of x - OFFSET: shifted by a whole number, the scatter is the same and products stay small."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims) - OFFSET


def _largest(y: np.ndarray) -> int:
    return max(int(y.max()), -int(y.min())) if y.size else 0


def gram(y: np.ndarray) -> np.ndarray:
    """y'y as exact whole numbers (an array of Python integers)."""
    top = _largest(y)
    out = np.zeros((y.shape[1], y.shape[1]), object)
    if top >= 1 << 26:
        return out + y.astype(object).T @ y.astype(object) if len(y) else out
    step = max(1, (1 << 53) // max(1, top * top))
    for at in range(0, len(y), step):
        part = y[at : at + step].astype(np.float64)
        out += (part.T @ part).astype(np.int64).astype(object)
    return out


def centred(y: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * y - sums, exact: longs where they suffice, else Python integers."""
    top = max(n * _largest(y), max((abs(s) for s in sums), default=0))
    if top < 1 << 62:
        return y * np.int64(n) - np.array(sums, np.int64)
    return y.astype(object) * n - np.array(sums, object)


def deviations(z: np.ndarray) -> list[int | None]:
    """Sum of squares of each row; None where no long holds it."""
    if z.dtype != object and _largest(z) ** 2 * z.shape[1] < 1 << 63:
        return (z * z).sum(axis=1).tolist()
    exact = [sum(int(v) ** 2 for v in row) for row in z]
    return [v if v < 1 << 63 else None for v in exact]


# ---- characteristic polynomial ----------------------------------------------------------------------------------


def primes(count: int, below: int = 2**31) -> list[int]:
    """The largest primes below a bound, falling."""
    root = isqrt(below) + 1
    sieve = np.ones(root + 1, bool)
    sieve[:2] = False
    for k in range(2, isqrt(root) + 1):
        if sieve[k]:
            sieve[k * k :: k] = False
    small = np.flatnonzero(sieve)
    out: list[int] = []
    at = below - 1
    while len(out) < count:
        if (at % small[small * small <= at]).all():
            out.append(at)
        at -= 1
    return out


def polynomial_mod(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(x I - matrix) modulo p < 2**31, constant first."""
    a = matrix % p
    d = len(a)
    for k in range(1, d - 1):  # similarity to upper Hessenberg form, column k - 1
        rows = np.flatnonzero(a[k:, k - 1])
        if not len(rows):
            continue
        pivot = k + int(rows[0])
        if pivot != k:
            a[[k, pivot]] = a[[pivot, k]]
            a[:, [k, pivot]] = a[:, [pivot, k]]
        factor = a[k + 1 :, k - 1] * pow(int(a[k, k - 1]), -1, p) % p
        a[k + 1 :] = (a[k + 1 :] - factor[:, None] * a[k] % p) % p
        a[:, k] = (a[:, k] + (a[:, k + 1 :] * factor % p).sum(axis=1)) % p
    polys = np.zeros((d + 1, d + 1), np.int64)  # polys[k]: of the leading k by k part
    polys[0, 0] = 1
    for k in range(d):
        new = np.zeros(d + 1, np.int64)
        new[1:] = polys[k, :-1]
        new = (new - a[k, k] * polys[k]) % p
        below = 1
        for i in range(k - 1, -1, -1):
            below = below * int(a[i + 1, i]) % p
            if not below:
                break
            new = (new - int(a[i, k]) * below % p * polys[i]) % p
        polys[k + 1] = new
    return polys[d].tolist()


def chinese(residues: list[tuple[int, list[int]]]) -> list[int]:
    """Whole numbers, least in size, from their residues by prime."""
    modulus, values = 1, [0] * len(residues[0][1])
    for p, rest in residues:
        inverse = pow(modulus, -1, p)
        values = [v + modulus * ((r - v) * inverse % p) for v, r in zip(values, rest, strict=True)]
        modulus *= p
    return [v - modulus if 2 * v > modulus else v for v in values]


def prime_count(d: int, trace: int) -> int:
    """Primes below 2**31 that surely hold every coefficient of a positive semidefinite matrix and its sign."""
    bits = max((comb(d, k) * trace**k // d**k).bit_length() for k in range(d + 1)) + 2
    return bits // 30 + 1


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(x I - matrix) of a positive semidefinite integer matrix, constant first."""
    d = len(matrix)
    moduli = primes(prime_count(d, sum(matrix[i][i] for i in range(d))))
    wide = np.array(matrix, object)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mine = [moduli[i] for i in batch.column("id").to_pylist()]
            found = [polynomial_mod((wide % p).astype(np.int64), p) for p in mine]
            kinds = [pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((mine, found), kinds, strict=True)], names=["p", "c"])

    ids = spark.range(0, len(moduli), 1, min(len(moduli), 64))
    found = ids.transform(map_arrow, reduce, "p long, c array<long>").collect()
    return chinese(sorted((r.p, list(r.c)) for r in found))


# ---- roots ------------------------------------------------------------------------------------------------------


def _at_scale(poly: list[int], bits: int) -> list[int]:
    """Coefficients whose roots are 2**bits times as large."""
    d = len(poly) - 1
    return [c << (bits * (d - k)) for k, c in enumerate(poly)]


def roots_above(poly: list[int], a: int) -> int:
    """Roots beyond a of a polynomial whose roots are all real: the sign changes of its Taylor shift."""
    c = list(poly)
    d = len(c) - 1
    for i in range(d):
        for j in range(d - 1, i - 1, -1):
            c[j] += a * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def _value(poly: list[int], a: int) -> int:
    out = 0
    for c in reversed(poly):
        out = out * a + c
    return out


def largest_roots(poly: list[int], top: int, count: int, precision: int = PRECISION) -> list[tuple[int, int, int]]:
    """(mantissa, bits, cluster) of the `count` largest roots, falling: the root is mantissa / 2**bits.

    All roots are real, lie in [0, top], and the `count` largest are positive.  Equal clusters mark roots that the
    precision does not part.
    """
    found: list[tuple[int, int, int]] = []
    clusters = 0
    todo = [(0, top, 0, 0, len(poly) - 1)]  # interval (low, high] at 2**bits, roots above its high and low ends
    while todo:
        low, high, bits, above, upto = todo.pop()
        if above >= count or above == upto:
            continue
        if upto - above == 1 and low > 0 and (high - low) * 4 <= low:
            found.append((*_narrow(poly, low, high, bits, precision), clusters))
            clusters += 1
            continue
        if low > 0 and high - low <= low >> precision:
            found.extend([(high, bits, clusters)] * (min(upto, count) - above))
            clusters += 1
            continue
        middle, bits = low + high, bits + 1
        inner = roots_above(_at_scale(poly, bits), middle)
        todo.append((2 * low, middle, bits, inner, upto))
        todo.append((middle, 2 * high, bits, above, inner))  # the larger half first
    return found


def _narrow(poly: list[int], low: int, high: int, bits: int, precision: int) -> tuple[int, int]:
    """Bisect an interval (low, high] that holds one simple root, by exact signs."""
    ends = _value(_at_scale(poly, bits), high)
    while ends and high - low > low >> precision:
        middle, low, high, bits = low + high, 2 * low, 2 * high, bits + 1
        here = _value(_at_scale(poly, bits), middle)
        if not here:
            return middle, bits
        low, high = (low, middle) if (here > 0) == (ends > 0) else (middle, high)
    return high, bits


# ---- components -------------------------------------------------------------------------------------------------


def _eliminate(a: np.ndarray, work: int) -> tuple[np.ndarray, list[int]]:
    """LU factors of a fixed-point matrix (one array) and the order of its rows."""
    d = len(a)
    order = list(range(d))
    for k in range(d):
        pivot = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
        if pivot != k:
            a[[k, pivot]] = a[[pivot, k]]
            order[k], order[pivot] = order[pivot], order[k]
        a[k, k] = a[k, k] or 1  # a null pivot is one unit of the last place
        if k + 1 < d:
            factor = (a[k + 1 :, k] << work) // a[k, k]
            a[k + 1 :, k] = factor
            a[k + 1 :, k + 1 :] -= (factor[:, None] * a[k, k + 1 :][None, :]) >> work
    return a, order


def _solve(lu: np.ndarray, order: list[int], right: np.ndarray, work: int) -> np.ndarray:
    x = right[order]
    d = len(x)
    for k in range(d):
        x[k + 1 :] -= (lu[k + 1 :, k] * x[k]) >> work
    for k in range(d - 1, -1, -1):
        x[k] = (x[k] << work) // lu[k, k]
        x[:k] -= (lu[:k, k] * x[k]) >> work
    return x


def _scaled(x: np.ndarray, work: int) -> np.ndarray:
    return (x << work) // max(1, max(abs(v) for v in x))


def components(matrix: list[list[int]], roots: list[tuple[int, int, int]], work: int = WORKING) -> np.ndarray:
    """Unit eigenvectors (columns) of the integer matrix for its roots, to double precision."""
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    base = (np.array(matrix, object) << work) // trace
    done: dict[int, list[np.ndarray]] = {}
    factors: dict[int, tuple[np.ndarray, list[int]]] = {}
    out = np.zeros((d, len(roots)))
    for at, (mantissa, bits, cluster) in enumerate(roots):
        if cluster not in factors:
            shifted = base.copy()
            shifted[np.diag_indices(d)] -= (mantissa << work) // (trace << bits)
            factors[cluster] = _eliminate(shifted, work)
        others = done.setdefault(cluster, [])
        x = np.array([pow(7, (i + 1) * (len(others) + 1), 1009) - 504 for i in range(d)], object) << work
        for _ in range(4):
            x = _scaled(x, work)
            for o in others:
                x = x - o * int((x * o).sum()) // int((o * o).sum())
            x = _solve(*factors[cluster], x, work)
            x = _scaled(x, work)
        for o in others:
            x = x - o * int((x * o).sum()) // int((o * o).sum())
        others.append(x)
        size = isqrt(int((x * x).sum()))
        out[:, at] = [int(v) / size for v in x]
    return out


# ---- Spark ------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: exact counts and sums, and the components as doubles (d x components: small)."""

    dims: int
    n: int
    sums: tuple[int, ...]  # of x - OFFSET
    values: tuple[float, ...]  # eigenvalues of the covariance, falling
    explained: tuple[float, ...]
    vectors: np.ndarray  # columns
    identity_error: float

    def whiten(self, y: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
        """Whitened rows and exact deviations of rows of x - OFFSET."""
        z = centred(y, self.n, list(self.sums))
        scale = self.n * np.sqrt(np.array(self.values))
        return z.astype(np.float64) @ self.vectors / scale, deviations(z)


def _limbs(at: list[tuple[int, int, int]]) -> pa.RecordBatch:
    """(i, j, total) as rows (i, j, limb, part): total = sum of part * 2**(LIMB * limb)."""
    rows: list[tuple[int, int, int, int]] = []
    for i, j, total in at:
        limb = 0
        while abs(total) >= 1 << LIMB:
            total, low = total >> LIMB, total & ((1 << LIMB) - 1)
            rows.append((i, j, limb, low))
            limb += 1
        rows.append((i, j, limb, total))
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["i", "j", "limb", "part"])


def _scatter(vectors: DataFrame, dims: int) -> tuple[int, list[int], np.ndarray]:
    """(n, sums, products) of the rows of x - OFFSET; -1 stands for the column of ones."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, total = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
        for batch in batches:
            y = _matrix(batch.column("x"), dims)
            n += len(y)
            total += gram(y)
            sums += (y if _largest(y) < 1 << 40 else y.astype(object)).sum(axis=0).astype(object)
        if n:
            cells = [(-1, -1, n)] + [(-1, i, int(s)) for i, s in enumerate(sums)]
            yield _limbs(cells + [(i, j, int(total[i, j])) for i in range(dims) for j in range(i, dims)])

    parts = vectors.transform(map_arrow, add, "i int, j int, limb int, part long")
    cells: dict[tuple[int, int], int] = {}
    for r in parts.groupBy("i", "j", "limb").agg(F.sum("part").alias("part")).collect():
        cells[r.i, r.j] = cells.get((r.i, r.j), 0) + (r.part << (LIMB * r.limb))
    products = np.array([[cells[min(i, j), max(i, j)] for j in range(dims)] for i in range(dims)], object)
    return cells[-1, -1], [cells[-1, i] for i in range(dims)], products


def _identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity, measured on the list."""
    k = len(model.values)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            w = model.whiten(_matrix(batch.column("x"), model.dims))[0]
            total += w.T @ w
        yield pa.RecordBatch.from_pydict({"at": np.arange(k * k, dtype=np.int32), "total": total.ravel()})

    sums = vectors.transform(map_arrow, add, "at int, total double").groupBy("at").agg(F.sum("total").alias("total")).collect()
    covariance = np.zeros(k * k)
    for r in sums:
        covariance[r["at"]] = r.total / model.n
    return float(np.abs(covariance.reshape(k, k) - np.eye(k)).max())


def fit(embeddings: DataFrame, vector: str = "embedding", limit: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct integer vectors; None if no row has a valid vector."""
    spark = embeddings.sparkSession
    distinct = staged(embeddings.select(grid(vector).alias("x")).where("x is not null").distinct())
    common = distinct.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if common is None:
        return None
    dims = common.d
    vectors = distinct.where(F.size("x") == dims)
    n, sums, products = _scatter(vectors, dims)
    totals = np.array(sums, object)
    matrix = (products * n - totals[:, None] * totals[None, :]).tolist()
    trace = sum(matrix[i][i] for i in range(dims))
    if not trace:
        return Whitening(dims, n, tuple(sums), (), (), np.zeros((dims, 0)), 0.0)
    poly = characteristic_polynomial(spark, matrix)
    rank = dims - next(k for k, c in enumerate(poly) if c)  # the root zero is as often as the lowest coefficients vanish
    roots = largest_roots(poly, trace, min(limit, rank))
    values = tuple(m / (n * n << bits) for m, bits, _ in roots)
    explained = tuple(m / (trace << bits) for m, bits, _ in roots)
    model = Whitening(dims, n, tuple(sums), values, explained, components(matrix, roots), 0.0)
    return Whitening(*(getattr(model, f) for f in list(model.__dataclass_fields__)[:-1]), _identity_error(vectors, model))


def whiten(embeddings: DataFrame, model: Whitening | None, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error; map-only."""
    kind = embeddings.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not model.values:
        return embeddings.sparkSession.createDataFrame([], schema)
    k = len(model.values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            white, far = model.whiten(_matrix(batch.column("x"), model.dims))
            rows = batch.num_rows
            each = pa.array(np.repeat(np.arange(rows), k))
            columns = [
                batch.column(key).take(each),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, model.n, np.int64)),
                pa.array(far, pa.int64()).take(each),
                pa.array(white.ravel()),
                pa.array(np.tile(np.array(model.explained), rows)),
                pa.array(np.full(rows * k, model.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    rows = embeddings.select(key, grid(vector).alias("x")).where(F.size("x") == model.dims)
    return rows.transform(map_arrow, project, schema)
