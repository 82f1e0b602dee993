"""Whitening of embeddings from the exact characteristic polynomial of their scatter.

Entries become whole numbers x, so n, the sums S and the scatter
``A = n * sum(x x') - S S'`` (n^2 times the covariance) are exact integers.

1. One pass sums x and x x' per task; only width^2 / 2 totals reach the driver.
2. The characteristic polynomial of A is found modulo 31-bit primes, each by
   reduction to Hessenberg form, as Spark tasks over primes, and recombined by
   Chinese remaindering. A is positive semidefinite, so its k-th coefficient is
   at most the k-th elementary symmetric sum of the diagonal; the primes exceed
   twice that, so the polynomial is exact.
3. All roots are real: the sign changes of p(x + t) count exactly the roots
   above t. Each task isolates the k-th root by that count with bisection over
   dyadic numbers, and refines it to far more bits than the gap to its
   neighbours needs. Roots that agree to ``MERGE_BITS`` bits count as one root
   with its multiplicity.
4. Inverse iteration in fixed-point numbers on ``A - root`` gives the null space
   of each root, as tasks over roots; their components are orthonormal to
   double precision.
5. A pass over the table projects ``x - S / n``, whose numerator n x - S is exact.

What depends on the width alone (scatter, polynomial, components) passes the
driver; everything that grows with the rows is summed or projected in tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.batches import with_computed

SCALE, SHIFT = 64, 1_000_000
MERGE_BITS = 256
_LIMB = 1 << 60
#: Entries are kept within these bounds, so that a number of 64 bits holds x.
MOST = 1 << 62


# Exact sums

def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    """floor(64 c) for entries c, as 64-bit numbers; entries beyond 2^56 count as 2^56."""
    return np.clip(np.floor(SCALE * vectors.astype(np.float64)), -MOST, MOST).astype(np.int64)


def _matrix(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    column = batch.column(name)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _exactly(rows: np.ndarray) -> np.ndarray:
    """Rows as numbers whose products cannot overflow: doubles below 2^53, Python's own beyond."""
    most = int(np.abs(rows).max(initial=0))
    return rows.astype(np.float64) if most * most * max(1, len(rows)) < 1 << 53 else rows.astype(object)


_whole = np.vectorize(int, otypes=[object])


def _summing(width: int):
    """Per task: the count, sums and products of floor(64 c), cut into limbs that Spark can add."""
    upper = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums, products = 0, np.zeros(width, object), np.zeros((width, width), object)
        for batch in batches:
            every = whole_numbers(_matrix(batch, "vector", width))
            for at in range(0, len(every), 4096):
                rows = _exactly(every[at:at + 4096])
                count += len(rows)
                sums += _whole(rows.sum(0))
                products += _whole(rows.T @ rows)
        if not count:
            return
        totals = [(-1, -1, count), *((-1, i, s) for i, s in enumerate(sums)),
                  *((int(i), int(j), products[i, j]) for i, j in zip(*upper))]
        yield pa.RecordBatch.from_arrays([
            pa.array([t[0] for t in totals], pa.int32()), pa.array([t[1] for t in totals], pa.int32()),
            pa.array([Decimal(t[2] // _LIMB) for t in totals], pa.decimal128(38, 0)),
            pa.array([Decimal(t[2] % _LIMB) for t in totals], pa.decimal128(38, 0))], names=["i", "j", "high", "low"])
    return run


def exact_scatter(vectors: DataFrame, width: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, sums, A) of ``vector`` rows, as whole numbers; S is of floor(64 c), and A does not depend on the shift."""
    parts = vectors.mapInArrow(_summing(width), "i int, j int, high decimal(38,0), low decimal(38,0)")
    totals = {(r.i, r.j): int(r.high) * _LIMB + int(r.low)
              for r in parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()}
    n = totals.get((-1, -1), 0)
    sums = [totals.get((-1, i), 0) for i in range(width)]
    a = [[n * totals.get((min(i, j), max(i, j)), 0) - sums[i] * sums[j] for j in range(width)] for i in range(width)]
    return n, sums, a


# Characteristic polynomial

def _is_prime(p: int) -> bool:
    """Miller-Rabin; these bases decide all numbers below 3.4e9."""
    d, s = p - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for base in (2, 3, 5, 7):
        x = pow(base, d, p)
        if x in (1, p - 1):
            continue
        for _ in range(s - 1):
            x = x * x % p
            if x == p - 1:
                break
        else:
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """The largest primes below 2^31, as many as it takes for their product to exceed ``bound``."""
    found, product, p = [], 1, (1 << 31) - 1
    while product <= bound:
        if _is_prime(p):
            found.append(p)
            product *= p
        p -= 2
    return found


def coefficient_bound(a: list[list[int]]) -> int:
    """The largest elementary symmetric sum of the diagonal, which bounds all coefficients of a semidefinite matrix."""
    sums = [1]
    for i in range(len(a)):
        sums = [b + a[i][i] * c for b, c in zip([*sums, 0], [0, *sums])]
    return max(sums)


def polynomial_modulo(a: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(x - A) modulo a prime below 2^31, highest first, by reduction to Hessenberg form."""
    h, n = a % p, len(a)
    for k in range(n - 2):
        below = np.flatnonzero(h[k + 1:, k])
        if not len(below):
            continue
        pivot = k + 1 + int(below[0])
        if pivot != k + 1:
            h[[k + 1, pivot]] = h[[pivot, k + 1]]
            h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        factor = h[k + 2:, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2:, k:] = (h[k + 2:, k:] - factor[:, None] * h[k + 1, k:] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2:] * factor % p).sum(1)) % p
    found = np.zeros((n + 1, n + 1), np.int64)  # lowest first
    found[0, 0] = 1
    for k in range(1, n + 1):
        found[k, 1:] = found[k - 1, :-1]
        found[k] = (found[k] - h[k - 1, k - 1] * found[k - 1]) % p
        chain = 1
        for i in range(k - 1, 0, -1):
            chain = chain * int(h[i, i - 1]) % p
            if not chain:
                break
            found[k] = (found[k] - int(h[i - 1, k - 1]) * chain % p * found[i - 1]) % p
    return found[n][::-1].copy()


def characteristic_polynomial(spark, a: list[list[int]]) -> list[int]:
    """Exact coefficients of det(x - A), highest first; tasks work on primes, the driver recombines.

    What is collected has width + 1 residues for each prime, and their number follows the width.
    """
    primes = primes_beyond(2 * coefficient_bound(a))
    width = len(a)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = batch.column(0).to_pylist()
            found = [polynomial_modulo(np.array([[v % p for v in row] for row in a], np.int64), p).tolist() for p in chosen]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["p", "c"])

    tasks = spark.createDataFrame([(p,) for p in primes], "p long").repartition(min(len(primes), 64))
    whole, modulus = [0] * (width + 1), 1
    for r in tasks.mapInArrow(run, "p long, c array<long>").collect():
        inverse = pow(modulus, -1, r.p)
        whole = [w + modulus * ((c - w) * inverse % r.p) for w, c in zip(whole, r.c)]
        modulus *= r.p
    return [w - modulus if 2 * w > modulus else w for w in whole]


# Roots

def roots_above(polynomial: list[int], at: int, bits: int) -> int:
    """How many roots exceed at / 2^bits, with multiplicity; all roots must be real."""
    shifted = [c << (bits * k) for k, c in enumerate(polynomial)]
    n = len(shifted)
    for end in range(n - 1, 0, -1):  # Taylor shift by repeated synthetic division
        for k in range(1, end + 1):
            shifted[k] += at * shifted[k - 1]
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _sign(polynomial: list[int], at: int, bits: int) -> int:
    value = 0
    for k, c in enumerate(polynomial):
        value = value * at + (c << (bits * k))
    return (value > 0) - (value < 0)


def isolated_root(polynomial: list[int], k: int, bound: int) -> tuple[int, int, int, int]:
    """(numerator, bits, first, last): the k-th largest root (from 1) as numerator / 2^bits, an upper bound of it.

    ``first`` and ``last`` number the roots that share it. The root is exact to
    ``MERGE_BITS`` bits beyond its distance to the next other root.
    """
    nonzero = len(polynomial) - 1
    while nonzero and polynomial[nonzero] == 0:
        nonzero -= 1
    width = len(polynomial) - 1
    if k > nonzero:
        return 0, 0, nonzero + 1, width
    low, high, bits = 0, bound, 0  # low < root <= high
    above_low, above_high = nonzero, 0
    floor_bits = MERGE_BITS + bound.bit_length()
    while above_low - above_high > 1 and bits < floor_bits:
        if high - low == 1:
            low, high, bits = 2 * low, 2 * high, bits + 1
        middle = (low + high) // 2
        above = roots_above(polynomial, middle, bits)
        if above >= k:
            low, above_low = middle, above
        else:
            high, above_high = middle, above
    if above_low - above_high > 1:
        return high, bits, above_high + 1, above_low
    target = bits + MERGE_BITS + max(0, bound.bit_length() - (high - low).bit_length())
    falling = _sign(polynomial, high, bits)
    if falling == 0:
        return high, bits, k, k
    while bits < target or high - low > 1:
        if high - low == 1:
            low, high, bits = 2 * low, 2 * high, bits + 1
        middle = (low + high) // 2
        sign = _sign(polynomial, middle, bits)
        if sign == 0:
            return middle, bits, k, k
        if sign == falling:
            high = middle
        else:
            low = middle
    return high, bits, k, k


# Components

def null_space(a: list[list[int]], numerator: int, bits: int, size: int) -> np.ndarray:
    """Orthonormal vectors (rows) of the null space of A - root, by inverse iteration in fixed-point numbers."""
    width = len(a)
    work = 2 * (bits + max(1, max(abs(v) for row in a for v in row)).bit_length()) + 128
    one = 1 << work
    system = np.array([[(v << work) - ((numerator << work) >> bits if i == j else 0) for j, v in enumerate(row)]
                       for i, row in enumerate(a)], object)
    order, tiny = list(range(width)), 1
    for k in range(width):  # elimination with row pivots
        best = max(range(k, width), key=lambda i: abs(system[i, k]))
        if best != k:
            system[[k, best]] = system[[best, k]]
            order[k], order[best] = order[best], order[k]
        if system[k, k] == 0:
            system[k, k] = tiny
        for i in range(k + 1, width):
            if system[i, k]:
                factor = (system[i, k] << work) // system[k, k]
                system[i, k] = factor
                system[i, k + 1:] -= factor * system[k, k + 1:] >> work

    def solved(right: list[int]) -> list[int]:
        x = [right[i] for i in order]
        for i in range(width):
            x[i] -= sum((system[i, j] * x[j] for j in range(i)), 0) >> work
        for i in reversed(range(width)):
            rest = x[i] - (sum((system[i, j] * x[j] for j in range(i + 1, width)), 0) >> work)
            x[i] = (rest << work) // system[i, i]
        return x

    def unit(v: list[int], against: list[list[int]]) -> list[int]:
        scale = max(1, max(abs(c) for c in v))
        v = [(c << work) // scale for c in v]
        for _ in range(2):
            for other in against:
                share = sum(c * o for c, o in zip(v, other)) >> work
                v = [c - (share * o >> work) for c, o in zip(v, other)]
        length = max(1, math.isqrt(sum(c * c for c in v)))
        return [(c << work) // length for c in v]

    found: list[list[int]] = []
    for s in range(size):
        v = unit([one * ((i * 2654435761 + s * 40503 + 12345) % 1009 + 1) for i in range(width)], found)
        for _ in range(3):
            v = unit(solved(v), found)
        found.append(v)
    out = np.array([[c / one for c in v] for v in found])
    return np.array([v if v[np.argmax(np.abs(v))] > 0 else -v for v in out])


class Components:
    """The fit: n, sums of floor(64 c), eigenvalues of A (n^2 times those of the covariance) and unit components."""

    def __init__(self, n: int, sums: list[int], trace: int, roots: list[float], vectors: np.ndarray):
        self.n, self.sums, self.trace, self.roots, self.vectors = n, sums, trace, roots, vectors

    @property
    def explained(self) -> list[float]:
        return [r / self.trace if self.trace else 0.0 for r in self.roots]


def fit(vectors: DataFrame, width: int, most: int = 32) -> Components:
    """The first ``most`` components of a frame of ``vector`` rows of this width."""
    spark = vectors.sparkSession
    n, sums, a = exact_scatter(vectors, width)
    trace = sum(a[i][i] for i in range(width))
    asked = min(most, width)
    if not trace:
        return Components(n, sums, 0, [0.0] * asked, np.eye(width)[:asked])
    polynomial = characteristic_polynomial(spark, a)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [isolated_root(polynomial, k, trace + 1) for k in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                pa.array([str(f[0]) for f in found]), *(pa.array([f[i] for f in found], pa.int32()) for i in (1, 2, 3))],
                names=["numerator", "bits", "first", "last"])

    tasks = spark.createDataFrame([(k,) for k in range(1, asked + 1)], "k int").repartition(asked)
    roots = {r.first_: (int(r.numerator), r.bits, r.last) for r in tasks.mapInArrow(
        find, "numerator string, bits int, first int, last int").withColumnRenamed("first", "first_").collect()}

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            firsts = batch.column(0).to_pylist()
            found = [null_space(a, *roots[f][:2], roots[f][2] - f + 1).tolist() for f in firsts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.list_(pa.float64())))], names=["f", "v"])

    tasks = spark.createDataFrame([(f,) for f in sorted(roots)], "f int").repartition(len(roots))
    spaces = {r.f: r.v for r in tasks.mapInArrow(solve, "f int, v array<array<double>>").collect()}
    values, rows = [], []
    for f in sorted(roots):
        numerator, bits, last = roots[f]
        values += [numerator / (1 << bits)] * (last - f + 1)
        rows += spaces[f]
    return Components(n, sums, trace, values[:asked], np.array(rows[:asked]))


# Projection

def _centred(rows: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, list[int | None]]:
    """(x - S / n, sum of (n x - S)^2) per row; a deviation beyond 64 bits is null."""
    most = max(int(np.abs(rows).max(initial=0)) * n, max((abs(s) for s in sums), default=0))
    if most < 1 << 61:
        gap = rows * np.int64(n) - np.array(sums, np.int64)
        far = int(np.abs(gap).max(initial=0))
        squares = (gap * gap).sum(1).tolist() if far * far * gap.shape[1] < 1 << 63 else [
            sum(int(g) * int(g) for g in row) for row in gap]
        return gap / n, [s if s < 1 << 63 else None for s in squares]
    gaps = [[int(x) * n - s for x, s in zip(row, sums)] for row in rows]
    squares = [sum(g * g for g in row) for row in gaps]
    return (np.array([[g / n for g in row] for row in gaps]).reshape(rows.shape),
            [s if s < 1 << 63 else None for s in squares])


def _projected(vectors: DataFrame, fitted: Components, width: int) -> DataFrame:
    """``vector`` replaced by deviation and the whitened values (null where a component has no variance)."""
    roots = np.array(fitted.roots)
    scale = np.array([fitted.n / math.sqrt(r) if r > 0 else 0.0 for r in roots])
    axes, n, sums = (fitted.vectors * scale[:, None]).T, fitted.n, fitted.sums

    def arrays(batch: pa.RecordBatch) -> list:
        centred, deviations = _centred(whole_numbers(_matrix(batch, "vector", width)), n, sums)
        values = centred @ axes
        flat = pa.array(values.ravel(), mask=np.tile(roots <= 0, len(values)))
        return [pa.array(deviations, pa.int64()),
                pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32()), flat)]

    return with_computed(vectors, "deviation long, whitened array<double>", arrays, drop=["vector"])


def _identity_error(projected: DataFrame, n: int, live: int) -> float:
    """Largest entry of the covariance of the whitened values minus the identity, over components with variance."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(live), np.zeros((live, live))
        for batch in batches:
            column = batch.column("whitened")
            rows = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)[:, :live]
            sums += rows.sum(0)
            products += rows.T @ rows
        pairs = [(-1, i, v) for i, v in enumerate(sums)] + [(i, j, products[i, j]) for i in range(live) for j in range(i, live)]
        yield pa.RecordBatch.from_arrays([pa.array([int(p[k]) for p in pairs], pa.int32()) for k in (0, 1)]
                                         + [pa.array([float(p[2]) for p in pairs])], names=["i", "j", "v"])

    if not live:
        return 0.0
    totals = {(r.i, r.j): r.v / n for r in projected.select("whitened").mapInArrow(run, "i int, j int, v double")
              .groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}
    # The values are centred before they are multiplied; what rounding leaves of their means is taken off.
    return max(abs(v - totals[-1, i] * totals[-1, j] - (i == j)) for (i, j), v in totals.items() if i >= 0)


def whiten(embeddings: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", most: int = 32) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for each remaining row and component.

    Rows whose vector is null or holds null or non-finite entries are dropped,
    and so are those whose width is not the commonest (of equally common ones
    the larger). Repeated rows count and are returned as often as they occur;
    null ids are kept. Components without variance have null ``whitened`` and
    ``explained`` 0; ``identity_error`` is over the others, 0 where none is.
    ``deviation`` is null beyond 64 bits; entries beyond 2^56 count as 2^56. An
    empty table or empty vectors give an empty result. Other columns are not
    read. Equal eigenvalues get some orthonormal basis of their space.
    """
    vector = F.col(embedding).cast("array<double>")
    good = embeddings.select(F.col(vec_id).alias("vec_id"), vector.alias("vector")).where(
        F.col("vector").isNotNull() & F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    commonest = good.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    width = commonest["width"] if commonest else 0
    good = good.where(F.size("vector") == width)
    if not width:
        fitted = Components(0, [], 0, [], np.zeros((0, 0)))
        error = 0.0
        rows = good.where("false").select("vec_id", F.lit(0).cast("long").alias("deviation"), F.array().cast("array<double>").alias("whitened"))
    else:
        fitted = fit(good.select("vector"), width, most)
        rows = _projected(good, fitted, width)
        error = _identity_error(rows, fitted.n, sum(r > 0 for r in fitted.roots))
    explained = F.array(*map(F.lit, fitted.explained)) if fitted.roots else F.array(F.lit(0.0))
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(fitted.n).cast("long").alias("n"), "deviation",
        "whitened", explained[F.col("at")].alias("explained"), F.lit(float(error)).alias("identity_error"))
