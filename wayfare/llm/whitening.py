"""Operator 12: whitening of embeddings by the exact characteristic polynomial of their scatter.

Entries are scaled to integers, so the scatter ``n * sum(x x') - S S'`` (n squared times the covariance)
is an integer matrix that the tasks sum without rounding. Its characteristic polynomial is found modulo
primes by reduction to Hessenberg form, the primes dealt out as Spark rows, and put together by Chinese
remaindering. All roots are real, so the sign changes of the shifted polynomial count the roots above a
point exactly (Descartes); bisection isolates the largest ones, Newton steps refine them to ``DIGITS``
digits, and inverse iteration in decimal arithmetic finds the unit vectors of their null spaces, one
task for each root. A last pass projects the rows.

Memory: a task holds one Arrow batch and the matrix; the driver holds the matrix, the polynomial and the
components, which depend on the number of dimensions and not on the rows.

Vectors that are null, or hold null or non-finite entries, take no part, nor do empty ones and those of
another length than the most frequent one (the longest of several). A component without variance cannot be scaled
and is left out, so equal vectors give no rows, like an empty table. Equal eigenvalues share an
orthonormal basis. Null ids and repeated rows take part as they are; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, ship

SCALE = 1024
DIGITS = 60


def sound_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, v array<double>, dim`` of the vectors without null and non-finite entries."""
    whole = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    rows = df.select(F.col(id_col).cast("bigint").alias("vec_id"), whole.alias("v"))
    sound = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return rows.filter((F.coalesce(F.size("v"), F.lit(0)) > 0) & sound).select("vec_id", "v", F.size("v").alias("dim"))


def integers(batch: pa.RecordBatch, dim: int, scale: int) -> np.ndarray:
    """``floor(scale * v)`` as a matrix, of Python integers where 64 bits are not enough."""
    v = np.floor(batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) * scale)
    return v.astype(np.int64) if not len(v) or np.abs(v).max() < 2.0**62 else np.array([[int(x) for x in row] for row in v.tolist()], object)


def exact_products(y: np.ndarray) -> np.ndarray:
    """``y' y`` without rounding, as Python integers."""
    if y.dtype == object:
        return y.T @ y
    most = int(np.abs(y).max(initial=0))
    rows = (2**53 - 1) // max(1, most * most)
    if rows < 64:
        return y.astype(object).T @ y.astype(object)
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for a in range(0, len(y), rows):  # sums below 2**53 are exact in doubles
        part = y[a : a + rows].astype(np.float64)
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


def pieces_of(x: int) -> list[int]:
    """``x`` in pieces of 18 digits, the lowest first, each with the sign of ``x``."""
    sign, x, out = (-1 if x < 0 else 1), abs(x), []
    while x or not out:
        x, part = divmod(x, 10**18)
        out.append(sign * part)
    return out


def moments(rows: DataFrame, dim: int, scale: int) -> tuple[int, list[int], list[list[int]]]:
    """Exact count, sums and sums of products of the integers of all rows."""
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(dim, object), np.zeros((dim, dim), object)
        for batch in batches:
            if batch.num_rows:
                y = integers(batch, dim, scale)
                n += len(y)
                sums, products = sums + y.sum(0), products + exact_products(y)
        if n:
            limbs = [(i, k, part) for i, x in enumerate([n, *sums, *products[np.triu_indices(dim)]]) for k, part in enumerate(pieces_of(int(x)))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*limbs, strict=True), (pa.int32(), pa.int32(), pa.int64()), strict=True)], names=["i", "k", "limb"])

    parts = rows.select("v").mapInArrow(run, "i int, k int, limb long")
    added = parts.groupBy("i", "k").agg(F.sum(F.col("limb").cast("decimal(20,0)")).alias("limb"))
    found = [0] * (1 + dim + dim * (dim + 1) // 2)
    for r in added.collect():  # as many numbers as the matrix has
        found[r["i"]] += int(r["limb"]) * 10 ** (18 * r["k"])
    upper = iter(found[1 + dim :])
    matrix = [[0] * dim for _ in range(dim)]
    for j, k in zip(*np.triu_indices(dim), strict=True):
        matrix[j][k] = matrix[k][j] = next(upper)
    return found[0], found[1 : 1 + dim], matrix


def is_prime(n: int) -> bool:
    """Miller and Rabin's test with bases that decide all 32-bit numbers."""
    d, r = n - 1, 0
    while d % 2 == 0:
        d, r = d // 2, r + 1
    for a in (2, 3, 5, 7):
        x = pow(a, d, n)
        if x in (1, n - 1):
            continue
        for _ in range(r - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_below(top: int, bits: int) -> list[int]:
    """The largest primes below ``top`` whose product has more than ``bits`` bits."""
    out, total, n = [], 0.0, top - 1 - top % 2
    while total <= bits:
        if is_prime(n):
            out.append(n)
            total += math.log2(n)
        n -= 2
    return out


def characteristic_mod(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients of ``det(t I - matrix)`` modulo ``p`` below 2**31, the constant first."""
    h, n = matrix % p, len(matrix)
    for k in range(n - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        at = k + 1 + int(below[0])
        if at != k + 1:
            h[[at, k + 1]] = h[[k + 1, at]]
            h[:, [at, k + 1]] = h[:, [k + 1, at]]
        factor = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - factor[:, None] * h[k + 1] % p) % p
        # The inverse change on the columns, in steps whose sums stay below 2**63.
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * factor % p).sum(1)) % p
    polys = [np.array([1], np.int64)]
    for m in range(1, n + 1):
        last = polys[-1]
        new = np.zeros(m + 1, np.int64)
        new[1:] = last
        new[:m] = (new[:m] - int(h[m - 1, m - 1]) * last) % p
        run = 1
        for i in range(1, m):
            run = run * int(h[m - i, m - i - 1]) % p
            if not run:
                break
            c = run * int(h[m - i - 1, m - 1]) % p
            new[: m - i] = (new[: m - i] - c * polys[m - i - 1]) % p
        polys.append(new % p)
    return [int(x) for x in polys[n]]


def characteristic(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Integer coefficients of ``det(t I - matrix)`` for a positive semidefinite matrix, the constant first."""
    dim, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    # A coefficient is a sum of products of eigenvalues, at most (1 + trace / dim) ** dim times the choices.
    bits = int(dim * (math.log2(dim + trace) - math.log2(dim))) + 4 if trace else 4
    primes = primes_below(2**31, bits + 2 * dim)
    flat, ship_of = [str(x) for row in matrix for x in row], spark.sparkContext.broadcast
    held = ship_of(flat)  # the square of the dimensions

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = None
        for batch in batches:
            for p in batch.column("p").to_pylist():
                whole = whole if whole is not None else [int(x) for x in held.value]
                a = np.array([x % p for x in whole], np.int64).reshape(dim, dim)
                yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([characteristic_mod(a, p)], pa.list_(pa.int64()))], names=["p", "residues"])

    ship(spark)
    tasks = min(len(primes), max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    ps = spark.range(0, len(primes), 1, tasks).select(F.get(F.array(*[F.lit(p) for p in primes]), F.col("id").cast("int")).cast("long").alias("p"))
    rows = ps.mapInArrow(run, "p long, residues array<long>").collect()  # dim + 1 numbers a prime
    modulus = math.prod(primes)
    out = [0] * (dim + 1)
    for r in rows:
        rest = modulus // r["p"]
        unit = rest * pow(rest, -1, r["p"])
        for i, x in enumerate(r["residues"]):
            out[i] += unit * x
    held.unpersist()
    return [x - modulus if (x := c % modulus) * 2 > modulus else x for c in out]


def roots_above(poly: list[int], at: int) -> int:
    """Roots greater than ``at``, with multiplicity, of a polynomial that has real roots only."""
    c = list(poly)
    for i in range(len(c) - 1):
        for k in range(len(c) - 2, i - 1, -1):
            c[k] += at * c[k + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def stretched(poly: list[int], bits: int) -> list[int]:
    """The polynomial whose roots are ``2**bits`` times as large."""
    n = len(poly) - 1
    return [c << (bits * (n - i)) for i, c in enumerate(poly)]


def isolate(poly: list[int], count: int) -> list[tuple[int, int, int, int]]:
    """Positive roots from the largest down, ``count`` of them at least: (low, high, bits, multiplicity).

    ``low < root * 2**bits <= high``; an interval with several roots is shorter than ``10**-DIGITS`` of its root.
    """
    top = 1 << max(1, (-poly[-2]).bit_length())  # the sum of the roots is above each
    out: list[tuple[int, int, int, int]] = []
    found = 0
    pending = [(0, top, 0, 0, roots_above(poly, 0))]  # low, high, bits, roots above high, roots above low
    scaled = {0: poly}
    need = int(DIGITS * 3.33) + 8
    while pending and found < count:
        low, high, bits, above, below = pending.pop()
        if below == above:
            continue
        if below - above == 1 and low > 0 and 4 * (high - low) < low or high - low == 1 and low.bit_length() > need:
            out.append((low, high, bits, below - above))
            found += below - above
            continue
        if high - low == 1:
            low, high, bits = 2 * low, 2 * high, bits + 1
        mid = (low + high) // 2
        if bits not in scaled:
            scaled[bits] = stretched(poly, bits)
        n = roots_above(scaled[bits], mid)
        pending += [(low, mid, bits, n, below), (mid, high, bits, above, n)]
    return out


def refined(poly: list[int], low: int, high: int, bits: int) -> Decimal:
    """The single root in ``(low, high] / 2**bits`` to ``DIGITS`` digits, by guarded Newton steps."""
    with localcontext() as ctx:
        # Room for cancellation: the size of the largest term at the root.
        ctx.prec = 2 * DIGITS + len(str(max(abs(c) for c in poly)))
        a, b = Decimal(low) / (1 << bits), Decimal(high) / (1 << bits)
        c = [Decimal(x) for x in poly]

        def value(x: Decimal) -> tuple[Decimal, Decimal]:
            f, d = Decimal(0), Decimal(0)
            for k in reversed(c):
                d = d * x + f
                f = f * x + k
            return f, d

        at_b, _ = value(b)
        if not at_b:
            return b
        x, close = (a + b) / 2, Decimal(10) ** -(DIGITS + 5)
        while True:
            f, d = value(x)
            if not f:
                return x
            if (f > 0) == (at_b > 0):
                b = x
            else:
                a = x
            new = x - f / d if d else (a + b) / 2
            if not a < new < b:
                new = (a + b) / 2
            if abs(new - x) <= close * x or b - a <= close * b:
                return new
            x = new


def middle(low: int, high: int, bits: int) -> Decimal:
    with localcontext() as ctx:
        ctx.prec = 2 * DIGITS
        return Decimal(low + high) / (2 << bits)


def null_vectors(matrix: list[list[int]], root: Decimal, many: int) -> list[list[float]]:
    """Unit vectors that span the null space of ``matrix - root``: inverse iteration in decimal arithmetic."""
    dim = len(matrix)
    with localcontext() as ctx:
        ctx.prec = 2 * DIGITS + 10
        tiny = root.scaleb(-DIGITS - 20) if root else Decimal(1).scaleb(-DIGITS)
        m = np.array([[Decimal(x) for x in row] for row in matrix], object)
        for i in range(dim):
            m[i, i] -= root
        order = list(range(dim))
        factors = np.full((dim, dim), Decimal(0), object)
        for k in range(dim):
            at = max(range(k, dim), key=lambda i: abs(m[i, k]))
            if at != k:
                m[[at, k]], factors[[at, k]] = m[[k, at]], factors[[k, at]]
                order[at], order[k] = order[k], order[at]
            if abs(m[k, k]) < tiny:
                m[k, k] = tiny
            for i in range(k + 1, dim):
                if m[i, k]:
                    factors[i, k] = f = m[i, k] / m[k, k]
                    m[i, k:] = m[i, k:] - f * m[k, k:]

        def solve(v: list[Decimal]) -> list[Decimal]:
            y = [v[i] for i in order]
            for k in range(dim):
                for i in range(k + 1, dim):
                    if factors[i, k]:
                        y[i] -= factors[i, k] * y[k]
            for k in range(dim - 1, -1, -1):
                y[k] = (y[k] - sum((m[k, j] * y[j] for j in range(k + 1, dim)), Decimal(0))) / m[k, k]
            return y

        rng = np.random.default_rng(dim)
        some = [[Decimal(int(x)) for x in rng.integers(1, 1 << 30, dim)] for _ in range(many)]
        for _ in range(4):
            out: list[list[Decimal]] = []
            for v in map(solve, some):
                for _ in range(2):  # twice, so that what rounding leaves goes too
                    for u in out:
                        dot = sum((a * b for a, b in zip(u, v, strict=True)), Decimal(0))
                        v = [b - dot * a for a, b in zip(u, v, strict=True)]
                    norm = sum((x * x for x in v), Decimal(0)).sqrt()
                    v = [x / norm for x in v]
                out.append(v)
            some = out
        return [[float(x) for x in v] for v in some]


def principal(spark: SparkSession, scatter: list[list[int]], count: int) -> list[tuple[Decimal, list[float]]]:
    """The ``count`` largest positive eigenvalues of the integer scatter with their unit vectors."""
    if not any(scatter[i][i] for i in range(len(scatter))):
        return []
    poly = characteristic(spark, scatter)
    ranges = isolate(poly, count)
    held = spark.sparkContext.broadcast([[str(x) for x in row] for row in scatter])
    coefficients = spark.sparkContext.broadcast([str(x) for x in poly])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                low, high, bits, many = int(r["low"]), int(r["high"]), r["bits"], r["many"]
                root = refined([int(x) for x in coefficients.value], low, high, bits) if many == 1 else middle(low, high, bits)
                vectors = null_vectors([[int(x) for x in row] for row in held.value], root, many)
                yield pa.RecordBatch.from_pylist([{"at": r["at"], "root": str(root), "vectors": vectors}], schema=answer)

    answer = pa.schema([("at", pa.int32()), ("root", pa.string()), ("vectors", pa.list_(pa.list_(pa.float64())))])
    rows = [(i, str(low), str(high), bits, many) for i, (low, high, bits, many) in enumerate(ranges)]
    asked = spark.createDataFrame(rows, "at int, low string, high string, bits int, many int").repartitionByRange(len(rows), "at")
    found = sorted(asked.mapInArrow(run, "at int, root string, vectors array<array<double>>").collect())
    return [(Decimal(r["root"]), v) for r in found for v in r["vectors"]][:count]


def whitened(df: DataFrame, components: int = 8, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row a vector and component: ``vec_id, component, n, deviation decimal, whitened, explained, identity_error``.

    ``deviation`` is exact; one beyond 38 digits is an error. The fit is on all sound vectors. A constant added to the scaled integers changes none of these columns, so none is added.
    """
    spark = df.sparkSession
    vectors = sound_vectors(df, id_col, vector_col)
    lengths = vectors.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    fit, scatter, sums, dim, n = [], [], [], 0, 0
    if lengths:
        dim = lengths[0]["dim"]
        vectors = vectors.filter(F.col("dim") == dim)
        n, sums, products = moments(vectors, dim, scale)
        scatter = [[n * products[j][k] - sums[j] * sums[k] for k in range(dim)] for j in range(dim)]
        fit = principal(spark, scatter, components)
    if not fit:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    with localcontext() as ctx:
        ctx.prec = 2 * DIGITS
        trace = sum(scatter[i][i] for i in range(dim))
        scales = [float(e.sqrt() / n) for e, _ in fit]
        explained = [float(e / trace) for e, _ in fit]
    basis = np.array([v for _, v in fit]).T
    project = projection(n, sums, basis, scales, scale)
    rows = cut(vectors.select("vec_id", "v").mapInArrow(project, "vec_id long, deviation decimal(38,0), w array<double>"))
    at = F.posexplode("w").alias("component", "whitened")
    long = rows.select("vec_id", "deviation", at)
    share = F.get(F.array(*[F.lit(x) for x in explained]), F.col("component"))
    return long.select(
        "vec_id", (F.col("component") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", share.alias("explained"),
        F.lit(identity_error(rows, len(fit))).alias("identity_error"),
    )


def projection(n: int, sums: list[int], basis: np.ndarray, scales: list[float], scale: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What a task does to its rows: the exact deviation and the whitened components."""
    dim = len(sums)
    whole, rest = [s // n for s in sums], np.array([s % n / n for s in sums])
    largest = max(map(abs, sums))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            y = integers(batch, dim, scale)
            most = max(n * max(abs(int(y.max())), abs(int(y.min()))) + largest, 1)
            if most >= 2**62:
                y = y.astype(object)
            w = ((y - np.array(whole, y.dtype)).astype(np.float64) - rest) @ basis / scales
            far = y * n - np.array(sums, y.dtype)
            far = far if dim * most * most < 2**62 else far.astype(object)
            deviation = [Decimal(int(x)) for x in (far * far).sum(1)]
            w = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1) * len(scales), pa.int32()), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(deviation, pa.decimal128(38, 0)), w], names=["vec_id", "deviation", "w"])

    return run


def identity_error(rows: DataFrame, count: int) -> float:
    """Largest absolute entry of the covariance of ``w`` minus the identity."""
    pairs = [(i, j) for i in range(count) for j in range(i, count)]
    found = rows.agg(*[F.covar_pop(F.get("w", F.lit(i)), F.get("w", F.lit(j))).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whitened_embeddings(embeddings: DataFrame) -> DataFrame:
    """The first eight components of all embeddings, the deviation as a long (an error where it is larger)."""
    return whitened(embeddings).withColumn("deviation", F.col("deviation").cast("long"))
