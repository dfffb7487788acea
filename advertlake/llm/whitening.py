"""Whitening of embeddings by the exact characteristic polynomial of their integer scatter matrix.

Entries become whole numbers, so the scatter of the distinct vectors is an exact integer matrix. Its characteristic
polynomial is found modulo many primes, each by reduction to Hessenberg form in a task of its own, and put together by
Chinese remaindering. All roots are real and none is negative, so the sign changes of the polynomial shifted to a point
count the roots above it exactly (Descartes' rule, Budan and Fourier). Bisection with these counts isolates the largest
roots, signs at single points narrow them to some 36 digits. Components follow by inverse iteration: the matrix less
the root is solved in long decimals, which leaves its null space.

The driver holds what grows with the dimension only: the matrix, the polynomial and the components.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction
from math import isqrt, log2

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from advertlake.session import scratch_path, stage

# An entry c counts as floor(64 c) + 1000000; the second term changes no covariance and is left out.
SCALE = 64
LARGEST = 1 << 62  # entries beyond have no 64-bit number
COMPONENTS = 16
LIMB = 40  # bits of the parts in which exact sums travel
ROOT_BITS = 120  # relative accuracy of a root
DIGITS = 90  # of the decimals in which components are found
WIDTHS = ((1, "<i1"), (2, "<i2"), (4, "<i4"), (8, "<i8"))


# ---- vectors as whole numbers


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose entries are all finite, as little-endian numbers of the least width that holds the row."""
    for batch in batches:
        vectors, names = batch.column("vector"), batch.column("vec_id")
        there = np.flatnonzero(vectors.is_valid().to_numpy(zero_copy_only=False))
        vectors = vectors.take(pa.array(there))
        sizes = np.diff(vectors.offsets.to_numpy())
        values = vectors.flatten().cast(pa.float64()).fill_null(float("nan")).to_numpy()
        begins = np.concatenate(([0], np.cumsum(sizes)))
        rows, counts, packed = [], [], []
        with np.errstate(over="ignore", invalid="ignore"):
            whole = np.floor(values * SCALE)
        good = np.abs(whole) < LARGEST  # false for what is no number
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            cells = begins[at][:, None] + np.arange(size)
            at, cells = at[good[cells].all(axis=1)], cells[good[cells].all(axis=1)]
            numbers = whole[cells].astype(np.int64)
            low, high = (numbers.min(axis=1), numbers.max(axis=1)) if size else (np.zeros(len(at)),) * 2
            done = np.zeros(len(at), bool)
            for width, kind in WIDTHS:
                limit = 1 << (8 * width - 1)
                fits = ~done & (low >= -limit) & (high < limit)
                done |= fits
                rows += at[fits].tolist()
                counts += [int(size)] * int(fits.sum())
                packed += [r.tobytes() for r in numbers[fits].astype(kind)]
        ids = names.take(pa.array(there)).take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays([ids, pa.array(counts, pa.int32()), pa.array(packed, pa.binary())], names=["vec_id", "d", "packed"])


def _numbers(packed: pa.Array, d: int) -> np.ndarray:
    """The rows of a batch of packed vectors as one 64-bit matrix."""
    raw = packed.to_pylist()
    out = np.empty((len(raw), d), np.int64)
    sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // d
    for width, kind in WIDTHS:
        at = np.flatnonzero(sizes == width)
        if len(at):
            out[at] = np.frombuffer(b"".join([raw[i] for i in at]), kind).reshape(len(at), d)
    return out


# ---- exact sums


def exact_gram(rows: np.ndarray) -> np.ndarray:
    """Sums of products of all pairs of columns, as unbounded integers.

    Products are taken in floating point where every partial sum is below 2**53 and hence exact; larger numbers are cut
    into parts of 20 bits before.
    """
    top = int(np.abs(rows).max(initial=0))
    if top * top * len(rows) < 1 << 53:
        x = rows.astype(np.float64)
        return (x.T @ x).astype(np.int64).astype(object)
    total = np.zeros((rows.shape[1],) * 2, object)
    for begin in range(0, len(rows), 4096):
        part, parts = rows[begin : begin + 4096], []
        while np.any((part < -1) | (part > 0)) and len(parts) < 3:
            parts.append((part & 0xFFFFF).astype(np.float64))
            part = part >> 20
        parts.append(part.astype(np.float64))
        for a, x in enumerate(parts):
            for b, y in enumerate(parts):
                total += (x.T @ y).astype(np.int64).astype(object) * (1 << 20 * (a + b))
    return total


def _limbs(value: int) -> list[int]:
    """Parts of 40 bits, the last one signed, whose sums over many tasks stay within 64 bits."""
    out = []
    while not -(1 << LIMB) < value < 1 << LIMB:
        out.append(value & ((1 << LIMB) - 1))
        value >>= LIMB
    return [*out, value]


def _sum_matrix(partial: DataFrame, size: int) -> np.ndarray:
    """Symmetric matrix from ``i, j, k, v``; a few rows per pair of columns come to the driver."""
    total = np.zeros((size, size), object)
    for i, j, k, v in partial.groupBy("i", "j", "k").agg(F.sum("v").alias("v")).collect():
        total[i, j] += v << (LIMB * k)
        if i != j:
            total[j, i] += v << (LIMB * k)
    return total


def scatter(fit: DataFrame, d: int) -> tuple[int, list[int], np.ndarray]:
    """Number of vectors n, their sums T, and the integer matrix n * sum(y y') - T T', which is n**2 times the covariance."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d + 1, d + 1), object)
        for batch in batches:
            if batch.num_rows:
                rows = _numbers(batch.column("packed"), d)
                total += exact_gram(np.column_stack((rows, np.ones(len(rows), np.int64))))
        found = [(i, j, k, v) for i in range(d + 1) for j in range(i, d + 1) for k, v in enumerate(_limbs(int(total[i, j]))) if v]
        columns = list(zip(*found)) or [[]] * 4
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["i", "j", "k", "v"])

    total = _sum_matrix(fit.mapInArrow(sums, "i int, j int, k int, v bigint"), d + 1)
    n, t = int(total[d, d]), [int(x) for x in total[d, :d]]
    matrix = n * total[:d, :d] - np.outer(np.array(t, object), np.array(t, object))
    return n, t, matrix


# ---- characteristic polynomial


def primes_below(top: int, bits: int) -> list[int]:
    """Primes from ``top`` downwards whose product has more than ``bits`` bits."""
    out, have, p = [], 0.0, top - 1 + top % 2
    while have <= bits:
        p -= 2
        # Miller and Rabin: these bases decide below 3,215,031,751
        odd, twos = p - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        for base in (2, 3, 5, 7):
            x = pow(base, odd, p)
            if x not in (1, p - 1) and all((x := x * x % p) != p - 1 for _ in range(twos - 1)):
                break
        else:
            out.append(p)
            have += log2(p)
    return out


def polynomial_modulo(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients, lowest first, of the monic characteristic polynomial modulo a prime below 2**31."""
    h = (matrix % p).astype(np.int64)
    n = len(h)
    for m in range(1, n - 1):
        below = np.flatnonzero(h[m:, m - 1])
        if not len(below):
            continue
        i = m + int(below[0])
        if i != m:
            h[[i, m]] = h[[m, i]]
            h[:, [i, m]] = h[:, [m, i]]
        factor = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1 :] = (h[m + 1 :] - factor[:, None] * h[m] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * factor % p).sum(axis=1)) % p
    polys = np.zeros((n + 1, n + 1), np.int64)
    polys[0, 0] = 1
    for k in range(1, n + 1):
        now = np.zeros(n + 1, np.int64)
        now[1:] = polys[k - 1, :-1]
        now = (now - h[k - 1, k - 1] * polys[k - 1]) % p
        under = 1
        for i in range(k - 1, 0, -1):
            under = under * int(h[i, i - 1]) % p
            if not under:
                break
            now = (now - int(h[i - 1, k - 1]) * under % p * polys[i - 1]) % p
        polys[k] = now
    return polys[n]


def characteristic_polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Integer coefficients, lowest first, for a symmetric matrix without negative eigenvalues.

    Their sum of absolute values is the product of all (1 + root), at most (1 + trace / d)**d, which tells how many primes
    are needed. Every prime is a row; d + 1 numbers a prime come back.
    """
    d = len(matrix)
    trace = int(sum(matrix[i, i] for i in range(d)))
    bits = d * (trace // d + 2).bit_length() + 2
    primes = primes_below(1 << 31, bits)
    # whole rows as text, as pickled matrices of unbounded integers are several times larger
    rows = [" ".join(map(str, r)) for r in matrix.tolist()]

    def residues(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = np.array([[int(x) for x in r.split()] for r in rows], object)
        for frame in frames:
            found = [polynomial_modulo(whole, int(p)) for p in frame["p"]]
            yield pd.DataFrame({"p": frame["p"], "c": found})

    tasks = min(len(primes), spark.sparkContext.defaultParallelism * 2)
    asked = spark.createDataFrame([(p,) for p in primes], "p bigint").repartition(tasks)
    got = {r["p"]: r["c"] for r in asked.mapInPandas(residues, "p bigint, c array<bigint>").collect()}
    product = 1
    for p in primes:
        product *= p
    weights = [(p, product // p * pow(product // p, -1, p)) for p in primes]
    out = [sum(got[p][k] * w for p, w in weights) % product for k in range(d + 1)]
    out = [c - product if 2 * c > product else c for c in out]
    if out[d] != 1 or out[d - 1] != -trace:
        raise ArithmeticError("the residues do not make up a characteristic polynomial")
    return out


# ---- roots


def _scaled(poly: list[int], bits: int) -> list[int]:
    """The polynomial whose roots are those of ``poly`` times 2**bits."""
    d = len(poly) - 1
    return [c << (bits * (d - k)) for k, c in enumerate(poly)]


def roots_above(poly: list[int], at: int, bits: int = 0) -> int:
    """How many roots, each as often as it occurs, exceed at / 2**bits; exact, as all roots are real."""
    c = _scaled(poly, bits)
    d = len(c) - 1
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            c[k] += at * c[k + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _sign(poly: list[int], at: int, bits: int) -> int:
    value, d = 0, len(poly) - 1
    for k in range(d, -1, -1):
        value = value * at + (poly[k] << (bits * (d - k)))
    return (value > 0) - (value < 0)


def largest_roots(poly: list[int], k: int) -> list[tuple[Fraction, int]]:
    """The largest positive roots with how often each occurs, until ``k`` are counted; falling.

    An interval with one root is narrowed by signs, to 2**-120 of the root. One that still holds several at this width
    counts as a repeated root.
    """
    above_zero = roots_above(poly, 0)
    k = min(k, above_zero)
    if not k:
        return []
    top = -poly[-2] + 1  # the sum of all roots
    out: list[tuple[Fraction, int]] = []
    # (low, high, bits, roots above low, roots above high); the interval furthest up is last
    todo = [(0, top, 0, above_zero, 0)]
    while todo and sum(m for _, m in out) < k:
        low, high, bits, over_low, over_high = todo.pop()
        if over_low == over_high:
            continue
        single = over_low - over_high == 1
        if (high - low) << ROOT_BITS <= high:
            out.append((Fraction(low + high, 2 << bits), over_low - over_high))
            continue
        if high - low < 2:
            low, high, bits = low << 16, high << 16, bits + 16
        middle = (low + high) // 2
        if single:
            # the sign of the polynomial tells the parity of the roots above
            sign = _sign(poly, middle, bits)
            if sign == 0:
                out.append((Fraction(middle, 1 << bits), 1))
                continue
            over = over_low if (sign < 0) == (over_low % 2 == 1) else over_high
        else:
            over = roots_above(poly, middle, bits)
        todo.append((low, middle, bits, over_low, over))
        todo.append((middle, high, bits, over, over_high))
    return out


# ---- components


def null_vectors(matrix: np.ndarray, root: Fraction, many: int, digits: int = DIGITS) -> list[list[Decimal]]:
    """``many`` orthonormal vectors that the matrix takes to ``root`` times themselves, by inverse iteration."""
    with decimal.localcontext() as context:
        context.prec = digits
        d = len(matrix)
        a = np.array([[Decimal(int(x)) for x in row] for row in matrix], object)
        shift = Decimal(root.numerator) / Decimal(root.denominator)
        for i in range(d):
            a[i, i] -= shift
        tiny = shift * Decimal(10) ** (10 - digits)
        order = list(range(d))
        for c in range(d):
            best = max(range(c, d), key=lambda r: abs(a[r, c]))
            if best != c:
                a[[c, best]] = a[[best, c]]
                order[c], order[best] = order[best], order[c]
            if abs(a[c, c]) < tiny:
                a[c, c] = tiny
            if c + 1 < d:
                a[c + 1 :, c] = a[c + 1 :, c] / a[c, c]
                a[c + 1 :, c + 1 :] -= np.multiply.outer(a[c + 1 :, c], a[c, c + 1 :])
        start = np.random.Generator(np.random.PCG64(11)).standard_normal((many, d))
        vectors = [np.array([Decimal(float(x)) for x in v], object) for v in start]
        for _ in range(3):
            solved = []
            for v in vectors:
                x = v[order]
                for r in range(d):
                    x[r] -= np.dot(a[r, :r], x[:r]) if r else 0
                for r in range(d - 1, -1, -1):
                    x[r] = (x[r] - (np.dot(a[r, r + 1 :], x[r + 1 :]) if r + 1 < d else 0)) / a[r, r]
                scale = max(map(abs, x))
                x = x / scale
                for _again in range(2):
                    for u in solved:
                        x = x - u * np.dot(u, x)
                x = x / np.dot(x, x).sqrt()
                solved.append(x)
            vectors = solved
        return [list(v) for v in vectors]


@dataclass
class Whitening:
    """The fitted transform: ``d`` entries, ``n`` distinct vectors with sums ``t``, falling eigenvalues as doubles with the
    parts of the variance they explain, and one row of ``axes`` per component, which is its unit vector over the root of
    its eigenvalue."""

    d: int
    n: int
    t: list[int]
    explained: list[float]
    eigenvalues: list[float]
    axes: np.ndarray

    def apply(self, numbers: np.ndarray) -> np.ndarray:
        return self.centred(numbers).astype(np.float64) / self.n @ self.axes.T

    def centred(self, numbers: np.ndarray) -> np.ndarray:
        """n * y - T for every entry, exactly; as unbounded integers where 64 bits might not do."""
        t = max(map(abs, self.t), default=0)
        if self.n * int(np.abs(numbers).max(initial=0)) + t < 1 << 62:
            return self.n * numbers - np.array(self.t, np.int64)
        return self.n * numbers.astype(object) - np.array(self.t, object)


def fit_whitening(spark: SparkSession, fit: DataFrame, d: int, *, components: int = COMPONENTS) -> Whitening:
    """Fit to packed vectors of ``d`` entries. Components without variance are left out, so there may be none."""
    n, t, matrix = scatter(fit, d)
    if n == 0 or not any(matrix[i, i] for i in range(d)):
        return Whitening(d, n, t, [], [], np.zeros((0, d)))
    found = largest_roots(characteristic_polynomial(spark, matrix), components)
    rows = [" ".join(map(str, r)) for r in matrix.tolist()]

    def axes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = [[int(x) for x in r.split()] for r in rows]
        for frame in frames:
            for k, top, bottom, many in frame.itertuples(index=False):
                for j, v in enumerate(null_vectors(whole, Fraction(int(top), int(bottom)), many)):
                    yield pd.DataFrame({"k": [k], "j": [j], "v": [[float(x) for x in v]]})

    asked = [(k, str(r.numerator), str(r.denominator), m) for k, (r, m) in enumerate(found)]
    roots = spark.createDataFrame(asked, "k int, top string, bottom string, many int").repartition(len(asked))
    got = {(r["k"], r["j"]): r["v"] for r in roots.mapInPandas(axes, "k int, j int, v array<double>").collect()}
    trace = int(sum(matrix[i, i] for i in range(d)))
    values, parts, vectors = [], [], []
    for k, (root, many) in enumerate(found):
        for j in range(many):
            if len(values) < components:
                v = np.array(got[k, j])
                v = v if v[np.argmax(np.abs(v))] > 0 else -v
                value = root / n**2
                # the square root of a fraction to some 30 digits
                deep = Fraction(isqrt((value.numerator << 200) // value.denominator), 1 << 100)
                values.append(float(value))
                parts.append(float(root / trace))
                vectors.append(v / float(deep))
    return Whitening(d, n, t, parts, values, np.array(vectors))


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance less the identity; 0 without components."""
    k = len(model.axes)
    if not k:
        return 0.0

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            if batch.num_rows:
                w = model.apply(_numbers(batch.column("packed"), model.d))
                w = np.column_stack((w, np.ones(len(w))))
                total += w.T @ w
        i, j = np.triu_indices(k + 1)
        columns = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "v"])

    found = fit.mapInArrow(sums, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    total = np.zeros((k + 1, k + 1))
    for i, j, v in found:
        total[i, j] = total[j, i] = v
    mean = total[k, :k] / model.n
    return float(np.abs(total[:k, :k] / model.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(embeddings: DataFrame, *, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row per vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Rows whose vector is null, or has an entry that is null, not finite or of 2**56 or more (its number would have no 64
    bits), are dropped, and so are those of another length than most vectors have (of equally frequent lengths the longest
    counts). Vectors that repeat count once in the fit and get rows each; ids may be null or repeat. Components have
    positive variance, so there may be fewer than asked for; equal vectors only, or no vector, give no row. ``deviation``
    is null where it exceeds 64 bits. Other columns are not read.
    """
    spark = embeddings.sparkSession
    kind = embeddings.schema["vec_id"].dataType.simpleString()
    given = embeddings.select("vec_id", F.col(vector).alias("vector"))
    packed = stage(given.mapInArrow(_pack, f"vec_id {kind}, d int, packed binary"), "packed-vectors")
    out = f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    # as many rows as there are lengths
    usual = packed.groupBy("d").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if usual is None or usual["d"] == 0:
        return spark.createDataFrame([], out)
    d = usual["d"]
    rows = packed.filter(F.col("d") == d)
    fit = stage(rows.select("packed").distinct(), "fit-list", scratch_path(spark, "fit-list"))
    model = fit_whitening(spark, fit, d, components=components)
    error = identity_error(fit, model)
    k = len(model.axes)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not k or not batch.num_rows:
                continue
            numbers = _numbers(batch.column("packed"), d)
            centred = model.centred(numbers)
            top = int(np.abs(centred).max(initial=0))
            if top * top * d < 1 << 63:
                far = pa.array((centred.astype(np.int64) ** 2).sum(axis=1))
            else:
                exact = [sum(int(x) ** 2 for x in r) for r in centred]
                far = pa.array([x if x < 1 << 63 else None for x in exact], pa.int64())
            again = np.repeat(np.arange(batch.num_rows), k)
            size = len(again)
            columns = [
                batch.column("vec_id").take(pa.array(again)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), batch.num_rows)),
                pa.array(np.full(size, model.n)),
                far.take(pa.array(again)),
                pa.array(model.apply(numbers).ravel()),
                pa.array(np.tile(model.explained, batch.num_rows)),
                pa.array(np.full(size, error)),
            ]
            heads = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
            yield pa.RecordBatch.from_arrays(columns, names=heads)

    return rows.select("vec_id", "packed").mapInArrow(project, out)
