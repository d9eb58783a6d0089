"""Whitening of vectors by the exact characteristic polynomial of their integer scatter.

Each component c becomes the whole number x = floor(64 c) + 1,000,000. Over the distinct vectors (the fit
list, n of them) Spark adds up sums and products of x exactly: components are cut into limbs of 20 bits, a
task adds products of limbs where doubles are exact, and Spark adds the tasks' whole numbers. With the
scatter A = n * sum(x x') - S S' (n^2 times the covariance):

1. the characteristic polynomial of A modulo many primes, each by reduction to Hessenberg form, in tasks
   that take a share of the primes; the remainders are put together to whole coefficients, exactly;
2. all roots are real, so the sign changes of the polynomial's coefficients, moved to a, count the roots
   above a. Bisection with exact counts isolates the largest roots, Newton steps in whole numbers of 2^-FINE
   refine them;
3. the null space of A - root * I by inverse iteration with DIGITS decimal digits gives the components, one
   task a root. Roots that no 2^-FINE tells apart are one root with several components.

Vectors that are null or hold null or non-finite entries are left out, and so are those whose length is not
the most frequent one (the longer of equally frequent ones), and empty ones. Rows that repeat are returned
each, but count once for the fit; so do rows of different ids with equal vectors. A component whose
eigenvalue is 0 cannot be scaled to 1 and is left out; with one distinct vector nothing is returned.
Entries beyond 2^62 / 64 count as that. `deviation` is null where it does not fit into 64 bits. An empty
table gives no rows; extra columns are left out.
"""

from __future__ import annotations

import decimal
from bisect import bisect_left
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.llm.common import stored

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
# Bits of a limb and the rows of a block: 20 + 20 + 12 bits stay exact in a double.
LIMB, BLOCK = 20, 4096
# Binary places of a refined root; decimal digits of inverse iteration, and its steps.
FINE, DIGITS, STEPS = 400, 130, 3
# Primes of one task, and rows of output made at once.
PRIMES, ROWS = 4, 1024


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and x as whole numbers without the offset, of the vectors that can be used."""
    value = F.col("embedding")
    finite = F.forall(value, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    bound = float(1 << 62)
    whole = F.transform(
        value, lambda c: F.greatest(F.lit(-bound), F.least(F.lit(bound), F.floor(c.cast("double") * SCALE).cast("double"))).cast("bigint")
    )
    return vectors.filter(value.isNotNull() & finite & (F.size(value) > 0)).select("vec_id", whole.alias("y"))


def of_one_length(rows: DataFrame) -> tuple[DataFrame, int]:
    """The rows of the most frequent length, and that length (0 for an empty table)."""
    lengths = rows.groupBy(F.size("y").alias("size")).count()
    first = lengths.orderBy(F.desc("count"), F.desc("size")).first()
    size = first["size"] if first else 0
    return rows.filter(F.size("y") == size), size


def _matrix(batch: pa.RecordBatch, name: str, size: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy().reshape(-1, size)


def _limbs(values: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Parts of whole numbers with their place, such that sum(part << place) is the number; zero parts are left out."""
    out, place = [], 0
    while values.any():
        # Rounded to the nearest multiple, so that numbers near zero have one part only.
        high = (values + (1 << (LIMB - 1))) >> LIMB
        out.append((place, values - (high << LIMB)))
        values, place = high, place + LIMB
    return out


def moments(fit: DataFrame, size: int) -> tuple[int, list[int], list[list[int]]]:
    """Number of rows, sums, and sums of products of the fit list, all exact.

    A task gives size * (size + 3) / 2 numbers for each pair of limb places in use.
    """

    def run(batches):
        sums, products, count = {}, {}, 0
        for batch in batches:
            rows = _matrix(batch, "y", size)
            for at in range(0, len(rows), BLOCK):
                block = rows[at : at + BLOCK]
                count += len(block)
                parts = [(place, part.astype(np.float64)) for place, part in _limbs(block)]
                for place, part in parts:
                    sums[place] = sums.get(place, 0) + part.sum(0).astype(np.int64)
                    for other, more in parts:
                        both = place + other
                        products[both] = products.get(both, 0) + (part.T @ more).astype(np.int64)
        upper = np.triu_indices(size)
        out = [(0, -1, -1, count)] if count else []
        out += [(place, -1, i, int(v)) for place, total in sums.items() for i, v in enumerate(total)]
        for place, total in products.items():
            out += [(place, int(i), int(j), int(v)) for i, j, v in zip(*upper, total[upper], strict=True)]
        names = ["place", "i", "j", "total"]
        yield pa.RecordBatch.from_arrays(
            [pa.array([row[k] for row in out], pa.int64() if k == 3 else pa.int32()) for k in range(4)], names
        )

    found = fit.select("y").mapInArrow(run, "place int, i int, j int, total bigint")
    # At most size * (size + 3) / 2 + 1 rows for each of at most 8 places.
    rows = found.groupBy("place", "i", "j").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    n, sums, products = 0, [0] * size, [[0] * size for _ in range(size)]
    for place, i, j, total in rows:
        value = int(total) << place
        if j < 0:
            n = value
        elif i < 0:
            sums[j] += value
        else:
            products[i][j] += value
            if i != j:
                products[j][i] += value
    return n, sums, products


def primes(count: int) -> list[int]:
    """The largest primes below 2^31, falling."""
    out, number = [], (1 << 31) - 1
    while len(out) < count:
        if _prime(number):
            out.append(number)
        number -= 2
    return out


def _prime(number: int) -> bool:
    """Strong probable prime to 2, 3, 5 and 7, which is proof below 3 * 10^9."""
    odd, twos = number - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, number)
        if x not in (1, number - 1) and not any((x := x * x % number) == number - 1 for _ in range(twos - 1)):
            return False
    return True


def polynomial_modulo(matrix: list[list[int]], p: int) -> list[int]:
    """Coefficients of det(t I - matrix) modulo a prime, the constant first, by reduction to Hessenberg form."""
    size = len(matrix)
    h = np.array([[value % p for value in row] for row in matrix], np.int64)
    for k in range(size - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        pivot = k + 1 + int(below[0])
        if pivot != k + 1:
            h[[k + 1, pivot]] = h[[pivot, k + 1]]
            h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        factors = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - factors[:, None] * h[k + 1] % p) % p
        # The inverse change of columns keeps the matrix similar: column k+1 gains the columns below.
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * factors % p).sum(1)) % p
    found = [np.zeros(size + 1, np.int64) for _ in range(size + 1)]
    found[0][0] = 1
    for m in range(1, size + 1):
        # p_m = (t - h_mm) p_(m-1) - sum over i of h_im times the subdiagonal between, times p_(i-1)
        now = np.roll(found[m - 1], 1)
        now = (now - h[m - 1, m - 1] * found[m - 1] % p) % p
        between = 1
        for i in range(m - 1, 0, -1):
            between = between * int(h[i, i - 1]) % p
            if not between:
                break
            now = (now - int(h[i - 1, m - 1]) * between % p * found[i - 1] % p) % p
        found[m] = now
    return found[size].tolist()


def characteristic(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Whole coefficients of det(t I - matrix), the constant first; the matrix has no negative eigenvalue."""
    size = len(matrix)
    trace = sum(matrix[i][i] for i in range(size))
    # The coefficient of t^(size-k) is at most comb(size, k) * (trace / size)^k.
    bits = max((comb(size, k) * (trace**k // size**k + 1)).bit_length() for k in range(size + 1)) + 2
    moduli = primes(-(-bits // 30))

    def run(batches):
        for batch in batches:
            for at in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at]), pa.array([polynomial_modulo(matrix, moduli[at])], pa.list_(pa.int64()))], ["at", "found"]
                )

    tasks = spark.range(0, len(moduli), 1, -(-len(moduli) // PRIMES))
    rows = sorted(tasks.mapInArrow(run, "at bigint, found array<bigint>").collect())
    out, product = [0] * (size + 1), 1
    for at, found in rows:
        p = moduli[at]
        inverse = pow(product, -1, p)
        out = [value + product * ((rest - value) * inverse % p) for value, rest in zip(out, found, strict=True)]
        product *= p
    return [value - product if 2 * value > product else value for value in out]


class Roots:
    """Roots of a polynomial whose roots are all real, by exact counts and exact Newton steps."""

    def __init__(self, coefficients: list[int]):
        self.zeros = next(i for i, value in enumerate(coefficients) if value)
        self.coefficients = coefficients[self.zeros :]
        self.counts: dict[tuple[int, int], int] = {}

    def above(self, number: int, places: int) -> int:
        """Roots above number / 2^places, each as often as it repeats."""
        while places and number % 2 == 0:
            number, places = number // 2, places - 1
        key = number, places
        if key not in self.counts:
            degree = len(self.coefficients) - 1
            moved = [value << places * (degree - k) for k, value in enumerate(self.coefficients)]
            # Horner's scheme over and over: the coefficients around `number`.
            for start in range(degree):
                for k in range(degree - 1, start - 1, -1):
                    moved[k] += number * moved[k + 1]
            signs = [value > 0 for value in moved if value]
            self.counts[key] = sum(a != b for a, b in zip(signs, signs[1:]))
        return self.counts[key]

    def value(self, number: int, places: int) -> tuple[int, int]:
        """The polynomial and its derivative at number / 2^places, times 2^(places * degree) and so on."""
        value, slope = 0, 0
        for k, coefficient in enumerate(reversed(self.coefficients)):
            slope = slope * number + value
            value = value * number + (coefficient << places * k)
        return value, slope

    def largest(self, count: int) -> list[tuple[int, int]]:
        """(root * 2^FINE, how often) of the largest positive roots until `count` are reached."""
        positive, out, done = self.above(0, 0), [], 0
        # All roots are below their sum.
        high, places = 1 << sum(map(abs, self.coefficients[-2:])).bit_length(), 0
        while done < min(count, positive):
            low = 0
            # Always above(low) > done = above(high), until one root or one cluster is between.
            while (many := self.above(low, places) - done) > 1 and (high - low > 1 or places < FINE):
                if high - low <= 1:
                    low, high, places = 2 * low, 2 * high, places + 1
                middle = (low + high) // 2
                if self.above(middle, places) > done:
                    low = middle
                else:
                    high = middle
            root = self.refined(low, high, places) if many == 1 else (low + high) << FINE - places >> 1
            out.append((root, many))
            done, high = done + many, low
        return out

    def refined(self, low: int, high: int, places: int) -> int:
        """The one root in (low, high] / 2^places, times 2^FINE, to about its last place."""
        low, high = low << FINE - places, high << FINE - places
        rising = self.value(high, FINE)[0] >= 0
        at = high
        if self.value(high, FINE)[0] == 0:
            return high
        while high - low > 1:
            value, slope = self.value(at, FINE)
            if value == 0:
                return at
            low, high = (low, at) if (value > 0) == rising else (at, high)
            move = value // slope if slope else high - low
            if abs(move) <= 1:
                return at - move
            # A Newton step that leaves the interval becomes a halving: both keep the root inside.
            at = at - move if low < at - move < high else (low + high) // 2
        return high


def null_space(matrix: list[list[int]], root: int, many: int) -> list[list[float]]:
    """Orthonormal vectors that `matrix - root / 2^FINE` sends to about zero, by inverse iteration."""
    size = len(matrix)
    with decimal.localcontext() as context:
        context.prec = DIGITS
        exact = decimal.Decimal(root) / (1 << FINE)
        lower = np.array([[decimal.Decimal(v) for v in row] for row in matrix], object)
        for i in range(size):
            lower[i, i] -= exact
        tiny = max(abs(exact), decimal.Decimal(1)).scaleb(-(DIGITS - 10))
        order = list(range(size))
        for k in range(size):
            pivot = max(range(k, size), key=lambda i: abs(lower[i, k]))
            if pivot != k:
                lower[[k, pivot]] = lower[[pivot, k]]
                order[k], order[pivot] = order[pivot], order[k]
            if abs(lower[k, k]) < tiny:
                lower[k, k] = tiny
            if k + 1 < size:
                lower[k + 1 :, k] /= lower[k, k]
                lower[k + 1 :, k + 1 :] -= lower[k + 1 :, k][:, None] * lower[k, k + 1 :][None]
        rng = np.random.default_rng(1)
        basis = [np.array([decimal.Decimal(int(v)) for v in rng.integers(1, 1000, size)], object) for _ in range(many)]
        for _ in range(STEPS):
            for b in range(many):
                x = basis[b][order]
                for k in range(1, size):
                    x[k] -= (lower[k, :k] * x[:k]).sum()
                for k in range(size - 1, -1, -1):
                    x[k] = (x[k] - (lower[k, k + 1 :] * x[k + 1 :]).sum()) / lower[k, k]
                for other in basis[:b]:
                    x = x - other * (other * x).sum()
                basis[b] = x / (x * x).sum().sqrt()
            for _ in range(2):  # again, for digits lost to cancellation
                for b in range(many):
                    for other in basis[:b]:
                        basis[b] = basis[b] - other * (other * basis[b]).sum()
                    basis[b] = basis[b] / (basis[b] * basis[b]).sum().sqrt()
        return [list(map(float, row)) for row in basis]


@dataclass
class Whitening:
    """What turns vectors into whitened ones."""

    n: int
    sums: list[int]  # without the offset, which cancels
    weights: np.ndarray  # component x dimension, divided by the root of the eigenvalue
    explained: np.ndarray

    def centred(self, rows: np.ndarray) -> np.ndarray:
        """n * x - S, in 64-bit numbers where they are wide enough, else in Python's."""
        widest = max(map(abs, self.sums), default=0) + self.n * int(np.abs(rows).max(initial=0))
        if widest >= 1 << 62:
            return rows.astype(object) * self.n - np.array(self.sums, object)
        return rows * self.n - np.array(self.sums, np.int64)

    def apply(self, rows: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
        """Whitened values of each row, and the exact squared deviation of n * x from S."""
        centred = self.centred(rows)
        widest = int(np.abs(centred).max(initial=0))
        wide = centred.astype(object) if widest**2 * max(1, rows.shape[1]) >= 1 << 63 else centred
        deviation = [int(v) if v < 1 << 63 else None for v in (wide * wide).sum(1)]
        return (centred / self.n).astype(np.float64) @ self.weights.T, deviation


def fitted(fit: DataFrame, size: int, components: int = COMPONENTS) -> Whitening | None:
    """The components of the largest eigenvalues of the fit list's covariance; None where none is above 0."""
    spark = fit.sparkSession
    n, sums, products = moments(fit, size)
    matrix = [[n * products[i][j] - sums[i] * sums[j] for j in range(size)] for i in range(size)]
    trace = sum(matrix[i][i] for i in range(size))
    if not trace:
        return None
    found = Roots(characteristic(spark, matrix)).largest(components)

    def run(batches):
        for batch in batches:
            for at in batch.column(0).to_pylist():
                vectors = null_space(matrix, *found[at])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at] * len(vectors)), pa.array(vectors, pa.list_(pa.float64()))], ["at", "vector"]
                )

    rows = spark.range(0, len(found), 1, len(found)).mapInArrow(run, "at bigint, vector array<double>").collect()
    rows = sorted(rows, key=lambda row: row["at"])[:components]
    # Shares and scales from the exact roots; the eigenvalue of the covariance is root / n^2.
    values = [decimal.Decimal(found[row["at"]][0]) / (1 << FINE) for row in rows]
    scale = np.array([float((value / n / n).sqrt()) for value in values])
    explained = np.array([float(value / trace) for value in values])
    return Whitening(n, sums, np.array([row["vector"] for row in rows]) / scale[:, None], explained)


def identity_error(fit: DataFrame, size: int, whitening: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity: means first, then products."""
    count = len(whitening.weights)

    def totals(centre: np.ndarray | None) -> np.ndarray:
        def run(batches):
            total, shape = 0, count if centre is None else count * count
            for batch in batches:
                rows = _matrix(batch, "y", size)
                for at in range(0, len(rows), BLOCK):
                    values = whitening.apply(rows[at : at + BLOCK])[0]
                    total = total + (values.sum(0) if centre is None else ((values - centre).T @ (values - centre)).reshape(-1))
            some = not isinstance(total, int)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(shape) if some else [], pa.int32()), pa.array(total if some else [], pa.float64())], ["at", "total"]
            )

        rows = fit.select("y").mapInArrow(run, "at int, total double").groupBy("at").agg(F.sum("total")).collect()
        return np.array([total for _, total in sorted(rows)]) / whitening.n

    means = totals(None)
    return float(np.abs(totals(means).reshape(count, count) - np.eye(count)).max())


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of each usable vector and component."""
    schema = (
        "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    )
    rows, size = of_one_length(usable(vectors))
    whitening = None
    if size:
        fit = stored(rows.select("y").dropDuplicates(["y"]))
        whitening = fitted(fit, size, components)
    if whitening is None:
        return vectors.sparkSession.createDataFrame([], schema)
    error = identity_error(fit, size, whitening)
    count = len(whitening.weights)

    def run(batches):
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            values, deviation = whitening.apply(_matrix(batch, "y", size))
            each = np.repeat(np.arange(batch.num_rows), count)
            total = len(each)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), batch.num_rows)),
                    pa.array(np.full(total, whitening.n)),
                    pa.array(deviation, pa.int64()).take(pa.array(each)),
                    pa.array(values.reshape(-1)),
                    pa.array(np.tile(whitening.explained, batch.num_rows)),
                    pa.array(np.full(total, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), "y").mapInArrow(run, schema)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
