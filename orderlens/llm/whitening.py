"""Whitening of vectors by spectrum slicing.

The covariance of whole-number vectors is exact: two passes over the rows add up whole numbers, first each
dimension's sum, then the products of what is left after subtracting the rounded mean; the remainder of that
mean, below one half, is taken off exactly as well. So no order of summation and no lost task changes a bit of it.

Its leading eigenvalues are found by counts: the number of positive pivots in an LDL' factorisation of the
covariance minus a shift is the number of eigenvalues above the shift. Bisection by such counts isolates every
leading eigenvalue in an interval of its own; Rayleigh quotient iteration from there converges cubically; counts
just above and just below the result certify its number. Eigenvalues that no shift can tell apart in double
precision are a cluster, whose vectors come from one subspace iteration; any basis of theirs is one.

Only sums per pair of dimensions, and the factors, pass through the driver: their size is set by the dimension.

Defined results: rows whose vector is null or holds null or non-finite entries are dropped, as are empty ones,
which have no component. Vectors of different lengths are whitened apart, each length over its own rows. Entries
beyond a long after scaling are the nearest long. A component without variance has null ``whitened``;
``explained`` is null if nothing varies; ``deviation`` is null beyond a long. A constant added to all entries
changes no result. Repeated rows count each and null ids stay; extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.vectors import lists, usable
from orderlens.session import pin


@dataclass(frozen=True)
class WhiteningParams:
    components: int = 32
    scale: int = 64
    seed: int = 11


# ---- eigenpairs of a symmetric matrix

class Factored:
    """LDL' of a symmetric matrix, rows and columns swapped by Bunch and Kaufman's rule."""

    ALPHA = (1 + 17 ** 0.5) / 8

    def __init__(self, matrix: np.ndarray):
        a, n = matrix.copy(), len(matrix)
        self.order = np.arange(n)
        self.blocks: list[tuple[int, np.ndarray]] = []
        self.lower = np.eye(n)
        tiny = np.finfo(float).tiny
        k = 0
        while k < n:
            size, swap = self._pivot(a, k)
            at = k + size - 1
            if swap != at:
                for m in (a, a.T):
                    m[[at, swap]] = m[[swap, at]]
                self.lower[[at, swap], :k] = self.lower[[swap, at], :k]
                self.order[[at, swap]] = self.order[[swap, at]]
            pivot = a[k: k + size, k: k + size].copy()
            if size == 1 and abs(pivot[0, 0]) < tiny:
                # The rest of the column is nil as well.
                pivot[0, 0] = 0.0
            else:
                below = a[k + size:, k: k + size]
                ratio = below / pivot[0, 0] if size == 1 else np.linalg.solve(pivot, below.T).T
                self.lower[k + size:, k: k + size] = ratio
                a[k + size:, k + size:] -= ratio @ below.T
            self.blocks.append((k, pivot))
            k += size

    def _pivot(self, a: np.ndarray, k: int) -> tuple[int, int]:
        """Size of the next pivot and the row that is swapped to its end."""
        column = np.abs(a[k + 1:, k])
        if not len(column) or (largest := column.max()) == 0 or abs(a[k, k]) >= self.ALPHA * largest:
            return 1, k
        r = k + 1 + int(column.argmax())
        row = np.abs(a[r, k:]).copy()
        row[r - k] = 0
        if abs(a[k, k]) * row.max() >= self.ALPHA * largest * largest:
            return 1, k
        return (1, r) if abs(a[r, r]) >= self.ALPHA * row.max() else (2, r)

    def positive(self) -> int:
        """Positive eigenvalues, as many as positive pivots (Sylvester's law)."""
        return sum(int((np.linalg.eigvalsh(b) > 0).sum()) if len(b) > 1 else int(b[0, 0] > 0) for _, b in self.blocks)

    def solve(self, right: np.ndarray, floor: float) -> np.ndarray:
        """Solution of the factored system; pivots below ``floor`` are moved up to it."""
        x = right[self.order].astype(float)
        n = len(x)
        for k, b in self.blocks:
            x[k + len(b):] -= self.lower[k + len(b):, k: k + len(b)] @ x[k: k + len(b)]
        for k, b in self.blocks:
            values, vectors = np.linalg.eigh(b) if len(b) > 1 else (b[0], np.eye(1))
            values = np.where(np.abs(values) < floor, np.where(values < 0, -floor, floor), values)
            part = vectors.T @ x[k: k + len(b)]
            x[k: k + len(b)] = vectors @ (part / values.reshape(-1, *[1] * (x.ndim - 1)))
        for k, b in reversed(self.blocks):
            if k + len(b) < n:
                x[k: k + len(b)] -= self.lower[k + len(b):, k: k + len(b)].T @ x[k + len(b):]
        out = np.empty_like(x)
        out[self.order] = x
        return out


@dataclass
class Slicer:
    """Leading eigenpairs of ``matrix`` by inertia counts and Rayleigh quotient iteration."""

    matrix: np.ndarray
    seed: int = 0

    def __post_init__(self):
        self.size = float(np.abs(self.matrix).sum(axis=1).max(initial=0))
        #: Below this no two shifts are told apart.
        self.grain = max(8 * np.finfo(float).eps * self.size, 1e-290)
        self.counts: dict[float, int] = {}

    def above(self, shift: float) -> int:
        """Eigenvalues greater than ``shift``."""
        if shift not in self.counts:
            self.counts[shift] = Factored(self.matrix - shift * np.eye(len(self.matrix))).positive()
        return self.counts[shift]

    def intervals(self, wanted: int) -> list[tuple[float, float, int]]:
        """(low, high, number) of disjoint intervals from the top that hold the leading eigenvalues.

        Each holds one, or a cluster and is no wider than the grain.
        """
        edge = self.size + self.grain
        todo, found, have = [(-edge, edge, 0, len(self.matrix))], [], 0
        while todo and have < wanted:
            low, high, over_high, over_low = todo.pop()
            number = over_low - over_high
            middle = (low + high) / 2
            if number == 1 or high - low <= self.grain or not low < middle < high:
                found.append((low, high, number))
                have += number
                continue
            over = min(max(self.above(middle), over_high), over_low)
            # The upper half comes off the stack first.
            todo += [(a, b, x, y) for a, b, x, y in ((low, middle, over, over_low), (middle, high, over_high, over)) if y > x]
        return found

    def _shrunk(self, low: float, high: float, over: int) -> tuple[float, float]:
        middle = (low + high) / 2
        return (middle, high) if self.above(middle) > over else (low, middle)

    def _orthonormal(self, block: np.ndarray, known: np.ndarray) -> np.ndarray:
        """``block`` made orthonormal and orthogonal to the vectors already found."""
        for _ in range(2):
            block = block - known @ (known.T @ block)
            block = np.linalg.qr(block)[0]
        return block

    def single(self, low: float, high: float, over: int, known: np.ndarray) -> tuple[float, np.ndarray]:
        """The eigenpair of an interval that holds one eigenvalue."""
        random = np.random.default_rng([self.seed, over])
        one = np.eye(len(self.matrix))
        start = random.standard_normal((len(self.matrix), 1))
        while True:
            vector = self._orthonormal(start, known)
            shift, best = (low + high) / 2, np.inf
            for _ in range(40):
                vector = self._orthonormal(Factored(self.matrix - shift * one).solve(vector, self.grain / 8), known)
                image = self.matrix @ vector
                value = float((vector * image).sum())
                missed = float(np.linalg.norm(image - value * vector))
                if not low - self.grain <= value <= high + self.grain:
                    break
                if missed <= self.grain and missed >= best / 2:
                    if self.certified(value, value, over, 1):
                        return value, vector
                    break
                best = min(best, missed)
                # The interval's middle until the quotient is close to an eigenvalue, then the quotient.
                shift = value if missed < (high - low) / 4 or missed <= self.grain else (low + high) / 2
            if high - low <= self.grain:
                return (low + high) / 2, vector
            low, high = self._shrunk(low, high, over)

    def certified(self, top: float, bottom: float, over: int, number: int) -> bool:
        """Whether the eigenvalues after the first ``over`` lie from ``bottom`` to ``top``, by counts around these."""
        margin = 4 * len(self.matrix) ** 0.5 * self.grain
        return self.above(top + margin) <= over and self.above(bottom - margin) >= over + number

    def cluster(self, low: float, high: float, number: int, over: int, known: np.ndarray) -> list[tuple[float, np.ndarray]]:
        """Eigenpairs of an interval whose eigenvalues are one in double precision."""
        random = np.random.default_rng([self.seed, over])
        factored = Factored(self.matrix - (low + high) / 2 * np.eye(len(self.matrix)))
        block = self._orthonormal(random.standard_normal((len(self.matrix), number)), known)
        for _ in range(4):
            block = self._orthonormal(factored.solve(block, self.grain / 8), known)
        inner = block.T @ self.matrix @ block
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        return [(float(v), block @ turn[:, [i]]) for i, v in reversed(list(enumerate(values)))]

    def leading(self, wanted: int) -> tuple[np.ndarray, np.ndarray]:
        """Eigenvalues in falling order and their unit vectors, as columns; each number is certified."""
        wanted = min(wanted, len(self.matrix))
        values, known, over = [], np.zeros((len(self.matrix), 0)), 0
        for low, high, number in self.intervals(wanted):
            pairs = [self.single(low, high, over, known)] if number == 1 else self.cluster(low, high, number, over, known)
            if not self.certified(max(v for v, _ in pairs), min(v for v, _ in pairs), over, number):
                raise ArithmeticError(f"eigenvalues {over + 1} to {over + number} are not where they were counted")
            values += [v for v, _ in pairs]
            known = np.concatenate([known, *[v for _, v in pairs]], axis=1)
            over += number
        return np.array(values[:wanted]), known[:, :wanted]


# ---- exact sums over the rows

LONG = (-(1 << 63), (1 << 63) - 1)
LOW_BITS = 60


def integers(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, dims)


def exact_products(rows: np.ndarray) -> np.ndarray:
    """rows' rows in whole numbers, as Python's where doubles or longs would not do."""
    most = int(np.abs(rows.astype(np.float64)).max(initial=0))
    if most * most * max(1, len(rows)) < 1 << 53:
        wide = rows.astype(np.float64)
        return (wide.T @ wide).astype(np.int64).astype(object)
    return rows.astype(object).T @ rows.astype(object)


def _by_length(batches: Iterator[pa.RecordBatch], at_once: int = 4_096) -> Iterator[tuple[int, np.ndarray]]:
    """(length, matrix of longs) of stretches of the batches."""
    for batch in batches:
        for start in range(0, len(batch), at_once):
            column = batch.column("numbers").slice(start, at_once)
            lengths = np.diff(column.offsets.to_numpy())
            for dims in np.unique(lengths):
                yield int(dims), integers(column.filter(pa.array(lengths == dims)), int(dims))


def _sums(numbers: DataFrame) -> dict[int, tuple[int, np.ndarray]]:
    """Rows and exact sums per dimension, for each length."""
    def run(batches):
        totals: dict[int, tuple[int, np.ndarray]] = {}
        for dims, rows in _by_length(batches):
            n, sums = totals.get(dims, (0, np.zeros(dims, object)))
            totals[dims] = (n + len(rows), sums + rows.astype(object).sum(axis=0))
        for dims, (n, sums) in totals.items():
            yield pa.RecordBatch.from_pydict({
                "dims": pa.array([dims] * dims, pa.int32()), "i": pa.array(range(dims), pa.int32()),
                "n": pa.array([n] * dims, pa.int64()), "total": pa.array([int(s) for s in sums], pa.decimal128(38, 0))})

    parts = numbers.select("numbers").mapInArrow(run, "dims int, i int, n bigint, total decimal(38,0)")
    found: dict[int, tuple[int, np.ndarray]] = {}
    for r in parts.groupBy("dims", "i").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        found.setdefault(r["dims"], (r["n"], np.zeros(r["dims"], object)))[1][r["i"]] = int(r["total"])
    return found


def _products(numbers: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Exact sums of the products of centred entries, for each length."""
    shared = numbers.sparkSession.sparkContext.broadcast(centres)

    def run(batches):
        totals: dict[int, np.ndarray] = {}
        for dims, rows in _by_length(batches):
            centre = shared.value[dims]
            small = max(map(abs, centre)) < 1 << 62 and np.abs(rows.astype(np.float64)).max() < 2.0**62
            moved = rows - centre.astype(np.int64) if small else rows.astype(object) - centre
            part = exact_products(moved)
            totals[dims] = totals[dims] + part if dims in totals else part
        for dims, total in totals.items():
            for i in range(dims):
                # High and low bits apart: each fits a decimal, however large the products.
                line = [int(x) for x in total[i, i:]]
                yield pa.RecordBatch.from_pydict({
                    "dims": pa.array([dims] * len(line), pa.int32()), "i": pa.array([i] * len(line), pa.int32()),
                    "j": pa.array(range(i, dims), pa.int32()),
                    "high": pa.array([x >> LOW_BITS for x in line], pa.decimal128(38, 0)),
                    "low": pa.array([x & ((1 << LOW_BITS) - 1) for x in line], pa.decimal128(38, 0))})

    parts = numbers.select("numbers").mapInArrow(run, "dims int, i int, j int, high decimal(38,0), low decimal(38,0)")
    found: dict[int, np.ndarray] = {}
    for r in parts.groupBy("dims", "i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect():
        total = (int(r["high"]) << LOW_BITS) + int(r["low"])
        whole = found.setdefault(r["dims"], np.zeros((r["dims"], r["dims"]), object))
        whole[r["i"], r["j"]] = whole[r["j"], r["i"]] = total
    return found


@dataclass
class Whitener:
    """Of one length: rows, sums, trace, eigenvalues and unit eigenvectors (columns)."""

    n: int
    sums: np.ndarray
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    @property
    def varies(self) -> np.ndarray:
        """Components with more variance than rounding makes."""
        return self.values > 64 * np.finfo(float).eps * max(self.trace, 0.0)

    def apart(self, rows: np.ndarray) -> np.ndarray:
        """n times each entry minus the sum, in whole numbers."""
        most = int(np.abs(rows.astype(np.float64)).max(initial=0)) * self.n + max(map(abs, self.sums))
        if most < 1 << 62:
            return self.n * rows - self.sums.astype(np.int64)
        return self.n * rows.astype(object) - self.sums

    def deviations(self, apart: np.ndarray) -> list[int | None]:
        most = max((abs(int(x)) for x in (apart.max(), apart.min())), default=0) if apart.size else 0
        exact = apart if most * most * apart.shape[1] < LONG[1] else apart.astype(object)
        return [int(d) if int(d) <= LONG[1] else None for d in (exact * exact).sum(axis=1)]

    def whiten(self, apart: np.ndarray) -> np.ndarray:
        """Rows of whitened components, NaN where nothing varies."""
        centred = (apart / self.n).astype(np.float64)
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.varies, centred @ self.vectors / np.sqrt(self.values), np.nan)


def covariance(n: int, sums: np.ndarray, centre: np.ndarray, products: np.ndarray) -> np.ndarray:
    """The exact covariance, rounded once."""
    rest = sums - n * centre
    exact = n * products - np.outer(rest, rest)
    return np.array([[x / (n * n) for x in line] for line in exact], np.float64)


def fit(numbers: DataFrame, params: WhiteningParams = WhiteningParams()) -> dict[int, Whitener]:
    """Whiteners by length, from ``numbers`` (an array of longs a row)."""
    sums = _sums(numbers)
    centres = {dims: np.array([(2 * int(s) + n) // (2 * n) for s in total], object) for dims, (n, total) in sums.items()}
    products = _products(numbers, centres) if sums else {}
    found = {}
    for dims, (n, total) in sums.items():
        matrix = covariance(n, total, centres[dims], products[dims])
        values, vectors = Slicer(matrix, params.seed).leading(params.components)
        found[dims] = Whitener(n, total, float(np.trace(matrix)), values, vectors)
    return found


def _identity_errors(rows: DataFrame, whiteners: dict[int, Whitener]) -> dict[int, float]:
    """How far the covariance of the stored whitened rows is from the identity, by length.

    Each task adds up its rows' products about its own mean; the parts are joined about the common mean.
    """
    counts = {dims: int(w.varies.sum()) for dims, w in whiteners.items()}

    def run(batches):
        # (rows, mean, products about it) by length
        parts: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}
        for batch in batches:
            dims_of = batch.column("dims").to_numpy()
            for dims in np.unique(dims_of):
                column = batch.column("whitened").filter(pa.array(dims_of == dims))
                width = len(column.flatten()) // len(column)
                made = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)[:, : counts[int(dims)]]
                mean = made.mean(axis=0)
                own = (made - mean).T @ (made - mean)
                if int(dims) in parts:
                    n, old, total = parts[int(dims)]
                    both, gap = n + len(made), mean - old
                    own = total + own + np.outer(gap, gap) * (n * len(made) / both)
                    parts[int(dims)] = (both, old + gap * (len(made) / both), own)
                else:
                    parts[int(dims)] = (len(made), mean, own)
        for dims, (n, mean, total) in parts.items():
            for i in range(len(mean)):
                yield pa.RecordBatch.from_pydict({
                    "dims": pa.array([dims], pa.int32()), "i": pa.array([i], pa.int32()), "n": pa.array([n], pa.int64()),
                    "mean": pa.array([mean.tolist()], pa.list_(pa.float64())),
                    "products": pa.array([total[i].tolist()], pa.list_(pa.float64()))})

    parts = pin(rows.select("dims", "whitened").mapInArrow(
        run, "dims int, i int, n bigint, mean array<double>, products array<double>"), "whitened-parts")
    means = parts.filter("i = 0").select("dims", "n", F.posexplode("mean").alias("j", "m")).groupBy("dims", "j").agg(
        (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("mean")).collect()
    mean = {dims: np.zeros(k) for dims, k in counts.items()}
    for r in means:
        mean[r["dims"]][r["j"]] = r["mean"]
    known = F.create_map(*[x for dims, m in mean.items() for x in (F.lit(dims), F.array(*[F.lit(float(v)) for v in m]))])
    centre = known[F.col("dims")]
    gap = F.element_at("mean", F.col("i") + 1) - F.element_at(centre, F.col("i") + 1)
    other = F.element_at("mean", F.col("j") + 1) - F.element_at(centre, F.col("j") + 1)
    joined = parts.select("dims", "i", "n", "mean", F.posexplode("products").alias("j", "p")).groupBy("dims", "i", "j").agg(
        (F.sum(F.col("p") + F.col("n") * gap * other) / F.sum("n")).alias("c"))
    off = F.abs(F.col("c") - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0))
    return {r["dims"]: r["off"] for r in joined.groupBy("dims").agg(F.max(off).alias("off")).collect()}


def whiten(
    table: DataFrame, params: WhiteningParams = WhiteningParams(), key: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """A row per vector: its id, n, deviation, ``whitened``, ``explained`` (arrays by component), identity_error."""
    numbers = pin(
        table.filter(usable(table[vector]) & (F.size(table[vector]) > 0)).select(
            table[key].alias("vec_id"),
            F.transform(table[vector], lambda x: F.floor(x.cast("double") * F.lit(float(params.scale)))).alias("numbers")),
        "numbers")
    whiteners = fit(numbers, params)
    shared = table.sparkSession.sparkContext.broadcast(whiteners)
    schema = T.StructType([
        numbers.schema["vec_id"], T.StructField("dims", T.IntegerType()), T.StructField("deviation", T.LongType()),
        T.StructField("whitened", T.ArrayType(T.DoubleType()))])

    def run(batches):
        for batch in batches:
            column = batch.column("numbers")
            lengths = np.diff(column.offsets.to_numpy())
            for dims in np.unique(lengths):
                own = pa.array(lengths == dims)
                known = shared.value[int(dims)]
                apart = known.apart(integers(column.filter(own), int(dims)))
                yield pa.RecordBatch.from_arrays([
                    batch.column("vec_id").filter(own), pa.array(np.full(len(apart), dims, np.int32)),
                    pa.array(known.deviations(apart), pa.int64()), lists(known.whiten(apart), np.float64)], schema.names)

    rows = pin(numbers.mapInArrow(run, schema), "whitened")
    errors = _identity_errors(rows, whiteners) if whiteners else {}

    def by_length(of, kind):
        if not whiteners:
            return F.lit(None).cast(kind)
        return F.create_map(*[x for dims in whiteners for x in (F.lit(dims), F.lit(of(dims)).cast(kind))])[F.col("dims")]

    explained = {
        dims: [float(v) / w.trace if w.trace > 0 else None for v in np.maximum(w.values, 0)] for dims, w in whiteners.items()}
    return rows.select(
        "vec_id", by_length(lambda d: whiteners[d].n, "bigint").alias("n"), "deviation",
        F.transform("whitened", lambda x: F.when(~F.isnan(x), x)).alias("whitened"),
        by_length(lambda d: explained[d], "array<double>").alias("explained"),
        by_length(lambda d: errors.get(d), "double").alias("identity_error"))
