"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The centred matrix A of the distinct vectors stays distributed. Each step multiplies it with a vector and its
transpose with the result, in one pass. The left vectors are as long as the table and are never stored: each is
A times a short vector that the driver keeps, so a pass computes those of its rows anew. Each left and right
vector is made orthogonal to all before it. The small bidiagonal matrix's singular values and vectors give the
components and their deviations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.llm.common import stage

#: Residual at which a component counts as found, relative to the largest singular value.
TOLERANCE = 1e-13
#: Variance below this share of all is rounding, not a component.
NO_VARIANCE = 1e-12
#: Residual, relative to its value, at which the largest value beside the found ones is known well enough to be
#: no component, and the least number of steps for that.
PROBE, PROBE_STEPS = 1e-2, 8
#: Partial sums of a pass that come to the driver; tasks add up more than that.
_ADDERS = 16


def scaled(vector: Column) -> Column:
    """``floor(256 * c)`` of each entry as longs; null if the vector or an entry is null or not finite."""
    wide = F.transform(vector, lambda c: c.cast("double"))
    finite = F.forall(wide, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when(finite & (F.size(vector) > 0), F.transform(wide, lambda c: F.floor(256 * c).cast("bigint")))


def _matrix(batch: pa.RecordBatch, column: str = "x") -> np.ndarray:
    rows = batch.column(column)
    return rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)


def _total(table: DataFrame, width: int, of_rows: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of ``of_rows``, which maps a block of rows to ``width`` sums."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                total += of_rows(_matrix(batch))
        yield pa.RecordBatch.from_pydict({"part": pa.array([total])})

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_matrix(batch, "part") for batch in batches if batch.num_rows]
        if parts:
            yield pa.RecordBatch.from_pydict({"part": pa.array([np.concatenate(parts).sum(0)])})

    schema = "part ARRAY<DOUBLE>"
    parts = table.mapInArrow(partial, schema)
    if table.rdd.getNumPartitions() > _ADDERS:
        parts = parts.repartition(_ADDERS).mapInArrow(added, schema)
    rows = parts.collect()
    return np.sum([r.part for r in rows], axis=0) if rows else np.zeros(width)


class _Bidiagonal:
    """One run of the bidiagonalisation, orthogonal to the right vectors ``locked`` with their values."""

    def __init__(self, table: DataFrame, mean: np.ndarray, locked: np.ndarray, values: np.ndarray, seed: int) -> None:
        self.table, self.mean, self.d = table, mean, len(mean)
        self.random = np.random.default_rng(seed)
        self.locked = locked
        # Right vectors, short forms of the left vectors, and the transpose's products with the left vectors.
        self.right: list[np.ndarray] = []
        self.short = [locked[:, i] / values[i] for i in range(locked.shape[1])]
        self.back = [locked[:, i] * values[i] for i in range(locked.shape[1])]
        self.alpha: list[float] = []
        self.beta: list[float] = []

    def _orthogonal(self, v: np.ndarray) -> np.ndarray:
        basis = np.column_stack([self.locked, *self.right]) if self.right else self.locked
        for _ in range(2):
            v = v - basis @ (basis.T @ v)
        return v

    def _products(self, short: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
        """With w = A short: the left vectors' products with w, w's squared length, and the transpose times w."""
        mean, d, k = self.mean, self.d, len(self.short)
        both = np.column_stack([short, *self.short])

        def of_rows(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            left = centred @ both
            w = left[:, 0]
            return np.concatenate([left[:, 1:].T @ w, [w @ w], centred.T @ w])

        found = _total(self.table, k + 1 + d, of_rows)
        return found[:k], float(found[k]), found[k + 1 :]

    def step(self, scale: float) -> None:
        """One more right and left vector. ``scale``: the largest singular value known."""
        if self.right and self.beta[-1] > 0:
            v = self.next
            short = v - self.beta[-1] * self.short[-1]
        else:
            v = self._orthogonal(self.random.standard_normal(self.d))
            v = self._orthogonal(v / np.linalg.norm(v))
            short = v = v / np.linalg.norm(v)
        self.right.append(v)
        for _ in range(3):
            onto, square, back = self._products(short)
            if not self.short:
                break
            short = short - np.column_stack(self.short) @ onto
            if np.linalg.norm(onto) <= 1e-9 * np.sqrt(square):
                # So small a correction is exact without another pass.
                square = max(square - float(onto @ onto), 0.0)
                back = back - np.column_stack(self.back) @ onto
                break
        alpha = float(np.sqrt(square))
        if alpha <= TOLERANCE * max(scale, alpha) or alpha == 0:
            alpha, self_short, self_back = 0.0, np.zeros(self.d), np.zeros(self.d)
        else:
            self_short, self_back = short / alpha, back / alpha
        self.alpha.append(alpha)
        self.short.append(self_short)
        self.back.append(self_back)
        rest = self._orthogonal(self_back - alpha * v)
        beta = float(np.linalg.norm(rest))
        if len(self.right) + self.locked.shape[1] >= self.d or beta <= TOLERANCE * max(scale, alpha):
            beta = 0.0
        self.beta.append(beta)
        self.next = rest / beta if beta else None

    def ritz(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Singular values, falling; their right vectors; and the residuals."""
        left, values, right = np.linalg.svd(np.diag(self.alpha) + np.diag(self.beta[:-1], 1))
        return values, np.column_stack(self.right) @ right.T, self.beta[-1] * np.abs(left[-1])

    def whole(self) -> bool:
        return len(self.right) + self.locked.shape[1] >= self.d


def principal(table: DataFrame, mean: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``top`` largest singular values of the centred rows ``x`` of ``table``, and their right vectors.

    A run ends when these have converged, or when all of the space is spanned. From one start vector it finds
    one vector for each distinct value, so a further run beside the found ones looks for larger values left out;
    it ends as soon as its largest value is known to be none.
    """
    d = len(mean)
    top = min(top, d)
    vectors, values = np.zeros((d, 0)), np.zeros(0)
    for seed in range(d + 1):
        run = _Bidiagonal(table, mean, vectors, values, seed)
        least = values[top - 1] if len(values) >= top else 0.0
        wanted = top
        while True:
            scale = max([*values[:1], *(run.ritz()[0][:1] if run.right else [])], default=0.0)
            run.step(scale)
            found, right, rest = run.ritz()
            scale = max(scale, found[0])
            ended = run.whole() or scale == 0
            if ended or run.beta[-1] == 0 and not least:
                if ended:
                    break
                continue
            if least:
                if len(found) >= PROBE_STEPS and rest[0] <= PROBE * found[0] and found[0] + rest[0] <= least * (1 + 1e-9):
                    return values[:top], vectors[:, :top]
                wanted = max(1, int((found > least).sum()))
            if len(found) > wanted and (rest[:wanted] <= TOLERANCE * scale).all():
                break
        keep = min(top, len(found))
        good = found[:keep] > np.sqrt(NO_VARIANCE) * scale if scale else np.zeros(keep, dtype=bool)
        if least:
            good &= (found[:keep] > least * (1 + 1e-9)) & (rest[:keep] <= 1e-6 * scale)
        more = np.column_stack([vectors, right[:, :keep][:, good]])
        order = np.argsort(-np.concatenate([values, found[:keep][good]]), kind="stable")
        changed = good.any()
        values, vectors = np.concatenate([values, found[:keep][good]])[order], more[:, order]
        if run.whole() or scale == 0 or not changed:
            break
    return values[:top], vectors[:, :top]


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", top: int = 4) -> DataFrame:
    """One row for each vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Fitted on the distinct vectors of ``floor(256 * c)``. Vectors that are null or empty or hold null or
    non-finite entries are left out, and so are those not of the commonest length (of two, the larger).
    Repeated vectors count once in the fit and are each returned; a null key is kept. Components are numbered
    by falling variance and are as many as have any, ``top`` at most: equal vectors give no row, nor does an
    empty table. Components of equal variance are some orthogonal ones of their space. ``deviation`` is exact,
    null where it exceeds a long. Other columns are not read.
    """
    spark, kind = vectors.sparkSession, vectors.schema[key].dataType.simpleString()
    rows = vectors.select(F.col(key).alias("vec_id"), scaled(F.col(vector)).alias("x")).filter("x IS NOT NULL")
    schema = f"vec_id {kind}, component INT, n BIGINT, deviation BIGINT, whitened DOUBLE, explained DOUBLE, identity_error DOUBLE"
    length = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if length is None:
        return spark.createDataFrame([], schema)
    d = length.d
    rows = rows.filter(F.size("x") == d)
    table = stage(rows.select("x").distinct(), "distinct-vectors")
    exact = F.sum(F.col("v").cast("decimal(38,0)")).alias("s")
    sums = table.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(exact, F.count("*").alias("n")).collect()
    n, sums = sums[0].n, [int(r.s) for r in sorted(sums)]
    mean = np.array([float(Fraction(s, n)) for s in sums])
    trace = float(_total(table, 1, lambda x: np.array([((x - mean) ** 2).sum()]))[0]) / n
    if not trace > 0:
        return spark.createDataFrame([], schema)
    values, right = principal(table, mean, top)
    e = values**2 / n
    real = e > NO_VARIANCE * trace
    e, right = e[real], right[:, real]
    m = len(e)
    onto = right / np.sqrt(e)
    off = _total(table, m, lambda x: ((x - mean) @ onto).sum(0)) / n

    def squares(x: np.ndarray) -> np.ndarray:
        w = (x - mean) @ onto - off
        return (w.T @ w).ravel()

    error = float(np.abs(_total(table, m * m, squares).reshape(m, m) / n - np.eye(m)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch)
            largest = n * int(max(x.max(), -x.min(), 0)) + max(map(abs, sums))
            fits = d * largest**2 < 1 << 63
            apart = n * (x if fits else x.astype(object)) - np.array(sums, dtype=np.int64 if fits else object)
            deviation = [int(v) if v < 1 << 63 else None for v in (apart * apart).sum(1)]
            w = (x - mean) @ onto
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(deviation, pa.int64()), pa.array(list(w), pa.list_(pa.float64()))], ["vec_id", "deviation", "w"]
            )

    projected = rows.mapInArrow(project, f"vec_id {kind}, deviation BIGINT, w ARRAY<DOUBLE>")
    shares = F.array(*[F.lit(float(v / trace)) for v in e])
    return projected.select("vec_id", "deviation", F.posexplode("w").alias("i", "whitened")).select(
        "vec_id",
        (F.col("i") + 1).alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        shares[F.col("i")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )
