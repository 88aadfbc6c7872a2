"""Operator 11, embedding whitening by a polarisation covariance.

Entries become integers, x = floor(64 * c) + 1000000, so that all sums are exact. For every dimension and every sum of two dimensions the
squares of the centred values are added up; as Var(a + b) = Var(a) + Var(b) + 2 Cov(a, b), differences of those variances give all
covariances, still as integers. They are divided once, and numpy's eigh gives the components.

Values are centred before they are squared: by the mean rounded to an integer, so that squares stay small, and the rest of the mean is
taken out of the sums exactly (sum (n*z - R)^2 = n^2 * sum z^2 - n * R^2, with z the centred values and R their sum).

Scale: three passes of partial sums and one that whitens. Vectors are never shuffled; a task sends d * (d + 1) / 2 rows of partial sums (d dimensions), which
Spark adds up per pair, so a vector that a third of all rows hold costs what any other does. The driver gets one row per pair: its number hangs on d only.
``identity_error`` is measured on the whitened rows, in a pass of its own.

Defined cases: a NULL vector, or one with a NULL, NaN or infinite entry, is left out, and so are vectors of another length than most have (ties: the longer
one). x stops at +-2^60. ``deviation`` is NULL where it does not fit in a long. A component without variance (eigenvalue zero to
double precision) has no scale: its whitened values are NULL, and ``identity_error`` is that of the others; without any it is NULL, like ``explained`` if nothing
varies at all. Repeated rows count as often as they occur. An empty table gives no rows. ``whiten`` keeps all columns and renames its own if they clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortsieve.llm.registry import query
from cohortsieve.llm.texts import free_name, table
from cohortsieve.llm.vectors import matrix, usable, usual_length

STEPS, SHIFT = 64, 1_000_000
COMPONENTS = 32
LIMIT = 1 << 60
#: Vectors computed with at once. Centred values below SMALL cannot overflow a long when so many squares of pair sums are added.
ROWS, SMALL = 4096, 1 << 24
LIMB = 40


def integers(vectors: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(vectors * STEPS), -LIMIT, LIMIT).astype(np.int64) + SHIFT


def limbs(value: int) -> list[int]:
    """A whole number as five limbs of LIMB bits; the last one carries the sign."""
    return [(value >> LIMB * i) & ((1 << LIMB) - 1) for i in range(4)] + [value >> LIMB * 4]


def _added(df: DataFrame, column: str, length: int, sums: Callable[[np.ndarray], dict[tuple[int, int], int]]) -> dict[tuple[int, int], int]:
    """What ``sums`` gives for slices of the vectors, by its keys, added up over the table."""
    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], int] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                for key, value in sums(integers(matrix(batch.column(0).slice(at, ROWS), length))).items():
                    total[key] = total.get(key, 0) + value
        if total:
            parts = np.array([limbs(v) for v in total.values()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[i] for k in total], pa.int32()) for i in range(2)] + [pa.array(parts[:, i]) for i in range(5)],
                ["i", "j", *(f"l{i}" for i in range(5))])

    partial = df.filter(usable(column, length)).select(column).mapInArrow(
        per_task, "i int, j int, " + ", ".join(f"l{i} long" for i in range(5)))
    rows = partial.groupBy("i", "j").agg(*[F.sum(f"l{i}").alias(f"l{i}") for i in range(5)]).collect()
    return {(r["i"], r["j"]): sum(r[f"l{k}"] << LIMB * k for k in range(5)) for r in rows}


def totals(x: np.ndarray) -> dict[tuple[int, int], int]:
    """The number of vectors at (-1, -1), the sum of dimension i at (i, i)."""
    exact = x if len(x) * (int(np.abs(x).max(initial=0)) + 1) < 1 << 62 else x.astype(object)
    return {(-1, -1): len(x)} | {(i, i): int(s) for i, s in enumerate(exact.sum(axis=0))}


def squares(x: np.ndarray, centre: np.ndarray) -> dict[tuple[int, int], int]:
    """Sums of squares: of the centred dimension i at (i, i), of the sum of dimensions i and j at (i, j)."""
    z = x - centre
    if len(z) and np.abs(z).max() >= SMALL:
        z = z.astype(object)
    found = {(i, i): int(s) for i, s in enumerate((z * z).sum(axis=0))}
    for i in range(z.shape[1] - 1):
        both = z[:, i + 1:] + z[:, i:i + 1]
        found |= {(i, i + 1 + j): int(s) for j, s in enumerate((both * both).sum(axis=0))}
    return found


@dataclass(frozen=True)
class Whitening:
    """What was fitted: n vectors, centre + rest / n is their mean, components in columns by falling eigenvalue."""

    n: int
    centre: np.ndarray
    rest: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def length(self) -> int:
        return len(self.centre)

    @property
    def scales(self) -> np.ndarray:
        """1 / sqrt(eigenvalue); NaN for components without variance."""
        null = max(self.values.max(initial=0.0), 0.0) * np.finfo(float).eps * max(self.length, 1)
        return np.array([1 / np.sqrt(e) if e > null else np.nan for e in self.values])

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, rounded once."""
        return (x - self.centre) - np.array([r / self.n for r in self.rest])

    def apply(self, x: np.ndarray, count: int) -> np.ndarray:
        return self.centred(x) @ self.vectors[:, :count] * self.scales[:count]

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """sum (n * x - S)^2 of each vector; None if it does not fit in a long."""
        z = x - self.centre
        rough = ((z * float(self.n) - np.array(self.rest, float)) ** 2).sum(axis=1)
        # Sums modulo 2^64 are the sums themselves where those fit.
        n, rest = np.uint64(self.n & (1 << 64) - 1), np.array([r & (1 << 64) - 1 for r in self.rest], np.uint64)
        y = z.astype(np.uint64) * n - rest
        wrapped = (y * y).sum(axis=1, dtype=np.uint64)
        out: list[int | None] = []
        for i, (near, value) in enumerate(zip(rough.tolist(), wrapped.tolist())):
            if 9e18 < near < 9.5e18:
                value = sum((self.n * v - r) ** 2 for v, r in zip(z[i].tolist(), self.rest))
                near = 0.0 if value < 1 << 63 else near
            out.append(value if near <= 9e18 else None)
        return out


def covariance(n: int, rest: list[int], sums: dict[tuple[int, int], int]) -> list[list[int]]:
    """n^3 times the covariances, from the sums of squares of dimensions and of sums of two."""
    d = len(rest)
    spread = lambda i, j, r: n * n * sums[i, j] - n * r * r
    own = [spread(i, i, rest[i]) for i in range(d)]
    out = [[0] * d for _ in range(d)]
    for i in range(d):
        out[i][i] = own[i]
        for j in range(i + 1, d):
            out[i][j] = out[j][i] = (spread(i, j, rest[i] + rest[j]) - own[i] - own[j]) // 2
    return out


def fit(df: DataFrame, column: str = "embedding") -> Whitening | None:
    """The whitening of all usable vectors; None without any."""
    length = usual_length(df, column)
    if not length:
        return None
    found = _added(df, column, length, totals)
    n, whole = found[-1, -1], [found[i, i] for i in range(length)]
    centre = np.array([(2 * s + n) // (2 * n) for s in whole], np.int64)
    rest = [s - n * int(c) for s, c in zip(whole, centre)]
    exact = covariance(n, rest, _added(df, column, length, lambda x: squares(x, centre)))
    v = np.array([[c / n ** 3 for c in row] for row in exact])
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values, kind="stable")
    return Whitening(n, centre, rest, values[order], vectors[:, order], sum(exact[i][i] for i in range(length)) / n ** 3)


def identity_error(df: DataFrame, model: Whitening, column: str = "embedding", count: int = COMPONENTS) -> float | None:
    """The largest entry, by size, of the covariance of all whitened rows minus the identity."""
    have = [k for k in range(min(count, model.length)) if not np.isnan(model.scales[k])]

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(have), len(have)))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                # The rows are centred, so their products are those of centred values.
                w = model.apply(integers(matrix(batch.column(0).slice(at, ROWS), model.length)), max(have) + 1)[:, have]
                total += w.T @ w
        i, j = np.triu_indices(len(have))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "s"])

    if not have:
        return None
    partial = df.filter(usable(column, model.length)).select(column).mapInArrow(per_task, "i int, j int, s double")
    # Decimals add up to the same total in any order.
    sums = partial.groupBy("i", "j").agg(F.sum(F.col("s").cast("decimal(38,16)")).cast("double").alias("s")).collect()
    return max(abs(r["s"] / model.n - (r["i"] == r["j"])) for r in sums)


def whiten(df: DataFrame, model: Whitening, column: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """``df`` with a struct of ``deviation`` and ``values`` (the whitened vector), NULL for vectors that cannot be whitened."""
    count = min(count, model.length)

    @F.arrow_udf("struct<deviation: bigint, values: array<double>>")
    def whitened(vectors: pa.Array) -> pa.Array:
        x = integers(matrix(vectors, model.length))
        values = model.apply(x, count)
        flat = pa.array(np.nan_to_num(values).ravel(), pa.float64(), mask=np.isnan(values).ravel())
        parts = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * count, pa.int32()), flat)
        return pa.StructArray.from_arrays([pa.array(model.deviations(x), pa.int64()), parts], ["deviation", "values"])

    known = usable(column, model.length)
    # Unusable vectors are replaced for the computation and their results taken back.
    zeros = F.array_repeat(F.lit(0.0), model.length)
    return df.withColumn(free_name(df, "whitened"), F.when(
        known, whitened(F.when(known, F.col(column).cast("array<double>")).otherwise(zeros))))


@query("op11_embedding_whitening")
def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "embeddings").select("vec_id", "embedding")
    kind = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = fit(df)
    if model is None:
        return spark.createDataFrame([], kind)
    error = identity_error(df, model)
    explained = [float(e) / model.trace if model.trace else None for e in model.values[:COMPONENTS]]
    rows = whiten(df.filter(usable("embedding", model.length)), model).select(
        "vec_id", "whitened.deviation", F.posexplode("whitened.values").alias("at", "whitened"))
    return rows.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(F.array(*[F.lit(e).cast("double") for e in explained]), F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))
