"""Whitening of vectors by an exact integer scatter.

Each entry c is the integer x = floor(SCALE * c) + OFFSET. A shift is subtracted, which
makes the integers small and changes no covariance: y = x - shift. Tasks sum y and all
cross-products y_i * y_j without rounding: small integers by matrix products of
doubles that hold them exactly, larger ones in limbs. A task's sums leave it as
limbs of 32 bits, which Spark adds up by their place, so that neither a task nor the
driver meets more than a few rows for each pair of dimensions. The driver puts the limbs together as
integers of any size, forms A = n * Y'Y - T T' (T: sums of y) without rounding, and only then
divides: V = A / n^2 in doubles, decomposed by eigh.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobloom.llm.common import free_names, frugal, written

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Bits of a limb in products of doubles, and rows that one product takes: the sum of
#: that many products of two limbs is below 2^53.
LIMB, ROWS = 18, 1 << 16
#: Entries beyond this, scaled, count as this.
MOST = 1 << 61
#: Eigenvalues up to this share of the trace are no variance but rounding.
NOTHING = 1e-13


class Whitening(NamedTuple):
    """n vectors of `size` entries; shift and total: of y, integers; axes: a column
    for each component; values: eigenvalues; trace: of V."""

    n: int
    size: int
    shift: list[int]
    total: list[int]
    axes: np.ndarray
    values: np.ndarray
    trace: float


def usable(column: str = "embedding"):
    """Vectors that take part: not null, without null or non-finite entries."""
    c = F.col(column)
    bad = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return c.isNotNull() & ~bad


def _shifted(vectors: pa.Array, size: int, shift: np.ndarray, scale: int, offset: int) -> np.ndarray:
    """y of each vector, a row each; entries that a shorter vector lacks are c = 0."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    length = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    c = np.zeros((len(vectors), size))
    row = np.repeat(np.arange(len(vectors)), length)
    c[row, np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)] = flat
    return np.clip(np.floor(scale * c), -MOST, MOST).astype(np.int64) + (offset - shift)


def cross_products(y: np.ndarray) -> np.ndarray:
    """Y'Y of integers, exact, as Python integers."""
    found = np.zeros((y.shape[1],) * 2, object)
    for at in range(0, len(y), ROWS):
        part, limbs = y[at : at + ROWS], []
        while part.any():
            low = part & ((1 << LIMB) - 1)
            low = np.where(low >= 1 << (LIMB - 1), low - (1 << LIMB), low)  # nearest, so that small negative numbers have one limb
            limbs.append(low.astype(np.float64))
            part = (part - low) >> LIMB
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                found += (a.T @ b).astype(np.int64).astype(object) << (LIMB * (i + j))
    return found


def sums(y: np.ndarray) -> np.ndarray:
    """Sum of each column, as Python integers."""
    high, low = y >> 31, y & ((1 << 31) - 1)
    return (high.sum(axis=0).astype(object) << 31) + low.sum(axis=0).astype(object)


def fit(rows: DataFrame, column: str = "embedding", scale: int = SCALE, offset: int = OFFSET) -> Whitening | None:
    """Of all usable vectors of rows; None if there are none, or only empty ones."""
    frugal(rows.sparkSession)
    vectors = rows.filter(usable(column)).select(F.col(column).alias("c"))
    head = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("c")).alias("size"), F.max("c").alias("any")).first()
    n, size = head["n"], head["size"] or 0
    if not n or not size:
        return None
    whole = pa.array([head["any"]], pa.list_(pa.float64()))
    shift = _shifted(whole, size, np.zeros(size, np.int64), scale, offset)[0]
    upper = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, total, any_row = np.zeros((size, size), object), np.zeros(size, object), False
        for batch in batches:
            y = _shifted(batch["c"], size, shift, scale, offset)
            products += cross_products(y)
            total += sums(y)
            any_row = True
        if not any_row:
            return
        place, level, value = [], [], []
        for k, x in enumerate([*total.tolist(), *products[upper].tolist()]):
            sign, x, at = (1 if x >= 0 else -1), abs(x), 0
            while x:
                place.append(k)
                level.append(at)
                value.append(sign * (x & 0xFFFFFFFF))
                x >>= 32
                at += 1
        yield pa.RecordBatch.from_pydict({"place": pa.array(place, pa.int32()), "level": pa.array(level, pa.int32()), "value": pa.array(value, pa.int64())})

    limbs = vectors.mapInArrow(run, "place int, level int, value long").groupBy("place", "level").agg(F.sum("value").alias("value"))
    found = [0] * (size + len(upper[0]))
    for r in limbs.collect():  # a few rows for each pair of dimensions
        found[r["place"]] += r["value"] << (32 * r["level"])
    total, scatter = found[:size], np.zeros((size, size))
    for i, j, x in zip(*(u.tolist() for u in upper), found[size:], strict=True):
        scatter[i, j] = scatter[j, i] = (n * x - total[i] * total[j]) / (n * n)  # integers up to here: one rounding
    values, axes = np.linalg.eigh(scatter)
    values, axes = values[::-1], axes[:, ::-1]
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(size)] < 0, -1.0, 1.0)
    return Whitening(n, size, shift.tolist(), total, axes, values, float(np.trace(scatter)))


def apply(rows: DataFrame, model: Whitening | None, column: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """The usable rows with `deviation` (sum over dimensions of (n*x-S)^2; null if no
    long holds it) and `whitened`, an array of up to `components` entries: x less the
    mean, projected on each component, over the root of its eigenvalue; null for
    components without variance.

    Other columns stay; of those that are called like the two new ones, these take
    the place. Vectors shorter than the longest have c = 0 for what they lack. Null
    ids, repeated rows and ties are rows like others. Without vectors, no rows."""
    spark = rows.sparkSession
    frugal(spark)
    kept = [c for c in rows.columns if c.lower() not in ("deviation", "whitened")]
    used = rows.filter(usable(column)).select(kept)
    if model is None:
        return used.withColumns({"deviation": F.lit(0).cast("long"), "whitened": F.array().cast("array<double>")})
    n, size, count = model.n, model.size, min(components, model.size)
    shift, real = np.array(model.shift, np.int64), model.values[:count] > NOTHING * model.trace
    steps = np.where(real, 1 / np.sqrt(np.where(real, model.values[:count], 1)), 0) * model.axes[:, :count]
    most = max(map(abs, model.total))
    (c,) = free_names(kept, "_c")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.array(model.total, object)
        for batch in batches:
            y = _shifted(batch[c], size, shift, scale, offset)
            small = max(1, int(np.abs(y).max(initial=0))) * n + most
            away = y * n - total.astype(np.int64) if small < 1 << 62 else y.astype(object) * n - total
            if size * small**2 < 1 << 63:
                deviation = (away.astype(np.int64) ** 2).sum(axis=1).tolist()
            else:
                deviation = [x if x < 1 << 63 else None for x in (away.astype(object) ** 2).sum(axis=1).tolist()]
            # far from the root of 2^63 a difference is exact in a double only after the division
            centred = (away / n).astype(np.float64)
            w = centred @ steps
            flat = pa.array(w.reshape(-1), mask=np.tile(~real, len(w)))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * count, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([*(batch[k] for k in kept), pa.array(deviation, pa.int64()), lists], [*kept, "deviation", "whitened"])

    schema = T.StructType([*used.schema.fields, T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    return used.withColumn(c, F.col(column).cast("array<double>")).mapInArrow(run, schema)


def identity_error(rows: DataFrame, whitened: str = "whitened") -> float:
    """Largest absolute entry of the covariance of the whitened rows less the
    identity, over the components that have variance; 0.0 without any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moments, total, n = 0.0, 0.0, 0
        for batch in batches:
            if len(batch):
                w = batch["w"].flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
                moments, total, n = moments + w.T @ w, total + w.sum(axis=0), n + len(w)
        if n:
            yield pa.RecordBatch.from_pydict({"place": pa.array(range(1 + len(total) + moments.size), pa.int32()), "value": pa.array(np.concatenate(([n], total, moments.reshape(-1))), pa.float64(), from_pandas=False)})

    parts = rows.select(F.col(whitened).alias("w")).mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    found = [r["value"] for r in parts.orderBy("place").collect()]  # components squared, and a few
    if len(found) < 2:
        return 0.0
    n, size = found[0], round((np.sqrt(4 * len(found) - 3) - 1) / 2)
    mean, moments = np.array(found[1 : 1 + size]) / n, np.array(found[1 + size :]).reshape(size, size) / n
    off = np.abs(moments - np.outer(mean, mean) - np.eye(size))
    real = ~np.isnan(np.diag(moments))
    return float(off[np.ix_(real, real)].max(initial=0.0))


def whiten(rows: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> tuple[DataFrame, Whitening | None, float]:
    """(rows as of apply(), written; the model; identity error of these rows)."""
    model = fit(rows, column)
    table = written(apply(rows, model, column, components), "whitened")
    return table, model, identity_error(table)


def report(table: DataFrame, model: Whitening | None, error: float, key: str = "vec_id") -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error), a row for
    each row of table and component."""
    share = [] if model is None else [float(max(e, 0.0) / model.trace) if model.trace > 0 else 0.0 for e in model.values[:COMPONENTS]]
    each = table.select(key, "deviation", F.posexplode("whitened").alias("_k", "whitened"))
    explained = F.element_at(F.lit(share) if share else F.array().cast("array<double>"), F.col("_k") + 1)
    n = F.lit(model.n if model else 0).cast("long")
    return each.select(key, (F.col("_k") + 1).alias("component"), n.alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(error).alias("identity_error"))
