"""Whitening of embeddings by the leading components of their covariance.

Entries become integers, so sums and products of rows are exact whatever the order in which
tasks add them, and lost work that is done again gives the same components. Tasks reduce
their rows to one small matrix each; the matrix of the table has the size of a vector, and
``spectrum`` finds its components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlake.llm.spectrum import leading

# Fixed values of the integer form: x = floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1024, 100_000
# Beyond this |x| is no safe integer of a double, and no long for larger ones.
LARGEST = float(1 << 53)
EXACT = 1 << 53
ROWS_AT_ONCE = 4096
# Partial matrices are added up by so many tasks before the driver adds the rest.
ADDERS = 16


@dataclass(frozen=True)
class Whitener:
    """What a table's rows are projected with; ``n`` rows of sums ``sums`` were fitted."""

    n: int
    sums: tuple[int, ...]
    values: tuple[float, ...]
    vectors: np.ndarray
    trace: float


def usable_rows(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``vec_id, x`` (the integer form) of the rows that take part, of any vector length."""
    scaled = F.transform(F.col(vector_column).cast("array<double>"), lambda c: F.floor(c * F.lit(float(SCALE))))
    bad = F.exists(
        F.col(vector_column).cast("array<double>"),
        lambda c: c.isNull() | F.isnan(c) | (F.abs(c) * F.lit(float(SCALE)) + F.lit(float(OFFSET)) >= F.lit(LARGEST)),
    )
    return (
        df.where(F.col(vector_column).isNotNull() & ~bad & (F.size(vector_column) > 0))
        .select(F.col(id_column).cast("long").alias("vec_id"), scaled.alias("x"))
        .select("vec_id", F.transform("x", lambda v: v + F.lit(OFFSET)).alias("x"))
    )


def _matrices(batches: Iterator[pa.RecordBatch], place: int, size: int) -> Iterator[np.ndarray]:
    """The vectors of column ``place`` as rows of integers, a bounded number at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.column(place).slice(start, ROWS_AT_ONCE)
            yield np.asarray(part.flatten()).reshape(-1, size)


def _wide_sums(rows: np.ndarray) -> np.ndarray:
    """Exact column sums as Python integers."""
    high, low = rows >> 26, rows & ((1 << 26) - 1)
    return high.sum(axis=0).astype(object) * (1 << 26) + low.sum(axis=0).astype(object)


def _wide_products(rows: np.ndarray) -> np.ndarray:
    """Exact sums of products of all pairs of columns.

    The fast product of doubles is exact while its sums stay below 2^53; rows with larger
    entries are split into digits until that holds.
    """
    largest = int(np.abs(rows).max(initial=0))
    if largest * largest * len(rows) < EXACT:
        rows = rows.astype(np.float64)
        return (rows.T @ rows).astype(np.int64).astype(object)
    shift = max(1, largest.bit_length() // 2)
    high = rows >> shift
    low = rows - (high << shift)
    if len(rows) > 64 and largest.bit_length() <= 32:
        middle = len(rows) // 2
        return _wide_products(rows[:middle]) + _wide_products(rows[middle:])
    cross = high.astype(object).T @ low.astype(object)
    return (
        (high.astype(object).T @ high.astype(object)) * (1 << (2 * shift))
        + (cross + cross.T) * (1 << shift)
        + low.astype(object).T @ low.astype(object)
    )


def _added(rows: DataFrame, one: Callable[[Iterator[pa.RecordBatch]], np.ndarray | None], cells: int) -> np.ndarray:
    """Sums over all partitions of what ``one`` makes of each: ``cells`` integers or doubles.

    Numbers travel as text, which keeps integers of any length exact. A second set of
    tasks adds what the first ones made, so that the driver gets few rows.
    """

    def first(batches):
        made = one(batches)
        if made is not None:
            yield pa.RecordBatch.from_arrays([pa.array([[repr(v) for v in made]], pa.list_(pa.string()))], names=["cells"])

    def again(batches):
        total = None
        for batch in batches:
            for row in batch.column("cells"):
                made = _numbers(row.as_py())
                total = made if total is None else total + made
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([[repr(v) for v in total]], pa.list_(pa.string()))], names=["cells"])

    partial = rows.mapInArrow(first, "cells array<string>")
    # Dealt by a digest of the row, so a task that runs again deals as before.
    dealt = partial.repartition(ADDERS, F.xxhash64("cells")).mapInArrow(again, "cells array<string>")
    total = np.zeros(cells, object)
    for row in dealt.collect():
        total = total + _numbers(row.cells)
    return total


def _numbers(texts: list[str]) -> np.ndarray:
    return np.array([float(t) if set(t) & set(".en") else int(t) for t in texts], object)


def fit(rows: DataFrame, components: int) -> tuple[DataFrame, Whitener | None]:
    """The rows of one length and what whitens them; None without rows."""
    most = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if most is None:
        return rows, None
    size = most["size"]
    rows = rows.where(F.size("x") == size)

    def sums(batches):
        n, total = 0, np.zeros(size, object)
        for x in _matrices(batches, 1, size):
            n += len(x)
            total = total + _wide_sums(x)
        return np.append(total, n) if n else None

    *totals, n = _added(rows, sums, size + 1)
    centre = np.array([_nearest(s, n) for s in totals], np.int64)

    def products(batches):
        seen, moved, total = 0, np.zeros(size, object), np.zeros((size, size), object)
        for x in _matrices(batches, 1, size):
            seen += len(x)
            moved = moved + _wide_sums(x - centre)
            total = total + _wide_products(x - centre)
        return np.concatenate([moved, total.ravel()]) if seen else None

    made = _added(rows, products, size + size * size)
    off, total = made[:size], made[size:].reshape(size, size)
    # What the whole-numbered centre is off by is taken out in exact arithmetic.
    exact = total * n - np.outer(off, off)
    covariance = np.array([[value / (n * n) for value in row] for row in exact], np.float64)
    found = leading(covariance, components)
    return rows, Whitener(
        n,
        tuple(totals),
        tuple(c.value for c in found),
        np.array([c.vector for c in found]).reshape(len(found), size),
        float(np.trace(covariance)),
    )


def _nearest(total: int, n: int) -> int:
    return (2 * total + n) // (2 * n)


def _whitened(x: np.ndarray, model: Whitener) -> np.ndarray:
    """Rows projected on the components; x - S/n is taken as a whole part and a small rest."""
    centre = np.array([_nearest(s, model.n) for s in model.sums], np.int64)
    rest = np.array([(s - int(c) * model.n) / model.n for s, c in zip(model.sums, centre)])
    return ((x - centre) - rest) @ (model.vectors / np.sqrt(np.array(model.values))[:, None]).T


def _deviations(x: np.ndarray, model: Whitener) -> list[int | None]:
    """Exact sums of (n x - S)²; None where a long does not hold one."""
    sums = np.array(model.sums, object)
    bound = max(abs(model.n * int(x.max()) - min(model.sums)), abs(model.n * int(x.min()) - max(model.sums)), 1)
    if bound * bound * x.shape[1] < 1 << 63:
        moved = x * model.n - sums.astype(np.int64)
        return (moved * moved).sum(axis=1).tolist()
    moved = x.astype(object) * model.n - sums
    return [value if value < 1 << 63 else None for value in (moved * moved).sum(axis=1)]


def identity_error(rows: DataFrame, model: Whitener) -> float:
    """The largest entry of the whitened rows' covariance less the identity, from the rows."""
    k = len(model.values)
    if not k:
        return 0.0
    size = len(model.sums)

    def moments(batches):
        seen, first, second = 0, np.zeros(k), np.zeros((k, k))
        for x in _matrices(batches, 1, size):
            w = _whitened(x, model)
            seen += len(x)
            first += w.sum(axis=0)
            second += w.T @ w
        return np.concatenate([first, second.ravel()]).astype(float).tolist() if seen else None

    made = _added(rows, moments, k + k * k).astype(np.float64)
    # Rows are centred before they are projected; their mean is rounding noise.
    mean, second = made[:k] / model.n, made[k:].reshape(k, k) / model.n
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def whiten(
    df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = 8
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``.

    A row for each vector that takes part and each component, numbered from 1 by falling
    eigenvalue. Left out are vectors that are null or empty, that hold null or non-finite
    entries, or entries beyond 2^53 / 1024, for which there is no exact integer form. Where
    lengths differ, the most frequent takes part (of equally frequent ones the longest).
    Components without variance beyond rounding do not exist: a single row, equal rows, or
    fewer dimensions give fewer or none. A null id and repeated rows count like any other; a
    deviation that no long can hold is null. Other columns play no part.
    """
    schema = (
        "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    rows, model = fit(usable_rows(df, id_column, vector_column), components)
    if model is None or not model.values:
        return df.sparkSession.createDataFrame([], schema)
    error = identity_error(rows, model)
    size, k = len(model.sums), len(model.values)
    explained = [value / model.trace for value in model.values]

    def project(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                (x,) = _matrices([part], 1, size)
                count = len(x)
                deviations = np.repeat(np.array(_deviations(x, model), object), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(np.repeat(np.arange(count), k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                        pa.array(np.full(count * k, model.n)),
                        pa.array(deviations, pa.int64()),
                        pa.array(_whitened(x, model).ravel()),
                        pa.array(np.tile(explained, count)),
                        pa.array(np.full(count * k, error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(project, schema)
