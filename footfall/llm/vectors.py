"""Vectors of whole numbers: matrices of bytes in columns, exact inner products, highest scores."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LARGEST = 1 << 24  # of a component as a whole number, so that all products are exact
NONE = -(1 << 62)  # below every score


@dataclass(frozen=True)
class Shape:
    """Rows of a table of vectors, their length, bytes and scale of a component."""

    rows: int
    size: int
    width: int
    scale: int

    @property
    def kind(self) -> str:
        return f"i{self.width}"


def finite(vector: Column) -> Column:
    """Whether a vector is there and every component is a finite number."""
    sound = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return F.coalesce(sound, F.lit(False))


def measured(df: DataFrame, scale: int, parts: int = 1) -> Shape:
    """The shape of ``floor(scale * x)`` of ``embedding``, by one pass.

    The length is that of the longest vector, made a multiple of ``parts``. Stops where a
    component is too large for exact products.
    """
    vector = F.col("embedding")
    most = F.max(F.array_max(F.transform(vector, F.abs)))
    rows, size, top = df.agg(F.count("*"), F.max(F.size(vector)), most).head()
    top = (top or 0.0) * scale + 1
    if top > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST / scale:g}")
    width = next(w for w in (1, 2, 4) if top < 1 << (8 * w - 1))
    return Shape(rows, -(-(size or 0) // parts) * parts, width, scale)


def whole(column: pa.Array, shape: Shape) -> np.ndarray:
    """A column of vectors as whole numbers, a row each; short ones are filled up with 0."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), shape.size), np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out[np.arange(shape.size) < lengths[:, None]] = np.floor(values * shape.scale)
    return out


def byte_rows(matrix: np.ndarray) -> pa.Array:
    """A column of bytes, one value for each row of ``matrix``."""
    matrix = np.ascontiguousarray(matrix)
    length = matrix.shape[1] * matrix.itemsize
    ends = np.arange(len(matrix) + 1, dtype=np.int64) * length
    data = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(matrix.tobytes())]
    return pa.Array.from_buffers(pa.binary(), len(matrix), data)


def from_byte_rows(column: pa.Array, shape: Shape) -> np.ndarray:
    """The matrix whose rows ``byte_rows`` has put down with the width of ``shape``."""
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, shape.kind).reshape(len(column), shape.size)


def matrix(raw: bytes, n: int, shape: Shape) -> np.ndarray:
    return np.frombuffer(raw, shape.kind).reshape(n, shape.size)


def squares(rows: np.ndarray) -> np.ndarray:
    """Sum of squares of each row."""
    rows = rows.astype(np.int64)
    return (rows * rows).sum(axis=1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of ``a`` with all of ``b``, exact.

    No partial sum passes the product of the lengths, which tells what kind of number
    holds all of them.
    """
    most = np.sqrt(float(squares(a).max(initial=0)) * float(squares(b).max(initial=0)))
    kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
    return a.astype(kind) @ b.astype(kind).T


def hide(scores: np.ndarray, which: np.ndarray) -> None:
    """Takes entries out of the running."""
    low = np.iinfo(np.int64).min if scores.dtype == np.int64 else -np.inf
    scores[which] = low


def leading(
    scores: np.ndarray, ids: np.ndarray, floor: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``k`` highest scores of each row, ties to the smaller id.

    Scores below the row's ``floor`` are left out, and hidden ones.
    """
    # Exact in the scores' own type, which holds all whole numbers up to the largest score.
    among = scores >= floor.astype(scores.dtype)[:, None]
    many = np.count_nonzero(among, axis=1) > k
    if many.any():
        which, place = slice(None) if many.all() else many, scores.shape[1] - k
        some = scores[which]
        among[which] &= some >= np.partition(some, place, axis=1)[:, place, None]
    rows, columns = np.divmod(np.flatnonzero(among), scores.shape[1])
    order = np.lexsort((ids[columns], -scores[rows, columns], rows))
    rows, columns = rows[order], columns[order]
    top = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
    return rows[top], columns[top]


def pieces(
    batches: Iterator[pa.RecordBatch], key: str, size: int
) -> Iterator[pa.RecordBatch]:
    """Runs of rows that are alike in ``key``, cut after ``size`` rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([*held, batch]).combine_chunks().to_batches()[0]
        keys = rows.column(key).to_numpy()
        ends = [*(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        low = 0
        for end in ends:
            # What the last run lacks of a piece may come with the next batch.
            while low < end and (end < len(keys) or end - low >= size):
                high = min(low + size, end)
                yield rows.slice(low, high - low)
                low = high
        held = [rows.slice(low)] if low < len(keys) else []
    yield from held


def record(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A batch of ``schema`` from lists or arrays by name."""
    arrays = [
        columns[f.name].cast(f.type)
        if isinstance(columns[f.name], pa.Array)
        else pa.array(columns[f.name], f.type)
        for f in schema
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def longs(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.int64)


def spread(sample: np.ndarray, number: int) -> np.ndarray:
    """Numbers of up to ``number`` rows, each as far as can be from those before."""
    if not len(sample):
        return np.zeros(0, np.int64)
    rows = sample.astype(np.float64)
    chosen, far = [0], ((rows - rows[0]) ** 2).sum(axis=1)
    while len(chosen) < number and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((rows - rows[chosen[-1]]) ** 2).sum(axis=1))
    return np.array(chosen)
