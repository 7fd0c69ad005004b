"""Whole vectors as integer or double matrices inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(name: str) -> Column:
    """The vector is there and none of its components is null, NaN or infinite."""
    return F.col(name).isNotNull() & F.forall(name, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))


def plain(df: DataFrame, *more: str) -> DataFrame:
    """vec_id as long, the embedding as doubles, and the columns ``more`` of the rows whose vector is finite."""
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), *more)
    return rows.where(finite("embedding"))


def matrix(col: pa.Array, dims: int) -> np.ndarray:
    """The doubles of a list column whose rows have ``dims`` components each."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), dims)


def integers(x: np.ndarray, scale: int, limit: int) -> np.ndarray:
    """floor(scale * x) as 32-bit integers, held to ``limit`` on either side so that sums of squares fit a long."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(x * scale), -limit, limit).astype(np.int32)


def packed(rows: np.ndarray) -> pa.Array:
    """One binary value per row of a C-contiguous matrix."""
    rows = np.ascontiguousarray(rows)
    width = rows.dtype.itemsize * rows.shape[1]
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def unpacked(col: pa.Array, dtype: type, width: int) -> np.ndarray:
    """The matrix of ``width`` columns that ``packed`` wrote."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not len(col):
        return np.zeros((0, width), dtype)
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, dtype=np.int32)[col.offset:col.offset + len(col) + 1]
    return np.frombuffer(data, dtype=dtype, count=(off[-1] - off[0]) // np.dtype(dtype).itemsize, offset=off[0]).reshape(len(col), width)


def pieces(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows."""
    for batch in batches:
        for lo in range(0, len(batch), rows):
            yield batch.slice(lo, rows)
