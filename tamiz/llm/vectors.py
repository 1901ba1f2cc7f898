"""Embeddings as exact integer vectors (helpers inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 256
# Components beyond this would overflow a long in a sum of squares over 64 of them: the job stops with an error.
LARGEST = 1 << 27
# Sums of products below this are exact in double precision.
EXACT = 1 << 52


def integer_vectors(df: DataFrame, carried: Sequence[str], dimension: int | None = None, scale: int = SCALE) -> DataFrame:
    """The carried columns and q, floor(scale * x) of each component of `embedding` as a double.

    Rows with a null vector or a null or non-finite component are left out, and those with another number of
    components than `dimension`, if that is given. Other columns are ignored, whatever their names.
    """
    rows = df.select(*carried, F.col("embedding").cast("array<double>").alias("_vector"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("_vector")
            there = np.asarray(lists.is_valid())
            size = np.asarray(pc.fill_null(pc.list_value_length(lists), 0)).astype(np.int64)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(lists.flatten().to_numpy(zero_copy_only=False)))])
            ends = np.cumsum(size)
            keep = there & (bad[ends] == bad[ends - size])
            if dimension is not None:
                keep &= size == dimension
            kept = batch.filter(pa.array(keep))
            whole = np.floor(kept.column("_vector").flatten().to_numpy(zero_copy_only=False) * scale)
            if len(whole) and np.abs(whole).max() > LARGEST:
                raise ValueError(f"a component of a vector is beyond {LARGEST // scale} in size")
            offsets = pa.array(np.concatenate([[0], np.cumsum(size[keep])]), pa.int32())
            q = pa.ListArray.from_arrays(offsets, pa.array(whole.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*(kept.column(c) for c in carried), q], names=[*carried, "q"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*carried).schema)
    return rows.mapInArrow(run, f"{kinds}, q array<int>")


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of `width` numbers; shorter lists are filled up with zeros."""
    size = np.asarray(pc.list_value_length(column)).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (size == width).all():
        return flat.reshape(len(column), width)
    made = np.zeros((len(column), width), flat.dtype)
    row = np.repeat(np.arange(len(column)), size)
    made[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return made


def exact_kind(*parts: np.ndarray) -> type:
    """The fastest number type in which sums of products of the parts' rows are exact."""
    most = max((int(np.abs(p).max()) for p in parts if p.size), default=0)
    return np.float64 if 4 * most * most * max(p.shape[-1] for p in parts) < EXACT else np.int64
