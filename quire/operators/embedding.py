"""Batch embedding: each row leaves with its own vector, so nothing is zipped by position."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quire.functions.embedders import EmbedFn


def embed(
    df: DataFrame,
    embed_fn: EmbedFn,
    *,
    text: str = "text",
    vector: str = "embedding",
    batch_size: int = 64,
    spread: bool = False,
) -> DataFrame:
    """Append ``vector``, the embedding of column ``text``, as ``array<float>``.

    ``spread`` lets adaptive execution even out the partitions first; a gzip part is one
    task, and embedding is the part of the job that must not wait for the largest one.
    """
    if spread:
        df = df.hint("rebalance")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, batch_size):
                part = batch.slice(at, batch_size)  # so that a task holds the texts and vectors of one call
                texts = part.column(part.schema.get_field_index(text)).to_pylist()
                matrix = np.asarray(embed_fn(texts), dtype="float32")
                if matrix.ndim != 2 or matrix.shape[0] != len(texts):
                    raise ValueError(f"{len(texts)} texts gave a matrix of shape {matrix.shape}")
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, vectors_to_arrow(matrix)], names=[*part.schema.names, vector]
                )

    schema = T.StructType([*df.schema.fields, T.StructField(vector, T.ArrayType(T.FloatType()))])
    return df.mapInArrow(run, schema)


def by_bytes(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts in ``column`` have up to ``most`` bytes, or one row."""
    texts = batch.column(batch.schema.get_field_index(column))
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype("int64"))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def vectors_to_arrow(matrix: np.ndarray) -> pa.ListArray:
    """Rows of a matrix as an Arrow list column, without copying row by row."""
    n, dim = matrix.shape
    offsets = pa.array(np.arange(n + 1, dtype="int32") * dim)
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(matrix).reshape(-1)))


def arrow_to_matrix(column: pa.Array, dtype="float64") -> np.ndarray:
    """An Arrow list column as a matrix over its flat buffer; uneven rows are an error."""
    n = len(column)
    if n == 0:
        return np.empty((0, 0), dtype=dtype)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    dim, rest = divmod(flat.size, n)
    lengths = np.diff(column.offsets.to_numpy())
    if column.null_count or rest or (lengths != dim).any():
        raise ValueError("vectors differ in length or are missing")
    return flat.reshape(n, dim).astype(dtype, copy=False)
