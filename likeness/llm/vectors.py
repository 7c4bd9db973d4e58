"""Vectors of the embedding operators: which take part, and their copies."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from likeness.llm.common import materialize


def usable(rows: DataFrame, id_col: str, vector_col: str, widen: bool = True) -> DataFrame:
    """(id, vec) of the rows that can be compared: an id, and a vector that is
    not null or zero and holds neither nulls nor non-finite numbers.  Vectors
    are compared with others of their own length.  ``vec`` holds doubles; without
    ``widen`` floats stay floats, half as many bytes."""
    vec = F.col(f"`{vector_col}`")
    if widen or rows.select(vec).schema[0].dataType.simpleString() != "array<float>":
        vec = vec.cast("array<double>")
    big = float("inf")
    return (rows.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), vec.alias("vec"))
            .where("id is not null and vec is not null and size(vec) > 0")
            .where(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big)))
            .where(F.exists("vec", lambda x: x != 0)))


def written_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return materialize(usable(rows, id_col, vector_col).distinct(), "vectors")


def by_length(batch: pa.RecordBatch, column: str):
    """The rows of each vector length in ``batch``."""
    length = pc.list_value_length(batch.column(column)).to_numpy(zero_copy_only=False)
    for n in np.unique(length):
        yield batch if (length == n).all() else batch.take(pa.array(np.flatnonzero(length == n)))


def matrix(column) -> np.ndarray:
    """Rows of a list column as a matrix of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))
