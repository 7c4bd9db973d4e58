"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import os
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from likeness.session import ensure_checkpoint_dir, materialize

__all__ = ["add_columns", "arrow_map", "bounded_batches", "fresh", "materialize", "short_reads", "table", "text_id"]

try:
    _LIBC = ctypes.CDLL(None)
except OSError:                # a platform without it keeps its memory
    _LIBC = None

# Rows and bytes of one Arrow batch handed to a Python worker: whole texts are
# long, so the default of 10,000 rows would not bound a worker's memory.
BATCH_ROWS = 1000
BATCH_BYTES = 4 << 20
READER_ROWS = "spark.sql.parquet.columnarReaderBatchSize"
READ_ROWS = 500                # of whole texts, that a reader holds at once inside ``short_reads``


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches of this session; every query calls it first."""
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bounded_batches(spark).read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


@contextmanager
def short_reads(spark: SparkSession):
    """Plans run inside read ``READ_ROWS`` rows of Parquet at once: arrays for the
    default of 4,096 whole texts make an executor's heap grow, and it stays so."""
    rows = spark.conf.get(READER_ROWS)
    spark.conf.set(READER_ROWS, min(int(rows), READ_ROWS))
    try:
        yield
    finally:
        spark.conf.set(READER_ROWS, rows)


def text_id(col) -> F.Column:
    """crc32 of an id written as text: the key of every train / held-out rule."""
    return F.crc32(F.col(col).cast("string").cast("binary"))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have in any case."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def arrow_map(df: DataFrame, fn, schema) -> DataFrame:
    """``mapInArrow`` with a function from one batch to batches of ``schema``."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)
        release_memory()
    return df.mapInArrow(run, schema)


def release_memory() -> None:
    """Give freed memory back at the end of a partition: Python workers live on
    from stage to stage, beside a heap that grows."""
    pa.default_memory_pool().release_unused()
    trim = getattr(_LIBC, "malloc_trim", None)
    if trim:
        trim(0)


def add_columns(df: DataFrame, fields: list[T.StructField], make, text_col: str = "text") -> DataFrame:
    """Every row of ``df`` with the columns that ``make(texts)`` returns.

    Map-only: rows and all other columns pass through unchanged.  A column of
    ``df`` whose name equals an added one (in any case) is replaced by it.
    ``make`` gets the whole texts of a batch (null included) and returns one
    list or Arrow array per field.
    """
    added = {f.name.lower() for f in fields}
    kept = [c for c in df.columns if c.lower() not in added]
    names = [*kept, *(f.name for f in fields)]
    schema = T.StructType([*(df.schema[c] for c in kept), *fields])
    hidden = fresh(df, "whole_text")

    def run(batch):
        made = make(batch.column(hidden).to_pylist())
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in kept),
             *(pa.array(m, type=_arrow(f.dataType)) for m, f in zip(made, fields))], names)

    passed = df.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text_col}`").alias(hidden))
    return arrow_map(passed, run, schema)


def _arrow(kind) -> pa.DataType:
    simple = {"long": pa.int64(), "integer": pa.int32(), "double": pa.float64(),
              "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([(f.name, _arrow(f.dataType)) for f in kind.fields])
    return simple[kind.typeName()]
