"""Small helpers shared by the operators: words, scratch tables, text blocks.

Words are the runs ``[^\\x20\\x09-\\x0D]+`` everywhere.  A null text counts as
empty.  Operators read only the columns they name, so a table may carry
further columns, also ones called like an operator's outputs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellspark.session import cut_lineage, remove_path, shared_path

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(col: str | Column) -> Column:
    """The text as it is; null is empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def finished(spark: SparkSession, query: Callable[[], DataFrame]) -> DataFrame:
    """A query's result as a checkpoint; the tables that it wrote on the way are deleted."""
    paths: list[str] = []
    token = _scratch.set(paths)
    try:
        return cut_lineage(query())
    finally:
        _scratch.reset(token)
        for path in paths:
            remove_path(spark, path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared folder; inside ``finished`` it goes with the query's end."""
    path = shared_path(spark, name)
    if (paths := _scratch.get()) is not None:
        paths.append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


__all__ = ["WORD", "GAP", "table", "whole_text", "word_count", "written", "finished", "scratch_path", "cut_lineage", "text_blocks", "utf8", "whole_bytes"]


def whole_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and its row offsets (nulls are empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or len(at) < 2:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]], at - at[0]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its row offsets (nulls are empty)."""
    return whole_bytes(column)


def text_blocks(batch: pa.RecordBatch, most: int = 1 << 20, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes in one column; a row is never cut."""
    _, at = whole_bytes(batch.column(column))
    row = 0
    while row < batch.num_rows:
        end = max(row + 1, int(np.searchsorted(at, at[row] + most, side="right")) - 1)
        yield batch.slice(row, end - row)
        row = end
