"""Helpers shared by the operators: reading tables, row keys, Arrow columns as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """``did`` and ``tag``: equal for two rows only if their id is equal and (nearly always) their text too.

    Two rows with the same id and text have the same results, so they may share a key. A null id is replaced by a
    hash of the text, so that rows without an id do not meet under one key.
    """
    return [
        F.coalesce(F.col(doc_id).cast("long"), F.xxhash64(F.coalesce(F.col(text), F.lit("")))).alias("did"),
        F.hash(F.coalesce(F.col(text), F.lit(""))).alias("tag"),
    ]


def small_batches(spark: SparkSession) -> None:
    """Bound the bytes of one Arrow batch, so that a Python worker's memory does not depend on text lengths."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def byte_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and the n + 1 offsets of its values (a null is empty)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    _, places, data = column.buffers()
    kind = np.int64 if large else np.int32
    if len(column) == 0 or places is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(places, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    content = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return content[offsets[0] : offsets[-1]], offsets - offsets[0]


def packed(df: DataFrame, text: str, name: str) -> DataFrame:
    """Replace a text column by its zstandard frame ``name``, which makes the shuffle of long texts smaller."""
    others = [c for c in df.columns if c != text]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            place = batch.schema.get_field_index(text)
            data, at = byte_column(batch.column(place))
            frames = pa.array([squeeze(data[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), frames], [*others, name])

    return df.mapInArrow(run, f"{fields}, {name} binary")


def rows_by_bytes(batch: pa.RecordBatch, sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Cut a batch into row ranges of about ``most`` bytes; a single longer row is a range of its own."""
    start, total = 0, 0
    for row, size in enumerate(sizes):
        if row > start and total + size > most:
            yield start, row
            start, total = row, 0
        total += int(size)
    if start < batch.num_rows:
        yield start, batch.num_rows
