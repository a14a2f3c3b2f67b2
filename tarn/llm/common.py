"""Helpers shared by the operators: stored intermediate tables, byte texts in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tarn.session import scratch

#: Splits words as ``[^\x20\x09-\x0D]+`` does: Spark's regular expression for native code, ``bytes.split()`` in Python.
WORD = r"[^\x20\x09-\x0D]+"


def saved(df: DataFrame, name: str, rows_per_file: int = 0) -> DataFrame:
    """Write a table to the shared folder and read it back: lost executors recompute nothing behind it."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def byte_texts(column: pa.Array) -> list[bytes]:
    """Texts of an Arrow column as UTF-8 bytes; a null text is empty."""
    if pa.types.is_null(column.type):
        return [b""] * len(column)
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b or b"" for b in column.cast(kind).to_pylist()]


def chunks_by_bytes(texts: list[bytes], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts of about ``most`` bytes; a longer text stands alone, whole."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > most:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def id_hash_mod(column: str, n: int) -> Column:
    """crc32 of an id written as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % F.lit(n)
