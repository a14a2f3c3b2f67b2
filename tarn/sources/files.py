"""File scans: projection, row positions, alias names and evolved schemas."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (ByteType, DataType, DecimalType, DoubleType, FloatType, IntegerType, LongType,
                               ShortType, StructType)


def scan(spark: SparkSession, path: str, columns: list[str] | None = None, where: Column | str | None = None,
         schema: StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """Projected and filtered file scan; both reach the file reader."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.format(fmt).load(path)
    df = df.where(where) if where is not None else df
    return df.select(*columns) if columns else df


def with_positions(df: DataFrame, file: str = "_file", pos: str = "_pos") -> DataFrame:
    """Rows with the file they were read from and their row number in it."""
    return df.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(pos))


def file_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                files_per_trigger: int | None = None) -> DataFrame:
    """Stream over a growing folder, or the files and folders a pattern names; new files are found at every trigger."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def resolve_names(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Columns under their mapped names: the first present alias with a value, else NULL."""
    have = set(df.columns)
    columns = []
    for name, options in aliases.items():
        found = [F.col(o) for o in options if o in have]
        columns.append((F.coalesce(*found) if found else F.lit(None)).alias(name))
    return df.select(*columns)


_INTEGRAL = [ByteType, ShortType, IntegerType, LongType]


def can_widen(old: DataType, new: DataType) -> bool:
    """int to long, float to double, decimal to more digits of the same scale, or no change."""
    if old == new:
        return True
    if type(old) in _INTEGRAL and type(new) in _INTEGRAL:
        return _INTEGRAL.index(type(old)) <= _INTEGRAL.index(type(new))
    if isinstance(old, FloatType) and isinstance(new, DoubleType):
        return True
    return (isinstance(old, DecimalType) and isinstance(new, DecimalType)
            and old.scale == new.scale and old.precision <= new.precision)


def read_evolved(parts: list[DataFrame], schema: StructType) -> DataFrame:
    """Files of several schema versions under the current one: new columns NULL, old types widened."""

    def current(part: DataFrame) -> DataFrame:
        types = {f.name: f.dataType for f in part.schema.fields}
        for f in schema.fields:
            if f.name in types and not can_widen(types[f.name], f.dataType):
                raise ValueError(f"column {f.name}: {types[f.name].simpleString()} cannot become {f.dataType.simpleString()}")
        kept = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields if f.name in types]
        return part.select(*kept)

    empty = parts[0].sparkSession.createDataFrame([], schema)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(current, parts), empty)
