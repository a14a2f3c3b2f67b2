"""Scalar functions: JSON and variant access, small UDF forms, schema inference."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (ArrayType, DataType, DoubleType, FloatType, MapType, NullType, StringType, StructField,
                               StructType, VariantType)


def celsius_to_fahrenheit(col: Column) -> Column:
    return col * 9.0 / 5.0 + 32.0


@F.pandas_udf(DoubleType())
def celsius_to_fahrenheit_udf(values: pd.Series) -> pd.Series:
    """The same conversion as an Arrow-batched function, the form for real Python logic."""
    return values * 9.0 / 5.0 + 32.0


def determinant_2x2(a: Column, b: Column, c: Column, d: Column) -> Column:
    return a * d - b * c


@F.pandas_udf(FloatType())
def determinant_2x2_udf(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    return a * d - b * c


def extract(col: Column, path: str, data_type: str) -> Column:
    """Typed value at a path of JSON text, NULL where absent or of another type."""
    return F.try_variant_get(F.try_parse_json(col), path, data_type)


def json_to_map(col: Column) -> Column:
    """JSON object to map<string,string>; nested values stay JSON text."""
    return F.from_json(col, "map<string,string>")


def copy_value(df: DataFrame, source: str, target: str) -> DataFrame:
    return df.withColumn(target, F.col(source))


def infer_struct(df: DataFrame, payload: str) -> StructType:
    """Struct type of all JSON documents of a column, found by one distributed aggregate.

    Fields only ever null or empty are left out, arrays of mixed values become
    arrays of strings, arrays of objects become arrays of string maps.
    """
    text = df.select(F.schema_of_variant_agg(F.try_parse_json(F.col(payload)))).first()[0]
    inferred = DataType.fromDDL(text.replace("OBJECT<", "STRUCT<"))
    return _usable(inferred) or StructType([])


def _usable(kind: DataType) -> DataType | None:
    if isinstance(kind, NullType):
        return None
    if isinstance(kind, VariantType):
        return StringType()
    if isinstance(kind, StructType):
        fields = [(f.name, _usable(f.dataType)) for f in kind.fields]
        kept = [StructField(name, t) for name, t in fields if t is not None]
        return StructType(kept) if kept else None
    if isinstance(kind, ArrayType):
        if isinstance(kind.elementType, StructType):
            return ArrayType(MapType(StringType(), StringType()))
        element = _usable(kind.elementType)
        return ArrayType(element) if element is not None else None
    return kind
