"""Schema evolution rules on StructType, and writing under a merged schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, FloatType, IntegerType, LongType, StructField, StructType


def evolve_schema(current: StructType, incoming: StructType) -> StructType:
    """Current schema changed so the incoming records fit.

    New columns are appended as optional, a column missing from or nullable in
    the records becomes optional, int widens to long and float to double;
    nothing else changes type.
    """
    arriving = {f.name: f for f in incoming.fields}
    fields = []
    for f in current.fields:
        other = arriving.get(f.name)
        kind, nullable = f.dataType, f.nullable or other is None or other.nullable
        if other is not None:
            if isinstance(kind, IntegerType) and isinstance(other.dataType, LongType):
                kind = other.dataType
            elif isinstance(kind, FloatType) and isinstance(other.dataType, DoubleType):
                kind = other.dataType
            elif isinstance(kind, StructType) and isinstance(other.dataType, StructType):
                kind = evolve_schema(kind, other.dataType)
        fields.append(StructField(f.name, kind, nullable, f.metadata))
    have = {f.name for f in current.fields}
    fields += [StructField(f.name, f.dataType, True) for f in incoming.fields if f.name not in have]
    return StructType(fields)


def check_write(table: StructType, rows: StructType, ordering: bool = False, nullability: bool = True) -> None:
    """Refuse rows with NULLs for required columns or, where asked, columns in another order."""
    arriving = {f.name: f for f in rows.fields}
    for f in table.fields:
        other = arriving.get(f.name)
        if nullability and not f.nullable and (other is None or other.nullable):
            raise ValueError(f"column {f.name} is required but the rows may lack it")
    if ordering:
        shared = [f.name for f in rows.fields if f.name in {t.name for t in table.fields}]
        if shared != [f.name for f in table.fields if f.name in arriving]:
            raise ValueError("columns are out of order")


def merge_schema(target: DataFrame, rows: DataFrame, ordering: bool = False) -> DataFrame:
    """Union by name under the evolved schema, for a write that may add columns."""
    check_write(target.schema, rows.schema, ordering, nullability=False)
    merged = evolve_schema(target.schema, rows.schema)
    fit = lambda df: df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in merged.fields if f.name in df.columns])
    return fit(target).unionByName(fit(rows), allowMissingColumns=True)
