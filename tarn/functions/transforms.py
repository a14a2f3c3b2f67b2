"""Partition transforms as Columns, their display form and predicate projection.

Every transform is a plain Column expression, so Catalyst can push, fold and
generate code for it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.types import BinaryType

from tarn.functions.murmur import ZERO_FIRST, hash_bytes, hash_word, sql_hash_bytes

_MAX_INT = 0x7FFFFFFF


def _unscaled_bytes(col: Column, precision: int, scale: int) -> Column:
    """Shortest two's-complement bytes, high byte first, of a decimal's unscaled value."""
    if precision > 18:
        return _wide_unscaled_bytes(col)
    unscaled = (col * F.lit(10**scale).cast(f"decimal({scale + 1},0)")).cast("bigint")
    text = F.hex(unscaled)
    even = F.when(F.length(text) % 2 == 1, F.concat(F.lit("0"), text)).otherwise(text)
    positive = F.when(F.substring(even, 1, 1) >= "8", F.concat(F.lit("00"), even)).otherwise(even)
    negative = F.regexp_replace(text, "^(FF)+(?=[89A-F])", "")
    return F.unhex(F.when(unscaled < 0, negative).otherwise(positive))


@F.arrow_udf(BinaryType())
def _wide_unscaled_bytes(values: pa.Array) -> pa.Array:
    def encode(value):
        sign, digits, _ = value.as_tuple()
        unscaled = int("".join(map(str, digits)) or "0") * (-1 if sign else 1)
        magnitude = unscaled if unscaled >= 0 else ~unscaled
        return unscaled.to_bytes(magnitude.bit_length() // 8 + 1, "big", signed=True)

    return pa.array([None if v is None else encode(v) for v in values.to_pylist()], pa.binary())


def _base(data_type: str) -> str:
    return re.split(r"[(<]", data_type.strip().lower())[0]


def bucket_hash(col: Column, data_type: str) -> Column:
    """32-bit murmur3 with seed 0 of the single-value byte form; NULL stays NULL."""
    kind = _base(data_type)
    if kind in ("string", "varchar", "char"):
        return hash_bytes(col.cast("binary"))
    if kind == "binary":
        return hash_bytes(col)
    if kind == "uuid":  # as text; its 16 bytes are whole words
        return F.when(col.isNotNull(), hash_word(F.unhex(F.replace(col, F.lit("-")))))
    if kind == "decimal":
        precision, scale = map(int, re.findall(r"\d+", data_type))
        return hash_bytes(_unscaled_bytes(col, precision, scale))
    if kind in ("tinyint", "smallint", "int", "bigint"):
        eight_bytes = col.cast("bigint")
    elif kind == "date":
        eight_bytes = F.unix_date(col).cast("bigint")
    elif kind in ("timestamp", "timestamp_ntz"):
        eight_bytes = col
    elif kind in ("float", "double"):
        eight_bytes = col.cast("double")
    else:
        raise ValueError(f"cannot bucket {data_type}")
    return F.when(col.isNotNull(), hash_word(eight_bytes))


def bucket(n: int, col: Column, data_type: str = "bigint") -> Column:
    if n <= 0:
        raise ValueError("number of buckets must be positive")
    return bucket_hash(col, data_type).bitwiseAND(F.lit(_MAX_INT)) % F.lit(n)


def truncate(width: int, col: Column, data_type: str = "bigint") -> Column:
    """Round down to a multiple of the width; strings by code points, binary by bytes."""
    if width <= 0:
        raise ValueError("truncate width must be positive")
    kind = _base(data_type)
    if kind in ("string", "binary"):
        return F.substring(col, 1, width)
    if kind == "decimal":
        precision, scale = map(int, re.findall(r"\d+", data_type))
        unscaled = (col * F.lit(10**scale).cast(f"decimal({scale + 1},0)")).cast("decimal(38,0)")
        down = unscaled - F.pmod(unscaled, F.lit(width).cast("decimal(38,0)"))
        return (down / F.lit(10**scale).cast(f"decimal({scale + 1},0)")).cast(f"decimal({precision},{scale})")
    return (col - F.pmod(col, F.lit(width).cast(kind))).cast(kind)


def years(col: Column) -> Column:
    return F.year(col) - 1970


def months(col: Column) -> Column:
    return (F.year(col) - 1970) * 12 + F.month(col) - 1


def days(col: Column) -> Column:
    return F.unix_date(F.to_date(col))


def hours(col: Column) -> Column:
    return F.unix_date(F.to_date(col)) * 24 + F.hour(col)


def void(data_type: str) -> Column:
    return F.lit(None).cast(data_type)


def human(unit: str, ordinal: Column) -> Column:
    """Readable form of a time ordinal: 2017, 2017-11, 2017-11-16, 2017-11-16-22."""
    if unit == "year":
        return F.format_string("%04d", ordinal + 1970)
    if unit == "month":
        return F.format_string("%04d-%02d", (F.floor(ordinal / 12) + 1970).cast("int"), F.pmod(ordinal, F.lit(12)) + 1)
    if unit == "day":
        return F.date_from_unix_date(ordinal).cast("string")
    if unit == "hour":
        day = F.date_from_unix_date(F.floor(ordinal / 24).cast("int")).cast("string")
        return F.concat_ws("-", day, F.format_string("%02d", F.pmod(ordinal, F.lit(24))))
    raise ValueError(f"unknown unit {unit}")


_TIME_UNITS = {"year": years, "month": months, "day": days, "hour": hours}
_COARSENESS = {"hour": 0, "day": 1, "month": 2, "year": 3}


@dataclass(frozen=True)
class PartitionField:
    """One field of a partition layout: source column, transform and optional argument."""

    source: str
    transform: str = "identity"
    arg: int | None = None
    data_type: str = "bigint"

    @property
    def name(self) -> str:
        return self.source if self.transform == "identity" else f"{self.source}_{self.transform}"

    def value(self, col: Column) -> Column:
        if self.transform == "identity":
            return col
        if self.transform == "void":
            return void(self.data_type)
        if self.transform == "bucket":
            return bucket(self.arg, col, self.data_type)
        if self.transform == "truncate":
            return truncate(self.arg, col, self.data_type)
        return _TIME_UNITS[self.transform](col)

    def column(self) -> Column:
        return self.value(F.col(self.source)).alias(self.name)

    def satisfies(self, other: "PartitionField") -> bool:
        """Whether rows ordered by this field are also ordered by the other one."""
        if self.source != other.source:
            return False
        if self == other:
            return True
        if self.transform == "identity":
            return other.transform in _COARSENESS or other.transform == "truncate"
        if self.transform in _COARSENESS and other.transform in _COARSENESS:
            return _COARSENESS[self.transform] <= _COARSENESS[other.transform]
        if self.transform == other.transform == "truncate" and self.data_type in ("string", "binary"):
            return self.arg >= other.arg
        return False


def _step(data_type: str) -> Column | None:
    kind = _base(data_type)
    if kind in ("timestamp", "timestamp_ntz"):
        return F.expr("interval 1 microsecond")
    if kind == "date":
        return F.expr("interval 1 day")
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.lit(1)
    if kind == "decimal":
        _, scale = map(int, re.findall(r"\d+", data_type))
        return F.lit(f"1e-{scale}").cast(data_type)
    return None


def _compare(op: str, left: Column, right) -> Column:
    return {
        "<": lambda: left < right, "<=": lambda: left <= right,
        ">": lambda: left > right, ">=": lambda: left >= right,
        "=": lambda: left == right, "!=": lambda: left != right,
    }[op]()


def project_inclusive(field: PartitionField, op: str, value, part: Column | None = None) -> Column:
    """Predicate on the partition column true for every partition that may hold a match."""
    part = F.col(field.name) if part is None else part
    if op == "is_null":
        return part.isNull() if field.transform != "void" else F.lit(True)
    if op == "not_null":
        return part.isNotNull() if field.transform != "void" else F.lit(True)
    if field.transform == "void":
        return F.lit(True)
    if op == "in":
        return part.isin([v for v in value]) if field.transform == "identity" else \
            _any_of([part == field.value(F.lit(v)) for v in value])
    if op in ("starts_with", "not_starts_with"):
        return _prefix_projection(field, op, value, part, inclusive=True)
    lit = F.lit(value)
    if field.transform == "identity":
        return _compare(op, part, lit)
    if field.transform == "bucket":
        return part == field.value(lit) if op == "=" else F.lit(True)
    if op == "!=":
        return F.lit(True)
    step = _step(field.data_type)
    if step is None:
        return _compare({"<": "<=", ">": ">="}.get(op, op), part, field.value(lit))
    if op == "<":
        return part <= field.value((lit - step))
    if op == ">":
        return part >= field.value((lit + step))
    return _compare(op, part, field.value(lit))


def project_strict(field: PartitionField, op: str, value, part: Column | None = None) -> Column:
    """Predicate on the partition column true only where every row of it matches."""
    part = F.col(field.name) if part is None else part
    if field.transform == "void":
        return F.lit(False)
    if op == "is_null":
        return part.isNull()
    if op == "not_null":
        return part.isNotNull()
    if op in ("starts_with", "not_starts_with"):
        return _prefix_projection(field, op, value, part, inclusive=False)
    if field.transform == "identity":
        return part.isin(list(value)) if op == "in" else _compare(op, part, F.lit(value))
    if op == "in":
        return F.lit(False)
    lit = F.lit(value)
    if op == "!=":
        return part != field.value(lit)
    if field.transform == "bucket" or op == "=":
        return F.lit(False)
    step = _step(field.data_type)
    if op == "<":
        return part < field.value(lit)
    if op == ">":
        return part > field.value(lit)
    if step is None:
        return _compare({"<=": "<", ">=": ">"}[op], part, field.value(lit))
    if op == "<=":
        return part < field.value(lit + step)
    return part > field.value(lit - step)


def _prefix_projection(field: PartitionField, op: str, prefix: str, part: Column, inclusive: bool) -> Column:
    """A prefix no longer than the partition value is decided by it; of a longer one only its head is known."""
    if field.transform not in ("identity", "truncate"):
        return F.lit(inclusive)
    positive = op == "starts_with"
    if field.transform == "identity" or len(prefix) <= field.arg:
        known = part.startswith(prefix)
        return known if positive else ~known
    head = part == prefix[: field.arg]
    if positive:
        return head if inclusive else F.lit(False)
    return F.lit(True) if inclusive else ~head


def _any_of(terms: list[Column]) -> Column:
    out = F.lit(False)
    for term in terms:
        out = out | term
    return out


_SQL_FUNCTIONS = {
    "bucket(n INT, v BIGINT) RETURNS INT":
        "CASE WHEN v IS NOT NULL THEN (hash({zero}, v) & 2147483647) % n END",
    "bucket_date(n INT, v DATE) RETURNS INT":
        "CASE WHEN v IS NOT NULL THEN (hash({zero}, CAST(unix_date(v) AS BIGINT)) & 2147483647) % n END",
    "bucket_timestamp(n INT, v TIMESTAMP_NTZ) RETURNS INT":
        "CASE WHEN v IS NOT NULL THEN (hash({zero}, v) & 2147483647) % n END",
    "bucket_string(n INT, v STRING) RETURNS INT":
        "CASE WHEN v IS NOT NULL THEN CAST(({bytes_of_text} & 2147483647) % n AS INT) END",
    "bucket_binary(n INT, v BINARY) RETURNS INT":
        "CASE WHEN v IS NOT NULL THEN CAST(({bytes} & 2147483647) % n AS INT) END",
    "bucket_uuid(n INT, v STRING) RETURNS INT":
        "CASE WHEN v IS NOT NULL THEN (hash({zero}, unhex(replace(v, '-', ''))) & 2147483647) % n END",
    "bucket_decimal(n INT, unscaled BIGINT) RETURNS INT":
        "CASE WHEN unscaled IS NOT NULL THEN CAST(({bytes_of_number} & 2147483647) % n AS INT) END",
    "truncate(w BIGINT, v BIGINT) RETURNS BIGINT": "v - pmod(v, w)",
    "truncate_string(w INT, v STRING) RETURNS STRING": "substring(v, 1, w)",
    "truncate_binary(w INT, v BINARY) RETURNS BINARY": "substring(v, 1, w)",
    "truncate_decimal(w BIGINT, unscaled BIGINT) RETURNS BIGINT": "unscaled - pmod(unscaled, w)",
    "years(v TIMESTAMP_NTZ) RETURNS INT": "year(v) - 1970",
    "months(v TIMESTAMP_NTZ) RETURNS INT": "(year(v) - 1970) * 12 + month(v) - 1",
    "days(v TIMESTAMP_NTZ) RETURNS INT": "unix_date(CAST(v AS DATE))",
    "hours(v TIMESTAMP_NTZ) RETURNS INT": "unix_date(CAST(v AS DATE)) * 24 + hour(v)",
}


def register_sql_functions(spark, prefix: str = "tarn_") -> None:
    """Make the transforms callable from SQL text.

    They are SQL functions, which the optimizer puts in line like any expression.
    Decimals go in as their unscaled number, whatever their scale.
    """
    # Shortest two's-complement bytes: pairs of hex digits, without sign bytes that the next byte repeats.
    digits = ("CASE WHEN unscaled < 0 THEN regexp_replace(hex(unscaled), '^(FF)+(?=[89A-F])', '') "
              "ELSE regexp_replace(concat('00', right(concat('0', hex(unscaled)), 2 * ((length(hex(unscaled)) + 1) div 2))), '^00(?=[0-7])', '') END")
    parts = {"zero": ZERO_FIRST, "bytes": sql_hash_bytes("v"), "bytes_of_text": sql_hash_bytes("CAST(v AS BINARY)"),
             "bytes_of_number": sql_hash_bytes(f"unhex({digits})")}
    for head, body in _SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{head} RETURN {body.format(**parts)}")
