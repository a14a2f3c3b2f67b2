"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, MapType, StringType, VariantType

from tarn.session import cut_lineage

BROADCAST_BYTES = 64 << 20


def int_div(a: Column, b: Column | int) -> Column:
    """Whole-number quotient towards zero, exact for all of BIGINT."""
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b).cast("bigint"))


def small_side(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A metadata side made ready for a join: broadcast if its bytes are within the bound, else left to a shuffle join.

    The rows are materialised once, so measuring them does not compute them
    twice.  A value counts with the bytes of its text and 16 more.
    """
    stored = cut_lineage(df)
    width = F.lit(0)
    for f in df.schema.fields:
        value = F.col(f"`{f.name}`")
        text = F.octet_length(value if isinstance(f.dataType, (StringType, BinaryType)) else value.cast("string"))
        width = width + F.coalesce(text, F.lit(0)) + 16
    size = stored.agg(F.sum(width.cast("bigint"))).first()[0] or 0
    return F.broadcast(stored) if size <= max_bytes else stored


def listed_only(rows: DataFrame, listed: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join with a list of files, prepared so that the join prunes the scan of ``rows``.

    The range of the listed keys becomes a filter on both sides: on the rows it
    reaches the file reader, and on the list it lets Spark prune dynamically
    where ``key`` is a partition column of the stored table.
    """
    listed = small_side(listed)
    low, high = listed.agg(F.min(key), F.max(key)).first()
    inside = F.lit(False) if low is None else F.col(key).between(low, high)
    return rows.where(inside), listed.where(inside)


def tie_breaker(df: DataFrame) -> Column:
    """Hash of the whole row: as last term of a range partitioning it splits even rows of one sort value."""
    usable = [f.name for f in df.schema.fields if not isinstance(f.dataType, (MapType, VariantType))]
    return F.xxhash64(*usable)
