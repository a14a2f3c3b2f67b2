"""Ordered scans per key with a small running state."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType


def scan_in_order(df: DataFrame, keys: list[str], order: list[str], inputs: list[str], outputs: str,
                  new_step: Callable[[], Callable[..., tuple]]) -> DataFrame:
    """Add columns that depend on the earlier rows of the same key.

    Spark shuffles by key and sorts; a task then streams its rows in Arrow
    batches and keeps only the step's state of the current key, so a key of any
    size costs memory for one batch.  Meant for metadata (a row per file or per
    commit); ``new_step()`` gives a fresh ``step(*inputs) -> outputs`` per key.
    """
    added = StructType.fromDDL(outputs)
    schema = StructType([*df.schema.fields, *added.fields])
    group = F.to_json(F.struct(*keys)) if keys else F.lit("")
    placed = df.withColumn("_group", group).repartition("_group").sortWithinPartitions("_group", *order)
    kept, types = df.columns, [to_arrow_type(f.dataType) for f in added.fields]

    def run(batches):
        current, step = None, None
        for batch in batches:
            made = []
            for row in zip(*(batch.column(c).to_pylist() for c in ("_group", *inputs))):
                if row[0] != current:
                    current, step = row[0], new_step()
                made.append(step(*row[1:]))
            new = [pa.array(values, kind) for values, kind in zip(zip(*made), types)] if made else [pa.array([], k) for k in types]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *new], names=schema.names)

    return placed.mapInArrow(run, schema)


def pack(df: DataFrame, keys: list[str], order: list[str], weight: str, target: int, lookback: int = 1,
         largest_first: bool = False, name: str = "bin") -> DataFrame:
    """Number of the bin each item goes to, filling bins up to a target weight in order.

    An item goes to the first open bin with room, else opens a new one; beyond
    ``lookback`` open bins the oldest (or the heaviest) is closed.
    """

    def new_step():
        open_bins: list[list[int]] = []  # [number, weight]
        count = 0

        def step(w):
            nonlocal count
            w = int(w)
            for entry in open_bins:
                if entry[1] + w <= target:
                    entry[1] += w
                    return (entry[0],)
            open_bins.append([count, w])
            count += 1
            if len(open_bins) > lookback:
                open_bins.remove(max(open_bins, key=lambda b: b[1]) if largest_first else open_bins[0])
            return (count - 1,)

        return step

    return scan_in_order(df, keys, order, [weight], f"{name} bigint", new_step)
