"""Operators with state per key: a value of their own, and windows that are put out once they close."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tarn.streaming.windows import with_watermark

_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.statefulOperator.allowMultiple": "false",
}


@contextmanager
def state_on_disk(spark: SparkSession):
    """Start streams with state in RocksDB, which stateful processors need, and one operator with state, which judges
    lateness by the watermark of its batch; other streams keep their settings."""
    before = {name: spark.conf.get(name) for name in _ON_DISK}
    for name, value in _ON_DISK.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


class RunningCount(StatefulProcessor):
    """Numbers the rows of each key from 1 on; the state is the last number."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "n bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n = self.count.get()[0] if self.count.exists() else 0
        for batch in rows:
            yield pd.DataFrame({"key": key[0], "running_count": range(n + 1, n + len(batch) + 1)})
            n += len(batch)
        self.count.update((n,))

    def close(self) -> None:
        pass


def numbered(stream: DataFrame, key: str) -> DataFrame:
    """(key, running_count): a row per row of the stream with the number of rows of its key so far.

    The state is one number per key.  The rows of a key meet it one after the
    other, in one task; where only the latest count matters,
    ``tables.running_counts`` combines before the shuffle.
    """
    kind = stream.schema[key].dataType.simpleString()
    return (stream.select(F.col(key).alias("key")).groupBy("key")
            .transformWithStateInPandas(RunningCount(), f"key {kind}, running_count bigint", "append", "none")
            .withColumnRenamed("key", key))


KINDS = ("event", "sensor", "warning")
_CLOSED_AT_ONCE = 20000


def _whole_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (vin, window_end, average, warning_count) from the sums of whole windows; each window has one sum of events."""
    parts = []
    for batch in batches:
        kind = pc.index_in(batch.column("kind"), pa.array(KINDS))
        parts.append(pa.table([batch.column("vin"), batch.column("window_end"), kind, batch.column("name").dictionary_encode(), batch.column("n")],
                              ["vin", "window_end", "kind", "name", "n"]))
    if not parts:
        return
    sums = pa.concat_tables(parts).unify_dictionaries()
    parts.clear()
    sums = sums.sort_by([("vin", "ascending"), ("window_end", "ascending"), ("kind", "ascending")]).combine_chunks()
    kind = sums["kind"].to_numpy()
    starts = np.flatnonzero(kind == 0)
    group = np.cumsum(kind == 0) - 1
    sensors, warned = np.flatnonzero(kind == 1), kind == 2
    total = sums["n"].combine_chunks()
    events = total.take(pa.array(starts)).to_numpy(zero_copy_only=False)
    read = total.take(pa.array(sensors))
    n, by = read.fill_null(0).to_numpy(zero_copy_only=False), events[group[sensors]]
    average = n // by
    average += (n < 0) & (average * by != n)  # towards zero
    offsets = np.concatenate([[0], np.cumsum(np.bincount(group[sensors], minlength=len(starts)))]).astype(np.int32)
    names = sums["name"].combine_chunks().take(pa.array(sensors)).cast(pa.string())
    averages = pa.MapArray.from_arrays(pa.array(offsets), names, pa.array(average, mask=np.asarray(read.is_null())))
    counts = np.bincount(group[warned], minlength=len(starts)).astype(np.int64)
    first = sums.select(["vin", "window_end"]).take(pa.array(starts)).combine_chunks()
    rows = pa.table([first["vin"], first["window_end"], averages, pa.array(counts)], ["vin", "window_end", "sensor_average", "warning_count"])
    yield from rows.to_batches(max_chunksize=_CLOSED_AT_ONCE)


def vehicle_windows(stream: DataFrame, vin: str, ts: str, size: str, delay: str, items: Column) -> DataFrame:
    """The rows of ``operators.windows.vehicle_windows``, each once, when its window closes.

    State is a sum per vehicle, window, sensor and warning, not the events, kept
    by a windowed aggregate; the watermark puts out all sums of a window in one
    batch, and a task puts those of its vehicles together, in memory of some 50 bytes a sum
    (``spark.sql.shuffle.partitions`` says among how many tasks).  An event whose window the watermark has passed is late
    and dropped: started by :func:`state_on_disk` by the watermark of its own batch, else, as Spark has it, of the batch before.
    """
    late = with_watermark(stream.select(F.col(vin).alias("vin"), F.col(ts).alias("ts"), items.alias("_items")), "ts", delay)
    flat = late.select("vin", "ts", F.explode("_items").alias("_i")).select("vin", "ts", "_i.*")
    sums = (flat.groupBy(F.window("ts", size).alias("_w"), "vin", "kind", "name").agg(F.sum("n").alias("n"))
            .select("vin", F.col("_w.end").alias("window_end"), "kind", "name", "n"))
    kind = stream.schema[vin].dataType.simpleString()
    closed = sums.repartition("vin", "window_end").mapInArrow(
        _whole_windows, f"vin {kind}, window_end timestamp, sensor_average map<string,bigint>, warning_count bigint")
    return closed.select(F.col("vin").alias(vin), "window_end", (F.col("window_end") - F.expr("interval 1 millisecond")).alias("max_timestamp"),
                         "sensor_average", "warning_count")
