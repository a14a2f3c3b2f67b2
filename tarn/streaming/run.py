"""Running streams: to completion over what is there, into files or per batch.

Sinks written by ``foreachBatch`` are keyed by batch id: a batch run again
after a failure replaces its own output, which makes the result exactly-once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

AVAILABLE_NOW = {"availableNow": True}


def to_files(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", partition: list[str] = (),
             trigger: dict | None = None):
    """Append rows to files, exactly once by checkpoint and the sink's own log."""
    writer = (stream.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
              .trigger(**(trigger or AVAILABLE_NOW)))
    return (writer.partitionBy(*partition) if partition else writer).start(path)


def per_batch(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], mode: str = "append",
              trigger: dict | None = None):
    return (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or AVAILABLE_NOW)).foreachBatch(write).start())


def batch_files(path: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """Batch writer into ``batch_id=<n>`` folders, each replaced as a whole when its batch is run again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format(fmt).mode("overwrite").save(f"{path}/batch_id={batch_id}")

    return write


def latest_state(spark: SparkSession, path: str, schema: str, keys: list[str]) -> DataFrame:
    """Current value per key of an update-mode stream written by :func:`batch_files`."""
    rows = spark.read.schema(f"{schema}, batch_id bigint").parquet(path)
    values = [c for c in rows.columns if c not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_v"))
    return newest.select(*keys, *[f"_v.{c}" for c in values if c != "batch_id"])


def last_batch(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Output of the newest batch, the whole result of a complete-mode stream."""
    rows = spark.read.schema(f"{schema}, batch_id bigint").parquet(path)
    newest = rows.agg(F.max("batch_id")).scalar()
    return rows.where(F.col("batch_id") == newest).drop("batch_id")


def fan_out(sinks: list[Callable[[DataFrame, int], None]]) -> Callable[[DataFrame, int], None]:
    """One pass over a batch into several sinks."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def filtered(sink: Callable[[DataFrame, int], None], condition: str) -> Callable[[DataFrame, int], None]:
    return lambda batch, batch_id: sink(batch.where(condition), batch_id)


def finish(query) -> None:
    """Wait for a stream over finite input and raise what made it fail."""
    try:
        query.awaitTermination()
    finally:
        query.stop()
