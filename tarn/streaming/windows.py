"""Watermarked window aggregations on streams, and what a watermark drops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tarn.util import int_div


def with_watermark(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Event time with bounded out-of-orderness; a zone-less column is read as UTC."""
    typed = df.withColumn(ts, F.col(ts).cast("timestamp")) if dict(df.dtypes)[ts] == "timestamp_ntz" else df
    return typed.withWatermark(ts, delay)


def windowed(df: DataFrame, ts: str, delay: str, size: str, keys: list[str], aggs: list[Column],
             slide: str | None = None) -> DataFrame:
    """Aggregates per key and event-time window, tumbling or sliding."""
    late = with_watermark(df, ts, delay)
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    return (late.groupBy(window.alias("_w"), *keys).agg(*aggs)
            .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "*").drop("_w"))


def processing_windowed(df: DataFrame, size: str, keys: list[str], aggs: list[Column], slide: str | None = None,
                        delay: str = "0 seconds") -> DataFrame:
    """The same by arrival time; results depend on when rows come, so they do not repeat."""
    return windowed(df.withColumn("_arrived", F.current_timestamp()), "_arrived", delay, size, keys, aggs, slide)


def distinct_then_count(df: DataFrame, ts: str, delay: str, size: str, keys: list[str], distinct: str) -> DataFrame:
    """First level of a distinct count on a stream: one row per window, key and value.

    Streams refuse distinct aggregates; removing duplicates first and counting
    rows downstream gives the same number.  A value is remembered until the
    watermark passes the end of its window, however short the delay.
    """
    late = with_watermark(df, ts, delay)
    return (late.select(F.window(ts, size).alias("_w"), *keys, distinct).dropDuplicates(["_w", *keys, distinct])
            .select(F.col("_w.start").alias("window_start"), *keys, distinct))


def drop_late(df: DataFrame, arrival: Column, batch_rows: int, ts: str, delay_seconds: int, lag: int = 0) -> DataFrame:
    """What a stream that reads fixed batches in arrival order keeps, as a batch computation.

    A row is late if its time is more than the delay behind the largest time of
    all earlier batches.  Structured Streaming judges lateness by the watermark
    of the batch before, which ``lag=1`` reproduces.  Batches are reduced to a
    row each before they are ordered.
    """
    rows = df.withColumn("_batch", int_div(arrival, batch_rows))
    maxima = rows.groupBy("_batch").agg(F.max(ts).alias("_max"))
    earlier = Window.orderBy("_batch").rowsBetween(Window.unboundedPreceding, -1 - lag)
    marks = maxima.select("_batch", F.max("_max").over(earlier).alias("_seen"))
    on_time = F.col("_seen").isNull() | (F.col(ts) >= F.col("_seen") - F.make_dt_interval(secs=F.lit(delay_seconds)))
    return rows.join(marks, "_batch").where(on_time).drop("_batch", "_seen")
