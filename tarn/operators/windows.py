"""Keyed window aggregations over event time, in batch form.

Hot keys are safe throughout: every aggregate here combines on the map side.
Sliding windows first aggregate panes as long as the slide and only then copy
each pane row into the windows covering it, so what is multiplied by
size/slide is one row per key and pane, not every event.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window, functions as F

from tarn.util import int_div

_UNITS = {"millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000,
          "day": 86_400_000_000}


def micros(duration: str) -> int:
    number, unit = re.fullmatch(r"\s*(\d+)\s+(\w+?)s?\s*", duration).groups()
    return int(number) * _UNITS[unit]


def tumbling(df: DataFrame, ts: str, size: str, keys: list[str], aggs: list[Column]) -> DataFrame:
    """Aggregates per key and tumbling window, with the window bounds as columns."""
    return (df.groupBy(F.window(ts, size).alias("_w"), *keys).agg(*aggs)
            .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "*").drop("_w"))


def sliding(df: DataFrame, ts: str, size: str, slide: str, keys: list[str],
            partial: list[Column], merge: list[Column]) -> DataFrame:
    """Aggregates per key and sliding window.

    ``partial`` are aliased aggregates of a pane, ``merge`` aliased aggregates
    over those aliases.  The size must be a multiple of the slide.
    """
    span, step = micros(size), micros(slide)
    if span % step:
        raise ValueError("window size must be a multiple of the slide")
    panes = df.groupBy(F.window(ts, slide).alias("_p"), *keys).agg(*partial)
    shifts = F.explode(F.sequence(F.lit(0), F.lit(span // step - 1)))
    start = F.col("_p.start") - F.make_dt_interval(secs=F.lit(step / 1e6)) * F.col("_i")
    return (panes.withColumn("_i", shifts).withColumn("window_start", start).drop("_i", "_p")
            .groupBy("window_start", *keys).agg(*merge)
            .withColumn("window_end", F.col("window_start") + F.make_dt_interval(secs=F.lit(span / 1e6))))


def min_ignoring_nan(col: Column) -> Column:
    """Smallest value, NaN only where there is nothing else: NaN sorts above all numbers."""
    return F.min(col)


def session_summary(df: DataFrame, keys: list[str], ts: str, lists: dict[str, str]) -> DataFrame:
    """First time, event count and sorted distinct lists per session.

    Values are made distinct in a first aggregate, so a session of any size
    brings only its distinct combinations to the second one.
    """
    columns = list(lists)
    distinct = df.groupBy(*keys, *columns).agg(F.min(ts).alias("_first"), F.count("*").alias("_n"))
    joined = [F.array_join(F.array_sort(F.collect_set(F.col(c).cast("string"))), ",").alias(lists[c]) for c in columns]
    return distinct.groupBy(*keys).agg(F.min("_first").alias("session_start"), F.sum("_n").alias("event_count"), *joined)


def running(df: DataFrame, keys: list[str], order: list[str], chunk: Column, value: Column, name: str) -> DataFrame:
    """Running sum per key in order, safe for keys of any size.

    ``chunk`` must grow with the order columns (an hour of the time column, an
    id divided by a constant).  Sums run inside (key, chunk) groups; one total
    row per group gives the offset of each chunk.
    """
    rows = df.withColumns({"_chunk": chunk, "_value": value})
    totals = rows.groupBy(*keys, "_chunk").agg(F.sum("_value").alias("_total"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "_chunk", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("_local", F.sum("_value").over(inside))
    on = [local[k].eqNullSafe(offsets[k]) for k in [*keys, "_chunk"]]
    joined = local.join(offsets, on, "left").select(local["*"], (F.col("_local") + F.col("_offset")).alias(name))
    return joined.drop("_chunk", "_value", "_local")


def decayed_average(df: DataFrame, keys: list[str], order: list[str], chunk: Column, value: str, decay: float,
                    name: str = "decayed_average") -> DataFrame:
    """Final value per key of avg = avg * (1 - decay) + value * decay, starting from 0.

    The recursion is linear, so a chunk folds to its own average and its
    length: each event weighs decay * (1 - decay)^(events after it).
    """
    keep = F.lit(1.0 - decay)
    rows = df.withColumn("_chunk", chunk)
    later = Window.partitionBy(*keys, "_chunk").orderBy(*[F.col(c).desc() for c in order])
    chunks = (rows.withColumn("_after", F.row_number().over(later) - 1)
              .groupBy(*keys, "_chunk")
              .agg(F.sum(F.col(value) * decay * F.pow(keep, "_after")).alias("_avg"), F.count("*").alias("_n")))
    following = Window.partitionBy(*keys).orderBy(F.col("_chunk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    return (chunks.withColumn("_rest", F.coalesce(F.sum("_n").over(following), F.lit(0)))
            .groupBy(*keys).agg(F.sum(F.col("_avg") * F.pow(keep, "_rest")).alias(name),
                                F.sum("_n").alias("event_count")))


def vehicle_items(sensors: str, warnings: str) -> Column:
    """The parts of an event as tagged items to sum: the event itself, its sensor readings and its distinct warnings."""
    item = lambda kind, name, n: F.struct(F.lit(kind).alias("kind"), name.alias("name"), n.alias("n"))
    some = lambda found: F.coalesce(found, F.array().cast("array<struct<kind:string,name:string,n:bigint>>"))
    return F.concat(
        F.array(item("event", F.lit(None).cast("string"), F.lit(1).cast("bigint"))),
        some(F.transform(F.map_entries(sensors), lambda e: item("sensor", e["key"], e["value"].cast("bigint")))),
        some(F.transform(F.array_distinct(warnings), lambda w: item("warning", w, F.lit(1).cast("bigint")))))


def vehicle_windows(df: DataFrame, vin: str, ts: str, size: str, sensors: str, warnings: str) -> DataFrame:
    """Per vehicle and window: integer sensor averages, distinct warnings, last millisecond of the window.

    A sensor's sum is divided by the number of events, not of its own readings;
    an event without sensors or warnings counts too.
    Events, sensor readings and warnings go through one scan as tagged items and
    are summed per item before anything is put together per vehicle.
    """
    items = vehicle_items(sensors, warnings)
    sums = (df.select(vin, F.window(ts, size).end.alias("window_end"), F.explode(items).alias("_i"))
            .groupBy(vin, "window_end", "_i.kind", "_i.name").agg(F.sum("_i.n").alias("n")))
    of = lambda kind, then: F.when(F.col("kind") == kind, then)
    whole = sums.groupBy(vin, "window_end").agg(
        F.max(of("event", F.col("n"))).alias("_events"),
        F.collect_list(of("sensor", F.struct("name", "n"))).alias("_sensors"),
        F.count(of("warning", F.lit(1))).alias("warning_count"))
    average = F.map_from_entries(F.transform(
        "_sensors", lambda s: F.struct(s["name"], int_div(s["n"], F.col("_events")))))
    return whole.select(vin, F.col("window_end"),
                        (F.col("window_end") - F.expr("interval 1 millisecond")).alias("max_timestamp"),
                        average.alias("sensor_average"), "warning_count")
