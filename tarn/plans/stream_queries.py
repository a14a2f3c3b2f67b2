"""Queries run as Structured Streaming jobs over the stored tables, read back as DataFrames."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarn.operators import delta as dt, windows as wn
from tarn.plans.event_queries import naive
from tarn.plans.registry import Tables, query
from tarn.plans.window_queries import VEHICLE_SQL, vehicle_events
from tarn.session import scratch
from tarn.sources.files import file_stream
from tarn.streaming import enrich as en, run, state as ss, tables as tb, windows as sw


def event_stream(t: Tables):
    """The events table as a file stream; a pattern, since a plain path would have to be a folder."""
    return file_stream(t.spark, t.path("event[s]"), t.events.schema)


@query("file_stream_parquet", "SELECT event_id, ts, user_id FROM events")
def file_stream_parquet(t: Tables):
    """A file stream copied to a file sink until all input is read."""
    base = scratch(t.spark, "stream")
    run.finish(run.to_files(event_stream(t).select("event_id", "ts", "user_id"), f"{base}/out", f"{base}/cp"))
    return t.spark.read.schema("event_id bigint, ts timestamp_ntz, user_id bigint").parquet(f"{base}/out")


@query("sink_append_parquet", "SELECT event_id, value, event_type FROM events")
def sink_append_parquet(t: Tables):
    base = scratch(t.spark, "stream")
    run.finish(run.to_files(event_stream(t).select("event_id", "value", "event_type"), f"{base}/out", f"{base}/cp", partition=["event_type"]))
    return t.spark.read.schema("event_id bigint, value double, event_type string").parquet(f"{base}/out")


CLOSED = "(SELECT max(ts) FROM events) - INTERVAL 10 SECOND"


@query("stream_tumble_min", f"""
SELECT event_type AS ticker, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, min(value) AS min_price
FROM events WHERE time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= {CLOSED} GROUP BY ALL""")
def stream_tumble_min(t: Tables):
    """Append mode: every window the watermark has closed."""
    base = scratch(t.spark, "stream")
    rows = event_stream(t).select("ts", F.col("event_type").alias("ticker"), "value")
    out = sw.windowed(rows, "ts", "10 seconds", "1 hour", ["ticker"], [F.min("value").alias("min_price")])
    run.finish(run.to_files(out, f"{base}/out", f"{base}/cp"))
    return naive(t.spark.read.schema(out.schema).parquet(f"{base}/out"), "window_start", "window_end")


@query("stream_slide_min", f"""
SELECT event_type AS ticker, w AS window_start, w + INTERVAL 1 HOUR AS window_end, min(value) AS min_price
FROM (SELECT event_type, value, time_bucket(INTERVAL 20 MINUTE, ts) - INTERVAL 20 MINUTE * i AS w FROM events, range(0, 3) r(i))
WHERE w + INTERVAL 1 HOUR <= {CLOSED} GROUP BY ALL""")
def stream_slide_min(t: Tables):
    base = scratch(t.spark, "stream")
    rows = event_stream(t).select("ts", F.col("event_type").alias("ticker"), "value")
    out = sw.windowed(rows, "ts", "10 seconds", "1 hour", ["ticker"], [F.min("value").alias("min_price")], slide="20 minutes")
    run.finish(run.to_files(out, f"{base}/out", f"{base}/cp"))
    return naive(t.spark.read.schema(out.schema).parquet(f"{base}/out"), "window_start", "window_end")


@query("stream_distinct_users", """
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, event_type AS platform, count(DISTINCT user_id) AS unique_users FROM events GROUP BY ALL""")
def stream_distinct_users(t: Tables):
    """Distinct users per window: duplicates are removed on the stream, rows counted on its output."""
    base = scratch(t.spark, "stream")
    rows = event_stream(t).select("ts", F.col("event_type").alias("platform"), "user_id")
    out = sw.distinct_then_count(rows, "ts", "10 minutes", "5 minutes", ["platform"], "user_id")
    run.finish(run.to_files(out, f"{base}/out", f"{base}/cp"))
    found = t.spark.read.schema(out.schema).parquet(f"{base}/out")
    return naive(found.groupBy("window_start", "platform").agg(F.count("*").alias("unique_users")), "window_start")


@query("stream_output_modes", """
SELECT 'append' AS mode, event_type, count(*) AS n FROM events GROUP BY ALL UNION ALL SELECT 'update', event_type, count(*) FROM events GROUP BY ALL
UNION ALL SELECT 'complete', event_type, count(*) FROM events GROUP BY ALL""")
def stream_output_modes(t: Tables):
    """Final state of the same counts written in each output mode."""
    base = scratch(t.spark, "stream")
    counts = event_stream(t).groupBy("event_type").agg(F.count("*").alias("n"))
    for mode in ("update", "complete"):
        run.finish(run.per_batch(counts, f"{base}/cp-{mode}", run.batch_files(f"{base}/{mode}"), mode))
    run.finish(run.to_files(event_stream(t).select("event_type"), f"{base}/append", f"{base}/cp-append"))
    schema = "event_type string, n bigint"
    label = lambda df, mode: df.select(F.lit(mode).alias("mode"), "event_type", "n")
    appended = t.spark.read.schema("event_type string").parquet(f"{base}/append").groupBy("event_type").agg(F.count("*").alias("n"))
    return (label(appended, "append").union(label(run.latest_state(t.spark, f"{base}/update", schema, ["event_type"]), "update"))
            .union(label(run.last_batch(t.spark, f"{base}/complete", schema), "complete")))


@query("stream_running_count", "SELECT event_type AS device_type, count(*) AS running_count FROM events GROUP BY 1")
def stream_running_count(t: Tables):
    base = scratch(t.spark, "stream")
    counts = tb.running_counts(event_stream(t).select(F.col("event_type").alias("device_type")), "device_type")
    run.finish(run.per_batch(counts, f"{base}/cp", run.batch_files(f"{base}/out"), "update"))
    return run.latest_state(t.spark, f"{base}/out", "device_type string, running_count bigint", ["device_type"])


@query("stream_value_state", """
SELECT event_type AS device_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS running_count FROM events""")
def stream_value_state(t: Tables):
    """A row per event with the count of its device so far, from a typed value state per device."""
    base = scratch(t.spark, "stream")
    counts = ss.numbered(event_stream(t).select(F.col("event_type").alias("device_type")), "device_type")
    with ss.state_on_disk(t.spark):
        run.finish(run.to_files(counts, f"{base}/out", f"{base}/cp"))
    return t.spark.read.schema("device_type string, running_count bigint").parquet(f"{base}/out")


@query("stream_vehicle_windows", VEHICLE_SQL + f" WHERE window_end <= {CLOSED}")
def stream_vehicle_windows(t: Tables):
    """Windows per vehicle that the watermark has closed, from sums kept in state until then."""
    base = scratch(t.spark, "stream")
    rows = vehicle_events(event_stream(t))
    out = ss.vehicle_windows(rows, "vin", "ts", "1 hour", "10 seconds", wn.vehicle_items("sensor_data", "warning_lights"))
    with ss.state_on_disk(t.spark):
        run.finish(run.to_files(out, f"{base}/out", f"{base}/cp"))
    found = t.spark.read.schema(out.schema).parquet(f"{base}/out")
    return naive(found.select("vin", "max_timestamp", F.explode("sensor_average").alias("sensor", "average"), "warning_count"), "max_timestamp")


@query("multi_sink", """
SELECT 'big' AS sink, event_id FROM events WHERE value > 50 UNION ALL SELECT 'errors', event_id FROM events WHERE event_type = 'error'""")
def multi_sink(t: Tables):
    """Two filtered sinks fed by one pass over each batch."""
    base = scratch(t.spark, "stream")
    sinks = [run.filtered(run.batch_files(f"{base}/big"), "value > 50"), run.filtered(run.batch_files(f"{base}/errors"), "event_type = 'error'")]
    run.finish(run.per_batch(event_stream(t).select("event_id", "event_type", "value"), f"{base}/cp", run.fan_out(sinks)))
    read = lambda name: t.spark.read.schema("event_id bigint").parquet(f"{base}/{name}").select(F.lit(name).alias("sink"), "event_id")
    return read("big").union(read("errors"))


@query("stream_dead_letters", """
SELECT CASE WHEN value < 20 THEN 'dead' ELSE 'main' END AS side, event_id FROM events""")
def stream_dead_letters(t: Tables):
    """Rows failing a check go to their own folder."""
    base = scratch(t.spark, "stream")
    tagged = event_stream(t).select("event_id", F.when(F.col("value") < 20, "dead").otherwise("main").alias("side"))
    run.finish(run.to_files(tagged, f"{base}/out", f"{base}/cp", partition=["side"]))
    return t.spark.read.schema("event_id bigint, side string").parquet(f"{base}/out").select("side", "event_id")


def change_feed(t: Tables):
    kind = F.when(F.col("event_type") == "error", "UPDATE_BEFORE").when(F.col("event_type") == "signup", "DELETE").otherwise("UPDATE_AFTER")
    return event_stream(t).select(F.col("user_id").alias("k"), F.col("value").alias("v"), "ts", "event_id", kind.alias("op"))


@query("stream_apply_cdc", """
SELECT k, v FROM (SELECT user_id AS k, value AS v, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS i FROM events WHERE event_type <> 'error')
WHERE i = 1 AND event_type <> 'signup'""")
def stream_apply_cdc(t: Tables):
    """A change stream applied to a bucketed keyed table."""
    base = scratch(t.spark, "stream")
    schema = StructType.fromDDL("k bigint, v double, ts timestamp_ntz, event_id bigint")
    run.finish(run.per_batch(change_feed(t), f"{base}/cp", tb.keyed_table_writer(f"{base}/table", ["k"], ["ts", "event_id"], schema, 8, "op")))
    return tb.read_keyed_table(t.spark, f"{base}/table", schema).select("k", "v")


@query("stream_upsert_delta", """
SELECT k, v FROM (SELECT user_id AS k, value AS v, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS i FROM events WHERE event_type <> 'error')
WHERE i = 1 AND event_type <> 'signup'""")
def stream_upsert_delta(t: Tables):
    """The same change stream written as rows and deletes, batch by batch, and read merged."""
    base = scratch(t.spark, "stream")
    schema = StructType.fromDDL("k bigint, v double")
    write = dt.upsert_writer(f"{base}/table", ["k"], ["ts", "event_id"], schema, "op")
    run.finish(run.per_batch(change_feed(t), f"{base}/cp", write))
    return dt.read_upserted(t.spark, f"{base}/table", schema, ["k"])


@query("late_drop", """
WITH a AS (SELECT event_id, ts, (event_id + (event_id % 7) * 400) // 1000 AS b FROM events),
m AS (SELECT b, max(ts) AS m FROM a GROUP BY 1), s AS (SELECT b, max(m) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM m)
SELECT event_id, ts FROM a JOIN s USING (b) WHERE seen IS NULL OR ts >= seen - INTERVAL 10 SECOND""")
def late_drop(t: Tables):
    """Rows kept when events arrive out of order in batches of about a thousand."""
    arrival = F.col("event_id") + (F.col("event_id") % 7) * 400
    return sw.drop_late(t.events.select("event_id", "ts"), arrival, 1000, "ts", 10)


def lookup(row: dict) -> dict | None:
    """Stand-in for a remote service: knows the answer for most users."""
    if row["user_id"] % 10 == 3:
        raise en.Unavailable("503")
    return {"score": float(row["user_id"] % 7)}


@query("async_enrich", """
SELECT event_id, user_id, CASE WHEN user_id % 10 = 3 THEN NULL ELSE (user_id % 7)::DOUBLE END AS score FROM events""")
def async_enrich(t: Tables):
    """Concurrent calls with retries; failing rows pass through unchanged."""
    rows = t.events.select("event_id", "user_id")
    return en.enrich(rows, lookup, "score double", fallback="passthrough", retries=1, delay=0.001, backoff=2.0, capacity=16)


@query("async_enrich_drop", "SELECT event_id, user_id, (user_id % 7)::DOUBLE AS score FROM events WHERE user_id % 10 <> 3")
def async_enrich_drop(t: Tables):
    rows = t.events.select("event_id", "user_id")
    return en.enrich(rows, lookup, "score double", fallback="drop", retries=1, delay=0.001, capacity=16)


@query("tumble_proc", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def tumble_proc(t: Tables):
    """Processing-time windows: the totals, as the windows depend on when it runs."""
    base = scratch(t.spark, "stream")
    out = sw.processing_windowed(event_stream(t), "10 seconds", ["event_type"], [F.count("*").alias("n"), F.sum("value").alias("s")])
    run.finish(run.per_batch(out, f"{base}/cp", run.batch_files(f"{base}/out"), "update"))
    state = run.latest_state(t.spark, f"{base}/out", "window_start timestamp, window_end timestamp, event_type string, n bigint, s double",
                             ["window_start", "window_end", "event_type"])
    return state.groupBy("event_type").agg(F.sum("n").alias("n"))


@query("slide_proc", "SELECT event_type, 5 * count(*) AS n FROM events GROUP BY 1")
def slide_proc(t: Tables):
    """Processing-time sliding windows: a row is in five of them, whenever it arrives."""
    base = scratch(t.spark, "stream")
    out = sw.processing_windowed(event_stream(t), "10 seconds", ["event_type"], [F.count("*").alias("n"), F.avg("value").alias("a")], slide="2 seconds")
    run.finish(run.per_batch(out, f"{base}/cp", run.batch_files(f"{base}/out"), "update"))
    state = run.latest_state(t.spark, f"{base}/out", "window_start timestamp, window_end timestamp, event_type string, n bigint, a double",
                             ["window_start", "window_end", "event_type"])
    return state.groupBy("event_type").agg(F.sum("n").alias("n"))


@query("observed_counts", "SELECT count(*) AS rows_seen, round(sum(value::DECIMAL(18,2))::DOUBLE, 2) AS value_sum FROM events")
def observed_counts(t: Tables):
    """Counters observed while the rows are written elsewhere, not by a second pass."""
    from pyspark.sql import Observation

    seen = Observation("events_seen")
    rows = t.events.observe(seen, F.count(F.lit(1)).alias("rows_seen"), F.sum(F.col("value").cast("decimal(18,2)")).alias("value_sum"))
    rows.write.parquet(scratch(t.spark, "observed"))
    counters = seen.get
    return t.spark.range(1).select(F.lit(counters["rows_seen"]).cast("bigint").alias("rows_seen"),
                                   F.round(F.lit(counters["value_sum"]).cast("double"), 2).alias("value_sum"))
