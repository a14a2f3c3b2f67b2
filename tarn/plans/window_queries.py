"""Queries over windows, sessions and running aggregates, in batch form."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarn.operators import windows as wn
from tarn.plans.registry import Tables, query


@query("bid_events_aggregated", """
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end,
       event_type AS platform, count(*) AS event_count, count(DISTINCT user_id) AS unique_users,
       count(DISTINCT props) AS unique_sessions FROM events GROUP BY ALL""")
def bid_events_aggregated(t: Tables):
    bids = t.events.select("ts", F.col("event_type").alias("platform"), "user_id", F.col("props").alias("session_id"))
    return wn.tumbling(bids, "ts", "5 minutes", ["platform"], [
        F.count("*").alias("event_count"), F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("session_id").alias("unique_sessions")])


@query("session_analytics", """
SELECT props AS session_id, user_id, min(ts) AS session_start, count(*) AS event_count,
       string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS platforms,
       string_agg(DISTINCT (event_id % 10 + 1)::VARCHAR, ',' ORDER BY (event_id % 10 + 1)::VARCHAR) AS cities
FROM events GROUP BY props, user_id""")
def session_analytics(t: Tables):
    rows = t.events.select(F.col("props").alias("session_id"), "user_id", "ts", F.col("event_type").alias("platform"),
                           (F.col("event_id") % 10 + 1).alias("city_id"))
    return wn.session_summary(rows, ["session_id", "user_id"], "ts", {"platform": "platforms", "city_id": "cities"})


@query("running_count", """
SELECT event_id, event_type AS device_type, count(*) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS running_count FROM events""")
def running_count(t: Tables):
    rows = t.events.select("event_id", F.col("event_type").alias("device_type"), "ts")
    minute = F.date_trunc("minute", F.col("ts").cast("timestamp"))
    return wn.running(rows, ["device_type"], ["ts", "event_id"], minute, F.lit(1), "running_count").drop("ts")


VEHICLE_SQL = """
WITH e AS (SELECT *, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
counts AS (SELECT user_id, window_end, count(*) AS n,
   count(DISTINCT event_type) + count(DISTINCT CASE WHEN value > 100 THEN 1 END) AS warning_count FROM e GROUP BY ALL),
readings AS (SELECT user_id, window_end, 'k' AS sensor, k AS v FROM e UNION ALL
   SELECT user_id, window_end, 'cents', CAST(round(value * 100) AS BIGINT) FROM e WHERE event_id % 2 = 0),
sums AS (SELECT user_id, window_end, sensor, sum(v)::BIGINT AS s FROM readings GROUP BY ALL)
SELECT user_id AS vin, window_end - INTERVAL 1 MILLISECOND AS max_timestamp, sensor, s // n AS average, warning_count
FROM sums JOIN counts USING (user_id, window_end)"""


def vehicle_events(events):
    """Events as vehicle reports: sensor readings and warning lights."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    cents = F.round(F.col("value") * 100).cast("bigint")
    sensors = F.when(F.col("event_id") % 2 == 0, F.create_map(F.lit("k"), k, F.lit("cents"), cents)).otherwise(
        F.create_map(F.lit("k"), k))
    lights = F.array_compact(F.array(F.col("event_type"), F.when(F.col("value") > 100, F.lit("hot"))))
    return events.select(F.col("user_id").alias("vin"), "ts", sensors.alias("sensor_data"), lights.alias("warning_lights"))


@query("vehicle_window_agg", VEHICLE_SQL)
def vehicle_window_agg(t: Tables):
    out = wn.vehicle_windows(vehicle_events(t.events), "vin", "ts", "1 hour", "sensor_data", "warning_lights")
    return out.select("vin", "max_timestamp", F.explode("sensor_average").alias("sensor", "average"), "warning_count")


@query("win_min_tumble", """
SELECT event_type AS ticker, time_bucket(INTERVAL 10 SECOND, ts) AS window_start,
       time_bucket(INTERVAL 10 SECOND, ts) + INTERVAL 10 SECOND AS window_end, min(value) AS min_price FROM events GROUP BY ALL""")
def win_min_tumble(t: Tables):
    rows = t.events.select("ts", F.col("event_type").alias("ticker"), "value")
    return wn.tumbling(rows, "ts", "10 seconds", ["ticker"], [wn.min_ignoring_nan(F.col("value")).alias("min_price")])


@query("win_min_slide", """
SELECT event_type AS ticker, w AS window_start, w + INTERVAL 30 MINUTE AS window_end, min(value) AS min_price
FROM (SELECT event_type, value, time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 5 MINUTE * i AS w FROM events, range(0, 6) r(i))
GROUP BY ALL""")
def win_min_slide(t: Tables):
    rows = t.events.select("ts", F.col("event_type").alias("ticker"), "value")
    return wn.sliding(rows, "ts", "30 minutes", "5 minutes", ["ticker"],
                      [F.min("value").alias("m")], [F.min("m").alias("min_price")])


@query("win_tumble_event", """
SELECT user_id AS sensor_id, time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 10 MINUTE AS window_end,
       round(sum(value::DECIMAL(18,2))::DOUBLE / count(*), 6) AS avg_temperature FROM events GROUP BY ALL""")
def win_tumble_event(t: Tables):
    rows = t.events.select("ts", F.col("user_id").alias("sensor_id"), F.col("value").cast("decimal(18,2)").alias("v"))
    out = wn.tumbling(rows, "ts", "10 minutes", ["sensor_id"], [F.sum("v").alias("s"), F.count("v").alias("n")])
    return out.select("sensor_id", "window_end", F.round(F.col("s").cast("double") / F.col("n"), 6).alias("avg_temperature"))


@query("win_slide_event", """
SELECT sensor_id, w + INTERVAL 10 SECOND AS window_end, round(sum(v)::DOUBLE / count(*), 6) AS avg_temperature
FROM (SELECT user_id AS sensor_id, value::DECIMAL(18,2) AS v, time_bucket(INTERVAL 2 SECOND, ts) - INTERVAL 2 SECOND * i AS w
      FROM events, range(0, 5) r(i)) GROUP BY ALL""")
def win_slide_event(t: Tables):
    rows = t.events.select("ts", F.col("user_id").alias("sensor_id"), F.col("value").cast("decimal(18,2)").alias("v"))
    out = wn.sliding(rows, "ts", "10 seconds", "2 seconds", ["sensor_id"],
                     [F.sum("v").alias("s"), F.count("v").alias("n")], [F.sum("s").alias("s"), F.sum("n").alias("n")])
    return out.select("sensor_id", "window_end", F.round(F.col("s").cast("double") / F.col("n"), 6).alias("avg_temperature"))


@query("ema_speed", """
SELECT event_type AS id, round(sum(value * 0.1::DOUBLE * power(0.9::DOUBLE, rest)), 6) AS decayed_average, count(*) AS event_count
FROM (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) - 1 AS rest FROM events)
GROUP BY event_type""")
def ema_speed(t: Tables):
    rows = t.events.select(F.col("event_type").alias("id"), "ts", "event_id", "value")
    minute = F.date_trunc("minute", F.col("ts").cast("timestamp"))
    out = wn.decayed_average(rows, ["id"], ["ts", "event_id"], minute, "value", 0.1)
    return out.withColumn("decayed_average", F.round("decayed_average", 6))
