"""Queries over event rows: parsing, cleaning, enrichment and rules."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarn.operators import events as ev
from tarn.plans.registry import Tables, query
from tarn.sources import messages as ms


def millis(col: str = "ts"):
    """Epoch milliseconds of a zone-less timestamp, read as UTC."""
    return F.unix_millis(F.col(col).cast("timestamp"))


def naive(df, *columns: str):
    """UTC instants as zone-less timestamps, the type of the stored tables."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query("json_source_parse", """
SELECT event_id, CAST(json_extract_string(doc, '$.k') AS INTEGER) AS k, CAST(NULL AS VARCHAR) AS missing
FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN replace(props, '}', '') ELSE props END AS doc FROM events)
WHERE json_valid(doc)""")
def json_source_parse(t: Tables):
    broken = F.when(F.col("event_type") == "error", F.replace("props", F.lit("}"))).otherwise(F.col("props"))
    raw = t.events.select("event_id", broken.alias("payload"))
    return ms.parse_json(raw, "payload", StructType.fromDDL("k int, missing string"), keep=["event_id"])


@query("raw_json_extract", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       strftime(ts, '%Y-%m-%d-%H') AS event_hour
FROM events WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) IS NOT NULL""")
def raw_json_extract(t: Tables):
    rows = ms.json_paths(t.events, "props", {"k": ("k", "int")}, keep=["event_id", "ts"])
    return rows.where("k is not null").select("event_id", "k", F.date_format("ts", "yyyy-MM-dd-HH").alias("event_hour"))


@query("bid_events_raw", """
SELECT event_type AS event_name, user_id, CAST(user_id % 10 + 1 AS BIGINT) AS city_id,
       epoch_us(ts) // 1000 AS timestamp_ms, make_timestamp(epoch_us(ts) // 1000 * 1000) AS event_time FROM events""")
def bid_events_raw(t: Tables):
    bids = t.events.select(F.col("event_type").alias("event_name"), "user_id",
                           (F.col("user_id") % 10 + 1).alias("city_id"), millis().alias("timestamp_ms"))
    return naive(ev.with_event_time(bids, "timestamp_ms"), "event_time")


DEVICE_CASE = """CASE event_id % 5 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' WHEN 2 THEN 'mobile'
                 WHEN 3 THEN 'desktop' ELSE NULL END"""


@query("user_events_enriched", f"""
SELECT event_id, event_type, user_id, device_type, ts AS event_time,
       coalesce(lower(device_type) IN ('ios', 'android', 'mobile'), FALSE) AS is_mobile
FROM (SELECT *, {DEVICE_CASE} AS device_type FROM events)""")
def user_events_enriched(t: Tables):
    rows = t.events.withColumn("device_type", F.expr(DEVICE_CASE))
    return rows.select("event_id", "event_type", "user_id", "device_type", F.col("ts").alias("event_time"),
                       ev.is_mobile("device_type").alias("is_mobile"))


@query("user_events_processed", """
SELECT event_id, event_type, user_id, ts AS event_time, CAST(ts AS DATE) AS event_date,
       CAST(hour(ts) AS INTEGER) AS event_hour FROM events""")
def user_events_processed(t: Tables):
    rows = t.events.select("event_id", "event_type", "user_id", F.col("ts").alias("event_time"))
    return ev.with_date_and_hour(rows, "event_time")


@query("order_events_enriched", """
SELECT l_orderkey, l_linenumber, l_partkey, round(l_quantity * price, 4) AS total_amount,
       CAST(l_shipdate AS DATE) AS order_date,
       CASE WHEN price < 100 THEN 'LOW' WHEN price < 500 THEN 'MEDIUM' ELSE 'HIGH' END AS price_category
FROM (SELECT *, CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_extendedprice / 100 END AS price FROM lineitem)""")
def order_events_enriched(t: Tables):
    price = F.when(F.col("l_partkey") % 11 != 0, F.col("l_extendedprice") / 100)
    rows = t.lineitem.withColumn("price", price)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey",
                       F.round(F.col("l_quantity") * F.col("price"), 4).alias("total_amount"),
                       F.to_date("l_shipdate").alias("order_date"),
                       ev.price_band(F.col("price")).alias("price_category"))


@query("order_ingest", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS user_id,
       CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS DOUBLE) AS order_amount, o_orderstatus AS order_status,
       o_orderdate AS event_time, CAST(o_orderdate AS DATE) AS event_day FROM orders""")
def order_ingest(t: Tables):
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_totalprice").cast("decimal(10,2)").cast("double").alias("order_amount"),
        F.col("o_orderstatus").alias("order_status"), F.col("o_orderdate").alias("event_time"),
        F.to_date("o_orderdate").alias("event_day"))


@query("filter_with_dt_hr", """
SELECT event_id, value AS price, strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hr
FROM events WHERE value > 50""")
def filter_with_dt_hr(t: Tables):
    rows = t.events.where(F.col("value") > 50)
    return ev.with_day_and_hour_text(rows, "ts").select("event_id", F.col("value").alias("price"), "dt", "hr")


RIDE_ROWS_SQL = """
SELECT event_id AS seq, concat('evt_', event_id) AS event_id, concat('user_', user_id) AS user_id, event_type,
       epoch_us(ts) // 1000 AS event_timestamp,
       CASE WHEN event_id % 3 = 0 THEN '' ELSE concat('ride_', user_id % 50) END AS ride_id,
       CAST((10 + event_id % 31) / 10.0 AS DOUBLE) AS surge_multiplier,
       CAST(event_id % 71 AS INTEGER) AS estimated_wait_minutes,
       CASE WHEN event_id % 17 = 0 THEN 0.0 ELSE value * 4 END AS fare_amount,
       CAST((4 + event_id % 7) / 2.0 AS DOUBLE) AS driver_rating,
       strftime(ts, '%Y-%m-%d-%H') AS event_hour
FROM events WHERE event_id % 13 <> 0"""


def ride_messages(t: Tables):
    """Ride events as JSON text; every 13th is cut off, some fields are missing."""
    e = F.col("event_id")
    meta = F.struct(((e % 31 + 10) / 10.0).alias("surge_multiplier"),
                    (e % 71).alias("estimated_wait_minutes"),
                    F.when(e % 17 != 0, F.col("value") * 4).alias("fare_amount"),
                    ((e % 7 + 4) / 2.0).alias("driver_rating"))
    body = F.to_json(F.struct(
        F.concat(F.lit("evt_"), e).alias("event_id"), F.concat(F.lit("user_"), F.col("user_id")).alias("user_id"),
        "event_type", millis().alias("timestamp"),
        F.when(e % 3 != 0, F.concat(F.lit("ride_"), F.col("user_id") % 50)).alias("ride_id"), meta.alias("metadata")))
    return t.events.select(e.alias("seq"), F.when(e % 13 == 0, F.substring(body, 1, 20)).otherwise(body).alias("payload"))


def ride_rows(t: Tables):
    return ev.flatten_ride(ms.parse_json(ride_messages(t), "payload", StructType.fromDDL(ev.RIDE_DDL)))


@query("ride_flatten", f"SELECT * EXCLUDE (seq) FROM ({RIDE_ROWS_SQL})")
def ride_flatten(t: Tables):
    return ride_rows(t)


RISK_SQL = """least(1.0, CASE WHEN surge_multiplier > 2.5 THEN 0.3 WHEN surge_multiplier > 2 THEN 0.2
      WHEN surge_multiplier > 1.5 THEN 0.1 ELSE 0 END
    + CASE WHEN estimated_wait_minutes > 45 THEN 0.3 WHEN estimated_wait_minutes > 30 THEN 0.2 ELSE 0 END
    + CASE WHEN fare_amount > 1000 THEN 0.2 WHEN fare_amount < 5 THEN 0.1 ELSE 0 END
    + CASE WHEN driver_rating < 3 THEN 0.2 ELSE 0 END)"""


@query("ride_rules", f"""
WITH rides AS ({RIDE_ROWS_SQL}),
scored AS (SELECT *, surge_multiplier > 3 OR estimated_wait_minutes > 60 AS fraud_detected,
                  CAST({RISK_SQL} AS DOUBLE) AS risk FROM rides),
advised AS (SELECT *, concat_ws(' | ', CASE WHEN fraud_detected THEN 'ALERT: Manual review required' END,
    CASE WHEN risk > 0.7 THEN 'High risk - apply additional verification'
         WHEN risk > 0.4 THEN 'Moderate risk - monitor closely' END,
    CASE WHEN surge_multiplier > 2 THEN 'High surge pricing (' || surge_multiplier || 'x)' END,
    CASE WHEN driver_rating < 3.5 THEN 'Low driver rating (' || driver_rating || ')' END,
    CASE WHEN estimated_wait_minutes > 30 THEN 'Long wait time (' || estimated_wait_minutes || ' min)' END) AS advice
  FROM scored)
SELECT event_id, fraud_detected, round(risk, 6) AS risk_score,
       CASE WHEN advice = '' THEN 'Normal' ELSE advice END AS recommendation,
       CASE WHEN fraud_detected AND fare_amount > 500 THEN 500.0
            WHEN surge_multiplier > 3 AND fare_amount > 200 THEN round(fare_amount * 0.9, 6) END AS adjusted_fare
FROM advised""")
def ride_rules(t: Tables):
    rows = ev.with_ride_rules(ride_rows(t))
    return rows.select("event_id", "fraud_detected", F.round("risk_score", 6).alias("risk_score"), "recommendation",
                       F.round("adjusted_fare", 6).alias("adjusted_fare"))


@query("fraud_check", f"""
SELECT event_id, surge_multiplier > 3 AS high_surge, estimated_wait_minutes > 60 AS long_wait,
       fare_amount > 1000 OR fare_amount < 5 AS unusual_fare, driver_rating < 3 AS low_driver_rating,
       CASE WHEN high_surge OR long_wait OR unusual_fare OR low_driver_rating THEN 'BLOCK' ELSE 'ALLOW' END AS recommendation
FROM ({RIDE_ROWS_SQL})""")
def fraud_check(t: Tables):
    rows = ev.with_fraud_check(ride_rows(t))
    names = ("high_surge", "long_wait", "unusual_fare", "low_driver_rating")
    return rows.select("event_id", *[F.col("indicators")[n].alias(n) for n in names], "recommendation")


@query("pricing_optimization", f"""
WITH p AS (SELECT event_id, fare_amount,
  fare_amount * CASE WHEN surge_multiplier > 2.5 THEN 0.95::DOUBLE ELSE 1::DOUBLE END
              * CASE WHEN estimated_wait_minutes > 45 THEN 0.9::DOUBLE ELSE 1::DOUBLE END AS optimal
  FROM ({RIDE_ROWS_SQL}))
SELECT event_id, round(fare_amount, 2) AS original_fare, printf('%.2f', optimal)::DOUBLE AS optimal_fare,
       printf('%.2f', fare_amount - optimal)::DOUBLE AS savings,
       CASE WHEN fare_amount > 0 THEN printf('%.1f', (fare_amount - optimal) / fare_amount * 100)::DOUBLE ELSE 0 END AS discount_percent
FROM p""")
def pricing_optimization(t: Tables):
    rows = ev.with_optimal_fare(ride_rows(t))
    return rows.select("event_id", F.round("fare_amount", 2).alias("original_fare"), "optimal_fare", "savings",
                       "discount_percent")


@query("speed_filter", "SELECT event_id, value AS speed FROM events WHERE value > 106.0")
def speed_filter(t: Tables):
    return t.events.where(F.col("value") > 106.0).select("event_id", F.col("value").alias("speed"))


@query("enum_filter", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'R'")
def enum_filter(t: Tables):
    return t.lineitem.where(F.col("l_returnflag") == "R").select("l_orderkey", "l_linenumber", "l_quantity")


@query("format_rows", """
SELECT event_id, event_type || ',' || printf('%.2f', value) AS csv_row,
       '{"ticker":"' || event_type || '","id":' || event_id || '}' AS json_row FROM events""")
def format_rows(t: Tables):
    return t.events.select(
        "event_id", F.format_string("%s,%.2f", "event_type", "value").alias("csv_row"),
        F.to_json(F.struct(F.col("event_type").alias("ticker"), F.col("event_id").alias("id"))).alias("json_row"))


ORDER_TEXT_SQL = """
SELECT o_orderkey AS seq,
       CASE WHEN o_orderkey % 9 = 0 THEN 'not-a-uuid' ELSE '00000000-0000-4000-8000-' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') END AS event_id,
       CASE WHEN o_orderkey % 11 = 0 THEN 'yesterday' ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || 'Z' END AS event_time,
       CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE 'ord-' || o_orderkey END AS order_id,
       'user-' || o_custkey AS user_id,
       CASE o_orderkey % 8 WHEN 0 THEN '12.345' WHEN 1 THEN '-5.00' WHEN 2 THEN 'ten'
            ELSE printf('%.2f', o_totalprice) END AS order_amount,
       CASE o_orderkey % 5 WHEN 0 THEN 'usd' WHEN 1 THEN 'euro' ELSE 'EUR' END AS currency,
       CASE WHEN o_orderkey % 6 = 0 THEN 'SHIPPED' ELSE 'CREATED' END AS order_status
FROM orders"""


def order_texts(t: Tables):
    """Order events as text fields, a share of them broken in each of the checked ways."""
    k = F.col("o_orderkey")
    return t.orders.select(
        k.alias("seq"),
        F.when(k % 9 == 0, "not-a-uuid").otherwise(
            F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(k.cast("string"), 12, "0"))).alias("event_id"),
        F.when(k % 11 == 0, "yesterday").otherwise(
            F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))).alias("event_time"),
        F.when(k % 7 == 0, "").otherwise(F.concat(F.lit("ord-"), k)).alias("order_id"),
        F.concat(F.lit("user-"), F.col("o_custkey")).alias("user_id"),
        F.when(k % 8 == 0, "12.345").when(k % 8 == 1, "-5.00").when(k % 8 == 2, "ten")
         .otherwise(F.format_string("%.2f", "o_totalprice")).alias("order_amount"),
        F.when(k % 5 == 0, "usd").when(k % 5 == 1, "euro").otherwise("EUR").alias("currency"),
        F.when(k % 6 == 0, "SHIPPED").otherwise("CREATED").alias("order_status"))


@query("parse_order_events", f"""
SELECT event_id, TRY_CAST(replace(replace(event_time, 'T', ' '), 'Z', '') AS TIMESTAMP) AS event_time, order_id, user_id,
       CAST(TRY_CAST(order_amount AS DECIMAL(10,2)) AS DOUBLE) AS order_amount, currency, order_status
FROM ({ORDER_TEXT_SQL})
WHERE TRY_CAST(replace(replace(event_time, 'T', ' '), 'Z', '') AS TIMESTAMP) IS NOT NULL
  AND TRY_CAST(order_amount AS DECIMAL(10,2)) IS NOT NULL AND seq % 10 <> 0""")
def parse_order_events(t: Tables):
    texts = order_texts(t)
    body = F.to_json(F.struct(*[c for c in texts.columns if c != "seq"]))
    payload = texts.select(F.when(F.col("seq") % 10 == 0, F.substring(body, 1, 30)).otherwise(body).alias("payload"))
    rows = ev.parse_order_events(ms.parse_json(payload, "payload", StructType.fromDDL(ev.ORDER_EVENT_DDL)))
    return naive(rows.withColumn("order_amount", F.col("order_amount").cast("double")), "event_time")


@query("validate_orders", f"""
SELECT seq, upper(currency) AS currency, violations, violations = '' AS is_valid FROM (
SELECT seq, currency, concat_ws(',',
   CASE WHEN event_id = 'not-a-uuid' THEN 'event_id' END,
   CASE WHEN length(order_id) NOT BETWEEN 1 AND 64 THEN 'order_id' END,
   CASE WHEN length(user_id) NOT BETWEEN 1 AND 64 THEN 'user_id' END,
   CASE WHEN coalesce(TRY_CAST(order_amount AS DOUBLE), 0) <= 0 OR length(split_part(order_amount, '.', 2)) > 2 THEN 'order_amount' END,
   CASE WHEN length(currency) <> 3 THEN 'currency' END,
   CASE WHEN order_status <> 'CREATED' THEN 'order_status' END) AS violations
FROM ({ORDER_TEXT_SQL}))""")
def validate_orders(t: Tables):
    return ev.order_violations(order_texts(t)).select("seq", "currency", "violations", "is_valid")


@query("dlq_split", """
SELECT event_id, CASE WHEN value < 20 THEN 'Poison' ELSE event_type END AS message, value < 20 AS is_dead_letter FROM events""")
def dlq_split(t: Tables):
    rows = t.events.select("event_id", F.when(F.col("value") < 20, "Poison").otherwise(F.col("event_type")).alias("message"))
    return ev.tag_dead_letters(rows, F.col("message") == "Poison")


@query("cast_to_schema", """
SELECT CAST(l_orderkey AS INTEGER) AS l_orderkey, CAST(l_quantity AS INTEGER) AS l_quantity,
       CAST(l_shipdate AS DATE) AS l_shipdate, l_returnflag, CAST(NULL AS VARCHAR) AS note FROM lineitem""")
def cast_to_schema(t: Tables):
    target = StructType.fromDDL("l_orderkey int, l_quantity int, l_shipdate date, l_returnflag string, note string")
    return ev.cast_to_schema(t.lineitem, target)


@query("passthrough", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def passthrough(t: Tables):
    t.events.createOrReplaceTempView("tarn_passthrough_in")
    return t.spark.sql("SELECT event_id, ts, user_id, event_type, value, props FROM tarn_passthrough_in")


@query("image_to_changes", """
SELECT seq, key, body, 'UPDATE_BEFORE' AS _change_type FROM (SELECT o_orderkey AS seq, o_custkey AS key, o_orderstatus AS body FROM orders WHERE o_orderkey % 3 = 0)
UNION ALL SELECT o_orderkey, o_custkey, o_orderpriority, 'UPDATE_AFTER' FROM orders WHERE o_orderkey % 3 = 0
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, 'DELETE' FROM orders WHERE o_orderkey % 3 = 1
UNION ALL SELECT o_orderkey, o_custkey, o_orderpriority, 'INSERT' FROM orders WHERE o_orderkey % 3 = 2""")
def image_to_changes(t: Tables):
    k = F.col("o_orderkey")
    image = lambda body: F.struct(F.col("o_custkey").alias("key"), F.col(body).alias("body"))
    feed = t.orders.select(k.alias("seq"), F.when(k % 3 != 2, image("o_orderstatus")).alias("old_item"),
                           F.when(k % 3 != 1, image("o_orderpriority")).alias("new_item"))
    return ms.image_to_changes(feed, "old_item", "new_item", "seq")


@query("cdc_customers", """
SELECT c_custkey AS customer_id, c_name AS full_name, CASE c_custkey % 4 WHEN 0 THEN 'c' WHEN 1 THEN 'u' WHEN 2 THEN 'd' ELSE 'r' END AS op,
       make_timestamp(CAST(1700000000000 + c_custkey AS BIGINT) * 1000) AS op_ts, 'shop' AS database_name,
       'dbo' AS schema_name, 'Customers' AS table_name FROM customer""")
def cdc_customers(t: Tables):
    k = F.col("c_custkey")
    row = F.struct(k.alias("CustomerID"), F.col("c_name").alias("Name"))
    op = F.when(k % 4 == 0, "c").when(k % 4 == 1, "u").when(k % 4 == 2, "d").otherwise("r")
    body = F.struct(op.alias("op"), (k + 1700000000000).alias("ts_ms"),
                    F.struct(F.lit("shop").alias("db"), F.lit("dbo").alias("schema"), F.lit("Customers").alias("table")).alias("source"),
                    F.when(op.isin("u", "d"), row).alias("before"), F.when(op != "d", row).alias("after"))
    payload = t.customer.select(F.to_json(body).alias("payload"))
    rows = ms.cdc_rows(payload, "payload", StructType.fromDDL("CustomerID bigint, Name string"),
                       {"CustomerID": "customer_id", "Name": "full_name"})
    return naive(rows, "op_ts")
