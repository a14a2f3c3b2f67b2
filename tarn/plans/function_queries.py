"""Queries over scalar functions, partition transforms and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarn.functions import scalars as sc, transforms as tr, zorder as zo
from tarn.plans.event_queries import naive
from tarn.plans.registry import Tables, query


def murmur_sql(value: str) -> str:
    """Murmur3 (seed 0) of a BIGINT as its 8 little-endian bytes, in 64-bit unsigned arithmetic."""
    m = "4294967296::UBIGINT"
    rot = lambda x, r: f"(({x} * {1 << r}) % {m} + {x} // {1 << (32 - r)})"
    return f"""
  WITH w AS (SELECT *, (CASE WHEN {value} < 0 THEN {value}::HUGEINT + 18446744073709551616::HUGEINT ELSE {value}::HUGEINT END)::UBIGINT AS u FROM src),
  k AS (SELECT *, ((u % {m}) * 3432918353::UBIGINT) % {m} AS a1, ((u // {m}) * 3432918353::UBIGINT) % {m} AS a2 FROM w),
  k2 AS (SELECT *, ({rot('a1', 15)} * 461845907::UBIGINT) % {m} AS b1, ({rot('a2', 15)} * 461845907::UBIGINT) % {m} AS b2 FROM k),
  h1 AS (SELECT *, ({rot('b1', 13)} * 5 + 3864292196::UBIGINT) % {m} AS h FROM k2),
  h2 AS (SELECT * REPLACE (xor(h, b2) AS h) FROM h1),
  h3 AS (SELECT * REPLACE (xor(({rot('h', 13)} * 5 + 3864292196::UBIGINT) % {m}, 8::UBIGINT) AS h) FROM h2),
  h4 AS (SELECT * REPLACE ((xor(h, h // 65536) * 2246822507::UBIGINT) % {m} AS h) FROM h3),
  h5 AS (SELECT * REPLACE ((xor(h, h // 8192) * 3266489909::UBIGINT) % {m} AS h) FROM h4),
  h6 AS (SELECT *, xor(h, h // 65536) % 2147483648::UBIGINT AS positive FROM h5)"""


@query("bucket_hash", f"""
WITH src AS (SELECT o_orderkey, o_custkey - 500 AS v, o_orderdate FROM orders),
nums AS ({murmur_sql('v')} SELECT o_orderkey, (positive % 16)::INTEGER AS cust_bucket FROM h6),
days AS (WITH src AS (SELECT o_orderkey, date_diff('day', DATE '1970-01-01', o_orderdate::DATE) AS v FROM orders)
         SELECT * FROM ({murmur_sql('v')} SELECT o_orderkey, (positive % 100)::INTEGER AS day_bucket FROM h6)),
times AS (WITH src AS (SELECT o_orderkey, epoch_us(o_orderdate) AS v FROM orders)
         SELECT * FROM ({murmur_sql('v')} SELECT o_orderkey, (positive % 32)::INTEGER AS time_bucket FROM h6))
SELECT * FROM nums JOIN days USING (o_orderkey) JOIN times USING (o_orderkey)""")
def bucket_hash(t: Tables):
    return t.orders.select(
        "o_orderkey", tr.bucket(16, F.col("o_custkey") - 500).alias("cust_bucket"),
        tr.bucket(100, F.to_date("o_orderdate"), "date").alias("day_bucket"),
        tr.bucket(32, F.col("o_orderdate"), "timestamp_ntz").alias("time_bucket"))


def murmur_bytes_sql(source: str, key: str, blob: str) -> str:
    """Murmur3 (seed 0) of whole byte strings: words folded in a list, then the tail: (key, positive)."""
    m = "4294967296::UBIGINT"
    rot = lambda x, r: f"(({x}) * {1 << r} % {m} + ({x}) // {1 << (32 - r)})"
    mix = lambda k: f"({rot(f'{k} * 3432918353::UBIGINT % {m}', 15)} * 461845907::UBIGINT % {m})"
    word = "('0x0' || substr(w, 7, 2) || substr(w, 5, 2) || substr(w, 3, 2) || substr(w, 1, 2))::UBIGINT"
    return f"""
  SELECT {key}, xor(h, h // 65536) % 2147483648::UBIGINT AS positive FROM (
  SELECT {key}, xor(h, h // 8192) * 3266489909::UBIGINT % {m} AS h FROM (
  SELECT {key}, xor(h, h // 65536) * 2246822507::UBIGINT % {m} AS h FROM (
  SELECT {key}, xor(xor(h, {mix('k')}), n::UBIGINT) AS h FROM (
  SELECT {key}, n, {word.replace('w,', 'rest,')} AS k, list_reduce(list_prepend(0::UBIGINT, [{mix('w')} for w in words]),
      lambda h, k: ({rot('xor(h, k)', 13)} * 5 + 3864292196::UBIGINT) % {m}) AS h
  FROM (SELECT {key}, n, substr(x, 8 * (n // 4) + 1) AS rest, [{word} for w in regexp_extract_all(x, '[0-9A-F]{{8}}')] AS words FROM (
  SELECT {key}, hex({blob}) AS x, octet_length({blob}) AS n FROM {source}))))))"""


BUCKET_TEXT_SQL = f"""
SELECT doc_id, (a.positive % 128)::INTEGER AS text_bucket, (b.positive % 16)::INTEGER AS lang_bucket, (c.positive % 16)::INTEGER AS size_bucket
FROM ({murmur_bytes_sql('documents', 'doc_id', 'encode(text)')}) a JOIN ({murmur_bytes_sql('documents', 'doc_id', 'encode(lang)')}) b USING (doc_id)
JOIN ({murmur_bytes_sql("(SELECT doc_id, printf('%X', n_chars * 100) AS d FROM documents)", 'doc_id',
                       "unhex(CASE WHEN length(d) % 2 = 1 THEN '0' || d WHEN d[1] >= '8' THEN '00' || d ELSE d END)")}) c USING (doc_id)"""


@query("bucket_hash_text", BUCKET_TEXT_SQL)
def bucket_hash_text(t: Tables):
    """Hash buckets of whole texts, of binary and of decimals."""
    return t.documents.select(
        "doc_id", tr.bucket(128, F.col("text"), "string").alias("text_bucket"),
        tr.bucket(16, F.unhex(F.hex("lang")), "binary").alias("lang_bucket"),
        tr.bucket(16, F.col("n_chars").cast("decimal(12,2)"), "decimal(12,2)").alias("size_bucket"))


@query("truncate_int", """
SELECT o_orderkey, CAST(floor((o_orderkey - 7000) / 10.0) * 10 AS BIGINT) AS by_ten,
       CAST(floor((o_custkey - 700) / 64.0) * 64 AS INTEGER) AS by_64 FROM orders""")
def truncate_int(t: Tables):
    return t.orders.select("o_orderkey", tr.truncate(10, F.col("o_orderkey") - 7000).alias("by_ten"),
                           tr.truncate(64, (F.col("o_custkey") - 700).cast("int"), "int").alias("by_64"))


@query("truncate_decimal", """
SELECT s_suppkey, c AS part, CAST(CAST(floor(CAST(c AS DECIMAL(20,2)) * 100 / 50) * 50 / 100 AS DECIMAL(12,2)) AS DOUBLE) AS down
FROM (SELECT c_custkey AS s_suppkey, CAST(c_acctbal - 3000 AS DECIMAL(12,2)) AS c FROM customer)""".replace("c AS part, ", ""))
def truncate_decimal(t: Tables):
    balance = (F.col("c_acctbal") - 3000).cast("decimal(12,2)")
    down = tr.truncate(50, balance, "decimal(12,2)")
    return t.customer.select(F.col("c_custkey").alias("s_suppkey"), down.cast("double").alias("down"))


@query("truncate_string", """
SELECT doc_id, substring(text, 1, 3) AS head, substring(source, 1, 4) AS source_head FROM documents""")
def truncate_string(t: Tables):
    return t.documents.select("doc_id", tr.truncate(3, F.col("text"), "string").alias("head"),
                              tr.truncate(4, F.col("source"), "string").alias("source_head"))


SHIFTED = "(ts - INTERVAL 54 YEAR - INTERVAL 10 DAY)"


@query("date_transforms", f"""
SELECT event_id, CAST(year(d) - 1970 AS INTEGER) AS years, CAST((year(d) - 1970) * 12 + month(d) - 1 AS INTEGER) AS months,
       CAST(date_diff('day', DATE '1970-01-01', d::DATE) AS INTEGER) AS days,
       CAST(floor(epoch_us(d) / 3600000000.0) AS INTEGER) AS hours, event_type AS same, CAST(NULL AS VARCHAR) AS nothing
FROM (SELECT *, {SHIFTED} AS d FROM events)""")
def date_transforms(t: Tables):
    d = F.expr(SHIFTED.replace("54 YEAR", "'54' YEAR").replace("10 DAY", "'10' DAY"))
    rows = t.events.withColumn("d", d)
    return rows.select("event_id", tr.years(F.col("d")).alias("years"), tr.months(F.col("d")).alias("months"),
                       tr.days(F.col("d")).alias("days"), tr.hours(F.col("d")).alias("hours"),
                       tr.PartitionField("event_type").value(F.col("event_type")).alias("same"),
                       tr.void("string").alias("nothing"))


@query("human_partition", f"""
SELECT event_id, strftime(d, '%Y') AS y, strftime(d, '%Y-%m') AS m, strftime(d, '%Y-%m-%d') AS dd,
       strftime(d, '%Y-%m-%d-%H') AS h FROM (SELECT *, {SHIFTED} AS d FROM events)""")
def human_partition(t: Tables):
    d = F.expr(SHIFTED.replace("54 YEAR", "'54' YEAR").replace("10 DAY", "'10' DAY"))
    rows = t.events.withColumn("d", d)
    c = F.col("d")
    return rows.select("event_id", tr.human("year", tr.years(c)).alias("y"), tr.human("month", tr.months(c)).alias("m"),
                       tr.human("day", tr.days(c)).alias("dd"), tr.human("hour", tr.hours(c)).alias("h"))


@query("epoch_functions", """
SELECT event_id, make_timestamp(epoch_us(ts) // 1000 * 1000) AS from_millis, make_timestamp(epoch_us(ts) // 1000000 * 1000000) AS from_seconds,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS unix_text, CAST(ts AS DATE) AS day, CAST(hour(ts) AS INTEGER) AS hr,
       strftime(ts, '%Y-%m-%d') AS fmt FROM events""")
def epoch_functions(t: Tables):
    instant = F.col("ts").cast("timestamp")
    rows = t.events.select(
        "event_id", F.timestamp_millis(F.unix_millis(instant)).alias("from_millis"),
        F.timestamp_seconds(F.unix_seconds(instant)).alias("from_seconds"),
        F.from_unixtime(F.unix_seconds(instant)).alias("unix_text"), F.to_date("ts").alias("day"),
        F.hour("ts").alias("hr"), F.date_format("ts", "yyyy-MM-dd").alias("fmt"))
    return naive(rows, "from_millis", "from_seconds")


@query("variant_extract", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events WHERE CAST(json_extract(props, '$.k') AS INTEGER) > 50""")
def variant_extract(t: Tables):
    rows = t.events.select("event_id", sc.extract(F.col("props"), "$.k", "int").alias("k"))
    return rows.where("k > 50")


@query("json_to_map", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k, '{"type":"' || event_type || '"}' AS nested, '[1,2]' AS items FROM events""")
def json_to_map(t: Tables):
    doc = F.to_json(F.struct(F.get_json_object("props", "$.k").cast("int").alias("k"),
                             F.struct(F.col("event_type").alias("type")).alias("nested"),
                             F.array(F.lit(1), F.lit(2)).alias("items")))
    rows = t.events.select("event_id", sc.json_to_map(doc).alias("m"))
    return rows.select("event_id", *[F.col("m")[k].alias(k) for k in ("k", "nested", "items")])


@query("copy_value", "SELECT event_id, user_id, user_id AS user_copy FROM events")
def copy_value(t: Tables):
    return sc.copy_value(t.events.select("event_id", "user_id"), "user_id", "user_copy")


@query("celsius_to_fahrenheit", "SELECT event_id, round(value * 9 / 5 + 32, 6) AS fahrenheit FROM events")
def celsius_to_fahrenheit(t: Tables):
    return t.events.select("event_id", F.round(sc.celsius_to_fahrenheit(F.col("value")), 6).alias("fahrenheit"))


@query("celsius_to_fahrenheit_udf", "SELECT event_id, round(value * 9 / 5 + 32, 6) AS fahrenheit FROM events")
def celsius_udf(t: Tables):
    return t.events.select("event_id", F.round(sc.celsius_to_fahrenheit_udf("value"), 6).alias("fahrenheit"))


@query("determinant_2x2", """
SELECT l_orderkey, l_linenumber, l_partkey, round(l_quantity * l_discount - l_tax * l_linenumber, 6) + 0.0::DOUBLE AS det FROM lineitem""")
def determinant(t: Tables):
    det = sc.determinant_2x2(F.col("l_quantity"), F.col("l_tax"), F.col("l_linenumber"), F.col("l_discount"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", (F.round(det, 6) + 0.0).alias("det"))


MATRIX = [  # name, SQL text valid in both dialects, over id, v (with NULL and NaN), s
    ("true", "TRUE"), ("false", "FALSE"), ("is_null", "v IS NULL"), ("not_null", "v IS NOT NULL"),
    ("is_nan", "isnan(v)"), ("not_nan", "NOT isnan(v)"), ("lt", "v < 50"), ("lt_eq", "v <= 50"),
    ("gt", "v > 50"), ("gt_eq", "v >= 50"), ("eq", "v = 6.55"), ("not_eq", "v <> 6.55"),
    ("in", "s IN ('click', 'view')"), ("not_in", "s NOT IN ('click', 'view')"), ("not", "NOT (v < 50)"),
    ("and", "v < 50 AND s = 'click'"), ("or", "v < 50 OR s = 'click'"),
    ("starts_with", "starts_with(s, 'c')"), ("not_starts_with", "NOT starts_with(s, 'c')")]

MATRIX_ROWS = """SELECT event_id AS id, CASE WHEN event_id % 10 = 1 THEN NULL WHEN event_id % 10 = 2 THEN CAST('NaN' AS DOUBLE)
   ELSE value END AS v, CASE WHEN event_id % 10 = 3 THEN NULL ELSE event_type END AS s FROM events"""


@query("predicate_matrix", " UNION ALL ".join(
    f"SELECT '{name}' AS predicate, count(*) AS matches FROM ({MATRIX_ROWS}) WHERE {sql}" for name, sql in MATRIX))
def predicate_matrix(t: Tables):
    """Rows matched by each predicate kind, all counted in one pass."""
    i, v, s = F.col("event_id"), F.col("v"), F.col("s")
    rows = t.events.select(
        F.when(i % 10 == 2, F.lit(float("nan"))).when(i % 10 != 1, F.col("value")).alias("v"),
        F.when(i % 10 != 3, F.col("event_type")).alias("s"))
    conditions = {
        "true": F.lit(True), "false": F.lit(False), "is_null": v.isNull(), "not_null": v.isNotNull(),
        "is_nan": F.isnan(v), "not_nan": v.isNotNull() & ~F.isnan(v), "lt": v < 50, "lt_eq": v <= 50, "gt": v > 50,
        "gt_eq": v >= 50, "eq": v == 6.55, "not_eq": v != 6.55, "in": s.isin("click", "view"),
        "not_in": ~s.isin("click", "view"), "not": ~(v < 50), "and": (v < 50) & (s == "click"),
        "or": (v < 50) | (s == "click"), "starts_with": s.startswith("c"), "not_starts_with": ~s.startswith("c")}
    counts = rows.agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])
    return counts.unpivot([], list(conditions), "predicate", "matches")


@query("zorder_key", """
SELECT l_orderkey, l_linenumber, l_partkey,
       list_sum([((a >> i) & 1) * (1 << (2 * i + 1)) + ((b >> i) & 1) * (1 << (2 * i)) for i in range(12)])::BIGINT AS z
FROM (SELECT *, l_linenumber::BIGINT AS a, l_quantity::BIGINT AS b FROM lineitem)""")
def zorder_key(t: Tables):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", zo.small_zorder_key(
        [F.col("l_linenumber"), F.col("l_quantity")], 12).alias("z"))


@query("infer_json_struct", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def infer_json_struct(t: Tables):
    schema = sc.infer_struct(t.events, "props")
    return t.events.select("event_id", F.from_json("props", schema).alias("r")).select("event_id", "r.*")


@query("sql_functions", """
SELECT o_orderkey, CAST(o_orderkey - o_orderkey % 10 AS BIGINT) AS by_ten, substring(o_orderpriority, 1, 3) AS head,
  CAST((year(o_orderdate) - 1970) * 12 + month(o_orderdate) - 1 AS INTEGER) AS m, CAST(date_diff('day', DATE '1970-01-01', o_orderdate::DATE) AS INTEGER) AS d,
  b AS cust_bucket FROM orders JOIN (WITH src AS (SELECT o_orderkey AS k, o_custkey AS v FROM orders) SELECT k, b FROM (__MURMUR__ SELECT k, (positive % 16)::INTEGER AS b FROM h6)) x ON x.k = o_orderkey""".replace("__MURMUR__", murmur_sql("v")))
def sql_functions(t: Tables):
    """The transforms called from SQL text."""
    tr.register_sql_functions(t.spark)
    t.orders.createOrReplaceTempView("tarn_orders_in")
    return t.spark.sql("""SELECT o_orderkey, tarn_truncate(10, o_orderkey) AS by_ten, tarn_truncate_string(3, o_orderpriority) AS head,
        tarn_months(o_orderdate) AS m, tarn_days(o_orderdate) AS d, tarn_bucket(16, o_custkey) AS cust_bucket FROM tarn_orders_in""")


@query("sql_bucket_text", BUCKET_TEXT_SQL)
def sql_bucket_text(t: Tables):
    """The same buckets of text, binary and decimals, called from SQL text."""
    tr.register_sql_functions(t.spark)
    t.documents.createOrReplaceTempView("tarn_documents_in")
    return t.spark.sql("""SELECT doc_id, tarn_bucket_string(128, text) AS text_bucket, tarn_bucket_binary(16, CAST(lang AS BINARY)) AS lang_bucket,
        tarn_bucket_decimal(16, n_chars * 100) AS size_bucket FROM tarn_documents_in""")


@query("bucket_uuid", f"""
SELECT o_orderkey, (positive % 16)::INTEGER AS by_column, (positive % 16)::INTEGER AS by_sql
FROM ({murmur_bytes_sql("(SELECT o_orderkey, md5(o_orderkey::VARCHAR) AS u FROM orders)", 'o_orderkey', 'unhex(u)')}) x""")
def bucket_uuid(t: Tables):
    """Buckets of UUIDs written as text."""
    tr.register_sql_functions(t.spark)
    digits = F.md5(F.col("o_orderkey").cast("string").cast("binary"))
    part = lambda start, n: F.substring(digits, start, n)
    uuids = F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12))
    rows = t.orders.select("o_orderkey", uuids.alias("u"))
    return rows.select("o_orderkey", tr.bucket(16, F.col("u"), "uuid").alias("by_column"), F.expr("tarn_bucket_uuid(16, u)").alias("by_sql"))
