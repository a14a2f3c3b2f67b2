"""Queries over snapshot lineage, change logs and applied changes."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarn.operators import cdc, changes as ch, delta as dt, lineage as ln, schemas as sm
from tarn.operators.events import cast_to_schema
from tarn.plans import fixtures as fx
from tarn.plans.event_queries import naive
from tarn.plans.registry import Tables, query
from tarn.session import scratch
from tarn.util import int_div

AT = "1999-06-15"


@query("ancestors_of", f"WITH {fx.LINE_SQL} SELECT snapshot_id, committed_at FROM line")
def ancestors_of(t: Tables):
    return ln.chain(fx.snapshots(t), fx.HEAD).select("snapshot_id", "committed_at")


@query("history_report", f"""
WITH {fx.LINE_SQL} SELECT committed_at, snapshot_id, parent_id, snapshot_id IN (SELECT snapshot_id FROM line) AS is_current_ancestor FROM snapshots""")
def history_report(t: Tables):
    return ln.history(fx.snapshots(t), fx.HEAD)


LIVE_SQL = """SELECT f.* FROM files f WHERE added_snapshot_id IN (SELECT snapshot_id FROM visible)
  AND (removed_snapshot_id IS NULL OR removed_snapshot_id NOT IN (SELECT snapshot_id FROM visible))"""


@query("time_travel_as_of", f"""
WITH {fx.LINE_SQL}, files AS ({fx.FILES_SQL}), visible AS (SELECT snapshot_id FROM line WHERE committed_at <= TIMESTAMP '{AT}'),
live AS ({LIVE_SQL})
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_orderkey // {fx.ORDERS_PER_FILE} IN (SELECT file_no FROM live WHERE content = 0)""")
def time_travel_as_of(t: Tables):
    """Rows of the data files live at a point in time."""
    line = ln.chain(fx.snapshots(t), fx.HEAD)
    at = ln.snapshot_as_of(line, F.lit(AT).cast("timestamp_ntz")).first()[0]
    live = ln.live_files(fx.files(t).where("content = 0"), ln.up_to(line, at)).select("file_no", "added_snapshot_id")
    rows = fx.stored_lines(t).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "file_no", "added_snapshot_id")
    return ln.rows_of_files(rows, live, "file_no", "added_snapshot_id").drop("file_no")


@query("resolve_snapshot", f"""
WITH {fx.LINE_SQL}
SELECT 'as_of' AS how, (SELECT max_by(snapshot_id, committed_at) FROM line WHERE committed_at <= TIMESTAMP '{AT}') AS snapshot_id
UNION ALL SELECT 'main', {fx.HEAD}::BIGINT
UNION ALL SELECT 'audit', (SELECT max(snapshot_id) FROM snapshots WHERE snapshot_id % 10 = 3)
UNION ALL SELECT 'common', (SELECT max(snapshot_id) FROM line WHERE snapshot_id < (SELECT max(snapshot_id) FROM snapshots WHERE snapshot_id % 10 = 3))""")
def resolve_snapshot(t: Tables):
    """Which snapshot a time, a branch and a side branch's fork point stand for."""
    snaps = fx.snapshots(t)
    line = ln.chain(snaps, fx.HEAD)
    side = snaps.where("snapshot_id % 10 = 3").agg(F.max("snapshot_id").alias("snapshot_id"))
    refs = (snaps.agg(F.max("snapshot_id").alias("snapshot_id")).select(F.lit("main").alias("how"), "snapshot_id")
            .union(side.select(F.lit("audit"), "snapshot_id")))
    head = ln.head_of(refs.withColumnRenamed("how", "name"), "audit")
    fork = (ln.ancestors(snaps, head).join(line.select("snapshot_id"), "snapshot_id", "left_semi")
            .agg(F.min_by("snapshot_id", "depth").alias("snapshot_id")))
    as_of = ln.snapshot_as_of(line, F.lit(AT).cast("timestamp_ntz"))
    return as_of.select(F.lit("as_of").alias("how"), "snapshot_id").union(refs).union(fork.select(F.lit("common"), "snapshot_id"))


@query("incremental_append", f"""
WITH {fx.LINE_SQL}, files AS ({fx.FILES_SQL}), span AS (SELECT snapshot_id FROM line WHERE snapshot_id > 20 AND snapshot_id <= 60 AND operation = 'append')
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey // {fx.ORDERS_PER_FILE} IN
  (SELECT file_no FROM files WHERE content = 0 AND added_snapshot_id IN (SELECT snapshot_id FROM span))""")
def incremental_append(t: Tables):
    line = ln.chain(fx.snapshots(t), fx.HEAD)
    added = ln.appended_files(fx.files(t), ln.after(ln.up_to(line, 60), 20)).select("file_no", "added_snapshot_id")
    rows = fx.stored_lines(t).select("l_orderkey", "l_linenumber", "l_partkey", "file_no", "added_snapshot_id")
    return ln.rows_of_files(rows, added, "file_no", "added_snapshot_id").drop("file_no")


@query("changelog_scan", f"""
WITH {fx.LINE_SQL}, files AS ({fx.FILES_SQL}),
span AS (SELECT snapshot_id, CAST(row_number() OVER (ORDER BY snapshot_id) - 1 AS INTEGER) AS _change_ordinal FROM line
         WHERE committed_at >= TIMESTAMP '1997-01-01' AND committed_at < TIMESTAMP '2000-01-01' AND operation <> 'replace'),
changed AS (SELECT file_no, 'INSERT' AS _change_type, _change_ordinal, snapshot_id AS _commit_snapshot_id FROM files JOIN span ON added_snapshot_id = snapshot_id WHERE content = 0
   UNION ALL SELECT file_no, 'DELETE', _change_ordinal, snapshot_id FROM files JOIN span ON removed_snapshot_id = snapshot_id WHERE content = 0)
SELECT l_orderkey, l_linenumber, l_partkey, _change_type, _change_ordinal, _commit_snapshot_id
FROM lineitem JOIN changed ON l_orderkey // {fx.ORDERS_PER_FILE} = file_no""")
def changelog_scan(t: Tables):
    """Change rows of the commits between two times."""
    line = ln.chain(fx.snapshots(t), fx.HEAD)
    c = F.col("committed_at")
    span = line.where((c >= F.lit("1997-01-01").cast("timestamp_ntz")) & (c < F.lit("2000-01-01").cast("timestamp_ntz")))
    changed = ln.changed_files(fx.files(t).where("content = 0"), span).select("file_no", "added_snapshot_id", *ch.METADATA)
    rows = fx.stored_lines(t).select("l_orderkey", "l_linenumber", "l_partkey", "file_no", "added_snapshot_id")
    return ln.rows_of_files(rows, changed, "file_no", "added_snapshot_id").drop("file_no")


@query("stream_start_strategy", f"""
WITH {fx.LINE_SQL}, appends AS (SELECT * FROM line WHERE operation = 'append')
SELECT 'full_then_incremental' AS strategy, {fx.HEAD}::BIGINT AS snapshot_id, 'full' AS read_as
UNION ALL SELECT 'latest_inclusive', snapshot_id, 'incremental' FROM appends WHERE snapshot_id = {fx.HEAD}
UNION ALL SELECT 'earliest_inclusive', snapshot_id, 'incremental' FROM appends
UNION ALL SELECT 'from_id_inclusive', snapshot_id, 'incremental' FROM appends WHERE snapshot_id >= 40
UNION ALL SELECT 'from_timestamp_inclusive', snapshot_id, 'incremental' FROM appends WHERE committed_at >= TIMESTAMP '{AT}'""")
def stream_start_strategy(t: Tables):
    line = ln.chain(fx.snapshots(t), fx.HEAD)
    out = None
    for strategy in ln.START_STRATEGIES:
        part = ln.start_reading(line, strategy, 40, F.lit(AT).cast("timestamp_ntz"))
        part = part.select(F.lit(strategy).alias("strategy"), "snapshot_id", "read_as")
        out = part if out is None else out.union(part)
    return out


@query("split_watermark", f"""
WITH files AS ({fx.FILES_SQL}) SELECT file_no // 4 AS split, min(l_shipdate_lower) AS watermark FROM files GROUP BY 1""")
def split_watermark(t: Tables):
    files = fx.files(t).withColumn("split", int_div(F.col("file_no"), 4))
    return ln.split_watermarks(files, "split", "l_shipdate_lower")


@query("ordered_backfill", f"""
WITH files AS ({fx.FILES_SQL})
SELECT file_no, CAST((sum(record_count) OVER (ORDER BY sequence_number, file_no) - record_count) // 5000 AS BIGINT) AS batch FROM files WHERE content = 0""")
def ordered_backfill(t: Tables):
    """Files in sequence order cut into batches of about 5000 rows."""
    files = fx.files(t).where("content = 0").select("file_no", "sequence_number", "record_count")
    return ln.read_batches(files, ["sequence_number", "file_no"], F.col("sequence_number"), max_rows=5000).select("file_no", "batch")


@query("stream_read_limits", f"""
WITH {fx.LINE_SQL}, files AS ({fx.FILES_SQL}), f AS (SELECT * FROM files WHERE content = 0 AND added_snapshot_id IN (SELECT snapshot_id FROM line WHERE operation = 'append'))
SELECT file_no, (row_number() OVER (ORDER BY sequence_number, file_no) - 1) // 10 AS batch FROM f""")
def stream_read_limits(t: Tables):
    """Files of append commits, ten per batch; deletes and overwrites are skipped."""
    line = ln.streamable(ln.chain(fx.snapshots(t), fx.HEAD), skip_delete=True, skip_overwrite=True)
    files = ln.appended_files(fx.files(t), line).select("file_no", "sequence_number", "record_count")
    return ln.read_batches(files, ["sequence_number", "file_no"], F.col("sequence_number"), max_files=10).select("file_no", "batch")


@query("entries_report", f"""
WITH {fx.LINE_SQL}, files AS ({fx.FILES_SQL}), older AS (SELECT snapshot_id FROM line WHERE snapshot_id < 80)
SELECT file_no, CASE WHEN added_snapshot_id = 80 THEN 1 WHEN removed_snapshot_id = 80 THEN 2 ELSE 0 END AS status FROM files
WHERE added_snapshot_id = 80 OR (added_snapshot_id IN (SELECT snapshot_id FROM older) AND (removed_snapshot_id IS NULL OR removed_snapshot_id NOT IN (SELECT snapshot_id FROM older)))""")
def entries_report(t: Tables):
    return ln.entries_report(fx.files(t), ln.chain(fx.snapshots(t), fx.HEAD)).select("file_no", "status")


@query("metadata_log", """
SELECT o_orderdate AS timestamp, 'v' || max(o_orderkey) || '.json' AS file,
   (SELECT max_by(snapshot_id, committed_at) FROM (__SNAPS__) s WHERE committed_at <= o_orderdate) AS latest_snapshot_id
FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1""".replace("__SNAPS__", fx.SNAPSHOTS_SQL))
def metadata_log(t: Tables):
    log = t.orders.where("o_orderpriority = '1-URGENT'").groupBy(F.col("o_orderdate").alias("timestamp")).agg(
        F.concat(F.lit("v"), F.max("o_orderkey"), F.lit(".json")).alias("file"))
    return ln.metadata_log(log, fx.snapshots(t))


@query("evolve_schema", "SELECT event_id, user_id, value, CAST(NULL AS VARCHAR) AS note FROM events")
def evolve_schema(t: Tables):
    """Rows cast to the schema that took in wider and additional columns."""
    narrow = t.events.select(F.col("event_id").cast("int").alias("event_id"), F.col("user_id").cast("int").alias("user_id"), "value")
    arriving = StructType.fromDDL("event_id bigint, user_id bigint, value float, note string")
    return cast_to_schema(narrow, sm.evolve_schema(narrow.schema, arriving))


CHANGES_SQL = """
SELECT l_orderkey // 4 AS id, l_returnflag AS name, CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE l_linestatus END AS data,
       CASE WHEN l_linenumber % 2 = 0 THEN 'DELETE' ELSE 'INSERT' END AS _change_type,
       CAST(l_partkey % 3 AS INTEGER) AS _change_ordinal, 100 + l_partkey % 3 AS _commit_snapshot_id FROM lineitem"""


def change_rows(t: Tables):
    return t.lineitem.select(
        int_div(F.col("l_orderkey"), 4).alias("id"), F.col("l_returnflag").alias("name"),
        F.when(F.col("l_suppkey") % 5 != 0, F.col("l_linestatus")).alias("data"),
        F.when(F.col("l_linenumber") % 2 == 0, "DELETE").otherwise("INSERT").alias("_change_type"),
        (F.col("l_partkey") % 3).cast("int").alias("_change_ordinal"), (F.col("l_partkey") % 3 + 100).alias("_commit_snapshot_id"))


@query("changelog_carryover", f"""
WITH c AS ({CHANGES_SQL}), numbered AS (SELECT *, row_number() OVER (PARTITION BY id, name, data, _change_ordinal, _commit_snapshot_id, _change_type) AS i FROM c)
SELECT a.* EXCLUDE (i) FROM numbered a ANTI JOIN numbered b
  ON a.id = b.id AND a.name = b.name AND a.data IS NOT DISTINCT FROM b.data AND a._change_ordinal = b._change_ordinal
  AND a._commit_snapshot_id = b._commit_snapshot_id AND a._change_type <> b._change_type AND a.i = b.i""")
def changelog_carryover(t: Tables):
    return ch.remove_carryovers(change_rows(t))


@query("changelog_net", f"""
WITH c AS ({CHANGES_SQL}), walk AS (SELECT *, CASE _change_type WHEN 'INSERT' THEN 1 ELSE -1 END AS step,
    row_number() OVER (PARTITION BY id, name, data ORDER BY _change_ordinal, _change_type) AS i FROM c),
bal AS (SELECT *, sum(step) OVER (PARTITION BY id, name, data ORDER BY i) AS after FROM walk),
net AS (SELECT id, name, data, sum(step) AS n, max(CASE WHEN after - step = 0 THEN i END) AS opening FROM bal GROUP BY ALL HAVING sum(step) <> 0)
SELECT net.id, net.name, net.data, w._change_type, w._change_ordinal, w._commit_snapshot_id
FROM (SELECT *, unnest(range(abs(n)::BIGINT)) AS copy FROM net) net
JOIN walk w ON w.id = net.id AND w.name = net.name AND w.data IS NOT DISTINCT FROM net.data AND w.i = net.opening""")
def changelog_net(t: Tables):
    return ch.net_changes(change_rows(t))


ORDER_CHANGES_SQL = """
SELECT o_orderkey AS id, o_orderstatus AS name, CASE WHEN o_orderpriority = '5-LOW' THEN o_orderpriority ELSE 'was ' || o_orderpriority END AS data,
       'DELETE' AS _change_type, CAST(o_custkey % 4 AS INTEGER) AS _change_ordinal, o_custkey % 4 AS _commit_snapshot_id FROM orders WHERE o_orderstatus <> 'O'
UNION ALL SELECT o_orderkey, o_orderstatus, o_orderpriority, 'INSERT', CAST(o_custkey % 4 AS INTEGER), o_custkey % 4 FROM orders WHERE o_orderstatus <> 'F'"""


def order_changes(t: Tables):
    """Deletes of finished, inserts of open and updates of pending orders; pairs of low priority are carry-overs."""
    o = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("name"), "o_orderpriority",
                        (F.col("o_custkey") % 4).cast("int").alias("_change_ordinal"), (F.col("o_custkey") % 4).alias("_commit_snapshot_id"))
    was = F.when(F.col("o_orderpriority") == "5-LOW", F.col("o_orderpriority")).otherwise(F.concat(F.lit("was "), F.col("o_orderpriority")))
    shape = lambda df, data, kind: df.select("id", "name", data.alias("data"), F.lit(kind).alias("_change_type"),
                                             "_change_ordinal", "_commit_snapshot_id")
    return shape(o.where("name <> 'O'"), was, "DELETE").union(shape(o.where("name <> 'F'"), F.col("o_orderpriority"), "INSERT"))


UPDATES_SQL = f"""
WITH c AS ({ORDER_CHANGES_SQL}),
clean AS (SELECT * FROM c WHERE NOT (data = '5-LOW' AND name = 'P'))
SELECT id, name, data, CASE WHEN count(*) OVER (PARTITION BY id, _change_ordinal) = 1 THEN _change_type
   WHEN _change_type = 'DELETE' THEN 'UPDATE_BEFORE' ELSE 'UPDATE_AFTER' END AS _change_type, _change_ordinal, _commit_snapshot_id FROM clean"""


@query("changelog_updates", UPDATES_SQL)
def changelog_updates(t: Tables):
    return ch.compute_updates(order_changes(t), ["id"])


@query("changelog_view", f"SELECT _change_type, count(*) AS n FROM ({UPDATES_SQL}) GROUP BY 1")
def changelog_view(t: Tables):
    ch.changelog_view(order_changes(t), "tarn_order_changes", identifiers=["id"])
    return t.spark.sql("SELECT _change_type, count(*) AS n FROM tarn_order_changes GROUP BY _change_type")


@query("diff_versions", """
WITH old AS (SELECT l_orderkey % 100 AS k, l_returnflag AS f FROM lineitem WHERE l_linenumber <> 1),
     new AS (SELECT l_orderkey % 100 AS k, l_returnflag AS f FROM lineitem WHERE l_linenumber <> 2)
SELECT *, 'DELETE' AS _change_type FROM (SELECT * FROM old EXCEPT ALL SELECT * FROM new)
UNION ALL SELECT *, 'INSERT' FROM (SELECT * FROM new EXCEPT ALL SELECT * FROM old)""")
def diff_versions(t: Tables):
    rows = lambda n: t.lineitem.where(F.col("l_linenumber") != n).select((F.col("l_orderkey") % 100).alias("k"), F.col("l_returnflag").alias("f"))
    return ch.diff_versions(rows(1), rows(2))


UPSERT_SQL = """
WITH newest AS (SELECT l_orderkey AS k, l_extendedprice AS price FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01'
   QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_extendedprice DESC) = 1)
SELECT * FROM newest UNION ALL SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT k FROM newest)"""


@query("upsert_by_key", UPSERT_SQL)
def upsert_by_key(t: Tables):
    target = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price"))
    source = t.lineitem.where("l_shipdate >= timestamp_ntz'1999-01-01'").select(
        F.col("l_orderkey").alias("k"), F.col("l_extendedprice").alias("price"), "l_shipdate", "l_linenumber", "l_partkey")
    return ch.upsert(target, source, ["k"], ["l_shipdate", "l_linenumber", "l_partkey", "price"])


@query("upsert_delta", UPSERT_SQL)
def upsert_delta(t: Tables):
    """The same upsert as rows, equality deletes and position deletes written beside the table, and read merged."""
    path = scratch(t.spark, "delta")
    schema = StructType.fromDDL("k bigint, price double")
    dt.write_rows(t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price")), path, 0)
    batch = t.lineitem.where("l_shipdate >= timestamp_ntz'1999-01-01'").select(
        F.col("l_orderkey").alias("k"), F.col("l_extendedprice").alias("price"), "l_shipdate", "l_linenumber", "l_partkey")
    dt.write_upsert(batch, path, ["k"], ["l_shipdate", "l_linenumber", "l_partkey", "price"], 1, schema)
    return dt.read_upserted(t.spark, path, schema, ["k"])


@query("upsert_precombine", """
SELECT event_type AS ticker, user_id, ts AS event_time, value AS price FROM events
QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) = 1""")
def upsert_precombine(t: Tables):
    rows = t.events.select(F.col("event_type").alias("ticker"), "user_id", F.col("ts").alias("event_time"), F.col("value").alias("price"), "event_id")
    return ch.latest_per_key(rows, ["ticker", "user_id"], ["event_time", "event_id"]).drop("event_id")


@query("apply_cdc", """
WITH feed AS (SELECT user_id AS k, value AS v, ts, event_id, CASE event_type WHEN 'click' THEN 'INSERT' WHEN 'view' THEN 'UPDATE_AFTER'
     WHEN 'error' THEN 'UPDATE_BEFORE' WHEN 'signup' THEN 'DELETE' ELSE 'UPDATE_AFTER' END AS op FROM events),
newest AS (SELECT * FROM feed WHERE op <> 'UPDATE_BEFORE' QUALIFY row_number() OVER (PARTITION BY k ORDER BY ts DESC, event_id DESC) = 1)
SELECT k, v FROM newest WHERE op <> 'DELETE' UNION ALL SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT k FROM newest)""")
def apply_cdc(t: Tables):
    kind = F.when(F.col("event_type") == "click", "INSERT").when(F.col("event_type") == "error", "UPDATE_BEFORE") \
        .when(F.col("event_type") == "signup", "DELETE").otherwise("UPDATE_AFTER")
    feed = t.events.select(F.col("user_id").alias("k"), F.col("value").alias("v"), "ts", "event_id", kind.alias("op"))
    target = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"))
    return ch.apply_cdc(target, feed, ["k"], ["ts", "event_id"], "op")


@query("debezium_flatten", """
SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 2 THEN o_orderpriority ELSE o_orderstatus END AS state,
       CASE o_orderkey % 4 WHEN 1 THEN 'U' WHEN 2 THEN 'D' ELSE 'I' END AS op,
       CASE WHEN o_orderkey % 2 = 0 THEN 'dbo' ELSE 'shop' END || '.orders' AS source,
       'lake.' || CASE WHEN o_orderkey % 2 = 0 THEN 'dbo' ELSE 'shop' END || '_orders' AS target,
       make_timestamp(CAST(1700000000000 + o_orderkey AS BIGINT) * 1000) AS ts
FROM orders WHERE o_orderpriority <> '3-MEDIUM'""")
def debezium_flatten(t: Tables):
    k = F.col("o_orderkey")
    op = F.when(k % 4 == 0, "c").when(k % 4 == 1, "u").when(k % 4 == 2, "d").otherwise("r")
    row = lambda state: F.struct(k.alias("id"), F.col(state).alias("state"))
    feed = t.orders.select(
        F.when(F.col("o_orderpriority") != "3-MEDIUM", op).alias("op"), (k + 1700000000000).alias("ts_ms"),
        F.struct(F.lit("shop").alias("db"), F.when(k % 2 == 0, "dbo").alias("schema"), F.lit("orders").alias("table")).alias("source"),
        F.when(op.isin("u", "d"), row("o_orderpriority")).alias("before"), F.when(op != "d", row("o_orderstatus")).alias("after"))
    out = cdc.debezium_flatten(feed, "lake.{db}_{table}")
    return naive(out.select("id", "state", "_cdc.op", "_cdc.source", "_cdc.target", "_cdc.ts"), "ts")


@query("dms_flatten", """
SELECT s_suppkey AS id, s_name AS name, CASE s_suppkey % 4 WHEN 1 THEN 'U' WHEN 2 THEN 'D' ELSE 'I' END AS op, 'sales.supplier' AS source
FROM supplier WHERE s_acctbal >= 1000""")
def dms_flatten(t: Tables):
    k = F.col("s_suppkey")
    kind = F.when(k % 4 == 0, "load").when(k % 4 == 1, "update").when(k % 4 == 2, "delete").otherwise("insert")
    feed = t.supplier.select(
        F.when(F.col("s_acctbal") >= 1000, F.struct(k.alias("id"), F.col("s_name").alias("name"))).alias("data"),
        F.struct(kind.alias("operation"), F.lit("2024-01-01T00:00:00Z").alias("timestamp"),
                 F.lit("sales").alias("schema-name"), F.lit("supplier").alias("table-name")).alias("metadata"))
    return cdc.dms_flatten(feed).select("id", "name", "_cdc.op", "_cdc.source")


@query("mongo_partial_update", """
SELECT c_custkey::VARCHAR AS id, CASE c_custkey % 3 WHEN 0 THEN c_mktsegment WHEN 1 THEN 'moved' ELSE c_mktsegment END AS segment,
       CASE c_custkey % 3 WHEN 1 THEN NULL ELSE c_name END AS name FROM customer""")
def mongo_partial_update(t: Tables):
    k = F.col("c_custkey")
    whole = F.create_map(F.lit("_id"), k.cast("string"), F.lit("segment"), F.col("c_mktsegment"), F.lit("name"), F.col("c_name"))
    feed = t.customer.select(
        k.alias("id"), F.when(k % 3 != 0, whole).alias("before"), F.when(k % 3 == 0, whole).alias("after"),
        F.when(k % 3 == 1, F.create_map(F.lit("segment"), F.lit("moved"))).alias("updated"),
        F.when(k % 3 == 1, F.array(F.lit("name"))).alias("removed"))
    doc = F.col("document")
    return cdc.document_after(feed, "before", "after", "updated", "removed", "id").select(
        doc["_id"].alias("id"), doc["segment"].alias("segment"), doc["name"].alias("name"))


@query("attach_metadata", """
SELECT event_id AS value, 'clicks' AS _kafka_metadata_topic, CAST(user_id % 4 AS INTEGER) AS _kafka_metadata_partition, event_id AS _kafka_metadata_offset,
       ts AS _kafka_metadata_record_timestamp, 'eu' AS _kafka_metadata_region FROM events""")
def attach_metadata(t: Tables):
    feed = t.events.select(F.col("event_id").alias("value"), F.lit("clicks").alias("topic"),
                           (F.col("user_id") % 4).cast("int").alias("partition"), F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"))
    out = cdc.attach_metadata(feed, external=("region", "eu"))
    return out.drop("topic", "partition", "offset", "timestamp")


@query("merge_schema", """
SELECT event_id, user_id, value, CAST(NULL AS VARCHAR) AS props FROM events WHERE value < 50
UNION ALL SELECT event_id, user_id, CAST(NULL AS DOUBLE), props FROM events WHERE value >= 50""")
def merge_schema(t: Tables):
    old = t.events.where("value < 50").select("event_id", F.col("user_id").cast("int").alias("user_id"), "value")
    new = t.events.where("value >= 50").select("event_id", "user_id", "props")
    return sm.merge_schema(old, new)


@query("dedup_paths", "SELECT DISTINCT url AS path FROM (SELECT url FROM pages UNION ALL SELECT lower(url) FROM pages)")
def dedup_paths(t: Tables):
    paths = t.pages.select(F.col("url").alias("path"))
    return paths.union(t.pages.select(F.lower("url"))).dropDuplicates(["path"])
