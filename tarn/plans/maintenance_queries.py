"""Queries over layout, maintenance, sinks, routing and generators."""

from __future__ import annotations

import uuid

from pyspark.sql import Window, functions as F

from tarn.functions import transforms as tr
from tarn.functions.zorder import zorder_key
from tarn.operators import events as ev, jobs, layout as ly, lineage as ln, maintenance as mt, sinks as sn, stats as st
from tarn.operators.ordered import pack
from tarn.plans import fixtures as fx
from tarn.plans.event_queries import DEVICE_CASE, millis, naive
from tarn.plans.registry import Tables, query
from tarn.session import scratch
from tarn.sources import generators as gn
from tarn.sources.files import with_positions
from tarn.util import int_div, small_side

FILES = f"files AS ({fx.FILES_SQL})"
SIZING = mt.Sizing(target=240_000_000, max_group=1_500_000_000)


def greedy_sql(source: str, size: str, limit: int) -> str:
    """Sequential filling of bins per part, one file at a time."""
    return f"""
cand AS (SELECT file_no, part, {size} AS size, record_count, row_number() OVER (PARTITION BY part ORDER BY file_no) AS i FROM {source}),
fill AS (SELECT part, i, file_no, size, size AS used, 0::BIGINT AS bin FROM cand WHERE i = 1
  UNION ALL SELECT c.part, c.i, c.file_no, c.size, CASE WHEN f.used + c.size <= {limit} THEN f.used + c.size ELSE c.size END,
     CASE WHEN f.used + c.size <= {limit} THEN f.bin ELSE f.bin + 1 END
  FROM fill f JOIN cand c ON c.part IS NOT DISTINCT FROM f.part AND c.i = f.i + 1)"""


def outputs_sql(b: str, s: mt.Sizing) -> str:
    return f"""CASE WHEN {b} < {s.target} THEN 1 WHEN {b} % {s.target} > {s.smallest} THEN {b} // {s.target} + 1
      WHEN {b} // ({b} // {s.target}) < {min(1.1 * s.target, s.write_limit)} THEN {b} // {s.target}
      ELSE {b} // {s.target} + CASE WHEN {b} % {s.target} > 0 THEN 1 ELSE 0 END END"""


def live_data_files(t: Tables):
    return fx.files(t).where("content = 0").withColumn("deleted_records", F.when(F.col("file_no") % 9 == 0, int_div(F.col("record_count"), 2)))


@query("compaction_plan", f"""
WITH RECURSIVE {FILES}, chosen AS (SELECT * FROM files WHERE content = 0
   AND (file_size_in_bytes < {SIZING.smallest} OR file_size_in_bytes > {SIZING.largest} OR (file_no % 9 = 0 AND record_count // 2 >= 0.3 * record_count))),
{greedy_sql('chosen', 'file_size_in_bytes', SIZING.max_group)},
groups AS (SELECT part, bin, count(*) AS n, sum(size)::BIGINT AS b, bool_or(file_no % 9 = 0) AS heavy FROM fill GROUP BY ALL)
SELECT part, bin AS file_group, n AS input_files, b AS input_bytes, ({outputs_sql('b', SIZING)})::BIGINT AS output_files,
   CASE WHEN b // ({outputs_sql('b', SIZING)}) + 5120 < {SIZING.target} THEN {SIZING.target} ELSE least(b // ({outputs_sql('b', SIZING)}) + 5120, {SIZING.write_limit}) END::BIGINT AS split_size
FROM groups WHERE (n > 1 AND n >= 5) OR (n > 1 AND b > {SIZING.target}) OR b > {SIZING.largest} OR heavy""")
def compaction_plan(t: Tables):
    return mt.compaction_plan(live_data_files(t), ["part"], SIZING, order="file_no", job_order="bytes-desc")


@query("expected_output_files", f"""
SELECT o_orderkey, ({outputs_sql('b', mt.Sizing(target=1 << 30))})::BIGINT AS n FROM (SELECT o_orderkey, (o_totalprice * 100000)::BIGINT AS b FROM orders)""")
def expected_output_files(t: Tables):
    size = (F.round(F.col("o_totalprice") * 100000)).cast("bigint")
    return t.orders.select("o_orderkey", mt.output_files(size, mt.Sizing(target=1 << 30)).alias("n"))


@query("bin_packing", f"""
WITH RECURSIVE {FILES}, {greedy_sql('files', 'file_size_in_bytes', 900_000_000)} SELECT file_no, bin FROM fill""")
def bin_packing(t: Tables):
    return pack(fx.files(t), ["part"], ["file_no"], "file_size_in_bytes", 900_000_000).select("file_no", "bin")


@query("bin_packing_lookback")
def bin_packing_lookback(t: Tables):
    """Packing with ten open bins, heaviest closed first; checked against a plain loop in the tests."""
    return pack(fx.files(t), ["part"], ["file_no"], "file_size_in_bytes", 900_000_000, 10, True).select("file_no", "bin")


LEAST_WRITERS = 4


def sorting_writers(rows) -> int:
    return mt.writers_for(rows, LEAST_WRITERS, sorted_rows=ly.SORTED_ROWS)


def written(t: Tables, rows, keys):
    """Rows written out and read back, with whether their file is in order of the keys and overlaps no other."""
    path = scratch(t.spark, "layout")
    sn.write_files(rows, path)
    stored = with_positions(sn.read_back(t.spark, path, rows.schema))
    flags = ly.clustering(stored, keys(stored)).select(F.col("_file").alias("_f"), "in_order", "apart")
    return stored.join(small_side(flags), F.col("_file") == F.col("_f")).drop("_file", "_pos", "_f")


@query("compact_rows_equal", "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, TRUE AS even FROM lineitem")
def compact_rows_equal(t: Tables):
    """A bin-pack rewrite written out and read back; no file has over a tenth more than its share."""
    path = scratch(t.spark, "compact")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    writers = mt.writers_for(t.lineitem, LEAST_WRITERS)
    sn.write_files(mt.compact(rows, writers), path)
    stored = with_positions(sn.read_back(t.spark, path, rows.schema)).drop("_pos")
    loads = stored.groupBy(F.col("_file").alias("_f")).agg(F.count("*").alias("n"))
    loads = loads.select("_f", (F.col("n") * writers <= 1.1 * F.sum("n").over(Window.partitionBy()) + writers * 10).alias("even"))
    return stored.join(small_side(loads), F.col("_file") == F.col("_f")).drop("_file", "_f")


@query("sort_compact", "SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, TRUE AS in_order, TRUE AS apart FROM lineitem")
def sort_compact(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    out = mt.compact(rows, sorting_writers(t.lineitem), "sort", [ly.SortTerm("l_shipdate"), ly.SortTerm("l_orderkey", ascending=False)])
    return written(t, out, lambda df: [F.col("l_shipdate"), -F.col("l_orderkey")])


@query("zorder_layout", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, TRUE AS in_order, TRUE AS apart FROM lineitem")
def zorder_layout(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    out = mt.compact(rows, sorting_writers(t.lineitem), "zorder", zorder=[("l_partkey", "bigint"), ("l_suppkey", "bigint")])
    return written(t, out, lambda df: [zorder_key([(F.col("l_partkey"), "bigint"), (F.col("l_suppkey"), "bigint")])])


@query("zorder_bytes")
def zorder_bytes(t: Tables):
    """Binary z-order keys over number, text and time columns."""
    key = zorder_key([(F.col("o_totalprice"), "double"), (F.col("o_orderpriority"), "string"), (F.col("o_orderdate"), "timestamp_ntz")])
    return t.orders.select("o_orderkey", F.hex(key).alias("z"))


@query("write_distribution", "SELECT event_id, event_type, ts, TRUE AS in_order, TRUE AS apart FROM events")
def write_distribution(t: Tables):
    spec = [tr.PartitionField("ts", "day", data_type="timestamp_ntz")]
    rows = t.events.select("event_id", "event_type", "ts")
    order = ly.write_order(spec, [ly.SortTerm("event_type"), ly.SortTerm("event_id")])
    out = ly.distribute(rows, "range", spec, order, sorting_writers(t.events))
    return written(t, out, lambda df: [F.to_date("ts"), F.col("event_type"), F.col("event_id")])


@query("write_ordering", "SELECT event_id, event_type, ts, TRUE AS in_order FROM events")
def write_ordering(t: Tables):
    """Sorted as it lies, without a shuffle."""
    spec = [tr.PartitionField("event_type"), tr.PartitionField("ts", "month", data_type="timestamp_ntz")]
    order = [ly.SortTerm("event_type"), ly.SortTerm("ts", transform="day"), ly.SortTerm("event_id", ascending=False)]
    out = ly.distribute(t.events.select("event_id", "event_type", "ts"), "none", order=ly.write_order(spec, order))
    return written(t, out, lambda df: [F.col("event_type"), F.to_date("ts"), -F.col("event_id")]).drop("apart")


@query("distribute_by_key", """
SELECT event_id, user_id, FALSE AS split FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN -7 ELSE user_id END AS user_id FROM events)
WHERE user_id <> -7 UNION ALL SELECT event_id, -7, TRUE FROM events WHERE event_id % 3 = 0""")
def distribute_by_key(t: Tables):
    """Whether the rows of a key lie in several files: only the key with a third of all rows does."""
    rows = t.events.select("event_id", F.when(F.col("event_id") % 3 == 0, -7).otherwise(F.col("user_id")).alias("user_id"))
    path = scratch(t.spark, "by-key")
    sn.write_files(ly.distribute_by_key(rows, ["user_id"], WRITERS), path)
    stored = with_positions(sn.read_back(t.spark, path, rows.schema)).drop("_pos")
    files = stored.groupBy(F.col("user_id").alias("_u")).agg((F.min("_file") != F.max("_file")).alias("split"))
    return stored.join(files, F.col("user_id") == F.col("_u")).select("event_id", "user_id", "split")


@query("relayout", """
SELECT o_orderkey, o_orderdate, o_orderstatus, CAST((year(o_orderdate) - 1970) * 12 + month(o_orderdate) - 1 AS INTEGER) AS o_orderdate_month,
       CAST(o_orderkey - o_orderkey % 1000 AS BIGINT) AS o_orderkey_truncate, TRUE AS in_order, TRUE AS apart FROM orders""")
def relayout(t: Tables):
    spec = [tr.PartitionField("o_orderstatus"), tr.PartitionField("o_orderdate", "month", data_type="timestamp_ntz"), tr.PartitionField("o_orderkey", "truncate", 1000)]
    rows = t.orders.select("o_orderkey", "o_orderdate", "o_orderstatus")
    out = mt.relayout(rows, spec, [ly.SortTerm("o_orderkey")], sorting_writers(t.orders))
    return written(t, out, lambda df: [F.col("o_orderstatus"), F.col("o_orderdate_month"), F.col("o_orderkey")])


@query("bucket_route", """
SELECT event_id, CAST(user_id % 2 + 2 * (event_id % CASE WHEN user_id % 2 < 1 THEN 3 ELSE 2 END) AS INTEGER) AS writer, CAST(user_id % 16 % 5 AS INTEGER) AS few FROM events""")
def bucket_route(t: Tables):
    u, e = F.col("user_id"), F.col("event_id")
    return t.events.select("event_id", ly.bucket_writer(u % 2, 2, 5, e).alias("writer"), ly.bucket_writer(u % 16, 16, 5, e).alias("few"))


WRITERS = 8


@query("skew_assign", f"""
WITH w AS (SELECT user_id, count(*) AS weight FROM (SELECT CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id FROM events) GROUP BY 1),
tot AS (SELECT sum(weight)::DOUBLE / {WRITERS} AS even FROM w),
p AS (SELECT user_id, weight, (weight + ceil(even * 2 / 100) * ceil(weight / even))::BIGINT AS padded FROM w, tot),
l AS (SELECT *, (sum(padded) OVER (ORDER BY user_id))::BIGINT AS upto FROM p),
s AS (SELECT ceil(max(upto)::DOUBLE / {WRITERS})::BIGINT AS span FROM l)
SELECT user_id, weight, ((upto - padded) // span)::INTEGER AS first_writer, ((upto - 1) // span)::INTEGER AS last_writer FROM l, s""")
def skew_assign(t: Tables):
    """Writer ranges of users, one of whom has a third of all events."""
    rows = t.events.select(F.when(F.col("event_id") % 3 == 0, 7).otherwise(F.col("user_id")).alias("user_id"))
    weights = ly.key_weights(rows, "user_id")
    out = ly.assign_writers(weights, "user_id", int_div(F.col("user_id"), 64), WRITERS, 2)
    return out.select("user_id", "weight", "first_writer", "last_writer")


@query("skew_route", f"SELECT i::INTEGER AS writer, TRUE AS fair, 0::BIGINT AS shared_keys, (SELECT count(*) FROM events) AS all_rows FROM range({WRITERS}) r(i)")
def skew_route(t: Tables):
    """Load of each writer when a third of all rows share one key, routed by merged sketches of the days.

    No writer has over twice its share, and no other key lies on two of them.
    """
    rows = t.events.select("event_id", F.to_date("ts").alias("day"), F.when(F.col("event_id") % 3 == 0, 7).otherwise(F.col("user_id")).alias("user_id"))
    heavy, total = ly.heavy_keys(ly.key_sketches(rows, "user_id", WRITERS, ["day"]), WRITERS)
    routed = ly.sketched_writer(rows, "user_id", heavy, total, WRITERS, F.xxhash64("event_id"))
    per_key = routed.groupBy("user_id").agg(F.count_distinct("_writer").alias("writers")).where(~F.col("user_id").isin([k for k, _ in heavy]))
    shared = per_key.where("writers > 1").agg(F.count("*").alias("shared_keys")).scalar()
    loads = routed.groupBy(F.col("_writer").alias("writer")).agg(F.count("*").alias("rows"))
    return loads.select("writer", (F.col("rows") <= 2 * total / WRITERS).alias("fair"), shared.alias("shared_keys"), F.lit(total).cast("bigint").alias("all_rows"))


RANGES = 16


@query("range_bounds", f"SELECT i::INTEGER AS range, TRUE AS close FROM range({RANGES - 1}) r(i)")
def range_bounds(t: Tables):
    """Whether each bound of equal ranges, from merged sketches of the months, is within 1 % of the rows of its true rank."""
    rows = t.lineitem.select(tr.months(F.col("l_shipdate")).alias("month"), "l_extendedprice")
    bounds = ly.range_bounds(ly.range_sketches(rows, "l_extendedprice", ["month"]), RANGES).orderBy("range").collect()  # RANGES - 1 numbers
    below = rows.agg(F.count("*").alias("n"), F.array(*[F.count_if(F.col("l_extendedprice") <= r["bound"]) for r in bounds]).alias("below"))
    ranks = below.select("n", F.posexplode("below").alias("range", "rank"))
    return ranks.select("range", (F.abs(F.col("rank") / F.col("n") - (F.col("range") + 1) / RANGES) <= 0.01).alias("close"))


REFS_SQL = """refs AS (SELECT * FROM (VALUES ('main', 'BRANCH', 80::BIGINT, NULL::BIGINT, 3, NULL::BIGINT), ('audit', 'BRANCH', 63, NULL, 2, NULL),
   ('old', 'BRANCH', 13, 1000, 5, NULL), ('release', 'TAG', 33, NULL, NULL, NULL), ('stale', 'TAG', 23, 1000, NULL, NULL)) r(name, type, snapshot_id, max_age, min_keep, max_snapshot_age))"""


def refs(t: Tables):
    """Branches and tags at commits of the orders table."""
    picked = fx.snapshots(t).where("snapshot_id IN (80, 63, 13, 33, 23)").select("snapshot_id")
    s = F.col("snapshot_id")
    name = F.when(s == 80, "main").when(s == 63, "audit").when(s == 13, "old").when(s == 33, "release").otherwise("stale")
    return picked.select(
        name.alias("name"), F.when(s.isin(80, 63, 13), "BRANCH").otherwise("TAG").alias("type"), "snapshot_id",
        F.when(s.isin(13, 23), 1000).cast("bigint").alias("max_reference_age_in_ms"),
        F.when(s == 80, 3).when(s == 63, 2).when(s == 13, 5).alias("min_snapshots_to_keep"),
        F.lit(None).cast("bigint").alias("max_snapshot_age_in_ms"))


@query("refs_report", f"""
WITH {REFS_SQL} SELECT name, type, snapshot_id, max_age AS max_reference_age_in_ms, min_keep AS min_snapshots_to_keep, max_snapshot_age AS max_snapshot_age_in_ms
FROM refs WHERE snapshot_id IN (SELECT snapshot_id FROM ({fx.SNAPSHOTS_SQL}))""")
def refs_report(t: Tables):
    return ln.refs_report(refs(t))


KEPT_SQL = f"""RECURSIVE snapshots AS ({fx.SNAPSHOTS_SQL}), {REFS_SQL},
heads AS (SELECT refs.* FROM refs JOIN snapshots USING (snapshot_id) WHERE name = 'main' OR max_age IS NULL OR epoch_ms(TIMESTAMP '2001-09-01' - committed_at) <= max_age),
walk AS (SELECT name, min_keep, s.snapshot_id, parent_id, committed_at, 0 AS depth FROM heads JOIN snapshots s USING (snapshot_id) WHERE type = 'BRANCH'
   UNION ALL SELECT name, min_keep, s.snapshot_id, s.parent_id, s.committed_at, depth + 1 FROM walk JOIN snapshots s ON s.snapshot_id = walk.parent_id),
flagged AS (SELECT *, depth < min_keep OR committed_at >= TIMESTAMP '2001-01-01' AS ok FROM walk),
stops AS (SELECT name, min(depth) FILTER (NOT ok) AS stop FROM flagged GROUP BY 1),
kept AS (SELECT snapshot_id FROM heads UNION SELECT snapshot_id FROM flagged JOIN stops USING (name) WHERE stop IS NULL OR depth < stop
   UNION SELECT snapshot_id FROM snapshots WHERE committed_at >= TIMESTAMP '2001-01-01' AND snapshot_id NOT IN (SELECT snapshot_id FROM walk)
      AND snapshot_id NOT IN (SELECT snapshot_id FROM heads WHERE type = 'TAG'))"""

SNAPSHOT_FILES_SQL = f"sf AS (SELECT unnest(range(added_snapshot_id, least(coalesce(removed_snapshot_id, added_snapshot_id + 4), 81))) AS snapshot_id, file_path FROM files)"


def retained(t: Tables):
    at = lambda text: F.lit(text).cast("timestamp_ntz")
    return mt.retained_snapshots(fx.snapshots(t), refs(t), at("2001-09-01"), at("2001-01-01"))


def snapshot_files(t: Tables):
    """References of a few following commits to each file."""
    last = F.least(F.coalesce(F.col("removed_snapshot_id"), F.col("added_snapshot_id") + 4), F.lit(81)) - 1
    return fx.files(t).select(F.explode(F.sequence("added_snapshot_id", last)).alias("snapshot_id"), "file_path")


@query("retained_snapshots", f"WITH {KEPT_SQL} SELECT snapshot_id FROM kept")
def retained_snapshots(t: Tables):
    return retained(t)


@query("expire_snapshots", f"""
WITH {KEPT_SQL}, {FILES}, {SNAPSHOT_FILES_SQL}
SELECT DISTINCT file_path FROM sf WHERE snapshot_id NOT IN (SELECT snapshot_id FROM kept) EXCEPT SELECT file_path FROM sf WHERE snapshot_id IN (SELECT snapshot_id FROM kept)""")
def expire_snapshots(t: Tables):
    return mt.expired_files(snapshot_files(t), retained(t))


@query("reachable_files", f"""
WITH {FILES}, {SNAPSHOT_FILES_SQL}
SELECT file_path FROM sf UNION SELECT 'store://wh/metadata/snap-' || snapshot_id || '.avro' FROM sf UNION SELECT 'store://wh/metadata/m-' || file_no // 20 || '.avro' FROM files""")
def reachable_files(t: Tables):
    sf = snapshot_files(t)
    lists = sf.select(F.concat(F.lit("store://wh/metadata/snap-"), F.col("snapshot_id"), F.lit(".avro")))
    manifests = fx.files(t).select(F.concat(F.lit("store://wh/metadata/m-"), int_div(F.col("file_no"), 20), F.lit(".avro")))
    return mt.reachable_files(sf.select("file_path"), lists, manifests)


MONTHS_SQL = "CAST((year(l_shipdate) - 1970) * 12 + month(l_shipdate) - 1 AS INTEGER)"
LOC = r"'^([a-z]+)://([^/]*)(/.*)$'"
ORPHAN_SQL = f"""
WITH l AS (SELECT page_id, url AS file_path, TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * page_id AS last_modified FROM pages),
v AS (SELECT CASE WHEN url LIKE 'http://%' THEN replace(url, 'http://', 'https://') ELSE replace(url, '.example.', '.other.') END AS p FROM pages WHERE url NOT LIKE '%/fr/%'),
lp AS (SELECT *, replace(regexp_extract(file_path, {LOC}, 1), 'https', 'http') AS s, regexp_extract(file_path, {LOC}, 2) AS a, regexp_extract(file_path, {LOC}, 3) AS path FROM l
       WHERE last_modified < TIMESTAMP '2024-01-01' + INTERVAL 9000 HOUR),
vp AS (SELECT replace(regexp_extract(p, {LOC}, 1), 'https', 'http') AS s, regexp_extract(p, {LOC}, 2) AS a, regexp_extract(p, {LOC}, 3) AS path FROM v)
SELECT file_path, last_modified FROM lp WHERE NOT EXISTS (SELECT 1 FROM vp WHERE vp.path = lp.path __MATCH__)"""


def orphans(t: Tables, mismatch: str):
    hours = lambda n: F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=n)
    listing = t.pages.select(F.col("url").alias("file_path"), hours(F.col("page_id").cast("int")).alias("last_modified"))
    moved = F.when(F.col("url").startswith("http://"), F.replace("url", F.lit("http://"), F.lit("https://"))).otherwise(F.replace("url", F.lit(".example."), F.lit(".other.")))
    valid = t.pages.where("url NOT LIKE '%/fr/%'").select(moved.alias("file_path"))
    return mt.orphan_files(listing, valid, hours(F.lit(9000)), {"https": "http"}, mismatch=mismatch)


@query("orphan_files", ORPHAN_SQL.replace("__MATCH__", ""))
def orphan_files(t: Tables):
    return orphans(t, "ignore")


@query("orphan_files_delete", ORPHAN_SQL.replace("__MATCH__", "AND vp.s = lp.s AND vp.a = lp.a"))
def orphan_files_delete(t: Tables):
    return orphans(t, "delete")


@query("orphan_files_listed", f"""
SELECT DISTINCT {MONTHS_SQL} AS month FROM lineitem WHERE {MONTHS_SQL} % 3 = 0""")
def orphan_files_listed(t: Tables):
    """Orphans of a stored table, listed by tasks folder by folder: the metadata has lost every third month."""
    stored = fx.stored_months(t)
    known = stored.where("month % 3 <> 0").select(F.col("_metadata.file_path").alias("file_path")).distinct()
    root = stored.select(F.regexp_extract("_metadata.file_path", "^(.*)/month=", 1)).first()[0]  # with its scheme
    listing = mt.list_tree(t.spark, root).where(F.col("file_path").endswith(".parquet"))
    gone = mt.orphan_files(listing, known, F.lit("9999-01-01").cast("timestamp"))
    return gone.select(F.regexp_extract("file_path", "/month=([0-9]+)/", 1).cast("int").alias("month"))


@query("import_files_plan", """
SELECT l_returnflag, l_linestatus, count(*) AS record_count FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL""")
def import_files_plan(t: Tables):
    """Plan the import of a partitioned folder, then count its rows by the planned files."""
    path = scratch(t.spark, "import")
    sn.write_files(t.lineitem.select("l_orderkey", "l_returnflag", "l_linestatus"), path, partition=["l_returnflag", "l_linestatus"])
    plan = mt.import_plan(mt.list_tree(t.spark, path), ["l_returnflag", "l_linestatus"], {"l_returnflag": "R"})
    rows = t.spark.read.schema("l_orderkey bigint").option("recursiveFileLookup", "true").parquet(path)
    counts = rows.groupBy(F.col("_metadata.file_path").alias("p")).agg(F.count("*").alias("n"))
    bare = lambda c: F.regexp_replace(c, r"^[a-z0-9]+:/+", "/")
    named = plan.join(counts, bare(F.col("file_path")) == bare(F.col("p")))
    return named.groupBy("l_returnflag", "l_linestatus").agg(F.sum("n").alias("record_count"))


@query("rewrite_paths", f"""
WITH {FILES} SELECT file_path AS source_path, 'copy://backup/' || substr(file_path, length('store://wh/') + 1) AS target_path FROM files""")
def rewrite_paths(t: Tables):
    return mt.rewrite_paths(fx.files(t), "store://wh/", "copy://backup/")


@query("table_changes", f"""
WITH {FILES} SELECT added_snapshot_id AS snapshot_id, count(*) FILTER (content = 0) AS data_file_count,
  coalesce(sum(file_size_in_bytes) FILTER (content = 0), 0)::BIGINT AS data_file_size, count(*) FILTER (content = 1) AS pos_delete_file_count,
  coalesce(sum(record_count) FILTER (content = 1), 0)::BIGINT AS pos_delete_record_count, count(*) FILTER (content = 2) AS eq_delete_file_count,
  coalesce(sum(record_count) FILTER (content = 2), 0)::BIGINT AS eq_delete_record_count FROM files GROUP BY 1""")
def table_changes(t: Tables):
    return st.table_changes(fx.files(t))


@query("maintenance_trigger", f"""
WITH RECURSIVE {FILES}, commits AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY s) AS i FROM (SELECT part, sequence_number AS s, sum(record_count)::BIGINT AS n FROM files GROUP BY ALL)),
w AS (SELECT part, s, i, CASE WHEN n >= 900 THEN 0 ELSE n END AS total, n >= 900 AS fires FROM commits WHERE i = 1
  UNION ALL SELECT c.part, c.s, c.i, CASE WHEN w.total + c.n >= 900 THEN 0 ELSE w.total + c.n END, w.total + c.n >= 900
  FROM w JOIN commits c ON c.part IS NOT DISTINCT FROM w.part AND c.i = w.i + 1)
SELECT part, s AS sequence_number, fires FROM w""")
def maintenance_trigger(t: Tables):
    commits = fx.files(t).groupBy("part", "sequence_number").agg(F.sum("record_count").alias("records"))
    timed = commits.withColumn("at", F.timestamp_seconds(F.col("sequence_number") * 60))
    return mt.maintenance_trigger(timed, ["part"], ["sequence_number"], "at", {"records": 900}).select("part", "sequence_number", "fires")


@query("sink_json_roundtrip", "SELECT event_id, user_id, event_type, value FROM events")
def sink_json_roundtrip(t: Tables):
    path = scratch(t.spark, "json")
    rows = t.events.select("event_id", "user_id", "event_type", "value")
    sn.write_files(rows, path, "json")
    return sn.read_back(t.spark, path, rows.schema, "json")


@query("sink_time_buckets", """
SELECT event_id, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour FROM events""")
def sink_time_buckets(t: Tables):
    path = scratch(t.spark, "buckets")
    rows = sn.with_time_buckets(t.events.select("event_id", "ts"), "ts").drop("ts")
    cols = ["year", "month", "day", "hour"]
    sn.write_files(rows, path, partition=cols, cluster=True)
    return sn.read_back(t.spark, path, "event_id bigint, year string, month string, day string, hour string")


@query("sink_dt_hr", """
SELECT event_id, value AS price, strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hr FROM events WHERE value > 50""")
def sink_dt_hr(t: Tables):
    path = scratch(t.spark, "dt-hr")
    rows = ev.with_day_and_hour_text(t.events.where("value > 50"), "ts").select("event_id", F.col("value").alias("price"), "dt", "hr")
    sn.write_files(rows, path, partition=["dt", "hr"], cluster=True)
    return sn.read_back(t.spark, path, "event_id bigint, price double, dt string, hr string")


@query("write_mode_append", "SELECT event_id, event_type FROM events")
def write_mode_append(t: Tables):
    path = scratch(t.spark, "append")
    rows = t.events.select("event_id", "event_type")
    for part in ("event_type IN ('click', 'view')", "event_type NOT IN ('click', 'view')"):
        sn.write_table(rows.where(part), "append", path, ["event_type"])
    return sn.read_back(t.spark, path, "event_id bigint, event_type string")


@query("write_mode_overwrite", """
SELECT event_id, event_type, 'old' AS origin FROM events WHERE event_type NOT IN ('click', 'view') UNION ALL SELECT event_id, event_type, 'new' FROM events WHERE event_type IN ('click', 'view') AND value > 50""")
def write_mode_overwrite(t: Tables):
    """Dynamic overwrite: only the partitions written again are replaced."""
    path = scratch(t.spark, "overwrite")
    rows = t.events.select("event_id", "event_type", "value")
    sn.write_table(rows.drop("value").withColumn("origin", F.lit("old")), "append", path, ["event_type"])
    new = rows.where("event_type IN ('click', 'view') AND value > 50").drop("value").withColumn("origin", F.lit("new"))
    sn.write_table(new, "overwrite", path, ["event_type"])
    return sn.read_back(t.spark, path, "event_id bigint, origin string, event_type string")


@query("write_mode_upsert", """
SELECT c_custkey AS k, coalesce(v, c_acctbal) AS v FROM customer LEFT JOIN (SELECT user_id, max_by(value, event_id) AS v FROM events GROUP BY 1) ON user_id = c_custkey""")
def write_mode_upsert(t: Tables):
    path = scratch(t.spark, "upsert")
    current = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"))
    new = t.events.select(F.col("user_id").alias("k"), F.col("value").alias("v"), "event_id")
    sn.write_table(new, "upsert", path, keys=["k"], order=["event_id"], current=current)
    return sn.read_back(t.spark, path, "k bigint, v double")


@query("to_message", """
SELECT event_type AS key, '{"event_id":' || event_id || ',"user_id":' || user_id || '}' AS value FROM events""")
def to_message(t: Tables):
    return sn.to_messages(t.events, "event_type", ["event_id", "user_id"])


@query("key_partition", """
SELECT k AS key, count(*) AS n, 1::BIGINT AS partitions, TRUE AS in_range, k IS NULL AS is_first
FROM (SELECT CASE WHEN event_id % 3 <> 0 THEN user_id::VARCHAR END AS k FROM events) GROUP BY k""")
def key_partition(t: Tables):
    """Rows and message partitions per key; a third of the rows have no key and go to the first partition."""
    key = F.when(F.col("event_id") % 3 != 0, F.col("user_id").cast("string"))
    rows = t.events.select(key.alias("key"), sn.key_partition(key, 12).alias("partition"))
    return rows.groupBy("key").agg(
        F.count("*").alias("n"), F.count_distinct("partition").alias("partitions"),
        F.bool_and(F.col("partition").between(0, 11)).alias("in_range"),
        (F.col("key").isNull() & (F.max("partition") == 0)).alias("is_first"))


@query("snapshot_table", """
SELECT l_returnflag, l_linestatus, count(*) AS record_count, 0 AS content, 1::BIGINT AS added_snapshot_id, TRUE AS has_size, sum(l_orderkey)::BIGINT AS live_sum
FROM lineitem GROUP BY ALL""")
def snapshot_table(t: Tables):
    """A stored table taken over as the first commit of a new one, and its rows read through the new table's files."""
    path = scratch(t.spark, "source")
    sn.write_files(t.lineitem.select("l_orderkey", "l_returnflag", "l_linestatus"), path, partition=["l_returnflag", "l_linestatus"])
    source = t.spark.read.schema("l_orderkey bigint, l_returnflag string, l_linestatus string").parquet(path)
    files = mt.snapshot_table(source, ["l_returnflag", "l_linestatus"])
    rows = source.select("l_orderkey", F.col("_metadata.file_path").alias("file_path"))
    live = ln.rows_of_files(rows, files.select("file_path"), "file_path").groupBy("file_path").agg(F.sum("l_orderkey").alias("s"))
    named = files.join(live, "file_path")
    return named.groupBy("l_returnflag", "l_linestatus", "content", "added_snapshot_id").agg(
        F.sum("record_count").alias("record_count"), F.bool_and(F.col("file_size_in_bytes") > 0).alias("has_size"), F.sum("s").alias("live_sum"))


@query("timeseries_shape", """
SELECT 'temperature' AS metric, (user_id % 10)::VARCHAR AS room, user_id::VARCHAR AS sensor, value, ts FROM events""")
def timeseries_shape(t: Tables):
    rows = t.events.select((F.col("user_id") % 10).alias("room"), F.col("user_id").alias("sensor"), "value", "ts")
    series = sn.ordered_by_labels(sn.to_time_series(rows, "temperature", {"roomId": "room", "sensorId": "sensor"}, "value", "ts"))
    return series.select("metric", F.col("labels")["roomId"].alias("room"), F.col("labels")["sensorId"].alias("sensor"), "value", "ts")


@query("route_static", """
SELECT event_id, 'clicks' AS tbl FROM events WHERE event_type = 'click' UNION ALL SELECT event_id, 'c_or_p' FROM events WHERE event_type IN ('click', 'purchase')
UNION ALL SELECT event_id, 'long' FROM events WHERE length(event_type) >= 6""")
def route_static(t: Tables):
    tables = {"clicks": "click", "c_or_p": "[cp].*", "long": ".{6,}", "unrouted": None}
    return sn.route_static(t.events, tables, "event_type", "tbl").select("event_id", "tbl")


@query("route_dynamic", """
SELECT event_id, lower(r) AS tbl FROM (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'DB.' || upper(event_type) END AS r FROM events) WHERE r IS NOT NULL""")
def route_dynamic(t: Tables):
    route = F.when(F.col("event_id") % 5 != 0, F.concat(F.lit("DB."), F.upper("event_type")))
    return sn.route_dynamic(t.events.withColumn("r", route), "r", "tbl").select("event_id", "tbl")


@query("split_by_type", "SELECT event_id, event_type, 'event_type=' || event_type AS folder FROM events")
def split_by_type(t: Tables):
    """One write puts every event type into a folder of its own; all are read back with their folder."""
    path = scratch(t.spark, "split")
    sn.write_files(t.events.select("event_id", "event_type"), path, partition=["event_type"])
    rows = sn.read_back(t.spark, path, "event_id bigint, event_type string")
    return rows.select("event_id", "event_type", F.element_at(F.split("_metadata.file_path", "/"), -2).alias("folder"))


@query("wap_publish", """
WITH staged AS (SELECT event_id % 40 AS wap_id, event_id, value FROM events), ok AS (SELECT wap_id FROM staged GROUP BY 1 HAVING max(value) < 400 AND count(*) > 10)
SELECT event_id, value FROM staged WHERE wap_id IN (SELECT wap_id FROM ok) AND wap_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey < 5)""")
def wap_publish(t: Tables):
    staged = t.events.select((F.col("event_id") % 40).alias("wap_id"), "event_id", "value")
    audit = sn.audit_staged(staged, "wap_id", {"small": F.max("value") < 400, "enough": F.count("*") > 10})
    done = t.customer.where("c_custkey < 5").select(F.col("c_custkey").alias("wap_id"))
    return sn.publish_staged(staged, "wap_id", audit, done).select("event_id", "value")


@query("ctas_roundtrip", "SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def ctas_roundtrip(t: Tables):
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_name", "n_name")
    return sn.create_table_as(joined, f"tarn_ctas_{uuid.uuid4().hex}", scratch(t.spark, "ctas"))


@query("job_from_config", f"""
SELECT event_id, device_type, event_type, make_timestamp(epoch_us(ts) // 1000 * 1000) AS event_time,
   coalesce(lower(device_type) IN ('ios', 'android', 'mobile'), FALSE) AS is_mobile, CAST(ts AS DATE) AS event_date, CAST(hour(ts) AS INTEGER) AS event_hour
FROM (SELECT *, {DEVICE_CASE} AS device_type FROM events) WHERE event_type <> 'error'""")
def job_from_config(t: Tables):
    """A job read from configuration, over JSON payloads."""
    body = F.to_json(F.struct("event_id", F.expr(DEVICE_CASE).alias("device_type"), "event_type", millis().alias("timestamp_ms")))
    config = {
        "source": {"format": "kafka", "fields": [{"name": "event_id", "type": "bigint"}, {"name": "device_type", "type": "string"},
                                                 {"name": "event_type", "type": "string"}, {"name": "timestamp_ms", "type": "bigint"}]},
        "transforms": ["with_event_time", "user_enriched", {"name": "date_and_hour", "ts": "event_time"},
                       {"name": "where", "condition": "event_type <> 'error'"}],
        "sink": {"format": "parquet"}}
    out = jobs.build_job(config, t.events.select(body.alias("value")))
    return naive(out.drop("timestamp_ms"), "event_time")


def noise_sql(id: str, seed: int) -> str:
    """The generator's mixing function in SQL."""
    x = f"(({id} % 2147483648 * 2654435761 + {seed * 40503}) % 4294967296)"
    x = f"(xor({x}, {x} >> 15) * 1540483477 % 4294967296)"
    return f"xor({x}, {x} >> 13)"


def field_sql(field: gn.Field, id: str, seed: int) -> str:
    n = noise_sql(id, seed)
    if field.kind == "sequence":
        return f"{id} + {field.low}"
    if field.kind == "int":
        return f"{n} % {field.high - field.low + 1} + {field.low}"
    if field.kind == "decimal":
        unit = 10**field.digits
        return f"({n} % {(field.high - field.low) * unit + 1} + {field.low * unit})::DOUBLE / {unit}"
    return f"{list(field.choices)}[{n} % {len(field.choices)} + 1]"


def generated_sql(fields: list[gn.Field], id: str, table: str, seed: int) -> str:
    columns = [f"{field_sql(f, id, seed + i)} AS {f.name}" for i, f in enumerate(fields)]
    return f"SELECT {id}, {', '.join(columns)} FROM {table}"


SENSOR = [gn.Field("seq", "sequence", low=1), gn.Field("reading", "decimal", -20, 60, 1), gn.Field("room", "int", 1, 12), gn.Field("unit", "choice", choices=("C", "F"))]


@query("datagen_stock", generated_sql(gn.STOCK, "event_id", "events", 11))
def datagen_stock(t: Tables):
    """Prices generated for every event id."""
    return gn.generate(t.events, "event_id", gn.STOCK, 11, keep=["event_id"])


@query("datagen_spec", generated_sql(SENSOR, "o_orderkey", "orders", 3))
def datagen_spec(t: Tables):
    return gn.generate(t.orders, "o_orderkey", SENSOR, seed=3, keep=["o_orderkey"])


@query("datagen_bid", generated_sql(gn.BID, "event_id", "events", 5))
def datagen_bid(t: Tables):
    return gn.generate(t.events, "event_id", gn.BID, 5, keep=["event_id"])


@query("datagen_user", generated_sql(gn.USER, "event_id", "events", 6))
def datagen_user(t: Tables):
    return gn.generate(t.events, "event_id", gn.USER, 6, keep=["event_id"])


@query("datagen_order", generated_sql(gn.ORDER, "o_orderkey", "orders", 8))
def datagen_order(t: Tables):
    return gn.generate(t.orders, "o_orderkey", gn.ORDER, 8, keep=["o_orderkey"])


@query("datagen_ride", f"""
SELECT 'evt_' || lpad(event_id::VARCHAR, greatest(6, length(event_id::VARCHAR))::INTEGER, '0') AS event_id, 'user_' || lpad(user_no::VARCHAR, 4, '0') AS user_id, event_type,
  ms AS timestamp, 'ride_' || lpad(ride_no::VARCHAR, 5, '0') AS ride_id, surge_multiplier, estimated_wait_minutes, fare_amount, driver_rating
FROM ({generated_sql(gn.RIDE, 'event_id', 'events', 7)}) g JOIN (SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events) USING (event_id)""")
def datagen_ride(t: Tables):
    rides = gn.ride_events(t.events, "event_id", millis(), 7)
    return rides.select("event_id", "user_id", "event_type", "timestamp", "ride_id", "metadata.*")
