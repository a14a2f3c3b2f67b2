"""Queries over row-level commands, deletes, statistics and data skipping."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarn.functions import transforms as tr
from tarn.operators import deletes as dl, layout as ly, lineage as ln, merge as mg, sinks as sn, skipping as sk, stats as st
from tarn.plans import fixtures as fx
from tarn.plans.registry import Tables, query
from tarn.session import scratch
from tarn.sources.files import with_positions
from tarn.util import int_div, small_side

FILES = f"files AS ({fx.FILES_SQL})"
SNAPS = f"snapshots AS ({fx.SNAPSHOTS_SQL})"

MERGE_SQL = """
WITH src AS (SELECT l_orderkey AS k, max(l_extendedprice) AS price, max(l_returnflag) AS flag FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01' GROUP BY 1
             UNION ALL SELECT o_orderkey + 10000000, o_totalprice, o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT'),
     tgt AS (SELECT o_orderkey AS k, o_totalprice AS price, o_orderstatus AS flag FROM orders)
SELECT coalesce(t.k, s.k) AS k,
       CASE WHEN t.k IS NULL THEN s.price WHEN s.k IS NOT NULL AND s.flag = 'R' THEN t.price + s.price ELSE t.price END AS price,
       CASE WHEN t.k IS NULL THEN 'new' WHEN s.k IS NOT NULL AND s.flag = 'R' THEN s.flag __BY_SOURCE__ ELSE t.flag END AS flag
FROM tgt t FULL JOIN src s ON t.k = s.k
WHERE NOT (t.k IS NOT NULL AND s.k IS NOT NULL AND s.flag = 'A' AND t.price > 200000)
  AND NOT (t.k IS NULL AND s.price < 50000) __DROP__"""


def merge_inputs(t: Tables):
    target = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("flag"))
    lines = t.lineitem.where("l_shipdate < timestamp_ntz'1998-01-01'").groupBy(F.col("l_orderkey").alias("k")).agg(
        F.max("l_extendedprice").alias("price"), F.max("l_returnflag").alias("flag"))
    new = t.orders.where("o_orderpriority = '1-URGENT'").select((F.col("o_orderkey") + 10000000).alias("k"), "o_totalprice", "o_orderstatus")
    return target, lines.union(new)


MATCHED = lambda: [mg.Clause("delete", (F.col("s.flag") == "A") & (F.col("t.price") > 200000)),
                   mg.Clause("update", F.col("s.flag") == "R", {"price": F.col("t.price") + F.col("s.price"), "flag": F.col("s.flag")})]
INSERT = lambda: [mg.Clause("insert", F.col("s.price") >= 50000, {"k": F.col("s.k"), "price": F.col("s.price"), "flag": F.lit("new")})]


@query("merge_into", MERGE_SQL.replace("__BY_SOURCE__", "").replace("__DROP__", ""))
def merge_into(t: Tables):
    target, source = merge_inputs(t)
    return mg.merge(target, source, ["k"], MATCHED(), INSERT())


@query("merge_by_source", MERGE_SQL.replace("__BY_SOURCE__", "WHEN s.k IS NULL AND t.flag = 'P' THEN 'stale'")
       .replace("__DROP__", "AND NOT (s.k IS NULL AND t.flag = 'F')"))
def merge_by_source(t: Tables):
    target, source = merge_inputs(t)
    by_source = [mg.Clause("delete", F.col("t.flag") == "F"),
                 mg.Clause("update", F.col("t.flag") == "P", {"flag": F.lit("stale")})]
    return mg.merge(target, source, ["k"], MATCHED(), INSERT(), by_source)


@query("merge_star", """
WITH src AS (SELECT c_custkey AS k, c_acctbal AS price, c_mktsegment AS flag FROM customer),
     tgt AS (SELECT o_orderkey AS k, o_totalprice AS price, o_orderstatus AS flag FROM orders WHERE o_orderstatus <> 'F')
SELECT coalesce(t.k, s.k) AS k, CASE WHEN s.k IS NULL THEN t.price ELSE s.price END AS price, CASE WHEN s.k IS NULL THEN t.flag ELSE s.flag END AS flag
FROM tgt t FULL JOIN src s ON t.k = s.k""")
def merge_star(t: Tables):
    """UPDATE * and INSERT *."""
    target = t.orders.where("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("flag"))
    source = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("price"), F.col("c_mktsegment").alias("flag"))
    return mg.merge(target, source, ["k"], [mg.Clause("update")], [mg.Clause("insert")])


@query("merge_on_condition", """
WITH src AS (SELECT c_custkey AS id, 0.0::DOUBLE AS low, 250000.0::DOUBLE AS high, c_mktsegment AS w FROM customer WHERE c_custkey % 3 <> 0
             UNION ALL SELECT c_custkey, 300000.0, 1e9, 'high' FROM customer WHERE c_custkey % 2 = 0),
     tgt AS (SELECT o_orderkey AS id, o_custkey AS k, o_totalprice AS price, o_orderstatus AS flag FROM orders)
SELECT t.id, t.k, t.price, CASE WHEN s.id IS NOT NULL THEN s.w WHEN t.flag = 'P' THEN 'stale' ELSE t.flag END AS flag
FROM tgt t LEFT JOIN src s ON t.k = s.id AND t.price >= s.low AND t.price < s.high
UNION ALL SELECT NULL, s.id, s.low, 'new' FROM src s WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.k = s.id AND t.price >= s.low AND t.price < s.high)""")
def merge_on_condition(t: Tables):
    """Orders meet the price band of their customer that they fall in; key columns differ in name."""
    target = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("k"), F.col("o_totalprice").alias("price"),
                             F.col("o_orderstatus").alias("flag"))
    band = lambda rows, low, high, w: rows.select(F.col("c_custkey").alias("id"), F.lit(low).alias("low"), F.lit(high).alias("high"), w.alias("w"))
    source = band(t.customer.where("c_custkey % 3 <> 0"), 0.0, 250000.0, F.col("c_mktsegment")).union(
        band(t.customer.where("c_custkey % 2 = 0"), 300000.0, 1e9, F.lit("high")))
    return mg.merge(target, source, [("k", "id")], [mg.Clause("update", None, {"flag": F.col("s.w")})],
                    [mg.Clause("insert", None, {"k": F.col("s.id"), "price": F.col("s.low"), "flag": F.lit("new")})],
                    [mg.Clause("update", F.col("t.flag") == "P", {"flag": F.lit("stale")})],
                    (F.col("t.price") >= F.col("s.low")) & (F.col("t.price") < F.col("s.high")))


@query("merge_cardinality", """
SELECT l_orderkey AS k, count(*) AS source_rows FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1 HAVING count(*) > 1""")
def merge_cardinality(t: Tables):
    target = t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("k"))
    return mg.cardinality_violations(target, t.lineitem.select(F.col("l_orderkey").alias("k")), ["k"])


@query("touched_files", f"""
SELECT DISTINCT l_orderkey // {fx.ORDERS_PER_FILE} AS file_no FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 499000)""")
def touched_files(t: Tables):
    rows = t.lineitem.select("l_orderkey", fx.file_no().alias("file_no"))
    matches = t.orders.where("o_totalprice > 499000").select(F.col("o_orderkey").alias("l_orderkey"))
    return mg.touched_files(rows, matches, ["l_orderkey"], "file_no")


HIT = "(CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE l_quantity END) > 25"


def lines(t: Tables):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")


@query("delete_cow", f"SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag FROM lineitem WHERE coalesce(NOT ({HIT}), TRUE)")
def delete_cow(t: Tables):
    return mg.delete_where(lines(t), F.expr(HIT))


@query("delete_mor", f"SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag FROM lineitem WHERE coalesce(NOT ({HIT}), TRUE)")
def delete_mor(t: Tables):
    """Position deletes written and then applied: the same rows as the copy-on-write form."""
    rows = fx.stored_months(t).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag", F.col("month").alias("_file"),
                                      F.col("_metadata.row_index").alias("_pos")).withColumn("sequence_number", F.lit(1))
    found = mg.delete_where(rows, F.expr(HIT), "merge-on-read").withColumn("sequence_number", F.lit(1))
    return dl.apply_position_deletes(rows, found, "_file", "_pos", by_file=True).drop("_file", "_pos", "sequence_number")


@query("update_cow", f"""
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN {HIT} THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
       CASE WHEN {HIT} THEN 'X' ELSE l_returnflag END AS l_returnflag FROM lineitem""")
def update_cow(t: Tables):
    return mg.update_where(lines(t), F.expr(HIT), {"l_quantity": F.col("l_quantity") + 1, "l_returnflag": F.lit("X")})


@query("update_mor", f"""
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN {HIT} THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
       CASE WHEN {HIT} THEN 'X' ELSE l_returnflag END AS l_returnflag FROM lineitem""")
def update_mor(t: Tables):
    """Position deletes and added rows of an update, applied: the same rows as the copy-on-write form."""
    rows = with_positions(t.lineitem).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag", "_file", "_pos")
    gone, added = mg.update_delta(rows, F.expr(HIT), {"l_quantity": F.col("l_quantity") + 1, "l_returnflag": F.lit("X")})
    kept = dl.apply_position_deletes(rows.withColumn("sequence_number", F.lit(1)), gone.withColumn("sequence_number", F.lit(1)), "_file", "_pos")
    return kept.drop("_file", "_pos", "sequence_number").unionByName(added)


@query("merge_mor", MERGE_SQL.replace("__BY_SOURCE__", "").replace("__DROP__", ""))
def merge_mor(t: Tables):
    """Position deletes and added rows of the same merge, applied."""
    _, source = merge_inputs(t)
    target = with_positions(t.orders).select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("flag"), "_file", "_pos")
    gone, added = mg.merge_delta(target, source, ["k"], MATCHED(), INSERT())
    kept = dl.apply_position_deletes(target.withColumn("sequence_number", F.lit(1)), gone.withColumn("sequence_number", F.lit(1)), "_file", "_pos")
    return kept.select("k", "price", "flag").unionByName(added)


@query("update_nested", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' ELSE c_mktsegment END AS segment, c_nationkey AS nation FROM customer""")
def update_nested(t: Tables):
    rows = t.customer.select("c_custkey", "c_acctbal", F.struct(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation")).alias("info"))
    out = mg.update_where(rows, F.col("c_acctbal") < 0, {"info.segment": F.lit("debt")})
    return out.select("c_custkey", "info.segment", "info.nation")


@query("apply_equality_deletes", """
WITH d AS (SELECT l_orderkey, CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE l_returnflag END AS flag, l_linenumber, l_partkey, l_partkey % 50 AS seq FROM lineitem),
del AS (SELECT c_custkey AS l_orderkey, c_custkey % 40 AS seq FROM customer), del2 AS (SELECT CASE WHEN s_suppkey % 2 = 0 THEN NULL ELSE 'A' END AS flag, s_suppkey % 30 AS seq FROM supplier)
SELECT * FROM d WHERE NOT EXISTS (SELECT 1 FROM del WHERE del.l_orderkey = d.l_orderkey AND d.seq < del.seq)
  AND NOT EXISTS (SELECT 1 FROM del2 WHERE del2.flag IS NOT DISTINCT FROM d.flag AND d.seq < del2.seq)""")
def apply_equality_deletes(t: Tables):
    data, sets = equality_inputs(t)
    return dl.apply_equality_deletes(data, sets, "seq")


def equality_inputs(t: Tables):
    data = t.lineitem.select("l_orderkey", F.when(F.col("l_suppkey") % 9 != 0, F.col("l_returnflag")).alias("flag"),
                             "l_linenumber", "l_partkey", (F.col("l_partkey") % 50).alias("seq"))
    by_key = t.customer.select(F.col("c_custkey").alias("l_orderkey"), (F.col("c_custkey") % 40).alias("seq"))
    by_flag = t.supplier.select(F.when(F.col("s_suppkey") % 2 != 0, "A").alias("flag"), (F.col("s_suppkey") % 30).alias("seq"))
    return data, [(by_key, ["l_orderkey"]), (by_flag, ["flag"])]


@query("eq_to_position_deletes", """
WITH d AS (SELECT event_id, user_id, event_id // 1000 AS file_no, event_id % 1000 AS pos, event_id % 50 AS seq FROM events),
del AS (SELECT c_custkey AS user_id, c_custkey % 40 AS seq FROM customer WHERE c_acctbal > 5000)
SELECT file_no, pos FROM d WHERE EXISTS (SELECT 1 FROM del WHERE del.user_id = d.user_id AND d.seq < del.seq)""")
def eq_to_position_deletes(t: Tables):
    e = F.col("event_id")
    data = t.events.select("user_id", int_div(e, 1000).alias("file_no"), (e % 1000).alias("pos"), (e % 50).alias("seq"))
    gone = t.customer.where("c_acctbal > 5000").select(F.col("c_custkey").alias("user_id"), (F.col("c_custkey") % 40).alias("seq"))
    return dl.equality_to_position_deletes(data, [(gone, ["user_id"])], "file_no", "pos", "seq")


POS_SQL = """
WITH d AS (SELECT event_id, event_id // 1000 AS file_path, event_id % 1000 AS pos, event_id % 7 AS sequence_number FROM events),
del AS (SELECT c_custkey % 12 AS file_path, c_custkey % 1000 AS pos, c_custkey % 9 AS sequence_number FROM customer)"""


def positions(t: Tables):
    c = F.col("c_custkey")
    return fx.stored_events(t), t.customer.select((c % 12).alias("file_path"), (c % 1000).alias("pos"), (c % 9).alias("sequence_number"))


@query("apply_position_deletes", POS_SQL + """
SELECT * FROM d WHERE NOT EXISTS (SELECT 1 FROM del WHERE del.file_path = d.file_path AND del.pos = d.pos AND d.sequence_number <= del.sequence_number)""")
def apply_position_deletes(t: Tables):
    return dl.apply_position_deletes(*positions(t), by_file=True)


@query("mark_deleted", POS_SQL + """
SELECT *, EXISTS (SELECT 1 FROM del WHERE del.file_path = d.file_path AND del.pos = d.pos AND d.sequence_number <= del.sequence_number) AS _deleted FROM d""")
def mark_deleted(t: Tables):
    return dl.mark_deleted(*positions(t), by_file=True)


PD_SQL = f"""pd AS (SELECT 'store://wh/data/f-' || lpad(CAST(event_id % 400 AS VARCHAR), 12, '0') || '.parquet' AS file_path, event_id // 400 AS pos FROM events)"""


def position_deletes(t: Tables):
    e = F.col("event_id")
    path = F.concat(F.lit("store://wh/data/f-"), F.lpad((e % 400).cast("string"), 12, "0"), F.lit(".parquet"))
    return t.events.select(path.alias("file_path"), int_div(e, 400).alias("pos"))


@query("valid_position_deletes", f"WITH {FILES}, {PD_SQL} SELECT * FROM pd WHERE file_path IN (SELECT file_path FROM files WHERE content = 0)")
def valid_position_deletes(t: Tables):
    return dl.valid_position_deletes(position_deletes(t), fx.files(t))


@query("position_deletes_report", f"""
WITH {FILES}, {PD_SQL}
SELECT pd.file_path, pos, part AS partition, spec_id, TRUE AS stored FROM pd LEFT JOIN (SELECT * FROM files WHERE content = 0) f ON f.file_path = pd.file_path""")
def position_deletes_report(t: Tables):
    """Stored position deletes as rows, with what is known of the data files they reach."""
    path = scratch(t.spark, "position-deletes")
    written = position_deletes(t)
    sn.write_files(written, path)
    stored = sn.read_back(t.spark, path, written.schema).select("*", F.col("_metadata.file_path").alias("delete_file_path"))
    report = dl.position_deletes_report(stored, fx.files(t))
    return report.select("file_path", "pos", "partition", "spec_id", F.col("delete_file_path").contains("position-deletes-").alias("stored"))


@query("compact_deletes", f"WITH {FILES}, {PD_SQL} SELECT *, TRUE AS in_order, TRUE AS apart FROM pd WHERE file_path IN (SELECT file_path FROM files WHERE content = 0)")
def compact_deletes(t: Tables):
    """Valid position deletes written sorted by file and position, in files that do not overlap."""
    out = dl.compact_position_deletes(position_deletes(t), fx.files(t))
    path = scratch(t.spark, "deletes")
    sn.write_files(out, path)
    stored = with_positions(sn.read_back(t.spark, path, out.schema), "_in", "_at")
    flags = ly.clustering(stored, [F.col("file_path"), F.col("pos")], "_in", "_at").select(F.col("_in").alias("_f"), "in_order", "apart")
    return stored.join(small_side(flags), F.col("_in") == F.col("_f")).drop("_in", "_at", "_f")


@query("deletion_vectors", f"WITH {PD_SQL} SELECT file_path, count(DISTINCT pos) AS deleted_rows FROM pd GROUP BY 1")
def deletion_vectors(t: Tables):
    """Bitmaps of two overlapping delete batches merged and counted."""
    pd = position_deletes(t)
    old, new = dl.deletion_vectors(pd.where("pos < 10")), dl.deletion_vectors(pd)
    return dl.deleted_counts(dl.merge_deletion_vectors(old, new))


@query("dangling_deletes", f"""
WITH {FILES}, live AS (SELECT *, file_no // 12 AS shelf FROM files WHERE removed_snapshot_id IS NULL),
m AS (SELECT shelf, min(sequence_number) AS s FROM live WHERE content = 0 GROUP BY ALL)
SELECT f.file_no, f.content, f.sequence_number FROM live f LEFT JOIN m USING (shelf)
WHERE f.content <> 0 AND (m.s IS NULL OR (f.content = 1 AND f.sequence_number < m.s) OR (f.content = 2 AND f.sequence_number <= m.s))""")
def dangling_deletes(t: Tables):
    """Delete files that reach no live data file of their partition, here twelve neighbouring files."""
    live = fx.files(t).where("removed_snapshot_id IS NULL").withColumn("shelf", int_div(F.col("file_no"), 12))
    return dl.dangling_deletes(live, ["shelf"]).select("file_no", "content", "sequence_number")


@query("row_lineage", f"""
WITH {FILES}, first AS (SELECT file_no, sequence_number, sum(record_count) OVER (ORDER BY sequence_number, file_no) - record_count AS f FROM files),
r AS (SELECT l_orderkey // {fx.ORDERS_PER_FILE} AS file_no, count(*) AS n FROM lineitem GROUP BY 1)
SELECT file_no, f::BIGINT AS first_id, (f + n - 1)::BIGINT AS last_id, sequence_number AS seq FROM r JOIN first USING (file_no)""")
def row_lineage(t: Tables):
    """Smallest and largest row id of each file."""
    files = dl.first_row_ids(fx.files(t), ["sequence_number", "file_no"], F.col("sequence_number"))
    within = t.lineitem.groupBy(fx.file_no().alias("file_no")).agg(F.count("*").alias("n"))
    ends = within.select("file_no", F.explode(F.array(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("_pos"))
    rows = dl.row_lineage(ends, files, "file_no", "_pos")
    return rows.groupBy("file_no").agg(F.min("_row_id").alias("first_id"), F.max("_row_id").alias("last_id"),
                                       F.max("_last_updated_sequence_number").alias("seq"))


@query("overwrite_partitions", """
SELECT o_orderkey, o_orderstatus, 'old' AS origin FROM orders WHERE o_orderstatus NOT IN (SELECT DISTINCT o_orderstatus FROM orders WHERE o_totalprice > 499000 AND o_orderstatus <> 'F')
UNION ALL SELECT o_orderkey, o_orderstatus, 'new' FROM orders WHERE o_totalprice > 499000 AND o_orderstatus <> 'F'""")
def overwrite_partitions(t: Tables):
    rows = t.orders.select("o_orderkey", "o_orderstatus", F.lit("old").alias("origin"))
    new = t.orders.where("o_totalprice > 499000 AND o_orderstatus <> 'F'").select("o_orderkey", "o_orderstatus", F.lit("new").alias("origin"))
    return sn.overwrite_partitions(rows, new, ["o_orderstatus"])


@query("overwrite_by_filter", """
SELECT o_orderkey, p FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_totalprice END AS p FROM orders) WHERE p <= 300000 OR p IS NULL
UNION ALL SELECT o_orderkey, 400000.0 FROM orders WHERE o_orderpriority = '1-URGENT'""")
def overwrite_by_filter(t: Tables):
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 50 != 0, F.col("o_totalprice")).alias("p"))
    new = t.orders.where("o_orderpriority = '1-URGENT'").select("o_orderkey", F.lit(400000.0).alias("p"))
    return sn.overwrite_by_filter(rows, new, F.col("p") > 300000)


@query("bucketed_join", """
SELECT o_orderkey, o_orderstatus, l_linenumber, l_partkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def bucketed_join(t: Tables):
    """Two tables stored in the same buckets, joined without a shuffle."""
    left = sn.write_bucketed(t.orders.select("o_orderkey", "o_orderstatus"), ["o_orderkey"], 8, scratch(t.spark, "bucketed"))
    right = sn.write_bucketed(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey"], 8, scratch(t.spark, "bucketed"))
    return left.hint("merge").join(right, left.o_orderkey == right.l_orderkey).drop("l_orderkey")


@query("partitions_report", f"""
WITH {FILES}, {SNAPS}, f AS (SELECT files.*, committed_at FROM files LEFT JOIN snapshots ON added_snapshot_id = snapshot_id)
SELECT part, spec_id, sum(CASE content WHEN 0 THEN record_count ELSE 0 END)::BIGINT AS record_count, count(*) FILTER (content = 0) AS file_count,
  sum(CASE content WHEN 0 THEN file_size_in_bytes ELSE 0 END)::BIGINT AS total_data_file_size_in_bytes,
  sum(CASE content WHEN 1 THEN record_count ELSE 0 END)::BIGINT AS position_delete_record_count, count(*) FILTER (content = 1) AS position_delete_file_count,
  sum(CASE content WHEN 2 THEN record_count ELSE 0 END)::BIGINT AS equality_delete_record_count, count(*) FILTER (content = 2) AS equality_delete_file_count,
  max(committed_at) AS last_updated_at, arg_max(added_snapshot_id, committed_at) AS last_updated_snapshot_id
FROM f GROUP BY part, spec_id""")
def partitions_report(t: Tables):
    return st.partitions_report(fx.files(t), fx.snapshots(t), ["part"])


@query("files_report", """
SELECT count(*) AS record_count, count(*) AS l_quantity_values, 0::BIGINT AS l_quantity_nulls, 0::BIGINT AS l_quantity_nans,
  min(l_quantity) AS l_quantity_lower, max(l_quantity) AS l_quantity_upper, count(*) AS l_returnflag_values, 0::BIGINT AS l_returnflag_nulls,
  min(l_returnflag) AS l_returnflag_lower, max(l_returnflag) AS l_returnflag_upper FROM lineitem""")
def files_report(t: Tables):
    """Metrics of each stored file of a table (here one)."""
    rows = t.lineitem.select("l_quantity", "l_returnflag", F.col("_metadata.file_path").alias("file_path"))
    return st.column_metrics(rows, ["file_path"], {"l_quantity": "full", "l_returnflag": "truncate(16)"}).drop("file_path")


@query("snapshots_report", f"""
SELECT committed_at, snapshot_id, parent_id, operation, '{{"orders":"' || order_count || '"}}' AS summary FROM ({fx.SNAPSHOTS_SQL})""")
def snapshots_report(t: Tables):
    summary = F.create_map(F.lit("orders"), F.col("order_count").cast("string"))
    return fx.snapshots(t).select("committed_at", "snapshot_id", "parent_id", "operation", F.to_json(summary).alias("summary"))


@query("group_summaries", f"""
WITH {FILES} SELECT file_no // 20 AS manifest, count(*) AS file_count, sum(record_count)::BIGINT AS row_count, max(added_snapshot_id) AS added_snapshot_id,
  bool_or(part IS NULL) AS contains_null, min(part) AS lower_bound, max(part) AS upper_bound FROM files GROUP BY 1""")
def group_summaries(t: Tables):
    files = fx.files(t).withColumn("manifest", int_div(F.col("file_no"), 20))
    return st.group_summaries(files, ["manifest"], "part")


@query("scan_summary", f"""
WITH {FILES}, {SNAPS} SELECT l_day AS day, count(*) AS file_count, sum(record_count)::BIGINT AS record_count, max(committed_at) AS data_timestamp
FROM (SELECT *, CAST(l_shipdate_lower AS DATE) AS l_day FROM files) JOIN snapshots ON added_snapshot_id = snapshot_id
WHERE content = 0 AND committed_at >= TIMESTAMP '1996-01-01' AND committed_at <= TIMESTAMP '2000-12-31' GROUP BY 1 ORDER BY 1 LIMIT 20""")
def scan_summary(t: Tables):
    files = fx.files(t).withColumn("day", F.to_date("l_shipdate_lower"))
    at = lambda text: F.lit(text).cast("timestamp_ntz")
    return st.scan_summary(files, fx.snapshots(t), "day", at("1996-01-01"), at("2000-12-31"), limit=20)


@query("agg_from_stats", """
SELECT count(*) AS count_all, count(nullif(l_tax, 0)) AS count_l_tax, min(l_shipdate) AS min_l_shipdate, max(l_shipdate) AS max_l_shipdate,
       min(l_quantity) AS min_l_quantity, max(l_quantity) AS max_l_quantity FROM lineitem
WHERE (l_orderkey // 50) % 12 NOT IN (5, 7)""")
def agg_from_stats(t: Tables):
    """Aggregates over the data files alone."""
    return st.count_from_stats(fx.files(t).where("content = 0"), ["l_tax"], ["l_shipdate", "l_quantity"])


@query("agg_from_stats_guarded", f"""
WITH {FILES} SELECT 'missing' AS listing, sum(record_count)::BIGINT AS count_all, sum(record_count - l_tax_nulls)::BIGINT AS count_l_tax,
  NULL::TIMESTAMP AS max_l_shipdate, max(l_quantity_upper) AS max_l_quantity FROM files WHERE content = 0
UNION ALL SELECT 'truncated', sum(record_count)::BIGINT, sum(record_count - l_tax_nulls)::BIGINT, max(l_shipdate_upper), NULL FROM files WHERE content = 0
UNION ALL SELECT 'deletes', NULL, NULL, NULL, NULL""")
def agg_from_stats_guarded(t: Tables):
    """Where statistics have no answer: a file without a bound, cut bounds, delete files in the listing."""
    files = fx.files(t)
    data = files.where("content = 0")
    holes = data.withColumn("l_shipdate_upper", F.when(F.col("file_no") % 4 != 0, F.col("l_shipdate_upper")))
    listings = {"missing": (holes, []), "truncated": (data, ["l_quantity"]), "deletes": (files, [])}
    out = None
    for name, (listing, cut) in listings.items():
        one = st.count_from_stats(listing, ["l_tax"], ["l_shipdate", "l_quantity"], cut).select(
            F.lit(name).alias("listing"), "count_all", "count_l_tax", "max_l_shipdate", "max_l_quantity")
        out = one if out is None else out.union(one)
    return out


@query("partition_stats", f"""
WITH {FILES} SELECT part, sum(CASE content WHEN 0 THEN record_count ELSE 0 END)::BIGINT AS record_count, count(*) FILTER (content = 0) AS file_count,
  sum(CASE content WHEN 0 THEN file_size_in_bytes ELSE 0 END)::BIGINT AS total_size, count(*) FILTER (content = 1) AS position_delete_files,
  count(*) FILTER (content = 2) AS equality_delete_files, max(added_snapshot_id) AS last_snapshot_id,
  CASE WHEN count(*) FILTER (content <> 0) = 0 THEN sum(record_count)::BIGINT END AS total_record_count FROM files GROUP BY part""")
def partition_stats(t: Tables):
    """Statistics of the files up to a commit, brought forward by the later ones."""
    files = fx.files(t)
    old = st.partition_stats(files.where("sequence_number <= 50"), ["part"])
    return st.append_partition_stats(old, files.where("sequence_number > 50"), ["part"])


@query("ndv_theta", """
SELECT 'user_id' AS column_name, count(DISTINCT user_id) AS ndv FROM events UNION ALL SELECT 'event_type', count(DISTINCT event_type) FROM events
UNION ALL SELECT 'props', count(DISTINCT props) FROM events""")
def ndv_theta(t: Tables):
    return st.ndv(t.events, ["user_id", "event_type", "props"])


@query("column_metrics", """
SELECT source, count(*) AS record_count, count(*) AS text_values, 0::BIGINT AS text_nulls, substring(min(text), 1, 4) AS text_lower,
  CASE WHEN length(max(text)) <= 4 THEN max(text) ELSE substring(max(text), 1, 3) || chr(unicode(substring(max(text), 4, 1)) + 1) END AS text_upper,
  count(*) AS n_chars_values, 0::BIGINT AS n_chars_nulls, min(n_chars) AS n_chars_lower, max(n_chars) AS n_chars_upper,
  count(*) AS lang_values, count(*) - count(nullif(lang, 'en')) AS lang_nulls FROM documents GROUP BY source""")
def column_metrics(t: Tables):
    docs = t.documents.withColumn("lang", F.nullif(F.col("lang"), F.lit("en")))
    return st.column_metrics(docs, ["source"], {"text": "truncate(4)", "n_chars": "full", "lang": "counts", "doc_id": "none"})


@query("snapshot_summary", f"""
WITH {FILES}, moves AS (SELECT added_snapshot_id AS snapshot_id, part, record_count AS r, file_size_in_bytes AS b, 1 AS s FROM files
   UNION ALL SELECT removed_snapshot_id, part, record_count, file_size_in_bytes, -1 FROM files WHERE removed_snapshot_id IS NOT NULL)
SELECT *, sum(added_records - deleted_records) OVER (ORDER BY snapshot_id)::BIGINT AS total_records,
  sum(added_data_files - deleted_data_files) OVER (ORDER BY snapshot_id)::BIGINT AS total_data_files,
  sum(added_files_size - removed_files_size) OVER (ORDER BY snapshot_id)::BIGINT AS total_files_size
FROM (SELECT snapshot_id, count(*) FILTER (s = 1) AS added_data_files, count(*) FILTER (s = -1) AS deleted_data_files,
  coalesce(sum(r) FILTER (s = 1), 0)::BIGINT AS added_records, coalesce(sum(r) FILTER (s = -1), 0)::BIGINT AS deleted_records,
  coalesce(sum(b) FILTER (s = 1), 0)::BIGINT AS added_files_size, coalesce(sum(b) FILTER (s = -1), 0)::BIGINT AS removed_files_size,
  count(DISTINCT coalesce('=' || part, 'null')) AS changed_partition_count FROM moves GROUP BY 1)""")
def snapshot_summary(t: Tables):
    return st.snapshot_summary(fx.files(t), "part")


@query("find_files", f"""
WITH {fx.LINE_SQL}, {FILES}, visible AS (SELECT snapshot_id FROM line WHERE snapshot_id <= 60)
SELECT file_no, file_path FROM files WHERE added_snapshot_id IN (SELECT snapshot_id FROM visible)
  AND (removed_snapshot_id IS NULL OR removed_snapshot_id NOT IN (SELECT snapshot_id FROM visible))
  AND record_count > 150 AND l_tax_nulls > 0 AND part IN ('north', 'p2')""")
def find_files(t: Tables):
    files, snaps = fx.files(t), fx.snapshots(t)
    line = ln.up_to(ln.chain(snaps, fx.HEAD), 60)
    parts = files.where("part IN ('north', 'p2')").select("part").distinct()
    found = ln.find_files(files, line, F.col("record_count") > 150, sk.FileStats(files).is_null("l_tax"), parts)
    return found.select("file_no", "file_path")


def ship_files(t: Tables):
    """Files of lineitem by month of shipping with bounds, the table to skip over."""
    month = tr.months(F.col("l_shipdate")).alias("month")
    rows = t.lineitem.select(month, "l_shipdate", "l_quantity", F.when(F.col("l_tax") != 0, F.col("l_tax")).alias("l_tax"))
    return st.column_metrics(rows, ["month"], {"l_shipdate": "full", "l_quantity": "full", "l_tax": "full"})


def ship_predicate(files):
    s = sk.FileStats(files)
    at = lambda text: F.lit(text).cast("timestamp_ntz")
    return (s.gt_eq("l_shipdate", at("1996-03-01")) & s.lt("l_shipdate", at("1997-06-15"))) | (s.lt("l_shipdate", at("1995-02-10")) & ~s.is_null("l_tax"))


SHIP = "(l_shipdate >= TIMESTAMP '1996-03-01' AND l_shipdate < TIMESTAMP '1997-06-15') OR (l_shipdate < TIMESTAMP '1995-02-10' AND nullif(l_tax, 0) IS NOT NULL)"
MONTH_SQL = "CAST((year(l_shipdate) - 1970) * 12 + month(l_shipdate) - 1 AS INTEGER)"


@query("files_may_match", f"""
SELECT m AS month, n AS record_count FROM (SELECT {MONTH_SQL} AS m, count(*) AS n, bool_or({SHIP}) AS hit FROM lineitem GROUP BY 1) WHERE hit""")
def files_may_match(t: Tables):
    """Months that may hold matches; here bounds are tight enough to be exact."""
    files = ship_files(t)
    return files.where(ship_predicate(files).may_match).select("month", "record_count")


@query("files_fully_matched", f"""
SELECT m AS month, n AS record_count FROM (SELECT {MONTH_SQL} AS m, count(*) AS n, bool_and(coalesce({SHIP}, FALSE)) AS every FROM lineitem GROUP BY 1) WHERE every""")
def files_fully_matched(t: Tables):
    files = ship_files(t)
    return files.where(ship_predicate(files).must_match).select("month", "record_count")


@query("residual_scan", f"SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem WHERE {SHIP}")
def residual_scan(t: Tables):
    files = ship_files(t)
    rows = fx.stored_months(t).select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate",
                                      F.when(F.col("l_tax") != 0, F.col("l_tax")).alias("l_tax"), "month")
    return sk.residual_scan(rows, files, "month", ship_predicate(files)).select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")


@query("metadata_delete", f"""
SELECT m AS month, CASE WHEN every THEN 'drop' WHEN hit THEN 'rewrite' ELSE 'keep' END AS action
FROM (SELECT {MONTH_SQL} AS m, bool_and(l_shipdate < TIMESTAMP '1996-07-16') AS every, bool_or(l_shipdate < TIMESTAMP '1996-07-16') AS hit FROM lineitem GROUP BY 1)""")
def metadata_delete(t: Tables):
    files = ship_files(t)
    condition = sk.FileStats(files).lt("l_shipdate", F.lit("1996-07-16").cast("timestamp_ntz"))
    return sk.metadata_delete(files, condition).select("month", "action")


@query("conflict_check", f"""
WITH {FILES} SELECT count(*) AS conflicting_files FROM files WHERE sequence_number > 40 AND l_quantity_upper > 49 AND l_tax_nulls < record_count AND l_tax_upper >= 0.08""")
def conflict_check(t: Tables):
    files = fx.files(t)
    s = sk.FileStats(files)
    clash = sk.conflicting_files(files, s.gt("l_quantity", 49) & s.gt_eq("l_tax", 0.08), since=40)
    return clash.agg(F.count("*").alias("conflicting_files"))


@query("skip_partitions", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-03-10' AND l_shipdate < TIMESTAMP '1996-05-20' AND l_partkey < 1000 AND l_suppkey = 42""")
def skip_partitions(t: Tables):
    """Row predicate plus the derived predicates on month, truncated and bucketed partition columns."""
    month = tr.PartitionField("l_shipdate", "month", data_type="timestamp_ntz")
    part = tr.PartitionField("l_partkey", "truncate", 100)
    supp = tr.PartitionField("l_suppkey", "bucket", 16)
    rows = fx.stored_months(t).select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_suppkey",
                                      F.col("month").alias(month.name), part.column(), supp.column())
    low, high = F.lit("1996-03-10").cast("timestamp_ntz"), F.lit("1996-05-20").cast("timestamp_ntz")
    kept = rows.where(tr.project_inclusive(month, ">=", low) & tr.project_inclusive(month, "<", high)
                      & tr.project_inclusive(part, "<", 1000) & tr.project_inclusive(supp, "=", 42))
    s = (F.col("l_shipdate") >= low) & (F.col("l_shipdate") < high) & (F.col("l_partkey") < 1000) & (F.col("l_suppkey") == 42)
    return kept.where(s).select("l_orderkey", "l_linenumber", "l_partkey")
