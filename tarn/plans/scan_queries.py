"""Queries over file scans and their row and column resolution."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarn.operators.layout import SortTerm, sort_columns, with_places
from tarn.plans.registry import Tables, query
from tarn.session import scratch
from tarn.sources import files as fs


@query("scan_project_filter", "SELECT l_orderkey, l_extendedprice FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01' AND l_quantity >= 25")
def scan_project_filter(t: Tables):
    where = (F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")) & (F.col("l_quantity") >= 25)
    return fs.scan(t.spark, t.path("lineitem"), ["l_orderkey", "l_extendedprice"], where)


@query("limit_topn", "SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 100")
def limit_topn(t: Tables):
    return t.events.select("event_id", "value").orderBy(F.desc("value"), "event_id").limit(100)


@query("scan_with_positions", "SELECT event_id, row_number() OVER () - 1 AS pos FROM events")
def scan_with_positions(t: Tables):
    return fs.with_positions(t.events).select("event_id", F.col("_pos").alias("pos"))


@query("name_mapping", "SELECT event_id AS id, event_type AS kind, CAST(NULL AS VARCHAR) AS region FROM events")
def name_mapping(t: Tables):
    rows = fs.resolve_names(t.events, {"id": ["id", "event_id"], "kind": ["event_type", "type"], "region": ["region"]})
    return rows.withColumn("region", F.col("region").cast("string"))


@query("evolved_read", """
SELECT event_id, user_id, CAST(NULL AS VARCHAR) AS props, value FROM events WHERE value < 50
UNION ALL SELECT event_id, user_id, props, CAST(NULL AS DOUBLE) FROM events WHERE value >= 50""")
def evolved_read(t: Tables):
    cheap, dear = t.events.where("value < 50"), t.events.where("value >= 50")
    old = cheap.select(F.col("event_id").cast("int").alias("event_id"), F.col("user_id").cast("int").alias("user_id"), "value")
    new = dear.select("event_id", "user_id", "props")
    return fs.read_evolved([old, new], StructType.fromDDL("event_id bigint, user_id bigint, props string, value double"))


@query("sort_terms_nulls", """
SELECT event_id, row_number() OVER (ORDER BY month(ts) ASC NULLS FIRST, k DESC NULLS LAST, value ASC NULLS LAST, event_id) AS place
FROM (SELECT *, CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_type END AS k FROM events)""")
def sort_terms_nulls(t: Tables):
    """The place of every row in a sort by transform and column terms."""
    rows = t.events.select("event_id", "ts", "value", F.when(F.col("event_id") % 4 != 0, F.col("event_type")).alias("k"))
    terms = [SortTerm("ts", transform="month"), SortTerm("k", ascending=False), SortTerm("value", nulls="last"),
             SortTerm("event_id")]
    return with_places(rows, sort_columns(terms), scratch(t.spark, "sorted")).select("event_id", "place")
