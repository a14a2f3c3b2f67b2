"""Table metadata derived from the input tables, with the same derivation in SQL.

A commit per month of ``orders``, a data file per 50 order keys of
``lineitem``: the numbers of files and rows grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tarn.functions import transforms as tr
from tarn.operators.sinks import write_files
from tarn.plans.registry import Tables
from tarn.session import scratch
from tarn.util import int_div

HEAD = 80
ORDERS_PER_FILE = 50

SNAPSHOTS_SQL = """
SELECT m AS snapshot_id, CASE WHEN m = 1 THEN NULL WHEN m % 10 = 4 THEN m - 2 ELSE m - 1 END AS parent_id,
       committed_at, CASE WHEN m % 7 = 0 THEN 'replace' WHEN m % 5 = 1 THEN 'overwrite' WHEN m % 11 = 0 THEN 'delete' ELSE 'append' END AS operation,
       order_count
FROM (SELECT CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS BIGINT) AS m, max(o_orderdate) AS committed_at, count(*) AS order_count
      FROM orders GROUP BY 1)"""

LINE_SQL = f"""
RECURSIVE snapshots AS ({SNAPSHOTS_SQL}),
line AS (SELECT snapshot_id, parent_id, committed_at, operation, 0 AS depth FROM snapshots WHERE snapshot_id = {HEAD}
         UNION ALL SELECT s.snapshot_id, s.parent_id, s.committed_at, s.operation, depth + 1
         FROM snapshots s JOIN line ON s.snapshot_id = line.parent_id)"""

FILES_SQL = f"""
SELECT file_no, CASE file_no % 8 WHEN 0 THEN 'north' WHEN 1 THEN NULL ELSE 'p' || (file_no % 4) END AS part,
       'store://wh/data/f-' || lpad(CAST(file_no AS VARCHAR), 12, '0') || '.parquet' AS file_path,
       CAST(CASE file_no % 12 WHEN 5 THEN 1 WHEN 7 THEN 2 ELSE 0 END AS INTEGER) AS content,
       n AS record_count, n * 1000000 + file_no % 1000 AS file_size_in_bytes,
       file_no * 7 % {HEAD} + 1 AS added_snapshot_id,
       CASE WHEN file_no % 6 = 0 AND file_no * 7 % {HEAD} + 11 <= {HEAD} THEN file_no * 7 % {HEAD} + 11 END AS removed_snapshot_id,
       file_no * 7 % {HEAD} + 1 AS sequence_number, CAST(file_no % 3 AS INTEGER) AS spec_id,
       l_shipdate_lower, l_shipdate_upper, l_quantity_lower, l_quantity_upper, l_tax_lower, l_tax_upper, l_tax_nulls
FROM (SELECT l_orderkey // {ORDERS_PER_FILE} AS file_no, count(*) AS n, min(l_shipdate) AS l_shipdate_lower, max(l_shipdate) AS l_shipdate_upper,
             min(l_quantity) AS l_quantity_lower, max(l_quantity) AS l_quantity_upper,
             min(nullif(l_tax, 0)) AS l_tax_lower, max(nullif(l_tax, 0)) AS l_tax_upper, count(*) - count(nullif(l_tax, 0)) AS l_tax_nulls
      FROM lineitem GROUP BY 1)"""


def snapshots(t: Tables) -> DataFrame:
    m = ((F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate")).cast("bigint")
    months = t.orders.groupBy(m.alias("m")).agg(F.max("o_orderdate").alias("committed_at"), F.count("*").alias("order_count"))
    m = F.col("m")
    return months.select(
        m.alias("snapshot_id"), F.when(m % 10 == 4, m - 2).when(m > 1, m - 1).alias("parent_id"), "committed_at",
        F.when(m % 7 == 0, "replace").when(m % 5 == 1, "overwrite").when(m % 11 == 0, "delete").otherwise("append").alias("operation"),
        "order_count")


def file_no(key: str = "l_orderkey") -> Column:
    return int_div(F.col(key), ORDERS_PER_FILE)


def added_by(file_no: Column) -> Column:
    """The commit that added a file."""
    return file_no * 7 % HEAD + 1


def files(t: Tables) -> DataFrame:
    tax = F.when(F.col("l_tax") != 0, F.col("l_tax"))
    stats = t.lineitem.groupBy(file_no().alias("file_no")).agg(
        F.count("*").alias("record_count"),
        F.min("l_shipdate").alias("l_shipdate_lower"), F.max("l_shipdate").alias("l_shipdate_upper"),
        F.min("l_quantity").alias("l_quantity_lower"), F.max("l_quantity").alias("l_quantity_upper"),
        F.count_if(F.isnan("l_quantity")).alias("l_quantity_nans"), F.count_if(F.isnan(tax)).alias("l_tax_nans"),
        F.min(tax).alias("l_tax_lower"), F.max(tax).alias("l_tax_upper"),
        (F.count("*") - F.count(tax)).alias("l_tax_nulls"))
    n = F.col("file_no")
    added = added_by(n)
    return stats.select(
        "file_no", F.when(n % 8 == 0, "north").when(n % 8 != 1, F.concat(F.lit("p"), n % 4)).alias("part"),
        F.concat(F.lit("store://wh/data/f-"), F.lpad(n.cast("string"), 12, "0"), F.lit(".parquet")).alias("file_path"),
        F.when(n % 12 == 5, 1).when(n % 12 == 7, 2).otherwise(0).alias("content"), "record_count",
        (F.col("record_count") * 1000000 + n % 1000).alias("file_size_in_bytes"), added.alias("added_snapshot_id"),
        F.when((n % 6 == 0) & (added + 10 <= HEAD), added + 10).alias("removed_snapshot_id"),
        added.alias("sequence_number"), (n % 3).cast("int").alias("spec_id"),
        *[c for c in stats.columns if c.startswith("l_")])


_STORED: dict[tuple[str, str, str], str] = {}


def stored(t: Tables, name: str, rows: DataFrame, by: str, split: bool = False) -> DataFrame:
    """A copy of rows in one folder and file (with ``split``, files as their size asks) per value of a column, written once per application
    and data folder."""
    key = (t.spark.sparkContext.applicationId, t.folder, name)
    if key not in _STORED:
        path = scratch(t.spark, name)
        if split:
            write_files(rows, path, partition=[by], cluster=True)
        else:
            rows.repartition(by).write.partitionBy(by).parquet(path)
        _STORED[key] = path
    return t.spark.read.schema(rows.schema).parquet(_STORED[key])


def stored_lines(t: Tables) -> DataFrame:
    """lineitem with the data file of :func:`files` each row is in, a folder per commit: files of 50 orders are too many to be folders."""
    rows = t.lineitem.withColumn("file_no", file_no()).withColumn("added_snapshot_id", added_by(F.col("file_no")))
    return stored(t, "lines-by-commit", rows, "added_snapshot_id", split=True)


def stored_months(t: Tables) -> DataFrame:
    """lineitem in a folder per month of shipping."""
    return stored(t, "lines-by-month", t.lineitem.withColumn("month", tr.months(F.col("l_shipdate"))), "month")


def stored_events(t: Tables) -> DataFrame:
    """events in files of 1000 ids, with their position and a sequence number."""
    e = F.col("event_id")
    rows = t.events.select("event_id", (e % 1000).alias("pos"), (e % 7).alias("sequence_number"), int_div(e, 1000).alias("file_path"))
    return stored(t, "events-by-file", rows, "file_path")
