"""Keyed tables kept up to date by streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructType

from tarn.operators.changes import latest_per_key
from tarn.operators.sinks import write_files


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema("_bucket int").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def keyed_table_writer(path: str, keys: list[str], order: list[str], schema: StructType, buckets: int = 16,
                       op: str | None = None) -> Callable[[DataFrame, int], None]:
    """Batch writer that keeps the last row per key in a table of files.

    The table is split into buckets by key hash.  A batch reads and replaces
    only the buckets its keys fall in, by dynamic partition overwrite, so its
    cost follows the batch.  Rows older than the stored one do not win, which
    makes a repeated batch harmless.  With ``op`` the batch is a change stream
    and deletes remove the key; they are kept as marked rows so that a repeated
    older change cannot bring the key back.
    """
    stored = StructType([*schema.fields]).add("_deleted", BooleanType())

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch
        if op:
            rows = rows.where(~F.coalesce(F.col(op).isin("UPDATE_BEFORE", "UB"), F.lit(False)))
        gone = F.coalesce(F.col(op).isin("DELETE", "D"), F.lit(False)) if op else F.lit(False)
        incoming = latest_per_key(rows.withColumn("_deleted", gone).select(*stored.names), keys, order)
        incoming = incoming.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        incoming.persist()
        try:
            merged = incoming
            if _exists(spark, path):
                touched = incoming.select("_bucket").distinct()
                current = spark.read.schema(StructType(stored.fields).add("_bucket", IntegerType())).parquet(path)
                current = current.join(F.broadcast(touched), "_bucket", "left_semi")  # at most one row per bucket
                merged = latest_per_key(current.unionByName(incoming), keys, order)
            write_files(merged, path, partition=["_bucket"], mode="overwrite", cluster=True)
        finally:
            incoming.unpersist()

    return write


def read_keyed_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    stored = StructType([*schema.fields]).add("_deleted", BooleanType())
    return spark.read.schema(stored).parquet(path).where("NOT _deleted").select(*schema.names)


def running_counts(stream: DataFrame, key: str) -> DataFrame:
    """Count per key so far, for update mode: combined on the map side, whatever a key's share."""
    return stream.groupBy(key).agg(F.count("*").alias("running_count"))
