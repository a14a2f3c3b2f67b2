"""Keyed tables as rows and deletes: an upsert writes its own rows and what they replace, never the table.

A table is a folder with three parts, each in a folder per commit: ``rows``,
``keys`` (equality deletes: older rows of these keys are gone) and ``places``
(position deletes: rows of the same commit that a later one replaced).  A
fourth part, the ledger, names the commits that are complete: readers see no
others, and a commit in it is not written again.  A commit costs what its batch
costs; reading joins the parts, and compaction writes the rows that are left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructType

from tarn.operators import deletes as dl
from tarn.util import small_side

COMMIT = "_commit"
_PLACES = StructType().add("file_path", StringType()).add("pos", LongType())
_LEDGER = StructType().add("done", BooleanType())


def _part(path: str, part: str, commit: int) -> str:
    return f"{path}/{part}/{COMMIT}={commit}"


def _read(spark: SparkSession, path: str, part: str, schema: StructType) -> DataFrame | None:
    """A part of the table with its commit number; None if no commit has written one."""
    try:
        return spark.read.schema(StructType([*schema.fields]).add(COMMIT, LongType())).parquet(f"{path}/{part}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def committed(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger: a row per complete commit."""
    done = _read(spark, path, "ledger", _LEDGER)
    return None if done is None else done.select(COMMIT).distinct()


def _is_committed(spark: SparkSession, path: str, commit: int) -> bool:
    done = committed(spark, path)
    return done is not None and not done.where(F.col(COMMIT) == commit).isEmpty()


def _finish(spark: SparkSession, path: str, commit: int) -> None:
    spark.createDataFrame([(True,)], _LEDGER).coalesce(1).write.mode("overwrite").parquet(_part(path, "ledger", commit))


def write_rows(rows: DataFrame, path: str, commit: int) -> None:
    """Commit rows that replace nothing, such as a table's first ones or those left by a compaction."""
    if not _is_committed(rows.sparkSession, path, commit):
        rows.write.mode("overwrite").parquet(_part(path, "rows", commit))
        _finish(rows.sparkSession, path, commit)


def write_upsert(batch: DataFrame, path: str, keys: list[str], order: list[str], commit: int, schema: StructType,
                 op: str | None = None) -> None:
    """Commit a batch: its rows, an equality delete per key and a position delete per row a later one of the batch replaces.

    The last row of a key by ``order`` is the one that counts; rows that tie in
    it are told apart by their place.  With ``op`` the batch is a change stream:
    update-before images are left out, and a key whose last change is a delete
    keeps no row.  NULL keys are equal.  A commit that failed half way is written
    anew, one that is in the ledger is left as it is: a replayed batch does nothing.

    Rows are written as they come and read back with their places.  The last
    row per key is an aggregate that combines on the map side, and rows meet it
    by place, so a key with very many changes in one batch is split like any other.
    """
    spark = batch.sparkSession
    if _is_committed(spark, path, commit):
        return
    rows = batch
    if op:
        rows = rows.where(~F.coalesce(F.col(op).isin("UPDATE_BEFORE", "UB"), F.lit(False)))
    gone = F.coalesce(F.col(op).isin("DELETE", "D"), F.lit(False)) if op else F.lit(False)
    extra = [c for c in order if c not in schema.names]
    rows.withColumn("_gone", gone).select(*schema.names, *extra, "_gone").write.mode("overwrite").parquet(_part(path, "rows", commit))
    wide = StructType([*schema.fields, *[batch.schema[c] for c in extra]]).add("_gone", "boolean")
    written = spark.read.schema(wide).parquet(_part(path, "rows", commit)).select(
        "*", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.row_index").alias("pos"))
    last = written.groupBy(*keys).agg(F.max_by(F.struct("file_path", "pos", "_gone"), F.struct(*order, "file_path", "pos")).alias("_last"))
    stay = last.where("NOT _last._gone").select("_last.file_path", "_last.pos")
    places = written.select("file_path", "pos").join(stay, ["pos", "file_path"], "left_anti")
    places.select(*_PLACES.names).write.mode("overwrite").parquet(_part(path, "places", commit))
    last.select(*keys).write.mode("overwrite").parquet(_part(path, "keys", commit))
    _finish(spark, path, commit)


def read_upserted(spark: SparkSession, path: str, schema: StructType, keys: list[str], upto: int | None = None) -> DataFrame:
    """The rows of the table, or those it had at an earlier commit; only folders of complete commits are read."""
    rows, done = _read(spark, path, "rows", schema), committed(spark, path)
    if rows is None or done is None:
        return spark.createDataFrame([], schema)
    if upto is not None:
        done = done.where(F.col(COMMIT) <= upto)
    done = small_side(done)
    low, high = done.agg(F.min(COMMIT), F.max(COMMIT)).first()
    if low is None:
        return spark.createDataFrame([], schema)
    # The range reaches the file index, the join prunes the commits between that are not complete.
    seen = lambda df: df.where(F.col(COMMIT).between(low, high)).join(done, COMMIT, "left_semi")
    rows = seen(rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_pos")))
    by_place = _read(spark, path, "places", _PLACES)
    by_key = _read(spark, path, "keys", StructType([schema[k] for k in keys]))
    if by_place is not None:
        rows = dl.apply_position_deletes(rows, seen(by_place), "_file", "_pos", COMMIT)
    if by_key is not None:
        rows = dl.apply_equality_deletes(rows, [(seen(by_key), keys)], COMMIT)
    return rows.select(*schema.names)


def compact(spark: SparkSession, path: str, to: str, schema: StructType, keys: list[str], commit: int) -> None:
    """Write the rows that are left after a commit into a new table, without any deletes."""
    write_rows(read_upserted(spark, path, schema, keys, commit), to, commit)


def upsert_writer(path: str, keys: list[str], order: list[str], schema: StructType, op: str | None = None
                  ) -> Callable[[DataFrame, int], None]:
    """Batch writer of a stream: batch n is commit n + 1, so commit 0 is free for the table's first rows."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_upsert(batch, path, keys, order, batch_id + 1, schema, op)

    return write
