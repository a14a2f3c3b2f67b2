"""Write forms: modes, overwrites, time buckets, routing, messages and audit."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tarn.operators.changes import latest_per_key, upsert, without_keys
from tarn.operators.skipping import check_added_rows


def write_files(df: DataFrame, path: str, fmt: str = "parquet", partition: list[str] = (), mode: str = "append",
                options: dict[str, str] | None = None, cluster: bool = False) -> None:
    """Write files; overwriting replaces only the partitions the rows touch.

    Clustering brings a partition's rows together first, for few files per
    folder; a partition far larger than the others is still split over tasks.
    """
    rows = df.hint("rebalance", *partition) if cluster and partition else df
    writer = rows.write.format(fmt).mode(mode).options(**{"compression": "snappy"} if fmt == "parquet" else {})
    if partition:
        writer = writer.partitionBy(*partition)
        if mode == "overwrite":
            writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.options(**(options or {})).save(path)


def write_table(df: DataFrame, mode: str, path: str, partition: list[str] = (), keys: list[str] = (),
                order: list[str] = (), current: DataFrame | None = None) -> None:
    """Append, overwrite or upsert, by configuration; an upsert writes the new state of ``current`` to the path."""
    if mode == "upsert":
        write_files(upsert(current, df, list(keys), list(order)), path, partition=partition)
    elif mode in ("append", "overwrite"):
        write_files(df, path, partition=partition, mode=mode)
    else:
        raise ValueError(f"unknown write mode {mode}")


def overwrite_partitions(old: DataFrame, new: DataFrame, partition: list[str]) -> DataFrame:
    """Old rows of partitions the new rows do not touch, and the new rows."""
    touched = new.select(*partition).distinct()
    return without_keys(old, touched, partition).unionByName(new)


def overwrite_by_filter(old: DataFrame, new: DataFrame, condition: Column, validate: bool = True) -> DataFrame:
    """Old rows for which the filter is not TRUE, and the new rows, which must all match it."""
    added = check_added_rows(new, condition) if validate else new
    return old.where(~F.coalesce(condition, F.lit(False))).unionByName(added)


def with_time_buckets(df: DataFrame, ts: str | Column) -> DataFrame:
    """Columns year, month, day and hour (as padded text) for a time-bucketed path."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return df.withColumns({n: F.date_format(c, f) for n, f in (("year", "yyyy"), ("month", "MM"), ("day", "dd"), ("hour", "HH"))})


def write_bucketed(df: DataFrame, keys: list[str], buckets: int, path: str) -> DataFrame:
    """Store hash-bucketed and sorted by the keys, so joins and groupings on them need no shuffle."""
    table = f"tarn_bucketed_{uuid.uuid4().hex}"
    (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
     .format("parquet").option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)


def create_table_as(df: DataFrame, name: str, path: str, replace: bool = False, partition: list[str] = ()) -> DataFrame:
    """Create (or replace) a stored table from a query and return it."""
    writer = df.write.format("parquet").option("path", path).mode("overwrite" if replace else "error")
    (writer.partitionBy(*partition) if partition else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def to_messages(df: DataFrame, key: Column | str, columns: list[str] | None = None) -> DataFrame:
    """Message rows: key text and the row as JSON."""
    k = F.col(key) if isinstance(key, str) else key
    return df.select(k.cast("string").alias("key"), F.to_json(F.struct(*(columns or df.columns))).alias("value"))


def key_partition(key: Column, partitions: int) -> Column:
    """Message partition by key hash; a NULL key goes to the first partition."""
    return F.when(key.isNull(), 0).otherwise(F.pmod(F.hash(key), F.lit(partitions)))


def to_time_series(df: DataFrame, metric: str, labels: dict[str, str], value: str, ts: str) -> DataFrame:
    """Metric name, label map and sample per row."""
    pairs = [x for name, col in labels.items() for x in (F.lit(name), F.col(col).cast("string"))]
    return df.select(F.lit(metric).alias("metric"), F.create_map(*pairs).alias("labels"), F.col(value).alias("value"), F.col(ts).alias("ts"))


def ordered_by_labels(series: DataFrame, writers: int | None = None) -> DataFrame:
    """Samples of one label set in time order, as series stores demand.

    Ranges over (label set, time): a series with very many samples covers
    several ranges, each in order and the ranges themselves in time order.
    """
    bounds = [F.xxhash64(F.map_entries("labels")), F.col("ts")]
    out = series.repartitionByRange(writers, *bounds) if writers else series.repartitionByRange(*bounds)
    return out.sortWithinPartitions(*bounds)


def route_static(df: DataFrame, tables: dict[str, str | None], field: str | None = None, name: str = "table") -> DataFrame:
    """A row per target table: all tables without a route field, else those whose pattern matches the whole value."""
    if field is None:
        targets = F.array(*[F.lit(t) for t in tables])
    else:
        targets = F.array_compact(F.array(*[F.when(F.col(field).rlike(f"^(?:{p})$"), F.lit(t))
                                            for t, p in tables.items() if p is not None]))
    return df.withColumn(name, F.explode(targets))


def route_dynamic(df: DataFrame, field: str, name: str = "table") -> DataFrame:
    """The lower-cased value of the field names the table; rows without one are dropped."""
    return df.where(F.col(field).isNotNull()).withColumn(name, F.lower(field))


def audit_staged(staged: DataFrame, wap_id: str, checks: dict[str, Column]) -> DataFrame:
    """Per staged write: every named check (an aggregate) and whether all passed."""
    out = staged.groupBy(wap_id).agg(*[F.coalesce(c, F.lit(False)).alias(n) for n, c in checks.items()])
    passed = F.lit(True)
    for n in checks:
        passed = passed & F.col(n)
    return out.withColumn("passed", passed)


def publish_staged(staged: DataFrame, wap_id: str, audit: DataFrame, published: DataFrame, strict: bool = False) -> DataFrame:
    """Rows of audited writes not published before; in strict mode a second publish is an error."""
    good = audit.where("passed").select(wap_id)
    done = published.select(F.col(wap_id).alias("_done")).distinct()
    joined = good.join(done, F.col(wap_id) == F.col("_done"), "left")
    if strict:
        twice = F.when(F.col("_done").isNotNull(), F.raise_error(F.lit("write was published before")).cast("boolean"))
        fresh = joined.where(twice.isNull())
    else:
        fresh = joined.where("_done IS NULL")
    return staged.join(fresh.select(wap_id), wap_id, "left_semi")


def upsert_statement(table: str, columns: list[str], keys: list[str], mark: str = "?", add: tuple[str, ...] = ()) -> str:
    """INSERT ... ON CONFLICT DO UPDATE for a database that knows it; columns in ``add`` are added to the stored value."""
    rest = [c for c in columns if c not in keys]
    new = lambda c: f"{table}.{c} + excluded.{c}" if c in add else f"excluded.{c}"
    change = "DO UPDATE SET " + ", ".join(f"{c} = {new(c)}" for c in rest) if rest else "DO NOTHING"
    return (f"INSERT INTO {table} ({', '.join(columns)}) VALUES ({', '.join([mark] * len(columns))}) "
            f"ON CONFLICT ({', '.join(keys)}) {change}")


def write_database(df: DataFrame, connect: Callable[[], object], table: str, keys: list[str], order: list[str],
                   batch_size: int = 500, retries: int = 3, columns: list[str] | None = None) -> None:
    """Upsert into a database from the executors, in retried batches.

    ``connect()`` opens a DB-API connection.  Rows are reduced to the last per
    key and placed by key first, so no two tasks write the same row.
    """
    names = columns or df.columns
    statement = upsert_statement(table, names, keys)

    def write(rows) -> None:
        import time

        connection = connect()

        def flush(batch: list[tuple]) -> None:
            for attempt in range(retries + 1):
                try:
                    connection.cursor().executemany(statement, batch)
                    connection.commit()
                    return
                except Exception:
                    connection.rollback()
                    if attempt == retries:
                        raise
                    time.sleep(0.1 * 2**attempt)

        try:
            batch: list[tuple] = []
            for row in rows:
                batch.append(tuple(row[n] for n in names))
                if len(batch) >= batch_size:
                    flush(batch)
                    batch = []
            if batch:
                flush(batch)
        finally:
            connection.close()

    latest_per_key(df, keys, order).foreachPartition(write)


def once_into_database(connect: Callable[[], object], table: str, keys: list[str], order: list[str], columns: list[str],
                       ledger: str, add: tuple[str, ...] = (), slices: int = 16, mark: str = "?", batch_size: int = 500
                       ) -> Callable[[DataFrame, int], None]:
    """Batch writer of a stream that upserts each batch exactly once.

    A batch is reduced to the last row per key and dealt to a fixed number of
    slices by key.  A task writes one slice in one transaction, together with the
    slice's line ``(batch_id, slice, slices)`` in the ``ledger`` table, whose first
    two columns are its key; a slice whose line is there is left out.  So a batch
    that failed half way, or is played again after later ones, changes nothing twice,
    not even columns that are added up (``add``), whose rows are summed per key
    instead.  A batch begun with another number of slices is refused.
    """
    statement = upsert_statement(table, columns, keys, mark, add)
    found = f"SELECT slices FROM {ledger} WHERE batch_id = {mark} AND slice = {mark}"
    done = f"INSERT INTO {ledger} (batch_id, slice, slices) VALUES ({mark}, {mark}, {mark})"

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = latest_per_key(batch, keys, order)
        if add:
            sums = batch.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in add])
            same = [newest[k].eqNullSafe(sums[k]) for k in keys]
            newest = newest.join(sums, same).select(*[sums[c] if c in add else newest[c] for c in columns])
        placed = newest.select(*columns).withColumn("_slice", F.pmod(F.xxhash64(*keys), F.lit(slices)).cast("int"))

        def write_slice(rows) -> None:
            number = TaskContext.get().partitionId()
            connection = connect()
            try:
                cursor = connection.cursor()
                cursor.execute(found, (batch_id, number))
                before = cursor.fetchone()
                if before is not None:
                    if before[0] != slices:
                        raise ValueError(f"batch {batch_id} was begun in {before[0]} slices")
                    return
                some: list[tuple] = []
                for row in rows:
                    some.append(tuple(row[c] for c in columns))
                    if len(some) >= batch_size:
                        cursor.executemany(statement, some)
                        some = []
                if some:
                    cursor.executemany(statement, some)
                cursor.execute(done, (batch_id, number, slices))
                connection.commit()
            except Exception:
                connection.rollback()
                raise
            finally:
                connection.close()

        placed.repartitionById(slices, "_slice").foreachPartition(write_slice)

    return write


def read_back(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(schema).format(fmt).load(path)
