"""Column metrics, metadata reports and statistics over files and snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

DATA, POSITION_DELETES, EQUALITY_DELETES = 0, 1, 2


def _next_char(c: Column) -> Column:
    """The next code point, stepping over the surrogate range."""
    code = F.ascii(c)
    following = F.when(code == 0xD7FF, F.lit(0xE000)).otherwise(code + 1)
    return F.decode(F.unhex(F.lpad(F.hex(following), 8, "0")), "UTF-32")


def upper_bound(text: Column, length: int) -> Column:
    """Shortest string of at most ``length`` code points not below the text; NULL if there is none."""
    top = "\U0010ffff"
    head = F.rtrim(F.substring(text, 1, length), F.lit(top))
    last = F.right(head, F.lit(1))
    bumped = F.concat(F.left(head, F.length(head) - 1), _next_char(last))
    return F.when(F.length(text) <= length, text).when(F.length(head) > 0, bumped)


def column_metrics(df: DataFrame, by: list[str], modes: dict[str, str]) -> DataFrame:
    """Per file: row count and, by each column's mode, its value/null/NaN counts and bounds.

    Modes: ``none``, ``counts``, ``truncate(n)`` (string bounds cut to n code
    points) and ``full``.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    aggs = [F.count("*").alias("record_count")]
    for name, mode in modes.items():
        if mode == "none":
            continue
        col = F.col(name)
        aggs += [F.count("*").alias(f"{name}_values"), F.count_if(col.isNull()).alias(f"{name}_nulls")]
        if types[name] in ("float", "double"):
            aggs.append(F.count_if(F.isnan(col)).alias(f"{name}_nans"))
            col = F.when(~F.isnan(col), col)
        if mode != "counts":
            low, high = F.min(col), F.max(col)
            if mode.startswith("truncate") and types[name] == "string":
                length = int(mode[len("truncate("):-1])
                low, high = F.substring(low, 1, length), upper_bound(high, length)
            aggs += [low.alias(f"{name}_lower"), high.alias(f"{name}_upper")]
    return df.groupBy(*by).agg(*aggs)


def count_from_stats(files: DataFrame, counts: list[str] = (), bounds: list[str] = (), truncated: list[str] = ()) -> DataFrame:
    """COUNT(*), COUNT(c), MIN(c) and MAX(c) from file statistics, without reading data.

    NULL says that the statistics have no answer and the data must be read: all
    are NULL where delete files are listed, a count if a file lacks its number
    of NULLs, a bound if a file with values lacks it, holds NaN, or the column
    is named as one whose stored bounds may be cut.
    """
    rows = F.col("record_count")
    sound = F.count_if(F.col("content") != DATA) == 0 if "content" in files.columns else F.lit(True)
    aggs = [F.when(sound, F.coalesce(F.sum(rows), F.lit(0))).alias("count_all")]
    for c in counts:
        known = F.count_if(F.col(f"{c}_nulls").isNull()) == 0
        aggs.append(F.when(sound & known, F.coalesce(F.sum(rows - F.col(f"{c}_nulls")), F.lit(0))).alias(f"count_{c}"))
    for c in bounds:
        values = rows - F.coalesce(F.col(f"{c}_nulls"), F.lit(0)) if f"{c}_nulls" in files.columns else rows
        unknown = (values > 0) & (F.col(f"{c}_lower").isNull() | F.col(f"{c}_upper").isNull())
        if f"{c}_nans" in files.columns:
            unknown = unknown | (F.coalesce(F.col(f"{c}_nans"), F.lit(0)) > 0)
        usable = sound & (F.count_if(unknown) == 0) & F.lit(c not in truncated)
        aggs += [F.when(usable, F.min(f"{c}_lower")).alias(f"min_{c}"), F.when(usable, F.max(f"{c}_upper")).alias(f"max_{c}")]
    return files.agg(*aggs)


def _of(content: int, value: Column) -> Column:
    return F.coalesce(F.sum(F.when(F.col("content") == content, value)), F.lit(0))


def partitions_report(files: DataFrame, snapshots: DataFrame, partition: list[str]) -> DataFrame:
    """Per partition and layout: data and delete counts, bytes, and what last changed it."""
    when = snapshots.select(F.col("snapshot_id").alias("added_snapshot_id"), "committed_at")
    one, records = F.lit(1), F.col("record_count")
    return (files.join(when, "added_snapshot_id", "left").groupBy(*partition, "spec_id").agg(
        _of(DATA, records).alias("record_count"), _of(DATA, one).alias("file_count"),
        _of(DATA, F.col("file_size_in_bytes")).alias("total_data_file_size_in_bytes"),
        _of(POSITION_DELETES, records).alias("position_delete_record_count"),
        _of(POSITION_DELETES, one).alias("position_delete_file_count"),
        _of(EQUALITY_DELETES, records).alias("equality_delete_record_count"),
        _of(EQUALITY_DELETES, one).alias("equality_delete_file_count"),
        F.max("committed_at").alias("last_updated_at"),
        F.max_by("added_snapshot_id", F.struct("committed_at", "added_snapshot_id")).alias("last_updated_snapshot_id")))


STAT_SUMS = ("record_count", "file_count", "total_size", "position_delete_files", "equality_delete_files")


def partition_stats(files: DataFrame, partition: list[str]) -> DataFrame:
    """Mergeable statistics of each partition."""
    one = F.lit(1)
    return files.groupBy(*partition).agg(
        _of(DATA, F.col("record_count")).alias("record_count"), _of(DATA, one).alias("file_count"),
        _of(DATA, F.col("file_size_in_bytes")).alias("total_size"),
        _of(POSITION_DELETES, one).alias("position_delete_files"), _of(EQUALITY_DELETES, one).alias("equality_delete_files"),
        F.max("added_snapshot_id").alias("last_snapshot_id"))


def append_partition_stats(old: DataFrame, new_files: DataFrame, partition: list[str]) -> DataFrame:
    """Old statistics brought up to date by the files added since, without reading the old files again.

    The live record count is known only for partitions without delete files.
    """
    both = old.unionByName(partition_stats(new_files, partition))
    merged = both.groupBy(*partition).agg(*[F.sum(c).alias(c) for c in STAT_SUMS],
                                          F.max("last_snapshot_id").alias("last_snapshot_id"))
    no_deletes = (F.col("position_delete_files") == 0) & (F.col("equality_delete_files") == 0)
    return merged.withColumn("total_record_count", F.when(no_deletes, F.col("record_count")))


def group_summaries(files: DataFrame, group: list[str], column: str, snapshot: str = "added_snapshot_id") -> DataFrame:
    """Per group of files: counts and the NULLs and range of a partition column."""
    c = F.col(column)
    return files.groupBy(*group).agg(
        F.count("*").alias("file_count"), F.sum("record_count").alias("row_count"), F.max(snapshot).alias("added_snapshot_id"),
        F.bool_or(c.isNull()).alias("contains_null"), F.min(c).alias("lower_bound"), F.max(c).alias("upper_bound"))


def scan_summary(files: DataFrame, snapshots: DataFrame, partition: str, after: Column | None = None,
                 before: Column | None = None, limit: int | None = None) -> DataFrame:
    """Per partition: files, records and newest data time, of files committed in a time range.

    A limit keeps the first partitions in key order.  A range reaching back
    before the oldest known commit is refused: expired commits may be in it.
    """
    when = snapshots.select(F.col("snapshot_id").alias("added_snapshot_id"), F.col("committed_at").alias("_at"))
    if after is not None:
        oldest = snapshots.agg((F.min("committed_at") > after).alias("gap")).first()["gap"]
        if oldest:
            raise ValueError("cannot satisfy the time range: it may include expired snapshots")
    rows = files.where(F.col("content") == DATA).join(when, "added_snapshot_id")
    if after is not None:
        rows = rows.where(F.col("_at") >= after)
    if before is not None:
        rows = rows.where(F.col("_at") <= before)
    out = rows.groupBy(partition).agg(F.count("*").alias("file_count"), F.sum("record_count").alias("record_count"),
                                      F.max("_at").alias("data_timestamp"))
    return out.orderBy(partition).limit(limit) if limit else out


def snapshot_summary(files: DataFrame, partition: str) -> DataFrame:
    """Per commit: added and deleted files, records and bytes, changed partitions, and running totals."""

    def side(snapshot: str, sign: int) -> DataFrame:
        return files.where(F.col(snapshot).isNotNull()).select(
            F.col(snapshot).alias("snapshot_id"), partition, "record_count", "file_size_in_bytes", F.lit(sign).alias("sign"))

    moves = side("added_snapshot_id", 1).union(side("removed_snapshot_id", -1))
    added, deleted = F.col("sign") == 1, F.col("sign") == -1
    total = lambda which, c: F.coalesce(F.sum(F.when(which, F.col(c))), F.lit(0))
    key = F.coalesce(F.concat(F.lit("="), F.col(partition)), F.lit("null"))
    per_commit = moves.groupBy("snapshot_id").agg(
        F.count_if(added).alias("added_data_files"), F.count_if(deleted).alias("deleted_data_files"),
        total(added, "record_count").alias("added_records"), total(deleted, "record_count").alias("deleted_records"),
        total(added, "file_size_in_bytes").alias("added_files_size"), total(deleted, "file_size_in_bytes").alias("removed_files_size"),
        F.count_distinct(key).alias("changed_partition_count"))
    # One row per commit from here on.
    so_far = Window.orderBy("snapshot_id").rowsBetween(Window.unboundedPreceding, 0)
    return per_commit.withColumns({
        "total_records": F.sum(F.col("added_records") - F.col("deleted_records")).over(so_far),
        "total_data_files": F.sum(F.col("added_data_files") - F.col("deleted_data_files")).over(so_far),
        "total_files_size": F.sum(F.col("added_files_size") - F.col("removed_files_size")).over(so_far)})


def table_changes(files: DataFrame) -> DataFrame:
    """Per commit: data files and bytes, delete files and records, by kind; feeds the maintenance trigger."""
    one, records = F.lit(1), F.col("record_count")
    return files.groupBy(F.col("added_snapshot_id").alias("snapshot_id")).agg(
        _of(DATA, one).alias("data_file_count"), _of(DATA, F.col("file_size_in_bytes")).alias("data_file_size"),
        _of(POSITION_DELETES, one).alias("pos_delete_file_count"), _of(POSITION_DELETES, records).alias("pos_delete_record_count"),
        _of(EQUALITY_DELETES, one).alias("eq_delete_file_count"), _of(EQUALITY_DELETES, records).alias("eq_delete_record_count"))


def ndv(df: DataFrame, columns: list[str], by: list[str] = ()) -> DataFrame:
    """Distinct counts per column by theta sketches: (column, ndv).  Sketches merge on the map side."""
    sketches = df.groupBy(*by).agg(*[F.theta_sketch_agg(c).alias(c) for c in columns])
    counts = sketches.select(*by, *[F.theta_sketch_estimate(c).cast("bigint").alias(c) for c in columns])
    return counts.unpivot(list(by), columns, "column_name", "ndv")


def merge_ndv(sketches: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct counts over all sketches of each column, such as one per file."""
    merged = sketches.agg(*[F.theta_sketch_estimate(F.theta_union_agg(c)).cast("bigint").alias(c) for c in columns])
    return merged.unpivot([], columns, "column_name", "ndv")
