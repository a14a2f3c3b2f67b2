"""Snapshot lineage: ancestors, time travel, ranges of commits and the files in them.

Inputs are plain DataFrames: ``snapshots(snapshot_id, parent_id, committed_at,
operation, ...)`` and ``files(file_path, content, added_snapshot_id,
removed_snapshot_id, ...)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tarn.operators.windows import running
from tarn.session import cut_lineage
from tarn.util import int_div, listed_only


def branch_ancestors(snapshots: DataFrame, heads: DataFrame) -> DataFrame:
    """All ancestors of each head, itself included: (head_id, snapshot_id, depth).

    Walks by doubling: after the k-th round all ancestors up to 2^k - 1 steps
    away are known, so a history of a million commits takes twenty joins.
    """
    jump = cut_lineage(snapshots.where("parent_id IS NOT NULL").select(
        F.col("snapshot_id").alias("from_id"), F.col("parent_id").alias("to_id")))
    found = heads.select(F.col("snapshot_id").alias("head_id"), "snapshot_id", F.lit(0).alias("depth"))
    hops = 1
    while not jump.isEmpty():
        # Every row stays and brings the one so many steps further: one join per round, no union of two copies.
        here = F.struct("snapshot_id", "depth")
        there = F.when(F.col("to_id").isNotNull(), F.struct(F.col("to_id").alias("snapshot_id"), (F.col("depth") + hops).alias("depth")))
        found = (found.join(jump, F.col("snapshot_id") == F.col("from_id"), "left")
                 .select("head_id", F.explode(F.array_compact(F.array(here, there))).alias("_s")).select("head_id", "_s.*"))
        jump = cut_lineage(jump.alias("a").join(jump.alias("b"), F.col("a.to_id") == F.col("b.from_id"))
                           .select("a.from_id", "b.to_id"))
        hops *= 2
    return cut_lineage(found)


def ancestors(snapshots: DataFrame, head: int) -> DataFrame:
    """The snapshot and its ancestors with their distance: (snapshot_id, depth)."""
    heads = snapshots.where(F.col("snapshot_id") == head)
    return branch_ancestors(snapshots, heads).select("snapshot_id", "depth")


def chain(snapshots: DataFrame, head: int) -> DataFrame:
    """Rows of the snapshots table on the lineage of the head, with their depth.

    The snapshots, a row per commit, are stored once: where they are derived from large tables, neither the walk nor what reads the line
    derives them again.
    """
    snapshots = cut_lineage(snapshots)
    return snapshots.join(ancestors(snapshots, head), "snapshot_id")


def history(snapshots: DataFrame, head: int) -> DataFrame:
    """All snapshots, marked whether they are ancestors of the current one."""
    line = ancestors(snapshots, head).select(F.col("snapshot_id").alias("_a"))
    return (snapshots.join(line, F.col("snapshot_id") == F.col("_a"), "left")
            .select("committed_at", "snapshot_id", "parent_id", F.col("_a").isNotNull().alias("is_current_ancestor")))


def head_of(refs: DataFrame, name: str) -> int:
    row = refs.where(F.col("name") == name).select("snapshot_id").first()
    if row is None:
        raise ValueError(f"no branch or tag {name}")
    return row[0]


def snapshot_as_of(line: DataFrame, at: Column) -> DataFrame:
    """The newest snapshot of a lineage committed at or before a time, as one row."""
    return (line.where(F.col("committed_at") <= at)
            .agg(F.max_by("snapshot_id", "committed_at").alias("snapshot_id")))


def live_files(files: DataFrame, line: DataFrame) -> DataFrame:
    """Files added by a snapshot of the lineage and not removed by one."""
    added = line.select(F.col("snapshot_id").alias("added_snapshot_id"))
    removed = line.select(F.col("snapshot_id").alias("removed_snapshot_id"))
    return files.join(added, "added_snapshot_id", "left_semi").join(removed, "removed_snapshot_id", "left_anti")


def up_to(line: DataFrame, snapshot_id: int) -> DataFrame:
    """The part of a lineage that ends at one of its snapshots."""
    return line.where(F.col("depth") >= _depth(line, snapshot_id))


def after(line: DataFrame, snapshot_id: int, inclusive: bool = False) -> DataFrame:
    """The part of a lineage that follows one of its snapshots."""
    depth = _depth(line, snapshot_id)
    return line.where(F.col("depth") <= depth if inclusive else F.col("depth") < depth)


def is_ancestor(line: DataFrame, snapshot_id: int) -> bool:
    """Whether a snapshot is on a lineage."""
    return not line.where(F.col("snapshot_id") == snapshot_id).isEmpty()


def _depth(line: DataFrame, snapshot_id: int) -> int:
    row = line.where(F.col("snapshot_id") == snapshot_id).select("depth").first()
    if row is None:
        raise ValueError(f"snapshot {snapshot_id} is not an ancestor of the end of the range")
    return row[0]


def appended_files(files: DataFrame, span: DataFrame) -> DataFrame:
    """Data files added by the append snapshots of a range."""
    appends = span.where("operation = 'append'").select(F.col("snapshot_id").alias("added_snapshot_id"))
    return files.where("content = 0").join(appends, "added_snapshot_id", "left_semi")


def changed_files(files: DataFrame, span: DataFrame) -> DataFrame:
    """Files with ``_change_type, _change_ordinal, _commit_snapshot_id`` over a range.

    Rewrites (``replace`` commits) change no rows and are skipped; a range that
    holds delete files is refused, as its changes cannot be read off data files.
    """
    commits = span.where("operation <> 'replace'")
    # One row per commit, so ordering all of them in one task stays small.
    ordered = commits.select("snapshot_id", (F.row_number().over(Window.orderBy(F.desc("depth"))) - 1).alias("_change_ordinal"))

    # A file meets both of its commits in one join, so that the list of files, which may come from all rows, is computed once.
    commit = lambda kind, column: F.struct(F.lit(kind).alias("_change_type"), F.col(column).alias("_commit_snapshot_id"))
    sides = files.withColumn("_side", F.explode(F.array(commit("INSERT", "added_snapshot_id"), commit("DELETE", "removed_snapshot_id"))))
    both = (sides.join(ordered, F.col("_side._commit_snapshot_id") == F.col("snapshot_id"))
            .select("*", "_side.*").drop("_side", "snapshot_id"))
    refuse = F.when(F.col("content") != 0, F.raise_error(F.lit("delete files are not supported in changelog scans")).cast("int"))
    return both.where(refuse.isNull())


START_STRATEGIES = ("full_then_incremental", "latest_inclusive", "latest_exclusive", "earliest_inclusive",
                    "from_id_inclusive", "from_timestamp_inclusive")


def start_reading(line: DataFrame, strategy: str, snapshot_id: int | None = None, at: Column | None = None,
                  max_snapshots: int | None = None) -> DataFrame:
    """What a stream read starts with: the snapshots to read, and whether as full table or increment.

    A timestamp between two commits starts at the later one.  Increments are of
    append snapshots only, oldest first where their number per round is limited.
    """
    appends = line.where("operation = 'append'").select("snapshot_id", F.lit("incremental").alias("read_as"), "depth", "committed_at")
    if strategy == "full_then_incremental":
        out = line.where("depth = 0").select("snapshot_id", F.lit("full").alias("read_as"))
    elif strategy == "latest_inclusive":
        out = appends.where("depth = 0")
    elif strategy == "latest_exclusive":
        out = appends.where("depth < 0")
    elif strategy == "earliest_inclusive":
        out = appends
    elif strategy == "from_id_inclusive":
        out = appends.where(F.col("depth") <= _depth(line, snapshot_id))
    elif strategy == "from_timestamp_inclusive":
        out = appends.where(F.col("committed_at") >= at)
    else:
        raise ValueError(f"unknown strategy {strategy}")
    if max_snapshots and "depth" in out.columns:
        out = out.orderBy(F.desc("depth")).limit(max_snapshots)
    return out.select("snapshot_id", "read_as")


def streamable(line: DataFrame, skip_delete: bool = False, skip_overwrite: bool = False) -> DataFrame:
    """Snapshots a stream read takes rows from: the appends.

    Rewrites hold no new rows.  A delete or overwrite is an error unless it is
    to be skipped.
    """
    op = F.col("operation")
    refuse = lambda kind, skip: F.lit(False) if skip else F.raise_error(F.lit(f"cannot stream a {kind} snapshot")).cast("boolean")
    take = F.when(op == "append", True).when(op == "delete", refuse("delete", skip_delete)) \
        .when(op == "overwrite", refuse("overwrite", skip_overwrite)).otherwise(False)
    return line.where(take)


def read_batches(files: DataFrame, order: list[str], chunk: Column, max_rows: int | None = None,
                 max_files: int | None = None) -> DataFrame:
    """Files in reading order with the number of the batch each is read in.

    A batch is cut where the rows (or files) before a file pass a multiple of
    the limit.  ``chunk`` must grow with the order.
    """
    one = F.lit(1) if max_rows is None else F.col("record_count")
    placed = running(files, [], order, chunk, one, "_upto")
    return placed.withColumn("batch", int_div(F.col("_upto") - one, max_files if max_rows is None else max_rows)).drop("_upto")


def rows_of_files(rows: DataFrame, files: DataFrame, file: str, folder: str | None = None) -> DataFrame:
    """Rows stored in the given files, with the files' other columns where there are any.

    Only those files are read where ``file`` is a partition column of the stored rows.  Small files are better stored many to a folder: with
    ``folder``, a partition column of the rows that the files have too, only the folders of the given files are read.
    """
    if folder:
        files = cut_lineage(files)
        rows, folders = listed_only(rows, files.select(folder).distinct(), folder)
        rows, files = rows.join(folders, folder, "left_semi").drop(folder), files.drop(folder)
    rows, listed = listed_only(rows, files, file)
    return rows.join(listed, file, "left_semi" if files.columns == [file] else "inner")


def refs_report(refs: DataFrame) -> DataFrame:
    """Branches and tags with their retention rules."""
    return refs.select("name", "type", "snapshot_id", "max_reference_age_in_ms", "min_snapshots_to_keep", "max_snapshot_age_in_ms")


EXISTING, ADDED, DELETED = 0, 1, 2


def entries_report(files: DataFrame, line: DataFrame) -> DataFrame:
    """Files of a lineage's head with their status there: 0 existing, 1 added, 2 deleted by the head itself."""
    head = line.where("depth = 0").agg(F.max("snapshot_id")).scalar()
    before = line.where("depth > 0")
    kept = live_files(files, before).withColumn("_head", head)
    status = F.when(F.col("removed_snapshot_id") == F.col("_head"), DELETED).otherwise(EXISTING)
    old = kept.withColumn("status", status)
    new = files.withColumn("_head", head).where(F.col("added_snapshot_id") == F.col("_head")).withColumn("status", F.lit(ADDED))
    return old.unionByName(new).drop("_head")


def metadata_log(entries: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Each metadata file with the newest snapshot committed by then.

    Both sides are a row per commit; they are merged in time order.
    """
    log = entries.select("timestamp", "file", F.lit(None).cast("bigint").alias("snapshot_id"), F.lit(1).alias("_side"))
    commits = snapshots.select(F.col("committed_at").alias("timestamp"), F.lit(None).cast("string").alias("file"), "snapshot_id", F.lit(0).alias("_side"))
    so_far = Window.orderBy("timestamp", "_side").rowsBetween(Window.unboundedPreceding, 0)
    latest = F.last("snapshot_id", ignorenulls=True).over(so_far)
    return log.union(commits).withColumn("latest_snapshot_id", latest).where("_side = 1").select("timestamp", "file", "latest_snapshot_id")


def split_watermarks(files: DataFrame, split: str, lower: str) -> DataFrame:
    """Watermark of each split: the smallest lower bound of its files; a file without one is an error."""
    bound = F.when(F.col(lower).isNull(), F.raise_error(F.lit("missing lower bound of the watermark column")).cast("timestamp_ntz")) \
        .otherwise(F.col(lower))
    return files.groupBy(split).agg(F.min(bound).alias("watermark"))


def find_files(files: DataFrame, line: DataFrame | None = None, file_predicate: Column | None = None,
               record_predicate=None, partitions: DataFrame | None = None) -> DataFrame:
    """Live files of a lineage, limited by partition, file columns and what their bounds can hold.

    ``record_predicate`` is a :class:`tarn.operators.skipping.Predicate`.
    """
    out = live_files(files, line) if line is not None else files
    if file_predicate is not None:
        out = out.where(file_predicate)
    if record_predicate is not None:
        out = out.where(record_predicate.may_match)
    if partitions is not None:
        out = out.join(partitions, partitions.columns, "left_semi")
    return out
