"""Compaction planning and execution, expiry, orphan files, imports, path rewrites, triggers."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tarn.functions.transforms import PartitionField
from tarn.operators.layout import SortTerm, distribute, write_order, zorder_layout
from tarn.operators.ordered import pack, scan_in_order
from tarn.session import cut_lineage
from tarn.util import int_div

# Default sizing of file rewrites.
TARGET_FILE_SIZE = 512 * 1024 * 1024
MIN_FILE_RATIO, MAX_FILE_RATIO = 0.75, 1.80
MIN_INPUT_FILES = 5
MAX_GROUP_SIZE = 100 * 1024**3
SPLIT_OVERHEAD = 5 * 1024
DELETE_RATIO = 0.3
NO_DELETE_LIMIT = 2**31 - 1


@dataclass(frozen=True)
class Sizing:
    target: int = TARGET_FILE_SIZE
    min_input_files: int = MIN_INPUT_FILES
    max_group: int = MAX_GROUP_SIZE
    delete_files: int = NO_DELETE_LIMIT
    delete_ratio: float = DELETE_RATIO

    @property
    def smallest(self) -> int:
        return int(self.target * MIN_FILE_RATIO)

    @property
    def largest(self) -> int:
        return int(self.target * MAX_FILE_RATIO)

    @property
    def write_limit(self) -> int:
        """Largest file a rewrite should produce: half way from the target to the maximum."""
        return int(self.target + (self.largest - self.target) * 0.5)


def output_files(size: Column, sizing: Sizing) -> Column:
    """Number of files to write for an input size.

    A remainder too small for a file of its own is spread over the others as
    long as that makes them at most a tenth larger than the target.
    """
    without = F.greatest(int_div(size, sizing.target), F.lit(1).cast("bigint"))
    rest = size % F.lit(sizing.target)
    rounded_up = without + F.when(rest > 0, 1).otherwise(0)
    average = int_div(size, without)
    return (F.when(size < sizing.target, F.lit(1).cast("bigint"))
            .when(rest > sizing.smallest, rounded_up)
            .when(average < min(1.1 * sizing.target, float(sizing.write_limit)), without)
            .otherwise(rounded_up))


def split_size(size: Column, sizing: Sizing) -> Column:
    estimate = int_div(size, output_files(size, sizing)) + SPLIT_OVERHEAD
    return F.when(estimate < sizing.target, F.lit(sizing.target).cast("bigint")).otherwise(
        F.least(estimate, F.lit(sizing.write_limit).cast("bigint")))


def _delete_heavy(files: DataFrame, sizing: Sizing) -> Column:
    heavy = F.lit(False)
    if "delete_file_count" in files.columns:
        heavy = heavy | F.coalesce(F.col("delete_file_count") >= sizing.delete_files, F.lit(False))
    if "deleted_records" in files.columns:
        known = F.coalesce(F.col("deleted_records"), F.lit(0))
        heavy = heavy | (F.least(known, F.col("record_count")) >= F.col("record_count") * sizing.delete_ratio) & (known > 0)
    return heavy


def compaction_files(files: DataFrame, partition: list[str], sizing: Sizing = Sizing(), order: str = "file_path",
                     size: str = "file_size_in_bytes", rewrite_all: bool = False) -> DataFrame:
    """Files worth rewriting with the number of their group inside the partition."""
    marked = files.withColumn("_heavy", _delete_heavy(files, sizing))
    wrong_size = (F.col(size) < sizing.smallest) | (F.col(size) > sizing.largest)
    chosen = marked if rewrite_all else marked.where(wrong_size | F.col("_heavy"))
    packed = pack(chosen, partition, [order], size, sizing.max_group, name="file_group")
    if rewrite_all:
        return packed.drop("_heavy")
    # A group holds at most max_group bytes of files, so this window is bounded.
    group = Window.partitionBy(*partition, "file_group")
    n, b = F.col("_n"), F.col("_b")
    sized = packed.withColumns({"_n": F.count("*").over(group), "_b": F.sum(size).over(group), "_h": F.bool_or("_heavy").over(group)})
    kept = sized.where(((n > 1) & (n >= sizing.min_input_files)) | ((n > 1) & (b > sizing.target))
                       | (b > sizing.largest) | F.col("_h"))
    return kept.drop("_heavy", "_n", "_b", "_h")


JOB_ORDERS = {
    "none": None,
    "bytes-asc": lambda: F.asc("input_bytes"), "bytes-desc": lambda: F.desc("input_bytes"),
    "files-asc": lambda: F.asc("input_files"), "files-desc": lambda: F.desc("input_files"),
}


def compaction_plan(files: DataFrame, partition: list[str], sizing: Sizing = Sizing(), order: str = "file_path",
                    size: str = "file_size_in_bytes", job_order: str = "none") -> DataFrame:
    """One row per file group to rewrite, with its input, output files and split size."""
    chosen = compaction_files(files, partition, sizing, order, size)
    groups = chosen.groupBy(*partition, "file_group").agg(F.count("*").alias("input_files"), F.sum(size).alias("input_bytes"))
    plan = groups.withColumns({"output_files": output_files(F.col("input_bytes"), sizing),
                               "split_size": split_size(F.col("input_bytes"), sizing)})
    by = JOB_ORDERS[job_order]
    return plan.orderBy(by()) if by else plan


def compact(rows: DataFrame, files_out: int, strategy: str = "binpack", order: list[SortTerm] | None = None,
            zorder: list[tuple[str, str]] | None = None, partitions_per_file: int = 1) -> DataFrame:
    """Rows of a file group laid out for rewriting; writing and swapping files is the caller's."""
    if strategy == "binpack":
        return rows.repartition(files_out)
    if strategy == "sort":
        return distribute(rows, "range", order=order, writers=files_out * partitions_per_file)
    if strategy == "zorder":
        return zorder_layout(rows, zorder, files_out * partitions_per_file)
    raise ValueError(f"unknown strategy {strategy}")


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the files behind a scan; only their names and sizes are read."""
    files = df.select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("n")).distinct()
    return files.agg(F.sum("n")).first()[0] or 0


def writers_for(df: DataFrame, least: int = 1, sizing: Sizing = Sizing(), sorted_rows: int | None = None) -> int:
    """Writers of a rewrite of stored rows, so that files come out near the target size.

    A writer that sorts must hold its rows: with ``sorted_rows`` there are as many that each has about so many, in files below the target.
    """
    writers = max(least, shuffle_partitions(stored_bytes(df), 1.0, 1, sizing))
    return max(writers, -(-df.count() // sorted_rows)) if sorted_rows else writers


def shuffle_partitions(input_bytes: int, compression: float, partitions_per_file: int, sizing: Sizing = Sizing()) -> int:
    """Shuffle partitions of a sorting rewrite of so many stored bytes."""
    size = int(input_bytes * compression)
    if size < sizing.target:
        files = 1
    else:
        whole, rest = divmod(size, sizing.target)
        up = whole + (1 if rest else 0)
        small = size // whole < min(1.1 * sizing.target, sizing.write_limit)
        files = up if rest > sizing.smallest or not small else whole
    return max(1, files * partitions_per_file)


def relayout(rows: DataFrame, spec: list[PartitionField], order: list[SortTerm], writers: int | None = None) -> DataFrame:
    """Rows with the partition columns of a new layout, clustered and sorted for writing it."""
    wide = rows.select("*", *[f.column() for f in spec if f.transform != "identity"])
    terms = write_order(spec, order)
    return distribute(wide, "range" if order else "hash", spec=spec, order=terms, writers=writers)


def retained_snapshots(snapshots: DataFrame, refs: DataFrame, now: Column, older_than: Column, min_keep: int = 1,
                       max_ref_age_ms: int = 2**62) -> DataFrame:
    """Ids of the snapshots expiry keeps.

    ``main`` and refs young enough keep their heads.  A kept branch keeps its
    ancestors while they are among its newest few or young enough, up to the
    first that is neither.  Snapshots no ref reaches are kept only while young.
    """
    at = snapshots.select("snapshot_id", "committed_at")
    millis = lambda c: F.unix_millis(c.cast("timestamp"))
    head_age = millis(now) - millis(F.col("committed_at"))
    kept = refs.join(at, "snapshot_id").where(
        (F.col("name") == "main") | (head_age <= F.coalesce(F.col("max_reference_age_in_ms"), F.lit(max_ref_age_ms))))
    heads = kept.select("snapshot_id").distinct()

    branches = kept.where("type = 'BRANCH'")
    cutoff = F.coalesce(F.timestamp_millis(millis(now) - F.col("max_snapshot_age_in_ms")).cast("timestamp_ntz"), older_than)
    rules = branches.select("snapshot_id", cutoff.alias("_cutoff"), F.coalesce(F.col("min_snapshots_to_keep"), F.lit(min_keep)).alias("_keep"))
    levels = _jumps(snapshots)
    depths = _root_depths(at, levels)
    stops = _stop_depths(rules, at, levels, depths)
    on_path = _least_below(stops, levels)
    on_branch = on_path.join(depths, "snapshot_id").where("_root_depth > _stop").select("snapshot_id")

    reached = on_path.select("snapshot_id").union(kept.where("type = 'TAG'").select("snapshot_id"))
    loose = (at.join(reached, "snapshot_id", "left_anti").where(F.col("committed_at") >= older_than).select("snapshot_id"))
    return heads.union(on_branch).union(loose).distinct()


def _jumps(snapshots: DataFrame) -> list[DataFrame]:
    """Per level k a row per snapshot that has a 2^k-th ancestor: that one, and the oldest commit of the 2^k snapshots from here on."""
    level = cut_lineage(snapshots.where("parent_id IS NOT NULL").select(
        F.col("snapshot_id").alias("_from"), F.col("parent_id").alias("_to"), F.col("committed_at").alias("_oldest")))
    levels = []
    while not level.isEmpty():
        levels.append(level)
        a, b = level.alias("a"), level.alias("b")
        level = cut_lineage(a.join(b, F.col("a._to") == F.col("b._from")).select(
            "a._from", "b._to", F.least("a._oldest", "b._oldest").alias("_oldest")))
    return levels


def _root_depths(at: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """Steps from each snapshot to the first one of its line."""
    walk = at.select("snapshot_id", F.col("snapshot_id").alias("_at"), F.lit(0).cast("bigint").alias("_root_depth"))
    for k in reversed(range(len(levels))):
        up = F.when(F.col("_to").isNotNull(), F.lit(2 ** k)).otherwise(0)
        walk = walk.join(levels[k], F.col("_at") == F.col("_from"), "left").select(
            "snapshot_id", F.coalesce("_to", "_at").alias("_at"), (F.col("_root_depth") + up).alias("_root_depth"))
    return cut_lineage(walk.select("snapshot_id", "_root_depth"))


def _stop_depths(rules: DataFrame, at: DataFrame, levels: list[DataFrame], depths: DataFrame) -> DataFrame:
    """Per kept branch head the depth of the first snapshot its rule does not keep, or -1 if it keeps all.

    A branch is one row: it goes up as many steps as it must keep, then on while
    all the snapshots jumped over are young enough.
    """
    walk = cut_lineage(rules.withColumn("_at", F.when(F.col("_keep") < 2 ** len(levels), F.col("snapshot_id"))))
    for k in range(len(levels)):
        step = F.getbit(F.col("_keep").cast("bigint"), F.lit(k)) == 1
        walk = walk.join(levels[k], F.col("_at") == F.col("_from"), "left").select(
            "snapshot_id", "_cutoff", "_keep", F.when(step, F.col("_to")).otherwise(F.col("_at")).alias("_at"))
    walk = cut_lineage(walk)
    for k in reversed(range(len(levels))):
        young = F.col("_oldest") >= F.col("_cutoff")
        walk = walk.join(levels[k], F.col("_at") == F.col("_from"), "left").select(
            "snapshot_id", "_cutoff", F.when(young, F.col("_to")).otherwise(F.col("_at")).alias("_at"))
    last = walk.join(at.withColumnRenamed("snapshot_id", "_at"), "_at", "left").join(
        depths.withColumnRenamed("snapshot_id", "_at"), "_at", "left")
    stop = F.when(F.col("committed_at") < F.col("_cutoff"), F.col("_root_depth")).otherwise(-1)
    return cut_lineage(last.groupBy("snapshot_id").agg(F.min(stop).alias("_stop")))


def _least_below(stops: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """Per snapshot on the line of a kept branch the least stop of the branches it lies on: a row per snapshot in every round."""
    least = stops
    for level in levels:
        up = least.join(level, F.col("snapshot_id") == F.col("_from")).select(F.col("_to").alias("snapshot_id"), "_stop")
        least = cut_lineage(least.union(up).groupBy("snapshot_id").agg(F.min("_stop").alias("_stop")))
    return least


def expired_files(snapshot_files: DataFrame, retained: DataFrame) -> DataFrame:
    """Paths referenced only by snapshots that are not kept."""
    keep = snapshot_files.join(retained, "snapshot_id", "left_semi").select("file_path")
    gone = snapshot_files.join(retained, "snapshot_id", "left_anti").select("file_path")
    return gone.subtract(keep)


def reachable_files(*references: DataFrame) -> DataFrame:
    """Distinct paths over all kinds of references."""
    return reduce(lambda a, b: a.union(b), references).distinct()


_LOCATION = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/]*))?(/?.*)$"


def _location(path: Column, schemes: dict[str, str], authorities: dict[str, str]) -> Column:
    """Scheme, authority and path of a location, equivalent names replaced by one of them."""

    def same(value: Column, names: dict[str, str]) -> Column:
        out = F.when(value == "", None)
        for name, standard in names.items():
            out = out.when(value == name, standard)
        return out.otherwise(value)

    part = lambda i: F.regexp_extract(path, _LOCATION, i)
    return F.struct(same(F.lower(part(1)), {k.lower(): v.lower() for k, v in schemes.items()}).alias("scheme"), same(part(2), authorities).alias("authority"), part(3).alias("path"))


def orphan_files(listing: DataFrame, valid: DataFrame, older_than: Column, equal_schemes: dict[str, str] | None = None,
                 equal_authorities: dict[str, str] | None = None, mismatch: str = "error") -> DataFrame:
    """Listed files, old enough, that no metadata names.

    The same path under another scheme or authority is a mismatch: an error,
    not an orphan (``ignore``), or an orphan (``delete``).  A valid location
    without scheme or authority matches any.
    """
    schemes, authorities = equal_schemes or {}, equal_authorities or {}
    known = (valid.select(_location(F.col("file_path"), schemes, authorities).alias("v"))
             .groupBy("v.path").agg(F.collect_set(F.struct("v.scheme", "v.authority")).alias("_prefixes")))
    old = listing.where(F.col("last_modified") < older_than).withColumn("_l", _location(F.col("file_path"), schemes, authorities))
    joined = old.join(known, F.col("_l.path") == F.col("path"), "left")
    fits = F.exists("_prefixes", lambda p: (p["scheme"].isNull() | p["scheme"].eqNullSafe(F.col("_l.scheme")))
                    & (p["authority"].isNull() | p["authority"].eqNullSafe(F.col("_l.authority"))))
    unknown = F.col("_prefixes").isNull()
    other = F.coalesce(~fits, F.lit(False))
    if mismatch == "error":
        verdict = F.when(other, F.raise_error(F.lit("a file's scheme or authority differs from its metadata")).cast("boolean")).otherwise(unknown)
    elif mismatch == "ignore":
        verdict = unknown
    elif mismatch == "delete":
        verdict = unknown | other
    else:
        raise ValueError(f"unknown mismatch mode {mismatch}")
    return joined.where(verdict).select(*listing.columns)


def folder_entries(folder: str) -> Iterator[tuple[str, bool, int, datetime | None]]:
    """(path, whether it is a folder, bytes, time) of what lies directly in a folder, on any store pyarrow knows."""
    from pyarrow import fs

    local = folder.startswith(("/", "file:"))
    system, path = (fs.LocalFileSystem(), re.sub("^file:(//)?", "", folder)) if local else fs.FileSystem.from_uri(folder)
    prefix = folder[:len(folder) - len(path)]
    for info in system.get_file_info(fs.FileSelector(path)):
        yield prefix + info.path, info.type == fs.FileType.Directory, info.size or 0, info.mtime


def list_tree(spark: SparkSession, root: str, entries: Callable[[str], Iterable[tuple]] = folder_entries) -> DataFrame:
    """Paths, sizes and times of all files under a folder, listed by tasks.

    The folders of one depth are a table spread over the cluster; each task lists
    its folders and gives their files and the folders of the next depth.  Every
    round is stored, the driver only learns whether a next one is needed.
    """
    schema = "path string, is_folder boolean, file_size_in_bytes bigint, last_modified timestamp"

    def listed(batches):
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                found = iter(entries(folder))
                while some := list(islice(found, 10_000)):
                    path, is_folder, size, time = zip(*some)
                    yield pa.RecordBatch.from_arrays([pa.array(path, pa.string()), pa.array(is_folder, pa.bool_()), pa.array(size, pa.int64()),
                                                      pa.array(time, pa.timestamp("us", "UTC"))], ["path", "is_folder", "file_size_in_bytes", "last_modified"])

    folders = spark.createDataFrame([(root.rstrip("/"),)], "path string")
    files = None
    while True:
        found = cut_lineage(folders.repartition("path").mapInArrow(listed, schema))
        here = found.where("NOT is_folder").select(F.col("path").alias("file_path"), "file_size_in_bytes", "last_modified")
        files = here if files is None else files.union(here)
        folders = found.where("is_folder").select("path")
        if folders.isEmpty():
            return files


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """The same listing by Spark's own file index, for stores only it can open; it keeps a status per file in the driver."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            .select(F.col("path").alias("file_path"), F.col("length").alias("file_size_in_bytes"), F.col("modificationTime").alias("last_modified")))


def import_plan(listing: DataFrame, partition: list[str], where: dict[str, str] | None = None,
                existing: DataFrame | None = None, check_duplicates: bool = True) -> DataFrame:
    """Files to import with partition values read from their paths (``key=value`` folders).

    A file the table already has is an error while duplicates are checked.
    """
    out = listing.where(F.element_at(F.split("file_path", "/"), -1).rlike(r"^[^_.]"))
    for name in partition:
        value = F.regexp_extract("file_path", rf"/{name}=([^/]*)/", 1)
        out = out.withColumn(name, F.when(value != "__HIVE_DEFAULT_PARTITION__", F.url_decode(value)))
    for name, value in (where or {}).items():
        out = out.where(F.col(name) == value)
    if existing is not None and check_duplicates:
        have = existing.select(F.col("file_path").alias("_have")).distinct()
        out = out.join(have, F.col("file_path") == F.col("_have"), "left")
        twice = F.when(F.col("_have").isNotNull(), F.raise_error(F.concat(F.lit("already imported: "), F.col("file_path"))).cast("boolean"))
        out = out.where(twice.isNull()).drop("_have")
    return out


def snapshot_table(source: DataFrame, partition: list[str], snapshot_id: int = 1) -> DataFrame:
    """File metadata of a new table whose first commit takes over the files of a stored one; the files stay where they are.

    ``source`` is a scan of the stored table.  Rows per file and partition are
    counted on the map side, and only the partition columns are read.
    """
    file = F.struct(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size_in_bytes"))
    found = source.select(*partition, file.alias("_f")).groupBy(*partition, "_f").agg(F.count("*").alias("record_count"))
    return found.select("_f.*", *partition, F.lit(0).alias("content"), "record_count", F.lit(snapshot_id).cast("bigint").alias("added_snapshot_id"),
                        F.lit(None).cast("bigint").alias("removed_snapshot_id"), F.lit(1).cast("bigint").alias("sequence_number"))


def rewrite_paths(files: DataFrame, source_prefix: str, target_prefix: str, after: int | None = None,
                  up_to: int | None = None) -> DataFrame:
    """(source, target) copies of files moved from one path prefix to another; a path outside the prefix is an error.

    Limited to the files added after one version and up to another where these are given.
    """
    if after is not None:
        files = files.where(F.col("sequence_number") > after)
    if up_to is not None:
        files = files.where(F.col("sequence_number") <= up_to)
    path, source, moved = F.col("file_path"), source_prefix.rstrip("/"), target_prefix.rstrip("/")
    outside = F.raise_error(F.concat(F.lit("path outside the source prefix: "), path))
    inside = (path == source) | path.startswith(source + "/")  # /a/b does not hold /a/bc
    target = F.when(inside, F.concat(F.lit(moved), F.substring(path, len(source) + 1, 1 << 30))).otherwise(outside)
    return files.select(path.alias("source_path"), target.alias("target_path"))


def maintenance_trigger(changes: DataFrame, table: list[str], order: list[str], time: str, thresholds: dict[str, int],
                        timeout_seconds: int | None = None, min_delay_seconds: int = 0) -> DataFrame:
    """Marks the commits at which a maintenance task fires.

    Changes add up since the last firing; any threshold reached fires and
    resets them.  ``commit_count`` counts commits.  A timeout fires when so much
    time has passed, and firings are at least the minimum delay apart.
    """
    names = [n for n in thresholds if n != "commit_count"]
    limits = dict(thresholds)

    def new_step():
        total = dict.fromkeys(limits, 0)
        last = None

        def step(at, *values):
            nonlocal last
            seconds = at.timestamp()
            last = seconds if last is None else last
            for name, value in zip(names, values):
                total[name] += int(value)
            if "commit_count" in total:
                total["commit_count"] += 1
            due = any(total[n] >= limit for n, limit in limits.items())
            due = due or (timeout_seconds is not None and seconds - last >= timeout_seconds)
            if due and fired and seconds - last < min_delay_seconds:
                due = False
            if due:
                fired.append(seconds)
                last = seconds
                for n in total:
                    total[n] = 0
            return (due,)

        fired: list[float] = []
        return step

    return scan_in_order(changes, table, order, [time, *names], "fires boolean", new_step)
