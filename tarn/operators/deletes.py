"""Equality and position deletes, deletion vectors, row lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tarn.operators.windows import running
from tarn.util import small_side


def _newest(deletes: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """A row per deleted key with its newest sequence number: no fan-out, however often a key was deleted."""
    return (deletes.groupBy(*keys).agg(F.max(seq).alias("_delete_seq"))
            .select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_delete_seq"))


def _hit(keys: list[str], seq: str) -> list[Column]:
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return [*same, F.col(seq) < F.col("_delete_seq")]


#: Positions in one bitmap, the bits of a BIGINT.
BITMAP = 64
#: Files with deletes that are named in a filter; beyond that many, all rows look into the bitmaps.
NAMED_FILES = 10_000


def apply_equality_deletes(data: DataFrame, deletes: list[tuple[DataFrame, list[str]]],
                           seq: str = "sequence_number") -> DataFrame:
    """Data without the rows that equality deletes written after them name; NULL equals NULL.

    Each element is a delete set with its own equality columns.
    """
    for rows, keys in deletes:
        data = data.join(_newest(rows, keys, seq), _hit(keys, seq), "left_anti")
    return data


def equality_to_position_deletes(data: DataFrame, deletes: list[tuple[DataFrame, list[str]]], file: str, pos: str,
                                 seq: str = "sequence_number") -> DataFrame:
    """Positions of the rows equality deletes hit."""
    hits = None
    for rows, keys in deletes:
        part = data.join(_newest(rows, keys, seq), _hit(keys, seq), "left_semi").select(file, pos)
        hits = part if hits is None else hits.union(part)
    return hits.distinct() if len(deletes) > 1 else hits


def position_bitmaps(deletes: DataFrame, file: str = "file_path", pos: str = "pos", seq: str = "sequence_number") -> DataFrame:
    """Deleted positions as bitmaps: ``(_b_file, _b_word, _b_bits)``, a row per file and ``BITMAP`` positions.

    ``_b_bits`` has a bitmap per sequence number of the deletes.  Repeated deletes
    combine on the map side, dense ones take a bit each, and a lone one takes
    one short row.
    """
    at = F.col(pos)
    bits = F.expr(f"shiftleft(1L, int(pmod(`{pos}`, {BITMAP})))")
    per_seq = (deletes.where(at.isNotNull() & F.col(seq).isNotNull())
               .groupBy(F.col(file).alias("_b_file"), F.floor(at / BITMAP).alias("_b_word"), F.col(seq).alias("seq"))
               .agg(F.bit_or(bits).alias("bits")))
    return per_seq.groupBy("_b_file", "_b_word").agg(F.collect_list(F.struct("seq", "bits")).alias("_b_bits"))


def _probed(data: DataFrame, bitmaps: DataFrame, file: str, pos: str, seq: str) -> DataFrame:
    """Data with ``_hit``: whether a bitmap of the row's file, not older than the row, has the row's bit."""
    bit = F.pmod(F.col(pos), F.lit(BITMAP)).cast("int")
    set_in = F.exists("_b_bits", lambda b: (b["seq"] >= F.col(seq)) & (F.getbit(b["bits"], bit) == 1))
    # The word goes first: paths share long beginnings, which makes them slow to sort by.
    met = data.join(bitmaps, [F.floor(F.col(pos) / BITMAP) == F.col("_b_word"), F.col(file) == F.col("_b_file")], "left")
    return met.select(*[F.col(f"`{c}`") for c in data.columns], F.coalesce(set_in, F.lit(False)).alias("_hit"))


def _reached(data: DataFrame, deletes: DataFrame, file: str, pos: str, seq: str, by_file: bool) -> tuple[DataFrame | None, DataFrame]:
    """Rows of files without deletes, if these are read apart, and the others with ``_hit``."""
    bitmaps = small_side(position_bitmaps(deletes, "file_path", "pos", seq))
    if by_file:
        named = [r[0] for r in bitmaps.select("_b_file").distinct().limit(NAMED_FILES + 1).collect()]
        if len(named) <= NAMED_FILES:
            inside = F.coalesce(F.col(file).isin(named), F.lit(False))
            return data.where(~inside), _probed(data.where(inside), bitmaps, file, pos, seq)
    return None, _probed(data, bitmaps, file, pos, seq)


def apply_position_deletes(data: DataFrame, deletes: DataFrame, file: str = "file_path", pos: str = "pos",
                           seq: str = "sequence_number", by_file: bool = False) -> DataFrame:
    """Data without the rows at deleted positions; a delete reaches rows up to its own sequence number.

    Rows look their bit up in the bitmaps of their file, which are broadcast
    while they are small, so the data is not shuffled.  With ``by_file``, for
    data stored in folders by ``file`` (or named by ``_metadata.file_path``),
    files without deletes are read on a branch of their own that meets no join.
    """
    rest, probed = _reached(data, deletes, file, pos, seq, by_file)
    kept = probed.where("NOT _hit").drop("_hit")
    return kept if rest is None else rest.union(kept)


def mark_deleted(data: DataFrame, deletes: DataFrame, file: str = "file_path", pos: str = "pos",
                 seq: str = "sequence_number", flag: str = "_deleted", by_file: bool = False) -> DataFrame:
    """All rows, with a flag instead of removal; looked up as by :func:`apply_position_deletes`."""
    rest, probed = _reached(data, deletes, file, pos, seq, by_file)
    marked = probed.withColumnRenamed("_hit", flag)
    return marked if rest is None else rest.withColumn(flag, F.lit(False)).union(marked)


def valid_position_deletes(deletes: DataFrame, files: DataFrame) -> DataFrame:
    """Position deletes whose data file is live."""
    return deletes.join(files.where("content = 0").select("file_path"), "file_path", "left_semi")


def position_deletes_report(deletes: DataFrame, files: DataFrame) -> DataFrame:
    """Position deletes as rows with the partition and layout of the data file they reach, and the delete file they are stored in.

    ``deletes`` carries its own file as ``delete_file_path``; a delete whose data
    file is gone has no partition.
    """
    known = files.where("content = 0").select(F.col("file_path").alias("_p"), F.col("part").alias("partition"), "spec_id")
    met = deletes.join(small_side(known), F.col("file_path") == F.col("_p"), "left")
    return met.select("file_path", "pos", "partition", "spec_id", "delete_file_path")


def compact_position_deletes(deletes: DataFrame, files: DataFrame, granularity: str = "file",
                             partition: str | None = None, writers: int | None = None) -> DataFrame:
    """Valid position deletes laid out for writing, sorted by file and position.

    Granularity ``file`` keeps a data file's deletes together; a file with very
    many of them is range-split by position rather than sent to one task.
    ``partition`` clusters by partition first.
    """
    valid = valid_position_deletes(deletes, files)
    order = ["file_path", "pos"] if granularity == "file" else [partition, "file_path", "pos"]
    spread = valid.repartitionByRange(writers, *order) if writers else valid.repartitionByRange(*order)
    return spread.sortWithinPartitions(*order)


def deletion_vectors(deletes: DataFrame, file: str = "file_path", pos: str = "pos") -> DataFrame:
    """Bitmaps of deleted positions: one row per file and range of 32768 positions.

    Positions start at 0 but bitmap buckets at 1, hence the shift.
    """
    place = F.col(pos) + 1
    return (deletes.groupBy(F.col(file).alias("file_path"), F.bitmap_bucket_number(place).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bitmap")))


def merge_deletion_vectors(*vectors: DataFrame) -> DataFrame:
    """Union of old and new bitmaps per file and range."""
    every = vectors[0]
    for more in vectors[1:]:
        every = every.unionByName(more)
    return every.groupBy("file_path", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def deleted_counts(vectors: DataFrame) -> DataFrame:
    return vectors.groupBy("file_path").agg(F.sum(F.bitmap_count("bitmap")).alias("deleted_rows"))


def dangling_deletes(files: DataFrame, partition: list[str]) -> DataFrame:
    """Delete files that reach no data file of their partition.

    Position deletes reach data up to their own sequence number, equality
    deletes only older data.
    """
    oldest = (files.where("content = 0").groupBy(*partition).agg(F.min("sequence_number").alias("_oldest"))
              .select(*[F.col(p).alias(f"_k_{p}") for p in partition], "_oldest"))
    deletes = files.where("content <> 0")
    joined = deletes.join(oldest, [F.col(p).eqNullSafe(F.col(f"_k_{p}")) for p in partition], "left")
    seq = F.col("sequence_number")
    dangling = (F.col("_oldest").isNull() | ((F.col("content") == 1) & (seq < F.col("_oldest")))
                | ((F.col("content") == 2) & (seq <= F.col("_oldest"))))
    return joined.where(dangling).select(*[deletes[c] for c in deletes.columns])


def dangling_vectors(vectors: DataFrame, files: DataFrame) -> DataFrame:
    """Deletion vectors whose data file is gone."""
    return vectors.join(files.where("content = 0").select("file_path"), "file_path", "left_anti")


def first_row_ids(files: DataFrame, order: list[str], chunk: Column) -> DataFrame:
    """Files with the id of their first row: the number of rows in all files before them."""
    placed = running(files, [], order, chunk, F.col("record_count"), "_upto")
    return placed.withColumn("first_row_id", F.col("_upto") - F.col("record_count")).drop("_upto")


def row_lineage(rows: DataFrame, files: DataFrame, file: str, pos: str) -> DataFrame:
    """Rows with ``_row_id`` and the sequence number that last wrote them."""
    heads = files.select(file, "first_row_id", F.col("sequence_number").alias("_last_updated_sequence_number"))
    return rows.join(small_side(heads), file).withColumn("_row_id", F.col("first_row_id") + F.col(pos)).drop("first_row_id")
