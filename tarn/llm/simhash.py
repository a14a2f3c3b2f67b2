"""SimHash near-duplicates: fingerprints, a grid over segment popcounts, exact verification, components."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tarn.llm.common import byte_texts, saved
from tarn.llm.components import components

BITS = 64
SEED = 42
#: Rows of one cell that meet in one block, and rows of one task's group of cells.
BLOCK_ROWS = 2048
GROUP_ROWS = 50_000


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of one text: a bit is set if it is set in over half of the shingle hashes, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1:].tolist())], ">u8")
    counts = np.zeros(BITS, np.int64)
    for part in range(0, len(hashes), 8192):  # a bounded bit matrix also for very long texts
        counts += np.unpackbits(hashes[part:part + 8192].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, fp) per row, fp as a signed BIGINT; a null, empty or blank text has fingerprint zero."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in byte_texts(batch.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["id", "fp"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fp bigint")


def popcount_vector(fp: Column) -> Column:
    """The popcounts of the 32 two-bit segments, each written as 00, 01 or 11.

    In this unary form the Manhattan distance of two popcount vectors is the
    number of differing bits, and equality of some segments' popcounts is
    equality under a mask.
    """
    low = F.lit(0x5555555555555555).cast("bigint")
    shifted = F.shiftrightunsigned(fp, 1)
    some, both = fp.bitwiseOR(shifted).bitwiseAND(low), fp.bitwiseAND(shifted).bitwiseAND(low)
    return some.bitwiseOR(F.shiftleft(both, 1))


def cell_masks(groups: int, distance: int) -> list[int]:
    """Masks of the sub-grids: vectors within Manhattan distance d agree on all but d of the groups at least."""
    bounds = [round(i * (BITS // 2) / groups) * 2 for i in range(groups + 1)]
    parts = [(1 << hi) - (1 << lo) for lo, hi in zip(bounds, bounds[1:])]
    masks = [sum(c) for c in combinations(parts, groups - distance)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def merge_roots(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the classes of a[i] and b[i]; each entry of root leads to the smallest index of its class."""
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            return root
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while (up := root[root]).tobytes() != root.tobytes():
            root = up


def forest_in_cells(pdf: pd.DataFrame, distance: int) -> pd.DataFrame:
    """Links of a spanning forest of each cell: as many rows as members at most, no link between classes lost."""
    pdf = pdf.sort_values(["cell", "key", "i", "j", "fp"], kind="stable")
    keys = pdf[["cell", "key", "i", "j"]].to_numpy()
    fp, vec = pdf["fp"].to_numpy(np.int64).view(np.uint64), pdf["vec"].to_numpy(np.int64).view(np.uint64)
    run = np.concatenate([[0], np.cumsum((keys[1:] != keys[:-1]).any(axis=1))]) if len(fp) else np.zeros(0, np.int64)
    root, left = np.arange(len(fp)), np.arange(len(fp))
    step = 0
    while len(left):
        step += 1
        left = left[left + step < len(fp)]
        left = left[run[left] == run[left + step]]
        near = left[np.bitwise_count(vec[left] ^ vec[left + step]) <= distance]
        near = near[np.bitwise_count(fp[near] ^ fp[near + step]) <= distance]
        if len(near):
            root = merge_roots(root, near, near + step)
    tied = root != np.arange(len(fp))
    return pd.DataFrame({"a": fp[tied].view(np.int64), "b": fp[root[tied]].view(np.int64)}).drop_duplicates()


def links(distinct: DataFrame, distance: int, groups: int | None = None) -> DataFrame:
    """Links (a, b) between distinct fingerprints whose classes are those of "at most ``distance`` differing bits".

    Grid range-join: every fingerprint enters the cells of each sub-grid, a
    cell's members are compared by the Manhattan bound and then exactly.  A cell
    with many members is cut into blocks and every pair of blocks meets in a
    group of its own, so no task holds more than two blocks of one cell.  Any
    number of ``groups`` over the distance gives the same classes: more of them
    mean more cells for each fingerprint, each shared with fewer others.
    """
    n = distinct.count()
    masks = cell_masks(groups or distance + 2, distance)
    vec = distinct.select("fp", popcount_vector(F.col("fp")).alias("vec"))
    cell = F.explode(F.array(*[F.struct(F.lit(i).alias("cell"), F.col("vec").bitwiseAND(F.lit(m).cast("bigint")).alias("key"))
                               for i, m in enumerate(masks)])).alias("c")
    cells = vec.select("fp", "vec", cell).select("fp", "vec", "c.cell", "c.key")
    crowded = cells.groupBy("cell", "key").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK_ROWS)
    blocks = F.coalesce(F.ceil(F.col("n") / F.lit(BLOCK_ROWS)), F.lit(1)).cast("int")
    placed = (cells.join(crowded, ["cell", "key"], "left").withColumn("blocks", blocks)
              .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("fp", "vec", "cell", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")))
    buckets = max(1, n * len(masks) // GROUP_ROWS)
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64("cell", "key", "i", "j"), F.lit(buckets)))
    found = placed.groupBy("bucket").applyInPandas(lambda pdf: forest_in_cells(pdf, distance), "a bigint, b bigint")
    return found.distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    distance: int = 4, groups: int | None = None) -> DataFrame:
    """(id, fingerprint, component_id) per row of docs.

    component_id is the smallest id reachable over links of fingerprints
    differing in at most ``distance`` bits, the row's own included.  Equal
    fingerprints are one node, so copies cost one row each.  Null and empty
    texts have fingerprint zero and link like any other; rows with a null id
    get their class's smallest non-null id, null if there is none; repeated
    rows are all returned; an empty table gives an empty result; other columns
    are not read.
    """
    if not 0 <= distance <= BITS // 2 - 2:
        raise ValueError("distance must be from 0 to 30")
    marked = saved(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = saved(marked.groupBy("fp").agg(F.min("id").alias("first")), "nodes")
    roots = components(links(nodes.select("fp"), distance, groups), "a", "b")
    named = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = named.join(least, "root").select("fp", "component_id")
    return marked.join(classes, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
