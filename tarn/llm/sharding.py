"""Shards by jump consistent hashing, with gapless slots."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import pandas_udf

from tarn.llm.common import saved

#: Rows whose slots are counted in one piece.
BUCKET_ROWS = 2000
#: Multiplier of the generator that the jump hash steps with (fixed value of the published algorithm).
STEP = np.uint64(2862933555777941757)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Jump consistent hash of 64-bit keys, vectorised: only keys that still jump take part in a step."""
    key = keys.astype(np.uint64)
    shard, at = np.zeros(len(key), np.int64), np.arange(len(key))
    with np.errstate(over="ignore"):
        while len(at):
            key = key * STEP + np.uint64(1)
            following = ((shard[at] + 1) * (2.0 ** 31 / ((key >> np.uint64(33)).astype(np.float64) + 1))).astype(np.int64)
            on = following < shards
            at, key = at[on], key[on]
            shard[at] = following[on]
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a BIGINT key."""
    if shards < 1:
        raise ValueError("at least one shard is needed")

    @pandas_udf("int")
    def run(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(np.int64).view(np.uint64), shards).astype(np.int32))

    return run(key)


def key_of(column: str) -> Column:
    """64-bit key of a stable id; a null id is a key of its own."""
    return F.xxhash64(F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("null")))


def assign_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", name: str = "shard") -> DataFrame:
    """docs with the shard of each row: a function of id and shard count alone, so nothing is shuffled.

    Equal ids share a shard, null ids too; an empty table stays empty; a
    column of that name is replaced.
    """
    kept = [c for c in docs.columns if c != name]
    return docs.select(*kept, shard_of(key_of(id_col), shards).alias(name))


def with_slots(docs: DataFrame, shards: int, id_col: str = "doc_id") -> DataFrame:
    """docs with shard, grown_shard (with one shard more) and slot, gapless from 0 in each shard.

    Slots follow the id's hash.  They are counted in pieces of (shard, hash
    range); one row per piece gives the offsets, so no task sees a whole shard.
    A piece made hot by a repeated id is cut further by the row's place in the
    stored table, in which rows of one id may come in any order.
    """
    added = ("shard", "grown_shard", "slot")
    kept = [c for c in docs.columns if c not in added]
    key = key_of(id_col)
    rows = saved(docs.select(*kept, key.alias("_key"), shard_of(key, shards).alias("shard"),
                             shard_of(key, shards + 1).alias("grown_shard"), F.monotonically_increasing_id().alias("_row")), "sharded")
    ranges = max(1, rows.count() // (shards * BUCKET_ROWS))
    rows = rows.withColumn("_range", F.floor(F.shiftrightunsigned("_key", 12) / float(1 << 52) * ranges))
    sizes = rows.groupBy("shard", "_range").agg(F.count("*").alias("_n"))
    pieces = F.ceil(F.col("_n") / (10 * BUCKET_ROWS))
    cut = rows.join(sizes, ["shard", "_range"]).withColumn("_piece", F.pmod(F.xxhash64("_row"), pieces)).drop("_n")
    before = Window.partitionBy("shard").orderBy("_range", "_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (cut.groupBy("shard", "_range", "_piece").agg(F.count("*").alias("_n"))
               .select("shard", "_range", "_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")))
    inside = Window.partitionBy("shard", "_range", "_piece").orderBy("_key", "_row")
    placed = cut.withColumn("_at", F.row_number().over(inside) - 1).join(offsets, ["shard", "_range", "_piece"])
    return placed.select(*kept, "shard", "grown_shard", (F.col("_offset") + F.col("_at")).cast("bigint").alias("slot"))
