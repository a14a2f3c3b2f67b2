"""How text filters interact: every order of the filters audited in one pass, with wide packed counters."""

from __future__ import annotations

from functools import cache
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tarn.llm.common import saved

LETTERS = "ABCDE"
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
#: A counter holds any BIGINT number of documents, so no sum runs over into the next field.
FIELD_BYTES = 8


def failures(text: Column) -> Column:
    """Bits of the filters A to D a text fails; filter E needs the other texts (see ``marks``).

    A (1): under 50 words; B (2): under 65 distinct words in 100; C (4): over 5
    capitals A-Z in 100 characters; D (8): any of ``#$%&*|``.
    """
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    few = F.transform(F.array(words), lambda ws: F.when(F.size(ws) < 50, 1).otherwise(0)
                      + F.when(100 * F.size(F.array_distinct(ws)).cast("bigint") < 65 * F.size(ws).cast("bigint"), 2).otherwise(0))[0]
    length = F.char_length(text).cast("bigint")
    capitals = length - F.char_length(F.regexp_replace(text, "[A-Z]+", ""))
    return (few + F.when(100 * capitals > 5 * length, 4).otherwise(0) + F.when(text.rlike("[#$%&*|]"), 8).otherwise(0)).cast("int")


def marks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(part, mask, good, toxic, n): the number of documents per source, failed filters and labels.

    Bit 16 of the mask is filter E: the text is that of a document with a
    smaller id; texts are compared by SHA-256.  A null text is empty, a null
    source is the part ``''``, a null id is neither smaller nor larger than
    another and has no label.  A label counts if any row of its document says so.

    Rows are counted per (text, id, part) before anything is joined, so a text
    that fills a third of the table is spread by its ids; joined sides are stored,
    which lets the skew join split an id with very many texts.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(source_col), F.lit("")).alias("part"),
                       F.unhex(F.sha2(text.cast("binary"), 256)).alias("key"), failures(text).alias("mask"))
    per = saved(rows.groupBy("key", "id", "part").agg(F.first("mask").alias("mask"), F.count("*").alias("n")), "audit-rows")
    first = per.groupBy("key").agg(F.min("id").alias("id")).where("id IS NOT NULL").withColumn("is_first", F.lit(True))
    first = saved(first, "audit-first")
    label = labels.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    label = saved(label.where("id IS NOT NULL AND (good OR toxic)"), "audit-labels")
    copy = F.col("id").isNotNull() & F.col("is_first").isNull()
    return (per.join(first, ["key", "id"], "left").join(label, "id", "left")
            .groupBy("part", (F.col("mask") + F.when(copy, 16).otherwise(0)).alias("mask"),
                     F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
            .agg(F.sum("n").alias("n")))


def steps(letters: str) -> list[tuple[str, int, int, int]]:
    """(order, step, bit of the step's filter, bits of the filters before it) of all orders."""
    bit = {letter: 1 << i for i, letter in enumerate(letters)}
    return [("".join(order), i + 1, bit[letter], sum(bit[x] for x in order[:i]))
            for order in permutations(letters) for i, letter in enumerate(order)]


@cache
def packed(letters: str, mask: int, good: bool, toxic: bool) -> int:
    """One document as a big integer: a field per measure, order and step, 1 where the document counts there."""
    _, _, bit, before = zip(*steps(letters))
    bit, before = np.array(bit), np.array(before)
    fails, earlier = (mask & bit) != 0, (mask & before) != 0
    removed = fails & ~earlier
    fields = np.concatenate([~fails & ~earlier, removed, fails & earlier, bit == mask, removed & good, removed & toxic])
    return int.from_bytes(fields.astype(f"<u{FIELD_BYTES}").tobytes(), "little")


def audit(marked: DataFrame, letters: str = LETTERS) -> DataFrame:
    """(part, filter_order, step, measures, shapley) for every part, order of the filters and step.

    ``marked`` counts documents by part, mask of failed filters (the first
    letter is bit 1), good and toxic.  A mask is one integer with a field for
    every outcome, so a part is audited by adding at most 4 * 2^filters
    integers, each times its number of documents, and unpacking the sum.  An
    empty table gives an empty result.
    """
    order, step, bit, _ = (list(x) for x in zip(*steps(letters)))
    size = len(order)

    def per_part(rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(packed(letters, mask, good, toxic) * n
                    for mask, good, toxic, n in zip(rows["mask"].tolist(), rows["good"].tolist(), rows["toxic"].tolist(), rows["n"].tolist()))
        fields = np.frombuffer(total.to_bytes(len(MEASURES) * size * FIELD_BYTES, "little"), f"<u{FIELD_BYTES}").astype(np.int64)
        out = pd.DataFrame({"part": rows["part"].iloc[0], "filter_order": order, "step": step,
                            **dict(zip(MEASURES, fields.reshape(len(MEASURES), size)))})
        out["shapley"] = out.groupby(np.array(bit))["removed"].transform("sum")
        return out

    counts = ", ".join(f"{m} bigint" for m in (*MEASURES, "shapley"))
    # One row per mask: a part never has more rows than masks, however many rows of marked share one.
    few = marked.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
    return few.groupBy("part").applyInPandas(per_part, f"part string, filter_order string, step int, {counts}")
