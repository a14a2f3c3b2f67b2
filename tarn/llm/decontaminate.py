"""Benchmark decontamination: n-gram seeds join passages to test items, Smith-Waterman alignment scores them."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tarn.llm.common import saved

WORDS = re.compile(r"[^\W_]+")
#: Words of a seed; an item with fewer is one seed as a whole.
SEED_WORDS = 3
#: Bits of the filter that tasks hold: fixed, so that a larger benchmark only makes it less selective.
FILTER_BITS = 1 << 22
MATCH, MISMATCH, GAP = 2, -1, -1
MIN_SCORE = 0.5


def words_of(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


def grams(words: list[str], width: int) -> np.ndarray:
    """Hash of each run of ``width`` words; of all words if there are fewer, none without words."""
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    each = np.fromiter(map(digest, words), np.uint64, len(words))
    width = min(width, len(words))
    out = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        out = (out ^ each[i:len(words) - width + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(FILTER_BITS - 1)
    return (hashes & mask).astype(np.int64), (hashes >> np.uint64(40) & mask).astype(np.int64)


def filter_of(hashes: DataFrame) -> np.ndarray:
    """Bytes that are 1 where a hash of the table may be: at most FILTER_BITS positions reach the driver."""
    def run(batches):
        hit = np.zeros(FILTER_BITS, bool)
        for batch in batches:
            for at in places(batch.column(0).to_numpy().view(np.uint64)):
                hit[at] = True
        yield pa.RecordBatch.from_pydict({"bit": pa.array(np.nonzero(hit)[0], pa.int32())})

    bits = hashes.select("gram").mapInArrow(run, "bit int").distinct().toPandas()["bit"].to_numpy(np.int64)
    out = np.zeros(FILTER_BITS, bool)
    out[bits] = True
    return out


def seeds_of(items: DataFrame) -> DataFrame:
    """(gram, item_id): every n-gram of each item.

    None is left out for being frequent: in an edited copy the frequent ones may be all that is intact.
    """
    def run(batches):
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = np.unique(grams(words_of(text), SEED_WORDS))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view(np.int64)), pa.array([item] * len(found), batch.schema.field(0).type)], ["gram", "item_id"])

    return items.mapInArrow(run, f"gram bigint, item_id {items.schema['item_id'].dataType.simpleString()}").distinct()


def passages(docs: DataFrame, maybe: np.ndarray, widths: list[int], reach: int) -> DataFrame:
    """(id, key, start, words, grams): stretches of text around possible seeds, ``reach`` words to both sides."""
    shared = docs.sparkSession.sparkContext.broadcast(maybe)

    def run(batches):
        maybe = shared.value
        for batch in batches:
            ids, keys, starts, texts, hits = [], [], [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                at, found = [], []
                for width in widths:
                    if len(words) >= width:
                        all_grams = grams(words, width)
                        a, b = places(all_grams)
                        near = np.nonzero(maybe[a] & maybe[b])[0]
                        at.append(near), found.append(all_grams[near])
                if not at or not sum(map(len, at)):
                    continue
                at, found = np.concatenate(at), np.concatenate(found)
                order = np.argsort(at, kind="stable")
                at, found = at[order], found[order]
                cuts = np.nonzero(np.diff(at) > 2 * reach)[0] + 1
                for part, grams_in in zip(np.split(at, cuts), np.split(found, cuts)):
                    start, end = max(0, int(part[0]) - reach), int(part[-1]) + reach + SEED_WORDS
                    passage = " ".join(words[start:end])
                    ids.append(doc), starts.append(start), texts.append(passage)
                    keys.append(xxhash.xxh3_128_hexdigest(passage.encode("utf-8", "replace")))
                    hits.append(np.unique(grams_in).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch.schema.field(0).type), pa.array(keys, pa.string()), pa.array(starts, pa.int32()),
                 pa.array(texts, pa.string()), pa.array(hits, pa.list_(pa.int64()))], ["id", "key", "start", "words", "grams"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").mapInArrow(run, f"id {kind}, key string, start int, words string, grams array<bigint>")


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best local alignment score of two word sequences and the passage word at which it ends.

    A row of the matrix is one vector: the gap along the row is a running maximum.
    """
    across = np.arange(len(passage) + 1) * -GAP
    above, best, end = np.zeros(len(passage) + 1, np.int64), 0, 0
    for word in item:
        row = np.zeros_like(above)
        row[1:] = np.maximum(above[:-1] + np.where(passage == word, MATCH, MISMATCH), above[1:] + GAP)
        row = np.maximum.accumulate(np.maximum(row, 0) + across) - across
        if row.max() > best:
            best, end = int(row.max()), int(row.argmax())
        above = row
    return best, end


def alignment(item: list[str], passage: list[str]) -> tuple[float, int, int]:
    """Score as a share of a full match of the item, and the aligned words of the passage (end exclusive)."""
    names = {w: i for i, w in enumerate(dict.fromkeys(item))}
    a = np.array([names[w] for w in item], np.int64)
    b = np.array([names.get(w, -1) for w in passage], np.int64)
    best, end = align(a, b)
    _, length = align(a[::-1], b[:end][::-1])
    return best / (MATCH * len(item)) if item else 0.0, end - length, end


def can_reach(item: list[str], passage: list[str], min_score: float) -> bool:
    """Whether the words that the two share, each matched in full, would give ``min_score``: a bound that loses nothing."""
    return sum((Counter(item) & Counter(passage)).values()) >= min_score * len(item)


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """(id, item_id, score, start_word, end_word): texts that hold a test item, exact, edited or in part.

    A text is compared with an item if they share a seed; the local alignment
    must reach ``min_score`` of the item's full score.  Words are runs of
    letters and digits in lower case.  Equal passages are aligned once.  A null
    or empty text or item matches nothing; items with equal texts each give a
    row; repeated documents each give theirs; null ids come out as null; an empty table on either side
    gives an empty result; other columns are not read.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    tests = saved(items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
                  .where("text is not null and item_id is not null"), "items")
    sizes = tests.select(F.size(F.regexp_extract_all(F.lower("text"), F.lit(r"(?U)[^\W_]+"), F.lit(0))).alias("n"))
    reach = sizes.agg(F.max("n")).first()[0] or 0
    widths = sorted({min(SEED_WORDS, w) for (w,) in sizes.where(F.col("n") < SEED_WORDS).distinct().collect() if w} | {SEED_WORDS})
    seeds = saved(seeds_of(tests), "seeds")
    found = saved(passages(texts, filter_of(seeds), widths, reach), "passages")
    distinct = found.groupBy("key").agg(F.first("words").alias("words"), F.first("grams").alias("grams"))
    distinct = saved(distinct, "distinct-passages")
    wanted = (distinct.select("key", F.explode("grams").alias("gram")).join(seeds, "gram").select("key", "item_id").distinct())
    pairs = wanted.join(distinct.select("key", "words"), "key").join(tests, "item_id").select("key", "item_id", "words", "text")

    def run(frames):
        for pdf in frames:
            both = [(words_of(t), w.split(" ")) for t, w in zip(pdf["text"], pdf["words"])]
            near = np.array([can_reach(*x, min_score) for x in both], bool)
            got = [alignment(*x) for x, maybe in zip(both, near) if maybe]
            out = pd.DataFrame(got, columns=["score", "first", "last"])
            out.insert(0, "key", pdf["key"].to_numpy()[near])
            out.insert(1, "item_id", pdf["item_id"].to_numpy()[near])
            yield out[out["score"] >= min_score]

    kind = tests.schema["item_id"].dataType.simpleString()
    scored = pairs.repartition("key", "item_id").mapInPandas(run, f"key string, item_id {kind}, score double, first int, last int")
    return (found.select("id", "key", "start").join(scored, "key")
            .groupBy("id", "start", "item_id").agg(F.max(F.struct("score", "first", "last")).alias("b"), F.count("*").alias("times"))
            .select(F.col("id").alias(id_col), F.col("item_id").alias(item_col), F.col("b.score").alias("score"),
                    (F.col("start") + F.col("b.first")).alias("start_word"), (F.col("start") + F.col("b.last")).alias("end_word")))


def without_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **settings) -> DataFrame:
    """docs without the texts that hold a test item; rows with a null id stay."""
    hits = contaminated(docs, items, id_col, **settings).select(F.col(id_col).alias("_hit")).distinct()
    return docs.join(hits, F.col(id_col) == F.col("_hit"), "left_anti")
