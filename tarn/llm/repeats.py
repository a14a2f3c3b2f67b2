"""Long substrings that occur more than once in a corpus: anchors route them to shards, suffix arrays find them.

Every string of ``length`` bytes has one anchor: the place in it at which the hash
of the next bytes is least.  Equal strings have equal anchors, so two places of
a string meet under one anchor.  Anchors that occur once cannot be in a repeated
string and are dropped; for the others the bytes of their strings go to shards,
whose suffix arrays are made by induced sorting.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from tarn.llm.common import byte_texts, saved
from tarn.llm.sais import common_prefixes, text_suffix_array

#: Text of one suffix array, and contexts of one anchor that stay in one shard.
SHARD_BYTES = 2 << 20
HOT_ANCHOR = 2000
#: Low bits of a hash that give way to its place: the longest text that is searched as a whole has 2^28 bytes.
PLACE_BITS = 28
ANCHOR = "anchor bigint, ctx bigint, t1 bigint, t2 bigint, start int, size int"
SPAN = ["t1", "t2", "first", "last"]


def widths(length: int) -> tuple[int, int]:
    """Bytes an anchor hashes, and the places among which it is the least."""
    gram = max(1, length // 4)
    return gram, length - gram + 1


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of one text in order: hash, place, and the first and last of the strings that have it.

    Ties go to the leftmost place, so the anchor depends on the string alone.
    """
    if len(data) >> PLACE_BITS:
        raise ValueError(f"a text of {len(data)} bytes is too long to search as a whole")
    gram, window = widths(length)
    n = len(data) - gram + 1
    hashes = np.zeros(n, np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    if gram >= 8:
        words = np.ndarray((len(data),), "<u8", padded, strides=(1,))
        parts = [*range(0, gram - 7, 8), gram - 8]
        for k in dict.fromkeys(parts):
            hashes = (hashes ^ words[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
    else:
        for k in range(gram):
            hashes = (hashes ^ data[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
    hashes ^= hashes >> np.uint64(32)
    hashes *= np.uint64(0xD6E8FEB86659FD93)
    hashes ^= hashes >> np.uint64(32)

    low = np.uint64((1 << PLACE_BITS) - 1)
    least, done = (hashes & ~low) | np.arange(n, dtype=np.uint64), 1
    while 2 * done <= window:
        least, done = np.minimum(least[:-done], least[done:]), 2 * done
    least = np.minimum(least[:len(least) - (window - done)], least[window - done:])
    at = (least & low).astype(np.int64)
    first = np.concatenate([[0], np.nonzero(np.diff(at))[0] + 1])
    return hashes[at[first]], at[first], first, np.append(first[1:], len(at)) - 1


def find_anchors(texts: DataFrame, length: int) -> DataFrame:
    """(anchor, ctx, t1, t2, start, size) of each anchor of each text (space, t1, t2, text); anchors of different spaces differ.

    The context, size bytes from start, is all strings of the anchor; its hash
    is seeded with the anchor's place in it.
    """
    def run(batches):
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], [], [], []]
            t1, t2 = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            for i, (space, text) in enumerate(zip(batch.column(0).to_pylist(), byte_texts(batch.column(3)))):
                if len(text) < length:
                    continue
                hashes, at, first, last = anchors(np.frombuffer(text, np.uint8), length)
                digest = xxhash.xxh3_64_intdigest
                context = [digest(text[s:e], p - s) for p, s, e in zip(at.tolist(), first.tolist(), (last + length).tolist())]
                for column, values in zip(out, (hashes ^ np.uint64(digest(space) if space else 0), np.array(context, np.uint64),
                                                np.full(len(at), t1[i]), np.full(len(at), t2[i]), first, last + length - first)):
                    column.append(values)
            if out[0]:
                kinds = (np.int64,) * 4 + (np.int32,) * 2
                cols = [pa.array(np.concatenate(c).astype(k)) for c, k in zip(out, kinds)]
                yield pa.RecordBatch.from_arrays(cols, ["anchor", "ctx", "t1", "t2", "start", "size"])

    return texts.select("space", "t1", "t2", "text").mapInArrow(run, ANCHOR)


def shard_repeats(pdf: pd.DataFrame, length: int, by_place: bool) -> pd.DataFrame:
    """Repeated strings of one shard as spans; for the pieces of a hot anchor also every string, for the comparison of pieces.

    Rows are distinct contexts (space, anchor, salted, many, t1, t2, start,
    bytes); ``many`` says that the context occurs at several places.  A string
    is repeated if its run in the suffix array is met at two places (in two
    texts unless ``by_place``) of one space.
    """
    data = b"\xff".join(pdf["bytes"])
    sizes = pdf["bytes"].map(len).to_numpy()
    begin = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    sa = text_suffix_array(data, length)
    shared = common_prefixes(data, sa, length)
    row = np.repeat(np.arange(len(pdf)), sizes + 1)[:len(data)]
    inside = np.arange(len(data)) - begin[row]
    run = np.cumsum(shared[sa] < length)
    fits = (inside + length <= sizes[row])[sa]
    at, run = sa[fits], run[fits]
    text = pd.factorize(pd.MultiIndex.from_frame(pdf[["t1", "t2"]]))[0][row[at]]
    start = pdf["start"].to_numpy()[row[at]] + inside[at]
    found = pd.DataFrame({"run": run, "space": pd.factorize(pdf["space"], use_na_sentinel=False)[0][row[at]], "row": row[at], "start": start,
                          "place": text * (1 << 32) + start if by_place else text, "many": pdf["many"].to_numpy()[row[at]]})
    groups = found.groupby(["run", "space"])
    found["hit"] = groups["many"].transform("max") | (groups["place"].transform("min") != groups["place"].transform("max"))
    salted = pdf["salted"].to_numpy()[found["row"]]
    hits = found[found["hit"]].sort_values(["row", "start"])
    apart = (np.diff(hits["row"], prepend=-1) != 0) | (np.diff(hits["start"], prepend=-length - 2) > length)
    piece = np.cumsum(apart)
    spans = hits.groupby(piece).agg(row=("row", "first"), first=("start", "min"), last=("start", "max"))
    t1, t2, spaces = pdf["t1"].to_numpy(), pdf["t2"].to_numpy(), pdf["space"].to_numpy()
    out = pd.DataFrame({"t1": t1[spans["row"]], "t2": t2[spans["row"]], "first": spans["first"].astype("int32"),
                        "last": (spans["last"] + length).astype("int32"), "hit": True, "w1": 0, "w2": 0, "place": 0})
    one = found[salted].drop_duplicates(["run", "space"])
    if len(one):
        names = [((spaces[r] or "") + "\0").encode() + data[begin[r] + s - st:begin[r] + s - st + length]
                 for r, s, st in zip(one["row"], one["start"], pdf["start"].to_numpy()[one["row"]])]
        w = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x) for x in names), np.int64).reshape(-1, 2)
        place = np.array([xxhash.xxh3_64_intdigest(f"{a}:{b}:{s if by_place else ''}") for a, b, s in
                          zip(t1[one["row"]], t2[one["row"]], one["start"])], np.uint64).view(np.int64)
        more = pd.DataFrame({"t1": t1[one["row"]], "t2": t2[one["row"]], "first": one["start"].astype("int32").to_numpy(),
                             "last": (one["start"] + length).astype("int32").to_numpy(), "hit": one["hit"].to_numpy(),
                             "w1": w[:, 0], "w2": w[:, 1], "place": place})
        out = pd.concat([out.assign(w1=0, w2=0), more])
    return out


def repeated_spans(texts: DataFrame, length: int, by_place: bool = True) -> tuple[DataFrame, DataFrame]:
    """(t1, t2, spans), and the texts (space, t1, t2, text) they are in: merged [first, last) byte spans of each text covered by strings that also occur elsewhere.

    texts: (space, id, t1, t2, text), where (t1, t2) is a 128-bit hash of space
    and text; rows with equal hashes are one text here, and callers treat texts
    that several rows share as covered altogether.  Strings count within their
    space (null is one space).  With ``by_place`` a second place in the same text counts as elsewhere.
    """
    # The joins below have stored sides only: next to an aggregate of its key adaptive execution cannot split a hot anchor.
    found = saved(find_anchors(texts, length), "found")
    place = F.xxhash64("t1", "t2", "start") if by_place else F.xxhash64("t1", "t2")
    repeated = found.groupBy("anchor").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a <> b").select("anchor")
    repeated = saved(repeated, "repeated")
    # Distinct as structs: by its columns it would need all rows of an anchor in one task and keep the join from being split.
    each = found.join(repeated, "anchor", "left_semi").select(F.struct(*found.columns).alias("row")).distinct()
    kept = saved(each.select("row.*"), "anchors")

    here = F.struct("t1", "t2", "start", "size")
    spot = here if by_place else F.struct("t1", "t2")
    contexts = saved(kept.groupBy("anchor", "ctx").agg(F.min(here).alias("at"), (F.min(spot) != F.max(spot)).alias("many")), "contexts")
    several = saved(contexts.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"), "several")
    wanted = (contexts.join(several, "anchor").select("anchor", "ctx", "many", "n", "at.*"))

    # the texts behind repeated anchors, one row each
    rows = texts.groupBy("t1", "t2").agg(F.min("id").alias("one"))
    needed = kept.select("t1", "t2").distinct().join(rows, ["t1", "t2"])
    source = (texts.alias("x").join(needed.alias("n"), (F.col("x.t1") == F.col("n.t1")) & (F.col("x.t2") == F.col("n.t2"))
                                    & F.col("x.id").eqNullSafe(F.col("n.one")))
              .select("x.space", "x.t1", "x.t2", F.col("x.text").cast("binary").alias("text")))
    source = saved(source.dropDuplicates(["t1", "t2"]), "texts")  # rows may share id and text
    cut = F.substring(F.col("text"), F.col("start") + 1, F.col("size"))
    filled = (wanted.join(source, ["t1", "t2"]).withColumn("bytes", cut)
              .withColumn("salt", F.pmod(F.xxhash64("ctx"), F.ceil(F.col("n") / HOT_ANCHOR)))
              .select("space", "anchor", "many", "t1", "t2", "start", "bytes", "salt", (F.col("n") > HOT_ANCHOR).alias("salted")))
    filled = saved(filled.dropDuplicates(["anchor", "t1", "t2", "start"]), "shards")
    total = filled.agg(F.sum(F.length("bytes"))).first()[0] or 0
    shard = F.when(F.col("salted"), F.xxhash64("anchor", "salt")).otherwise(F.pmod(F.xxhash64("anchor"), F.lit(max(1, total // SHARD_BYTES))))
    out = "t1 bigint, t2 bigint, first int, last int, hit boolean, w1 bigint, w2 bigint, place bigint"
    results = saved(filled.withColumn("shard", shard).groupBy("shard").applyInPandas(
        lambda pdf: shard_repeats(pdf, length, by_place), out), "repeats")
    strings = results.where("place <> 0")
    across = (strings.groupBy("w1", "w2").agg(F.max("hit").alias("h"), F.min("place").alias("a"), F.max("place").alias("b"))
              .where("h or a <> b"))
    spans = results.where("place = 0").select(*SPAN).union(strings.join(across, ["w1", "w2"]).select(*SPAN))
    whole = (kept.join(contexts.where("many").select("anchor", "ctx"), ["anchor", "ctx"])
             .select("t1", "t2", F.col("start").alias("first"), (F.col("start") + F.col("size")).alias("last")))
    return merged_spans(spans.union(whole)), source


def merged_spans(spans: DataFrame) -> DataFrame:
    """(t1, t2, spans): the [first, last) spans of each text in order, those that meet or overlap made one."""
    so_far = Window.partitionBy("t1", "t2").orderBy("first", "last")
    before = F.max("last").over(so_far.rowsBetween(Window.unboundedPreceding, -1))
    opened = spans.withColumn("opens", F.when(F.col("first") <= before, 0).otherwise(1))
    pieces = opened.withColumn("piece", F.sum("opens").over(so_far.rowsBetween(Window.unboundedPreceding, 0)))
    whole = pieces.groupBy("t1", "t2", "piece").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return whole.groupBy("t1", "t2").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("spans"))


def text_key(text: Column, space: Column) -> list[Column]:
    """128 bits that name a text of a space."""
    return [F.xxhash64(text, space).alias("t1"), F.xxhash64(F.lit(1), space, text).alias("t2")]


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept) per row of docs.

    A byte is removed if a string of ``length`` bytes that also starts anywhere
    else, in this text or another, covers it.  kept holds the remaining bytes,
    null where the text is unchanged.  Texts that several rows share are
    removed altogether if they have ``length`` bytes.  Texts are UTF-8 bytes,
    null is empty; shorter texts stay; null ids and repeated rows come out as
    they are (repeated rows are copies); an empty table gives an empty result;
    other columns are not read.  A text of 2^28 bytes or more is an error.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    space = F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), *text_key(text, F.lit(0)), space.alias("space"), text.alias("text"))
    digests = rows.select("id", "t1", "t2", F.octet_length("text").cast("bigint").alias("n_bytes"),
                          F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    copies = rows.groupBy("t1", "t2").agg(F.count("*").alias("copies"))
    spans, source = repeated_spans(rows, length)

    def cut(batches):
        for batch in batches:
            kept = []
            for text, spans in zip(byte_texts(batch.column(2)), batch.column(3).to_pylist()):
                at, parts = 0, []
                for s in spans:
                    parts.append(text[at:s["first"]])
                    at = s["last"]
                kept.append(b"".join([*parts, text[at:]]))
            removed = [sum(s["last"] - s["first"] for s in spans) for spans in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()),
                 pa.array([len(s) for s in batch.column(3).to_pylist()], pa.int64()), pa.array(kept, pa.binary())],
                ["t1", "t2", "removed", "spans", "kept"])

    partial = (source.join(spans, ["t1", "t2"]).select("t1", "t2", "text", "spans")
               .mapInArrow(cut, "t1 bigint, t2 bigint, removed bigint, spans bigint, kept binary"))
    partial = partial.select("t1", "t2", "removed", "spans", "kept", F.sha2("kept", 256).alias("kept_sha"))
    copied = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    return (digests.join(copies, ["t1", "t2"]).join(partial, ["t1", "t2"], "left")
            .select(F.col("id").alias(id_col), "n_bytes",
                    F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
                    F.when(copied, 1).otherwise(F.coalesce("spans", F.lit(0))).cast("bigint").alias("n_spans"),
                    F.when(copied, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
                    F.when(copied, F.lit("").cast("binary")).otherwise(F.col("kept")).alias("kept")))
