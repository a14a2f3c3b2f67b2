"""Token counts with the library of a vocabulary; huge texts in overlapping chunks, spliced where both chunks agree."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tarn.llm.common import chunks_by_bytes, saved
from tarn.util import BROADCAST_BYTES

#: Longer texts (characters) are cut; chunks start this far apart and overlap by this much at first.
WHOLE = 1 << 16
WIDTH = 1 << 15
OVERLAP = 1 << 9
BATCH_BYTES = 1 << 20
#: Stretches between the stable boundaries of byte-level vocabularies: white space and the word behind it.
WORD_WITH_SPACE = re.compile(r"\s*\S+(?:[^\S \t\n\r]\s*\S*)*|\s+")
#: Counts of words a task keeps at least, and at most twice as many.
REMEMBERED = 300_000


class JsonVocabulary:
    """A vocabulary for the ``tokenizers`` library."""

    spaces = " \t\n\r"

    def __init__(self, content: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_str(content.decode())
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.loads(content)
        before = spec.get("pre_tokenizer") or {}
        added = spec.get("added_tokens") or []
        #: The word pattern of byte-level vocabularies never has white space after another character inside one match
        #: and looks ahead only from white space; without a normalizer, and with added tokens free of white space, a
        #: place between another character and white space is a boundary on which neither side depends.
        self.splits = (before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
                       and not spec.get("normalizer") and not any(t["lstrip"] or t["rstrip"] or any(c.isspace() for c in t["content"])
                                                                  for t in added))

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens per text; where words can be told apart, each distinct one is encoded once and remembered for a while."""
        if not self.splits:
            return [len(e) for e in self.library.encode_batch(texts, add_special_tokens=False)]
        words = [WORD_WITH_SPACE.findall(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        new = {w for ws in words for w in ws if w not in self.known}
        self.known.update((w, self.older[w]) for w in new if w in self.older)
        new = [w for w in new if w not in self.known]
        for start in range(0, len(new), 1000):
            some = new[start:start + 1000]
            self.known.update(zip(some, map(len, self.library.encode_batch(some, add_special_tokens=False))))
        return [sum(map(self.known.__getitem__, ws)) for ws in words]

    def offsets(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        found = np.array(self.library.encode(text, add_special_tokens=False).offsets, np.int64).reshape(-1, 2)
        return found[:, 0], found[:, 1]


class PieceVocabulary:
    """A model for the ``sentencepiece`` library."""

    spaces = " "

    def __init__(self, content: bytes):
        from sentencepiece import SentencePieceProcessor
        self.library = SentencePieceProcessor(model_proto=content)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        #: Pieces are merged only into pieces of the vocabulary; if none has a space after another character, no merge
        #: crosses such a place.
        self.splits = not any("▁" in p.lstrip("▁") for p in pieces)

    def counts(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.library.encode(texts, num_threads=1)]

    def offsets(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        pieces = self.library.encode(text, return_type="proto").pieces
        leads = (np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80  # the library counts bytes, not characters
        places = np.concatenate([[0], np.cumsum(leads)])
        return places[[p.begin for p in pieces]], places[[p.end for p in pieces]]


@cache
def _loaded(kind: str, content: bytes):
    return JsonVocabulary(content) if kind == "json" else PieceVocabulary(content)


def splice(text: str, spaces: str, starts: np.ndarray, ends: np.ndarray, low: int, high: int) -> tuple[int, int] | None:
    """(place, tokens before it) of the first stable boundary with low < place < high, or None.

    Stable: another character before it, white space at it, one token ends there
    and the next does not begin before.
    """
    for place in range(low + 1, min(high, len(text))):
        if text[place] in spaces and not text[place - 1].isspace():
            token = int(np.searchsorted(starts, place))
            if 0 < token and ends[token - 1] == place:
                return place, token
    return None


def _column(rows: list, kind: pa.DataType) -> pa.Array:
    return pa.array(rows, kind)


def _first_pass(kind: str, content: bytes, whole: int):
    """Texts of up to ``whole`` characters with their counts; longer ones as they are, with a key of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _loaded(kind, content)
        key = TaskContext.get().partitionId() << 33
        for batch in batches:
            ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            sizes = [t.encode() for t in texts]
            for start, end in chunks_by_bytes(sizes, BATCH_BYTES):
                long = [len(t) > whole and vocabulary.splits for t in texts[start:end]]
                counted = iter(vocabulary.counts([t for t, cut in zip(texts[start:end], long) if not cut]))
                numbers = [None if cut else next(counted) for cut in long]
                yield pa.RecordBatch.from_arrays([
                    ids.slice(start, end - start), _column([len(b) for b in sizes[start:end]], pa.int64()),
                    _column(numbers, pa.int64()), _column([t if cut else None for t, cut in zip(texts[start:end], long)], pa.string()),
                    _column(range(key, key + end - start), pa.int64())], ["id", "n_bytes", "n_tokens", "text", "key"])
                key += end - start

    return run


def _cut(width: int, overlap: int):
    """Chunks of ``width`` characters, each followed by the beginning of the next one; the last one takes the remainder too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                last = max(1, len(text) // width) - 1
                for piece in range(last + 1):
                    at = piece * width
                    yield pa.RecordBatch.from_pydict({
                        "key": _column([key], pa.int64()), "piece": _column([piece], pa.int64()), "last": _column([piece == last], pa.bool_()),
                        "text": _column([text[at:] if piece == last else text[at:at + width + overlap]], pa.string())})

    return run


def _between_splices(kind: str, content: bytes, width: int, overlap: int):
    """Tokens of each chunk between its splice with the chunk before and that with the next; a missing splice is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _loaded(kind, content)
        for batch in batches:
            out = []
            for key, piece, last, text in zip(*(c.to_pylist() for c in batch.columns)):
                starts, ends = vocabulary.offsets(text)
                left = splice(text, vocabulary.spaces, starts, ends, 0, overlap) if piece else (0, 0)
                right = (len(text), len(starts)) if last else splice(text, vocabulary.spaces, starts, ends, width, width + overlap)
                out.append((key, piece, last, left and left[0] + piece * width, right and right[0] + piece * width,
                            right[1] - left[1] if left and right else None))
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([_column(c, t) for c, t in zip(zip(*out), kinds)],
                                             ["key", "piece", "last", "left_at", "right_at", "n"])

    return run


def _aligned(chunks: DataFrame) -> DataFrame:
    """(key, n_tokens) of all cut texts; n_tokens is null where two chunks do not meet at one place.

    A junction is named by the chunk that follows it; both chunks give its place.
    """
    left = F.when(F.col("piece") > 0, F.struct(F.col("piece").alias("junction"), F.col("left_at").alias("place")))
    right = F.when(~F.col("last"), F.struct((F.col("piece") + 1).alias("junction"), F.col("right_at").alias("place")))
    sides = chunks.select("key", F.explode(F.array_compact(F.array(left, right))).alias("side")).select("key", "side.*")
    met = sides.groupBy("key", "junction").agg((F.count("place") == 2).alias("both"), (F.min("place") == F.max("place")).alias("same"))
    apart = met.where("NOT coalesce(both AND same, false)").groupBy("key").agg(F.lit(True).alias("apart"))
    total = chunks.groupBy("key").agg(F.sum("n").alias("n"))
    return total.join(apart, "key", "left").select("key", F.when(F.col("apart").isNull(), F.col("n")).alias("n_tokens"))


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", whole: int = WHOLE,
                 width: int = WIDTH, overlap: int = OVERLAP) -> DataFrame:
    """(id, n_bytes, n_tokens) of every text, as the vocabulary's own library counts the whole text.

    ``vocabulary`` is a file: ``.json`` for tokenizers, ``.model`` for
    sentencepiece.  It is read once and sent along (64 MB at most), so
    executors need no such file.  No begin, end or other special token is
    added, nothing is truncated or padded.

    Texts of over ``whole`` characters are cut into chunks that overlap, spread
    over the cluster, and spliced in each overlap at the first boundary that
    both sides must have and that neither side's tokens depend on.  A text
    where two chunks do not meet is cut again with eight times the overlap,
    until they do or one chunk holds all.  Vocabularies for which no such
    boundary is proven count every text in one piece.

    A null text is empty and has no token; null and repeated ids keep their
    rows; an empty table gives an empty result; other columns are not read.
    """
    kind = vocabulary.rsplit(".", 1)[-1]
    if kind not in ("json", "model"):
        raise ValueError(f"no library for {vocabulary}")
    with open(vocabulary, "rb") as file:
        content = file.read()
    if len(content) > BROADCAST_BYTES:
        raise ValueError(f"a vocabulary of {len(content)} bytes is too large to send to every task")
    kind_of_id = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {kind_of_id}, n_bytes bigint, n_tokens bigint, text string, key bigint"
    first = saved(rows.mapInArrow(_first_pass(kind, content, whole), schema), "token-counts")
    out = first.where("n_tokens IS NOT NULL").select(F.col("id").alias(id_col), "n_bytes", "n_tokens")
    long = todo = first.where("n_tokens IS NULL")
    parts = []
    while not todo.isEmpty():
        chunks = todo.select("key", "text").mapInArrow(_cut(width, overlap), "key bigint, piece bigint, last boolean, text string")
        chunks = chunks.repartition("key", "piece").mapInArrow(
            _between_splices(kind, content, width, overlap),
            "key bigint, piece bigint, last boolean, left_at bigint, right_at bigint, n bigint")
        done = saved(_aligned(saved(chunks, "token-chunks")), "token-splices")
        parts.append(done.where("n_tokens IS NOT NULL"))
        todo = todo.join(done.where("n_tokens IS NULL"), "key", "left_semi")
        overlap *= 8
        width = max(width, overlap)
    for part in parts:
        out = out.unionByName(long.select("key", F.col("id").alias(id_col), "n_bytes").join(part, "key").drop("key"))
    return out
