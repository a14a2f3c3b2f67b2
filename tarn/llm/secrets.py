"""Secret scan: fixed patterns, and character Markov models of random strings and of ordinary identifiers."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tarn.llm.common import byte_texts

#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
#: Maximal runs, as of [0-9a-f]+, that have the least length; shorter ones would be dropped anyway.
HEX = re.compile(rb"(?<![0-9a-f])[0-9a-f]{24,}")
ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SYMBOLS = len(ALPHABET) + 1  # 0 stands for anything else and for the start of a string
#: Upper case, lower case, digits and each sign by itself: a string of one kind is no secret.
KINDS_OF_SYMBOLS = np.array([0, *[1] * 26, *[2] * 26, *[3] * 10, 4, 5, 6, 7, 8], np.int8)
CODES = np.zeros(256, np.int64)
CODES[np.frombuffer(ALPHABET, np.uint8)] = np.arange(1, SYMBOLS)
#: A string counts as random if it is at least this long and e^10 times likelier under the model of random strings.
MIN_LENGTH = 16
MIN_RATIO = 10.0


def base_spans(text: bytes) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the secret itself) in bytes, sorted; per kind leftmost and not overlapping."""
    found = []
    if b":" in text or b"=" in text:
        found += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if b"AKIA" in text:
        found += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(found)


def pairs(codes: np.ndarray) -> np.ndarray:
    """Number of each (symbol before, symbol) in strings of the alphabet; the symbol before the first is 0."""
    before = np.concatenate([[0], codes[:-1]])
    inside = codes > 0
    return np.bincount(before[inside] * SYMBOLS + codes[inside], minlength=SYMBOLS * SYMBOLS)


def runs_of(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of the alphabet."""
    edges = np.diff((codes > 0).astype(np.int8), prepend=0, append=0)
    return np.nonzero(edges == 1)[0], np.nonzero(edges == -1)[0]


def train(docs: DataFrame, text_col: str = "text", min_length: int = MIN_LENGTH) -> np.ndarray:
    """Log-likelihood ratio of each transition, random over ordinary, from the labelled strings of all documents.

    Labels come from the fixed patterns: what they find are random strings.  All
    other runs of the alphabet below ``min_length`` are ordinary, and so are
    longer ones of one kind of symbols, such as card numbers; the other longer
    ones, which the models are to judge, have no label.  Each task sends its pair counts
    only (at most two numbers per pair of symbols), summed in Spark.
    """
    def run(batches):
        total = np.zeros((2, SYMBOLS * SYMBOLS), np.int64)
        for batch in batches:
            for text in byte_texts(batch.column(0)):
                codes = CODES[np.frombuffer(text, np.uint8)]
                for _, _, end, secret in base_spans(text):
                    total[1] += pairs(CODES[np.frombuffer(text[secret:end], np.uint8)])
                    codes[secret:end] = 0
                starts, ends = runs_of(codes)
                long = ends - starts >= min_length
                kinds = KINDS_OF_SYMBOLS[codes]
                for s, e in zip(starts[long].tolist(), ends[long].tolist()):
                    if (kinds[s:e] != kinds[s]).any():
                        codes[s:e] = 0
                total[0] += pairs(codes)
        label, pair = np.nonzero(total)
        yield pa.RecordBatch.from_pydict({"label": pa.array(label, pa.int32()), "pair": pa.array(pair, pa.int32()),
                                          "n": pa.array(total[label, pair], pa.int64())})

    counted = docs.select(text_col).mapInArrow(run, "label int, pair int, n bigint").groupBy("label", "pair").agg(F.sum("n").alias("n"))
    counts = np.zeros((2, SYMBOLS, SYMBOLS))
    for label, pair, n in counted.collect():  # 2 * SYMBOLS^2 rows at most
        counts[label].flat[pair] = n
    single = counts[:, :, 1:].sum(axis=1, keepdims=True) + 1.0
    smooth = counts[:, :, 1:] + 4.0 * single / single.sum(axis=2, keepdims=True)  # unseen transitions fall back to single symbols
    chances = np.log(smooth / smooth.sum(axis=2, keepdims=True))
    return np.pad(chances[1] - chances[0], ((0, 0), (1, 0))).ravel()


def random_spans(text: bytes, ratios: np.ndarray, taken: list[tuple[int, int, int, int]], min_length: int,
                 min_ratio: float) -> list[tuple[int, int, int, float]]:
    """(start, kind, end, log-likelihood ratio) of runs that look random and overlap no span found before."""
    codes = CODES[np.frombuffer(text, np.uint8)]
    starts, ends = runs_of(codes)
    out = []
    for s, e in zip(starts[(long := ends - starts >= min_length)].tolist(), ends[long].tolist()):
        if not any(a < e and s < b for a, _, b, _ in taken):
            run = codes[s:e]
            ratio = float(ratios[np.concatenate([[0], run[:-1]]) * SYMBOLS + run].sum())
            if ratio > min_ratio:
                out.append((s, 3, e, ratio))
    return out


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                 min_ratio: float = MIN_RATIO) -> DataFrame:
    """(id, spans) per row of docs; spans: kind, start, end in code points (end exclusive) and score.

    Spans of the fixed patterns are all kept, with a null score; the Markov models add
    spans of kind "random".  Whole texts are read; a null or empty text has no spans;
    a null id and repeated rows come out as they are; an empty table gives an
    empty result; other columns are not read.
    """
    ratios = train(docs, text_col, min_length)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def scan(text: bytes) -> list[dict]:
        base = base_spans(text)
        added = random_spans(text, ratios, base, min_length, min_ratio)
        if not base and not added:
            return []
        points = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
        found = sorted([(s, k, e, None) for s, k, e, _ in base] + added, key=lambda x: x[:3])
        return [{"kind": KINDS[k], "start": int(points[s]), "end": int(points[e]), "score": r} for s, k, e, r in found]

    def run(batches):
        for batch in batches:
            spans = pa.array([scan(t) for t in byte_texts(batch.column(1))], kind)
            yield pa.RecordBatch.from_arrays([batch.column(0), spans], ["id", "spans"])

    schema = f"id {rows.schema['id'].dataType.simpleString()}, spans array<struct<kind:string,start:int,end:int,score:double>>"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
