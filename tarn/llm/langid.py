"""Language identification: every text is a mixture of languages, its words drawn from n-gram models."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tarn.llm.common import chunks_by_bytes

UNKNOWN = "und"
#: Buckets of hashed byte trigrams of a language's model.
BUCKETS = 1 << 15
CHUNK_BYTES = 1 << 20
ROUNDS = 12
#: Log-likelihood that one more language must gain, in units of half the logarithm of the number of words.
PENALTY = 4.0
#: Trigrams overlap: a word's evidence is the third part of its trigrams' sum.
OVERLAP = 3.0
#: ASCII bytes that are no letters separate words.
LETTERS = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.uint32)


def trigrams(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams around each letter byte, and the index of the first one of each word."""
    symbols = LETTERS[np.frombuffer(b" " + text + b" ", np.uint8)]
    at = np.nonzero(symbols[1:-1] != 32)[0] + 1
    code = symbols[at - 1] * np.uint32(65599) ^ symbols[at] * np.uint32(2654435761) ^ symbols[at + 1] * np.uint32(40503)
    return (code ^ (code >> np.uint32(15))) & np.uint32(BUCKETS - 1), np.nonzero(symbols[at - 1] == 32)[0]


def lowered(texts: list[str | None]) -> list[bytes]:
    return [(t or "").lower().encode("utf-8", "replace") for t in texts]


def train(docs: DataFrame, text_col: str, lang_col: str) -> tuple[list[str], np.ndarray]:
    """Languages in order and their log trigram chances, from all rows with a text and a language.

    Tasks send one count per language and bucket; the table that reaches the
    driver has BUCKETS numbers per language, however many rows there are.
    """
    def run(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(lowered(batch.column(0).to_pylist()), batch.column(1).to_pylist()):
                codes, _ = trigrams(text)
                if lang not in total:
                    total[lang] = np.zeros(BUCKETS, np.int64)
                np.add.at(total[lang], codes, 1) if len(codes) < 64 else total[lang].__iadd__(np.bincount(codes, minlength=BUCKETS))
        for lang, counts in total.items():
            used = np.nonzero(counts)[0]
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(used), pa.string()),
                                              "bucket": pa.array(used, pa.int32()), "n": pa.array(counts[used], pa.int64())})

    counted = (docs.select(text_col, lang_col).where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
               .mapInArrow(run, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    table = counted.toPandas()
    langs = sorted(set(table["lang"]))
    counts = np.full((BUCKETS, len(langs)), 0.5)
    np.add.at(counts, (table["bucket"].to_numpy(), np.searchsorted(langs, table["lang"])), table["n"].to_numpy())
    return langs, np.log(counts / counts.sum(axis=0)).astype(np.float32) if langs else counts.astype(np.float32)


def proportions(words: np.ndarray, doc: np.ndarray, allowed: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation of each document's language shares within its allowed set; shares and log-likelihood.

    words: log-likelihood of each word under each language; doc: its document,
    ascending; every document has a word.
    """
    first = np.concatenate([[0], np.nonzero(np.diff(doc))[0] + 1])
    size = np.diff(np.append(first, len(doc)))
    top = words.max(axis=1, keepdims=True)
    likely = np.exp(words - top)
    shares = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(rounds):
        joint = likely * shares[doc] + 1e-300
        shares = np.add.reduceat(joint / joint.sum(axis=1, keepdims=True), first, axis=0) / size[:, None] * allowed
        shares /= shares.sum(axis=1, keepdims=True)
    fit = np.log((likely * shares[doc]).sum(axis=1) + 1e-300) + top[:, 0]
    return shares, np.add.reduceat(fit, first)


def infer(texts: list[bytes], model: np.ndarray, penalty: float = PENALTY, rounds: int = ROUNDS) -> np.ndarray:
    """Language shares of each text (a row of zeros if it has no letter).

    The language set starts with the best single language; the next one by the
    shares of the full mixture joins while the log-likelihood gains more than
    the penalty.
    """
    n, width = len(texts), model.shape[1]
    out = np.zeros((n, width))
    evidence, owner = [], []
    for i, text in enumerate(texts):
        codes, first = trigrams(text)
        if len(codes):
            evidence.append(np.add.reduceat(model[codes].astype(np.float64), first, axis=0) / OVERLAP)
            owner.append(np.full(len(first), i))
    if not evidence or not width:
        return out
    words, owners = np.concatenate(evidence), np.concatenate(owner)
    ids, doc = np.unique(owners, return_inverse=True)
    first = np.concatenate([[0], np.nonzero(np.diff(doc))[0] + 1])
    size = np.diff(np.append(first, len(doc)))
    everything = np.ones((len(ids), width))
    full, _ = proportions(words, doc, everything, rounds)
    chosen = np.zeros_like(everything)
    chosen[np.arange(len(ids)), np.add.reduceat(words, first, axis=0).argmax(axis=1)] = 1
    shares, best = proportions(words, doc, chosen, 1)
    growing = np.arange(len(ids))
    while len(growing) and chosen[growing[0]].sum() < width:
        following = np.where(chosen[growing] > 0, -1.0, full[growing]).argmax(axis=1)
        wider = chosen[growing].copy()
        wider[np.arange(len(growing)), following] = 1
        place = np.full(len(ids), -1)
        place[growing] = np.arange(len(growing))
        part = place[doc] >= 0
        new, fit = proportions(words[part], place[doc[part]], wider, rounds)
        gains = fit - best[growing] > penalty * 0.5 * np.log(size[growing] + 1)
        kept = growing[gains]
        chosen[kept], shares[kept], best[kept] = wider[gains], new[gains], fit[gains]
        growing = kept
    out[ids] = shares
    return out


def predict(docs: DataFrame, langs: list[str], model: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
            keep: list[str] | None = None) -> DataFrame:
    """(id, lang_pred, score, languages) per row: the largest share's language, that share, and the selected set.

    Columns named in ``keep`` come along.

    A null text, a text without a letter, and any text when no language was
    learned, are "und" with score 0 and an empty set.  Whole texts are read; null ids
    and repeated rows come out as they are; an empty table gives an empty result.
    """
    keep = keep or []
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *[F.col(c).alias(f"keep_{c}") for c in keep])
    names_out = ["id", "lang_pred", "score", "languages", *rows.columns[2:]]
    shared = docs.sparkSession.sparkContext.broadcast((langs, model))  # BUCKETS numbers per language

    def run(batches):
        langs, model = shared.value
        for batch in batches:
            texts = [t if t and any(c.isalpha() for c in t) else None for t in batch.column(1).to_pylist()]
            data = lowered(texts)
            for s, e in chunks_by_bytes(data, CHUNK_BYTES):
                shares = infer(data[s:e], model)
                if not langs:
                    shares = np.zeros((e - s, 1))
                best, top = shares.argmax(axis=1), shares.max(axis=1)
                names = [langs[b] if x > 0 else UNKNOWN for b, x in zip(best, top)]
                sets = [[langs[j] for j in np.nonzero(r > 0)[0]] if langs else [] for r in shares]
                kept = [batch.column(2 + i).slice(s, e - s) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s, e - s), pa.array(names, pa.string()), pa.array(np.minimum(top, 1.0), pa.float64()),
                     pa.array(sets, pa.list_(pa.string())), *kept], names_out)

    schema = f"id {rows.schema['id'].dataType.simpleString()}, lang_pred string, score double, languages array<string>"
    schema += "".join(f", {f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[2:])
    found = rows.mapInArrow(run, schema)
    return found.select(F.col("id").alias(id_col), "lang_pred", "score", "languages", *[F.col(f"keep_{c}").alias(c) for c in keep])
