"""Hidden Markov language model: Baum-Welch counts from all partitions, exact likelihood by the scaled forward recursion.

States emit classes of words and a class emits its words by their smoothed
share: P(text) = HMM(classes) * product of P(word | class).  A word with enough
of the training tokens is a class of its own, so the classes grow with the
corpus, up to 1/OWN_SHARE of them; the other words share classes by their
last letters.  Every word of any vocabulary has a proper probability.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tarn.llm.common import byte_texts, saved

STATES = 8
#: A word with this share of the training tokens, and this often, is a class of its own: 1/OWN_SHARE classes at most.
OWN_SHARE = 1e-5
OWN_COUNT = 5
#: Classes of the other words, by a hash of their last bytes.  Class 0 is the end of a text.
ENDINGS = 2048
ENDING_BYTES = 3
#: Text of one block of documents, which share a list of words, and of the pieces it is stored and sent in, a row each;
#: a longer document makes a larger piece by itself.
BLOCK_BYTES = 8 << 20
PIECE_BYTES = 2 << 20
#: Pieces of a stored file: a file's columns are read into memory whole.
FILE_PIECES = 8
#: Blocks a task that looks up counts has on average.
TASK_BLOCKS = 3
#: Counts of words that a task gathers before it sends them, in a row per block.
GATHERED = 1 << 18
#: Words that are counted or scored at once, about; texts scored and sequences trained on are not cut further.
TRAINED_WORDS, SCORED_WORDS = 1 << 19, 1 << 20
#: Training cuts longer texts into sequences of this many words; scoring takes them whole.
SEQUENCE = 256
#: The likelihood has settled when a Baum-Welch round raises it by less than this share.
SETTLED = 5e-4
SMOOTH = 0.01


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # CLASSES rows, a column per state


@dataclass
class Classes:
    """Which class a word is in: words with a class of their own by hash, in order, and classes by ending for the rest."""

    own: np.ndarray  # hashes of at most 1/OWN_SHARE words

    @property
    def number(self) -> int:
        return 1 + ENDINGS + len(self.own)

    def of(self, hashes: np.ndarray, endings: np.ndarray) -> np.ndarray:
        out = endings.astype(np.int32) + 1
        if len(self.own):
            at = np.minimum(np.searchsorted(self.own, hashes), len(self.own) - 1)
            hit = self.own[at] == hashes
            out[hit] = at[hit] + 1 + ENDINGS
        return out


def pack(docs: DataFrame) -> DataFrame:
    """Documents (id, held, text) in blocks of a few rows, the pieces: ids, word numbers and words new to the block as hashes.

    Words are numbered in the order a block meets them, so its pieces behind
    each other list its distinct words; ``first`` is the number of a piece's
    first new one.  Words are named by a 64-bit hash: among a billion distinct
    words a clash of two is unlikely.  Blocks and pieces are bounded by their
    bytes, not by their documents' keys.
    """
    def blocks(batches):
        place, count, id_type = TaskContext.get().partitionId() << 32, 0, None
        pieces, known, block_size = [], {}, 0
        ids, held, lengths, numbers, size = [], [], [], [], 0

        def rows():
            names = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in known), np.uint64, len(known))
            endings = np.fromiter((xxhash.xxh3_64_intdigest(w[-ENDING_BYTES:]) % ENDINGS for w in known), np.int16, len(known))
            seen, first = np.zeros(len(known), np.int32), 0
            for _, out, lengths, index, upto in pieces:
                learn = np.repeat(~np.array(out, bool), np.array(lengths, np.int64))
                seen[:upto] += np.bincount(index[learn], minlength=upto).astype(np.int32)
            for piece, (ids, out, lengths, index, upto) in enumerate(pieces):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([place + count], pa.int64()), pa.array([piece], pa.int32()), pa.array([first], pa.int32()),
                     pa.array([ids], pa.list_(id_type)), pa.array([out], pa.list_(pa.bool_())), pa.array([lengths], pa.list_(pa.int32())),
                     pa.array([packed(index)], pa.binary()),
                     *[pa.array([x[first:upto].tobytes()], pa.binary()) for x in (names, seen, endings)]],
                    ["block", "piece", "first", "ids", "held", "lengths", "words", "hashes", "seen", "endings"])
                first = upto

        for batch in batches:
            id_type = batch.schema.field(0).type
            for part in (batch.slice(s, 512) for s in range(0, batch.num_rows, 512)):
                for doc, out, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), byte_texts(part.column(2))):
                    words = text.lower().split()
                    for w in words:
                        if w not in known:
                            known[w] = len(known)
                    ids.append(doc), held.append(out), lengths.append(len(words))
                    numbers.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
                    size, block_size = size + len(text), block_size + len(text)
                    if size >= PIECE_BYTES or block_size >= BLOCK_BYTES:
                        pieces.append((ids, held, lengths, np.concatenate(numbers), len(known)))
                        ids, held, lengths, numbers, size = [], [], [], [], 0
                    if block_size >= BLOCK_BYTES:
                        yield from rows()
                        count += 1
                        pieces, known, block_size = [], {}, 0
        if ids:
            pieces.append((ids, held, lengths, np.concatenate(numbers), len(known)))
        if pieces:
            yield from rows()

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "held", "text").mapInArrow(
        blocks, f"block bigint, piece int, first int, ids array<{kind}>, held array<boolean>, lengths array<int>, words binary, "
                "hashes binary, seen binary, endings binary")


def numbers_of(batch: pa.RecordBatch | pa.Table, name: str, i: int, kind: type) -> np.ndarray:
    """Numbers of one row, stored as bytes."""
    return np.frombuffer(batch.column(name)[i].as_py(), kind)


def packed(numbers: np.ndarray) -> bytes:
    """A number per word, compressed, as rows of them are shuffled and held in memory."""
    return pa.compress(numbers.astype(np.int32).tobytes(), "zstd", asbytes=True)


def unpacked(batch: pa.RecordBatch | pa.Table, name: str, i: int) -> np.ndarray:
    """A number for each word of one row's texts."""
    size = 4 * int(listed(batch, "lengths", i, np.int64).sum())
    return np.frombuffer(pa.decompress(batch.column(name)[i].as_py(), size, "zstd", asbytes=True), np.int32)


def listed(batch: pa.RecordBatch | pa.Table, name: str, i: int, kind: type) -> np.ndarray:
    """Numbers of one row, stored as a list without nulls."""
    return batch.column(name)[i].values.to_numpy(zero_copy_only=False).astype(kind)


@dataclass
class Ragged:
    """Class sequences, longest first, laid out time step by time step."""

    steps: np.ndarray  # the classes
    begin: np.ndarray  # first place of each time step, and the total
    order: np.ndarray  # the sequences, longest first


def with_ends(classes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts behind each other with the end class after each."""
    return np.insert(classes, np.cumsum(lengths), 0), lengths + 1


def cut(lengths: np.ndarray, most: int) -> np.ndarray:
    """Lengths of the pieces of texts that are cut every ``most`` words."""
    pieces = -(-lengths // most)
    out = np.full(int(pieces.sum()), most, np.int64)
    out[np.cumsum(pieces) - 1] = lengths - (pieces - 1) * most
    return out


def portions(lengths: np.ndarray, most: int):
    """Ranges of texts behind each other of about ``most`` words, with the places of their words; a longer text stands alone."""
    upto, s = np.concatenate([[0], np.cumsum(lengths)]), 0
    while s < len(lengths):
        e = max(s + 1, int(np.searchsorted(upto, upto[s] + most, side="right")) - 1)
        yield slice(s, e), slice(int(upto[s]), int(upto[e]))
        s = e


def ragged(classes: np.ndarray, lengths: np.ndarray) -> Ragged:
    order = np.argsort(-lengths, kind="stable")
    first = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    full = lengths[order]
    counts = len(full) - np.searchsorted(np.sort(full), np.arange(full[0] if len(full) else 0), side="right")
    begin = np.concatenate([[0], np.cumsum(counts)])
    steps = np.zeros(int(begin[-1]), np.int32)
    rank = np.repeat(np.arange(len(order)), full)
    time = np.arange(int(full.sum())) - np.repeat(np.concatenate([[0], np.cumsum(full)])[:-1], full)
    steps[begin[time] + rank] = classes[np.repeat(first[order], full) + time]
    return Ragged(steps, begin, order)


def log_likelihood(model: Model, seqs: Ragged) -> np.ndarray:
    """Exact log10 probability of each class sequence, in the original order: the scaled forward recursion."""
    n = len(seqs.order)
    total = np.zeros(n)
    state = np.broadcast_to(model.start, (n, len(model.start)))
    for t in range(len(seqs.begin) - 1):
        s, e = seqs.begin[t], seqs.begin[t + 1]
        state = (state[: e - s] @ model.move if t else state) * model.emit[seqs.steps[s:e]]
        scale = state.sum(axis=1)
        total[: e - s] += np.log10(scale)
        state = state / scale[:, None]
    out = np.empty(n)
    out[seqs.order] = total
    return out


def expected_counts(model: Model, seqs: Ragged) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Baum-Welch counts: states at the start, moves, and emissions of each class; and the log10 likelihood."""
    k, begin = len(model.start), seqs.begin
    move, emit = model.move.astype(np.float32), model.emit.astype(np.float32)
    ahead = np.empty((len(seqs.steps), k), np.float32)
    scales = np.empty(len(seqs.steps), np.float32)
    state = None
    for t in range(len(begin) - 1):
        s, e = begin[t], begin[t + 1]
        state = (model.start.astype(np.float32) if t == 0 else state[: e - s] @ move) * emit[seqs.steps[s:e]]
        scale = state.sum(axis=1)
        state = state / scale[:, None]
        ahead[s:e], scales[s:e] = state, scale
    moves = np.zeros((k, k))
    back = np.ones((0, k), np.float32)
    for t in range(len(begin) - 2, -1, -1):
        s, e = begin[t], begin[t + 1]
        full = np.ones((e - s, k), np.float32)
        if len(back):
            weighted = emit[seqs.steps[e:begin[t + 2]]] * back / scales[e:begin[t + 2], None]
            moves += ahead[s:s + len(back)].T @ weighted
            full[: len(back)] = weighted @ move.T
        back = full
        ahead[s:e] *= full  # now the share of each state at this place
    emits = np.stack([np.bincount(seqs.steps, ahead[:, j], len(emit)) for j in range(k)], axis=1)
    first = ahead[: begin[1]].sum(axis=0, dtype=np.float64) if len(seqs.order) else np.zeros(k)
    return first, moves * model.move, emits, float(np.log10(scales).sum(dtype=np.float64))


def starting_model(classes: int, states: int, seed: int = 7) -> Model:
    """Sticky states, each with random preferences for classes."""
    random = np.random.default_rng(seed)
    emit = np.exp(random.normal(0, 1, (classes, states)))
    move = np.full((states, states), 0.1 / max(1, states - 1)) + np.eye(states) * (0.9 - 0.1 / max(1, states - 1))
    return Model(np.full(states, 1 / states), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def maximised(start: np.ndarray, moves: np.ndarray, emits: np.ndarray) -> Model:
    """Smoothed shares of the counts."""
    emits = emits + SMOOTH + emits.sum(axis=1, keepdims=True) * 1e-4
    return Model((start + SMOOTH) / (start + SMOOTH).sum(), (moves + SMOOTH) / (moves + SMOOTH).sum(axis=1, keepdims=True),
                 emits / emits.sum(axis=0))


def gathered(sequences: DataFrame, classes: Classes, model: Model) -> tuple[Model, float]:
    """One Baum-Welch round and the likelihood before it.

    Every task sums its pieces' counts and sends a row per class it has seen, and
    one per state, with a number per state; Spark adds them up.  The model has
    at most 1/OWN_SHARE + ENDINGS + 1 classes, whatever the corpus.
    """
    k, number = len(model.start), classes.number
    shared = sequences.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        total = np.zeros((number + k + 2, k))  # classes, moves, start, likelihood
        for batch in batches:
            for i in range(batch.num_rows):
                learn, lengths = ~listed(batch, "held", i, bool), listed(batch, "lengths", i, np.int64)
                kinds = unpacked(batch, "kinds", i)[np.repeat(learn, lengths)]
                kinds, lengths = with_ends(kinds, lengths[learn])
                lengths = cut(lengths, SEQUENCE)
                for part, at in portions(lengths, TRAINED_WORDS):
                    start, moves, emits, likely = expected_counts(model, ragged(kinds[at], lengths[part]))
                    total[:number] += emits
                    total[number:number + k] += moves
                    total[number + k] += start
                    total[number + k + 1, 0] += likely
        used = np.nonzero(total.any(axis=1))[0]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), *[pa.array(total[used, j]) for j in range(k)]],
                                         ["place", *[f"n{j}" for j in range(k)]])

    sums = [f"n{j}" for j in range(k)]
    rows = (sequences.select("held", "lengths", "kinds")
            .mapInArrow(run, "place int, " + ", ".join(f"{n} double" for n in sums))
            .groupBy("place").agg(*[F.sum(n).alias(n) for n in sums]).toPandas())
    shared.destroy()
    total = np.zeros((number + k + 2, k))
    total[rows["place"].to_numpy(np.int64)] = rows[sums].to_numpy()
    return maximised(total[number + k], total[number:number + k], total[:number]), float(total[number + k + 1, 0])


def train(sequences: DataFrame, classes: Classes, states: int = STATES) -> Model:
    """Baum-Welch from a random start: every round counts all training documents, until the likelihood settles."""
    model, before = starting_model(classes.number, states), -np.inf
    while True:
        model, likelihood = gathered(sequences, classes, model)
        if likelihood - before <= SETTLED * abs(likelihood):
            return model
        before = likelihood


def word_counts(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(word, block, at) of every distinct word of every block, and (word, c, ending) of the words in training texts."""
    def words(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                names, seen, endings = (numbers_of(batch, c, i, t) for c, t in (
                    ("hashes", np.int64), ("seen", np.int32), ("endings", np.int16)))
                block, first = batch.column("block")[i].as_py(), batch.column("first")[i].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names), pa.array(np.full(len(names), block)),
                     pa.array(np.arange(first, first + len(names), dtype=np.int32)), pa.array(seen), pa.array(endings)],
                    ["word", "block", "at", "seen", "ending"])

    entries = blocks.select("block", "first", "hashes", "seen", "endings").mapInArrow(
        words, "word bigint, block bigint, at int, seen int, ending smallint")
    counts = entries.where("seen > 0").groupBy("word").agg(F.sum("seen").alias("c"), F.first("ending").alias("ending"))
    return entries.select("word", "block", "at"), saved(counts, "word-counts")


def by_block(words: DataFrame, classes: Classes) -> DataFrame:
    """Rows (block, at, c, word, ending) as a row per task and block, or a few, with places, counts and classes."""
    def run(batches):
        kept, n = [], 0

        def rows():
            block, at, c, word, ending = (np.concatenate([k[j] for k in kept]) for j in range(5))
            order = np.argsort(block, kind="stable")
            block, at, c, kind = block[order], at[order], c[order], classes.of(word.view(np.uint64), ending)[order]
            starts = np.concatenate([[0], np.nonzero(np.diff(block))[0] + 1])
            ends = [*starts[1:], len(block)]
            return pa.RecordBatch.from_arrays(
                [pa.array(block[starts]), *[pa.array([x[s:e].tobytes() for s, e in zip(starts, ends)], pa.binary()) for x in (at, c, kind)]],
                ["block", "at", "c", "kind"])

        for batch in batches:
            if batch.num_rows:
                kept.append([batch.column(j).to_numpy() for j in range(5)])
                n += batch.num_rows
            if n >= GATHERED:
                yield rows()
                kept, n = [], 0
        if n:
            yield rows()

    return words.select("block", "at", "c", "word", "ending").mapInArrow(run, "block bigint, at binary, c binary, kind binary")


def own_classes(counts: DataFrame, total: int) -> Classes:
    """At most 1/OWN_SHARE words reach the driver."""
    often = counts.where((F.col("c") >= OWN_COUNT) & (F.col("c") >= OWN_SHARE * total)).select("word").toPandas()["word"]
    return Classes(np.sort(often.to_numpy(np.int64).view(np.uint64)))


def score(docs: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text", states: int = STATES) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of docs, log10 throughout.

    Learns from the rows for which ``held`` is false.  Tokens are the words,
    lower-cased in A-Z, and one end.  base_score is the smoothed unigram; score
    the model's probability of the whole text.  Word counts are joined as (word,
    block) rows: each block of documents sends each of its words once, and is
    then stored as the classes of its words, which training and scoring read.
    A null text is empty; null ids and repeated rows come out as they are;
    without training rows all words are equally unknown; an empty table gives an
    empty result; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(held, F.lit(False)).alias("held"), F.col(text_col).alias("text"))
    blocks = saved(pack(rows), "blocks", FILE_PIECES)
    entries, counts = word_counts(blocks)
    distinct = blocks.select(F.explode("held").alias("held")).agg(F.sum(F.when(~F.col("held"), 1).otherwise(0)).alias("n"))
    texts = distinct.first()["n"] or 0  # every training text has one end
    summed = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    total, vocabulary = (summed["n"] or 0) + texts, summed["v"] + (texts > 0)
    base_total = total + 0.5 * (vocabulary + 1)
    classes = own_classes(counts, total)
    # Tokens and words of the shared classes; a class of its own has one word.
    shared_words = counts.where((F.col("c") < OWN_COUNT) | (F.col("c") < OWN_SHARE * total))
    tables = shared_words.groupBy("ending").agg(F.sum("c").alias("n"), F.count("*").alias("v")).toPandas()
    n_class, v_class = np.zeros(1 + ENDINGS), np.zeros(1 + ENDINGS)
    n_class[tables["ending"] + 1], v_class[tables["ending"] + 1] = tables["n"], tables["v"]

    def classed(left: pa.Table, right: pa.Table) -> pa.Table:
        """Pieces of one block with the classes of their words, and the parts of the scores that need the counts."""
        order = np.argsort(left.column("piece").to_numpy())
        kinds = np.concatenate([numbers_of(left, "endings", i, np.int16) for i in order]).astype(np.int32) + 1
        count = np.zeros(len(kinds), np.int64)
        for i in range(right.num_rows):
            at = numbers_of(right, "at", i, np.int32)
            count[at], kinds[at] = numbers_of(right, "c", i, np.int64), numbers_of(right, "kind", i, np.int32)
        base = np.log10((count + 0.5) / base_total)
        ending = np.minimum(kinds, ENDINGS)
        inner = np.where(kinds > ENDINGS, 0.0, np.log10((count + 0.5) / (n_class + 0.5 * (v_class + 1))[ending]))
        out = []
        for i in order:
            words, lengths = unpacked(left, "words", i), listed(left, "lengths", i, np.int64)
            sums = np.concatenate([[0], np.cumsum(lengths)])

            def per_text(values):
                each = values[words]
                return [each[s:e].sum() for s, e in zip(sums[:-1], sums[1:])]

            out.append(pa.Table.from_arrays(
                [*[left.column(c).slice(i, 1) for c in ("ids", "held", "lengths")], pa.array([per_text((count > 0).astype(np.int64))]),
                 pa.array([per_text(base)]), pa.array([per_text(inner)]), pa.array([packed(kinds[words])], pa.binary())],
                ["ids", "held", "lengths", "known", "base", "inner", "kinds"]))
        return pa.concat_tables(out)

    id_type = rows.schema["id"].dataType
    # Both sides are dealt to a number of tasks that follows the blocks, so a task's share does not grow with the corpus.
    tasks = -(-blocks.where("piece = 0").count() // TASK_BLOCKS) or 1
    looked_up = by_block(entries.join(counts, "word"), classes)
    both = (blocks.drop("first", "hashes", "seen").repartition(tasks, "block").groupBy("block")
            .cogroup(looked_up.repartition(tasks, "block").groupBy("block")))
    sequences = saved(both.applyInArrow(
        classed, f"ids array<{id_type.simpleString()}>, held array<boolean>, lengths array<int>, known array<bigint>, "
                 "base array<double>, inner array<double>, kinds binary"), "sequences", FILE_PIECES)
    model = train(sequences, classes, states)

    def scored(batches):
        for batch in batches:
            words = np.array([int(listed(batch, "lengths", i, np.int64).sum()) for i in range(batch.num_rows)], np.int64)
            for part, _ in portions(words, SCORED_WORDS):
                some = batch.slice(part.start, part.stop - part.start)
                flat = lambda name: pa.concat_arrays([some.column(name)[i].values for i in range(some.num_rows)])  # noqa: E731, B023
                lengths = flat("lengths").to_numpy().astype(np.int64)
                kinds = np.concatenate([unpacked(some, "kinds", i) for i in range(some.num_rows)])
                likely = log_likelihood(model, ragged(*with_ends(kinds, lengths)))
                yield pa.RecordBatch.from_arrays(
                    [flat("ids"), flat("held"), pa.array(lengths + 1), pa.array(flat("known").to_numpy() + (texts > 0)),
                     pa.array(np.full(len(lengths), total, np.int64)),
                     pa.array(flat("base").to_numpy() + np.log10((texts + 0.5) / base_total)), pa.array(likely + flat("inner").to_numpy())],
                    ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = (f"id {id_type.simpleString()}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
              "base_score double, score double")
    return sequences.mapInArrow(scored, schema).withColumnRenamed("id", id_col)
