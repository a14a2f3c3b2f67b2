"""Runs of periodic repetition in word sequences, found with string synchronising sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tarn.llm.common import byte_texts, chunks_by_bytes

BATCH_BYTES = 1 << 20
#: Runs shorter than this are not reported.
MIN_LENGTH = 12
_NEVER = np.uint64(2 ** 64 - 1)
_STEPS = 16


def _mix(x: np.ndarray) -> np.ndarray:
    """A hash of 64-bit numbers (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of True."""
    edges = np.diff(same.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    return np.nonzero(edges == 1)[0], np.nonzero(edges == -1)[0]


class RunFinder:
    """All runs of several word sequences, which lie behind each other in ``words``, the longest sequence first.

    A run is a maximal stretch with smallest period q and a length of 2q at
    least.  ``found`` has a row (start, end, period) per run.

    At scale t (2, 4, 8 ...) a hash of every t words picks places: a place is in
    the synchronising set if the least hash of the t + 1 windows from it on is
    that of the first or the last of them, windows of period t/3 or less left
    out.  Equal contexts of 2t words thus have both or neither of their places
    in the set, and every run of period q, 3t - 1 <= q <= 6t - 2, has a picked
    place whose context comes again q words later, unless one period of the run
    is itself of a period of t/3 or less.  Pairs of equal contexts at such a
    distance propose q.  The omitted runs lie where two runs of one small period
    meet or overlap; these are known from smaller scales and propose the rest.
    Periods below 5 are compared directly.
    """

    def __init__(self, words: np.ndarray, sizes: np.ndarray):
        self.words = words
        self.bounds = np.concatenate([[0], np.cumsum(sizes)])
        self.sizes = sizes
        self.doc = np.repeat(np.arange(len(sizes)), sizes)
        self.end = self.bounds[1:][self.doc] if len(sizes) else np.zeros(0, np.int64)
        self.found = np.zeros((0, 3), np.int64)
        for q in range(1, 5):
            self._add(*self._direct(q, 0, len(words)), q)
        longest = int(sizes[0]) if len(sizes) else 0
        names = _mix(words.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        names = self._doubled(names, 1)
        scale = 2
        while 2 * (3 * scale - 1) <= longest:
            # Shorter sequences have no run of such a period.
            upto = int(self.bounds[np.searchsorted(-sizes, -2 * (3 * scale - 1), side="right")])
            twice = self._doubled(names, scale)
            self._scale(names[:upto], twice, scale, upto)
            names, scale = twice, 2 * scale

    @staticmethod
    def _doubled(names: np.ndarray, width: int) -> np.ndarray:
        """Hashes of stretches of twice the width; those at the very end, which reach beyond it, are of no use."""
        out = _mix(names * np.uint64(0x9E3779B97F4A7C15))
        out[:len(out) - width] += names[width:]
        return _mix(out)

    def _add(self, starts: np.ndarray, ends: np.ndarray, q) -> None:
        """Keep runs; of several periods of one stretch the smallest counts."""
        if len(starts):
            rows = np.concatenate([self.found, np.stack([starts, ends, np.broadcast_to(q, len(starts))], axis=1)])
            rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
            new = np.ones(len(rows), bool)
            new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
            self.found = rows[new]

    def _direct(self, q: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Runs of period q inside words[low:high], by comparing all words q apart."""
        if high - low <= q:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        same = (self.words[low:high - q] == self.words[low + q:high]) & (self.doc[low:high - q] == self.doc[low + q:high])
        starts, ends = _stretches(same)
        long = ends - starts >= q
        return starts[long] + low, ends[long] + low + q

    def _synchronising(self, names: np.ndarray, scale: int, upto: int) -> np.ndarray:
        values = names.copy()
        start, end, q = self.found.T
        periodic = (q <= scale // 3) & (end - start >= scale) & (end <= upto)
        if periodic.any():
            marks = np.zeros(upto + 1, np.int64)
            np.add.at(marks, start[periodic], 1)
            np.add.at(marks, end[periodic] - scale + 1, -1)
            values[np.cumsum(marks[:-1]) > 0] = _NEVER
        least, width = values, 1
        while width < scale:
            shorter = least.copy()
            np.minimum(least[:-width], least[width:], out=shorter[:-width])
            least, width = shorter, 2 * width
        last = values[scale:]
        least = np.minimum(least[:-scale], last)
        picked = (least != _NEVER) & ((least == values[:-scale]) | (least == last))
        places = np.nonzero(picked)[0]
        return places[places + 2 * scale <= self.end[places]]

    def _scale(self, names: np.ndarray, twice: np.ndarray, scale: int, upto: int) -> None:
        low, high = 3 * scale - 1, 6 * scale - 2
        self._extend(*self._meeting(low, high, scale).T, known=True)
        proposed = [np.zeros((0, 3), np.int64)]
        places = self._synchronising(names, scale, upto)
        context = twice[places] ^ _mix(self.doc[places].astype(np.uint64))
        order = np.argsort(context, kind="stable")
        places, context = places[order], context[order]
        # Equal contexts are over scale/3 apart, so few of them are near enough to a place.
        for k in range(1, len(places)):
            apart = places[k:] - places[:-k]
            near = (context[k:] == context[:-k]) & (apart <= high)
            if not near.any():
                break
            near &= apart >= low
            proposed.append(np.stack([apart[near], places[:-k][near], places[:-k][near] + 2 * scale], axis=1))
        rows = np.concatenate(proposed)
        if not len(rows):
            return
        # Proposals of one period whose contexts touch belong to one run.
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
        q, left, right = rows.T
        head = np.ones(len(rows), bool)
        head[1:] = (q[1:] != q[:-1]) | (left[1:] > right[:-1])
        first = np.nonzero(head)[0]
        self._extend(q[first], left[first], np.maximum.reduceat(right, first))

    def _meeting(self, low: int, high: int, scale: int) -> np.ndarray:
        """(period, left, right) for two runs of one small period that meet or overlap: words[left:right] come again a period later."""
        rows = self.found[(self.found[:, 2] <= scale // 3) & (self.found[:, 1] - self.found[:, 0] >= low - scale)]
        rows = rows[np.lexsort((rows[:, 0], rows[:, 2]))]
        out = []
        if len(rows) > 1:
            s1, e1, p = rows[:-1].T
            s2, e2, p2 = rows[1:].T
            room = np.minimum(s2 - s1, e2 - e1) + p  # an overlap is shorter than p
            near = (p == p2) & (s2 <= e1) & (self.doc[s1] == self.doc[s2]) & (room >= low)
            for i in np.nonzero(near)[0].tolist():
                turn = self._rotation(int(s1[i]), int(s2[i]), int(p[i]))
                if turn is not None:
                    first = int(s2[i] - s1[i]) - turn
                    step = int(p[i])
                    periods = np.arange(low + (first - low) % step, min(high, int(room[i])) + 1, step)
                    left = np.maximum(s2[i] - periods, s1[i])
                    out.append(np.stack([periods, left, np.maximum(left, np.minimum(e1[i], e2[i] - periods))], axis=1))
        return np.concatenate(out) if out else np.zeros((0, 3), np.int64)

    def _rotation(self, a: int, b: int, p: int) -> int | None:
        """r with words[a + r : ...] = words[b : b + p], both within periodic runs; None if their periods differ."""
        twice, one = np.tile(self.words[a:a + p], 2).tobytes(), self.words[b:b + p].tobytes()
        width = self.words.itemsize
        at = twice.find(one)
        while at >= 0 and at % width:
            at = twice.find(one, at + 1)
        return None if at < 0 else at // width % p

    def _extend(self, q: np.ndarray, left: np.ndarray, right: np.ndarray, known: bool = False) -> None:
        """Extend stretches words[left:right] = words[left + q:right + q] as far as they go and keep the runs.

        Equal hashes make a stretch likely, so its words are compared unless it is known to be one.
        """
        start_of, end_of = self.bounds[self.doc[left]], self.end[left]
        fits = right + q <= end_of
        q, left, right, start_of, end_of = (x[fits] for x in (q, left, right, start_of, end_of))
        right = self._slide(right.copy(), q, end_of - q, 1)
        left = self._slide(left - 1, q, start_of - 1, -1) + 1
        run = right - left >= q
        q, left, right = q[run], left[run], right[run]
        exact = np.fromiter((known or np.array_equal(self.words[a:b], self.words[a + n:b + n])
                             for a, b, n in zip(left.tolist(), right.tolist(), q.tolist())), bool, len(q))
        self._add(left[exact], (right + q)[exact], q[exact])
        for i in np.nonzero(~exact)[0].tolist():  # two contexts with one hash
            self._add(*self._direct(int(q[i]), int(start_of[run][i]), int(end_of[run][i])), int(q[i]))

    def _slide(self, at: np.ndarray, q: np.ndarray, limit: np.ndarray, step: int) -> np.ndarray:
        """Places moved by ``step`` while the words q apart are equal, up to the limit."""
        words = self.words
        moving = np.arange(len(at))
        for _ in range(_STEPS):
            moving = moving[at[moving] != limit[moving]]
            moving = moving[words[at[moving]] == words[at[moving] + q[moving]]]
            at[moving] += step
        for i in moving.tolist():
            x, n, end, block = int(at[i]), int(q[i]), int(limit[i]), 64
            while x != end:
                size = min(block, abs(end - x))
                a, b = (x, x + size) if step > 0 else (x - size + 1, x + 1)
                differ = (words[a:b] != words[a + n:b + n])[::step]
                stop = int(differ.argmax())
                if differ[stop]:
                    x += step * stop
                    break
                x += step * size
                block *= 2
            at[i] = x
        return at


def runs_of(texts: list[list[bytes]], min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(number of the text, start, length, period) of all runs by text and start, and for all words whether they repeat.

    A word repeats if a run contains it after the run's first period.  Words of
    all texts lie behind each other.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(-sizes, kind="stable")
    flat = pa.array([w for i in order.tolist() for w in texts[i]], pa.binary())
    words = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int32)
    finder = RunFinder(words, sizes[order])
    start, end, q = finder.found[(finder.found[:, 1] - finder.found[:, 0]) >= min_length].T
    place = finder.doc[start] if len(start) else start
    text = order[place]
    offset = (np.cumsum(sizes) - sizes)[text]
    own = start - finder.bounds[place]
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, offset + own + q, 1)
    np.add.at(marks, offset + own + end - start, -1)
    rows = np.stack([text, own, end - start, q], axis=1)
    return rows[np.lexsort((q, own, text))], np.cumsum(marks[:-1]) > 0


def periodic_runs(docs: DataFrame, keep: list[str], text_col: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """The kept columns, ``n_words``, ``runs`` (start, length, period in words, in order) and the ``collapsed`` text.

    Words are ``[^\\x20\\x09-\\x0D]+``.  A run is a stretch of consecutive words
    with smallest period q and a length of 2q and ``min_length`` at least that no
    neighbouring word extends keeping period q.  The collapsed text joins, by one
    space, the words that no run contains after its first q words.

    All runs are found, whatever their period and however long the text; a
    text is handled in one piece (about 100 bytes of memory a word).  A null
    text is empty: no word, no run, an empty collapsed text.  Null and repeated
    ids keep their rows, an empty table gives an empty result, other columns
    are not read; kept columns must not be called like the added ones.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_texts(batch.column(len(keep)))
            for low, high in chunks_by_bytes(texts, BATCH_BYTES):
                words = [t.split() for t in texts[low:high]]
                rows, repeats = runs_of(words, min_length)
                ends = np.cumsum([len(w) for w in words]) if words else np.zeros(0, np.int64)
                collapsed = []
                for ws, end in zip(words, ends.tolist()):
                    gone = repeats[end - len(ws):end]
                    collapsed.append(b" ".join([w for w, g in zip(ws, gone.tolist()) if not g] if gone.any() else ws))
                offsets = np.searchsorted(rows[:, 0], np.arange(len(words) + 1)).astype(np.int32)
                runs = pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in (1, 2, 3)], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(low, high - low) for i in range(len(keep))]
                    + [pa.array([len(w) for w in words], pa.int64()), pa.ListArray.from_arrays(offsets, runs),
                       pa.array(collapsed, pa.binary()).cast(pa.string(), safe=False)], [*keep, "n_words", "runs", "collapsed"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, F.col(text_col).alias("_text")).mapInArrow(
        run, f"{kinds}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
