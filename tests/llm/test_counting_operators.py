"""Periodic runs, token counts and the filter audit against brute force, and their odd cases."""

from __future__ import annotations

import hashlib
import os
import random
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest

import __spark_entry__ as entry
from tarn.llm import filter_audit, periodic, token_counts

FOLDER = os.environ.get("TARN_TEST_DATA", "/root/testdata/sf0.001")
CLASHING = "doc_id long, text string, source string, n long, key string, mask int, part string, id long, runs int, words string"


def slow_runs(words: list, least: int = 12) -> list[tuple[int, int, int]]:
    """(start, length, period) by trying every period at every place."""
    names = {w: i for i, w in enumerate(dict.fromkeys(words))}
    x, found = np.array([names[w] for w in words], np.int64), {}
    for q in range(1, len(x) // 2 + 1):
        same = np.concatenate([[0], (x[:-q] == x[q:]).astype(np.int8), [0]])
        edges = np.diff(same)
        for s, e in zip(np.nonzero(edges == 1)[0].tolist(), np.nonzero(edges == -1)[0].tolist()):
            if e - s >= q:
                found.setdefault((s, e + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items() if e - s >= least)


def puzzle(dice: random.Random) -> list[bytes]:
    """Words full of repetition: few letters, broken periods, repeats of repeats, Fibonacci words."""
    size, letters, kind = dice.randint(0, 220), dice.choice([1, 2, 2, 3, 5]), dice.randrange(4)
    unit = dice.choices(range(letters), k=dice.randint(1, 30))
    if kind == 0:
        out = dice.choices(range(letters), k=size)
    elif kind == 1:
        out = [unit[i % len(unit)] for i in range(size)]
        for _ in range(dice.randint(0, 4)):
            if out:
                del out[dice.randrange(len(out))]
    elif kind == 2:
        out, unit = [], unit[:4]
        while len(out) < size:
            turn = dice.randrange(len(unit))
            out += [unit[(i + turn) % len(unit)] for i in range(dice.randint(1, 60))]
        out = out[:dice.randint(1, len(out) + 1)] * dice.randint(1, 3)
    else:
        a, out = [0], [0, 1]
        while len(out) < size:
            a, out = out, out + a
        out = out[dice.randint(0, 20):size]
    return [b"%d" % x for x in out]


def test_runs_equal_brute_force():
    dice = random.Random(7)
    for _ in range(150):
        texts = [puzzle(dice) for _ in range(dice.randint(1, 6))]
        rows, repeats = periodic.runs_of(texts)
        got = defaultdict(list)
        for i, *run in rows.tolist():
            got[i].append(tuple(run))
        at = 0
        for i, words in enumerate(texts):
            want = slow_runs(words)
            assert got[i] == want
            inside = {x for s, n, q in want for x in range(s + q, s + n)}
            assert [x in inside for x in range(len(words))] == repeats[at:at + len(words)].tolist()
            at += len(words)


def test_many_long_runs_that_meet():
    half = [b"a", b"b"] * 20000
    rows, _ = periodic.runs_of([half + half[::-1]])
    assert len(rows) == 19999 and rows[:, 3].max() == 39999 and (rows[:, 3] % 2 == 1).sum() == 19997


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_run_query_equals_brute_force(spark):
    want = []
    for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect():
        words = planted((r["text"] or "").encode().split(), r["doc_id"])
        runs = slow_runs(words)
        gone = {x for s, n, q in runs for x in range(s + q, s + n)}
        s, n, q = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        want.append((r["doc_id"], len(runs), s, n, q, n and 1000 * n // q, sha("".join("%d,%d,%d\n" % x for x in runs).encode()),
                     sha(b" ".join(w for i, w in enumerate(words) if i not in gone))))
    got = entry.queries()["op11_periodic_runs"](spark, FOLDER).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert sum(w[1] > 0 for w in want) > 10


def test_runs_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (None, "x " * 30), (4, "a"), (5, "é ü " * 7 + "end"), (6, "q " * 200000)]
    df = spark.createDataFrame([(i, t, "s", 1, "k", 1, "p", 1, 1, "w") for i, t in rows], CLASHING)
    got = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"])
           for r in periodic.periodic_runs(df, ["doc_id", "key"]).collect()]
    assert sorted(got, key=str) == sorted([
        (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 1, [], "a"), (None, 30, [(0, 30, 1)], "x"), (4, 1, [], "a"),
        (5, 15, [(0, 14, 2)], "é ü end"), (6, 200000, [(0, 200000, 1)], "q")], key=str)
    assert periodic.periodic_runs(df.limit(0), ["doc_id"]).count() == 0


@pytest.fixture(scope="module")
def vocabularies():
    return pytest.importorskip("public_tokenizers")


@pytest.mark.parametrize("file, splits", [("byte_bpe_50k.json", True), ("piece_bpe_32k.model", True), ("word_bpe_49k.json", False)])
def test_spliced_counts_equal_whole_counts(spark, vocabularies, file, splits):
    dice, alphabet = random.Random(3), "ab  \n\té'1中。<|endoftext|>.,'s "
    texts = [None, "", " ", "hi"] + ["".join(dice.choices(alphabet, k=dice.randint(1, 2500))) for _ in range(25)]
    texts += ["x" * 5000, "y" * 900 + " " + "z" * 4000, "a b" * 2000, " " * 3000 + "q" + " " * 3000,
              "<|endoftext|>" * 300 + " <|endoftext|> w" * 300, "hi"]  # no boundary for long, special tokens, a repeated row
    rows = [(i if i % 7 else None, t, "s", 1, "k", 1, "p", 1, 1, "w") for i, t in enumerate(texts)] + [(3, "hi", "s", 1, "k", 1, "p", 1, 1, "w")]
    library = (token_counts.JsonVocabulary if file.endswith("json") else token_counts.PieceVocabulary)(
        open(vocabularies.path(file), "rb").read())
    assert bool(library.splits) == splits
    want = sorted(((r[0], len((r[1] or "").encode()), n) for r, n in zip(rows, library.counts([r[1] or "" for r in rows]))), key=str)
    got = token_counts.count_tokens(spark.createDataFrame(rows, CLASHING), vocabularies.path(file), whole=200, width=100, overlap=8)
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_token_counts_of_an_empty_table(spark, vocabularies):
    empty = spark.createDataFrame([], CLASHING)
    assert token_counts.count_tokens(empty, vocabularies.path("byte_bpe_50k.json")).count() == 0
    with pytest.raises(ValueError):
        token_counts.count_tokens(empty, "some.txt")


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_token_query_counts_all_documents(spark, vocabularies):
    library = token_counts.JsonVocabulary(open(vocabularies.path("byte_bpe_50k.json"), "rb").read())
    docs = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    want = [(i, len(t.encode()), n, n > 512) for (i, t), n in zip(docs, library.counts([t for _, t in docs]))]
    assert sorted(map(tuple, entry.queries()["op12_token_counts"](spark, FOLDER).collect())) == sorted(want)


def test_audit_equals_brute_force_with_odd_rows(spark):
    dice = random.Random(11)
    texts = [None, "", "a b", "A B C D", " ".join(f"w{i}" for i in range(60)), "same " * 60, "x | y", "É" * 5, "long " * 100000]
    rows = [(i if i % 11 else None, dice.choice(texts), dice.choice(["s", None, "", "t"])) for i in range(120)]
    rows += [rows[5], rows[5], (rows[5][0], rows[5][1], "t"), (500, "only here |", "u")]
    docs = spark.createDataFrame([(i, t, s, 1, "k", 1, "p", 1, 1, "w") for i, t, s in rows], CLASHING)
    labels = [(i, int(i % 3 == 0), int(i % 5 == 0)) for i in range(1, 60)] + [(3, 0, 1), (None, 1, 1), (7, None, None)]
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    judged = []
    for i, t, s in rows:
        words = (t or "").encode().split()
        fails = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
                 "C": 100 * sum("A" <= c <= "Z" for c in t or "") > 5 * len(t or ""), "D": any(c in "#$%&*|" for c in t or ""),
                 "E": i is not None and i > first[t or ""]}
        judged.append((s or "", {f for f, x in fails.items() if x}, i in good, i in toxic))
    want = Counter()
    orders = ["".join(p) for p in permutations("ABCDE")]
    for part in {j[0] for j in judged}:
        for order in orders:
            for step, letter in enumerate(order, 1):
                for name in (*filter_audit.MEASURES, "shapley"):
                    want[part, order, step, name] += 0
                for p, fails, is_good, is_toxic in judged:
                    if p != part:
                        continue
                    before = bool(fails & set(order[:step - 1]))
                    removed = letter in fails and not before
                    for name, hit in zip(filter_audit.MEASURES, (letter not in fails and not before, removed, letter in fails and before,
                                                                 fails == {letter}, removed and is_good, removed and is_toxic)):
                        want[part, order, step, name] += hit
    total = Counter()
    for (part, order, step, name), n in want.items():
        if name == "removed":
            total[part, order[step - 1]] += n
    got = filter_audit.audit(filter_audit.marks(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))).collect()
    assert len(got) == 600 * len({j[0] for j in judged})
    for r in got:
        for name in filter_audit.MEASURES:
            assert r[name] == want[r["part"], r["filter_order"], r["step"], name], (r, name)
        assert r["shapley"] == total[r["part"], r["filter_order"][r["step"] - 1]]


def test_audit_of_an_empty_table_and_of_huge_counts(spark):
    empty = spark.createDataFrame([], CLASHING)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(filter_audit.marks(empty, labels)).count() == 0
    huge = spark.createDataFrame([("p", 0, True, True, 2 ** 61), ("p", 31, True, True, 2 ** 61), ("p", 31, True, True, 2 ** 61)],
                                 "part string, mask int, good boolean, toxic boolean, n long")
    first = filter_audit.audit(huge).where("filter_order = 'ABCDE'").orderBy("step").collect()
    assert [r["removed"] for r in first] == [2 ** 62, 0, 0, 0, 0] and [r["kept"] for r in first] == [2 ** 61] * 5
    assert first[1]["redundant"] == 2 ** 62 and first[0]["good_lost"] == 2 ** 62
