"""Suffix structures against slow ones, texts with very many spans, and texts too long to search."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tarn.llm import repeats, sais


def test_common_prefixes_equal_a_walk():
    dice = random.Random(1)
    for _ in range(300):
        letters, n = dice.choice([1, 2, 3, 26]), dice.randint(1, 120)
        data = bytes(dice.choices(range(97, 97 + letters), k=n))
        if dice.random() < 0.4:
            data = (data[:20] * 8)[:n]
        for depth in (None, 5):
            sa, most = sais.text_suffix_array(data, depth), dice.choice([1, 3, 9, 40])
            want = [0] * n
            for a, b in zip(sa[:-1].tolist(), sa[1:].tolist()):
                while want[b] < most and a + want[b] < n and b + want[b] < n and data[a + want[b]] == data[b + want[b]]:
                    want[b] += 1
            assert sais.common_prefixes(data, sa, most).tolist() == want


def test_a_long_text_with_very_many_spans(spark):
    """Ten thousand words of a dictionary, each between bytes of its own: as many spans in one text."""
    dice = random.Random(4)
    unique = iter(range(10 ** 9))
    word = lambda: "".join(dice.choices("abcdefghijklmnopqrstuvwxyz", k=70))
    words = [word() for _ in range(5000)]
    text = "".join(f"<{next(unique):09d}>{w}" for w in words + words)
    got = repeats.without_repeats(spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string"), length=60).collect()
    long = next(r for r in got if r["doc_id"] == 1)
    gone = np.zeros(len(text), bool)
    seen: dict[str, int] = {}
    for i in range(len(text) - 59):
        j = seen.setdefault(text[i:i + 60], i)
        if j != i:
            gone[i:i + 60] = gone[j:j + 60] = True
    assert long["n_spans"] == int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()) == 10000
    assert long["n_removed"] == int(gone.sum())


def test_merged_spans(spark):
    rows = [(1, 1, 0, 5), (1, 1, 5, 9), (1, 1, 20, 22), (1, 1, 1, 3), (1, 1, 10, 12), (1, 2, 4, 6), (1, 1, 11, 15), (1, 1, 20, 22)]
    got = {(r["t1"], r["t2"]): [tuple(s) for s in r["spans"]]
           for r in repeats.merged_spans(spark.createDataFrame(rows, "t1 long, t2 long, first int, last int")).collect()}
    assert got == {(1, 1): [(0, 9), (10, 15), (20, 22)], (1, 2): [(4, 6)]}


def test_texts_beyond_the_limit_are_refused(monkeypatch):
    monkeypatch.setattr(repeats, "PLACE_BITS", 10)
    with pytest.raises(ValueError, match="too long"):
        repeats.anchors(np.zeros(1024, np.uint8), 60)
