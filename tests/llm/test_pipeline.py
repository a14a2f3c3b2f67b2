"""Stages of the corpus pipeline against brute force, with null and repeated ids, empty tables and clashing columns."""

from __future__ import annotations

import random
from collections import Counter

import pytest

import corpus_pipeline as cp
from tarn.llm import decontaminate
from test_operators import prose, slow_fingerprint

DDL = "doc_id long, text string, lang string, source string, n_chars long, _row long, key string, size int, copies int, shard int, slot int"


def table(spark, rows):
    """documents with columns called like those the stages add."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 1, "k", 2, 3, 4, 5) for i, t, s in rows], DDL)


def rows_of(df):
    return Counter((r["doc_id"], r["text"]) for r in df.collect())


@pytest.fixture(scope="module")
def corpus():
    dice = random.Random(6)
    base = [prose(i, 120) for i in range(12)]
    near = [" ".join(w if dice.random() > 0.01 else "edited" for w in t.split()) for t in base[:6]]
    texts = base + near + base[:4] + [base[0]] * 3 + [None, "", ""]
    return [(None if i % 5 == 0 else i % 9, t, f"s{i % 3}") for i, t in enumerate(texts)]


def test_one_row_of_each_group_stays(spark, corpus):
    prints = [slow_fingerprint(t, 4) for _, t, _ in corpus]
    group = list(range(len(corpus)))
    for _ in corpus:
        group = [min(g for g, p in zip(group, prints) if bin(p ^ q).count("1") <= 4) for q in prints]
    got = rows_of(cp.near_duplicates(spark, table(spark, corpus), ""))
    members = {g: [(d, t) for (d, t, _), h in zip(corpus, group) if h == g] for g in set(group)}
    assert sum(got.values()) == len(members) < len(corpus)
    assert all(sum(got[m] > 0 for m in set(ms)) >= 1 for ms in members.values())


def test_rows_with_test_items_go_with_or_without_an_id(spark, corpus, tmp_path):
    items = [(1, " ".join(corpus[2][1].split()[30:55])), (2, "never seen anywhere in these rows at all"), (3, None), (None, "the of and")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    bad = {t for _, t, _ in corpus for i, item in items if t and item and i is not None
           and decontaminate.alignment(decontaminate.words_of(item), decontaminate.words_of(t))[0] >= 0.5}
    assert 0 < len(bad) < len(corpus)
    got = rows_of(cp.decontamination(spark, table(spark, corpus), str(tmp_path)))
    assert got == Counter((d, t) for d, t, _ in corpus if t not in bad)


def test_language_rejects_rows_without_a_letter(spark, corpus):
    rows = corpus + [(50, "12 34 !!", "s1")]
    got = cp.language(spark, table(spark, rows), "")
    assert got.columns == cp.COLUMNS
    assert rows_of(got) == Counter((d, t) for d, t, _ in rows if t and any(c.isalpha() for c in t))


def test_mix_and_shards_keep_columns_and_rows(spark, corpus):
    mixed = cp.mix(spark, table(spark, corpus), "")
    assert mixed.columns == cp.COLUMNS and set(rows_of(mixed)) <= {(d, t) for d, t, _ in corpus}
    placed = cp.shards(spark, table(spark, corpus), "")
    assert rows_of(placed) == Counter((d, t) for d, t, _ in corpus) and placed.where("shard NOT BETWEEN 0 AND 39").count() == 0


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for _, stage in cp.STAGES:
        assert stage(spark, table(spark, [(1, "x", "s")]).limit(0), str(tmp_path)).count() == 0
