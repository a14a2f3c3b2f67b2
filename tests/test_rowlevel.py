from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tarn.operators import deletes as dl, lineage as ln, merge as mg, skipping as sk, stats as st
from tarn.operators.sinks import overwrite_by_filter


def plain_merge(target, source, matched, inserted):
    """Reference result for the clauses used below, by loops."""
    out = []
    keys = {t[0] for t in target}
    by_key = {}
    for s in source:
        by_key.setdefault(s[0], []).append(s)
    for t in target:
        hits = by_key.get(t[0], []) if t[0] is not None else []
        if len(hits) > 1:
            raise ValueError
        out += [t] if not hits else matched(t, hits[0])
    for s in source:
        if s[0] is None or s[0] not in keys:
            out += inserted(s)
    return sorted(out, key=str)


def test_merge_against_loops(spark):
    rng = random.Random(3)
    target = [(rng.choice([None, *range(20)]), rng.randrange(100), rng.choice(["a", "b", None])) for _ in range(60)]
    source = [(k, rng.randrange(100), rng.choice(["a", "b", None])) for k in rng.sample(range(40), 25)] + [(None, 1, "a"), (None, 2, "b")]
    ddl = "k int, n int, f string"

    def matched(t, s):
        if s[2] == "a":
            return []
        if s[1] > t[1]:
            return [(t[0], t[1] + s[1], t[2])]
        return [t]

    clauses = [mg.Clause("delete", F.col("s.f") == "a"), mg.Clause("update", F.col("s.n") > F.col("t.n"), {"n": F.col("t.n") + F.col("s.n")})]
    insert = [mg.Clause("insert", F.col("s.f") == "b"), mg.Clause("insert", F.col("s.n") > 50, {"k": F.col("s.k"), "f": F.lit("big")})]
    inserted = lambda s: [s] if s[2] == "b" else [(s[0], None, "big")] if s[1] > 50 else []
    got = mg.merge(spark.createDataFrame(target, ddl), spark.createDataFrame(source, ddl), ["k"], clauses, insert)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_merge(target, source, matched, inserted)


def test_merge_cardinality(spark):
    target = spark.createDataFrame([(1, "t"), (2, "t")], "k int, v string")
    source = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z"), (3, "z")], "k int, v string")
    with pytest.raises(Exception, match="several source rows"):
        mg.merge(target, source, ["k"], [mg.Clause("update")]).collect()
    # Without matched clauses the duplicates do no harm and all new rows are inserted.
    assert mg.merge(target, source, ["k"], not_matched=[mg.Clause("insert")]).count() == 4


def test_merge_on_differing_names_and_a_condition(spark):
    rng = random.Random(4)
    target = [(rng.choice([None, *range(8)]), rng.randrange(10), "t") for _ in range(50)] + [(1, 5, "t")] * 2
    halves = [(k, *half) for k in [None, *range(12)] for half in [(0, 4, "low"), (5, 9, "high")]]
    source = rng.sample(halves, 16) + [(1, 90, 99, "none"), (1, 90, 99, "none")]

    def meets(t, s):
        return t[0] is not None and t[0] == s[0] and s[1] <= t[1] <= s[2]

    want = [(t[0], t[1], next((s[3] for s in source if meets(t, s)), "gone")) for t in target]
    want += [(s[0], s[1], "new") for s in source if not any(meets(t, s) for t in target)]
    args = dict(on=[("k", "id")], matched=[mg.Clause("update", None, {"v": F.col("s.w")})],
                not_matched=[mg.Clause("insert", None, {"k": F.col("s.id"), "n": F.col("s.low"), "v": F.lit("new")})],
                not_matched_by_source=[mg.Clause("update", None, {"v": F.lit("gone")})],
                condition=(F.col("t.n") >= F.col("s.low")) & (F.col("t.n") <= F.col("s.high")))
    t = spark.createDataFrame(target, "k int, n int, v string")
    s = spark.createDataFrame(source, "id int, low int, high int, w string")
    got = sorted((tuple(r) for r in mg.merge(t, s, **args).collect()), key=str)
    assert got == sorted(want, key=str)
    twice = s.union(spark.createDataFrame([(1, 0, 9, "more")] * 2, s.schema))
    with pytest.raises(Exception, match="several source rows"):
        mg.merge(t, twice, **args).collect()
    assert mg.merge(t, twice, [("k", "id")], not_matched_by_source=[mg.Clause("delete")], condition=args["condition"]).count() == \
        sum(t[0] == 1 or any(meets(t, s) for s in source) for t in target)
    with pytest.raises(ValueError, match="key"):
        mg.merge(t, s, [], condition=args["condition"])


def test_listed_files_prune_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(200).select("id", (F.col("id") % 20).cast("int").alias("file")).write.partitionBy("file").parquet(path)
    stored = spark.read.parquet(path)
    listed = spark.createDataFrame([(3,), (5,), (9,)], "file int")
    for got in (ln.rows_of_files(stored, listed, "file"), mg.only_touched(stored, listed, "file")):
        assert sorted(r["id"] for r in got.collect()) == [i for i in range(200) if i % 20 in (3, 5, 9)]
        plan = got._jdf.queryExecution().toString()
        scan = next(line for line in plan.split("== Physical Plan ==")[-1].splitlines() if "PartitionFilters" in line)
        assert "dynamicpruning" in scan and ">= 3" in scan
    assert ln.rows_of_files(stored, listed.where("false"), "file").count() == 0


def test_files_listed_by_folder_prune_the_scan(spark, tmp_path):
    """Many files to a folder: folders without a listed file are not read, other files of a folder give no rows."""
    path = str(tmp_path / "t")
    spark.range(200).select("id", F.col("id") % 20 % 7, (F.col("id") % 20).alias("file")).toDF("id", "commit", "file").write.partitionBy("commit").parquet(path)
    stored = spark.read.parquet(path)
    listed = spark.createDataFrame([(3, 3, "a"), (10, 3, "b"), (11, 4, "c"), (11, 4, "d")], "file bigint, commit int, kind string")
    got = ln.rows_of_files(stored, listed, "file", "commit")
    assert sorted(map(tuple, got.select("id", "file", "kind").collect())) == sorted(
        (i, f, k) for i in range(200) for f, _, k in listed.collect() if i % 20 == f)
    scan = next(line for line in got._jdf.queryExecution().toString().split("== Physical Plan ==")[-1].splitlines() if "PartitionFilters" in line)
    assert "dynamicpruning" in scan and "commit" in scan and ">= 3" in scan
    only = ln.rows_of_files(stored, listed.select("file", "commit").distinct(), "file", "commit")
    assert only.columns == ["file", "id"] and only.count() == 30
    assert ln.rows_of_files(stored, listed.where("false"), "file", "commit").count() == 0


def test_delete_keeps_unknown(spark, rows):
    df = spark.createDataFrame([(1,), (5,), (None,)], "v int")
    assert rows(mg.delete_where(df, F.col("v") > 3)) == [(None,), (1,)]
    with pytest.raises(ValueError):
        mg.delete_where(df, F.lit(True), "other")


def test_update_sees_old_row(spark, rows):
    df = spark.createDataFrame([(1, 2), (3, 4)], "a int, b int")
    assert rows(mg.update_where(df, F.col("a") == 1, {"a": F.col("b"), "b": F.col("a")})) == [(2, 1), (3, 4)]


def test_two_nested_fields(spark):
    df = spark.createDataFrame([(1, (2, 3))], "id int, s struct<x:int,y:int>")
    out = mg.update_where(df, F.col("id") == 1, {"s.x": F.lit(9), "s.y": F.col("s.x")}).first()
    assert tuple(out["s"]) == (9, 2)


def test_delete_sequence_rules(spark, rows):
    data = spark.createDataFrame([("f", 0, "a", 1), ("f", 1, "a", 2), ("f", 2, None, 1), ("f", 3, "b", 1)], "file_path string, pos bigint, k string, sequence_number bigint")
    eq = spark.createDataFrame([("a", 2), (None, 2)], "k string, sequence_number bigint")
    assert rows(dl.apply_equality_deletes(data, [(eq, ["k"])]), "pos") == [(1,), (3,)]
    pos = spark.createDataFrame([("f", 1, 2), ("f", 3, 0)], "file_path string, pos bigint, sequence_number bigint")
    assert rows(dl.apply_position_deletes(data, pos), "pos") == [(0,), (2,), (3,)]
    assert [r["_deleted"] for r in dl.mark_deleted(data, pos).orderBy("pos").collect()] == [False, True, False, False]


def test_deletion_vector_ranges(spark):
    pos = [0, 1, 32767, 32768, 32769, 100000, 100000]
    df = spark.createDataFrame([("f", p) for p in pos], "file_path string, pos bigint")
    vectors = dl.deletion_vectors(df)
    assert vectors.count() == 3
    assert dl.deleted_counts(dl.merge_deletion_vectors(vectors, vectors)).first()["deleted_rows"] == 6
    files = spark.createDataFrame([("g", 0)], "file_path string, content int")
    assert dl.dangling_vectors(vectors, files).count() == 3


def test_dangling_deletes(spark, rows):
    files = spark.createDataFrame([
        ("d1", "p", 0, 5), ("d2", None, 0, 3), ("pos-ok", "p", 1, 5), ("pos-old", "p", 1, 4), ("eq-old", "p", 2, 5), ("eq-ok", "p", 2, 6),
        ("null-ok", None, 1, 3), ("alone", "q", 1, 9)], "file_path string, part string, content int, sequence_number bigint")
    assert rows(dl.dangling_deletes(files, ["part"]), "file_path") == [("alone",), ("eq-old",), ("pos-old",)]


def test_added_rows_must_match(spark):
    old = spark.createDataFrame([(1,)], "v int")
    new = spark.createDataFrame([(5,), (None,)], "v int")
    with pytest.raises(Exception, match="overwrite filter"):
        overwrite_by_filter(old, new, F.col("v") > 3).collect()


def make_files(spark, seed):
    """Rows in files with NULLs and NaNs, and the files' statistics."""
    rng = random.Random(seed)
    data = []
    for f in range(40):
        low = rng.uniform(0, 50)
        for _ in range(rng.randrange(1, 6)):
            kind = rng.random()
            v = None if kind < 0.15 else float("nan") if kind < 0.25 else round(rng.uniform(low, low + rng.choice([0, 5, 30])), 1)
            s = None if rng.random() < 0.2 else rng.choice(["ab", "abc", "b", "ca"])
            data.append((f, v, s))
        if f % 7 == 0:
            data = [(g, None if g == f else v, s) for g, v, s in data]
    rows = spark.createDataFrame(data, "file int, v double, s string")
    return rows, st.column_metrics(rows, ["file"], {"v": "full", "s": "full"})


def predicates(p):
    leaves = [p.lt("v", 20.0), p.lt_eq("v", 20.0), p.gt("v", 20.0), p.gt_eq("v", 20.0), p.eq("v", 20.0), p.not_eq("v", 20.0),
              p.is_in("v", [10.0, 30.0]), p.not_in("v", [10.0, 30.0]), p.is_null("v"), p.not_null("v"), p.is_nan("v"), p.not_nan("v"),
              p.starts_with("s", "ab"), p.not_starts_with("s", "ab"), p.eq("s", "b"), p.is_null("s"), p.always(True), p.always(False)]
    pairs = [a & b for a, b in itertools.product(leaves[:4], leaves[8:14])] + [a | ~b for a, b in zip(leaves, leaves[5:])]
    return leaves + [~x for x in leaves] + pairs + [~x for x in pairs]


@pytest.mark.parametrize("seed", [1, 2])
def test_skipping_is_safe(spark, seed):
    """No file with a match is skipped; a file said to match wholly does.  NaN sorts above all numbers, so
    files holding NaN may answer "some" but never wrongly "none" for upper comparisons they satisfy."""
    rows, files = make_files(spark, seed)
    every = predicates(sk.FileStats(files))
    checks = rows.groupBy("file").agg(*[F.count_if(F.coalesce(p.row, F.lit(False))).alias(f"hit{i}") for i, p in enumerate(every)], F.count("*").alias("n"))
    verdicts = files.select("file", *[p.may_match.alias(f"may{i}") for i, p in enumerate(every)], *[p.must_match.alias(f"must{i}") for i, p in enumerate(every)])
    for r in checks.join(verdicts, "file").collect():
        for i in range(len(every)):
            assert r[f"may{i}"] or r[f"hit{i}"] == 0, (i, r["file"])
            assert not r[f"must{i}"] or r[f"hit{i}"] == r["n"], (i, r["file"])


def test_upper_bounds(spark):
    cases = [("abc", "abc"), ("abcd", "abd"), ("ab\U0010ffffz", "ac"), ("\U0010ffff\U0010ffff\U0010ffffx", None), ("a\ud7ff"[:1] + "b\ud7ffx", "ab\ue000")]
    df = spark.createDataFrame([(c[0],) for c in cases], "t string")
    assert [r[0] for r in df.select(st.upper_bound(F.col("t"), 3)).collect()] == [c[1] for c in cases]


def test_merged_sketches(spark):
    df = spark.range(3000).withColumn("g", F.col("id") % 3)
    sketches = df.groupBy("g").agg(F.theta_sketch_agg("id").alias("id"))
    assert st.merge_ndv(sketches, ["id"]).first()["ndv"] == 3000


def test_scan_summary_range(spark):
    files = spark.createDataFrame([(0, 1, 10, "p")], "content int, added_snapshot_id bigint, record_count bigint, part string")
    snaps = spark.sql("SELECT 1L AS snapshot_id, timestamp_ntz'2024-01-05' AS committed_at")
    with pytest.raises(ValueError, match="expired"):
        st.scan_summary(files, snaps, "part", after=F.lit("2024-01-01").cast("timestamp_ntz"))
