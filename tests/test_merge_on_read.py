"""One-pass MERGE, bitmap deletes, tables of rows and deletes, and scans that leave files out."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import __spark_entry__ as entry
from tarn.operators import deletes as dl, delta as dt, merge as mg
from tarn.plans import fixtures as fx
from tarn.plans.registry import Tables

FOLDER = os.environ.get("TARN_TEST_DATA", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def merged_by_loops(target, source):
    by_key = {s[0]: s for s in source if s[0] is not None}
    keys = {t[0] for t in target}
    out = []
    for k, n in target:
        s = by_key.get(k)
        if s is None:
            out += [] if n == 0 else [(k, n)]
        elif s[1] != 3:
            out.append((k, n + s[1]))
    return sorted(out + [(k, -n) for k, n in source if (k is None or k not in keys) and n < 8], key=str)


def clauses():
    return dict(matched=[mg.Clause("delete", F.col("s.n") == 3), mg.Clause("update", None, {"n": F.col("t.n") + F.col("s.n")})],
                not_matched=[mg.Clause("insert", F.col("s.n") < 8, {"k": F.col("s.k"), "n": -F.col("s.n")})],
                not_matched_by_source=[mg.Clause("delete", F.col("t.n") == 0)])


@pytest.mark.parametrize("hot", [False, True])
def test_merge_in_one_pass(spark, monkeypatch, hot):
    """Hot and null keys on both sides, matched and not, with and without spreading."""
    if hot:
        monkeypatch.setattr(mg, "HOT_ROWS", 1)
        monkeypatch.setattr(mg.hot_keys, "__defaults__", (0.05, 1))
        monkeypatch.setattr(mg, "SPREAD", 7)
    dice = random.Random(1)
    target = [(dice.choice([None, *[1] * 20, 2, *range(3, 60)]), dice.randrange(6)) for _ in range(400)]
    source = [(k, dice.randrange(10)) for k in dice.sample(range(90), 50)] + [(None, 1), (None, 1), (None, 9)]
    t, s = spark.createDataFrame(target, "k int, n int"), spark.createDataFrame(source, "k bigint, n int")
    assert (1,) in mg.hot_keys(t, ["k"], 0.05, 1)
    got = mg.merge(t, s, ["k"], **clauses())
    assert sorted(map(tuple, got.collect()), key=str) == merged_by_loops(target, source)


def test_merge_on_two_keys_with_hot_rows(spark, monkeypatch):
    monkeypatch.setattr(mg.hot_keys, "__defaults__", (0.1, 1))
    target = [(1, "a", i) for i in range(50)] + [(1, "b", 0), (None, "a", 1), (2, "a", 5)]
    source = [(1, "a", 100), (1, None, 5), (3, "a", 6), (2, "a", 7)]
    t, s = spark.createDataFrame(target, "k int, c string, n int"), spark.createDataFrame(source, "k int, c string, n int")
    got = mg.merge(t, s, ["k", "c"], [mg.Clause("update", None, {"n": F.col("s.n")})], [mg.Clause("insert")])
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, "a", 100)] * 50 + [(1, "b", 0), (None, "a", 1), (2, "a", 7), (1, None, 5), (3, "a", 6)], key=str)


def test_repeated_source_keys(spark):
    t = spark.createDataFrame([(1, 1), (2, 2)], "k int, n int")
    s = spark.createDataFrame([(2, 5), (3, 6), (3, 6), (4, 9)], "k int, n int")
    got = mg.merge(t, s, ["k"], **clauses())
    assert sorted(map(tuple, got.collect())) == [(1, 1), (2, 7), (3, -6), (3, -6)]
    with pytest.raises(Exception, match="several source rows"):
        mg.merge(t, s.union(spark.createDataFrame([(2, 1)], s.schema)), ["k"], **clauses()).collect()


def test_merge_reads_each_side_once(spark, tmp_path):
    for name, rows in (("t", 300), ("s", 100)):
        spark.range(rows).select((F.col("id") * (2 if name == "s" else 1)).alias("k"), F.lit(1).alias("n")).write.parquet(str(tmp_path / name))
    t, s = spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "s"))
    got = mg.merge(t, s, ["k"], **clauses())
    plan = plan_of(got)
    assert plan.count("FileScan parquet") == 1 and str(tmp_path / "t") in plan and "FullOuter" in plan
    assert got.count() == 300  # 100 keys of the source are all in the target
    two = mg.merge(t, s, ["k"], **clauses(), condition=F.col("t.n") <= F.col("s.n"))
    assert plan_of(two).count("FileScan") == 0 and two.count() == 300  # both sides were stored with their pairs
    gone, added = mg.merge_delta(t.select("*", F.lit("f").alias("_file"), F.col("k").alias("_pos")), s, ["k"], **clauses())
    assert plan_of(gone).count("FileScan") == plan_of(added).count("FileScan") == 0
    assert gone.count() == added.count() == 100


def test_bitmaps_of_positions(spark, tmp_path):
    dice = random.Random(5)
    data = [(f"f{dice.randrange(8)}", p, dice.choice([1, 2, 3])) for p in range(700)]
    gone = [(f"f{dice.randrange(6)}", dice.randrange(700), dice.choice([1, 2, 3])) for _ in range(900)] + [("f1", None, 1), (None, 3, 1)]
    names = "file_path string, pos bigint, sequence_number int"
    rows, deletes = spark.createDataFrame(data, names), spark.createDataFrame(gone, names)
    hit = {r for r in data for g in gone if r[:2] == g[:2] and r[2] <= g[2]}
    assert 0 < len(hit) < len(data)
    rows.repartition("file_path").write.partitionBy("file_path").parquet(str(tmp_path / "d"))
    stored = spark.read.schema(rows.schema).parquet(str(tmp_path / "d")).select(*rows.columns)
    for table, by_file in ((rows, False), (stored, True)):
        kept = dl.apply_position_deletes(table, deletes, by_file=by_file)
        assert sorted(map(tuple, kept.collect())) == sorted(set(data) - hit)
        marked = dl.mark_deleted(table, deletes, by_file=by_file)
        assert {tuple(r)[:3]: r["_deleted"] for r in marked.collect()} == {r: r in hit for r in data}
    plan = plan_of(dl.apply_position_deletes(stored, deletes, by_file=True))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 2 and plan.count("BroadcastHashJoin") == 1 and any("NOT" in line and "file_path" in line for line in scans)
    assert dl.apply_position_deletes(rows, deletes.limit(0)).count() == len(data)


def test_upserts_as_rows_and_deletes(spark, tmp_path):
    dice = random.Random(8)
    path, schema = str(tmp_path / "t"), StructType.fromDDL("k int, v int")
    first = [(k, 0) for k in range(10)] + [(None, 0)]
    assert dt.read_upserted(spark, path, schema, ["k"]).count() == 0
    dt.write_rows(spark.createDataFrame(first, schema), path, 0)
    want, at = dict(first), [dict(first)]
    for commit in range(1, 4):
        batch = [(dice.choice([None, *range(14)]), 100 * commit + i, i, dice.choice(["INSERT", "UPDATE_BEFORE", "DELETE", "UPDATE_AFTER", None]))
                 for i in range(25)]
        df = spark.createDataFrame(batch, "k int, v int, i int, op string").repartition(3)
        dt.write_upsert(df, path, ["k"], ["i"], commit, schema, "op")
        for k, v, _, op in batch:
            if op == "DELETE":
                want.pop(k, None)
            elif op != "UPDATE_BEFORE":
                want[k] = v
        at.append(dict(want))
        dt.write_upsert(df.withColumn("v", F.lit(-1)), path, ["k"], ["i"], commit, schema, "op")  # a replay does nothing
    for commit, rows in list(enumerate(at))[::2]:
        got = dt.read_upserted(spark, path, schema, ["k"], commit).collect()
        assert sorted(map(tuple, got), key=str) == sorted(rows.items(), key=str)
    # A commit that has not come to its end is not seen, and is written anew.
    spark.createDataFrame([(1, 7)], schema).write.parquet(f"{path}/rows/{dt.COMMIT}=4")
    assert sorted(map(tuple, dt.read_upserted(spark, path, schema, ["k"]).collect()), key=str) == sorted(want.items(), key=str)
    dt.write_upsert(spark.createDataFrame([(1, 8), (1, 9)], schema), path, ["k"], ["v"], 4, schema)
    want[1] = 9
    dt.compact(spark, path, str(tmp_path / "new"), schema, ["k"], 4)
    assert sorted(map(tuple, dt.read_upserted(spark, str(tmp_path / "new"), schema, ["k"]).collect()), key=str) == sorted(want.items(), key=str)


def files_read(df) -> list[tuple[int, int]]:
    """(files read, folders the scan could have read) of each file scan of a query that has run."""
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            todo.append(node.executedPlan())
            continue
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            out.append((node.metrics().apply("numFiles").value(), node.relation().location().inputFiles().__len__()))
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return out


@needs_tables
@pytest.mark.parametrize("name", ["time_travel_as_of", "incremental_append", "changelog_scan", "residual_scan", "skip_partitions"])
def test_scans_read_fewer_files_than_stored(spark, name):
    df = entry.queries()[name](spark, FOLDER)
    df.collect()
    read = [(got, all_) for got, all_ in files_read(df) if all_ > 1]
    assert read and all(0 < got < all_ for got, all_ in read), read


def test_stored_lines_have_a_folder_per_commit(spark, tmp_path):
    """However many files of 50 orders there are."""
    spark.range(10000).select((F.col("id") * 5).alias("l_orderkey")).write.parquet(str(tmp_path / "lineitem.parquet"))
    stored = fx.stored_lines(Tables(spark, str(tmp_path)))
    rows = stored.select("l_orderkey", "file_no", F.regexp_extract("_metadata.file_path", "^(.*)/", 1).alias("f"))
    found = rows.agg(F.count_distinct("f"), F.count_distinct("file_no"), F.count_distinct("l_orderkey"), F.count("*")).first()
    assert tuple(found) == (fx.HEAD, 1000, 10000, 10000)
