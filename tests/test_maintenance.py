from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tarn.functions.transforms import PartitionField
from tarn.operators import layout as ly, lineage as ln, maintenance as mt
from tarn.operators.ordered import pack

GB = 1 << 30


@pytest.mark.parametrize("size,files", [(0, 1), (GB - 1, 1), (GB, 1), (int(10.1 * GB), 10), (int(1.05 * GB), 1), (int(1.2 * GB), 2),
                                        (int(1.8 * GB), 2), (int(10.8 * GB), 11), (int(2.5 * GB), 3)])
def test_output_files(spark, size, files):
    sizing = mt.Sizing(target=GB)
    assert spark.range(1).select(mt.output_files(F.lit(size).cast("bigint"), sizing)).first()[0] == files
    assert mt.shuffle_partitions(size, 1.0, 1, sizing) == files


def plain_pack(weights, target, lookback, largest_first):
    open_bins, where, count = [], [], 0
    for w in weights:
        fit = next((b for b in open_bins if b["w"] + w <= target), None)
        if fit is None:
            fit = {"id": count, "w": 0}
            count += 1
            open_bins.append(fit)
            fit["w"] += w
            if len(open_bins) > lookback:
                gone = max(open_bins, key=lambda b: b["w"]) if largest_first else open_bins[0]
                open_bins.remove(gone)
        else:
            fit["w"] += w
        where.append(fit["id"])
    return where


@pytest.mark.parametrize("lookback,largest", [(1, False), (3, False), (10, True)])
def test_packing(spark, lookback, largest):
    rng = random.Random(lookback)
    data = [(k, i, rng.randrange(1, 60)) for k in ("a", "b", None) for i in range(80)]
    df = spark.createDataFrame(data, "k string, i int, w bigint")
    got = {(r["k"], r["i"]): r["bin"] for r in pack(df, ["k"], ["i"], "w", 100, lookback, largest).collect()}
    for k in ("a", "b", None):
        assert [got[k, i] for i in range(80)] == plain_pack([w for kk, _, w in data if kk == k], 100, lookback, largest)


def test_compaction_filters(spark):
    s = mt.Sizing(target=100)
    small = [("p", f"s{i}", 10, 100, 0) for i in range(5)]
    rest = [("p", "good", 100, 100, 0), ("q", "lonely", 10, 100, 0), ("r", "huge", 500, 100, 0), ("t", "deleted", 100, 100, 30), ("u", "few", 100, 100, None)]
    df = spark.createDataFrame(small + rest, "part string, file_path string, file_size_in_bytes bigint, record_count bigint, deleted_records bigint")
    chosen = {r["file_path"] for r in mt.compaction_files(df, ["part"], s).collect()}
    assert chosen == {"s0", "s1", "s2", "s3", "s4", "huge", "deleted"}
    assert mt.compaction_files(df, ["part"], s, rewrite_all=True).count() == 10
    by = [r["input_bytes"] for r in mt.compaction_plan(df, ["part"], s, job_order="bytes-desc").collect()]
    assert by == sorted(by, reverse=True)


def line_table(spark):
    data = [(i, i - 1 if i > 1 else None, dt.datetime(2024, 1, i), "append") for i in range(1, 10)]
    data += [(20, 4, dt.datetime(2024, 1, 20), "append"), (30, None, dt.datetime(2024, 1, 25), "append"), (31, None, dt.datetime(2024, 1, 2), "append")]
    return spark.createDataFrame(data, "snapshot_id bigint, parent_id bigint, committed_at timestamp_ntz, operation string")


def test_ancestors(spark, rows):
    snaps = line_table(spark)
    assert rows(ln.ancestors(snaps, 20)) == [(1, 4), (2, 3), (3, 2), (4, 1), (20, 0)]
    line = ln.chain(snaps, 9)
    assert rows(ln.after(line, 6), "snapshot_id") == [(7,), (8,), (9,)]
    assert rows(ln.after(line, 6, inclusive=True), "snapshot_id") == [(6,), (7,), (8,), (9,)]
    with pytest.raises(ValueError, match="not an ancestor"):
        ln.after(line, 20)
    assert ln.is_ancestor(line, 1) and not ln.is_ancestor(line, 20)


def test_line_does_not_read_the_snapshots_again(spark, rows, tmp_path):
    line_table(spark).write.parquet(str(tmp_path / "s"))
    snaps = spark.read.parquet(str(tmp_path / "s"))
    line = ln.chain(snaps, 20)
    assert rows(line, "snapshot_id", "parent_id", "depth") == [(1, None, 4), (2, 1, 3), (3, 2, 2), (4, 3, 1), (20, 4, 0)]
    assert rows(ln.after(ln.up_to(line, 4), 2), "snapshot_id") == [(3,), (4,)]
    assert rows(ln.chain(snaps, 30), "snapshot_id", "depth") == [(30, 0)]
    assert rows(ln.chain(snaps.where("parent_id IS NULL"), 31), "snapshot_id", "depth") == [(31, 0)]
    assert "FileScan" not in line._jdf.queryExecution().executedPlan().toString()


def test_start_limits(spark, rows):
    line = ln.chain(line_table(spark), 9)
    assert rows(ln.start_reading(line, "earliest_inclusive", max_snapshots=2), "snapshot_id") == [(1,), (2,)]
    at = F.lit("2024-01-07 12:00:00").cast("timestamp_ntz")
    assert rows(ln.start_reading(line, "from_timestamp_inclusive", at=at), "snapshot_id") == [(8,), (9,)]
    assert ln.start_reading(line, "latest_exclusive").count() == 0


def test_stream_refuses_deletes(spark):
    line = line_table(spark).withColumn("operation", F.when(F.col("snapshot_id") == 5, "delete").otherwise("append"))
    with pytest.raises(Exception, match="cannot stream a delete"):
        ln.streamable(line).collect()
    assert ln.streamable(line, skip_delete=True).count() == 11


def test_changelog_refuses_delete_files(spark):
    line = ln.chain(line_table(spark), 9)
    files = spark.createDataFrame([("f", 1, 5, None)], "file_path string, content int, added_snapshot_id bigint, removed_snapshot_id bigint")
    with pytest.raises(Exception, match="delete files"):
        ln.changed_files(files, line).collect()


def test_changelog_computes_the_files_once(spark, rows, tmp_path):
    """Added and removed in the range, in a rewrite or outside of it; the list is read by one scan."""
    data = [("a", 0, 1, 7), ("b", 0, 6, 8), ("c", 0, 7, None), ("d", 0, 5, None), ("e", 0, 9, 9), ("f", 0, 20, 31), ("g", 0, None, 6)]
    spark.createDataFrame(data, "file_path string, content int, added_snapshot_id bigint, removed_snapshot_id bigint").write.parquet(str(tmp_path / "f"))
    line = line_table(spark).withColumn("operation", F.when(F.col("snapshot_id") == 6, "replace").otherwise("append"))
    got = ln.changed_files(spark.read.parquet(str(tmp_path / "f")), ln.after(ln.chain(line, 9), 5))
    assert got.columns == ["file_path", "content", "added_snapshot_id", "removed_snapshot_id", "_change_ordinal", "_change_type", "_commit_snapshot_id"]
    assert rows(got.drop("content", "added_snapshot_id", "removed_snapshot_id")) == [
        ("a", 0, "DELETE", 7), ("b", 1, "DELETE", 8), ("c", 0, "INSERT", 7), ("e", 2, "DELETE", 9), ("e", 2, "INSERT", 9)]
    assert got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("FileScan parquet") == 1


def test_missing_bound_is_an_error(spark):
    files = spark.createDataFrame([("s", None)], "split string, low timestamp_ntz")
    with pytest.raises(Exception, match="missing lower bound"):
        ln.split_watermarks(files, "split", "low").collect()


def test_expiry_rules(spark):
    snaps = line_table(spark)
    refs = spark.createDataFrame([("main", "BRANCH", 9, 1, 2, None), ("side", "BRANCH", 20, None, 1, 6 * 86400000), ("gone", "TAG", 3, 1000, None, None)],
                                 "name string, type string, snapshot_id bigint, max_reference_age_in_ms bigint, min_snapshots_to_keep int, max_snapshot_age_in_ms bigint")
    at = lambda s: F.lit(s).cast("timestamp_ntz")
    kept = {r[0] for r in mt.retained_snapshots(snaps, refs, at("2024-01-25"), at("2024-01-24")).collect()}
    # main keeps two, side its head only (4 is too old), 30 is unreferenced but young, 31 unreferenced and old
    assert kept == {9, 8, 20, 30}


def test_orphan_mismatch(spark, rows):
    listing = spark.createDataFrame([("s3a://b/x", dt.datetime(2024, 1, 1)), ("s3://b/y", dt.datetime(2024, 1, 1)), ("gs://b/x2", dt.datetime(2024, 1, 1)),
                                     ("s3://b/new", dt.datetime(2024, 2, 1)), ("/b2/z", dt.datetime(2024, 1, 1))], "file_path string, last_modified timestamp_ntz")
    valid = spark.createDataFrame([("s3://b/x",), ("s3://b/x2",)], "file_path string")
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    run = lambda mode: rows(mt.orphan_files(listing, valid, cut, {"s3a": "s3"}, mismatch=mode), "file_path")
    assert run("ignore") == [("/b2/z",), ("s3://b/y",)]
    assert run("delete") == [("/b2/z",), ("gs://b/x2",), ("s3://b/y",)]
    with pytest.raises(Exception, match="differs"):
        run("error")


def test_import_plan(spark, tmp_path):
    spark.range(10).withColumn("k", F.concat(F.lit("a/"), F.col("id") % 2)).write.partitionBy("k").parquet(str(tmp_path / "t"))
    listing = mt.list_files(spark, str(tmp_path / "t"))
    plan = mt.import_plan(listing, ["k"], {"k": "a/1"})
    assert plan.count() >= 1 and {r["k"] for r in plan.collect()} == {"a/1"}
    with pytest.raises(Exception, match="already imported"):
        mt.import_plan(listing, ["k"], existing=plan).collect()


def test_rewrite_paths_outside(spark):
    df = spark.createDataFrame([("x://a/1",), ("y://a/1",)], "file_path string")
    with pytest.raises(Exception, match="outside"):
        mt.rewrite_paths(df, "x://a/", "z://b/").collect()


def test_trigger(spark):
    data = [("t", i, dt.datetime(2024, 1, 1, 0, i), 1, 10) for i in range(12)]
    df = spark.createDataFrame(data, "tbl string, i int, at timestamp, files bigint, bytes bigint")
    fires = lambda limits, **kw: [r["i"] for r in mt.maintenance_trigger(df, ["tbl"], ["i"], "at", limits, **kw).where("fires").orderBy("i").collect()]
    assert fires({"commit_count": 4}) == [3, 7, 11]
    assert fires({"files": 5, "bytes": 30}) == [2, 5, 8, 11]
    assert fires({"commit_count": 2}, min_delay_seconds=180) == [1, 4, 7, 10]
    assert fires({"files": 1000}, timeout_seconds=300) == [5, 10]


def test_bucket_routing(spark):
    df = spark.range(600).withColumn("b", F.col("id") % 2)
    routed = df.withColumn("w", ly.bucket_writer(F.col("b"), 2, 5, (F.col("id") / 2).cast("bigint")))
    assert {(r["b"], r["w"]) for r in routed.select("b", "w").distinct().collect()} == {(0, 0), (0, 2), (0, 4), (1, 1), (1, 3)}


def test_routing_places_rows(spark):
    df = spark.range(1000)
    placed = ly.route_to_writers(df, F.col("id") % 5, 5).withColumn("p", F.spark_partition_id())
    assert placed.select(((F.col("id") % 5) == F.col("p")).alias("ok")).where("NOT ok").count() == 0


def test_hot_key_is_spread(spark):
    df = spark.range(30000).withColumn("k", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 100 + 1))
    assigned = ly.assign_writers(ly.key_weights(df, "k"), "k", F.lit(0), 6)
    counts = [r[1] for r in ly.skew_aware_writer(df, "k", assigned, 6, F.xxhash64("id")).groupBy("_writer").count().collect()]
    assert len(counts) == 6 and sum(counts) == 30000 and max(counts) < 5600


def test_one_sort_value_is_split(spark):
    df = spark.range(20000).withColumn("k", F.lit(1))
    out = ly.distribute(df, "range", order=[ly.SortTerm("k")], writers=4)
    sizes = [r[1] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 20000 and len(sizes) == 4 and max(sizes) < 10000


def test_write_order():
    day = PartitionField("ts", "day")
    order = ly.write_order([PartitionField("ts", "month"), PartitionField("c")], [ly.SortTerm("ts", transform="day"), ly.SortTerm("id")])
    assert [(t.source, t.transform) for t in order] == [("c", "identity"), ("ts", "day"), ("id", "identity")]
    assert day.satisfies(PartitionField("ts", "year"))


def test_sketches_route_heavy_keys_and_merge(spark):
    df = spark.range(40000).withColumn("k", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 5 != 0, (F.col("id") % 3000).cast("string")))
    sketches = ly.key_sketches(df.withColumn("day", F.col("id") % 4), "k", 6, ["day"])
    assert sketches.count() == 4
    heavy, total = ly.heavy_keys(sketches, 6)
    assert total == 40000 and "hot" in [k for k, _ in heavy] and len(heavy) <= 2  # NULL may be counted as a key
    routed = ly.sketched_writer(df, "k", heavy, total, 6, F.xxhash64("id"))
    loads = {r[0]: r[1] for r in routed.groupBy("_writer").count().collect()}
    assert set(loads) == set(range(6)) and sum(loads.values()) == 40000
    light = routed.where("k <> 'hot'").groupBy("k").agg(F.count_distinct("_writer").alias("n")).where("n > 1")
    assert light.count() == 0
    empty = df.limit(0)
    heavy, total = ly.heavy_keys(ly.key_sketches(empty, "k", 6), 6)
    assert (heavy, total) == ([], 0) and ly.sketched_writer(empty, "k", heavy, total, 6, F.xxhash64("id")).count() == 0


def test_merged_quantile_sketches(spark):
    df = spark.range(50000).select((F.col("id") * F.col("id")).alias("v"), (F.col("id") % 7).alias("g"))
    bounds = [r["bound"] for r in ly.range_bounds(ly.range_sketches(df, "v", ["g"]), 10).orderBy("range").collect()]
    assert len(bounds) == 9 and bounds == sorted(bounds)
    assert all(abs(b ** 0.5 / 50000 - (i + 1) / 10) < 0.01 for i, b in enumerate(bounds))


def test_list_tree(spark, tmp_path):
    import os
    names = ["a.txt", "x/b.txt", "x/y/c d.txt", "x/y/z/é.txt", "_log/e.txt"]
    for n in names:
        (tmp_path / "t" / n).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "t" / n).write_text(n)
    (tmp_path / "t" / "empty").mkdir()
    for root in (str(tmp_path / "t"), f"file:{tmp_path}/t", f"file://{tmp_path}/t/"):
        got = mt.list_tree(spark, root).collect()
        assert sorted(r["file_path"] for r in got) == sorted(f"{root.rstrip('/')}/{n}" for n in names)
        assert {r["file_size_in_bytes"] for r in got} == {len(n.encode()) for n in names} and all(r["last_modified"] for r in got)
    # Any other store: what a folder holds is a function of its path.
    tree = {"s3://b/t": [("s3://b/t/f", False, 5, None), ("s3://b/t/d", True, 0, None)], "s3://b/t/d": [("s3://b/t/d/g", False, 6, None)]}
    assert sorted(r[0] for r in mt.list_tree(spark, "s3://b/t", lambda f: tree[f]).collect()) == ["s3://b/t/d/g", "s3://b/t/f"]


def test_retention_equals_a_walk(spark):
    """Random trees, branches that share lines, clocks that go back, against walking every branch."""
    import datetime as dt
    import random
    dice = random.Random(5)
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    for size in (1, 2, 37, 60):
        snaps = {i: (None if i == 0 or dice.random() < 0.03 else dice.randrange(max(0, i - 4), i), day(i + dice.choice([0, 0, 0, -9, 5]))) for i in range(size)}
        refs = [("main", "BRANCH", size - 1, None, dice.choice([None, 3]), dice.choice([None, 8 * 86400000]))]
        refs += [(f"b{j}", dice.choice(["BRANCH", "BRANCH", "TAG"]), dice.randrange(size), dice.choice([None, 10 * 86400000]),
                  dice.choice([None, 1, 5, 1000]), dice.choice([None, 4 * 86400000, 400 * 86400000])) for j in range(5)]
        now, older = day(size), day(size - size // 3)
        want, reached = set(), set()
        for name, kind, head, max_age, keep, age in refs:
            if name != "main" and max_age is not None and now - snaps[head][1] > dt.timedelta(milliseconds=max_age):
                continue
            want.add(head)
            reached.add(head)
            if kind == "TAG":
                continue
            cut, at, depth, open_ = older if age is None else now - dt.timedelta(milliseconds=age), head, 0, True
            while at is not None:
                reached.add(at)
                open_ = open_ and (depth < (keep or 1) or snaps[at][1] >= cut)
                if open_:
                    want.add(at)
                at, depth = snaps[at][0], depth + 1
        want |= {i for i, (_, t) in snaps.items() if i not in reached and t >= older}
        s = spark.createDataFrame([(i, p, t) for i, (p, t) in snaps.items()], "snapshot_id long, parent_id long, committed_at timestamp_ntz")
        r = spark.createDataFrame(refs, "name string, type string, snapshot_id long, max_reference_age_in_ms long, min_snapshots_to_keep int, max_snapshot_age_in_ms long")
        lit = lambda t: F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")
        assert {x[0] for x in mt.retained_snapshots(s, r, lit(now), lit(older)).collect()} == want


def test_clustering_compares_stretches_of_a_file(spark, monkeypatch):
    monkeypatch.setattr(ly, "STRETCH", 4)
    keys = {"a": [1, 2, 2, 3, 3, 4, 5, 6, 9], "b": [9, 9, 10, 11, 8, 9, 10, 11], "c": [12, None, 13], "d": [14]}  # b falls between two stretches
    rows = [(name, i, k) for name, ks in keys.items() for i, k in enumerate(ks)]
    random.Random(3).shuffle(rows)
    stored = spark.createDataFrame(rows, "_file string, _pos bigint, k int").repartition(3)
    flags = ly.clustering(stored, [F.col("k")])
    assert "_stretch" in flags._jdf.queryExecution().optimizedPlan().toString()
    got = {r["_file"]: (r["rows"], r["lower"]["k0"], r["upper"]["k0"], r["in_order"], r["apart"]) for r in flags.collect()}
    # NULL sorts first, so c begins before all others and ends after them.
    assert got == {"a": (9, 1, 9, True, False), "b": (8, 8, 11, False, True), "c": (3, None, 13, False, False), "d": (1, 14, 14, True, True)}
    assert ly.clustering(stored.where("false"), [F.col("k")]).count() == 0


def test_sorting_writers_hold_so_many_rows(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert mt.writers_for(stored, 4) == 4
    assert mt.writers_for(stored, 4, sorted_rows=101) == 10
