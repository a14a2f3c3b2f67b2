from __future__ import annotations

import datetime as dt
import os
import sqlite3
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarn.operators import delta as dm, events as ev, jobs, sinks as sn, windows as wn
from tarn.sources import files as fs, generators as gn, messages as ms
from tarn.streaming import enrich as en, run, state as ss, tables as tb, windows as sw


_fed: set[str] = set()


def feed(spark, folder, batches, ddl):
    """One file per batch, read one file per micro-batch in the order written."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").json(str(folder))
        for path in folder.glob("part-*"):
            if str(path) not in _fed:
                _fed.add(str(path))
                os.utime(path, (1000 + i, 1000 + i))
    return fs.file_stream(spark, str(folder), StructType.fromDDL(ddl), "json", files_per_trigger=1)


def at(minute, second=0):
    return dt.datetime(2024, 1, 1, 0, minute, second)


def test_late_rows_drop_like_the_batch_form(spark, tmp_path):
    batches = [[("a", at(0)), ("b", at(5))], [("c", at(4, 55)), ("d", at(6))], [("e", at(4, 40)), ("f", at(5, 45)), ("g", at(9))], [("h", at(5, 49)), ("i", at(8, 51))]]
    stream = feed(spark, tmp_path / "in", batches, "k string, ts timestamp")
    kept_rows = sw.with_watermark(stream, "ts", "10 seconds").dropDuplicatesWithinWatermark(["k"])
    run.finish(run.to_files(kept_rows, str(tmp_path / "out"), str(tmp_path / "cp")))
    kept = {r["k"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert kept == set("abcdfgi")
    flat = spark.createDataFrame([(i * 3, k, t) for i, b in enumerate(batches) for k, t in b], "arrival int, k string, ts timestamp")
    form = lambda lag: {r["k"] for r in sw.drop_late(flat, F.col("arrival"), 3, "ts", 10, lag).collect()}
    assert form(1) == kept
    assert form(0) == set("abcdgi")


def test_restart_continues(spark, tmp_path):
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    stream = feed(spark, tmp_path / "in", [[(1,), (2,)]], "v int")
    run.finish(run.to_files(stream, out, cp))
    stream = feed(spark, tmp_path / "in", [[(3,)]], "v int")
    run.finish(run.to_files(stream, out, cp))
    run.finish(run.to_files(stream, out, cp))
    assert sorted(r[0] for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_repeated_batch_replaces_itself(spark, tmp_path):
    write = run.batch_files(str(tmp_path / "o"))
    write(spark.range(5), 0)
    write(spark.range(5), 0)
    write(spark.range(3), 1)
    assert spark.read.parquet(str(tmp_path / "o")).count() == 8


def test_keyed_table(spark, tmp_path):
    schema = StructType.fromDDL("k int, v string, seq int")
    write = tb.keyed_table_writer(str(tmp_path / "t"), ["k"], ["seq"], schema, 4, "op")
    ddl = "k int, v string, seq int, op string"
    first = spark.createDataFrame([(1, "a", 1, "I"), (2, "b", 1, "I"), (3, "c", 1, "I")], ddl)
    second = spark.createDataFrame([(1, "a2", 2, "UA"), (1, "a1", 2, "UB"), (2, None, 3, "D"), (4, "d", 2, "I")], ddl)
    for batch_id, batch in ((0, first), (1, second), (1, second), (0, first)):
        write(batch, batch_id)
        state = sorted(tuple(r) for r in tb.read_keyed_table(spark, str(tmp_path / "t"), schema).collect())
    assert state == [(1, "a2", 2), (3, "c", 1), (4, "d", 2)]


def test_processing_time_stream_total(spark, tmp_path):
    stream = feed(spark, tmp_path / "in", [[("a", 1.0), ("b", 2.0)], [("a", 3.0)]], "k string, v double")
    out = sw.processing_windowed(stream, "1 hour", ["k"], [F.sum("v").alias("s")])
    run.finish(run.per_batch(out, str(tmp_path / "cp"), run.batch_files(str(tmp_path / "o")), "update"))
    state = run.latest_state(spark, str(tmp_path / "o"), "window_start timestamp, k string, s double", ["window_start", "k"])
    assert {r["k"]: r["s"] for r in state.groupBy("k").agg(F.sum("s").alias("s")).collect()} == {"a": 4.0, "b": 2.0}


def test_call_retries():
    calls = []

    def flaky(row):
        calls.append(row)
        if len(calls) < 3:
            raise en.Unavailable("500")
        return {"x": 1}

    pauses = []
    assert en.call_with_retry(flaky, {}, 3, 0.1, 2.0, float("inf"), True, pauses.append) == {"x": 1}
    assert pauses == [0.1, 0.2]
    assert en.call_with_retry(lambda row: {}, {}, 2, 0.1, 1.0, float("inf"), True, pauses.append) is None
    assert en.call_with_retry(lambda row: {}, {}, 2, 0.1, 1.0, float("inf"), False, pauses.append) == {}
    assert en.call_with_retry(lambda row: {}, {}, 5, 9.0, 1.0, 0.0, True, pauses.append) is None
    with pytest.raises(ZeroDivisionError):
        en.call_with_retry(lambda row: 1 / 0, {}, 5, 9.0, 1.0, 0.0, True, pauses.append)


def test_timeouts_are_kept(spark, rows):
    def slow(row):
        time.sleep(3 if row["id"] % 5 == 0 else 0)
        return {"x": row["id"]}

    df = spark.range(0, 20, numPartitions=2)
    start = time.monotonic()
    kept = rows(en.enrich(df, slow, "x bigint", capacity=2, timeout=0.4))
    assert kept == [(i, i) for i in range(20) if i % 5]
    through = rows(en.enrich(df, slow, "x bigint", fallback="passthrough", capacity=2, timeout=0.4))
    assert through == sorted([(i, i if i % 5 else None) for i in range(20)])
    assert time.monotonic() - start < 12
    with pytest.raises(Exception, match="ZeroDivisionError"):
        en.enrich(df, lambda row: {"x": 1 // (row["id"] - 7)}, "x bigint").collect()


def test_database_upsert(spark, tmp_path):
    path = str(tmp_path / "db.sqlite")
    with sqlite3.connect(path) as con:
        con.execute("CREATE TABLE prices (symbol TEXT PRIMARY KEY, price REAL)")
    df = spark.createDataFrame([("a", 1.0, 1), ("a", 2.0, 2), ("b", 3.0, 1)], "symbol string, price double, seq int")
    for _ in range(2):
        sn.write_database(df, lambda: sqlite3.connect(path, timeout=30), "prices", ["symbol"], ["seq"], batch_size=1, columns=["symbol", "price"])
    with sqlite3.connect(path) as con:
        assert con.execute("SELECT * FROM prices ORDER BY 1").fetchall() == [("a", 2.0), ("b", 3.0)]


def test_upsert_statement():
    assert sn.upsert_statement("t", ["k", "v"], ["k"]) == "INSERT INTO t (k, v) VALUES (?, ?) ON CONFLICT (k) DO UPDATE SET v = excluded.v"
    assert sn.upsert_statement("t", ["k"], ["k"]).endswith("DO NOTHING")


def test_second_publish_is_refused(spark):
    staged = spark.createDataFrame([(1, 5.0)], "wap_id int, v double")
    audit = sn.audit_staged(staged, "wap_id", {"any": F.count("*") > 0})
    with pytest.raises(Exception, match="published before"):
        sn.publish_staged(staged, "wap_id", audit, staged, strict=True).collect()
    assert sn.publish_staged(staged, "wap_id", audit, staged).count() == 0


def test_null_key_partition(spark):
    df = spark.createDataFrame([(None,), ("a",), ("b",)], "k string")
    got = [r[0] for r in df.select(sn.key_partition(F.col("k"), 7)).collect()]
    assert got[0] == 0 and all(0 <= p < 7 for p in got)


def test_route_without_field(spark):
    assert sn.route_static(spark.range(2), {"x": None, "y": None}).count() == 4


def test_stream_options():
    options = ms.stream_options("h:1", ["a", "b"], "group-offsets", "g", 10)
    assert options == {"kafka.bootstrap.servers": "h:1", "subscribe": "a,b", "startingOffsets": "earliest", "groupIdPrefix": "g", "maxOffsetsPerTrigger": "10"}
    assert ms.stream_options("h:1", "a", "latest-offset")["startingOffsets"] == "latest"
    with pytest.raises(KeyError):
        ms.stream_options("h:1", "a", "sometime")


def test_malformed_json_can_stay(spark):
    df = spark.createDataFrame([('{"a": 1}',), ('{"a": ',), ('{"b": 2}',), (None,)], "value string")
    schema = StructType.fromDDL("a int")
    assert [r[0] for r in ms.parse_json(df, "value", schema).collect()] == [1, None]
    assert ms.parse_json(df, "value", schema, drop_malformed=False).count() == 4


def test_price_bands(spark):
    df = spark.createDataFrame([(99.99,), (100.0,), (499.99,), (500.0,), (None,)], "p double")
    assert [r[0] for r in df.select(ev.price_band(F.col("p"))).collect()] == ["LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH"]


def test_nearest(spark):
    values = [525.825, 2.675, 1.005, 0.125, 2.5, -1.375, 1234567.885, 0.0, 0.005, 0.015, 0.025, 0.0049999999999999, 0.045, 0.115, -0.005, 1e-300]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(ev.nearest(F.col("v"), 2)).collect()] == [round(v, 2) for v in values]


def test_running_over_chunks(spark):
    df = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 2).alias("k"))
    got = wn.running(df, ["k"], ["id"], (F.col("id") / 100).cast("int"), F.lit(1), "n")
    seen, want = {}, {}
    for i, k in sorted((r["id"], r["k"]) for r in df.collect()):
        seen[k] = seen.get(k, 0) + 1
        want[i] = seen[k]
    assert {r["id"]: r["n"] for r in got.collect()} == want


def test_decayed_average(spark):
    df = spark.range(500).select(F.col("id"), F.lit("k").alias("k"), (F.col("id") % 17).cast("double").alias("v"))
    got = wn.decayed_average(df, ["k"], ["id"], (F.col("id") / 64).cast("int"), "v", 0.1).first()["decayed_average"]
    avg = 0.0
    for i in range(500):
        avg = avg * 0.9 + (i % 17) * 0.1
    assert got == pytest.approx(avg, rel=1e-12)


def test_nan_prices(spark):
    df = spark.createDataFrame([("a", float("nan")), ("a", 2.0), ("b", float("nan"))], "k string, v double")
    got = {r["k"]: r["m"] for r in df.groupBy("k").agg(wn.min_ignoring_nan(F.col("v")).alias("m")).collect()}
    assert got["a"] == 2.0 and got["b"] != got["b"]


def test_generators_repeat(spark):
    a = gn.generate(gn.id_range(spark, 2000, 3), "id", gn.RIDE, 1).collect()
    b = gn.generate(gn.id_range(spark, 2000, 7), "id", gn.RIDE, 1).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    assert {r["event_type"] for r in a} == set(gn.RIDE_EVENTS)
    assert 1.0 <= min(r["surge_multiplier"] for r in a) and max(r["surge_multiplier"] for r in a) <= 3.0
    assert gn.id_stream(spark, 10).isStreaming


def test_job_writes(spark, tmp_path):
    config = {"source": {"format": "json", "path": str(tmp_path / "in")}, "transforms": [{"name": "where", "condition": "v > 1"}],
              "sink": {"format": "parquet", "path": str(tmp_path / "out"), "partition_by": ["v"]}}
    spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "v int, k string").write.json(str(tmp_path / "in"))
    jobs.start_job(config, jobs.build_job(config, spark=spark))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    with pytest.raises(ValueError, match="no transform"):
        jobs.build_job({"source": {}, "transforms": ["nothing"]}, spark.range(1))


def test_config_file(tmp_path):
    (tmp_path / "job.json").write_text('{"source": {"format": "rate"}}')
    assert jobs.load_config(str(tmp_path / "job.json"))["source"]["format"] == "rate"


def test_widening(spark):
    new = StructType.fromDDL("a int")
    with pytest.raises(ValueError, match="cannot become"):
        fs.read_evolved([spark.range(1).withColumnRenamed("id", "a")], new)


def test_distinct_on_a_stream_with_a_short_delay(spark, tmp_path):
    for i in range(5):
        rows = spark.createDataFrame([("u", f"2024-01-01 00:0{i}:00")], "user string, t string")
        rows.select("user", F.col("t").cast("timestamp").alias("t")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("user string, t timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    distinct = sw.distinct_then_count(stream, "t", "10 seconds", "5 minutes", [], "user")
    distinct.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_value_state_counts_over_batches_and_restarts(spark, tmp_path):
    out, cp, ddl = str(tmp_path / "out"), str(tmp_path / "cp"), "device string"

    def play(batches):
        stream = feed(spark, tmp_path / "in", batches, ddl)
        with ss.state_on_disk(spark):
            run.finish(run.to_files(ss.numbered(stream, "device"), out, cp))
        return sorted((tuple(r) for r in spark.read.schema("device string, running_count bigint").parquet(out).collect()), key=str)

    first = play([[("a",), ("b",), ("a",)], [("a",), (None,)]])
    assert first == [("a", 1), ("a", 2), ("a", 3), ("b", 1), (None, 1)]
    # A new query on the same checkpoint goes on counting; nothing is counted again.
    assert play([[("b",), ("c",), (None,)]]) == sorted(first + [("b", 2), ("c", 1), (None, 2)], key=str)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_vehicle_windows_close_once(spark, tmp_path):
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    ddl = "vin string, ts timestamp, sensors map<string,bigint>, lights array<string>"

    def play(batches):
        stream = feed(spark, tmp_path / "in", batches, ddl)
        windows = ss.vehicle_windows(stream, "vin", "ts", "5 minutes", "10 seconds", wn.vehicle_items("sensors", "lights"))
        with ss.state_on_disk(spark):
            run.finish(run.to_files(windows, out, cp))
        rows = spark.read.schema(windows.schema).parquet(out).select(
            "vin", F.date_format("window_end", "mm:ss"), F.date_format("max_timestamp", "mm:ss.SSS"), "sensor_average", "warning_count")
        return sorted(tuple(r) for r in rows.collect())

    closed = play([
        [("v", at(1), {"speed": 10, "heat": -3}, ["oil", "oil"]), ("w", at(2), None, None), ("v", at(6), {"speed": 1}, [])],
        [("v", at(4), {"speed": 21}, ["oil", "belt"])],     # late: the watermark of the batch before has passed its window
        [("v", at(12), {}, ["abs"])],                        # closes the window that ends at 10
        [("v", at(3), {"speed": 999}, ["late"]), ("v", at(11), {"speed": 7}, [])]])
    first = [r for r in closed if r[1] == "05:00"]
    assert first[1] == ("w", "05:00", "04:59.999", {}, 0)
    assert first[0] == ("v", "05:00", "04:59.999", {"speed": 10, "heat": -3}, 1)
    assert [r for r in closed if r[1] == "10:00"] == [("v", "10:00", "09:59.999", {"speed": 1}, 0)]
    assert len(closed) == 3
    # The open window is in the checkpoint and comes out after a restart, with what came before it.
    again = play([[("x", at(30), {"speed": 5}, [])]])
    assert [r for r in again if r not in closed] == [("v", "15:00", "14:59.999", {"speed": 3}, 1)]


def test_vehicle_windows_of_many_vehicles_equal_the_batch_form(spark, tmp_path):
    """Sums are kept by Spark's aggregate, no Python state per vehicle; readings that are missing have no average."""
    odd = spark.createDataFrame([(None, at(1), {"k": -7, "l": None}, [None, "x"]), (None, at(2), {"k": 2}, None), (7, at(1), {}, None)],
                                "vin bigint, ts timestamp, sensors map<string,bigint>, lights array<string>")
    many = spark.range(20000).select((F.col("id") % 9000 + (1 << 60)).alias("vin"), (F.lit(at(0)) + F.make_dt_interval(secs=F.col("id") % 500)).alias("ts"),
                                     F.create_map(F.lit("k"), F.col("id") - 10000, F.lit("id"), F.col("id")).alias("sensors"),
                                     F.array(F.concat(F.lit("w"), F.col("id") % 3)).alias("lights"))
    last = spark.createDataFrame([(1, at(59), {}, [])], odd.schema)
    odd.union(many).union(last).write.parquet(str(tmp_path / "in"))
    stream = fs.file_stream(spark, str(tmp_path / "in"), odd.schema)
    windows = ss.vehicle_windows(stream, "vin", "ts", "5 minutes", "10 seconds", wn.vehicle_items("sensors", "lights"))
    assert "TransformWithState" not in windows._jdf.queryExecution().toString()
    with ss.state_on_disk(spark):
        run.finish(run.to_files(windows, str(tmp_path / "out"), str(tmp_path / "cp")))
    told = lambda df: sorted((str(r["vin"]), str(r["window_end"]), str(r["max_timestamp"]), sorted(r["sensor_average"].items()), r["warning_count"]) for r in df.collect())
    want = wn.vehicle_windows(odd.union(many), "vin", "ts", "5 minutes", "sensors", "lights")
    assert told(spark.read.schema(windows.schema).parquet(str(tmp_path / "out"))) == told(want)


def test_upsert_writer_on_a_stream(spark, tmp_path):
    schema, path = StructType.fromDDL("k int, v int"), str(tmp_path / "t")
    write = dm.upsert_writer(path, ["k"], ["i"], schema, "op")
    stream = feed(spark, tmp_path / "in", [[(1, 1, 1, "I"), (1, 2, 2, "U"), (2, 5, 3, "I")], [(2, 6, 4, "DELETE"), (3, 7, 5, None)]],
                  "k int, v int, i int, op string")
    run.finish(run.per_batch(stream, str(tmp_path / "cp"), write))
    write(spark.createDataFrame([(9, 9, 9, "I")], "k int, v int, i int, op string"), 0)  # batch 0 again
    assert sorted(map(tuple, dm.read_upserted(spark, path, schema, ["k"]).collect())) == [(1, 2), (3, 7)]


def test_database_batches_count_once(spark, tmp_path):
    """A batch dies between its slices and is played again, and an old one after a newer one: all totals hold."""
    path, flag = str(tmp_path / "db.sqlite"), str(tmp_path / "broken")
    with sqlite3.connect(path) as con:
        con.execute("CREATE TABLE totals (symbol TEXT PRIMARY KEY, price REAL, n INTEGER)")
        con.execute("CREATE TABLE ledger (batch_id INTEGER, slice INTEGER, slices INTEGER, PRIMARY KEY (batch_id, slice))")

    class Breaking:
        """A connection whose commits fail while the flag file is there, but for the first few."""

        def __init__(self):
            self.real = sqlite3.connect(path, timeout=60)

        def __getattr__(self, name):
            return getattr(self.real, name)

        def commit(self):
            if os.path.exists(flag) and self.real.execute("SELECT count(*) FROM ledger WHERE batch_id = 1").fetchone()[0] > 3:
                raise OSError("connection lost")
            self.real.commit()

    write = sn.once_into_database(Breaking, "totals", ["symbol"], ["i"], ["symbol", "price", "n"], "ledger", add=("n",), slices=8)
    batch = lambda price: spark.createDataFrame([(f"s{i % 20}", price + i, 1, i) for i in range(100)], "symbol string, price double, n int, i int")
    write(batch(0.0), 0)
    open(flag, "w").close()
    with pytest.raises(Exception, match="connection lost"):
        write(batch(1000.0), 1)
    with sqlite3.connect(path) as con:
        assert 0 < con.execute("SELECT count(*) FROM ledger WHERE batch_id = 1").fetchone()[0] < 8
    os.unlink(flag)
    write(batch(1000.0), 1)
    write(batch(0.0), 0)
    with sqlite3.connect(path) as con:
        assert con.execute("SELECT * FROM totals ORDER BY 1").fetchall() == sorted((f"s{i}", 1080.0 + i, 10) for i in range(20))
        assert con.execute("SELECT count(*) FROM ledger").fetchone()[0] == 16
    with pytest.raises(Exception, match="slices"):
        sn.once_into_database(Breaking, "totals", ["symbol"], ["i"], ["symbol", "price", "n"], "ledger", slices=4)(batch(0.0), 0)
