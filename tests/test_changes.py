from __future__ import annotations

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarn.operators import cdc, changes as ch, schemas as sm

DDL = "id int, name string, _change_type string, _change_ordinal int, _commit_snapshot_id bigint"


def change(kind, ordinal, i=1, name="a"):
    return (i, name, kind, ordinal, ordinal + 100)


def test_carryover_vector(spark, rows):
    df = spark.createDataFrame([change("DELETE", 0), change("INSERT", 0), change("DELETE", 0, 2, "b")], DDL)
    assert rows(ch.remove_carryovers(df)) == [change("DELETE", 0, 2, "b")]


def test_update_vector(spark, rows):
    df = spark.createDataFrame([change("DELETE", 0), change("INSERT", 0, 1, "b")], DDL)
    assert rows(ch.compute_updates(df, ["id"])) == [change("UPDATE_BEFORE", 0), change("UPDATE_AFTER", 0, 1, "b")]


def test_carryover_keeps_null_rows_equal(spark, rows):
    df = spark.createDataFrame([(1, None, "DELETE", 0, 100), (1, None, "INSERT", 0, 100), (2, None, "INSERT", 0, 100)], DDL)
    assert rows(ch.remove_carryovers(df)) == [(2, None, "INSERT", 0, 100)]


def walk_net(items):
    """Cancel neighbours one by one, as an ordered pass over the changes of one row does."""
    first, count = None, 0
    for item in items:
        if count == 0:
            first, count = item, 1
        elif first[2] == item[2]:
            count += 1
        else:
            count -= 1
    return [first] * count


def test_net_changes_match_a_walk(spark):
    rng = random.Random(5)
    data = []
    for i in range(60):
        data += [change(rng.choice(["INSERT", "DELETE"]), rng.randrange(5), i % 12, rng.choice(["x", None])) for _ in range(rng.randrange(1, 9))]
    rng.shuffle(data)
    want = Counter()
    key = lambda r: (r[0], r[1] or "")
    for _, group in itertools.groupby(sorted(data, key=key), key):
        want.update(walk_net(sorted(group, key=lambda r: (r[3], r[2]))))
    got = Counter(tuple(r) for r in ch.net_changes(spark.createDataFrame(data, DDL)).collect())
    assert got == want


@pytest.mark.parametrize("order", list(itertools.permutations(range(4)))[::5])
def test_updates_do_not_depend_on_input_order(spark, rows, order):
    base = [change("DELETE", 0), change("INSERT", 0, 1, "b"), change("INSERT", 1, 2, "c"), change("DELETE", 2, 2, "c")]
    got = rows(ch.compute_updates(spark.createDataFrame([base[i] for i in order], DDL), ["id"]))
    assert Counter(r[2] for r in got) == Counter(UPDATE_BEFORE=1, UPDATE_AFTER=1, INSERT=1, DELETE=1)


def test_duplicate_identifier_is_an_error(spark):
    df = spark.createDataFrame([change("INSERT", 0), change("INSERT", 0, 1, "b")], DDL)
    with pytest.raises(Exception, match="identifier columns"):
        ch.compute_updates(df, ["id"]).collect()


def test_changelog_options(spark):
    df = spark.createDataFrame([change("INSERT", 0)], DDL)
    with pytest.raises(ValueError):
        ch.changelog_view(df, updates=True)
    with pytest.raises(ValueError):
        ch.changelog_view(df, identifiers=["id"], net=True)
    assert ch.changelog_view(df, net=True).count() == 1


def test_many_copies_are_spread(spark, monkeypatch):
    monkeypatch.setattr(ch, "COPIES_PER_ROW", 10)
    df = spark.createDataFrame([("a", 3), ("b", 47), ("c", 0)], "k string, n bigint")
    out = ch.repeat_rows(df, "n")
    assert {r["k"]: r["count"] for r in out.groupBy("k").count().collect()} == {"a": 3, "b": 47}
    tasks = out.where("k = 'b'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 1


def test_diff_versions(spark, rows):
    old = spark.createDataFrame([(1,), (1,), (2,)], "v int")
    new = spark.createDataFrame([(1,), (3,), (3,)], "v int")
    assert rows(ch.diff_versions(old, new)) == [(1, "DELETE"), (2, "DELETE"), (3, "INSERT"), (3, "INSERT")]


def test_upsert_null_key(spark, rows):
    target = spark.createDataFrame([(None, "old"), (1, "old"), (2, "old")], "k int, v string")
    source = spark.createDataFrame([(None, "new", 1), (1, "a", 1), (1, "b", 2)], "k int, v string, seq int")
    assert rows(ch.upsert(target, source, ["k"], ["seq"])) == [(None, "new"), (1, "b"), (2, "old")]


def test_apply_cdc(spark, rows):
    target = spark.createDataFrame([(1, "x"), (2, "x"), (3, "x")], "k int, v string")
    feed = spark.createDataFrame([(1, "n", 1, "U"), (1, "n", 2, "D"), (2, "b", 1, "UB"), (2, "a", 2, "UA"), (4, "i", 1, "I")], "k int, v string, seq int, op string")
    assert rows(ch.apply_cdc(target, feed, ["k"], ["seq"], "op")) == [(2, "a"), (3, "x"), (4, "i")]


def test_document_without_images_is_an_error(spark):
    df = spark.createDataFrame([("1", None, None, None, None)], "id string, b map<string,string>, a map<string,string>, u map<string,string>, r array<string>")
    with pytest.raises(Exception, match="without any image"):
        cdc.document_after(df, "b", "a", "u", "r", "id").collect()


def test_target_names(spark):
    one = spark.range(1)
    db, table = F.lit("shop"), F.lit("orders")
    assert one.select(cdc.target_name("", db, table)).first()[0] == "shop.orders"
    assert one.select(cdc.target_name("lake.{db}_{table}_x", db, table)).first()[0] == "lake.shop_orders_x"


def test_nested_metadata(spark):
    df = spark.createDataFrame([(1, "t", 0, 5, None)], "v int, topic string, partition int, offset bigint, timestamp timestamp")
    assert cdc.attach_metadata(df, nested=True).first()["_kafka_metadata"]["offset"] == 5


def test_evolve_schema():
    current = StructType.fromDDL("a int not null, b float, c string, s struct<x:int>")
    incoming = StructType.fromDDL("a bigint not null, b double, s struct<x:bigint,y:string>, d date not null")
    out = sm.evolve_schema(current, incoming)
    assert out.simpleString() == "struct<a:bigint,b:double,c:string,s:struct<x:bigint,y:string>,d:date>"
    assert not out["a"].nullable and out["c"].nullable and out["d"].nullable
    assert sm.evolve_schema(StructType.fromDDL("a int"), StructType.fromDDL("a string"))["a"].dataType.simpleString() == "int"


def test_write_checks():
    table = StructType.fromDDL("a int not null, b string")
    with pytest.raises(ValueError, match="required"):
        sm.check_write(table, StructType.fromDDL("b string"))
    with pytest.raises(ValueError, match="order"):
        sm.check_write(table, StructType.fromDDL("b string, a int not null"), ordering=True)
