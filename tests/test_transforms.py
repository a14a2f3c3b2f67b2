from __future__ import annotations

import datetime as dt
import random
import struct
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tarn.functions import transforms as tr, zorder as zo
from tarn.functions.murmur import hash_bytes, preimage_of_zero


def plain_murmur3(data: bytes, seed: int = 0) -> int:
    """The published algorithm, byte by byte."""
    mask, h = 0xFFFFFFFF, seed
    rot = lambda x, r: ((x << r) | (x >> (32 - r))) & mask
    full = len(data) // 4 * 4
    for i in range(0, full, 4):
        k = rot(int.from_bytes(data[i:i + 4], "little") * 0xCC9E2D51 & mask, 15) * 0x1B873593 & mask
        h = (rot(h ^ k, 13) * 5 + 0xE6546B64) & mask
    if data[full:]:
        h ^= rot(int.from_bytes(data[full:], "little") * 0xCC9E2D51 & mask, 15) * 0x1B873593 & mask
    h ^= len(data)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        h = (h ^ (h >> shift)) * factor & mask
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


def test_hash_of_byte_strings(spark):
    rng = random.Random(1)
    values = [None, b"", *[rng.randbytes(n) for n in range(1, 70)], *[rng.randbytes(rng.randrange(3000)) for _ in range(40)], b"\xff" * 7]
    df = spark.createDataFrame([(i, None if v is None else bytearray(v)) for i, v in enumerate(values)], "i int, v binary")
    got = dict(df.select("i", hash_bytes(F.col("v"))).collect())
    assert got == {i: None if v is None else plain_murmur3(v) for i, v in enumerate(values)}


def test_zero_seed_trick():
    x = preimage_of_zero(42)
    assert plain_murmur3(struct.pack("<i", x), 42) == 0


def test_bucket_vectors(spark):
    one = spark.range(1)
    assert one.select(tr.bucket(128, F.lit("abc"), "string")).first()[0] == 122
    assert one.select(tr.bucket(100, F.lit(34), "int")).first()[0] == 79
    assert one.select(tr.bucket(100, F.lit(34), "bigint")).first()[0] == 79
    assert one.select(tr.bucket(16, F.lit(None).cast("int"), "int")).first()[0] is None
    assert one.select(tr.bucket(16, F.lit(None).cast("string"), "string")).first()[0] is None


@pytest.mark.parametrize("kind,value,raw", [
    ("bigint", -7_000_000_000, struct.pack("<q", -7_000_000_000)),
    ("int", -5, struct.pack("<q", -5)),
    ("date", dt.date(2017, 11, 16), struct.pack("<q", 17486)),
    ("timestamp_ntz", dt.datetime(2017, 11, 16, 22, 31, 8), struct.pack("<q", 1510871468000000)),
    ("double", 1.5, struct.pack("<d", 1.5)),
    ("double", -0.0, struct.pack("<d", 0.0)),
    ("float", 1.5, struct.pack("<d", 1.5)),
    ("string", "naïve €", "naïve €".encode()),
    ("binary", bytearray(b"\x00\x01\x02\x03"), b"\x00\x01\x02\x03"),
    ("decimal(9,2)", Decimal("14.20"), (1420).to_bytes(2, "big")),
    ("decimal(9,2)", Decimal("-1.28"), b"\x80"),
    ("decimal(9,2)", Decimal("0.00"), b"\x00"),
    ("decimal(9,2)", Decimal("1.28"), b"\x00\x80"),
    ("decimal(9,2)", Decimal("-0.01"), b"\xff"),
    ("decimal(9,2)", Decimal("-1.29"), b"\xff\x7f"),
    ("decimal(18,0)", Decimal(-(10**17)), (-(10**17)).to_bytes(8, "big", signed=True)),
    ("decimal(38,3)", Decimal("123456789012345678901234.567"), (123456789012345678901234567).to_bytes(11, "big")),
    ("decimal(38,3)", Decimal("-0.128"), b"\x80"),
])
def test_bucket_hash_bytes(spark, kind, value, raw):
    df = spark.createDataFrame([(value,), (None,)], f"v {kind}")
    got = [r[0] for r in df.select(tr.bucket_hash(F.col("v"), kind)).collect()]
    assert got == [plain_murmur3(raw), None]


def test_truncate(spark):
    values = [(v,) for v in (0, 1, 5, 9, 10, 11, -1, -5, -10, -11, 255, None)]
    df = spark.createDataFrame(values, "v int")
    got = [r[0] for r in df.select(tr.truncate(10, F.col("v"), "int")).collect()]
    assert got == [0, 0, 0, 0, 10, 10, -10, -10, -10, -20, 250, None]
    d = spark.createDataFrame([(Decimal("12.34"),), (Decimal("0.05"),), (Decimal("-0.05"),)], "v decimal(9,2)")
    assert [r[0] for r in d.select(tr.truncate(10, F.col("v"), "decimal(9,2)")).collect()] == [Decimal("12.30"), Decimal("0.00"), Decimal("-0.10")]
    s = spark.createDataFrame([("abcdefg",), ("ab",), ("😀é😀x",), (None,)], "v string")
    assert [r[0] for r in s.select(tr.truncate(3, F.col("v"), "string")).collect()] == ["abc", "ab", "😀é😀", None]
    b = spark.createDataFrame([(bytearray(b"abcdef"),)], "v binary")
    assert bytes(b.select(tr.truncate(2, F.col("v"), "binary")).first()[0]) == b"ab"


def test_times_before_epoch(spark):
    df = spark.createDataFrame([(dt.datetime(1969, 12, 31, 23, 59, 59, 999999),), (dt.datetime(2017, 11, 16, 22, 31, 8),)], "v timestamp_ntz")
    got = [tuple(r) for r in df.select(tr.years(F.col("v")), tr.months(F.col("v")), tr.days(F.col("v")), tr.hours(F.col("v"))).collect()]
    assert got == [(-1, -1, -1, -1), (47, 574, 17486, 419686)]


def test_human(spark):
    one = spark.range(1)
    got = one.select(tr.human("year", F.lit(47)), tr.human("month", F.lit(574)), tr.human("day", F.lit(17486)),
                     tr.human("hour", F.lit(419686)), tr.human("month", F.lit(-1)), tr.human("hour", F.lit(-1))).first()
    assert tuple(got) == ("2017", "2017-11", "2017-11-16", "2017-11-16-22", "1969-12", "1969-12-31-23")


FIELDS = [tr.PartitionField("v", "identity"), tr.PartitionField("v", "truncate", 7), tr.PartitionField("v", "bucket", 5)]


@pytest.mark.parametrize("field", FIELDS, ids=lambda f: f.transform)
@pytest.mark.parametrize("op", ["<", "<=", ">", ">=", "=", "!="])
def test_projection_bounds(spark, field, op):
    """Inclusive projection keeps every match, strict projection admits nothing else."""
    df = spark.range(-30, 31).withColumnRenamed("id", "v").withColumn("p", field.value(F.col("v")))
    for value in (-14, -8, 0, 3, 7, 13):
        row = {"<": F.col("v") < value, "<=": F.col("v") <= value, ">": F.col("v") > value, ">=": F.col("v") >= value,
               "=": F.col("v") == value, "!=": F.col("v") != value}[op]
        inclusive = tr.project_inclusive(field, op, value, F.col("p"))
        strict = tr.project_strict(field, op, value, F.col("p"))
        wrong = df.where((row & ~inclusive) | (strict & ~row))
        assert wrong.count() == 0, (value, wrong.collect()[:3])


def test_projection_formulas(spark):
    field = tr.PartitionField("v", "truncate", 10)
    df = spark.range(-20, 41).select((F.col("id") - F.pmod("id", F.lit(10))).alias("p")).distinct()
    kept = lambda c: sorted(r[0] for r in df.where(c).collect())
    part = F.col("p")
    assert kept(tr.project_inclusive(field, "<", 20, part)) == [-20, -10, 0, 10]
    assert kept(tr.project_inclusive(field, "<=", 20, part)) == [-20, -10, 0, 10, 20]
    assert kept(tr.project_inclusive(field, ">", 19, part)) == [20, 30, 40]
    assert kept(tr.project_strict(field, "<=", 19, part)) == [-20, -10, 0, 10]
    assert kept(tr.project_strict(field, ">=", 20, part)) == [20, 30, 40]


def test_projection_of_times(spark):
    field = tr.PartitionField("v", "day", data_type="timestamp_ntz")
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, id) AS v FROM range(96)").withColumn("p", field.value(F.col("v")))
    edge = F.lit("2024-01-03").cast("timestamp_ntz")
    assert df.where(tr.project_inclusive(field, "<", edge, F.col("p"))).count() == 48
    assert df.where(tr.project_strict(field, ">=", edge, F.col("p"))).count() == 48


def test_satisfies():
    day, month = tr.PartitionField("t", "day"), tr.PartitionField("t", "month")
    assert day.satisfies(month) and not month.satisfies(day)
    assert tr.PartitionField("t").satisfies(day)
    assert not tr.PartitionField("u", "day").satisfies(month)


def spread_bits(codes: list[int], width: int) -> int:
    out, k = 0, len(codes)
    for i in range(width):
        for j, c in enumerate(codes):
            out |= ((c >> i) & 1) << (i * k + (k - 1 - j))
    return out


def test_zorder_keys(spark):
    values = [(-(1 << 62), 3.5, "b"), (-1, -0.0, "a"), (0, 0.0, "abc"), (7, -2.25, ""), (None, 1e300, "zzzzzzzzzz")]
    df = spark.createDataFrame(values, "a bigint, b double, c string")
    for name, kind in (("a", "bigint"), ("b", "double"), ("c", "string")):
        by_code = [r[0] for r in df.orderBy(zo.ordered_code(F.col(name), kind)).select(name).collect()]
        present = [v for v in by_code if v is not None]
        assert present == sorted(present)
    keys = df.select("a", zo.zorder_key([(F.col("a"), "bigint"), (F.col("b"), "double")]).alias("z")).collect()
    bits = lambda d: struct.unpack(">Q", struct.pack(">d", d))[0]
    code = lambda d: (bits(d) ^ 0xFFFFFFFFFFFFFFFF) if bits(d) >> 63 else bits(d) ^ (1 << 63)
    for (a, b, _), row in zip(values, keys):
        x = 0 if a is None else (a + (1 << 63))
        assert int.from_bytes(row["z"], "big") == spread_bits([x, code(b + 0.0)], 64)


@pytest.mark.parametrize("low,high", [(0, 1000), (-500, 500), (-(1 << 63), (1 << 63) - 1), (1 << 40, (1 << 40) + 70000), (5, 5)])
def test_clustering_columns_order_like_full_keys(spark, low, high):
    rng = random.Random(2)
    rows = [(rng.randint(low, high), rng.randint(low // 2, high), rng.randint(low, high)) for _ in range(200)]
    df = spark.createDataFrame(rows, "a bigint, b bigint, c bigint")
    pairs = [(F.col(n), "bigint") for n in "abc"]
    by_key = [r["z"] for r in df.orderBy(*zo.clustering_columns(df, pairs)).select(zo.zorder_key(pairs).alias("z")).collect()]
    assert by_key == sorted(by_key)


def test_zorder_of_wide_strings_and_decimals(spark):
    texts = ["aaaaaaaab", "aaaaaaaac", "aaaaaaaa", "aaaaaaaabz", "aaaaaaaab" + "z" * 20, "", "b", None]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(texts)], "s string, n int")
    one = [(F.col("s"), "string")]
    keys = {r["s"]: bytes(r["z"]) for r in df.select("s", zo.zorder_key(one, 16).alias("z")).collect()}
    assert keys["aaaaaaaab"] == b"aaaaaaaab".ljust(16, b"\0") and keys["aaaaaaaab"] < keys["aaaaaaaabz"] < keys["aaaaaaaac"]
    pairs = [*one, (F.col("n"), "int")]
    by_key = [bytes(r["z"]) for r in df.orderBy(*zo.clustering_columns(df, pairs, 16)).select(zo.zorder_key(pairs, 16).alias("z")).collect()]
    assert by_key == sorted(by_key)
    with pytest.raises(ValueError):
        zo.ordered_code(F.col("s"), "string", 16)
    close = spark.sql("SELECT CAST(v AS decimal(18,2)) AS d FROM VALUES ('9007199254740993.01'), ('9007199254740993.00'), ('-0.01'), (NULL) t(v)")
    codes = [r[0] for r in close.select(zo.ordered_code(F.col("d"), "decimal(18,2)")).collect()]
    assert codes == [900719925474099301, 900719925474099300, -1, None]


def test_small_zorder(spark):
    df = spark.range(64).select((F.col("id") % 8).alias("a"), (F.col("id") / 8).cast("int").alias("b"))
    for a, b, z in df.select("a", "b", zo.small_zorder_key([F.col("a"), F.col("b")], 3).alias("z")).collect():
        assert z == spread_bits([a, b], 3)


def test_sql_functions(spark):
    tr.register_sql_functions(spark)
    row = spark.sql("SELECT tarn_bucket(100, 34L), tarn_truncate(10, -1L), tarn_months(timestamp_ntz'2017-11-16 22:31:08')").first()
    assert tuple(row) == (79, -10, 574)


@pytest.mark.parametrize("width", [1, 2, 3])
@pytest.mark.parametrize("prefix", ["a", "ab", "abc", "b"])
@pytest.mark.parametrize("op", ["starts_with", "not_starts_with"])
def test_prefix_projection(spark, width, prefix, op):
    field = tr.PartitionField("v", "truncate", width, "string")
    df = spark.createDataFrame([(v,) for v in ("a", "ab", "abc", "abcd", "b", "ba", "ac", "")], "v string").withColumn("p", field.value(F.col("v")))
    row = F.col("v").startswith(prefix) if op == "starts_with" else ~F.col("v").startswith(prefix)
    inclusive, strict = tr.project_inclusive(field, op, prefix, F.col("p")), tr.project_strict(field, op, prefix, F.col("p"))
    assert df.where((row & ~inclusive) | (strict & ~row)).count() == 0


def test_sql_buckets_equal_the_columns(spark):
    """Every length of tail, empty and null values, and numbers around the sign bits."""
    import uuid
    tr.register_sql_functions(spark)
    texts = [None, "", "a", "ab", "abc", "abcd", "abcde", "é", "thirteen char", "x" * 1001]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("b", F.col("t").cast("binary"))
    for r in df.select(tr.bucket(1000, F.col("t"), "string").alias("c"), F.expr("tarn_bucket_string(1000, t)").alias("s"),
                       F.expr("tarn_bucket_binary(1000, b)").alias("x")).collect():
        assert r["c"] == r["s"] == r["x"]
    numbers = [None, 0, 1, -1, 127, 128, -128, -129, 255, 256, 32767, 32768, -32768, -32769, 10 ** 15, -10 ** 15, 1420]
    df = spark.createDataFrame([(n,) for n in numbers], "n bigint").withColumn("d", F.col("n").cast("decimal(18,0)"))
    for r in df.select("n", tr.bucket(1000, F.col("d"), "decimal(18,0)").alias("c"), F.expr("tarn_bucket_decimal(1000, n)").alias("s")).collect():
        assert r["c"] == r["s"], r
    one = spark.createDataFrame([(str(uuid.UUID("f79c3e09-677c-4bbd-a479-3f349cb785e7")),), (None,)], "u string")
    got = one.select(tr.bucket_hash(F.col("u"), "uuid").alias("h"), tr.bucket(100, F.col("u"), "uuid").alias("c"),
                     F.expr("tarn_bucket_uuid(100, u)").alias("s")).collect()
    assert [r["h"] for r in got] == [1488055340, None] and [r["c"] for r in got] == [r["s"] for r in got] == [1488055340 % 100, None]
