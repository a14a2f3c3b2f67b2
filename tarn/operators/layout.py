"""Sort orders, write distribution, clustering and skew-aware routing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tarn.functions.transforms import PartitionField
from tarn.functions.zorder import clustering_columns
from tarn.operators.windows import running
from tarn.util import int_div, small_side, tie_breaker

#: Rows that a task sorts at most, about; of narrow rows some 200 MB.
SORTED_ROWS = 2_000_000
#: Positions of a file that are put in order together to see whether they are.
STRETCH = 1 << 16


@dataclass(frozen=True)
class SortTerm:
    """One term of a sort order; NULLs come first when ascending and last when descending unless said otherwise."""

    source: str
    ascending: bool = True
    nulls: str | None = None
    transform: str = "identity"
    arg: int | None = None
    data_type: str = "bigint"

    @property
    def field(self) -> PartitionField:
        return PartitionField(self.source, self.transform, self.arg, self.data_type)

    def column(self) -> Column:
        value = self.field.value(F.col(self.source))
        first = (self.nulls or ("first" if self.ascending else "last")) == "first"
        if self.ascending:
            return value.asc_nulls_first() if first else value.asc_nulls_last()
        return value.desc_nulls_first() if first else value.desc_nulls_last()


def sort_columns(terms: list[SortTerm]) -> list[Column]:
    return [term.column() for term in terms]


def write_order(spec: list[PartitionField], order: list[SortTerm]) -> list[SortTerm]:
    """Sort order to write with: partition fields the order's prefix does not already cluster, then the order."""
    missing = []
    for field in spec:
        if field.transform == "void":
            continue
        if not any(term.field.satisfies(field) for term in order[: len(spec)]):
            missing.append(SortTerm(field.source, transform=field.transform, arg=field.arg, data_type=field.data_type))
    return missing + list(order)


def distribute(df: DataFrame, mode: str = "none", spec: list[PartitionField] | None = None,
               order: list[SortTerm] | None = None, writers: int | None = None) -> DataFrame:
    """Shuffle rows for writing: not at all, by hash of the partition, or by range of the sort order.

    Hash distribution keeps a partition's rows together but is a rebalancing
    one: adaptive execution splits a partition far larger than the others over
    several writers.  Range distribution ends in a hash of the row, so rows that
    share one sort value are split too.
    """
    terms = sort_columns(order) if order else []
    if mode == "none":
        return df.sortWithinPartitions(*terms) if terms else df
    if mode == "hash":
        keys = {f"_p{i}": f.value(F.col(f.source)) for i, f in enumerate(spec)}
        out = df.withColumns(keys).hint("rebalance", *([writers] if writers else []), *keys)
        return out.sortWithinPartitions(*(terms or keys)).drop(*keys)
    if mode == "range":
        bounds = [*terms, tie_breaker(df)]
        out = df.repartitionByRange(writers, *bounds) if writers else df.repartitionByRange(*bounds)
        return out.sortWithinPartitions(*terms)
    raise ValueError(f"unknown distribution {mode}")


def clustering(stored: DataFrame, keys: list[Column], file: str = "_file", pos: str = "_pos") -> DataFrame:
    """How well stored files are sorted: per file its rows, its bounds of the (ascending) keys, whether its rows are in order, and whether no
    other file begins before it ends.

    Rows are compared inside stretches of ``STRETCH`` positions, then stretches inside their file and files, a row each, among each
    other: no task orders the rows of a whole file.
    """
    found = stored.groupBy(F.col(file).alias("_name")).agg((F.max(pos) + 1).alias("_size"))
    files = small_side(found.withColumn("_no", F.monotonically_increasing_id()))  # a number is narrower than a path
    total = files.agg(F.sum("_size")).first()[0] or 0
    k = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(keys)])
    rows = (stored.select(F.col(file).alias("_name"), F.col(pos).alias("_at"), k.alias("_k")).join(files, "_name")
            .select("_no", int_div(F.col("_at"), STRETCH).alias("_stretch"), "_at", "_k")
            .repartition(1 + total // SORTED_ROWS, "_no", "_stretch"))
    in_turn = lambda value, before: F.bool_and(F.coalesce(F.col(before) <= F.col(value), F.lit(True)))
    before = F.lag("_k").over(Window.partitionBy("_no", "_stretch").orderBy("_at"))
    stretches = rows.withColumn("_before", before).groupBy("_no", "_stretch").agg(
        F.count("*").alias("rows"), F.min("_k").alias("lower"), F.max("_k").alias("upper"), in_turn("_k", "_before").alias("in_order"),
        F.min_by("_k", "_at").alias("_first"), F.max_by("_k", "_at").alias("_last"))
    last = F.lag("_last").over(Window.partitionBy("_no").orderBy("_stretch"))
    per_file = stretches.withColumn("_last", last).groupBy("_no").agg(
        F.sum("rows").alias("rows"), F.min("lower").alias("lower"), F.max("upper").alias("upper"),
        (F.bool_and("in_order") & in_turn("_first", "_last")).alias("in_order"))
    following = F.lead("lower").over(Window.orderBy("lower", "upper"))
    apart = per_file.withColumn("apart", F.coalesce(F.col("upper") <= following, F.lit(True)))
    return apart.join(files, "_no").select(F.col("_name").alias(file), "rows", "lower", "upper", "in_order", "apart")


def with_places(df: DataFrame, order: list[Column], path: str, name: str = "place") -> DataFrame:
    """Rows with their place, from 1, in a sort by ``order`` (whose terms must not tie): no task orders all rows.

    Rows are dealt in ranges and stored under ``path``, each with its range; a
    place is the rows in the ranges before it, a row per range, plus the number in its own.
    """
    df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    dealt = df.sparkSession.read.parquet(path)
    counts = dealt.groupBy("_range").agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_range")) - F.col("_rows")
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return (dealt.join(counts.select("_range", before.alias("_before")), "_range")
            .withColumn(name, (F.col("_before") + own).cast("bigint")).drop("_range", "_before"))


def distribute_by_key(df: DataFrame, keys: list[str], writers: int) -> DataFrame:
    """Rows of an equality key together on one writer, as upserts need; a key with over half a writer's rows is spread.

    Heavy keys are found by a sketch of the key hashes, and get writers by
    their weight; their rows must then be reduced to one per key where they are
    written, as every upsert does before.
    """
    named = df.withColumn("_key", F.xxhash64(*keys))
    heavy, total = heavy_keys(key_sketches(named, "_key", writers), writers)
    routed = sketched_writer(named, "_key", heavy, total, writers, tie_breaker(df))
    return routed.repartitionById(writers, "_writer").drop("_key", "_writer")


def zorder_layout(df: DataFrame, columns: list[tuple[str, str]], writers: int, partition: list[str] = (),
                  string_width: int = 8) -> DataFrame:
    """Rows clustered along the z-order curve of (column, type) pairs; identity partition columns are left out of it."""
    used = [(F.col(c), t) for c, t in columns if c not in partition]
    if not used:
        raise ValueError("no column left to cluster by")
    keys = {f"_z{i}": c for i, c in enumerate(clustering_columns(df, used, string_width))}
    order = [*partition, *keys]
    spread = df.withColumns(keys).repartitionByRange(writers, *order, tie_breaker(df))
    return spread.sortWithinPartitions(*order).drop(*keys)


def bucket_writer(bucket: Column, buckets: int, writers: int, spread: Column) -> Column:
    """Writer of a bucketed row.

    With no more writers than buckets, bucket modulo writers.  With more, each
    bucket has the writers bucket, bucket + buckets, ... and its rows rotate
    over them by ``spread`` (a hash or counter of the row).
    """
    if writers <= buckets:
        return (bucket % writers).cast("int")
    own = F.lit(writers // buckets) + F.when(bucket < writers % buckets, 1).otherwise(0)
    return (bucket + F.lit(buckets) * F.pmod(spread, own)).cast("int")


def route_to_writers(df: DataFrame, writer: Column, writers: int) -> DataFrame:
    """Rows on the writer their id says, unchanged by adaptive execution."""
    return df.withColumn("_writer", writer.cast("int")).repartitionById(writers, "_writer").drop("_writer")


def key_weights(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("weight"))


def assign_writers(weights: DataFrame, key: str, chunk: Column, writers: int, close_cost_percent: float = 0.0) -> DataFrame:
    """Writer range of each key: keys in order share the writers by weight, a heavy key spans several.

    Each file a key is split into costs an extra share of a writer's target.
    Adds the key's place ``_from``..``_to`` on the line of all weights and the
    length ``_span`` of a writer on it.  ``chunk`` must grow with the key.
    """
    even = weights.agg(F.sum("weight") / writers).scalar()
    cost = F.ceil(F.col("_even") * close_cost_percent / 100)
    padded = (weights.withColumn("_even", even)
              .withColumn("_padded", F.col("weight") + cost * F.ceil(F.col("weight") / F.col("_even"))).drop("_even"))
    placed = running(padded, [], [key], chunk, F.col("_padded"), "_to")
    span = padded.agg(F.ceil(F.sum("_padded") / writers)).scalar()
    ranged = placed.withColumns({"_from": F.col("_to") - F.col("_padded"), "_span": span})
    return ranged.withColumns({"first_writer": int_div(F.col("_from"), F.col("_span")).cast("int"),
                               "last_writer": int_div(F.col("_to") - 1, F.col("_span")).cast("int")})


def skew_aware_writer(df: DataFrame, key: str, assignment: DataFrame, writers: int, spread: Column) -> DataFrame:
    """Rows with ``_writer``: a point in the key's weight range picks the writer; unknown keys go anywhere."""
    ranges = assignment.select(key, "_from", "_padded", "_span")
    point = F.col("_from") + F.pmod(spread, F.col("_padded"))
    writer = F.coalesce(int_div(point, F.col("_span")), F.pmod(spread, F.lit(writers))).cast("int")
    return df.join(ranges, key, "left").withColumn("_writer", writer).drop("_from", "_padded", "_span")


def key_sketches(df: DataFrame, key: str, writers: int, by: list[str] = ()) -> DataFrame:
    """Heavy-hitter sketches of a key, one per group (a file, a commit, a batch): (by..., keys, rows).

    They have a fixed size, however many keys there are, and merge, so a table
    can keep them with its files.  A count is too high by less than a tenth of
    the weight that makes a key heavy.
    """
    sketch = F.call_function("approx_top_k_accumulate", F.col(key), F.lit(_tracked(writers)))
    return df.groupBy(*by).agg(sketch.alias("keys"), F.count("*").alias("rows"))


def _tracked(writers: int) -> int:
    return max(4096, 128 * writers)


def heavy_keys(sketches: DataFrame, writers: int) -> tuple[list[tuple], int]:
    """((key, rows) of the keys that hold half a writer's share or more, number of all rows): 2 * writers keys at most."""
    merged = sketches.agg(F.call_function("approx_top_k_combine", F.col("keys"), F.lit(_tracked(writers))).alias("keys"), F.sum("rows").alias("rows"))
    found = merged.select(F.call_function("approx_top_k_estimate", F.col("keys"), F.lit(4 * writers)).alias("top"), "rows").first()
    total = found["rows"] or 0
    return [(t["item"], t["count"]) for t in found["top"] or [] if 2 * writers * t["count"] >= total > 0], total


def sketched_writer(df: DataFrame, key: str, heavy: list[tuple], total: int, writers: int, spread: Column) -> DataFrame:
    """Rows with ``_writer``: heavy keys share the first writers by weight, every other key goes whole to one of the rest.

    All rows lie on a line, the heavy keys' first; a writer takes a stretch of
    equal length.  Only the heavy keys are joined, so this needs no row per key.
    """
    places, upto = [], 0
    for value, weight in sorted(heavy, key=lambda h: (-h[1], str(h[0]))):
        places.append((value, upto, weight))
        upto += weight
    length = max(total, upto, 1)
    light = max(length - upto, 1)
    schema = StructType([StructField("_heavy", df.schema[key].dataType), StructField("_from", LongType()), StructField("_weight", LongType())])
    listed = F.broadcast(df.sparkSession.createDataFrame(places, schema))  # 2 * writers rows at most
    own = F.col("_from") + F.pmod(spread, F.col("_weight"))
    other = F.lit(upto).cast("bigint") + F.pmod(F.xxhash64(F.col(key)), F.lit(light).cast("bigint"))
    point = F.least(F.coalesce(own, other), F.lit(length - 1))
    return (df.join(listed, F.col(key).eqNullSafe(F.col("_heavy")), "left")
            .withColumn("_writer", F.floor(point * writers / length).cast("int")).drop("_heavy", "_from", "_weight"))


#: Items of a quantile sketch; bounds are wrong by about 0.3 % of all rows at most.
QUANTILE_ITEMS = 1000


def range_sketches(df: DataFrame, column: str, by: list[str] = ()) -> DataFrame:
    """Quantile sketches of a numeric column, one per group: (by..., values).  They have a fixed size and merge."""
    return df.groupBy(*by).agg(F.kll_sketch_agg_double(F.col(column).cast("double"), F.lit(QUANTILE_ITEMS)).alias("values"))


def range_bounds(sketches: DataFrame, partitions: int) -> DataFrame:
    """Upper bounds of ranges of equal weight from merged sketches, as (range, bound) rows."""
    shares = F.array(*[F.lit(i / partitions) for i in range(1, partitions)])
    merged = sketches.agg(F.kll_merge_agg_double("values").alias("values"))
    return merged.select(F.posexplode(F.kll_sketch_get_quantile_double("values", shares)).alias("range", "bound"))
