"""Change logs: netting, update images, version differences and applying changes.

Identical rows are netted by counting, not by walking them: one aggregate row
per distinct row (combined on the map side) says how many copies survive, and
only those are written out again.  A row repeated billions of times is one
counter until then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tarn.util import int_div, tie_breaker

CHANGE_TYPE, ORDINAL, SNAPSHOT = "_change_type", "_change_ordinal", "_commit_snapshot_id"
METADATA = (CHANGE_TYPE, ORDINAL, SNAPSHOT)
COPIES_PER_ROW = 100_000


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Each row as often as its count says.

    Counts above a bound are first cut into pieces that are spread over tasks,
    so the copies of one row never come out of a single task.
    """
    n = F.col(times)
    few = df.where((n > 0) & (n <= COPIES_PER_ROW))
    many = df.where(n > COPIES_PER_ROW)
    pieces = (many.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("bigint"), int_div(n - 1, COPIES_PER_ROW))))
              .withColumn(times, F.least(F.lit(COPIES_PER_ROW).cast("bigint"), n - F.col("_piece") * COPIES_PER_ROW)))
    # A fixed number of partitions: adaptive execution would merge these few small rows into one task.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = pieces.repartition(tasks, "_piece", tie_breaker(pieces)).drop("_piece")
    every = few.union(spread)
    return every.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), n))).drop("_copy", times)


def remove_carryovers(changes: DataFrame) -> DataFrame:
    """Within a commit, cancel DELETE and INSERT of the same row pairwise."""
    same = [c for c in changes.columns if c != CHANGE_TYPE]
    sign = F.when(F.col(CHANGE_TYPE) == "INSERT", 1).when(F.col(CHANGE_TYPE) == "DELETE", -1)
    net = changes.groupBy(*same).agg(F.sum(sign).alias("_net")).where("_net <> 0")
    kind = F.when(F.col("_net") > 0, "INSERT").otherwise("DELETE")
    rows = net.withColumns({CHANGE_TYPE: kind, "_times": F.abs("_net")}).drop("_net")
    return repeat_rows(rows, "_times").select(*changes.columns)


def net_changes(changes: DataFrame) -> DataFrame:
    """Net effect of a range: opposite changes of the same row cancel across commits.

    The survivors carry the ordinal and snapshot of the change that opened the
    uncancelled run: the last one, in change order, at which the running balance
    left zero or changed sides.
    """
    data = [c for c in changes.columns if c not in METADATA]
    per_commit = (changes.groupBy(*data, ORDINAL, CHANGE_TYPE)
                  .agg(F.count("*").alias("_n"), F.min(SNAPSHOT).alias(SNAPSHOT))
                  .withColumn("_step", F.when(F.col(CHANGE_TYPE) == "INSERT", F.col("_n")).otherwise(-F.col("_n"))))
    # Grouped to a row per (data row, commit, kind) before this window, so a
    # window partition holds at most two rows per commit of the range.
    walk = Window.partitionBy(*data).orderBy(ORDINAL, CHANGE_TYPE).rowsBetween(Window.unboundedPreceding, 0)
    after = F.sum("_step").over(walk)
    balance = per_commit.withColumn("_after", after).withColumn("_before", F.col("_after") - F.col("_step"))
    opens = (F.col("_before") == 0) | (F.signum("_before") * F.signum("_after") < 0)
    opening = F.max(F.when(opens, F.struct(F.col(ORDINAL).alias("o"), F.col(CHANGE_TYPE).alias("k"), F.col(SNAPSHOT).alias("s"))))
    net = (balance.groupBy(*data).agg(F.sum("_step").alias("_net"), opening.alias("_open")).where("_net <> 0")
           .select(*data, F.when(F.col("_net") > 0, "INSERT").otherwise("DELETE").alias(CHANGE_TYPE),
                   F.col("_open.o").alias(ORDINAL), F.col("_open.s").alias(SNAPSHOT), F.abs("_net").alias("_times")))
    return repeat_rows(net, "_times").select(*changes.columns)


def compute_updates(changes: DataFrame, identifiers: list[str]) -> DataFrame:
    """Relabel DELETE + INSERT of one identifier in one commit as update images.

    Carry-overs go first.  More than one row on a side is an error: the
    identifier does not identify.
    """
    clean = remove_carryovers(changes)
    pair = Window.partitionBy(*identifiers, ORDINAL)
    kind = F.col(CHANGE_TYPE)
    deletes = F.count(F.when(kind == "DELETE", 1)).over(pair)
    inserts = F.count(F.when(kind == "INSERT", 1)).over(pair)
    label = (F.when((deletes > 1) | (inserts > 1),
                    F.raise_error(F.lit("identifier columns match several rows of one commit")).cast("string"))
             .when((deletes == 1) & (inserts == 1) & (kind == "DELETE"), "UPDATE_BEFORE")
             .when((deletes == 1) & (inserts == 1), "UPDATE_AFTER").otherwise(kind))
    return clean.withColumn(CHANGE_TYPE, label)


def changelog_view(changes: DataFrame, name: str | None = None, identifiers: list[str] | None = None,
                   updates: bool | None = None, net: bool = False) -> DataFrame:
    """Cleaned change log, optionally as a temporary view.

    Update images are computed by default when identifiers are given; asking
    for them without identifiers, or together with net changes, is an error.
    """
    with_updates = bool(identifiers) if updates is None else updates
    if with_updates and not identifiers:
        raise ValueError("identifier columns are needed to compute updates")
    if with_updates and net:
        raise ValueError("net changes cannot be combined with update images")
    out = (compute_updates(changes, identifiers) if with_updates
           else net_changes(changes) if net else remove_carryovers(changes))
    if name:
        out.createOrReplaceTempView(name)
    return out


def diff_versions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows to add to and to remove from one version to get the other, with multiplicity."""
    columns = new.columns
    sides = (old.select(*columns).withColumn("_side", F.lit(-1))
             .union(new.select(*columns).withColumn("_side", F.lit(1))))
    net = sides.groupBy(*columns).agg(F.sum("_side").alias("_net")).where("_net <> 0")
    rows = net.withColumns({CHANGE_TYPE: F.when(F.col("_net") > 0, "INSERT").otherwise("DELETE"),
                            "_times": F.abs("_net")}).drop("_net")
    return repeat_rows(rows, "_times")


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row per key; combines on the map side, so hot keys shrink before the shuffle."""
    newest = F.max_by(F.struct(*df.columns), F.struct(*order))
    return df.groupBy(*keys).agg(newest.alias("_row")).select("_row.*")


def upsert(target: DataFrame, source: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Target rows whose key the source does not hold, and the source's last row per key; NULL keys are equal."""
    newest = latest_per_key(source, keys, order)
    return without_keys(target, newest, keys).unionByName(newest.select(*target.columns))


def without_keys(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    held = other.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return df.join(held, on, "left_anti")


def apply_cdc(target: DataFrame, changes: DataFrame, keys: list[str], order: list[str], op: str) -> DataFrame:
    """Target after a change stream: last change per key wins, a delete removes, update-before images are ignored.

    A change without an operation writes its row.
    """
    effective = changes.where(~F.coalesce(F.col(op).isin("UPDATE_BEFORE", "UB"), F.lit(False)))
    newest = latest_per_key(effective, keys, order)
    kept = newest.where(~F.coalesce(F.col(op).isin("DELETE", "D"), F.lit(False)))
    return without_keys(target, newest, keys).unionByName(kept.select(*target.columns))
