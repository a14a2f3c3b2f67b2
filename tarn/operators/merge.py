"""MERGE, UPDATE and DELETE as copy-on-write results or position deletes."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tarn.session import cut_lineage
from tarn.util import listed_only, tie_breaker

#: A target key with this share of all rows, and this many rows, is spread over several tasks.
HOT_SHARE = 0.001
HOT_ROWS = 100_000
SPREAD = 200
#: Items the top-k sketch tracks; its error is far below HOT_SHARE.
TRACKED = 20_000

#: Key columns: one name where both sides call it the same, or (target name, source name).
Keys = list[str | tuple[str, str]]


@dataclass(frozen=True)
class Clause:
    """One WHEN clause: ``update``, ``delete`` or ``insert``, its condition and its assignments.

    Conditions and values address the two sides as ``t.column`` and
    ``s.column``.  An update or insert without assignments takes all columns
    of the source (UPDATE * / INSERT *).
    """

    action: str
    condition: Column | None = None
    values: dict[str, Column] | None = field(default=None)


def _pairs(on: Keys) -> list[tuple[str, str]]:
    if not on:
        raise ValueError("a merge needs a pair of key columns; other conditions come on top of it")
    return [(k, k) if isinstance(k, str) else k for k in on]


def _meets(on: Keys, condition: Column | None) -> Column:
    out = F.lit(True) if condition is None else condition
    for t, s in _pairs(on):
        out = (F.col(f"t.`{t}`") == F.col(f"s.`{s}`")) & out
    return out


def merge(target: DataFrame, source: DataFrame, on: Keys, matched: list[Clause] = (),
          not_matched: list[Clause] = (), not_matched_by_source: list[Clause] = (),
          condition: Column | None = None) -> DataFrame:
    """The target after the merge.

    Rows match where the key columns are equal and ``condition``, which may use
    both sides, is TRUE; a target row that only shares the key of a source row
    counts as not matched, and so does the source row.

    The first clause whose condition is TRUE acts on a row; a target row no
    clause acts on stays, a source row none acts on is dropped.  A target row
    matched by several source rows is an error once there are matched clauses.

    The source is stored once.  If none of its keys repeats, one full outer join
    yields matched rows, target rows without a source row and source rows
    without a target row at once, and each side is read once.  Such a join
    cannot be split by adaptive execution, so target keys with a large share of
    the rows are found by a sketch over the key columns and spread over
    ``SPREAD`` tasks (see ``_both_sides``); rows with a null key meet nothing
    and are spread by their hash.

    A merge without inserts needs a left join only, which adaptive execution
    splits.  One with inserts alone leaves the target as it is and looks at its
    distinct keys.  A source with repeated keys is reduced to a row per key
    before it meets the target, and its new rows are found in a second join.
    With a ``condition`` the pairs of one key are joined and, where they are
    needed twice, stored.
    """
    on = _pairs(on)
    matched, unmatched, new = list(matched), list(not_matched_by_source), list(not_matched)
    if not matched and not unmatched and not new:
        return target
    if condition is not None:
        kept, inserted = _conditional(target, source, on, matched, unmatched, new, condition)
        return kept if inserted is None else kept.unionByName(inserted)
    if not matched and not unmatched:
        return target.unionByName(_insert_side(target, source, on, new))
    source = cut_lineage(source)
    if _repeats_a_key(source, on):
        kept = _target_side(_with_source(target, source, on), target, source, matched, unmatched)
        return kept.unionByName(_insert_side(target, source, on, new)) if new else kept
    decided = _decide(_both_sides(target, source, on, bool(new)), matched, unmatched, new)
    return _after(decided, target, source, [*matched, *unmatched, *new])


def hot_keys(df: DataFrame, keys: list[str], share: float = HOT_SHARE, rows: int = HOT_ROWS) -> list[tuple]:
    """Keys that hold at least ``share`` of all rows and ``rows`` rows: at most 1/share of them.

    Reads the key columns only.  A mergeable top-k sketch of key hashes is filled
    on the map side; the keys themselves are looked up only if there are any.
    """
    name = F.xxhash64(*keys)
    known = reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])
    top = F.call_function("approx_top_k", F.when(known, name), F.lit(int(2 / share)), F.lit(max(TRACKED, int(4 / share))))
    found = df.agg(F.count("*").alias("n"), top.alias("top")).first()
    hashes = [t["item"] for t in found["top"] or [] if t["item"] is not None and t["count"] >= max(share * found["n"], rows)]
    if not hashes:
        return []
    return [tuple(r) for r in df.where(known & name.isin(hashes)).select(*keys).distinct().collect()]


def _repeats_a_key(source: DataFrame, on: Keys) -> bool:
    keys = [f"`{s}`" for _, s in on]
    return not source.dropna("any", subset=[s for _, s in on]).groupBy(*keys).count().where("count > 1").isEmpty()


def _both_sides(target: DataFrame, source: DataFrame, on: Keys, new: bool) -> DataFrame:
    """Rows of both sides, each once, as ``t`` and ``s``; one of them is null where nothing matches.

    Target rows of a hot key get one of ``SPREAD`` numbers and its source row
    meets them all as so many copies.  Copies without a target row are no new
    rows, because a hot key is in the target; so nothing has to be compared
    between the tasks of a key.
    """
    t = target.select(F.struct(*target.columns).alias("t"), *[F.col(f"`{k}`").alias(f"_t_{i}") for i, (k, _) in enumerate(on)],
                      F.pmod(F.hash(tie_breaker(target), F.monotonically_increasing_id()), F.lit(SPREAD)).alias("_any"))
    s = source.select(F.struct(*source.columns).alias("s"), *[F.col(f"`{k}`").alias(f"_s_{i}") for i, (_, k) in enumerate(on)],
                      F.pmod(tie_breaker(source), F.lit(SPREAD)).cast("int").alias("_any"))
    same = [F.col(f"_t_{i}") == F.col(f"_s_{i}") for i in range(len(on))]
    if not new:
        return t.join(s, same, "left").select("t", "s")
    without = lambda side: reduce(lambda a, b: a | b, [F.col(f"_{side}_{i}").isNull() for i in range(len(on))])
    hot = hot_keys(target, [k for k, _ in on])
    if hot:
        listed = target.sparkSession.createDataFrame(hot, target.select(*[f"`{k}`" for k, _ in on]).schema)  # at most 1/HOT_SHARE rows
        listed = F.broadcast(listed.toDF(*[f"_h_{i}" for i in range(len(on))]).withColumn("_hot", F.lit(True)))
        t, s = (side.join(listed, [F.col(f"_{n}_{i}") == F.col(f"_h_{i}") for i in range(len(on))], "left") for n, side in (("t", t), ("s", s)))
    else:
        t, s = (side.withColumn("_hot", F.lit(None).cast("boolean")) for side in (t, s))
    t = t.withColumn("_t_part", F.when(F.col("_hot") | without("t"), F.col("_any")).otherwise(0)).drop("_any", "_hot")
    s = s.withColumn("_s_part", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SPREAD - 1)))
                                          .otherwise(F.array(F.when(without("s"), F.col("_any")).otherwise(0)))))
    met = t.join(s.drop("_any"), [*same, F.col("_t_part") == F.col("_s_part")], "full")
    return met.where(~(F.col("t").isNull() & F.coalesce("_hot", F.lit(False)))).select("t", "s")


def cardinality_violations(target: DataFrame, source: DataFrame, on: list[str]) -> DataFrame:
    """Keys of the target matched by more than one source row, with the number of source rows."""
    many = source.groupBy(*on).agg(F.count("*").alias("source_rows")).where("source_rows > 1")
    return many.join(target.select(*on), on, "left_semi")


def _first_true(clauses: list[Clause], then) -> Column | None:
    out = None
    for i, clause in enumerate(clauses):
        condition = F.lit(True) if clause.condition is None else F.coalesce(clause.condition, F.lit(False))
        out = F.when(condition, then(i, clause)) if out is None else out.when(condition, then(i, clause))
    return out


def _with_source(target: DataFrame, source: DataFrame, on: Keys) -> DataFrame:
    """Target rows ``t`` with a source row ``s`` of their key and the number of such rows.

    The source's rows per key are stored: adaptive execution splits a hot target
    key only where neither side of the join is aggregated in the same stage.
    """
    pairs = _pairs(on)
    per_key = source.groupBy(*[F.col(f"`{s}`").alias(f"_k_{i}") for i, (_, s) in enumerate(pairs)]).agg(
        F.first(F.struct(*source.columns)).alias("s"), F.count("*").alias("_rows"))
    per_key = cut_lineage(per_key)
    t = target.select(F.struct(*target.columns).alias("t"))
    return t.join(per_key, [F.col(f"t.`{k}`") == F.col(f"_k_{i}") for i, (k, _) in enumerate(pairs)], "left")


def _conditional(target: DataFrame, source: DataFrame, on: Keys, matched: list[Clause], unmatched: list[Clause], new: list[Clause],
                 condition: Column) -> tuple[DataFrame, DataFrame | None]:
    """Target rows after the merge and inserted rows, for a merge with a further condition.

    Pairs are counted by key and number of the target row in one struct: a
    grouping by the key itself would reuse the join's partitions and keep the
    skew join from splitting a hot key.  Copies of a row leave the join in one
    task, so they carry the same number even when a lost scan is repeated.
    """
    pairs, s = _pairs_met(target, source, on, condition, bool(new))
    kept = _target_side(_counted(pairs, on), target, source, matched, unmatched)
    if not new:
        return kept, None
    met = pairs.where("_s_number IS NOT NULL").select("_s_number").distinct()
    return kept, _inserted(s.join(met, "_s_number", "left_anti").select("s"), target, source, new)


def _pairs_met(target: DataFrame, source: DataFrame, on: Keys, condition: Column, twice: bool) -> tuple[DataFrame, DataFrame]:
    """Target rows with each source row they match, and the source rows, both numbered; stored if both are needed twice."""
    s = source.select(F.struct(*source.columns).alias("s"), F.monotonically_increasing_id().alias("_s_number"))
    t = target.select(F.struct(*target.columns).alias("t"), F.monotonically_increasing_id().alias("_t_number"))
    if not twice:
        return t.join(s, _meets(on, condition), "left"), s
    s = cut_lineage(s)
    return cut_lineage(t.join(s, _meets(on, condition), "left")), s


def _counted(pairs: DataFrame, on: Keys) -> DataFrame:
    each = F.struct(*[F.col(f"t.`{k}`").alias(f"_{i}") for i, (k, _) in enumerate(on)], "_t_number").alias("_row")
    return pairs.groupBy(each).agg(
        F.first("t").alias("t"), F.first("s", ignorenulls=True).alias("s"), F.count("s").alias("_rows")).select("t", "s", "_rows")


def _decide(rows: DataFrame, matched: list[Clause], unmatched: list[Clause], new: list[Clause] = ()) -> DataFrame:
    """Rows ``t`` and ``s`` with the number of the clause that acts on them, or -1; clauses count on from list to list."""
    number = lambda clauses, base: _first_true(clauses, lambda i, _: F.lit(base + i)) if clauses else F.lit(-1)
    choice = (F.when(F.col("t").isNull(), number(new, len(matched) + len(unmatched)))
              .when(F.col("s").isNull(), number(unmatched, len(matched))).otherwise(number(matched, 0)))
    if matched and "_rows" in rows.columns:
        choice = F.when(F.col("_rows") > 1, F.raise_error(F.lit(
            "a target row is matched by several source rows")).cast("int")).otherwise(choice)
    return rows.withColumn("_clause", F.coalesce(choice, F.lit(-1)))


def _numbers(clauses: list[Clause], action: str) -> list[int]:
    return [i for i, c in enumerate(clauses) if c.action == action]


def _values(target: DataFrame, source: DataFrame, clauses: list[Clause]) -> list[Column]:
    """Target columns after the clause of each row; an insert leaves columns it does not name NULL."""

    def value(name: str, data_type) -> Column:
        out = F.when(F.lit(False), F.lit(None))
        for i, clause in enumerate(clauses):
            new = _assigned(clause, name, source.columns)
            if clause.action == "delete" or clause.action == "update" and new is None:
                continue
            out = out.when(F.col("_clause") == i, F.lit(None) if new is None else new)
        return out.otherwise(F.col(f"t.`{name}`")).cast(data_type).alias(name)

    return [value(f.name, f.dataType) for f in target.schema.fields]


def _after(decided: DataFrame, target: DataFrame, source: DataFrame, clauses: list[Clause]) -> DataFrame:
    """What the clauses leave and add."""
    # The filter is kept without delete clauses too: it makes the check on several matches count.
    stays = ~F.col("_clause").isin([*_numbers(clauses, "delete"), -2]) & (F.col("t").isNotNull() | (F.col("_clause") >= 0))
    return decided.where(stays).select(*_values(target, source, clauses))


def _target_side(rows: DataFrame, target: DataFrame, source: DataFrame, matched: list[Clause], unmatched: list[Clause]) -> DataFrame:
    return _after(_decide(rows, matched, unmatched), target, source, matched + unmatched)


def merge_delta(target: DataFrame, source: DataFrame, on: Keys, matched: list[Clause] = (),
                not_matched: list[Clause] = (), not_matched_by_source: list[Clause] = (),
                file: str = "_file", pos: str = "_pos", condition: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The merge as position deletes and rows to add; an update is a delete and an added row.

    The target carries the file and position of each row, which the added rows
    lack.  Both results come from one stored table of the changed rows, so the
    target is read once; only that table, not the target, is written.
    """
    on = _pairs(on)
    matched, unmatched, new = list(matched), list(not_matched_by_source), list(not_matched)
    clauses = [*matched, *unmatched, *new]
    data = target.drop(file, pos)
    inserted = None
    if condition is not None:
        pairs, s = _pairs_met(target, source, on, condition, bool(new))
        rows = _counted(pairs, on)
        if new:
            met = pairs.where("_s_number IS NOT NULL").select("_s_number").distinct()
            inserted = _inserted(s.join(met, "_s_number", "left_anti").select("s"), data, source, new)
        decided = _decide(rows, matched, unmatched)
    else:
        source = cut_lineage(source)
        if _repeats_a_key(source, on):
            decided = _decide(_with_source(target, source, on), matched, unmatched)
            inserted = _insert_side(data, source, on, new) if new else None
        else:
            decided = _decide(_both_sides(target, source, on, bool(new)), matched, unmatched, new)
    changed = cut_lineage(decided.where("_clause >= 0"))
    gone = changed.where("t IS NOT NULL").select(F.col(f"t.{file}").alias("file_path"), F.col(f"t.{pos}").alias("pos"))
    added = changed.where(~F.col("_clause").isin([*_numbers(clauses, "delete"), -2])).select(*_values(data, source, clauses))
    return gone, added if inserted is None else added.unionByName(inserted)


def _assigned(clause: Clause, name: str, source_columns: list[str]) -> Column | None:
    if clause.values is None:
        return F.col(f"s.{name}") if name in source_columns else None
    return clause.values.get(name)


def _insert_side(target: DataFrame, source: DataFrame, on: Keys, clauses: list[Clause]) -> DataFrame:
    """Rows inserted for source rows whose key no target row has; only the target's distinct keys are looked at."""
    keys = target.select(*[F.col(f"`{t}`").alias(f"_k_{i}") for i, (t, _) in enumerate(on)]).distinct()
    s = source.select(F.struct(*source.columns).alias("s"))
    new = s.join(keys, [F.col(f"s.`{k}`") == F.col(f"_k_{i}") for i, (_, k) in enumerate(on)], "left_anti")
    return _inserted(new, target, source, clauses)


def _inserted(new: DataFrame, target: DataFrame, source: DataFrame, clauses: list[Clause]) -> DataFrame:
    nothing = F.lit(None).cast(target.select(F.struct(*target.columns).alias("t")).schema["t"].dataType)
    return _after(_decide(new.withColumn("t", nothing), [], [], clauses), target, source, clauses)


def delete_where(df: DataFrame, condition: Column, mode: str = "copy-on-write",
                 file: str = "_file", pos: str = "_pos") -> DataFrame:
    """DELETE: rows whose condition is not TRUE, or (merge-on-read) the positions of those where it is."""
    if mode == "copy-on-write":
        return df.where(~F.coalesce(condition, F.lit(False)))
    if mode == "merge-on-read":
        return df.where(condition).select(F.col(file).alias("file_path"), F.col(pos).alias("pos"))
    raise ValueError(f"unknown mode {mode}")


def update_where(df: DataFrame, condition: Column, assignments: dict[str, Column]) -> DataFrame:
    """UPDATE: assigned columns change where the condition is TRUE; ``a.b`` rebuilds the struct column a.

    All assignments see the old row.
    """
    hit = F.coalesce(condition, F.lit(False))
    changed: dict[str, Column] = {}
    for name, value in assignments.items():
        root, _, path = name.partition(".")
        if path:
            changed[root] = changed.get(root, F.col(root)).withField(path, value)
        else:
            changed[root] = value
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[F.when(hit, changed[c]).otherwise(F.col(c)).cast(types[c]).alias(c) if c in changed else F.col(c)
                       for c in df.columns])


def update_delta(df: DataFrame, condition: Column, assignments: dict[str, Column], file: str = "_file",
                 pos: str = "_pos") -> tuple[DataFrame, DataFrame]:
    """UPDATE as position deletes of the old rows and the new rows to add."""
    hit = df.where(condition)
    gone = hit.select(F.col(file).alias("file_path"), F.col(pos).alias("pos"))
    return gone, update_where(hit, F.lit(True), assignments).drop(file, pos)


def touched_files(df: DataFrame, matches: DataFrame, on: list[str], file: str) -> DataFrame:
    """Files holding at least one row a row-level command may change; only those are rewritten.

    Reads just the key and file columns; the file list is distinct per map task
    before it is shuffled.
    """
    return df.select(file, *on).join(matches.select(*on), on, "left_semi").select(file).distinct()


def only_touched(df: DataFrame, touched: DataFrame, file: str) -> DataFrame:
    """Rows of the touched files; the others are not read where ``file`` is a partition column."""
    rows, listed = listed_only(df, touched, file)
    return rows.join(listed, file, "left_semi")
