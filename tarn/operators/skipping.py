"""Data skipping: predicates evaluated on rows and on per-file column statistics.

A files DataFrame holds ``record_count`` and, per data column c, any of
``c_lower, c_upper, c_nulls, c_nans``.  Each predicate carries three Columns:

* ``row``: the condition on data rows,
* ``may_match``: false only if no row of the file can satisfy it,
* ``must_match``: true only if every row of the file satisfies it.

All follow SQL logic: a comparison with NULL is not TRUE, and NaN is above all
numbers.  Bounds leave NaN out, so a file of a floating column may match an
upward comparison through its NaN rows unless it is known to hold none.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tarn.util import listed_only

TRUE, FALSE = (lambda: F.lit(True)), (lambda: F.lit(False))


@dataclass(frozen=True)
class Predicate:
    row: Column
    may_match: Column
    must_match: Column
    negated: Callable[[], "Predicate"]

    def __and__(self, other: "Predicate") -> "Predicate":
        return Predicate(self.row & other.row, self.may_match & other.may_match, self.must_match & other.must_match,
                         lambda: ~self | ~other)

    def __or__(self, other: "Predicate") -> "Predicate":
        return Predicate(self.row | other.row, self.may_match | other.may_match, self.must_match | other.must_match,
                         lambda: ~self & ~other)

    def __invert__(self) -> "Predicate":
        return self.negated()


class FileStats:
    """Builds predicates against the statistics columns a files DataFrame has."""

    def __init__(self, files: DataFrame):
        self._have = set(files.columns)
        self._floating = {f.name[: -len("_lower")] for f in files.schema.fields
                          if f.name.endswith("_lower") and f.dataType.simpleString() in ("float", "double")}

    def _stat(self, column: str, what: str) -> Column:
        name = f"{column}_{what}"
        return F.col(name) if name in self._have else F.lit(None)

    def _clean(self, column: str) -> Column:
        """The file is known to hold neither NULL nor (where counted) NaN in the column."""
        nulls = F.coalesce(self._stat(column, "nulls") == 0, FALSE())
        return nulls & ~self._maybe_nan(column)

    def _maybe_nan(self, column: str) -> Column:
        if column not in self._floating:
            return FALSE()
        return F.coalesce(self._stat(column, "nans") > 0, TRUE())

    def _some_value(self, column: str) -> Column:
        return F.coalesce(self._stat(column, "nulls") < F.col("record_count"), TRUE())

    def _make(self, column: str, row: Column, may: Column, must: Column, negated) -> Predicate:
        return Predicate(row, self._some_value(column) & F.coalesce(may, TRUE()), self._clean(column) & F.coalesce(must, FALSE()), negated)

    def lt(self, c: str, v) -> Predicate:
        low, high = self._stat(c, "lower"), self._stat(c, "upper")
        return self._make(c, F.col(c) < v, low < v, high < v, lambda: self.gt_eq(c, v))

    def lt_eq(self, c: str, v) -> Predicate:
        low, high = self._stat(c, "lower"), self._stat(c, "upper")
        return self._make(c, F.col(c) <= v, low <= v, high <= v, lambda: self.gt(c, v))

    def gt(self, c: str, v) -> Predicate:
        low, high = self._stat(c, "lower"), self._stat(c, "upper")
        return self._make(c, F.col(c) > v, (high > v) | self._maybe_nan(c), low > v, lambda: self.lt_eq(c, v))

    def gt_eq(self, c: str, v) -> Predicate:
        low, high = self._stat(c, "lower"), self._stat(c, "upper")
        return self._make(c, F.col(c) >= v, (high >= v) | self._maybe_nan(c), low >= v, lambda: self.lt(c, v))

    def eq(self, c: str, v) -> Predicate:
        low, high = self._stat(c, "lower"), self._stat(c, "upper")
        return self._make(c, F.col(c) == v, (low <= v) & (high >= v), (low == v) & (high == v), lambda: self.not_eq(c, v))

    def not_eq(self, c: str, v) -> Predicate:
        low, high = self._stat(c, "lower"), self._stat(c, "upper")
        return self._make(c, F.col(c) != v, TRUE(), (low > v) | (high < v), lambda: self.eq(c, v))

    def is_in(self, c: str, values: list) -> Predicate:
        low, high = self._stat(c, "lower"), self._stat(c, "upper")
        may, must = FALSE(), FALSE()
        for v in values:
            may, must = may | ((low <= v) & (high >= v)), must | ((low == v) & (high == v))
        return self._make(c, F.col(c).isin(values), may, must, lambda: self.not_in(c, values))

    def not_in(self, c: str, values: list) -> Predicate:
        low, high = self._stat(c, "lower"), self._stat(c, "upper")
        must = TRUE()
        for v in values:
            must = must & ((low > v) | (high < v))
        return self._make(c, ~F.col(c).isin(values), TRUE(), must, lambda: self.is_in(c, values))

    def starts_with(self, c: str, prefix: str) -> Predicate:
        n = len(prefix)
        low, high = F.substring(self._stat(c, "lower"), 1, n), F.substring(self._stat(c, "upper"), 1, n)
        return self._make(c, F.col(c).startswith(prefix), (low <= prefix) & (high >= prefix),
                          (low == prefix) & (high == prefix), lambda: self.not_starts_with(c, prefix))

    def not_starts_with(self, c: str, prefix: str) -> Predicate:
        n = len(prefix)
        low, high = F.substring(self._stat(c, "lower"), 1, n), F.substring(self._stat(c, "upper"), 1, n)
        return self._make(c, ~F.col(c).startswith(prefix), ~((low == prefix) & (high == prefix)),
                          (low > prefix) | (high < prefix), lambda: self.starts_with(c, prefix))

    def is_null(self, c: str) -> Predicate:
        nulls = self._stat(c, "nulls")
        return Predicate(F.col(c).isNull(), F.coalesce(nulls > 0, TRUE()),
                         F.coalesce(nulls == F.col("record_count"), FALSE()), lambda: self.not_null(c))

    def not_null(self, c: str) -> Predicate:
        return Predicate(F.col(c).isNotNull(), self._some_value(c),
                         F.coalesce(self._stat(c, "nulls") == 0, FALSE()), lambda: self.is_null(c))

    def is_nan(self, c: str) -> Predicate:
        nans = self._stat(c, "nans")
        return Predicate(F.coalesce(F.isnan(c), FALSE()), F.coalesce(nans > 0, TRUE()),
                         F.coalesce(nans == F.col("record_count"), FALSE()), lambda: self.not_nan(c))

    def not_nan(self, c: str) -> Predicate:
        nans = self._stat(c, "nans")
        return Predicate(~F.coalesce(F.isnan(c), FALSE()), F.coalesce(nans < F.col("record_count"), TRUE()),
                         F.coalesce(nans == 0, FALSE()), lambda: self.is_nan(c))

    def always(self, verdict: bool = True) -> Predicate:
        v = F.lit(verdict)
        return Predicate(v, v, v, lambda: self.always(not verdict))


def classify(files: DataFrame, predicate: Predicate) -> DataFrame:
    """Files with ``verdict``: all rows match, none can, or some may."""
    verdict = (F.when(predicate.must_match, "all").when(~predicate.may_match, "none").otherwise("some"))
    return files.withColumn("verdict", verdict)


def residual_scan(data: DataFrame, files: DataFrame, file: str, predicate: Predicate) -> DataFrame:
    """Matching rows: files that must match are not filtered, and those that cannot match are not read where ``file`` is a partition column."""
    kept = classify(files, predicate).where("verdict <> 'none'").select(file, (F.col("verdict") == "all").alias("_all"))
    data, kept = listed_only(data, kept, file)
    return data.join(kept, file).where(F.col("_all") | predicate.row).drop("_all")


def metadata_delete(files: DataFrame, predicate: Predicate) -> DataFrame:
    """What a delete does to each data file: drop it whole, keep it, or rewrite it row by row."""
    action = F.when(F.col("verdict") == "all", "drop").when(F.col("verdict") == "none", "keep").otherwise("rewrite")
    return classify(files, predicate).withColumn("action", action).drop("verdict")


def conflicting_files(files: DataFrame, predicate: Predicate, since: int) -> DataFrame:
    """Files added after a snapshot that may hold rows of a filter: they conflict with an overwrite of it."""
    return files.where((F.col("sequence_number") > since) & predicate.may_match)


def check_added_rows(rows: DataFrame, condition: Column) -> DataFrame:
    """Rows as they are; one outside the overwrite filter is an error."""
    outside = ~F.coalesce(condition, FALSE())
    wrong = F.when(outside, F.raise_error(F.lit("a row to add does not match the overwrite filter")).cast("boolean"))
    return rows.where(wrong.isNull())
