"""Mixing sources to target weights by Pareto order sampling, as DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tarn.llm.common import WORD, saved
from tarn.operators.windows import running

#: Documents of one source whose running sum is made in one piece.
CHUNK_ROWS = 2000


def targets(totals: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """Target words of each source from (source, source_size, n).

    The words are shared by weight; a source stops at ``most`` times its size
    and the excess is shared again by weight, which is water filling: target =
    min(most * size, weight * level).  With sources ordered by the level at
    which they fill up, the level is the greatest of the levels that remain
    after filling the sources before.  One row per source is ordered here.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    filling = Window.orderBy("full_at", "pos").rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("pos") % len(weights) + 1).cast("int"))
    return (totals.withColumn("pos", F.row_number().over(by_name) - 1).withColumn("weight", weight)
            .withColumn("room", F.col("source_size") * F.lit(float(most)))
            .withColumn("full_at", F.col("room") / F.col("weight"))
            .withColumn("words_left", F.sum(F.col("source_size").cast("double")).over(everything)
                        - F.coalesce(F.sum("room").over(filling), F.lit(0.0)))
            .withColumn("weight_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(filling), F.lit(0.0)))
            .withColumn("level", F.max(F.col("words_left") / F.col("weight_left")).over(everything))
            .withColumn("target", F.least("room", F.col("weight") * F.col("level")))
            .select("source", "source_size", "n", "target"))


def uniform(id_col: Column, seed: int) -> Column:
    """A number strictly between 0 and 1 that depends on the id and the seed only."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), id_col.cast("string")), 12)
    return (bits + 0.5) / float(1 << 52)


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = 1, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """docs with size, source_size, target and copies: how often the mix takes each document (0 to ``most``).

    A document's wanted count is target / source_size.  The whole part is
    certain.  The rest p is an inclusion probability, different per source:
    documents are ranked by random odds u/(1-u) over inclusion odds p/(1-p) and
    taken in that order while they fit into the source's remaining words; one
    more document, the one that closes the remaining gap best, ends the sample.

    The sample is a prefix of the ranking and one document, so each source
    needs one cut only: documents are not moved, the running sums are over
    (source, id, size).
    Rows with equal source, id and size rank together and are taken together.
    A null source is a source, last in order; a null or blank text has size 0,
    a source of size 0 has target 0; a null id ranks like any other value; an empty table
    gives an empty result.  Columns of docs named like the added ones are
    replaced.  Reruns agree: the numbers depend on ids and ``seed``.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint")
    units = saved(docs.select(F.col(source_col).alias("source"), F.col(id_col).alias("id"), size.alias("size"))
                  .groupBy("source", "id", "size").agg(F.count("*").alias("m")), "sizes")
    totals = units.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"), F.sum("m").alias("n"))
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.least(F.floor(wanted + 1e-12), F.lit(most)).cast("int")
    plan = saved(targets(totals, weights, most).withColumn("whole", whole)
                 .withColumn("left", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0))), "targets")
    u, name = uniform(F.col("id"), seed), F.coalesce(F.col("id").cast("string"), F.lit(""))
    p = F.least(F.greatest(F.col("left") / F.col("source_size"), F.lit(1e-12)), F.lit(1 - 1e-12))
    ranked = (units.alias("d").join(plan.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
              .where("t.left > 0").select("d.*", "t.left", "t.n", u.alias("u"), name.alias("name"), ((u / (1 - u)) / (p / (1 - p))).alias("odds")))
    chunk = F.floor(F.col("u") * F.ceil(F.col("n") / CHUNK_ROWS))
    words = F.col("size") * F.col("m")
    summed = saved(running(ranked, ["source"], ["odds", "name", "size"], chunk, words, "upto"), "running")
    prefix = (summed.where("upto <= left").groupBy("source")
              .agg(F.max(F.struct("u", "name", "size")).alias("cut"), F.max("upto").alias("got")))
    gap = F.col("s.left") - F.coalesce("got", F.lit(0))
    miss = F.abs(words - gap)
    rest = (summed.alias("s").where("upto > left").join(prefix.alias("p"), F.col("s.source").eqNullSafe(F.col("p.source")), "left")
            .where(miss < gap).groupBy("s.source")
            .agg(F.min(F.struct(miss.alias("miss"), "s.u", "s.name", "s.size")).alias("last")))
    cuts = saved(plan.alias("t").join(prefix.alias("c"), F.col("t.source").eqNullSafe(F.col("c.source")), "left")
                 .join(rest.alias("r"), F.col("t.source").eqNullSafe(F.col("r.source")), "left")
                 .select(F.col("t.source").alias("_source"), "source_size", "target", "whole", "cut",
                         F.struct("last.u", "last.name", "last.size").alias("last")), "cuts")
    own = F.struct(uniform(F.col(id_col), seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col("size"))
    kept = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies")]
    rows = docs.select(*kept, size.alias("size"))
    return (rows.join(cuts, F.col(source_col).eqNullSafe(F.col("_source")))
            .select(*kept, "size", "source_size", "target",
                    (F.col("whole") + F.when((own <= F.col("cut")) | (own == F.col("last")), 1).otherwise(0)).alias("copies")))
