"""The corpus pipeline: language, near-duplicates, benchmark passages, source mix, shards.

Every stage judges rows, so repeated rows and null ids are ordinary input; a
null text is an empty one, which the first stage rejects.  Columns beyond those
of documents are dropped, whatever they are called.  Empty tables give empty
results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tarn.llm import decontaminate, langid, mixing, sharding, simhash
from tarn.llm.common import id_hash_mod, saved
from tarn.plans.registry import QUERIES, Tables

SHARDS = 40
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without a letter go.  lang becomes the predicted language.

    The models learn from the documents whose id hash modulo 4 is not 2, as
    the operator's own query does.
    """
    docs = docs.select(*COLUMNS)
    langs, model = langid.train(docs.where(id_hash_mod("doc_id", 4) != 2), "text", "lang")
    found = langid.predict(docs, langs, model, keep=["text", "source", "n_chars"])
    return found.where(F.col("lang_pred") != langid.UNKNOWN).select(
        "doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars")


def keyed(docs: DataFrame) -> DataFrame:
    """The columns of documents with a stored number per row: null and repeated ids are told apart by it."""
    return saved(docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id()), "keyed")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group; which rows a group has does not depend on their ids, null or repeated."""
    rows = keyed(docs)
    classes = simhash.near_duplicates(rows, shingle=4, distance=4, id_col="_row")
    gone = classes.where("_row <> component_id").select(F.col("_row").alias("_gone"))
    return rows.join(gone, F.col("_row") == F.col("_gone"), "left_anti").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no item of the benchmark, with an id or without."""
    return decontaminate.without_contaminated(keyed(docs), Tables(spark, sf_dir).benchmark, "_row").select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    copies = mixing.mix(docs.select(*COLUMNS)).where("copies > 0")
    return copies.withColumn("_copy", F.explode(F.sequence(F.lit(1), "copies"))).select(*COLUMNS)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard."""
    return sharding.assign_shards(docs.select(*COLUMNS), SHARDS)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("mix", mix),
          ("shards", shards)]

#: Hashes, models and alignments are beyond SQL; tests/llm/test_pipeline.py holds the stages that drop rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each stage's rows stored before the next one reads them."""
    docs = Tables(spark, sf_dir).documents
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES["pipeline"] = run
