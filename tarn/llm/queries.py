"""Registered queries of the operators, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tarn.llm import (ann, decontaminate, filter_audit, hmm, langid, mixing, periodic, repeats, secrets, sharding, simhash, token_counts,
                      webpages)
from tarn.llm.common import id_hash_mod
from tarn.plans.registry import query

SHARDS = 40


@query("op1_hmm_scores")
def op1_hmm_scores(t):
    """Hidden Markov scores of all documents, learned from those whose id hash modulo 5 is not 1."""
    return hmm.score(t.documents, id_hash_mod("doc_id", 5) == 1)


@query("op2_secret_scan")
def op2_secret_scan(t):
    """Secrets in all documents: fixed patterns and Markov models."""
    found = secrets.find_secrets(t.documents)

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select("doc_id", number("assign"), number("access"), number("hex"),
                        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
                        number("random"))


@query("op3_balanced_lists")
def op3_balanced_lists(t):
    """The 20 nearest by inner product of every vector whose id is divisible by 20."""
    return ann.nearest(t.embeddings, lambda vec_id: vec_id % 20 == 0)


@query("op4_language_mixture")
def op4_language_mixture(t):
    """Language of every document, learned from those whose id hash modulo 4 is not 2."""
    docs = t.documents
    langs, model = langid.train(docs.where(id_hash_mod("doc_id", 4) != 2), "text", "lang")
    found = langid.predict(docs, langs, model)
    return found.select("doc_id", (id_hash_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "languages")


@query("op5_pareto_mix")
def op5_pareto_mix(t):
    """Mix of all documents: sources weigh 1, 2, 3, repeating."""
    mixed = mixing.mix(t.documents)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query("op6_simhash_dedup")
def op6_simhash_dedup(t):
    """Fingerprints over 4-word shingles, linked at 4 or fewer differing bits."""
    return simhash.near_duplicates(t.documents, shingle=4, distance=4)


@query("op7_decontaminate")
def op7_decontaminate(t):
    """Documents that hold an item of the benchmark, with the item and the aligned words."""
    return decontaminate.contaminated(t.documents, t.benchmark)


@query("op8_host_text")
def op8_host_text(t):
    """Main text of every page."""
    return webpages.main_text(t.pages).select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


@query("op9_jump_shards")
def op9_jump_shards(t):
    """All documents on 40 shards by jump consistent hashing of the id."""
    text = F.col("text").cast("binary")
    rows = t.documents.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("bigint").alias("size"),
                              F.crc32(F.coalesce(text, F.lit("").cast("binary"))).alias("text_crc32"))
    placed = sharding.with_slots(rows, SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query("op10_suffix_dedup")
def op10_suffix_dedup(t):
    """Bytes of all documents covered by 200-byte strings that occur elsewhere too."""
    return repeats.without_repeats(t.documents, length=200).drop("kept")


def with_repeats(text: Column, doc_id: Column) -> Column:
    """Texts of a tenth of the ids with a part of their words repeated to the end; other texts, and those without an id, as they are."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def repeated(ws: Column) -> Column:
        n = F.size(ws)
        start = (g % n).cast("int")
        period = (1 + F.floor((n - start) / (3 + g % 8))).cast("int")
        place = lambda i: F.when(i < start, i).otherwise(start + (i - start) % period)
        return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: ws[place(i)]), " ")

    planted = F.transform(F.array(words), lambda ws: F.when(F.size(ws) > 0, repeated(ws)).otherwise(""))[0]
    return F.when(h % 10 == 0, planted).otherwise(text)


@query("op11_periodic_runs")
def op11_periodic_runs(t):
    """Runs of repetition in the words of all documents, with repetitions planted into a tenth of them."""
    docs = t.documents.select("doc_id", with_repeats(F.col("text"), F.col("doc_id")).alias("text"))
    found = periodic.periodic_runs(docs, ["doc_id"])
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return (found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("longest.col2")).alias("start"),
        F.col("longest.length").alias("length"), (-F.col("longest.col3")).alias("period"),
        F.floor(1000 * F.col("longest.length") / -F.col("longest.col3")).alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))


@query("op12_token_counts")
def op12_token_counts(t):
    """Tokens of all documents as a byte-level vocabulary of 50,257 counts them."""
    import public_tokenizers
    counted = token_counts.count_tokens(t.documents, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


FILTER_AUDIT = """
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce("text", '') AS x FROM documents),
judged AS (
  SELECT doc_id, part, x, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY x) AS first_id FROM texts),
label AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
masks AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(words) < 50 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 5 * length(x) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(x, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > first_id THEN 16 ELSE 0 END AS mask, count(*) AS n
  FROM judged LEFT JOIN label USING (doc_id) GROUP BY ALL),
letters(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (
  SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS earlier
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5])::INT AS step)),
counted AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN mask & (bit | earlier) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & bit <> 0 AND mask & earlier = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & bit <> 0 AND mask & earlier <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & bit <> 0 AND mask & earlier = 0 THEN n * good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & bit <> 0 AND mask & earlier = 0 THEN n * toxic ELSE 0 END) AS toxic_lost
  FROM masks, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM counted
"""


@query("op13_filter_audit", FILTER_AUDIT)
def op13_filter_audit(t):
    """Five filters over all documents in every order, per source."""
    return filter_audit.audit(filter_audit.marks(t.documents, t.labels))
