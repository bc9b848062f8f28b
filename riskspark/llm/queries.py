"""Registered queries of the text operators: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm import (decontamination, hard_negatives, licenses, line_dedup, mixing, ngram_join, pii, quality, sharding, simhash,
                           suffix_dedup, toxicity, whitening)
from riskspark.llm.common import documents

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f
    return add


@query("op1_line_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.each_row(line_dedup.removed_lines(documents(spark, sf_dir), min_words=1))
    spans = F.transform("runs", lambda r: F.concat_ws("-", r["lo"].cast("string"), r["hi"].cast("string")))
    return found.select(F.col("id").alias("doc_id"), "n_lines",
                        F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + r["n"]).alias("n_removed"),
                        F.size("runs").cast("long").alias("n_runs"), F.array_join(spans, ",").alias("removed"), "longest_block",
                        F.size("copies").cast("long").alias("n_copies"),
                        F.coalesce(F.array_max(F.transform("copies", lambda c: c["n"])), F.lit(0)).cast("long").alias("longest_copy"))


# DuckDB: A-Z lower-cased, all else as it is.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query("op2_benchmark_decontamination", f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, list_slice(w, k, k + least(10, len(w)) - 1) AS g
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS k FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(g) AS n FROM win),
seen AS (SELECT doc_id, n, k, list_slice(w, k, k + n - 1) AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT seen.doc_id, seen.k, seen.n, win.item_id FROM seen JOIN win USING (g)),
words AS (SELECT doc_id, count(DISTINCT k + j) AS n_hit
          FROM (SELECT doc_id, k, unnest(range(0, n)) AS j FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS s
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontamination.scan(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


@query("op3_pivotal_mixing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


@query("op4_compression_bands")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.measure(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                      "ratio", "bad_share")


@query("op5_toxicity_crf")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, documents(spark, sf_dir, "labels"))
    out = toxicity.marginals(docs, model, ["doc_id"])
    return out.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
                      F.size("spans").cast("long").alias("n_spans"))


@query("op6_simhash_balls")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.classes(documents(spark, sf_dir))
    return out.select(F.col("id").alias("doc_id"), simhash.hex_fp().alias("fingerprint"), "component_id")


@query("op7_candidate_boosting")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(documents(spark, sf_dir))
    base = {k: F.col(f"base_{k}") for k in pii.KINDS}
    every = {k: F.concat(f"base_{k}", f"added_{k}") for k in pii.KINDS}
    return found.select("doc_id", *[F.size(base[k]).cast("long").alias(f"n_{k}") for k in pii.KINDS],
                        F.sha2(pii.written(base).cast("binary"), 256).alias("base_sha256"), pii.written(every).alias("spans"))


@query("op8_bounded_ring")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards_of(documents(spark, sf_dir))


def shards_of(docs: DataFrame) -> DataFrame:
    out = sharding.shard(docs)
    return out.select(F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"),
                      "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op9_rare_token_licenses")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licenses.scan(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
                      F.array_join("labels", ",").alias("labels"), "score")


@query("op10_two_stage_suffixes")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(documents(spark, sf_dir))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op11_ngram_join")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ngram_join.classes(documents(spark, sf_dir))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


@query("op12_embedding_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(documents(spark, sf_dir, "embeddings"))


# DuckDB: the entries on the grid as 64-bit integers; rows that take no part are left out.
@query("op13_hard_negatives", """
WITH usable AS (SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, r.vec_id AS id, r.label = a.label AS same,
         CAST(list_sum(list_transform(list_zip(a.v, r.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM usable a JOIN usable r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
positives AS (SELECT anchor_id, id, score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
ranked AS (SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS rank
  FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
   AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(
        documents(spark, sf_dir, "embeddings"), is_anchor=lambda i: i % 100 == 0,
        label=lambda i, label: F.when(i % 7 == 0, (label + 1) % 10).otherwise(label))
