"""The operators' queries over the driver's tables, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metaloom.llm.common import table
from metaloom.llm.decontaminate import find_contamination
from metaloom.llm.html_extract import extract
from metaloom.llm.mixing import mix
from metaloom.llm.negatives import mine
from metaloom.llm.quality import ORACLE as QUALITY_SQL
from metaloom.llm.quality import quality
from metaloom.llm.rules import score_quality
from metaloom.llm.runs import digest, periodic_runs
from metaloom.llm.secrets import find_secrets, listed
from metaloom.llm.simhash import near_duplicates
from metaloom.llm.suffix_dedup import repeated_passages
from metaloom.llm.toxicity import score_toxicity
from metaloom.llm.token_files import round_trip as token_round_trip
from metaloom.llm.warc import round_trip as warc_round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query("op1_source_mixing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mix(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


@query("op2_suffix_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_passages(table(spark, sf_dir, "documents"))
    listed_spans = lambda c: F.concat_ws(",", F.transform(c, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))))
    return found.select("doc_id", "n_words", "n_repeated", "n_later", listed_spans("spans").alias("spans"), listed_spans("later").alias("later"))


@query("op3_warc", sql="""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
     f AS (SELECT payload_digest, max(page_id) AS first FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc_round_trip(spark, table(spark, sf_dir, "pages"))
    return found.select(
        F.col("record_id").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"))


@query("op4_token_files")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_round_trip(spark, table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op5_simhash_near_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op6_adaptive_quality", sql=QUALITY_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op7_secret_scan")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < 3)
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    judged = lambda verdict: F.size(F.filter("spans", lambda s: s["verdict"] == verdict)).cast("bigint")
    return found.select(
        "doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
        judged("live").alias("n_live"), judged("example").alias("n_example"))


@query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_main_text")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).drop("blocks")


@query("op10_benchmark_decontamination", sql="""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
     b AS (SELECT item_id, regexp_extract_all(
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
     bs AS (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
            FROM b WHERE len(w) > 0),
     bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS x FROM bs),
     sizes AS (SELECT DISTINCT n FROM bw),
     ds AS (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n),
     dw AS (SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS x FROM ds),
     m AS (SELECT r, i, n, item_id FROM dw JOIN bw USING (n, x)),
     spots AS (SELECT r, count(DISTINCT p) AS n_hit
               FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM m)) GROUP BY r),
     items AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
               FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM m) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN spots USING (r) LEFT JOIN items USING (r)
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(periodic_runs(table(spark, sf_dir, "documents"), planted=True))


@query("op12_quality_rules")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), least=0.3)
    return found.select("doc_id", "held_out", "score", "predicted")


@query("op13_hard_negatives", sql="""
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     a AS (SELECT vec_id AS anchor_id, label AS own, v AS q FROM r WHERE vec_id % 50 = 0),
     s AS (SELECT anchor_id, own, vec_id, label,
             CAST(coalesce(list_sum(list_transform(range(1, least(len(q), len(v)) + 1), lambda i: q[i] * v[i])), 0) AS BIGINT) AS score
           FROM a JOIN r ON vec_id <> anchor_id),
     p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own
           QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE label <> own AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 3
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.select("vec_id", "embedding", shifted.alias("label")))
