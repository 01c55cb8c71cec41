"""One query per operator over the whole of its table, with production
parameters, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metroframe.llm import bpe, capfilters, licenses, packing, pii, quality, resample, simhash, substring, topk, urlfilter, warc, whitening
from metroframe.llm.common import table

#: the least score of an accepted document
ACCEPT = 0.3


def op1_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_cap_filter_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = capfilters.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_nra_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
    return found.select("query_id", "rank", "vec_id", "score")


TOP_K_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v q, v c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


#: fixed values of the contract
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"), URL_RULES, whole_url=True)


def op6_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder = warc.new_folder(pages)
    records = warc.read_records(warc.write_bundles(pages, folder), folder)
    page = pages.schema["page_id"].dataType
    return records.select(F.col("page_id").cast(page).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          F.col("refers_to").cast(page).alias("refers_to"))


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM p),
h AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS holder FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> holder THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> holder THEN holder END AS refers_to
FROM h
"""


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels that may be learned: those whose remainder is not 0."""
    return table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    weights = quality.fit(docs, training_labels(spark, sf_dir))
    scored = quality.score(docs, weights, keep=["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def op8_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bpe.encode(table(spark, sf_dir, "documents"), ranks, pattern)
    decoded = bpe.decode(encoded, ranks, pattern)
    return decoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "end", "n_units", "n_words", "kept_id", "kept_start")


LINE_DEDUP_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS line_no FROM d),
o AS (SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
          + length(regexp_extract(line, '^[ \t\r\f\v]*')) AS line_start FROM l),
t AS (SELECT doc_id, line_no, line_start, regexp_extract_all(line, '[^ \t\r\f\v]+[ \t\r\f\v]*') AS words FROM o),
w AS (SELECT doc_id, line_no, line_start, unnest(words) AS word, unnest(range(len(words))) AS word_no FROM t),
p AS (SELECT doc_id, line_no, word_no, regexp_replace(word, '[ \t\r\f\v]+$', '') AS word,
        line_start + coalesce(sum(length(word)) OVER f, 0) AS start,
        coalesce(sum(CAST(regexp_matches(word, '[.!?][ \t\r\f\v]*$') AS INTEGER)) OVER f, 0) AS part
      FROM w WINDOW f AS (PARTITION BY doc_id, line_no ORDER BY word_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
u AS (SELECT doc_id, line_no, part, min(start) AS start, max(start + length(word)) AS "end", count(*) AS n_words,
        string_agg(translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ' ' ORDER BY word_no) AS norm
      FROM p GROUP BY ALL),
n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no, part) AS unit_no FROM u),
k AS (SELECT *, first_value(doc_id) OVER f AS kept_id, first_value(start) OVER f AS kept_start FROM n
      WINDOW f AS (PARTITION BY norm ORDER BY doc_id, start)),
r AS (SELECT *, unit_no - row_number() OVER (PARTITION BY doc_id ORDER BY unit_no) AS run FROM k WHERE doc_id <> kept_id OR start <> kept_start)
SELECT doc_id, CAST(min(start) AS BIGINT) AS start, CAST(max("end") AS BIGINT) AS "end", count(*) AS n_units, CAST(sum(n_words) AS BIGINT) AS n_words,
  arg_min(kept_id, unit_no) AS kept_id, CAST(arg_min(kept_start, unit_no) AS BIGINT) AS kept_start
FROM r GROUP BY doc_id, run HAVING sum(n_words) >= 25
"""


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    counts = [F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "value")
    return found.select("vec_id", "n", "deviation", "identity_error", each).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", F.col("value.whitened").alias("whitened"),
        F.col("value.explained").alias("explained"), "identity_error")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_harmonic_packing, op2_cap_filter_dedup, op3_simhash_dedup, op4_nra_top_k, op5_url_filter, op6_warc_bundles,
        op7_quality_classifier, op8_bpe_codec, op9_line_dedup, op10_license_scan,
        op11_pii_spans, op12_embedding_whitening, op13_importance_resampling)}


def oracle_sql() -> dict[str, str]:
    return {"op4_nra_top_k": TOP_K_SQL, "op6_warc_bundles": WARC_SQL, "op9_line_dedup": LINE_DEDUP_SQL}
