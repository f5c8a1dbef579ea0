"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldlake.llm.common import table
from fieldlake.session import stored, work_path

Job = Callable[[SparkSession, str], DataFrame]


def op1_range_coded_ids(spark: SparkSession, folder: str) -> DataFrame:
    from fieldlake.llm import range_coder

    return coded_ids(table(spark, folder, "documents"), range_coder.LANES)


def coded_ids(docs: DataFrame, together: int) -> DataFrame:
    """Write the ids of ``docs`` and give their digests as read back."""
    import public_tokenizers

    from fieldlake.llm import range_coder

    path = work_path(docs.sparkSession, "ids")
    range_coder.write(docs, path, public_tokenizers.path("byte_bpe_50k.json"), together=together)
    return range_coder.digests(docs.sparkSession, path, together)


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from fieldlake.llm import token_counts

    return token_counts.count(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_warc_transactions(spark: SparkSession, folder: str) -> DataFrame:
    from fieldlake.llm import warc

    path = work_path(spark, "warc")
    warc.write(table(spark, folder, "pages"), path)
    whole = warc.captures(warc.read(spark, path, payloads=False))
    flat = whole.select(
        F.element_at("metadata", 1)["fields"].alias("notes"), "capture_id", "response.*", F.size("requests").alias("n_requests"))
    page = F.element_at(F.map_from_entries("notes"), "page-id")
    flat = flat.select(
        F.when(page != "", page).cast("long").alias("page_id"), "capture_id", "refers_to", "payload_bytes", "payload_digest",
        F.col("type").alias("record_type"), "target_uri", "n_requests")
    flat = stored(flat, "captures")
    named = stored(flat.filter("record_type = 'response'").groupBy(F.col("capture_id").alias("refers_to")).agg(F.max("page_id").alias("to_page")), "responses")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", F.col("to_page").alias("refers_to"), "target_uri", "n_requests"]
    revisits = flat.filter("record_type = 'revisit'").join(named, "refers_to", "left").select(*columns)
    # responses refer to nothing: they don't take part in the join
    return flat.filter("record_type <> 'revisit'").withColumn("to_page", F.lit(None).cast("long")).select(*columns).unionByName(revisits)


OP3 = """
WITH p AS (
  SELECT page_id, coalesce(url, 'urn:page:' || page_id) AS url, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
g AS (SELECT html, max(page_id) AS kept FROM p WHERE payload_bytes >= 1000 GROUP BY html)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN g.kept > p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.kept > p.page_id THEN g.kept END AS refers_to, p.url AS target_uri, 1 AS n_requests
FROM p LEFT JOIN g ON p.html = g.html AND p.payload_bytes >= 1000
"""


def op4_hnsw_search(spark: SparkSession, folder: str) -> DataFrame:
    from fieldlake.llm import hnsw

    return hnsw.nearest(table(spark, folder, "embeddings"))


def op5_url_logistic(spark: SparkSession, folder: str) -> DataFrame:
    from fieldlake.llm import url_filter

    pages = table(spark, folder, "pages")
    model = url_filter.train(url_filter.labelled_by_rules(pages, url_filter.RULES))
    return url_filter.judge(pages, url_filter.RULES, model)


#: Wanted token shares of the two domains that ``labels`` tells apart.
SHARES = {"high": 0.93, "low": 0.07}


def op6_soft_mixing(spark: SparkSession, folder: str) -> DataFrame:
    from fieldlake.llm import mixing

    docs = table(spark, folder, "documents")
    return mixing.rates(docs, mixing.train(docs, quality_domains(table(spark, folder, "labels")), "domain"), SHARES)


def quality_domains(labels: DataFrame) -> DataFrame:
    return labels.select("doc_id", F.when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low").alias("domain"))


def op7_ordinal_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from fieldlake.llm import toxicity

    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, toxicity.graded_labels(docs, table(spark, folder, "labels")), "grade")
    return toxicity.score(docs, model).select(
        "doc_id", "expected_severity", "grade", (F.col("expected_severity") >= 0.5).alias("rejected"))


def op8_hash_tree_shards(spark: SparkSession, folder: str) -> DataFrame:
    from fieldlake.llm import sharding

    return sharding.place(table(spark, folder, "documents"), 40)


def op9_simhash_leaks(spark: SparkSession, folder: str) -> DataFrame:
    from fieldlake.llm import decontaminate

    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op10_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    from fieldlake.llm import ngram_join

    return ngram_join.join_documents(table(spark, folder, "documents"))


def op11_length_strata(spark: SparkSession, folder: str) -> DataFrame:
    from fieldlake.llm import lexical

    return lexical.search(lexical.build(table(spark, folder, "documents")), table(spark, folder, "benchmark"))


TERMS = """regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""

OP11 = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         {TERMS} AS ts
  FROM documents WHERE text IS NOT NULL),
n AS (SELECT r, doc_id, ts, CAST(len(ts) AS BIGINT) AS n FROM d WHERE len(ts) > 0),
s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM n),
m AS (SELECT r, doc_id, 100 - 75 + ((75 * n * docs) // length) AS m, ts FROM n, s),
p AS (SELECT r, doc_id, m, term, count(*) AS tf FROM (SELECT r, doc_id, m, unnest(ts) AS term FROM m) GROUP BY ALL),
i AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest({TERMS}) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)) GROUP BY ALL),
w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s),
g AS (
  SELECT i.item_id, p.r, p.doc_id, CAST(sum(i.times * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * p.m))) AS BIGINT) AS score
  FROM i JOIN w ON w.term = i.term JOIN p ON p.term = i.term GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, r) AS rank FROM g WHERE score > 0)
WHERE rank <= 10
"""


def op12_residue_negatives(spark: SparkSession, folder: str) -> DataFrame:
    from fieldlake.llm import hard_negatives

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, folder, "embeddings").withColumn("label", label))


OP12 = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.r AS ar, a.vec_id AS anchor_id, b.r AS br, b.vec_id, a.label = b.label AS same,
         CAST(list_sum([z[1] * z[2] FOR z IN list_zip(a.x, b.x)]) AS BIGINT) AS score
  FROM v a JOIN v b ON len(a.x) = len(b.x) AND a.r <> b.r WHERE a.vec_id % 50 = 0),
p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id, br) AS n FROM s WHERE same) WHERE n <= 5),
w AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.ar, p.br ORDER BY s.score DESC, s.vec_id, s.br) AS rank
  FROM p JOIN s ON s.ar = p.ar AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM w WHERE rank <= 3
"""


def op13_grace_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from fieldlake.llm import exact_dedup

    return exact_dedup.find_copies(table(spark, folder, "documents"))


OP13 = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS keep_id, count(*) OVER (PARTITION BY text) AS group_size,
       row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1 AS kept, sha256(text) AS text_sha256
FROM t
"""


JOBS: dict[str, Job] = {f.__name__: f for f in (
    op1_range_coded_ids, op2_token_counts, op3_warc_transactions, op4_hnsw_search, op5_url_logistic, op6_soft_mixing, op7_ordinal_toxicity, op8_hash_tree_shards, op9_simhash_leaks, op10_ngram_jaccard,
    op11_length_strata, op12_residue_negatives, op13_grace_dedup)}

CHECKS: dict[str, str] = {
    "op3_warc_transactions": OP3, "op11_length_strata": OP11, "op12_residue_negatives": OP12, "op13_grace_dedup": OP13}
