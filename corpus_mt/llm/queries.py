"""The queries of this package over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpus_mt.llm import (
    ann,
    hard_negatives,
    langid,
    license_scan,
    mixing,
    neardup,
    packing,
    quality,
    ranked_search,
    simhash,
    token_count,
    url_filter,
    warc,
)

TOKENIZER = "word_bpe_49k.json"
URL_RULES = (
    url_filter.Rule("net", "/", url_filter.BLOCK),
    url_filter.Rule("example.net", "/en/", url_filter.ALLOW),
    url_filter.Rule("example.com", "/de/", url_filter.BLOCK),
    url_filter.Rule("org", "/fr/", url_filter.ALLOW),
)
# Between the sources' own shares (1) and equal ones (0).
MIX_POWER = 0.5


def _read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def op1_url_filter(spark: SparkSession, d: str) -> DataFrame:
    pages = _read(spark, d, "pages")
    judged = url_filter.filter_urls(pages, URL_RULES, url_filter.count_words(pages, "html"))
    return judged.withColumn("host_words", F.array_join("host_words", " "))


def op2_best_fit_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(_read(spark, d, "documents"), public_tokenizers.path(TOKENIZER))


def op3_warc_salvage(spark: SparkSession, d: str) -> DataFrame:
    archives = warc.archive_pages(_read(spark, d, "pages"))
    records = warc.records_of(warc.read_archives(archives, payloads=False))
    return records.select(
        F.col("record_key").cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"),
    )


def op4_language_id(spark: SparkSession, d: str) -> DataFrame:
    docs = _read(spark, d, "documents")
    model = langid.fit(docs.filter(~langid.held_out() & F.col("doc_id").isNotNull()))
    predicted = langid.predict(docs.select("doc_id", "text"), model)
    return predicted.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op5_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return quality.judge(_read(spark, d, "documents"), _read(spark, d, "labels"))


def op6_nearest_neighbours(spark: SparkSession, d: str) -> DataFrame:
    vectors = _read(spark, d, "embeddings")
    return ann.search(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


def op7_near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return neardup.classes(_read(spark, d, "documents")).drop("node")


def op8_source_mixing(spark: SparkSession, d: str) -> DataFrame:
    return mixing.schedule(_read(spark, d, "documents").select("doc_id", "source"), MIX_POWER)


def op9_license_scan(spark: SparkSession, d: str) -> DataFrame:
    return license_scan.license_digest(license_scan.scan_licenses(_read(spark, d, "documents")))


def op10_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return token_count.count_tokens(_read(spark, d, "documents"), public_tokenizers.path(TOKENIZER))


def op11_simhash(spark: SparkSession, d: str) -> DataFrame:
    return simhash.classes(_read(spark, d, "documents"))


def op12_hard_negatives(spark: SparkSession, d: str) -> DataFrame:
    label = F.col("label").cast("bigint")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(_read(spark, d, "embeddings").withColumn("label", moved), 50)


def op13_ranked_search(spark: SparkSession, d: str) -> DataFrame:
    return ranked_search.search(_read(spark, d, "documents"), _read(spark, d, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_filter,
        op2_best_fit_packing,
        op3_warc_salvage,
        op4_language_id,
        op5_quality_rules,
        op6_nearest_neighbours,
        op7_near_duplicates,
        op8_source_mixing,
        op9_license_scan,
        op10_token_counts,
        op11_simhash,
        op12_hard_negatives,
        op13_ranked_search,
    )
}

ORACLES: dict[str, str] = {
    "op3_warc_salvage": """
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
        ), d AS (
            SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha1(body) AS payload_digest FROM p
        ), k AS (
            SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS kept FROM d
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> kept THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> kept THEN kept END AS refers_to
        FROM k
    """,
    "op12_hard_negatives": """
        WITH r AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS alike, list_inner_product(a.v, r.v)::BIGINT AS score
            FROM r AS a JOIN r ON a.vec_id <> r.vec_id
            WHERE a.vec_id % 50 = 0
        ), p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score
            FROM s WHERE alike
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT anchor_id, positive_id, row_number() OVER w AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE NOT s.alike AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
        WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
        QUALIFY row_number() OVER w <= 3
    """,
    "op13_ranked_search": """
        WITH t AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
            FROM documents
        ), i AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                               '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
            FROM benchmark
        ), tf AS (
            SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term
        ), len AS (
            SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id
        ), c AS (
            SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM len
        ), w AS (
            SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
            FROM tf, c WHERE term IN (SELECT term FROM i) GROUP BY term, n_docs
        ), scored AS (
            SELECT item_id, doc_id,
                   sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
            FROM i JOIN w USING (term) JOIN tf USING (term) JOIN len USING (doc_id), c
            GROUP BY item_id, doc_id
        )
        SELECT item_id, row_number() OVER v AS rank, doc_id, score
        FROM scored WHERE score > 0
        WINDOW v AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
        QUALIFY row_number() OVER v <= 50
    """,
}
