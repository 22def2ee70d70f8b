"""One query per operator, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm.byte_bpe import round_trip
from logloom.llm.decontaminate import decontaminate
from logloom.llm.embeddings import embedding_duplicates
from logloom.llm.exact_dedup import exact_dedup
from logloom.llm.jaccard import jaccard_components
from logloom.llm.licenses import scan_licenses
from logloom.llm.packing import pack_documents
from logloom.llm.revisits import captures_of, resolve_revisits
from logloom.llm.secrets import scan_secrets
from logloom.llm.surrogates import surrogate_documents
from logloom.llm.token_alignment import align_documents
from logloom.llm.toxicity import score_toxicity
from logloom.llm.vector_codes import vector_codes

# The key of the query; a job over texts of people needs one of its own, which nobody else knows.
TEST_KEY = "corpus"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patricia-trie owners of equal texts."""
    return exact_dedup(_table(spark, sf_dir, "documents"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of embeddings at cosine 0.95."""
    return embedding_duplicates(_table(spark, sf_dir, "embeddings"))


def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by surrogates."""
    return surrogate_documents(_table(spark, sf_dir, "documents"), TEST_KEY)


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose 5-word shingles overlap to 0.8 and more."""
    return jaccard_components(_table(spark, sf_dir, "documents"))


def op5_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisits of crawled pages with the responses they stand for; headers as sorted text."""
    found = resolve_revisits(captures_of(_table(spark, sf_dir, "pages")))
    lines = F.transform(F.map_entries("headers"), lambda x: F.concat_ws(": ", x["key"], x["value"]))
    return found.withColumn("headers", F.array_join(F.array_sort(lines), "; "))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids and their decoding, digested."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return round_trip(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as token pieces in sequences of at most 1024 tokens."""
    return pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret candidates with corpus-wide ownership."""
    return scan_secrets(_table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and signature rules."""
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category probabilities and the verdict of the classifier chain."""
    return score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents inside windows of benchmark items."""
    return decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level and piece tokens of documents, aligned and weighed over the corpus."""
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align_documents(_table(spark, sf_dir, "documents"), *paths)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of embeddings and their errors."""
    return vector_codes(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_pii_surrogates": op3_pii_surrogates,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_warc_revisits": op5_warc_revisits,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_toxicity": op7_toxicity,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_secret_scan": op9_secret_scan,
    "op10_license_scan": op10_license_scan,
    "op11_decontamination": op11_decontamination,
    "op12_token_alignment": op12_token_alignment,
    "op13_vector_codes": op13_vector_codes,
}

ORACLES: dict[str, str] = {
    "op1_exact_dedup": r"""
        WITH bodies AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
            FROM documents
        ), owned AS (
            SELECT doc_id, sha256(body) AS text_sha256, count(*) OVER (PARTITION BY body) AS group_size,
                   first_value(doc_id) OVER (PARTITION BY body ORDER BY n DESC, doc_id) AS keep_id
            FROM bodies
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM owned
    """,
    "op5_warc_revisits": r"""
        WITH parts AS (
            SELECT page_id AS n, coalesce(html, '') AS body,
                   regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest
            FROM pages
        ), keyed AS (
            SELECT n, body, page_at.moment AS "at", page_at.moment + (n % 9 + 1) * 3600 AS later,
                   regexp_replace(lower(regexp_extract(rest, '^(?:[^/?]*@)?([^/?]*)', 1)), '^www\.|:(?:80|443)$', '', 'g') AS host,
                   regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
                   list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'),
                       lambda x: x <> '' AND NOT regexp_matches(x, '^(?:utm_[^=]*|ref|fbclid|gclid|sessionid)(?:=|$)'))) AS query
            FROM parts, LATERAL (SELECT n * 60 AS moment) AS page_at
        ), named AS (
            SELECT *, host || path || CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END AS url_key,
                   '"' || substring(md5(body), 1, 16) || '"' AS tag, (n * 60 - n % 5000)::VARCHAR AS modified
            FROM keyed
        ), asked AS (
            SELECT n * 2 + 1 AS record_id, url_key, later AS "at", modified,
                   CASE WHEN n % 5 = 0 THEN NULL WHEN n % 11 = 0 THEN '"stale"' ELSE tag END AS tag
            FROM named
        ), joined AS (
            SELECT a.record_id, a.url_key, a."at", f.n * 2 AS response_id, f."at" AS response_at, a.tag, a.modified,
                   f.tag AS full_tag, sha1(f.body) AS sha, strlen(f.body) AS size,
                   CASE WHEN f.n IS NULL THEN NULL WHEN a.tag IS NOT NULL THEN 'etag' ELSE 'last-modified' END AS validator,
                   CASE WHEN f.n IS NULL THEN 'missing'
                        WHEN coalesce(a.tag = f.tag, a.modified = f.modified) THEN 'resolved' ELSE 'changed' END AS state
            FROM asked a ASOF LEFT JOIN named f ON a.url_key = f.url_key AND a."at" > f."at"
        )
        SELECT record_id, url_key, "at", response_id, response_at, validator, state,
               CASE WHEN state = 'resolved' THEN sha END AS digest, CASE WHEN state = 'resolved' THEN size END AS n_bytes,
               CASE WHEN state = 'resolved' THEN 'cache-control: max-age=60; content-type: text/html; date: ' || "at" || '; etag: '
                    || coalesce(tag, full_tag) || '; last-modified: ' || modified END AS headers
        FROM joined
    """,
    "op2_embedding_dedup": """
        WITH RECURSIVE vectors AS (
            SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
        ), links AS (
            SELECT a.vec_id AS u, b.vec_id AS w FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id
            WHERE list_dot_product(a.v, b.v) >= 0.95 * sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))
              AND list_dot_product(a.v, a.v) > 0 AND list_dot_product(b.v, b.v) > 0
        ), reached(vec_id, low) AS (
            SELECT vec_id, vec_id FROM vectors
            UNION SELECT l.w, r.low FROM reached r JOIN links l ON r.vec_id = l.u
        ), least AS (
            SELECT vec_id, min(low) AS component_id FROM reached GROUP BY vec_id
        )
        SELECT vec_id, (SELECT count(*) FROM links WHERE u = vec_id) AS n_links, component_id, vec_id = component_id AS kept
        FROM least
    """,
    "op4_ngram_jaccard": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM documents
        ), sets AS (
            SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
            FROM words
        ), shingles AS (
            SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets
        ), links AS (
            SELECT a.doc_id AS u, b.doc_id AS w FROM shingles a JOIN shingles b ON a.t = b.t AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id
            HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))
        ), reached(doc_id, low) AS (
            SELECT doc_id, doc_id FROM documents
            UNION SELECT l.w, r.low FROM reached r JOIN links l ON r.doc_id = l.u
        ), least AS (
            SELECT doc_id, min(low) AS component_id FROM reached GROUP BY doc_id
        )
        SELECT s.doc_id, len(s.s) AS n_shingles, component_id FROM sets s JOIN least USING (doc_id)
    """,
    "op11_decontamination": r"""
        WITH texts AS (
            SELECT row_number() OVER () AS n, doc_id, string_split_regex(trim(regexp_replace(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g')), ' +') AS w
            FROM documents
        ), docs AS (
            SELECT n, doc_id, list_filter(w, lambda x: x <> '') AS w FROM texts
        ), tests AS (
            SELECT item_id, list_filter(string_split_regex(trim(regexp_replace(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g')), ' +'),
                lambda x: x <> '') AS w
            FROM benchmark
        ), windows AS (
            SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS t
            FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
                  FROM (SELECT item_id, w, least(10, len(w)) AS k FROM tests WHERE len(w) > 0))
        ), places AS (
            SELECT n, i, k, array_to_string(w[i:i + k - 1], ' ') AS t
            FROM (SELECT n, w, k, unnest(range(1, len(w) - k + 2)) AS i
                  FROM docs CROSS JOIN (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)
        ), found AS (
            SELECT p.n, p.i, p.k, v.item_id FROM places p JOIN windows v ON p.k = v.k AND p.t = v.t
        ), hit AS (
            SELECT n, count(DISTINCT spot) AS n_hit FROM (SELECT n, unnest(range(i, i + k)) AS spot FROM found) GROUP BY n
        ), named AS (
            SELECT n, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS items
            FROM found GROUP BY n
        )
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN hit USING (n) LEFT JOIN named USING (n)
    """,
}
