"""Registered queries of this subpackage: each applies one operator with
production parameters to its whole table and derives the digest columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import (best_fit_packing, byte_bpe, collocations, decontaminate, embedding_dedup, html_text, language_id,
                          line_dedup, pii, simhash_dedup, toxicity, vector_codes, warc)
from footfall.llm.stages import held_out

BPE_RANKS = "byte_bpe_multi_50k.tiktoken"
PACKING_VOCABULARY = "byte_bpe_50k.json"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.simhash_components(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(_read(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    model = toxicity.learn(docs, _read(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model, "score").select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_components(_read(spark, sf_dir, "embeddings"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", *[pii.count_of(k).alias(f"n_{k}") for k in pii.KINDS],
                        F.sha2(pii.listed("spans"), 256).alias("base_sha256"),
                        pii.listed("spans", "terms").alias("spans"), pii.actions("terms").alias("term_actions"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(_read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op8_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.parse_records(warc.crawl_of_pages(_read(spark, sf_dir, "pages")), with_payload=False)
    header = [F.col("headers")[h].alias(a) for h, a in (
        ("etag", "etag"), ("cache-control", "cache_control"), ("content-type", "content_type"), ("server", "server"))]
    return warc.resolve_revisits(records).select(
        F.col("record_id").cast("long").alias("record_id"), "canonical_url", "captured_at", "outcome",
        F.col("response_id").cast("long").alias("response_id"), "payload_bytes", "payload_sha256", *header)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(_read(spark, sf_dir, "documents"), public_tokenizers.path(BPE_RANKS),
                               public_tokenizers.PATTERN)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.learn(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_read(spark, sf_dir, "documents"))


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing.pack_documents(_read(spark, sf_dir, "documents"), public_tokenizers.path(PACKING_VOCABULARY),
                                           public_tokenizers.PATTERN)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, _ = vector_codes.compress(_read(spark, sf_dir, "embeddings"))
    return codes.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_simhash_dedup": op2_simhash_dedup,
    "op3_line_dedup": op3_line_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_pii": op6_pii,
    "op7_html_text": op7_html_text,
    "op8_warc_revisits": op8_warc_revisits,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_language_id": op10_language_id,
    "op11_collocations": op11_collocations,
    "op12_best_fit_packing": op12_best_fit_packing,
    "op13_vector_codes": op13_vector_codes,
}

_LINE_DEDUP_SQL = r"""
WITH lines AS (
    SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
    SELECT doc_id, pos, line,
           translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), repeated AS (
    SELECT key, max(doc_id) AS keeper FROM keyed
    WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
    SELECT k.doc_id, k.pos, k.line, r.key IS NOT NULL AND k.doc_id <> r.keeper AS gone
    FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_EMBEDDING_SQL = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v,
           coalesce(len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
                    AND list_sum(list_transform(embedding, lambda c: CAST(c AS DOUBLE) * c)) > 0, false) AS usable
    FROM embeddings
), links AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM vectors a JOIN vectors b
    ON a.vec_id <> b.vec_id AND a.usable AND b.usable AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.95
), reach(x, y) AS (
    SELECT vec_id, vec_id FROM vectors UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), roots AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT v.vec_id, (SELECT count(*) FROM links l WHERE l.x = v.vec_id)::BIGINT AS n_links, r.component_id,
       v.vec_id = r.component_id AS kept
FROM vectors v JOIN roots r ON r.x = v.vec_id
"""

_WARC_SQL = r"""
WITH captures AS (
    SELECT page_id, html, sha256(html) AS digest, strlen(html) AS bytes,
           1700000000 + 60 * page_id AS at,
           ltrim(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), ' ') AS host,
           regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path,
           regexp_extract(url, '^[^?#]*[?]([^#]*)', 1) AS query
    FROM pages
), named AS (
    SELECT *, regexp_replace(regexp_replace(lower(host), ':(80|443)?$', ''), '^www[.]', '')
           || CASE WHEN path = '' THEN '/' ELSE path END AS place,
           list_sort([p FOR p IN string_split(query, '&') IF p <> ''
               AND NOT regexp_full_match(string_split(p, '=')[1],
                   '(?i)utm_[a-z]+|ref|fbclid|gclid|sessionid|phpsessid|jsessionid')]) AS kept
    FROM captures
), keyed AS (
    SELECT *, place || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS canonical_url,
           CASE WHEN page_id % 10 <> 5 THEN substr(digest, 1, 16) END AS tag,
           CASE WHEN page_id % 20 = 5 THEN 'day 5' WHEN page_id % 10 = 5 THEN 'day 6' END AS modified
    FROM named
), revisits AS (
    SELECT page_id, page_id % 10 AS kind, keyed.at + 86400 AS captured_at,
           CASE WHEN page_id % 10 = 9 THEN 'never.captured/' || page_id ELSE canonical_url END AS canonical_url,
           CASE page_id % 10 WHEN 3 THEN 'changed' WHEN 5 THEN NULL WHEN 7 THEN NULL ELSE tag END AS tag,
           CASE WHEN page_id % 10 = 5 THEN 'day 5' END AS modified
    FROM keyed
), found AS (
    SELECT r.*, max(f.page_id) AS response
    FROM revisits r LEFT JOIN keyed f ON f.canonical_url = r.canonical_url AND f.at < r.captured_at
    GROUP BY ALL
), judged AS (
    SELECT r.*, f.bytes, f.digest,
           CASE WHEN f.page_id IS NULL THEN 'missing'
                WHEN r.tag IS NOT NULL AND f.tag IS NOT NULL THEN CASE WHEN r.tag = f.tag THEN 'resolved' ELSE 'mismatch' END
                WHEN r.modified IS NOT NULL AND f.modified IS NOT NULL
                THEN CASE WHEN r.modified = f.modified THEN 'resolved' ELSE 'mismatch' END
                ELSE 'unverified' END AS outcome, f.tag AS response_tag
    FROM found r LEFT JOIN keyed f ON f.page_id = r.response
)
SELECT 2 * page_id + 1 AS record_id, canonical_url, captured_at, outcome,
       CASE WHEN outcome = 'resolved' THEN 2 * response END AS response_id,
       CASE WHEN outcome = 'resolved' THEN bytes END AS payload_bytes,
       CASE WHEN outcome = 'resolved' THEN digest END AS payload_sha256,
       CASE WHEN kind = 3 THEN '"changed"' WHEN tag IS NOT NULL THEN 'W/"' || tag || '"'
            WHEN outcome = 'resolved' THEN '"' || response_tag || '"' END AS etag,
       'max-age=7200' AS cache_control,
       CASE WHEN outcome = 'resolved' THEN 'text/html' END AS content_type,
       CASE WHEN outcome <> 'resolved' THEN 'again' END AS server
FROM judged
"""

_COLLOCATION_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), worded AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces
), placed AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM worded),
totals AS (SELECT lang, count(*) AS n FROM placed GROUP BY lang),
grams AS (
    SELECT lang, words[i] AS phrase, 1 AS size FROM placed
    UNION ALL SELECT lang, words[i] || ' ' || words[i + 1], 2 FROM placed WHERE i + 1 <= len(words)
    UNION ALL SELECT lang, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2], 3 FROM placed WHERE i + 2 <= len(words)
), counts AS MATERIALIZED (
    SELECT lang, phrase, size, count(*) AS a, string_split(phrase, ' ') AS w FROM grams GROUP BY lang, phrase, size
    HAVING count(*) >= 10
), cuts AS (
    SELECT lang, phrase, size, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
    FROM (SELECT *, unnest(range(1, size)) AS k FROM counts WHERE size > 1)
), scored AS (
    SELECT c.lang, c.phrase, c.size, c.a, l.a AS l, r.a AS r, c.k,
           ((1000000::HUGEINT * c.a * c.a) // (l.a::HUGEINT * r.a))::BIGINT AS score
    FROM cuts c JOIN counts l ON l.lang = c.lang AND l.phrase = c.head
    JOIN counts r ON r.lang = c.lang AND r.phrase = c.tail
), weakest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
    SELECT lang, phrase, max(a) AS longer FROM (
        SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM counts WHERE size = 3
        UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM counts WHERE size = 3) GROUP BY lang, phrase
), ranked AS (
    SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank,
           s.phrase, a, l, r, score
    FROM weakest s LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase
    WHERE i.longer IS NULL OR 100 * i.longer < 50 * s.a
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def _vector_code_sql(parts: int = vector_codes.PARTS, entries: int = vector_codes.ENTRIES,
                     rounds: int = vector_codes.ROUNDS, scale: int = vector_codes.SCALE) -> str:
    """Plain k-means: every part against every entry, in each round."""
    steps = [f"""WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS HUGEINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), numbered AS (SELECT *, row_number() OVER (ORDER BY vec_id) - 1 AS place FROM kept),
parts AS MATERIALIZED (
    SELECT vec_id, label, place, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS v
    FROM numbered, range({parts}) t(p)
), book0 AS MATERIALIZED (SELECT p, place AS entry, v FROM parts WHERE place < {entries})"""]
    for i in range(rounds + 1):
        steps.append(f"""near{i} AS MATERIALIZED (
    SELECT x.vec_id, x.label, x.p, x.v, min(CAST({entries} AS HUGEINT) * list_sum(list_transform(list_zip(x.v, b.v),
        lambda z: (z[1] - z[2]) * (z[1] - z[2]))) + b.entry) AS best
    FROM parts x JOIN book{i} b ON b.p = x.p GROUP BY x.vec_id, x.label, x.p, x.v
)""")
        if i < rounds:
            steps.append(f"""mean{i} AS (
    SELECT p, entry, list(m ORDER BY j) AS v FROM (
        SELECT p, entry, j, CAST((s - ((s % n) + n) % n) // n AS HUGEINT) AS m FROM (
            SELECT p, best % {entries} AS entry, j, sum(x) AS s, CAST(count(*) AS HUGEINT) AS n FROM (
                SELECT p, best, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM near{i}) GROUP BY ALL)
    ) GROUP BY p, entry
), book{i + 1} AS MATERIALIZED (
    SELECT b.p, b.entry, coalesce(m.v, b.v) AS v FROM book{i} b LEFT JOIN mean{i} m ON m.p = b.p AND m.entry = b.entry
)""")
    return ",\n".join(steps) + f""", coded AS (
    SELECT vec_id, label, string_agg(printf('%02x', CAST(best % {entries} AS INTEGER)), '' ORDER BY p) AS code,
           CAST(sum(best // {entries}) AS BIGINT) AS error
    FROM near{rounds} GROUP BY vec_id, label
), digest AS (
    SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, entry)) AS codebooks_sha256 FROM book{rounds}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded, digest"""


ORACLE: dict[str, str] = {
    "op3_line_dedup": _LINE_DEDUP_SQL,
    "op5_embedding_dedup": _EMBEDDING_SQL,
    "op8_warc_revisits": _WARC_SQL,
    "op11_collocations": _COLLOCATION_SQL,
    "op13_vector_codes": _vector_code_sql(),
}
