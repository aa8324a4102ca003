"""The training-data operators as queries over the input tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordwatch.llm import bpe, chat, exact_dedup, fingerprints, lexical_search, license_scan, line_dedup, mixing, packing, quality, simhash_dedup, spelling, toxicity
from recordwatch.llm.common import table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), radius=None)
    return found.select("doc_id", "n_lines", "n_kept", F.sha2("text", 256).alias("text_sha256"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_documents(table(spark, sf_dir, "documents"))


def op3_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate_digests(table(spark, sf_dir, "conversations"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op5_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_groups(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.document_words(table(spark, sf_dir, "documents")))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_license_scan,
        op3_chat_rotation,
        op4_fingerprints,
        op5_bpe_encoding,
        op6_exact_dedup,
        op7_toxicity,
        op8_simhash_near_dedup,
        op9_quality,
        op10_best_fit_packing,
        op11_source_mix,
        op12_spelling_variants,
        op13_lexical_search,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op6_exact_dedup": r"""
        WITH rows AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
        )
        SELECT doc_id,
               min(doc_id) OVER (PARTITION BY body) AS keep_id,
               count(*) OVER (PARTITION BY body) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY body) AS kept,
               sha256(body) AS text_sha256
        FROM rows
    """,
    "op3_chat_rotation": r"""
        WITH every AS (
            SELECT DISTINCT conv_id, coalesce(turn // 64, 4611686018427387904)::BIGINT AS segment,
                   coalesce(turn, 9223372036854775807)::BIGINT AS turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text
            FROM conversations
        ), parts AS (
            SELECT e.conv_id, p.perspective, e.segment, e.turn, e.speaker, e.text,
                   CASE WHEN e.speaker = p.perspective THEN '<|im_start|>assistant' || chr(10)
                        ELSE '<|im_start|>user name=' || e.speaker || chr(10) END AS head,
                   CASE WHEN e.speaker = p.perspective THEN '1' ELSE '0' END AS bit
            FROM every e JOIN (SELECT DISTINCT conv_id, speaker AS perspective FROM every) p ON e.conv_id IS NOT DISTINCT FROM p.conv_id
        ), whole AS (
            SELECT conv_id, perspective, segment, count(*) AS n_turns,
                   string_agg(head || text || '<|im_end|>' || chr(10), '' ORDER BY turn, speaker, text) AS rendered,
                   string_agg(repeat('0', length(head)) || repeat(bit, length(text) + 10) || '0', '' ORDER BY turn, speaker, text) AS mask
            FROM parts GROUP BY ALL
        )
        SELECT conv_id, perspective, segment,
               coalesce(sum(length(rendered)) OVER (PARTITION BY conv_id, perspective ORDER BY segment ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
               n_turns, length(rendered)::BIGINT AS n_chars, (length(mask) - length(replace(mask, '1', '')))::BIGINT AS n_learnt,
               sha256(rendered) AS rendered_sha256, sha256(mask) AS mask_sha256
        FROM whole
    """,
    "op11_source_mix": r"""
        WITH RECURSIVE sized AS (
            SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                   coalesce(doc_id::VARCHAR, sha256(coalesce(text, ''))) AS key
            FROM documents
        ), sources AS (
            SELECT source, sum(size)::BIGINT AS source_size, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
            FROM sized GROUP BY source
        ), level AS (
            SELECT 0 AS round, 1.5::DOUBLE * sum(source_size)::DOUBLE / sum(weight)::DOUBLE AS level, -1 AS n_full FROM sources
            UNION ALL
            SELECT round + 1, CASE WHEN free = 0 THEN 'inf'::DOUBLE ELSE (1.5::DOUBLE * total - full_words) / free END, n
            FROM (
                SELECT any_value(l.round) AS round, any_value(l.n_full) AS n_full, sum(source_size)::DOUBLE AS total,
                       coalesce(sum(2.0::DOUBLE * source_size) FILTER (WHERE 2.0::DOUBLE * source_size < l.level * weight), 0)::DOUBLE AS full_words,
                       coalesce(sum(weight) FILTER (WHERE NOT 2.0::DOUBLE * source_size < l.level * weight), 0)::DOUBLE AS free,
                       count(*) FILTER (WHERE 2.0::DOUBLE * source_size < l.level * weight) AS n
                FROM sources, level l
            ) WHERE n > n_full
        ), targets AS (
            SELECT s.*, least(2.0::DOUBLE * source_size, l.level * weight) AS target
            FROM sources s, (SELECT level FROM level ORDER BY round DESC LIMIT 1) l
        ), rates AS (
            SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole,
                   CASE WHEN source_size > 0 THEN target / source_size - floor(target / source_size) ELSE 0 END AS fraction
            FROM targets
        ), tried AS (
            SELECT d.source, k.seed, sum(CASE WHEN ('0x' || substr(md5(d.key || ':' || k.seed), 1, 12))::BIGINT::DOUBLE < r.fraction * 281474976710656 THEN d.size ELSE 0 END)
                   + any_value(r.whole * r.source_size) AS taken, any_value(r.target) AS target
            FROM sized d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source, (SELECT unnest(range(16)) AS seed) k
            GROUP BY d.source, k.seed
        ), seeds AS (
            SELECT source, seed FROM tried QUALIFY row_number() OVER (PARTITION BY source ORDER BY abs(taken - target), seed) = 1
        )
        SELECT d.doc_id, d.size, r.source_size, r.target,
               (d.size * (r.whole + CASE WHEN ('0x' || substr(md5(d.key || ':' || s.seed), 1, 12))::BIGINT::DOUBLE < r.fraction * 281474976710656 THEN 1 ELSE 0 END))::BIGINT AS taken
        FROM sized d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source JOIN seeds s ON d.source IS NOT DISTINCT FROM s.source
    """,
    "op13_lexical_search": r"""
        WITH words AS (
            SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents
        ), sizes AS (
            SELECT doc_id, terms, len(terms) AS n FROM words WHERE len(terms) > 0
        ), corpus AS (
            SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS all_terms FROM sizes
        ), postings AS (
            SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM sizes) GROUP BY ALL
        ), weights AS (
            SELECT term, floor(1000 * ln((2.0::DOUBLE * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM postings, corpus GROUP BY term
        ), asked AS (
            SELECT item_id, term, count(*) AS q
            FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
            GROUP BY ALL
        ), scores AS (
            SELECT item_id, doc_id, sum(q * w * ((1000000000::BIGINT * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // all_terms))))::BIGINT AS score
            FROM asked JOIN weights USING (term) JOIN postings USING (term), corpus
            GROUP BY ALL
        )
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
        FROM scores WHERE score > 0
        QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
    """,
}
