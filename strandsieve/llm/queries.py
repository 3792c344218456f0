"""The queries of this subpackage, each over its whole table with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strandsieve.llm import chunks, decontaminate, hardnegatives, mixing, neardup, pii, quality, secrets, substrings, token_files, tokens, urlfilter
from strandsieve.llm.common import table

TOKENIZER = "byte_bpe_50k.json"


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return tokens.length_histogram(lengths)


def op2_chunk_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.edited_fingerprints(table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op4_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge_urls(table(spark, sf_dir, "pages"))


def op5_passage_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.without_repeats(table(spark, sf_dir, "documents")).drop("n_factors")


def op8_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op10_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(table(spark, sf_dir, "documents"))


def op11_structural_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents")).drop("found")


def op12_pivot_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hardnegatives.mine(hardnegatives.quantised(table(spark, sf_dir, "embeddings")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_chunk_fingerprints,
        op3_token_files,
        op4_link_trust,
        op5_passage_attention,
        op6_near_duplicates,
        op7_repeated_passages,
        op8_benchmark_leaks,
        op9_personal_data,
        op10_entropy_mix,
        op11_structural_secrets,
        op12_pivot_negatives,
    )
}

_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

SQL: dict[str, str] = {
    "op6_near_duplicates": f"""
        WITH RECURSIVE w AS (
            SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS shingle FROM w
        ), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        both_ways AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
        ), link AS (
            SELECT x, y FROM both_ways JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)
        ), reach AS (
            SELECT x, y FROM link UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x
        ), least AS (SELECT x AS doc_id, min(y) AS y FROM reach GROUP BY x)
        SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(y, w.doc_id)) AS component_id, w.doc_id = least(w.doc_id, coalesce(y, w.doc_id)) AS kept
        FROM w LEFT JOIN n USING (doc_id) LEFT JOIN least USING (doc_id)""",
    "op7_repeated_passages": f"""
        WITH w AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
        windows AS (SELECT doc_id, i AS start, array_to_string(ws[i:i + 19], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 18, 1))) AS i FROM w)),
        again AS (SELECT doc_id, start FROM (SELECT doc_id, start, row_number() OVER (PARTITION BY k ORDER BY doc_id, start) AS r FROM windows) WHERE r > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(range(start, start + 20)) AS pos FROM again),
        word AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM w),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
        SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)""",
    "op12_pivot_negatives": """
        WITH e AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
            FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT a.vec_id AS anchor_id, e.vec_id AS id, a.label = e.label AS same, CAST(list_dot_product(a.v, e.v) AS BIGINT) AS score
            FROM e a, e WHERE a.vec_id % 100 = 0
        ), p AS (
            SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same AND id <> anchor_id
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
        )
        SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
            id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
        QUALIFY rank <= 5""",
}
