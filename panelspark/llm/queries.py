"""Registered queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import (
    langid,
    merkle,
    minhash,
    packing,
    quality_rules,
    sentencepiece_lattice,
    sharding,
    token_counts,
    topk,
    toxicity,
    url_filter,
    wavelet,
    whitening,
)
from panelspark.llm.common import held_out, table


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id of its class), kept (it is that document)."""
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, lexicon).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit integers)."""
    return sentencepiece_lattice.encoded_digest(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality_rules.apply_policy(quality_rules.ledger(table(spark, sf_dir, "documents")))
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failures")


def op7_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.wavelet_round_trip(table(spark, sf_dir, "documents")).select("doc_id", "start", "n_tokens", "ids_crc32")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_ledger(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.learn(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.learn(url_filter.labelled_frame(spark)))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_minhash_near_dedup,
        op2_sharding,
        op3_toxicity,
        op4_exact_top_k,
        op5_sentencepiece,
        op6_quality_rules,
        op7_token_binary,
        op8_token_counts,
        op9_packing,
        op10_language_id,
        op11_embedding_whitening,
        op12_url_filter,
        op13_merkle_manifest,
    )
}

_TOP_K_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         max(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0 GROUP BY 1, 2)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
WHERE place <= 5
"""

_QUALITY_SQL = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM t),
windows AS (
  SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS gram
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
again AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, gram) > 1),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY r),
lines AS (
  SELECT r, count(*) AS n, count(DISTINCT line) AS n_distinct
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM t)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (
  SELECT doc_id, len(ws) AS n_words,
    coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(l.n, 0) AS n_lines, coalesce(l.n - l.n_distinct, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
    len(list_filter(ws, lambda x: regexp_matches(x, '[A-Za-z\x{80}-\x{10FFFF}]'))) AS n_letter_words,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_letters
  FROM t JOIN w USING (r) LEFT JOIN covered c USING (r) LEFT JOIN lines l USING (r)),
f AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END) + (CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END)
    + (CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END) + (CASE WHEN word_chars > 14 * n_words THEN 32 ELSE 0 END)
    + (CASE WHEN 10 * n_letter_words < 6 * n_words THEN 64 ELSE 0 END) + (CASE WHEN 2 * n_upper > n_letters THEN 128 ELSE 0 END)
    AS failures FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, failures % 4 <> 0 AS base_failed, failures = 0 AS kept,
  CAST(failures AS BIGINT) AS failures
FROM f
"""

_MERKLE_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda v: list_reduce(list_prepend(v, range(8)),
    lambda c, i: xor(c >> 1, (c & 1) * 3988292384))) AS t),
d AS (
  SELECT row_number() OVER () AS r, doc_id, source, text,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS front,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS crc
  FROM documents, crc),
l AS (
  SELECT r, doc_id, source, sha256(front || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(front || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) AS damaged, crc
  FROM d),
placed AS (
  SELECT r, doc_id, leaf, CASE WHEN crc % 2 = 0 THEN damaged ELSE leaf END AS given,
    dense_rank() OVER (ORDER BY source NULLS FIRST) AS g,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS n
  FROM l),
low AS (
  SELECT g, 0 AS level, pos, n, leaf AS digest FROM placed
  UNION ALL
  SELECT g, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM low
  WHERE n > 1 GROUP BY g, level, pos // 3, n),
subroots AS (SELECT g, level AS height, digest FROM low WHERE n = 1),
high AS (
  SELECT 0 AS level, g - 1 AS pos, count(*) OVER () AS n, digest FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM high
  WHERE n > 1 GROUP BY level, pos // 3, n),
root AS (SELECT level AS height, digest FROM high WHERE n = 1),
steps AS (
  SELECT p.r, s.level AS k, string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos < p.pos // pow(3, s.level)::BIGINT) AS a,
    string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos > p.pos // pow(3, s.level)::BIGINT) AS b
  FROM placed p JOIN low s ON s.g = p.g AND s.n > 1 AND s.pos // 3 = p.pos // pow(3, s.level + 1)::BIGINT GROUP BY 1, 2
  UNION ALL
  SELECT p.r, u.height + s.level, string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos < (p.g - 1) // pow(3, s.level)::BIGINT),
    string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos > (p.g - 1) // pow(3, s.level)::BIGINT)
  FROM placed p JOIN subroots u ON u.g = p.g JOIN high s ON s.n > 1 AND s.pos // 3 = (p.g - 1) // pow(3, s.level + 1)::BIGINT
  GROUP BY 1, 2),
folded AS (
  SELECT r, 0 AS k, given AS x FROM placed
  UNION ALL
  SELECT f.r, f.k + 1, sha256(coalesce(s.a, '') || f.x || coalesce(s.b, '')) FROM folded f JOIN steps s ON s.r = f.r AND s.k = f.k),
last AS (SELECT r, arg_max(x, k) AS x FROM folded GROUP BY r),
proofs AS (SELECT r, sha256(string_agg(coalesce(a, '') || coalesce(b, ''), '' ORDER BY k)) AS proof FROM steps GROUP BY r)
SELECT p.doc_id, p.leaf, u.digest AS subroot, root.digest AS root, coalesce(q.proof, sha256('')) AS proof_sha256,
  f.x AS folded_root, f.x = root.digest AS verified
FROM placed p JOIN subroots u USING (g) JOIN last f USING (r) LEFT JOIN proofs q USING (r) CROSS JOIN root
"""

#: DuckDB SQL of the queries that SQL can express on whole tables in good time; tests/llm holds the others against
#: brute force, the tokenizer libraries, round trips or held-out labels.
ORACLE: dict[str, str] = {"op4_exact_top_k": _TOP_K_SQL, "op6_quality_rules": _QUALITY_SQL, "op13_merkle_manifest": _MERKLE_SQL}
