"""The registered queries of this subpackage, and their oracle SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plinth.llm.exact_dedup import exact_dedup
from plinth.llm.jaccard_join import link_documents
from plinth.llm.licenses import GAP, LEAST, NOTICES, PHRASES, scan_licenses, verified_licenses
from plinth.llm.mixing import mix
from plinth.llm.oracles import OP8_SQL, OP10_SQL
from plinth.llm.packing import default_tokenizer, pack
from plinth.llm.pii import find_pii
from plinth.llm.spotsigs import fingerprint_documents
from plinth.llm.substring_dedup import dedup_substrings
from plinth.llm.suffix_dedup import find_repeats
from plinth.llm.toxicity import learn, score_toxicity


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(_documents(spark, sf_dir))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_documents(spark, sf_dir))


def op4_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(_documents(spark, sf_dir))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return score_toxicity(docs, learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_repeats(_documents(spark, sf_dir))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_documents(spark, sf_dir), default_tokenizer())


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(_documents(spark, sf_dir))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verified_licenses(_documents(spark, sf_dir))


def license_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the votes of op9 tell before spans are verified: SQL can state that much."""
    return scan_licenses(_documents(spark, sf_dir))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(_documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mixing": op1_mixing,
        "op2_pii": op2_pii,
        "op3_exact_dedup": op3_exact_dedup,
        "op4_spotsigs": op4_spotsigs,
        "op5_toxicity": op5_toxicity,
        "op6_suffix_dedup": op6_suffix_dedup,
        "op7_packing": op7_packing,
        "op8_jaccard_join": op8_jaccard_join,
        "op9_licenses": op9_licenses,
        "op10_substring_dedup": op10_substring_dedup,
        "license_votes": license_votes,
    }


OP1_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS key
  FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END::DOUBLE AS weight FROM sizes),
placed AS (SELECT *, row_number() OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST) AS place FROM weighed),
levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(source_size) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 2.0::DOUBLE)
            / sum(weight) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM placed),
final AS (SELECT min_by(level, place) AS level FROM levels WHERE level < 2.0 * source_size / weight),
plan AS (
  SELECT source, source_size, CASE WHEN f.level IS NULL THEN 2.0 * source_size ELSE least(2.0 * source_size, f.level * weight) END::DOUBLE AS target
  FROM levels l LEFT JOIN final f ON TRUE),
passes AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS passes FROM plan),
keys AS (SELECT source, key, sum(size) AS size FROM docs GROUP BY source, key),
upto AS (SELECT source, key, size, sum(size) OVER (PARTITION BY source ORDER BY key) AS upto FROM keys),
taken AS (
  SELECT u.source, u.key FROM upto u JOIN passes p ON u.source IS NOT DISTINCT FROM p.source
  WHERE p.target - p.passes * p.source_size > 0 AND u.upto + (u.upto - u.size) <= 2 * (p.target - p.passes * p.source_size))
SELECT d.doc_id, d.size, p.source_size, p.target, (d.size * (p.passes + CASE WHEN t.key IS NULL THEN 0 ELSE 1 END))::BIGINT AS taken
FROM docs d JOIN passes p ON d.source IS NOT DISTINCT FROM p.source
LEFT JOIN taken t ON d.key = t.key AND d.source IS NOT DISTINCT FROM t.source
"""

OP3_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


_TEMPLATES = ", ".join(
    f"('{label}', {base}, {at}, {len(words) - 1}, '{a}', '{b}')"
    for base, listed in (("true", PHRASES), ("false", NOTICES))
    for label, text in listed
    for words in [text.split()]
    for at, (a, b) in enumerate(zip(words, words[1:], strict=False))
)

VOTES_SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
words AS (SELECT row, unnest(words) AS a, generate_subscripts(words, 1) - 1 AS pos FROM docs),
grams AS (SELECT row, pos, a, lead(a) OVER (PARTITION BY row ORDER BY pos) AS b FROM words),
t(label, base, tpos, n, a, b) AS (VALUES {_TEMPLATES}),
votes AS (SELECT DISTINCT g.row, t.label, t.base, t.n, g.pos - t.tpos AS diagonal, t.tpos FROM grams g JOIN t ON g.a = t.a AND g.b = t.b),
diagonals AS (SELECT DISTINCT row, label, diagonal, base FROM votes),
steps AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY row, label ORDER BY diagonal) <= CASE WHEN base THEN 0 ELSE {GAP} END THEN 0 ELSE 1 END AS apart FROM diagonals),
bands AS (SELECT row, label, diagonal, sum(apart) OVER (PARTITION BY row, label ORDER BY diagonal ROWS UNBOUNDED PRECEDING) AS band FROM steps),
spans AS (SELECT v.row, v.label, v.base, min(v.diagonal) AS start, count(DISTINCT v.tpos)::DOUBLE / v.n AS part FROM votes v JOIN bands b ON v.row = b.row AND v.label = b.label AND v.diagonal = b.diagonal GROUP BY v.row, v.label, v.base, v.n, b.band),
found AS (
  SELECT row, count(*) FILTER (WHERE base AND part = 1) AS n_base, min(start) FILTER (WHERE base AND part = 1) AS first_word, max(start) FILTER (WHERE base AND part = 1) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base AND part = 1) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base AND part = 1 OR NOT base AND part >= {LEAST}) AS labels, max(part) AS score
  FROM spans GROUP BY row)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM docs LEFT JOIN found USING (row)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_mixing": OP1_SQL, "op3_exact_dedup": OP3_SQL, "op8_jaccard_join": OP8_SQL, "op10_substring_dedup": OP10_SQL, "license_votes": VOTES_SQL}
