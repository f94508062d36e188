"""The operators on the given tables with production parameters, and the same in SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import link_digests
from .boilerplate import dedup_lines
from .byte_pairs import byte_pair_digests
from .common import ship
from .embedding_pairs import link_vectors
from .filter_audit import audit_filters
from .language import identify_language
from .mixing import mix_sources
from .neighbours import nearest_neighbours
from .packing import pack_documents
from .pseudo_likelihood import score_texts
from .repeats import remove_repeats
from .secrets import scan_secrets
from .simhash import simhash_groups

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents"))


def op2_scan_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(_table(spark, sf_dir, "documents"))


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return nearest_neighbours(rows, rows.filter("vec_id % 50 = 0"))


def op4_score_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(_table(spark, sf_dir, "documents"))


def op5_link_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(_table(spark, sf_dir, "embeddings"))


def op6_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(_table(spark, sf_dir, "documents"))


def op7_dedup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return rows.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op8_identify_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify_language(docs, vocabulary=PIECES).select("doc_id", "held_out", "lang_pred", "score")


def op9_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), vocabulary=WORDS)


def op10_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents")).drop("spans")


def op11_audit_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return byte_pair_digests(docs, vocabulary=RANKS, pattern=public_tokenizers.PATTERN)


def op13_align_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_digests(_table(spark, sf_dir, "documents"), a_vocabulary=BYTES, b_vocabulary=PIECES)


QUERIES = {
    f.__name__: f
    for f in (
        op1_mix_sources, op2_scan_secrets, op3_nearest_neighbours, op4_score_texts, op5_link_vectors,
        op6_simhash_groups, op7_dedup_lines,
        op8_identify_language, op9_pack_documents, op10_remove_repeats,
        op11_audit_filters, op12_byte_pairs, op13_align_tokens,
    )
}

_WORD = r"[^\x20\x09-\x0D]+"

_OP1 = rf"""
WITH sized AS (
  SELECT doc_id, source, md5(concat_ws(':', '1', CAST(doc_id AS VARCHAR), text)) AS key,
         coalesce(len(regexp_extract_all(text, '{_WORD}')), 0) AS size
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS DOUBLE) AS weight,
         3.0::DOUBLE * source_size AS most, CAST(sum(source_size) OVER () AS DOUBLE) AS whole
  FROM sizes),
levels AS (
  SELECT *, (whole - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST
                                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
targets AS (SELECT source, source_size, least(most, max(level) OVER () * weight) AS target FROM levels),
placed AS (
  SELECT sized.doc_id, size, source_size, target, CAST(floor(target) AS BIGINT) AS budget,
         CAST(sum(size) OVER (PARTITION BY sized.source ORDER BY key, doc_id, size
                              ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS before
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(coalesce(budget // nullif(source_size, 0), 0) * size
            + greatest(0, least(size, coalesce(budget % nullif(source_size, 0), 0) - before)) AS BIGINT) AS taken
FROM placed"""

_ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
)
_KINDS = {
    "assign": (_ASSIGN, 2, "length(value) >= 12"),
    "access": ("AKIA[A-Z0-9]+", 0, "length(value) >= 18"),
    "hex": ("[0-9a-f]+", 0, "length(value) >= 16"),
    "token": (
        "[A-Za-z0-9+/_-]{20,}", 0,
        "regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')",
    ),
}
_FOUND = " UNION ALL ".join(
    f"""SELECT doc_id, source, {n} AS kind, unnest(generate_series(1, len(m))) AS turn,
         unnest(list_transform(m, lambda x: length(x))) AS long, unnest(v) AS value,
         unnest(list_transform(g[1:len(m)], lambda x: length(x))) AS gap
  FROM (SELECT doc_id, source, regexp_extract_all(text, '{rule}', 0) AS m,
               regexp_extract_all(text, '{rule}', {group}) AS v, string_split_regex(text, '{rule}') AS g
        FROM documents)"""
    for n, (rule, group, _) in enumerate(_KINDS.values())
)
_OP2 = f"""
WITH found AS ({_FOUND}),
located AS (
  SELECT *, CAST(sum(gap + long) OVER (PARTITION BY doc_id, kind ORDER BY turn) AS BIGINT) AS stop FROM found),
valid AS (
  SELECT doc_id, source, kind, value, stop - long AS start, stop FROM located
  WHERE CASE kind {" ".join(f"WHEN {n} THEN {rule}" for n, (_, _, rule) in enumerate(_KINDS.values()))} END),
counts AS (
  SELECT value, count(DISTINCT doc_id) <= 3 AND count(DISTINCT source) <= 1 AS live FROM valid GROUP BY value),
judged AS (SELECT * FROM valid JOIN counts USING (value)),
kept AS (
  SELECT * FROM judged j WHERE kind < 3 OR live AND NOT EXISTS (
    SELECT 1 FROM judged b WHERE b.kind < 3 AND b.doc_id = j.doc_id AND b.start < j.stop AND j.start < b.stop)),
listed AS (
  SELECT *, concat_ws(':', ['assign', 'access', 'hex', 'token'][kind + 1], start, stop) AS span FROM kept),
per_doc AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
         count(*) FILTER (kind = 2) AS n_hex, count(*) FILTER (kind = 3) AS n_token,
         count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_copied,
         string_agg(span, ',' ORDER BY start, kind, stop) FILTER (kind < 3) AS base,
         string_agg(span, ',' ORDER BY start, kind, stop) AS spans
  FROM listed GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_token, 0) AS n_token,
       coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM documents LEFT JOIN per_doc USING (doc_id)"""

_OP7 = r"""
WITH lines AS (
  SELECT doc_id, source, unnest(l) AS line, unnest(generate_series(1, len(l))) AS turn
  FROM (SELECT doc_id, source, string_split(text, chr(10)) AS l FROM documents)),
shared AS (
  SELECT line, min((doc_id, turn)) AS first FROM lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY line HAVING count(DISTINCT source) >= 5),
marked AS (
  SELECT doc_id, turn, lines.line, first IS NOT NULL AND (doc_id, turn) > first AS gone
  FROM lines LEFT JOIN shared USING (line))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY turn) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""

_OP11 = rf"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words
  FROM documents),
known AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
         max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
firsts AS (SELECT text, min(doc_id) AS first FROM texts GROUP BY text),
judged AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         concat(CASE WHEN len(words) < 50 THEN 'A' ELSE '' END,
                CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END,
                CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END,
                CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END,
                CASE WHEN first IS NOT NULL AND (doc_id IS NULL OR doc_id > first) THEN 'E' ELSE '' END) AS failed
  FROM texts JOIN firsts USING (text) LEFT JOIN known USING (doc_id)),
masks AS (
  SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY part, failed),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter),
orders AS (
  SELECT '' AS filter_order
  UNION ALL
  SELECT filter_order || letter FROM orders, letters WHERE NOT contains(filter_order, letter)),
steps AS (
  SELECT filter_order, step, filter_order[step] AS letter, filter_order[1:step - 1] AS earlier
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step) WHERE length(filter_order) = 5),
counted AS (
  SELECT part, filter_order, step, letter,
         sum(CASE WHEN before OR now THEN 0 ELSE n END) AS kept,
         sum(CASE WHEN now AND NOT before THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN now AND before THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN failed = letter THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN now AND NOT before THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN now AND NOT before THEN toxic ELSE 0 END) AS toxic_lost
  FROM (SELECT *, contains(failed, letter) AS now,
               len(list_intersect(string_split(failed, ''), string_split(earlier, ''))) > 0
                 AND failed <> '' AND earlier <> '' AS before
        FROM masks, steps)
  GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counted"""

ORACLES = {
    "op1_mix_sources": _OP1, "op2_scan_secrets": _OP2, "op7_dedup_lines": _OP7, "op11_audit_filters": _OP11,
}
