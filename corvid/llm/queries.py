"""Registered queries of the training-data operators, and their DuckDB SQL where SQL can
express them. Every query runs over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm import (bpe, clean_lines, divergence, importance, jaccard, lattice, licenses, line_dedup, mixing,
                        pii, secrets, spelling, token_counts)
from corvid.sources.tables import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _tokenizer() -> tuple[str, str]:
    """Rank file and split pattern of the tokenizer that production uses."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@_query
def op1_importance(spark, sf_dir):
    """Log weight, Gumbel key and decision of every document."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    scored = importance.resample(docs, load(spark, sf_dir, "labels"), keep_text=False)
    return scored.select("doc_id", "log_weight", "gumbel_key", "kept")


@_query
def op2_line_dedup(spark, sf_dir):
    """Line counts and the hash of the kept text of every document."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.dedup_lines(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLES["op2_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
firsts AS (SELECT k, min(doc_id) AS keeper FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) > 1),
judged AS (
  SELECT keyed.*, (keeper IS NOT NULL AND doc_id <> keeper) AS gone FROM keyed LEFT JOIN firsts USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@_query
def op3_secrets(spark, sf_dir):
    """Secrets of every document: counts, digest of the base spans, all spans."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    out = secrets.find_secrets(docs)
    return out.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


@_query
def op4_clean_lines(spark, sf_dir):
    """Figures and verdict of the quality rules for every document."""
    return clean_lines.judge(load(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False).drop("text")


@_query
def op5_jaccard(spark, sf_dir):
    """Similarity class and number of links of every document."""
    return jaccard.similarity_join(load(spark, sf_dir, "documents").select("doc_id", "text"))


@_query
def op6_bpe(spark, sf_dir):
    """Token ids of every document and the bytes they decode to, as digests."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, *_tokenizer()).drop("text")


@_query
def op7_lattice(spark, sf_dir):
    """Links, component and decision of every embedding."""
    return lattice.near_duplicates(load(spark, sf_dir, "embeddings"))


@_query
def op8_licenses(spark, sf_dir):
    """License notices of every document with spans and coverage."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    out = licenses.find_licenses(docs)
    return out.select("doc_id", "n_licenses", F.array_join("licenses", ",").alias("licenses"), "spans")


@_query
def op9_pii(spark, sf_dir):
    """Personal data of every document: counts, digest of the base spans, all spans."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    out = pii.find_personal_data(docs)
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                      F.sha2("base_spans", 256).alias("base_sha256"), "spans")


@_query
def op10_mixing(spark, sf_dir):
    """Target of every document's source and the words that the mix takes of it."""
    return mixing.mix_report(load(spark, sf_dir, "documents").select("doc_id", "text", "source"))


@_query
def op11_spelling(spark, sf_dir):
    """Words with their near words, form and root."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.group_variants(spelling.vocabulary(docs))


@_query
def op12_token_counts(spark, sf_dir):
    """Bytes and tokens of every document, and whether these are over the limit."""
    import public_tokenizers
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"), keep_text=False)


@_query
def op13_source_divergence(spark, sf_dir):
    """Distances of the sources of every language, and the terms that tell each source."""
    return divergence.audit(load(spark, sf_dir, "documents"))


ORACLES["op13_source_divergence"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         coalesce(text, '') AS text FROM documents),
found AS (
  SELECT d, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM docs),
kept AS (SELECT lang, term FROM found GROUP BY lang, term HAVING count(DISTINCT d) >= 30),
sizes AS (SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
held AS (SELECT lang, source, term, count(*)::HUGEINT AS c FROM found JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
totals AS (
  SELECT g.lang, g.source, coalesce(sum(c), 0)::HUGEINT AS n
  FROM groups g LEFT JOIN held h ON g.lang = h.lang AND g.source = h.source GROUP BY ALL),
figures AS (
  SELECT t.lang, t.source, k.term, coalesce(h.c, 0) AS c,
         1 + (1000000000 * (coalesce(h.c, 0) + 5)) // (t.n + 5 * s.v) AS p
  FROM totals t JOIN sizes s USING (lang) JOIN kept k USING (lang)
  LEFT JOIN held h ON h.lang = t.lang AND h.source = t.source AND h.term = k.term),
langs AS (
  SELECT k.lang, k.term, 1 + (1000000000 * (sum(c) + 5)) // (any_value(a.n) + 5 * any_value(s.v)) AS q
  FROM kept k JOIN held USING (lang, term) JOIN sizes s USING (lang)
  JOIN (SELECT lang, sum(n) AS n FROM totals GROUP BY lang) a USING (lang) GROUP BY k.lang, k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN figures x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN figures y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL),
parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM figures JOIN langs USING (lang, term) WHERE c > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM parts)
SELECT lang, source, part, item, value::BIGINT AS value, r::INT AS rank FROM ranked WHERE part = 'pair' OR r <= 50
"""
