"""One registered query for each operator, over its whole table, and its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from granary.llm import (
    decontamination,
    embedding_dedup,
    jaccard_join,
    licence_scan,
    packing,
    quality,
    range_coder,
    role_repair,
    secret_scan,
    spelling_variants,
    suffix_dedup,
    token_counts,
    toxicity,
)
from granary.llm.tables import held_out, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"), learn=~held_out("doc_id", 5, 0))
    return quality.scored(docs, model)


@query
def op3_context_mixing_coder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return range_coder.written_and_read(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.benchmark_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"), learn=~held_out("doc_id", 3, 1))
    return toxicity.scored(docs, model)


@query
def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


@query
def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan.find_licences(table(spark, sf_dir, "documents"))


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(table(spark, sf_dir, "documents"), damage=spelling_variants.DAMAGE)


@query
def op12_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removed_repeats(table(spark, sf_dir, "documents"))


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return role_repair.conversation_repairs(table(spark, sf_dir, "conversations"), damage=True)


_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
ORACLES["op6_ngram_jaccard_join"] = rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), {_LETTERS}), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM worded
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT c.a, c.b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b WHERE 100 * c.n >= 75 * (x.n + y.n - c.n)
), reach AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), least AS (
  SELECT a, min(b) AS b FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, coalesce(l.b, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN least l ON l.a = d.doc_id
"""

ORACLES["op8_embedding_near_dedup"] = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e, len(embedding) AS n FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
    AND len(list_filter(embedding, lambda v: v <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.n = b.n AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(c.n, 0) AS n_links, least(v.vec_id, coalesce(l.b, v.vec_id)) AS component_id,
  least(v.vec_id, coalesce(l.b, v.vec_id)) = v.vec_id AS kept
FROM embeddings v LEFT JOIN least l ON l.a = v.vec_id LEFT JOIN counts c ON c.a = v.vec_id
"""


def _licence_sql() -> str:
    text = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"{text(s)}: {i}" for i, s in licence_scan.SENTENCES.items())
    rules = []
    for k, (licence, kind, rule) in enumerate(licence_scan.RULES):
        longer = [licence_scan._spaced(r[2]) for r in licence_scan.longer_rules(k)]
        rules.append(f"({text(licence)}, {text(kind)}, {rule[0]}, {len(rule)}, {text(licence_scan._spaced(rule))}, [{', '.join(map(text, longer))}]::VARCHAR[])")
    return rf"""
WITH sentences AS (
  SELECT doc_id, list_filter(list_transform(string_split_regex(text, {text(licence_scan.ENDS)}),
    lambda s: trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'))), lambda s: s <> '') AS s
  FROM documents WHERE regexp_matches(text, {text(licence_scan.HINT)})
), identified AS (
  SELECT doc_id, list_transform(s, lambda x: coalesce(MAP {{{known}}}[regexp_extract(x, {text(f'(?:^| )({licence_scan._KNOWN})(?: |$)')}, 1)], 0)) AS ids FROM sentences
), lines AS (
  SELECT doc_id, ids, ',' || array_to_string(list_filter(ids, lambda i: i > 0), ',,') || ',' AS line FROM identified
), rules(licence, kind, first_id, sentences, pattern, longer) AS (VALUES {', '.join(rules)})
SELECT doc_id, licence, kind, (list_position(ids, first_id) - 1)::INTEGER AS first_sentence, sentences
FROM lines JOIN rules ON regexp_matches(line, pattern) AND len(list_filter(longer, lambda p: regexp_matches(line, p))) = 0
"""


ORACLES["op10_licence_scan"] = _licence_sql()
