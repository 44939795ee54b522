"""Registered queries of the training-data operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import (best_fit, chunk_recipes, context_tree, hilbert, license_rules, permuterm, pii_bootstrap, quality_llr,
                          repair_ids, secret_scan, simhash_mih, son_phrases, winnow)
from tidemark.llm.common import read_table


def op1_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_bootstrap.extract(read_table(spark, sf_dir, "documents"))


def op2_quality_llr(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_llr.quality_rules(read_table(spark, sf_dir, "documents").select("doc_id", "text"),
                                       read_table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "llr_score")


def op3_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score(read_table(spark, sf_dir, "documents"))


def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnow.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op5_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = hilbert.assign_shards(read_table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "curve")


def op6_token_efficiency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(read_table(spark, sf_dir, "documents"))


def op7_signature_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_rules.scan(read_table(spark, sf_dir, "documents")).drop("detections")


def op8_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack_documents(read_table(spark, sf_dir, "documents"))


def op9_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_ids.round_trip(read_table(spark, sf_dir, "documents"))


def op10_simhash_mih(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_mih.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op11_son_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return son_phrases.collocations(read_table(spark, sf_dir, "documents"))


def op12_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_recipes.exact_groups(read_table(spark, sf_dir, "documents"))


def op13_permuterm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permuterm.variants(read_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_bootstrap, op2_quality_llr, op3_context_tree, op4_winnowing, op5_hilbert, op6_token_efficiency, op7_signature_rules,
    op8_best_fit, op9_repair, op10_simhash_mih, op11_son_phrases, op12_chunk_recipes, op13_permuterm)}
QUERIES["pipeline"] = corpus_pipeline.run

ORACLE: dict[str, str] = {
    "op4_winnowing": r"""
        WITH documents_words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        item_words AS (
            SELECT item_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        item_places AS (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s
                        FROM item_words WHERE len(w) > 0),
        windows AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS g FROM item_places),
        places AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
                   FROM documents_words, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
        hits AS (SELECT p.doc_id, p.n, p.s, x.item_id FROM places p
                 JOIN windows x ON x.n = p.n AND x.g = array_to_string(p.w[p.s:p.s + p.n - 1], ' ')),
        hit_words AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS place FROM hits) GROUP BY doc_id),
        hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
                      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
        SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM documents_words d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)""",
    "op11_son_phrases": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        words AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces),
        sizes AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
        places AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (SELECT unnest(range(1, 6)) AS k)),
        f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
              FROM places GROUP BY ALL HAVING count(*) >= 100),
        parts AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
        inner_starts AS (SELECT lang, w, f, m, unnest(range(1, k - m + 2)) AS i
                         FROM (SELECT lang, k, w, f, unnest(range(2, k)) AS m FROM parts)),
        around AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(f) AS around FROM inner_starts GROUP BY ALL),
        own AS (SELECT p.* FROM parts p LEFT JOIN around a USING (lang, phrase) WHERE a.around IS NULL OR 100 * a.around < 100 * p.f),
        cuts AS (SELECT lang, phrase, f AS a, j, array_to_string(w[:j], ' ') AS first, array_to_string(w[j + 1:], ' ') AS rest
                 FROM (SELECT *, unnest(range(1, k)) AS j FROM own)),
        scored AS (SELECT c.lang, c.phrase, c.a, c.j, l.f AS l, r.f AS r, s.n,
                          (1000::HUGEINT * c.a * s.n) // (l.f::HUGEINT * r.f) AS score
                   FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = c.first
                   JOIN f r ON r.lang = c.lang AND r.phrase = c.rest JOIN sizes s ON s.lang = c.lang),
        best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
        SELECT lang, row_number() OVER w AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
               score::BIGINT AS score
        FROM best WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
        QUALIFY rank <= 2000""",
    "op12_chunk_recipes": """
        WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
                   FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY t)""",
}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
