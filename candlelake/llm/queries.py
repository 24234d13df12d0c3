"""Registered queries of the corpus operators, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from candlelake.llm import (
    byte_bpe, chat, exact, mixing, periodic, pieces, repair, sanitise, simhash, spotsigs, substrings,
    token_counts, toxicity)
from candlelake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
PIECE_MODEL = "piece_bpe_32k.model"
BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"


def piece_model() -> str:
    return public_tokenizers.path(PIECE_MODEL)


def op1_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_components(table(spark, folder, "documents"))


def op2_chat_perspectives(spark: SparkSession, folder: str) -> DataFrame:
    return chat.perspectives(table(spark, folder, "conversations"))


def op3_sanitise(spark: SparkSession, folder: str) -> DataFrame:
    return sanitise.span_report(table(spark, folder, "documents"))


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_digests(table(spark, folder, "documents"))


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.repeat_report(table(spark, folder, "documents"))


def op6_spot_signatures(spark: SparkSession, folder: str) -> DataFrame:
    return spotsigs.edited_report(table(spark, folder, "documents"))


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), piece_model())


def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encoded_digests(table(spark, folder, "documents"), piece_model())


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_report(table(spark, folder, "documents"))


def op11_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.encoded_digests(table(spark, folder, "documents"), public_tokenizers.path(BYTE_RANKS),
                                    public_tokenizers.PATTERN)


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.repair_report(table(spark, folder, "conversations"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic.run_report(table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {run.__name__: run for run in (
    op1_simhash_near_dedup, op2_chat_perspectives, op3_sanitise, op4_exact_dedup, op5_substring_dedup,
    op6_spot_signatures, op7_token_counts, op8_sentencepiece, op9_toxicity, op10_mixing,
    op11_byte_bpe, op12_conversation_repair, op13_periodic_runs)}

ORACLES: dict[str, str] = {
    "op2_chat_perspectives": r"""
        WITH turns AS (
          SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
          FROM conversations),
        speakers AS (SELECT DISTINCT conv_id, role AS speaker FROM turns WHERE role <> 'system'),
        said AS (
          SELECT t.conv_id, speaker, coalesce(CAST(floor(turn / 64) AS BIGINT), -1) AS part, turn, role, text,
                 role = speaker AS own,
                 '<|' || CASE WHEN role = speaker THEN 'assistant' WHEN role = 'system' THEN role
                         ELSE 'user ' || replace(role, '<|', '< |') END || '|>' || chr(10) AS head,
                 replace(text, '<|', '< |') || '<|end|>' || chr(10) AS body
          FROM turns t JOIN speakers s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
        placed AS (
          SELECT *, sum(length(head) + length(body)) OVER (
                   PARTITION BY conv_id, speaker, part ORDER BY turn NULLS LAST, role, text) AS high
          FROM said)
        SELECT conv_id, speaker, part, count(*) AS n_turns, count(*) FILTER (own) AS n_masked,
               string_agg(head || body, '' ORDER BY turn NULLS LAST, role, text) AS dialogue,
               coalesce(string_agg(CAST(high - length(body) AS BIGINT) || ':' || CAST(high AS BIGINT), ','
                        ORDER BY turn NULLS LAST, role, text) FILTER (own), '') AS mask
        FROM placed GROUP BY conv_id, speaker, part""",
    "op4_exact_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
                   FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM d""",
    "op10_mixing": r"""
        WITH d AS (
          SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
        k AS (
          SELECT doc_id, source, CAST(len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                 CAST(length(regexp_replace(t, '[^\p{L}\x20\x09-\x0D]', '', 'g')) AS DOUBLE)
                   / CAST(greatest(length(t), 1) AS DOUBLE) AS share,
                 (CAST(('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || t), 1, 12))
                   AS BIGINT) + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS draw
          FROM d),
        e AS (SELECT doc_id, source, size, -ln(draw) / greatest(share * share, 0.05::DOUBLE) AS key FROM k),
        s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM e GROUP BY source),
        w AS (
          SELECT *, 2 * source_size AS lim,
                 [5, 2, 1][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1] AS weight FROM s),
        o AS (
          SELECT *, row_number() OVER q AS place,
                 3 * sum(source_size) OVER () - 2 * coalesce(sum(lim) OVER p, 0) AS remains,
                 sum(weight) OVER () - coalesce(sum(weight) OVER p, 0) AS heavy
          FROM w WINDOW q AS (ORDER BY lim / weight, encode(source) NULLS LAST),
            p AS (ORDER BY lim / weight, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        f AS (SELECT *, CAST(lim AS HUGEINT) * heavy * 2 <= CAST(remains AS HUGEINT) * weight AS filled,
                     CAST(remains AS DOUBLE) / CAST(2 * heavy AS DOUBLE) AS level FROM o),
        g AS (SELECT source, source_size, CASE WHEN filled THEN CAST(lim AS DOUBLE)
                     ELSE (SELECT arg_min(level, place) FROM f WHERE NOT filled) * weight END AS target FROM f),
        r AS (SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0) AS epochs FROM g),
        c AS (
          SELECT e.doc_id, e.size, r.source_size, r.target, r.epochs, r.target - r.epochs * r.source_size AS rest,
                 coalesce(sum(e.size) OVER (PARTITION BY e.source ORDER BY e.key, e.doc_id, e.size
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done
          FROM e JOIN r ON e.source IS NOT DISTINCT FROM r.source)
        SELECT doc_id, size, source_size, target,
               CAST(size * (epochs + CASE WHEN 2 * done + size <= 2 * rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
        FROM c""",
}
