"""Queries that apply each operator to its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spokeline.llm import (
    byte_repeats,
    chat_format,
    chat_repair,
    exact_dedup,
    mixing,
    near_dedup,
    pieces,
    quality,
    sharding,
    token_counts,
    token_files,
    whitening,
    word_repeats,
)
from spokeline.llm.tables import documents
from spokeline.session import scratch_root

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(documents(spark, sf_dir), 16)


def op3_word_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_repeats.without_repeats(documents(spark, sf_dir)).drop("kept_text")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{scratch_root(spark)}/tokens-{uuid.uuid4().hex}"
    token_files.write_tokens(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), folder)
    return token_files.read_tokens(spark, folder)


def op6_byte_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_repeats.without_repeats(documents(spark, sf_dir)).drop("kept")


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir), shingle_words=4)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pieces.encode_decode(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", "n_pieces", "ids_crc32", F.sha2("decoded", 256).alias("decoded_sha256"), "round_trip")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "host_rejected", "kept",
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return rows.withColumn("deviation", F.col("deviation").cast("long"))


# A conversation whose texts look like the template's own marks.
CONTROL_TEXT = r"\### Assistant: </turn> ok"


def _conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _conversations(spark, sf_dir)
    marks = [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)]
    formatted = chat_format.format_chats(rows.union(spark.createDataFrame(marks, rows.schema)))
    return chat_format.read_digests(formatted)


def op13_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat_repair.damaged(_conversations(spark, sf_dir))
    return chat_repair.repairs(rows, absent="absent")


def queries() -> dict[str, Query]:
    found = (
        op1_token_counts, op2_sharding, op3_word_repeats, op4_mixing, op5_token_files, op6_byte_repeats,
        op7_near_dedup, op8_exact_dedup, op9_sentencepiece, op10_quality_rules, op11_whitening,
        op12_chat_format, op13_chat_repair,
    )
    return {q.__name__: q for q in found}


# Quality rules and host verdicts, in one place for op10 and the pipeline.
QUALITY_SQL = r"""
words AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM words WHERE len(w) > 8)),
repeated AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT doc_id, sum(least(8, coalesce(following - i, 8)))::BIGINT AS n
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS following FROM repeated)
  GROUP BY doc_id),
lines AS (
  SELECT doc_id, (count(*) - count(DISTINCT line))::BIGINT AS n
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM words)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
measured AS (
  SELECT d.doc_id, source, len(w)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(l.n, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM words d LEFT JOIN covered c USING (doc_id) LEFT JOIN lines l USING (doc_id)),
judged AS (
  SELECT *, n_words < 20 AS short, 100 * n_repeat_words > 30 * n_words AS repeats FROM measured),
failures AS (
  SELECT source, rule, count(*) AS n, sum(f::INT) AS f
  FROM (SELECT source, unnest(['short', 'repeats']) AS rule, unnest([short, repeats]) AS f FROM judged)
  GROUP BY ALL),
moments AS (
  SELECT rule, sum(f) / sum(n) AS mean, count(*) / sum(n) AS hosts_a_doc,
         sum(f * f / n) / sum(n) - (sum(f) / sum(n)) ^ 2 AS var
  FROM failures GROUP BY rule),
priors AS (
  SELECT rule, mean,
         CASE WHEN var - mean * (1 - mean) * hosts_a_doc > 0
              THEN least(10000, greatest(1, mean * (1 - mean) / (var - mean * (1 - mean) * hosts_a_doc) - 1))
              ELSE 10000 END AS weight
  FROM moments),
hosts AS (
  SELECT source, bool_or((f + mean * weight) / (n + weight) > 0.5) AS host_rejected
  FROM failures JOIN priors USING (rule) GROUP BY source),
verdicts AS (
  SELECT j.*, short OR repeats AS base_failed, host_rejected,
         NOT (short OR repeats OR host_rejected) AS kept
  FROM judged j JOIN hosts h ON j.source IS NOT DISTINCT FROM h.source)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix:' || doc_id) AS shuffled
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS s, row_number() OVER (ORDER BY source NULLS LAST) AS nth
  FROM sized GROUP BY source),
weighted AS (SELECT *, [5, 2, 1][(nth - 1) % 3 + 1] AS w, sum(s) OVER ()::BIGINT AS total FROM sources),
tried AS (  -- every size per weight as the last one that stops at three times its size
  SELECT a.total - coalesce(sum(3 * b.s) FILTER (stops), 0) AS remaining,
         coalesce(sum(b.w) FILTER (NOT stops), 0) AS open_weight, any_value(level) AS level
  FROM (SELECT DISTINCT level, total FROM (SELECT s / w AS level, total FROM weighted UNION ALL SELECT -1, total FROM weighted)) a,
       LATERAL (SELECT s, w, s / w <= level AS stops FROM weighted) b
  GROUP BY a.level, a.total),
best AS (  -- the fewest that stop such that nobody else is above
  SELECT t.* FROM tried t
  WHERE NOT EXISTS (SELECT 1 FROM weighted w WHERE w.s / w.w > t.level
                    AND t.remaining * w.w / t.open_weight > 3 * w.s)
  ORDER BY level LIMIT 1),
targets AS (
  SELECT source, s AS source_size,
         CASE WHEN s / w <= level THEN (3 * s)::DOUBLE ELSE (remaining * w)::BIGINT / open_weight::BIGINT END AS target
  FROM weighted, best),
turns AS (
  SELECT d.doc_id, d.source, size, k, source_size * k + upto AS words, target
  FROM (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY shuffled, doc_id) AS upto FROM sized) d
  JOIN targets t ON d.source IS NOT DISTINCT FROM t.source, range(3) r(k)
  WHERE size > 0 AND target > 0),
ordered AS (
  SELECT *, sum(size) OVER (ORDER BY words::BIGINT / target, source NULLS LAST, doc_id, k) AS used FROM turns),
takes AS (
  SELECT doc_id, sum(size)::BIGINT AS taken FROM ordered
  WHERE used <= (SELECT sum(size) FROM sized) GROUP BY doc_id)
SELECT d.doc_id, size, source_size, target, coalesce(taken, 0) AS taken
FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN takes USING (doc_id)
""",
        "op8_exact_dedup": r"""
WITH plain AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(body) AS text_sha256
FROM plain WINDOW g AS (PARTITION BY body)
""",
        "op10_quality_rules": f"""
WITH {QUALITY_SQL}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_rejected, kept
FROM verdicts
""",
        # A control string of n hashes is broken n - 2 times; every break adds two characters.
        "op12_chat_format": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
written AS (
  SELECT *, row_number() OVER c AS nth, lag(role) OVER c AS before, lead(conv_id) OVER c IS NULL AS ends,
    length('### ' || CASE WHEN role IN ('system', 'user', 'assistant') THEN '' ELSE 'Role ' END || role || ':')
      + length(text) + length('</turn>') + 2  -- line ends
      + length(text) - length(replace(text, '\', ''))
      + 2 * coalesce(list_sum([length(h) - 2 for h in regexp_extract_all(text, '###+')]), 0)
      + 2 * len(regexp_extract_all(text, '</turn>')) AS chars_
  FROM turns WINDOW c AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
counted AS (
  SELECT *, CASE role WHEN 'assistant' THEN text END AS learnt,
    CASE WHEN nth = 1 THEN role IN ('system', 'user')
         ELSE before || ' ' || role IN ('system user', 'user assistant', 'assistant user') END AS fits
  FROM written)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
  coalesce(sum(length(learnt)), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(learnt, '' ORDER BY nth), '')) AS loss_sha256,
  sum(chars_)::BIGINT AS formatted_chars,
  bool_and(fits) AND bool_or(ends AND role = 'assistant') AS well_ordered
FROM counted GROUP BY conv_id
""",
    }
