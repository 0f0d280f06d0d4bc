"""The corpus queries, each over its whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (backoff, chat, decontaminate, extraction, language, neardup, packing, periods, phrases, quality, records,
               repeats, sharding)
from .common import documents, read

TOKENIZER_FILE = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER_FILE)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read(spark, sf_dir, "documents"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.main_text(read(spark, sf_dir, "pages"))


def op3_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = backoff.held_out()
    docs = read(spark, sf_dir, "documents")
    scores = backoff.katz_scores(docs, F.col("doc_id").isNotNull() & ~held)
    return scores.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.remove_repeats(read(spark, sf_dir, "documents"), length=400, keep_first=False, with_text=True,
                                 words=51, apart=True)
    return out.withColumnRenamed("kept_text", "text")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.benchmark_matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"))
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.conversation_digests(rows.unionByName(planted))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.stratified_shards(read(spark, sf_dir, "documents"), shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_verdicts(read(spark, sf_dir, "documents"))


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents"), shingle=2, percent=80)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.retrieval_packing(documents(read(spark, sf_dir, "documents")), tokenizer_path())


def op11_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.round_trip(read(spark, sf_dir, "documents"), tokenizer_path())


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"), least=100, longest=5, top=2000)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.periodic_runs(read(spark, sf_dir, "documents"), least=12, words_of=periods.looped_words)


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_html_extraction, op3_katz_scores, op4_suffix_repeats, op5_decontamination, op6_chat_format,
    op7_sharding, op8_quality_rules, op9_minhash_dedup, op10_packing, op11_token_records,
    op12_phrase_collocations, op13_periodic_runs)}

#: DuckDB SQL of the queries that SQL can tell; tests hold the others against brute force.
ORACLE_SQL: dict[str, str] = {
    "op6_chat_format": r"""
        WITH rows AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
          UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
        sized AS (
          SELECT *, role = 'assistant' AS trained,
            4 + length(role) + length(regexp_replace(role, '[^\\#:]', '', 'g'))
              + (length(role) - length(replace(role, '</', ''))) // 2
            + 2 + length(text) + length(regexp_replace(text, '[^\\#]', '', 'g'))
              + (length(text) - length(replace(text, '</', ''))) // 2 + 8 AS n,
            row_number() OVER w AS place FROM rows
          WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
        ended AS (SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY place) AS ends FROM sized)
        SELECT conv_id, count(*) AS n_turns,
          sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
          length(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE trained), '')) AS loss_chars,
          sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE trained), '')) AS loss_sha256,
          CAST(coalesce(sum(ends) FILTER (WHERE trained), 0) + max(ends)
               - coalesce(max(ends) FILTER (WHERE trained), 0) AS BIGINT) AS formatted_chars,
          count(*) FILTER (WHERE trained) AS n_examples
        FROM ended GROUP BY conv_id""",
    "op12_phrase_collocations": r"""
        WITH pieces AS (
          SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
          FROM documents),
        words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
        places AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, range(1, 6) t(k) WHERE len(w) >= k),
        counted AS (
          SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS a FROM places GROUP BY ALL HAVING count(*) >= 100),
        candidates AS (SELECT * FROM counted WHERE k > 1),
        open AS (
          SELECT * FROM candidates c WHERE NOT EXISTS (
            SELECT 1 FROM candidates o WHERE o.lang = c.lang AND o.k > c.k AND o.a >= c.a
              AND contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' '))),
        cuts AS (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS j FROM open),
        scored AS (
          SELECT c.lang, c.phrase, c.a, l.a AS l, r.a AS r, t.n, c.j,
            CAST(CAST(1000 AS HUGEINT) * c.a * t.n // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score
          FROM cuts c JOIN total t ON t.lang = c.lang
          JOIN counted l ON l.lang = c.lang AND l.k = c.j AND l.phrase = array_to_string(c.w[: c.j], ' ')
          JOIN counted r ON r.lang = c.lang AND r.k = c.k - c.j AND r.phrase = array_to_string(c.w[c.j + 1 :], ' ')),
        best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000""",
}
