"""One query for each operator, over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.llm import byte_language, chat_template, decontaminate, exact_dedup, huffman_ids, quality_resampling
from riskmart.llm import secret_scan, signature_tree, suffix_dedup, token_alignment, vector_codes, viterbi_pieces, weak_pii
from riskmart.llm.common import new_path, stash, table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the quality sample keeps."""
    return quality_resampling.sampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "ratio", "log_weight", "sample_key")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decide(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op4_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "huffman")
    huffman_ids.write(table(spark, sf_dir, "documents"), path, WORD_BPE)
    return huffman_ids.digests(spark, path)


def op5_signature_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = signature_tree.classes(table(spark, sf_dir, "documents"), signature_tree.Settings(words=3, percent=90))
    return found.select("doc_id", "n_shingles", "component_id")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removals(table(spark, sf_dir, "documents"))


def op7_weak_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_pii.classified(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and test item it holds."""
    return decontaminate.matches(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop(
        "text_hash")


def op9_chat_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                 "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return chat_template.digests(stash(chat_template.formatted(rows.unionByName(more)), "chats"))


def op10_viterbi_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return viterbi_pieces.digests(table(spark, sf_dir, "documents"), PIECES)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compressed(table(spark, sf_dir, "embeddings"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.digests(table(spark, sf_dir, "documents"), BYTE_BPE, PIECES)


def op13_byte_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return byte_language.predicted(docs, byte_language.fitted(docs))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_quality_resampling, op2_exact_dedup, op3_secret_scan, op4_huffman_ids,
                            op5_signature_tree, op6_suffix_dedup, op7_weak_pii, op8_decontaminate, op9_chat_template, op10_viterbi_pieces,
                            op11_vector_codes, op12_token_alignment, op13_byte_language)}

# Plain SQL for what SQL can say on whole tables at a fair price; the others are held
# against brute-force versions in tests/llm.
ORACLE_SQL = {
    "op11_vector_codes": vector_codes.ORACLE_SQL,
    "op2_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op5_signature_tree": """
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(regexp_split_to_array(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
            FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, unnest(
                       CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                       ELSE list_transform(range(1, len(w) - 1), lambda k: array_to_string(w[k:k + 2], ' ')) END) AS s
            FROM words),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
            FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
            GROUP BY 1, 2),
        links AS (
            SELECT o.a, o.b FROM common o JOIN sizes x ON x.doc_id = o.a JOIN sizes y ON y.doc_id = o.b
            WHERE 100 * o.c >= 90 * (x.n + y.n - o.c)),
        reach(doc_id, other) AS (
            SELECT doc_id, doc_id FROM documents
            UNION
            SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
        SELECT d.doc_id, coalesce(max(z.n), 0)::BIGINT AS n_shingles, min(r.other) AS component_id
        FROM documents d JOIN reach r ON r.doc_id = d.doc_id LEFT JOIN sizes z ON z.doc_id = d.doc_id
        GROUP BY d.doc_id
    """,
}
