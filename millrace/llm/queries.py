"""The operators over their whole tables, one query each, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import license_texts, sql
from millrace.llm.byte_bpe import Vocabulary, decode_documents, encode_documents
from millrace.llm.decontaminate import find_leaks
from millrace.llm.fingerprints import fingerprint_documents
from millrace.llm.frames import table
from millrace.llm.hard_negatives import mine_hard_negatives
from millrace.llm.html_text import extract_text
from millrace.llm.license_scan import scan_licenses
from millrace.llm.line_dedup import dedup_lines
from millrace.llm.minhash import near_duplicates
from millrace.llm.packing import pack_documents
from millrace.llm.quality import score_documents, train_quality
from millrace.llm.spelling import spelling_variants
from millrace.llm.token_counts import count_tokens, estimate_unigrams, piece_file
from millrace.llm.url_filter import judge_urls

Query = Callable[[SparkSession, str], DataFrame]

#: Verdicts on hosts (with all subdomains) and path beginnings.
URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))


@query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_file())


@query
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return score_documents(documents, train_quality(documents, table(spark, sf_dir, "labels")))


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        F.col("row.doc_id").alias("doc_id"),
        "n_lines",
        "n_removed",
        F.length("cleaned").cast("long").alias("n_chars"),
        F.md5(F.encode("cleaned", "UTF-8")).alias("text_md5"),
    )


@query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"), license_texts.PHRASES, license_texts.TEMPLATES)


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    pieces = piece_file(tokenizer_file("piece_bpe_32k.model"))
    return count_tokens(documents, estimate_unigrams(documents, pieces))


@query
def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


@query
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    )
    return mine_hard_negatives(embeddings, anchors="vec_id % 100 = 0")


@query
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = Vocabulary.read(tokenizer_file("byte_bpe_50k.tiktoken"))
    encoded = encode_documents(table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)
    return decode_documents(encoded, vocabulary).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.encode(F.array_join(F.col("ids").cast("array<string>"), " "), "UTF-8"), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


ORACLE["op5_license_scan"] = sql.op5_license_scan(license_texts.TEMPLATES)
ORACLE["op7_minhash_near_dedup"] = sql.OP7_NEAR_DUPLICATES
ORACLE["op4_line_dedup"] = sql.OP4_LINE_DEDUP
ORACLE["op11_hard_negatives"] = sql.OP11_HARD_NEGATIVES
