"""From raw documents to packed training sequences: judge, clean, deduplicate, decontaminate, pack."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.decontaminate import drop_leaking
from millrace.llm.frames import table, written
from millrace.llm.line_dedup import dedup_lines
from millrace.llm.minhash import near_duplicates
from millrace.llm.packing import pack_documents
from millrace.llm.quality import keep_good, train_quality
from millrace.llm.queries import tokenizer_file

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

NEAR_PERCENT = 80
#: 46 bands of 6: two documents at similarity 0.80 share no band in one of a million cases.
NEAR_BANDS, NEAR_ROWS = 46, 6
#: Less than packing takes alone: executors still hold what earlier stages needed.
KNOWN_BYTES = 112 << 20


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return keep_good(docs, train_quality(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated line runs; a document of which nothing stays goes."""
    cleaned = dedup_lines(docs).where("n_removed = 0 OR cleaned <> ''")
    changed = {"text": F.col("cleaned"), "n_chars": F.length("cleaned").cast("long")}
    same = F.col("n_removed") == 0
    columns = []
    for name in docs.columns:
        column = F.col("row").getField(name)
        columns.append(F.when(same, column).otherwise(changed[name]).alias(name) if name in changed else column.alias(name))
    return cleaned.select(*columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, linked from a similarity of 0.80 up."""
    gone = near_duplicates(docs, percent=NEAR_PERCENT, bands=NEAR_BANDS, band_rows=NEAR_ROWS).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their place in the training sequences."""
    return pack_documents(docs, tokenizer_file(), known_bytes=KNOWN_BYTES)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents table; each result is written before the next stage reads it.

    Null and empty texts stay until a stage rejects them, and an empty table gives an empty result. Rows of
    equal doc_id are one document to the near copies: all of them stay or go. Rows without doc_id always
    stay there. Columns beyond those of documents are kept up to the last stage.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Trained trees and tokenizers have no SQL form; tests compare each stage with brute force.
ORACLE_SQL: str | None = None
