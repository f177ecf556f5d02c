"""Quality of documents, judged by boosted trees over statistics of the whole text.

The statistics are shares of kinds of bytes, lengths of words and lines, and how much words and
lines repeat. Trees are trained on a bounded sample of labelled documents; scoring is one pass.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.boosting import Forest, train
from millrace.llm.frames import map_batches, pick
from millrace.llm.words import Texts, text_chunks, words_of

#: Labelled rows that training takes at most, in the order of a hash of doc_id.
SAMPLE_ROWS = 20_000
THRESHOLD = 0.3

_KINDS = {
    "upper": range(0x41, 0x5B),
    "lower": range(0x61, 0x7B),
    "digit": range(0x30, 0x3A),
    "space": (0x20, 0x09),
    "line": (0x0A,),
    "stop": b".?;:",
    "comma": b",",
    "shout": b"!",
    "bar": b"|",
    "symbol": b"#$%&*+<=>@[\\]^_`{}~/",
    "quote": b"\"'()-",
    "other": range(0x80, 0x100),
}
_OF_KIND = np.zeros((256, len(_KINDS)))
for _k, _bytes in enumerate(_KINDS.values()):
    _OF_KIND[list(_bytes), _k] = 1

FEATURES = [
    *(f"{k}_share" for k in _KINDS),
    "log_bytes", "log_words", "entropy", "word_length", "long_word_share", "short_word_share",
    "distinct_word_share", "top_word_share", "echo_share", "words_per_line", "distinct_line_share", "short_line_share",
]

_LINE_FEED = np.zeros(256, bool)
_LINE_FEED[0x0A] = True


def _statistics(texts: Texts) -> np.ndarray:
    n = len(texts)
    out = np.zeros((n, len(FEATURES)))
    words, lines = words_of(texts), words_of(texts, _LINE_FEED)
    for i in range(n):
        size = int(texts.bounds[i + 1] - texts.bounds[i])
        if not size:
            continue
        counts = np.bincount(texts.data[texts.bounds[i] : texts.bounds[i + 1]], minlength=256)
        out[i, : len(_KINDS)] = counts @ _OF_KIND / size
        share = counts[counts > 0] / size
        a, b = words.bounds[i], words.bounds[i + 1]
        if a == b:
            continue
        own, lengths = words.hashes[a:b], words.lengths[a:b]
        ordered = np.sort(own)
        runs = np.diff(np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]])))
        own_lines = slice(lines.bounds[i], lines.bounds[i + 1])
        line_sizes = lines.lengths[own_lines]
        out[i, len(_KINDS) :] = (
            np.log1p(size), np.log1p(b - a), -(share * np.log(share)).sum(), lengths.mean(), (lengths > 12).mean(),
            (lengths < 3).mean(), len(runs) / (b - a), runs.max() / (b - a), (own[1:] == own[:-1]).sum() / (b - a),
            (b - a) / len(line_sizes), len(np.unique(lines.hashes[own_lines])) / len(line_sizes), (line_sizes < 20).mean(),
        )
    return out


def statistics(column: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` for each text; empty and null texts have zeros."""
    parts = [_statistics(t) for t in text_chunks(column)]
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))


def held_out(doc_id) -> F.Column:
    """Rows that training never sees: crc32 of the doc_id as text, mod 5, is 0. False for a null doc_id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _labelled_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = statistics(batch.column(1))
    lists = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
    return pa.RecordBatch.from_arrays([batch.column(0), lists, batch.column(2)], ["doc_id", "x", "y"])


def train_quality(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Forest:
    """Trees for ``labels.quality``, from at most ``sample_rows`` labelled documents that are not held out.

    Rows with a null doc_id or a quality other than 0 and 1 are not used. Of documents that share a
    doc_id one is taken, so that the bound holds whatever repeats.
    """
    known = pick(labels, doc_id="long", quality="int").where("quality IN (0, 1) AND doc_id IS NOT NULL")
    known = known.where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample_rows)
    rows = pick(documents, doc_id="long", text="string").join(F.broadcast(known), "doc_id")
    rows = map_batches(rows.select("doc_id", "text", "quality"), _labelled_batch, "doc_id long, x array<double>, y int")
    found = rows.groupBy("doc_id", "y").agg(F.min("x").alias("x")).select("x", "y").toArrow()
    x = found["x"].combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES))
    y = found["y"].to_numpy().astype(float)
    # The same trees however the rows arrive.
    order = np.lexsort((*x.T, y))
    return train(x[order], y[order])


def _score_batch(batch: pa.RecordBatch, forest) -> pa.RecordBatch:
    score = forest.value.scores(statistics(batch.column(1)))
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["doc_id", "score"])


def score_documents(documents: DataFrame, forest: Forest, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 from ``threshold`` up).

    Null and empty texts have a score too, that of all statistics 0. Repeated rows give equal
    scores. Other columns are left out. An empty table gives an empty result.
    """
    shared = documents.sparkSession.sparkContext.broadcast(forest)
    rows = pick(documents, doc_id="long", text="string")
    scored = map_batches(rows, partial(_score_batch, forest=shared), "doc_id long, score double")
    predicted = (F.col("score") >= threshold).cast("int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def _filter_batch(batch: pa.RecordBatch, forest, threshold: float, at: int) -> pa.RecordBatch:
    text = pc.cast(batch.column(at), pa.string())
    return batch.filter(pa.array(forest.value.scores(statistics(text)) >= threshold))


def keep_good(documents: DataFrame, forest: Forest, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, whose text scores at least ``threshold``."""
    shared = documents.sparkSession.sparkContext.broadcast(forest)
    at = documents.columns.index("text")
    return map_batches(documents, partial(_filter_batch, forest=shared, threshold=threshold, at=at), documents.schema)
