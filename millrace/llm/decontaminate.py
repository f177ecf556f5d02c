"""Benchmark items in training documents: a BM25 index of the items, queried with every passage.

A passage is a window of words; windows overlap by half and are at least twice as long as the
longest item, so every place of an item lies whole in one of them. The score of an item is its
BM25 score against the passage as a share of its score against itself.

Retrieval is block-max WAND with a fixed threshold, over many passages at a time. The weakest terms
of each item, together under a part of the threshold, have no postings: they cannot carry an item
over it, only add to it. The other terms have postings on blocks of items with the block's highest
impact, and on items. A passage adds up block maxima first; only blocks that can reach the
threshold go on to their items, and only items that can reach it are scored in full. The items
found are then verified: their word shingles, of the question and of the answer, must be there.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import map_batches, pick
from millrace.llm.words import joined, text_chunks, words_of

THRESHOLD = 0.6
#: Share of the shingles of the question, and of the answer, that must be in the passage.
OVERLAP = 0.5
SHINGLE = 5
K1, B = 1.2, 0.75
#: Items of one index, which is sent to all executors; more items make more indexes and passes.
ITEMS_PER_INDEX = 20_000
BLOCK_ITEMS = 4
LEAST_STRIDE = 64
#: Cells (passages by blocks or items) that are added up at a time.
CELLS = 1 << 22

#: Words here are runs of letters and digits in lower case: all ASCII bytes but those separate.
SEPARATORS = np.ones(256, bool)
SEPARATORS[0x80:] = False
for _a, _b in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
    SEPARATORS[_a : _b + 1] = False

LEAKS = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, first_word long"


def _lower_chunks(column: pa.Array):
    """Texts in lower case, in all scripts."""
    return text_chunks(pc.utf8_lower(column))


def _hashes(texts: list[str | None]) -> list[np.ndarray]:
    out = []
    for chunk in _lower_chunks(pa.array(texts, pa.string())):
        words = words_of(chunk, SEPARATORS)
        out += [words.hashes[a:b] for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True)]
    return out


def question_and_answer(text: str) -> tuple[str, str]:
    """The last sentence is the answer; a text of one sentence is all question."""
    sentences = [s for s in re.split(r"(?<=[.?!])\s+|\n+", text) if re.search(r"[^\W_]", s)]
    if len(sentences) < 2:
        return text, ""
    at = text.rindex(sentences[-1])
    return text[:at], text[at:]


@dataclass
class Index:
    """Items with their impacts, and postings of their stronger terms as rows of (term -> from, to)."""

    ids: np.ndarray
    terms: list[np.ndarray]  # hashes of each item's terms, ascending
    impacts: list[np.ndarray]
    parts: list[tuple[np.ndarray, np.ndarray]]  # word hashes of question and answer
    vocabulary: np.ndarray  # hashes of terms with postings, ascending
    seen: np.ndarray  # by the low bits of a hash: whether a term with postings has them
    item_postings: tuple[np.ndarray, np.ndarray, np.ndarray]
    block_postings: tuple[np.ndarray, np.ndarray, np.ndarray]
    item_rest: np.ndarray  # what terms without postings can add
    block_rest: np.ndarray
    stride: int
    threshold: float


def _postings(term: np.ndarray, place: np.ndarray, impact: np.ndarray, terms: int):
    """Rows for each term: (row bounds, places, highest impact at the place)."""
    key = term * (place.max(initial=0) + 1) + place
    order = np.lexsort((-impact, key))
    first = order[np.unique(key[order], return_index=True)[1]]
    bounds = np.searchsorted(term[first], np.arange(terms + 1))
    return bounds, place[first], impact[first].astype(np.float32)


def build_index(ids, texts, document_counts, items: int, mean_words: float, threshold: float = THRESHOLD) -> Index:
    """``document_counts`` maps a term's hash to the number of items, of all indexes, that have it."""
    hashes = _hashes(texts)
    kept = [i for i, h in enumerate(hashes) if len(h)]
    terms, impacts, strong = [], [], []
    rest = np.zeros(len(kept))
    for k, i in enumerate(kept):
        own, tf = np.unique(hashes[i], return_counts=True)
        df = np.array([document_counts[h] for h in own.tolist()], float)
        idf = np.log1p((items - df + 0.5) / (df + 0.5))
        impact = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(hashes[i]) / mean_words))
        impact /= impact.sum()
        order = np.argsort(impact, kind="stable")
        weak = order[np.cumsum(impact[order]) <= threshold / 2]
        rest[k] = impact[weak].sum()
        stays = np.ones(len(own), bool)
        stays[weak] = False
        terms.append(own)
        impacts.append(impact)
        strong.append(stays)
    texts = [texts[i] for i in kept]
    cut = [question_and_answer(t) for t in texts]
    parts = list(zip(_hashes([q for q, _ in cut]), _hashes([a for _, a in cut]), strict=True))
    # Without items, one term that no passage has keeps all arrays in shape.
    none = np.zeros(0, np.uint64)
    flat = np.concatenate([t[s] for t, s in zip(terms, strong, strict=True)] or [none])
    vocabulary = np.unique(flat)
    term = np.searchsorted(vocabulary, flat)
    place = np.repeat(np.arange(len(kept)), [int(s.sum()) for s in strong])
    impact = np.concatenate([m[s] for m, s in zip(impacts, strong, strict=True)] or [np.zeros(0)])
    seen = np.zeros(1 << 20, bool)
    seen[(vocabulary & np.uint64(len(seen) - 1)).astype(np.int64)] = True
    blocks = -(-len(kept) // BLOCK_ITEMS)
    padded = np.zeros(blocks * BLOCK_ITEMS)
    padded[: len(kept)] = rest
    return Index(
        np.array([ids[i] for i in kept], np.int64),
        terms,
        impacts,
        parts,
        vocabulary,
        seen,
        _postings(term, place, impact, len(vocabulary)),
        _postings(term, place // BLOCK_ITEMS, impact, len(vocabulary)),
        rest,
        padded.reshape(-1, BLOCK_ITEMS).max(axis=1, initial=0),
        max([LEAST_STRIDE, *(len(hashes[i]) for i in kept)]),
        threshold,
    )


def _added(window: np.ndarray, term: np.ndarray, postings, windows: int, places: int) -> np.ndarray:
    """Impacts added up by window and place. ``window`` and ``term`` are distinct pairs."""
    bounds, place, impact = postings
    n = bounds[term + 1] - bounds[term]
    ends = np.cumsum(n)
    row = np.repeat(bounds[term] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
    cells = np.repeat(window, n) * places + place[row]
    return np.bincount(cells, impact[row], windows * places).reshape(windows, places)


def retrieve(index: Index, window: np.ndarray, term: np.ndarray, windows: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, item) pairs that can reach the threshold."""
    slack = index.threshold - 1e-4
    by_block = _added(window, term, index.block_postings, windows, len(index.block_rest))
    open_blocks = by_block + index.block_rest >= slack
    live = open_blocks.any(axis=1)
    stay = live[window]
    by_item = _added(window[stay], term[stay], index.item_postings, windows, len(index.item_rest))
    reach = by_item + index.item_rest >= slack
    reach &= np.repeat(open_blocks, BLOCK_ITEMS, axis=1)[:, : reach.shape[1]]
    return np.nonzero(reach)


def _overlap(part: np.ndarray, passage: np.ndarray) -> float:
    """Share of the distinct shingles of ``part`` that the passage has; of all its words if it is short."""
    width = min(SHINGLE, len(part))
    if not width:
        return 1.0
    if len(passage) < width:
        return 0.0
    grams = [joined([x[k : len(x) - width + 1 + k] for k in range(width)]) for x in (part, passage)]
    return float(np.isin(np.unique(grams[0]), grams[1]).mean())


def _passages(index: Index, counts: np.ndarray) -> np.ndarray:
    """Passages of documents with so many words."""
    return np.where(counts > 0, np.maximum(1, -(-counts // index.stride) - 1), 0)


def _leaks_of(index: Index, hashes: np.ndarray, bounds: np.ndarray, overlap: float):
    """(text, item, score, question, answer, first word) of the items in some texts, the best place of each."""
    stride = index.stride
    counts = np.diff(bounds)
    passages = _passages(index, counts)
    first_passage = np.concatenate([[0], np.cumsum(passages)])
    maybe = np.flatnonzero(index.seen[(hashes & np.uint64(len(index.seen) - 1)).astype(np.int64)])
    if not len(maybe) or not len(index.ids):
        return
    term = np.searchsorted(index.vocabulary, hashes[maybe])
    term[term == len(index.vocabulary)] = 0
    sure = index.vocabulary[term] == hashes[maybe]
    at, term = maybe[sure], term[sure]
    text = np.searchsorted(bounds, at, "right") - 1
    slot = (at - bounds[text]) // stride
    # A word is in the passage that begins in its stretch and in the one before.
    own = np.minimum(slot, passages[text] - 1)
    window = np.concatenate([first_passage[text] + own, first_passage[text] + slot - 1])
    valid = np.concatenate([slot <= own, slot >= 1])
    size = len(index.vocabulary)
    pairs = np.unique(window[valid] * size + np.concatenate([term, term])[valid])
    window, term = pairs // size, pairs % size
    step = max(1, CELLS // max(1, len(index.ids)))
    best: dict[tuple[int, int], tuple] = {}
    for low in range(0, int(first_passage[-1]), step):
        a, b = np.searchsorted(window, [low, low + step])
        found = retrieve(index, window[a:b] - low, term[a:b], step)
        for w, item in zip((found[0] + low).tolist(), found[1].tolist(), strict=True):
            doc = int(np.searchsorted(first_passage, w, "right")) - 1
            start = bounds[doc] + (w - first_passage[doc]) * stride
            passage = hashes[start : min(start + 2 * stride, bounds[doc + 1])]
            has = np.isin(index.terms[item], passage)
            score = float(index.impacts[item][has].sum())
            if score < index.threshold - 1e-9:
                continue
            question, answer = (_overlap(p, passage) for p in index.parts[item])
            if question >= overlap and answer >= overlap:
                row = (score, question, answer, -int(start - bounds[doc]))
                best[doc, item] = max(best.get((doc, item), row), row)
    for (doc, item), (score, question, answer, place) in sorted(best.items()):
        yield doc, int(index.ids[item]), score, question, answer, -place


def _leak_batch(batch: pa.RecordBatch, index, overlap: float) -> pa.RecordBatch | None:
    rows = []
    for texts in _lower_chunks(batch.column(1)):
        words = words_of(texts, SEPARATORS)
        rows += [(texts.first + r[0], *r[1:]) for r in _leaks_of(index.value, words.hashes, words.bounds, overlap)]
    if not rows:
        return None
    at, item, *rest = zip(*rows, strict=True)
    arrays = [batch.column(0).take(pa.array(at)), pa.array(item, pa.int64())]
    arrays += [pa.array(c, pa.float64()) for c in rest[:3]] + [pa.array(rest[3], pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in LEAKS.split(", ")])


def _term_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    hashes = _hashes(batch.column(2).to_pylist())
    lists = [np.unique(h).view(np.int64) for h in hashes]
    n = pa.array([len(h) for h in hashes], pa.int64())
    return pa.RecordBatch.from_arrays(
        [batch.column(0), batch.column(1), batch.column(2), n, pa.array(lists, pa.list_(pa.int64()))],
        ["item_id", "shard", "text", "n_words", "terms"],
    )


def _indexes(benchmark: DataFrame, threshold: float, items_per_index: int):
    items = pick(benchmark, item_id="long", text="string").where("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    shards = max(1, -(-items.count() // items_per_index))
    items = items.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)).cast("int"))
    terms = map_batches(
        items.select("item_id", "shard", "text"),
        _term_batch,
        "item_id long, shard int, text string, n_words long, terms array<long>",
    ).where("n_words > 0")
    count, mean = terms.agg(F.count("*"), F.avg("n_words")).first()
    counts = terms.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    for shard in range(shards):
        own = terms.where(F.col("shard") == shard)
        rows = own.select("item_id", "text").orderBy("item_id", "text").collect()
        used = own.select(F.explode("terms").alias("term")).distinct()
        df = {r.term & 0xFFFFFFFFFFFFFFFF: r.n for r in counts.join(used, "term").collect()}
        yield build_index([r.item_id for r in rows], [r.text for r in rows], df, count, mean or 1.0, threshold)


def find_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    overlap: float = OVERLAP,
    items_per_index: int = ITEMS_PER_INDEX,
) -> DataFrame:
    """Benchmark items found in documents, one row per document and item, with the best place.

    Columns: doc_id, item_id, score (share of the item's BM25 score, from ``threshold`` up),
    question_overlap and answer_overlap (share of their five-word shingles, from ``overlap`` up; 1
    for an item without an answer) and first_word, where the passage begins. All words of every
    document are queried. Null and empty texts and items, and items without item_id, never match;
    a null doc_id stays null. Repeated document rows each give their rows, repeated items one.
    Other columns are left out. An empty table on either side gives an empty result.
    """
    texts = pick(documents, doc_id="long", text="string")
    context = documents.sparkSession.sparkContext
    parts = [
        map_batches(texts, partial(_leak_batch, index=context.broadcast(index), overlap=overlap), LEAKS)
        for index in _indexes(benchmark, threshold, items_per_index)
    ]
    return reduce(DataFrame.unionByName, parts)


def _clean_batch(batch: pa.RecordBatch, index, overlap: float, at: int) -> pa.RecordBatch:
    clean = np.ones(batch.num_rows, bool)
    for texts in _lower_chunks(pc.cast(batch.column(at), pa.string())):
        words = words_of(texts, SEPARATORS)
        for row in _leaks_of(index.value, words.hashes, words.bounds, overlap):
            clean[texts.first + row[0]] = False
    return batch.filter(pa.array(clean))


def drop_leaking(
    documents: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    overlap: float = OVERLAP,
    items_per_index: int = ITEMS_PER_INDEX,
) -> DataFrame:
    """The rows, with all their columns, whose text holds no benchmark item."""
    context, at = documents.sparkSession.sparkContext, documents.columns.index("text")
    for index in _indexes(benchmark, threshold, items_per_index):
        job = partial(_clean_batch, index=context.broadcast(index), overlap=overlap, at=at)
        documents = map_batches(documents, job, documents.schema)
    return documents
