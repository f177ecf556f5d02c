"""Tokenize documents and pack them into sequences of a fixed length, with certified bin counts.

Pieces are dealt into groups of bounded size. Each group packs by best-fit decreasing, and dual
feasible functions give it a lower bound: a group that needs as many sequences as its bound is
certified. Groups with a gap give all their sequences with room back, certified ones those with
much room; these pieces are dealt anew, across groups, and packed again. This goes on until the
sequences are as few as the bound over all pieces allows, one group remains, or their number no longer falls.
"""

from __future__ import annotations

import os
import zlib
from functools import partial
from itertools import compress, repeat
from itertools import count as count_from

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import kept_in_worker, map_batches, pick, ship_package, written
from millrace.llm.words import CHUNK_BYTES

CAPACITY = 4096
END_ID = 1
#: Pieces that one task packs at a time.
GROUP_PIECES = 32_768
#: Known parts of a worker are forgotten beyond this size; each counts as its length, its ids and a fixed part.
KNOWN_BYTES, PART_BYTES = 160 << 20, 170
#: A certified group gives sequences back that are filled less than this.
WELL_FILLED = 0.95

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class WordIds:
    """Token ids of texts, looked up by the parts between spaces and line feeds.

    The tokenizer drops white space and its tokens never cross any, so the ids of a text are those of its
    parts in order. What is known is kept up to ``most`` bytes, about, and then begun anew.
    """

    def __init__(self, tokenizer_json: str, most: int = KNOWN_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_str(tokenizer_json), most
        self._forget()

    def _forget(self) -> None:
        self.parts, self.size = {"": 0}, 0
        self.starts, self.counts = np.zeros(1024, np.int64), np.zeros(1024, np.int32)
        self.flat, self.used = np.zeros(4096, np.uint16), 0

    def _add(self, parts: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        n, upto = len(self.parts), self.used + len(ids)
        if n + len(parts) > len(self.starts):
            room = (n + len(parts)) * 5 // 4
            self.starts, self.counts = np.resize(self.starts, room), np.resize(self.counts, room)
        if len(ids) and ids.max() > np.iinfo(self.flat.dtype).max:
            self.flat = self.flat.astype(np.uint32)
        if upto > len(self.flat):
            self.flat = np.resize(self.flat, upto * 5 // 4)
        self.starts[n : n + len(parts)] = self.used + np.cumsum(sizes) - sizes
        self.counts[n : n + len(parts)] = sizes
        self.flat[self.used : upto] = ids
        self.used = upto
        self.parts.update(zip(parts, range(n, n + len(parts)), strict=True))
        self.size += PART_BYTES * len(parts) + sum(map(len, parts)) + self.flat.itemsize * len(ids)

    def _learn(self, parts: list[str]) -> None:
        # Latin letters with stops behind them are one word or two in the tokenizer's eyes, so one call can
        # take many of them. Scripts whose letters fall apart into marks when normalized go one by one.
        cores = [p.rstrip(".,!?") for p in parts]
        plain = [c.isalpha() and (c.isascii() or max(c) < "\u0250" and "\u0130" not in c) for c in cores]
        simple = list(compress(parts, plain))
        if simple:
            words = np.fromiter(map(len, simple), np.int64, len(simple)) > np.fromiter(map(len, compress(cores, plain)), np.int64, len(simple))
            last = np.cumsum(words + 1)
            encoded = self.tokenizer.encode(" ".join(simple), add_special_tokens=False)
            word = np.array(encoded.word_ids, np.int64)
            if word[-1] + 1 != last[-1]:
                raise AssertionError("the tokenizer cuts words otherwise")
            upto = np.searchsorted(word, last)
            self._add(simple, np.array(encoded.ids, np.uint32), np.diff(upto, prepend=0))
        rest = [p for p, easy in zip(parts, plain, strict=True) if not easy]
        if rest:
            ids = [e.ids for e in self.tokenizer.encode_batch(rest, add_special_tokens=False)]
            self._add(rest, np.array([x for one in ids for x in one], np.uint32), np.array([len(x) for x in ids], np.int64))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and each text's bounds in them."""
        if self.size > self.most:
            self._forget()
        parts = " ".join(texts).replace("\n", " ").split(" ")
        codes = np.fromiter(map(self.parts.get, parts, repeat(-1)), np.int64, len(parts))
        unknown = np.flatnonzero(codes < 0).tolist()
        if unknown:
            self._learn(list(dict.fromkeys(parts[i] for i in unknown)))
            codes[unknown] = [self.parts[parts[i]] for i in unknown]
        counts = self.counts[codes].astype(np.int64)
        ends = np.cumsum(counts)
        ids = self.flat[np.repeat(self.starts[codes] - (ends - counts), counts) + np.arange(ends[-1])]
        sizes = [t.count(" ") + t.count("\n") + 1 for t in texts]
        upto = np.concatenate([[0], ends])
        return ids, upto[np.concatenate([[0], np.cumsum(sizes)])]


def _encoder(tokenizer: Broadcast, known_bytes: int) -> WordIds:
    """One for the tasks of a stage in a Python worker, so that known parts serve all of them."""
    return kept_in_worker("word_ids", lambda: WordIds(tokenizer.value, known_bytes))


def _text_groups(texts: list[str]):
    """Slices of about a chunk of text."""
    first = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK_BYTES:
            yield first, i
            first, size = i, 0
        size += len(t)
    if texts:
        yield first, len(texts)


def _piece_batch(
    batch: pa.RecordBatch, tokenizer: Broadcast, capacity: int, end_id: int, keep_ids: bool, known_bytes: int
) -> pa.RecordBatch:
    encoder = _encoder(tokenizer, known_bytes)
    doc, piece, start, length, crc, kept, deal = [], [], [], [], [], [], []
    texts = [t or "" for t in batch.column(1).to_pylist()]
    for first, last in _text_groups(texts):
        ids, bounds = encoder.encode(texts[first:last])
        for i in range(last - first):
            own = np.append(ids[bounds[i] : bounds[i + 1]], np.uint32(end_id)).astype("<u4")
            for k, at in enumerate(range(0, len(own), capacity)):
                part = own[at : at + capacity]
                doc.append(first + i)
                piece.append(k)
                start.append(at)
                length.append(len(part))
                crc.append(zlib.crc32(part.tobytes()))
                deal.append(zlib.crc32(b"%d %d %d" % (first + i, k, crc[-1])))
                if keep_ids:
                    kept.append(part.astype(np.int32))
    arrays = [batch.column(0).take(pa.array(doc, pa.int64())), pa.array(piece, pa.int32())]
    arrays += [pa.array(x, pa.int64()) for x in (start, length, crc, deal)]
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "deal"]
    if keep_ids:
        arrays.append(pa.array(kept, pa.list_(pa.int32())))
        names.append("ids")
    return pa.RecordBatch.from_arrays(arrays, names)


def token_pieces(
    documents: DataFrame,
    tokenizer_file: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    keep_ids: bool = False,
    known_bytes: int = KNOWN_BYTES,
) -> DataFrame:
    """Pieces of at most ``capacity`` tokens of each document, with their ids if asked for.

    ``documents`` has doc_id and text. A null text is empty and has only the end id. ``deal`` is a
    number that spreads pieces evenly, also those of repeated rows. ``known_bytes`` bounds what a Python
    worker remembers of the tokens of words.
    """
    with open(tokenizer_file, encoding="utf-8") as f:
        tokenizer = documents.sparkSession.sparkContext.broadcast(f.read())
    fields = f"{PIECES}, deal long" + ", ids array<int>" * keep_ids
    job = partial(
        _piece_batch, tokenizer=tokenizer, capacity=capacity, end_id=end_id, keep_ids=keep_ids, known_bytes=known_bytes
    )
    return map_batches(pick(documents, doc_id="long", text="string"), job, fields)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length; lengths are 1 to ``capacity``."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    with_rest: list[list[int]] = [[] for _ in range(capacity + 1)]
    rests, used = 0, 0  # bit r of rests: some bin has room for exactly r more
    for i, n in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fitting = rests >> n
        if fitting:
            rest = n + (fitting & -fitting).bit_length() - 1
            b = with_rest[rest].pop()
            if not with_rest[rest]:
                rests ^= 1 << rest
        else:
            rest, b = capacity, used
            used += 1
        bins[i], offsets[i] = b, capacity - rest
        if rest > n:
            with_rest[rest - n].append(b)
            rests |= 1 << (rest - n)
    return bins, offsets


def lower_bound(lengths: np.ndarray, capacity: int, counts: np.ndarray | None = None) -> int:
    """Bins that any packing needs, by the best of two families of dual feasible functions.

    One takes lengths over ``capacity - e`` as whole bins, those under ``e`` as nothing and the rest
    as they are; the other rounds to multiples of 1 / k. ``counts`` says how often each length occurs.
    """
    if not len(lengths):
        return 0
    size, n = np.unique(lengths, return_counts=True) if counts is None else (lengths, counts)
    best = -(-int((size * n).sum()) // capacity)
    for e in [1, *size[size <= capacity // 2].tolist()]:
        whole = size > capacity - e
        rest = (size >= e) & ~whole
        best = max(best, int(n[whole].sum()) + -(-int((size[rest] * n[rest]).sum()) // capacity))
    for k in range(1, 33):
        scaled = size * (k + 1)
        # In units of 1 / (k * capacity): lengths that are multiples of 1 / (k + 1) stay as they are.
        units = np.where(scaled % capacity == 0, size * k, scaled // capacity * capacity)
        best = max(best, -(-int((units * n).sum()) // (k * capacity)))
    return best


def _pack_group(frame: pd.DataFrame, capacity: int, turn: int, last: bool) -> pd.DataFrame:
    # The same order for the same rows, however they arrive.
    frame = frame.sort_values(["length", "doc_id", "piece", "ids_crc32", "deal"], kind="stable").reset_index(drop=True)
    lengths = frame["length"].to_numpy(np.int64)
    bins, offsets = best_fit_decreasing(lengths, capacity)
    filled = np.bincount(bins, lengths).astype(np.int64)
    certified = len(filled) == lower_bound(lengths, capacity)
    given = np.zeros(len(filled), bool)
    if not last:
        given = filled < (capacity * WELL_FILLED if certified else capacity)
    return frame.assign(
        sequence_id=(turn << 48) + (int(frame["pack"].iloc[0]) << 24) + bins,
        offset=offsets,
        certified=certified,
        given=given[bins],
    ).drop(columns="pack")


_PACKED = f"{PIECES}, deal long, sequence_id long, offset long, certified boolean, given boolean"


def _packer(capacity: int, turn: int, last: bool):
    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        return _pack_group(frame, capacity, turn, last)

    return pack


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Each piece with its sequence_id and offset, and whether its group met its lower bound (``certified``).

    ``pieces`` is a stored table with the columns of ``token_pieces``. Whole pieces are sequences of
    their own. An empty table gives an empty result.
    """
    ship_package(pieces.sparkSession)
    columns = [c.strip().split()[0] for c in PIECES.split(",")]
    whole = pieces.where(F.col("length") == capacity).select(
        *columns,
        (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        F.lit(True).alias("certified"),
    )
    # All lengths with their counts: no more rows than the capacity.
    lengths = pieces.where(F.col("length") < capacity).groupBy("length").agg(F.count("*").alias("n")).toArrow()
    size, n = (lengths[c].to_numpy() for c in ("length", "n"))
    needed, count, used = lower_bound(size, capacity, n), int(n.sum()), 0
    parts, rest = [whole], pieces.where(F.col("length") < capacity).select(*columns, "deal")
    before, open_before, placed = None, 0, [*columns, "sequence_id", "offset", "certified"]
    for turn in count_from(0):
        groups = max(1, -(-count // group_pieces))
        packed = written(
            rest.withColumn("pack", F.pmod(F.xxhash64("deal", F.lit(turn)), F.lit(groups)))
            .groupBy("pack")
            .applyInPandas(_packer(capacity, turn, groups == 1), _PACKED),
            "packed",
        )
        found = packed.groupBy("given").agg(F.count("*").alias("n"), F.count_distinct("sequence_id").alias("bins"))
        found = {r.given: (r.n, r.bins) for r in found.collect()}
        count, open_bins = found.get(True, (0, 0))
        closed = found.get(False, (0, 0))[1]
        if before is not None and closed + open_bins >= open_before:
            parts.append(before.where("given").select(*placed))  # dealing anew has gained nothing: as it was
            break
        used += closed
        done = not count or used + open_bins == needed
        parts.append((packed if done else packed.where("NOT given")).select(*placed))
        if done:
            break
        before, open_before, rest = packed, open_bins, packed.where("given").select(*columns, "deal")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def pack_documents(
    documents: DataFrame,
    tokenizer_file: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    known_bytes: int = KNOWN_BYTES,
) -> DataFrame:
    """Tokenized and packed documents, one row per piece.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset, certified. Texts are
    tokenized whole; only documents longer than ``capacity`` are cut. A null or empty text is the
    end id alone. Repeated rows are packed as often as they occur; a null doc_id stays null. Other
    columns are left out. An empty table gives an empty result.
    """
    pieces = token_pieces(documents, tokenizer_file, capacity, end_id, known_bytes=known_bytes)
    return pack_pieces(written(pieces, "pieces"), capacity)
