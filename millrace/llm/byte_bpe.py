"""Byte-level BPE by DuckDB's recursive queries inside Spark tasks, from a file of ranks.

Each task has a DuckDB of its own in memory, with one thread. The pattern cuts texts into words, and each
distinct word is encoded once a task: its tokens by position join the table of merges, and the pair with
the smallest rank, the leftmost one of several, is contracted until no pair is left. Known words give the
ids of texts. Ids are decoded by joining them with the vocabulary and aggregating in order of position.

A word of more than ``LONG`` bytes would need as many rounds as it has merges. It is first cut where no
token has the two bytes side by side, and then a round contracts several pairs: the pairs of the smallest
rank from left to right, up to the first one whose merge makes a pair of a smaller rank with a neighbour.
That is what one pair after another gives.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from millrace.llm.frames import pick, ship_package
from millrace.llm.words import CHUNK_BYTES

#: Bytes of a word that is contracted one pair a round.
LONG = 64
#: Units that one recursive query takes, tokens that one decoding query takes, words looked up at a time.
UNITS, TOKENS, WORDS = 16_384, 262_144, 131_072
#: Known words of a task are forgotten beyond this size; each counts as its length and a fixed part.
KNOWN_BYTES, WORD_BYTES = 96 << 20, 200
DUCKDB = {"threads": 1, "memory_limit": "400MB", "temp_directory": ""}

#: Positions are kept below this bit, ranks above it; so the smallest number is the leftmost pair of the smallest rank.
_CONTRACT = """
WITH RECURSIVE state(unit, tokens) USING KEY (unit) AS (
    SELECT unit, tokens FROM units
    UNION ALL (
        SELECT s.unit, list_concat(
            list_append(s.tokens[:(b.best & 4095) - 1], (b.best >> 12)::INTEGER), s.tokens[(b.best & 4095) + 2:])
        FROM (
            SELECT p.unit, min((m.merged::BIGINT << 12) | p.pos) AS best
            FROM (
                SELECT unit, unnest(tokens[:-2]) AS l, unnest(tokens[2:]) AS r, generate_subscripts(tokens[2:], 1) AS pos
                FROM state
            ) p JOIN merges m ON p.l = m.l AND p.r = m.r
            GROUP BY p.unit
        ) b JOIN state s ON s.unit = b.unit
    )
)
SELECT tokens FROM state ORDER BY unit
"""

_CONTRACT_LONG = """
WITH RECURSIVE state(unit, pos, token) USING KEY (unit, pos) AS (
    SELECT unit, unnest(generate_series(1, len(tokens))), unnest(tokens) FROM units
    UNION ALL (
        WITH pairs AS (
            SELECT unit, pos, token, row_number() OVER w AS place, lag(token) OVER w AS before,
                lead(token) OVER w AS other, lead(token, 2) OVER w AS after
            FROM state WHERE token IS NOT NULL WINDOW w AS (PARTITION BY unit ORDER BY pos)
        ), ranked AS (
            SELECT p.*, m.merged, min(m.merged) OVER (PARTITION BY unit) AS best
            FROM pairs p LEFT JOIN merges m ON p.token = m.l AND p.other = m.r
        ), hits AS (
            SELECT *, merged IS NOT NULL AND merged = best AS hit FROM ranked WHERE best IS NOT NULL
        ), chains AS (
            SELECT *, hit AND NOT coalesce(lag(hit) OVER w, false) AS begins
            FROM hits WINDOW w AS (PARTITION BY unit ORDER BY place)
        ), taken AS (
            SELECT *, hit AND (place - max(CASE WHEN begins THEN place END) OVER w) % 2 = 0 AS takes
            FROM chains WINDOW w AS (PARTITION BY unit ORDER BY place)
        ), stops AS (
            SELECT unit, min(place) AS stop
            FROM (
                SELECT unit, place, takes, best, after,
                    CASE WHEN lag(takes, 2) OVER (PARTITION BY unit ORDER BY place) THEN best ELSE before END AS before
                FROM taken
            ) t
            WHERE takes AND (
                EXISTS (FROM merges x WHERE x.l = t.before AND x.r = t.best AND x.merged < t.best)
                OR EXISTS (FROM merges x WHERE x.l = t.best AND x.r = t.after AND x.merged < t.best))
            GROUP BY unit
        ), chosen AS (
            SELECT t.unit, pos, token, best, place, takes AND (stop IS NULL OR place <= stop) AS takes
            FROM taken t LEFT JOIN stops USING (unit)
        )
        SELECT unit, pos, CASE WHEN takes THEN best WHEN lag(takes) OVER w THEN NULL ELSE token END
        FROM chosen WINDOW w AS (PARTITION BY unit ORDER BY place)
    )
)
SELECT list(token ORDER BY pos) AS tokens FROM state WHERE token IS NOT NULL GROUP BY unit ORDER BY unit
"""

_DECODE = """
SELECT unhex(string_agg(v.hex, '' ORDER BY t.pos)) AS bytes
FROM tokens t JOIN vocabulary v ON v.id = t.id GROUP BY t.doc ORDER BY t.doc
"""


@dataclass
class Vocabulary:
    """Tokens with their ranks, and every pair of tokens that makes one (``merges``: left, right, merged)."""

    ids: dict[bytes, int]
    merges: np.ndarray
    byte_ids: np.ndarray
    #: Whether some token has byte a before byte b, at 256 * a + b.
    touching: np.ndarray

    @classmethod
    def of(cls, ids: dict[bytes, int]) -> Vocabulary:
        splits = ((t[:i], t[i:], rank) for t, rank in ids.items() for i in range(1, len(t)))
        merges = [(ids[a], ids[b], rank) for a, b, rank in splits if a in ids and b in ids]
        touching = np.zeros(1 << 16, bool)
        for token in ids:
            data = np.frombuffer(token, np.uint8).astype(np.int64)
            touching[data[:-1] * 256 + data[1:]] = True
        byte_ids = np.array([ids[bytes([b])] for b in range(256)], np.int32)
        return cls(ids, np.array(merges, np.int32).reshape(-1, 3), byte_ids, touching)

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """A file with a token in base64 and its rank per line."""
        with open(path, "rb") as f:
            return cls.of({base64.b64decode(t): int(rank) for t, rank in (line.split() for line in f if line.strip())})


def _database(**tables: pa.Table):
    import duckdb

    con = duckdb.connect(config=DUCKDB)
    for name, table in tables.items():
        con.register("given", table)
        con.execute(f"CREATE TABLE {name} AS FROM given")
        con.unregister("given")
    return con


class Encoder:
    """Token ids of texts, with the words seen so far."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        import regex

        self.vocabulary, self.pattern = vocabulary, regex.compile(pattern)
        left, right, merged = vocabulary.merges.T
        self.con = _database(merges=pa.table({"l": left, "r": right, "merged": merged}))
        self._forget()

    def close(self) -> None:
        self.con.close()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.size = self.used = 0
        self.starts, self.counts, self.flat = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(4096, np.int32)

    def _store(self, words: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        n, upto = len(self.known), self.used + len(ids)
        if n + len(words) > len(self.starts):
            room = 2 * (n + len(words))
            self.starts, self.counts = np.resize(self.starts, room), np.resize(self.counts, room)
        if upto > len(self.flat):
            self.flat = np.resize(self.flat, 2 * upto)
        self.starts[n : n + len(words)] = self.used + np.cumsum(counts) - counts
        self.counts[n : n + len(words)] = counts
        self.flat[self.used : upto] = ids
        self.used = upto
        self.known.update(zip(words, range(n, n + len(words)), strict=True))
        self.size += WORD_BYTES * len(words) + 4 * len(ids) + sum(map(len, words))

    def _contract(self, units: list[bytes], query: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units, one after another, and how many each has."""
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        bounds = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        tokens = pa.ListArray.from_arrays(bounds, pa.array(self.vocabulary.byte_ids[np.frombuffer(b"".join(units), np.uint8)]))
        self.con.register("units", pa.table({"unit": pa.array(range(len(units)), pa.int32()), "tokens": tokens}))
        found = self.con.sql(query).to_arrow_table().column("tokens").combine_chunks()
        self.con.unregister("units")
        return np.asarray(found.flatten(), np.int32), np.diff(np.asarray(found.offsets)).astype(np.int64)

    def _cut(self, word: bytes) -> list[bytes]:
        data = np.frombuffer(word, np.uint8).astype(np.int64)
        ends = np.flatnonzero(~self.vocabulary.touching[data[:-1] * 256 + data[1:]]) + 1
        return [word[a:b] for a, b in zip([0, *ends.tolist()], [*ends.tolist(), len(word)], strict=True)]

    def _encode_long(self, word: bytes) -> np.ndarray:
        units = self._cut(word)
        found: dict[bytes, np.ndarray] = {}
        for query, own in (
            (_CONTRACT, [u for u in dict.fromkeys(units) if len(u) <= LONG]),
            (_CONTRACT_LONG, [u for u in dict.fromkeys(units) if len(u) > LONG]),
        ):
            for at in range(0, len(own), UNITS):
                part = own[at : at + UNITS]
                ids, counts = self._contract(part, query)
                found.update(zip(part, np.split(ids, np.cumsum(counts)[:-1]), strict=True))
        return np.concatenate([found[u] for u in units])

    def _learn(self, words: list[str]) -> None:
        rest = []
        whole, ids = [], []
        for word in words:
            data = word.encode()
            known = self.vocabulary.ids.get(data)  # a word that is a token as it stands is that token
            if known is not None:
                whole.append(word)
                ids.append(known)
            elif len(data) > LONG:
                own = self._encode_long(data)
                self._store([word], own, np.array([len(own)]))
            else:
                rest.append((word, data))
        self._store(whole, np.array(ids, np.int32), np.ones(len(whole), np.int64))
        for at in range(0, len(rest), UNITS):
            part = rest[at : at + UNITS]
            self._store([w for w, _ in part], *self._contract([d for _, d in part], _CONTRACT))

    def _look_up(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after another, and how many each has."""
        if self.size > KNOWN_BYTES:
            self._forget()
        codes = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(codes < 0).tolist()
        if unknown:
            self._learn(list(dict.fromkeys(words[i] for i in unknown)))
            codes[unknown] = [self.known[words[i]] for i in unknown]
        counts = self.counts[codes]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.starts[codes] - (ends - counts), counts) + np.arange(total)], counts

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and each text's bounds in them."""
        parts, sizes = [np.zeros(0, np.int32)], np.zeros(len(texts), np.int64)
        words, owners = [], []

        def finish() -> None:
            ids, counts = self._look_up(words)
            parts.append(ids)
            upto = np.concatenate([[0], np.cumsum(counts)])
            ends = np.cumsum([n for _, n in owners])
            own = upto[ends] - upto[ends - [n for _, n in owners]]
            np.add.at(sizes, [i for i, _ in owners], own)
            words.clear()
            owners.clear()

        for i, text in enumerate(texts):
            found = map(lambda m: m[0], self.pattern.finditer(text)) if len(text) > CHUNK_BYTES else iter(self.pattern.findall(text))
            while own := list(islice(found, WORDS)):
                words += own
                owners.append((i, len(own)))
                if len(words) >= WORDS:
                    finish()
        if words:
            finish()
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(sizes)])


class Decoder:
    """Bytes of token ids."""

    def __init__(self, vocabulary: Vocabulary):
        ids = np.fromiter(vocabulary.ids.values(), np.int32, len(vocabulary.ids))
        self.known = np.zeros(int(ids.max()) + 1, bool)
        self.known[ids] = True
        self.con = _database(vocabulary=pa.table({"id": ids, "hex": [t.hex() for t in vocabulary.ids]}))

    def close(self) -> None:
        self.con.close()

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.known) or not self.known[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        out = [b""] * (len(bounds) - 1)
        docs = np.repeat(np.arange(len(out), dtype=np.int64), np.diff(bounds))
        for at in range(0, len(ids), TOKENS):
            part = slice(at, at + TOKENS)
            self.con.register("tokens", pa.table({"doc": docs[part], "pos": np.arange(len(ids[part])), "id": ids[part]}))
            found = self.con.sql(_DECODE).to_arrow_table().column("bytes").to_pylist()
            self.con.unregister("tokens")
            for doc, data in zip(np.unique(docs[part]).tolist(), found, strict=True):
                out[doc] = out[doc] + data if out[doc] else data
        return out


def _groups(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Slices of consecutive rows of about ``most`` in sum."""
    first = total = 0
    for i, n in enumerate(sizes.tolist()):
        if total and total + n > most:
            yield first, i
            first, total = i, 0
        total += n
    if len(sizes):
        yield first, len(sizes)


def _encode(batches: Iterator[pa.RecordBatch], vocabulary: Broadcast, pattern: str) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(vocabulary.value, pattern)
    try:
        for batch in batches:
            sizes = np.array([len(t.as_py() or "") if t.is_valid else 0 for t in batch.column(1)], np.int64)
            for first, last in _groups(sizes, CHUNK_BYTES):
                part = batch.slice(first, last - first)
                ids, bounds = encoder.encode([t or "" for t in part.column(1).to_pylist()])
                column = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays([part.column(0), column], ["doc_id", "ids"])
    finally:
        encoder.close()


def _decode(batches: Iterator[pa.RecordBatch], vocabulary: Broadcast) -> Iterator[pa.RecordBatch]:
    decoder = Decoder(vocabulary.value)
    try:
        for batch in batches:
            column = batch.column(1)
            sizes = np.diff(np.asarray(column.offsets))
            for first, last in _groups(sizes, CHUNK_BYTES):
                part = batch.slice(first, last - first)
                ids = part.column(1).fill_null([]) if part.column(1).null_count else part.column(1)
                flat = ids.flatten()
                if flat.null_count:
                    raise ValueError("an id is null")
                bounds = np.asarray(ids.offsets, np.int64)
                texts = decoder.decode(np.asarray(flat, np.int32), bounds - bounds[0])
                nulls = part.column(1).is_null().to_pylist()
                data = pa.array([None if n else t for n, t in zip(nulls, texts, strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), data], ["doc_id", "ids", "bytes"])
    finally:
        decoder.close()


def encode_documents(documents: DataFrame, vocabulary: Vocabulary, pattern: str) -> DataFrame:
    """One row per document: doc_id and ids, the tokens of its whole text.

    Each match of ``pattern`` is encoded for itself. A null or empty text has no tokens. Repeated rows stay,
    a null doc_id stays null, other columns are left out, and an empty table gives an empty result.
    """
    ship_package(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)
    rows = pick(documents, doc_id="long", text="string")
    return rows.mapInArrow(partial(_encode, vocabulary=shared, pattern=pattern), "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Rows of (doc_id, ids) with the bytes that their ids stand for.

    No ids give no bytes, null ids null. An id that is null or not in the vocabulary raises ValueError.
    """
    ship_package(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)
    rows = pick(encoded, doc_id="long", ids="array<int>")
    return rows.mapInArrow(partial(_decode, vocabulary=shared), "doc_id long, ids array<int>, bytes binary")
