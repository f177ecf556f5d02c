"""Token counts under a unigram vocabulary, one pass over a trie of distinct words.

The distinct words of a batch, in sorted order, are the depth-first walk of their trie: what a
word shares with the one before is a path from the root that is already scored. The forward scores
(best log probability and token count of every prefix) of that path are kept, and only the rest of
the word is computed. ``Lattice`` goes through the same trie depth by depth, for many words at once.
Counts at the ends of words are stored, and documents add them up.

The vocabulary file tells the order of the pieces and no probabilities. These are estimated by
expectation and maximisation over all distinct words, whose forward and backward sums are shared over
the same kind of trie.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import enter_stage, kept_in_worker, map_batches, pick, release_memory, written
from millrace.llm.words import CHUNK_BYTES

#: Marks the beginning of a word.
MARK = "▁"
#: How much less likely than the rarest piece one byte of an unknown character is.
BYTE_PENALTY = 10.0
#: Parts of words are gone through together until they have so many characters.
LATTICE_CHARS = 1 << 19
#: Longer parts are gone through one by one.
LONG = 1 << 8
#: What every piece counts beside its occurrences, so that none has probability 0.
PRIOR = 0.1
#: The estimation ends when a round raises the log probability by less than this share.
TOLERANCE = 1e-4


@dataclass
class Unigrams:
    """Pieces with log probabilities; a character that no piece has falls back to its bytes."""

    scores: dict[str, float]
    byte_score: float
    longest: int

    @classmethod
    def of(cls, scores: dict[str, float]) -> Unigrams:
        return cls(scores, min(scores.values()) - BYTE_PENALTY, max(map(len, scores)))

    @classmethod
    def from_ranks(cls, pieces: list[str]) -> Unigrams:
        """Pieces from most to least frequent, with probabilities by Zipf's law."""
        ranks = np.arange(1, len(pieces) + 1)
        logs = -np.log(ranks) - np.log((1 / ranks).sum())
        return cls.of(dict(zip(pieces, logs.tolist(), strict=True)))


def piece_file(path: str) -> Unigrams:
    """The normal pieces of a sentencepiece file, in its order of merit."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    ids.sort(key=lambda i: (-model.get_score(i), i))
    return Unigrams.from_ranks([model.id_to_piece(i) for i in ids])


class Pieces:
    """The trie of the pieces, numbered in their order, for many steps at once; its state 0 is the root and also no state."""

    def __init__(self, names: Iterable[str]):
        names = list(names)
        chars = sorted(set("".join(names)))
        self.code = np.zeros(max(map(ord, chars)) + 2, np.int64)
        self.code[list(map(ord, chars))] = np.arange(1, len(chars) + 1)
        self.n, self.width = len(names), len(chars) + 1
        steps, ends = {}, []
        for name in names:
            state = 0
            for code in self.code[list(map(ord, name))].tolist():
                state = steps.setdefault(state * self.width + code, len(steps) + 1)
            ends.append(state)
        keys = sorted(steps)
        self.keys = np.array([*keys, np.iinfo(np.int64).max])
        self.states = np.array([*map(steps.__getitem__, keys), 0])
        self.piece = np.full(len(steps) + 1, -1)
        self.piece[ends] = np.arange(self.n)

    def codes(self, chars: np.ndarray) -> np.ndarray:
        """The pieces' own numbers of characters; 0 is one that no piece has."""
        return self.code[np.minimum(chars, len(self.code) - 1)]

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        keys = states * self.width + codes
        at = np.searchsorted(self.keys, keys)
        return np.where(self.keys[at] == keys, self.states[at], 0)


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The characters of all words in a row, and where each word ends there."""
    chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return chars, np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))


def matches(words: list[str], pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where pieces stand in the characters of all words: first place, end and number of each; shorter ones come first."""
    chars, ends = code_points(words)
    codes, last = pieces.codes(chars), np.repeat(ends, np.diff(ends, prepend=0))
    start, state, depth, found = np.arange(len(chars)), np.zeros(len(chars), np.int64), 0, []
    while len(start):
        inside = start + depth < last[start]
        start, state = start[inside], state[inside]
        state = pieces.step(state, codes[start + depth])
        start, state, depth = start[state > 0], state[state > 0], depth + 1
        piece = pieces.piece[state]
        whole = piece >= 0
        found.append((start[whole], start[whole] + depth, piece[whole]))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3


def parts_of(words: list[str], pieces: Pieces) -> tuple[list[str], np.ndarray]:
    """The words cut wherever no piece bridges the place, and the place in ``words`` that each part is from.

    Every segmentation has a token end there, so the expectations of a word are the sums of those of its parts.
    """
    text, ends = "".join(words), np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    reach = np.arange(1, len(text) + 1)
    starts, stops, _ = matches(words, pieces)
    reach[starts] = stops
    cuts = np.flatnonzero(np.maximum.accumulate(reach) == np.arange(1, len(text) + 1)) + 1
    bounds = [0, *cuts.tolist()]
    return [text[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)], np.searchsorted(ends, cuts)


def _headed(rows: np.ndarray, n: int, heads: tuple, values: tuple) -> tuple[np.ndarray, ...]:
    """For each of ``n`` nodes one head and then its ``values``, which go with the sorted ``rows``: their counts, and each column."""
    counts = np.bincount(rows, minlength=n) + 1
    first = np.cumsum(counts) - counts
    rest = np.ones(n + len(rows), bool)
    rest[first] = False
    columns = [np.empty(len(rest), np.int64) for _ in heads]
    for column, head, value in zip(columns, heads, values, strict=True):
        column[first], column[rest] = head, value
    return counts, *columns


class Lattice:
    """The trie of some words with every piece that leads from one node to a deeper one.

    A node is a prefix, numbered by depth. A level has the edges to the nodes of one depth: their number for each
    node, their sources, and their labels: the piece's number, or behind the last one the bytes of a character.
    Levels are built for all words at once; a node's open pairs are the nodes above it (itself included) from
    which a piece may still lead on, with the states of ``Pieces`` that the way from there has come to.
    """

    def __init__(self, words: list[str], pieces: Pieces | dict[str, int]):
        pieces = pieces if isinstance(pieces, Pieces) else Pieces(pieces)
        words = sorted(words)
        chars, ends = code_points(words)
        lengths = np.diff(ends, prepend=0)
        codes, n_bytes = pieces.codes(chars), 1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000)
        self.ends, self.n_nodes, self.levels = np.zeros(len(words), np.int64), 1, []
        going, above, depth = np.flatnonzero(lengths), 0, 0  # words that go on; the first node of their depth
        node = np.zeros(len(going), np.int64)
        opened, sources, states = np.ones(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64)
        while len(going):
            at = (ends - lengths)[going] + depth
            fresh = np.ones(len(going), bool)
            fresh[1:] = (node[1:] != node[:-1]) | (chars[at][1:] != chars[at][:-1])
            parent, at, node, low = node[fresh], at[fresh], np.cumsum(fresh) - 1, self.n_nodes
            n, count = len(at), opened[parent]
            target = np.repeat(np.arange(n), count)
            pair = np.arange(len(target)) + np.repeat((np.cumsum(opened) - opened)[parent] - (np.cumsum(count) - count), count)
            state = pieces.step(states[pair], codes[at][target])
            target, source, state = target[state > 0], sources[pair[state > 0]], state[state > 0]
            piece = pieces.piece[state]
            whole = piece >= 0
            edges = (above + parent, pieces.n - 1 + n_bytes[at]), (source[whole], piece[whole])
            self.levels.append(_headed(target[whole], n, *edges))
            opened, sources, states = _headed(target, n, (low + np.arange(n), 0), (source, state))
            above, self.n_nodes, depth = low, low + n, depth + 1
            done = lengths[going] == depth
            self.ends[going[done]] = low + node[done]
            going, node = going[~done], node[~done]

    def expected(self, logs: np.ndarray, byte_score: float, counts: np.ndarray) -> tuple[np.ndarray, float]:
        """How often each piece is expected in the words, each ``counts`` times, and their log probability.

        ``counts`` goes with the sorted words. The forward sums give each edge its share of the ways to its node;
        backward, the passes through a node (of all words below it) go to its edges by these shares, so one pass
        over the edges serves all words.
        """
        weights = np.concatenate([logs, byte_score * np.arange(1, 5)])
        forward, shares, at = np.zeros(self.n_nodes), [], 1
        for count, source, label in self.levels:
            first, way = np.cumsum(count) - count, forward[source] + weights[label]
            top = np.maximum.reduceat(way, first)
            way = np.exp(way - np.repeat(top, count))
            total = np.add.reduceat(way, first)
            forward[at : at + len(count)] = top + np.log(total)
            shares.append(way / np.repeat(total, count))
            at += len(count)
        passes, labels = np.bincount(self.ends, counts, self.n_nodes), [np.zeros(0, np.int64)]
        for (count, source, label), share in zip(reversed(self.levels), reversed(shares), strict=True):
            share *= np.repeat(passes[at - len(count) : at], count)
            np.add.at(passes, source, share)
            labels.append(label)
            at -= len(count)
        found = np.bincount(np.concatenate(labels), np.concatenate([np.zeros(0), *reversed(shares)]), len(weights))
        return found[: len(logs)], float((forward[self.ends] * counts).sum())

    def best(self, logs: np.ndarray, byte_score: float) -> tuple[np.ndarray, np.ndarray]:
        """What ``trie_counts`` gives for the sorted words."""
        weights, steps = np.concatenate([logs, byte_score * np.arange(1, 5)]), np.ones(len(logs) + 4, np.int64)
        steps[len(logs) :] = np.arange(1, 5)
        scores, tokens, at = np.zeros(self.n_nodes), np.zeros(self.n_nodes, np.int64), 1
        for count, source, label in self.levels:
            first, way = np.cumsum(count) - count, scores[source] + weights[label]
            top, here = np.maximum.reduceat(way, first), slice(at, at + len(count))
            number = np.where(way == np.repeat(top, count), tokens[source] + steps[label], np.iinfo(np.int64).max)
            scores[here], tokens[here] = top, np.minimum.reduceat(number, first)
            at += len(count)
        return tokens[self.ends], scores[self.ends]


def expected_alone(word: str, pieces: Pieces, logs: np.ndarray, byte_score: float, count: int) -> tuple[np.ndarray, float]:
    """What ``Lattice.expected`` gives for one word, place by place: a long one has no levels to share."""
    chars, _ = code_points([word])
    weights = np.concatenate([logs, byte_score * np.arange(1, 5)])
    starts, stops, labels = matches([word], pieces)
    n_bytes = 1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000)
    starts, stops = np.append(starts, np.arange(len(chars))), np.append(stops, np.arange(1, len(chars) + 1))
    order = np.argsort(stops, kind="stable")
    labels = np.append(labels, pieces.n - 1 + n_bytes)[order]
    sources, edge_weights = starts[order].tolist(), weights[labels].tolist()
    bounds = np.searchsorted(stops[order], np.arange(1, len(chars) + 2)).tolist()
    forward, shares = [0.0], []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        ways = [forward[sources[e]] + edge_weights[e] for e in range(a, b)]
        top = max(ways)
        ways = [math.exp(w - top) for w in ways]
        total = sum(ways)
        forward.append(top + math.log(total))
        shares += [w / total for w in ways]
    passes = [0.0] * len(chars) + [float(count)]
    for stop in range(len(chars), 0, -1):
        here = passes[stop]
        for e in range(bounds[stop - 1], bounds[stop]):
            shares[e] *= here
            passes[sources[e]] += shares[e]
    return np.bincount(labels, shares, len(weights))[: len(logs)], forward[-1] * count


#: Expected counts of the pieces and the log probability of all words, by log probabilities and the score of a byte.
Expect = Callable[[np.ndarray, float], tuple[np.ndarray, float]]


def maximised(expect: Expect, start: Unigrams, tolerance: float) -> Unigrams:
    """The pieces of ``start`` with the probabilities that expectation and maximisation finds.

    Each round raises the log probability of the words and of the prior, so the rounds come to an end.
    """
    logs, before = np.array(list(start.scores.values())), -np.inf
    while True:
        expected, found = expect(logs, start.byte_score)
        merit = found + PRIOR * logs.sum()
        if merit - before <= tolerance * abs(merit):
            return Unigrams.of(dict(zip(start.scores, logs.tolist(), strict=True)))
        logs, before = np.log(expected + PRIOR) - np.log((expected + PRIOR).sum()), merit


def fitted(words: list[str], counts: list[int], start: Unigrams, tolerance: float = TOLERANCE) -> Unigrams:
    """The pieces of ``start`` with probabilities estimated from a list of sorted ``words``."""
    if not words:
        return start
    lattice, n = Lattice(words, Pieces(start.scores)), np.array(counts, float)
    return maximised(lambda logs, byte_score: lattice.expected(logs, byte_score, n), start, tolerance)


def portions(batches: Iterable[pa.RecordBatch]) -> Iterator[dict[str, int]]:
    """Distinct words with their counts, together until they have ``LATTICE_CHARS`` characters."""
    words, size = {}, 0
    for batch in batches:
        for word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words[word] = n
            size += len(word)
            if size > LATTICE_CHARS:
                yield words
                words, size = {}, 0
    if words:
        yield words


def _parts(batch: pa.RecordBatch, pieces: Broadcast) -> pa.RecordBatch:
    parts, counts = [], [np.zeros(0, np.int64)]
    for words in portions([batch]):
        more, rows = parts_of([MARK + w for w in words], pieces.value)
        parts += more
        counts.append(np.fromiter(words.values(), np.int64, len(words))[rows])
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.string()), pa.array(np.concatenate(counts))], ["part", "n"])


def _expected(
    batches: Iterator[pa.RecordBatch], pieces: Broadcast, logs: np.ndarray, byte_score: float
) -> Iterator[pa.RecordBatch]:
    """Of the parts of one task: the expected count of each piece, and for the piece -1 their log probability."""
    enter_stage()
    try:
        found = [(np.zeros(len(logs)), 0.0)]
        for parts in portions(batches):
            short = sorted(p for p in parts if len(p) <= LONG)
            counts = np.array([parts[p] for p in short], float)
            found.append(Lattice(short, pieces.value).expected(logs, byte_score, counts))
            found += [expected_alone(p, pieces.value, logs, byte_score, n) for p, n in parts.items() if len(p) > LONG]
            found = [tuple(map(sum, zip(*found, strict=True)))]
        expected, log_prob = found[0]
        at = np.flatnonzero(expected)
        arrays = [pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(expected[at], log_prob))]
        yield pa.RecordBatch.from_arrays(arrays, ["piece", "expected"])
    finally:
        release_memory()


def estimate_unigrams(documents: DataFrame, start: Unigrams, sample_words: int | None = None) -> Unigrams:
    """The pieces of ``start`` with probabilities estimated from the words of ``documents``.

    Words, here parts between ASCII white space, are counted over all documents, and each round goes over all
    distinct ones, in tasks that each add up the expected counts of their own; only the sums for the pieces
    come to the driver. Log probabilities are rounded to multiples of 2^-20, so that sums of them are exact and
    the order of the tasks decides nothing. Without any words, ``start`` is returned. With ``sample_words``, the
    distinct words whose hash is below the share that so many have of them make the fit alone.
    """
    spark = documents.sparkSession
    text = pick(documents, doc_id="long", text="string").select(F.explode(F.split("text", r"\s+")).alias("word"))
    counts = text.where("word <> ''").groupBy("word").agg(F.count("*").alias("n"))
    if sample_words is not None:
        counts = written(counts, "words")
        distinct = counts.count()
        if distinct > sample_words:
            counts = counts.where(F.xxhash64("word") < -(1 << 63) + (sample_words << 64) // distinct)
    pieces = spark.sparkContext.broadcast(Pieces(start.scores))
    parts = map_batches(counts, partial(_parts, pieces=pieces), "part string, n long").groupBy("part").agg(F.sum("n").alias("n"))
    parts = written(parts.repartitionByRange("part").sortWithinPartitions("part"), "parts")  # neighbours share beginnings

    def expect(logs: np.ndarray, byte_score: float) -> tuple[np.ndarray, float]:
        run = partial(_expected, pieces=pieces, logs=logs, byte_score=byte_score)
        found = parts.mapInArrow(run, "piece int, expected double").groupBy("piece").agg(F.sum("expected")).collect()
        sums = np.zeros(len(logs) + 1)
        for piece, n in found:
            sums[piece] = n
        return sums[:-1], float(sums[-1])

    fit = start if parts.isEmpty() else maximised(expect, start, TOLERANCE)
    pieces.destroy()
    if fit is start:
        return start
    return Unigrams.of({piece: round(log * 2**20) / 2**20 for piece, log in fit.scores.items()})


def trie_counts(words: list[str], unigrams: Unigrams) -> tuple[list[int], list[float]]:
    """Token count and log probability of the best segmentation of each word; ``words`` is sorted.

    Of equally good segmentations the one with fewer tokens counts.
    """
    scores, longest = unigrams.scores, unigrams.longest
    best, tokens = [0.0], [0]
    before, out_tokens, out_scores = "", [], []
    for word in words:
        shared, most = 0, min(len(word), len(before))
        while shared < most and word[shared] == before[shared]:
            shared += 1
        del best[shared + 1 :], tokens[shared + 1 :]
        for end in range(shared + 1, len(word) + 1):
            n = len(word[end - 1].encode())
            score, count = best[end - 1] + n * unigrams.byte_score, tokens[end - 1] + n
            for start in range(max(0, end - longest), end):
                piece = scores.get(word[start:end])
                if piece is not None:
                    new = best[start] + piece
                    if new > score or new == score and tokens[start] + 1 < count:
                        score, count = new, tokens[start] + 1
            best.append(score)
            tokens.append(count)
        before = word
        out_tokens.append(tokens[-1])
        out_scores.append(best[-1])
    return out_tokens, out_scores


class Counter:
    """Counts of words seen so far, up to a bound, after which it begins anew."""

    def __init__(self, unigrams: Unigrams, words: int = 500_000):
        self.unigrams, self.most = unigrams, words
        self.pieces, self.logs = Pieces(unigrams.scores), np.array(list(unigrams.scores.values()))
        self.known, self.tokens, self.scores = {}, [], []

    def _learn(self, words: list[str]) -> None:
        """Count sorted words that are not known yet: long ones by themselves, the others at once."""
        short = [w for w in words if len(w) <= LONG]
        long = [w for w in words if len(w) > LONG]
        found = [(long, *trie_counts([MARK + w for w in long], self.unigrams))]
        blocks = np.cumsum(np.fromiter(map(len, short), np.int64, len(short))) // LATTICE_CHARS
        cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(short)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            tokens, scores = Lattice([MARK + w for w in short[a:b]], self.pieces).best(self.logs, self.unigrams.byte_score)
            found.append((short[a:b], tokens.tolist(), scores.tolist()))
        for some, tokens, scores in found:
            self.known.update(zip(some, range(len(self.known), len(self.known) + len(some)), strict=True))
            self.tokens += tokens
            self.scores += scores

    def add_up(self, texts: list[str]) -> list[tuple[int, int, float]]:
        """(words, tokens, log probability) of each text."""
        if len(self.known) > self.most:
            self.known, self.tokens, self.scores = {}, [], []
        split = [t.split() for t in texts]
        words = [w for one in split for w in one]
        fresh = sorted(w for w in set(words) if w not in self.known)
        if fresh:
            self._learn(fresh)
        codes = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        if fresh or not hasattr(self, "_arrays"):
            self._arrays = np.array(self.tokens, np.int64), np.array(self.scores)
        tokens, scores = (a[codes] if len(codes) else np.zeros(0, a.dtype) for a in self._arrays)
        bounds = np.concatenate([[0], np.cumsum([len(one) for one in split])]).astype(int)
        return [
            (b - a, int(tokens[a:b].sum()), float(scores[a:b].sum())) for a, b in zip(bounds[:-1], bounds[1:], strict=True)
        ]


def _counter(unigrams: Broadcast) -> Counter:
    """One for the tasks of a stage in a Python worker, so that known words serve all of them."""
    return kept_in_worker("counter", lambda: Counter(unigrams.value))


def _batch(batch: pa.RecordBatch, unigrams: Broadcast) -> pa.RecordBatch:
    counter, rows, open_texts, size = _counter(unigrams), [], [], 0
    for text in batch.column(1).to_pylist():
        open_texts.append(text or "")
        size += len(open_texts[-1])
        if size > CHUNK_BYTES:
            rows += counter.add_up(open_texts)
            open_texts, size = [], 0
    rows += counter.add_up(open_texts)
    words, tokens, scores = zip(*rows, strict=True) if rows else ((), (), ())
    arrays = [pa.array(words, pa.int64()), pa.array(tokens, pa.int64()), pa.array(scores, pa.float64())]
    return pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", "n_words", "n_tokens", "log_prob"])


def count_tokens(documents: DataFrame, unigrams: Unigrams) -> DataFrame:
    """One row per document: doc_id, n_words, n_tokens, log_prob of its best segmentation.

    Words are parts between white space, each with a mark before it. A null or empty text and one
    of white space have 0 words and tokens. Characters without a piece count as their UTF-8 bytes.
    Repeated rows stay; other columns are left out; an empty table gives an empty result.
    """
    shared = documents.sparkSession.sparkContext.broadcast(unigrams)
    rows = pick(documents, doc_id="long", text="string")
    return map_batches(rows, partial(_batch, unigrams=shared), "doc_id long, n_words long, n_tokens long, log_prob double")
