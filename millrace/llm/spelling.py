"""Spelling variants: words at one edit from each other, by search schemes over bidirectional FM indexes.

With one error in a word, one of its halves is intact. So each word is dealt, as text, to the shards of the
beginnings and ends that a word near it can have as its half, and, as pattern, to the shards of its own two
halves. A shard is an FM index over its words between delimiters: suffix ranks of the text and of its mirror
image, kept in step, so that an interval of either can be extended to the left and to the right. A search
matches one half with its delimiter exactly, then crosses the other half with one error and has to end on the
delimiter. All patterns of a shard take their steps together, as arrays of intervals.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import pick, ship_package, written

#: Text words of a shard, about; a half with more of them is split over several shards.
SHARD_WORDS = 32_768
#: Patterns that are searched at a time.
PATTERNS = 8_192
#: Longer texts are cut into parts of so many code points before their runs are listed.
PART = 1 << 20
LETTERS = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def cyclic_order(codes: np.ndarray, bits: int) -> np.ndarray:
    """Starts of the rotations of ``codes`` in order; no two rotations are equal."""
    n, width = len(codes), 62 // bits
    key = np.zeros(n, np.int64)
    for i in range(width):
        key = key << bits | np.roll(codes, -i)
    while True:
        order = np.argsort(key, kind="stable")
        ranks = np.empty(n, np.int64)
        ranks[order] = np.cumsum(np.concatenate([[0], key[order][1:] != key[order][:-1]]))
        if ranks[order[-1]] == n - 1:
            return order
        key = ranks * n + np.roll(ranks, -width)
        width *= 2


class Ranks:
    """A wavelet matrix: how often symbols occur in the beginnings of a sequence, and where suffixes with them begin."""

    def __init__(self, codes: np.ndarray, bits: int):
        self.zeros, self.levels, order = [], [], codes
        for bit in range(bits - 1, -1, -1):
            ones = (order >> bit & 1).astype(bool)
            self.levels.append((bit, np.concatenate([[0], np.cumsum(~ones)]).astype(np.int32)))
            self.zeros.append(int(len(ones) - ones.sum()))
            order = np.concatenate([order[~ones], order[ones]])
        symbols = np.arange(1 << bits)
        self.first = np.searchsorted(np.sort(codes), symbols)
        self.base = self._descend(np.zeros(len(symbols), np.int64), np.zeros(len(symbols), np.int64), symbols)[0]

    def _descend(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray):
        less = np.zeros(len(low), np.int64)
        for (bit, ranks), zeros in zip(self.levels, self.zeros, strict=True):
            one = (symbol >> bit & 1).astype(bool)
            a, b = ranks[low], ranks[high]
            less += np.where(one, b - a, 0)
            low, high = np.where(one, zeros + low - a, a), np.where(one, zeros + high - b, b)
        return low, high, less

    def extend(self, low: np.ndarray, size: np.ndarray, symbol: np.ndarray):
        """(begin, size) of each interval behind ``symbol``, and how many of its rows have a smaller symbol."""
        begin, end, less = self._descend(low, low + size, symbol)
        return self.first[symbol] + begin - self.base[symbol], end - begin, less

    def children(self, low: np.ndarray, size: np.ndarray):
        """All symbols that occur in each interval: (interval, symbol) and what ``extend`` gives for them."""
        own, symbol, less, high = np.arange(len(low)), np.zeros(len(low), np.int64), np.zeros(len(low), np.int64), low + size
        for (bit, ranks), zeros in zip(self.levels, self.zeros, strict=True):
            a, b = ranks[low].astype(np.int64), ranks[high].astype(np.int64)
            left, right = np.flatnonzero(b > a), np.flatnonzero(high - b > low - a)
            symbol = np.concatenate([symbol[left], symbol[right] | 1 << bit])
            less = np.concatenate([less[left], less[right] + (b - a)[right]])
            own = np.concatenate([own[left], own[right]])
            low, high = (
                np.concatenate([x[left], zeros + (y - x)[right]]) for x, y in ((a, low), (b, high))
            )
        return own, symbol, self.first[symbol] + low - self.base[symbol], high - low, less


class Index:
    """A bidirectional FM index of distinct words between delimiters (code 0), read as a ring.

    An interval is (low in the suffix ranks of the text, low in those of its mirror image, size).
    """

    def __init__(self, words: list[str]):
        joined = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.alphabet = np.unique(joined)
        bits = max(1, int(len(self.alphabet) + 1).bit_length())
        self.starts = np.cumsum(sizes + 1) - sizes - 1
        text = np.zeros(len(joined) + len(words), np.int64)
        inside = np.ones(len(text), bool)
        inside[self.starts] = False
        text[inside] = np.searchsorted(self.alphabet, joined) + 1
        self.order = cyclic_order(text, bits)
        mirror = text[::-1]
        self.forward = Ranks(text[self.order - 1], bits)
        self.backward = Ranks(mirror[cyclic_order(mirror, bits) - 1], bits)
        self.size = len(text)

    def codes(self, word: str) -> np.ndarray:
        """Codes of a word; a letter that no text has gets one that occurs nowhere."""
        points = np.frombuffer(word.encode("utf-32-le"), "<u4")
        at = np.searchsorted(self.alphabet, points)
        known = self.alphabet[np.minimum(at, len(self.alphabet) - 1)] == points
        return np.where(known, at + 1, len(self.alphabet) + 1).astype(np.int64)

    def step(self, states: np.ndarray, symbol: np.ndarray, to_right: bool) -> np.ndarray:
        ranks, own, other = (self.backward, 1, 0) if to_right else (self.forward, 0, 1)
        out = np.empty_like(states)
        out[own], out[2], less = ranks.extend(states[own], states[2], symbol)
        out[other] = states[other] + less
        return out

    def children(self, states: np.ndarray, to_right: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ranks, own, other = (self.backward, 1, 0) if to_right else (self.forward, 0, 1)
        parent, symbol, begin, size, less = ranks.children(states[own], states[2])
        out = np.empty((3, len(parent)), np.int64)
        out[own], out[other], out[2] = begin, states[other][parent] + less, size
        return parent, symbol, out

    def words_at(self, states: np.ndarray) -> np.ndarray:
        """The word of each interval of one whole word with its delimiters."""
        return np.searchsorted(self.starts, self.order[states[0]])

    def near(self, patterns: list[str], left_half: bool) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (pattern, word) with the pattern's left (right) half intact and one edit in the other one."""
        exact, rest = [], []
        for word in patterns:
            codes, half = self.codes(word), len(word) // 2
            exact.append(codes[:half][::-1] if left_half else codes[half:])
            rest.append(codes[half:] if left_half else codes[:half][::-1])
        exact, rest = _padded(exact), _padded(rest)
        states = np.zeros((3, len(patterns)), np.int64)
        states[2] = self.size
        own = np.arange(len(patterns))
        for at in range(exact.codes.shape[1]):
            open_ = at <= exact.sizes[own]
            moved = self.step(states[:, open_], exact.codes[own[open_], at], to_right=not left_half)
            states = np.concatenate([states[:, ~open_], moved], axis=1)
            own = np.concatenate([own[~open_], own[open_]])
            left = states[2] > 0
            states, own = states[:, left], own[left]
        return self._cross(states, own, rest, to_right=left_half)

    def _cross(self, states: np.ndarray, own: np.ndarray, rest: _Codes, to_right: bool) -> tuple[np.ndarray, np.ndarray]:
        at = np.zeros(len(own), np.int64)
        erred = (np.zeros((3, 0), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        while len(own) or len(erred[1]):
            # With the error behind them: the next letter, or the delimiter and the end.
            moved, whose, place = erred
            moved = self.step(moved, rest.codes[whose, place], to_right)
            left, ends = moved[2] > 0, place == rest.sizes[whose]
            found.append((whose[left & ends], self.words_at(moved[:, left & ends])))
            left &= ~ends
            erred = [(moved[:, left], whose[left], place[left] + 1)]
            # Still exact: leave a letter out, or take any letter that follows here.
            inner = at < rest.sizes[own]
            next_same = rest.codes[own, np.minimum(at + 1, rest.codes.shape[1] - 1)] == rest.codes[own, at]
            leave = inner & ~next_same  # of equal letters in a row only the last one
            erred.append((states[:, leave], own[leave], at[leave] + 1))
            parent, symbol, moved = self.children(states, to_right)
            whose, place = own[parent], at[parent]
            same, inner = symbol == rest.codes[whose, place], inner[parent]
            other = ~same & (symbol > 0)
            erred.append((moved[:, other], whose[other], place[other]))
            other &= inner
            erred.append((moved[:, other], whose[other], place[other] + 1))
            same &= inner
            states, own, at = moved[:, same], whose[same], place[same] + 1
            erred = tuple(np.concatenate(x, axis=-1) for x in zip(*erred, strict=True))
        pattern, word = (np.concatenate(x) for x in zip(*found, strict=True))
        pairs = np.unique(pattern * len(self.starts) + word)
        return pairs // len(self.starts), pairs % len(self.starts)


class _Codes:
    def __init__(self, codes: np.ndarray, sizes: np.ndarray):
        self.codes, self.sizes = codes, sizes


def _padded(rows: list[np.ndarray]) -> _Codes:
    """Rows as a matrix; at least one delimiter follows each."""
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    out = np.zeros((len(rows), int(sizes.max(initial=0)) + 1), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = np.concatenate(rows) if rows else []
    return _Codes(out, sizes)


def _search(table: pa.Table) -> pa.Table:
    """The near words of the patterns of one shard."""
    texts = table.filter(pc.equal(table.column("role"), 0))
    patterns = table.filter(pc.equal(table.column("role"), 1))
    out: dict[str, list] = {"id": [], "near": [], "near_n": []}
    places: dict[str, int] = {}
    counts, here = [], []
    for word, n, size in zip(*(texts.column(c).to_pylist() for c in ("word", "n", "size")), strict=True):
        if places.setdefault(word, len(places)) == len(counts):
            counts.append(n)
            here.append(set())
        here[places[word]].add(size)  # a word can be here with two of its halves
    words = list(places)
    if words and patterns.num_rows:
        index, left_half = Index(words), table.column("side")[0].as_py() == "L"
        # Two parts of a split half can fall into one shard.
        patterns = dict(zip(*(patterns.column(c).to_pylist() for c in ("id", "word")), strict=True))
        ids, own = list(patterns), list(patterns.values())
        # Patterns of about the same length take their steps together.
        order = sorted(range(len(own)), key=lambda i: len(own[i]))
        for first in range(0, len(order), PATTERNS):
            part = order[first : first + PATTERNS]
            for p, w in zip(*(x.tolist() for x in index.near([own[i] for i in part], left_half)), strict=True):
                pattern = own[part[p]]
                half = pattern[: len(pattern) // 2]
                # A pattern is in several shards if its half is split, a word there with that half in one only.
                if (len(half) if left_half else len(pattern) - len(half)) not in here[w]:
                    continue
                # Words with the left half intact are found by that half.
                if left_half or not words[w].startswith(half):
                    out["id"].append(ids[part[p]])
                    out["near"].append(words[w])
                    out["near_n"].append(counts[w])
    return pa.table([pa.array(out["id"], pa.int64()), pa.array(out["near"]).cast(pa.string()), pa.array(out["near_n"], pa.int64())], ["id", "near", "near_n"])


def near_words(vocabulary: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(id, near, near_n) for all pairs of words at exactly one edit, once in each direction.

    ``vocabulary`` is a stored table of (id, word, n) with distinct words of two letters at least.
    """
    ship_package(vocabulary.sparkSession)
    size, half = F.length("word"), F.floor(F.length("word") / 2)
    begin = lambda n: F.struct(F.lit("L").alias("side"), F.substring("word", F.lit(1), n.cast("int")).alias("half"))
    end = lambda n: F.struct(F.lit("R").alias("side"), F.right("word", n.cast("int")).alias("half"))
    # A word near one of n letters has n - 1, n or n + 1 letters, and the halves have n // 2 and n - n // 2.
    texts = vocabulary.withColumn(
        "key",
        F.explode(F.array(*[f(n) for f, n in ((begin, F.floor((size - 1) / 2)), (begin, F.floor((size + 1) / 2)), (end, F.floor(size / 2)), (end, F.floor(size / 2) + 1))])),
    )
    patterns = vocabulary.withColumn("key", F.explode(F.array(begin(half), end(size - half))))
    crowded = (
        texts.groupBy("key").agg(F.count("*").alias("crowd")).where(F.col("crowd") > shard_words)
        .select("key", F.ceil(F.col("crowd") / shard_words).cast("int").alias("parts"))
    )
    shards = max(1, -(-4 * vocabulary.count() // shard_words))
    parts = F.coalesce("parts", F.lit(1))
    texts = texts.join(crowded, "key", "left").select(
        "id", "word", "n", "key", F.lit(0).alias("role"), F.pmod(F.xxhash64("word"), parts).cast("int").alias("part")
    )
    patterns = patterns.join(crowded, "key", "left").select(
        "id", "word", "n", "key", F.lit(1).alias("role"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part")
    )
    rows = texts.unionByName(patterns).select(
        "id", "word", "n", "role", "key.side", F.length("key.half").alias("size"), F.pmod(F.xxhash64("key.half", "part"), F.lit(shards)).alias("shard")
    )
    return rows.groupBy("side", "shard").applyInArrow(_search, "id long, near string, near_n long")


def text_parts(documents: DataFrame) -> DataFrame:
    """(doc_id, text) with texts of more than ``PART`` code points cut between runs of letters.

    A run that crosses a cut goes with the part in which it begins.
    """
    documents = documents.where("text IS NOT NULL")
    short = documents.where(F.length("text") <= PART)
    long = documents.where(F.length("text") > PART).select(
        "doc_id", "text", F.explode(F.sequence(F.lit(0), F.floor((F.length("text") - 1) / PART).cast("int"))).alias("i")
    )
    own = F.substring("text", F.col("i") * PART + 1, F.lit(PART))
    own = F.when(F.col("i") == 0, own).when(
        F.substring("text", F.col("i") * PART, F.lit(1)).rlike(LETTERS), F.regexp_replace(own, f"^{LETTERS}+", "")
    ).otherwise(own)
    rest = F.regexp_extract(F.substring("text", (F.col("i") + 1) * PART + 1, F.length("text")), f"^{LETTERS}+", 0)
    long = long.select("doc_id", own.alias("own"), rest.alias("rest"))
    whole = F.when(F.col("own").rlike(f"{LETTERS}$"), F.concat("own", "rest")).otherwise(F.col("own"))
    return short.select("doc_id", "text").unionByName(long.select("doc_id", whole.alias("text")))


def count_words(documents: DataFrame, least_length: int = 7, least_count: int = 2, divisor: int = 31) -> DataFrame:
    """(word, n): runs of letters with A-Z in lower case, some of them with a letter left out, and how often they occur.

    A run loses letter h % length if ``divisor`` divides h, the crc32 of "doc_id:run" (a null doc_id is empty there).
    """
    rows = text_parts(pick(documents, doc_id="long", text="string"))
    runs = rows.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
        F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(f"{LETTERS}+"), F.lit(0))).alias("run"),
    ).where(F.length("run") >= least_length)
    hashed = runs.withColumn("h", F.crc32(F.encode(F.concat_ws(":", "doc", "run"), "UTF-8")))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % divisor == 0, shorter).otherwise(F.col("run"))
    words = hashed.select(word.alias("word")).where(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words with a form: the last one on their way from form to form."""
    links = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = links.join(onward, "root", "left")
        if joined.where("further IS NOT NULL").isEmpty():
            return links
        links = written(joined.select("word", F.coalesce("further", "root").alias("root")), "roots")


def group_variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """One row per word of ``words`` (distinct word, n): form, root, n_near and form_n.

    Two words are near if one edit of a letter leads from one to the other. A word's form is the near word of
    largest n (of equal ones the smallest), if that n is at least ``ratio`` times its own; its root is where the
    way from form to form ends, the word itself if it has no form. Words without near ones stay, with n_near 0.
    """
    vocabulary = written(words.select("word", "n").withColumn("id", F.monotonically_increasing_id()), "words")
    best = near_words(vocabulary).groupBy("id").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("best")
    )
    joined = vocabulary.join(best, "id", "left")
    formed = -F.col("best.rank") >= ratio * F.col("n")
    judged = written(
        joined.select(
            "word",
            F.when(formed, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(formed, -F.col("best.rank")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(judged.where("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(documents: DataFrame, least_length: int = 7, least_count: int = 2, ratio: int = 10) -> DataFrame:
    """Words of all texts with their spelling variants: word, form, root, n, n_near, form_n.

    ``documents`` has doc_id and text; see ``count_words`` for what a word is and ``group_variants`` for the
    columns. Null and empty texts have no words, repeated rows count again, other columns are left out, and an
    empty table gives an empty result.
    """
    return group_variants(count_words(documents, least_length, least_count), ratio)
