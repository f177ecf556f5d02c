"""Token counts against plain segmentation of every word."""

import collections
import math
import random

import numpy as np
import pytest

from millrace.llm.queries import tokenizer_file
from millrace.llm.token_counts import (
    MARK,
    PRIOR,
    Counter,
    Lattice,
    Pieces,
    Unigrams,
    count_tokens,
    estimate_unigrams,
    expected_alone,
    fitted,
    parts_of,
    piece_file,
    trie_counts,
)

SF = "/root/testdata/sf0.001"


def plain(word, unigrams):
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        n = len(word[end - 1].encode())
        options = [(best[end - 1][0] + n * unigrams.byte_score, -(n - best[end - 1][1]))]
        for start in range(end):
            if word[start:end] in unigrams.scores:
                options.append((best[start][0] + unigrams.scores[word[start:end]], best[start][1] - 1))
        best.append(max(options))
    return -best[-1][1], best[-1][0]


@pytest.fixture(scope="module")
def unigrams():
    return piece_file(tokenizer_file("piece_bpe_32k.model"))


def test_trie_equals_plain_segmentation():
    random.seed(4)
    scores = {"".join(random.choices("abc", k=random.randint(1, 4))): -random.randint(1, 12) / 2 for _ in range(25)}
    model = Unigrams.of(scores)
    words = sorted({"".join(random.choices("abcd", k=random.randint(1, 9))) for _ in range(400)})
    tokens, logs = trie_counts(words, model)
    assert [(t, s) for t, s in zip(tokens, logs, strict=True)] == [plain(w, model) for w in words]


def test_documents(spark, unigrams):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    known = {}
    for r in count_tokens(spark.read.parquet(f"{SF}/documents.parquet"), unigrams).collect():
        words = docs[r.doc_id].split()
        for w in set(words) - known.keys():
            known[w] = plain(MARK + w, unigrams)
        assert (r.n_words, r.n_tokens) == (len(words), sum(known[w][0] for w in words))
        assert math.isclose(r.log_prob, sum(known[w][1] for w in words), rel_tol=1e-9)


def test_bounded_memory_gives_the_same(unigrams):
    texts = [f"word{i} and some{i % 7} more" for i in range(60)]
    small, large = Counter(unigrams, words=5), Counter(unigrams)
    assert [small.add_up([t])[0] for t in texts] == large.add_up(texts)


def test_edge_cases(spark, unigrams):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "日本 \U0001f9ff x"), (4, "日本 \U0001f9ff x"), (None, "the"), (5, "ab" * 50_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_tokens int")
    got = count_tokens(df, unigrams).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: tuple(r)[1:] for r in got}
    assert by_id[1] == by_id[2] == by_id[3] == (0, 0, 0.0) and by_id[None][:2] == (1, 1)
    assert by_id[4][:2] == (3, sum(plain(MARK + w, unigrams)[0] for w in rows[3][1].split()))
    assert count_tokens(df.limit(0), unigrams).collect() == []


def ways(word, unigrams):
    """All segmentations: (probability, pieces); the bytes of a character are one step without a piece."""
    if not word:
        yield 1.0, ()
        return
    for rest, pieces in ways(word[1:], unigrams):
        yield math.exp(len(word[0].encode()) * unigrams.byte_score) * rest, pieces
    for end in range(1, len(word) + 1):
        if word[:end] in unigrams.scores:
            for rest, pieces in ways(word[end:], unigrams):
                yield math.exp(unigrams.scores[word[:end]]) * rest, (word[:end], *pieces)


def test_sums_over_the_trie_are_those_of_all_segmentations():
    rng = random.Random(9)
    names = sorted({"".join(rng.choices("abc", k=rng.randint(1, 3))) for _ in range(14)})
    model = Unigrams({p: math.log(rng.random() / 9) for p in names}, -6.0, 3)
    words = sorted({"".join(rng.choices("abcé", k=rng.randint(1, 7))) for _ in range(60)})
    counts = [rng.randint(1, 9) for _ in words]
    expected, total = collections.Counter(), 0.0
    for word, n in zip(words, counts, strict=True):
        found = list(ways(word, model))
        whole = sum(p for p, _ in found)
        total += n * math.log(whole)
        for p, pieces in found:
            for piece in pieces:
                expected[piece] += n * p / whole
    logs = np.array([model.scores[p] for p in names])
    got, log = Lattice(words, {p: k for k, p in enumerate(names)}).expected(logs, model.byte_score, np.array(counts, float))
    assert math.isclose(log, total, rel_tol=1e-9)
    assert np.allclose(got, [expected[p] for p in names])


def test_fitted_probabilities():
    start = Unigrams.of({p: math.log(1 / 5) for p in ("a", "b", "ab", "ba", "zz")})
    words, counts = ["ab", "abab", "b"], [50, 20, 3]
    model = fitted(words, counts, start, tolerance=1e-9)
    assert math.isclose(sum(map(math.exp, model.scores.values())), 1.0)
    # Nearly all is "ab"; a fixed point gives itself; a piece that never occurs keeps the prior.
    logs = np.array(list(model.scores.values()))
    again, _ = Lattice(words, {p: k for k, p in enumerate(model.scores)}).expected(logs, model.byte_score, np.array(counts, float))
    assert np.allclose(np.log((again + PRIOR) / (again + PRIOR).sum()), logs, atol=0.05)
    assert max(model.scores, key=model.scores.get) == "ab" and math.exp(model.scores["zz"]) < 0.01
    assert fitted([], [], start) is start


def test_probabilities_from_all_documents(spark, unigrams):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    words = collections.Counter(MARK + w for r in docs.collect() for w in (r.text or "").split() if len(w) <= 64)
    model, other = estimate_unigrams(docs.repartition(5), unigrams, 10**6), estimate_unigrams(docs, unigrams, 500)
    plain_fit = fitted(sorted(words), [words[w] for w in sorted(words)], unigrams)
    assert model.scores.keys() == other.scores.keys() == unigrams.scores.keys()
    assert np.allclose(list(model.scores.values()), list(plain_fit.scores.values()))

    def log_prob(m):
        _, logs = trie_counts(sorted(words), m)
        return sum(s * words[w] for s, w in zip(logs, sorted(words), strict=True))

    # The estimate explains the documents better than the order of the file does, also one from a part of the words.
    assert log_prob(model) > log_prob(other) > log_prob(unigrams)
    assert estimate_unigrams(docs.limit(0), unigrams) is unigrams
    nothing = spark.createDataFrame([(1, None), (2, " ")], "doc_id long, text string")
    assert estimate_unigrams(nothing, unigrams) is unigrams


def test_parts_and_single_words_give_the_same_sums():
    rng = random.Random(5)
    names = sorted({"".join(rng.choices("abc", k=rng.randint(1, 4))) for _ in range(12)} | {"bé"})
    pieces, logs = Pieces(names), np.array([math.log(rng.random() / 9) for _ in names])
    words = sorted({"".join(rng.choices("abcdé日", k=rng.randint(1, 12))) for _ in range(80)})
    counts = np.array([rng.randint(1, 9) for _ in words], float)
    expected, total = Lattice(words, pieces).expected(logs, -6.0, counts)
    parts, rows = parts_of(words, pieces)
    assert ["".join(p for p, r in zip(parts, rows, strict=True) if r == k) for k in range(len(words))] == words
    assert len(parts) > 2 * len(words)
    alone = [expected_alone(w, pieces, logs, -6.0, n) for w, n in zip(words, counts, strict=True)]
    of_parts = [expected_alone(p, pieces, logs, -6.0, counts[r]) for p, r in zip(parts, rows, strict=True)]
    for found in (alone, of_parts):
        assert np.allclose(sum(e for e, _ in found), expected)
        assert math.isclose(sum(log for _, log in found), total, rel_tol=1e-9)
    assert parts_of([], pieces)[0] == [] and Lattice([], pieces).expected(logs, -6.0, np.zeros(0))[1] == 0


def test_probabilities_from_every_distinct_word(spark):
    rng = random.Random(8)
    start = Unigrams.of({p: -3.0 for p in (MARK, *"abcde", "ab", "bc", "cab", "ddd", MARK + "e", "eeee", "dé")})
    words = collections.Counter("".join(rng.choices("abcdeé", k=rng.randint(6, 9))) for _ in range(40_000))
    words.update({"e" * 90: 3000, "dab" * 200: 40})
    assert len(words) > 35_000
    tokens = [w for w, n in words.items() for _ in range(n)]
    rng.shuffle(tokens)
    rows = [(k, " ".join(tokens[k::300])) for k in range(300)]
    model = estimate_unigrams(spark.createDataFrame(rows, "doc_id long, text string"), start)
    plain_fit = fitted(sorted(MARK + w for w in words), [words[w] for w in sorted(words)], start)
    assert model.scores.keys() == plain_fit.scores.keys()
    assert np.allclose(list(model.scores.values()), list(plain_fit.scores.values()))


def test_best_ways_over_the_trie_are_those_of_single_words():
    rng = random.Random(6)
    scores = {"".join(rng.choices("abcé", k=rng.randint(1, 4))): -rng.randint(1, 12) / 2 for _ in range(25)}
    model = Unigrams.of(scores)
    words = sorted({"".join(rng.choices("abcdé日\U0001f9ff", k=rng.randint(1, 9))) for _ in range(400)})
    tokens, logs = Lattice(words, Pieces(scores)).best(np.array(list(scores.values())), model.byte_score)
    assert [*zip(tokens.tolist(), logs.tolist(), strict=True)] == [plain(w, model) for w in words]


def test_long_and_many_words_at_once(monkeypatch):
    model = Unigrams.of({p: -1.0 - k for k, p in enumerate((MARK, "a", "b", "ab", "bab", MARK + "ab"))})
    texts = ["ab" * 300 + " ba", "b " + "ba" * 200, " ".join("ab" * k + "c" for k in range(60))]
    monkeypatch.setattr("millrace.llm.token_counts.LATTICE_CHARS", 100)
    found = Counter(model).add_up(texts)
    for text, (n, tokens, log_prob) in zip(texts, found, strict=True):
        of_words = [plain(MARK + w, model) for w in text.split()]
        assert (n, tokens) == (len(of_words), sum(t for t, _ in of_words))
        assert math.isclose(log_prob, sum(s for _, s in of_words), rel_tol=1e-9)
