"""Near-duplicates against all pairs of sets, and the edge cases of the docstring."""

import random
import re

import numpy as np
import pytest

from millrace.llm.minhash import band_keys, near_duplicates, sketches
from millrace.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
FIELDS = "doc_id long, text string"


def brute_force(rows, percent=85, width=5):
    """{doc_id: (n_shingles, component)} by comparing all pairs; doc_ids are distinct."""
    sets = {}
    for doc_id, text in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
        grams = [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]
        sets[doc_id] = set(grams or ([tuple(words)] if words else []))
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {d: (len(sets[d]), root(d)) for d in ids}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = QUERIES["op7_minhash_near_dedup"](spark, SF)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert result(got) == brute_force(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.collect())


def test_dense_group_near_the_threshold(spark):
    """Copies of one text with up to four edits: most pairs are not similar, chains still connect."""
    random.seed(3)
    base = [f"w{random.randrange(10**6)}" for _ in range(150)]
    rows = []
    for doc_id in range(160):
        words = list(base)
        for _ in range(doc_id % 5):
            words[random.randrange(len(words))] = f"x{random.randrange(40)}"
        rows.append((doc_id, " ".join(words)))
    assert result(near_duplicates(spark.createDataFrame(rows, FIELDS))) == brute_force(rows)


def test_edge_cases(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (6, "two one"), (7, "É a b c d"), (8, "é a b c d"),
        (9, "word " * 50_000), (10, "word " * 60_000), (None, "one two"), (11, "a b c d e f"), (11, "a b c d e f"),
    ]
    got = near_duplicates(spark.createDataFrame([(*r, "x") for r in rows], FIELDS + ", component_id string")).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert [by_id[k].n_shingles for k in (1, 2, 3, 4, 9, 11)] == [0, 0, 0, 1, 1, 2]
    assert [by_id[k].component_id for k in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11)] == [1, 2, 3, 4, 4, 6, 7, 8, 9, 9, 11]
    assert by_id[None].component_id is None and by_id[None].kept and not by_id[5].kept


def test_repeated_ids_are_one_document(spark):
    rows = [(5, "a b c d e f"), (3, "a b c d e f"), (5, "u v w x y z"), (4, "u v w x y z")]
    got = near_duplicates(spark.createDataFrame(rows, FIELDS)).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(5, 3), (3, 3), (4, 3)}


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], FIELDS)).collect() == []


@pytest.mark.parametrize("size", [1, 2, 30, 5000])
def test_sketch_fills_every_place_and_estimates_similarity(size):
    random.seed(size)
    values = np.array([random.getrandbits(64) for _ in range(size * 2)], np.uint64)
    a, b = np.unique(values[: int(size * 1.5)]), np.unique(values[size // 2 :])
    s = sketches([a, b, a], 252)
    assert (s != np.iinfo(np.uint64).max).all() and (s[0] == s[2]).all()
    likeness = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((s[0] == s[1]).mean() - likeness) < 0.15
    assert (band_keys(s, 36, 7)[0] == band_keys(s, 36, 7)[2]).all()
