"""Hard negatives against all scores in plain Python, the matrix product, and the edge cases of the docstring."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import hard_negatives
from millrace.llm.hard_negatives import Heaps, inner_products, mine_hard_negatives, strassen
from millrace.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
FIELDS = "vec_id long, label int, embedding array<double>"


def brute_force(rows, divisor=100, positives=5, negatives=10, low=30, high=90):
    """Sorted result rows; every row is an anchor or candidate of its own."""
    used = []
    for vec_id, label, vector in rows:
        if None in (vec_id, label, vector) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        used.append((vec_id, label, [math.floor(256 * x) for x in vector]))
    out = []
    for anchor, label, vector in used:
        if anchor % divisor:
            continue
        scored = sorted((-sum(a * b for a, b in zip(vector, v)), i, o == label) for i, o, v in used)
        best = [(i, -s) for s, i, same in scored if same and i != anchor][:positives]
        for positive, p in best:
            found = [(i, -s) for s, i, same in scored if not same and low * p <= -100 * s <= high * p][:negatives]
            out += [(anchor, positive, k + 1, i, p, s) for k, (i, s) in enumerate(found)]
    return sorted(out)


def result(df):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert df.columns == names
    return sorted(tuple(r) for r in df.collect())


def mined(spark, rows, fields=FIELDS, **options):
    return result(mine_hard_negatives(spark.createDataFrame(rows, fields), "vec_id % 100 = 0", **options))


def test_the_query(spark):
    rows = []
    for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect():
        label = (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label
        rows.append((r.vec_id, label, r.embedding))
    got = result(QUERIES["op11_hard_negatives"](spark, SF))
    assert got and got == brute_force(rows)


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 70), st.integers(1, 70), st.integers(1, 70), st.integers(0, 2**32), st.sampled_from([3, 1 << 12, 1 << 27]))
def test_product_is_exact(m, k, n, seed, most):
    random = np.random.default_rng(seed)
    a, b = random.integers(-most, most, (m, k)), random.integers(-most, most, (k, n))
    exact = np.array(a.astype(object) @ b.astype(object), dtype=object)
    assert (strassen(a, b, leaf=4).astype(object) == exact).all()


def test_heaps_merge_to_the_same_as_one():
    random = np.random.default_rng(5)
    keys, scores, ids = random.integers(0, 9, 900), random.integers(0, 40, 900), random.integers(0, 300, 900)
    one, many = Heaps(9, 7), Heaps(9, 7)
    one.merge(keys, scores, ids)
    for part in np.array_split(np.arange(900), 13):
        many.merge(keys[part], scores[part], ids[part])
    assert all((getattr(one, x) == getattr(many, x)).all() for x in ("keys", "scores", "ids"))
    assert one.scores[:7].tolist() == sorted(scores[keys == 0].tolist(), reverse=True)[:7]


def test_small_tiles_hot_label_ties_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "TILE_ROWS", 16)
    monkeypatch.setattr(hard_negatives, "ANCHOR_ROWS", 3)
    draw = random.Random(11)
    rows = []
    for i in range(0, 1800, 3):
        label = 0 if draw.random() < 0.4 else draw.randrange(40)
        rows.append((i, label, [draw.randrange(-3, 9) / 4 for _ in range(draw.choice([5, 5, 5, 3]))]))
    rows += rows[10:40] + [rows[0], rows[100], rows[100]]
    got = mined(spark, rows)
    assert got and got == brute_force(rows)


def test_rows_that_take_no_part(spark):
    sound = [(100, 1, [1.0, 0.5]), (1, 1, [1.0, 0.25]), (2, 2, [0.5, 0.25]), (3, 2, [0.5, 0.0])]
    bad = [
        (None, 2, [0.5, 0.25]),
        (200, None, [1.0, 1.0]),
        (300, 1, None),
        (4, 2, [0.5, None]),
        (5, 2, [float("nan"), 0.5]),
        (6, 2, [float("inf"), 0.5]),
        (7, 2, []),
    ]
    assert mined(spark, sound + bad) == brute_force(sound) != []


def test_long_vectors_and_extra_columns(spark):
    draw = random.Random(2)
    rows = [(i * 50, i % 3, [draw.random() * (1 + i % 4) for _ in range(9000)], "x", 1.5) for i in range(9)]
    fields = FIELDS + ", tile string, score double"
    assert mined(spark, rows, fields) == brute_force([r[:3] for r in rows]) != []


def test_large_components_and_overflow(spark):
    rows = [(100, 1, [3e5, 1e5]), (1, 1, [2e5, -1e5]), (2, 2, [1e5, 0.0]), (3, 2, [1.0, 1.0])]
    assert mined(spark, rows) == brute_force(rows) != []
    with pytest.raises(OverflowError):
        inner_products(np.array([[1 << 40]]), np.array([[1 << 40]]))


def test_negative_scores_have_no_window(spark):
    rows = [(100, 1, [1.0]), (1, 1, [-1.0]), (2, 2, [-0.5]), (200, 3, [0.0]), (3, 3, [0.0]), (4, 2, [1.0])]
    assert mined(spark, rows) == brute_force(rows)


def test_empty_tables(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [1.0]), (2, 2, [1.0])]) == []
    assert mined(spark, [(100, 1, [1.0]), (2, 2, [1.0])]) == []
