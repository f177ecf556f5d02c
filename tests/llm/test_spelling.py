"""Spelling variants against all pairs in plain Python, the index, and the edge cases of the docstrings."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import spelling
from millrace.llm.queries import QUERIES
from millrace.llm.spelling import Index, group_variants, near_words, spelling_variants

SF = "/root/testdata/sf0.001"
COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def one_edit(a, b):
    """Whether exactly one inserted, deleted or replaced letter leads from a to b."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def words_of(rows, least_length=7, least_count=2):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= least_length and n >= least_count}


def variants(counts, ratio=10):
    """Expected rows by deleting each letter of every word; words that share a rest are compared."""
    rests = {}
    for w in counts:
        for i in range(len(w)):
            rests.setdefault(w[:i] + w[i + 1 :], set()).add(w)
    near = {w: set() for w in counts}
    for rest, own in rests.items():
        for a in own | ({rest} & counts.keys()):
            near[a] |= {b for b in own | ({rest} & counts.keys()) if one_edit(a, b)}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return sorted(out)


def result(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


def grouped(spark, counts):
    return result(group_variants(spark.createDataFrame(list(counts.items()), "word string, n long")))


def test_the_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = result(QUERIES["op13_spelling_variants"](spark, SF))
    assert got == variants(words_of(rows))
    assert sum(r[4] > 0 for r in got) > 100


def all_near(words, patterns):
    index, out = Index(words), set()
    for left_half in (True, False):
        for p, w in zip(*(x.tolist() for x in index.near(patterns, left_half)), strict=True):
            half = len(patterns[p]) // 2
            same = words[w].startswith(patterns[p][:half]) if left_half else words[w].endswith(patterns[p][half:])
            assert same and one_edit(patterns[p], words[w])
            out.add((patterns[p], words[w]))
    return out


@settings(max_examples=150, deadline=None)
@given(st.sets(st.text("abé", min_size=2, max_size=7), min_size=1, max_size=60), st.sets(st.text("abcé", min_size=2, max_size=8), min_size=1, max_size=20))
def test_search_finds_all_and_only_near_words(words, others):
    words, patterns = sorted(words), sorted(words | others)
    assert all_near(words, patterns) == {(a, b) for a in patterns for b in words if one_edit(a, b)}


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("abc", min_size=1, max_size=6), min_size=1, max_size=30), st.text("abcd", min_size=1, max_size=4))
def test_intervals_stay_in_step(words, part):
    index = Index(sorted(words))
    text = "$" + "$".join(sorted(words)) + "$"
    count = sum(text.startswith(part, i) for i in range(len(text)))
    codes = index.codes(part)
    middle = len(codes) // 2
    state = np.array([[0], [0], [index.size]])
    for c in codes[middle:]:
        state = index.step(state, np.array([c]), True) if state[2, 0] else state
    for c in codes[:middle][::-1]:
        state = index.step(state, np.array([c]), False) if state[2, 0] else state
    assert state[2, 0] == count
    if count:
        starts = index.order[state[0, 0] : state[0, 0] + count]
        assert sorted(starts.tolist()) == [i for i in range(len(text)) if text.startswith(part, i)]


def test_crowded_halves_are_split(spark):
    draw = random.Random(4)
    words = {"aaab" + "".join(draw.choices("abcd", k=draw.randint(3, 5))) for _ in range(700)}
    rows = spark.createDataFrame([(i, w, 2) for i, w in enumerate(sorted(words))], "id long, word string, n long")
    got = [(r.id, r.near) for r in near_words(rows, shard_words=50).collect()]
    ids = {w: i for i, w in enumerate(sorted(words))}
    expected = {(ids[a], b) for a in words for b in words if one_edit(a, b)}
    assert len(got) == len(set(got)) and set(got) == expected


def test_chains_of_forms_and_ties(spark):
    counts = {"abcdefg": 2, "abcdefgh": 20, "abcdefghi": 200, "abcdefghij": 2000, "abcdefghijk": 20000, "xbcdefg": 20}
    counts |= {"zzzzzzza": 5, "zzzzzzzb": 50, "zzzzzzzc": 50, "alonealone": 3, "éèéèéèé": 30, "éèéèéè×é": 2}
    got = grouped(spark, counts)
    assert got == variants(counts)
    rows = {r[0]: r for r in got}
    assert rows["abcdefg"][2] == "abcdefghijk" and rows["zzzzzzza"][1] == "zzzzzzzb"


def test_long_words(spark):
    base = "ab" * 2000
    counts = {base: 100, base + "a": 2, base[:1000] + "c" + base[1001:]: 3, "a" * 3000: 5, "a" * 3001: 60}
    assert grouped(spark, counts) == variants(counts)


def test_texts_longer_than_a_part(spark, monkeypatch):
    monkeypatch.setattr(spelling, "PART", 16)
    draw = random.Random(9)
    rows = [(i, "".join(draw.choice(["abcdefg", "hijklmnop", " ", ", ", "é", "7"]) for _ in range(60))) for i in range(25)]
    rows += [(90, "x" * 50 + " " + "y" * 40), (90, "x" * 50 + " " + "y" * 40), (91, "a" * 16 + " " + "b" * 15 + " " + "c" * 32)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(spelling_variants(docs)) == variants(words_of(rows))


def test_nulls_repeated_rows_extra_columns_and_empty_tables(spark):
    rows = [(None, "Lettering LETTERING lettering"), (1, None), (2, ""), (3, "letterin"), (3, "letterin"), (4, "ÀÉÎõüßy àéîõüßy ÀÉÎõüßy")]
    docs = spark.createDataFrame([(*r, "x", 7, 8) for r in rows], "doc_id long, text string, word string, n int, id int")
    got = result(spelling_variants(docs))
    assert got == variants(words_of(rows)) and [r[0] for r in got] == ["letterin", "lettering", "ÀÉÎõüßy"]
    assert result(spelling_variants(docs.limit(0))) == []


@pytest.mark.parametrize("counts", [{"onlyone": 2}, {"samelen": 3, "samelem": 30}])
def test_few_words(spark, counts):
    assert grouped(spark, counts) == variants(counts)
