"""License statements against plain Python over all blocks and templates, and edge cases."""

import math
import random
import re

from millrace.llm.license_scan import _candidates, _prefixes, scan_licenses
from millrace.llm.license_texts import PHRASES, TEMPLATES

FIELDS = "doc_id long, text string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_force(text, templates=TEMPLATES, containment=0.8):
    w = words(text)
    places = {label: [i for i in range(len(w)) if w[i : i + len(p.split())] == p.split()] for p, label in PHRASES}
    every = [i for own in places.values() for i in own]
    base = {label for label, own in places.items() if own}
    found, best = set(), 0.0
    for label, t in templates:
        size, tokens = len(words(t)), set(words(t))
        for s in range(0, max(1, len(w)), size):
            block = set(w[s : s + 2 * size])
            if len(block & tokens) >= math.ceil(containment * len(tokens) - 1e-9):
                found.add(label)
                best = max(best, len(block & tokens) / len(tokens))
    return (
        len(w), len(every), min(every, default=None), max(every, default=None), ",".join(sorted(base)),
        ",".join(sorted(base | found)), 1.0 if base else best,
    )


def result(df, templates=TEMPLATES):
    rows = scan_licenses(df, PHRASES, templates).collect()
    return {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) for r in rows}


def test_statements_in_noise(spark):
    random.seed(5)
    vocabulary = [w for _, t in TEMPLATES for w in t.split()] + ["lorem", "ipsum", "dolor"] * 20
    docs = []
    for d in range(120):
        parts = random.choices(vocabulary, k=random.randint(0, 90))
        statement = random.choice(TEMPLATES)[1].split()
        for _ in range(d % 4):
            statement[random.randrange(len(statement))] = "zzz"
        at = random.randint(0, len(parts))
        docs.append((d, " ".join(parts[:at] + statement + parts[at:] + ["MIT", "License"] * (d % 5 == 0))))
    assert result(spark.createDataFrame(docs, FIELDS)) == {d: brute_force(t) for d, t in docs}


def test_the_filters_leave_few_pairs_and_lose_none(spark):
    """Random sets over few words, at several thresholds; a text without a rare word of a template is not verified."""
    rng = random.Random(6)
    pool = [f"w{k}" for k in range(30)]
    templates = [(f"t{k}", " ".join(rng.sample(pool, rng.randint(3, 12)))) for k in range(12)]
    docs = [(d, " ".join(rng.choices(pool[: rng.choice([8, 20, 30])], k=rng.randint(0, 60)))) for d in range(150)]
    df = spark.createDataFrame(docs, FIELDS)
    for share in (0.5, 0.8, 1.0):
        got = {r.doc_id: (r.labels, r.score) for r in scan_licenses(df, PHRASES, templates, share).collect()}
        assert got == {d: brute_force(t, templates, share)[5:] for d, t in docs}

    known = [(0, 5, ["a", "b", "c", "d", "e"], 4)]
    order = ["a", "b", "c", "d", "e", "f"]  # from the rarest on
    prefix = spark.createDataFrame(_prefixes(order, known), "template int, token string, place int, n_tokens int, needed int")
    assert {(r.token, r.place) for r in prefix.collect()} == {("a", 0), ("b", 1)}
    texts = [(1, list("bcde")), (2, list("cdef")), (3, list("abc")), (4, list("abcdf")), (5, list("acdf"))]
    scanned = spark.createDataFrame(texts, "text_hash long, tokens array<string>")
    left = {r.text_hash for r in _candidates(scanned, order, prefix, 4).collect()}
    assert left == {1, 4, 5}  # 2 has no word of the prefix, 3 too few words; 5 is left to the verification


def test_edge_cases(spark):
    rows = [
        (1, None), (2, ""), (3, "?! -"), (4, "MIT license mit-LICENSE, Apache  License"), (4, "MIT license mit-LICENSE, Apache  License"),
        (5, "mit licenseé"), (6, "x " * 300_000 + "the GNU General\nPublic License"), (7, "Licensed under CC BY-NC 4.0."),
    ]
    df = spark.createDataFrame([(*r, "y") for r in rows], FIELDS + ", labels string")
    assert result(df) == {d: brute_force(t) for d, t in rows}
    assert scan_licenses(df, PHRASES, TEMPLATES).count() == len(rows)
    assert result(df)[4] == (6, 3, 0, 4, "apache,mit", "apache,mit", 1.0) and result(df)[7][5:] == ("cc-by-nc", 1.0)
    null_id = spark.createDataFrame([(None, "mit license")], FIELDS)
    assert result(null_id)[None][4] == "mit"
    assert result(df.limit(0)) == {}


def test_rows_without_doc_id_have_the_labels_of_templates(spark):
    label, text = TEMPLATES[0]
    rows = [(1, text), (None, text), (None, "nothing"), (None, TEMPLATES[1][1])]
    got = scan_licenses(spark.createDataFrame(rows, FIELDS), PHRASES, TEMPLATES).collect()
    assert sorted((r.doc_id or 0, r.labels, r.score) for r in got) == sorted((d or 0, *brute_force(t)[5:]) for d, t in rows)
    assert sum(label in r.labels.split(",") for r in got) == 2
