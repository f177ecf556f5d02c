"""Fingerprints of all neighbours against plain Python, located edits, edge cases."""

import random
import re
from collections import Counter
from hashlib import blake2b, sha256

from millrace.llm.fingerprints import KEPT, differing_paragraphs, edited, fingerprint_documents, likeness, merkle_tree

SF = "/root/testdata/sf0.001"
FIELDS = "doc_id long, text string"


def plain_leaves(text):
    """Sentences in parts of 32 characters, with the stops behind them."""
    return Counter(p for line in text.split("\n") for p in re.findall(r"[^.!?]{1,32}[.!?]*|[.!?]+", line))


def plain_fingerprint(text):
    """The tree hashed level by level, written down without the operator."""

    def digest(level, data):
        return blake2b(data, digest_size=16, person=level).digest()

    sections, members = [], []
    lines = text.split("\n") if text else []
    for n, line in enumerate(lines):
        parts = list(plain_leaves(line).elements()) and re.findall(r"[^.!?]{1,32}[.!?]*|[.!?]+", line)
        own = digest(b"paragraph", b"".join(digest(b"part", p.encode()) for p in parts))
        members.append(own)
        if not parts or own[0] < 32 or n == len(lines) - 1:
            sections.append(digest(b"section", b"".join(members)))
            members = []
    kept = set()
    for part, n in plain_leaves(text).items():
        h = digest(b"part", part.encode())
        kept |= {h} | {digest(b"again", h + k.to_bytes(8, "little")) for k in range(1, n)}
    sketch = sorted({h[:4] for h in kept})[:64]
    return digest(b"document", b"".join(sections)) + len(sections).to_bytes(4, "little") + b"".join(
        [h[:4] for h in sections] + sketch
    )


def plain_likeness(a, b):
    """Common over all leaves, each as often as it occurs."""
    one, other = plain_leaves(a), plain_leaves(b)
    return 1.0 if a == b else (one & other).total() / max(1, (one | other).total())


def sampled(a, b):
    """The likeness of two printed fingerprints, from their last numbers."""
    if a[:32] == b[:32]:
        return 1.0
    sets = [{x[k : k + 8] for k in range(40 + 8 * int.from_bytes(bytes.fromhex(x[32:40]), "little"), len(x), 8)} for x in (a, b)]
    both = sorted(sets[0] | sets[1])[:64]
    return len([h for h in both if h in sets[0] & sets[1]]) / len(both) if both else 0.0


def plain_differing(a, b):
    """Paragraphs of a that b does not have, if no section of several holds them."""
    known = set(b.split("\n"))
    return [k for k, line in enumerate(a.split("\n")) if line not in known] if a else []


def expected(docs):
    docs = sorted(docs)
    out = {}
    for k, (d, text) in enumerate(docs):
        following = docs[(k + 1) % len(docs)][1]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        prints = [plain_fingerprint(t).hex() for t in (text, changed, following)]
        away = plain_differing(text, changed)
        out[d] = (
            len(text), sha256(changed.encode()).hexdigest(), prints[0], prints[1], sampled(prints[0], prints[1]),
            sampled(prints[0], prints[2]), len(text.split("\n")) if text else 0, len(away), away[0] if away else None,
        )
    return out


def result(df):
    rows = fingerprint_documents(df).collect()
    assert len({r.doc_id for r in rows}) == len(rows)
    return {r.doc_id: tuple(r)[1:] for r in rows}


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = result(docs.repartition(7))
    assert got == expected([(r.doc_id, r.text) for r in docs.collect()])
    assert all(0.1 < r[4] <= 1 for r in got.values() if r[0] > 200)
    assert len({r[2] for r in got.values()}) == docs.select("text").distinct().count()


def test_trees_locate_edits():
    lines = [f"paragraph {i} has words. And more {i * 7} of them." for i in range(60)]
    a = merkle_tree("\n".join(lines))
    changed = list(lines)
    changed[17] += " Edited."
    assert differing_paragraphs(a, merkle_tree("\n".join(changed))) == ([17], [17])
    longer = lines[:30] + ["an inserted one."] + lines[30:]
    assert differing_paragraphs(a, merkle_tree("\n".join(longer))) == ([], [30])
    assert differing_paragraphs(a, a) == ([], []) and likeness(a.fingerprint, a.fingerprint) == 1
    assert 0.9 < likeness(a.fingerprint, merkle_tree("\n".join(changed)).fingerprint) <= 1
    # Only a line end goes: the roots differ.
    b = merkle_tree("\n".join(lines).replace("\n", " ", 1))
    assert b.root != a.root


def test_edge_cases(spark):
    assert edited("abcde", "XYZ") == "abcXY" and edited("abcdef", "X") == "abcX" and edited("", "X") == ""
    rows = [(3, None), (1, ""), (2, "é" * 40_001), (7, "last. one"), (5, "x\n\n\ny")]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], FIELDS + ", n_chars double")
    got = result(df)
    assert got == expected([(d, t or "") for d, t in rows]) and got[3][4:6] == (1.0, 0.0)
    one = result(spark.createDataFrame([(9, "only")], FIELDS))
    assert one[9][0] == 4 and one[9][5] == 1.0
    twice = fingerprint_documents(spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "n")], FIELDS)).collect()
    assert len(twice) == 4 and sum(r.near_next == 1.0 for r in twice) == 1
    assert fingerprint_documents(df.limit(0)).collect() == []


def test_likeness_comes_near_that_of_all_leaves(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rng, errors = random.Random(2), []
    for a, b in [(k, rng.choice(list(docs))) for k in docs]:
        text = edited(docs[a], docs[b])
        got, exact = (f(docs[a], text) for f in (lambda x, y: likeness(*(merkle_tree(t).fingerprint for t in (x, y))), plain_likeness))
        if (plain_leaves(docs[a]) | plain_leaves(text)).total() <= KEPT:
            assert abs(got - exact) < 1e-9
        errors.append(got - exact)
    assert max(map(abs, errors)) < 0.25 and abs(sum(errors) / len(errors)) < 0.02
