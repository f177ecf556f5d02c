"""Line runs against all pairs of places in plain Python, and edge cases."""

import random

import duckdb

from millrace.llm import sql
from millrace.llm.line_dedup import dedup_lines, repeated_runs

FIELDS = "doc_id long, text string"


def brute_force(docs, min_words):
    """{doc_id: text that stays}: every run with a copy at an earlier place goes, if it has enough words."""
    lines = {d: [(i, x) for i, x in enumerate((t or "").split("\n")) if x.split()] for d, t in docs}
    places = [(d, k) for d in sorted(lines) for k in range(len(lines[d]))]
    gone = {d: set() for d in lines}
    for n, (d, k) in enumerate(places):
        longest = 0
        for e, j in places[:n]:
            size = 0
            while k + size < len(lines[d]) and j + size < len(lines[e]) and lines[d][k + size][1] == lines[e][j + size][1]:
                size += 1
            longest = max(longest, size)
        if sum(len(x.split()) for _, x in lines[d][k : k + longest]) >= min_words:
            gone[d] |= set(range(k, k + longest))
    out = {}
    for d, text in docs:
        removed = {lines[d][k][0] for k in gone[d]}
        for a in sorted(gone[d]):
            if a + 1 in gone[d]:  # blank lines in between
                removed |= set(range(lines[d][a][0], lines[d][a + 1][0]))
        out[d] = None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in removed)
    return out


def cleaned(df, min_words):
    rows = dedup_lines(df, min_words).collect()
    for r in rows:
        before = 0 if r.row.text is None else r.row.text.count("\n") + 1
        assert r.n_lines == before
        if r.cleaned:
            assert r.n_removed == before - r.cleaned.count("\n") - 1
    return {r.row.doc_id: r.cleaned for r in rows}


def test_random_documents(spark):
    for seed in range(3):
        random.seed(seed)
        lines = ["", "a", "b  b", "c\tc\u00a0c", "  d d d d", "e e e e e e", "\t", "\u2003"]
        docs = [(d, "\n".join(random.choices(lines, k=random.randint(0, 25)))) for d in range(25)]
        docs += [(d + 100, docs[d][1] + "\nz z\n" + docs[d + 1][1]) for d in range(5)]
        random.shuffle(docs)
        min_words = (1, 4, 9)[seed]
        assert cleaned(spark.createDataFrame(docs, FIELDS), min_words) == brute_force(docs, min_words)


def test_sql_counts_the_same_words(spark):
    random.seed(8)
    lines = ["", "\t \u00a0", "a\u2003b " * 9, "c\tc  c\x1fc " * 7, "  " + "d\u00a0e " * 12, "f\x85g\x0bh " * 6]
    docs = [(d, "\n".join(random.choices(lines, k=random.randint(1, 14)))) for d in range(40)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    expected = {d: (removed, size) for d, _, removed, size, _ in con.execute(sql.OP4_LINE_DEDUP).fetchall()}
    got = {r.row.doc_id: (r.n_removed, len(r.cleaned)) for r in dedup_lines(spark.createDataFrame(docs, FIELDS)).collect()}
    assert got == expected and any(removed for removed, _ in got.values())


def test_runs_are_maximal_and_may_overlap_their_original(spark):
    docs = [(1, "x y\n" * 6 + "end"), (2, "q\nx y\nx y\nx y\nw")]
    got = {(r.doc_id, r.first_line, r.last_line) for r in repeated_runs(spark.createDataFrame(docs, FIELDS), 4).collect()}
    assert got == {(1, 1, 5), (2, 1, 3)}


def test_words_are_runs_of_other_than_white_space(spark):
    code = "\n".join(" " * 12 + f"return x{i}" for i in range(4))  # 8 words, 48 leading spaces
    table = "\n".join("a" + " " * 20 + f"{i}" for i in range(3))
    tabs = "\n".join("\t".join(f"t{i}x{k}" for k in range(30)) for i in range(2))
    hard = "\n".join("\u00a0".join(f"h{i}x{k}" for k in range(30)) for i in range(2))
    blank = " ".join(f"b{k}" for k in range(30)) + "\n\t\n\u00a0\n" + " ".join(f"c{k}" for k in range(30))
    shared = [code, table, tabs, hard, blank]
    docs = [(2 * i + k, f"{t}\nown {2 * i + k}") for i, t in enumerate(shared) for k in range(2)]
    got = {r.row.doc_id: (r.n_removed, r.cleaned) for r in dedup_lines(spark.createDataFrame(docs, FIELDS)).collect()}
    texts = dict(docs)
    assert all(got[d] == (0, texts[d]) for d in (0, 1, 2, 3, 4, 6, 8))
    assert got[5] == (2, "own 5") and got[7] == (2, "own 7") and got[9] == (4, "own 9")


def test_edge_cases(spark):
    long = "one two three\n" * 30_000
    rows = [
        (1, None), (2, ""), (3, "\n\n"), (4, "a b c\nd e f"), (4, "a b c\nd e f"), (None, "a b c\nd e f"), (5, "a b c\nd e f\n\ng"), (6, long),
    ]
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], FIELDS + ", n_removed long, cleaned string")
    got = dedup_lines(df, 5).collect()
    assert len(got) == len(rows)
    by_id = {r.row.doc_id: r for r in got}
    assert by_id[1].cleaned is None and by_id[1].n_lines == 0 and by_id[2].cleaned == "" and by_id[3].cleaned == "\n\n"
    assert by_id[4].cleaned == by_id[None].cleaned == "a b c\nd e f" and by_id[5].cleaned == "\ng"
    assert by_id[6].cleaned == "one two three\n" and by_id[6].n_removed == 29_999 and by_id[6].row.cleaned == "x"
    assert dedup_lines(df.limit(0), 5).collect() == []
