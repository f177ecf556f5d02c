"""Repeated runs of lines, found by prefix doubling over line ids; later copies are deleted.

The lines of all documents are one long sequence of ids. Prefix doubling ranks every position by
its first line, its first 2, 4, 8 ... lines: at each step the pairs (rank here, rank 2**k further
on) are sorted, and their order is the rank of twice the length. Positions that share a rank are
an interval of the suffix array whose longest common prefix has at least that length; positions
whose pair occurs once leave. Two overlapping ranks name a window of any other length.

A run counts as repeated when it has ``min_words`` words. Every line of such a run lies in a
shortest window of that many words that begins or ends inside the run, so these windows are all
that has to be compared, and doubling stops at their greatest length, at most ``min_words`` lines.
Overlapping and adjoining windows are then joined to the maximal runs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.frames import pick, written

MIN_WORDS = 50

_DOC = ["doc_id", "text_hash"]
#: A run of characters that are not white space: neither ASCII's nor Unicode's, as the no-break space.
_WORD = r"[^\s\x1C-\x1F\x85\p{Z}]+"


def _lines(documents: DataFrame) -> DataFrame:
    """The lines that are not blank: their place in the text and among themselves, words, and a 128-bit id."""
    texts = pick(documents, doc_id="long", text="string").where("doc_id IS NOT NULL AND text IS NOT NULL")
    numbered = F.transform(F.split("text", "\n"), lambda line, i: F.struct(i.alias("line_no"), line.alias("line")))
    rows = texts.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.posexplode(F.filter(numbered, lambda x: x["line"].rlike(_WORD))).alias("seq", "at"),
    )
    line = F.col("at.line")
    return rows.select(
        *_DOC,
        "seq",
        F.col("at.line_no").alias("line_no"),
        F.regexp_count(line, F.lit(_WORD)).alias("words"),
        F.xxhash64(line).alias("id_a"),
        F.xxhash64(F.lit(1), line).alias("id_b"),
    )


def _ranked(rows: DataFrame, keys: list[str], rank: str) -> DataFrame:
    """The keys that occur more than once, numbered in their order."""
    repeated = rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(*keys)
    return written(repeated.orderBy(*keys).withColumn(rank, F.monotonically_increasing_id()), "ranks")


def _repeated_lines(lines: DataFrame) -> DataFrame:
    """Lines with a copy, ranked, in unbroken stretches (``stretch``) of their document."""
    ids = _ranked(lines, ["id_a", "id_b"], "rank")
    rows = lines.join(ids, ["id_a", "id_b"]).select(*_DOC, "seq", "line_no", "words", "rank").distinct()
    in_order = Window.partitionBy(*_DOC).orderBy("seq")
    return rows.withColumn("stretch", F.col("seq") - F.row_number().over(in_order))


def _windows(rows: DataFrame, min_words: int) -> DataFrame:
    """Shortest windows with enough words that begin (or end) at each line: seq ``first`` to ``last``."""
    stretch = Window.partitionBy(*_DOC, "stretch")
    counted = rows.withColumn("upto", F.sum("words").over(stretch.orderBy("seq")))
    counted = counted.withColumn("before", F.col("upto") - F.col("words"))
    # Each line has a word at least, so a frame of so many words holds no more lines than words.
    ahead = stretch.orderBy("before").rangeBetween(0, min_words - 1)
    back = stretch.orderBy("upto").rangeBetween(1 - min_words, 0)
    far = (
        counted.withColumn("last", F.max("seq").over(ahead))
        .withColumn("last_upto", F.max("upto").over(ahead))
        .withColumn("first", F.min("seq").over(back))
        .withColumn("first_before", F.min("before").over(back))
    )
    forward = far.where(F.col("last_upto") - F.col("before") >= min_words)
    backward = far.where(F.col("upto") - F.col("first_before") >= min_words)
    columns = [*_DOC, "first", "last"]
    both = forward.select(*_DOC, F.col("seq").alias("first"), "last").unionByName(
        backward.select(*_DOC, "first", F.col("seq").alias("last"))
    )
    lines = F.col("last") - F.col("first") + 1
    return both.distinct().select(*columns, F.floor(F.log2(lines) + 1e-9).cast("int").alias("level"))


def _doubled(rows: DataFrame, level: int) -> DataFrame:
    """Ranks of twice ``2 ** level`` lines, for the positions that share them with another."""
    stretch = Window.partitionBy(*_DOC, "stretch").orderBy("seq")
    step = 2**level
    # Positions that have left break a stretch, so the row that far ahead must be that far on.
    pairs = rows.withColumn("later", F.first(F.struct("seq", "rank")).over(stretch.rangeBetween(step, step)))
    pairs = pairs.where("later IS NOT NULL").select(
        *_DOC, "stretch", "seq", "rank", F.col("later.rank").alias("next_rank")
    )
    pairs = written(pairs, "pairs")
    ranks = _ranked(pairs, ["rank", "next_rank"], "joint")
    return pairs.join(ranks, ["rank", "next_rank"]).select(*_DOC, "stretch", "seq", F.col("joint").alias("rank"))


def _later_windows(windows: DataFrame, rows: DataFrame, level: int) -> DataFrame:
    """Windows of ``2 ** level`` to twice as many lines that have a copy further up."""
    own = windows.where(F.col("level") == level)
    ranks = rows.select(*_DOC, "seq", "rank")
    begin = ranks.select(*_DOC, F.col("seq").alias("first"), F.col("rank").alias("head"))
    end = ranks.select(*_DOC, (F.col("seq") + 2**level - 1).alias("last"), F.col("rank").alias("tail"))
    named = own.join(begin, [*_DOC, "first"]).join(end, [*_DOC, "last"])
    named = named.withColumn("lines", F.col("last") - F.col("first")).withColumn("place", F.struct(*_DOC, "first"))
    named = written(named, "windows")
    keys = ["head", "tail", "lines"]
    original = named.groupBy(*keys).agg(F.min("place").alias("original"), F.count("*").alias("n")).where("n > 1")
    # Written first, so that the join finds two shuffled sides and can split a run with very many copies.
    original = written(original.select(*keys, "original"), "originals")
    later = named.join(original, keys).where("place > original")
    return later.select(*_DOC, "first", "last")


def repeated_runs(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Runs of lines that an earlier place holds too: doc_id, text_hash, first_line, last_line.

    Earlier means a smaller doc_id, or further up in the same document (a copy may overlap its
    original). Lines count from 0 and are equal when all their characters are; words are the
    runs of characters other than white space; lines without one are blank, which are passed over but belong to a run that goes on behind them. A
    run lies within one document. Rows with equal doc_id and text are one document; of different
    texts with one doc_id, the one with the smaller hash is earlier. Rows without doc_id or text
    have no runs.
    """
    rows = written(_repeated_lines(written(_lines(documents), "lines")), "repeated")
    windows = written(_windows(rows, min_words), "spans")
    top = windows.agg(F.max("level")).first()[0]
    at = rows.select(*_DOC, "stretch", "seq", "rank")
    found = []
    for level in range((-1 if top is None else top) + 1):
        if level:
            at = written(_doubled(at, level - 1), "doubled")
        found.append(_later_windows(windows, at, level))
    if not found:
        found = [windows.select(*_DOC, "first", "last").limit(0)]
    later = reduce(DataFrame.unionByName, found)
    in_order = Window.partitionBy(*_DOC).orderBy("first", "last")
    reach = F.max("last").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    gap = F.when(F.coalesce(F.col("first") > reach + 1, F.lit(True)), 1).otherwise(0)
    runs = (
        later.withColumn("gap", gap)
        .withColumn("run", F.sum("gap").over(in_order))
        .groupBy(*_DOC, "run")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
    )
    place = rows.select(*_DOC, "seq", "line_no")
    begin = place.select(*_DOC, F.col("seq").alias("first"), F.col("line_no").alias("first_line"))
    end = place.select(*_DOC, F.col("seq").alias("last"), F.col("line_no").alias("last_line"))
    return runs.join(begin, [*_DOC, "first"]).join(end, [*_DOC, "last"]).select(*_DOC, "first_line", "last_line")


def dedup_lines(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows without later copies of repeated line runs, as (row, n_lines, n_removed, cleaned).

    ``row`` holds all columns as they came, so no name can clash; ``cleaned`` is the text that
    stays, empty if nothing does. A null text stays null, with 0 lines. Every row comes back.
    """
    runs = (
        repeated_runs(documents, min_words)
        .groupBy(*_DOC)
        .agg(F.collect_list(F.struct("first_line", "last_line")).alias("runs"))
    )
    rows = documents.select(F.struct("*").alias("row")).withColumns(
        {"doc_id": F.col("row.doc_id").cast("long"), "text_hash": F.xxhash64(F.col("row.text").cast("string"))}
    )
    text = F.col("row.text").cast("string")
    lines = F.split(text, "\n")
    kept = F.filter(
        lines, lambda _, i: ~F.exists("runs", lambda r: (r["first_line"] <= i) & (i <= r["last_line"]))
    )
    removed = F.aggregate("runs", F.lit(0), lambda n, r: n + r["last_line"] - r["first_line"] + 1)
    return rows.join(runs, _DOC, "left").select(
        "row",
        F.coalesce(F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1, F.lit(0))
        .cast("long")
        .alias("n_lines"),
        F.coalesce(removed, F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("runs").isNull(), text).otherwise(F.array_join(kept, "\n")).alias("cleaned"),
    )
