"""License texts in documents: phrases, and an exact set-similarity join with templates.

The blocks of a template are windows of words twice as long as it, overlapping by half. A block
meets the template when it has enough of its distinct words. The words of all templates are ordered
from the globally rarest on. A text with such a block shares one of the first ``size - needed + 1``
words of the template (prefix filter), has at least ``needed`` words of templates at all (length
filter), and behind the first shared word both have enough words left (positional filter). The join
on prefix words alone names the templates whose blocks of a text are then verified on the full sets.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import pick, written

CONTAINMENT = 0.8

_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text) -> F.Column:
    """Runs of letters, digits and characters beyond ASCII; A-Z in lower case."""
    parts = F.split(F.translate(text, _UPPER, _LOWER), _SEPARATORS)
    return F.coalesce(F.array_remove(parts, ""), F.array().cast("array<string>"))


def _words_of(text: str) -> list[str]:
    low = text.translate(str.maketrans(_UPPER, _LOWER))
    return [w for w in re.split(_SEPARATORS, low) if w]


def _texts(values) -> F.Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _places(column: str, phrase: str) -> F.Column:
    """Where the words of the phrase stand one after another; none without a look if the last word is missing."""
    parts = _words_of(phrase)
    met = lambda i: reduce(
        lambda a, b: a & b, [F.coalesce(F.get(column, i + k) == p, F.lit(False)) for k, p in enumerate(parts)]
    )
    places = F.filter(F.transform(column, lambda _, i: i), met)
    has_all = reduce(lambda a, b: a & b, [F.array_contains(column, p) for p in parts])
    return F.when(has_all, places).otherwise(F.array().cast("array<int>"))


def _prefixes(order: list[str], known: list[tuple[int, int, list[str], int]]) -> list[tuple]:
    """(template, token, place, n_tokens, needed) of the words that one of which every matching text has."""
    place_of = {t: k for k, t in enumerate(order)}
    out = []
    for number, _, tokens, needed in known:
        ordered = sorted(tokens, key=place_of.__getitem__)
        out += [(number, t, place, len(tokens), needed) for place, t in enumerate(ordered[: len(tokens) - needed + 1])]
    return out


def _candidates(scanned: DataFrame, order: list[str], prefix: DataFrame, least: int) -> DataFrame:
    """text_hash and template of the pairs that the prefix, length and positional filters leave.

    The overlap of a pair is at most what both have from their first common word on, so the row of
    that word stays whenever the pair can match.
    """
    ordered = F.array_intersect(_texts(order), F.col("tokens"))
    tokens = scanned.where(F.size("tokens") >= least).select(
        "text_hash", F.size("tokens").alias("n"), F.posexplode(ordered).alias("at", "token")
    )
    left = F.least(F.col("n_tokens") - F.col("place"), F.col("n") - F.col("at"))
    pairs = tokens.join(F.broadcast(prefix), "token").where((F.col("n") >= F.col("needed")) & (left >= F.col("needed")))
    return pairs.select("text_hash", "template").distinct()


def scan_licenses(
    documents: DataFrame,
    phrases: list[tuple[str, str]],
    templates: list[tuple[str, str]],
    containment: float = CONTAINMENT,
) -> DataFrame:
    """One row per document with what it says about licenses.

    ``phrases`` are (phrase, label), ``templates`` (label, text); both are short lists. Columns:
    doc_id, n_words, n_base (all places of the phrases), first_word and last_word (smallest and
    largest start of one, words from 0, else null), base_labels (of the phrases), labels (of phrases
    and templates; both distinct, sorted, comma-joined, empty if none) and score: 1 with a base
    label, else the best containment of a met template, else 0. Null and empty texts have no words.
    Rows with equal text have equal results, with and without doc_id; other columns are left out; an empty table
    gives an empty result.
    """
    spark = documents.sparkSession
    sets = [(label, len(_words_of(text)), sorted(set(_words_of(text)))) for label, text in templates]
    known = [(k, size, tokens, math.ceil(containment * len(tokens) - 1e-9)) for k, (_, size, tokens) in enumerate(sets) if tokens]
    vocabulary = sorted({t for _, _, tokens, _ in known for t in tokens})
    texts = pick(documents, doc_id="long", text="string").select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    rows = texts.select("doc_id", "text_hash", words(F.col("text")).alias("words"))
    scanned = written(
        rows.select(
            "doc_id",
            "text_hash",
            F.size("words").cast("long").alias("n_words"),
            F.array(*[_places("words", p) for p, _ in phrases]).alias("places"),
            F.array_intersect("words", _texts(vocabulary)).alias("tokens"),
        ),
        "licenses",
    )
    counts = scanned.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    counts = {r.token: r.n for r in counts.collect()}  # no more rows than the templates have words
    order = sorted(vocabulary, key=lambda t: (counts.get(t, 0), t))
    first = _prefixes(order, known)
    prefix = spark.createDataFrame(first, "template int, token string, place int, n_tokens int, needed int")
    whole = spark.createDataFrame(known, "template int, size int, template_tokens array<string>, needed int")
    least = min([n for *_, n in known], default=1)
    pairs = written(_candidates(scanned, order, prefix, least), "license_pairs")
    # Only texts with a word of a prefix move, and each of them once.
    hopeful = texts.select("text_hash", words(F.col("text")).alias("words")).where(
        F.arrays_overlap("words", _texts(sorted({t for _, t, *_ in first})))
    )
    starts = F.sequence(
        F.lit(0), F.greatest(F.lit(0), F.ceil(F.size("words") / F.col("size")).cast("int") - 2) * F.col("size"), F.col("size")
    )
    common = F.transform(
        starts,
        lambda s: F.size(F.array_intersect(F.slice("words", s + 1, 2 * F.col("size")), F.col("template_tokens"))),
    )
    met = (
        hopeful.join(pairs.select("text_hash").distinct(), "text_hash", "left_semi")
        .dropDuplicates(["text_hash"])
        .join(pairs, "text_hash")
        .join(F.broadcast(whole), "template")
        .withColumn("common", F.array_max(common))
        .where("common >= needed")
        .select("text_hash", "template", (F.col("common") / F.size("template_tokens")).alias("containment"))
    )
    names = F.create_map(*[x for k, (label, *_) in enumerate(sets) for x in (F.lit(k), F.lit(label))]) if sets else None
    found = met.groupBy("text_hash").agg(
        F.collect_set(F.element_at(names, F.col("template")) if sets else F.lit("")).alias("template_labels"),
        F.max("containment").alias("containment"),
    )
    # Written first, so that the join is sized by what was found and can split a text with very many copies.
    found = written(found, "found")
    base = F.filter(
        F.array(*[F.when(F.size(F.get("places", F.lit(k))) > 0, label) for k, (_, label) in enumerate(phrases)]).cast(
            "array<string>"
        ),
        lambda x: x.isNotNull(),
    )
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    every = F.flatten("places")
    return (
        scanned.join(found, "text_hash", "left")
        .withColumn("base", base)
        .select(
            "doc_id",
            "n_words",
            F.size(every).cast("long").alias("n_base"),
            F.array_min(every).cast("long").alias("first_word"),
            F.array_max(every).cast("long").alias("last_word"),
            joined("base").alias("base_labels"),
            joined(F.concat("base", F.coalesce("template_labels", F.array().cast("array<string>")))).alias("labels"),
            F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
        )
    )
