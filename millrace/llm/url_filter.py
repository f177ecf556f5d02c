"""URLs allowed or blocked: rules first, boosted trees over lexical features for the rest.

The trees learn from labelled URLs. Without a list of such, a URL is labelled by the rule that
decides it, else as bad if its host holds a word known from bad hosts in any form; URLs that nothing
speaks for or against are left out of the fit. Only what a URL looks like is an input, never which
host it is.
"""

from __future__ import annotations

import re
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.boosting import Forest, train
from millrace.llm.frames import map_batches, pick, written
from millrace.llm.words import text_chunks

SAMPLE_ROWS = 20_000
#: Host words that label a URL as bad for training.
BAD_WORDS = ("ads", "adserver", "bet", "casino", "farm", "pills", "porn", "spam", "track", "tracker", "win", "xxx")

FEATURES = [
    "length", "host_length", "path_length", "depth", "labels", "digit_ratio", "host_digit_ratio", "entropy",
    "host_entropy", "parameters", "hyphens", "host_hyphens", "escapes", "upper_ratio", "vowel_ratio", "longest_label",
    "fragment", "secure", "file_suffix", "suffix_share", "suffix_blocked",
]


def _entropy(counts: np.ndarray) -> float:
    share = counts[counts > 0] / counts.sum() if counts.sum() else np.zeros(0)
    return float(-(share * np.log2(share)).sum())


def features(urls: pa.Array, hosts: pa.Array, paths: pa.Array, share: pa.Array, blocked: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` for each URL; ``share`` and ``blocked`` are those of its host suffix."""
    counts = [np.zeros((0, 256), np.int64)]
    for column in (urls, hosts):
        for texts in text_chunks(column):
            for a, b in zip(texts.bounds[:-1], texts.bounds[1:], strict=True):
                counts.append(np.bincount(texts.data[a:b], minlength=256)[None])
    counts = np.concatenate(counts)
    n = len(urls)
    whole, host_counts = counts[:n], counts[n:]
    out = np.zeros((n, len(FEATURES)))
    of = lambda table, chars: table[:, [ord(c) for c in chars]].sum(axis=1)
    size, host_size = np.maximum(1, whole.sum(axis=1)), np.maximum(1, host_counts.sum(axis=1))
    names, roads, full = hosts.to_pylist(), paths.to_pylist(), urls.to_pylist()
    columns = {
        "length": whole.sum(axis=1),
        "host_length": host_counts.sum(axis=1),
        "path_length": [len(p) for p in roads],
        "depth": [p.count("/") for p in roads],
        "labels": [h.count(".") for h in names],
        "digit_ratio": of(whole, "0123456789") / size,
        "host_digit_ratio": of(host_counts, "0123456789") / host_size,
        "entropy": [_entropy(c) for c in whole],
        "host_entropy": [_entropy(c) for c in host_counts],
        "parameters": [(u or "").partition("?")[2].partition("#")[0].count("=") for u in full],
        "hyphens": of(whole, "-_"),
        "host_hyphens": of(host_counts, "-_"),
        "escapes": of(whole, "%"),
        "upper_ratio": of(whole, "ABCDEFGHIJKLMNOPQRSTUVWXYZ") / size,
        "vowel_ratio": of(host_counts, "aeiou") / host_size,
        "longest_label": [max(map(len, h.split("."))) for h in names],
        "fragment": of(whole, "#") > 0,
        "secure": [(u or "").startswith("https:") for u in full],
        "file_suffix": ["." in p.rpartition("/")[2] for p in roads],
        "suffix_share": share.to_numpy(zero_copy_only=False),
        "suffix_blocked": blocked.to_numpy(zero_copy_only=False),
    }
    for k, name in enumerate(FEATURES):
        out[:, k] = columns[name]
    return out


def _lower(column) -> F.Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, url, host and path; both are empty for a null url and one without ``://``."""
    rows = pick(pages, page_id="long", url="string")
    pattern = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    part = lambda k: F.coalesce(F.regexp_extract("url", pattern, k), F.lit(""))
    return rows.select("page_id", "url", _lower(part(1)).alias("host"), part(2).alias("path"))


def ruled(urls: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Adds rule and ruling: the longest of the short list ``rules`` of (verdict, host/path) that fits, else null."""
    rule, ruling = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, text in sorted(rules, key=lambda r: len(r[1])):
        host, _, path = text.partition("/")
        fits = (F.col("host") == host) | F.endswith("host", F.lit(f".{host}"))
        fits = fits & F.startswith("path", F.lit(f"/{path}"))
        rule, ruling = F.when(fits, text).otherwise(rule), F.when(fits, verdict).otherwise(ruling)
    return urls.withColumn("rule", rule).withColumn("ruling", ruling)


def _forms(word: str) -> str:
    """A pattern for a word, its singular and plural, and its form in -ing."""
    stem = re.escape(word[:-1] if word.endswith("s") and not word.endswith("ss") else word)
    return f"{stem}(?:e?s|{stem[-1]}?ing)?"


def labelled(urls: DataFrame, bad_words=BAD_WORDS) -> DataFrame:
    """Adds ``blocked``: 1 by a bad word or a block rule for whole hosts, 0 by an allow rule, null if both or nothing speak.

    A bad word counts in any form, as a part of the host between dots, hyphens, underscores or digits. A
    block rule for a path alone leaves no label, as it says nothing of how a bad URL looks.
    """
    forms = "|".join(_forms(w) for w in bad_words)
    bad = F.col("host").rlike(rf"(?:^|[.\-_0-9])(?:{forms})(?:$|[.\-_0-9:])") if bad_words else F.lit(False)
    blocked = (
        F.when((F.col("ruling") == "allow") & bad, None)
        .when(bad | (F.col("ruling") == "block") & F.col("rule").rlike("^[^/]*/?$"), 1)
        .when(F.col("ruling") == "allow", 0)
    )
    return urls.withColumn("blocked", blocked)


def suffix_shares(urls: DataFrame, seen: DataFrame) -> DataFrame:
    """suffix, suffix_share of all ``urls``, and suffix_blocked of all ``seen`` (blocked 1, 0 or null for unknown)."""
    suffix = F.substring_index("host", ".", -1).alias("suffix")
    both = (
        urls.select(suffix, F.lit(1).alias("n"), F.lit(0).alias("seen"), F.lit(0).alias("bad"))
        .unionByName(seen.select(suffix, F.lit(0).alias("n"), F.lit(1).alias("seen"), F.coalesce("blocked", F.lit(0)).alias("bad")))
        .groupBy("suffix")
        .agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"), F.sum("bad").alias("bad"))
    )
    counts = written(both, "suffixes")
    total = counts.agg(F.sum("n")).first()[0] or 1
    return counts.select(
        "suffix",
        (F.col("n") / total).alias("suffix_share"),
        ((F.col("bad") + 1) / (F.col("seen") + 2)).alias("suffix_blocked"),
    )


def _with_shares(urls: DataFrame, shares: DataFrame) -> DataFrame:
    """Adds suffix_share and suffix_blocked; a suffix that was never counted has 0.0 and 0.5."""
    joined = urls.withColumn("suffix", F.substring_index("host", ".", -1)).join(shares, "suffix", "left")
    return joined.withColumns(
        {
            "suffix_share": F.coalesce("suffix_share", F.lit(0.0)),
            "suffix_blocked": F.coalesce("suffix_blocked", F.lit(0.5)),
        }
    ).drop("suffix")


def train_urls(
    examples: DataFrame, shares: DataFrame, sample_rows: int = SAMPLE_ROWS, by_rules: bool = False
) -> Forest:
    """Trees from at most ``sample_rows`` distinct URLs (url, host, path, blocked), by hash order.

    Labels ``by_rules`` go by suffix as the rules do: one that no allow rule names has bad examples
    alone. Then the trees are not given the suffixes, or they would block all of such a suffix.
    """
    order = [F.xxhash64("url"), F.col("url"), F.col("blocked")]
    rows = examples.select("url", "host", "path", "blocked").distinct().orderBy(*order).limit(sample_rows)
    found = _with_shares(rows, shares).orderBy(*order).toArrow().combine_chunks()
    columns = ("url", "host", "path", "suffix_share", "suffix_blocked")
    x = features(*(found[c].combine_chunks() for c in columns))
    if by_rules:
        x[:, [FEATURES.index("suffix_share"), FEATURES.index("suffix_blocked")]] = 0
    return train(x, found["blocked"].to_numpy().astype(float), trees=60)


def _score_batch(batch: pa.RecordBatch, model) -> pa.RecordBatch:
    x = features(batch.column(1), batch.column(2), batch.column(3), batch.column(6), batch.column(7))
    scores = pa.array(model.value.scores(x))
    arrays = [batch.column(i) for i in (0, 2, 3, 4, 5)]
    return pa.RecordBatch.from_arrays([*arrays, scores], ["page_id", "host", "path", "rule", "ruling", "score"])


def judge_urls(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    examples: DataFrame | None = None,
    threshold: float = 0.5,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score (chance of a bad URL, by the trees).

    ``examples`` are labelled URLs (url, blocked); without them, those of ``labelled``. The verdict
    is that of the longest fitting rule, else ``block`` from ``threshold`` up. A null url and one
    without ``://`` have an empty host and path and are judged by the trees. Shares of host suffixes count all
    URLs, of pages and examples, and the blocked share all that have or could have a label. Repeated rows stay;
    other columns are left out; an empty table gives an empty result.
    """
    urls = ruled(parsed(pages), rules)
    every = urls.select("url", "host")
    if examples is None:
        known = labelled(urls)
    else:
        known = parsed(pick(examples, url="string", blocked="int").withColumn("page_id", F.col("blocked")))
        known = known.withColumnRenamed("page_id", "blocked").where("blocked IN (0, 1)")
        every = every.unionByName(known.select("url", "host"))
    known = known.where("url IS NOT NULL")
    shares = suffix_shares(every.where("url IS NOT NULL"), known)
    forest = train_urls(known.where("blocked IS NOT NULL"), shares, sample_rows, by_rules=examples is None)
    model = pages.sparkSession.sparkContext.broadcast(forest)
    fields = "page_id long, host string, path string, rule string, ruling string, score double"
    urls = _with_shares(urls, shares).select(
        "page_id", "url", "host", "path", "rule", "ruling", "suffix_share", "suffix_blocked"
    )
    scored = map_batches(urls, partial(_score_batch, model=model), fields)
    verdict = F.coalesce("ruling", F.when(F.col("score") >= threshold, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
