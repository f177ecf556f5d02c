"""Near-duplicate documents: fast similarity sketches, banding, exact verification.

A document's set is its distinct word shingles. The sketch fills ``bins`` places in rounds: in
each round every element falls into one hashed bin with a hashed value, and lower rounds win, so
small and large sets fill every place after few rounds; after ``bins`` rounds the elements are put
into the still empty bins one by one, so that no place stays empty. The share of equal places
estimates the Jaccard similarity with the concentration of fully random sampling.

Equal bands of the sketch make buckets. A bucket is never expanded into all its pairs:

1. Documents with equal sets are one class, and only its smallest doc_id goes on.
2. Each bucket compares its members with one member, the one with the fullest buckets.
3. A member that this does not connect is "loose". Loose members meet the rest by an exact
   similarity join: rarest shingles first, with length and positional filters. So every pair of a
   bucket is either in one component already, or checked.

Every link is confirmed on the full sets before it counts.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.frames import map_batches, pick, written
from millrace.llm.words import distinct_sets, mix, shingles_of, text_chunks, words_of

SHINGLE = 5
#: 36 bands of 7: two documents at similarity 0.85 share no band in one of a million cases.
BANDS, BAND_ROWS = 36, 7
#: Counters that rank shingles by frequency; a fixed size, whatever the input.
RANK_BITS = 18
#: Lengths fall into classes that grow by this factor.
LENGTH_STEP = 1.08


def sketches(sets: list[np.ndarray], bins: int = BANDS * BAND_ROWS) -> np.ndarray:
    """One row of ``bins`` values for each set (none of them empty)."""
    out = np.full(len(sets) * bins, np.iinfo(np.uint64).max, np.uint64)
    sizes = np.array([len(s) for s in sets], np.int64)
    items = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)) * bins, sizes)
    empty = np.iinfo(np.uint64).max
    for step in range(2 * bins):
        seed = np.uint64((step + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        hashed = mix(items ^ seed)
        if step < bins:
            place = ((hashed >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
        else:
            place = step - bins
        value = (hashed & np.uint64(0xFFFFFFFFFFFF)) | np.uint64(step << 48)
        np.minimum.at(out, owner + place, value)
        if step % 4 == 0 or step >= bins:
            open_sets = (out.reshape(-1, bins) == empty).any(axis=1)
            if not open_sets.any():
                break
            if not open_sets.all():
                stay = open_sets[owner // bins]
                items, owner = items[stay], owner[stay]
    return out.reshape(-1, bins)


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each band; the band's number is part of it."""
    parts = sketch.reshape(len(sketch), bands, rows)
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2])
    for k in range(rows):
        out = mix(out * np.uint64(0x94D049BB133111EB) + parts[:, :, k])
    return out


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values.view(np.int64)))


def _sketch_batch(batch: pa.RecordBatch, width: int, bands: int, rows: int) -> pa.RecordBatch:
    sizes, first, second, keys, counts = [], [], [], [], []
    for texts in text_chunks(batch.column(1)):
        sets = distinct_sets(*shingles_of(words_of(texts), width))
        full = [s for s in sets if len(s)]
        found = band_keys(sketches(full, bands * rows), bands, rows) if full else np.zeros((0, bands), np.uint64)
        keys.append(found.reshape(-1))
        sizes += [len(s) for s in sets]
        counts += [bands if len(s) else 0 for s in sets]
        for s in sets:
            a, b = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64)
            first.append(a)
            second.append(b)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0),
            pa.array(sizes, pa.int64()),
            pa.array(first, pa.int64()),
            pa.array(second, pa.int64()),
            _lists(np.concatenate(keys) if keys else np.zeros(0, np.uint64), bounds),
        ],
        ["doc_id", "n_shingles", "set_a", "set_b", "bands"],
    )


def _set_batch(batch: pa.RecordBatch, width: int) -> pa.RecordBatch:
    sets = []
    for texts in text_chunks(batch.column(1)):
        sets += distinct_sets(*shingles_of(words_of(texts), width))
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    return pa.RecordBatch.from_arrays([batch.column(0), _lists(values, bounds)], ["doc_id", "shingles"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("of_b"))
    common = F.size(F.array_intersect("of_a", "of_b"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .where(common * (100 + percent) >= percent * (F.size("of_a") + F.size("of_b")))
        .select("a", "b")
    )


def _counted(batch: pa.RecordBatch) -> pa.RecordBatch:
    values = batch.column(1).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    slot, n = np.unique(values & np.uint64((1 << RANK_BITS) - 1), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int64)), pa.array(n.astype(np.int64))], ["slot", "n"])


def _shingle_ranks(sets: DataFrame) -> np.ndarray:
    """How often shingles of each slot occur: a fixed table of ``2 ** RANK_BITS`` counters."""
    rows = map_batches(sets, _counted, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    found = rows.toArrow()
    table = np.zeros(1 << RANK_BITS, np.int64)
    table[found["slot"].to_numpy()] = found["n"].to_numpy()
    return table


def _length_class(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log(n) / np.log(LENGTH_STEP) + 1e-9).astype(np.int64)


def _prefix_rows(batch: pa.RecordBatch, ranks, percent: int) -> pa.RecordBatch | None:
    """For each document its rarest shingles, each with the length classes of partners it can still lead to."""
    table = ranks.value
    out = {name: [] for name in ("token", "own", "other", "doc_id", "place", "size")}
    ids = batch.column(0).to_numpy()
    lists = batch.column(1)
    for i in range(batch.num_rows):
        s = lists[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
        n = len(s)
        # Both sizes fixed, the overlap must reach need(m) = ceil(percent (n + m) / (100 + percent)).
        low, high = -(-n * percent // 100), n * 100 // percent
        prefix = n - low + 1
        order = np.lexsort((s, table[s & np.uint64((1 << RANK_BITS) - 1)]))[:prefix]
        classes = np.unique(_length_class(np.arange(max(1, low), high + 1)))
        smallest = np.maximum(low, np.ceil(LENGTH_STEP ** (classes - 1e-6)).astype(np.int64))
        need = -(-(percent * (n + smallest)) // (100 + percent))
        at, to = np.nonzero(n - np.arange(len(order))[:, None] >= need[None, :])
        out["token"].append(s[order[at]].view(np.int64))
        out["other"].append(classes[to])
        out["place"].append(at)
        for name, value in (("own", _length_class(np.array([n]))[0]), ("doc_id", ids[i]), ("size", n)):
            out[name].append(np.full(len(at), value, np.int64))
    if not out["token"]:
        return None
    arrays = [pa.array(np.concatenate(v).astype(np.int64)) for v in out.values()]
    return pa.RecordBatch.from_arrays(arrays, list(out))


def _loose_pairs(sets: DataFrame, loose: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs of a loose document and another of a different component that share a rare shingle early enough."""
    ranks = sets.sparkSession.sparkContext.broadcast(_shingle_ranks(sets))
    fields = "token long, own long, other long, doc_id long, place long, size long"
    rows = written(
        map_batches(sets, partial(_prefix_rows, ranks=ranks, percent=percent), fields).join(labels, "doc_id"), "prefix"
    )
    marked = rows.join(loose.withColumn("loose", F.lit(True)), "doc_id", "left")
    names = ("own", "other", "place", "size", "component", "doc_id", "loose")
    left = marked.where("loose").select("token", *[F.col(c).alias(f"{c}_a") for c in names])
    right = marked.select("token", *[F.col(c).alias(f"{c}_b") for c in names])
    need = (F.col("size_a") + F.col("size_b")) * percent
    rest = F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b")) * (100 + percent)
    met = (
        (left.token == right.token)
        & (F.col("own_a") == F.col("other_b"))
        & (F.col("other_a") == F.col("own_b"))
        & (F.col("component_a") != F.col("component_b"))
        & (rest >= need)
        # Two loose documents meet once.
        & (F.col("loose_b").isNull() | (F.col("doc_id_a") < F.col("doc_id_b")))
    )
    return (
        left.join(right, met)
        .select(F.greatest("doc_id_a", "doc_id_b").alias("a"), F.least("doc_id_a", "doc_id_b").alias("b"))
        .distinct()
    )


def near_duplicates(
    documents: DataFrame,
    percent: int = 85,
    width: int = SHINGLE,
    bands: int = BANDS,
    band_rows: int = BAND_ROWS,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    ``documents`` has doc_id and text; other columns are left out. Words are runs of bytes other
    than ASCII white space, A-Z lower-cased. Documents are linked when their sets of ``width``-word
    shingles have a Jaccard similarity of at least ``percent`` hundredths, and the smallest doc_id
    reachable over links is the component. Null and empty texts and texts of white space have an
    empty set (n_shingles 0) and are linked with nothing. Rows that share a doc_id count as one
    document: what one of them is linked with, all are. A row without doc_id is linked with
    nothing; its component_id is null and it is kept. An empty table gives an empty result.
    """
    texts = pick(documents, doc_id="long", text="string")
    found = written(
        map_batches(
            texts,
            partial(_sketch_batch, width=width, bands=bands, rows=band_rows),
            "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>",
        ),
        "sketches",
    )
    # One representative for each distinct set.
    classes = written(
        found.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("set_a", "set_b")
        .agg(F.min("doc_id").alias("first_id")),
        "classes",
    )
    spread = (
        found.where("n_shingles > 0")
        .join(classes.select(F.col("first_id").alias("doc_id")).distinct(), "doc_id", "left_semi")
        .select("doc_id", F.explode("bands").alias("band"))
    )
    shared = spread.groupBy("band").agg(F.count("*").alias("members")).where("members > 1")
    members = written(spread.join(shared, "band"), "buckets")
    # The member whose buckets are fullest stands in the middle of its group.
    weight = members.groupBy("doc_id").agg(F.sum("members").alias("weight"))
    centre = (
        members.join(weight, "doc_id")
        .groupBy("band")
        .agg(F.min(F.struct((-F.col("weight")).alias("weight"), "doc_id")).alias("centre"))
        .select("band", F.col("centre.doc_id").alias("centre"))
    )
    stars = written(members.join(centre, "band").select("band", "doc_id", "centre"), "centres")
    sets = written(
        map_batches(
            texts.join(members.select("doc_id").distinct(), "doc_id", "left_semi"),
            partial(_set_batch, width=width),
            "doc_id long, shingles array<long>",
        ).where("size(shingles) > 0"),
        "sets",
    )
    first_links = written(
        _verified(
            stars.where("doc_id <> centre").select(F.col("doc_id").alias("a"), F.col("centre").alias("b")).distinct(),
            sets,
            percent,
        ),
        "links",
    )
    near = components(first_links, "a", "b")
    labels = (
        members.select("doc_id")
        .distinct()
        .join(near.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("doc_id", F.coalesce("component", "doc_id").alias("component"))
    )
    labels = written(labels, "labels")
    of_centre = labels.select(F.col("doc_id").alias("centre"), F.col("component").alias("at_centre"))
    loose = written(
        stars.join(labels, "doc_id")
        .join(of_centre, "centre")
        .where("component <> at_centre")
        .select("doc_id")
        .distinct(),
        "loose",
    )
    links = first_links.unionByName(_verified(_loose_pairs(sets, loose, labels, percent), sets, percent))
    joined = components(links.unionByName(_repeated_ids(found, classes)), "a", "b").select(
        F.col("node").alias("first_id"), "component"
    )
    return (
        found.join(classes, ["set_a", "set_b"], "left")
        .join(joined, "first_id", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("n_shingles") == 0, F.col("doc_id"))
            .when(F.col("doc_id").isNotNull(), F.coalesce("component", "first_id"))
            .alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _repeated_ids(found: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of rows that share a doc_id."""
    repeated = found.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy("doc_id").agg(F.count("*").alias("n"))
    rows = found.join(repeated.where("n > 1"), "doc_id", "left_semi").join(classes, ["set_a", "set_b"])
    return rows.select(F.col("doc_id").alias("a"), F.col("first_id").alias("b")).where("a <> b")
