"""Hard negatives of anchor vectors, from exact integer scores of anchor and candidate tiles.

Vectors become integers and are cut into tiles: blocks of anchors and tiles of candidates, each of a
bounded size. A task holds the tiles of one cell (a bounded share of all candidates), and the blocks
of anchors pass by. Every block is multiplied with every tile by Strassen's recursion, on 64-bit
integers with zero padding. What a block finds in a cell is one heap per anchor; heaps of different
cells merge to the heap over all candidates. The first pass finds the positives and needs only the
cells of the anchors' own label groups; the second one keeps a heap for each window below a positive.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.frames import ship_package, written

#: Labels are dealt to so many groups; a tile holds rows of one group.
LABEL_GROUPS = 16
#: Rows and bytes (of 64-bit integers) of a tile at most; a vector longer than that is a tile by itself.
TILE_ROWS, TILE_BYTES = 1024, 1 << 19
ANCHOR_ROWS = 512
#: Tiles that a task holds at a time, on average at most.
CELL_TILES = 64
#: Products of matrices with a side of at most this many are not cut further.
LEAF = 32
#: Scores have to stay below this size, so that the bounds of windows fit in 64 bits too.
SCORE_LIMIT = 1 << 55

_TILE = "grp int, n int, dim int, ids binary, labels binary, vectors binary"
_KEYS = "array<struct<idx:int,slot:int,id:bigint,score:bigint>>"


def _leaf_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 1 << 53:  # every sum is a whole number that a double holds exactly
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Product of two integer matrices by seven products of their quarters, over and over.

    Odd sides get a row or column of zeros. Sums that pass 64 bits wrap around, which leaves each
    element right as long as the element itself fits.
    """
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return _leaf_product(a, b)
    if m % 2 or k % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
    if k % 2 or n % 2:
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, q = a.shape[0] // 2, b.shape[1] // 2, a.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :q], a[:i, q:], a[i:, :q], a[i:, q:]
    b11, b12, b21, b22 = b[:q, :j], b[:q, j:], b[q:, :j], b[q:, j:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * j), np.int64)
    out[:i, :j] = p1 + p4 - p5 + p7
    out[:i, j:] = p3 + p5
    out[i:, :j] = p2 + p4
    out[i:, j:] = p1 - p2 + p3 + p6
    return out[:m, :n]


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Scores of the rows of ``a`` with those of ``b``; the shorter vectors are padded with zeros."""
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
    size = [float(np.abs(x.astype(np.float64)).max(initial=0)) for x in (a, b)]
    if size[0] * size[1] * width >= SCORE_LIMIT and np.abs(a.astype(np.float64) @ b.T.astype(np.float64)).max(initial=0) >= SCORE_LIMIT:
        raise OverflowError("a score does not fit in 55 bits")
    return strassen(a, np.ascontiguousarray(b.T))


class Heaps:
    """The ``most`` best (score, id) of each of ``n`` keys: higher scores first, then smaller ids."""

    def __init__(self, n: int, most: int):
        self.n, self.most = n, most
        self.keys, self.scores, self.ids = (np.zeros(0, np.int64) for _ in range(3))

    def merge(self, keys: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        keys, scores, ids = (np.concatenate(x) for x in ((self.keys, keys), (self.scores, scores), (self.ids, ids)))
        order = np.lexsort((ids, -scores, keys))
        keys = keys[order]
        place = np.arange(len(keys)) - np.searchsorted(keys, keys)
        kept = place < self.most
        self.keys, self.scores, self.ids = keys[kept], scores[order][kept], ids[order][kept]

    def least(self) -> np.ndarray:
        """The score below which nothing enters a key's heap any more."""
        out = np.full(self.n, np.iinfo(np.int64).min)
        ends = np.searchsorted(self.keys, np.arange(self.n), "right")
        full = ends - np.searchsorted(self.keys, np.arange(self.n)) == self.most
        out[full] = self.scores[ends[full] - 1]
        return out

    def add(self, keys: np.ndarray, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """Offer a matrix of scores, one row per key of ``keys``, one column per id."""
        allowed = allowed & (scores >= self.least()[keys][:, None])
        if scores.shape[1] > self.most:
            masked = np.where(allowed, scores, np.iinfo(np.int64).min)
            cut = scores.shape[1] - self.most
            allowed &= scores >= np.partition(masked, cut, axis=1)[:, cut : cut + 1]
        row, column = np.nonzero(allowed)
        if len(row):
            self.merge(keys[row], scores[row, column], ids[column])


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Rows of a list column as one matrix, padded with zeros."""
    sizes = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten(), np.int64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def _tile_row(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple:
    ids, labels = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    width = max(p[2].shape[1] for p in parts)
    vectors = np.concatenate([np.pad(p[2], ((0, 0), (0, width - p[2].shape[1]))) for p in parts])
    order = np.argsort(ids, kind="stable")
    size = int(np.abs(vectors).max(initial=0))
    kind = "<i2" if size < 1 << 15 else "<i4" if size < 1 << 31 else "<i8"
    return len(ids), width, ids[order].tobytes(), labels[order].tobytes(), vectors[order].astype(kind).tobytes()


def _cut_tiles(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows of (vec_id, label, grp, vector) as tiles of one group each."""
    schema = pa.schema(
        [("grp", pa.int32()), ("n", pa.int32()), ("dim", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("vectors", pa.binary())]
    )
    waiting: dict[int, list] = {}
    held: dict[int, int] = {}

    def flush(group: int) -> pa.RecordBatch:
        held.pop(group)
        row = (group, *_tile_row(waiting.pop(group)))
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema, strict=True)], schema=schema)

    for batch in batches:
        ids, labels, groups = (np.asarray(batch.column(i)) for i in range(3))
        step = most
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            vectors = _matrix(part.column(3))
            for group in np.unique(groups[at : at + step]).tolist():
                picked = np.flatnonzero(groups[at : at + step] == group)
                room = max(1, min(most, TILE_BYTES // max(8, vectors.shape[1] * 8)))
                for first in range(0, len(picked), room):
                    own = picked[first : first + room]
                    if group in held and held[group] + len(own) > room:
                        yield flush(group)
                    waiting.setdefault(group, []).append((ids[at + own], labels[at + own], vectors[own]))
                    held[group] = held.get(group, 0) + len(own)
    for group in sorted(waiting):
        yield flush(group)


def _tiles(rows: DataFrame, most: int, label: str) -> DataFrame:
    """Stored tiles, each with a number of its own."""
    ship_package(rows.sparkSession)
    tiles = rows.mapInArrow(partial(_cut_tiles, most=most), _TILE)
    return written(tiles.withColumn("tile", F.monotonically_increasing_id()), label)


def _read_tile(batch: pa.RecordBatch, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, dim = batch.column("n")[at].as_py(), batch.column("dim")[at].as_py()
    ids, labels = (np.frombuffer(batch.column(c)[at].as_buffer(), "<i8") for c in ("ids", "labels"))
    data = batch.column("vectors")[at].as_buffer()
    kind = f"<i{data.size // (n * dim)}" if dim else "<i8"
    return ids, labels, np.frombuffer(data, kind).astype(np.int64).reshape(n, dim)


def _positives(anchors, tiles, keys, most: int) -> list[np.ndarray]:
    ids, labels, vectors = anchors
    heaps = Heaps(len(ids), most)
    for other_ids, other_labels, other in tiles:
        same = (labels[:, None] == other_labels) & (ids[:, None] != other_ids)
        if same.any():
            heaps.add(np.arange(len(ids)), inner_products(vectors, other), same, other_ids)
    return [heaps.keys, ids[heaps.keys], heaps.ids, heaps.scores]


def _negatives(anchors, tiles, keys, most: int, window: tuple[int, int]) -> list[np.ndarray]:
    ids, labels, vectors = anchors
    at, slot, positive, score = (np.array([k[c] for k in keys], np.int64) for c in ("idx", "slot", "id", "score"))
    lowest, highest = -(-window[0] * score // 100), window[1] * score // 100
    heaps = Heaps(len(at), most)
    slots = [np.flatnonzero(slot == s) for s in np.unique(slot)]
    for other_ids, other_labels, other in tiles:
        scores, differ = inner_products(vectors, other), labels[:, None] != other_labels
        for own in slots:
            found = scores[at[own]]
            allowed = differ[at[own]] & (found >= lowest[own][:, None]) & (found <= highest[own][:, None])
            heaps.add(own, found, allowed, other_ids)
    k = heaps.keys
    return [at[k], slot[k], ids[at[k]], positive[k], score[k], heaps.ids, heaps.scores]


def _search(batches: Iterator[pa.RecordBatch], find, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The tiles of a cell come first and are held; each block of anchors behind them is searched."""
    cell, tiles = None, []
    for batch in batches:
        for at in range(batch.num_rows):
            here = batch.column("cell")[at].as_py()
            if here != cell:
                cell, tiles = here, []
            tile = _read_tile(batch, at)
            if batch.column("kind")[at].as_py() == 0:
                tiles.append(tile)
            elif tiles:
                found = find(tile, tiles, batch.column("keys")[at].as_py())
                if len(found[0]):
                    block = np.full(len(found[0]), batch.column("tile")[at].as_py())
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (block, *found)], schema=schema)


def _pass(tiles: DataFrame, blocks: DataFrame, find, columns: list[str]) -> DataFrame:
    """Heaps of all blocks in all of their cells; ``blocks`` has the first and last cell of each."""
    shared = ["cell", "kind", "tile", "n", "dim", "ids", "labels", "vectors", "keys"]
    anchors = blocks.withColumn("cell", F.explode(F.sequence("first", "last"))).withColumn("kind", F.lit(1))
    held = tiles.withColumn("kind", F.lit(0)).withColumn("keys", F.lit(None).cast(_KEYS))
    parts = int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mixed = held.select(*shared).unionByName(anchors.select(*shared))
    schema = pa.schema([(c, pa.int64()) for c in columns])
    return (
        mixed.repartition(parts, "cell")
        .sortWithinPartitions("cell", "kind")
        .mapInArrow(partial(_search, find=find, schema=schema), ", ".join(f"{c} long" for c in columns))
    )


def integer_vectors(embeddings: DataFrame, vector: str, scale: int) -> DataFrame:
    """(vec_id, label, grp, vector of long) of the rows that take part."""
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col(f"`{vector}`").cast("array<double>").alias("raw"),
    )
    sound = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("raw").isNotNull() & sound).select(
        "vec_id",
        "label",
        F.pmod(F.xxhash64("label"), F.lit(LABEL_GROUPS)).cast("int").alias("grp"),
        F.transform("raw", lambda x: F.floor(x * scale)).alias("vector"),
    )


def mine_hard_negatives(
    embeddings: DataFrame,
    anchors: str,
    vector: str = "embedding",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 10,
    window: tuple[int, int] = (30, 90),
) -> DataFrame:
    """The best rows of other labels whose score lies in a window below each of an anchor's positives.

    ``embeddings`` has vec_id, label and ``vector``; ``anchors`` is a SQL condition on vec_id and label.
    Components become floor(scale * x), and a score is the inner product. An anchor's positives are the
    first ``positives`` rows of its label by score, then vec_id; its negatives for a positive with score
    p are the first ``negatives`` rows of other labels with a score from window[0] to window[1] percent
    of p. Columns: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows with a null id, label or vector, or a null or non-finite component, take no part. Of vectors of
    different length the shorter one ends with zeros. Repeated rows are rows of their own, as anchors and
    as candidates; a row with the anchor's id is none of its positives. Other columns are left out; an
    empty table gives an empty result. A score beyond 55 bits raises OverflowError.
    """
    spark = embeddings.sparkSession
    rows = integer_vectors(embeddings, vector, scale)
    tiles = _tiles(rows, TILE_ROWS, "candidate_tiles")
    blocks = _tiles(rows.where(anchors), ANCHOR_ROWS, "anchor_blocks")

    counts = {r.grp: r.n for r in tiles.groupBy("grp").agg(F.count("*").alias("n")).collect()}
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = max(1, min(CELL_TILES, sum(counts.values()) // (4 * parts)))
    slices = [-(-counts.get(g, 0) // share) for g in range(LABEL_GROUPS)]
    begins = np.concatenate([[0], np.cumsum(slices)]).tolist()
    by_group = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("grp") + 1)
    tiles = tiles.withColumn(
        "cell", (by_group(begins[:-1]) + F.pmod(F.xxhash64("tile"), by_group(slices))).cast("long")
    )

    near = blocks.withColumns({"first": by_group(begins[:-1]).cast("long"), "last": by_group(begins[1:]).cast("long") - 1})
    near = near.withColumn("keys", F.lit(None).cast(_KEYS))
    best = Window.partitionBy("tile", "idx").orderBy(F.desc("score"), "id")
    found = _pass(tiles, near, partial(_positives, most=positives), ["tile", "idx", "anchor_id", "id", "score"])
    found = found.withColumn("slot", F.row_number().over(best)).where(F.col("slot") <= positives)
    keys = found.groupBy("tile").agg(
        F.sort_array(F.collect_list(F.struct(F.col("idx").cast("int").alias("idx"), "slot", "id", "score"))).alias("keys")
    )

    wide = blocks.join(keys, "tile").withColumns({"first": F.lit(0).cast("long"), "last": F.lit(begins[-1] - 1).cast("long")})
    columns = ["tile", "idx", "slot", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
    found = _pass(tiles, wide, partial(_negatives, most=negatives, window=window), columns)
    best = Window.partitionBy("tile", "idx", "slot").orderBy(F.desc("negative_score"), "negative_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
