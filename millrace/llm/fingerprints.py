"""Merkle trees of documents: parts of sentences, paragraphs, sections, document.

Every node is the hash of its children, so equal roots mean equal texts, and from two roots that
differ the differing branches lead to the edits. A section ends at a blank line and behind a
paragraph whose hash says so, so a paragraph more or less only touches its own section.

A fingerprint is what is stored of a tree: the root, the beginnings of the sections' hashes, and the
smallest of the leaves' hashes. The likeness of two texts comes from their fingerprints alone.
"""

from __future__ import annotations

import re
import struct
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b, sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.frames import pick, ship_package, written

#: Leaves begin at the beginning of a sentence and behind every 32 characters of one.
_LEAF = re.compile(r"[^.!?]{1,32}[.!?]*|[.!?]+")
#: One in so many paragraphs ends a section.
SECTION = 8

#: Leaves that a fingerprint keeps; a likeness of one third has a standard error of 0.06 by so many.
KEPT = 64

RESULT = (
    "doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double, n_paragraphs long, n_differing long, first_differing long"
)


def _hash(level: bytes, data: bytes) -> bytes:
    return blake2b(data, digest_size=16, person=level).digest()


@dataclass
class Tree:
    """Hashes of the root, of sections with their number of paragraphs, of paragraphs, and how often each leaf occurs."""

    root: bytes
    sections: list[tuple[bytes, int]]
    paragraphs: list[bytes]
    leaves: Counter

    @property
    def fingerprint(self) -> bytes:
        """The root (16 bytes), the number of sections, 4 bytes of each, and of each of the smallest leaves."""
        found = set(self.leaves)
        for leaf, n in self.leaves.items():
            # Each further occurrence is a leaf of its own.
            found.update(_hash(b"again", leaf + struct.pack("<Q", k)) for k in range(1, n))
        smallest = sorted({h[:4] for h in found})[:KEPT]
        return b"".join([self.root, struct.pack("<I", len(self.sections)), *(s[:4] for s, _ in self.sections), *smallest])


def merkle_tree(text: str) -> Tree:
    leaves: Counter = Counter()
    sections, paragraphs, open_section = [], [], []

    def close() -> None:
        sections.append((_hash(b"section", b"".join(open_section)), len(open_section)))
        open_section.clear()

    for paragraph in text.split("\n") if text else ():
        parts = _LEAF.findall(paragraph)
        hashes = [_hash(b"part", s.encode()) for s in parts]
        leaves.update(hashes)
        own = _hash(b"paragraph", b"".join(hashes))
        paragraphs.append(own)
        open_section.append(own)
        if not parts or own[0] < 256 // SECTION:
            close()
    if open_section:
        close()
    return Tree(_hash(b"document", b"".join(s for s, _ in sections)), sections, paragraphs, leaves)


def _kept_leaves(fingerprint: bytes) -> list[bytes]:
    start = 20 + 4 * struct.unpack_from("<I", fingerprint, 16)[0]
    return [fingerprint[k : k + 4] for k in range(start, len(fingerprint), 4)]


def likeness(a: bytes, b: bytes) -> float:
    """The share of common leaves in all leaves of two texts, by their fingerprints; 1 for equal roots, also of empty texts.

    The smallest leaves of both together are a fair sample of all leaves, and all of them while there are
    no more than ``KEPT``; the likeness is then exact.
    """
    if a[:16] == b[:16]:
        return 1.0
    one, other = set(_kept_leaves(a)), set(_kept_leaves(b))
    sample = sorted(one | other)[:KEPT]
    return sum(h in one and h in other for h in sample) / len(sample) if sample else 0.0


def differing_paragraphs(a: Tree, b: Tree) -> tuple[list[int], list[int]]:
    """Numbers of the paragraphs of ``a`` and of ``b`` that the other does not have.

    Sections that both have are passed over whole.
    """

    def rest(one: Tree, other: Tree) -> list[int]:
        shared, known, out, at = Counter(s for s, _ in other.sections), Counter(other.paragraphs), [], 0
        for section, size in one.sections:
            if shared[section] > 0:
                shared[section] -= 1
            else:
                for k in range(at, at + size):
                    if known[one.paragraphs[k]] <= 0:
                        out.append(k)
            at += size
        return out

    if a.root == b.root:
        return [], []
    return rest(a, b), rest(b, a)


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as many characters from the beginning of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _row(doc_id, text: str, tree: Tree, own: bytes, following: str, next_own: bytes) -> tuple:
    changed = edited(text, following)
    changed_tree = merkle_tree(changed)
    changed_own = changed_tree.fingerprint
    differing = differing_paragraphs(tree, changed_tree)[0]
    return (
        doc_id, len(text), sha256(changed.encode()).digest(), own, changed_own, likeness(own, changed_own),
        likeness(own, next_own), len(tree.paragraphs), len(differing), differing[0] if differing else None,
    )


_EDGE = RESULT + ", edge string, edge_id string, text_hash long, tie double, text string"
_NAMES = [f.split()[0] for f in _EDGE.split(", ")]
_TYPES = {"long": pa.int64(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary()}
#: How many columns the result has.
_OWN = RESULT.count(", ") + 1
_SCHEMA = pa.schema([(f.split()[0], _TYPES[f.split()[1]]) for f in _EDGE.split(", ")])


def _record_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of all rows but the last, and the first and last row as they are; each text is hashed once."""
    part = TaskContext.get().partitionId()
    before = None

    def edge(kind: str, row: tuple) -> tuple:
        doc_id, text, text_hash, tie, *_ = row
        return (doc_id, *[None] * (_OWN - 1), kind, f"{part}-{kind}", text_hash, tie, text)

    for batch in batches:
        rows = []
        for doc_id, text, text_hash, tie in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            tree = merkle_tree(text)
            row = (doc_id, text, text_hash, tie, tree, tree.fingerprint)
            if before is None:
                rows.append(edge("first", row))
            else:
                rows.append((*_row(before[0], before[1], *before[4:], text, row[5]), *[None] * 5))
            before = row
        if rows:
            yield _record_batch(rows, _SCHEMA)
    if before is not None:
        yield _record_batch([edge("last", before)], _SCHEMA)


def _of_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(list(_SCHEMA)[:_OWN])
    for batch in batches:
        rows = []
        for doc_id, text, following in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            tree = merkle_tree(text)
            rows.append(_row(doc_id, text, tree, tree.fingerprint, following, merkle_tree(following).fingerprint))
        if rows:
            yield _record_batch(rows, schema)


def fingerprint_documents(documents: DataFrame) -> DataFrame:
    """Fingerprints of each document, of the edited one, and how near they are to it.

    One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (lower-case hex),
    near_edited, near_next, n_paragraphs, n_differing and first_differing (how many paragraphs the edited
    text does not have, and the number of the first, from 0; else null). The next document has the next larger doc_id; that of the last one is
    the first. A null text is empty. Null doc_ids come first; rows with equal doc_id follow each
    other by a hash of their text. A single document is its own next one. Other columns are left
    out; an empty table gives an empty result.

    Documents are dealt out by ranges of doc_id, so a document and its next one meet in one task,
    but for the last of each range; these few meet the first of the next range afterwards.
    """
    ship_package(documents.sparkSession)
    rows = pick(documents, doc_id="long", text="string").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("text_hash"), F.rand(7).alias("tie")
    )
    keys = ["doc_id", "text_hash", "tie"]
    found = written(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(_in_order, _EDGE), "fingerprints"
    )
    edges = found.where("edge IS NOT NULL")
    order = Window.orderBy(*keys, "edge")
    ends = (
        edges.select(*keys, "edge", "edge_id")
        .withColumn("start", F.first("edge_id").over(order))
        .withColumn("next_id", F.coalesce(F.lead("edge_id").over(order), "start"))
        .where("edge = 'last'")
        .select("edge_id", "next_id")
    )
    texts = edges.select("edge_id", "doc_id", "text")
    following = edges.select(F.col("edge_id").alias("next_id"), F.col("text").alias("following"))
    pairs = ends.join(texts, "edge_id").join(following, "next_id").select("doc_id", "text", "following")
    inside = found.where("edge IS NULL").select(*_NAMES[:_OWN])
    rows = inside.unionByName(pairs.mapInArrow(_of_pairs, RESULT))
    return rows.withColumns({c: F.lower(F.hex(c)) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")})
