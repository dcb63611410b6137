"""SimHash near-duplicate detection with pivot distance tables.

1. One Arrow pass gives each text its 64-bit fingerprint; equal fingerprints form a class, and only classes go on.
2. Fingerprints within ``max_bits`` differing bits agree on at least one of ``max_bits + 1`` blocks of the bits, whatever the
   blocks are. Classes that agree on a block share a bucket. A bucket of more than ``unit_rows`` classes is split again: the bits
   that its key leaves free are cut into as many blocks, and so on, until every bucket fits a unit. No pair is lost by this, and a
   bucket cannot resist it: with log2(unit_rows) free bits or fewer it holds no more than unit_rows classes.
3. A unit precomputes the table of Hamming distances of its classes to ``pivots`` reference fingerprints (fixed random ones, and
   some of its own members). By the triangle inequality, two classes within ``max_bits`` differ by no more than that in
   each coordinate of the table, so a pair with any larger difference is discarded unseen; the rest are verified
   bit by bit. A unit passes on a spanning forest of its links, never more edges than classes.
4. Links give components; the least id of a component is its representative.

Classes are moved as 24 bytes each, texts never.

Defined cases: null and empty texts, and texts without words, have the fingerprint zero and are linked like any other; bytes that are
not UTF-8 are hashed as they are; very long texts are read whole; a row without id keeps its fingerprint, has no component and links nothing; rows that repeat
an id are returned as often as they occur, and the id has the links of all its texts; a bit set in exactly half of the
hashes is 0; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.bytewords import LOWER_BYTES, release, sub_batches
from millrace.llm.components import components
from millrace.llm.workspace import Workspace

BITS = 64


def fingerprint(text: bytes, shingle_words: int = 3) -> int:
    """The bits that are set in over half of the text's shingle hashes, repeats counted."""
    words = text.translate(LOWER_BYTES).split()
    if not words:
        return 0
    if len(words) < shingle_words:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    n, counts = len(words) - shingle_words + 1, np.zeros(BITS, np.int64)
    hashed = map(xxhash.xxh64_intdigest, map(b" ".join, zip(*[words[k:] for k in range(shingle_words)], strict=False)), repeat(42))
    for at in range(0, n, 1 << 15):
        h = np.fromiter(hashed, dtype="<u8", count=min(1 << 15, n - at))
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, f) per row of docs; f is the fingerprint as a signed long."""
    source = docs.select(docs[id_column].alias("doc_id"), docs[text_column].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in sub_batches(batch, "text"):
                f = np.array([fingerprint(t, shingle_words) for t in texts], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(f.view(np.int64))], ["doc_id", "f"])
        release()

    return source.mapInArrow(run, source.drop("text").schema.add("f", "long"))


def blocks(free: list[int], n: int) -> list[int]:
    """The masks of n blocks, as even as may be, of the free bits."""
    return [sum(1 << b for b in part.tolist()) for part in np.array_split(np.array(free), n)]


def _children(masks: list[int], n: int) -> list[tuple[int, int]]:
    """(mask, mask with one block of its free bits added) for each of the masks and blocks."""
    return [(m, m | more) for m in masks for more in blocks([b for b in range(BITS) if not m >> b & 1], n) if more]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _buckets(ws: Workspace, classes: DataFrame, max_bits: int, unit_rows: int) -> DataFrame:
    """(mask, key, f) of the buckets of 2 to unit_rows classes in which every pair within max_bits meets."""
    spark: SparkSession = classes.sparkSession
    masks, units = [0], None
    held = classes.select(F.lit(0).cast("long").alias("mask"), "f")
    while True:
        steps = _children(masks, max_bits + 1)
        masks = sorted({child for _, child in steps})
        table = spark.createDataFrame([(_signed(m), _signed(c)) for m, c in steps], "mask long, child long")  # a number of rows fixed by the level
        held = held.join(F.broadcast(table), "mask").select(F.col("child").alias("mask"), F.col("f").bitwiseAND(F.col("child")).alias("key"), "f").distinct()
        held = ws.save(held, "keys")
        sizes = ws.save(held.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
        few = held.join(sizes.where(F.col("n") <= unit_rows).select("mask", "key"), ["mask", "key"])
        units = few if units is None else units.unionByName(few)
        many = sizes.where(F.col("n") > unit_rows)
        if many.isEmpty():
            return units
        held = held.join(many.select("mask", "key"), ["mask", "key"]).select("mask", "f")


class _Forest:
    """Which rows of a unit are connected, and by which links."""

    def __init__(self, n: int):
        self.parent = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def _roots(self, x: np.ndarray) -> np.ndarray:
        r = self.parent[x]
        while not np.array_equal(up := self.parent[r], r):
            r = up
        self.parent[x] = r
        return r

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        a, b = self._roots(i), self._roots(j)
        apart = np.flatnonzero(a != b)
        for k, p, q in zip(apart.tolist(), a[apart].tolist(), b[apart].tolist(), strict=True):
            while (up := int(self.parent[p])) != p:
                p = up
            while (up := int(self.parent[q])) != q:
                q = up
            if p != q:
                self.parent[max(p, q)] = min(p, q)
                self.links.append((int(i[k]), int(j[k])))


def _verified(f: np.ndarray, table: np.ndarray, i: np.ndarray, j: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Those pairs (i, j) that no pivot tells apart and whose fingerprints are within max_bits."""
    for k in range(table.shape[1]):
        if not len(i):
            return i, j
        near = np.abs(table[i, k] - table[j, k]) <= max_bits
        i, j = i[near], j[near]
    near = np.bitwise_count(f[i] ^ f[j]) <= max_bits
    return i[near], j[near]


def references(pivots: int) -> np.ndarray:
    return np.random.default_rng(64_013).integers(0, 1 << 64, pivots, dtype=np.uint64)


def distances(f: np.ndarray, refs: np.ndarray) -> np.ndarray:
    return np.bitwise_count(f[:, None] ^ refs[None, :]).astype(np.int8)


def _small(f: np.ndarray, unit: np.ndarray, refs: np.ndarray, max_bits: int, forest: _Forest, at: np.ndarray) -> None:
    """Links within units of few rows, all units at once: row i against row i + d for growing d."""
    table, i, d = distances(f, refs), np.arange(len(f)), 0
    while len(i):
        d += 1
        i = i[i + d < len(f)]
        i = i[unit[i] == unit[i + d]]
        a, b = _verified(f, table, i, i + d, max_bits)
        forest.join(at[a], at[b])


def _large(f: np.ndarray, refs: np.ndarray, max_bits: int, forest: _Forest, at: np.ndarray, own: int = 8, rows: int = 128) -> None:
    """Links within one unit, whose rows are sorted by their first coordinate so that a row meets only those near to it there."""
    table = distances(f, np.concatenate([f[:: max(1, len(f) // own)][:own], refs]))
    order = np.argsort(table[:, 0], kind="stable")
    f, table, at = f[order], table[order], at[order]
    ends = np.searchsorted(table[:, 0], table[:, 0] + max_bits, side="right")
    for begin in range(0, len(f), rows):
        i = np.arange(begin, min(begin + rows, len(f)))
        j = np.arange(begin + 1, ends[i[-1]])
        p, q = np.nonzero((j[None, :] > i[:, None]) & (j[None, :] < ends[i][:, None]))
        a, b = _verified(f, table, i[p], j[q], max_bits)
        forest.join(at[a], at[b])


def _links(units: DataFrame, max_bits: int, pivots: int, small: int = 24) -> DataFrame:
    """(a, b): for each unit of (mask, key, f), links that connect what its pairs within max_bits connect."""
    refs = references(pivots)
    sorted_units = units.repartition("mask", "key").sortWithinPartitions("mask", "key")

    def forest(mask: np.ndarray, key: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
        begins = np.flatnonzero(np.concatenate([[True], (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])]))
        sizes = np.diff(np.append(begins, len(f)))
        unit, found = np.repeat(np.arange(len(begins)), sizes), _Forest(len(f))
        few = np.flatnonzero(sizes[unit] <= small)
        _small(f[few], unit[few], refs, max_bits, found, few)
        for k in np.flatnonzero(sizes > small):
            at = np.arange(begins[k], begins[k] + sizes[k])
            _large(f[at], refs, max_bits, found, at)
        links = np.array(found.links, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(f[links[:, c]].view(np.int64)) for c in (0, 1)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.zeros((3, 0), np.int64)
        for batch in batches:
            rows = np.concatenate([rest, np.stack([c.to_numpy() for c in batch.columns])], axis=1)
            if not rows.shape[1]:
                continue
            last = np.flatnonzero((rows[0] != rows[0, -1]) | (rows[1] != rows[1, -1]))
            cut = last[-1] + 1 if len(last) else 0
            if cut:
                yield forest(rows[0, :cut], rows[1, :cut], rows[2, :cut].copy().view(np.uint64))
            rest = rows[:, cut:]
        if rest.shape[1]:
            yield forest(rest[0], rest[1], rest[2].copy().view(np.uint64))

    return sorted_units.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, *, shingle_words: int = 3, max_bits: int = 3, pivots: int = 32, unit_rows: int = 512, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row of docs: doc_id, fingerprint (16 hex digits) and component_id (smallest id reachable over links)."""
    if unit_rows < 1 << max_bits:
        raise ValueError("a unit must hold 2**max_bits classes, as many as may differ in their last free bits")
    ws = Workspace(docs.sparkSession, "simhash")
    marked = ws.save(fingerprints(docs, shingle_words, id_column, text_column), "fingerprints")
    classes = ws.save(marked.where("doc_id is not null").groupBy("f").agg(F.min("doc_id").alias("least")), "classes")
    links = ws.save(_links(_buckets(ws, classes, max_bits, unit_rows), max_bits, pivots), "links")
    rooted = classes.join(components(ws, links).withColumnRenamed("vertex", "f"), "f", "left").select("f", "least", F.coalesce("root", "f").alias("root"))
    rooted = ws.save(rooted, "rooted")
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("f", "component_id")
    out = marked.join(named, "f", "left")
    return ws.keep(out.select("doc_id", F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")))
