"""Approximate nearest neighbours by inner product over balanced posting lists.

Centroids are fitted on the driver by k-means with a penalty on crowded clusters, to a sample that is chosen by a hash of the id before
anything is ordered: at most ``sample_rows`` ids, or ``per_list`` for each list where that is more. There is a list for every
``4 * sqrt(n)`` vectors of n, so lists grow neither faster nor slower than their number. Every vector of the table is indexed: it goes to the list of its nearest centroid and is replicated to those
almost as near. Centroids are searched through an in-memory neighbour graph, best first: a search opens some multiple of the
logarithm of their number and measures only the neighbours of those. A query visits
the lists it met whose centroids are within a ratio of its nearest one's distance; the ratio is the smallest at which
sampled queries reach ``recall`` against brute force over the sample, which is the harder case, as its neighbours are
farther apart than the table's.

Maximum inner product is turned into nearest distance by one more coordinate that lifts all vectors to the
greatest norm. Lists are cut into chunks by hash, so that a crowded list (thousands of equal vectors) is many units of
work; a unit scores its queries in double precision and passes on at most k rows each. The result's scores are recomputed pair by
pair, so that equal vectors tie exactly.

Defined cases: vectors that are null, zero, or hold null or non-finite components, rows without id, and vectors not of the commonest
length of the table (of equally common ones, the greatest) take no part; vectors of any length are read whole; rows that repeat an id are one candidate with the best of their scores (as a query, the least of their vectors); ties go to
the smaller id; with fewer candidates than k all are returned; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.workspace import Workspace


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] - 2 * x @ y.T + (y * y).sum(1), 0))


def _nearest(x: np.ndarray, y: np.ndarray, scale: np.ndarray, block: int = 2048) -> np.ndarray:
    """For each row of x the row of y at the least scaled distance, block by block."""
    return np.concatenate([(_distances(x[at : at + block], y) * scale).argmin(1) for at in range(0, len(x), block)])


def balanced_kmeans(x: np.ndarray, k: int, rounds: int = 12, pressure: float = 0.3, seed: int = 3) -> np.ndarray:
    """Centroids of k clusters; a cluster over its fair share looks farther away in the next round."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(x, axis=0)
    k = min(k, len(distinct))
    centres, size = distinct[rng.choice(len(distinct), k, replace=False)].copy(), np.full(k, len(x) / k)
    for _ in range(rounds):
        own = _nearest(x, centres, 1 + pressure * (size * k / len(x) - 1).clip(-0.5, 2))
        size, order = np.bincount(own, minlength=k), own.argsort(kind="stable")
        full = np.flatnonzero(size)
        centres[full] = np.add.reduceat(x[order], (np.cumsum(size) - size)[full]) / size[full][:, None]
        if len(empty := np.flatnonzero(size == 0)):
            centres[empty] = distinct[rng.choice(len(distinct), len(empty))]
    return centres


@dataclass
class Index:
    centres: np.ndarray  # lists x (d + 1)
    graph: np.ndarray  # lists x degree
    entries: np.ndarray
    top_norm: float
    ratio: float = 1.0
    measured: int = 0  # distances to centroids so far

    @classmethod
    def build(cls, sample: np.ndarray, k: int, top_norm: float) -> Index:
        centres = balanced_kmeans(lift(sample, top_norm), k)
        n = len(centres)
        degree = min(n - 1, max(4, int(np.ceil(np.log2(n))))) if n > 1 else 0
        order = np.concatenate([_distances(centres[at : at + 1024], centres).argsort(1)[:, : degree + 1] for at in range(0, n, 1024)])
        far = np.random.default_rng(5).integers(0, n, (n, 2))  # long links, and a ring, keep the graph in one piece
        graph = np.concatenate([order[:, 1:], far, np.roll(np.arange(n), 1)[:, None]], 1)
        return cls(centres, graph, np.unique(np.linspace(0, n - 1, int(np.ceil(np.log2(n + 1)))).astype(int)), top_norm)

    def beam(self, width: int) -> int:
        """How many centroids a search opens: some multiple of the logarithm of their number."""
        return width * max(1, int(np.ceil(np.log2(len(self.centres) + 1))))

    def search(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """For each of a block of lifted vectors the centroids met, nearest first, and their distances; -1 and infinite where fewer were met.

        Best first through the graph: each hop opens every vector's nearest unopened centroid among its ``beam(width)`` nearest and measures those of its
        neighbours that it has not met. Nothing is as wide as the number of centroids.
        """
        n, beam = len(x), self.beam(width)
        ids = np.broadcast_to(self.entries, (n, len(self.entries))).copy()
        far = np.stack([np.sqrt(((x - self.centres[e]) ** 2).sum(1)) for e in self.entries], 1)
        opened, live = np.zeros(ids.shape, bool), np.arange(n)
        self.measured += ids.size
        while len(live):
            order = np.argsort(far[live], 1, kind="stable")
            ids[live], far[live], opened[live] = (np.take_along_axis(v[live], order, 1) for v in (ids, far, opened))
            able = ~opened[live, :beam] & np.isfinite(far[live, :beam])
            rows = np.flatnonzero(able.any(1))
            live = live[rows]
            if not len(live):
                break
            first = able[rows].argmax(1)
            opened[live, first] = True
            near = self.graph[ids[live, first]]
            new = ~(near[:, :, None] == ids[live][:, None, :]).any(2)
            new[:, 1:] &= ~((near[:, 1:, None] == near[:, None, :]) & (np.arange(near.shape[1])[None, :] < np.arange(1, near.shape[1])[:, None])).any(2)  # a link may be there twice
            r, c = np.nonzero(new)
            added = np.full(near.shape, np.inf)
            for at in range(0, len(r), 65_536):
                q = slice(at, at + 65_536)
                added[r[q], c[q]] = np.sqrt(((x[live[r[q]]] - self.centres[near[r[q], c[q]]]) ** 2).sum(1))
            self.measured += len(r)
            wide = int(new.sum(1).max(initial=0))
            if wide:
                pick = np.argsort(added, 1, kind="stable")[:, :wide]
                more_far = np.full((n, wide), np.inf)
                more_ids = np.full((n, wide), -1)
                more_far[live] = np.take_along_axis(added, pick, 1)
                more_ids[live] = np.where(np.isfinite(more_far[live]), np.take_along_axis(near, pick, 1), -1)
                ids, far, opened = np.concatenate([ids, more_ids], 1), np.concatenate([far, more_far], 1), np.concatenate([opened, np.zeros(more_ids.shape, bool)], 1)
        order = np.argsort(far, 1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(far, order, 1)

    def homes(self, x: np.ndarray, copies: int, closure: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of every placement of a block of lifted vectors: the nearest centroid, and up to copies - 1 almost as near."""
        near, far = (v[:, :copies] for v in self.search(x, 2))
        rows, cols = np.nonzero((far <= far[:, :1] * closure) & np.isfinite(far))
        return rows, near[rows, cols]

    def visits(self, x: np.ndarray, sizes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of the lists each lifted query visits: those met within the ratio, and the nearest ones that together hold ``least`` vectors.

        A query whose lists met don't hold as many visits all lists.
        """
        near, far = self.search(x, 3)
        held = np.where(near >= 0, sizes[near], 0)
        before = np.cumsum(held, 1) - held
        rows, cols = np.nonzero((near >= 0) & ((far <= far[:, :1] * self.ratio) | (before < least)))
        lists = near[rows, cols]
        few = np.flatnonzero(held.sum(1) < least)
        keep = ~np.isin(rows, few)
        k = len(self.centres)
        return np.concatenate([rows[keep], np.repeat(few, k)]), np.concatenate([lists[keep], np.tile(np.arange(k), len(few))])

    def calibrate(self, sample: np.ndarray, k: int, recall: float, copies: int, closure: float, queries: int = 200) -> None:
        """Sets the smallest ratio that reaches the recall on the sample."""
        lifted, q = lift(sample, self.top_norm), sample[:queries]
        scores = q @ sample.T
        scores[np.arange(len(q)), np.arange(len(q))] = -np.inf
        k = min(k, len(sample) - 1)
        if k < 1:
            return
        truth = np.argpartition(-scores, k - 1, 1)[:, :k]
        homes = np.full((len(sample), copies), -1)
        for at in range(0, len(sample), 512):
            rows, lists = self.homes(lifted[at : at + 512], copies, closure)
            homes[at + rows, np.arange(len(rows)) - np.searchsorted(rows, rows)] = lists
        near, far = self.search(np.concatenate([q, np.zeros((len(q), 1))], 1), 3)
        reach = np.full((len(q), k), np.inf)  # the distance of the nearest list met that holds a true neighbour
        for i in range(len(q)):
            met = dict(zip(near[i].tolist(), far[i].tolist(), strict=True))
            met[-1] = np.inf
            reach[i] = [min(met.get(h, np.inf) for h in homes[t].tolist()) for t in truth[i]]
        for ratio in (*np.arange(1.0, 2.0, 0.01), np.inf):
            self.ratio = float(ratio)
            if (reach <= far[:, :1] * ratio).mean() >= recall:
                return


def lift(x: np.ndarray, top_norm: float) -> np.ndarray:
    return np.concatenate([x, np.sqrt(np.maximum(top_norm**2 - (x * x).sum(1), 0))[:, None]], 1)


def _usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    v = F.col("v")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(v, lambda c: c != 0)
    return vectors.select(vectors[id_column].alias("id"), vectors[vector_column].cast("array<double>").alias("v")).where(F.col("id").isNotNull() & v.isNotNull()).where(F.coalesce(finite, F.lit(False)))


def search(vectors: DataFrame, is_query: Column, *, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding", recall: float = 0.97, copies: int = 3, closure: float = 1.1, sample_rows: int = 8000, per_list: int = 16, chunk: int = 8192) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates found for each row of vectors that is_query holds for."""
    spark, ws = vectors.sparkSession, Workspace(vectors.sparkSession, "ann")
    usable = _usable(vectors, id_column, vector_column)
    kind = usable.schema["id"].dataType.simpleString()
    schema = f"query_id {kind}, rank int, vec_id {kind}, score double"
    norm = F.max(F.aggregate("v", F.lit(0.0), lambda t, c: t + c * c))
    lengths = usable.groupBy(F.size("v").alias("dim")).agg(norm.alias("top"), F.count("*").alias("n"), F.approx_count_distinct("id").alias("ids"))
    stats = lengths.orderBy(F.desc("n"), F.desc("dim")).first()
    if stats is None:
        return spark.createDataFrame([], schema)
    usable = usable.where(F.size("v") == stats.dim)
    n_lists = int(max(64, np.sqrt(stats.n) / 4))
    wanted = max(sample_rows, per_list * n_lists)
    share = min(1.0, 1.3 * wanted / max(1, stats.ids))  # of the ids, before anything is ordered: what reaches the driver doesn't grow with tasks
    spot = F.pmod(F.xxhash64("id"), F.lit(1 << 20))
    drawn = usable.where(spot < int(np.ceil(share * (1 << 20)))).groupBy("id").agg(F.min("v").alias("v"))
    sample = np.array([r.v for r in drawn.orderBy(F.xxhash64("id"), "id").limit(wanted).select("v").collect()])
    index = Index.build(sample, n_lists, float(np.sqrt(stats.top)) * (1 + 1e-12))
    index.calibrate(sample, k, recall, copies, closure)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                r, lists = index.homes(lift(_matrix(part.column(1)), index.top_norm), copies, closure)
                yield pa.RecordBatch.from_arrays([pa.array(lists.astype(np.int32)), part.column(0).take(pa.array(r)), part.column(1).take(pa.array(r))], ["list", "id", "v"])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                x = _matrix(part.column(1))
                r, lists = index.visits(np.concatenate([x, np.zeros((len(x), 1))], 1), sizes, 4 * copies * (k + 1))
                yield pa.RecordBatch.from_arrays([pa.array(lists.astype(np.int32)), part.column(0).take(pa.array(r)), part.column(1).take(pa.array(r))], ["list", "id", "v"])

    placed = ws.save(usable.mapInArrow(place, f"list int, id {kind}, v array<double>"), "lists")
    chunks = ws.save(placed.groupBy("list").agg(F.countDistinct("id").alias("n"), F.count("*").alias("rows")).select("list", "n", F.ceil(F.col("rows") / chunk).cast("int").alias("chunks")), "sizes")
    sizes = np.zeros(len(index.centres), np.int64)
    for r in chunks.collect():  # at most one row per centroid
        sizes[r["list"]] = r.n
    chunks = chunks.drop("n")
    queries = vectors.where(is_query).select(vectors[id_column].alias("id")).distinct()
    queries = usable.join(queries, "id", "left_semi").groupBy("id").agg(F.min("v").alias("v"))
    asked = queries.mapInArrow(visit, f"list int, id {kind}, v array<double>").join(F.broadcast(chunks), "list")
    asked = asked.select("list", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(True).alias("asks"), "id", "v")
    held = placed.join(F.broadcast(chunks), "list").select("list", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int").alias("chunk"), F.lit(False).alias("asks"), "id", "v")
    units = held.unionByName(asked).repartition("list", "chunk").sortWithinPartitions("list", "chunk", "asks")

    def best(q_ids: list, q: np.ndarray, ids: list, v: np.ndarray) -> list[tuple]:
        out, scores = [], q @ v.T
        for i, q_id in enumerate(q_ids):
            row, take = scores[i], k + 1
            while True:  # rows that repeat an id are one candidate: more are picked until there are k ids
                if len(row) > take:
                    edge = np.partition(row, len(row) - take)[len(row) - take]
                    picked = np.flatnonzero(row >= edge - 1e-9 * max(1.0, abs(edge)))
                else:
                    picked = np.arange(len(row))
                top: dict = {}
                for s, j in zip((v[picked] * q[i]).sum(1).tolist(), picked, strict=True):
                    if ids[j] != q_id and s > top.get(ids[j], -np.inf):
                        top[ids[j]] = s
                if len(top) >= k or len(picked) == len(row):
                    break
                take *= 4
            found = sorted((-s, vec) for vec, s in top.items())
            out += [(q_id, vec, -s) for s, vec in found[:k]]
        return out

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, ids, parts, v = None, [], [], None
        for batch in batches:
            keys = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns[:3]], 1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1), len(keys)] if len(keys) else []
            for a, b in zip(cuts, cuts[1:], strict=False):
                here, part = tuple(keys[a, :2]), batch.slice(a, b - a)
                if here != unit:
                    unit, ids, parts, v = here, [], [], None
                if not keys[a, 2]:
                    ids += part.column(3).to_pylist()
                    parts.append(_matrix(part.column(4)))
                    v = None
                    continue
                if not parts:
                    continue
                v = np.concatenate(parts) if v is None else v
                for at in range(0, b - a, 256):
                    block = part.slice(at, 256)
                    if found := best(block.column(3).to_pylist(), _matrix(block.column(4)), ids, v):
                        columns = list(zip(*found, strict=True))
                        yield pa.RecordBatch.from_arrays([pa.array(columns[0], batch.schema.field(3).type), pa.array(columns[1], batch.schema.field(3).type), pa.array(columns[2], pa.float64())], ["query_id", "vec_id", "score"])

    found = units.mapInArrow(score, f"query_id {kind}, vec_id {kind}, score double").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
