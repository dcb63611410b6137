"""MinHash near-duplicate detection with sequential Bayesian verification.

1. One Arrow pass gives each text its shingle count, a 128-bit digest of its word sequence and a signature of
   ``bands * rows`` minhashes of 16 bits. Equal digests form a class; only one row per class goes on.
2. Classes that agree on a band share a bucket. Its hub is the member that meets most others over all bands, as
   the centre of a group of copies does. Members are compared with hubs, first each with its best one, then with
   the others where that could still join something: linear in the bucket, never all pairs.
3. Candidates are verified in sequence: after each batch of signature positions the posterior of the similarity
   (uniform prior) is consulted, and a pair is pruned once the chance that it reaches the threshold is under
   ``miss``. Survivors are compared exactly, on the full sets of shingles, and give components.
4. What is left are buckets that still hold members of several components. Of these, members of the largest component meet
   only members of the others, and no two of one component meet: one straggler beside n near copies costs n comparisons. They are dealt
   out in bounded chunks, first with their signatures alone, to find which of them survive against any other and what those
   survivors would join; then the survivors only, once each with their texts, to be compared exactly. No task passes on
   more than two rows for each row that it read, however many pairs survive.

A pair over the threshold that shares a bucket is so compared unless its ends are connected already.
Texts are moved once, and only those of members of buckets; those of survivors once more.

With 32 bands of 5 rows a pair at similarity 0.8 shares no bucket with probability 3e-6, and less above.

Defined cases: null text counts as empty; a text without words has no shingles and is linked with nothing; a row
with a null id has no component and is kept; very long texts are read whole; bytes that are not UTF-8 are compared as they are; a pair at exactly the threshold is linked; repeated rows are returned as often as they occur; if an id occurs with different texts, each row keeps
its own shingle count and the id has the links of all its texts; empty tables give empty results; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bytewords import LOWER_BYTES, Words, mix, release, shingles, sub_batches
from millrace.llm.components import components
from millrace.llm.workspace import Workspace


def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_011)
    return rng.integers(1, 1 << 32, n, dtype=np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, n, dtype=np.uint32)


def minhash(h: np.ndarray, begins: np.ndarray, n: int) -> np.ndarray:
    """Signatures (texts x n) of the shingle hashes of texts that have at least one shingle each."""
    x = (h >> np.uint64(32)).astype(np.uint32)
    a, b = _coefficients(n)
    out = np.empty((len(begins) - 1, n), dtype=np.uint32)
    y = np.empty_like(x)
    for k in range(n):
        np.multiply(x, a[k], out=y)
        np.add(y, b[k], out=y)
        out[:, k] = np.minimum.reduceat(y, begins[:-1])
    return out


def _signatures(docs: DataFrame, id_column: str, text_column: str, k: int, n: int) -> DataFrame:
    source = docs.select(docs[id_column].alias("doc_id"), docs[text_column].alias("text"))
    schema = source.drop("text").schema.add("n_shingles", "long").add("digest", "binary").add("signature", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in sub_batches(batch, "text"):
                h, begins = shingles(Words(texts, lower=True), k)
                sizes = np.diff(begins)
                full = np.flatnonzero(sizes)
                distinct = np.zeros(len(texts), dtype=np.int64)
                for i in full:
                    own = np.sort(h[begins[i] : begins[i + 1]])
                    distinct[i] = 1 + np.count_nonzero(own[1:] != own[:-1])
                signs: list[bytes | None] = [None] * len(texts)
                digests: list[bytes | None] = [None] * len(texts)
                if len(full):
                    for i, row in zip(full, minhash(h, np.append(begins[:-1][full], begins[-1]), n), strict=True):
                        signs[i] = row.astype(np.uint16).tobytes()  # the low half
                        digests[i] = hashlib.blake2b(b" ".join(texts[i].translate(LOWER_BYTES).split()), digest_size=16).digest()
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(distinct), pa.array(digests, pa.binary()), pa.array(signs, pa.binary())], ["doc_id", "n_shingles", "digest", "signature"])
        release()

    return source.mapInArrow(run, schema)


def _band_rows(classes: DataFrame, bands: int, rows: int) -> DataFrame:
    """(key, rep) for each band of each class."""
    schema = classes.select("rep").schema.add("key", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                signs = np.frombuffer(b"".join(part.column(1).to_pylist()), dtype=np.uint16).reshape(-1, bands, rows).astype(np.uint64)
                key = np.broadcast_to(np.arange(bands, dtype=np.uint64), signs.shape[:2])
                for r in range(rows):
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + signs[:, :, r])
                reps = part.column(0).take(pa.array(np.repeat(np.arange(part.num_rows), bands)))
                yield pa.RecordBatch.from_arrays([reps, pa.array(key.reshape(-1).view(np.int64))], ["rep", "key"])

    return classes.select("rep", "signature").mapInArrow(run, schema)


def least_matches(n: int, step: int, threshold: float, miss: float) -> dict[int, int]:
    """For each number of compared positions, the matches below which P(similarity >= threshold) < miss."""
    s = np.linspace(0, 1, 20_001)[1:-1]
    out = {}
    for seen in range(step, n + 1, step):
        for m in range(seen + 1):
            log = m * np.log(s) + (seen - m) * np.log1p(-s)
            p = np.exp(log - log.max())
            if p[s >= threshold].sum() / p.sum() >= miss:
                out[seen] = m
                break
    return out


def _survive(x: np.ndarray, y: np.ndarray, bounds: dict[int, int], step: int) -> np.ndarray:
    """Which rows of two signature matrices are never pruned, looking only as far as a row is alive."""
    live, matches = np.arange(len(x)), np.zeros(len(x), np.int64)
    for seen, least in bounds.items():
        matches = matches + (x[live, seen - step : seen] == y[live, seen - step : seen]).sum(1)
        stay = matches >= least
        live, matches = live[stay], matches[stay]
    out = np.zeros(len(x), bool)
    out[live] = True
    return out


def _sequential(pairs: DataFrame, classes: DataFrame, n: int, threshold: float, miss: float, step: int = 20) -> DataFrame:
    """pairs(a, b) with ``near``, the share of equal positions, and ``alive``, whether it survived."""
    bounds = least_matches(n, step, threshold, miss)
    side = lambda c: classes.select(F.col("rep").alias(c), F.col("signature").alias(f"sign_{c}"))
    joined = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "sign_a", "sign_b")  # b may be the hub of many: it meets bare ids
    schema = pairs.select("a", "b").schema.add("near", "double").add("alive", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x, y = (np.frombuffer(b"".join(part.column(i).to_pylist()), dtype=np.uint16).reshape(-1, n) for i in (2, 3))
                alive = _survive(x, y, bounds, step)
                near = (x == y).mean(1)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(near), pa.array(alive)], ["a", "b", "near", "alive"])
        release()

    return joined.mapInArrow(run, schema)


def shingle_set(text: str | bytes | None, k: int) -> frozenset:
    words = (text.encode("utf-8", "replace") if isinstance(text, str) else text or b"").translate(LOWER_BYTES).split()
    return frozenset(zip(*[words[i:] for i in range(k)], strict=False)) if len(words) >= k else frozenset([tuple(words)] if words else [])


def _exact(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Those pairs(a, b) whose full shingle sets have 100 * intersection >= percent * union."""
    side = lambda c: texts.select(F.col("doc_id").alias(c), F.col("text").alias(f"text_{c}"))
    joined = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "text_a", "text_b")  # b may be the hub of many: it meets bare ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lru_cache(maxsize=16)(lambda text: shingle_set(text, k))
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = known(x.as_py()), known(y.as_py())
                common = len(p & q)
                keep.append(100 * common >= percent * (len(p) + len(q) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))
        release()

    return joined.mapInArrow(run, pairs.select("a", "b").schema)


def near_duplicates(docs: DataFrame, *, shingle_words: int = 5, percent: int = 80, bands: int = 32, rows: int = 5, miss: float = 1e-4, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row of docs: doc_id, n_shingles, component_id (smallest id reachable over links) and kept."""
    ws, n, threshold = Workspace(docs.sparkSession, "near"), bands * rows, percent / 100
    signed = ws.save(_signatures(docs, id_column, text_column, shingle_words, n), "signed")
    usable = signed.where("doc_id is not null and digest is not null")
    classes = ws.save(usable.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature")), "classes")
    signed = signed.drop("signature")
    members = _members(ws, classes, bands, rows)
    texts_all = docs.select(docs[id_column].alias("doc_id"), docs[text_column].cast("binary").alias("text"))
    needed = members.select(F.col("rep").alias("doc_id")).distinct().hint("merge")  # no broadcast at any size: the members grow with the table
    texts = ws.save(texts_all.join(needed, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]), "texts")

    spokes = members.where("rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct()
    best = members.where("rep <> hub").groupBy(F.col("rep").alias("a")).agg(F.max_by("hub", F.struct("hub_score", "hub")).alias("b"))
    judged = ws.save(_sequential(best, classes, n, threshold, miss), "best")
    others = _apart(spokes, components(ws, judged.where(F.col("near") >= threshold))).join(judged, ["a", "b"], "left_anti")
    alive = judged.unionByName(_sequential(others, classes, n, threshold, miss)).where("alive").select("a", "b").distinct()
    links = ws.save(_exact(alive, texts, shingle_words, percent).distinct(), "links")
    found = components(ws, links)
    rest = ws.save(_across(members, found, classes, n, threshold, miss).distinct(), "rest")
    if not rest.isEmpty():
        found = components(ws, links.unionByName(_joining(_survivors(ws, rest, found), classes, texts, shingle_words, n, percent, miss)))
    ws.drop(texts)
    roots = classes.join(found, classes["rep"] == found["vertex"], "left").select("digest", F.coalesce("root", "rep").alias("root"))
    out = signed.join(roots, "digest", "left")
    out = out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).alias("component_id"))
    return ws.keep(out.withColumn("kept", F.col("component_id").isNull() | (F.col("doc_id") == F.col("component_id"))))


def _members(ws: Workspace, classes: DataFrame, bands: int, rows: int) -> DataFrame:
    """(key, rep, hub, hub_score) of the buckets with two members or more."""
    banded = _band_rows(classes, bands, rows)
    buckets = banded.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high"), F.count("*").alias("n")).where("low <> high").select("key", "n")
    shared = ws.save(banded.join(buckets, "key").select("key", "rep", "n").distinct(), "shared")
    scores = shared.groupBy("rep").agg(F.sum("n").alias("score"))
    hubs = shared.join(scores, "rep").groupBy("key").agg(F.max(F.struct("score", "rep")).alias("top")).select("key", F.col("top.rep").alias("hub"), F.col("top.score").alias("hub_score"))
    return ws.save(shared.drop("n").join(hubs, "key"), "members")


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Those pairs(a, b) whose ends have different labels (vertex, root); unlabelled ones are their own."""
    side = lambda c: labels.select(F.col("vertex").alias(c), F.col("root").alias(f"root_{c}"))
    joined = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
    return joined.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")


def _grouped(units: DataFrame, keys: list[str], schema: object, compare: Callable[[list[tuple]], list[tuple]]) -> DataFrame:
    """compare's pairs (a, b) for the rows, without keys, of each group; the first column left is the id."""
    k = len(keys)
    units = units.repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, rows, out, kind = None, [], [], None
        for batch in batches:
            kind = batch.schema.field(k).type
            for at in range(0, batch.num_rows, 256):  # a batch of texts is never all Python objects at once
                for row in zip(*[c.to_pylist() for c in batch.slice(at, 256).columns], strict=True):
                    if row[:k] != unit:
                        out += compare(rows)
                        unit, rows = row[:k], []
                    rows.append(row[k:])
        if out := out + compare(rows):
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in out], kind) for i in (0, 1)], ["a", "b"])
        rows.clear()
        release()

    return units.mapInArrow(run, schema)


def _rooted(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """rows(rep, ...) with root, as labels(vertex, root) has it; unlabelled ones are their own."""
    return rows.join(labels.select(F.col("vertex").alias("rep"), "root"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))


def _units(rows: DataFrame, extra: DataFrame, chunk: int) -> DataFrame:
    """rows(key, rep, root) of the keys that hold several roots, with what extra(rep, ...) has of them, dealt to units (key, u, x).

    In each key the largest component is the base. The other members are cut into chunks; each chunk meets each chunk of the base, and
    each other chunk. Base rows are copied once per chunk of the others, never per chunk of the base.
    """
    shares = rows.groupBy("key", "root").agg(F.count("*").alias("n"))
    plan = shares.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("base"), F.max("n").alias("n_base"), F.sum("n").alias("n_all"), F.count("*").alias("roots")).where("roots > 1")
    plan = plan.select("key", "base", F.ceil(F.col("n_base") / chunk).cast("int").alias("bases"), F.ceil((F.col("n_all") - F.col("n_base")) / chunk).cast("int").alias("others"), (F.col("roots") > 2).alias("mixed"))
    placed = rows.join(plan, "key").join(extra, "rep").withColumn("is_base", F.col("root") == F.col("base"))
    placed = placed.withColumn("own", F.pmod(F.xxhash64("rep"), F.when(F.col("is_base"), F.col("bases")).otherwise(F.col("others"))).cast("int"))
    unit = lambda u, x: F.struct(u.cast("int").alias("u"), x.cast("int").alias("x"))
    with_base = F.transform(F.sequence(F.lit(0), F.col("bases") - 1), lambda j: unit(F.col("own"), j))
    with_others = F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda k: unit(F.least(F.col("own"), k), F.col("bases") + F.greatest(F.col("own"), k)))
    of_base = F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda i: unit(i, F.col("own")))
    none = F.array().cast("array<struct<u:int,x:int>>")
    dealt = placed.withColumn("unit", F.explode(F.when(F.col("is_base"), of_base).otherwise(F.concat(with_base, F.when(F.col("mixed"), with_others).otherwise(none)))))
    return dealt.select("key", F.col("unit.u").alias("u"), F.col("unit.x").alias("x"), "rep", "root", "is_base", *[c for c in extra.columns if c != "rep"])


def _surviving(rows: list[tuple], n: int, bounds: dict[int, int], step: int) -> Iterator[tuple[int, np.ndarray]]:
    """(i, those of other components that row i may be linked to, likeliest first) over the rows (rep, root, is_base, signature) of a unit."""
    y = np.frombuffer(b"".join([r[3] for r in rows]), np.uint16).reshape(-1, n)
    base, roots = np.array([r[2] for r in rows], bool), np.unique([r[1] for r in rows], return_inverse=True)[1]
    against = np.flatnonzero(base)
    for i in np.flatnonzero(~base):
        j = against if len(against) else np.flatnonzero(roots[i + 1 :] != roots[i]) + i + 1
        j = j[_survive(np.broadcast_to(y[i], (len(j), n)), y[j], bounds, step)]
        if len(j):
            yield i, j[np.argsort(-(y[j] == y[i]).sum(1), kind="stable")]


class _Joined:
    """Which components a unit has connected."""

    def __init__(self) -> None:
        self.parent: dict = {}

    def root(self, x: object) -> object:
        while x in self.parent:
            x = self.parent[x]
        return x

    def join(self, x: object, y: object) -> None:
        self.parent[self.root(x)] = self.root(y)


def _across(members: DataFrame, labels: DataFrame, classes: DataFrame, n: int, threshold: float, miss: float, chunk: int = 512, step: int = 20) -> DataFrame:
    """Among the members of a bucket that are of different components(vertex, root): (a, a) of each that survives against one
    of another component, and surviving pairs (a, b), enough of them to connect the components that survivors connect."""
    rooted = _rooted(members.select("key", "rep"), labels).select("key", "rep", "root")
    bounds = least_matches(n, step, threshold, miss)

    def compare(rows: list[tuple]) -> list[tuple]:
        if not rows:
            return []
        joined, touched, out = _Joined(), set(), []
        for i, survivors in _surviving(rows, n, bounds, step):
            touched.add(rows[i][0])
            touched.update(rows[j][0] for j in survivors)
            for j in survivors:
                if joined.root(rows[i][1]) != joined.root(rows[j][1]):
                    joined.join(rows[i][1], rows[j][1])
                    out.append((rows[i][0], rows[j][0]))
        return out + [(t, t) for t in touched]

    schema = members.select(F.col("rep").alias("a"), F.col("rep").alias("b")).schema
    return _grouped(_units(rooted, classes.select("rep", "signature"), chunk), ["key", "u", "x"], schema, compare)


def _survivors(ws: Workspace, rest: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, rep, root) of the survivors (a, a) of rest; key is what their components would become if its pairs (a, b) were links."""
    ends = _rooted(_rooted(rest.where("a <> b").select(F.col("a").alias("rep"), "b"), labels).select(F.col("root").alias("ra"), F.col("b").alias("rep")), labels)
    joined = components(ws, ends.select(F.col("ra").alias("a"), F.col("root").alias("b"))).select(F.col("vertex").alias("root"), F.col("root").alias("key"))
    return ws.save(_rooted(rest.where("a = b").select(F.col("a").alias("rep")), labels).join(joined, "root").select("key", "rep", "root"), "survivors")


def _joining(rows: DataFrame, classes: DataFrame, texts: DataFrame, k: int, n: int, percent: int, miss: float, chunk: int = 512, step: int = 20) -> DataFrame:
    """Links (a, b) between different components of a key of rows(key, rep, root), enough of them to connect what links connect."""
    extra = classes.select("rep", "signature").join(texts.select(F.col("doc_id").alias("rep"), "text").join(rows.select("rep").distinct(), "rep", "left_semi"), "rep")
    bounds = least_matches(n, step, percent / 100, miss)

    def compare(rows: list[tuple]) -> list[tuple]:
        if not rows:
            return []
        sets: dict[int, np.ndarray] = {}
        joined, out = _Joined(), []

        def own(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = np.unique(shingles(Words([rows[i][4] or b""], lower=True), k)[0])
            return sets[i]

        for i, survivors in _surviving(rows, n, bounds, step):
            for j in survivors:
                if joined.root(rows[i][1]) != joined.root(rows[j][1]):
                    a, b = own(i), own(j)
                    common = len(np.intersect1d(a, b, assume_unique=True))
                    if 100 * common >= percent * (len(a) + len(b) - common):
                        s, t = shingle_set(rows[i][4], k), shingle_set(rows[j][4], k)
                        if 100 * len(s & t) >= percent * len(s | t):
                            joined.join(rows[i][1], rows[j][1])
                            out.append((max(rows[i][0], rows[j][0]), min(rows[i][0], rows[j][0])))
        return out

    schema = rows.select(F.col("rep").alias("a"), F.col("rep").alias("b")).schema
    return _grouped(_units(rows, extra, chunk), ["key", "u", "x"], schema, compare)
