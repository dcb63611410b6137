"""Quality classifier: a byte-level convolutional network in numpy.

Learned filters run over overlapping chunks that together cover the whole UTF-8
text; each filter is max-pooled over every position of every chunk, and a logistic
unit combines the pooled values into one probability. A byte enters as a learned
embedding of its value and of one bit telling whether its word repeats the word
before it, which no filter of bounded width could see by itself.

Training happens on the driver, on a bounded sample of labelled rows
(``sample_rows``, chosen by a hash of the id), of whole texts. Scoring is one Arrow map over the
table: no shuffle, memory bounded by a batch, lost tasks are redone.

Defined cases: null text counts as empty; the empty text is scored like any other
(it has one padded chunk); very long texts are read chunk by chunk to their end; null ids pass through; repeated rows are scored
each and learned from once; labels that are null or not 0/1 are not used; an id with both labels counts as either; a score equal
to a cutoff is over it; with labels of one class only (or none)
the score is that class's share (0.5 without any); empty tables give empty results;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import ArrowUDFType
from pyspark.sql.types import DoubleType
from pyspark.sql.window import Window

from millrace.llm.bytewords import Words, release, sub_batches

WIDTH, STRIDE, DIM = 12, 4, 6
CHUNK, OVERLAP = 4096, WIDTH - STRIDE


def held_out(doc_id: Column) -> Column:
    """The evaluation fold: crc32 of the id as text, divisible by five."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> list[tuple[str, int]]:
    """A bounded, class-balanced sample of labelled whole texts outside the evaluation fold, by hash of the id.

    At most ``rows`` labelled ids are drawn, half of each class, from those whose documents exist; of rows that repeat an id, the text
    that is least by hash is taken once. That is the only bound on what is learned from; scoring has none.
    """
    usable = labels.select(labels["doc_id"].alias("doc_id"), labels[label].cast("int").alias("y")).where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("doc_id"))).distinct()
    texts = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    there = usable.join(texts.select("doc_id"), "doc_id", "left_semi")
    # Thinned by hash before anything is ordered: what is sorted in one task doesn't grow with the labels.
    share = {r.y: min(1.0, 1.5 * (rows // 2) / r.n) for r in there.groupBy("y").agg(F.count("*").alias("n")).collect()}
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    thin = there.where(spot < F.when(F.col("y") == 1, math.ceil(share.get(1, 1.0) * (1 << 20))).otherwise(math.ceil(share.get(0, 1.0) * (1 << 20))))
    place = F.row_number().over(Window.partitionBy("y").orderBy(spot, "doc_id"))
    drawn = thin.withColumn("n", place).where(F.col("n") <= rows // 2).select("doc_id", "y").collect()
    if not drawn:
        return []
    keys = docs.sparkSession.createDataFrame([tuple(r) for r in drawn], there.schema)  # at most `rows` rows
    found = texts.join(F.broadcast(keys), "doc_id").select("doc_id", "y", F.coalesce("text", F.lit("")).alias("text"))
    chosen = found.groupBy("doc_id", "y").agg(F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text"))
    return [(r.text, r.y) for r in sorted(chosen.collect(), key=lambda r: (r.doc_id, r.text))]


def _symbols(words: Words) -> np.ndarray:
    """A symbol of 0-511 for each byte: its value, plus 256 where its word repeats the word before it."""
    out = words.data.astype(np.int16)
    n = len(words)
    if n > 1:
        h = words.hashes()
        same = np.flatnonzero((h[1:] == h[:-1]) & ~np.isin(np.arange(1, n), words.first[1:-1])) + 1
        steps = np.zeros(len(out) + 1, dtype=np.int8)
        steps[words.starts[same]] += 1
        steps[words.ends[same]] -= 1
        out += np.cumsum(steps[:-1], dtype=np.int16) * 256
    return out


@dataclass
class ByteConvolution:
    embedding: np.ndarray  # 512 x DIM
    filters: np.ndarray  # WIDTH * DIM x F
    bias: np.ndarray  # F
    out: np.ndarray  # F
    out_bias: float

    @classmethod
    def fresh(cls, n_filters: int, seed: int) -> ByteConvolution:
        rng = np.random.default_rng(seed)
        low = rng.normal(0, 0.3, (256, DIM))
        return cls(np.concatenate([low, low]).astype(np.float32), rng.normal(0, (2 / (WIDTH * DIM)) ** 0.5, (WIDTH * DIM, n_filters)).astype(np.float32), np.zeros(n_filters, np.float32), rng.normal(0, 0.3, n_filters).astype(np.float32), 0.0)

    def _maps(self, symbols: np.ndarray) -> np.ndarray:
        """Filter responses at the windows of one chunk."""
        need = max(WIDTH, -(-(len(symbols) - WIDTH) // STRIDE) * STRIDE + WIDTH)
        x = self.embedding[symbols]
        if need > len(symbols):
            x = np.concatenate([x, np.repeat(self.embedding[32][None], need - len(symbols), 0)])
        rows = (need - WIDTH) // STRIDE + 1
        view = np.lib.stride_tricks.as_strided(x, (rows, WIDTH * DIM), (STRIDE * DIM * x.itemsize, x.itemsize), writeable=False)
        return view @ self.filters

    def pool(self, symbols: np.ndarray, track: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Each filter's maximum over all chunks of a text and, if asked to track them, the windows they came from."""
        best, where = np.full(self.filters.shape[1], -np.inf, np.float32), np.zeros(self.filters.shape[1], np.int64)
        for start in range(0, max(1, len(symbols) - OVERLAP), CHUNK - OVERLAP):
            maps = self._maps(symbols[start : start + CHUNK])
            if not track:
                np.maximum(best, maps.max(0), out=best)
                continue
            at = maps.argmax(0)
            top = maps[at, np.arange(len(at))]
            better = top > best
            best[better] = top[better]
            where[better] = start // STRIDE + at[better]
        return best, where

    def probability(self, pooled: np.ndarray) -> np.ndarray:
        z = np.maximum(pooled + self.bias, 0) @ self.out + self.out_bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(rows: list[tuple[str, int]], *, n_filters: int = 16, epochs: int = 6, batch: int = 32, rate: float = 0.01, seed: int = 7, least_steps: int = 300) -> ByteConvolution | float:
    """Fits the network with Adam; the gradient of a max reaches only the window that won it."""
    y = np.array([r[1] for r in rows], dtype=np.float32)
    if len(rows) == 0 or y.min() == y.max():
        return float(y.mean()) if len(rows) else 0.5
    net, rng = ByteConvolution.fresh(n_filters, seed), np.random.default_rng(seed)
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())).astype(np.float32)
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k in ("embedding", "filters", "bias", "out") for v in [getattr(net, k)]} | {"out_bias": [0.0, 0.0]}
    step = 0
    for _ in range(max(epochs, -(-least_steps * batch // len(rows)))):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), batch):
            ids = order[lo : lo + batch]
            grads = {k: np.zeros_like(getattr(net, k)) for k in ("embedding", "filters", "bias", "out")} | {"out_bias": 0.0}
            for i in ids:
                words = Words([rows[i][0].encode("utf-8", "replace")])
                symbols = _symbols(words)
                best, where = net.pool(symbols)
                act = np.maximum(best + net.bias, 0)
                err = (net.probability(best) - y[i]) * weight[i] / len(ids)
                grads["out"] += err * act
                grads["out_bias"] += float(err)
                back = (err * net.out * (act > 0)).astype(np.float32)
                grads["bias"] += back
                at = where[:, None] * STRIDE + np.arange(WIDTH)
                won = np.where(at < len(symbols), symbols[np.minimum(at, len(symbols) - 1)], 32)  # F x WIDTH
                grads["filters"] += net.embedding[won].reshape(n_filters, -1).T * back
                np.add.at(grads["embedding"], won, (net.filters.T * back[:, None]).reshape(n_filters, WIDTH, DIM))
            step += 1
            for k, g in grads.items():
                v = getattr(net, k)
                g = g + 1e-4 * v * (k != "out_bias")
                m = moments[k]
                m[0] = 0.9 * m[0] + 0.1 * g
                m[1] = 0.99 * m[1] + 0.01 * g * g
                setattr(net, k, v - rate * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-7))
    return net


def score_texts(net: ByteConvolution | float, texts: list[bytes]) -> np.ndarray:
    if isinstance(net, float):
        return np.full(len(texts), net)
    words = Words(texts)
    symbols = _symbols(words)
    pooled = [net.pool(symbols[a:b], track=False)[0] for a, b in zip(words.offsets, words.offsets[1:], strict=False)]
    return net.probability(np.array(pooled)).astype(float) if pooled else np.zeros(0)


def score(docs: DataFrame, net: ByteConvolution | float, *, keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns of docs (by default doc_id) and ``score``, the probability of good quality of the whole text.

    Only texts go to Python and only scores come back; the other columns stay on the JVM side.
    """

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in texts:
            batch = pa.RecordBatch.from_arrays([array], ["text"])
            scores = [score_texts(net, part) for _, part in sub_batches(batch, "text", 1 << 18)]
            yield pa.array(np.concatenate(scores) if scores else [], pa.float64())
        release()

    scored = F.arrow_udf(run, DoubleType(), ArrowUDFType.SCALAR_ITER)
    return docs.select(*[docs[c] for c in keep or ["doc_id"]], scored(docs["text"]).alias("score"))


def fit(docs: DataFrame, labels: DataFrame, *, sample_rows: int = 3000) -> ByteConvolution | float:
    return train(training_rows(docs, labels, "quality", sample_rows))
