"""Toxicity: a convolutional text classifier over hashed word embeddings, in numpy.

A word's vector is the sum of learned embeddings of hashes of the word and of its
first four, five and six bytes, so that inflected forms share what was learned.
Filters of widths 1, 2 and 3 run over the words of the whole text and are
max-pooled; a logistic unit combines them. Thresholds are calibrated by language,
on scores that every labelled row got from a network trained without it (``FOLDS`` networks, each trained without one part
of the rows). Each language's threshold, of any number of rows, is drawn toward the one of all rows, the more the fewer rows of
its rarer class it has (``PRIOR`` of them weigh as much as all rows). The language is guessed from the text's
own function words, never read from a column, and the threshold is folded into
the score: 0.5 is the calibrated threshold of the guessed language.

Networks are trained beside each other, a task each, on a bounded sample (``sample_rows``) of whole texts. Scoring is one
Arrow map: no shuffle, memory bounded by a batch.

Defined cases: null or wordless text has one empty window and is scored like any other; very long texts
are scored whole; null ids pass through; repeated rows are scored each and learned from once; labels that are null or not 0/1
are not used; an id with both labels counts as either; a score equal to the threshold is over it; languages that tie in
function words go to the first in the list; with one class only (or none) the score is that class's share (0.5
without any); empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.bytewords import Words, release, sub_batches
from millrace.llm.quality_cnn import training_rows

# Common function words by language.
FUNCTION_WORDS = {
    "en": "the of and to in is that for it with as was on are by this be from at or an he not".split(),
    "de": "der die und das ist nicht mit von den des im zu für ein eine sich dem als auf auch".split(),
    "fr": "le la les des et un une est que pour dans pas par sur au aux ne ce qui en du".split(),
    "es": "el los las y por con para se del que una al lo su no como más o en un la".split(),
}
WIDTHS = (1, 2, 3)
FOLDS, PRIOR = 4, 10
PREFIXES = (4, 5, 6)
_PUNCTUATION = np.zeros(256, dtype=bool)
_PUNCTUATION[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True
_LANGUAGES = list(FUNCTION_WORDS)
_FUNCTION_HASHES = {k: Words([" ".join(v).encode()]).hashes() for k, v in FUNCTION_WORDS.items()}


def features(texts: list[bytes], buckets: int) -> list[tuple[np.ndarray, int]]:
    """For each text its words' embedding rows (words x 4) and the index of its guessed language (-1: none)."""
    words = Words(texts, lower=True)
    starts, ends = words.starts.copy(), words.ends.copy()
    while (trim := (ends > starts) & _PUNCTUATION[words.data[ends - 1]]).any():
        ends[trim] -= 1
    while (trim := (ends > starts) & _PUNCTUATION[words.data[np.minimum(starts, len(words.data) - 1)]]).any():
        starts[trim] += 1
    whole = words.span_hash(starts, ends)
    rows = np.stack([whole, *[words.span_hash(starts, np.minimum(ends, starts + p)) + np.uint64(p) for p in PREFIXES]], 1) % np.uint64(buckets)
    seen = np.stack([np.isin(whole, h) for h in _FUNCTION_HASHES.values()]).astype(np.int32)
    counts = np.concatenate([np.zeros((len(seen), 1), np.int32), np.cumsum(seen, 1, dtype=np.int32)], 1)
    out = []
    for a, b in zip(words.first, words.first[1:], strict=False):
        votes = counts[:, b] - counts[:, a]
        out.append((rows[a:b].astype(np.int64), int(votes.argmax()) if votes.max() else -1))
    return out


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-9, 1 - 1e-9)
    return np.log(p / (1 - p))


@dataclass
class WordConvolution:
    table: np.ndarray  # buckets x d
    filters: list[np.ndarray]  # for each width, width * d x F
    bias: np.ndarray  # all filters
    out: np.ndarray
    out_bias: float = 0.0
    thresholds: dict[int, float] = field(default_factory=dict)  # by language index; -1 for the rest

    @classmethod
    def fresh(cls, buckets: int, dim: int, n_filters: int, seed: int) -> WordConvolution:
        rng = np.random.default_rng(seed)
        table = rng.normal(0, 0.02, (buckets, dim)).astype(np.float32)
        filters = [rng.normal(0, (1 / (w * dim)) ** 0.5, (w * dim, n_filters)).astype(np.float32) for w in WIDTHS]
        n = n_filters * len(WIDTHS)
        return cls(table, filters, np.zeros(n, np.float32), np.abs(rng.normal(0, 0.3, n)).astype(np.float32) * rng.choice([-1, 1], n).astype(np.float32))

    def pool(self, rows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Each filter's maximum over the text, and the windows they came from by width."""
        x = self.table[rows[:, 0]] + self.table[rows[:, 1]] + self.table[rows[:, 2]] + self.table[rows[:, 3]]
        if len(x) < WIDTHS[-1]:
            x = np.concatenate([x, np.zeros((WIDTHS[-1] - len(x), self.table.shape[1]), np.float32)])
        best, where = [], []
        for width, f in zip(WIDTHS, self.filters, strict=True):
            view = np.lib.stride_tricks.as_strided(x, (len(x) - width + 1, width * x.shape[1]), x.strides, writeable=False)
            maps = view @ f
            where.append(maps.argmax(0))
            best.append(maps[where[-1], np.arange(f.shape[1])])
        return np.concatenate(best), where

    def raw(self, pooled: np.ndarray) -> np.ndarray:
        z = np.maximum(pooled + self.bias, 0) @ self.out + self.out_bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def scores(self, feats: list[tuple[np.ndarray, int]], calibrated: bool = True) -> np.ndarray:
        if not feats:
            return np.zeros(0)
        p = self.raw(np.stack([self.pool(rows)[0] for rows, _ in feats])).astype(float)
        if not calibrated:
            return p
        t = np.array([self.thresholds.get(lang, self.thresholds[-1]) for _, lang in feats])
        return 1 / (1 + np.exp(-(_logit(p) - _logit(t))))


def _threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The threshold with fewest errors, weighted as if negatives were nine times as common as positives, in the middle of its range."""
    order = np.argsort(p)
    z, t = _logit(p[order]), y[order]
    cost = 9 * max(1, (t == 1).sum()) / max(1, (t == 0).sum())
    wrong = np.concatenate([[0], np.cumsum(t)]) + cost * ((t == 0).sum() - np.concatenate([[0], np.cumsum(t == 0)]))
    best = np.flatnonzero(wrong == wrong.min())
    edges = np.concatenate([[z[0] - 2], (z[1:] + z[:-1]) / 2, [z[-1] + 2]])
    return float(np.clip(1 / (1 + np.exp(-edges[best[len(best) // 2]])), 0.05, 0.95))


def _optimised(feats: list[tuple[np.ndarray, int]], y: np.ndarray, used: np.ndarray, *, buckets: int, dim: int, n_filters: int, epochs: int, batch: int, rate: float, seed: int, least_steps: int) -> WordConvolution:
    """A network fitted to the used rows by Adagrad; the gradient of a max reaches only the window that won it."""
    net, rng, share = WordConvolution.fresh(buckets, dim, n_filters, seed), np.random.default_rng(seed), float(y[used].mean())
    weight = np.where(y == 1, 0.5 / max(share, 1e-3), 0.5 / max(1 - share, 1e-3))
    used = rng.permutation(used)
    sums = {"table": np.full(net.table.shape, 1e-4, np.float32), "bias": np.full_like(net.bias, 1e-4), "out": np.full_like(net.out, 1e-4), "filters": [np.full_like(f, 1e-4) for f in net.filters]}
    bias_sum = 1e-4
    for _ in range(max(epochs, -(-least_steps * batch // len(used)))):
        for lo in range(0, len(used), batch):
            ids = used[lo : lo + batch]
            g_bias, g_out, g_filters, g_b = np.zeros_like(net.bias), np.zeros_like(net.out), [np.zeros_like(f) for f in net.filters], 0.0
            touched, g_rows = [], []
            for i in ids:
                rows_i = feats[i][0]
                pooled, where = net.pool(rows_i)
                act = np.maximum(pooled + net.bias, 0)
                err = float((net.raw(pooled) - y[i]) * weight[i] / len(ids))
                g_out += err * act
                g_b += err
                back = (err * net.out * (act > 0)).astype(np.float32)
                g_bias += back
                for w, width in enumerate(WIDTHS):
                    b = back[w * n_filters : (w + 1) * n_filters]
                    at = where[w][:, None] + np.arange(width)  # F x width
                    inside = at < len(rows_i)
                    rows_at = rows_i[np.minimum(at, max(0, len(rows_i) - 1))] if len(rows_i) else np.zeros((*at.shape, 4), np.int64)
                    x = net.table[rows_at].sum(2) * inside[..., None]
                    g_filters[w] += x.reshape(n_filters, -1).T * b
                    g = (net.filters[w].T * b[:, None]).reshape(n_filters, width, dim) * inside[..., None]
                    touched.append(rows_at.reshape(-1))
                    g_rows.append(np.repeat(g[:, :, None, :], 4, 2).reshape(-1, dim))
            at, back = np.unique(np.concatenate(touched), return_inverse=True)
            total = np.zeros((len(at), dim), np.float32)
            np.add.at(total, back, np.concatenate(g_rows))
            sums["table"][at] += total * total
            net.table[at] -= rate * total / np.sqrt(sums["table"][at])
            for k, g in (("bias", g_bias), ("out", g_out)):
                sums[k] += g * g
                setattr(net, k, getattr(net, k) - rate * g / np.sqrt(sums[k]))
            for f, s, g in zip(net.filters, sums["filters"], g_filters, strict=True):
                s += g * g
                f -= rate * g / np.sqrt(s)
            bias_sum += g_b * g_b
            net.out_bias -= rate * g_b / bias_sum**0.5
        used = rng.permutation(used)
    return net


def train_part(rows: list[tuple[str, int]], part: int, *, buckets: int = 1 << 16, dim: int = 8, n_filters: int = 8, epochs: int = 8, batch: int = 32, rate: float = 0.05, seed: int = 11, least_steps: int = 600) -> WordConvolution | tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One of the networks: for a part under FOLDS (rows, scores, languages) of the rows left out; for FOLDS, the network of all rows."""
    y, feats = np.array([r[1] for r in rows]), [features([r[0].encode("utf-8", "replace")], buckets)[0] for r in rows]
    fold = np.random.default_rng(seed).permutation(len(rows)) % FOLDS
    used, left = np.flatnonzero(fold != part), np.flatnonzero(fold == part)
    options = {"buckets": buckets, "dim": dim, "n_filters": n_filters, "epochs": epochs, "batch": batch, "rate": rate, "seed": seed, "least_steps": least_steps}
    if part == FOLDS:
        return _optimised(feats, y, used, **options)
    langs = np.array([feats[i][1] for i in left], int)
    if not len(used) or y[used].min() == y[used].max():
        return left, np.full(len(left), float(y.mean())), langs
    return left, _optimised(feats, y, used, **options).scores([feats[i] for i in left], calibrated=False), langs


def calibrated(net: WordConvolution, y: np.ndarray, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> WordConvolution:
    """net with a threshold for every language and one (-1) for texts of none, from the scores of rows left out."""
    at, p, langs = (np.concatenate([part[k] for part in parts]) for k in range(3))
    y = y[at]
    common = _threshold(p, y)
    net.thresholds = {-1: common}
    for k in range(len(_LANGUAGES)):
        own = langs == k
        n = min((y[own] == 1).sum(), (y[own] == 0).sum())
        z = (n * _logit(np.array(_threshold(p[own], y[own]) if n else common)) + PRIOR * _logit(np.array(common))) / (n + PRIOR)
        net.thresholds[k] = float(1 / (1 + np.exp(-z)))
    return net


def _trivial(rows: list[tuple[str, int]]) -> float | None:
    """The share of ones, if there is only one class or none."""
    y = [r[1] for r in rows]
    return None if len(set(y)) > 1 else float(np.mean(y)) if y else 0.5


def train(rows: list[tuple[str, int]], **options: float) -> WordConvolution | float:
    """The calibrated network of labelled rows, trained in this process."""
    if (share := _trivial(rows)) is not None:
        return share
    return calibrated(train_part(rows, FOLDS, **options), np.array([r[1] for r in rows]), [train_part(rows, k, **options) for k in range(FOLDS)])


def fit(docs: DataFrame, labels: DataFrame, *, sample_rows: int = 6000, **options: float) -> WordConvolution | float:
    """The same, each network in a task of its own; rows are a bounded sample, sent to the tasks whole."""
    rows = training_rows(docs, labels, "toxic", sample_rows)
    if (share := _trivial(rows)) is not None:
        return share
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([pickle.dumps(train_part(shared.value, k, **options)) for k in parts], pa.binary())], ["id", "made"])
        release()

    made = spark.range(0, FOLDS + 1, 1, FOLDS + 1).mapInArrow(run, "id long, made binary").collect()  # FOLDS + 1 rows
    shared.unpersist()
    made = {r.id: pickle.loads(r.made) for r in made}
    return calibrated(made.pop(FOLDS), np.array([r[1] for r in rows]), [made[k] for k in sorted(made)])


def score_texts(net: WordConvolution | float, texts: list[bytes]) -> tuple[np.ndarray, list[str]]:
    """Calibrated scores and guessed languages."""
    feats = features(texts, 1 if isinstance(net, float) else len(net.table))
    scores = np.full(len(texts), net) if isinstance(net, float) else net.scores(feats)
    return scores, [_LANGUAGES[k] if k >= 0 else "other" for _, k in feats]


def score(docs: DataFrame, net: WordConvolution | float, *, keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (by default doc_id), ``score`` and ``language_guess`` of every whole text."""
    keep = keep or ["doc_id"]
    source = docs.select(*[docs[c] for c in keep], docs["text"].alias("__text"))
    schema = source.drop("__text").schema.add("score", "double").add("language_guess", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                parts = [score_texts(net, texts) for _, texts in sub_batches(batch, "__text", 1 << 18)]
                arrays = [*batch.columns[:-1], pa.array(np.concatenate([s for s, _ in parts]), pa.float64()), pa.array([x for _, g in parts for x in g], pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, [*keep, "score", "language_guess"])

    return source.mapInArrow(run, schema)
