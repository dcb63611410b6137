"""Evaluation: routing, edit metrics, per-tag scores, paired tests, noise injection and edit replay."""

from __future__ import annotations

import math
import random
from collections import Counter
from collections.abc import Callable
from difflib import SequenceMatcher
from functools import lru_cache
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

from millrace.functions.text import edit_distance, osa_distance
from millrace.operators.generate import bounded, keys_of
from millrace.sources.workspace import Workspace

EDIT = StructType([StructField("op", StringType()), StructField("start", LongType()), StructField("end", LongType()), StructField("words", StringType())])
SPAN = StructType([StructField("start", LongType()), StructField("end", LongType()), StructField("target", StringType())])


@F.pandas_udf(ArrayType(EDIT))
def token_edits(source: pd.Series, target: pd.Series) -> pd.Series:
    """Word edits from source to target, by longest matching blocks (which is not the longest common subsequence).

    The conditions of a sample follow each other and mostly ask the same, so the last pairs are remembered.
    """

    @lru_cache(maxsize=16)
    def one(a: str | None, b: str | None) -> list[dict]:
        if a == b:
            return []
        y = (b or "").split()
        return [{"op": op, "start": i, "end": j, "words": " ".join(y[k:m])} for op, i, j, k, m in word_changes((a or "").split(), y)]

    return pd.Series([one(a, b) for a, b in zip(source, target, strict=True)])


#: Words of passages of which none may stand at two places, for ``word_changes`` to go by places: the first length that will do is taken.
PASSAGES = (2, 3, 4, 6, 9, 14)


def word_changes(x: list[str], y: list[str]) -> list[tuple[str, int, int, int, int]]:
    """(op, start, end, start, end) of what differs between two lists, as SequenceMatcher has it: the longest common passage is matched, then what is left and right of it.

    Where both are of one length, passages at the same places are longest where they are longer than any passage that stands at different places; how long such
    passages may be is told once. Only the windows that are left over, most of them one word, are compared in the general way.
    """
    n, blocks = len(x), []
    moved = _moved(x, y) if n == len(y) else None
    if moved is None:
        blocks = _passages(x, y)
    else:
        ends, before = [i for i in range(n) if x[i] != y[i]], 0
        sure = [(a + 1, b) for a, b in zip([-1, *ends], [*ends, n], strict=True) if b - a - 1 > moved]  # passages at the same places
        for i, j in [*sure, (n, n)]:
            if i - before > 1 or (i > before and x[before] == y[before]):
                blocks += [(before + a, before + b, size) for a, b, size in _passages(x[before:i], y[before:i])]
            blocks.append((i, i, j - i))
            before = j
    out, i, j = [], 0, 0
    for a, b, size in [*sorted(blocks), (n, len(y), 0)]:
        if i < a or j < b:
            out.append(("replace" if i < a and j < b else "delete" if i < a else "insert", i, a, j, b))
        i, j = a + size, b + size
    return out


def _passages(x: list[str], y: list[str]) -> list[tuple[int, int, int]]:
    """(start, start, words) of the passages that SequenceMatcher matches, in any order. It looks at every pair of equal words; where those are many, the longest passage is found without."""
    out, todo = [], [(0, len(x), 0, len(y))]
    while todo:
        a, b, c, d = todo.pop()
        left, right = x[a:b], y[c:d]
        times = Counter(right)
        pairs = sum(n * times[w] for w, n in Counter(left).items())
        if pairs <= 4000 or pairs <= 8 * (b - a + d - c):
            out += [(a + m.a, c + m.b, m.size) for m in SequenceMatcher(None, left, right, autojunk=False).get_matching_blocks() if m.size]
            continue
        i, j, size = _longest_passage(left, right)
        out.append((a + i, c + j, size))
        todo += [w for w in ((a, a + i, c, c + j), (a + i + size, b, c + j + size, d)) if w[0] < w[1] and w[2] < w[3]]
    return out


def _longest_passage(x: list[str], y: list[str]) -> tuple[int, int, int]:
    """The longest passage of both, the first one of x and of y: x is read through the suffix automaton of y, so work is in proportion to the words."""
    steps, links, sizes, ends, last = [{}], [-1], [0], [-1], 0
    for j, word in enumerate(y):
        new, p = len(steps), last
        steps.append({})
        links.append(0)
        sizes.append(j + 1)
        ends.append(j)
        while p >= 0 and word not in steps[p]:
            steps[p][word] = new
            p = links[p]
        if p >= 0:
            q = steps[p][word]
            if sizes[q] > sizes[p] + 1:
                clone = len(steps)
                steps.append(steps[q].copy())
                links.append(links[q])
                sizes.append(sizes[p] + 1)
                ends.append(ends[q])
                while p >= 0 and steps[p].get(word) == q:
                    steps[p][word] = clone
                    p = links[p]
                links[q] = q = clone
            links[new] = q
        last = new
    at, size, best = 0, 0, (0, 0, 0)
    for i, word in enumerate(x):
        while at and word not in steps[at]:
            at = links[at]
            size = sizes[at]
        if word in steps[at]:
            at, size = steps[at][word], size + 1
        if size > best[2]:
            best = (i - size + 1, ends[at] - size + 1, size)
    return best


def _moved(x: list[str], y: list[str]) -> int | None:
    """A bound on the words of any passage of x that stands at another place in y, or nothing if there are long ones."""
    for size in PASSAGES:
        here, there = (list(zip(*[t[k:] for k in range(size)], strict=False)) for t in (x, y))
        known = set(there)
        if len(known) == len(there) and not any(a in known for a, b in zip(here, there, strict=True) if a != b):
            return size - 1
    return None


@F.pandas_udf(ArrayType(SPAN))
def character_edits(source: pd.Series, target: pd.Series) -> pd.Series:
    """Character edits (start, end in source, replacement) that turn source into target."""

    def one(a: str | None, b: str | None) -> list[dict]:
        a, b = a or "", b or ""
        return [{"start": i, "end": j, "target": b[k:m]} for op, i, j, k, m in SequenceMatcher(None, a, b, autojunk=False).get_opcodes() if op != "equal"]

    return pd.Series([one(a, b) for a, b in zip(source, target, strict=True)])


def apply_edits(text: Column, edits: Column) -> Column:
    """text with edits(start, end, target) applied from the right; null if two of them overlap or one is out of bounds."""
    ordered = F.sort_array(edits)
    bad = F.exists(edits, lambda e: (e["start"] < 0) | (e["end"] < e["start"]) | (e["end"] > F.length(text)))
    pairs = F.arrays_zip(F.slice(ordered, F.lit(1), F.greatest(F.size(ordered) - 1, F.lit(0))).alias("a"), F.slice(ordered, F.lit(2), F.size(ordered)).alias("b"))
    overlap = F.exists(pairs, lambda p: p["b"]["start"] < p["a"]["end"])
    done = F.aggregate(F.reverse(ordered), text, lambda t, e: F.concat(F.left(t, e["start"]), e["target"], F.substring(t, e["end"] + 1, F.length(t))))
    return F.when(~bad & ~overlap, done)


def precision(tp: Column, fp: Column, fn: Column) -> Column:
    return F.when(tp + fp > 0, tp / (tp + fp)).when(fn == 0, F.lit(1.0)).otherwise(F.lit(0.0))


def recall(tp: Column, fn: Column) -> Column:
    return F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(1.0))


def f_half(p: Column, r: Column) -> Column:
    """F of beta one half: precision counts for more."""
    return F.when(0.25 * p + r > 0, 1.25 * p * r / (0.25 * p + r)).otherwise(F.lit(0.0))


def with_edit_counts(df: DataFrame, source: str, gold: str, output: str) -> DataFrame:
    """df with tp, fp, fn of the word edits of output against those of gold (as sets)."""
    df = df.withColumns({"__g": token_edits(source, gold), "__p": token_edits(source, output)})
    tp = F.size(F.array_intersect("__g", "__p"))
    return df.withColumns({"tp": tp.cast("long"), "fp": (F.size(F.array_distinct("__p")) - tp).cast("long"), "fn": (F.size(F.array_distinct("__g")) - tp).cast("long")}).drop("__g", "__p")


def scores(df: DataFrame, *by: str) -> DataFrame:
    """Totals of tp, fp, fn with precision, recall and F0.5, per group."""
    out = df.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")], F.count("*").alias("n"))
    p, r = precision(F.col("tp"), F.col("fp"), F.col("fn")), recall(F.col("tp"), F.col("fn"))
    return out.withColumns({"precision": p, "recall": r, "f_half": f_half(p, r)})


def summary(df: DataFrame, source: str, gold: str, output: str, *by: str) -> DataFrame:
    """One row per group: scores of word edits, exact matches, errors before and after, their reduction, and mean distances of output to gold."""
    counted = with_edit_counts(df, source, gold, output)
    changed = F.col(output) != F.col(gold)
    left = token_edits(F.when(changed, F.col(output)), F.when(changed, F.col(gold)))
    counted = counted.withColumns(
        {
            "__exact": (~changed).cast("long"),
            "__before": F.col("tp") + F.col("fn"),
            "__after": F.when(changed, F.size(F.array_distinct(left))).otherwise(0),
            "__levenshtein": edit_distance(F.col(output), F.col(gold)),
            "__osa": F.coalesce(osa_distance(F.when(changed, F.col(output)), F.col(gold)), F.lit(0)),
        }
    )
    sums = {"tp": "tp", "fp": "fp", "fn": "fn", "n_exact": "__exact", "errors_before": "__before", "errors_after": "__after", "__l": "__levenshtein", "__o": "__osa"}
    out = counted.groupBy(*by).agg(F.count("*").alias("n"), *[F.coalesce(F.sum(v), F.lit(0)).cast("long").alias(k) for k, v in sums.items()])
    p, r = precision(F.col("tp"), F.col("fp"), F.col("fn")), recall(F.col("tp"), F.col("fn"))
    share = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    return out.withColumns(
        {
            "precision": p,
            "recall": r,
            "f_half": f_half(p, r),
            "exact_rate": share(F.col("n_exact"), F.col("n")),
            "error_reduction_rate": share(F.col("errors_before") - F.col("errors_after"), F.col("errors_before")),
            "mean_distance": share(F.col("__l"), F.col("n")),
            "mean_osa_distance": share(F.col("__o"), F.col("n")),
        }
    ).drop("__l", "__o")


BASELINES = {"raw_to_final": "raw", "gec_input": "gec_input"}


def breakdown(routed: DataFrame, field: str, *, baseline: str = "raw_to_final") -> DataFrame:
    """summary of routed(raw, gec_input, gec_output, gold, source_type, field) per condition and value of field (each of an array's), without clean controls.

    The baseline is what edits are counted from: the raw text (end to end), or what the corrector was given.
    """
    rows = routed.where(~F.coalesce(F.col("source_type") == "clean_control", F.lit(False)))
    value = F.explode(field) if isinstance(rows.schema[field].dataType, ArrayType) else F.col(field)
    return summary(rows.withColumn("value", value), BASELINES[baseline], "gold", "gec_output", "condition", "value")


def normalization_breakdowns(samples: DataFrame, predictions: DataFrame) -> DataFrame:
    """summary of normaliser outputs (condition B) against gold normalisations: whole, by type and by whether the rule was seen.

    samples: sample_id, source_type, raw, gold_normalised, normalization_types, normalization_rule_seen_status. The exact rate is accuracy at 1.
    """
    rows = samples.where(~F.coalesce(F.col("source_type") == "clean_control", F.lit(False))).join(predictions.where("condition = 'B'").select("sample_id", "normalizer_output"), "sample_id")
    status = F.coalesce("normalization_rule_seen_status", F.lit("unknown"))
    kinds = F.concat(F.array(F.struct(F.lit("all").alias("breakdown"), F.lit("").alias("value")), F.struct(F.lit("seen_status").alias("breakdown"), status.alias("value"))), F.transform("normalization_types", lambda t: F.struct(F.lit("type").alias("breakdown"), t.alias("value"))))
    return summary(rows.withColumn("__kind", F.explode(kinds)).select("*", "__kind.*"), "raw", "gold_normalised", "normalizer_output", "breakdown", "value")


def tag_scores(gold: DataFrame, predicted: DataFrame, tags: DataFrame) -> DataFrame:
    """Per tag of tags(tag): matches of gold and predicted (sample_id, tag, span, replacement) as multisets; all zero without support."""
    key = ["sample_id", "tag", "start", "end", "target"]
    g = gold.groupBy(*key).agg(F.count("*").alias("g"))
    p = predicted.groupBy(*key).agg(F.count("*").alias("p"))
    both = g.join(p, key, "full").fillna(0, ["g", "p"])
    counted = both.groupBy("tag").agg(F.sum(F.least("g", "p")).alias("tp"), F.sum("g").alias("support"), F.sum("p").alias("n_predicted"))
    out = tags.join(counted, "tag", "left").fillna(0)
    prec = F.when(F.col("n_predicted") > 0, F.col("tp") / F.col("n_predicted")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    zero = F.col("support") == 0
    return out.withColumns({"precision": F.when(zero, 0.0).otherwise(prec), "recall": rec, "f_half": F.when(zero, 0.0).otherwise(f_half(prec, rec))})


def route(samples: DataFrame, normalise: Callable[[Column], Column], correct: Callable[[Column], Column]) -> DataFrame:
    """Three rows per sample: A corrects the raw text, B the normalised one, C the gold normalisation."""
    out = samples.withColumn("condition", F.explode(F.array(F.lit("A"), F.lit("B"), F.lit("C"))))
    fed = F.when(F.col("condition") == "A", F.col("raw")).when(F.col("condition") == "B", normalise(F.col("raw"))).otherwise(F.col("gold_normalised"))
    return out.withColumn("gec_input", fed).withColumn("gec_output", correct(F.col("gec_input")))


# The longer names of the routes.
ROUTES = {"raw_to_gec": "A", "raw_to_normalizer_to_gec": "B", "oracle_normalized_to_gec": "C"}
# End of fixed values.


def with_prediction(df: DataFrame, column: str, *, output: str, tags: str | None = None, edits: str | None = None) -> DataFrame:
    """df with what a model's column says in the names given, and without that column.

    A model returns a text, or a struct of ``text`` (or ``output``) with or without ``predicted_tags`` and ``predicted_edits``, or a tuple of the three or the first two
    (a struct of ``_1``, ``_2``, ``_3``). Any other shape is refused before anything runs; tags and edits that it doesn't return are null.
    """
    kind = df.schema[column].dataType
    fields = {f.name: f.dataType for f in kind.fields} if isinstance(kind, StructType) else {}
    text = next((n for n in ("text", "output", "_1") if n in fields), None)
    if not isinstance(kind, StringType) and not (text and isinstance(fields[text], StringType)):
        raise ValueError(f"a model returns a text, or a struct or tuple that begins with one, not {kind.simpleString()}")
    out = df.withColumn(output, F.col(column) if text is None else F.col(column)[text])
    for to, names, none in ((tags, ("predicted_tags", "_2"), "array<string>"), (edits, ("predicted_edits", "_3"), "array<struct<start:bigint,end:bigint,source:string,target:string,tag:string>>")):
        if to is not None:
            held = next((n for n in names if n in fields), None)
            out = out.withColumn(to, F.lit(None).cast(none) if held is None else F.col(column)[held])
    return out.drop(column)


def predict(samples: DataFrame, normalise: Callable[[Column], Column], correct: Callable[[Column], Column], *, conditions: tuple[str, ...] = ("A", "B", "C"), versions: dict[str, str] | None = None) -> DataFrame:
    """Predictions of samples(sample_id, raw, gold_normalised) under each condition, by models of any shape (``with_prediction``), once per condition however it is named.

    Each has what its route says (raw_input, normalizer_output for B and the gold one for C, gec_input), gec_output, tags and edits if the corrector gives them, and the
    versions it is bound to. Samples without id or texts fail the job.
    """
    wanted = list(dict.fromkeys(ROUTES.get(c, c) for c in conditions))
    if unknown := [c for c in wanted if c not in ROUTES.values()]:
        raise ValueError(f"unknown conditions: {unknown}")
    c = F.col
    whole = F.coalesce(c("sample_id").cast("string") != "", F.lit(False)) & c("raw").isNotNull() & c("gold_normalised").isNotNull()
    rows = samples.where(F.when(whole, F.lit(True)).otherwise(F.raise_error(F.lit("a sample needs an id, a raw text and a gold normalisation")).cast("boolean")))
    rows = rows.withColumn("condition", F.explode(F.array(*[F.lit(x) for x in wanted]))).withColumn("__n", normalise(c("raw")))
    rows = with_prediction(rows, "__n", output="__normalised")
    b, oracle = c("condition") == "B", c("condition") == "C"
    rows = rows.withColumns({"raw_input": c("raw"), "normalizer_output": F.when(b, c("__normalised")).when(oracle, c("gold_normalised")), "gec_input": F.when(b, c("__normalised")).when(oracle, c("gold_normalised")).otherwise(c("raw"))}).drop("__normalised")
    rows = with_prediction(rows.withColumn("__g", correct(c("gec_input"))), "__g", output="gec_output", tags="predicted_tags", edits="predicted_edits")
    return rows.withColumns({k: F.lit(v) for k, v in (versions or {}).items()})


def key_faults(samples: DataFrame, predictions: DataFrame) -> DataFrame:
    """(sample_id, condition, fault) of expected keys that are missing, and of extra or repeated ones."""
    wanted = samples.select("sample_id", F.explode(F.array(F.lit("A"), F.lit("B"), F.lit("C"))).alias("condition"))
    held = predictions.groupBy("sample_id", "condition").agg(F.count("*").alias("n"))
    both = wanted.withColumn("w", F.lit(True)).join(held, ["sample_id", "condition"], "full")
    fault = F.when(F.col("n").isNull(), "missing").when(F.col("w").isNull(), "extra").when(F.col("n") > 1, "repeated")
    return both.select("sample_id", "condition", fault.alias("fault")).where("fault is not null")


def mcnemar_p(x: int, y: int) -> float:
    """Exact two-sided p of x against y discordant pairs.

    Terms are summed from the largest one down, each from the one before it, until they no longer count: about the square root of x + y of them.
    """
    n, k = x + y, min(x, y)
    if n == 0:
        return 1.0
    term = math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) - n * math.log(2))
    total, i = 0.0, k
    while i >= 0 and term > total * 1e-18:
        total += term
        term *= i / (n - i + 1)
        i -= 1
    return min(1.0, 2 * total)


def mcnemar(df: DataFrame, a: str, b: str) -> tuple[int, int, float]:
    """(only a right, only b right, exact two-sided p) over paired booleans."""
    row = df.agg(F.count_if(F.col(a) & ~F.col(b)).alias("x"), F.count_if(~F.col(a) & F.col(b)).alias("y")).first()
    return row.x, row.y, mcnemar_p(row.x, row.y)


@F.arrow_udf(StructType([StructField(k, LongType()) for k in ("tp", "fp", "fn")]))
def word_counts(source: pa.Array, gold: pa.Array, output: pa.Array) -> pa.Array:
    """Words by place: those that were to change and are right, that were right and are not, that are still wrong. Null where a text is.

    Words of a whole batch are compared at once; a text that is shorter than another one of its row has no word at the other one's last places.
    """
    texts = [pc.cast(t, pa.string()) for t in (source, gold, output)]
    whole = np.logical_and.reduce([t.is_valid().to_numpy(zero_copy_only=False) for t in texts])
    split = [pc.split_pattern(t.filter(pa.array(whole)), " ") for t in texts]
    sizes = np.stack([s.value_lengths().to_numpy(zero_copy_only=False) for s in split])
    counts = np.zeros((3, sizes.shape[1]), dtype=np.int64)
    even = (sizes == sizes[0]).all(axis=0)
    for rows in (np.flatnonzero(even), np.flatnonzero(~even)):
        if not len(rows):
            continue
        most = sizes[:, rows].max(axis=0)
        first = np.cumsum(most) - most
        x, y, z = (_words_by_place(s.take(pa.array(rows)), most, first) for s in split)
        before, after = _same(x, y), _same(z, y)
        counts[:, rows] = [np.add.reduceat(hit, first, dtype=np.int64) for hit in (~before & after, before & ~after, ~before & ~after)]
    at = pa.array(np.cumsum(whole) - 1, pa.int64(), mask=~whole)
    return pa.StructArray.from_arrays([pa.array(v, pa.int64()).take(at) for v in counts], names=["tp", "fp", "fn"], mask=pa.array(~whole))


def _words_by_place(split: pa.ListArray, most: np.ndarray, first: np.ndarray) -> pa.Array:
    """All words of split, each text's followed by nulls up to most; texts begin at first."""
    sizes, words = split.value_lengths().to_numpy(), split.flatten()
    if len(words) == most.sum():
        return words
    place = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(first, sizes)
    index, none = np.zeros(most.sum(), dtype=np.int64), np.ones(most.sum(), dtype=bool)
    index[place], none[place] = np.arange(len(words)), False
    return words.take(pa.array(index, mask=none))


def _same(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Whether words are the same, or both are missing."""
    return pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(a.is_null(), b.is_null())).to_numpy(zero_copy_only=False)


COUNTS = ["tp_a", "fp_a", "fn_a", "tp_b", "fp_b", "fn_b"]


def bootstrap(df: DataFrame, *, resamples: int = 2000, seed: int = 7, indexes: str = "vectors", level: float = 0.95) -> DataFrame:
    """Mean and interval of F0.5(b) - F0.5(a) over paired resamples of df(sample_id, tp_a, fp_a, fn_a, tp_b, fp_b, fn_b).

    Edit counts are additive, so a resample is a weighted sum and no edit is computed twice. ``indexes`` says how samples are drawn:

    * ``vectors``: samples with equal counts are interchangeable, so a resample is one multinomial draw over the distinct count vectors.
      Their number depends on how many edits sentences have, not on how many sentences there are: this is the way for large sets.
    * ``hashed``: indexes from MD5, over samples numbered by id. Reproducible in SQL; work is samples times resamples, spread over the executors (``_drawn_sums``).
    * ``mersenne``: indexes from Python's generator over samples in order of id, drawn on the driver; for sets of a few thousand samples.
    """
    spark, c = df.sparkSession, F.col
    if indexes == "vectors":
        held = [tuple(r) for r in df.groupBy(*COUNTS).agg(F.count("*").alias("n")).orderBy(*COUNTS).collect()]
        vectors, weights = np.array([r[:6] for r in held], dtype=np.float64).reshape(-1, 6), np.array([r[6] for r in held], dtype=np.int64)
        draws = np.random.default_rng(seed).multinomial(weights.sum(), weights / max(1, weights.sum()), resamples) if len(held) else np.zeros((0, 0))
        sums = spark.createDataFrame([tuple(int(v) for v in row) for row in draws @ vectors], ", ".join(f"{k} long" for k in COUNTS))
    else:
        numbered = _numbered(df.select("sample_id", *COUNTS))
        if indexes == "hashed":
            sums = _drawn_sums(numbered, resamples, seed)
        else:
            n = numbered.count()
            rng = random.Random(seed)
            drawn = spark.createDataFrame([(r, [rng.randrange(n) for _ in range(n)]) for r in range(resamples)], "resample long, ix array<long>").select("resample", F.explode("ix").alias("i"))
            sums = drawn.join(numbered, "i").groupBy("resample").agg(*[F.sum(k).alias(k) for k in COUNTS])
    score = lambda s: f_half(precision(c(f"tp_{s}"), c(f"fp_{s}"), c(f"fn_{s}")), recall(c(f"tp_{s}"), c(f"fn_{s}")))
    deltas = sums.select((score("b") - score("a")).alias("delta")).agg(F.sort_array(F.collect_list("delta")).alias("d"))  # `resamples` numbers
    at = lambda q: F.get("d", F.floor(q * (F.size("d") - 1)).cast("int"))
    edge = (1 - level) / 2
    return deltas.select((F.aggregate("d", F.lit(0.0), lambda s, x: s + x) / F.size("d")).alias("mean_delta"), at(F.lit(edge)).alias("low"), at(F.lit(1 - edge)).alias("high"))


#: Samples that a task of hashed draws holds at once, samples that are sent to it as one row, places that it draws at once, and numbers hashed at once.
BLOCK, CHUNK, DRAWS, HASHES = 1 << 25, 1 << 15, 1 << 18, 1 << 13
#: Distinct count vectors up to which samples are sent as codes of them; beyond, their counts are sent, by smaller blocks.
VECTORS = 1 << 20
_MD5_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
_MD5_SINES = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_MD5_TURNS = (7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)


def md5_words(head: bytes, first: int, last: int) -> np.ndarray:
    """MD5 of head followed by each number from first to before last, in decimal, as its 4 words (a row each) read as big-endian numbers.

    All numbers of one length are hashed together, step by step: some six times faster than one by one.
    """
    out, at = np.empty((4, last - first), dtype=np.uint32), first
    while at < last:
        digits = len(str(at))
        end = min(last, 10**digits, at + HASHES)
        out[:, at - first : end - first] = _md5_of_length(head, np.arange(at, end, dtype=np.int64), digits)
        at = end
    return out.byteswap(inplace=True)


def _md5_of_length(head: bytes, numbers: np.ndarray, digits: int) -> np.ndarray:
    n, size = len(numbers), len(head) + digits
    if size > 55:  # more than a block
        return np.frombuffer(b"".join([md5(head + b"%d" % k).digest() for k in numbers.tolist()]), dtype="<u4").reshape(n, 4).T
    block = bytearray(64)
    block[: len(head)], block[size], block[56:] = head, 0x80, (8 * size).to_bytes(8, "little")
    fixed = np.frombuffer(bytes(block), dtype="<u4").tolist()
    rest, varying = numbers, {}
    for spot in range(size - 1, len(head) - 1, -1):
        higher = rest // 10
        digit = (rest - 10 * higher + 48).astype(np.uint32) << np.uint32(8 * (spot % 4))
        varying[spot // 4] = varying.get(spot // 4, np.uint32(0)) + digit
        rest = higher
    a, b, c, d = (np.full(n, v, dtype=np.uint32) for v in _MD5_START)
    f, t = np.empty(n, dtype=np.uint32), np.empty(n, dtype=np.uint32)
    for i in range(64):
        turn = i // 16
        if turn == 0:  # d ^ (b & (c ^ d))
            np.bitwise_xor(c, d, out=f)
            np.bitwise_and(f, b, out=f)
            np.bitwise_xor(f, d, out=f)
        elif turn == 1:  # c ^ (d & (b ^ c))
            np.bitwise_xor(b, c, out=f)
            np.bitwise_and(f, d, out=f)
            np.bitwise_xor(f, c, out=f)
        elif turn == 2:
            np.bitwise_xor(b, c, out=f)
            np.bitwise_xor(f, d, out=f)
        else:  # c ^ (b | ~d)
            np.invert(d, out=f)
            np.bitwise_or(f, b, out=f)
            np.bitwise_xor(f, c, out=f)
        word, by = (i, 5 * i + 1, 3 * i + 5, 7 * i)[turn] % 16, _MD5_TURNS[turn][i % 4]
        np.add(f, a, out=f)
        np.add(f, np.uint32((_MD5_SINES[i] + fixed[word]) & 0xFFFFFFFF), out=f)
        if word in varying:
            np.add(f, varying[word], out=f)
        np.left_shift(f, np.uint32(by), out=t)
        np.right_shift(f, np.uint32(32 - by), out=f)
        np.bitwise_or(f, t, out=f)
        np.add(f, b, out=f)
        a, b, c, d, f = d, f, b, c, a
    return np.stack([v + np.uint32(s) for v, s in zip((a, b, c, d), _MD5_START, strict=True)])


def _drawn_sums(numbered: DataFrame, resamples: int, seed: int, block: int | None = None) -> DataFrame:
    """(resample, COUNTS) of hashed draws from numbered(i, COUNTS): each draw is looked up where it is made, so that no draw is shuffled.

    Samples go by blocks of i, and each block to every group of resamples, which is one task: what is shuffled is the samples, as codes of two bytes that name their counts,
    times the groups. A task holds one block and the places of one batch, whatever the samples and resamples are. Only beyond BLOCK samples is there more than one block;
    each draws anew, and keeps the places that fall in it.
    """
    spark, c = numbered.sparkSession, F.col
    ws = Workspace(spark, "bootstrap")
    held = ws.save(numbered.select("i", *COUNTS), "numbered")
    n = held.count()
    known = ws.save(held.select(*COUNTS).distinct(), "vectors")
    coded = known.count() <= VECTORS
    size = block or (BLOCK if coded else BLOCK >> 6)
    groups, blocks = max(1, min(resamples, 3 * spark.sparkContext.defaultParallelism)), max(1, -(-n // size))
    schema = ", ".join(f"{k} long" for k in ("resample", *COUNTS))
    vectors, sent = None, COUNTS
    if coded:
        named = [tuple(r) for r in known.orderBy(*COUNTS).collect()]
        vectors, codes, sent = np.array(named, dtype=np.int64).reshape(-1, 6), {r: k for k, r in enumerate(named)}, ["code"]

        def named_by(batches):
            for batch in batches:
                found = [codes[r] for r in zip(*[batch.column(k).to_pylist() for k in COUNTS], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("i"), pa.array(found, pa.int32())], names=["i", "code"])

        held = held.mapInArrow(named_by, "i long, code int").withColumn("code", c("code").cast("short" if len(named) <= 1 << 15 else "int"))
    chunks = held.groupBy(F.floor(c("i") / size).alias("block"), F.floor(c("i") % size / CHUNK).alias("chunk")).agg(F.array_sort(F.collect_list(F.struct("i", *sent))).alias("rows"))
    chunks = chunks.select("block", "chunk", *[c(f"rows.{k}").alias(k) for k in sent])

    def summed(batches):
        held, low, group = {}, 0, 0
        for batch in batches:
            for at in range(batch.num_rows):
                low, group = batch.column("block")[at].as_py() * size, batch.column("group")[at].as_py()
                held[batch.column("chunk")[at].as_py()] = [batch.column(k)[at].values.to_numpy(zero_copy_only=False).copy() for k in sent]
        if not held:
            return
        columns = [np.concatenate(v) for v in zip(*[held.pop(k) for k in sorted(held)], strict=True)]
        rows, code = (vectors, columns[0]) if coded else (np.stack(columns, axis=1), None)
        here, out = len(columns[0]), []
        for resample in range(group, resamples, groups):
            head, times = f"{seed}:{resample}:".encode(), np.zeros(len(rows), dtype=np.int64)
            for first in range(0, n, DRAWS):
                last = min(n, first + DRAWS)
                drawn = md5_words(head, first // 4, (last + 3) // 4)
                drawn = drawn.ravel() if (last - first) % 4 == 0 else drawn.T.ravel()[: last - first]
                if n < 1 << 32:
                    drawn -= drawn // np.uint32(n) * np.uint32(n)
                if blocks > 1:
                    drawn = drawn.astype(np.int64) - low
                    drawn = drawn[(drawn >= 0) & (drawn < here)]
                times += np.bincount(drawn if code is None else code[drawn], minlength=len(rows))
            out.append([resample, *(times @ rows).tolist()])
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*out, strict=True)], names=["resample", *COUNTS])

    spread = chunks.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).repartitionById(groups * blocks, (c("block") * groups + c("group")).cast("int"))
    return spread.mapInArrow(summed, schema).groupBy("resample").agg(*[F.sum(k).alias(k) for k in COUNTS])


def _numbered(df: DataFrame) -> DataFrame:
    """df without sample_id and with i, its place in order of it from 0: ranges are sorted apart and offset by the rows before them, so no task sorts all."""
    ws = Workspace(df.sparkSession, "numbered")
    # Both are saved: ranges are sampled before rows are dealt out, and a plan that reads less may be dealt out to fewer partitions.
    ordered = ws.save(ws.save(df, "rows").repartitionByRange("sample_id").withColumn("__part", F.spark_partition_id()), "ranges")
    ordered = ordered.withColumn("i", F.row_number().over(Window.partitionBy("__part").orderBy("sample_id")).cast("long") - 1)
    sizes = sorted((r[0], r[1]) for r in ordered.groupBy("__part").count().collect())  # one row per partition
    offsets, before = [], 0
    for part, n in sizes:
        offsets.append((part, before))
        before += n
    return ordered.join(df.sparkSession.createDataFrame(offsets, "__part int, __before long"), "__part").withColumn("i", F.col("i") + F.col("__before")).drop("__part", "__before", "sample_id")


def noise_places(samples: DataFrame, rules: DataFrame, seed: int, category: str | None = None) -> DataFrame:
    """(sample_id, text, category, id, source, target, start, rank, ...) of every whole word of samples(sample_id, text) that a rule(id, category, source, target, ...) fits.

    Further columns of the rules come along. ``category`` stands in the rank instead of the rule's own, if given. If samples have ``protected``, an array of spans
    (start, end), places that overlap one are left out. Only words that are some rule's target are exploded, and the rules, which are counted first, are broadcast.
    """
    forms, pairs = keys_of(rules, "target"), F.transform("w", lambda w, i: F.struct(i.alias("at"), w.alias("word")))
    hits = pairs if forms is None else F.filter(pairs, lambda x: x["word"].isin(*forms))
    spans = [c for c in ("protected",) if c in samples.columns]
    words = samples.withColumn("w", F.split("text", " ")).select("sample_id", "text", *spans, "w", F.explode(hits).alias("hit")).select("sample_id", "text", *spans, "w", "hit.*")
    start = F.when(F.col("at") == 0, 0).otherwise(F.length(F.array_join(F.slice("w", F.lit(1), F.col("at")), " ")) + 1)
    hit = words.join(bounded(rules), words["word"] == rules["target"]).withColumn("start", start.cast("long"))
    if spans:
        free = ~F.exists("protected", lambda p: (p["start"] < F.col("start") + F.length("target")) & (p["end"] > F.col("start")))
        hit = hit.where(F.coalesce(free, F.lit(True))).drop("protected")
    named = F.col("category") if category is None else F.lit(category)
    return hit.withColumn("rank", F.sha2(F.concat_ws("|", F.lit(str(seed)), "sample_id", named, "id", F.col("start").cast("string")), 256)).drop("w", "word", "at")


def _noisy(text: Column, start: Column, source: Column, target: Column) -> Column:
    return F.concat(F.left(text, start.cast("int")), source, F.substring(text, (start + F.length(target) + 1).cast("int"), F.length(text)))


def inject_noise(samples: DataFrame, rules: DataFrame, seed: int) -> DataFrame:
    """One edit per sample and category: of all places where a rule(id, category, source, target) fits a whole word, the least by hash.

    samples(sample_id, text): text holds targets; the edit puts the informal source there.
    """
    least = F.min(F.struct("rank", "id", "start", "source", "target")).alias("best")
    best = noise_places(samples, rules, seed).groupBy("sample_id", "text", "category").agg(least).select("sample_id", "text", "category", "best.*")
    noisy = _noisy(F.col("text"), F.col("start"), F.col("source"), F.col("target"))
    return best.select("sample_id", "category", F.col("id").alias("rule_id"), "start", F.length("source").cast("long").alias("n_chars"), noisy.alias("noisy_text"), "text", "source", "target")


def inject_mixed_noise(samples: DataFrame, rules: DataFrame, seed: int) -> DataFrame:
    """Two edits per sample, of rules of distinct categories and one status, that don't overlap; samples without such two give no row.

    rules have ``seen`` besides the columns of ``inject_noise``: whether the normaliser knows the rule. Of the seen places, then of the unseen ones, the
    least by hash is taken, and with it the least that goes with it; the first status that has both decides. A sample's places are no more than its
    words times the rules of a word, so the choice is one expression in its row.

    Returns sample_id, text, noisy_text, seen_status and edits, which replay noisy_text to text.
    """
    item = F.struct("rank", "id", "start", "category", "source", "target")
    places = noise_places(samples, rules, seed, "mixed_noise")
    held = places.groupBy("sample_id", "text").agg(*[F.array_sort(F.collect_list(F.when(F.col("seen") == known, item))).alias(name) for name, known in (("seen_rule", True), ("unseen_pattern", False))])

    def goes_with(x: Column, y: Column) -> Column:
        apart = (y["start"] >= x["start"] + F.length(x["target"])) | (y["start"] + F.length(y["target"]) <= x["start"])
        return apart & (y["category"] != x["category"])

    def pair(name: str) -> Column:
        first = F.get(name, F.lit(0))
        return F.struct(F.lit(name).alias("status"), first.alias("a"), F.get(F.filter(name, lambda y: goes_with(first, y)), F.lit(0)).alias("b")).alias(name)

    held = held.select("sample_id", "text", pair("seen_rule"), pair("unseen_pattern"))
    two = F.when(F.col("seen_rule.b").isNotNull(), F.col("seen_rule")).when(F.col("unseen_pattern.b").isNotNull(), F.col("unseen_pattern"))
    chosen = held.withColumn("two", two).where("two is not null").select("sample_id", "text", F.col("two.status").alias("seen_status"), *[F.struct(*[F.col(f"two.{e}.{f}").alias(f) for f in ("start", "id", "category", "source", "target")]).alias(e) for e in "ab"])
    chosen = chosen.withColumns({"l": F.least("a", "b"), "r": F.greatest("a", "b")})
    once = _noisy(F.col("text"), F.col("r.start"), F.col("r.source"), F.col("r.target"))  # the later one first, so that the earlier one's place holds
    noisy = _noisy(once, F.col("l.start"), F.col("l.source"), F.col("l.target"))
    moved = F.col("r.start") + F.length("l.source") - F.length("l.target")
    edit = lambda e, start: F.struct(start.alias("start"), (start + F.length(f"{e}.source")).alias("end"), *[F.col(f"{e}.{f}").alias(f) for f in ("source", "target", "id", "category")])
    return chosen.select("sample_id", "text", noisy.alias("noisy_text"), "seen_status", F.array(edit("l", F.col("l.start")), edit("r", moved)).alias("edits"))


def controlled_rows(samples: DataFrame, rules: DataFrame, seed: int) -> DataFrame:
    """Evaluation rows with planted noise, awaiting annotation, from samples(sample_id, base_clean_id, errorful, correct, grammar_edits) and reviewed rules.

    grammar_edits(start, end, source, target) turn errorful into correct, and their spans take no noise. Rows are returned only if the noise replays to errorful and the
    grammar edits replay to correct. Samples without two places for noise give no row.
    """
    spans = F.transform("grammar_edits", lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end")))
    made = inject_mixed_noise(samples.select("sample_id", F.col("errorful").alias("text"), spans.alias("protected")), rules, seed)
    rows = samples.join(made.drop("text"), "sample_id").withColumnRenamed("edits", "normalization_edits")
    same = (apply_edits(F.col("noisy_text"), F.col("normalization_edits")) == F.col("errorful")) & (apply_edits(F.col("errorful"), F.col("grammar_edits")) == F.col("correct"))
    fixed = {"normalization_types": F.array(F.lit("mixed_noise")), "source_type": F.lit("controlled"), "annotator_1": F.lit(""), "annotator_2": F.lit(""), "adjudication_status": F.lit("pending"), "split": F.lit("test_only"), "generation_status": F.lit("pending_annotation")}
    return rows.where(same).withColumnRenamed("noisy_text", "raw_informal").withColumns(fixed)
