"""Quality rules with adaptive thresholds from mergeable quantile sketches, in DataFrame functions only.

Each text gets base measures (words, characters in words, symbols, repeated lines, words in repeated 8-word windows)
and rates of them, in parts per million. The sketch of a rate is a log-linear histogram: a value falls into the bucket of
its leading ``SKETCH_BITS`` binary digits, so a quantile is off by less than one part in 64, counts of equal buckets add up
in any order, and the result never depends on partitions, retries or the order of merging. Sketches are built per
language and source before the shuffle; those of languages and of the whole table come from merging them, not from the texts.

The upper fence of a group is ``q75 + spread * (q75 - q25)`` of its own sketch. Nothing is floored: in sketches, counts are
smoothed by a few symbols or words or half a line, so that a group of clean texts has the spread that its texts' lengths
imply. What is held against the fence is the text's plain rate, so a text without the fault is never over. Groups under ``least`` texts borrow the
sketch of their language, small languages that of the table. Fences are joined back and filter.

Defined cases: null text has no words and fails the base rules, like empty text; very long texts are measured whole; a rate
equal to its fence is kept (ties pass); null languages and sources are groups of their own; null ids pass through; repeated
rows are judged each and counted each; a group without texts that pass the base rules has no fence and nothing of it is
kept; empty tables give empty results; other columns pass unless they have the name of a measure, which then replaces them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.workspace import Workspace
from millrace.operators.generate import bounded

SPACES = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
SKETCH_BITS = 7
#: rate -> (count, what it is a share of, pseudo-count in halves); the sketches hold (2 * count + halves) / (2 * size + 2).
RATES = {
    "symbol_rate": ("n_symbols", "word_chars", 6),
    "dup_line_rate": ("n_dup_lines", "n_lines", 1),
    "repeat_rate": ("n_repeat_words", "n_words", 8),
    "word_length": ("word_chars", "n_words", 0),
}


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once however often use names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _windows(words: Column) -> Column:
    """Hashes of the 8-word windows, by doubling: words, pairs, fours, eights."""
    h = F.transform(words, lambda w: F.xxhash64(w))

    def joined(step: int) -> Callable[[Column], Column]:
        return lambda x: F.zip_with(F.slice(x, 1, F.size(x) - step), F.slice(x, step + 1, F.size(x) - step), lambda a, b: F.xxhash64(a, b))

    for step in (1, 2, 4):
        h = _bound(h, joined(step))
    return h


def _covered(hashes: Column) -> Column:
    """Words inside windows whose hash occurs twice or more: of each such window, those before the next one begins, at most 8."""
    tagged = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    match = lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>"))
    pairs = _bound(tagged, lambda t: F.zip_with(F.slice(t, 1, F.size(t) - 1), F.slice(t, 2, F.size(t) - 1), match))
    places = F.sort_array(F.array_distinct(F.flatten(pairs)))
    state = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
    return F.aggregate(places, state, lambda s, i: F.struct((s["n"] + F.least(F.lit(WINDOW), i - s["last"])).cast("long").alias("n"), i.alias("last")), lambda s: s["n"])


def measures(docs: DataFrame, *, text_column: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words and base_failed of the whole text."""
    text = F.coalesce(docs[text_column], F.lit(""))
    spaceless = F.translate(text, "\x20\x09\x0a\x0b\x0c\x0d", "")
    staged = docs.withColumns({"__words": F.filter(F.split(text, SPACES), lambda w: w != ""), "__lines": F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))})
    staged = staged.withColumn("__windows", F.when(F.size("__words") >= WINDOW, _windows(F.col("__words"))).otherwise(F.array().cast("array<bigint>")))
    repeats = F.size(F.array_distinct("__windows")) < F.size("__windows")
    out = staged.withColumns(
        {
            "n_words": F.size("__words").cast("long"),
            "word_chars": F.length(spaceless).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
            "n_lines": F.size("__lines").cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "n_repeat_words": F.when(repeats, _covered(F.col("__windows"))).otherwise(F.lit(0).cast("long")),
        }
    ).drop("__words", "__lines", "__windows")
    return out.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def rate(name: str) -> Column:
    """A rate in whole parts per million (exact integer arithmetic)."""
    count, size, _ = RATES[name]
    return F.expr(f"(1000000 * {count}) div greatest({size}, 1)")


def smoothed(name: str) -> Column:
    """The rate as sketches hold it: with pseudo-counts, so that it says how much one more would weigh in a text of this length."""
    count, size, halves = RATES[name]
    return F.expr(f"(1000000 * (2 * {count} + {halves})) div (2 * {size} + 2)")


def bucket(value: Column) -> Column:
    """The least value with the same leading SKETCH_BITS binary digits."""
    drop = F.greatest(F.length(F.bin(value)) - SKETCH_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def sketches(measured: DataFrame, *by: str) -> DataFrame:
    """(by..., rate, bucket, n) over the texts that pass the base rules; adding up n of equal buckets merges sketches."""
    passing = measured.where("not base_failed")
    rates = F.array(*[F.struct(F.lit(k).alias("rate"), bucket(smoothed(k)).alias("bucket")) for k in RATES])
    return passing.select(*by, F.inline(rates)).groupBy(*by, "rate", "bucket").agg(F.count("*").alias("n"))


def quartile_fence(sketch: DataFrame, by: list[str], spread: int) -> DataFrame:
    """(by..., rate, texts, fence) of each group's sketch; a group has at most a few thousand buckets."""
    running = Window.partitionBy(*by, "rate").orderBy("bucket")
    placed = sketch.withColumns({"__through": F.sum("n").over(running), "__texts": F.sum("n").over(Window.partitionBy(*by, "rate"))})
    at = lambda q: F.min(F.when(4 * F.col("__through") >= q * F.col("__texts"), F.col("bucket")))
    return placed.groupBy(*by, "rate").agg(F.max("__texts").alias("texts"), (at(3) + spread * (at(3) - at(1))).alias("fence"))


def fences(measured: DataFrame, *, spread: int = 6, least: int = 200) -> DataFrame:
    """lang, source, n_texts, borrowed (own, language or table) and the fence of each rate."""
    fine = sketches(measured, "lang", "source")
    coarse = fine.groupBy("lang", "rate", "bucket").agg(F.sum("n").alias("n"))
    whole = coarse.groupBy("rate", "bucket").agg(F.sum("n").alias("n"))
    own, language = quartile_fence(fine, ["lang", "source"], spread), quartile_fence(coarse, ["lang"], spread)
    table = quartile_fence(whole, [], spread).select(F.col("rate").alias("t_rate"), F.col("fence").alias("t_fence"))
    language = language.select(F.col("lang").alias("l_lang"), F.col("rate").alias("l_rate"), F.col("texts").alias("l_texts"), F.col("fence").alias("l_fence"))
    joined = own.join(language, F.col("lang").eqNullSafe(F.col("l_lang")) & (F.col("rate") == F.col("l_rate"))).join(table, F.col("rate") == F.col("t_rate"))
    lender = F.when(F.col("texts") >= least, "own").when(F.col("l_texts") >= least, "language").otherwise("table")
    chosen = joined.select("lang", "source", "rate", "texts", lender.alias("borrowed"), F.when(lender == "own", F.col("fence")).when(lender == "language", F.col("l_fence")).otherwise(F.col("t_fence")).alias("fence"))
    return chosen.groupBy("lang", "source").agg(F.max("texts").alias("n_texts"), F.max("borrowed").alias("borrowed"), *[F.max(F.when(F.col("rate") == k, F.col("fence"))).alias(f"{k}_fence") for k in RATES])


def judge(measured: DataFrame, **options: int) -> DataFrame:
    """measured (from ``measures``, best saved first, as it is read twice) with ``kept``."""
    limits = Workspace(measured.sparkSession, "fences").save(fences(measured, **options).withColumnsRenamed({"lang": "__lang", "source": "__source"}), "limits")
    joined = measured.join(bounded(limits), F.col("lang").eqNullSafe(F.col("__lang")) & F.col("source").eqNullSafe(F.col("__source")), "left").drop("__lang", "__source")
    under = reduce(lambda a, b: a & b, [rate(k) <= F.col(f"{k}_fence") for k in RATES])
    return joined.withColumn("kept", ~F.col("base_failed") & F.coalesce(under, F.lit(False)))
