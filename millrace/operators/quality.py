"""The clean-target gate: every failing reason of a sentence, in a fixed order, as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.profile import QualityRules
from millrace.functions.text import is_ascii

# Patterns of the gate.
CONTROL = "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]"
BRACKETS = "[()\\[\\]{}]"
URL_OR_EMAIL = "(?i)(?:https?://|www\\.|[\\p{L}\\p{N}_.+-]+@[\\p{L}\\p{N}_.-]+\\.[A-Za-z]{2,})"
# End of fixed values.
#: What a text has that the pattern above matches: found in one pass, while the pattern begins anew at every letter.
URL_SIGNS = ("@", "://", "[wW]{3}\\.")

#: Every reason, in the order in which a row lists them.
CODES = (
    "empty_text nul_character no_letter too_long low_alphabetic_ratio repeated_punctuation boilerplate upstream_duplicate_marker language_mismatch "
    "low_language_confidence language_code_switch_ratio language_code_switch_borderline language_code_switch_clause unbalanced_bracket unbalanced_quote "
    "control_character sentence_integrity_too_short sentence_integrity_leading_closer sentence_integrity_trailing_opener suspicious_encoding informal_marker url_or_email"
).split()


def unbalanced_brackets(text: Column) -> Column:
    """Whether brackets close what they should: a fold over the brackets alone, with the open ones as its state."""
    marks = F.filter(F.split(F.regexp_replace(text, "[^()\\[\\]{}]+", ""), ""), lambda c: c != "")
    opener = lambda c: F.translate(c, ")]}", "([{")

    def step(open_: Column, c: Column) -> Column:
        closes = F.when((F.length(open_) > 0) & (F.right(open_, F.lit(1)) == opener(c)), F.left(open_, F.length(open_) - 1)).otherwise("X")
        return F.when(F.left(open_, F.lit(1)) == "X", open_).when(c.isin("(", "[", "{"), F.concat(open_, c)).otherwise(closes)

    return F.when(text.rlike(BRACKETS), F.aggregate(marks, F.lit(""), step) != "").otherwise(F.lit(False))


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def code_switch(df: DataFrame, rules: QualityRules, text: str = "text") -> DataFrame:
    """df with n_words, n_markers, marker_ratio and the flags of ratio and clause rules."""
    among = lambda values: lambda w: w.isin(*values)  # noqa: E731  (a set lookup)
    small = F.when(is_ascii(F.col(text)), F.lower(text)).otherwise(F.lower(F.translate(text, "\u0130\u212a", "  ")))
    df = df.withColumn("__w", F.regexp_extract_all(small, F.lit("([a-z]+)"), 1))
    df = df.withColumn("__b", F.filter(F.transform("__w", lambda w, i: F.when(among(rules.boundaries)(w), i)), lambda i: i.isNotNull()))
    w, b, n = F.col("__w"), F.col("__b"), F.size("__w")
    marked = lambda part: (F.size(F.filter(part, among(rules.markers))) >= rules.clause_min_markers) & (F.size(F.filter(part, among(rules.content))) >= rules.clause_min_content)
    first, last = F.get(b, F.lit(0)), F.get(b, F.size(b) - 1)
    clause = (F.size(b) > 0) & (((first >= rules.clause_min_tokens) & marked(F.slice(w, F.lit(1), F.greatest(first, F.lit(0))))) | ((n - last - 1 >= rules.clause_min_tokens) & marked(F.slice(w, F.coalesce(last, F.lit(0)) + 2, n))))
    df = df.withColumns({"n_words": n.cast("long"), "n_markers": F.size(F.filter(w, among(rules.markers))).cast("long"), "__clause": F.coalesce(clause, F.lit(False))})
    ratio = F.col("n_markers") / F.greatest(F.col("n_words"), F.lit(1))
    long, many = F.col("n_words") >= rules.min_tokens, F.col("n_markers") >= rules.min_markers
    return df.withColumns(
        {
            "marker_ratio": ratio,
            "switch_ratio": long & many & (ratio >= rules.max_marker_ratio),
            "switch_borderline": long & many & (ratio >= rules.borderline_ratio) & (ratio < rules.max_marker_ratio),
            "switch_clause": long & F.col("__clause"),
        }
    ).drop("__w", "__b", "__clause")


def with_reasons(df: DataFrame, rules: QualityRules, text: str = "text") -> DataFrame:
    """df (normalised text, language, language_confidence, is_duplicate) with reason_codes; none means accepted."""
    t = F.col(text)
    no_spaces = F.length(F.replace(t, F.lit(" "), F.lit("")))
    words = F.when(t == "", 0).otherwise(F.length(t) - no_spaces + 1)  # they stand between single spaces
    ascii_ = is_ascii(t)
    at, scheme, www = URL_SIGNS
    any_of = lambda tests: F.coalesce(F.greatest(*tests, F.lit(False)), F.lit(False))
    checks: list[tuple[str, Column]] = [
        ("empty_text", t == ""),
        ("nul_character", F.contains(t, F.lit("\x00"))),
        ("no_letter", (t != "") & ~t.rlike("\\p{L}")),
        ("too_long", F.length(t) > rules.max_characters if rules.max_characters else F.lit(False)),
        ("low_alphabetic_ratio", (t != "") & (F.length(F.when(ascii_, F.regexp_replace(t, "[^A-Za-z]+", "")).otherwise(F.regexp_replace(t, "\\P{L}+", ""))) / F.greatest(no_spaces, F.lit(1)) < rules.min_alphabetic_ratio)),
        ("repeated_punctuation", t.rlike(f"[!?.,;:]{{{rules.max_repeated_punctuation + 1},}}")),
        ("boilerplate", any_of([t.rlike(f"(?i)\\A(?:{p})\\z") for p in rules.boilerplate])),
        ("upstream_duplicate_marker", F.coalesce(F.col("is_duplicate"), F.lit(False))),
    ]
    if rules.required_language:
        checks.append(("language_mismatch", F.upper(F.coalesce("language", F.lit(""))) != rules.required_language))
    if rules.min_language_confidence is not None:
        checks.append(("low_language_confidence", F.col("language_confidence").isNull() | (F.col("language_confidence") < rules.min_language_confidence)))
    checks += [
        ("language_code_switch_ratio", F.col("switch_ratio")),
        ("language_code_switch_borderline", F.col("switch_borderline")),
        ("language_code_switch_clause", F.col("switch_clause")),
        ("unbalanced_bracket", unbalanced_brackets(t)),
        ("unbalanced_quote", (_count(t, '"') % 2 == 1) | (_count(t, "“") != _count(t, "”"))),
        ("control_character", t.rlike(CONTROL)),
        ("sentence_integrity_too_short", words < rules.integrity_min_tokens),
        ("sentence_integrity_leading_closer", F.left(t, F.lit(1)).isin(*".,;:!?)]}")),
        ("sentence_integrity_trailing_opener", F.right(t, F.lit(1)).isin(*"([{")),
        ("suspicious_encoding", any_of([F.contains(t, F.lit(m)) if m.isascii() else ~ascii_ & F.contains(t, F.lit(m)) for m in rules.mojibake])),
        ("informal_marker", any_of([F.when(ascii_, t.rlike(p)).otherwise(t.rlike(f"(?U){p}")) for p in rules.informal])),
        ("url_or_email", (F.contains(t, F.lit(at)) | F.contains(t, F.lit(scheme)) | t.rlike(www)) & t.rlike(URL_OR_EMAIL)),
    ]
    switched = code_switch(df, rules, text)
    # One string of the codes that hold (concat_ws skips nulls), as that compiles and an array of tests with a lambda does not.
    said = F.concat_ws(",", *[F.when(test, F.lit(code)) for code, test in checks])
    codes = F.when(F.col("__said") == "", F.array().cast("array<string>")).otherwise(F.split("__said", ","))
    return switched.withColumn("__said", said).withColumn("reason_codes", codes).drop("__said").drop("n_words", "n_markers", "marker_ratio", "switch_ratio", "switch_borderline", "switch_clause")


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.size("reason_codes") == 0).drop("reason_codes")


def quarantined(df: DataFrame) -> DataFrame:
    return df.where(F.size("reason_codes") > 0)


def histogram(df: DataFrame) -> DataFrame:
    """Rows per reason that occurs; a row counts once for each of its reasons. One count per code, so nothing is exploded or shuffled but a row per task."""
    counts = df.select(F.col("reason_codes").alias("__codes")).agg(*[F.count_if(F.array_contains("__codes", c)).alias(c) for c in CODES])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("reason"), F.col(c).alias("n_rows")) for c in CODES])).alias("r")).select("r.*").where("n_rows > 0")
