"""The sentences of the driver's tables, in Spark and in DuckDB, and inline resources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.profile import ENGLISH
from millrace.functions.text import with_normalised

SEED = 20260905


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(df: DataFrame, key: str) -> DataFrame:
    """df, dealt out by key where it has fewer files than there are cores, so that a small table uses them; a large one is never shuffled for it."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores, key) if df.rdd.getNumPartitions() < cores else df  # asks the plan, not for the files


def sentences(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per line of a document (of docs, if given) that has text after normalisation; ``carry`` names further columns of docs, or ``line``."""
    docs = dealt(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), "doc_id") if docs is None else docs
    lines = docs.select(
        F.col("doc_id").cast("string").alias("source_doc_id"),
        F.col("source").alias("publisher"),
        F.upper("lang").alias("language"),
        ((F.col("doc_id") % 100) / 100.0).alias("language_confidence"),
        (F.col("doc_id") % 97 == 0).alias("is_duplicate"),
        *[c for c in carry if c != "line"],
        F.posexplode(F.split("text", "\n")).alias("line", "said"),
    )
    lines = lines.withColumn("clean_id", F.concat_ws(":", "source_doc_id", F.col("line").cast("string")))
    written = lines.where(F.col("said").rlike("[^\\s\\x1c-\\x1f\\x85\\p{Z}]"))  # the same as text <> '', said before Python is involved
    made = with_normalised(written, "said", "text").drop("said")
    return made if "line" in carry else made.drop("line")


def split_column() -> object:
    """A document's split, by the last 32 bits of the hash of its id (what the DuckDB side can say too)."""
    spot = F.conv(F.left(F.sha2(F.concat(F.lit("document:"), F.col("source_doc_id")), 256), F.lit(8)), 16, 10).cast("long") % 100
    return F.when(spot < 70, "train").when(spot < 85, "dev").otherwise("synthetic_test")


def split_sentences(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """The English sentences, as the registered queries run the English profile, with the split of their documents."""
    return sentences(spark, sf_dir, docs, carry).where("language = 'EN'").select("clean_id", "source_doc_id", "publisher", "text", *carry).withColumn("split", split_column())


SPACE_SQL = r"[\s\x0B\x1c-\x1f\x{85}\p{Z}]+"
PUNCT_SQL = "[:punct:]…“”‘’—–"


def norm_sql(c: str) -> str:
    return f"trim(regexp_replace(nfc_normalize({c}), '{SPACE_SQL}', ' ', 'g'), ' ')"


SENTENCES_SQL = f"""
lines AS (SELECT doc_id, source, lang, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents),
sentences AS (SELECT doc_id::VARCHAR AS source_doc_id, source AS publisher, upper(lang) AS language, (doc_id % 100) / 100.0::DOUBLE AS language_confidence,
    doc_id % 97 = 0 AS is_duplicate, doc_id::VARCHAR || ':' || pos::VARCHAR AS clean_id, {norm_sql('line')} AS text FROM lines WHERE {norm_sql('line')} <> '')"""

_SPOT = "(('0x' || left(sha256('document:' || source_doc_id), 8))::BIGINT % 100)"
SPLIT_SQL = f"CASE WHEN {_SPOT} < 70 THEN 'train' WHEN {_SPOT} < 85 THEN 'dev' ELSE 'synthetic_test' END"
EN_SQL = f"""{SENTENCES_SQL},
en AS (SELECT clean_id, source_doc_id, publisher, text, {SPLIT_SQL} AS split FROM sentences WHERE language = 'EN')"""


def core_sql(t: str) -> str:
    return f"regexp_replace(regexp_replace({t}, '^[{PUNCT_SQL}]+', ''), '[{PUNCT_SQL}]+$', '')"


def prefix_sql(t: str) -> str:
    return f"regexp_extract({t}, '^([{PUNCT_SQL}]*)', 1)"


def suffix_sql(t: str) -> str:
    return f"CASE WHEN {core_sql(t)} = '' THEN '' ELSE regexp_extract({t}, '([{PUNCT_SQL}]*)$', 1) END"


def words_sql(words: object) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def cases_sql(column: str, mapping: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


P = ENGLISH
_OPEN = "right(prev, 1) IN ('a', 'e', 'i', 'o', 'u', 'w', 'y')"
_EXCEPTED = f"(core IN {words_sql(P.exception_words)} AND regexp_matches(prev, '(?:{'|'.join(P.exception_endings)})$'))"
_WITH = "array_to_string(list_concat(list_concat(words[1:i], {made}), words[i + 2:]), ' ')"


def _branch(kind: str, tag: str, family: str, where: str, made: str, correct: str, wrong: str, confidence: str) -> str:
    source = _WITH.format(made=made)
    return f"SELECT clean_id, {tag} AS tag, '{family}' AS family, '{kind}' AS kind, i AS position, {correct} AS correct, {wrong} AS wrong, {source} AS source_text, text AS target_text, '{confidence}' AS confidence, split, publisher, source_doc_id FROM toks WHERE {where}"


_WHOLE = "prefix = '' AND suffix = ''"
_CTX_WRONG = cases_sql("core", {k: w for k, (w, _) in P.contextual.items()})
_CTX_AFTER = "CASE core " + " ".join(f"WHEN '{k}' THEN {str(v).upper()}" for k, (_, v) in P.contextual.items()) + " END"
BRANCHES = {
    "swap": _branch("swap", "'$REPLACE_' || core", P.swap_family, f"core IN {words_sql(P.swaps)} AND {_WHOLE}", f"[{cases_sql('core', P.swaps)}]", "core", cases_sql("core", P.swaps), "high"),
    "pronoun": _branch("swap", "'$REPLACE_' || core", "pronoun", f"core IN {words_sql(P.pronouns)} AND {_WHOLE}", f"[{cases_sql('core', P.pronouns)}]", "core", cases_sql("core", P.pronouns), "medium"),
    "contextual": _branch("contextual", "'$REPLACE_' || core", "enclitic", f"core IN {words_sql(P.contextual)} AND i > 0 AND prefix = '' AND regexp_matches(prev, '\\p{{L}}$') AND ({_OPEN} AND NOT {_EXCEPTED}) = {_CTX_AFTER}", f"[{_CTX_WRONG} || suffix]", "core", _CTX_WRONG, "high"),
    "duplicate": _branch("duplicate", "'$DELETE'", "duplicate_word", f"lower(core) IN {words_sql(P.edit_contexts)} AND {_WHOLE} AND i > 0 AND i < n - 1", "[tok, tok]", "core", "''", "provisional"),
    "missing": _branch("missing", "'$APPEND_t1'", "missing_word", f"lower(core) IN {words_sql(P.edit_contexts)} AND {_WHOLE} AND n > 1 AND NOT (i = n - 1 AND i > 0)", "[]::VARCHAR[]", "core", "''", "provisional"),
    "case_lower": _branch("case_lower", "'$TRANSFORM_CASE_LOWER'", "casing", f"core IN {words_sql(P.case_words)} AND {_WHOLE} AND i > 0", "[upper(left(core, 1)) || core[2:]]", "core", "upper(left(core, 1)) || core[2:]", "high"),
    "add_mark": "SELECT clean_id, '$ADD_PUNC_' || CASE right(text, 1) WHEN '!' THEN 'EMARK' WHEN '.' THEN 'PERIOD' ELSE 'QMARK' END AS tag, 'punctuation' AS family, 'add_mark' AS kind, NULL::BIGINT AS position, right(text, 1) AS correct, '' AS wrong, left(text, length(text) - 1) AS source_text, text AS target_text, 'high' AS confidence, split, publisher, source_doc_id FROM en WHERE right(text, 1) IN ('!', '.', '?')",
    "case_capital": f"SELECT clean_id, '$TRANSFORM_CASE_CAPITAL' AS tag, 'casing' AS family, 'case_capital' AS kind, NULL::BIGINT AS position, core AS correct, lower(left(core, 1)) || core[2:] AS wrong, prefix || lower(left(core, 1)) || text[length(prefix) + 2:] AS source_text, text AS target_text, 'high' AS confidence, split, publisher, source_doc_id FROM toks WHERE i = 0 AND regexp_matches(core, '^\\p{{Lu}}') AND core <> upper(core)",
}
TOKENS_SQL = f"""{EN_SQL},
tok0 AS (SELECT *, string_split(text, ' ') AS words, unnest(range(len(string_split(text, ' ')))) AS i FROM en),
toks AS (SELECT *, len(words) AS n, words[i + 1] AS tok, {core_sql('words[i + 1]')} AS core, {prefix_sql('words[i + 1]')} AS prefix, {suffix_sql('words[i + 1]')} AS suffix, CASE WHEN i > 0 THEN lower({core_sql('words[i]')}) END AS prev FROM tok0)"""
CANDIDATES_SQL = f"""{TOKENS_SQL},
candidates AS (SELECT * FROM ({' UNION ALL '.join(BRANCHES.values())}) WHERE source_text <> target_text)"""
RANKED_SQL = f"""{CANDIDATES_SQL},
ranked AS (SELECT *, left(sha256(concat_ws('|', '{SEED}', clean_id, tag, source_text, target_text)), 32) AS pair_id, sha256(concat_ws('|', '{SEED}', clean_id, split, tag, source_text, target_text)) AS rank FROM candidates)"""
