"""Queries over sources, normalisation, the quality gate, integrity and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.profile import ENGLISH
from millrace.functions.text import core, length_bucket, prefix, shard_of, suffix, tokens, with_normalised
from millrace.operators import generate, quality, splits
from millrace.operators.splits import RATIOS
from millrace.plans.common import SEED, SENTENCES_SQL, core_sql, norm_sql, prefix_sql, sentences, split_column, suffix_sql, table, words_sql
from millrace.plans.common import SPLIT_SQL as _SPLIT

R = ENGLISH.rules


def norm_text_hash(spark: SparkSession, d: str) -> DataFrame:
    docs = with_normalised(table(spark, d, "documents").select("doc_id", "text"), "text", "norm")
    return docs.select("doc_id", F.sha2("norm", 256).alias("text_hash"), F.length("norm").cast("long").alias("norm_length"))


def uniqueness_assertion(spark: SparkSession, d: str) -> DataFrame:
    hashed = sentences(spark, d).select(F.sha2("text", 256).alias("h")).groupBy("h").count()
    out = hashed.agg(F.sum("count").alias("n_rows"), F.count("*").alias("n_unique"))
    return out.select("n_rows", "n_unique", (F.col("n_rows") - F.col("n_unique")).alias("n_duplicates"), (F.col("n_rows") == F.col("n_unique")).alias("passed"))


def integrity_summary(spark: SparkSession, d: str) -> DataFrame:
    per_text = sentences(spark, d).groupBy("text").agg(F.count("*").alias("n"), F.sum(F.col("is_duplicate").cast("long")).alias("marked"))
    return per_text.agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_texts"), F.sum("marked").alias("n_marked"), F.count_if(F.col("n") > 1).alias("n_repeated_texts"))


def source_left_joins(spark: SparkSession, d: str) -> DataFrame:
    orders, customers, nations = (table(spark, d, t) for t in ("orders", "customer", "nation"))
    joined = orders.join(customers, orders["o_custkey"] == customers["c_custkey"], "left").join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    publisher = F.coalesce(F.when(F.col("n_name") != "", F.col("n_name")), F.col("c_name"), F.lit("<unknown>"))
    return joined.select("o_orderkey", publisher.alias("publisher"), F.sha2(F.col("c_name"), 256).alias("name_hash"))


def _reasons(spark: SparkSession, d: str) -> DataFrame:
    return quality.with_reasons(sentences(spark, d), R)


def quality_reasons(spark: SparkSession, d: str) -> DataFrame:
    return _reasons(spark, d).select("clean_id", F.concat_ws(",", "reason_codes").alias("reasons"))


def quality_histogram(spark: SparkSession, d: str) -> DataFrame:
    return quality.histogram(_reasons(spark, d))


def quality_split_counts(spark: SparkSession, d: str) -> DataFrame:
    return _reasons(spark, d).groupBy(split_column().alias("split"), (F.size("reason_codes") == 0).alias("accepted")).agg(F.count("*").alias("n_rows"))


def code_switch_metrics(spark: SparkSession, d: str) -> DataFrame:
    out = quality.code_switch(sentences(spark, d), R)
    return out.select("clean_id", "n_words", "n_markers", "switch_ratio", "switch_borderline", "switch_clause")


def token_explode(spark: SparkSession, d: str) -> DataFrame:
    """Each token with its number, its sentences and its first position.

    A sentence's distinct tokens are counted beside its tokens, where the sentence is, so that what is shuffled is a row per token and task. Sentences that
    share an id (lines of documents that do) are told apart from the others first: theirs are the only ids that are compared.
    """
    docs = table(spark, d, "documents").select("doc_id", "text", "lang", "source")
    again = docs.groupBy("doc_id").agg(F.count("*").alias("times")).where("times > 1").select(F.col("doc_id").alias("again"))
    said, zero, one = tokens(F.col("text")), F.lit(0).cast("long"), F.lit(1).cast("long")

    def counted(some: DataFrame) -> DataFrame:
        every = some.select(F.posexplode(said).alias("first", "token")).select("token", one.alias("n"), zero.alias("n_sentences"), "first")
        once = some.select(F.explode(F.array_distinct(said)).alias("token")).select("token", zero.alias("n"), one.alias("n_sentences"), F.lit(None).cast("int").alias("first"))
        return every.unionByName(once)

    whole = lambda parts: parts.groupBy("token").agg(F.sum("n").alias("n"), F.sum("n_sentences").alias("n_sentences"), F.min("first").cast("long").alias("first_position"))
    if again.isEmpty():
        return whole(counted(sentences(spark, d)))
    same = docs["doc_id"].eqNullSafe(F.col("again"))
    known = generate.bounded(again)
    each = sentences(spark, d, docs.join(known, same, "left_semi")).select("clean_id", F.posexplode(said).alias("position", "token")).groupBy("clean_id", "token").agg(F.count("*").alias("n"), F.min("position").alias("first"))
    return whole(counted(sentences(spark, d, docs.join(known, same, "left_anti"))).unionByName(each.select("token", "n", one.alias("n_sentences"), "first")))


def token_parts(spark: SparkSession, d: str) -> DataFrame:
    words = sentences(spark, d).select(F.explode(tokens(F.col("text"))).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    t = F.col("token")
    return words.select("token", "n", core(t).alias("core"), prefix(t).alias("prefix"), suffix(t).alias("suffix"))


def length_buckets(spark: SparkSession, d: str) -> DataFrame:
    buckets = spark.createDataFrame([(b,) for b in ("<10", "10-19", "20-29", "30-49", "50+")], "bucket string")
    counted = sentences(spark, d).groupBy(length_bucket(F.col("text")).alias("bucket")).agg(F.count("*").alias("n"))
    return buckets.join(counted, "bucket", "left").fillna(0)


def group_split(spark: SparkSession, d: str) -> DataFrame:
    """Greedy split of whole documents; its balance is tested against the fold, and rows and groups are checked here."""
    keyed = sentences(spark, d).select("clean_id", splits.group_key(F.col("source_doc_id"), F.col("clean_id")).alias("group_key"))
    return splits.greedy_split(keyed, SEED).groupBy("split").agg(F.count("*").alias("n_rows"), F.countDistinct("group_key").alias("n_groups"))


def hash_group_split(spark: SparkSession, d: str) -> DataFrame:
    return sentences(spark, d).withColumn("split", split_column()).groupBy("split").agg(F.count("*").alias("n_rows"), F.countDistinct("source_doc_id").alias("n_groups"))


def shard_assignment(spark: SparkSession, d: str) -> DataFrame:
    return sentences(spark, d).groupBy(shard_of(F.col("clean_id"), 7).alias("shard")).agg(F.count("*").alias("n_rows"))


def leakage_semi_join(spark: SparkSession, d: str) -> DataFrame:
    """Sentences of documents that also stand, whole, in the benchmark."""
    bench = table(spark, d, "benchmark").select(F.explode(F.split("text", "\n")).alias("line"))
    known = with_normalised(bench, "line", "text").select(F.sha2("text", 256).alias("h")).distinct()
    return sentences(spark, d).withColumn("h", F.sha2("text", 256)).join(known, "h", "left_semi").select("clean_id", "publisher")


def conversation_turns(spark: SparkSession, d: str) -> DataFrame:
    turns = with_normalised(table(spark, d, "conversations"), "text", "norm")
    return turns.groupBy("role").agg(F.count("*").alias("n_turns"), F.countDistinct("conv_id").alias("n_conversations"), F.sum(F.size(tokens(F.col("norm")))).alias("n_tokens"))


def schema_catalog(spark: SparkSession, d: str) -> DataFrame:
    """Columns and types of every table, from the files' footers."""
    rows = [(t, f.name, f.dataType.simpleString(), i) for t in TABLES for i, f in enumerate(table(spark, d, t).schema.fields)]
    return spark.createDataFrame(rows, "table_name string, column_name string, type string, position int")


_WORDS = "list_transform(regexp_extract_all(text, '[A-Za-z]+'), lambda w: lower(w))"


def _marked(part: str) -> str:
    return f"(len(list_filter({part}, lambda w: w IN {words_sql(R.markers)})) >= {R.clause_min_markers} AND len(list_filter({part}, lambda w: w IN {words_sql(R.content)})) >= {R.clause_min_content})"


_SWITCH = f"""{SENTENCES_SQL},
w AS (SELECT *, {_WORDS} AS ws FROM sentences),
b AS (SELECT *, list_filter(range(len(ws)), lambda i: ws[i + 1] IN {words_sql(R.boundaries)}) AS bs, len(ws) AS n_words, len(list_filter(ws, lambda w: w IN {words_sql(R.markers)})) AS n_markers FROM w),
switched AS (SELECT *, n_words >= {R.min_tokens} AND n_markers >= {R.min_markers} AND n_markers / greatest(n_words, 1) >= {R.max_marker_ratio} AS switch_ratio,
    n_words >= {R.min_tokens} AND n_markers >= {R.min_markers} AND n_markers / greatest(n_words, 1) >= {R.borderline_ratio} AND n_markers / greatest(n_words, 1) < {R.max_marker_ratio} AS switch_borderline,
    n_words >= {R.min_tokens} AND len(bs) > 0 AND ((bs[1] >= {R.clause_min_tokens} AND {_marked('ws[1:bs[1]]')}) OR (n_words - bs[-1] - 1 >= {R.clause_min_tokens} AND {_marked('ws[bs[-1] + 2:]')})) AS switch_clause FROM b)"""
_BRACKETS = r"""list_reduce(list_filter(string_split(regexp_replace(text, '[^()\[\]{}]', '', 'g'), ''), lambda c: c <> ''),
    lambda a, c: CASE WHEN left(a, 1) = 'X' THEN a WHEN c IN ('(', '[', '{') THEN a || c WHEN length(a) > 0 AND right(a, 1) = translate(c, ')]}', '([{') THEN left(a, length(a) - 1) ELSE 'X' END, '') <> ''"""


def _n(mark: str) -> str:
    return f"(length(text) - length(replace(text, '{mark}', '')))"


def _text(value: str) -> str:
    return " || ".join(f"chr({ord(c)})" for c in value)


def _around(pattern: str) -> str:
    """A pattern whose looks around it are written as what may stand there, for an engine without them."""
    return pattern.replace("(?<!\\w)", "(?:^|[^\\p{L}\\p{N}_])").replace("(?!\\w)", "(?:$|[^\\p{L}\\p{N}_])")


_CHECKS = [
    ("empty_text", "text = ''"),
    ("nul_character", "contains(text, chr(0))"),
    ("no_letter", "text <> '' AND NOT regexp_matches(text, '\\p{L}')"),
    ("too_long", f"length(text) > {R.max_characters}"),
    ("low_alphabetic_ratio", f"text <> '' AND length(regexp_replace(text, '\\P{{L}}', '', 'g')) / greatest(length(replace(text, ' ', '')), 1) < {R.min_alphabetic_ratio}"),
    ("repeated_punctuation", f"regexp_matches(text, '[!?.,;:]{{{R.max_repeated_punctuation + 1},}}')"),
    ("boilerplate", " OR ".join(f"regexp_full_match(text, '(?i)(?:{p})')" for p in R.boilerplate)),
    ("upstream_duplicate_marker", "is_duplicate"),
    ("language_mismatch", f"coalesce(language, '') <> '{R.required_language}'"),
    ("low_language_confidence", f"language_confidence IS NULL OR language_confidence < {R.min_language_confidence}"),
    ("language_code_switch_ratio", "switch_ratio"),
    ("language_code_switch_borderline", "switch_borderline"),
    ("language_code_switch_clause", "switch_clause"),
    ("unbalanced_bracket", _BRACKETS),
    ("unbalanced_quote", f"{_n(chr(34))} % 2 = 1 OR {_n('“')} <> {_n('”')}"),
    ("control_character", "regexp_matches(text, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]')"),
    ("sentence_integrity_too_short", f"len(string_split(text, ' ')) < {R.integrity_min_tokens}"),
    ("sentence_integrity_leading_closer", "left(text, 1) IN ('.', ',', ';', ':', '!', '?', ')', ']', '}')"),
    ("sentence_integrity_trailing_opener", "right(text, 1) IN ('(', '[', '{')"),
    ("suspicious_encoding", " OR ".join(f"contains(text, {_text(m)})" for m in R.mojibake)),
    ("informal_marker", " OR ".join(f"regexp_matches(text, '{_around(p)}')" for p in R.informal)),
    ("url_or_email", "regexp_matches(text, '(?i)(?:https?://|www\\.|[\\p{L}\\p{N}_.+-]+@[\\p{L}\\p{N}_.-]+\\.[A-Za-z]{2,})')"),
]
_REASONS = f"""{_SWITCH},
reasoned AS (SELECT *, list_filter([{', '.join(f"CASE WHEN {test} THEN '{code}' END" for code, test in _CHECKS)}], lambda c: c IS NOT NULL) AS codes FROM switched)"""

_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "FLOAT": "float", "DATE": "date", "TIMESTAMP": "timestamp_ntz", "TIMESTAMP WITH TIME ZONE": "timestamp", "BOOLEAN": "boolean", "FLOAT[]": "array<float>", "DOUBLE[]": "array<double>"}
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
_FILL = [f"{{'fill': f{i} / (total * {r}), 'tie': sha256('{SEED}' || chr(0) || k || ':{s}'), 'split': '{s}'}}" for i, (s, r) in enumerate(RATIOS.items())]
_GREEDY = f"""WITH RECURSIVE {SENTENCES_SQL},
    counted AS MATERIALIZED (SELECT 'document:' || source_doc_id AS k, count(*)::BIGINT AS n FROM sentences GROUP BY source_doc_id),
    ordered AS MATERIALIZED (SELECT k, n, sum(n) OVER ()::BIGINT AS total, row_number() OVER (ORDER BY n DESC, sha256('{SEED}' || chr(0) || k)) AS g FROM counted),
    fold(g, {', '.join(f'f{i}' for i in range(len(RATIOS)))}, split, n) AS (SELECT 0::BIGINT, {', '.join('0::BIGINT' for _ in RATIOS)}, '', 0::BIGINT
        UNION ALL SELECT g, {', '.join(f"f{i} + CASE WHEN split = '{s}' THEN n ELSE 0 END" for i, s in enumerate(RATIOS))}, split, n
        FROM (SELECT o.g, {', '.join(f'f.f{i}' for i in range(len(RATIOS)))}, list_min([{', '.join(_FILL)}]).split AS split, o.n FROM fold f JOIN ordered o ON o.g = f.g + 1))
    SELECT split, sum(n)::BIGINT AS n_rows, count(*) AS n_groups FROM fold WHERE g > 0 GROUP BY split"""

QUERIES = {f.__name__: f for f in (norm_text_hash, uniqueness_assertion, integrity_summary, source_left_joins, quality_reasons, quality_histogram, quality_split_counts, code_switch_metrics, token_explode, token_parts, length_buckets, group_split, hash_group_split, shard_assignment, leakage_semi_join, conversation_turns, schema_catalog)}
ORACLES = {
    "norm_text_hash": f"SELECT doc_id, sha256({norm_sql('text')}) AS text_hash, length({norm_sql('text')}) AS norm_length FROM documents",
    "uniqueness_assertion": f"WITH {SENTENCES_SQL}, u AS (SELECT count(*) AS n_rows, count(DISTINCT sha256(text)) AS n_unique FROM sentences) SELECT n_rows, n_unique, n_rows - n_unique AS n_duplicates, n_rows = n_unique AS passed FROM u",
    "integrity_summary": f"WITH {SENTENCES_SQL}, t AS (SELECT text, count(*) AS n, sum(is_duplicate::BIGINT) AS m FROM sentences GROUP BY text) SELECT sum(n)::BIGINT AS n_rows, count(*) AS n_texts, sum(m)::BIGINT AS n_marked, count(*) FILTER (n > 1) AS n_repeated_texts FROM t",
    "source_left_joins": "SELECT o_orderkey, coalesce(nullif(n_name, ''), c_name, '<unknown>') AS publisher, sha256(c_name) AS name_hash FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey",
    "quality_reasons": f"WITH {_REASONS} SELECT clean_id, array_to_string(codes, ',') AS reasons FROM reasoned",
    "quality_histogram": f"WITH {_REASONS} SELECT reason, count(*) AS n_rows FROM (SELECT unnest(codes) AS reason FROM reasoned) GROUP BY reason",
    "quality_split_counts": f"WITH {_REASONS} SELECT {_SPLIT} AS split, len(codes) = 0 AS accepted, count(*) AS n_rows FROM reasoned GROUP BY 1, 2",
    "code_switch_metrics": f"WITH {_SWITCH} SELECT clean_id, n_words, n_markers, switch_ratio, switch_borderline, switch_clause FROM switched",
    "token_explode": f"WITH {SENTENCES_SQL}, t AS (SELECT clean_id, unnest(string_split(text, ' ')) AS token, unnest(range(len(string_split(text, ' ')))) AS position FROM sentences) SELECT token, count(*) AS n, count(DISTINCT clean_id) AS n_sentences, min(position) AS first_position FROM t GROUP BY token",
    "token_parts": f"WITH {SENTENCES_SQL}, t AS (SELECT unnest(string_split(text, ' ')) AS token FROM sentences), g AS (SELECT token, count(*) AS n FROM t GROUP BY token) SELECT token, n, {core_sql('token')} AS core, {prefix_sql('token')} AS prefix, {suffix_sql('token')} AS suffix FROM g",
    "length_buckets": f"WITH {SENTENCES_SQL}, l AS (SELECT len(string_split(text, ' ')) AS n FROM sentences), b(bucket) AS (VALUES ('<10'), ('10-19'), ('20-29'), ('30-49'), ('50+')), c AS (SELECT CASE WHEN n < 10 THEN '<10' WHEN n < 20 THEN '10-19' WHEN n < 30 THEN '20-29' WHEN n < 50 THEN '30-49' ELSE '50+' END AS bucket, count(*) AS n FROM l GROUP BY 1) SELECT bucket, coalesce(n, 0) AS n FROM b LEFT JOIN c USING (bucket)",
    "group_split": _GREEDY,
    "schema_catalog": f"SELECT table_name, column_name, CASE data_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in _TYPES.items())} ELSE data_type END AS type, (ordinal_position - 1)::INTEGER AS position FROM information_schema.columns WHERE table_name IN {words_sql(TABLES)}",
    "hash_group_split": f"WITH {SENTENCES_SQL} SELECT {_SPLIT} AS split, count(*) AS n_rows, count(DISTINCT source_doc_id) AS n_groups FROM sentences GROUP BY 1",
    "shard_assignment": f"WITH {SENTENCES_SQL} SELECT list_reduce(list_transform(range(16), lambda i: ('0x' || substr(sha256(clean_id), (4 * i + 1)::BIGINT, 4))::BIGINT), lambda a, x: (a * 65536 + x) % 7, 0::BIGINT) AS shard, count(*) AS n_rows FROM sentences GROUP BY 1",
    "leakage_semi_join": f"WITH {SENTENCES_SQL}, k AS (SELECT DISTINCT {norm_sql('line')} AS text FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM benchmark)) SELECT clean_id, publisher FROM sentences WHERE text IN (SELECT text FROM k)",
    "conversation_turns": f"WITH t AS (SELECT role, conv_id, {norm_sql('text')} AS text FROM conversations) SELECT role, count(*) AS n_turns, count(DISTINCT conv_id) AS n_conversations, sum(CASE WHEN text = '' THEN 0 ELSE len(string_split(text, ' ')) END)::BIGINT AS n_tokens FROM t GROUP BY role",
}
