"""Queries over places, operations, ordered files, counters, leakage and reviewed resources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.profile import ENGLISH
from millrace.functions.text import with_normalised
from millrace.operators import diagnostics, evaluate, first_come, generate, replay, select
from millrace.plans.common import CANDIDATES_SQL, EN_SQL, RANKED_SQL, SEED, TOKENS_SQL, dealt, norm_sql, split_sentences, table
from millrace.plans.evaluation import NOISE
from millrace.plans.pairs import ORACLES as PAIR_ORACLES
from millrace.plans.pairs import PARADIGM
from millrace.sources import frozen, positions, readers
from millrace.sources.workspace import Workspace

FIRST_COME = 7
#: Rules of the noise queries with the categories and statuses that two edits in one sample need.
SEEN = {"n1": True, "n2": False, "n3": True, "n4": True, "n5": False}


def _placed(spark: SparkSession, d: str) -> DataFrame:
    """All candidates with the file and row of their document, its line, and their place in it."""
    docs = positions.positioned(table(spark, d, "documents")).select("doc_id", "text", "lang", "source", "file", "row")
    made = generate.generate(split_sentences(spark, d, dealt(docs, "doc_id"), ("file", "row", "line")), ENGLISH)
    return made.withColumn("spot", F.coalesce("position", F.lit(-1)))


def first_come_selection(spark: SparkSession, d: str) -> DataFrame:
    """Candidates in the order of the table's files and rows, the first of each split and tag."""
    quotas = {(s, t): FIRST_COME for t, _ in ENGLISH.tags for s in ("train", "dev", "synthetic_test")}
    found = first_come.select_first_come(_placed(spark, d), order=["file", "row", "line", "spot"], quotas=quotas)
    doc = F.col("row").cast("long").alias("doc_row")
    return found.selected.select("split", "tag", doc, F.col("line").cast("long").alias("line"), "spot", F.col("taken").cast("long").alias("taken"))


def first_come_rejections(spark: SparkSession, d: str) -> DataFrame:
    """What first-come selection passes over, by split: pairs that occurred before, and rows behind a full quota."""
    quotas = {(s, t): FIRST_COME for t, _ in ENGLISH.tags for s in ("train", "dev", "synthetic_test")}
    found = first_come.select_first_come(_placed(spark, d), order=["file", "row", "line", "spot"], quotas=quotas)
    over = found.over_quota.groupBy("split").agg(F.count("*").alias("n_over_quota"))
    again = spark.createDataFrame(sorted(found.collisions.items()), "split string, n_collisions long")  # one row per split
    return again.join(over, "split", "left").select("split", "n_collisions", F.coalesce("n_over_quota", F.lit(0)).alias("n_over_quota"))


def operation_spans(spark: SparkSession, d: str) -> DataFrame:
    """The operation of every candidate, with its spans, and whether it makes the correct sentence again."""
    made = replay.with_operation(generate.generate(split_sentences(spark, d), ENGLISH))
    judged = made.withColumn("v", replay.validated(F.col("source_text"), F.col("target_text"), F.col("operation")))
    long = lambda c, name: F.col(c).cast("long").alias(name)
    return judged.select("clean_id", "tag", "position", "operation.type", long("operation.start", "start"), long("operation.end", "end"), "operation.source_surface", "operation.target_surface", long("operation.anchor_end", "anchor_end"), "operation.anchor_surface", "v.success", long("v.target_start", "target_start"), long("v.target_end", "target_end"))


def token_offsets(spark: SparkSession, d: str) -> DataFrame:
    """Words of the raw lines of all documents, by any white space, and what their offsets add up to; each is the text at its offsets."""
    lines = table(spark, d, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("said"))
    spans = lines.select("doc_id", "said", F.explode(replay.token_spans(F.col("said"))).alias("t"))
    there = F.substring(F.col("said"), F.col("t.start") + 1, F.col("t.end") - F.col("t.start")) == F.col("t.token")
    return spans.groupBy("doc_id").agg(F.count("*").alias("n_tokens"), F.sum("t.start").alias("starts"), F.sum("t.end").alias("ends"), F.count_if(there).alias("n_there"))


def json_line_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Documents written as JSON lines with planted faults, in order of id; the faults by number of line over all files."""
    path = Workspace(spark, "json-lines").path("lines")
    value = F.when(F.col("doc_id") % 13 == 0, "not an object").when(F.col("doc_id") % 17 == 0, '{"doc_id": ').when(F.col("doc_id") % 19 == 0, "").otherwise(F.to_json(F.struct("doc_id", "lang", "source", "text")))
    table(spark, d, "documents").repartitionByRange("doc_id").sortWithinPartitions("doc_id").select(value.alias("value")).write.text(path)
    sizes = spark.read.text(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"))
    before = sizes.alias("a").join(sizes.alias("b"), F.col("b.file") < F.col("a.file"), "left").groupBy(F.col("a.file").alias("file")).agg(F.coalesce(F.sum("b.n"), F.lit(0)).alias("before"))
    return positions.json_line_faults(spark, path).join(before, "file").select((F.col("line") + F.col("before")).alias("line"), "fault")


def ordered_output(spark: SparkSession, d: str) -> DataFrame:
    """All ranked candidates, written in order and read back with their positions over all files."""
    ws = Workspace(spark, "ordered")
    path, made = ws.path("candidates"), select.with_rank(generate.generate(split_sentences(spark, d), ENGLISH), SEED)
    # Ranks are kept as bytes, whose order is that of their digits; saved once, as ranges are sampled before they are dealt out.
    ranked = ws.save(made.select("split", "tag", F.unhex("rank").alias("rank"), "clean_id", F.coalesce("position", F.lit(-1)).alias("spot")), "ranked")
    positions.write_ordered(ranked, path, ["split", "tag", "rank", "clean_id", "spot"])
    ws.drop(ranked)
    return positions.read_ordered(spark, path).select("position", "split", "tag", F.lower(F.hex("rank")).alias("rank"), "clean_id", "spot")


def diagnostics_report(spark: SparkSession, d: str) -> DataFrame:
    """Every candidate, verb forms included, and every sentence as an identity: counted by tag, family, length, publisher and state transition, and cross-checked."""
    sentences = split_sentences(spark, d)
    states = {"source_state": F.lit(None).cast("string"), "target_state": F.lit(None).cast("string")}
    columns = ["is_errorful", "tag", "family", "target_text", "publisher", "source_state", "target_state"]
    made = generate.generate(sentences, ENGLISH).withColumns(states).withColumn("is_errorful", F.lit(True)).select(columns)
    verbs = generate.verb_states(sentences, spark.createDataFrame(PARADIGM, "lemma string, surface string, state string")).withColumn("is_errorful", F.lit(True)).select(columns)
    same = sentences.withColumns(states | {"is_errorful": F.lit(False), "tag": F.lit(None).cast("string"), "family": F.lit(None).cast("string"), "target_text": F.col("text")}).select(columns)
    return diagnostics.report(made.unionByName(verbs).unionByName(same), list(ENGLISH.tags))


def telemetry_samples(spark: SparkSession, d: str) -> DataFrame:
    """Words that could be doubled or dropped: what became of them, with the first places of each outcome, and sentences without any."""
    sentences = split_sentences(spark, d)
    touched = generate.touched_tokens(sentences, list(ENGLISH.edit_contexts))
    affixed = (F.col("prefix") != "") | (F.col("suffix") != "")
    edge = (F.col("index") == 0) | (F.col("index") == F.col("n") - 1)
    doubled = touched.select("clean_id", F.lit("$DELETE").alias("tag"), F.col("index").alias("position"), F.when(affixed, "affixed").when(edge, "unsafe_or_ambiguous_construction").alias("reason"))
    dropped = touched.select("clean_id", F.lit("$APPEND_t1").alias("tag"), F.col("index").alias("position"), F.when(affixed, "affixed").when((F.col("index") == F.col("n") - 1), "no_word_after").alias("reason"))
    out = diagnostics.telemetry(doubled.unionByName(dropped), sentences, ["$DELETE", "$APPEND_t1"])
    return out.select("tag", "outcome", "n", "positions", F.concat_ws(",", F.transform("samples", lambda x: F.concat_ws("@", x["clean_id"], x["position"].cast("string")))).alias("samples"))


def _bench(spark: SparkSession, d: str) -> DataFrame:
    return with_normalised(table(spark, d, "benchmark").select(F.col("item_id").cast("string").alias("sample_id"), F.col("text").alias("line")), "line", "text").drop("line")


def noise_mixed(spark: SparkSession, d: str) -> DataFrame:
    """Two edits of distinct categories and one status in each benchmark item that has room for them."""
    rules = spark.createDataFrame([(*r, SEEN[r[0]]) for r in NOISE], "id string, category string, source string, target string, seen boolean")
    made = evaluate.inject_mixed_noise(_bench(spark, d), rules, 7)
    plain = F.transform("edits", lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end"), e["target"].alias("target")))
    return made.select("sample_id", "noisy_text", "seen_status", *[F.get("edits", F.lit(k))[f].alias(f"{f}_{k + 1}") for k in (0, 1) for f in ("id", "start")], (evaluate.apply_edits(F.col("noisy_text"), plain) == F.col("text")).alias("replays"))


def leakage_mixed(spark: SparkSession, d: str) -> DataFrame:
    """An external folder of JSON, JSON lines and Parquet files, made of the tables: its ids and texts that our documents hold too."""
    root = Workspace(spark, "external").path("files")
    bench, docs, turns = table(spark, d, "benchmark"), table(spark, d, "documents"), table(spark, d, "conversations")
    bench.select(F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("base_clean_id"), F.col("text").alias("raw_informal")).write.parquet(f"{root}/views/parquet")
    lines = docs.where("lang = 'en'").select(F.col("doc_id").alias("clean_id"), F.col("text").alias("source_text"))
    lines.select(F.to_json(F.struct("*")).alias("value")).write.text(f"{root}/views/deep/text")
    turns.select(F.to_json(F.struct(F.col("conv_id").alias("source_clean_id"), F.col("text").alias("normalized"))).alias("value")).write.text(f"{root}/turns")
    nations = table(spark, d, "nation").select(F.struct(F.col("n_nationkey").alias("clean_id"), F.col("n_name").alias("text")).alias("r"))  # a table of 25 rows
    nations.agg(F.to_json(F.struct(F.collect_list("r").alias("rows"))).alias("value")).coalesce(1).write.text(f"{root}/json")
    for folder, ending in (("views/deep/text", ".jsonl"), ("turns", ".jsonl"), ("json", ".json")):
        _renamed(spark, f"{root}/{folder}", ".txt", ending)
    found = readers.external_scan(spark, root)
    ours = docs.select(F.explode(F.array(F.struct(F.lit("id").alias("kind"), F.col("doc_id").cast("string").alias("value")), F.struct(F.lit("text").alias("kind"), F.col("text").alias("value")))).alias("k")).select("k.*").distinct()
    held = found.groupBy("kind").agg(F.count("*").alias("n_external"))
    return held.join(found.join(ours, ["kind", "value"], "left_semi").groupBy("kind").agg(F.count("*").alias("n_leaked")), "kind", "left").select("kind", "n_external", F.coalesce("n_leaked", F.lit(0)).alias("n_leaked"))


def _renamed(spark: SparkSession, folder: str, old: str, new: str) -> None:
    """Gives the files of a folder another ending: Spark's text writer has none for JSON lines."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(folder)
    system = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for f in system.listStatus(at):
        name = f.getPath().getName()
        if name.endswith(old):
            system.rename(f.getPath(), jvm.org.apache.hadoop.fs.Path(at, name[: -len(old)] + new))


def frozen_digest(spark: SparkSession, d: str) -> DataFrame:
    """Documents, frozen by their rows and read back verified: rows and the sums that the digest is made of, by language."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars").withColumn("review_status", F.lit("approved"))
    target = Workspace(spark, "frozen").path("documents")
    frozen.freeze_table(docs, target, version="1", reviewer="query")
    held = frozen.load_frozen_table(spark, target, schema="doc_id long", version="1").drop("review_status")
    part = lambda k: F.sum(F.conv(F.substring("h", 8 * k + 1, 8), 16, 10).cast("long")).alias(f"sum_{k}")
    return held.select("lang", frozen.row_hash(held).alias("h")).groupBy("lang").agg(F.count("*").alias("rows"), part(0), part(7))


def sentence_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Lines of documents as sentences with articles and sources: staged, with a hash of their metadata as JSON."""
    docs, c = table(spark, d, "documents"), F.col
    lines = docs.select("doc_id", "lang", "source", F.posexplode(F.split("text", "\n")).alias("pos", "said"))
    none = lambda kind: F.lit(None).cast(kind)
    sentences = lines.select(
        F.concat_ws(":", c("doc_id").cast("string"), c("pos").cast("string")).alias("sentence_id"), c("doc_id").cast("string").alias("article_id"), c("source").alias("source_id"), c("said").alias("sentence_text"), none("string").alias("normalized_text"), c("lang").alias("language"),
        ((c("doc_id") % 100) / 100.0).alias("language_confidence"), F.size(F.split("said", " ")).alias("token_count"), none("double").alias("quality_score"), c("said").startswith('"').cast("int").alias("is_quote"), (c("pos") == 0).cast("int").alias("is_headline"), F.sha2("said", 256).alias("content_hash"),
        (c("doc_id") % 97 == 0).cast("int").alias("is_duplicate"), none("string").alias("duplicate_group_id"),
    )
    url = F.concat(F.lit("https://"), F.coalesce("source", F.lit("x")), F.lit("/"), c("doc_id").cast("string"))
    articles = docs.where("doc_id % 11 <> 0").select(c("doc_id").cast("string").alias("article_id"), F.when(c("doc_id") % 7 != 0, url).otherwise("").alias("url"), F.when(c("doc_id") % 2 == 0, "").otherwise(F.upper(url)).alias("canonical_url"), none("string").alias("publication_date"), F.element_at(F.split("text", "\n"), 1).alias("headline"))
    names = docs.select("source").distinct().where("source is not null")
    sources = names.select(c("source").alias("source_id"), F.when(F.length("source") % 2 == 0, F.upper("source")).otherwise("").alias("name"), F.concat("source", F.lit(".example")).alias("domain"))
    staged = readers.staged(readers.sentence_rows(sentences, articles, sources))
    return staged.select("clean_id", "publisher", "source_doc_id", "url_hash", F.sha2("metadata_json", 256).alias("metadata_sha256"))


QUERIES = {f.__name__: f for f in (first_come_selection, first_come_rejections, operation_spans, token_offsets, json_line_numbers, ordered_output, diagnostics_report, telemetry_samples, noise_mixed, leakage_mixed, frozen_digest, sentence_metadata)}

_FIRST = f"""{CANDIDATES_SQL},
ordered AS (SELECT *, source_doc_id::BIGINT AS doc, split_part(clean_id, ':', 2)::BIGINT AS line, coalesce(position, -1)::BIGINT AS spot FROM candidates),
kept AS (SELECT *, count(*) OVER (PARTITION BY source_text, target_text) AS times FROM ordered QUALIFY row_number() OVER (PARTITION BY source_text, target_text ORDER BY doc, line, spot, split, tag) = 1),
placed AS (SELECT *, row_number() OVER (PARTITION BY split, tag ORDER BY doc, line, spot) AS taken FROM kept),
rows AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS doc_row FROM documents)"""
_W = "string_split(source_text, ' ')"
_LEAD = "length(regexp_extract({0}, '^([" + "[:punct:]…“”‘’—–" + "]*)', 1))"
_BEFORE = f"length(array_to_string({_W}[1:coalesce(position, 0)], ' '))"
_AT = f"({_BEFORE} + CASE WHEN position > 0 THEN 1 ELSE 0 END)"
_HERE = f"{_W}[coalesce(position, 0) + 1]"
_SPANS = f"""{CANDIDATES_SQL},
started AS (SELECT *, CASE kind WHEN 'add_mark' THEN 'add_punctuation' WHEN 'missing' THEN 'append' WHEN 'duplicate' THEN 'duplicate' WHEN 'case_lower' THEN 'case' WHEN 'case_capital' THEN 'case' ELSE 'replace' END AS type,
    CASE kind WHEN 'duplicate' THEN {_AT} + length({_HERE}) WHEN 'case_capital' THEN {_LEAD.format(f'{_W}[1]')} WHEN 'add_mark' THEN NULL WHEN 'missing' THEN NULL ELSE {_AT} + {_LEAD.format(_HERE)} END AS start,
    CASE WHEN kind = 'missing' AND position > 0 THEN {_BEFORE} END AS anchor_end, CASE WHEN kind = 'missing' AND position > 0 THEN {_W}[position] END AS anchor_surface FROM candidates),
ended AS (SELECT *, start + CASE WHEN kind = 'duplicate' THEN 1 + length({_W}[position + 2]) ELSE length(wrong) END AS "end" FROM started)"""
_LENGTH = "CASE WHEN len(string_split({0}, ' ')) < 10 THEN '<10' WHEN len(string_split({0}, ' ')) < 20 THEN '10-19' WHEN len(string_split({0}, ' ')) < 30 THEN '20-29' WHEN len(string_split({0}, ' ')) < 50 THEN '30-49' ELSE '50+' END"
_VERBS = PAIR_ORACLES["gen_morphology"]
_TAGS = ", ".join(f"('{t}', '{f}')" for t, f in dict.fromkeys(ENGLISH.tags))
_RULES = ", ".join(f"('{i}', '{c}', '{s}', '{t}', {str(SEEN[i]).upper()})" for i, c, s, t in NOISE)
_APART = "(y.start >= x.start + length(x.target) OR y.start + length(y.target) <= x.start)"
_TOLD = """
    told AS (SELECT tag, outcome, count(*) AS n, count(*) AS positions, array_to_string(list(clean_id || '@' || i ORDER BY clean_id, i)[1:25], ',') AS samples FROM events GROUP BY tag, outcome)"""
ORACLES = {
    "first_come_selection": f"WITH {_FIRST} SELECT split, tag, doc_row, line, spot, taken FROM placed JOIN rows ON doc = doc_id WHERE taken <= {FIRST_COME} AND tag IN (SELECT tag FROM (VALUES {_TAGS}) r(tag, family))",
    "first_come_rejections": f"WITH {_FIRST} SELECT split, sum(times - 1)::BIGINT AS n_collisions, count(*) FILTER (taken > {FIRST_COME}) AS n_over_quota FROM placed GROUP BY split",
    "operation_spans": f"""WITH {_SPANS} SELECT clean_id, tag, position, type, start, "end", CASE WHEN kind = 'duplicate' THEN ' ' || {_W}[position + 2] WHEN start IS NOT NULL THEN wrong END AS source_surface,
        CASE WHEN kind = 'duplicate' THEN '' ELSE correct END AS target_surface, anchor_end, anchor_surface, TRUE AS success, CASE kind WHEN 'missing' THEN coalesce(anchor_end, 0) WHEN 'add_mark' THEN length(source_text) ELSE start END AS target_start,
        CASE kind WHEN 'missing' THEN coalesce(anchor_end, 0) WHEN 'add_mark' THEN length(source_text) ELSE "end" END + length(target_text) - length(source_text) AS target_end FROM ended""",
    "token_offsets": r"""WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS said FROM documents),
        cut AS (SELECT doc_id, regexp_extract_all(said, '[^\s\x0B\x1c-\x1f\x{85}\p{Z}]+') AS w, regexp_split_to_array(said, '[^\s\x0B\x1c-\x1f\x{85}\p{Z}]+') AS g FROM lines),
        own AS (SELECT doc_id, len(w) AS n, list_transform(range(1, len(w) + 1), lambda i: coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(w[1:i - 1], lambda x: length(x))), 0)) AS s, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS chars FROM cut)
        SELECT doc_id, sum(n)::BIGINT AS n_tokens, sum(list_sum(s))::BIGINT AS starts, sum(list_sum(s) + chars)::BIGINT AS ends, sum(n)::BIGINT AS n_there FROM own WHERE n > 0 GROUP BY doc_id""",
    "json_line_numbers": "WITH l AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS line FROM documents) SELECT line, CASE WHEN doc_id % 13 = 0 THEN 'not an object' ELSE 'invalid JSON' END AS fault FROM l WHERE doc_id % 13 = 0 OR doc_id % 17 = 0",
    "ordered_output": f"WITH {RANKED_SQL} SELECT row_number() OVER (ORDER BY split, tag, rank, clean_id, coalesce(position, -1)) - 1 AS position, split, tag, rank, clean_id, coalesce(position, -1)::BIGINT AS spot FROM ranked",
    "diagnostics_report": f"""WITH {CANDIDATES_SQL}, m AS ({_VERBS}), v(surface, state) AS (VALUES {', '.join(f"('{s}', '{t}')" for _, s, t in PARADIGM)}),
        rows AS (SELECT TRUE AS e, tag, family, target_text AS t, publisher, NULL AS transition FROM candidates
            UNION ALL SELECT TRUE, m.tag, m.family, m.target_text, en.publisher, v.state || ' -> ' || replace(m.tag, '$TRANSFORM_VERB_', '') FROM m JOIN en USING (clean_id) JOIN v ON v.surface = m.wrong
            UNION ALL SELECT FALSE, NULL, NULL, text, publisher, NULL FROM en),
        d AS (SELECT 'tag' AS dimension, tag AS value, e FROM rows UNION ALL SELECT 'family', family, e FROM rows UNION ALL SELECT 'bucket', {_LENGTH.format('t')}, e FROM rows
            UNION ALL SELECT 'publisher', coalesce(publisher, '<unknown>'), e FROM rows UNION ALL SELECT 'transition', transition, e FROM rows UNION ALL SELECT 'total', 'rows', e FROM rows),
        c AS (SELECT dimension, value, count(*) AS n, count(*) FILTER (e) AS n_errorful, count(*) FILTER (NOT e) AS n_identity FROM d WHERE value IS NOT NULL GROUP BY dimension, value),
        r AS (SELECT 'tag' AS dimension, tag AS value FROM (VALUES {_TAGS}) x(tag, family) UNION SELECT 'family', family FROM (VALUES {_TAGS}) x(tag, family) UNION SELECT 'bucket', unnest({diagnostics.BUCKETS}))
        SELECT dimension, value, coalesce(n, 0) AS n, coalesce(n_errorful, 0) AS n_errorful, coalesce(n_identity, 0) AS n_identity FROM c FULL JOIN r USING (dimension, value)""",
    "telemetry_samples": f"""WITH {TOKENS_SQL}, hit AS (SELECT *, prefix <> '' OR suffix <> '' AS affixed FROM toks WHERE lower(core) IN ('{"', '".join(ENGLISH.edit_contexts)}')),
        events AS (SELECT clean_id, i, '$DELETE' AS tag, CASE WHEN affixed THEN 'affixed' WHEN i = 0 OR i = n - 1 THEN 'unsafe_or_ambiguous_construction' ELSE 'selected' END AS outcome FROM hit
            UNION ALL SELECT clean_id, i, '$APPEND_t1', CASE WHEN affixed THEN 'affixed' WHEN i = n - 1 THEN 'no_word_after' ELSE 'selected' END FROM hit),{_TOLD}
        SELECT * FROM told UNION ALL SELECT tag, 'not_applicable', (SELECT count(*) FROM en) - (SELECT count(DISTINCT clean_id) FROM hit), 0, '' FROM (VALUES ('$DELETE'), ('$APPEND_t1')) t(tag)""",
    "noise_mixed": f"""WITH b AS (SELECT item_id::VARCHAR AS sample_id, {norm_sql('text')} AS text FROM benchmark), rules(id, category, source, target, seen) AS (VALUES {_RULES}),
        w AS (SELECT *, string_split(text, ' ') AS ws, unnest(range(len(string_split(text, ' ')))) AS k FROM b),
        h AS (SELECT *, CASE WHEN k = 0 THEN 0 ELSE length(array_to_string(ws[1:k], ' ')) + 1 END AS start FROM w JOIN rules ON ws[k + 1] = target),
        p AS (SELECT sample_id, text, id, category, source, target, seen, start, row_number() OVER (PARTITION BY sample_id, seen ORDER BY sha256(concat_ws('|', '7', sample_id, 'mixed_noise', id, start::VARCHAR)), id, start) AS n FROM h),
        two AS (SELECT x.*, y.id AS id_y, y.source AS source_y, y.target AS target_y, y.start AS start_y FROM p x JOIN p y ON x.sample_id = y.sample_id AND x.seen = y.seen AND x.n = 1 AND x.category <> y.category AND {_APART}
            QUALIFY row_number() OVER (PARTITION BY x.sample_id ORDER BY x.seen DESC, y.n) = 1),
        o AS (SELECT sample_id, text, seen, CASE WHEN start < start_y THEN {{'id': id, 's': start, 'a': source, 'b': target}} ELSE {{'id': id_y, 's': start_y, 'a': source_y, 'b': target_y}} END AS l, CASE WHEN start < start_y THEN {{'id': id_y, 's': start_y, 'a': source_y, 'b': target_y}} ELSE {{'id': id, 's': start, 'a': source, 'b': target}} END AS r FROM two)
        SELECT sample_id, text[1:l.s] || l.a || text[l.s + length(l.b) + 1:r.s] || r.a || text[r.s + length(r.b) + 1:] AS noisy_text, CASE WHEN seen THEN 'seen_rule' ELSE 'unseen_pattern' END AS seen_status,
            l.id AS id_1, l.s AS start_1, r.id AS id_2, r.s + length(l.a) - length(l.b) AS start_2, TRUE AS replays FROM o""",
    "leakage_mixed": """WITH e AS (SELECT 'id' AS kind, 'b' || item_id AS value FROM benchmark UNION SELECT 'text', text FROM benchmark UNION SELECT 'id', doc_id::VARCHAR FROM documents WHERE lang = 'en' UNION SELECT 'text', text FROM documents WHERE lang = 'en'
            UNION SELECT 'id', conv_id::VARCHAR FROM conversations UNION SELECT 'text', text FROM conversations
            UNION SELECT 'id', n_nationkey::VARCHAR FROM nation UNION SELECT 'text', n_name FROM nation),
        o AS (SELECT 'id' AS kind, doc_id::VARCHAR AS value FROM documents UNION SELECT 'text', text FROM documents)
        SELECT kind, count(*) AS n_external, count(*) FILTER ((kind, value) IN (SELECT (kind, value) FROM o)) AS n_leaked FROM e WHERE value <> '' GROUP BY kind""",
    "sentence_metadata": f"""WITH l AS (SELECT doc_id, lang, source, unnest(string_split(text, chr(10))) AS said, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents),
        s AS (SELECT doc_id::VARCHAR || ':' || pos AS sentence_id, doc_id::VARCHAR AS article_id, source AS source_id, said AS sentence_text, lang AS language, (doc_id % 100) / 100.0::DOUBLE AS language_confidence, len(string_split(said, ' ')) AS token_count, NULL AS quality_score,
            starts_with(said, '"')::INT AS is_quote, (pos = 0)::INT AS is_headline, sha256(said) AS content_hash, (doc_id % 97 = 0)::INT AS is_duplicate, NULL AS duplicate_group_id FROM l),
        u AS (SELECT doc_id::VARCHAR AS article_id, CASE WHEN doc_id % 7 <> 0 THEN url ELSE '' END AS article_url, CASE WHEN doc_id % 2 = 0 THEN '' ELSE upper(url) END AS canonical_url, NULL AS publication_date, string_split(text, chr(10))[1] AS headline
            FROM (SELECT *, 'https://' || coalesce(source, 'x') || '/' || doc_id AS url FROM documents) WHERE doc_id % 11 <> 0),
        n AS (SELECT DISTINCT source AS source_id, CASE WHEN length(source) % 2 = 0 THEN upper(source) ELSE '' END AS source_name, source || '.example' AS source_domain FROM documents WHERE source IS NOT NULL),
        j AS (SELECT * FROM s LEFT JOIN u USING (article_id) LEFT JOIN n USING (source_id))
        SELECT sentence_id AS clean_id, coalesce(nullif(source_name, ''), source_domain) AS publisher, article_id AS source_doc_id, sha256(coalesce(nullif(canonical_url, ''), nullif(article_url, ''))) AS url_hash,
            sha256('{{' || concat_ws(', ', {', '.join(f"""'"{k}": ' || coalesce(to_json({k})::VARCHAR, 'null')""" for k in sorted(readers.METADATA))}) || '}}') AS metadata_sha256 FROM j""",
    "frozen_digest": """WITH h AS (SELECT lang, sha256('{"doc_id":' || doc_id || ',"lang":' || to_json(lang) || ',"n_chars":' || n_chars || ',"source":' || to_json(source) || '}') AS h FROM documents)
        SELECT lang, count(*) AS rows, sum(('0x' || substr(h, 1, 8))::BIGINT)::BIGINT AS sum_0, sum(('0x' || substr(h, 57, 8))::BIGINT)::BIGINT AS sum_7 FROM h GROUP BY lang""",
}
