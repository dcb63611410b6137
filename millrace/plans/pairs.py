"""Queries over generators, census, selection, final datasets and diagnostics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.profile import ENGLISH
from millrace.functions.text import length_bucket, shard_of
from millrace.operators import contracts, generate, select
from millrace.plans.common import BRANCHES, CANDIDATES_SQL, EN_SQL, RANKED_SQL, SEED, TOKENS_SQL, dealt, split_sentences, table
from millrace.sources.workspace import Workspace

QUOTA, GAP, IDENTITIES, FIRST, SAMPLE = 5, 40, 60, 20, 5
CONSTRUCTIONS = [("of the", "ofthe", "$MERGE_SPACE", "space"), ("to the", "to-the", "$TRANSFORM_SPLIT_HYPHEN", "hyphen"), ("in", "i n", "$TRANSFORM_SPLIT_SPACE", "space")]
PARADIGM = [("be", "be", "BASE"), ("be", "was", "COMPACT"), ("be", "is", "INCACT"), ("be", "are", "CONTACT"), ("be", "been", "IMPACT")]
_TUPLES = lambda rows: ", ".join("(" + ", ".join(f"'{x}'" for x in r) + ")" for r in rows)
_COLUMNS = "clean_id, tag, family, kind, position, correct, wrong, source_text, target_text, confidence"


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    return generate.generate(split_sentences(spark, d), ENGLISH)


def _kind(*kinds: str, family: str | None = None) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, d: str) -> DataFrame:
        out = _candidates(spark, d).where(F.col("kind").isin(*kinds))
        return (out.where(F.col("family") == family) if family else out).select(*generate.CANDIDATE)

    return query


def _kind_sql(branch: str) -> str:
    return f"WITH {TOKENS_SQL} SELECT {_COLUMNS} FROM ({BRANCHES[branch]}) WHERE source_text <> target_text"


def gen_change_punct(spark: SparkSession, d: str) -> DataFrame:
    sentences = split_sentences(spark, d)
    text = F.col("text")
    reviewed = sentences.where("text like '%.'").select(F.left(text, F.length(text) - 1).alias("context"), F.lit(".").alias("correct"), F.lit("?").alias("wrong"), F.lit("$CHANGE_PUNC_PERIOD").alias("tag")).distinct()
    return generate.changed_marks(sentences, reviewed).select(*generate.CANDIDATE)


def gen_construction(spark: SparkSession, d: str) -> DataFrame:
    resource = spark.createDataFrame(CONSTRUCTIONS, "correct string, wrong string, tag string, family string")
    return generate.constructions(split_sentences(spark, d), resource).select(*generate.CANDIDATE)


def gen_morphology(spark: SparkSession, d: str) -> DataFrame:
    return generate.verb_states(split_sentences(spark, d), spark.createDataFrame(PARADIGM, "lemma string, surface string, state string")).select(*generate.CANDIDATE)


def replay_check(spark: SparkSession, d: str) -> DataFrame:
    made = generate.with_replay(_candidates(spark, d))
    return made.groupBy("kind").agg(F.count("*").alias("n"), F.count_if(F.col("again") == F.col("target_text")).alias("n_replayed"))


def capacity_census(spark: SparkSession, d: str) -> DataFrame:
    return generate.census(spark, _candidates(spark, d), ENGLISH)


def shard_capacity(spark: SparkSession, d: str) -> DataFrame:
    return _candidates(spark, d).groupBy("split", "tag", shard_of(F.col("clean_id"), 4).alias("shard")).agg(F.count("*").alias("capacity"))


def topk_rank_per_group(spark: SparkSession, d: str) -> DataFrame:
    """Ranks alone are compared; pair_id, a hash of whole texts, is made for what was kept."""
    narrow = select.with_rank(_candidates(spark, d), SEED).select("split", "tag", "rank", "clean_id", "position")
    best = Workspace(spark, "top").save(select.top_k(narrow, ["split", "tag"], 25, ["rank", "clean_id", "position"]), "best")
    named = _fetched(spark, d, best.select("split", "tag", "rank", "clean_id").distinct()).select("split", "tag", "rank", "pair_id")
    return best.join(named, ["split", "tag", "rank"]).select("split", "tag", "pair_id", "rank", "clean_id", "position")


def review_sample(spark: SparkSession, d: str) -> DataFrame:
    """Only documents that may hold a group's first sentences are looked at with texts: as many as rows are wanted, by their least clean_id, as each has a candidate with it."""
    tags = _candidates(spark, d).select("source_doc_id", "split", "tag").groupBy("source_doc_id", "split", "tag").agg(F.count("*").alias("n"))
    first = F.concat("source_doc_id", F.lit(":"))  # clean_id is this and the line, so documents are in the order of their ids
    docs = select.top_k(tags.withColumn("first", first), ["split", "tag"], SAMPLE + 1, ["first"]).select("source_doc_id").distinct()  # one more, as documents without an id stand first here
    few = table(spark, d, "documents").select("doc_id", "text", "lang", "source")
    few = few.join(generate.bounded(Workspace(spark, "review").save(docs, "docs")), F.col("doc_id").cast("string").eqNullSafe(F.col("source_doc_id")), "left_semi")
    made = select.with_pair_id(generate.generate(split_sentences(spark, d, dealt(few, "doc_id")), ENGLISH), SEED).select("split", "tag", "clean_id", "pair_id", "position")
    return select.top_k(made, ["split", "tag"], SAMPLE, ["clean_id", "pair_id", "position"]).select("split", "tag", "clean_id", "pair_id")


def _narrow(spark: SparkSession, d: str) -> DataFrame:
    """Ranks and pairs' hashes of all candidates, computed once: what selection works on, without a text."""
    keyed = select.keyed(select.with_rank(_candidates(spark, d), SEED))
    return Workspace(spark, "selection").save(keyed, "ranked")


def _quotas(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(narrow, selected, left over) of all candidates under the quotas."""
    quotas = spark.createDataFrame([(s, t, QUOTA) for t, _ in dict.fromkeys(ENGLISH.tags) for s in ("train", "dev", "synthetic_test")], "split string, tag string, quota int").distinct()
    narrow = _narrow(spark, d)
    return narrow, *select.quota_select(narrow, quotas, QUOTA)


def _selected(spark: SparkSession, d: str) -> DataFrame:
    narrow, taken, _ = _quotas(spark, d)
    return _fetched(spark, d, taken, narrow)


def _fetched(spark: SparkSession, d: str, chosen: DataFrame, narrow: DataFrame | None = None) -> DataFrame:
    """The candidates that chosen names, with texts: made again from their documents alone, so that no other texts are normalised or shuffled.

    What is chosen is bounded by quotas; it is saved, and counted before it is broadcast. Its sentences stand in chosen, or in the narrow table it was chosen from.
    """
    ws = Workspace(spark, "selection")
    chosen = ws.save(chosen, "chosen")
    ids = ws.save((chosen if narrow is None else narrow.join(generate.bounded(chosen), select.NAMES, "left_semi")).select("clean_id").distinct(), "ids")
    docs = ids.select(F.substring_index("clean_id", ":", 1).cast("long").alias("doc_id")).distinct()
    few = dealt(table(spark, d, "documents").select("doc_id", "text", "lang", "source").join(generate.bounded(docs), "doc_id", "left_semi"), "doc_id")
    sentences = split_sentences(spark, d, few).join(generate.bounded(ids), "clean_id", "left_semi")
    made = select.with_rank(generate.generate(sentences, ENGLISH), SEED)
    return select.with_pair_id(select.fetch(made, chosen), SEED)


def quota_selection(spark: SparkSession, d: str) -> DataFrame:
    return _selected(spark, d).select("split", "tag", "pair_id", "rank")


def greedy_quota_selection(spark: SparkSession, d: str) -> DataFrame:
    quotas = {(s, t): QUOTA for t, _ in ENGLISH.tags for s in ("train", "dev", "synthetic_test")}
    narrow = _narrow(spark, d)
    return _fetched(spark, d, select.greedy_names(narrow, quotas), narrow).select("split", "tag", "pair_id", "rank")


def overflow_refill(spark: SparkSession, d: str) -> DataFrame:
    gaps = spark.createDataFrame([(s, GAP) for s in ("train", "dev", "synthetic_test")], "split string, gap int")
    narrow, _, left = _quotas(spark, d)
    return _fetched(spark, d, select.refill(left, gaps, GAP), narrow).select("split", "tag", "pair_id", "rank")


def identity_rows(spark: SparkSession, d: str) -> DataFrame:
    return select.identity_rows(split_sentences(spark, d), SEED, IDENTITIES)


def _final(spark: SparkSession, d: str) -> DataFrame:
    wrong = _selected(spark, d).select("pair_id", "clean_id", "source_text", "target_text", F.lit(True).alias("is_errorful"), "tag", "split")
    return wrong.unionByName(identity_rows(spark, d))


def final_dataset(spark: SparkSession, d: str) -> DataFrame:
    return _final(spark, d)


def stage_views(spark: SparkSession, d: str) -> DataFrame:
    return select.stage_views(_final(spark, d), FIRST).select("pair_id", "split", "is_errorful", "stage")


def provenance_mismatch(spark: SparkSession, d: str) -> DataFrame:
    """Candidates whose clean sentence is missing, or differs in text, publisher or document."""
    return contracts.provenance_counts(_candidates(spark, d), split_sentences(spark, d))


def diagnostics_tags(spark: SparkSession, d: str) -> DataFrame:
    return _final(spark, d).groupBy("split", F.coalesce("tag", F.lit("<identity>")).alias("tag"), length_bucket(F.col("target_text")).alias("bucket")).agg(F.count("*").alias("n"))


def diagnostics_publishers(spark: SparkSession, d: str) -> DataFrame:
    clean = split_sentences(spark, d).select("clean_id", F.coalesce("publisher", F.lit("<unknown>")).alias("publisher"))
    return _final(spark, d).join(clean, "clean_id").groupBy("publisher").agg(F.count_if("is_errorful").alias("n_errorful"), F.count_if(~F.col("is_errorful")).alias("n_identity"))


def telemetry_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Candidates and rejections by reason, merged over shards, with a bounded, deterministic sample of each."""
    made = generate.touched_tokens(split_sentences(spark, d), list(ENGLISH.edit_contexts))
    reason = F.when((F.col("prefix") != "") | (F.col("suffix") != ""), "affixed").when((F.col("index") == 0) | (F.col("index") == F.col("n") - 1), "unsafe_or_ambiguous_construction").otherwise("accepted")
    shards = made.withColumn("reason", reason).groupBy("reason", shard_of(F.col("clean_id"), 4).alias("shard")).agg(F.count("*").alias("n"), F.min("clean_id").alias("sample"))
    return shards.groupBy("reason").agg(F.sum("n").alias("n"), F.min("sample").alias("sample"))


def candidate_gate(spark: SparkSession, d: str) -> DataFrame:
    """The structural gate over all candidates, with faults planted by position and length: rows per reject code, or accepted."""
    c, n = F.col, F.length("target_text")
    made = generate.with_replay(_candidates(spark, d)).withColumn("pair_id", F.col("clean_id"))
    planted = made.select(
        F.concat_ws(":", "pair_id", F.coalesce(c("position"), F.lit(-1)).cast("string")).alias("pair_id"),
        F.when(n % 31 == 0, "$UNKNOWN").otherwise(c("tag")).alias("tag"),
        F.when(n % 37 == 0, c("target_text")).otherwise(c("source_text")).alias("source_text"),
        F.when(n % 41 == 0, F.concat("target_text", F.lit("  x"))).otherwise(c("target_text")).alias("target_text"),
        F.when(n % 43 == 0, "unheard_of").otherwise("replace").alias("operation"),
        F.when(n % 47 == 0, "lemma").alias("morphology_lemma"),
        F.when(n % 53 == 0, F.lit("lost")).otherwise(c("again")).alias("again"),
    )
    found = contracts.candidate_codes(planted, [t for t, _ in ENGLISH.tags], c("again"))
    return found.groupBy(F.coalesce("reject_code", F.lit("accepted")).alias("code")).agg(F.count("*").alias("n"))


#: Planted faults of the gate by bucket, in the order in which the gate asks: every reject code has one; later buckets are sound.
GATE_CODES = (
    "unregistered_tag source_equals_target target_not_normalized source_not_normalized incomplete_morphology_provenance unexpected_morphology_provenance invalid_morphology_state "
    "unsupported_morphology_target_state same_morphology_state morphology_resource_version_mismatch unknown_operation append_anchor_index_mismatch append_start_sentinel_missing "
    "append_anchor_missing alignment_replay_failed alignment_span_mismatch"
).split()


def candidate_gate_codes(spark: SparkSession, d: str) -> DataFrame:
    """The structural gate over all candidates with a fault of every kind planted by bucket, and sound verb forms and insertions: rows per tag and reject code."""
    c = F.col
    made = generate.with_replay(_candidates(spark, d)).withColumn("b", F.pmod(F.length("target_text") * 31 + F.coalesce("position", F.lit(0)), F.lit(20)))
    at = lambda *names: c("b").isin(*[GATE_CODES.index(n) for n in names])
    verb = c("b").isin(4, 6, 7, 8, 9, 16)
    told = c("b").isin(6, 7, 8, 9, 16)
    appended = c("b").isin(11, 12, 13, 17)
    planted = made.select(
        F.concat_ws(":", "clean_id", "tag", F.coalesce(c("position"), F.lit(-1)).cast("string")).alias("pair_id"),
        c("tag").alias("was"),
        F.when(at("unregistered_tag"), "$UNKNOWN").when(verb, "$TRANSFORM_VERB_BASE").otherwise(c("tag")).alias("tag"),
        F.when(at("source_equals_target"), c("target_text")).when(at("source_not_normalized"), F.concat("source_text", F.lit(" "))).otherwise(c("source_text")).alias("source_text"),
        F.when(at("target_not_normalized"), F.concat("target_text", F.lit("  x"))).otherwise(c("target_text")).alias("target_text"),
        F.when(at("invalid_morphology_state"), "ODD").when(at("same_morphology_state"), "BASE").when(told, "COMPACT").alias("morphology_source_state"),
        F.when(at("unsupported_morphology_target_state"), "IMPACT").when(told, "BASE").alias("morphology_target_state"),
        F.when(told | at("unexpected_morphology_provenance"), "lemma").alias("morphology_lemma"),
        F.when(at("morphology_resource_version_mismatch"), "2").when(told, "1").alias("morphology_resource_version"),
        F.when(at("unknown_operation"), "melt").when(appended, "append").otherwise("replace").alias("operation"),
        F.when(at("append_anchor_index_mismatch"), "previous_token").when(c("b").isin(12, 17), "$START").alias("append_anchor"),
        F.when(appended, "prepend").alias("append_position"),
        F.when(c("b") == 17, "$START").alias("append_sentinel"),
        F.when(at("append_anchor_index_mismatch"), 1).cast("long").alias("append_index_anchor"),
        F.when(at("append_anchor_index_mismatch"), 1).cast("long").alias("target_token_index"),
        F.when(at("alignment_span_mismatch"), "0:1").otherwise("0:2").alias("spans"),
        F.when(at("alignment_replay_failed"), F.lit("lost")).otherwise(c("again")).alias("again"),
    )
    found = contracts.candidate_codes(planted, [t for t, _ in ENGLISH.tags], c("again"), morphology_version="1", replayed_spans=F.lit("0:2"))
    return found.groupBy(F.coalesce("reject_code", F.lit("accepted")).alias("code")).agg(F.count("*").alias("n"))


def pair_contract(spark: SparkSession, d: str) -> DataFrame:
    """The contract of errorful and identity rows over the final dataset, with planted faults."""
    c, n = F.col, F.length("target_text")
    rows = _final(spark, d).select(
        "pair_id", "clean_id", F.when(n % 19 == 0, "nowhere").otherwise(c("split")).alias("split"), F.when(n % 23 == 0, c("target_text")).otherwise(c("source_text")).alias("source_text"),
        F.when(~c("is_errorful") & (n % 7 == 0), F.concat("target_text", F.lit("!"))).otherwise(c("target_text")).alias("target_text"), "is_errorful",
        F.when(n % 29 == 0, 2).otherwise(c("is_errorful").cast("int")).alias("num_errors"), F.when(c("is_errorful"), F.array("tag")).otherwise(F.array().cast("array<string>")).alias("correction_tags"),
    )
    return contracts.pair_faults(rows, [t for t, _ in ENGLISH.tags]).select("pair_id", F.concat_ws(",", "faults").alias("faults"))


QUERIES = {
    "gen_swap": _kind("swap", family="swap"),
    "gen_pronoun": _kind("swap", family="pronoun"),
    "gen_contextual": _kind("contextual"),
    "gen_duplicate": _kind("duplicate"),
    "gen_missing": _kind("missing"),
    "gen_add_punct": _kind("add_mark"),
    "gen_case_cap": _kind("case_capital"),
    "gen_case_lower": _kind("case_lower"),
} | {f.__name__: f for f in (gen_change_punct, gen_construction, gen_morphology, replay_check, capacity_census, shard_capacity, topk_rank_per_group, review_sample, quota_selection, greedy_quota_selection, overflow_refill, identity_rows, final_dataset, stage_views, provenance_mismatch, diagnostics_tags, diagnostics_publishers, telemetry_rollup, candidate_gate, candidate_gate_codes, pair_contract)}

_PLACED = f"""{RANKED_SQL},
uniq AS (SELECT * FROM ranked QUALIFY row_number() OVER (PARTITION BY source_text, target_text ORDER BY split, tag, rank, pair_id) = 1),
placed AS (SELECT *, row_number() OVER (PARTITION BY split, tag ORDER BY rank, pair_id) AS n FROM uniq)"""
_IDENTITY = f"SELECT left(sha256(concat_ws('|', 'identity', '{SEED}', clean_id)), 32) AS pair_id, clean_id, text AS source_text, text AS target_text, FALSE AS is_errorful, NULL::VARCHAR AS tag, split FROM en QUALIFY row_number() OVER (PARTITION BY split ORDER BY clean_id) <= {IDENTITIES}"
_FINAL = f"""{_PLACED},
final AS (SELECT pair_id, clean_id, source_text, target_text, TRUE AS is_errorful, tag, split FROM placed WHERE n <= {QUOTA} UNION ALL {_IDENTITY})"""
_SHARD = "list_reduce(list_transform(range(16), lambda i: ('0x' || substr(sha256(clean_id), (4 * i + 1)::BIGINT, 4))::BIGINT), lambda a, x: (a * 65536 + x) % 4, 0::BIGINT)"
_LENGTH = "CASE WHEN len(string_split(target_text, ' ')) < 10 THEN '<10' WHEN len(string_split(target_text, ' ')) < 20 THEN '10-19' WHEN len(string_split(target_text, ' ')) < 30 THEN '20-29' WHEN len(string_split(target_text, ' ')) < 50 THEN '30-49' ELSE '50+' END"
_CONTEXTS = "('" + "', '".join(ENGLISH.edit_contexts) + "')"
ORACLES = {
    **{f"gen_{k}": _kind_sql(b) for k, b in {"swap": "swap", "pronoun": "pronoun", "contextual": "contextual", "duplicate": "duplicate", "missing": "missing", "add_punct": "add_mark", "case_cap": "case_capital", "case_lower": "case_lower"}.items()},
    "gen_change_punct": f"WITH {EN_SQL}, r AS (SELECT DISTINCT left(text, length(text) - 1) AS context FROM en WHERE text LIKE '%.') SELECT clean_id, '$CHANGE_PUNC_PERIOD' AS tag, 'punctuation' AS family, 'change_mark' AS kind, NULL::BIGINT AS position, '.' AS correct, '?' AS wrong, context || '?' AS source_text, text AS target_text, 'reviewed' AS confidence FROM en JOIN r ON text = context || '.'",
    "gen_construction": f"""WITH {EN_SQL}, r(correct, wrong, tag, family) AS (VALUES {_TUPLES(CONSTRUCTIONS)}),
        p AS (SELECT *, string_split(text, correct) AS pieces, unnest(range(1, len(string_split(text, correct)))) AS k FROM en JOIN r ON contains(text, correct)),
        q AS (SELECT *, left(text, (list_sum(list_transform(pieces[1:k], lambda x: length(x))) + (k - 1) * length(correct))::BIGINT) AS l FROM p), s AS (SELECT *, text[length(l) + length(correct) + 1:] AS rr FROM q)
        SELECT clean_id, tag, family, 'construction' AS kind, length(l) AS position, correct, wrong, l || wrong || rr AS source_text, text AS target_text, 'reviewed' AS confidence FROM s
        WHERE NOT regexp_matches(l, '[\\p{{L}}\\p{{N}}_]$') AND NOT regexp_matches(rr, '^[\\p{{L}}\\p{{N}}_]')""",
    "gen_morphology": f"""WITH {TOKENS_SQL}, v(lemma, surface, state) AS (VALUES {_TUPLES(PARADIGM)})
        SELECT clean_id, '$TRANSFORM_VERB_' || a.state AS tag, 'morphology' AS family, 'morphology' AS kind, i AS position, a.surface AS correct, b.surface AS wrong,
        array_to_string(list_concat(list_concat(words[1:i], [prefix || b.surface || suffix]), words[i + 2:]), ' ') AS source_text, text AS target_text, 'reviewed' AS confidence
        FROM toks JOIN v a ON core = a.surface JOIN v b ON a.lemma = b.lemma AND a.state <> b.state AND a.surface <> b.surface WHERE a.state NOT IN ('IMPACT', 'IMPOBJ')""",
    "replay_check": f"WITH {CANDIDATES_SQL} SELECT kind, count(*) AS n, count(*) AS n_replayed FROM candidates GROUP BY kind",
    "capacity_census": f"""WITH {CANDIDATES_SQL}, r(tag, family) AS (VALUES {_TUPLES(dict.fromkeys(ENGLISH.tags))}),
        c AS (SELECT tag, count(*) AS candidates, count(DISTINCT clean_id) AS sentences, count(*) FILTER (split = 'train') AS a, count(*) FILTER (split = 'dev') AS b, count(*) FILTER (split = 'synthetic_test') AS t FROM candidates GROUP BY tag)
        SELECT tag, family, coalesce(candidates, 0) AS candidates, coalesce(sentences, 0) AS sentences, coalesce(a, 0) AS candidates_train, coalesce(b, 0) AS candidates_dev, coalesce(t, 0) AS candidates_synthetic_test FROM r LEFT JOIN c USING (tag)""",
    "shard_capacity": f"WITH {CANDIDATES_SQL} SELECT split, tag, {_SHARD} AS shard, count(*) AS capacity FROM candidates GROUP BY 1, 2, 3",
    "topk_rank_per_group": f"WITH {RANKED_SQL} SELECT split, tag, pair_id, rank, clean_id, position FROM ranked QUALIFY row_number() OVER (PARTITION BY split, tag ORDER BY rank, pair_id, clean_id, position) <= 25",
    "review_sample": f"WITH {RANKED_SQL} SELECT split, tag, clean_id, pair_id FROM ranked QUALIFY row_number() OVER (PARTITION BY split, tag ORDER BY clean_id, pair_id, position) <= {SAMPLE}",
    "quota_selection": f"WITH {_PLACED} SELECT split, tag, pair_id, rank FROM placed WHERE n <= {QUOTA}",
    "greedy_quota_selection": f"""WITH RECURSIVE {RANKED_SQL.strip()},
        keyed AS (SELECT split, tag, rank, pair_id, source_text || chr(1) || target_text AS pair FROM ranked QUALIFY row_number() OVER (PARTITION BY split, tag, source_text, target_text ORDER BY rank, pair_id) = 1),
        numbered AS (SELECT split, tag, row_number() OVER (ORDER BY split, tag) AS g, list({{'rank': rank, 'pair_id': pair_id, 'pair': pair}} ORDER BY rank, pair_id) AS best FROM keyed
            WHERE tag IN ({', '.join(f"'{t}'" for t, _ in dict.fromkeys(ENGLISH.tags))}) GROUP BY split, tag),
        fold(g, taken, picked) AS (SELECT 0::BIGINT, []::VARCHAR[], []::STRUCT(rank VARCHAR, pair_id VARCHAR, pair VARCHAR)[]
            UNION ALL SELECT n.g, list_concat(f.taken, list_transform(list_filter(n.best, lambda b: NOT list_contains(f.taken, b.pair))[1:{QUOTA}], lambda b: b.pair)), list_filter(n.best, lambda b: NOT list_contains(f.taken, b.pair))[1:{QUOTA}] FROM fold f JOIN numbered n ON n.g = f.g + 1),
        chosen AS (SELECT g, unnest(picked) AS b FROM fold)
        SELECT split, tag, b.pair_id AS pair_id, b.rank AS rank FROM chosen JOIN numbered USING (g)""",
    "overflow_refill": f"WITH {_PLACED} SELECT split, tag, pair_id, rank FROM placed WHERE n > {QUOTA} QUALIFY row_number() OVER (PARTITION BY split ORDER BY rank, pair_id) <= {GAP}",
    "identity_rows": f"WITH {EN_SQL} {_IDENTITY}",
    "final_dataset": f"WITH {_FINAL} SELECT * FROM final",
    "stage_views": f"WITH {_FINAL} SELECT pair_id, split, is_errorful, CASE WHEN is_errorful AND row_number() OVER (PARTITION BY split, is_errorful ORDER BY pair_id) <= {FIRST} THEN 'dataset1_stage2' ELSE 'dataset2_stage3' END AS stage FROM final",
    "provenance_mismatch": f"WITH {CANDIDATES_SQL} SELECT count(*) AS n_candidates, count(*) FILTER (en.text IS NULL) AS n_missing, count(*) FILTER (c.target_text IS DISTINCT FROM en.text OR c.publisher IS DISTINCT FROM en.publisher OR c.source_doc_id IS DISTINCT FROM en.source_doc_id) AS n_mismatched FROM candidates c LEFT JOIN en USING (clean_id)",
    "diagnostics_tags": f"WITH {_FINAL} SELECT split, coalesce(tag, '<identity>') AS tag, {_LENGTH} AS bucket, count(*) AS n FROM final GROUP BY 1, 2, 3",
    "diagnostics_publishers": f"WITH {_FINAL} SELECT coalesce(publisher, '<unknown>') AS publisher, count(*) FILTER (is_errorful) AS n_errorful, count(*) FILTER (NOT is_errorful) AS n_identity FROM final JOIN en USING (clean_id) GROUP BY 1",
    "candidate_gate": f"""WITH {CANDIDATES_SQL}, n AS (SELECT length(target_text) AS n FROM candidates),
        f AS (SELECT CASE WHEN n % 31 = 0 THEN 'unregistered_tag' WHEN n % 37 = 0 AND n % 41 <> 0 THEN 'source_equals_target' WHEN n % 41 = 0 THEN 'target_not_normalized' WHEN n % 47 = 0 THEN 'unexpected_morphology_provenance'
            WHEN n % 43 = 0 THEN 'unknown_operation' WHEN n % 53 = 0 THEN 'alignment_replay_failed' ELSE 'accepted' END AS code FROM n)
        SELECT code, count(*) AS n FROM f GROUP BY code""",
    "candidate_gate_codes": f"WITH {CANDIDATES_SQL} SELECT CASE WHEN b < 16 THEN {GATE_CODES}[b + 1] ELSE 'accepted' END AS code, count(*) AS n FROM (SELECT (length(target_text) * 31 + coalesce(position, 0)) % 20 AS b FROM candidates) GROUP BY 1",
    "pair_contract": f"""WITH {_FINAL}, r AS (SELECT *, length(target_text) AS n, CASE WHEN NOT is_errorful AND length(target_text) % 7 = 0 THEN target_text || '!' ELSE target_text END AS t, CASE WHEN length(target_text) % 23 = 0 THEN target_text ELSE source_text END AS s FROM final),
        f AS (SELECT pair_id, concat_ws(',', CASE WHEN n % 19 = 0 THEN 'unknown_split' END, CASE WHEN is_errorful AND s = t THEN 'errorful_texts' END, CASE WHEN is_errorful AND n % 29 = 0 THEN 'errorful_count' END,
            CASE WHEN NOT is_errorful AND s <> t THEN 'identity_changed' END, CASE WHEN NOT is_errorful AND n % 29 = 0 THEN 'identity_count' END) AS faults FROM r)
        SELECT * FROM f WHERE faults <> ''""",
    "telemetry_rollup": f"WITH {TOKENS_SQL} SELECT CASE WHEN prefix <> '' OR suffix <> '' THEN 'affixed' WHEN i = 0 OR i = n - 1 THEN 'unsafe_or_ambiguous_construction' ELSE 'accepted' END AS reason, count(*) AS n, min(clean_id) AS sample FROM toks WHERE lower(core) IN {_CONTEXTS} GROUP BY 1",
}
