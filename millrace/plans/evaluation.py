"""Queries over routed predictions, metrics, paired tests, noise and reviewed resources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import core, edit_distance, osa_distance, tokens, with_normalised
from millrace.operators import contracts, evaluate, select
from millrace.plans.common import EN_SQL, TOKENS_SQL, norm_sql, split_sentences, table
from millrace.sources import resources

NOISE = [("n1", "abbreviation", "w/", "with"), ("n2", "abbreviation", "4", "for"), ("n3", "slang", "da", "the"), ("n4", "slang", "dat", "that"), ("n5", "slang", "n", "and")]
BUNDLES = ["V;PFV;AF", "V|PFV|AGFOC", "V;PFV;PFOC", "V;PROSP;AF", "V;IPFV;AF", "V;NFIN", "V;STATE=RECCOMP", "N;SG", "INFINITIVE", "V;IMP;OF", "V;RECENT", "V;PRS;OBJECTFOCUS"]


def _samples(spark: SparkSession, d: str) -> DataFrame:
    """English sentences as gold; deterministic faults make the raw and normalised texts."""
    gold = F.col("gold")
    rows = split_sentences(spark, d).select(F.col("clean_id").alias("sample_id"), F.col("publisher").alias("source"), F.col("text").alias("gold"))
    return rows.withColumns({"raw": F.replace(F.replace(gold, F.lit(" the "), F.lit(" da ")), F.lit(" of "), F.lit(" in ")), "gold_normalised": F.replace(gold, F.lit(" of "), F.lit(" in "))})


def _normalise(text: Column) -> Column:
    return F.replace(text, F.lit(" da "), F.lit(" the "))


def _correct(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(" in "), F.lit(" of ")), F.lit(" da da "), F.lit(" da "))


def _routed(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.route(_samples(spark, d), _normalise, _correct)


def route_abc(spark: SparkSession, d: str) -> DataFrame:
    return _routed(spark, d).select("sample_id", "condition", "gec_input", "gec_output")


def routed_predictions(spark: SparkSession, d: str) -> DataFrame:
    """Predictions by a corrector that returns a text with tags and a normaliser that returns a tuple."""

    def tagged(text: Column) -> Column:
        said = _correct(text)
        return F.struct(said.alias("text"), F.when(said != text, F.array(F.lit("$REPLACE_of"))).otherwise(F.array().cast("array<string>")).alias("predicted_tags"))

    made = evaluate.predict(_samples(spark, d), lambda t: F.struct(_normalise(t).alias("_1"), F.lit(None).cast("array<string>").alias("_2")), tagged, conditions=("A", "raw_to_normalizer_to_gec", "C", "raw_to_gec"), versions={"gec_version": "g"})
    return made.select("sample_id", "condition", "raw_input", "normalizer_output", "gec_input", "gec_output", F.concat_ws(",", "predicted_tags").alias("tags"), "gec_version")


def edit_metrics(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.scores(evaluate.with_edit_counts(_routed(spark, d), "raw", "gold", "gec_output"), "condition")


def edit_breakdown(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.scores(evaluate.with_edit_counts(_routed(spark, d), "raw", "gold", "gec_output"), "condition", "source")


def metric_summary(spark: SparkSession, d: str) -> DataFrame:
    """Scores, exact rate, error reduction and mean distances per condition, end to end (word edits by longest matching blocks: no SQL)."""
    return evaluate.summary(_routed(spark, d), "raw", "gold", "gec_output", "condition")


def prediction_faults(spark: SparkSession, d: str) -> DataFrame:
    """Predictions of all conditions with planted faults of routes and bindings: the first fault of each."""
    c, n = F.col, F.length("gold")
    r = _routed(spark, d)
    made = r.select(
        F.when(n % 17 == 0, F.concat(F.lit("x"), "sample_id")).otherwise(c("sample_id")).alias("sample_id"), "condition", F.when(n % 19 == 0, F.lit("?")).otherwise(c("raw")).alias("raw_input"),
        F.when((c("condition") == "B") & (n % 23 != 0), _normalise(c("raw"))).when(c("condition") == "C", c("gold_normalised")).alias("normalizer_output"), F.when(n % 29 == 0, F.lit("?")).otherwise(c("gec_input")).alias("gec_input"), "gec_output",
        F.when(n % 31 == 0, "other").otherwise("g").alias("gec_version"), F.when(n % 37 != 0, "m").alias("model_version"),
    )
    return contracts.route_faults(_samples(spark, d), made, bindings={"gec_version": "g"})


def exact_rates(spark: SparkSession, d: str) -> DataFrame:
    """Exact matches, errors before and after (word positions that differ from gold), and overcorrection on clean inputs."""
    differs = lambda a: F.size(F.filter(F.zip_with(F.split(a, " "), F.split("gold", " "), lambda x, y: ~x.eqNullSafe(y)), lambda b: b))
    r = _routed(spark, d).withColumns({"before": differs("gec_input"), "after": differs("gec_output")})
    return r.groupBy("condition").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("gec_output") == F.col("gold")).alias("n_exact"),
        F.sum("before").alias("errors_before"),
        F.sum("after").alias("errors_after"),
        F.count_if((F.col("gec_input") == F.col("gold")) & (F.col("gec_output") != F.col("gold"))).alias("n_overcorrected"),
    )


def levenshtein_mean(spark: SparkSession, d: str) -> DataFrame:
    """Distance in code points of every routed output to its gold."""
    return _routed(spark, d).groupBy("condition").agg(F.sum(edit_distance(F.col("gec_output"), F.col("gold"))).alias("total"), F.count("*").alias("n"))


def osa_total(spark: SparkSession, d: str) -> DataFrame:
    """Distance with transpositions of every routed output to its gold; equal texts never leave the JVM."""
    distance = F.coalesce(osa_distance(F.when(F.col("gec_output") != F.col("gold"), F.col("gec_output")), F.col("gold")), F.lit(0))
    return _routed(spark, d).groupBy("condition").agg(F.sum(distance).alias("total"), F.count("*").alias("n"))


def per_tag_metrics(spark: SparkSession, d: str) -> DataFrame:
    samples = _samples(spark, d)
    spans = lambda text, word: samples.select("sample_id", F.posexplode(F.split(text, " ")).alias("start", "w")).where(F.col("w") == word)
    gold = spans("gold", "of").select("sample_id", F.lit("$REPLACE_of").alias("tag"), F.col("start"), (F.col("start") + 1).alias("end"), F.lit("of").alias("target"))
    predicted = spans("raw", "in").select("sample_id", F.lit("$REPLACE_of").alias("tag"), F.col("start"), (F.col("start") + 1).alias("end"), F.lit("of").alias("target"))
    tags = spark.createDataFrame([("$REPLACE_of",), ("$DELETE",)], "tag string")
    return evaluate.tag_scores(gold, predicted, tags)


def missing_extra_keys(spark: SparkSession, d: str) -> DataFrame:
    routed = _routed(spark, d).select("sample_id", "condition", "gold")
    kept = routed.where("not (condition = 'B' and length(gold) % 7 = 0)")
    extra = kept.where("length(gold) % 11 = 0").select(F.concat(F.lit("x"), "sample_id").alias("sample_id"), "condition", "gold")
    twice = kept.where("length(gold) % 13 = 0 and condition = 'C'")
    return evaluate.key_faults(_samples(spark, d), kept.unionByName(extra).unionByName(twice))


def _paired(spark: SparkSession, d: str) -> DataFrame:
    r = _routed(spark, d).withColumn("ok", F.col("gec_output") == F.col("gold"))
    return r.groupBy("sample_id").agg(F.bool_or(F.expr("condition = 'A' and ok")).alias("a"), F.bool_or(F.expr("condition = 'B' and ok")).alias("b"))


def mcnemar(spark: SparkSession, d: str) -> DataFrame:
    x, y, p = evaluate.mcnemar(_paired(spark, d), "a", "b")
    return spark.createDataFrame([(x, y, round(p, 9))], "only_a long, only_b long, p double")


def bootstrap_ci(spark: SparkSession, d: str) -> DataFrame:
    """Every sample's word edits under A and B, resampled 2000 times; indexes come from MD5, so that SQL can draw them too."""
    return evaluate.bootstrap(_counted(spark, d), resamples=2000, seed=7, indexes="hashed").select(*[F.round(c, 9).alias(c) for c in ("mean_delta", "low", "high")])


def _counted(spark: SparkSession, d: str) -> DataFrame:
    """(sample_id, tp_a, fp_a, fn_a, tp_b, fp_b, fn_b) of every sample: words that were to change and are right, that were right and are not, that are still wrong."""
    raw = F.col("raw")
    fed = {"a": raw, "b": _normalise(raw)}
    marked = _samples(spark, d).select("sample_id", *[evaluate.word_counts("raw", "gold", _correct(text)).alias(s) for s, text in fed.items()])
    return marked.groupBy("sample_id").agg(*[F.sum(f"{s}.{k}").alias(f"{k}_{s}") for s in fed for k in ("tp", "fp", "fn")])


def _noisy(spark: SparkSession, d: str) -> DataFrame:
    rules = spark.createDataFrame(NOISE, "id string, category string, source string, target string")
    bench = with_normalised(table(spark, d, "benchmark").select(F.col("item_id").alias("sample_id"), F.col("text").alias("line")), "line", "text").drop("line")
    return evaluate.inject_noise(bench, rules, 7)


def noise_inject(spark: SparkSession, d: str) -> DataFrame:
    return _noisy(spark, d).select("sample_id", "category", "rule_id", "start", "noisy_text")


def noise_replay(spark: SparkSession, d: str) -> DataFrame:
    made = _noisy(spark, d)
    edit = F.array(F.struct(F.col("start"), (F.col("start") + F.col("n_chars")).alias("end"), F.col("target")))
    return made.groupBy("category").agg(F.count("*").alias("n"), F.count_if(evaluate.apply_edits(F.col("noisy_text"), edit) == F.col("text")).alias("n_replayed"))


def _featured(spark: SparkSession, d: str) -> DataFrame:
    """Words of the English sentences as surfaces of a made paradigm: the lemma is their beginning, the feature bundle goes by their length."""
    words = split_sentences(spark, d).select(F.explode(tokens(F.col("text"))).alias("t")).select(F.lower(core(F.col("t"))).alias("surface")).where(F.col("surface").rlike("^[a-z]+$"))
    words = words.groupBy("surface").agg(F.max(F.length("surface")).alias("letters"))  # what is asked of bundles goes by an aggregate, so Spark cannot ask it of every word that was said
    bundle = F.element_at(F.array(*[F.lit(f) for f in BUNDLES]), F.col("letters") % len(BUNDLES) + 1)
    return words.select(F.left("surface", F.lit(2)).alias("lemma"), "surface", bundle.alias("features"))


def feature_map(spark: SparkSession, d: str) -> DataFrame:
    return _featured(spark, d).select("lemma", "surface", resources.state_of(F.col("features")).alias("state"))


def resource_freeze_checks(spark: SparkSession, d: str) -> DataFrame:
    mapped = _featured(spark, d).select("lemma", "surface", resources.state_of(F.col("features")).alias("state"))
    return resources.paradigm_report(mapped.where("state is not null"), least=3)


def largest_remainder(spark: SparkSession, d: str) -> DataFrame:
    """The documents of each source shared out over the splits, whole and exact."""
    held = table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("total")).withColumn("s", select.shares_of(F.col("total"), [70, 15, 15]))
    return held.select("source", "total", *[F.get("s", F.lit(i)).alias(name) for i, name in enumerate(("train", "dev", "test"))])


def prediction_edit_faults(spark: SparkSession, d: str) -> DataFrame:
    """Predictions with their edits, and a fault of every kind that edits can have planted by length: the first fault of each."""
    c, n = F.col, F.length("gold")
    r = _routed(spark, d)
    tag = F.when(n % 13 == 4, F.lit(None).cast("string")).when(n % 13 == 5, "$UNKNOWN").otherwise("$DELETE")
    edit = F.struct(F.lit(0).cast("long").alias("start"), F.length("gec_input").cast("long").alias("end"), F.when(n % 13 == 3, F.lit("?")).otherwise(c("gec_input")).alias("source"), c("gec_output").alias("target"), tag.alias("tag"))
    made = r.select(
        "sample_id", "condition", c("raw").alias("raw_input"), F.when(c("condition") == "B", _normalise(c("raw"))).when(c("condition") == "C", c("gold_normalised")).alias("normalizer_output"), "gec_input", F.when(n % 13 != 7, c("gec_output")).alias("gec_output"),
        F.when(n % 13 != 7, F.array(edit)).alias("predicted_edits"), F.when(~(n % 13).isin(1, 7), F.array(F.when(n % 13 == 6, "$ADD_PUNC_PERIOD").otherwise(tag))).alias("predicted_tags"),
        F.when(n % 13 == 2, "nowhere").otherwise("gec_input").alias("predicted_edits_coordinate_space"),
    )
    return contracts.route_faults(_samples(spark, d), made, tags=["$DELETE", "$ADD_PUNC_PERIOD"])


def eval_composition(spark: SparkSession, d: str) -> DataFrame:
    """Noise categories per evaluation item, each item counted once for each of its types, and clean controls."""
    made = noise_inject(spark, d).select("sample_id", "category")
    items = table(spark, d, "benchmark").select(F.col("item_id").alias("sample_id")).join(made, "sample_id", "left")
    types = items.groupBy("sample_id").agg(F.sort_array(F.collect_set("category")).alias("types"))
    return types.groupBy(F.when(F.size("types") == 0, "clean_control").when(F.size("types") > 1, "mixed").otherwise(F.get("types", F.lit(0))).alias("kind")).agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (route_abc, routed_predictions, edit_metrics, edit_breakdown, metric_summary, prediction_faults, exact_rates, levenshtein_mean, osa_total, per_tag_metrics, missing_extra_keys, mcnemar, bootstrap_ci, noise_inject, noise_replay, prediction_edit_faults, feature_map, resource_freeze_checks, largest_remainder, eval_composition)}

_S = f"""{EN_SQL},
samples AS (SELECT clean_id AS sample_id, publisher AS source, text AS gold, replace(replace(text, ' the ', ' da '), ' of ', ' in ') AS raw, replace(text, ' of ', ' in ') AS gold_normalised FROM en)"""
_R = f"""{_S},
r0 AS (SELECT *, unnest(['A', 'B', 'C']) AS condition FROM samples),
r1 AS (SELECT *, CASE condition WHEN 'A' THEN raw WHEN 'B' THEN replace(raw, ' da ', ' the ') ELSE gold_normalised END AS gec_input FROM r0),
routed AS (SELECT *, replace(replace(gec_input, ' in ', ' of '), ' da da ', ' da ') AS gec_output FROM r1)"""
_DIFFERS = "len(list_filter(range(greatest(len(string_split({0}, ' ')), len(string_split(gold, ' ')))), lambda i: string_split({0}, ' ')[i + 1] IS DISTINCT FROM string_split(gold, ' ')[i + 1]))"
_ASCII = "regexp_replace({0}, '[^\\x00-\\x7F]', '#', 'g')"  # its distance functions count bytes; what differs here is ASCII, so one byte may stand for each other character
_AT = "string_split({0}, ' ')[i + 1]"
_KINDS = f"""list_transform(range(greatest(len(string_split(raw, ' ')), len(string_split(gold, ' ')), len(string_split(gec_output, ' ')))), lambda i: CASE
    WHEN {_AT.format('raw')} IS NOT DISTINCT FROM {_AT.format('gold')} THEN CASE WHEN {_AT.format('gec_output')} IS DISTINCT FROM {_AT.format('gold')} THEN 'fp' ELSE '' END
    WHEN {_AT.format('gec_output')} IS NOT DISTINCT FROM {_AT.format('gold')} THEN 'tp' ELSE 'fn' END)"""
_EDITS = f"""{_R},
edits AS (SELECT sample_id, condition, len(list_filter(kinds, lambda k: k = 'tp')) AS tp, len(list_filter(kinds, lambda k: k = 'fp')) AS fp, len(list_filter(kinds, lambda k: k = 'fn')) AS fn FROM (SELECT *, {_KINDS} AS kinds FROM routed WHERE condition <> 'C'))"""
_NOISE = f"""b AS (SELECT item_id AS sample_id, {norm_sql('text')} AS text FROM benchmark), rules(id, category, source, target) AS (VALUES {', '.join(str(r) for r in NOISE)}),
w AS (SELECT *, string_split(text, ' ') AS ws, unnest(range(len(string_split(text, ' ')))) AS k FROM b),
h AS (SELECT *, CASE WHEN k = 0 THEN 0 ELSE length(array_to_string(ws[1:k], ' ')) + 1 END AS start FROM w JOIN rules ON ws[k + 1] = target),
made AS (SELECT sample_id, category, id AS rule_id, start, left(text, start) || source || text[start + length(target) + 1:] AS noisy_text FROM h
    QUALIFY row_number() OVER (PARTITION BY sample_id, category ORDER BY sha256(concat_ws('|', '7', sample_id::VARCHAR, category, id, start::VARCHAR)), id, start) = 1)"""


def _f(tp: str, fp: str, fn: str) -> str:
    p = f"(CASE WHEN {tp} + {fp} > 0 THEN {tp}::DOUBLE / ({tp} + {fp}) WHEN {fn} = 0 THEN 1.0 ELSE 0.0 END)"
    r = f"(CASE WHEN {tp} + {fn} > 0 THEN {tp}::DOUBLE / ({tp} + {fn}) ELSE 1.0 END)"
    return f"CASE WHEN 0.25 * {p} + {r} > 0 THEN 1.25 * {p} * {r} / (0.25 * {p} + {r}) ELSE 0.0 END"


_STATE = " ".join(f"WHEN {test} THEN '{state}'" for state, test in resources.STATE_SQL)
_MAPPED = f"""{TOKENS_SQL}, s AS (SELECT DISTINCT lower(core) AS surface FROM toks WHERE regexp_full_match(lower(core), '[a-z]+')),
f AS (SELECT left(surface, 2) AS lemma, surface, {BUNDLES}[length(surface) % {len(BUNDLES)} + 1] AS features FROM s), g AS (SELECT *, string_split(upper(replace(features, '|', ';')), ';') AS fs FROM f), m AS (SELECT lemma, surface, CASE {_STATE} END AS state FROM g)"""
ORACLES = {
    "route_abc": f"WITH {_R} SELECT sample_id, condition, gec_input, gec_output FROM routed",
    "routed_predictions": f"WITH {_R} SELECT sample_id, condition, raw AS raw_input, CASE condition WHEN 'B' THEN replace(raw, ' da ', ' the ') WHEN 'C' THEN gold_normalised END AS normalizer_output, gec_input, gec_output, CASE WHEN gec_output <> gec_input THEN '$REPLACE_of' ELSE '' END AS tags, 'g' AS gec_version FROM routed",
    "exact_rates": f"WITH {_R} SELECT condition, count(*) AS n, count(*) FILTER (gec_output = gold) AS n_exact, sum({_DIFFERS.format('gec_input')})::BIGINT AS errors_before, sum({_DIFFERS.format('gec_output')})::BIGINT AS errors_after, count(*) FILTER (gec_input = gold AND gec_output <> gold) AS n_overcorrected FROM routed GROUP BY condition",
    "levenshtein_mean": f"WITH {_R} SELECT condition, sum(levenshtein({_ASCII.format('gec_output')}, {_ASCII.format('gold')}))::BIGINT AS total, count(*) AS n FROM routed GROUP BY condition",
    "prediction_faults": f"""WITH {_R}, l AS (SELECT *, length(gold) AS n FROM routed), f AS (SELECT CASE WHEN n % 17 = 0 THEN 'x' || sample_id ELSE sample_id END AS sample_id, condition, CASE WHEN n % 17 = 0 THEN 'unknown_sample' WHEN n % 31 = 0 THEN 'bound_to_other_gec_version' WHEN n % 37 = 0 THEN 'no_model_version'
        WHEN n % 19 = 0 AND raw <> '?' THEN 'raw_input_differs' WHEN condition = 'B' AND n % 23 = 0 THEN 'normalizer_output_misplaced' WHEN n % 29 = 0 AND gec_input <> '?' THEN 'wrong_input' END AS fault FROM l) SELECT * FROM f WHERE fault IS NOT NULL""",
    "osa_total": f"WITH {_R} SELECT condition, sum(CASE WHEN gec_output = gold THEN 0 ELSE damerau_levenshtein({_ASCII.format('gec_output')}, {_ASCII.format('gold')}) END)::BIGINT AS total, count(*) AS n FROM routed GROUP BY condition",
    "per_tag_metrics": f"""WITH {_S}, g AS (SELECT sample_id, unnest(string_split(gold, ' ')) AS w, unnest(range(len(string_split(gold, ' ')))) AS k FROM samples), p AS (SELECT sample_id, unnest(string_split(raw, ' ')) AS w, unnest(range(len(string_split(raw, ' ')))) AS k FROM samples),
        c AS (SELECT count(*) FILTER (g.w = 'of' AND p.w = 'in') AS tp, count(*) FILTER (g.w = 'of') AS support, count(*) FILTER (p.w = 'in') AS n_predicted FROM g FULL JOIN p USING (sample_id, k)),
        z AS (SELECT '$REPLACE_of' AS tag, tp, support, n_predicted, tp / n_predicted AS precision, tp / support AS recall FROM c UNION ALL SELECT '$DELETE', 0, 0, 0, 0.0, 0.0)
        SELECT *, CASE WHEN 0.25 * precision + recall > 0 THEN 1.25 * precision * recall / (0.25 * precision + recall) ELSE 0.0 END AS f_half FROM z""",
    "missing_extra_keys": f"WITH {_R} SELECT sample_id, condition, 'missing' AS fault FROM routed WHERE condition = 'B' AND length(gold) % 7 = 0 UNION ALL SELECT 'x' || sample_id, condition, 'extra' FROM routed WHERE length(gold) % 11 = 0 AND NOT (condition = 'B' AND length(gold) % 7 = 0) UNION ALL SELECT sample_id, condition, 'repeated' FROM routed WHERE condition = 'C' AND length(gold) % 13 = 0",
    "mcnemar": f"""WITH {_R}, p AS (SELECT sample_id, bool_or(condition = 'A' AND gec_output = gold) AS a, bool_or(condition = 'B' AND gec_output = gold) AS b FROM routed GROUP BY sample_id),
        c AS (SELECT count(*) FILTER (a AND NOT b) AS x, count(*) FILTER (b AND NOT a) AS y FROM p),
        t AS (SELECT x, y, unnest(range(least(x, y) + 1)) AS i FROM c)
        SELECT x AS only_a, y AS only_b, round(least(1.0, sum(2 * exp(lgamma(x + y + 1) - lgamma(i + 1) - lgamma(x + y - i + 1) - (x + y) * ln(2)))), 9) AS p FROM t GROUP BY x, y""",
    "bootstrap_ci": f"""WITH {_EDITS},
        c AS (SELECT sample_id, row_number() OVER (ORDER BY sample_id) - 1 AS i, count(*) OVER () AS n, *  EXCLUDE (sample_id) FROM (SELECT sample_id, {', '.join(f"sum({k}) FILTER (condition = '{c.upper()}')::BIGINT AS {k}_{c}" for c in 'ab' for k in ('tp', 'fp', 'fn'))} FROM edits GROUP BY sample_id)),
        m AS (SELECT r, md5(concat_ws(':', '7', r::VARCHAR, k::VARCHAR)) AS h, k FROM range(2000) a(r), range((SELECT (count(*) + 3) // 4 FROM c)) b(k)),
        d AS (SELECT r, ('0x' || substr(h, (8 * j + 1)::BIGINT, 8))::BIGINT % (SELECT count(*) FROM c) AS i FROM m, range(4) q(j) WHERE 4 * k + j < (SELECT count(*) FROM c)),
        s AS (SELECT r, {', '.join(f'sum({k}_{c}) AS {k}_{c}' for c in 'ab' for k in ('tp', 'fp', 'fn'))} FROM d JOIN c USING (i) GROUP BY r),
        e AS (SELECT list_sort(list(({_f('tp_b', 'fp_b', 'fn_b')}) - ({_f('tp_a', 'fp_a', 'fn_a')}))) AS v FROM s)
        SELECT round(list_sum(v) / len(v), 9) AS mean_delta, round(v[floor(0.025 * (len(v) - 1))::INT + 1], 9) AS low, round(v[floor(0.975 * (len(v) - 1))::INT + 1], 9) AS high FROM e""",
    "noise_inject": f"WITH {_NOISE} SELECT * FROM made",
    "noise_replay": f"WITH {_NOISE} SELECT category, count(*) AS n, count(*) AS n_replayed FROM made GROUP BY category",
    "feature_map": f"WITH {_MAPPED} SELECT * FROM m",
    "resource_freeze_checks": f"WITH {_MAPPED}, k AS (SELECT * FROM m WHERE state IS NOT NULL) SELECT lemma, count(DISTINCT state) AS n_states, count(DISTINCT state) >= 3 AS enough, count(*) AS n_rows FROM k GROUP BY lemma",
    "largest_remainder": """WITH t AS (SELECT source, count(*) AS total FROM documents GROUP BY source), p AS (SELECT source, total, unnest([0, 1, 2]) AS i, unnest([70, 15, 15]) AS p FROM t),
        w AS (SELECT *, total * p // 100 AS whole, row_number() OVER (PARTITION BY source ORDER BY total * p % 100 DESC, i) AS place FROM p), l AS (SELECT *, total - sum(whole) OVER (PARTITION BY source) AS rest FROM w),
        s AS (SELECT source, total, i, whole + CASE WHEN place <= rest THEN 1 ELSE 0 END AS n FROM l)
        SELECT source, total, max(n) FILTER (i = 0)::BIGINT AS train, max(n) FILTER (i = 1)::BIGINT AS dev, max(n) FILTER (i = 2)::BIGINT AS test FROM s GROUP BY source, total""",
    "prediction_edit_faults": f"WITH {_R}, l AS (SELECT sample_id, condition, length(gold) % 13 AS n FROM routed) SELECT sample_id, condition, ['tags_without_edits', 'unknown_coordinate_space', 'edits_do_not_replay', 'untagged_edit', 'unregistered_tag', 'tags_differ_from_edits', 'no_output'][n] AS fault FROM l WHERE n BETWEEN 1 AND 7",
    "eval_composition": f"WITH {_NOISE}, t AS (SELECT item_id, count(DISTINCT category) AS n, min(category) AS c FROM benchmark LEFT JOIN made ON item_id = sample_id GROUP BY item_id) SELECT CASE WHEN n = 0 THEN 'clean_control' WHEN n > 1 THEN 'mixed' ELSE c END AS kind, count(*) AS n FROM t GROUP BY 1",
}
