import hashlib
import math
import random
import time

import pytest
from pyspark.sql import functions as F

from millrace.functions.text import distance, osa
from millrace.operators import evaluate
from millrace.sources import readers, resources


def test_edit_counts(spark):
    df = spark.createDataFrame([("a x c", "a b c", "a y z"), ("a c", "a b c", "a b c"), ("", "", "")], "s string, g string, o string")
    got = [(r.tp, r.fp, r.fn) for r in evaluate.with_edit_counts(df, "s", "g", "o").collect()]
    assert got == [(0, 1, 1), (1, 0, 0), (0, 0, 0)]
    one = evaluate.scores(spark.createDataFrame([(0, 0, 0)], "tp long, fp long, fn long")).first()
    assert (one.precision, one.recall, one.f_half) == (1.0, 1.0, 1.0)


def test_tag_scores_are_multisets(spark):
    schema = "sample_id string, tag string, start long, end long, target string"
    gold = spark.createDataFrame([("s", "t", 0, 0, "x")] * 2, schema)
    got = {r.tag: r for r in evaluate.tag_scores(gold, gold, spark.createDataFrame([("t",), ("u",)], "tag string")).collect()}
    assert (got["t"].tp, got["t"].f_half) == (2, 1.0) and (got["u"].tp, got["u"].precision, got["u"].f_half) == (0, 0.0, 0.0)


def test_edits_apply(spark):
    df = spark.createDataFrame([("good araw", "gud araw ito")], "a string, b string")
    again = evaluate.apply_edits(F.col("a"), evaluate.character_edits("a", "b"))
    assert df.select(again.alias("t")).first().t == "gud araw ito"
    over = F.expr("array(named_struct('start', 0L, 'end', 2L, 'target', 'x'), named_struct('start', 1L, 'end', 3L, 'target', 'y'))")
    assert df.select(evaluate.apply_edits(F.col("a"), over).alias("t")).first().t is None


def test_mcnemar_and_bootstrap(spark):
    df = spark.createDataFrame([(True, False)] * 3 + [(False, True)] * 9 + [(True, True)], "a boolean, b boolean")
    x, y, p = evaluate.mcnemar(df, "a", "b")
    assert (x, y) == (3, 9) and math.isclose(p, 2 * sum(math.comb(12, i) for i in range(4)) / 2**12)
    assert math.isclose(evaluate.mcnemar_p(400, 470), min(1, 2 * sum(math.comb(870, i) for i in range(401)) / 2**870), rel_tol=1e-9) and evaluate.mcnemar_p(0, 0) == 1.0
    assert 0 < evaluate.mcnemar_p(499_000_000, 500_000_000) < 1e-200 or evaluate.mcnemar_p(499_000_000, 500_000_000) == 0
    rng = random.Random(1)
    rows = [(f"s{i}", *[rng.randint(0, 2) for _ in range(6)]) for i in range(200)]
    counts = spark.createDataFrame(rows, "sample_id string, tp_a long, fp_a long, fn_a long, tp_b long, fp_b long, fn_b long")
    found = {indexes: evaluate.bootstrap(counts, resamples=400, indexes=indexes).first() for indexes in ("vectors", "hashed", "mersenne")}
    for r in found.values():  # the same distribution, drawn in three ways
        assert r.low < r.mean_delta < r.high and abs(r.mean_delta - found["mersenne"].mean_delta) < 0.01 and abs(r.low - found["mersenne"].low) < 0.02

    def f_half(tp, fp, fn):
        p, r = (tp / (tp + fp) if tp + fp else float(fn == 0)), (tp / (tp + fn) if tp + fn else 1.0)
        return 1.25 * p * r / (0.25 * p + r) if p + r else 0.0

    ordered, draws, deltas = sorted(rows), random.Random(7), []
    for _ in range(400):
        sums = [sum(v) for v in zip(*[ordered[draws.randrange(200)][1:] for _ in range(200)], strict=True)]
        deltas.append(f_half(*sums[3:]) - f_half(*sums[:3]))
    deltas.sort()
    r = found["mersenne"]
    assert math.isclose(r.low, deltas[int(0.025 * 399)]) and math.isclose(r.high, deltas[int(0.975 * 399)]) and math.isclose(r.mean_delta, sum(deltas) / 400)


def test_banded_distance_is_the_plain_one():
    def plain(a, b):
        d = [[max(i, j) if not min(i, j) else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
        return d[-1][-1]

    rng = random.Random(5)
    for _ in range(1500):
        a, b = ("".join(rng.choice("abcé") for _ in range(rng.randint(0, 14))) for _ in range(2))
        assert osa(a, b) == plain(a, b), (a, b)


def test_noise(spark):
    rules = spark.createDataFrame([("r1", "slang", "gud", "good"), ("r2", "abbr", "w/", "with")], "id string, category string, source string, target string")
    got = evaluate.inject_noise(spark.createDataFrame([("1", "good with x_good"), ("2", "none here")], "sample_id string, text string"), rules, 7)
    assert sorted(r.noisy_text for r in got.collect()) == ["good w/ x_good", "gud with x_good"]


def test_frozen_resources(spark, tmp_path):
    data, manifest = tmp_path / "r.jsonl", tmp_path / "r.json"
    assert resources.load_frozen(spark, data, manifest, "lemma string").isEmpty()
    rows = [{"lemma": "sulat", "review_status": "approved"}]
    resources.freeze(rows, data, manifest, version="1", reviewer="x")
    assert [r.lemma for r in resources.load_frozen(spark, data, manifest, "lemma string").collect()] == ["sulat"]
    for again in (lambda: resources.freeze(rows, data, manifest, version="1", reviewer="x"), lambda: resources.freeze([{"review_status": "draft"}], tmp_path / "n", tmp_path / "m", version="1", reviewer="x")):
        try:
            again()
        except (FileExistsError, ValueError):
            continue
        raise AssertionError("not refused")
    data.write_text(data.read_text() + "\n")
    try:
        resources.load_frozen(spark, data, manifest, "lemma string")
    except ValueError:
        return
    raise AssertionError("altered data were loaded")


def test_construction_faults(spark):
    rows = [("pag-aaral", "pag aaral", "$MERGE_HYPHEN"), ("ika apat", "ika-apat", "$TRANSFORM_SPLIT_HYPHEN"), ("pa rin", "parin", "$MERGE_SPACE"), ("pa rin", "parina", "$MERGE_SPACE"), ("parin", "pa rin", "$MERGE_SPACE")]
    got = resources.construction_faults(spark.createDataFrame(rows, "correct string, wrong string, tag string")).collect()
    assert sorted(r.fault for r in got) == ["letters_differ", "wrong_direction"]


def test_sqlite(spark, tmp_path):
    import sqlite3

    path = str(tmp_path / "c.db")
    with sqlite3.connect(path) as c:
        c.execute("CREATE TABLE sentences (sentence_id TEXT PRIMARY KEY, article_id TEXT, source_id TEXT, sentence_text TEXT, language TEXT, language_confidence REAL, is_duplicate INT)")
        c.execute("CREATE TABLE articles (article_id TEXT, source_id TEXT, url TEXT, canonical_url TEXT, publication_date TEXT)")
        c.execute("CREATE TABLE sources (source_id TEXT, name TEXT, domain TEXT)")
        c.executemany("INSERT INTO sentences VALUES (?, 'a1', ?, ?, 'FILIPINO', 0.99, 0)", [(f"x{i}", "s1" if i else "s9", f"Kumusta {i}") for i in range(10)])
        c.execute("INSERT INTO articles VALUES ('a1', 's1', 'https://example.test/a', '', '2026-01-01')")
        c.execute("INSERT INTO sources VALUES ('s1', '', 'test.example')")
    tables = [readers.read_sqlite(spark, path, t) for t in ("sentences", "articles", "sources")]
    got = {r.clean_id: r for r in readers.sentence_scan(*tables).collect()}
    assert len(got) == 10 and got["x1"].publisher == "test.example" and got["x0"].publisher is None and got["x1"].url_hash
    assert {t["name"]: t["rows"] for t in readers.catalogue(path)} == {"sentences": 10, "articles": 1, "sources": 1}


def test_summary_and_breakdowns(spark):
    rows = [("1", "controlled", "gud ng", "good ng", "good nang", ["slang", "noise"], "seen_rule"), ("2", "controlled", "a b c", "a x c", "a x d", ["slang"], None), ("3", "clean_control", "z", "z", "z", [], None)]
    samples = spark.createDataFrame(rows, "sample_id string, source_type string, raw string, gold_normalised string, gold string, normalization_types array<string>, normalization_rule_seen_status string")
    said = {"1": "good ng", "2": "a b c", "3": "z"}
    predictions = spark.createDataFrame([(k, "B", v) for k, v in said.items()], "sample_id string, condition string, normalizer_output string")
    got = {(r.breakdown, r.value): (r.n, r.tp, r.fn, r.exact_rate, r.error_reduction_rate, r.mean_distance) for r in evaluate.normalization_breakdowns(samples, predictions).collect()}
    assert got == {("all", ""): (2, 1, 1, 0.5, 0.5, 0.5), ("type", "slang"): (2, 1, 1, 0.5, 0.5, 0.5), ("type", "noise"): (1, 1, 0, 1.0, 1.0, 0.0), ("seen_status", "seen_rule"): (1, 1, 0, 1.0, 1.0, 0.0), ("seen_status", "unknown"): (1, 0, 1, 0.0, 0.0, 1.0)}
    routed = samples.select("*", F.lit("A").alias("condition"), F.col("raw").alias("gec_input"), F.when(F.col("sample_id") == "2", "a x cd").otherwise(F.col("gold")).alias("gec_output"))
    ends = {r.value: (r.n, r.tp, r.fp, r.fn, r.n_exact, r.errors_before, r.errors_after, r.mean_osa_distance) for r in evaluate.breakdown(routed, "normalization_types").collect()}
    assert ends == {"slang": (2, 1, 1, 1, 1, 2, 1, 0.5), "noise": (1, 1, 0, 0, 1, 1, 0, 0.0)}
    assert {r.value for r in evaluate.breakdown(routed, "source_type", baseline="gec_input").collect()} == {"controlled"}


def test_exports(spark, tmp_path):
    rows = spark.createDataFrame([("1", "good one", []), ("2", "bad", ["no_letter", "too_long"]), ("3", "other", ["too_long"])], "clean_id string, text string, reason_codes array<string>")
    for kind in ("parquet", "json"):
        target = str(tmp_path / kind)
        report = readers.export_gate(rows, target, kind=kind)
        assert report["status"] == "complete" and report["reasons"] == {"no_letter": 1, "too_long": 2} and (report["validated"], report["quarantined"]) == (1, 2)
        assert {r.clean_id for r in readers.read_export(spark, target, kind=kind).collect()} == {"1", "2", "3"} and [r.clean_id for r in readers.read_export(spark, target, "validated", kind=kind).collect()] == ["1"]
        with pytest.raises(FileExistsError):
            readers.export_gate(rows, target, kind=kind)
    with pytest.raises(readers.Blocked) as why:
        readers.export_gate(rows.unionByName(rows), str(tmp_path / "twice"))
    assert why.value.report["unique_texts"] == 3 and (tmp_path / "twice.blocked.json").exists() and not (tmp_path / "twice").exists()
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\n[1]\n{"a": \n')
    assert sorted((r.line, r.fault) for r in readers.json_line_faults(spark, str(tmp_path / "x.jsonl")).collect()) == [(3, "not an object"), (4, "invalid JSON")]


def test_models_of_any_shape(spark):
    samples = spark.createDataFrame([("1", "a b", "a c")], "sample_id string, raw string, gold_normalised string")
    edit = "array<struct<start:bigint,end:bigint,source:string,target:string,tag:string>>"
    shapes = {
        "text": (lambda t: F.upper(t), None, None),
        "mapping": (lambda t: F.struct(F.upper(t).alias("text"), F.array(F.lit("$X")).alias("predicted_tags")), ["$X"], None),
        "output": (lambda t: F.struct(F.upper(t).alias("output"), F.lit(None).cast(edit).alias("predicted_edits")), None, None),
        "pair": (lambda t: F.struct(F.upper(t).alias("_1"), F.array(F.lit("$Y")).alias("_2")), ["$Y"], None),
        "triple": (lambda t: F.struct(F.upper(t).alias("_1"), F.array(F.lit("$Y")).alias("_2"), F.array().cast(edit).alias("_3")), ["$Y"], []),
    }
    for model, tags, edits in shapes.values():
        got = {r.condition: r for r in evaluate.predict(samples, lambda t: F.concat(t, F.lit("!")), model, conditions=("C", "raw_to_gec", "B", "A"), versions={"gec_version": "7"}).collect()}
        assert {k: (r.raw_input, r.normalizer_output, r.gec_input, r.gec_output) for k, r in got.items()} == {"A": ("a b", None, "a b", "A B"), "B": ("a b", "a b!", "a b!", "A B!"), "C": ("a b", "a c", "a c", "A C")}
        assert all(r.predicted_tags == tags and r.predicted_edits == edits and r.gec_version == "7" for r in got.values())
    for bad in (lambda t: F.length(t), lambda t: F.struct(F.length(t).alias("text")), lambda t: F.array(t)):
        with pytest.raises(ValueError, match="model"):
            evaluate.predict(samples, F.upper, bad)
    with pytest.raises(ValueError, match="conditions"):
        evaluate.predict(samples, F.upper, F.upper, conditions=("D",))
    with pytest.raises(Exception, match="a sample needs"):
        evaluate.predict(samples.withColumn("raw", F.lit(None).cast("string")), F.upper, F.upper).collect()


def test_distances_of_long_texts_against_the_whole_table():
    """Any lengths and many edits, against plain tables; long texts take as many steps as they have characters, not times their distance."""

    def plain(a, b, swaps):
        d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
                if swaps and i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
        return d[-1][-1]

    rng = random.Random(4)
    for k in range(3000):
        a, b = ("".join(rng.choice("abé😀"[: 2 + k % 3]) for _ in range(rng.randint(0, 12))) for _ in "ab")
        assert [distance(a, b, s) for s in (False, True)] == [plain(a, b, s) for s in (False, True)], (a, b)
    text, began = "the house of the man " * 1000, time.time()
    assert distance(text, text.replace("the", "da"), True) == distance(text, text.replace("the", "da")) == 6000
    assert time.time() - began < 10


def test_hashed_draws_are_the_same_over_any_blocks_and_are_not_shuffled(spark, monkeypatch):
    rows = [(i, *[(i * k) % 5 for k in range(1, 7)]) for i in range(203)]
    numbered = spark.createDataFrame(rows, "i long, " + ", ".join(f"{k} long" for k in evaluate.COUNTS))
    wanted = []
    for r in range(20):
        digits = "".join(hashlib.md5(f"7:{r}:{k}".encode()).hexdigest() for k in range(51))
        drawn = [rows[int(digits[8 * j : 8 * j + 8], 16) % 203] for j in range(203)]
        wanted.append((r, *[sum(x[k] for x in drawn) for k in range(1, 7)]))
    for block in (None, 50):
        assert sorted(tuple(r) for r in evaluate._drawn_sums(numbered, 20, 7, block).collect()) == wanted
    assert evaluate._drawn_sums(numbered.limit(0), 20, 7).count() == 0
