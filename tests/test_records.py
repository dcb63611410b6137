import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from millrace.functions.profile import FILIPINO, TAGS
from millrace.operators import diagnostics, evaluate, first_come, generate, replay
from millrace.sources import frozen, positions, publish, readers

VERBS = "lemma string, surface string, state string"


def test_line_numbers_of_one_file_of_many_splits(spark, tmp_path):
    rng = random.Random(3)
    lines = [rng.choice(['{"a": %d}' % k, '{"a": %d}' % k, "", "  ", "[1]", '{"a": ', "é" * rng.randint(1, 90)]) for k in range(4000)]
    (tmp_path / "one.jsonl").write_text("\n".join(lines) + "\n")
    (tmp_path / "two.jsonl").write_text("\n\n[2]\n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000b")
        spark.conf.set("spark.sql.files.openCostInBytes", "100b")
        numbered = positions.numbered_lines(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 8
        got = sorted((r.line, r.value) for r in numbered.where("file like '%one.jsonl'").collect())
        faults = sorted((r.file[-9:], r.line, r.fault) for r in positions.json_line_faults(spark, str(tmp_path)).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == list(enumerate(lines, 1))
    wanted = [("one.jsonl", k, "invalid JSON" if s.startswith("{") else "not an object") for k, s in enumerate(lines, 1) if s.strip() and (not s.startswith("{") or s == '{"a": ')]
    assert faults == [*wanted, ("two.jsonl", 3, "not an object")]


def test_first_come_matches_a_plain_reading(spark, tmp_path):
    rng = random.Random(4)
    rows = [(rng.choice(["train", "dev"]), f"t{rng.randint(0, 3)}", f"s{rng.randint(0, 150)}", "t") for _ in range(600)]
    for k in range(3):
        spark.createDataFrame(rows[200 * k : 200 * (k + 1)], "split string, tag string, source_text string, target_text string").coalesce(1).write.parquet(str(tmp_path / f"shard={k}"))
    df = positions.positioned(spark.read.parquet(str(tmp_path)))
    shards = sorted({r.file for r in df.select("file").collect()})
    found = first_come.select_first_come(df, order=["file", "row"], targets={"train": 25, "dev": 9})
    seen, taken, wanted, again, over = set(), {}, [], {}, 0
    for k, (split, tag, source, _) in enumerate(rows):
        if source in seen:
            continue
        seen.add(source)
        taken[(split, tag)] = taken.get((split, tag), 0) + 1
        if taken[(split, tag)] <= found.quotas[(split, tag)]:
            wanted.append((split, tag, k // 200, k % 200, taken[(split, tag)]))
        else:
            over += 1
    for split, tag, source, _ in rows:
        first = next(r for r in rows if r[2] == source)
        again[first[0]] = again.get(first[0], 0) + 1
    assert sorted((r.split, r.tag, shards.index(r.file), r.row, r.taken) for r in found.selected.collect()) == sorted(wanted)
    assert sum(q for (s, _), q in found.quotas.items() if s == "train") == 25 and found.capacity == taken
    assert found.collisions == {s: n - sum(c for (x, _), c in taken.items() if x == s) for s, n in again.items()}
    assert found.over_quota.count() == over and first_come.rejection_samples(found, ["file", "row"], 5).count() == 5
    assert first_come.fetched(df, found, ["file", "row"]).count() == len(wanted)
    with pytest.raises(first_come.Shortfall):
        first_come.select_first_come(df, order=["file", "row"], targets={"train": 10_000}, strict=True)
    assert first_come.select_first_come(df.limit(0), order=["file", "row"], quotas={("train", "t1"): 3}).selected.isEmpty()


def test_token_spans(spark):
    texts = ["", " ", "one", " a  bb\tc ", "x yy　z\x1fw", "é ñandú 漢字", "w " * 700]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", replay.token_spans(F.col("t")).alias("s")).collect()
    for r in got:
        at, wanted = 0, []
        for w in r.t.split():
            at = r.t.index(w, at)
            wanted.append((w, at, at + len(w)))
            at += len(w)
        assert [tuple(s) for s in r.s] == wanted


def test_operations_replay_exactly_and_refuse_what_does_not_fit(spark):
    df = spark.createDataFrame([("1", "Ang bata ay (kumain) ng isda."), ("2", "Si Ana at Ang aso.")], "clean_id string, text string")
    verbs = spark.createDataFrame([("kain", "kumain", "COMPACT"), ("kain", "kakain", "CONTACT")], VERBS)
    built = spark.createDataFrame([("at Ang", "at-Ang", "$MERGE_SPACE", "space")], "correct string, wrong string, tag string, family string")
    marks = spark.createDataFrame([("Si Ana at Ang aso", ".", "?", "$CHANGE_PUNC_PERIOD")], "context string, correct string, wrong string, tag string")
    made = generate.generate(df, FILIPINO)
    for more in (generate.verb_states(df, verbs), generate.constructions(df, built), generate.changed_marks(df, marks)):
        made = made.unionByName(more.select(*generate.CANDIDATE))
    judged = replay.with_operation(made).withColumn("v", replay.validated(F.col("source_text"), F.col("target_text"), F.col("operation"))).collect()
    assert {r.kind for r in judged} >= {"swap", "duplicate", "missing", "case_lower", "case_capital", "add_mark", "change_mark", "construction", "morphology"}
    for r in judged:
        assert r.v.success and r.v.replayed == r.target_text, r
        assert r.source_text[: r.v.source_start] + r.target_text[r.v.target_start : r.v.target_end] + r.source_text[r.v.source_end :] == r.target_text
    assert {(r.correct, r.source_text) for r in judged if r.kind == "missing" and r.clean_id == "1"} >= {("Ang", "bata ay (kumain) ng isda.")}
    operation = "struct<type:string,start:int,end:int,source_surface:string,target_surface:string,anchor_start:int,anchor_end:int,anchor_surface:string>"
    odd = [("a b", ("replace", 0, 1, "x", "y", None, None, None)), ("a b", ("replace", 2, 9, "b", "y", None, None, None)), ("a b", ("append", None, None, None, "c", 2, 3, "z")), ("a b", ("melt", 0, 1, "a", "y", None, None, None)), ("a b", ("replace", 0, 1, "a", "a", None, None, None)), ("a b", ("replace", 0, 1, "a", "q", None, None, None)), ("a b", None)]
    got = spark.createDataFrame(odd, f"s string, o {operation}").select(replay.validated(F.col("s"), F.lit("a b"), F.col("o")).alias("v")).collect()
    span = "span does not match source surface"
    assert [r.v.reason for r in got] == [span, span, span, "unsupported operation type", "no aligned edit span", "operation replay did not recover target", "unsupported operation type"]


def test_words_are_replaced_and_removed_with_their_space(spark):
    df = spark.createDataFrame([("a bb c", 2, 4), ("a bb c", 0, 1), ("a bb c", 5, 6), ("a", 0, 1)], "t string, s int, e int")
    got = df.select(replay.remove_token(F.col("t"), F.col("s"), F.col("e")), replay.replace_span(F.col("t"), F.col("s"), F.col("e"), F.lit("x"))).collect()
    assert [tuple(r) for r in got] == [("a c", "a x c"), ("bb c", "x bb c"), ("a bb", "a bb x"), ("", "x")]


def test_rules_are_what_is_broadcast(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("clean_id"), F.lit("sumulat at pa rin kay w").alias("text"))
    verbs = spark.createDataFrame([("sulat", "sumulat", "COMPACT"), ("sulat", "magsusulat", "CONTACT")], VERBS)
    built = spark.createDataFrame([("pa rin", "parin", "$MERGE_SPACE", "space")], "correct string, wrong string, tag string, family string")
    rules = spark.createDataFrame([("n", "slang", "k", "kay")], "id string, category string, source string, target string")
    samples = df.toDF("sample_id", "text")
    for made in (generate.verb_states(df, verbs), generate.constructions(df, built), evaluate.noise_places(samples, rules, 1)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        joins = [line for line in plan.splitlines() if "BroadcastHashJoin" in line and "lemma" not in line.split("Inner")[0]]
        assert joins and all("BuildRight" in line for line in joins) and made.count() == 50, plan
        assert "SortMergeJoin" not in "\n".join(plan.splitlines()[: plan.splitlines().index(joins[0]) + 1])


def _noise_plainly(text, rules, sample, seed):
    import hashlib

    places, at = [], 0
    for word in text.split(" "):
        places += [(hashlib.sha256(f"{seed}|{sample}|mixed_noise|{r[0]}|{at}".encode()).hexdigest(), r[0], at, r) for r in rules if r[3] == word]
        at += len(word) + 1
    for status in (True, False):
        held = sorted(p for p in places if p[3][4] == status)
        for other in held[1:] if held else ():
            if other[3][1] != held[0][3][1] and other[2] != held[0][2]:
                return sorted((p[2], p[1]) for p in (held[0], other)), status
    return None


def test_two_edits_of_one_status_that_do_not_overlap(spark):
    rng = random.Random(6)
    rules = [("a", "slang", "u", "you", True), ("b", "abbreviation", "w/", "with", True), ("c", "slang", "ya", "you", False), ("d", "spelling", "thru", "through", False), ("e", "abbreviation", "yu", "you", True)]
    texts = {f"s{k}": " ".join(rng.choice(["you", "with", "through", "so"]) for _ in range(rng.randint(1, 7))) for k in range(80)}
    df = spark.createDataFrame(list(texts.items()), "sample_id string, text string")
    table = spark.createDataFrame(rules, "id string, category string, source string, target string, seen boolean")
    got = {r.sample_id: r for r in evaluate.inject_mixed_noise(df, table, 7).collect()}
    for sample, text in texts.items():
        plain = _noise_plainly(text, rules, sample, 7)
        assert (plain is None) == (sample not in got), (sample, text)
        if plain:
            r, made = got[sample], text
            for start, rule in reversed(plain[0]):
                source, target = next((x[2], x[3]) for x in rules if x[0] == rule)
                made = made[:start] + source + made[start + len(target) :]
            assert r.noisy_text == made and r.seen_status == ("seen_rule" if plain[1] else "unseen_pattern") and [e.id for e in r.edits] == [p[1] for p in plain[0]]
            for e in reversed(r.edits):
                made = made[: e.start] + e.target + made[e.end :]
            assert made == text


def test_controlled_rows_keep_grammar_spans_free(spark):
    rules = spark.createDataFrame([("a", "slang", "u", "you", True), ("b", "abbreviation", "w/", "with", True)], "id string, category string, source string, target string, seen boolean")
    edit = "array<struct<start:bigint,end:bigint,source:string,target:string>>"
    rows = [("1", "c1", "you goes with them", "you go with them", [(4, 8, "goes", "go")]), ("2", "c2", "you with go", "you with goes", [(4, 8, "with", "with")]), ("3", "c3", "you is with", "not what it makes", [(4, 6, "is", "are")])]
    got = evaluate.controlled_rows(spark.createDataFrame(rows, f"sample_id string, base_clean_id string, errorful string, correct string, grammar_edits {edit}"), rules, 7).collect()
    assert [(r.sample_id, r.raw_informal, r.adjudication_status) for r in got] == [("1", "u goes w/ them", "pending")]


def test_publishing_on_another_file_system(spark, tmp_path):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.pub.link./out", f"file://{tmp_path}")
    rows = spark.createDataFrame([("1", "a", []), ("2", "b", ["too_long"])], "clean_id string, text string, reason_codes array<string>")
    target = "viewfs://pub/out/export"
    report = readers.export_gate(rows, target, run={"config_hash": "c"})
    assert (report["rows"], report["validated"], report["reasons"], report["run"]) == (2, 1, {"too_long": 1}, {"config_hash": "c"})
    assert readers.read_export(spark, target).count() == 2 and json.loads((tmp_path / "export" / publish.POINTER).read_text())["data"] == report["data"]
    with pytest.raises(FileExistsError):
        readers.export_gate(rows, target)
    views = spark.createDataFrame([("1", "train", "dataset1_stage2"), ("2", "dev", "dataset2_stage3")], "pair_id string, split string, stage string")
    manifest = readers.write_views(views, "viewfs://pub/out/views")
    assert [r["n"] for r in manifest["rows"]] == [1, 1] and readers.read_views(spark, "viewfs://pub/out/views").where("split = 'dev'").count() == 1
    with pytest.raises(ValueError, match="empty"):
        readers.write_views(views.limit(0), "viewfs://pub/out/none")


def test_a_failed_run_publishes_nothing(spark, tmp_path):
    rows = spark.createDataFrame([("1", "a", []), ("2", "b", [])], "clean_id string, text string, reason_codes array<string>")
    late = rows.withColumn("x", F.when(F.col("clean_id") == "2", F.raise_error(F.lit("lost")).cast("int")))
    target = tmp_path / "export"
    with pytest.raises(Exception, match="lost"):
        readers.export_gate(late, str(target))
    assert not (target / publish.POINTER).exists() and not [p for p in target.glob("data-*") if p.exists()]
    with pytest.raises(FileNotFoundError):
        readers.read_export(spark, str(target))
    (target / publish.POINTER).parent.mkdir(exist_ok=True)
    (target / publish.POINTER).write_text('{"status": ')
    with pytest.raises(FileNotFoundError):
        readers.read_export(spark, str(target))
    (target / publish.POINTER).unlink()
    assert readers.export_gate(rows, str(target))["rows"] == 2
    with pytest.raises(readers.Blocked) as why:
        readers.export_gate(rows.unionByName(rows.limit(1)), str(tmp_path / "twice"))
    assert why.value.report["repeated_texts"] == 1 and not (tmp_path / "twice").exists() and json.loads((tmp_path / "twice.blocked.json").read_text())["status"] == "blocked"
    with pytest.raises(readers.Blocked, match="missing"):
        readers.export_gate(rows.withColumn("text", F.when(F.col("clean_id") == "1", F.col("text"))), str(tmp_path / "holes"))


def test_ordered_files(spark, tmp_path):
    rng = random.Random(1)
    rows = [(rng.randint(0, 500), f"v{k}") for k in range(2000)]
    positions.write_ordered(spark.createDataFrame(rows, "k int, v string"), str(tmp_path / "o"), ["k", "v"], files=7)
    files = sorted(p for p in (tmp_path / "o").iterdir() if p.suffix == ".parquet")
    assert len(files) > 4
    plain = list(itertools.chain.from_iterable([(r.k, r.v) for r in spark.read.parquet(str(f)).collect()] for f in files))
    assert plain == sorted(rows)
    got = positions.read_ordered(spark, str(tmp_path / "o")).collect()
    assert sorted((r.position, r.k, r.v) for r in got) == [(i, *r) for i, r in enumerate(sorted(rows))]
    assert positions.order_faults(spark, str(tmp_path / "o"), "k").isEmpty()
    spark.createDataFrame(rows, "k int, v string").coalesce(2).write.parquet(str(tmp_path / "u"))
    assert not positions.order_faults(spark, str(tmp_path / "u"), "k").isEmpty()


PAIRS = "is_errorful boolean, tag string, family string, target_text string, publisher string, source_state string, target_state string"


def test_diagnostics_add_up_or_raise(spark):
    rows = [(True, "$REPLACE_ng", "ng_nang", "a b", "p", None, None), (True, "$TRANSFORM_VERB_BASE", "morphology", "a " * 30, None, "COMPACT", "BASE"), (False, None, None, "x", "p", None, None)]
    got = {(r.dimension, r.value): (r.n, r.n_errorful, r.n_identity) for r in diagnostics.report(spark.createDataFrame(rows, PAIRS), list(TAGS)).collect()}
    assert got[("total", "rows")] == (3, 2, 1) and got[("publisher", "p")] == (2, 1, 1) and got[("publisher", "<unknown>")] == (1, 1, 0)
    assert got[("transition", "COMPACT -> BASE")] == (1, 1, 0) and got[("bucket", "<10")] == (2, 1, 1) and got[("tag", "$DELETE")] == (0, 0, 0) and got[("family", "casing")] == (0, 0, 0)
    assert sum(1 for d, _ in got if d == "tag") == len(dict(TAGS)) and sum(n[0] for (d, _), n in got.items() if d == "family") == 2
    for bad in ((True, "$NOWHERE", "ng_nang", "a", "p", None, None), (True, "$REPLACE_ng", "odd", "a", "p", None, None), (True, "$REPLACE_ng", "ng_nang", "a", "p", "BASE", None), (True, "$TRANSFORM_VERB_BASE", "morphology", "a", "p", None, "BASE"), (False, "$DELETE", "duplicate_word", "a", "p", None, None), (True, "$DELETE", None, "a", "p", None, None)):
        with pytest.raises(diagnostics.Inconsistent):
            diagnostics.report(spark.createDataFrame([*rows, bad], PAIRS), list(TAGS))
    empty = diagnostics.report(spark.createDataFrame([], PAIRS), list(TAGS)).collect()
    assert all(r.n == 0 for r in empty) and len(empty) == len(got) - 3


def test_telemetry_is_the_same_however_rows_are_dealt(spark):
    rng = random.Random(9)
    sentences = spark.range(200).select(F.format_string("c%03d", "id").alias("clean_id"))
    rows = [(f"c{rng.randint(0, 120):03d}", rng.choice(["$A", "$B"]), rng.choice([None, *range(9)]), rng.choice([None, "affixed", "collision"])) for _ in range(900)]
    rows += [("c001", "$A", 3, "hot")] * 500
    results = []
    for n in (1, 5):
        rng.shuffle(rows)
        events = spark.createDataFrame(rows, "clean_id string, tag string, position int, reason string").repartition(n)
        out = diagnostics.telemetry(events, sentences, ["$A", "$B", "$C"])
        results.append({(r.tag, r.outcome): (r.n, r.positions, [tuple(s) for s in r.samples]) for r in out.collect()})
    assert results[0] == results[1]
    for (tag, outcome), (n, positions_, samples) in results[0].items():
        held = [(c, -1 if p is None else p) for c, t, p, r in rows if t == tag and (r or "selected") == outcome]
        if outcome == "not_applicable":
            assert (n, positions_, samples) == (200 - len({c for c, t, *_ in rows if t == tag}), 0, [])
        else:
            assert (n, positions_, samples) == (len(held), len(set(held)), sorted(set(held))[:25])
    assert results[0][("$C", "not_applicable")][0] == 200
    twice = diagnostics.merged(out.unionByName(out)).collect()
    assert {(r.tag, r.outcome): r.n for r in twice} == {k: 2 * v[0] for k, v in results[0].items()} and max(len(r.samples) for r in twice) == 25


def test_external_scan_of_mixed_folders(spark, tmp_path):
    (tmp_path / "deep" / "er").mkdir(parents=True)
    (tmp_path / "a.jsonl").write_text('{"clean_id": 7, "text": "one", "x": 1}\n[1]\n\n{"source": "two", "target": ""}\n')
    (tmp_path / "deep" / "b.json").write_text('{"rows": [{"base_clean_id": "b1",\n "raw": "three"}, {"normalized": null}]}')
    (tmp_path / "deep" / "er" / "c.json").write_text('[{"text": "four"},\n {"source_clean_id": "s"}]')
    (tmp_path / "deep" / "er" / "d.json").write_text('{"text": "five"}')
    spark.createDataFrame([("p1", "six", 3)], "clean_id string, raw_informal string, other int").coalesce(1).write.parquet(str(tmp_path / "deep" / "e"))
    spark.createDataFrame([("seven",)], "target_text string").coalesce(1).write.parquet(str(tmp_path / "f"))
    (tmp_path / "g.txt").write_text('{"text": "not read"}')
    got = sorted((r.kind, r.value) for r in readers.external_scan(spark, str(tmp_path)).collect())
    assert got == sorted([("id", i) for i in ("7", "b1", "s", "p1")] + [("text", t) for t in ("one", "two", "three", "four", "five", "six", "seven")])
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        readers.external_scan(spark, str(tmp_path / "none"))


def test_frozen_tables_are_bound_to_their_rows_alone(spark, tmp_path):
    rows = [(k, f"w{k}", None if k % 3 else k / 7, "approved") for k in range(60)]
    schema = "k int, w string, x double, review_status string"
    df = spark.createDataFrame(rows, schema)
    target = str(tmp_path / "t")
    manifest = frozen.freeze_table(df, target, version="3", reviewer="r")
    held = frozen.load_frozen_table(spark, target, schema=schema, version="3")
    assert sorted(map(tuple, held.collect())) == sorted(rows) and held.schema == df.schema
    data = publish.published_path(spark, target)
    df.orderBy(F.desc("k")).repartition(3).write.mode("overwrite").parquet(data)
    assert frozen.load_frozen_table(spark, target, schema=schema).count() == 60
    assert frozen.multiset_digest(df.repartition(7)) == {k: manifest[k] for k in ("rows", "digest")}
    changed = [df.withColumn("w", F.when(F.col("k") == 5, "x").otherwise(F.col("w"))), df.where("k > 0"), df.unionByName(df.where("k = 1")), df.where("k > 0").unionByName(df.where("k = 1")), df.withColumn("x", F.coalesce("x", F.lit(0.0)))]
    for other in changed:
        other.write.mode("overwrite").parquet(data)
        with pytest.raises(frozen.Refused, match="digest"):
            frozen.load_frozen_table(spark, target, schema=schema)
    df.write.mode("overwrite").parquet(data)
    with pytest.raises(frozen.Refused, match="version"):
        frozen.load_frozen_table(spark, target, schema=schema, version="4")
    with pytest.raises(FileExistsError):
        frozen.freeze_table(df, target, version="3", reviewer="r")
    for status in ("draft", None):
        with pytest.raises(frozen.Refused):
            frozen.freeze_table(df.withColumn("review_status", F.lit(status).cast("string")), str(tmp_path / "u"), version="1", reviewer="r")
    assert frozen.load_frozen_table(spark, str(tmp_path / "missing"), schema=schema).isEmpty()


def test_a_context_with_faults_stops_generation(spark):
    extra = ", review_status string, resource_version string"
    ok = ("approved", "1")
    morphology = [("sulat", "sumulat", "COMPACT", *ok), ("sulat", "magsusulat", "CONTACT", *ok)]
    built, marks = [("pa rin", "parin", "$MERGE_SPACE", "space", *ok)], [("Masaya", ".", "?", "$CHANGE_PUNC_PERIOD", *ok)]
    versions = dict.fromkeys(("morphology", "constructions", "marks"), "1")

    def faults(m, c, k, least=2):
        frames = [spark.createDataFrame(r, s + extra) for r, s in ((m, VERBS), (c, "correct string, wrong string, tag string, family string"), (k, "context string, correct string, wrong string, tag string"))]
        out = sorted((r.resource, r.key, r.fault) for r in frozen.context_faults(*frames, list(TAGS), versions, least_states=least).collect())
        if out:
            with pytest.raises(frozen.Refused):
                frozen.require_context(*frames, list(TAGS), versions, least_states=least)
        else:
            frozen.require_context(*frames, list(TAGS), versions, least_states=least)
        return out

    assert faults(morphology, built, marks) == []
    assert faults([*morphology, ("basa", "sumulat", "BASE", *ok)], built, marks) == [("morphology", "basa", "too_few_states"), ("morphology", "sumulat", "homograph")]
    assert faults([*morphology[:1], ("sulat", "x", "ODD", "approved", "2"), ("sulat", "", "BASE", "draft", "1")], built, marks, 1) == [("morphology", "", "incomplete"), ("morphology", "", "not_approved"), ("morphology", "x", "other_version"), ("morphology", "x", "unknown_state")]
    assert faults(morphology, [("a", "b", "$MERGE_SPACE", "hyphen", *ok)], marks) == [("constructions", "a", "unknown_tag_or_family")]
    for mark in (("Masaya.", ".", "?", "$CHANGE_PUNC_PERIOD"), ("Masaya", ".", ".", "$CHANGE_PUNC_PERIOD"), ("Masaya", "?", ".", "$CHANGE_PUNC_PERIOD"), ("", ".", "?", "$CHANGE_PUNC_PERIOD"), ("Masaya", ".", "?", "$DELETE")):
        assert [f[2] for f in faults(morphology, built, [(*mark, *ok)])] == ["invalid_context"]


def test_invalid_rows_fail_the_plan(spark, tmp_path):
    rows = spark.createDataFrame([("a", []), ("b", [])], "pair_id string, faults array<string>")
    assert frozen.checked(rows, F.col("faults"), "pair_id").count() == 2
    bad = rows.withColumn("faults", F.when(F.col("pair_id") == "b", F.array(F.lit("errorful_count"))).otherwise(F.col("faults")))
    with pytest.raises(Exception, match="invalid row b: errorful_count"):
        frozen.checked(bad, F.col("faults"), "pair_id").write.parquet(str(tmp_path / "out"))
    assert not (tmp_path / "out" / "_SUCCESS").exists()


def test_addresses_with_any_letters_are_found(spark):
    from millrace.operators.quality import URL_OR_EMAIL

    rows = [("sulat kay josé@x.com", True), ("a@b", False), ("ñ_1@é.org", True), ("WWW.x", True)]
    got = spark.createDataFrame(rows, "t string, w boolean").select(F.col("t").rlike(URL_OR_EMAIL).alias("g"), "w").collect()
    assert all(r.g == r.w for r in got)


def test_metadata_is_json_with_sorted_keys_and_nulls(spark):
    words = {k: [None] for k in readers.SENTENCE_COLUMNS}
    words |= {"sentence_id": ["s"], "article_id": ["a"], "source_id": ["z"], "sentence_text": ['Ang "ñ" [at]\n漢字 \\ /'], "language_confidence": [0.5], "token_count": [3], "is_duplicate": [0]}
    kinds = {"language_confidence": "double", "token_count": "bigint", "is_duplicate": "int"}
    sentences = spark.createDataFrame([tuple(v[0] for v in words.values())], ", ".join(f"{k} {kinds.get(k, 'string')}" for k in words))
    articles = spark.createDataFrame([("a", "u", "", "2026-01-01", None)], "article_id string, url string, canonical_url string, publication_date string, headline string")
    sources = spark.createDataFrame([("other", "n", "d")], "source_id string, name string, domain string")
    rows = readers.sentence_rows(sentences, articles, sources)
    assert len(rows.columns) == 20
    got = readers.staged(rows).first()
    wanted = {k: words.get(k, [None])[0] for k in readers.METADATA} | {"article_url": "u", "canonical_url": "", "publication_date": "2026-01-01"}
    assert got.metadata_json == json.dumps(wanted, ensure_ascii=False, sort_keys=True) and len(wanted) == 19
    assert got.publisher is None and got.url_hash is not None


def test_shares_are_whole_and_exact(spark):
    from decimal import Decimal

    from millrace.operators import select

    totals = [0, 1, 7, 10, 101, 830_000, 170_003, 10**12 + 7]
    got = {r.n: r.s for r in spark.createDataFrame([(n,) for n in totals], "n long").withColumn("s", select.shares_of(F.col("n"), [70, 15, 15])).collect()}
    assert all(got[n] == select.largest_remainder(n, [Decimal("0.70"), Decimal("0.15"), Decimal("0.15")]) for n in totals)


def test_token_spans_take_blocks_by_the_number_of_words(spark):
    """By default a block grows with the cube root of the words; any block gives the same spans."""
    df = spark.createDataFrame([("ab  c " * 900,), ("x",), ("",)], "t string")
    r = df.select(replay.token_spans(F.col("t"), None).alias("own"), replay.token_spans(F.col("t"), 128).alias("fixed")).collect()
    assert all(x.own == x.fixed for x in r) and len(r[0].own) == 1800
