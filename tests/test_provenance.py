import pytest
from pyspark.sql import functions as F

from millrace.operators import contracts
from millrace.operators import provenance as p


def test_manifests_cover_one_plan():
    shards = [{"plan_hash": "h", "shards": 2, "shard": i, "requested": {"a": 2}, "produced": {"a": 2 - i}, "rejected": {"x": 1}} for i in (0, 1)]
    got = p.aggregate_manifests(shards)
    assert (got["shortfall"], got["rejected"], got["capacity_adequate"]) == ({"a": 1}, {"x": 2}, False)
    for bad in (shards[:1], [shards[0], shards[0]], [shards[0], shards[1] | {"plan_hash": "g"}]):
        with pytest.raises(p.GateClosed):
            p.aggregate_manifests(bad)


def test_plan(spark):
    capacity = spark.createDataFrame([("train", "t", 1, 120)], "split string, tag string, shard int, capacity long")
    plan = p.candidate_plan(capacity, {("train", "t"): 100}, 2, "c")
    assert plan["quotas"] == {"train:t": [0, 100]} and plan["plan_hash"] == p.candidate_plan(capacity, {("train", "t"): 100}, 2, "c")["plan_hash"]
    assert p.buffered_target(100, 0.25, 110) == 110 and p.buffered_target(10, 0.25, 110) == 13


def test_aliases(tmp_path):
    a, b = tmp_path / "a", tmp_path / "b"
    a.write_text("x")
    b.symlink_to(a)
    with pytest.raises(p.GateClosed):
        p.refuse_aliases([a], [b])
    p.refuse_aliases([a], [tmp_path / "c"])
    p.verify_manifest({"status": "complete", "config_hash": "c", "artifact_sha256": p.file_hash(a)}, config_hash="c", artifact=a)
    with pytest.raises(p.GateClosed):
        p.verify_manifest({"status": "complete"}, config_hash="c", artifact=a)
    assert p.tree_hash(tmp_path) == p.tree_hash(tmp_path)


def test_review(spark):
    sample = spark.createDataFrame([("1", "h1"), ("2", "h2")], "pair_id string, row_hash string")
    made = lambda *rows: spark.createDataFrame(list(rows), "pair_id string, row_hash string, decision string")
    people = [{"name": n, "reviewed_at": "2026-01-01T00:00:00+08:00"} for n in "ab"]
    assert p.review_status(sample, made(("1", "h1", "accept"), ("2", "h2", "accept")), {"counts": {"accept": 2}, "reviewers": people}) == "complete"
    assert p.review_status(sample, made(("1", "h1", "accept"), ("2", "h2", "revise")), {"counts": {"accept": 1, "revise": 1}, "reviewers": people}) == "revise"
    assert p.review_status(sample, made(("1", "h1", "accept"), ("2", "zz", "accept")), {"counts": {"accept": 2}, "reviewers": people}) == "stale"
    assert p.review_status(sample, made(("1", "h1", "accept")), {"counts": {"accept": 1}, "reviewers": people}) == "incomplete"
    with pytest.raises(p.GateClosed):
        p.require_review(sample, made(("1", "h1", "accept")), {})


def test_routes(spark):
    samples = spark.createDataFrame([("s", "r", "n")], "sample_id string, raw string, gold_normalised string")
    rows = [("s", "A", "r", None, "r", "o"), ("s", "B", "r", "m", "m", "o"), ("s", "C", "r", "n", "n", "o"), ("s", "C", "r", None, "n", "o"), ("s", "A", "r", "m", "r", "o"), ("s", "C", "r", "n", "r", "o"), ("t", "A", "r", None, "r", "o"), ("s", "B", "r", None, "r", "o"), ("s", "D", "r", None, "r", "o"), ("s", "A", "q", None, "r", "o"), ("s", "A", "r", None, "r", None)]
    schema = "sample_id string, condition string, raw_input string, normalizer_output string, gec_input string, gec_output string"
    got = contracts.route_faults(samples, spark.createDataFrame(rows, schema)).collect()
    assert sorted(r.fault for r in got) == sorted(["normalizer_output_misplaced"] * 3 + ["wrong_input", "unknown_sample", "unknown_condition", "raw_input_differs", "no_output"])


def test_prediction_bindings_and_edits(spark):
    samples = spark.createDataFrame([("s", "a ng b", "a ng b")], "sample_id string, raw string, gold_normalised string")
    edit = (2, 4, "ng", "nang", "t")
    good = ("s", "A", "a ng b", None, "a ng b", "a nang b", "m", "h", "n1", "g1", ["t"], [edit], None)
    cases = {
        None: good,
        "bound_to_other_gec_version": (*good[:9], "g2", *good[10:]),
        "no_model_version": (*good[:6], " ", *good[7:]),
        "tags_without_edits": (*good[:10], None, *good[11:]),
        "unknown_coordinate_space": (*good[:12], "elsewhere"),
        "edits_do_not_replay": (*good[:11], [(2, 4, "ng", "na", "t")], None),
        "untagged_edit": (*good[:11], [(2, 4, "ng", "nang", None)], None),
        "unregistered_tag": (*good[:10], ["u"], [(2, 4, "ng", "nang", "u")], None),
        "tags_differ_from_edits": (*good[:10], ["t", "t"], *good[11:]),
    }
    schema = "sample_id string, condition string, " + ", ".join(f"{k} {v}" for k, v in contracts.PREDICTION.items())
    for wanted, row in cases.items():
        got = contracts.route_faults(samples, spark.createDataFrame([row], schema), bindings={"frozen_evaluation_sha256": "h", "normalizer_version": "n1", "gec_version": "g1"}, tags=["t"]).collect()
        assert [r.fault for r in got] == ([wanted] if wanted else [])


def _record(**changes):
    edit = lambda start, end, source, target, **k: {"start": start, "end": end, "source": source, "target": target, "tag": None, "rule_id": None, "pattern_id": None, "seen_status": None} | k
    row = {
        "sample_id": "1", "split": "evaluation", "source_type": "controlled", "real_or_controlled": "controlled", "base_clean_id": "c1", "raw": "gud ng", "normalised": "good ng", "gold": "good nang",
        "normalization_types": ["slang"], "normalization_edits": [edit(0, 3, "gud", "good", rule_id="r1", pattern_id="p1", seen_status="seen_rule")], "grammar_edits": [edit(5, 7, "ng", "nang", tag="t")], "grammar_tags": ["t"], "grammar_families": ["f"],
        "normalization_rule_id": "r1", "normalization_pattern_id": "p1", "normalization_rule_ids": ["r1"], "normalization_pattern_ids": ["p1"], "normalization_rule_seen_status": "seen_rule",
        "annotator_1": "a", "annotator_2": "b", "adjudication_status": "Approved", "provenance": dict.fromkeys(contracts.PROVENANCE, "x"),
    }
    return row | changes


def test_records(spark):
    norm, gram = _record()["normalization_edits"][0], _record()["grammar_edits"][0]
    control = {"source_type": "clean_control", "real_or_controlled": "controlled", "raw": "x", "normalised": "x", "gold": "x", "normalization_types": [], "normalization_edits": [], "grammar_edits": [], "grammar_tags": [], "grammar_families": []}
    cases = [
        (_record(), []),
        (_record(**control), []),
        (_record(**control | {"gold": "y"}), ["clean_control_changed", "grammar_replay"]),
        (_record(**control | {"grammar_tags": ["t"], "grammar_families": ["f"]}), ["clean_control_edited", "tags_differ_from_edits"]),
        (_record(split="dev"), ["wrong_split"]),
        (_record(source_type="other"), ["unknown_source_type"]),
        (_record(real_or_controlled="authentic"), ["origin_disagrees"]),
        (_record(base_clean_id=None), ["missing_base"]),
        (_record(normalization_types=["slang", "noise"]), ["types"]),
        (_record(annotator_2=" a "), ["annotators"]),
        (_record(adjudication_status="draft"), ["not_adjudicated"]),
        (_record(provenance=dict.fromkeys(contracts.PROVENANCE, "x") | {"license": ""}), ["provenance"]),
        (_record(grammar_tags=["u"], grammar_families=[""]), ["unregistered_tag", "tags_differ_from_edits"]),
        (_record(grammar_edits=[gram | {"tag": None}]), ["untagged_edit", "tags_differ_from_edits"]),
        (_record(grammar_families=["f", "f"]), ["families_differ_from_tags"]),
        (_record(normalization_edits=[norm | {"source": "gut"}]), ["normalization_replay"]),
        (_record(normalization_edits=[norm | {"seen_status": "unseen_pattern"}]), ["seen_status_disagrees", "seen_status_of_record"]),
        (_record(normalization_edits=[norm | {"rule_id": "unknown"}], normalization_rule_ids=["unknown"], normalization_rule_id="unknown"), []),
        (_record(normalization_edits=[norm | {"rule_id": "r2"}], normalization_rule_ids=["r2"], normalization_rule_id="r2"), ["seen_status_disagrees"]),
        (_record(normalization_rule_ids=["r1", "r1"]), ["rule_ids"]),
        (_record(normalization_pattern_id="p2"), ["first_ids"]),
        (_record(normalization_rule_seen_status="maybe"), ["unknown_seen_status", "seen_status_of_record"]),
    ]
    rows = [row | {"sample_id": str(i)} for i, (row, _) in enumerate(cases)]
    df = spark.createDataFrame([tuple(r[k] for k in contracts.RECORD) for r in rows], ", ".join(f"{k} {v}" for k, v in contracts.RECORD.items()))
    got = {int(r.sample_id): r.faults for r in contracts.record_faults(df, {"t": "f"}, ["slang", "abbreviation"], {"r1": ["p1"], "r2": ["p2"]}, "evaluation").collect()}
    assert {i: got.get(i, []) for i in range(len(cases))} == {i: wanted for i, (_, wanted) in enumerate(cases)}


def test_candidates(spark):
    states = {"morphology_source_state": "BASE", "morphology_target_state": "COMPACT", "morphology_lemma": "l", "morphology_resource_version": "1"}
    start = {"operation": "append", "append_anchor": "$START", "append_position": "prepend", "append_sentinel": "$START"}
    after = {"operation": "append", "append_anchor": "previous_token", "source_token_index": 1, "target_token_index": 2, "append_index_anchor": 1}
    verb = {"tag": "$TRANSFORM_VERB_COMPACT", **states}
    cases = [
        ({}, None), ({"tag": "u"}, "unregistered_tag"), ({"target_text": "a b"}, "source_equals_target"), ({"target_text": "a c "}, "target_not_normalized"), ({"source_text": "a\u00a0b"}, "source_not_normalized"), ({"source_text": "zz"}, "alignment_replay_failed"),
        (verb, None), (verb | {"morphology_lemma": ""}, "incomplete_morphology_provenance"), (states, "unexpected_morphology_provenance"), (verb | {"morphology_source_state": "X"}, "invalid_morphology_state"),
        (verb | {"morphology_target_state": "IMPACT"}, "unsupported_morphology_target_state"), (verb | {"morphology_source_state": "COMPACT"}, "same_morphology_state"), (verb | {"morphology_resource_version": "2"}, "morphology_resource_version_mismatch"),
        ({"operation": "swap"}, "unknown_operation"), (start, None), (start | {"append_position": "after"}, "append_anchor_index_mismatch"), (start | {"append_sentinel": None}, "append_start_sentinel_missing"),
        (after, None), (after | {"source_token_index": 2}, "append_anchor_index_mismatch"), (after | {"target_token_index": None}, "append_anchor_index_mismatch"), ({"operation": "append"}, "append_anchor_missing"),
        ({"spans": "0:1"}, None), ({"spans": "0:2"}, "alignment_span_mismatch"),
    ]
    columns = {"pair_id": "string", "tag": "string", "source_text": "string", "target_text": "string", "operation": "string", **dict.fromkeys(states, "string"), "append_anchor": "string", "append_position": "string", "append_sentinel": "string", "append_index_anchor": "long", "source_token_index": "long", "target_token_index": "long", "spans": "string"}
    base = {"tag": "t", "source_text": "a b", "target_text": "a c", "operation": "replace"}
    rows = [tuple(({"pair_id": str(i)} | base | change).get(k) for k in columns) for i, (change, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, ", ".join(f"{k} {v}" for k, v in columns.items()))
    got = {int(r.pair_id): r.reject_code for r in contracts.candidate_faults(df, ["t", "$TRANSFORM_VERB_COMPACT"], F.regexp_replace("source_text", "b", "c"), morphology_version="1", replayed_spans=F.lit("0:1")).collect()}
    assert {i: got.get(i) for i in range(len(cases))} == {i: wanted for i, (_, wanted) in enumerate(cases)}


def test_pairs_and_composition(spark):
    schema = "pair_id string, clean_id string, split string, source_text string, target_text string, is_errorful boolean, num_errors int, correction_tags array<string>"
    rows = [("1", "c", "train", "a", "b", True, 1, ["t"]), ("2", "c", "dev", "a", "a", False, 0, []), ("3", "c", "dev", "a", "b", False, 1, ["t"]), ("4", "", "x", "a", "a", True, 2, ["t", "t"]), ("5", "c", "train", "a", "b", True, 1, ["u"]), ("6", "c", "train", "a", "a", False, 0, None)]
    got = {r.pair_id: r.faults for r in contracts.pair_faults(spark.createDataFrame(rows, schema), ["t"]).collect()}
    assert got == {"3": ["identity_changed", "identity_count", "identity_tagged"], "4": ["unknown_split", "missing_id", "errorful_texts", "errorful_count", "errorful_tag_count"], "5": ["unregistered_tag"]}
    items = [(str(i), "controlled", ["slang"]) for i in range(3)] + [("9", "controlled", ["slang", "noise"]), ("9", "clean_control", None), ("10", "controlled", ["odd"])]
    df = spark.createDataFrame(items, "sample_id string, source_type string, normalization_types array<string>")
    got = {(r.kind, r.n, r.wanted) for r in contracts.composition_faults(df, {"slang": 3, "mixed": 2, "noise": 1}, (2, 5)).collect()}
    assert got == {("mixed", 1, "2"), ("noise", 0, "1"), ("clean_control", 1, "2-5"), ("odd", 1, "none"), ("repeated_id", 1, "0")}
