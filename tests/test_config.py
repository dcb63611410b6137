import json

import pytest

from millrace.sources import config

GOOD = {"split_ratios": {"train": 0.7, "dev": 0.15, "test": 0.15}, "errorful_ratio": 0.83, "target_rows": 10, "shards": 2}


def test_configuration(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text(json.dumps(GOOD))
    assert config.validate(config.load(path)) == config.validate(dict(reversed(GOOD.items())))
    for bad in ({"split_ratios": {"train": 0.7, "dev": 0.2}}, {"errorful_ratio": 2}, {"shards": 0}):
        with pytest.raises(ValueError, match="."):
            config.validate(GOOD | bad)


def test_rules_and_inventory(spark):
    rule = {"id": "r", "category": "slang", "source": "gud", "target": "good", "review_status": "approved"}
    assert config.noise_rules(spark, {"status": "frozen", "rules": [rule]}).first().pattern_id == "r"
    for bad in ({"status": "draft", "rules": [rule]}, {"status": "frozen", "rules": [rule, rule]}, {"status": "frozen", "rules": [rule | {"source": "good"}]}):
        with pytest.raises(ValueError, match="."):
            config.noise_rules(spark, bad)
    held = config.inventory(spark, {"status": "frozen", "rules": [{"id": "a", "pattern_ids": ["p", "q"], "review_status": "approved"}, {"id": "b", "review_status": "approved"}]})
    edits = spark.createDataFrame([("a", "p"), ("a", "b"), ("new", "q"), ("new", "z")], "rule_id string, pattern_id string")
    got = {(r.rule_id, r.pattern_id): r.seen_status for r in config.seen_status(edits, held).collect()}
    assert got == {("a", "p"): "seen_rule", ("a", "b"): "unseen_pattern", ("new", "q"): "seen_rule", ("new", "z"): "unseen_pattern"}
    assert config.markdown("T", [{"a": 1}]) == "# T\n\n| a |\n|---|\n| 1 |\n"
