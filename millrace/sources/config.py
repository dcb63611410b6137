"""Build configuration, noise rules and the normaliser's inventory: small, validated documents."""

from __future__ import annotations

import json
from collections.abc import Iterable
from decimal import Decimal
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.provenance import canonical_hash

CATEGORIES_OF_MATCH = ("token", "phrase", "substring")


def load(path: str | Path) -> dict:
    """JSON, or YAML where PyYAML is there."""
    text = Path(path).read_text(encoding="utf-8")
    try:
        out = json.loads(text)
    except ValueError:
        import yaml

        out = yaml.safe_load(text)
    if not isinstance(out, dict):
        raise ValueError(f"{path} is not an object")
    return out


def validate(config: dict) -> str:
    """The configuration's hash, if its ratios are exact and its counts possible."""
    ratios = {k: Decimal(str(v)) for k, v in config["split_ratios"].items()}
    if sum(ratios.values()) != 1 or min(ratios.values()) <= 0:
        raise ValueError("split ratios do not add up to 1")
    if not 0 <= Decimal(str(config["errorful_ratio"])) <= 1:
        raise ValueError("the errorful ratio is no share")
    if int(config["target_rows"]) < 1 or int(config["shards"]) < 1:
        raise ValueError("targets and shards are at least 1")
    return canonical_hash(config)


def noise_rules(spark: SparkSession, document: dict) -> DataFrame:
    """(id, category, source, target, pattern_id, match_mode) of a frozen document whose rules are all approved."""
    rules = document.get("rules", [])
    if document.get("status") != "frozen" or any(r.get("review_status") != "approved" for r in rules):
        raise ValueError("noise rules are not frozen and approved")
    if len({r["id"] for r in rules}) != len(rules):
        raise ValueError("rule ids repeat")
    if bad := [r["id"] for r in rules if r["source"] == r["target"] or r.get("match_mode", "token") not in CATEGORIES_OF_MATCH]:
        raise ValueError(f"rules change nothing or match in no known way: {bad}")
    rows = [(r["id"], r["category"], r["source"], r["target"], r.get("pattern_id", r["id"]), r.get("match_mode", "token")) for r in rules]
    return spark.createDataFrame(rows, "id string, category string, source string, target string, pattern_id string, match_mode string")


def inventory(spark: SparkSession, document: dict) -> DataFrame:
    """(rule_id, pattern_id) of a normaliser's frozen inventory, one row per pattern."""
    rules = document.get("rules", [])
    if document.get("status") != "frozen" or any(r.get("review_status") != "approved" for r in rules):
        raise ValueError("the inventory is not frozen and approved")
    rows = [(r["id"], p) for r in rules for p in (r.get("pattern_ids") or [r.get("pattern_id") or r["id"]])]
    return spark.createDataFrame(rows, "rule_id string, pattern_id string")


def seen_status(edits: DataFrame, held: DataFrame) -> DataFrame:
    """edits(rule_id, pattern_id) with seen_status: a known rule is judged by its own patterns, an unknown one by those of all rules."""
    own = held.select("rule_id", "pattern_id", F.lit(True).alias("own")).distinct()
    rules = held.select("rule_id", F.lit(True).alias("known")).distinct()
    anywhere = held.select("pattern_id", F.lit(True).alias("anywhere")).distinct()
    joined = edits.join(own, ["rule_id", "pattern_id"], "left").join(rules, "rule_id", "left").join(anywhere, "pattern_id", "left")
    status = F.when(F.col("own") | (F.col("known").isNull() & F.col("anywhere")), "seen_rule").otherwise("unseen_pattern")
    return joined.withColumn("seen_status", status).drop("own", "known", "anywhere")


def markdown(title: str, rows: Iterable[dict]) -> str:
    """A report of aggregates as a table."""
    rows = list(rows)
    head = list(rows[0]) if rows else []
    lines = [f"# {title}", "", "| " + " | ".join(head) + " |", "|" + "---|" * len(head)]
    return "\n".join(lines + ["| " + " | ".join(str(r[c]) for c in head) + " |" for r in rows]) + "\n"
