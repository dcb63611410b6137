"""What makes a build trustworthy: hashes, plans, shard manifests and review gates (contracts of rows are in ``contracts``).

Decisions are small (manifests, one row per tag or shard) and live on the driver; whatever is as large as the data is a
DataFrame of faults that has to be empty.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterable
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class GateClosed(Exception):
    """A precondition that does not hold; raised before anything is written."""


def canonical_hash(value: object, ascii_only: bool = False) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=ascii_only).encode()).hexdigest()


def file_hash(path: str | Path) -> str:
    digest = hashlib.sha256()
    with Path(path).open("rb") as f:
        while block := f.read(1 << 20):
            digest.update(block)
    return digest.hexdigest()


def tree_hash(root: str | Path) -> str:
    """One hash of all files below root, by relative path."""
    root = Path(root)
    return canonical_hash([[str(p.relative_to(root)), file_hash(p)] for p in sorted(root.rglob("*")) if p.is_file()])


def refuse_aliases(sources: Iterable[str | Path], targets: Iterable[str | Path]) -> None:
    """No target may be a source or another target under another name (symbolic or hard link)."""
    seen = [Path(s) for s in sources]
    for target in map(Path, targets):
        for other in seen:
            if target.resolve() == other.resolve() or (target.exists() and other.exists() and target.samefile(other)):
                raise GateClosed(f"{target} is {other}")
        seen.append(target)


def verify_manifest(manifest: dict, *, config_hash: str, artifact: str | Path) -> None:
    wanted = {"status": "complete", "config_hash": config_hash, "artifact_sha256": file_hash(artifact)}
    if wrong := [k for k, v in wanted.items() if manifest.get(k) != v]:
        raise GateClosed(f"manifest disagrees in {', '.join(wrong)}")


def buffered_target(target: int, ratio: float, ceiling: int) -> int:
    """What a shard may produce: the target and its buffer, no more than the ceiling."""
    return min(ceiling, target + math.ceil(target * ratio))


def candidate_plan(capacity: DataFrame, quotas: dict[tuple[str, str], int], shards: int, config_hash: str) -> dict:
    """A hash-bound plan of each shard's quota per split and tag, from capacity(split, tag, shard, capacity)."""
    from millrace.operators.select import shard_quotas

    held: dict[tuple[str, str], list[int]] = {}
    for r in capacity.groupBy("split", "tag", "shard").agg(F.sum("capacity").alias("n")).collect():  # splits * tags * shards rows
        held.setdefault((r.split, r.tag), [0] * shards)[r.shard] = r.n
    plan = {"config_hash": config_hash, "shards": shards, "quotas": {f"{s}:{t}": shard_quotas(held.get((s, t), [0] * shards), q) for (s, t), q in sorted(quotas.items())}}
    return plan | {"plan_hash": canonical_hash(plan, ascii_only=True)}


def aggregate_manifests(manifests: list[dict]) -> dict:
    """Shard manifests (plan_hash, shard, shards, requested, produced, rejected) as one; they must cover all shards of one plan."""
    if len({(m["plan_hash"], m["shards"]) for m in manifests}) != 1:
        raise GateClosed("the shards are of different plans")
    if sorted(m["shard"] for m in manifests) != list(range(manifests[0]["shards"])):
        raise GateClosed("the shards are not an exact cover")

    def total(name: str) -> dict[str, int]:
        out: dict[str, int] = {}
        for m in manifests:
            for k, v in m.get(name, {}).items():
                out[k] = out.get(k, 0) + v
        return dict(sorted(out.items()))

    requested, produced = total("requested"), total("produced")
    short = {k: v - produced.get(k, 0) for k, v in requested.items() if produced.get(k, 0) < v}
    body = {"plan_hash": manifests[0]["plan_hash"], "requested": requested, "produced": produced, "rejected": total("rejected"), "shortfall": short, "capacity_adequate": not short}
    return body | {"aggregate_hash": canonical_hash(body)}


def review_time_valid(value: str) -> bool:
    """An ISO time with a time zone."""
    try:
        return datetime.fromisoformat(value).tzinfo is not None
    except (TypeError, ValueError):
        return False


def review_faults(sample: DataFrame, decisions: DataFrame) -> DataFrame:
    """(pair_id, fault) where decisions(pair_id, row_hash, decision) is not an exact cover of sample(pair_id, row_hash)."""
    held = decisions.groupBy("pair_id").agg(F.count("*").alias("n"), F.min("row_hash").alias("d_hash"), F.min("decision").alias("decision"))
    both = sample.withColumn("in_sample", F.lit(True)).join(held, "pair_id", "full")
    fault = (
        F.when(F.col("n").isNull(), "undecided")
        .when(F.col("in_sample").isNull(), "unknown_pair")
        .when(F.col("n") > 1, "decided_twice")
        .when(~F.col("row_hash").eqNullSafe(F.col("d_hash")), "row_changed")
        .when(~F.col("decision").isin("accept", "revise", "reject"), "unknown_decision")
    )
    return both.select("pair_id", fault.alias("fault")).where("fault is not null")


def review_status(sample: DataFrame, decisions: DataFrame, manifest: dict, reviewers: int = 2) -> str:
    """incomplete, stale, reject, revise or complete; only complete opens the gate."""
    faults = {r.fault for r in review_faults(sample, decisions).select("fault").distinct().collect()}
    tally = {r.decision: r.n for r in decisions.groupBy("decision").agg(F.count("*").alias("n")).collect()}
    said = manifest.get("counts", {})
    if "row_changed" in faults:
        return "stale"
    signed = [r for r in manifest.get("reviewers", []) if review_time_valid(r.get("reviewed_at"))]
    if faults or len({r.get("name") for r in signed}) < reviewers or any(tally.get(k, 0) != said.get(k, 0) for k in ("accept", "revise", "reject")):
        return "incomplete"
    return "reject" if tally.get("reject") else "revise" if tally.get("revise") else "complete"


def require_review(*args: object, **options: object) -> None:
    if (status := review_status(*args, **options)) != "complete":
        raise GateClosed(f"review is {status}")
