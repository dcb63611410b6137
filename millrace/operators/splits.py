"""Whole documents to train, dev and test: greedy assignment of groups, and its join back to the rows."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RATIOS = {"train": 0.70, "dev": 0.15, "synthetic_test": 0.15}


def group_key(source_doc_id: Column, clean_id: Column) -> Column:
    """The document, or the sentence itself where it has none."""
    blank = F.trim(F.coalesce(source_doc_id, F.lit(""))) == ""
    return F.when(blank, F.concat(F.lit("sentence:"), clean_id)).otherwise(F.concat(F.lit("document:"), source_doc_id))


def assign(counts: dict[str, int], seed: int, ratios: dict[str, float] = RATIOS) -> dict[str, str]:
    """Largest group first, each to the split that is emptiest for its ratio; ties by hash.

    Sequential by nature: every choice depends on all before it, so it folds over (group, rows) and never over rows.
    """
    tie = lambda key: hashlib.sha256(f"{seed}\x00{key}".encode()).hexdigest()
    total, filled, out = sum(counts.values()), dict.fromkeys(ratios, 0), {}
    for key in sorted(counts, key=lambda k: (-counts[k], tie(k))):
        split = min(ratios, key=lambda s: (filled[s] / (total * ratios[s]), tie(f"{key}:{s}")))
        out[key], filled[split] = split, filled[split] + counts[key]
    return out


def greedy_split(df: DataFrame, seed: int, key: str = "group_key") -> DataFrame:
    """df with split. The group table (one row per document) is folded on the driver, as its order is global: about 200 bytes a document,
    so some ten million of them at most; ``hash_split`` has no such bound."""
    counted = {r[0]: r[1] for r in df.groupBy(key).count().toLocalIterator()}
    rows = list(assign(counted, seed).items())
    assigned = df.sparkSession.createDataFrame(rows, f"{key} string, split string") if rows else df.select(F.col(key), F.lit("").alias("split")).limit(0)
    return df.join(assigned, key)


def hash_split(df: DataFrame, seed: int, key: str = "group_key", ratios: dict[str, float] = RATIOS) -> DataFrame:
    """df with split, by where the group's hash falls: no table of groups anywhere, so it scales with the rows.

    The shares are met in expectation rather than greedily; groups stay whole.
    """
    spot = F.conv(F.left(F.sha2(F.concat(F.lit(f"{seed}\x00"), F.col(key)), 256), F.lit(8)), 16, 10).cast("long") / float(1 << 32)
    out, edge = None, 0.0
    for name, ratio in list(ratios.items())[:-1]:
        edge += ratio
        out = F.when(spot < edge, name) if out is None else out.when(spot < edge, name)
    last = list(ratios)[-1]
    return df.withColumn("split", out.otherwise(last) if out is not None else F.lit(last))
