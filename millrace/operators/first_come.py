"""First-come selection: rows are taken in the order of their shards and places, under a quota for each (split, tag).

A pair that occurs again, anywhere, belongs to its first place; only first places count towards quotas. Both steps are
aggregations over places and hashes: pairs are told apart by 128 bits, a place is a struct whose order is that of the input,
and the first rows of a group are a limit per group that is pushed below the shuffle. Texts are never moved.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.operators.generate import bounded
from millrace.operators.select import bounded_quotas
from millrace.sources.workspace import Workspace


class Shortfall(Exception):
    """A split cannot give as many rows as it should."""


@dataclass
class FirstCome:
    """selected(split, tag, place columns, taken), with what was asked of each group, what it has, and what was passed over."""

    selected: DataFrame
    quotas: dict[tuple[str, str], int]
    capacity: dict[tuple[str, str], int]
    collisions: dict[str, int]
    over_quota: DataFrame


def _rejections(places: DataFrame, reason: str, order: list[str], most: int) -> DataFrame:
    """The first ``most`` places of what was passed over, with the reason: a sample that doesn't depend on partitions."""
    ranked = places.withColumn("__n", F.row_number().over(Window.partitionBy(F.lit(reason)).orderBy(*order))).where(F.col("__n") <= most)
    return ranked.drop("__n").withColumn("reason", F.lit(reason))


def select_first_come(
    candidates: DataFrame,
    *,
    order: list[str],
    quotas: dict[tuple[str, str], int] | None = None,
    targets: dict[str, int] | None = None,
    strict: bool = False,
) -> FirstCome:
    """Selects among candidates(split, tag, source_text, target_text, order columns).

    ``order`` names the columns that place a row (file, row, ...); together they should tell rows apart. ``quotas`` is by (split, tag). With ``targets``
    instead, each split's rows are shared out over its tags in proportion to what they have (``bounded_quotas``); ``strict`` refuses a split that has too few.
    """
    ws, place = Workspace(candidates.sparkSession, "first-come"), F.struct(*order)
    pairs = candidates.select(place.alias("place"), "split", "tag", F.xxhash64("source_text", "target_text").alias("p"), F.xxhash64("target_text", "source_text").alias("q"))
    dealt = pairs.repartition("p", "q")  # few pairs occur twice, so rows are dealt out as they are and sorted only once
    kept = dealt.groupBy("p", "q").agg(F.min(F.struct("place", "split", "tag")).alias("first"), F.count("*").alias("times"))
    kept = ws.save(kept.select("first.*", "times"), "pairs")
    capacity, collisions = {}, {}
    for r in kept.groupBy("split", "tag").agg(F.count("*").alias("n"), F.sum(F.col("times") - 1).alias("again")).collect():  # splits * tags rows
        capacity[(r.split, r.tag)] = r.n
        collisions[r.split] = collisions.get(r.split, 0) + r.again
    if quotas is None:
        quotas = {}
        for split, target in (targets or {}).items():
            held = {t: n for (s, t), n in capacity.items() if s == split}
            if strict and sum(held.values()) < target:
                raise Shortfall(f"{split} has {sum(held.values())} of {target} rows")
            quotas |= {(split, t): q for t, q in bounded_quotas(held, target).items()}
    most = max(quotas.values(), default=0)
    table = candidates.sparkSession.createDataFrame([(*k, q) for k, q in quotas.items()], "split string, tag string, quota long")  # splits * tags rows
    # A group's first rows are among its first beginnings of places (file and row, say): as many of these as rows are wanted.
    lead = {f"__{k}": F.col(f"place.{c}") for k, c in enumerate(order[:2])}
    begun = kept.groupBy(F.col("split").alias("__s"), F.col("tag").alias("__t"), *[c.alias(k) for k, c in lead.items()]).agg(F.count("*").alias("__n"))
    begun = begun.withColumn("__n", F.row_number().over(Window.partitionBy("__s", "__t").orderBy(*lead))).where(F.col("__n") <= most).drop("__n")
    same = (F.col("split") == F.col("__s")) & (F.col("tag") == F.col("__t"))
    for k, c in lead.items():
        same &= c.eqNullSafe(F.col(k))
    early = kept.join(bounded(ws.save(begun, "begun")), same, "left_semi")
    best = early.withColumn("taken", F.row_number().over(Window.partitionBy("split", "tag").orderBy("place"))).where(F.col("taken") <= most)
    chosen = ws.save(best.join(F.broadcast(table), ["split", "tag"]).where("taken <= quota").select("split", "tag", "place", "taken"), "chosen")
    over = kept.join(chosen.select("split", "tag", "place"), ["split", "tag", "place"], "left_anti").select("split", "tag", "place.*")
    return FirstCome(chosen.select("split", "tag", "place.*", "taken"), quotas, capacity, collisions, over)


def rejection_samples(found: FirstCome, order: list[str], most: int = 25) -> DataFrame:
    """The first places that had to wait behind a full quota."""
    return _rejections(found.over_quota, "quota_or_buffer_not_selected", order, most)


def fetched(candidates: DataFrame, found: FirstCome, order: list[str]) -> DataFrame:
    """The selected rows of candidates, whole."""
    return candidates.join(found.selected.select("split", "tag", *order), ["split", "tag", *order], "left_semi")
