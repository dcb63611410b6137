"""Diagnostics of a dataset, and counters of what generation did and did not.

Both are single passes: one set of groupings over narrow columns, texts left behind. What they report is checked against itself
before it is returned, and samples are the least of their kind, so that they don't depend on partitions or order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions.text import length_bucket
from millrace.sources.workspace import Workspace

BUCKETS = ["<10", "10-19", "20-29", "30-49", "50+"]
DIMENSIONS = ["tag", "family", "bucket", "publisher", "transition"]


class Inconsistent(Exception):
    """A report whose parts don't add up, or rows that it cannot be made of."""


def described(pairs: DataFrame) -> DataFrame:
    """What diagnostics count of pairs(is_errorful, tag, family, target_text, publisher, source_state, target_state): no texts.

    Fault says why a row can't be counted: morphology without both states, or states without morphology.
    """
    verb = F.coalesce(F.col("tag").startswith("$TRANSFORM_VERB_"), F.lit(False))
    states = F.col("source_state").isNotNull().cast("int") + F.col("target_state").isNotNull().cast("int")
    fault = F.when(verb & (states < 2), "morphology_without_states").when(~verb & (states > 0), "states_without_morphology")
    return pairs.select(
        "is_errorful",
        "tag",
        "family",
        length_bucket(F.col("target_text")).alias("bucket"),
        F.coalesce("publisher", F.lit("<unknown>")).alias("publisher"),
        F.when(states == 2, F.concat_ws(" -> ", "source_state", "target_state")).alias("transition"),
        fault.alias("fault"),
    )


def report(pairs: DataFrame, tags: list[tuple[str, str]]) -> DataFrame:
    """(dimension, value, n, n_errorful, n_identity) by tag, family, length bucket, publisher and state transition, and for the total.

    Tags and families of the registry and all buckets are there, with zeros if need be. Raises ``Inconsistent`` for a tag or family outside the
    registry, for states that don't go with their tag, and if a dimension does not add up to the total: errorful rows over tags and families, all rows over
    buckets and publishers, morphology rows over transitions.
    """
    ws, rows = Workspace(pairs.sparkSession, "diagnostics"), described(pairs)
    sets = [[], *[[d] for d in [*DIMENSIONS, "fault"]]]
    rows = rows.groupBy(*DIMENSIONS, "fault").agg(F.count("*").alias("n"), F.count_if("is_errorful").alias("n_errorful"), F.count_if(~F.col("is_errorful")).alias("n_identity"))  # so that the sets are of kinds of rows, not of rows
    names = F.element_at(F.create_map(*[F.lit(x) for k, d in enumerate([*DIMENSIONS, "fault"]) for x in (63 - (1 << (5 - k)), d)], F.lit(63), F.lit("total")), F.grouping_id().cast("int"))
    counted = rows.groupingSets(sets, *DIMENSIONS, "fault").agg(names.alias("dimension"), F.sum("n").alias("n"), F.sum("n_errorful").alias("n_errorful"), F.sum("n_identity").alias("n_identity"))
    counted = counted.select("dimension", F.coalesce(*DIMENSIONS, "fault", F.when(F.col("dimension") == "total", "rows")).alias("value"), "n", "n_errorful", "n_identity").where("value is not null")
    counted = ws.save(counted, "counted")
    families = list(dict.fromkeys(f for _, f in tags))
    known = [("tag", t) for t, _ in dict.fromkeys(tags)] + [("family", f) for f in families] + [("bucket", b) for b in BUCKETS] + [("total", "rows")]
    registry = pairs.sparkSession.createDataFrame(list(dict.fromkeys(known)), "dimension string, value string")  # as long as the registry
    if stray := counted.where("dimension in ('tag', 'family')").join(F.broadcast(registry), ["dimension", "value"], "left_anti").head(5):
        raise Inconsistent(f"outside the registry: {[(r.dimension, r.value) for r in stray]}")
    sums = {r.dimension: r for r in counted.groupBy("dimension").agg(F.sum("n").alias("n"), F.sum("n_errorful").alias("n_errorful"), F.sum("n_identity").alias("n_identity")).collect()}  # as many as dimensions
    check_sums(sums, counted.where("dimension = 'tag' and value like '$TRANSFORM_VERB_%'").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    zeros = registry.join(counted.select("dimension", "value"), ["dimension", "value"], "left_anti")
    zero = F.lit(0).cast("long")
    return counted.unionByName(zeros.select("dimension", "value", zero.alias("n"), zero.alias("n_errorful"), zero.alias("n_identity")))


def check_sums(sums: dict, verbs: int) -> None:
    """Raises if the sums(dimension: n, n_errorful, n_identity) of a report contradict each other; verbs is the number of morphology rows."""
    if "fault" in sums:
        raise Inconsistent(f"{sums['fault'].n} rows have states that don't go with their tag")
    if not sums:
        return
    total = sums["total"]
    get = lambda d, k: getattr(sums[d], k) if d in sums else 0
    wrong = [d for d in ("tag", "family") if (get(d, "n"), get(d, "n_errorful")) != (total.n_errorful, total.n_errorful)]
    wrong += [d for d in ("bucket", "publisher") if any(get(d, k) != getattr(total, k) for k in ("n", "n_errorful", "n_identity"))]
    wrong += ["transition"] if get("transition", "n") != verbs else []
    if total.n_errorful + total.n_identity != total.n or wrong:
        raise Inconsistent(f"sums disagree with the total: {wrong}")


#: Events that one task counts, on average: they take some hundred bytes each, so a task's memory does not grow with the input.
PLACES_A_TASK = 500_000


def telemetry(events: DataFrame, sentences: DataFrame, tags: list[str], sample: int = 25) -> DataFrame:
    """(tag, outcome, n, positions, samples) of events(clean_id, tag, position, reason), where reason is null for a candidate.

    ``outcome`` is ``selected``, a reason, or ``not_applicable``: sentences with no place for the tag at all. ``positions`` counts distinct places. ``samples``
    holds the first ``sample`` places (clean_id, position) of each outcome, in order. Every tag has its ``not_applicable`` row. Places are
    counted by sentence first, and the first places are among those of the first sentences, so a common reason is no large group anywhere.
    """
    ws = Workspace(events.sparkSession, "telemetry")
    told = ws.save(events.select("clean_id", "tag", F.coalesce("position", F.lit(-1)).cast("long").alias("position"), F.coalesce("reason", F.lit("selected")).alias("outcome")), "events")
    group = ["clean_id", "tag", "outcome"]
    dealt = told.repartition(told.count() // PLACES_A_TASK + 1, "clean_id")  # all of a sentence is in one task; files, and shuffled rows, are small only as long as they are compressed
    places = ws.save(dealt.groupBy(*group, "position").agg(F.count("*").alias("n")).groupBy(*group).agg(F.sum("n").alias("n"), F.count("*").alias("positions")), "places")
    counted = places.groupBy("tag", "outcome").agg(F.sum("n").alias("n"), F.sum("positions").alias("positions"))
    order = Window.partitionBy("tag", "outcome").orderBy("clean_id", "position")
    leading = places.withColumn("k", F.row_number().over(Window.partitionBy("tag", "outcome").orderBy("clean_id"))).where(F.col("k") <= sample).select(group)
    few = told.join(F.broadcast(leading), group, "left_semi")  # at most sample sentences of each outcome
    first = few.select("tag", "outcome", "clean_id", "position").distinct().withColumn("k", F.row_number().over(order)).where(F.col("k") <= sample)
    samples = first.groupBy("tag", "outcome").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "clean_id", "position"))), lambda x: F.struct(x["clean_id"].alias("clean_id"), x["position"].alias("position"))).alias("samples"))
    touched = places.select("tag", "clean_id").distinct().groupBy("tag").agg(F.count("*").alias("touched"))
    registry = events.sparkSession.createDataFrame([(t,) for t in dict.fromkeys(tags)], "tag string")  # as long as the registry
    idle = F.broadcast(registry).join(touched, "tag", "left").select("tag", F.lit("not_applicable").alias("outcome"), (F.lit(sentences.count()) - F.coalesce("touched", F.lit(0))).alias("n"), F.lit(0).cast("long").alias("positions"), F.array().cast("array<struct<clean_id:string,position:bigint>>").alias("samples"))
    return counted.join(samples, ["tag", "outcome"]).unionByName(idle)


def merged(parts: DataFrame, sample: int = 25) -> DataFrame:
    """Several telemetries (of shards, stages or runs over different sentences) as one: counts add up, samples are the first of all."""
    out = parts.groupBy("tag", "outcome").agg(F.sum("n").alias("n"), F.sum("positions").alias("positions"), F.array_sort(F.flatten(F.collect_list("samples"))).alias("samples"))  # sample times parts each
    return out.withColumn("samples", F.slice("samples", 1, sample))
