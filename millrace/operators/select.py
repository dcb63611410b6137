"""Selection by stable hash rank: top-k, quotas, refill, samples, final datasets and stage views."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions.text import rank_hash


def pair_id(seed: int, *parts: Column) -> Column:
    return F.left(rank_hash(seed, *parts), F.lit(32))


def with_rank(candidates: DataFrame, seed: int) -> DataFrame:
    """candidates with rank, which depends on nothing but seed and content. Equal ranks mean equal content, so it needs no other tie breaker than places."""
    c = F.col
    return candidates.withColumn("rank", rank_hash(seed, c("clean_id"), c("split"), c("tag"), c("source_text"), c("target_text")))


def with_pair_id(candidates: DataFrame, seed: int) -> DataFrame:
    """candidates with pair_id: best asked for after selection, as it is a hash of whole texts."""
    c = F.col
    return candidates.withColumn("pair_id", pair_id(seed, c("clean_id"), c("tag"), c("source_text"), c("target_text")))


def ranked(candidates: DataFrame, seed: int) -> DataFrame:
    return with_rank(with_pair_id(candidates, seed), seed)


def top_k(df: DataFrame, by: list[str], k: int, order: list[str]) -> DataFrame:
    """The first k rows of each group (a limit per group is pushed below the shuffle)."""
    return df.withColumn("n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("n") <= k).drop("n")


def reserve_of(quota: int) -> int:
    """How many ranked candidates a group holds for its quota: a quarter more, at least 8 and at most 1000 more."""
    return quota + max(8, min(1000, quota // 4))


def ranked_reserve(df: DataFrame, quotas: dict[tuple[str, str], int]) -> DataFrame:
    """The reserve of each (split, tag) of df(split, tag, rank, pair_id, ...): its least ranks, rows that repeat a pair_id once.

    The greatest reserve is a literal, so that groups are limited before they are sorted whole.
    """
    table = df.sparkSession.createDataFrame([(*k, reserve_of(q)) for k, q in quotas.items()], "split string, tag string, __reserve int")  # splits * tags rows
    keys = ["split", "tag", "rank", "pair_id"]
    once = df.groupBy(*keys).agg(F.min(F.struct(F.lit(0).alias("__"), *[c for c in df.columns if c not in keys])).alias("__row"))
    most = max((reserve_of(q) for q in quotas.values()), default=0)
    best = once.withColumn("__n", F.row_number().over(Window.partitionBy("split", "tag").orderBy("rank", "pair_id"))).where(F.col("__n") <= most)
    return best.join(F.broadcast(table), ["split", "tag"]).where("__n <= __reserve").select(*keys, "__row.*").drop("__")


#: Bits of a rank that its beginning holds: its first 14 hex digits.
BEGINNING = 56
#: What names a candidate among those of its sentence, without a text.
NAMES = ["split", "tag", "r", "p", "q"]


def keyed(df: DataFrame) -> DataFrame:
    """(split, tag, r, clean_id, p, q) of ranked candidates: pairs are told apart by 128 bits of hash, and ranks are ordered by r, their first 56 bits.

    All but clean_id and the few splits and tags are whole numbers, so that what is saved, shuffled and sorted is narrow.
    """
    return _with_names(df).select("split", "tag", "r", "clean_id", "p", "q")


def _with_names(df: DataFrame) -> DataFrame:
    beginning = F.conv(F.left("rank", F.lit(BEGINNING // 4)), 16, 10).cast("long")
    return df.withColumns({"r": beginning, "p": F.xxhash64("source_text", "target_text"), "q": F.xxhash64("target_text", "source_text")})


def first_pairs(df: DataFrame) -> DataFrame:
    """(split, tag, g, r, p, q) of one row per (source, target) pair: its first in order of (split, tag, rank). g numbers (split, tag).

    df holds texts, or is what ``keyed`` makes of them. Groups, which are splits times tags, are numbered on the driver; up to 127 of them stand before the
    rank in one whole number, whose least is aggregated by hash.
    """
    pairs = df if "p" in df.columns else keyed(df)
    held = sorted(tuple(r) for r in pairs.select("split", "tag").distinct().collect())
    groups = F.broadcast(df.sparkSession.createDataFrame([(s, t, g) for g, (s, t) in enumerate(held)], "split string, tag string, g long"))
    numbered = pairs.join(groups, ["split", "tag"])
    if len(held) < 1 << (63 - BEGINNING):
        least = numbered.groupBy("p", "q").agg(F.min(F.shiftleft("g", BEGINNING) + F.col("r")).alias("key"))
        first = least.select("p", "q", F.shiftright("key", BEGINNING).alias("g"), F.col("key").bitwiseAND(F.lit((1 << BEGINNING) - 1)).alias("r"))
    else:
        first = numbered.groupBy("p", "q").agg(F.min(F.struct("g", "r")).alias("key")).select("p", "q", "key.*")
    return first.join(groups, "g").select("split", "tag", "g", "r", "p", "q")


def fetch(df: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of ranked df that chosen names, by rank or by ``NAMES``, one of each. df may be made anew, from the sentences of what was chosen alone."""
    names = ["split", "tag", "rank"] if "rank" in chosen.columns else NAMES
    held = _with_names(df).join(chosen.select(names).distinct(), names, "left_semi")
    return held.dropDuplicates(names).drop("r", "p", "q")  # rows of one rank are equal in content


def quota_select(df: DataFrame, quotas: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """(selected, left over) by ``NAMES``: the first quota rows by rank of each (split, tag), among pairs kept once, in their first group.

    ``most`` is the greatest quota: as a literal, it limits groups before the shuffle, so that no group is sorted whole in one task.
    """
    unique = first_pairs(df)
    best = unique.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("r", "p", "q"))).where(F.col("n") <= most)
    selected = best.join(quotas, ["split", "tag"]).where("n <= quota").select(NAMES)
    return selected, unique.select(NAMES).join(selected.select("p", "q"), ["p", "q"], "left_anti")


def refill(left: DataFrame, gaps: DataFrame, most: int) -> DataFrame:
    """The best left-over rows of each split, as many as its gap(split, gap), none of which is over ``most``."""
    best = left.withColumn("n", F.row_number().over(Window.partitionBy("split").orderBy("r", "p", "q"))).where(F.col("n") <= most)
    return best.join(gaps, "split").where("n <= gap").drop("n", "gap")


def identity_rows(sentences: DataFrame, seed: int, per_split: int) -> DataFrame:
    """The first sentences of each split, unchanged, as pairs without an error."""
    picked = top_k(sentences, ["split"], per_split, ["clean_id"])
    return picked.select(pair_id_identity(seed).alias("pair_id"), "clean_id", F.col("text").alias("source_text"), F.col("text").alias("target_text"), F.lit(False).alias("is_errorful"), F.lit(None).cast("string").alias("tag"), "split")


def pair_id_identity(seed: int) -> Column:
    return F.left(F.sha2(F.concat_ws("|", F.lit("identity"), F.lit(str(seed)), F.col("clean_id")), 256), F.lit(32))


def stage_views(final: DataFrame, first: int) -> DataFrame:
    """final with stage: the first errorful rows of each split by pair_id are dataset1; the others and the identities dataset2."""
    picked = top_k(final.where("is_errorful").select("split", "pair_id"), ["split"], first, ["pair_id"]).distinct().withColumn("__first", F.lit(True))
    joined = final.join(picked, ["split", "pair_id"], "left")
    return joined.withColumn("stage", F.when(F.col("is_errorful") & F.col("__first"), "dataset1_stage2").otherwise("dataset2_stage3")).drop("__first")


# --- Allocation: exact arithmetic over a few dozen keys, on the driver. -------------------------------------------


def largest_remainder(total: int, ratios: list[Decimal]) -> list[int]:
    """total in proportion to ratios, whole numbers, exact sum; what is left goes to the largest fractions, first ones first."""
    exact = [Decimal(total) * r for r in ratios]
    out = [int(e) for e in exact]
    order = sorted(range(len(out)), key=lambda i: (-(exact[i] - out[i]), i))
    for i in order[: total - sum(out)]:
        out[i] += 1
    return out


def shares_of(total: Column, percents: list[int]) -> Column:
    """The same as a column: an array of whole shares of total by percents (which add up to 100), in integer arithmetic."""
    exact = F.array(*[F.struct((-(total * p % 100)).alias("rest"), F.lit(i).alias("i")) for i, p in enumerate(percents)])
    whole = [((total * p - total * p % 100) / 100).cast("long") for p in percents]
    left = (total - sum(whole[1:], whole[0])).cast("int")
    extra = F.transform(F.slice(F.array_sort(exact), F.lit(1), F.greatest(left, F.lit(0))), lambda x: x["i"])
    return F.array(*[w + F.array_contains(extra, F.lit(i)).cast("long") for i, w in enumerate(whole)])


def composition(total: int, errorful: Decimal, splits: list[Decimal]) -> dict[str, list[int] | int]:
    """Errorful and identity rows, whole and by split."""
    wrong = int(Decimal(total) * errorful)
    return {"errorful": wrong, "identity": total - wrong, "errorful_by_split": largest_remainder(wrong, splits), "identity_by_split": largest_remainder(total - wrong, splits)}


def equal_quotas(capacity: dict[str, int], target: int) -> dict[str, int]:
    """An equal share each, no more than there is; then one at a time to what has most left (ties: the greater key)."""
    share = target // max(1, len(capacity))
    out = {k: min(share, c) for k, c in capacity.items()}
    target = min(target, sum(capacity.values()))
    while sum(out.values()) < target:
        out[max((k for k in out if out[k] < capacity[k]), key=lambda k: (capacity[k] - out[k], k))] += 1
    return out


def bounded_quotas(capacity: dict[str, int], target: int) -> dict[str, int]:
    """Shares in proportion to capacity, at least one each while the target lasts, none over its capacity."""
    target, total = min(target, sum(capacity.values())), sum(capacity.values())
    if not total:
        return dict.fromkeys(capacity, 0)
    wanted = {k: Decimal(target) * c / total for k, c in capacity.items()}
    out = {k: min(c, int(wanted[k])) for k, c in capacity.items()}
    for k in sorted(capacity, key=lambda k: (capacity[k], k)):  # rarest first
        if not out[k] and capacity[k] and sum(out.values()) < target:
            out[k] = 1
    while sum(out.values()) < target:
        for k in sorted((k for k in out if out[k] < capacity[k]), key=lambda k: (out[k] - wanted[k], k)):
            if sum(out.values()) < target:
                out[k] += 1
    return out


def shard_quotas(capacity: list[int], target: int) -> list[int]:
    """One tag's quota over shards, in proportion to what each holds (largest remainder), never over it."""
    total = sum(capacity)
    target = min(target, total)
    if not total:
        return [0] * len(capacity)
    out = largest_remainder(target, [Decimal(c) / total for c in capacity])
    out = [min(q, c) for q, c in zip(out, capacity, strict=True)]
    while sum(out) < target:
        i = max((i for i in range(len(out)) if out[i] < capacity[i]), key=lambda i: (capacity[i] - out[i], -i))
        out[i] += 1
    return out


def greedy_quota_select(candidates: DataFrame, quotas: dict[tuple[str, str], int], order: list[str], spare: int = 8) -> DataFrame:
    """Groups in order of (split, tag); each takes its best ranked pairs that no group before it took, up to its quota.

    What a group takes depends on all groups before it, so the fold runs on the driver, over (group, rank, pair) of a reserve: the best rows of
    each group, ``spare`` more than its quota. If collisions leave a quota short while its group has more rows, the reserve is
    widened fourfold and the fold repeated, until every quota is filled or its group exhausted.
    """
    by, most, hashed = ["split", "tag"], max(quotas.values(), default=0) + spare, candidates.withColumns({"__p": F.xxhash64("source_text", "target_text"), "__q": F.xxhash64("target_text", "source_text")})
    while True:
        reserve = top_k(hashed, by, most, order)
        keys = [tuple(r) for r in reserve.select("split", "tag", "rank", "pair_id", "__p", "__q").collect()]
        taken, out, filled, seen = set(), [], dict.fromkeys(quotas, 0), dict.fromkeys(quotas, 0)
        for split, tag, _, pair, p, q in sorted(keys):
            group = (split, tag)
            seen[group] = seen.get(group, 0) + 1
            if filled.get(group, 0) < quotas.get(group, 0) and (p, q) not in taken:
                taken.add((p, q))
                filled[group] += 1
                out.append((split, tag, pair, p, q))
        if all(filled[g] == n or seen[g] < most for g, n in quotas.items()):
            break
        most *= 4
    chosen = candidates.sparkSession.createDataFrame(out, "split string, tag string, pair_id string, __p long, __q long")  # at most the sum of the quotas
    once = top_k(reserve, [*by, "__p", "__q"], 1, order)
    return once.join(chosen, ["split", "tag", "pair_id", "__p", "__q"], "left_semi").drop("__p", "__q")


def greedy_names(df: DataFrame, quotas: dict[tuple[str, str], int]) -> DataFrame:
    """What ``greedy_quota_select`` takes, by ``NAMES``, of what ``keyed`` made: no text is read or hashed again, whatever collides.

    Pairs stand once in each group, at their best rank. A group passes over no more pairs than the groups before it took, so a reserve of as many as all
    quotas together is enough for any of them, and one fold over it on the driver is the whole selection.
    """
    most = sum(quotas.values())
    held = df.sparkSession.createDataFrame([(*k, g) for g, k in enumerate(sorted(quotas))], "split string, tag string, g long")  # splits * tags rows
    once = df.join(F.broadcast(held), ["split", "tag"]).groupBy("g", "p", "q").agg(F.min("r").alias("r"))
    reserve = once.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("r", "p", "q"))).where(F.col("n") <= most)
    taken, out, filled, groups = set(), [], [0] * len(quotas), sorted(quotas)
    for g, r, p, q in sorted(tuple(x) for x in reserve.select("g", "r", "p", "q").collect()):
        if filled[g] < quotas[groups[g]] and (p, q) not in taken:
            taken.add((p, q))
            filled[g] += 1
            out.append((*groups[g], r, p, q))
    return df.sparkSession.createDataFrame(out, "split string, tag string, r long, p long, q long")  # at most the sum of the quotas
