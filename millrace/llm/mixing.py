"""Mixing sources to target weights by temperature, in DataFrame functions only.

With ``p`` the token shares of the sources, the weights are ``p ** a`` normalised. The exponent starts at 1 and is lowered
as far as the target entropy asks for, but not so far that a source would be repeated more often than
``max_epochs``. Both bounds are found by bisection, four halvings per pass over the small table of sources. The weights become token
budgets: as many epochs of each source as its weight asks for, with the source of the least epochs at ``least_epochs``.

Budgets are realised as block permutations. A source is dealt by a hash of id and text into blocks of about ``block_rows`` rows;
each block is permuted by the rest of the hash and gives its whole epochs plus, for the fraction, the rows at the front of its
permutation until its share of the budget is filled. Rows that repeat id and text more often than a block is long are told by
counting hashes first and are dealt round robin, so no window grows beyond a few blocks, whatever the source's size, and
each source misses its budget by less than one row per block.

Defined cases: null text has no tokens and costs nothing; a null source is a source of its own; null ids are permuted by their texts;
very long texts count whole, and a text longer than what is left of a fraction isn't taken once more; repeated
rows are rows of their own (equal ones tie: which of them stands first makes no difference); one source has weight 1; a source without tokens
keeps its rows for ``least_epochs``; an empty table gives an empty result; other columns are passed on, but for those named as an added one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.workspace import Workspace
from millrace.operators.generate import bounded

_WIDTH = 16


def n_tokens(text: Column) -> Column:
    """White-space words of the text."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")).cast("long")


def _bisect(shares: DataFrame, meets: Column, low: float, high: float, passes: int = 8) -> float:
    """The largest exponent in [low, high] at which ``meets`` (over the column a) holds, if it holds below and not above.

    Each pass halves the interval four times: the sums for all exponents it may need come from one aggregation.
    """
    for _ in range(passes):
        grid = [low + (high - low) * k / _WIDTH for k in range(1, _WIDTH)]
        sums = shares.select("p", F.explode(F.array(*[F.lit(a) for a in grid])).alias("a")).groupBy("a").agg(F.sum(F.pow("p", F.col("a"))).alias("z"), F.sum(F.pow("p", F.col("a")) * F.log("p")).alias("s"), F.max("p").alias("top"), F.min("p").alias("bottom"))
        held = {r.a: r.ok for r in sums.select("a", meets.alias("ok")).collect()}  # 15 rows
        left, right = 0, _WIDTH
        while right - left > 1:
            middle = (left + right) // 2
            left, right = (middle, right) if held[grid[middle - 1]] else (left, middle)
        low, high = low + (high - low) * left / _WIDTH, low + (high - low) * right / _WIDTH
    return low


def temperature(sources: DataFrame, *, entropy: float = 0.98, max_epochs: float = 2.0, least_epochs: float = 1.0) -> float:
    """The exponent for sources(p): entropy is a share of the greatest possible; the repetition limit has precedence."""
    shares = sources.where("p > 0").select("p")
    row = shares.agg(F.count("*").alias("n"), (-F.sum(F.col("p") * F.log("p"))).alias("h"), F.max("p").alias("top"), F.min("p").alias("bottom")).first()
    if row.n < 2 or row.h >= entropy * math.log(row.n):
        return 1.0
    spread = F.pow(F.col("top") / F.col("bottom"), 1 - F.col("a")) * least_epochs
    wanted = _bisect(shares, F.log("z") - F.col("a") * F.col("s") / F.col("z") >= entropy * math.log(row.n), 0.0, 1.0)
    if (row.top / row.bottom) ** (1 - wanted) * least_epochs <= max_epochs:
        return wanted
    return min(1.0, _bisect(shares, spread > max_epochs, wanted, 1.0) + 16.0**-8)


def _digest(seed: int, id_column: Column, text: Column) -> Column:
    """MD5 of seed, id and text: the same in any engine."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(id_column.cast("string"), F.lit("")), F.coalesce(text, F.lit(""))))


def _number(digest: Column, at: int) -> Column:
    """15 of its hexadecimal digits as a number."""
    return F.conv(F.substring(digest, at, 15), 16, 10).cast("long")


def budgets(rows: DataFrame, ws: Workspace, *, block_rows: int = 1024, least_epochs: float = 1.0, **targets: float) -> tuple[DataFrame, float]:
    """(source, tokens, rows, p, weight, epochs, blocks) of each source of rows(source, n), and the exponent."""
    counted = ws.save(rows.groupBy("source").agg(F.sum("n").alias("tokens"), F.count("*").alias("rows")), "sources")
    total = counted.agg(F.sum("tokens")).first()[0] or 0
    shares = counted.withColumn("p", F.col("tokens") / F.lit(float(max(total, 1))))
    a = temperature(shares, least_epochs=least_epochs, **targets)
    raised = shares.withColumn("raised", F.when(F.col("p") > 0, F.pow("p", F.lit(a))).otherwise(0.0))
    sums = raised.agg(F.sum("raised").alias("z"), F.min(F.when(F.col("p") > 0, F.col("raised") / F.col("p"))).alias("least")).first()
    epochs = F.when(F.col("p") > 0, F.col("raised") / F.col("p") / F.lit(sums.least or 1.0)).otherwise(1.0) * least_epochs
    out = raised.select("source", "tokens", "rows", "p", (F.col("raised") / F.lit(sums.z or 1.0)).alias("weight"), epochs.alias("epochs"), F.ceil(F.col("rows") / block_rows).cast("int").alias("blocks"))
    return ws.save(out, "budgets"), a


def mix(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", seed: int = 42, block_rows: int = 1024, **options: float) -> DataFrame:
    """docs repeated to budget, with n_tokens, weight, epoch (from 0), block, and position (in the block's permutation, from 1)."""
    ws = Workspace(docs.sparkSession, "mix")
    digest = _digest(seed, F.col(id_column), F.col(text_column))
    counts = ws.save(docs.select(F.col(source_column).alias("source"), n_tokens(F.col(text_column)).alias("n"), _number(digest, 1).alias("spot")), "counts")
    plan, _ = budgets(counts, ws, block_rows=block_rows, **options)
    often = ws.save(counts.groupBy("spot").agg(F.count("*").alias("n")).where(F.col("n") > block_rows).select(F.col("spot").alias("__often")), "often")
    ws.drop(counts)
    plan = plan.select(F.col("source").alias("__source"), "weight", F.col("epochs").alias("__epochs"), F.col("blocks").alias("__blocks"))
    clean = docs.drop("n_tokens", "weight", "epoch", "block", "position")
    rows = clean.withColumns({"n_tokens": n_tokens(F.col(text_column)), "__digest": digest}).join(bounded(plan), F.col(source_column).eqNullSafe(F.col("__source"))).drop("__source")
    rows = rows.withColumns({"__spot": _number(F.col("__digest"), 1), "__order": _number(F.col("__digest"), 16)})
    spread = F.lit(0)
    if not often.isEmpty():  # rows that repeat are numbered before a saved step, so that a task that runs again deals them as before
        hot = ws.save(rows.join(often, F.col("__spot") == F.col("__often"), "left_semi").withColumn("__number", F.monotonically_increasing_id()), "hot")
        rows = rows.join(often, F.col("__spot") == F.col("__often"), "left_anti").withColumn("__number", F.lit(None).cast("long")).unionByName(hot)
        spread = F.when(F.col("__number").isNotNull(), F.pmod(F.xxhash64("__number"), F.lit(1 << 31))).otherwise(0)
    rows = rows.withColumn("block", F.pmod(F.col("__spot") + spread, F.col("__blocks")).cast("int"))
    block = Window.partitionBy(source_column, "block")
    order = block.orderBy("__order", "__spot")
    running, tail = order.rowsBetween(Window.unboundedPreceding, Window.currentRow), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns({"position": F.row_number().over(order), "__through": F.sum("n_tokens").over(running), "__all": F.sum("n_tokens").over(tail)})
    whole = F.floor(F.col("__epochs") + 1e-9)
    extra = (F.col("__through") <= (F.col("__epochs") - whole) * F.col("__all")) & (F.col("n_tokens") > 0)
    copies = whole.cast("int") + extra.cast("int")
    rows = rows.where(copies > 0).withColumn("epoch", F.explode(F.sequence(F.lit(0), copies - 1)))
    return rows.drop("__digest", "__epochs", "__blocks", "__order", "__spot", "__number", "__through", "__all")
