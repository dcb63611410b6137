"""Line dedup by distinct-site spread.

Every line is hashed to 128 bits (trimmed; lines without words are never boilerplate). For each
hash a HyperLogLog sketch of the sites it stands on is aggregated: partial sketches are built
before the shuffle and merged after it, so that a line found everywhere arrives as one
small sketch from each task. Lines whose estimate is clearly under or over ``min_sites`` are settled by it;
those within ``margin`` of it get an exact distinct count. Lines spread over at least ``min_sites`` sites are
boilerplate and are removed from every text.

With ``spare_copies`` copied documents are told from boilerplate. Rows with one text count as one row, and a line's sites are counted only over
documents of which such lines make up less than half the characters: lines that copies or near copies share with nothing else are then
no boilerplate, and the copies stay whole, for near dedup to choose among. A text that would be left without words stays whole too.

What was found of a document goes back to it by a 128-bit hash of id and text, so that rows without id, or with one id, don't meet.

Defined cases: null text stays null with no lines; a null site counts as a site of its own; null ids are documents like any other;
very long texts are split and cut whole; a line on exactly ``min_sites`` sites goes; repeated rows are cleaned each and count once per site; an
empty table gives an empty result; other columns are passed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.workspace import Workspace

_BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def _clean(line: Column) -> Column:
    return F.trim(line, F.lit(_BLANKS))


def _hash(line: Column) -> Column:
    """A 128-bit hash of the trimmed line, or null if it is blank."""
    cut = _clean(line)
    return F.when(cut != "", F.struct(F.xxhash64(cut).alias("x"), F.xxhash64(F.lit(17), cut).alias("y")))


def _key(id_column: Column, text: Column) -> list[Column]:
    """A 128-bit hash of id and text."""
    return [F.xxhash64(F.lit(1), id_column, text).alias("kx"), F.xxhash64(F.lit(2), id_column, text).alias("ky")]


def _lines(docs: DataFrame, id_column: str, text_column: str, site_column: str) -> DataFrame:
    # The hashes in their own select, as what stands beside a generator is computed for each line.
    texts = docs.select(*_key(docs[id_column], docs[text_column]), F.coalesce(docs[site_column].cast("string"), F.lit("\x00null")).alias("site"), F.split(docs[text_column], "\n").alias("parts"))
    lines = texts.select("kx", "ky", "site", F.explode("parts").alias("line"))
    return lines.select("kx", "ky", "site", _hash(F.col("line")).alias("h")).where("h is not null").select("kx", "ky", "site", F.col("h.x").alias("x"), F.col("h.y").alias("y"))


def boilerplate(lines: DataFrame, ws: Workspace, *, min_sites: int = 10, margin: float = 0.25, lg_k: int = 10) -> DataFrame:
    """(x, y, sites, exact): hashes of lines(site, x, y) that are spread over min_sites sites or more."""
    sketches = lines.groupBy("x", "y").agg(F.hll_sketch_agg("site", lg_k).alias("sketch"))
    spread = sketches.select("x", "y", F.hll_sketch_estimate("sketch").alias("estimate")).where(F.col("estimate") >= min_sites * (1 - margin))
    spread = ws.save(spread, "spread")
    over = spread.where(F.col("estimate") > min_sites * (1 + margin)).select("x", "y", F.col("estimate").alias("sites"), F.lit(False).alias("exact"))
    close = spread.where(F.col("estimate") <= min_sites * (1 + margin)).select("x", "y")
    counted = lines.select("site", "x", "y").join(close, ["x", "y"], "left_semi").groupBy("x", "y").agg(F.countDistinct("site").alias("sites"))
    out = ws.save(over.unionByName(counted.where(F.col("sites") >= min_sites).select("x", "y", "sites", F.lit(True).alias("exact"))), "boilerplate")
    ws.drop(spread)
    return out


def _placed_lines(docs: DataFrame, id_column: str, text_column: str, site_column: str) -> DataFrame:
    """_lines with a hash of the whole text (tx, ty), the line's place in it, and the characters (of trimmed lines) of line and text."""
    text, site = docs[text_column], F.coalesce(docs[site_column].cast("string"), F.lit("\x00null"))
    size = F.aggregate("parts", F.lit(0), lambda s, line: s + F.length(_clean(line)))
    # In its own select, as what stands beside a generator is computed for each line.
    texts = docs.select(*_key(docs[id_column], text), site.alias("site"), F.xxhash64(text).alias("tx"), F.xxhash64(F.lit(17), text).alias("ty"), F.split(text, "\n").alias("parts")).withColumn("total", size)
    lines = texts.select("kx", "ky", "site", "tx", "ty", "total", F.posexplode("parts").alias("at", "line"))
    return lines.select("kx", "ky", "site", "tx", "ty", "total", "at", F.length(_clean(F.col("line"))).alias("size"), _hash(F.col("line")).alias("h")).where("h is not null").select("kx", "ky", "site", "tx", "ty", "total", "at", "size", F.col("h.x").alias("x"), F.col("h.y").alias("y"))


def outside_copies(lines: DataFrame, found: DataFrame, ws: Workspace, *, min_sites: int = 10) -> DataFrame:
    """Those (x, y) of found that are spread over min_sites sites or more among the texts less than half of which is lines of found."""
    held = lines.join(found.select("x", "y"), ["x", "y"], "left_semi").groupBy("tx", "ty", "at").agg(*[F.min(c).alias(c) for c in ("site", "x", "y", "size", "total")])
    held = ws.save(held, "held")  # one row per line of each distinct text
    bodies = held.groupBy("tx", "ty").agg(F.sum("size").alias("size"), F.min("total").alias("total")).where("2 * size < total").select("tx", "ty")
    spread = held.join(bodies, ["tx", "ty"], "left_semi").groupBy("x", "y").agg(F.countDistinct("site").alias("sites"))
    out = ws.save(spread.where(F.col("sites") >= min_sites), "outside")
    ws.drop(held)
    return out


def dedup_lines(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", site_column: str = "source", spare_copies: bool = False, **options: float) -> DataFrame:
    """docs with the boilerplate lines cut out of the text, and n_lines (before) and n_removed."""
    ws = Workspace(docs.sparkSession, "lines")
    lines = ws.save((_placed_lines if spare_copies else _lines)(docs, id_column, text_column, site_column), "lines")  # hashes only: split once, read three times
    found = boilerplate(lines, ws, **options)
    if spare_copies:
        found = outside_copies(lines, found, ws, **{k: v for k, v in options.items() if k == "min_sites"})
    own = lines.join(found.select("x", "y"), ["x", "y"], "left_semi").groupBy("kx", "ky").agg(F.collect_set(F.struct("x", "y")).alias("__found"))
    own = ws.save(own, "found")
    ws.drop(lines)
    # The texts are shuffled at every size: how many documents hold boilerplate grows with the table, so it is no side to broadcast.
    keyed = docs.select("*", *[k.alias(f"__{c}") for c, k in zip(("kx", "ky"), _key(docs[id_column], docs[text_column]), strict=True)])
    joined = keyed.join(own.withColumnsRenamed({"kx": "__ox", "ky": "__oy"}).hint("merge"), (F.col("__kx") == F.col("__ox")) & (F.col("__ky") == F.col("__oy")), "left").drop("__kx", "__ky", "__ox", "__oy")
    split = F.split(F.col(text_column), "\n")
    kept = F.when(F.col("__found").isNull(), split).otherwise(F.filter(split, lambda line: ~F.coalesce(F.array_contains("__found", _hash(line)), F.lit(False))))
    if spare_copies:
        joined, kept = joined.withColumn("__cut", kept), F.when(F.exists("__cut", lambda line: _clean(line) != ""), F.col("__cut")).otherwise(split)
    out = joined.withColumns({"__kept": kept, "n_lines": F.coalesce(F.size(split), F.lit(0)).cast("long")})
    out = out.withColumn("n_removed", F.when(F.col(text_column).isNull(), F.lit(0)).otherwise(F.col("n_lines") - F.size("__kept")).cast("long"))
    return out.withColumn(text_column, F.when(F.col("__found").isNull(), F.col(text_column)).otherwise(F.concat_ws("\n", "__kept"))).drop("__kept", "__cut", "__found")
