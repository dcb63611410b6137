"""Frozen tables: reviewed resources of any size as Parquet, bound to a digest of their rows that doesn't depend on order or files.

The digest is a sum over rows: each row's SHA-256 is cut into eight numbers of 32 bits, and each is added up. Executors add; the driver sees eight sums.
Rows may be stored in any order and any number of files; a row that is changed, added, repeated or lost changes the sums.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.profile import MARKS, STATES
from millrace.operators.provenance import canonical_hash
from millrace.sources.publish import POINTER, Place, manifest_of, publish_folder, published_path

APPROVED = "approved"


class Refused(ValueError):
    """A resource that may not be used; nothing weaker takes its place."""


def row_hash(df: DataFrame) -> Column:
    """The SHA-256 of a row as JSON, its columns in order of name and its nulls written out."""
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)]), {"ignoreNullFields": "false"}), 256)


def multiset_digest(df: DataFrame) -> dict:
    """rows and digest of df as a multiset of rows."""
    hashed = df.select(row_hash(df).alias("h"))
    sums = [F.coalesce(F.sum(F.conv(F.substring("h", 8 * k + 1, 8), 16, 10).cast("decimal(38,0)")), F.lit(0)).alias(f"s{k}") for k in range(8)]
    row = hashed.agg(F.count("*").alias("rows"), *sums).first()
    return {"rows": row.rows, "digest": canonical_hash([row.rows, sorted(df.columns), *[int(row[f"s{k}"]) for k in range(8)]])}


def freeze_table(df: DataFrame, target: str, *, version: str, reviewer: str) -> dict:
    """Publishes df, whose rows must all be approved, as a frozen table; what was written is what the digest is of. A frozen table is never overwritten."""
    if Place(df.sparkSession, target).below(POINTER).exists():
        raise FileExistsError(f"{target} is frozen")
    if "review_status" not in df.columns or not df.where(~F.col("review_status").eqNullSafe(APPROVED)).isEmpty():
        raise Refused("rows are not approved")

    def write(path: str) -> dict:
        df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
        written = df.sparkSession.read.schema(df.schema).parquet(path)
        return {"status": "frozen", "version": version, "reviewer": reviewer, "schema": json.loads(written.schema.json()), **multiset_digest(written)}

    return publish_folder(df.sparkSession, target, write)


def load_frozen_table(spark: SparkSession, target: str, *, schema: str, version: str | None = None) -> DataFrame:
    """A frozen table, or no rows of schema if there is none. One that is not what its manifest says is refused before a row of it is used."""
    try:
        manifest = manifest_of(spark, target)
    except FileNotFoundError:
        return spark.createDataFrame([], schema)
    held = spark.read.schema(StructType.fromJson(manifest["schema"])).parquet(published_path(spark, target))
    found = multiset_digest(held)
    wrong = [k for k in ("rows", "digest") if found[k] != manifest.get(k)]
    wrong += ["status"] if manifest.get("status") != "frozen" else []
    wrong += ["version"] if version is not None and manifest.get("version") != version else []
    if wrong:
        raise Refused(f"{target} disagrees with its manifest in {', '.join(wrong)}")
    return held


# --- The context of generation: resources that are checked together before a candidate is made. --------------------


def _approved(rows: DataFrame, version: str, key: Column, kind: str) -> DataFrame:
    """Faults that any resource may have."""
    fault = F.when(~F.col("review_status").eqNullSafe(APPROVED), "not_approved").when(~F.col("resource_version").eqNullSafe(version), "other_version")
    return rows.select(F.lit(kind).alias("resource"), key.cast("string").alias("key"), fault.alias("fault"))


def context_faults(morphology: DataFrame, constructions: DataFrame, marks: DataFrame, tags: list[tuple[str, str]], versions: dict[str, str], *, least_states: int = 1) -> DataFrame:
    """(resource, key, fault) of everything that keeps resources from being used; no rows if they may be.

    morphology(lemma, surface, state, review_status, resource_version): complete, of known states, no surface of two lemmas, enough states per lemma.
    constructions(correct, wrong, tag, family, ...): a tag of the registry with its family. marks(context, correct, wrong, tag, ...): a context without a mark of its own,
    and the mark that its tag names, changed into another. All are approved and of their version.
    """
    c, spark = F.col, morphology.sparkSession
    registry = F.broadcast(spark.createDataFrame(list(dict.fromkeys(tags)), "tag string, family string").withColumn("known", F.lit(True)))  # as long as the registry
    empty = lambda k: F.coalesce(F.trim(c(k)) == "", F.lit(True))
    found = [_approved(morphology, versions["morphology"], c("surface"), "morphology"), _approved(constructions, versions["constructions"], c("correct"), "constructions"), _approved(marks, versions["marks"], c("context"), "marks")]
    fault = F.when(empty("lemma") | empty("surface"), "incomplete").when(~F.coalesce(c("state").isin(*STATES), F.lit(False)), "unknown_state")
    found.append(morphology.select(F.lit("morphology"), c("surface"), fault))
    found.append(morphology.groupBy("surface").agg(F.countDistinct("lemma").alias("n")).where("n > 1").select(F.lit("morphology"), c("surface"), F.lit("homograph")))
    found.append(morphology.groupBy("lemma").agg(F.countDistinct("state").alias("n")).where(c("n") < least_states).select(F.lit("morphology"), c("lemma"), F.lit("too_few_states")))
    found.append(constructions.join(registry, ["tag", "family"], "left").where("known is null").select(F.lit("constructions"), c("correct"), F.lit("unknown_tag_or_family")))
    wanted = F.element_at(F.create_map(*[F.lit(x) for name, mark in MARKS.items() for x in (f"$CHANGE_PUNC_{name}", mark)]), c("tag"))
    own = empty("context") | c("context").rlike("[.?!]$")
    bad = own | ~F.coalesce(c("correct").isin(*MARKS.values()) & c("wrong").isin(*MARKS.values()) & (c("correct") != c("wrong")) & (c("correct") == wanted), F.lit(False))
    found.append(marks.where(bad).select(F.lit("marks"), c("context"), F.lit("invalid_context")))
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out.where("fault is not null").distinct()


def require_context(*args: object, **options: object) -> None:
    """Raises ``Refused`` with the first faults of a context, before any candidate is made."""
    if faults := context_faults(*args, **options).orderBy("resource", "key", "fault").head(5):
        raise Refused("; ".join(f"{f.resource}: {f.key}: {f.fault}" for f in faults))


def checked(rows: DataFrame, faults: Column, key: str) -> DataFrame:
    """rows, in whose plan the first one with faults (an array) fails the job before it is written or counted."""
    message = F.concat(F.lit("invalid row "), F.coalesce(F.col(key).cast("string"), F.lit("?")), F.lit(": "), F.concat_ws(", ", faults))
    return rows.where(F.when(F.size(faults) > 0, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
