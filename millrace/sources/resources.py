"""Reviewed resources: verb paradigms, constructions, marks and noise rules; their freezing and verified loading.

A resource is data plus a manifest that holds its hash. Whatever is missing, unreviewed or altered is refused or
empty, never replaced by something weaker.
"""

from __future__ import annotations

import hashlib
import json
import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.profile import STATES

# Feature names of verb tables.
ASPECTS = {"COMP": ["PFV", "PERF", "PST", "COMPLETED"], "INC": ["IPFV", "IMPF", "PRS", "INCOMPLETED"], "CONT": ["PROSP", "FUT", "CONTEMPLATED"], "IMP": ["IMP", "IMPERATIVE"], "REC": ["REC", "RECENT", "RECENTLY_COMPLETED"]}
FOCI = {"ACT": ["AF", "AV", "ACTOR", "ACTORFOCUS"], "OBJ": ["OF", "OV", "OBJECT", "OBJECTFOCUS"]}
BASES = ["BASE", "INFINITIVE"]


def state_of(features: Column) -> Column:
    """The verb state that a feature bundle (``;`` or ``|`` between features) stands for, or null.

    A hint ``NAME=STATE`` decides; then a base form; then the first aspect that occurs with its focus.
    """
    bundle = F.transform(F.split(F.upper(F.translate(features, "|", ";")), ";"), F.trim)
    has = lambda names: F.arrays_overlap(bundle, F.array(*[F.lit(n) for n in names]))
    hint = F.get(F.filter(F.transform(bundle, lambda f: F.regexp_extract(f, "^[A-Z_]+=(\\w+)$", 1)), lambda s: s.isin(*STATES)), F.lit(0))
    out = F.when(hint.isNotNull(), hint).when(has(BASES), F.lit("BASE"))
    for aspect, names in ASPECTS.items():
        state = F.when(has(FOCI["ACT"]), f"{aspect}ACT").when(has(FOCI["OBJ"]), f"{aspect}OBJ")
        out = out.when(has(names), F.when(~(has(FOCI["ACT"]) | has(FOCI["OBJ"])), "RECCOMP") if aspect == "REC" else state)
    return out


def _any(names: list[str]) -> str:
    return "list_has_any(fs, [" + ", ".join(f"'{n}'" for n in names) + "])"


def _state_sql() -> list[tuple[str, str]]:
    """(state, test over the feature list fs) in order of precedence, for the SQL side."""
    rows = [(s, f"len(list_filter(fs, lambda f: regexp_matches(f, '^[A-Z_]+={s}$'))) > 0") for s in STATES]
    rows.append(("BASE", _any(BASES)))
    before: list[str] = []
    for aspect, names in ASPECTS.items():
        here = " AND ".join([_any(names), *[f"NOT {_any(b)}" for b in before]])
        if aspect == "REC":
            rows.append(("RECCOMP", f"{here} AND NOT {_any(FOCI['ACT'] + FOCI['OBJ'])}"))
        else:
            rows += [(f"{aspect}ACT", f"{here} AND {_any(FOCI['ACT'])}"), (f"{aspect}OBJ", f"{here} AND NOT {_any(FOCI['ACT'])} AND {_any(FOCI['OBJ'])}")]
        before.append(names)
    return rows


STATE_SQL = _state_sql()


def read_paradigm_tsv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """((lemma, surface, state) of the usable lines, (reason, n) of the others) of a tab-separated verb table."""
    lines = spark.read.text(path).where("not value rlike '^\\\\s*(#|$)'").select(F.split("value", "\t").alias("f"))
    state = state_of(F.get("f", F.lit(2)))
    reason = F.when(F.size("f") < 3, "malformed").when(F.trim(F.get("f", F.lit(0))) == "", "empty_lemma").when(state.isNull(), "state_not_supported")
    judged = lines.select(F.trim(F.get("f", F.lit(0))).alias("lemma"), F.trim(F.get("f", F.lit(1))).alias("surface"), state.alias("state"), reason.alias("reason"))
    return judged.where("reason is null").drop("reason").distinct(), judged.where("reason is not null").groupBy("reason").agg(F.count("*").alias("n"))


def paradigm_report(rows: DataFrame, least: int) -> DataFrame:
    """States per lemma, and whether they are enough."""
    out = rows.groupBy("lemma").agg(F.countDistinct("state").alias("n_states"), F.count("*").alias("n_rows"))
    return out.select("lemma", "n_states", (F.col("n_states") >= least).alias("enough"), "n_rows")


def homographs(rows: DataFrame) -> DataFrame:
    """Surfaces that belong to several lemmas, and so cannot be told apart in text."""
    return rows.groupBy("surface").agg(F.countDistinct("lemma").alias("n_lemmas")).where("n_lemmas > 1")


def construction_faults(rows: DataFrame) -> DataFrame:
    """Rows(correct, wrong, tag) that differ in more than hyphens and spaces, or in the wrong direction for their tag."""
    letters = lambda c: F.translate(c, "- ", "")
    n = lambda c, mark: F.length(c) - F.length(F.replace(c, F.lit(mark), F.lit("")))
    hyphens, spaces = n(F.col("correct"), "-") - n(F.col("wrong"), "-"), n(F.col("correct"), " ") - n(F.col("wrong"), " ")
    fits = (
        F.when(F.col("tag").isin("$MERGE_HYPHEN", "$TRANSFORM_INSERT_HYPHEN"), hyphens > 0)
        .when(F.col("tag") == "$TRANSFORM_SPLIT_HYPHEN", hyphens < 0)
        .when(F.col("tag") == "$MERGE_SPACE", spaces > 0)
        .when(F.col("tag") == "$TRANSFORM_SPLIT_SPACE", spaces < 0)
        .otherwise(False)
    )
    fault = F.when(letters(F.col("correct")) != letters(F.col("wrong")), "letters_differ").when(~fits, "wrong_direction")
    return rows.withColumn("fault", fault).where("fault is not null")


def _sha(path: Path) -> str:
    return hashlib.sha256(path.read_bytes()).hexdigest()


def publish(path: str | Path, data: bytes) -> None:
    """Writes a new file completely or not at all; an existing one is never replaced."""
    path = Path(path)
    hidden = path.with_name(f".{path.name}.{os.getpid()}")
    try:
        with hidden.open("xb") as f:
            f.write(data)
            f.flush()
            os.fsync(f.fileno())
        os.link(hidden, path)
    finally:
        hidden.unlink(missing_ok=True)


def freeze(rows: list[dict], data: str | Path, manifest: str | Path, *, version: str, reviewer: str) -> dict:
    """Publishes reviewed rows as JSON lines with a manifest of their hash. Rows that aren't approved stop it."""
    if bad := [r for r in rows if r.get("review_status") != "approved"]:
        raise ValueError(f"{len(bad)} rows are not approved")
    if Path(data).exists() or Path(manifest).exists():
        raise FileExistsError("a frozen resource is never overwritten")
    body = "".join(json.dumps(r, ensure_ascii=False, sort_keys=True) + "\n" for r in rows).encode()
    out = {"status": "frozen", "version": version, "reviewer": reviewer, "rows": len(rows), "sha256": hashlib.sha256(body).hexdigest()}
    publish(data, body)
    try:
        publish(manifest, json.dumps(out, indent=2, sort_keys=True).encode())
    except BaseException:
        Path(data).unlink()
        raise
    return out


def load_frozen(spark: SparkSession, data: str | Path, manifest: str | Path, schema: str) -> DataFrame:
    """A frozen resource, or no rows if it does not exist. Anything that disagrees with its manifest raises."""
    data, manifest = Path(data), Path(manifest)
    if not data.exists() and not manifest.exists():
        return spark.createDataFrame([], schema)
    said = json.loads(manifest.read_text())
    lines = data.read_text().splitlines()
    if said.get("status") != "frozen" or said["sha256"] != _sha(data) or said["rows"] != len(lines):
        raise ValueError(f"{data} is not what its manifest says")
    return spark.read.schema(schema).option("mode", "FAILFAST").json(spark.sparkContext.parallelize(lines, 1)) if lines else spark.createDataFrame([], schema)
