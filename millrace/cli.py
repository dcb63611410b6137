"""``python -m millrace.cli COMMAND``: the steps of a corpus build, each reading and writing folders.

Exit code 2 means that a gate refused.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from millrace.functions.profile import ENGLISH, FILIPINO
from millrace.functions.text import with_normalised
from millrace.operators import generate, quality, select, splits
from millrace.sources import readers, resources

PROFILES = {p.name: p for p in (FILIPINO, ENGLISH)}


class Refused(Exception):
    """A gate that did not open."""


def inspect(spark: SparkSession, a: argparse.Namespace) -> None:
    print(json.dumps(readers.catalogue(a.input), indent=2))


def export(spark: SparkSession, a: argparse.Namespace) -> None:
    """SQLite to base, validated and quarantined Parquet, if normalised texts are unique."""
    scan = readers.sentence_scan(*(readers.read_sqlite(spark, a.input, t) for t in ("sentences", "articles", "sources")))
    rows = with_normalised(scan, "raw_text", "text").drop("raw_text")
    try:
        print(json.dumps(readers.export_gate(quality.with_reasons(rows, PROFILES[a.profile].rules), a.output, kind=a.format)))
    except readers.Blocked as why:
        raise Refused(str(why)) from why


def split(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = spark.read.parquet(a.input)
    keyed = rows.withColumn("group_key", splits.group_key(F.col("source_doc_id"), F.col("clean_id")))
    splits.greedy_split(keyed, a.seed).write.mode("errorifexists").parquet(a.output)


def candidates(spark: SparkSession, a: argparse.Namespace) -> None:
    made = select.ranked(generate.generate(spark.read.parquet(a.input), PROFILES[a.profile]), a.seed)
    made.write.mode("errorifexists").parquet(a.output)


def census(spark: SparkSession, a: argparse.Namespace) -> None:
    out = generate.census(spark, spark.read.parquet(a.input), PROFILES[a.profile])
    print(json.dumps([r.asDict() for r in out.orderBy("tag").collect()]))  # one row per tag


def paradigms(spark: SparkSession, a: argparse.Namespace) -> None:
    good, bad = resources.read_paradigm_tsv(spark, a.input)
    good.write.mode("errorifexists").parquet(a.output)
    print(json.dumps({r.reason: r.n for r in bad.collect()}))


COMMANDS = {f.__name__: f for f in (inspect, export, split, candidates, census, paradigms)}


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="millrace")
    parser.add_argument("command", choices=COMMANDS)
    parser.add_argument("input")
    parser.add_argument("output", nargs="?")
    parser.add_argument("--profile", choices=PROFILES, default="fil")
    parser.add_argument("--format", choices=("parquet", "json"), default="parquet")
    parser.add_argument("--seed", type=int, default=20260905)
    a = parser.parse_args(arguments)
    try:
        COMMANDS[a.command](SparkSession.builder.getOrCreate(), a)
    except Refused as why:
        print(f"refused: {why}", file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main())
