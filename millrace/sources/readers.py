"""Readers and writers: SQLite tables, JSON lines with line numbers, predictions with a header, shards, create-new sinks."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from millrace.sources.positions import json_line_faults
from millrace.sources.publish import POINTER, Place, create_json, manifest_of, publish_folder, published_path
from millrace.sources.resources import publish

_TYPES = {"INT": "long", "REAL": "double", "FLOA": "double", "DOUB": "double", "BOOL": "boolean"}


def _connect(path: str) -> sqlite3.Connection:
    """A connection that cannot write."""
    connection = sqlite3.connect(f"file:{path}?mode=ro", uri=True)
    connection.execute("PRAGMA query_only = ON")
    if connection.execute("PRAGMA query_only").fetchone()[0] != 1:
        raise RuntimeError("the database could be written to")
    return connection


def quote(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


class _Range(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class SqliteSource(DataSource):
    """``spark.read.format("sqlite_table").option("path", ...).option("table", ...)``: a table by ranges of rowid, read in parallel."""

    @classmethod
    def name(cls) -> str:
        return "sqlite_table"

    def schema(self) -> str:
        with _connect(self.options["path"]) as c:
            rows = c.execute(f"PRAGMA table_info({quote(self.options['table'])})").fetchall()
        return ", ".join(f"`{r[1]}` {_TYPES.get((r[2] or '').upper()[:4], 'string')}" for r in rows)

    def reader(self, schema: StructType) -> DataSourceReader:
        return _SqliteReader(self.options, schema)


class _SqliteReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.options, self.declared = dict(options), schema

    def partitions(self) -> list[InputPartition]:
        with _connect(self.options["path"]) as c:
            low, high = c.execute(f"SELECT min(rowid), max(rowid) FROM {quote(self.options['table'])}").fetchone()
        if low is None:
            return [_Range(0, 0)]
        n = int(self.options.get("numpartitions", 4))
        step = -(-(high - low + 1) // n)
        return [_Range(a, min(a + step, high + 1)) for a in range(low, high + 1, step)]

    def read(self, partition: _Range) -> Iterator[tuple]:
        casts = {"long": int, "double": float, "boolean": bool, "string": str}
        kinds = [casts[f.dataType.typeName()] for f in self.declared.fields]
        columns = ", ".join(quote(f.name) for f in self.declared.fields)
        with _connect(self.options["path"]) as c:
            for row in c.execute(f"SELECT {columns} FROM {quote(self.options['table'])} WHERE rowid >= ? AND rowid < ? ORDER BY rowid", (partition.low, partition.high)):
                yield tuple(None if v is None else k(v) for k, v in zip(kinds, row, strict=True))


def read_sqlite(spark: SparkSession, path: str, table: str) -> DataFrame:
    spark.dataSource.register(SqliteSource)
    return spark.read.format("sqlite_table").option("path", path).option("table", table).load()


def catalogue(path: str) -> list[dict]:
    """Tables and views of a SQLite database with their columns, indexes and rows."""
    with _connect(path) as c:
        out = []
        for kind, name in c.execute("SELECT type, name FROM sqlite_master WHERE type IN ('table', 'view') AND name NOT LIKE 'sqlite_%' ORDER BY name").fetchall():
            columns = [{"name": r[1], "type": r[2], "required": bool(r[3]), "key": bool(r[5])} for r in c.execute(f"PRAGMA table_info({quote(name)})")]
            indexes = [r[1] for r in c.execute(f"PRAGMA index_list({quote(name)})")]
            out.append({"kind": kind, "name": name, "columns": columns, "indexes": indexes, "rows": c.execute(f"SELECT count(*) FROM {quote(name)}").fetchone()[0]})
    return out


# What is known of a sentence, by the table it comes from, and what of it is metadata.
SENTENCE_COLUMNS = "sentence_id article_id source_id sentence_text normalized_text language language_confidence token_count quality_score is_quote is_headline content_hash is_duplicate duplicate_group_id".split()
ARTICLE_COLUMNS = {"url": "article_url", "canonical_url": "canonical_url", "publication_date": "publication_date", "headline": "headline"}
SOURCE_COLUMNS = {"name": "source_name", "domain": "source_domain"}
METADATA = "sentence_id article_id source_id sentence_text language language_confidence token_count quality_score is_quote is_headline content_hash is_duplicate duplicate_group_id article_url canonical_url publication_date headline source_name source_domain".split()
# End of fixed values.


def sentence_rows(sentences: DataFrame, articles: DataFrame, sources: DataFrame) -> DataFrame:
    """Sentences with all that is known of them, their article and their source (20 columns, and ``sqlite_rowid`` where sentences have it); neither of the two has to exist.

    No order: sinks that need one sort (``positions.write_ordered``).
    """
    a = articles.select("article_id", *[F.col(c).alias(to) for c, to in ARTICLE_COLUMNS.items()])
    s = sources.select("source_id", *[F.col(c).alias(to) for c, to in SOURCE_COLUMNS.items()])
    row = [c for c in ("sqlite_rowid",) if c in sentences.columns]
    joined = sentences.select(*row, *SENTENCE_COLUMNS).join(a, "article_id", "left").join(s, "source_id", "left")
    return joined.select(*row, *SENTENCE_COLUMNS, *ARTICLE_COLUMNS.values(), *SOURCE_COLUMNS.values())


def metadata_json(columns: list[str] = METADATA) -> Column:
    """The columns as one JSON object with sorted keys, nulls written out, letters of all scripts as they are, and a space after each comma and colon.

    Numbers and strings are written by Spark's own JSON: control characters have capital hex digits, very large and very small numbers an exponent.
    """
    value = lambda c: F.coalesce(F.regexp_replace(F.to_json(F.array(F.col(c)), {"ignoreNullFields": "false"}), "(?s)^\\[(.*)\\]$", "$1"), F.lit("null"))
    return F.concat(F.lit("{"), F.concat_ws(", ", *[F.concat(F.lit(f'"{c}": '), value(c)) for c in sorted(columns)]), F.lit("}"))


def staged(rows: DataFrame) -> DataFrame:
    """What the gate works on: clean_id, raw_text, publisher (name, or else domain), source_doc_id, published_at, url_hash (of the canonical URL, or else the article's) and metadata_json."""
    blank = lambda c: F.when(F.col(c) != "", F.col(c))
    url = F.coalesce(blank("canonical_url"), blank("article_url"))
    return rows.select(F.col("sentence_id").alias("clean_id"), F.col("sentence_text").alias("raw_text"), F.coalesce(blank("source_name"), F.col("source_domain")).alias("publisher"), F.col("article_id").alias("source_doc_id"), F.col("publication_date").alias("published_at"), F.sha2(url, 256).alias("url_hash"), metadata_json().alias("metadata_json"))


def sentence_scan(sentences: DataFrame, articles: DataFrame, sources: DataFrame) -> DataFrame:
    """Sentences with what is known of their article and publisher; neither has to exist."""
    joined = sentences.join(articles.withColumnsRenamed({"source_id": "article_source_id"}), "article_id", "left").join(sources, "source_id", "left")
    blank = lambda c: F.when(F.col(c) != "", F.col(c))
    url = F.coalesce(blank("canonical_url"), F.col("url"))
    return joined.select(
        F.col("sentence_id").alias("clean_id"),
        F.col("sentence_text").alias("raw_text"),
        F.coalesce(blank("name"), F.col("domain")).alias("publisher"),
        F.col("article_id").alias("source_doc_id"),
        F.col("publication_date").alias("published_at"),
        F.sha2(url, 256).alias("url_hash"),
        F.col("language"),
        F.col("language_confidence"),
        F.col("is_duplicate").cast("boolean").alias("is_duplicate"),
    )


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines of a schema; the first malformed one fails the read, with its text."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_predictions(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(predictions, metadata lines) of a JSON lines file that may begin with a ``_metadata`` object."""
    lines = spark.read.text(path).where("trim(value) <> ''")
    is_meta = F.get_json_object("value", "$._metadata").isNotNull()
    return lines.where(~is_meta).select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*"), lines.where(is_meta).select(F.get_json_object("value", "$._metadata").alias("metadata"))


# The columns of external sets that hold ids and texts.
ID_COLUMNS = ["clean_id", "source_clean_id", "base_clean_id"]
TEXT_COLUMNS = ["source_text", "target_text", "text", "raw", "normalized", "source", "target", "nonstandard", "standardized", "raw_informal", "gold_normalized_errorful"]
# End of fixed values.
EXTERNAL_KINDS = ("json", "jsonl", "parquet")


def external_keys(df: DataFrame, id_columns: list[str], text_columns: list[str]) -> DataFrame:
    """(kind, value) of every id and text of an external set, whichever of its possible columns it has; empty and null ones aside."""
    pairs = [F.struct(F.lit(k).alias("kind"), F.col(c).cast("string").alias("value")) for k, cs in (("id", id_columns), ("text", text_columns)) for c in cs if c in df.columns]
    if not pairs:
        return df.sparkSession.createDataFrame([], "kind string, value string")
    return df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").where("value <> ''").distinct()


def external_scan(spark: SparkSession, path: str, id_columns: list[str] | None = None, text_columns: list[str] | None = None) -> DataFrame:
    """(kind, value) of the ids and texts of all JSON, JSON lines and Parquet files below path, each with whichever of the columns it holds.

    Each format is read once, by Spark, through all folders below. JSON files may hold an array of records, one record, or an object whose ``rows`` are
    the records; JSON lines hold one record a line, and lines that are no object are passed over. The columns of Parquet files are united by name; those that none has are
    passed over. A path without any such file raises, as a scan of nothing proves nothing.
    """
    ids, texts = id_columns or ID_COLUMNS, text_columns or TEXT_COLUMNS
    record = ", ".join(f"`{c}` string" for c in [*ids, *texts])
    deep = {"recursiveFileLookup": "true"}
    found = []

    def present(kind: str) -> bool:
        return not spark.read.format("binaryFile").options(pathGlobFilter=f"*.{kind}", **deep).load(path).select("path").limit(1).isEmpty()

    kinds = [k for k in EXTERNAL_KINDS if present(k)]
    if not kinds:
        raise FileNotFoundError(f"{path} has no JSON, JSON lines or Parquet files")
    if "jsonl" in kinds:
        lines = spark.read.options(pathGlobFilter="*.jsonl", **deep).text(path).where("trim(value) like '{%'")
        found.append(lines.select(F.from_json("value", record).alias("r")).select("r.*"))
    if "json" in kinds:
        held = spark.read.options(pathGlobFilter="*.json", multiLine="true", **deep).schema(f"{record}, rows array<struct<{record.replace(' string', ':string')}>>").json(path)
        one = F.array(F.struct(*[c for c in [*ids, *texts]]))
        found.append(held.select(F.explode(F.when(F.col("rows").isNotNull(), F.col("rows")).otherwise(one)).alias("r")).select("r.*"))
    if "parquet" in kinds:
        found.append(spark.read.options(pathGlobFilter="*.parquet", mergeSchema="true", **deep).parquet(path))
    keys = [external_keys(df, ids, texts) for df in found]
    out = keys[0]
    for more in keys[1:]:
        out = out.unionByName(more)
    return out.distinct()


class Blocked(Exception):
    """An export that may not happen; ``report`` says why, and was published beside the target."""

    def __init__(self, report: dict):
        super().__init__(report["reason"])
        self.report = report


def blocked(spark: SparkSession, target: str, reason: str, **facts: object) -> Blocked:
    """A failure with its report, published as a new file ``<target>.blocked.json`` (an earlier one is kept)."""
    report = {"status": "blocked", "reason": reason, **facts}
    if not Place(spark, f"{target}.blocked.json").exists():
        create_json(spark, f"{target}.blocked.json", report)
    return Blocked(report)


def integrity(rows: DataFrame, text: str = "text") -> dict:
    """Rows, distinct texts, repeated ones and missing ones, by the texts' hashes alone."""
    held = rows.select(F.sha2(text, 256).alias("h")).groupBy("h").agg(F.count("*").alias("n"))
    many = F.col("h").isNotNull() & (F.col("n") > 1)
    told = held.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("h").alias("unique_texts"), F.count_if(many).alias("repeated_texts"), F.coalesce(F.sum(F.when(F.col("h").isNull(), F.col("n"))), F.lit(0)).alias("missing_texts"))
    return told.first().asDict()


def export_gate(annotated: DataFrame, target: str, *, text: str = "text", kind: str = "parquet", run: dict | None = None) -> dict:
    """Publishes base, validated and quarantined rows of annotated (with reason_codes), in Parquet (zstd) or JSON lines, on any file system.

    Uniqueness of texts is checked first, over their hashes: repeated or missing texts block the export before a row is written. Rows are then computed once, into one
    folder partitioned by outcome that is published when all of it is there; ``base`` is the two partitions read together. If what was
    written is not as many rows as were checked, nothing is published. Returns the manifest: integrity, outcomes, reasons and what ``run`` says (configuration, versions).
    """
    spark = annotated.sparkSession
    if Place(spark, target).below(POINTER).exists():
        raise FileExistsError(f"{target} is published")
    facts = integrity(annotated, text)
    if facts["rows"] != facts["unique_texts"]:
        raise blocked(spark, target, "texts are missing" if facts["missing_texts"] else "texts are not unique", **facts)
    codes = F.col("reason_codes")
    outcome = F.when(F.size(codes) == 0, "validated").otherwise("quarantined")
    flat = annotated.withColumns({"outcome": outcome, "reason_codes": F.concat_ws(",", codes)}) if kind == "json" else annotated.withColumn("outcome", outcome)

    def write(path: str) -> dict:
        writer = flat.write.mode("errorifexists").partitionBy("outcome")
        (writer.option("compression", "zstd").parquet if kind == "parquet" else writer.json)(path)
        written = spark.read.schema(flat.schema).format(kind).load(path)
        counts = {r.outcome: r.n for r in written.groupBy("outcome").agg(F.count("*").alias("n")).collect()}
        if sum(counts.values()) != facts["rows"]:
            raise RuntimeError(f"{sum(counts.values())} rows were written of {facts['rows']} that were checked")
        said = F.split("reason_codes", ",") if kind == "json" else F.col("reason_codes")
        reasons = {r.reason: r.n for r in written.where("outcome = 'quarantined'").select(F.explode(said).alias("reason")).groupBy("reason").agg(F.count("*").alias("n")).collect()}
        return facts | {"validated": counts.get("validated", 0), "quarantined": counts.get("quarantined", 0), "reasons": dict(sorted(reasons.items())), "format": kind, "schema": annotated.schema.simpleString(), "run": run or {}}

    return publish_folder(spark, target, write)


def read_export(spark: SparkSession, target: str, part: str = "base", *, kind: str | None = None) -> DataFrame:
    """base, validated or quarantined rows of an export."""
    manifest = manifest_of(spark, target)
    rows = spark.read.format(kind or manifest["format"]).load(published_path(spark, target))
    return rows.drop("outcome", "reason_codes") if part == "base" else rows.where(F.col("outcome") == part).drop(*(["outcome", "reason_codes"] if part == "validated" else ["outcome"]))


def write_views(final: DataFrame, target: str) -> dict:
    """Publishes final partitioned by split and stage, with its rows by both; empty input is refused."""
    if final.isEmpty():
        raise ValueError("an empty dataset is not written")

    def write(path: str) -> dict:
        final.write.mode("errorifexists").partitionBy("split", "stage").option("compression", "zstd").parquet(path)
        counts = final.sparkSession.read.parquet(path).groupBy("split", "stage").agg(F.count("*").alias("n")).orderBy("split", "stage").collect()
        return {"rows": [r.asDict() for r in counts]}

    return publish_folder(final.sparkSession, target, write)


def read_views(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(published_path(spark, target))


__all__ = ["Blocked", "SqliteSource", "blocked", "catalogue", "export_gate", "external_keys", "external_scan", "integrity", "json_line_faults", "metadata_json", "publish", "read_export", "read_json_lines", "read_predictions", "read_sqlite", "read_views", "sentence_rows", "sentence_scan", "staged", "write_views"]
