"""Where rows stand in their files: line numbers of text files of any size, row numbers of Parquet files, and files whose order is that of their rows.

Nothing here reads a file as one row or sorts in one task: lines are counted by split, and a line's number is that within its split after
those of the splits before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _split_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, at, value): block is where the line's split begins in the file; at grows by one from line to line of a split."""
    held = spark.read.text(path)
    return held.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")


def _numbered(some: DataFrame, lines: DataFrame) -> DataFrame:
    """some of the lines(file, block, at, ...) with their number in the file, from 1."""
    blocks = lines.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    starts = blocks.select("file", "block", (F.coalesce(before, F.lit(0)) + 1 - F.col("first")).alias("shift"))
    return some.join(starts, ["file", "block"]).withColumn("line", F.col("at") + F.col("shift")).drop("block", "at", "shift")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value) of text files, numbered from 1 in each; empty lines count."""
    lines = _split_lines(spark, path)
    return _numbered(lines, lines).select("file", "line", "value")


def json_line_faults(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, fault) of lines that are no JSON object, numbered from 1 in each file; blank lines are passed over, but counted.

    Only faulty lines are joined with the counts of the splits; sound ones are read and forgotten.
    """
    lines = _split_lines(spark, path)
    value = F.trim("value")
    fault = F.when(value.startswith("{"), F.when(F.try_parse_json(value).isNull(), "invalid JSON")).otherwise("not an object")
    bad = lines.withColumn("fault", F.when(value != "", fault)).where("fault is not null").drop("value")
    return _numbered(bad, lines).select("file", "line", "fault")


def positioned(df: DataFrame) -> DataFrame:
    """A DataFrame just read from Parquet, with file and row: the path of each row's file and its number there, from 0."""
    return df.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def write_ordered(df: DataFrame, target: str, order: list, *, files: int | None = None) -> None:
    """df as new Parquet files that hold it in order: by name, each file's rows come before the next one's, and inside a file they are sorted.

    Ranges are dealt out, then sorted where they are; order should tell rows apart, as equal ones share a file.
    """
    dealt = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    dealt.sortWithinPartitions(*order).write.mode("errorifexists").parquet(target)


def read_ordered(spark: SparkSession, target: str) -> DataFrame:
    """What ``write_ordered`` wrote, with position: each row's number over all files, from 0. Only one row per file is sorted for it."""
    held = positioned(spark.read.parquet(target))
    sizes = held.groupBy("file").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))  # as many rows as files
    starts = sizes.select("file", F.coalesce(before, F.lit(0)).alias("before"))
    return held.join(F.broadcast(starts), "file").withColumn("position", F.col("row") + F.col("before")).drop("file", "row", "before")


def order_faults(spark: SparkSession, target: str, key: str) -> DataFrame:
    """(file, row) of rows of an ordered table whose key is less than that of the row before, in the file or at the end of the file before."""
    held = positioned(spark.read.parquet(target)).select("file", "row", key)
    inside = held.withColumn("before", F.lag(key).over(Window.partitionBy("file").orderBy("row"))).where(F.col("before") > F.col(key)).select("file", "row")
    ends = held.groupBy("file").agg(F.min(key).alias("low"), F.max(key).alias("high"))
    between = ends.withColumn("before", F.max("high").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))).where("before > low")
    return inside.unionByName(between.select("file", F.lit(0).cast("long").alias("row")))
