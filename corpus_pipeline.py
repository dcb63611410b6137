"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again
as the next stage's docs. All but the last return the columns of documents; further columns of the table go in the first.

Defined cases, besides those of the operators: an empty table passes through every stage and gives no pieces; null texts are scored,
cleaned, mixed and packed as empty ones and in no group of near duplicates; rows without id are kept by near dedup; very long texts are
handled whole by every stage; ties follow the operators' rules.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import line_dedup, mixing, near_dedup, packing, quality_cnn
from millrace.llm.workspace import Workspace

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the byte-level network scores under 0.3. It learns from the labels of documents it is given."""
    net = quality_cnn.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_cnn.score(docs, net, keep=COLUMNS).where(F.col("score") >= 0.3).select(COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts lines found on ten sites or more out of the texts; copied documents stay whole for the next stage, and none goes."""
    cut = line_dedup.dedup_lines(docs.select(COLUMNS), spare_copies=True)
    return cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group of near duplicates (five-word shingles, similarity 0.8 or more).

    Rows without id are in no group and stay. Of rows that repeat a kept id, the one whose text is least by hash stays.
    """
    marked = near_dedup.near_duplicates(docs).where("kept").select(F.col("doc_id").alias("__id"))
    kept = Workspace(spark, "kept").save(marked.groupBy("__id").agg(F.count("*").alias("__rows")), "ids")
    several = F.col("__id").isNotNull() & (F.col("__rows") > 1)
    held = lambda ids: docs.join(ids, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi").select(COLUMNS)
    first = F.min_by(F.struct(*COLUMNS), F.struct(F.xxhash64("text"), *[F.col(c) for c in COLUMNS]))
    return held(kept.where(~several)).unionByName(held(kept.where(several)).groupBy("doc_id").agg(first.alias("row")).select("row.*"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents of small sources (up to twice, each at least once) to flatten the mixture of sources."""
    return mixing.mix(docs.select(COLUMNS)).select(COLUMNS)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids packed into sequences of 4096."""
    return packing.pack(docs, str(public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("quality classifier", quality), ("line dedup", lines), ("MinHash near-dedup", near_duplicates), ("mixing", mixture), ("packing", sequences)]

#: SQL can express neither the networks nor the differencing; the stages are tested against brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents."""
    ws, docs = Workspace(spark, "pipeline"), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = ws.save(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
