"""The quality gate and the generators over streams. Both are stateless, so they run unchanged.

Uniqueness over a stream needs a bound on how late a repetition may come: that is the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.profile import QualityRules
from millrace.functions.text import collapse
from millrace.operators import quality


def read_sentences(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def gate(stream: DataFrame, rules: QualityRules) -> DataFrame:
    """stream(text, language, language_confidence, is_duplicate) with reason_codes."""
    return quality.with_reasons(stream.withColumn("text", collapse(F.col("text"))), rules)


def unique(stream: DataFrame, time: str, delay: str = "1 hour") -> DataFrame:
    """The first of equal texts within the watermark."""
    return stream.withColumn("text_hash", F.sha2("text", 256)).withWatermark(time, delay).dropDuplicatesWithinWatermark(["text_hash"])


def write(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    return stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
