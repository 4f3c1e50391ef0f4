"""Streaming forms (an extension: the row-wise rules on unbounded input)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.functions import predicates
from glyphmill.functions import text as T


def read_texts(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema("id long, text string, at timestamp").json(folder)


def valid_texts(stream: DataFrame, rules: predicates.UnitRules = predicates.UnitRules(), delay: str = "1 hour") -> DataFrame:
    """Valid texts, copies inside the watermark dropped."""
    rows = stream.where(predicates.valid_long_text(F.col("text"), rules))
    return rows.withColumn("key", F.sha2(T.normalize_text(F.col("text"), False), 256)).withWatermark("at", delay).dropDuplicatesWithinWatermark(["key"])


def counts(stream: DataFrame, window: str = "10 minutes", delay: str = "1 hour") -> DataFrame:
    return stream.withWatermark("at", delay).groupBy(F.window("at", window)).agg(F.count(F.lit(1)).alias("n"))
