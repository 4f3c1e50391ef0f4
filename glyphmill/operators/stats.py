"""Corpus statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glyphmill.operators.lineage import running
from glyphmill.operators.sampling import seeded_key


def corpus_stats(df: DataFrame, subset: str, length: str) -> DataFrame:
    """Rows and mean length of each subset and, with a null subset, of all."""
    return df.rollup(subset).agg(F.count(F.lit(1)).alias("samples"), F.avg(length).alias("mean_length"))


def joint_distribution(df: DataFrame, first: str, length: str, width: int) -> DataFrame:
    return df.groupBy(first, (F.floor(F.col(length) / width) * width).cast("long").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def medians(df: DataFrame, group: str, *columns: str) -> DataFrame:
    """Medians of each group, the mean of the two middle values if their number is even; nulls do not count.

    Values are counted first and their counts summed up in ranges, so no task
    holds all different values of a group.
    """
    out = None
    for c in columns:
        counted = df.where(F.col(c).isNotNull()).groupBy(F.col(group).alias("g"), F.col(c).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("n"))
        summed = running(counted, ["g"], ["v"], F.col("n"), "upto")
        totals = counted.groupBy(F.col("g").alias("h")).agg(F.sum("n").alias("total"))
        placed = summed.join(totals, F.col("g").eqNullSafe(F.col("h")))
        low, high = F.floor((F.col("total") + 1) / 2), F.floor((F.col("total") + 2) / 2)
        # the values whose places from 1 take in the one or two middle ones
        middle = placed.where((F.col("upto") >= low) & (F.col("upto") - F.col("n") < high))
        found = middle.groupBy("g").agg(((F.min("v") + F.max("v")) / 2).alias(f"median_{c}"))
        out = found if out is None else out.join(found.withColumnRenamed("g", "h"), F.col("g").eqNullSafe(F.col("h")), "full").withColumn("g", F.coalesce("g", "h")).drop("h")
    return out.withColumnRenamed("g", group)


def shares(df: DataFrame, topic: str) -> DataFrame:
    counted = df.groupBy(topic).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy()))


def histogram(df: DataFrame, value: str, low: float, high: float, buckets: int) -> DataFrame:
    return df.groupBy(F.width_bucket(F.col(value), F.lit(low), F.lit(high), F.lit(buckets)).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def sampled_scores(df: DataFrame, id: str, score: str, n: int, seed: int, low: float, high: float, buckets: int) -> DataFrame:
    """Histogram, mean and deviation of a score over n rows in seeded order: (bucket, n, mean, deviation), the last two those of all sampled rows."""
    rows = df.orderBy(seeded_key(seed, id), id).limit(n).where(F.col(score).isNotNull())
    whole = rows.agg(F.avg(score).alias("mean"), F.stddev_pop(score).alias("deviation"))
    return histogram(rows, score, low, high, buckets).join(F.broadcast(whole))


def topics(df: DataFrame, units: str, k: int = 20, vocabulary: int = 4096, iterations: int = 10, seed: int = 1):
    """LDA over unit counts: (model, rows with topicDistribution)."""
    from pyspark.ml.clustering import LDA
    from pyspark.ml.feature import CountVectorizer

    vectors = CountVectorizer(inputCol=units, outputCol="features", vocabSize=vocabulary).fit(df).transform(df)
    model = LDA(k=k, maxIter=iterations, seed=seed, featuresCol="features").fit(vectors)
    return model, model.transform(vectors)
