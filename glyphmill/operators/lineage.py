"""Cutting lineage through the cluster's shared checkpoint folder, and running totals."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def scratch(spark: SparkSession, name: str = "cut") -> str:
    """The path of a new folder below spark.checkpoint.dir.

    A local session may lack that setting and gets a temporary folder; on a
    cluster its absence is an error, as other machines could not read one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or getattr(spark, "_glyphmill_dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        base = spark._glyphmill_dir = tempfile.mkdtemp(prefix="glyphmill-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame) -> DataFrame:
    """df written as Parquet below the shared folder and read again: computed once, and safe from lost executors."""
    spark, path = df.sparkSession, scratch(df.sparkSession)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """df dealt out evenly where it has fewer parts than the cluster has cores, as a scan of few row groups; else df itself."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df


def running(df: DataFrame, group: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """df with the sum of `value` up to each row, inside its group and in order.

    Rows are summed up inside ranges of (group, order); the ranges' totals,
    one row a range and group, give the offsets. So no task holds a group.
    """
    by = [*group, *order]
    parts = cut(df.withColumn("_value", value).repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_part", F.spark_partition_id()))
    totals = parts.groupBy("_part", *group).agg(F.sum("_value").alias("_total"))
    before = W.partitionBy(*group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(F.col("_part").alias("_at"), *[F.col(g).alias(f"_of_{g}") for g in group], F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    inside = F.sum("_value").over(W.partitionBy("_part", *group).orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    same = F.col("_part") == F.col("_at")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    joined = parts.withColumn("_inside", inside).join(offsets, same)
    return joined.select(*df.columns, (F.col("_inside") + F.col("_before")).alias(name))


def numbered(df: DataFrame, *order: str) -> DataFrame:
    """Rows with `ord`, their place from 0 in an order."""
    return running(df, [], list(order), F.lit(1).cast("long"), "ord").withColumn("ord", (F.col("ord") - 1).cast("long"))
