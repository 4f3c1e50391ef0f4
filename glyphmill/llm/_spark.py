"""Shared folders, written tables and connected components."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir, which all executors share.

    A local session may lack the setting: a temporary folder then becomes its
    checkpoint folder. On a cluster its absence is an error, as other machines
    could not read such a folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        base = getattr(spark, "_glyphmill_dir", None) or tempfile.mkdtemp(prefix="glyphmill-")
        spark._glyphmill_dir = base
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(base)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(where)
    return files.makeQualified(where).toString()


def keep(df: DataFrame, path: str, **options) -> DataFrame:
    """Write df as Parquet under a shared folder and read it again: lineage ends here."""
    df.write.options(**options).mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(df: DataFrame, path: str) -> DataFrame:
    """df if its rows come in the same parts whenever a task is repeated, as those of a scan do; else df written by keep()."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return keep(df, path) if any(word in plan for word in ("Exchange", "Sample", "InMemoryTableScan", "ExistingRDD", "rand(")) else df


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a shared folder, as workers open it."""
    if "://" not in uri and uri.startswith("file:"):
        uri = "file://" + uri[len("file:") :]
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


#: Keys that may be broadcast at once: 64-bit integers, so tens of megabytes at most.
BROADCAST_KEYS = 2_000_000


def match_keys(df: DataFrame, keys: DataFrame, key: str, how: str) -> DataFrame:
    """Semi or anti join by one long column. The keys are counted; few are broadcast, more are shuffled with df."""
    return df.join(F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys, key, how)


def join_lists(rows: DataFrame, lists: DataFrame, key: str, most: int, size: str = "c") -> DataFrame:
    """rows joined with lists, one row a key with the number of its rows in `size`, where a key may hold a third of all rows.

    Keys of more than `most` rows are broadcast and never dealt out by key.
    `most` is rows / BROADCAST_KEYS at least, so there are at most that many.
    """
    heavy = lists.where(F.col(size) > most)
    light = lists.where(F.col(size) <= most)
    spread = rows.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key)
    return spread.unionByName(rows.join(F.broadcast(heavy), key))


def forest(n: int, pairs: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each of n points."""
    root = np.arange(n)
    while len(pairs):
        low = np.minimum(root[pairs[:, 0]], root[pairs[:, 1]])
        before = root.copy()
        np.minimum.at(root, root[pairs[:, 0]], low)
        np.minimum.at(root, root[pairs[:, 1]], low)
        root = root[root]
        if (root == before).all():
            break
    return root


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(id, component) for every end of an edge (a, b); component is the smallest id reachable.

    Each round takes the lowest label next to a vertex, hooks the vertex that
    its old label names to the lowest one found by all that carry that label,
    and then takes the label of the label. Regions merge whole, so rounds grow
    with the logarithm of a component's length (18 to 21 for paths of a million
    vertices, simulated). Labels only fall, so it ends; it stops when none
    does, as then all ends of edges agree. Each step is checkpointed. Minima are
    combined before the shuffle, and a join on a hub's id is one that Spark
    may split.
    """
    both = edges.where("a <> b").select("a", "b").unionByName(edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().checkpoint()
    labels = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("low")).select("id", F.least("id", "low").alias("component")).checkpoint()
    before = None
    while True:
        total = labels.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]
        if total == before:
            return labels
        before = total
        near = both.join(labels, both.b == labels.id).groupBy(F.col("a").alias("near_id")).agg(F.min("component").alias("near"))
        lower = labels.join(near, labels.id == near.near_id).select("id", F.col("component").alias("old"), F.least("component", "near").alias("low")).checkpoint()
        hooks = lower.groupBy(F.col("old").alias("root")).agg(F.min("low").alias("hook"))
        hooked = lower.join(hooks, lower.id == hooks.root, "left").select("id", F.least("low", "hook").alias("component")).checkpoint()
        up = hooked.select(F.col("id").alias("up_id"), F.col("component").alias("up"))
        labels = hooked.join(up, hooked.component == up.up_id).select("id", F.least("component", "up").alias("component")).checkpoint()


def unsigned_crc32(text: Column) -> Column:
    """zlib's crc32 of a string's UTF-8 bytes as a long; that of a null is 0, as of an empty text."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


