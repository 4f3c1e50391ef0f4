"""Near duplicates among embeddings by randomised-rotation binary codes.

Vectors are normalised, centred and rotated by a random orthogonal matrix; a
code keeps the signs, and with it the inner product of the code and the vector
that it stands for. From these an unbiased estimate of any inner product
follows, with an interval; only pairs whose interval reaches the threshold are
recomputed in double precision.

Pairs are sought in buckets: several tables, each keyed by a few signs of
another rotation of the vectors before centring, enough of them that a pair at
the threshold meets with the wanted probability whatever the mean. Large buckets are cut into blocks and compared block by
block, so no group is gathered in one task. A pair that meets in more than one
table is counted in the first only. Equal vectors are one node that counts as
many times as it occurs, so a group of copies is not compared with itself.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphmill.llm._bytes import tidied, tidied_group
from glyphmill.llm._spark import BROADCAST_KEYS, connected_components, forest, keep, shared_dir


@dataclass(frozen=True)
class EmbeddingParams:
    threshold: float = 0.9
    #: Chance that a pair at the threshold shares a bucket; closer pairs have a higher one.
    recall: float = 0.995
    #: Vectors that a bucket should hold; sets the signs in a key.
    bucket: int = 256
    #: Vectors in a block of a larger bucket.
    block: int = 1024
    #: Half width of the interval, in standard deviations of the estimate.
    sigmas: float = 4.0
    seed: int = 20240229


def rotation(dims: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def plan_tables(n: int, p: EmbeddingParams) -> tuple[int, int]:
    """(signs in a key, tables) for n vectors."""
    bits = min(24, max(1, math.ceil(math.log2(max(2.0, n / p.bucket)))))
    agree = (1 - math.acos(p.threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - p.recall) / math.log(1 - agree)))


def codes(x: np.ndarray, turn: np.ndarray, center: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(signs, rotated residual, its length, correction factor) of unit vectors x."""
    residual = (x - center) @ turn
    length = np.linalg.norm(residual, axis=1)
    unit = residual / np.maximum(length, 1e-12)[:, None]
    signs = np.where(unit >= 0, 1.0, -1.0) / math.sqrt(x.shape[1])
    factor = np.maximum(np.einsum("ij,ij->i", signs, unit), 1e-6)
    return signs, unit, length, factor


def upper_bounds(a: tuple, b: tuple, center: np.ndarray, xa: np.ndarray, xb: np.ndarray, sigmas: float) -> np.ndarray:
    """Upper confidence bound of the cosine of every pair, from b's codes and a's rotated vectors."""
    signs, _, length_b, factor = b
    _, unit, length_a, _ = a
    estimate = (unit @ signs.T) / factor[None, :]
    spread = np.sqrt(np.maximum(0.0, 1 - factor**2)) / factor / math.sqrt(max(1, signs.shape[1] - 1))
    residual = np.minimum(1.0, estimate + sigmas * spread[None, :]) * length_a[:, None] * length_b[None, :]
    # <x, y> = <x - c, y - c> + <x, c> + <y, c> - <c, c>
    return residual + (xa @ center)[:, None] + (xb @ center)[None, :] - float(center @ center)


def link_embeddings(vectors: DataFrame, params: EmbeddingParams = EmbeddingParams(), key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Two vectors link when their cosine in double precision is at least the
    threshold. A vector that is null, zero, or holds a null or a non-finite
    component links with nothing, as does one whose number of components
    differs from the most common one; each is a component of its own. Rows
    that repeat a key are counted as vectors of their own for links and share
    the key's component; a null key stays null. Equal vectors are found by two
    64-bit hashes. An empty table gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    at = shared_dir(spark, "embeddings")
    finite = F.forall(embedding, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    usable = F.col(embedding).isNotNull() & finite & F.exists(embedding, lambda v: v != 0)
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.when(F.coalesce(usable, F.lit(False)), F.col(embedding).cast("array<double>")).alias("v"))
    rows = keep(rows.withColumn("row", F.monotonically_increasing_id()), f"{at}/rows")
    sizes = rows.where("v is not null").groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if sizes is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    dims, n = sizes["d"], sizes["count"]
    p = params
    bits, tables = plan_tables(n, p)
    turns = [rotation(dims, p.seed + 1 + i) for i in range(-(-bits * tables // dims))]
    planes = np.concatenate(turns, axis=1)[:, : bits * tables]
    turn = rotation(dims, p.seed)
    every = rows.where((F.size("v") == dims) & F.col("v").isNotNull())
    hashed = every.select("row", F.xxhash64(F.lit(1), "v").alias("h1"), F.xxhash64(F.lit(2), "v").alias("h2"))
    groups = keep(hashed.groupBy("h1", "h2").agg(F.min("row").alias("rep"), F.count(F.lit(1)).alias("c")).where("c > 1"), f"{at}/groups")
    few = groups.count() <= BROADCAST_KEYS  # one group may hold a third of all rows, which a broadcast never deals out by key
    copies = keep(hashed.join(F.broadcast(groups) if few else groups, ["h1", "h2"]).select("row", "rep", "c"), f"{at}/copies")
    classed = keep(rows.select("row", "vec_id").join(copies, "row", "left").select("row", "vec_id", F.coalesce("rep", "row").alias("rep"), F.coalesce("c", F.lit(1)).cast("long").alias("c")), f"{at}/classed")
    good = keep(every.join(classed.where("row = rep").select("row", "c"), "row").select("row", "v", "c"), f"{at}/nodes")
    unit_sum = good.select(F.transform("v", lambda x: x / F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, y: a + y * y))).alias("u")).select(F.posexplode("u")).groupBy("pos").agg(F.avg("col").alias("m"))
    center = np.zeros(dims)
    for r in unit_sum.collect():  # one number a dimension
        center[r.pos] = r.m if math.isfinite(r.m) else 0.0
    shared = spark.sparkContext.broadcast((planes, center, turn))
    weights = 1 << np.arange(bits, dtype=np.int64)

    def unit(column, n_rows: int) -> np.ndarray:
        x = column.flatten().to_numpy(zero_copy_only=False).reshape(n_rows, dims).astype(np.float64)
        x = x / np.abs(x).max(axis=1, keepdims=True)  # lengths neither overflow nor vanish
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    def keys_of(x: np.ndarray) -> np.ndarray:
        signs = x @ shared.value[0] >= 0  # not centred: plan_tables counts with the angle of the cosine itself
        return signs.reshape(len(x), tables, bits) @ weights

    def spread(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            found = keys_of(unit(batch.column("v"), batch.num_rows))
            m = batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(tables, dtype=np.int32), m)), pa.array(found.reshape(-1)), pa.array(np.repeat(batch.column("row").to_numpy(), tables))], ["t", "bucket", "row"])

    keyed = keep(good.select("row", "v").mapInArrow(tidied(spread), "t int, bucket long, row long"), f"{at}/keys")
    counts = keyed.groupBy("t", "bucket").count().where("count > 1")
    placed = keyed.join(counts, ["t", "bucket"]).withColumn("blocks", F.ceil(F.col("count") / p.block).cast("int")).withColumn("own", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    # block i of a bucket meets blocks i..blocks-1: each row goes to every pair of blocks that holds its own
    pairs = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = pairs.select("t", "bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "row")
    tasks = pairs.join(good, "row")

    def compare(table: pa.Table) -> pa.Table:
        t, i, j = (table.column(c)[0].as_py() for c in ("t", "i", "j"))
        table = table.combine_chunks()
        x = unit(table.column("v").combine_chunks(), table.num_rows)
        row, own, times = (table.column(c).to_numpy() for c in ("row", "own", "c"))
        a, b = np.flatnonzero(own == i), np.flatnonzero(own == j)
        _, center, turn = shared.value
        coded = codes(x, turn, center)
        found = []
        for s in range(0, len(a), 512):
            part = a[s : s + 512]
            bound = upper_bounds(tuple(c[part] for c in coded), tuple(c[b] for c in coded), center, x[part], x[b], p.sigmas)
            q, r = np.nonzero(bound >= p.threshold)
            q, r = part[q], b[r]
            once = row[q] < row[r] if i == j else np.ones(len(q), bool)
            q, r = q[once], r[once]
            for u in range(0, len(q), 1 << 16):
                y, z = q[u : u + (1 << 16)], r[u : u + (1 << 16)]
                real = np.einsum("ij,ij->i", x[y], x[z]) >= p.threshold
                found.append(np.stack((y[real], z[real]), axis=1))
        links = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
        if t and len(links):
            seen = keys_of(x)[:, :t]
            links = np.concatenate([part[~(seen[part[:, 0]] == seen[part[:, 1]]).any(axis=1)] for part in np.array_split(links, len(links) // 100_000 + 1)])
        degree = sum(np.bincount(links[:, x], weights=times[links[:, y]], minlength=len(row)) for x, y in ((0, 1), (1, 0))).astype(np.int64)
        root = forest(len(row), links)
        used = np.flatnonzero((degree > 0))
        return pa.table({"row": row[used], "n": degree[used], "peer": row[root[used]]})

    linked = keep(tasks.groupBy("t", "bucket", "i", "j").applyInArrow(tidied_group(compare), "row long, n long, peer long"), f"{at}/links")
    degree = linked.groupBy(F.col("row").alias("rep")).agg(F.sum("n").alias("n"))
    # rows of one key belong together; the first row of equal vectors carries the component
    repeats = classed.where("vec_id is not null").groupBy("vec_id").agg(F.min("rep").alias("b"), F.max("rep").alias("last")).where("b <> last").select("vec_id", "b")
    same = classed.join(repeats, "vec_id").select(F.col("rep").alias("a"), "b").distinct()
    components = connected_components(spark, linked.select(F.col("row").alias("a"), F.col("peer").alias("b")).unionByName(same))
    lows = classed.groupBy("rep").agg(F.min("vec_id").alias("low"), F.first("c").alias("times"))
    placed = lows.join(components, lows.rep == components.id, "left").select("rep", "low", "times", F.coalesce("component", "rep").alias("component"))
    placed = keep(placed.join(degree, "rep", "left"), f"{at}/placed")
    smallest = placed.groupBy("component").agg(F.min("low").alias("component_id"))
    found = placed.join(smallest, "component").select("rep", "component_id", "times", F.coalesce("n", F.lit(0)).alias("n"))
    found = keep(found, f"{at}/found")
    several = found.where("times > 1").drop("times")
    out = classed.where("c = 1").join(found.where("times = 1").drop("times"), "rep").unionByName(classed.where("c > 1").join(F.broadcast(several) if few else several, "rep"))
    own = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", (F.col("n") + F.col("c") - 1).cast("long").alias("n_links"), own.alias("component_id"), F.coalesce(F.col("vec_id") == own, F.lit(True)).alias("kept"))


def op7_rotation_codes(spark, sf_dir: str) -> DataFrame:
    return link_embeddings(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
