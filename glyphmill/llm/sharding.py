"""Sharding by jump consistent hashing (native).

A key's 64-bit state steps through a linear congruential generator; each step
gives the next shard count at which the key would jump. The last jump below
the number of shards is the key's shard, so no ring table is kept and adding
one shard moves only the keys that jump to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphmill.llm._spark import unsigned_crc32

#: Jump steps tried at most. A key needs about ln(shards) + 1 of them; more than
#: this many is an error, never a wrong shard.
MAX_STEPS = 128
#: Rows that one numbering task may hold on average.
ROWS_PER_BIN = 250_000


def _next_state(state: Column) -> Column:
    """state * 2862933555777941757 + 1 modulo 2**64, in 32-bit halves so that ANSI arithmetic never overflows."""
    high, low = 2862933555777941757 >> 32, 2862933555777941757 & 0xFFFFFFFF
    mask16, mask32 = F.lit(0xFFFF), F.lit(0xFFFFFFFF)
    x_low, x_high = state.bitwiseAND(mask32), F.shiftrightunsigned(state, 32)
    # x_low * low in four 16-bit products, as the full product needs 64 unsigned bits
    a, b = x_low.bitwiseAND(mask16), F.shiftrightunsigned(x_low, 16)
    c, d = F.lit(low & 0xFFFF), F.lit(low >> 16)
    first = a * c + F.lit(1)
    middle = a * d + b * c + F.shiftrightunsigned(first, 16)
    low_word = F.shiftleft(middle.bitwiseAND(mask16), 16).bitwiseOR(first.bitwiseAND(mask16))
    carry = b * d + F.shiftrightunsigned(middle, 16)

    def cross(x: Column, y: int) -> Column:  # x * y modulo 2**32
        return (x.bitwiseAND(mask16) * F.lit(y) + F.shiftleft((F.shiftrightunsigned(x, 16) * F.lit(y & 0xFFFF)).bitwiseAND(mask16), 16)).bitwiseAND(mask32)

    high_word = (carry + cross(x_low, high) + cross(x_high, low)).bitwiseAND(mask32)
    return F.shiftleft(high_word, 32).bitwiseOR(low_word)


def jump_hash(key: Column, shards: int) -> Column:
    """The shard, 0 to shards - 1, of a long key. A null key has shard 0."""
    if shards < 1:
        raise ValueError("shards must be positive")
    zero = F.struct(F.coalesce(key, F.lit(0)).cast("long").alias("state"), F.lit(-1).cast("long").alias("at"), F.lit(0).cast("long").alias("next"))

    def step(acc: Column, _: Column) -> Column:
        state = _next_state(acc["state"])
        share = (F.shiftrightunsigned(state, 33) + F.lit(1)).cast("double")
        jump = F.floor((acc["next"] + F.lit(1)).cast("double") * (F.lit(float(1 << 31)) / share)).cast("long")
        done = acc["next"] >= F.lit(shards)
        return F.struct(
            F.when(done, acc["state"]).otherwise(state).alias("state"),
            F.when(done, acc["at"]).otherwise(acc["next"]).alias("at"),
            F.when(done, acc["next"]).otherwise(jump).alias("next"),
        )

    def finish(acc: Column) -> Column:
        return F.when(acc["next"] >= F.lit(shards), acc["at"]).otherwise(F.raise_error(F.lit("jump_hash: more steps than MAX_STEPS"))).cast("int")

    steps = F.sequence(F.lit(1), F.lit(min(shards, MAX_STEPS)))
    return F.aggregate(steps, zero, step, finish)


def shard_documents(docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Assign each row a shard by its key and a gapless slot inside the shard.

    The key is hashed with xxhash64 first, so sequential ids spread. Slots are
    counted from 0 in the order of (bin, key, size, crc): a shard is cut into
    bins by another hash of the key, so that no task numbers a whole shard,
    and the bins' counts give the offsets. Null text counts as no bytes (size
    1, crc 0); a null key is hashed like any value; repeated rows get slots of
    their own; an empty table gives no rows; other columns are ignored.
    """
    keyed = F.xxhash64(F.col(key))
    rows = docs.select(
        F.col(key),
        (F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + F.lit(1)).alias("size"),
        unsigned_crc32(F.col(text)).alias("text_crc32"),
        jump_hash(keyed, shards).alias("shard"),
        jump_hash(keyed, shards + 1).alias("grown_shard"),
    )
    bins = max(1, -(-docs.count() // (shards * ROWS_PER_BIN)))
    rows = rows.withColumn("bin", F.pmod(F.xxhash64(F.lit(1), F.col(key)), F.lit(bins)).cast("int"))
    per_bin = rows.groupBy("shard", "bin").count()
    from pyspark.sql import Window as W

    before = W.partitionBy("shard").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_bin.select(F.col("shard").alias("o_shard"), F.col("bin").alias("o_bin"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(W.partitionBy("shard", "bin").orderBy(key, "size", "text_crc32")) - 1
    numbered = rows.withColumn("rank", inside)
    return numbered.join(offsets, (F.col("shard") == F.col("o_shard")) & (F.col("bin") == F.col("o_bin"))).select(
        F.col(key), "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("rank") + F.col("offset")).cast("long").alias("slot"), "grown_shard"
    )


def op5_jump_shards(spark, sf_dir: str) -> DataFrame:
    return shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
