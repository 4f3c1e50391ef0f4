"""Quality classifier: logistic regression on hashed word n-grams, fitted by FTRL-proximal.

Features are n-grams of two views of a text's words: the words themselves and
their shapes (which classes of characters they hold, how they end, how long
they are, whether they repeat the word before). Each n-gram is hashed to a
weight; a text's score is the sparse dot product of its n-gram counts, divided
by the square root of their number, with the weights.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphmill.llm._bytes import grams, hash_words, mix, repeat_index, slices, split_words, tidied, utf8


@dataclass(frozen=True)
class QualityParams:
    #: Labelled rows used for fitting, at most: those with the smallest hash of the key.
    max_train: int = 4_000
    epochs: int = 2
    #: log2 of the number of weights.
    weight_bits: int = 18
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1
    threshold: float = 0.3


_CLASS = np.zeros(256, np.uint8)
_CLASS[65:91] = 1
_CLASS[97:123] = 2
_CLASS[128:] = 2
_CLASS[48:58] = 4
_CLASS[[ord(c) for c in ".,;:?'\"-()"]] = 8
_CLASS[[c for c in range(33, 127) if _CLASS[c] == 0]] = 16
_CLASS[ord("!")] = 32
_CLASS[:32] = 64

#: (view, n) of each family of features.
FAMILIES = (("word", 1), ("word", 2), ("shape", 1), ("shape", 2), ("shape", 3))


def word_shapes(data: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A small code for each word: classes held, classes at both ends, length and whether it repeats its predecessor."""
    if not len(start):
        return np.zeros(0, np.uint64)
    classes = _CLASS[data]
    held = np.bitwise_or.reduceat(classes, start)  # separators up to the next word belong to class 0 or 64
    held &= np.uint8(63)
    size = end - start
    length = np.searchsorted([2, 4, 8, 16, 32], size, side="right").astype(np.uint64)
    again = np.zeros(len(h), np.uint64)
    again[1:] = h[1:] == h[:-1]
    heads = first[:-1][first[:-1] < len(h)]
    again[heads] = 0
    return held.astype(np.uint64) | classes[start].astype(np.uint64) << np.uint64(8) | classes[end - 1].astype(np.uint64) << np.uint64(16) | length << np.uint64(24) | again << np.uint64(28)


def hashed_features(data: np.ndarray, offsets: np.ndarray, bits: int):
    """For each family: (weight index of every n-gram, its text). N-grams never cross texts."""
    start, end, first = split_words(data, offsets)
    h = hash_words(data, start, end)
    text = repeat_index(first)
    views = {"word": h, "shape": mix(word_shapes(data, start, end, first, h))}
    for seed, (view, n) in enumerate(FAMILIES, 1):
        codes = grams(views[view], n, seed)
        same = text[: len(codes)] == text[n - 1 :] if len(codes) else np.zeros(0, bool)
        yield (codes[same] >> np.uint64(64 - bits)).astype(np.int64), text[: len(codes)][same]


def fit_ftrl(rows, params: QualityParams) -> tuple[np.ndarray, float]:
    """Weights and bias from (weight indices, counts, label) rows, taken in the given order, `epochs` times."""
    size = 1 << params.weight_bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)  # the last weight is the bias

    def weight(zi, ni):
        return np.where(np.abs(zi) <= params.l1, 0.0, -(zi - np.sign(zi) * params.l1) / ((params.beta + np.sqrt(ni)) / params.alpha + params.l2))

    for _ in range(params.epochs):
        for index, value, label in rows:
            index, value = np.append(index, size), np.append(value, 1.0)
            zi, ni = z[index], n[index]
            wi = weight(zi, ni)
            g = (1.0 / (1.0 + np.exp(-np.clip(wi @ value, -35, 35))) - label) * value
            z[index], n[index] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / params.alpha * wi, ni + g * g
    w = weight(z, n)
    return w[:-1].astype(np.float32), float(w[-1])


def _held_out(key: str):
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train_quality(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams(), key: str = "doc_id", text: str = "text", label: str = "quality") -> tuple[np.ndarray, float]:
    """Fit on at most `max_train` labelled rows that are not held out.

    Their keys are a bounded broadcast; the fit runs in one task over that
    bounded sample. Null labels, keys and texts are left out; of repeated
    labels of a key the smallest counts, and of repeated rows of a document
    that with the smallest text; long texts are taken whole. Without any row, as of empty tables, all
    weights are 0 and the bias too.
    """
    bits = params.weight_bits
    order = F.xxhash64(F.lit(29), F.col(key))
    chosen = labels.where(~_held_out(key) & F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key)).agg(F.min(label).alias("label")).orderBy(order, key).limit(params.max_train)
    sample = docs.select(F.col(key).alias("key"), F.col(text).alias("t")).where("t is not null").join(F.broadcast(chosen.select(F.col(key).alias("key"), F.col("label").cast("double"))), "key")
    sample = sample.groupBy("key", "label").agg(F.min("t").alias("t"))  # a repeated row counts once, so max_train bounds rows

    def extract(batches):
        for batch in batches:
            for part in slices(batch, "t"):
                found = list(hashed_features(*utf8(part.column("t")), bits))
                index, owner = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
                pair, count = np.unique(owner * (1 << bits) + index, return_counts=True)
                owner, index = pair >> bits, pair & ((1 << bits) - 1)
                cuts = np.searchsorted(owner, np.arange(part.num_rows + 1))
                total = np.maximum(1, np.add.reduceat(np.append(count, 0), cuts[:-1]) * (np.diff(cuts) > 0))
                value = (count / np.sqrt(total[owner])).astype(np.float32)
                lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(index, pa.int32()))
                values = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(value))
                yield pa.RecordBatch.from_arrays([part.column("key").cast(pa.string()), part.column("label"), lists, values], ["key", "label", "index", "value"])

    rows = sample.mapInArrow(tidied(extract), "key string, label double, index array<int>, value array<float>")

    def fit(table: pa.Table) -> pa.Table:
        order = np.argsort(np.array(table.column("order").to_pylist()), kind="stable")
        index, value = ([row.values.to_numpy() for row in table.column(c)] for c in ("index", "value"))
        label = table.column("label").to_numpy()
        weights, b = fit_ftrl([(index[i], value[i], label[i]) for i in order], params)
        return pa.table({"weights": pa.array([weights.tobytes()], pa.binary()), "bias": [b]})

    fitted = rows.withColumn("order", F.md5("key")).withColumn("one", F.lit(0)).groupBy("one").applyInArrow(fit, "weights binary, bias double").collect()
    return (np.frombuffer(fitted[0].weights, np.float32), fitted[0].bias) if fitted else (np.zeros(1 << bits, np.float32), 0.0)


def score_texts(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray, bias: float, bits: int) -> np.ndarray:
    texts = len(offsets) - 1
    dot, total = np.zeros(texts), np.zeros(texts)
    for index, owner in hashed_features(data, offsets, bits):
        dot += np.bincount(owner, weights=weights[index], minlength=texts)
        total += np.bincount(owner, minlength=texts)
    return 1.0 / (1.0 + np.exp(-np.clip(dot / np.sqrt(np.maximum(1, total)) + bias, -35, 35)))


def score_quality(docs: DataFrame, model: tuple[np.ndarray, float], params: QualityParams = QualityParams(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, score, predicted) for every row.

    Only the text enters the score. A null or empty text, or one without
    words, has the score of the bias alone; ties and repeated rows are scored
    alike; a null key counts as held out; long texts are scored whole; an
    empty table gives no rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**weight_bits floats
    bits = params.weight_bits

    def score(batches):
        weights, bias = shared.value
        for batch in batches:
            for part in slices(batch, "t"):
                p = score_texts(*utf8(part.column("t")), weights, bias, bits)
                yield pa.RecordBatch.from_arrays([part.column("k"), part.column("held_out"), pa.array(p), pa.array((p >= params.threshold).astype(np.int32))], ["k", "held_out", "score", "predicted"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("k"), _held_out(key).alias("held_out"), F.col(text).alias("t"))
    return rows.mapInArrow(tidied(score), f"k {kind}, held_out boolean, score double, predicted int").withColumnRenamed("k", key)


def keep_good(docs: DataFrame, model: tuple[np.ndarray, float], params: QualityParams = QualityParams(), text: str = "text") -> DataFrame:
    """The rows whose text's score reaches the threshold, with all their columns.

    A null or empty text is judged by the bias alone; repeated rows stay or go
    together; an empty table stays empty; long texts are scored whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def good(batches):
        weights, bias = shared.value
        for batch in batches:
            for part in slices(batch, text):
                p = score_texts(*utf8(part.column(text)), weights, bias, params.weight_bits)
                yield part.filter(pa.array(p >= params.threshold))

    return docs.mapInArrow(tidied(good), docs.schema)


def op10_quality_ftrl(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_quality(docs, train_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
