"""Language identification by bit-sliced Bloom filters of n-grams.

One table serves all languages: slot s holds a mask with a bit for each
language, and a look-up ANDs the slots of an n-gram's hashes, so it returns
every language that holds the n-gram at once. A text's count for a language is
the popcount of that bit over the text's n-grams, corrected by the false
positives that the language's share of set bits leads one to expect.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glyphmill.llm._bytes import mix, slices, tidied, utf8
from glyphmill.llm._spark import keep, shared_dir

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[9, 10, 11, 12, 13]] = 32
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


@dataclass(frozen=True)
class LanguageParams:
    #: Sampled texts of each language from which its n-grams are learnt (expected number; a hash of the key decides).
    docs_per_lang: int = 2000
    #: n-grams kept for each language, the most frequent ones; None keeps all that the sample has.
    grams_per_lang: int | None = None
    #: A language holds an n-gram if its rate there is at least this share of the highest rate of any language.
    min_share: float = 0.25
    #: An n-gram needs this many occurrences in a language's sample.
    min_count: int = 3
    #: log2 of the slots of the filter, and the slots looked up for an n-gram.
    slot_bits: int = 20
    hashes: int = 2


def _padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The folded bytes with a space before and after each text, and where each text's part begins."""
    n, texts = len(data), len(offsets) - 1
    out = np.full(n + 2 * texts, 32, np.uint8)
    at = offsets[:-1] + 2 * np.arange(texts)
    out[np.arange(n) + np.repeat(2 * np.arange(texts) + 1, np.diff(offsets))] = _FOLD[data]
    return out, np.append(at, len(out))


def text_grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, first): the byte 4-grams of each padded text as 32-bit integers; text d's are codes[first[d]:first[d + 1]]."""
    padded, at = _padded(data, offsets)
    if len(padded) < 4:
        return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
    wide = padded.astype(np.uint32)
    codes = wide[:-3] | wide[1:-2] << np.uint32(8) | wide[2:-1] << np.uint32(16) | wide[3:] << np.uint32(24)
    sizes = np.maximum(0, np.diff(at) - 3)
    first = np.concatenate(([0], np.cumsum(sizes)))
    whole = np.ones(len(codes), dtype=bool)
    for back in (1, 2, 3):  # grams that run into the next text
        edge = at[1:-1] - back
        whole[edge[(edge >= 0) & (edge < len(whole))]] = False
    return codes[whole], first


def _slots(codes: np.ndarray, params_bits: int, hashes: int) -> list[np.ndarray]:
    h = mix(codes.astype(np.uint64) + np.uint64(0x51ED27))
    shift, mask = np.uint64(params_bits), np.uint64((1 << params_bits) - 1)
    return [(h >> (shift * np.uint64(i))) & mask for i in range(hashes)]


class BloomLanguages:
    """The filter: one mask of languages a slot. Its size is fixed by the parameters and the number of languages."""

    def __init__(self, langs: list[str], codes: list[np.ndarray], params: LanguageParams):
        self.langs, self.params = langs, params
        kind = np.uint8 if len(langs) <= 8 else np.uint16 if len(langs) <= 16 else np.uint64
        self.words = max(1, -(-len(langs) // 64))
        self.table = np.zeros((self.words, 1 << params.slot_bits), kind)
        for i, own in enumerate(codes):
            for s in _slots(own, params.slot_bits, params.hashes):
                self.table[i // 64][s] |= kind(1 << (i % 64))
        fill = [float(((self.table[i // 64] >> kind(i % 64)) & kind(1)).mean()) for i in range(len(langs))]
        self.false_positive = np.array(fill) ** params.hashes

    def counts(self, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Corrected popcounts, one row a text and one column a language."""
        texts, out = len(first) - 1, np.zeros((len(first) - 1, len(self.langs)))
        sizes = np.diff(first)
        full = np.flatnonzero(sizes)
        if not len(full):
            return out
        slots = _slots(codes, self.params.slot_bits, self.params.hashes)
        for w in range(self.words):
            mask = self.table[w][slots[0]]
            for s in slots[1:]:
                mask &= self.table[w][s]
            for i in range(64 * w, min(64 * w + 64, len(self.langs))):
                bit = (mask >> mask.dtype.type(i % 64)) & mask.dtype.type(1)
                out[full, i] = np.add.reduceat(bit, first[:-1][full], dtype=np.int64)
        return np.maximum(0.0, (out - sizes[:, None] * self.false_positive) / (1 - np.minimum(self.false_positive, 0.999)))


def _held_out(key: str):
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def learn_languages(docs: DataFrame, params: LanguageParams = LanguageParams(), key: str = "doc_id", text: str = "text", lang: str = "lang") -> BloomLanguages:
    """Fit the filter on a bounded, hashed sample of the rows that are not held out and have a language.

    Null texts and languages are left out; repeated rows count each; long
    texts are taken whole; an empty table gives a filter without languages,
    which calls every text `und`. The driver gets the n-grams of the sample,
    whose size the parameters bound, not the corpus.
    """
    known = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).alias("l"), _held_out(key).alias("held")).where("not held and l is not null and t is not null")
    sizes = {r.l: r["count"] for r in known.groupBy("l").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return BloomLanguages([], [], params)
    share = F.create_map(*[F.lit(v) for name in langs for v in (name, min(1.0, params.docs_per_lang / sizes[name]))])
    sample = known.where(F.pmod(F.xxhash64(F.lit(17), "k"), F.lit(1 << 20)) < share[F.col("l")] * float(1 << 20)).select("t", "l")

    def count(batches):
        for batch in batches:
            names = batch.column("l").to_pylist()
            for part_lang in sorted(set(names)):
                own = batch.filter(pc.equal(batch.column("l"), part_lang))
                found = [np.unique(text_grams(*utf8(part.column("t")))[0], return_counts=True) for part in slices(own, "t")]
                codes, inverse = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
                total = np.bincount(inverse, weights=np.concatenate([f[1] for f in found])).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([part_lang] * len(codes)), pa.array(codes.astype(np.int64)), pa.array(total)], ["l", "gram", "n"])

    grams = sample.mapInArrow(tidied(count), "l string, gram long, n long").groupBy("l", "gram").agg(F.sum("n").alias("n")).where(F.col("n") >= params.min_count)
    grams = keep(grams, f"{shared_dir(docs.sparkSession, 'languages')}/grams")
    totals = grams.groupBy("l").agg(F.sum("n").alias("total"))
    rated = grams.join(F.broadcast(totals), "l").withColumn("rate", F.col("n") / F.col("total"))
    best = rated.groupBy("gram").agg(F.max("rate").alias("best"))
    chosen = rated.join(best, "gram").where(F.col("rate") >= params.min_share * F.col("best"))
    if params.grams_per_lang is not None:
        chosen = chosen.withColumn("rank", F.row_number().over(W.partitionBy("l").orderBy(F.desc("rate"), "gram"))).where(F.col("rank") <= params.grams_per_lang)
    pairs = chosen.select("l", "gram").toArrow()  # n-grams of the sample
    names, codes = np.array(pairs.column("l").to_pylist(), dtype=object), pairs.column("gram").to_numpy().astype(np.uint32)
    return BloomLanguages(langs, [codes[names == name] for name in langs], params)


def predict_languages(docs: DataFrame, model: BloomLanguages, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, lang_pred, score) for every row.

    The score is the best language's share of all corrected counts. A null
    text or one without a letter has `und` and score 0, as has every text if
    nothing could be learnt; a text that has letters but no known n-gram gets
    the language with the most n-grams, with score 0. Ties go to the first
    language in alphabetical order. Repeated rows are judged alike; a null key
    counts as held out; long texts are judged whole; an empty table gives no
    rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def has_letter(column, data, offsets):
        seen = np.concatenate(([0], np.cumsum(_LETTER[data])))
        found = seen[offsets[1:]] > seen[offsets[:-1]]
        for i in np.flatnonzero(~found & (np.diff(offsets) > 0)):
            found[i] = any(c.isalpha() for c in column[int(i)].as_py())
        return found

    def predict(batches):
        m = shared.value
        names = np.array([*m.langs, "und"], dtype=object)
        fallback = max(range(len(m.langs)), key=lambda i: m.false_positive[i]) if m.langs else 0
        for batch in batches:
            for part in slices(batch, "t"):
                data, offsets = utf8(part.column("t"))
                letters = has_letter(part.column("t"), data, offsets)
                choice, score = np.full(part.num_rows, len(m.langs)), np.zeros(part.num_rows)
                if m.langs:
                    counts = m.counts(*text_grams(data, offsets))
                    total = counts.sum(axis=1)
                    choice = np.where(total > 0, counts.argmax(axis=1), fallback)
                    score = np.where(letters & (total > 0), counts.max(axis=1) / np.maximum(total, 1e-300), 0.0)
                    choice = np.where(letters, choice, len(m.langs))
                yield pa.RecordBatch.from_arrays([part.column("k"), part.column("held_out"), pa.array(names[choice].tolist(), pa.string()), pa.array(score)], ["k", "held_out", "lang_pred", "score"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("k"), _held_out(key).alias("held_out"), F.col(text).alias("t"))
    return rows.mapInArrow(tidied(predict), f"k {kind}, held_out boolean, lang_pred string, score double").withColumnRenamed("k", key)


def op1_language_bitmask(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return predict_languages(docs, learn_languages(docs))
