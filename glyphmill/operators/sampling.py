"""Seeded sampling, strata, budgets and weighted mixing.

Draws hash the row's id with the seed, so they depend on neither partitions
nor order; MD5 makes them equal in every engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glyphmill.functions.bins import EN_BINS, decide_pair
from glyphmill.functions.prompts import seeded_unit
from glyphmill.operators.lineage import running


def seeded_key(seed: int, *columns: str):
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]).cast("binary"))


def random_bin(df: DataFrame, id: str, seed: int, bins=EN_BINS) -> DataFrame:
    return df.withColumn("bin", F.element_at(F.array(*[F.lit(b) for b in bins]), (F.floor(seeded_unit(seed, F.col(id)) * len(bins)) + 1).cast("int")))


def per_stratum(df: DataFrame, stratum: str, id: str, n: int, seed: int) -> DataFrame:
    """n rows of each stratum (fewer where it is short), in seeded order."""
    place = F.row_number().over(W.partitionBy(stratum).orderBy(seeded_key(seed, id), id))
    return df.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


def stratified_bins(df: DataFrame, bin: str, id: str, total: int, seed: int, bins=EN_BINS) -> DataFrame:
    """An equal share of each bin; what a short bin lacks is not made up."""
    return per_stratum(df.where(F.col(bin).isin(*bins)), bin, id, total // len(bins), seed)


def stratified_topics(df: DataFrame, topic: str, id: str, total: int, seed: int) -> DataFrame:
    """max(1, total div topics) rows of each topic, then `total` of these in seeded order; a missing topic is one stratum.

    The share is a literal, so that ranks beyond it are left out before the exchange.
    """
    keyed = df.withColumn("_topic", F.coalesce(F.col(topic).cast("string"), F.lit("\x00")))
    strata = keyed.select(F.count_distinct("_topic")).first()[0]
    picked = per_stratum(keyed, "_topic", id, max(1, total // max(1, strata)), seed)
    return picked.orderBy(seeded_key(seed + 1, id), id).limit(total).drop("_topic")


def first_n(df: DataFrame, ord: str, n: int) -> DataFrame:
    return df.orderBy(ord).limit(n)


def budget(df: DataFrame, group: str, ord: str, passes, n: int, attempts: int) -> DataFrame:
    """Of each group's first n * attempts rows, the first n that pass."""
    tried = df.withColumn("_try", F.row_number().over(W.partitionBy(group).orderBy(ord))).where(F.col("_try") <= n * attempts).where(passes)
    return tried.withColumn("_got", F.row_number().over(W.partitionBy(group).orderBy("_try"))).where(F.col("_got") <= n).drop("_try", "_got")


def weighted_mix(df: DataFrame, corpus: str, id: str, weights: dict[str, float], seed: int, total: int | None = None) -> DataFrame:
    """Corpora interleaved without replacement: each row has an arrival time, exponential with its corpus's weight, cumulated inside the corpus.

    Weights are relative; corpora without one are left out. A corpus that ends
    early leaves its turns to the others. `total` keeps the first arrivals.
    Times are summed up in ranges, so a corpus is no single task.
    """
    table = F.create_map(*[F.lit(x) for name, w in weights.items() for x in (name, float(w))])
    rows = df.withColumn("_w", table[F.col(corpus)]).where("_w > 0")
    rows = rows.withColumn("_gap", -F.log(1.0 - seeded_unit(seed, F.col(id))) / F.col("_w"))
    rows = running(rows.withColumn("_key", seeded_key(seed + 1, id)), [corpus], ["_key", id], F.col("_gap"), "arrival").drop("_w", "_gap", "_key")
    return rows.orderBy("arrival", id).limit(total) if total else rows


def mixed_pairs(df: DataFrame, corpus: str, id: str, en: str, zh: str, weights: dict[str, float], seed: int, total: int | None = None) -> DataFrame:
    """weighted_mix of the pairs whose lengths pass at their natural bin; pairs that fail take no turn."""
    fitting = df.where(decide_pair(F.col(en), F.col(zh))["drop_reason"].isNull())
    return weighted_mix(fitting, corpus, id, weights, seed, total)


def seeded_attributes(df: DataFrame, id: str, seed: int, fonts: list[str], sizes=(24, 56), rotations=(-2, -1, 0, 1, 2), alignments=("left", "center", "right")) -> DataFrame:
    """Font, size, colour, rotation and alignment for each row, one independent draw each."""
    def draw(k: int):
        return seeded_unit(seed + k, F.col(id))

    def pick(k: int, values):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (F.floor(draw(k) * len(values)) + 1).cast("int"))

    return df.withColumns({
        "font": pick(1, fonts),
        "font_size": (F.floor(draw(2) * (sizes[1] - sizes[0] + 1)) + sizes[0]).cast("int"),
        "rotation": pick(3, rotations),
        "alignment": pick(4, alignments),
        "color": F.struct(*[F.floor(draw(5 + i) * 256).cast("int").alias(c) for i, c in enumerate("rgb")]),
    })


def preferred_family(df: DataFrame, id: str, seed: int, family: str, share: float = 0.6) -> DataFrame:
    return df.withColumn("family", F.when(seeded_unit(seed, F.col(id)) < share, F.lit(family)))


# Evaluation plan, key -> (source subset, strategy, rows), for single samples and for pairs.
EVAL_PLAN = {
    "clean": ("CleanTextSynth-CN", "bin", 1000),
    "styled": ("StyledTextSynth-CN", "topic", 1000),
    "scenes": ("TextScenesHQ-CN", "topic", 1000),
    "blend": ("TextVisionBlend-CN", "topic", 1000),
}
PAIR_PLAN = {key: (subset.replace("-CN", "-Parallel"), strategy, n) for key, (subset, strategy, n) in EVAL_PLAN.items()}


def eval_split(inputs: dict[str, DataFrame], seed: int, plan=EVAL_PLAN, split: str = "eval", subset: str = "source_subset", id: str = "sample_id", bin: str = "bin", topic: str = "topic") -> DataFrame:
    """The union of each planned input's stratified sample of its subset's rows, marked for review; unknown keys are skipped."""
    out = None
    for key, df in inputs.items():
        if key not in plan:
            continue
        name, strategy, n = plan[key]
        rows = df.where(F.col(subset) == name)
        rows = stratified_bins(rows, bin, id, n, seed) if strategy == "bin" else stratified_topics(rows, topic, id, n, seed)
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    if out is None:
        raise ValueError(f"no input is one of {', '.join(plan)}")
    return out.withColumns({"eval_split": F.lit(split), "needs_human_review": F.lit(True)})


def pair_eval_split(inputs: dict[str, DataFrame], seed: int, plan=PAIR_PLAN, split: str = "eval") -> DataFrame:
    """eval_split of pairs (pair_id, source_subset, alignment, shared, zh, en): strata are the anchor's bin, a string, and the shared topic or its name."""
    def strata(df: DataFrame) -> DataFrame:
        has = df.schema["shared"].dataType.fieldNames() if "shared" in df.columns else []
        name = F.lit(None).cast("string")
        if "topic" in has:
            kind = df.schema["shared"].dataType["topic"].dataType
            name = F.col("shared.topic.name") if hasattr(kind, "fieldNames") else F.col("shared.topic").cast("string")
        return df.withColumns({"_bin": F.col("alignment.bin_anchor").try_cast("int"), "_topic": name})

    keyed = {key: strata(df) for key, df in inputs.items() if key in plan}
    return eval_split(keyed, seed, plan, split, id="pair_id", bin="_bin", topic="_topic").drop("_bin", "_topic")


def pair_review(picked: DataFrame) -> DataFrame:
    """What a reviewer sees of picked pairs: images, texts and prompts of both sides."""
    sides = [F.col(f"{lang}.{name}").alias(f"{short}_{lang}") for short, name in (("image", "image_path"), ("rendered", "rendered_text"), ("prompt", "prompt")) for lang in ("zh", "en")]
    return picked.select("pair_id", F.col("source_subset").alias("subset"), *sides)
