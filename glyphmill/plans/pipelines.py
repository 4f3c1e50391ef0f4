"""Whole jobs: OCR filtering, clean texts, interleaved pages, bilingual pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphmill.functions import bins, layout, predicates, prompts
from glyphmill.functions import text as T
from glyphmill.operators import dedup, sampling
from glyphmill.operators.lineage import cut

# Subset names that samples of these jobs carry.
OCR_SUBSET, PAGE_SUBSET = "LongWordsSubsetZH", "TextVisionBlendZH"

def _ordered(records: DataFrame) -> DataFrame:
    """Records with normalised blocks in reading order, without empty ones, and `joined`, their texts joined by spaces."""
    plain = T.normalize_all(F.transform("blocks", lambda b: b["text"]))
    rows = records.withColumn("_plain", plain).withColumn("blocks", F.filter(F.zip_with("blocks", "_plain", lambda b, t: b.withField("text", t)), lambda b: b["text"] != ""))
    return rows.withColumn("blocks", layout.order_by_corner(F.col("blocks"))).withColumn("joined", F.array_join(F.transform("blocks", lambda b: b["text"]), " "))


def ocr_samples(records: DataFrame, subset: str, rules: predicates.UnitRules | None = predicates.UnitRules(), split: str = "train") -> DataFrame:
    """Valid samples of OCR records (line, sample_id, image_path, caption, blocks).

    Block texts are normalised, empty blocks go, the others are put in reading
    order. `text` is all texts without punctuation, joined by spaces; it is
    judged, and is what the prompt holds. Without rules all records count as
    valid, as after a first judgement.
    """
    rows = _ordered(records).withColumn("text", T.normalize_text(F.col("joined"), keep_punctuation=False))
    valid = (rows if rules is None else rows.where(predicates.valid_long_text(F.col("text"), rules))).withColumn("caption", T.normalize_text(F.col("caption")))
    return valid.withColumns({
        "sample_id": F.coalesce("sample_id", T.stable_id("real_zh_", F.lit(subset), F.coalesce("image_path", F.lit("")), "text")),
        "subset": F.lit(subset),
        "language": F.lit("zh"),
        "split": F.lit(split),
        "prompt": prompts.text_in_image_prompt(F.col("caption"), F.col("text")),
    }).drop("_plain")


def filter_ocr(records: DataFrame, subset: str = OCR_SUBSET, rules: predicates.UnitRules = predicates.UnitRules(), deduplicate: bool = True, near: bool = True) -> DataFrame:
    """Valid samples without exact copies (same text without punctuation) and, if wanted, without near copies; the first line wins.

    Near copies are sought in a written table of the joined texts, so a task holds the workers of one or two steps; samples are then made of the kept records.
    """
    if not deduplicate or not near:
        samples = ocr_samples(records, subset, rules)
        return (dedup.exact_dedup(samples, F.col("text"), "line") if deduplicate else samples).drop("joined")
    joined = cut(_ordered(records).select("line", "joined"))
    plain = joined.withColumn("text", T.normalize_text(F.col("joined"), keep_punctuation=False)).where(predicates.valid_long_text(F.col("text"), rules))
    keys = cut(plain.select("line", F.sha2(F.col("text").cast("binary"), 256).alias("key")))
    unique = dedup.among(joined, cut(dedup.exact_dedup(keys, F.col("key"), "line").select("line")), "line")
    kept = cut(dedup.near_dedup(unique, "joined", "line").select("line"))
    return ocr_samples(dedup.among(records, kept, "line"), subset, None).drop("joined")


def clean_texts(texts: DataFrame, seed: int, most_units: int = 80, limit: int | None = None) -> DataFrame:
    """Texts (line, text) cut to units, with an id, a prompt and seeded attributes for a renderer."""
    rows = sampling.first_n(texts, "line", limit) if limit else texts
    rows = rows.withColumn("text", T.truncate_by_units(F.col("text"), most_units)).where("text <> ''")
    rows = rows.withColumn("sample_id", T.stable_id("clean_zh_", F.to_json(F.struct("line")), F.col("text"))).withColumn("prompt", prompts.clean_prompt(F.col("text")))
    return sampling.seeded_attributes(rows, "sample_id", seed, ["default"])


def interleaved_pages(documents: DataFrame, seed: int, width: int = 1024, height: int = 1024, margin: int = 48, most_units: int = 80, subset: str = PAGE_SUBSET) -> DataFrame:
    """Pages of documents (id, sections): images and texts in their order until one overflows, with the prompt that lists them.

    A section's text is normalised and cut to units; an image is placed where
    its size (w, h) is known.
    """
    texts = T.truncate_all(F.transform("sections", lambda s: s["text"]), most_units)
    rows = documents.withColumn("_texts", texts).withColumn("_sections", F.zip_with("sections", "_texts", lambda s, t: s.withField("text", t)))
    rows = rows.withColumn("sample_id", T.stable_id("interleave_zh_", F.col("id"), F.to_json("sections"))).withColumn("_items", layout.flow_items(F.col("_sections")))
    rows = rows.withColumn("boxes", layout.page_flow(F.col("_items"), width, height, margin, seed=seed, key=F.col("sample_id")))
    # an item's place on the page is its place among the items
    shown = F.transform(F.slice("_items", 1, F.size("boxes")), lambda x: F.struct(x["kind"].alias("kind"), F.when(x["kind"] == "image", x["caption"]).otherwise(x["text"]).alias("text")))
    return rows.select("sample_id", F.lit(subset).alias("subset"), F.col("id").alias("source_id"), "boxes", prompts.interleaved_prompt(shown).alias("prompt"))


def text_pairs(pairs: DataFrame, id: str, seed: int) -> DataFrame:
    """Pairs (en, zh) that pass the length gate twice, at their natural bin and at a random one, with the decision of the second."""
    natural = pairs.where(bins.decide_pair(F.col("en"), F.col("zh"))["drop_reason"].isNull())
    drawn = sampling.random_bin(natural, id, seed).withColumn("d", bins.decide_pair(F.col("en"), F.col("zh"), F.col("bin")))
    return drawn.where(F.col("d.drop_reason").isNull() & predicates.min_pair_length(F.col("d.en"), F.col("d.zh"), F.col("bin")))


def pair_samples(pairs: DataFrame, pair_id: Column, subset: str, layout_type: str = "pure_text", mode: str = "shared_layout", method: str = "human_pair", source: Column | None = None) -> DataFrame:
    """Pair rows of decided pairs (d): both sides as samples, and how they are aligned."""
    def side(lang: str, language: str) -> Column:
        return F.struct(
            F.concat(pair_id, F.lit(f"-{lang}")).alias("sample_id"), F.lit(language).alias("language"), F.lit(f"{subset}/{lang}").alias("source_subset"), F.lit(layout_type).alias("layout_type"),
            F.col(f"d.{lang}").alias("rendered_text"), prompts.clean_prompt(F.col(f"d.{lang}")).alias("prompt"),
        )

    alignment = F.struct((F.lit("") if source is None else source).alias("source"), F.lit(method).alias("method"), F.col("d.bin").cast("string").alias("bin_anchor"), F.col("d.en_chars").alias("len_en_chars"), F.col("d.zh_chars").alias("len_zh_chars"))
    return pairs.select(pair_id.alias("pair_id"), F.lit(mode).alias("parallelism"), F.lit(layout_type).alias("layout_type"), F.lit(subset).alias("source_subset"), side("zh", "zh-Hans").alias("zh"), side("en", "en").alias("en"), alignment.alias("alignment"))


def review_queue(samples: DataFrame, flag) -> tuple[DataFrame, DataFrame]:
    """All samples with their flag, and the flagged ones' review columns."""
    marked = samples.withColumn("needs_human_review", flag)
    shown = [c for c in ("sample_id", "image_path", "rendered_text", "prompt", "source_subset") if c in samples.columns]
    return marked, marked.where("needs_human_review").select(*shown)
