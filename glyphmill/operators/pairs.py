"""Bilingual pairs: views, joins, fonts, routing and twins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphmill.functions import text as T
from glyphmill.functions.prompts import seeded_unit


def split_views(pairs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pairs, zh rows, en rows); the last two carry pair_id and lang."""
    def side(lang: str) -> DataFrame:
        return pairs.select("pair_id", F.lit(lang).alias("lang"), f"{lang}.*")

    return pairs, side("zh"), side("en")


def long_view(pairs: DataFrame) -> DataFrame:
    """One row a side."""
    sides = F.array(*[F.struct(F.lit(x).alias("lang"), F.col(x).alias("sample")) for x in ("zh", "en")])
    return pairs.select("pair_id", F.explode(sides).alias("s")).select("pair_id", "s.lang", "s.sample.*")


def rejoin(zh: DataFrame, en: DataFrame) -> DataFrame:
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select("pair_id", F.struct(*[c for c in df.columns if c not in ("pair_id", "lang")]).alias(name))

    return side(zh, "zh").join(side(en, "en"), "pair_id")


# Which families belong together, and the style that they share.
FONT_STYLES = (("黑体", "sans", "modern_sans"), ("宋体", "serif", "literary_serif"), ("楷体", "script", "calligraphy"), ("行书", "script", "calligraphy"), ("行楷", "script", "calligraphy"), ("艺术体", "display", "display"))


def spec_of(registry: list[dict], name: str) -> dict:
    """The registry entry of a name; an unknown one is an error."""
    for entry in registry:
        if entry.get("name") == name:
            return entry
    raise KeyError(f"no registry entry is named {name}")


def registry_table(spark, registry: list[dict]) -> DataFrame:
    """(name, type, field, weight) of a corpus registry: one row an entry, so small enough to broadcast. A missing weight is 1."""
    rows = [(e["name"], e.get("type"), e.get("field"), float(e.get("sampling_weight", 1.0))) for e in registry]
    return spark.createDataFrame(rows, "name string, type string, field string, weight double")


def installed(registry: DataFrame, files: DataFrame) -> DataFrame:
    """Registry entries whose file exists."""
    return registry.join(files.select("file").distinct(), "file", "left_semi")


def font_pairs(df: DataFrame, id: str, zh_fonts: DataFrame, en_fonts: DataFrame, seed: int) -> DataFrame:
    """A style, a zh and an en font for each row: fonts of the style's families, else any installed font.

    zh_fonts and en_fonts (family, file) are registries, small tables that hold
    one row a font file.
    """
    spark = df.sparkSession
    styles = spark.createDataFrame([(i, *s) for i, s in enumerate(FONT_STYLES)], "style_no int, zh_family string, en_family string, style string")

    def lists(fonts: DataFrame, family: str, name: str) -> DataFrame:
        every = fonts.agg(F.array_sort(F.collect_set("file")).alias("all"))
        own = fonts.groupBy(F.col("family").alias("f")).agg(F.array_sort(F.collect_set("file")).alias("own"))
        joined = styles.select("style_no", family).join(own, F.col(family) == F.col("f"), "left").crossJoin(every)
        return joined.select("style_no", F.coalesce("own", "all").alias(name))

    table = styles.join(lists(zh_fonts, "zh_family", "zh_files"), "style_no").join(lists(en_fonts, "en_family", "en_files"), "style_no")

    def pick(k: int, files: str) -> Column:
        return F.element_at(files, (F.floor(seeded_unit(seed + k, F.col(id)) * F.size(files)) + 1).cast("int"))

    chosen = df.withColumn("style_no", F.floor(seeded_unit(seed, F.col(id)) * len(FONT_STYLES)).cast("int"))
    return chosen.join(F.broadcast(table), "style_no").withColumns({"zh_font": pick(1, "zh_files"), "en_font": pick(2, "en_files")}).drop("style_no", "zh_files", "en_files", "zh_family", "en_family")


def fill_side(existing: Column, translated: Column) -> Column:
    return F.coalesce(F.nullif(existing, F.lit("")), translated)


def answered_pairs(answer: Column) -> Column:
    """The (zh, en) pairs of a JSON answer that may be fenced, those that have both sides; none of an answer that is no list."""
    bare = F.regexp_replace(F.regexp_replace(answer, "^[\\s`]+|[\\s`]+$", ""), "^json", "")
    found = F.coalesce(F.try_variant_get(F.try_parse_json(bare), "$", "array<struct<zh:string,en:string>>"), F.array().cast("array<struct<zh:string,en:string>>"))
    trimmed = F.transform(found, lambda p: F.struct(T.collapse_ends(p["zh"]).alias("zh"), T.collapse_ends(p["en"]).alias("en")))
    return F.filter(trimmed, lambda p: (F.coalesce(p["zh"], F.lit("")) != "") & (F.coalesce(p["en"], F.lit("")) != ""))


def text_pool(answer: Column, provider: Column) -> Column:
    """The texts of a numbered answer; none for topics whose texts are taken from images."""
    return F.when(F.coalesce(provider, F.lit("")) == "vlm", F.array().cast("array<string>")).otherwise(T.split_numbered(answer))


def source_language(text: Column, least: float = 0.4) -> Column:
    return F.when(T.chinese_ratio(text) >= least, "zh").otherwise("en")


def parallelism(first_cover: Column, second_cover: Column) -> Column:
    both = (F.coalesce(first_cover, F.lit("")) != "") & (F.coalesce(second_cover, F.lit("")) != "")
    return F.when(both & (first_cover != second_cover), "shared_layout").otherwise("same_image")


def zip_sections(texts: Column, images: Column) -> Column:
    """Texts and images paired by position up to the longer list; a position that neither list has gives no section, an empty text does."""
    zipped = F.transform(F.sequence(F.lit(0), F.greatest(F.size(texts), F.size(images), F.lit(1)) - 1), lambda i: F.struct(F.get(texts, i).alias("text"), F.get(images, i).alias("image")))
    return F.filter(zipped, lambda s: s["text"].isNotNull() | s["image"].isNotNull())


def replace_texts(boxes: Column, texts: Column, chars: int = 200) -> Column:
    """Boxes with the payloads of their text boxes replaced in order, cut at `chars`, empty where texts run out."""
    start = F.struct(F.lit(0).alias("next"), F.filter(boxes, lambda b: F.lit(False)).alias("out"))

    def step(acc: Column, b: Column) -> Column:
        is_text = b["kind"] == "text"
        new = b.withField("payload", F.when(is_text, F.left(F.coalesce(F.get(texts, acc["next"]), F.lit("")), F.lit(chars))).otherwise(b["payload"]))
        return F.struct((acc["next"] + is_text.cast("int")).alias("next"), F.array_append(acc["out"], new).alias("out"))

    return F.aggregate(boxes, start, step, lambda acc: acc["out"])
