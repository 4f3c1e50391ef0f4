"""The subsets: one job for single samples and one for bilingual pairs of each.

A job is a plan from prepared rows to samples. What needs a service (a
language model, translation, images, recognition, rendering) goes through
`operators.models`, once a distinct request; `service` is the model that is
asked, by default the deterministic stub. Rasters are the caller's: a sample
names its image by a path made from its id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphmill.functions import bins, layout, predicates, prompts
from glyphmill.functions import text as T
from glyphmill.operators import models, pairs, sampling
from glyphmill.sources.writers import image_path

# Subset -> (name of single samples, name of pairs, layout type, scene caption in zh, in en).
SUBSETS = {
    "clean": ("CleanTextSynth-CN", "CleanTextSynth-Parallel", "pure_text", "纯白背景，无场景内容。", "A blank white background with no scene content."),
    "words": ("LongWordsSubset-CN", "LongWordsSubset-Parallel", "real_dense_text", "中文场景图像", "A scene image with visible text."),
    "books": ("CoverBook-CN", "CoverBook-Parallel", "cover_book", "中文图书封面", "English-edition book cover"),
    "papers": ("Paper2Text-CN", "Paper2Text-Parallel", "paper_text", "一页中文学术论文", "A page of an academic paper."),
    "slides": ("PPT2Structured-CN", "PPT2Structured-Parallel", "ppt_structured", "一页中文学术幻灯", "An academic presentation slide."),
    "details": ("PPT2Details-CN", "PPT2Details-Parallel", "ppt_details", "一张中文 PowerPoint 幻灯片", "A PowerPoint slide image."),
    "scenes": ("TextScenesHQ-CN", "TextScenesHQ-Parallel", "scene_hq", "中文场景", ""),
    "styled": ("StyledTextSynth-CN", "StyledTextSynth-Parallel", "styled_scene", "", ""),
    "blend": ("TextVisionBlend-CN", "TextVisionBlend-Parallel", "interleaved", "一张交错图文版式的中文页面", "An interleaved Chinese/English image-text page"),
}
LANGUAGES = {"zh": "zh-Hans", "en": "en"}


def samples(rows: DataFrame, kind: str, id: Column, text: Column, prompt: Column, caption: Column | None = None, image: Column | None = None, suffix: str = "", **metadata: Column) -> DataFrame:
    """Single samples of a subset."""
    name, _, layout_type, scene, _ = SUBSETS[kind]
    return rows.select(
        id.alias("sample_id"), F.coalesce(image if image is not None else F.lit(None).cast("string"), image_path(id)).alias("image_path"), F.lit(name + suffix).alias("source_subset"), F.lit(layout_type).alias("layout_type"),
        text.alias("rendered_text"), (F.lit(scene) if caption is None else caption).alias("scene_caption"), prompt.alias("prompt"), F.lit("zh-Hans").alias("language"), F.struct(*[v.alias(k) for k, v in metadata.items()] or [F.lit(kind).alias("subset")]).alias("metadata"),
    )


def paired(rows: DataFrame, kind: str, id: Column, texts: dict[str, Column], prompts_: dict[str, Column], mode: Column | str, method: str, source: Column, captions: dict[str, Column] | None = None, anchor: Column | None = None, similarity: Column | None = None, suffix: str = "", shared: Column | None = None, review: Column | None = None) -> DataFrame:
    """Pairs of a subset: both sides as samples, what they share and how they are aligned."""
    _, name, layout_type, *scenes = SUBSETS[kind]

    def side(lang: str, scene: str) -> Column:
        sample_id = F.concat(id, F.lit(f"-{lang}"))
        caption = captions[lang] if captions else F.lit(scene)
        return F.struct(sample_id.alias("sample_id"), image_path(id).alias("image_path"), F.lit(f"{name}{suffix}/{lang}").alias("source_subset"), F.lit(layout_type).alias("layout_type"), F.lit(LANGUAGES[lang]).alias("language"), texts[lang].alias("rendered_text"), caption.alias("scene_caption"), prompts_[lang].alias("prompt")).alias(lang)

    alignment = F.struct(
        source.alias("source"), F.lit(method).alias("method"), (F.lit(None).cast("double") if similarity is None else similarity).alias("similarity"), (F.lit("") if anchor is None else anchor.cast("string")).alias("bin_anchor"),
        F.length(texts["zh"]).alias("len_zh_chars"), F.length(texts["en"]).alias("len_en_chars"),
    )
    how = F.lit(mode) if isinstance(mode, str) else mode
    return rows.select(id.alias("pair_id"), how.alias("parallelism"), F.lit(layout_type).alias("layout_type"), F.lit(name + suffix).alias("source_subset"), side("zh", scenes[0]), side("en", scenes[1]),
                       (F.struct(F.lit(kind).alias("subset")) if shared is None else shared).alias("shared"), alignment.alias("alignment"), F.coalesce(F.lit(False) if review is None else review, F.lit(False)).alias("needs_human_review"))


def _first(rows: DataFrame, n: int) -> DataFrame:
    return rows.orderBy("arrival", "id").limit(n)


def clean_texts(texts: DataFrame, weights: dict[str, float], fonts: list[str], n: int, seed: int) -> DataFrame:
    """n samples of a mix of corpora (corpus, id, text): four times as many texts are tried, each cut to a bin of its own."""
    mixed = sampling.random_bin(sampling.weighted_mix(texts, "corpus", "id", weights, seed, 4 * n), "id", seed)
    cut = mixed.withColumn("text", T.truncate_clean(F.col("text"), F.col("bin"))).where(predicates.min_clean_length(F.col("text"), F.col("bin")))
    rows = _first(cut, n).withColumn("font", prompts.seeded_choice(seed + 2, fonts, F.col("id")))
    id = T.stable_id0(F.col("corpus"), F.col("bin"), F.left("text", F.lit(64)), F.col("font"), F.col("id"))
    return samples(rows, "clean", id, F.col("text"), prompts.clean_prompt(F.col("text"), F.col("font")), source_corpus=F.col("corpus"), length_bin=F.col("bin"))


def clean_pairs(texts: DataFrame, weights: dict[str, float], zh_fonts: list[str], en_fonts: list[str], n: int, seed: int) -> DataFrame:
    """n pairs of a mix of parallel corpora (corpus, id, en, zh) that fit their bins."""
    mixed = sampling.random_bin(sampling.mixed_pairs(texts, "corpus", "id", "en", "zh", weights, seed, 3 * n), "id", seed)
    decided = mixed.withColumn("d", bins.decide_pair(F.col("en"), F.col("zh"), F.col("bin"))).where("d.drop_reason is null")
    rows = _first(decided.where(predicates.min_pair_length(F.col("d.en"), F.col("d.zh"), F.col("bin"))), n)
    fonts = {"zh": prompts.seeded_choice(seed + 2, zh_fonts, F.col("id")), "en": prompts.seeded_choice(seed + 2, en_fonts, F.col("id"))}
    id = T.stable_id0(F.lit("CleanText"), F.col("corpus"), F.left("d.en", F.lit(64)), F.left("d.zh", F.lit(32)), F.col("bin"))
    both = {lang: F.col(f"d.{lang}") for lang in LANGUAGES}
    return paired(rows, "clean", id, both, {lang: prompts.clean_prompt(both[lang], fonts[lang], lang) for lang in LANGUAGES}, "shared_layout", "human_pair", F.col("corpus"), anchor=F.col("bin"))


def _words(records: DataFrame, least: float | None, rules: predicates.CharRules) -> DataFrame:
    lines = layout.order_by_rows(predicates.long_words_lines(F.col("lines"), least))
    rows = records.withColumn("lines", lines).withColumn("joined", F.array_join(F.transform("lines", lambda x: x["text"]), "\n"))
    return rows.where(predicates.has_items(F.col("lines")) & predicates.long_words_valid(F.col("joined"), rules))


def _asked(rows: DataFrame, result: str, request: Column, service: models.Model) -> DataFrame:
    """rows with the trimmed answer to a chat request."""
    asked = models.call_once(rows.withColumn("prompt", request), "chat", service, "_answer")
    return asked.withColumn(result, F.trim(F.coalesce("_answer", F.lit("")))).drop("_answer", "prompt")


def long_words(records: DataFrame, source: str, seed: int, unify: models.Model | None = None, rules: predicates.CharRules = predicates.CharRules()) -> DataFrame:
    """Samples of OCR records of lines; a model joins caption and text, or a template where there is none or it fails."""
    rows = _words(records, 0.2, rules).withColumn("scene", F.coalesce("caption", F.lit("")))
    rows = rows.withColumn("unified", F.lit("")) if unify is None else _asked(rows, "unified", prompts.fill_request("unify", scene_caption=F.col("scene"), rendered_text=F.col("joined")), unify)
    id = T.stable_id0(F.lit(source), F.coalesce("image_path", "id"), F.left("joined", F.lit(64)))
    plain = prompts.caption(F.coalesce(F.nullif("scene", F.lit("")), F.lit(SUBSETS["words"][3])), F.col("joined"), seed, id)
    prompt = F.when((F.col("scene") != "") & (F.col("unified") != ""), F.col("unified")).otherwise(plain)
    return samples(rows, "words", id, F.col("joined"), prompt, F.col("scene"), F.col("image_path"), f"-{source}")


def _routed(rows: DataFrame, text: str, given: dict[str, Column], service: models.Model) -> tuple[DataFrame, dict[str, Column]]:
    """rows with both translations of a text, and its zh and en side: the text itself, what is given, or a translation."""
    rows = models.translated(models.translated(rows, text, "zh2en", "_en", service), text, "en2zh", "_zh", service)
    zh = pairs.source_language(F.col(text)) == "zh"
    none = F.lit(None).cast("string")
    sides = {"zh": F.when(zh, F.col(text)).otherwise(F.coalesce(pairs.fill_side(given.get("zh", none), F.col("_zh")), F.lit(""))), "en": F.when(zh, F.coalesce(pairs.fill_side(given.get("en", none), F.col("_en")), F.lit(""))).otherwise(F.col(text))}
    return rows, sides


def long_words_pairs(records: DataFrame, source: str, service: models.Model = models.stub, rules: predicates.CharRules = predicates.CharRules()) -> DataFrame:
    """Pairs of OCR records of lines: the text's language decides which side it is; the other one is given or translated."""
    rows, sides = _routed(_words(records, None, rules), "joined", {"zh": F.col("ocr_text_zh"), "en": F.col("ocr_text_en")}, service)
    scenes = {lang: F.coalesce(f"caption_{lang}", F.lit(SUBSETS["words"][3 + i])) for i, lang in enumerate(LANGUAGES)}
    id = T.stable_id0(F.lit(source), F.col("image_path"), F.left("joined", F.lit(48)))
    asked = {"zh": prompts.fill_request("unify", scene_caption=scenes["zh"], rendered_text=sides["zh"]), "en": F.concat(scenes["en"], F.lit(prompts.EN_TEXT["words"]), sides["en"])}
    rows = _asked(rows, "_prompt_zh", asked["zh"], service)
    return paired(rows, "words", id, sides, {"zh": F.col("_prompt_zh"), "en": asked["en"]}, "same_image", "dataset_pair_or_translate", F.lit(source), scenes, suffix=f"-{source}")


def books(records: DataFrame, fetch: models.Model = models.stub) -> DataFrame:
    """Samples of book records whose cover can be fetched."""
    rows = models.fetched(records.withColumn("url", F.col("cover_url")), "fetch", fetch, "cover")
    text = prompts.present(F.col("title"), F.col("author"), F.col("publisher"))
    fields = {n: F.col(n) for n in ("author", "publisher", "year", "category", "blurb")}
    return samples(rows, "books", T.stable_id0(F.coalesce(F.nullif("isbn", F.lit("")), "title"), F.col("author")), text, prompts.book_prompt(F.col("title"), **fields), cover_url=F.col("cover_url"))


def book_pairs(records: DataFrame, service: models.Model = models.stub) -> DataFrame:
    """Pairs of book records (isbn, year, cover_url_zh, cover_url_en and title, author, publisher, category in zh and en): missing en fields and titles are translated."""
    rows = records
    for name in ("title", "author", "publisher", "category"):
        rows = models.translated(rows, f"{name}_zh", "zh2en", "_answer", service).withColumn(f"{name}_en", pairs.fill_side(F.col(f"{name}_en"), F.col("_answer"))).drop("_answer")
    rows = models.translated(rows, "title_en", "en2zh", "_answer", service).withColumn("title_zh", pairs.fill_side(F.col("title_zh"), F.col("_answer"))).drop("_answer")

    def side(lang: str) -> tuple[Column, Column]:
        fields = {n: F.col(f"{n}_{lang}") for n in ("author", "publisher", "category")} | {"year": F.col("year")}
        return prompts.present(F.col(f"title_{lang}"), F.col(f"author_{lang}"), F.col(f"publisher_{lang}")), prompts.book_prompt(F.col(f"title_{lang}"), lang, **fields)

    id = T.stable_id0(F.coalesce(F.nullif("isbn", F.lit("")), "title_zh"), F.col("title_en"))
    both = {lang: side(lang) for lang in LANGUAGES}
    return paired(rows, "books", id, {k: v[0] for k, v in both.items()}, {k: v[1] for k, v in both.items()}, pairs.parallelism(F.col("cover_url_zh"), F.col("cover_url_en")), "metadata_pair", F.lit("metadata"), shared=F.struct("isbn", "year"))


def papers(pages: DataFrame) -> DataFrame:
    """Samples of paper pages (sources.readers.paper_pages)."""
    return samples(pages, "papers", T.stable_id0(F.col("path"), F.col("page")), F.col("text"), prompts.page_prompt(F.col("page"), F.col("spans")), path=F.col("path"), page=F.col("page"))


def paper_pairs(pages: DataFrame, service: models.Model = models.stub) -> DataFrame:
    """Pairs of paper pages with a text and its translation; pages without either go."""
    rows = models.translated(pages.where(predicates.not_blank(F.col("text"))), "text", "zh2en", "en", service).where(F.coalesce("en", F.lit("")) != "")
    both = {"zh": F.col("text"), "en": F.col("en")}
    return paired(rows, "papers", T.stable_id0(F.col("path"), F.col("page")), both, {"zh": prompts.page_prompt(F.col("page"), F.col("spans")), "en": prompts.translated_page_prompt(F.col("page"), F.col("en"))}, "same_image", "llm_translate", F.col("path").cast("string"))


def slides(pages: DataFrame) -> DataFrame:
    """Samples of slides and their elements (sources.readers.slide_pages)."""
    return samples(pages, "slides", T.stable_id0(F.col("path"), F.col("page")), F.col("text"), F.concat(F.lit(prompts.SLIDE_MONO), prompts.element_bullets(F.col("elements"))), path=F.col("path"), page=F.col("page"))


def slide_pairs(pages: DataFrame) -> DataFrame:
    """Pairs of slides that share their image; the bullets' words are in both languages."""
    return paired(pages, "slides", T.stable_id0(F.col("path"), F.col("page")), {lang: F.col("text") for lang in LANGUAGES}, {lang: F.concat(F.lit(prompts.SLIDE[lang]), prompts.element_bullets(F.col("elements"), lang)) for lang in LANGUAGES}, "same_image", "vlm_dual+translate", F.col("path").cast("string"))


def _read_slides(pages: DataFrame, service: models.Model, langs) -> DataFrame:
    rows = pages.where(predicates.min_total_chars(F.transform("lines", lambda x: x["text"]), 5)).withColumn("text", F.array_join(F.transform("lines", lambda x: x["text"]), "\n"))
    return models.described(rows, "image_path", {f"prompt_{lang}": prompts.REQUESTS[f"slide_{lang}"] for lang in langs}, service)


def slide_details(pages: DataFrame, service: models.Model = models.stub) -> DataFrame:
    """Samples of recognised slides (path, page, image_path, lines), described by a model; those with little text or no description go."""
    return samples(_read_slides(pages, service, ("zh",)), "details", T.stable_id0(F.col("path"), F.col("page")), F.col("text"), F.col("prompt_zh"), image=F.col("image_path"))


def slide_detail_pairs(pages: DataFrame, service: models.Model = models.stub) -> DataFrame:
    """Pairs of recognised slides, described in both languages; a failed translation of their text is empty."""
    rows = models.translated(_read_slides(pages, service, LANGUAGES), "text", "zh2en", "text_en", service)
    return paired(rows, "details", T.stable_id0(F.col("path"), F.col("page")), {"zh": F.col("text"), "en": F.coalesce("text_en", F.lit(""))}, {lang: F.col(f"prompt_{lang}") for lang in LANGUAGES}, "same_image", "vlm_dual", F.col("path").cast("string"))


def _scene_records(records: DataFrame, least: int) -> DataFrame:
    rows = records.withColumn("lines", layout.order_by_rows(F.col("lines")))
    rows = rows.where(predicates.min_total_chars(F.transform("lines", lambda x: x["text"]), least) & ~predicates.drop_image(F.col("classes")))
    return rows.withColumn("raw", F.array_join(F.transform("lines", lambda x: x["text"]), "\n"))


def scenes(records: DataFrame, seed: int, service: models.Model = models.stub, second: models.Model = models.stub, least: int = 10) -> DataFrame:
    """Samples of recognised scenes (topic, image_path, lines, classes): corrected texts, the longer of two descriptions, and whether those differ so much that a reviewer should look."""
    rows = _asked(_scene_records(records, least), "text", prompts.fill_request("correct", ocr=F.col("raw")), service)
    for name, model in (("first", service), ("second", second)):
        keys = rows.select(F.col("image_path")).distinct().withColumn("prompt", F.lit(prompts.REQUESTS["background"]))
        rows = rows.join(models.call_model(keys, "describe", model, name).select("image_path", F.coalesce(F.trim(name), F.lit("")).alias(name)), "image_path", "left")
    apart, caption = T.divergence(F.col("first"), F.col("second")), T.longer_of(F.col("first"), F.col("second"))
    id = T.stable_id0(F.col("topic"), F.col("image_path"))
    shown = F.coalesce(F.nullif(caption, F.lit("")), F.lit(SUBSETS["scenes"][3]))
    return samples(rows, "scenes", id, F.col("text"), prompts.caption(shown, F.col("text"), seed, id), caption, topic=F.col("topic"), divergence=apart, needs_human_review=predicates.needs_review(divergence=apart))


def scene_pairs(records: DataFrame, similarity: Column, service: models.Model = models.stub, least: int = 10) -> DataFrame:
    """Pairs of recognised scenes: texts routed by their language, descriptions in both, flagged where their similarity is low."""
    rows, sides = _routed(_scene_records(records, least), "raw", {}, service)
    rows = models.described(rows, "image_path", {"_scene_zh": prompts.REQUESTS["background"], "_scene_en": prompts.REQUESTS["background_en"]}, service)
    captions = {lang: F.col(f"_scene_{lang}") for lang in LANGUAGES}
    asked = {"zh": prompts.fill_template(prompts.TEMPLATES[0], captions["zh"], sides["zh"]), "en": F.concat(captions["en"], F.lit(prompts.EN_TEXT["scenes"]), sides["en"])}
    return paired(rows, "scenes", T.stable_id0(F.col("topic"), F.col("image_path")), sides, asked, "same_image", "vlm_dual+translate", F.col("image_path"), captions, similarity=similarity, shared=F.struct("topic"), review=predicates.needs_review(similarity=similarity))


def styled(attempts: DataFrame, per_topic: int, seed: int, rules: predicates.CharRules = predicates.CharRules()) -> DataFrame:
    """Samples of attempts (topic, ord, scene, text, box): of each topic's first 3 * per_topic attempts those with a box and a good text, per_topic at most."""
    good = F.col("box").isNotNull() & predicates.passes_text_quality(F.col("text"), rules)
    rows = sampling.budget(attempts.withColumn("_good", good), "topic", "ord", F.col("_good"), per_topic, 3).drop("_good")
    id = T.stable_id0(F.col("topic"), F.left("scene", F.lit(64)), F.left("text", F.lit(64)))
    return samples(rows, "styled", id, F.col("text"), prompts.caption(F.col("scene"), F.col("text"), seed, id), F.col("scene"), topic=F.col("topic"))


def styled_pairs(attempts: DataFrame, per_topic: int, seed: int, similarity: Column, rules: predicates.CharRules = predicates.CharRules()) -> DataFrame:
    """Pairs of attempts (topic, ord, scene_zh, scene_en, zh, en, box): as styled, with four attempts a pair and texts that are alike."""
    good = F.col("box").isNotNull() & predicates.passes_text_quality(F.col("zh"), rules) & (F.coalesce(similarity, F.lit(1.0)) >= 0.78)
    rows = sampling.budget(attempts.withColumn("_good", good).withColumn("_alike", similarity), "topic", "ord", F.col("_good"), per_topic, 4)
    id = T.stable_id0(F.lit("StyledText"), F.col("topic"), F.left("scene_en", F.lit(48)), F.left("en", F.lit(48)))
    asked = {"zh": prompts.caption(F.col("scene_zh"), F.col("zh"), seed, id), "en": F.concat(F.col("scene_en"), F.lit(prompts.EN_TEXT["styled"]), F.col("en"))}
    return paired(rows, "styled", id, {lang: F.col(lang) for lang in LANGUAGES}, asked, "shared_layout", "llm_translate", F.lit("model"), {lang: F.col(f"scene_{lang}") for lang in LANGUAGES}, similarity=F.col("_alike"), shared=F.struct("topic"))


def _page(article: Column, image: Column, title: Column, caption: Column, body: Column, images: Column, texts: Column, seed: int, id: Column) -> Column:
    """An article's page, or a grid of images in one or two rows, drawn by the seed."""
    rows = (F.floor(prompts.seeded_unit(seed, id) * 2) + 1).cast("int")
    return F.when(article, layout.article_page(image, title, caption, body)).otherwise(layout.image_page(images, texts, rows))


def blend(sources: DataFrame, seed: int, service: models.Model = models.stub) -> DataFrame:
    """Samples of page sources (id, type, image, title, caption, body, images, texts); each distinct image is captioned once."""
    id = T.stable_id0(F.col("id"), F.lit(seed))
    page = _page(F.col("type") == "wit", *[F.col(c) for c in ("image", "title", "caption", "body", "images", "texts")], seed, F.col("id"))
    rows = sources.select("id", "type", layout.annotations(page).alias("boxes"))
    pictures = rows.select(F.explode(F.filter("boxes", lambda b: b["kind"] == "image")).alias("b")).select(F.col("b.payload").alias("image_path")).distinct()
    answers = models.call_model(pictures.withColumn("prompt", F.lit(prompts.REQUESTS["background"])), "describe", service, "c")
    own = rows.select("id", F.posexplode("boxes").alias("place", "b")).join(answers.select("image_path", F.trim("c").alias("c")), F.col("b.payload") == F.col("image_path"), "left")
    captions = own.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("place", F.coalesce("c", F.lit("")).alias("c")))).alias("captions"))
    rows = rows.join(captions, "id", "left").withColumn("boxes", F.zip_with("boxes", F.coalesce("captions", F.array().cast("array<struct<place:int,c:string>>")), lambda b, c: b.withField("caption", c["c"])))
    text = F.array_join(F.transform(F.filter("boxes", lambda b: b["kind"] == "text"), lambda b: b["payload"]), "\n")
    return samples(rows, "blend", id, text, F.concat(F.lit(prompts.PAGE_ELEMENTS), prompts.bullets(F.col("boxes"))), type=F.col("type"), boxes=F.col("boxes"))


def blend_pairs(sources: DataFrame, seed: int) -> DataFrame:
    """Pairs of page sources (id, type, image, images and title, caption, body, texts in zh and en): an article has a page in each language, other pages share their boxes."""
    none = F.lit(None).cast("array<string>")

    def article(lang: str) -> Column:
        return layout.article_page(F.col("image"), *[F.col(f"{c}_{lang}") for c in ("title", "caption", "body")])

    wit = F.col("type") == "wit"
    rows = (F.floor(prompts.seeded_unit(seed, F.col("id")) * 2) + 1).cast("int")
    grid = layout.image_page(F.coalesce("images", none), F.coalesce("texts_zh", none), rows)
    boxes = {"zh": F.when(wit, article("zh")).otherwise(grid), "en": F.when(wit, article("en")).otherwise(pairs.replace_texts(grid, F.coalesce("texts_en", F.array().cast("array<string>"))))}
    paged = sources.select("id", *[layout.annotations(b).alias(f"boxes_{lang}") for lang, b in boxes.items()])
    texts = {lang: F.array_join(F.transform(F.filter(f"boxes_{lang}", lambda b: b["kind"] == "text"), lambda b: b["payload"]), "\n") for lang in LANGUAGES}
    asked = {lang: F.lit(prompts.BLEND_PAIR[lang]) for lang in LANGUAGES}
    return paired(paged, "blend", T.stable_id0(F.lit("blend"), F.col("id")), texts, asked, "shared_layout", "metadata_pair", F.col("id"), shared=F.struct("boxes_zh", "boxes_en"))
