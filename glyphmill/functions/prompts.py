"""Prompts, captions and bullets as Column expressions."""

from __future__ import annotations

import re
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from glyphmill.functions.text import collapse_ends

#: Default caption templates; any list with the two placeholders serves.
TEMPLATES = ("{scene_caption}，图上的文字是「{rendered_text}」。", "画面为{scene_caption}，写有：{rendered_text}")

# The openings of prompts, and what stands for a missing caption.
OCR_JOINT = "。图中包含以下中文文字："
OCR_PLAIN = "生成一张包含清晰中文长文本的真实场景图片，文字内容包括："
CLEAN_BUILDER = "生成一张白色背景的中文长文本图片，图片中清晰排版以下文字："
PAGE_TEXT = "生成一页中文文档图片，保持版面结构、字体大小和文字位置。页面文字包括："
INTERLEAVED = "生成一张中文图文混排页面，白色背景，保持以下阅读顺序："
NO_CAPTION = "与正文相关的配图"
BOOK = {"zh": "一本中文图书的封面，包含以下信息：", "en": "Cover of an English-edition book with the following metadata: "}
BOOK_FIELDS = {"zh": {"author": "作者", "publisher": "出版社", "year": "出版年", "category": "类别", "blurb": "简介"}, "en": {"author": "Author", "publisher": "Publisher", "year": "Year", "category": "Category"}}
SLIDE = {"zh": "请按照以下结构化要素生成一页幻灯片：\n", "en": "Generate one slide that matches the following structured elements:\n"}
SLIDE_MONO = "请按照以下结构化要素生成一页中文幻灯片：\n"
PAGE_ELEMENTS = "请生成一个交错图文页面，包含以下元素：\n"
NO_IMAGE_CAPTION = "（图像，无字幕）"
CLEAN_FONT = {"zh": ("白底图像，使用", "字体写有："), "en": ("A clean white image rendered in ", " typeface, displaying: ")}
PAPER_PAGE = ("中文论文第 ", " 页，按字体和位置呈现的文字内容：\n")
PAPER_TRANSLATION = ("Page ", " of an academic paper rendered with the original font and position information. The rendered text on the image is in Chinese; the following English translation is provided for reference:\n")
EN_TEXT = {"words": " The image visibly displays: ", "scenes": " The image displays: ", "styled": " The image must clearly render: "}
BLEND_PAIR = {"zh": "请生成一个交错图文页面，包含以下中文文字与对应图像。", "en": "Generate an interleaved page that contains the following English text blocks and matching images."}

#: Requests to language models, with named placeholders; wordings of our own, to be replaced freely.
REQUESTS = {
    "scene": "用不超过160字的中文描写一个以{topic}为主体的场景：主体正对镜头，占画面三分之一以上，背景丰富，颜色统一，不出现任何文字。只写描写本身。",
    "scene_from_seed": "把下面的种子描写扩展成不超过160字的中文场景，保留其结构，补上镜头、光线和细节，不出现任何文字。种子：{seed}",
    "texts": "写{n}段有关{topic}的中文短文，每段{min_len}到{max_len}字，内容互不重复，按“1.…”逐条编号。",
    "text_for_image": "这是一张{topic}的图像。想一段适合它的文案，只返回含 title（6字以内）与 body（30到60字）的 JSON。",
    "unify": "把文字“{rendered_text}”自然地写进下面的场景描写里，写成一段中文。场景：{scene_caption}",
    "correct": "改正下面识别出的文字里的错字，改动尽量少，顺序不变：\n{ocr}",
    "background": "用80字以内的中文描写图像的背景与主体，不要重复图中的文字。",
    "background_en": "Describe background and main scene of the image in at most 80 English words, without repeating text in it.",
    "slide_zh": "把幻灯片里的全部文字和图形写成一段连贯的中文，文字不得遗漏。",
    "slide_en": "Describe all text and figures of the slide in one coherent English paragraph; leave no text out.",
}


def fill_request(name: str, **values: Column) -> Column:
    """A request with its placeholders replaced by columns; one without a value is an error."""
    parts = re.split(r"\{(\w+)\}", REQUESTS[name])
    return F.concat(*[values[p].cast("string") if i % 2 else F.lit(p) for i, p in enumerate(parts)])


def load_templates(path: str | None = None) -> tuple[str, ...]:
    """The caption templates of a text file, one a line without blank ones; the default ones without a file."""
    if path is None or not Path(path).exists():
        return TEMPLATES
    return tuple(line.strip() for line in Path(path).read_text(encoding="utf-8").splitlines() if line.strip())


def seeded_unit(seed: int, *keys: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the keys alone, the same in any engine with MD5."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in keys]).cast("binary"))
    return F.conv(F.left(digest, F.lit(12)), 16, 10).cast("double") / float(1 << 48)


def seeded_choice(seed: int, values: list, *keys: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.floor(seeded_unit(seed, *keys) * len(values)) + 1).cast("int"))


def fill_template(template: str, scene: Column, text: Column) -> Column:
    """Both placeholders filled in one pass, so braces inside the values stay; other placeholders make it `scene text`."""
    parts = re.split(r"(\{\w*\})", template)
    values = {"{scene_caption}": collapse_ends(scene), "{rendered_text}": collapse_ends(text)}
    if any(re.fullmatch(r"\{\w*\}", p) and p not in values for p in parts):
        return F.concat(scene, F.lit(" "), text)
    return F.concat(*[values.get(p, F.lit(p)) for p in parts])


def caption(scene: Column, text: Column, seed: int, key: Column, templates=TEMPLATES) -> Column:
    pick = (F.floor(seeded_unit(seed, key) * len(templates))).cast("int")
    out = fill_template(templates[0], scene, text)
    for i, t in enumerate(templates[1:], 1):
        out = F.when(pick == i, fill_template(t, scene, text)).otherwise(out)
    return out


def text_in_image_prompt(scene: Column, text: Column) -> Column:
    has = scene.isNotNull() & (F.trim(scene) != "")
    return F.when(has, F.concat(scene, F.lit(OCR_JOINT), text)).otherwise(F.concat(F.lit(OCR_PLAIN), text))


def clean_prompt(text: Column, font: Column | None = None, lang: str = "zh") -> Column:
    """The prompt of a text on a blank page, with the zh font's family or the en font's name if a font is given."""
    if font is None:
        return F.concat(F.lit(CLEAN_BUILDER), text)
    before, after = CLEAN_FONT[lang]
    return F.concat(F.lit(before), font, F.lit(after), text)


def book_prompt(title: Column, lang: str = "zh", **fields: Column) -> Column:
    """A lead sentence, the title and every known field (author, publisher, year, category, in zh also blurb) that is present, with its label."""
    labels, colon = BOOK_FIELDS[lang], "：" if lang == "zh" else ": "
    shown = [F.when(fields[k].isNotNull() & (fields[k] != ""), F.concat(F.lit(f"{labels[k]}{colon}"), fields[k])) for k in labels if k in fields]
    return F.concat(F.lit(BOOK[lang]), F.concat_ws(" | ", F.nullif(title, F.lit("")), *shown))


def present(*fields: Column) -> Column:
    return F.concat_ws(" ", *[F.nullif(f, F.lit("")) for f in fields])


def _lines(write, joint: str = "\n"):
    """A function that writes one line for each struct of an array, as a Column function."""

    @F.arrow_udf(StringType())
    def joined(lists: pa.Array) -> pa.Array:
        return pa.array([None if items is None else joint.join(write(x) for x in items) for items in lists.to_pylist()], pa.string())

    return joined


def bullets(boxes: Column) -> Column:
    """One line a box (kind, role, x, y, w, h, payload, caption): texts with their role, images with their caption or a note that there is none."""

    def line(b: dict) -> str:
        corners = [float(b["x"]), float(b["y"]), float(b["x"] + b["w"]), float(b["y"] + b["h"])]
        if b["kind"] == "image":
            return f"- 图片（@{corners}）: {b.get('caption') or NO_IMAGE_CAPTION}"
        return f"- 文字（{b['role'] or 'block'}@{corners}）: {b['payload']}"

    return _lines(line)(boxes)


def element_bullets(elements: Column, lang: str = "zh") -> Column:
    """One line an element of a slide (kind, x0, y0, x1, y1, text, font, size, caption), corners to one decimal."""
    text, image, open_, close = ("文字", "图片", "（", "）") if lang == "zh" else ("text", "image", " (", ")")

    def line(e: dict) -> str:
        corners = [round(float(e[c]), 1) for c in ("x0", "y0", "x1", "y1")]
        if e["kind"] == "image":
            return f"- {image}{open_}@{corners}{close}: {e['caption'] or ''}"
        return f"- {text}{open_}{e['font']} {float(e['size']):.1f}pt @{corners}{close}: {e['text']}"

    return _lines(line)(elements)


def span_lines(spans: Column) -> Column:
    """One line a span (font, size, text), the size to one decimal."""
    return _lines(lambda s: f"- ({s['font']} {float(s['size']):.1f}pt) {s['text']}")(spans)


def page_prompt(page: Column, spans: Column) -> Column:
    """The prompt of a paper's page, whose number counts from 0: its spans with font and size."""
    return F.concat(F.lit(PAPER_PAGE[0]), (page + 1).cast("string"), F.lit(PAPER_PAGE[1]), span_lines(spans))


def translated_page_prompt(page: Column, translation: Column) -> Column:
    return F.concat(F.lit(PAPER_TRANSLATION[0]), (page + 1).cast("string"), F.lit(PAPER_TRANSLATION[1]), translation)


def interleaved_prompt(blocks: Column, header: str = INTERLEAVED, default_caption: str = NO_CAPTION) -> Column:
    """A header and one line a block (kind, text): its text, or an image's caption."""
    lines = F.transform(blocks, lambda b: F.when(b["kind"] == "image", F.concat(F.lit("图片："), F.coalesce(F.nullif(b["text"], F.lit("")), F.lit(default_caption)))).otherwise(F.concat(F.lit("文字："), b["text"])))
    return F.array_join(F.concat(F.array(F.lit(header)), lines), "\n")


def scene_request(kind: Column, topic: Column, seed: Column) -> Column:
    """The request for a scene: from a seed for topics of that kind, else from the topic."""
    return F.when(scene_prompt_kind(kind) == "seed", fill_request("scene_from_seed", seed=seed)).otherwise(fill_request("scene", topic=topic))


def scene_prompt_kind(kind: Column) -> Column:
    return F.when(kind == "seed", "seed").otherwise("general")
