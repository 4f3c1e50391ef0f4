"""Every subset's jobs on small rows."""

import random

import pytest
from pyspark.sql import functions as F

from glyphmill.functions import predicates
from glyphmill.plans import builders as B

HAN = "".join(chr(0x4E00 + 37 * i) for i in range(400))
LOOSE = predicates.CharRules(min_chinese_ratio=0.2, min_unique_ratio=0.05)


def service():
    """A service whose answers show what was asked; made here, so that workers get it by value."""

    def answer(requests):
        return [f" {r.get('direction') or r.get('image_path') or 'said'}:{(r.get('text') or r.get('prompt') or '')[:12]} " for r in requests]

    return answer


echo = service()


def han(n, at=0):
    return HAN[at : at + n]


@pytest.fixture(scope="module")
def texts(spark):
    rnd = random.Random(1)
    rows = [(f"c{i % 2}", i, han(rnd.randint(5, 300), i), "en words " * rnd.randint(2, 60)) for i in range(60)]
    return spark.createDataFrame(rows, "corpus string, id long, zh string, en string").withColumn("text", F.col("zh"))


@pytest.fixture(scope="module")
def records(spark):
    box = [(0.0, 0.0), (9.0, 0.0), (9.0, 5.0), (0.0, 5.0)]
    low = [(x, y + 40) for x, y in box]
    rows = [
        (0, "a", "img/a", "湖边", None, "lake", None, None, [(han(9, 20), low), (han(12), box), ("甲", box)], ["FACE"], "t1"),
        (1, "b", "img/b", None, None, None, None, "given", [("plain english words only", box)], None, "t2"),
        (2, "c", "img/c", None, None, None, None, None, [("甲", box)], [predicates.BANNED_CLASSES[0]], "t1"),
    ]
    point = "array<struct<x:double,y:double>>"
    return spark.createDataFrame(rows, f"line long, id string, image_path string, caption string, caption_zh string, caption_en string, ocr_text_zh string, ocr_text_en string, lines array<struct<text:string,points:{point}>>, classes array<string>, topic string")


def by_id(df, column):
    return {r[column]: r for r in df.collect()}


def test_clean(texts):
    weights = {"c0": 1.0, "c1": 2.0}
    single = B.clean_texts(texts, weights, ["宋体", "黑体"], 12, 7).collect()
    assert len(single) == 12 and len({r.sample_id for r in single}) == 12
    for r in single:
        assert len(r.rendered_text) <= r.metadata.length_bin and len(r.rendered_text) >= min(r.metadata.length_bin // 2, 32)
        assert r.prompt.endswith(f"字体写有：{r.rendered_text}") and r.image_path == f"{r.sample_id[:2]}/{r.sample_id}.png"
    both = B.clean_pairs(texts, weights, ["宋体"], ["Serif"], 5, 7).collect()
    assert 0 < len(both) <= 5
    for r in both:
        assert 0.3 <= len(r.zh.rendered_text) / len(r.en.rendered_text) <= 1.2 and r.alignment.bin_anchor in ("64", "128", "256", "512", "1024")
        assert (r.zh.sample_id, r.en.source_subset, r.parallelism) == (f"{r.pair_id}-zh", "CleanTextSynth-Parallel/en", "shared_layout")


def test_long_words(records):
    single = by_id(B.long_words(records, "Src", 3, rules=LOOSE), "image_path")
    assert sorted(single) == ["img/a"]
    assert single["img/a"].rendered_text == f"{han(12)}\n{han(9, 20)}" and single["img/a"].source_subset == "LongWordsSubset-CN-Src"
    assert single["img/a"].rendered_text in single["img/a"].prompt and "湖边" in single["img/a"].prompt
    assert by_id(B.long_words(records, "Src", 3, echo, LOOSE), "image_path")["img/a"].prompt.startswith("said:")
    both = B.long_words_pairs(records, "Src", echo, predicates.CharRules(min_unique_ratio=0.05)).collect()
    sides = sorted((r.zh.rendered_text, r.en.rendered_text) for r in both)
    assert sides == sorted([(f"{han(12)}\n{han(9, 20)}", f"zh2en:{han(12)}"), ("en2zh:plain englis", "plain english words only")])


def test_books(spark):
    rows = [(1, "http://a", "T", "A", None, "K", "2001", None, "9"), (2, "http://b", "U", None, "P", None, None, "blurb", "")]
    records = spark.createDataFrame(rows, "line long, cover_url string, title string, author string, publisher string, category string, year string, blurb string, isbn string")
    got = B.books(records, lambda requests: ["bytes" if r["url"] == "http://a" else None for r in requests]).collect()
    assert [(r.rendered_text, r.prompt) for r in got] == [("T A", "一本中文图书的封面，包含以下信息：T | 作者：A | 出版年：2001 | 类别：K")]
    names = [f"{n}_{lang}" for n in ("title", "author", "publisher", "category") for lang in ("zh", "en")]
    full = spark.createDataFrame([("9", "2001", "u", "v", "书", None, "人", "Writer", None, None, "类", ""), ("8", None, "u", "u", None, "Book", None, None, None, None, None, None)], ", ".join(f"{c} string" for c in ["isbn", "year", "cover_url_zh", "cover_url_en", *names]))
    pairs = {r.shared.isbn: r for r in B.book_pairs(full, echo).collect()}
    assert pairs["9"].en.rendered_text == "zh2en:书 Writer" and pairs["9"].parallelism == "shared_layout" and pairs["8"].zh.rendered_text == "en2zh:Book" and pairs["8"].parallelism == "same_image"
    assert pairs["9"].en.prompt == "Cover of an English-edition book with the following metadata: zh2en:书 | Author: Writer | Year: 2001 | Category: zh2en:类"


def test_pages(spark, records):
    span = "array<struct<font:string,size:double,text:string>>"
    pages = spark.createDataFrame([("p", 0, "一\n二", [("f", 9.25, "一"), ("f", 10.0, "二")]), ("p", 1, " \n", [])], f"path string, page int, text string, spans {span}")
    assert [r.prompt for r in B.papers(pages).where("prompt like '%第 1 页%'").collect()] == ["中文论文第 1 页，按字体和位置呈现的文字内容：\n- (f 9.2pt) 一\n- (f 10.0pt) 二"]
    assert [r.en.rendered_text for r in B.paper_pairs(pages, echo).collect()] == ["zh2en:一\n二"]
    elements = [("text", 0.04, 1.0, 2.0, 3.26, "字", "f", 9.0, None), ("image", 0.0, 0.0, 1.0, 1.0, None, None, None, "图")]
    slides = spark.createDataFrame([("s", 0, "字", elements)], "path string, page int, text string, elements array<struct<kind:string,x0:double,y0:double,x1:double,y1:double,text:string,font:string,size:double,caption:string>>")
    assert B.slides(slides).first().prompt == "请按照以下结构化要素生成一页中文幻灯片：\n- 文字（f 9.0pt @[0.0, 1.0, 2.0, 3.3]）: 字\n- 图片（@[0.0, 0.0, 1.0, 1.0]）: 图"
    assert B.slide_pairs(slides).first().en.prompt.endswith("- text (f 9.0pt @[0.0, 1.0, 2.0, 3.3]): 字\n- image (@[0.0, 0.0, 1.0, 1.0]): 图")
    read = records.select(F.lit("d").alias("path"), F.col("line").alias("page"), "image_path", "lines")
    assert sorted(r.image_path for r in B.slide_details(read, echo).collect()) == ["img/a", "img/b"]
    assert B.slide_detail_pairs(read, echo).count() == 2


def test_scenes_and_styles(spark, records):
    single = {r.metadata.topic: r for r in B.scenes(records, 1, echo, lambda requests: [""] * len(requests)).collect()}
    assert sorted(single) == ["t1", "t2"] and single["t1"].metadata.needs_human_review is True and single["t1"].scene_caption.startswith("img/a:")
    both = B.scene_pairs(records, F.when(F.col("topic") == "t1", 0.9).otherwise(0.1), echo).collect()
    assert {r.shared.topic: r.needs_human_review for r in both} == {"t1": False, "t2": True}
    rows = [("t", i, f"scene {i}", f"s {i}", han(20, i), "text", [0.0] if i != 1 else None, 0.5 if i == 2 else 0.9) for i in range(9)]
    attempts = spark.createDataFrame(rows, "topic string, ord int, scene_zh string, scene_en string, zh string, en string, box array<double>, sim double")
    picked = B.styled(attempts.withColumnsRenamed({"scene_zh": "scene", "zh": "text"}), 2, 5).collect()
    assert sorted(r.scene_caption for r in picked) == ["scene 0", "scene 2"]
    assert sorted(r.zh.scene_caption for r in B.styled_pairs(attempts, 2, 5, F.col("sim")).collect()) == ["scene 0", "scene 3"]


def test_blend(spark):
    rows = [("w", "wit", "a.png", "题", None, "正文" * 400, None, None), ("o", "obelics", None, None, None, None, ["b.png", "c.png", "a.png"], ["一", "二" * 300])]
    sources = spark.createDataFrame(rows, "id string, type string, image string, title string, caption string, body string, images array<string>, texts array<string>")
    got = {r.metadata.type: r for r in B.blend(sources, 4, echo).collect()}
    assert got["wit"].prompt.startswith("请生成一个交错图文页面，包含以下元素：\n- 文字（title@[48.0, 48.0, 976.0, 108.0]）: 题\n- 图片（@[48.0, 118.0, 976.0, 527.6]）: a.png:")
    assert len(got["wit"].rendered_text) == 2 + 600 and got["obelics"].rendered_text == "一"  # the gap pushes the second box over the margin
    pairs = sources.select("id", "type", "image", "images", *[F.col(c).alias(f"{c}_{lang}") for c in ("title", "caption", "body", "texts") for lang in ("zh", "en")])
    both = {r.zh.rendered_text[:1]: r for r in B.blend_pairs(pairs, 4).collect()}
    assert len(both) == 2 and all(r.zh.rendered_text == r.en.rendered_text for r in both.values())
    assert [(b.x, b.y, b.w, b.h) for b in both["一"].shared.boxes_zh] == [(b.x, b.y, b.w, b.h) for b in both["一"].shared.boxes_en]
