"""Queries over gates, requests, model boundaries, prompts and whole samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from glyphmill.functions import bins, layout, predicates, prompts
from glyphmill.functions import text as T
from glyphmill.operators import models, pairs, sampling, stats
from glyphmill.operators.dedup import once_per_key
from glyphmill.plans import pipelines
from glyphmill.plans.catalog import COLLAPSED, DECIDED_PAIRS, SEED, UNIT, docs, pair_rows, query, table


@query("SELECT doc_id, len(text) AS tokens FROM documents")
def token_estimates(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", T.token_estimate(F.col("text")).cast("long").alias("tokens"))


@query("SELECT doc_id, md5(CASE doc_id % 3 WHEN 0 THEN source || chr(10) || text WHEN 1 THEN chr(10) || text ELSE '{' || source END) AS answer FROM documents")
def json_answers(spark, sf_dir):
    """Fenced JSON answers with a title and a body or only a body, and answers that are no JSON."""
    whole = F.to_json(F.struct(F.col("source").alias("title"), F.col("text").alias("body")))
    fenced = F.concat(F.lit("```json\n"), whole, F.lit("\n```"))
    body = F.to_json(F.struct(F.col("text").alias("body")))
    answer = F.when(F.col("doc_id") % 3 == 0, fenced).when(F.col("doc_id") % 3 == 1, body).otherwise(F.concat(F.lit("{"), F.col("source")))
    return docs(spark, sf_dir).select("doc_id", F.md5(T.title_and_body(answer)).alias("answer"))


@query(r"""WITH t AS (SELECT item_id, list_filter(string_split(trim(regexp_replace(text, '\s+', ' ', 'g')), ' '), lambda w: w <> '') AS truth, list_filter(string_split(trim(regexp_replace(replace(regexp_replace(text, '[aeiou]', 'x', 'g'), 'th', ' '), '\s+', ' ', 'g')), ' '), lambda w: w <> '') AS found FROM benchmark),
 x AS (SELECT item_id, unnest(truth) AS w, generate_subscripts(truth, 1) AS i, found, len(truth) AS n FROM t), y AS (SELECT item_id, unnest(found) AS o, generate_subscripts(found, 1) AS i, truth, len(found) AS n FROM t),
 a AS (SELECT item_id, count(*) FILTER (WHERE len(list_filter(found, lambda o: levenshtein(w, o) <= 0.2 * greatest(len(w), len(o)))) > 0)::DOUBLE / count(*) AS a FROM x GROUP BY item_id),
 p AS (SELECT item_id, count(*) FILTER (WHERE len(list_filter(truth, lambda w: levenshtein(o, w) <= 0.2 * greatest(len(w), len(o)))) > 0)::DOUBLE / count(*) AS p FROM y GROUP BY item_id)
SELECT item_id, round(a, 6) AS accuracy, round(CASE WHEN a + p > 0 THEN 2 * a * p / (a + p) ELSE 0 END, 6) AS f1 FROM a JOIN p USING (item_id)""")
def ocr_scores(spark, sf_dir):
    """Words of a noisy reading against the truth, at a fifth of a word's length of edits."""
    noisy = F.replace(F.regexp_replace("text", "[aeiou]", "x"), F.lit("th"), F.lit(" "))
    rows = table(spark, sf_dir, "benchmark").select("item_id", T.word_scores(noisy, F.col("text"), 0.2).alias("s"))
    return rows.select("item_id", F.round("s.accuracy", 6).alias("accuracy"), F.round("s.f1", 6).alias("f1"))


@query("SELECT a.doc_id, md5(CASE WHEN len(a.text) >= len(b.text) THEN a.text ELSE b.text END) AS caption FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1")
def longer_captions(spark, sf_dir):
    d = docs(spark, sf_dir).select("doc_id", "text")
    both = d.alias("a").join(d.alias("b"), F.col("b.doc_id") == F.col("a.doc_id") + 1)
    return both.select("a.doc_id", F.md5(T.longer_of(F.col("a.text"), F.col("b.text"))).alias("caption"))


@query("""SELECT conv_id, sum(len(text))::BIGINT AS chars, sum(len(text)) >= 400 AS scene, sum(len(text)) >= 5 AS slide, bool_or(trim(replace(text, chr(10), ' ')) <> '') AS filled, count(*) FILTER (WHERE turn > 3) > 0 AS has_items FROM conversations GROUP BY conv_id""")
def record_gates(spark, sf_dir):
    """Characters of all lines, and the gates on them; the scene's bound is raised so that some fail."""
    r = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_list("text").alias("t"), F.collect_list(F.when(F.col("turn") > 3, F.col("turn"))).alias("late"))
    t = F.col("t")
    return r.select("conv_id", predicates.total_chars(t).cast("long").alias("chars"), predicates.min_total_chars(t, 400).alias("scene"), predicates.min_total_chars(t, 5).alias("slide"), predicates.not_blank(F.array_join(t, "\n")).alias("filled"), predicates.has_items(F.col("late")).alias("has_items"))


@query("SELECT doc_id, coalesce(toxic, 0) = 1 AS dropped FROM documents LEFT JOIN labels USING (doc_id)")
def image_gate(spark, sf_dir):
    """Images whose detector found a banned class; those without an answer stay."""
    rows = docs(spark, sf_dir).select("doc_id").join(table(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id", "left")
    classes = F.when(F.col("toxic").isNotNull(), F.when(F.col("toxic") == 1, F.array(F.lit("FACE"), F.lit(predicates.BANNED_CLASSES[0]))).otherwise(F.array(F.lit("FACE"))))
    return rows.select("doc_id", predicates.drop_image(classes).alias("dropped"))


@query("""WITH p AS (SELECT doc_id, n_chars % 50 + 0.4::DOUBLE AS x, n_chars % 30 + 0.2::DOUBLE AS y, doc_id % 4 AS tilt FROM documents)
SELECT doc_id, round(x, 6) AS x0, round(y, 6) AS y0, round(x + 100 + tilt, 6) AS x1, round(y + 18 + tilt, 6) AS y1, tilt = 0 AS axis_aligned FROM p""")
def tilted_boxes(spark, sf_dir):
    """Four corners, some of them moved so that the box is tilted."""
    x, y, tilt = F.col("n_chars") % 50 + 0.4, F.col("n_chars") % 30 + 0.2, F.col("doc_id") % 4
    corners = F.array(*[F.struct((x + dx).cast("double").alias("x"), (y + dy).cast("double").alias("y")) for dx, dy in ((F.lit(0), F.lit(0)), (F.lit(100), tilt), (100 + tilt, 18 + tilt), (tilt, F.lit(18)))])
    rows = docs(spark, sf_dir).select("doc_id", layout.polygon_box(corners).alias("b"), predicates.axis_aligned(corners).alias("axis_aligned"))
    return rows.select("doc_id", *[F.round(F.col(f"b.{c}"), 6).alias(c) for c in ("x0", "y0", "x1", "y1")], "axis_aligned")


@query("SELECT doc_id, upper(source) AS caption FROM documents")
def captions_by_source(spark, sf_dir):
    """One call a distinct source, joined back."""
    return once_per_key(docs(spark, sf_dir).select("doc_id", "source"), "source", lambda keys: keys.withColumn("caption", F.upper("source")), "caption").select("doc_id", "caption")


@query("SELECT doc_id, CASE WHEN lang IN ('en', 'fr') THEN 'cached ' || lang ELSE 'asked ' || lang END AS answer FROM documents")
def cached_answers(spark, sf_dir):
    """Answers from a cache where it has the request, else asked."""
    rows = docs(spark, sf_dir).select("doc_id", F.col("lang").alias("prompt"))
    cache = spark.createDataFrame([("en",), ("fr",)], "prompt string").select(models.request_key("prompt").alias("_request"), F.concat(F.lit("cached "), F.col("prompt")).alias("answer"))
    return models.call_once(rows, "chat", lambda requests: [f"asked {r['prompt']}" for r in requests], cache=cache).select("doc_id", "answer")


@query("""SELECT conv_id, string_agg(CASE WHEN turn % 2 = 0 THEN 't' ELSE 'i' END || turn, ',' ORDER BY CASE WHEN turn % 5 = 4 THEN 0 ELSE turn * 3 % 7 END, turn % 2, turn) AS blocks FROM conversations GROUP BY conv_id""")
def mixed_order(spark, sf_dir):
    """Text and image blocks by their reading order; a missing one counts as 0."""
    block = F.struct("turn", F.when(F.col("turn") % 5 != 4, (F.col("turn") * 3 % 7).cast("int")).alias("reading_order"), F.concat(F.when(F.col("turn") % 2 == 0, "t").otherwise("i"), F.col("turn").cast("string")).alias("name"))
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(block)).alias("b"))
    def side(odd):
        return F.filter("b", lambda b: b["turn"] % 2 == odd)

    return rows.select("conv_id", F.array_join(F.transform(layout.order_mixed(side(0), side(1)), lambda b: b["name"]), ",").alias("blocks"))


@query(f"""{DECIDED_PAIRS}, w AS (SELECT pair_id, 'c' || (pair_id % 3) AS corpus, -ln(1.0 - {UNIT.format(SEED, 'pair_id')}) / CASE pair_id % 3 WHEN 0 THEN 0.5 WHEN 1 THEN 0.3 ELSE 0.2 END AS gap FROM k WHERE en_chars > 0 AND zh_chars > 0 AND zh_chars::DOUBLE / en_chars BETWEEN 0.3 AND 1.2),
 a AS (SELECT pair_id, corpus, sum(gap) OVER (PARTITION BY corpus ORDER BY md5('{SEED + 1}:' || pair_id), pair_id ROWS UNBOUNDED PRECEDING) AS arrival FROM w)
SELECT pair_id, corpus, round(arrival, 6) AS arrival FROM a ORDER BY a.arrival, pair_id LIMIT 40""")
def mixed_pairs(spark, sf_dir):
    rows = pair_rows(spark, sf_dir).where("en is not null and zh is not null").withColumn("corpus", F.concat(F.lit("c"), (F.col("pair_id") % 3).cast("string")))
    mixed = sampling.mixed_pairs(rows, "corpus", "pair_id", "en", "zh", {"c0": 0.5, "c1": 0.3, "c2": 0.2}, SEED, 40)
    return mixed.select("pair_id", "corpus", F.round("arrival", 6).alias("arrival"))


@query(f"""{DECIDED_PAIRS}, d AS (SELECT pair_id, bin, 'topic' || (pair_id % 7) AS topic, CASE WHEN pair_id % 2 = 0 THEN 'X-Parallel' ELSE 'Y-Parallel' END AS s FROM k),
 c AS (SELECT pair_id FROM (SELECT pair_id, row_number() OVER (PARTITION BY bin ORDER BY md5('{SEED}:' || pair_id), pair_id) AS n FROM d WHERE s = 'X-Parallel') WHERE n <= 4),
 ranked AS (SELECT pair_id, row_number() OVER (PARTITION BY topic ORDER BY md5('{SEED}:' || pair_id), pair_id) AS n, (SELECT count(DISTINCT topic) FROM d WHERE s = 'Y-Parallel') AS k FROM d WHERE s = 'Y-Parallel'),
 t AS (SELECT pair_id FROM (SELECT pair_id, row_number() OVER (ORDER BY md5('{SEED + 1}:' || pair_id), pair_id) AS t FROM ranked WHERE n <= greatest(1, 15 // k)) WHERE t <= 15)
SELECT pair_id, 'X-Parallel' AS subset, 'img-zh' AS image_zh FROM c UNION ALL SELECT pair_id, 'Y-Parallel', 'img-zh' FROM t""")
def pair_eval_splits(spark, sf_dir):
    """Pairs by their anchor's bin and by their shared topic, as a reviewer sees them."""
    rows = pair_rows(spark, sf_dir).where("en is not null and zh is not null").withColumn("d", bins.decide_pair(F.col("en"), F.col("zh")))
    side = F.struct(F.lit("img-zh").alias("image_path"), F.lit("r").alias("rendered_text"), F.lit("p").alias("prompt"))
    rows = rows.select("pair_id", F.when(F.col("pair_id") % 2 == 0, "X-Parallel").otherwise("Y-Parallel").alias("source_subset"), F.struct(F.col("d.bin").cast("string").alias("bin_anchor")).alias("alignment"),
                       F.struct(F.struct(F.concat(F.lit("topic"), (F.col("pair_id") % 7).cast("string")).alias("name")).alias("topic")).alias("shared"), side.alias("zh"), side.alias("en"))
    plan = {"clean": ("X-Parallel", "bin", 20), "styled": ("Y-Parallel", "topic", 15)}
    picked = sampling.pair_eval_split({"clean": rows, "styled": rows, "other": rows}, SEED, plan)
    return sampling.pair_review(picked).select("pair_id", "subset", "image_zh")


@query(f"""WITH s AS (SELECT n_chars::DOUBLE AS v FROM documents ORDER BY md5('{SEED}:' || doc_id), doc_id LIMIT 150)
SELECT (CASE WHEN v < 0 THEN 0 WHEN v >= 10000 THEN 11 ELSE floor(v / 1000) + 1 END)::BIGINT AS bucket, count(*) AS n, (SELECT round(avg(v), 4) FROM s) AS mean, (SELECT round(stddev_pop(v), 4) FROM s) AS deviation FROM s GROUP BY 1""")
def sampled_scores(spark, sf_dir):
    rows = docs(spark, sf_dir).select("doc_id", F.col("n_chars").cast("double").alias("score"))
    found = stats.sampled_scores(rows, "doc_id", "score", 150, SEED, 0.0, 10000.0, 10)
    return found.select("bucket", "n", F.round("mean", 4).alias("mean"), F.round("deviation", 4).alias("deviation"))


@query("""SELECT doc_id, '生成一张白色背景的中文长文本图片，图片中清晰排版以下文字：' || lang AS builder, '白底图像，使用' || source || '字体写有：' || lang AS zh, 'A clean white image rendered in ' || source || ' typeface, displaying: ' || lang AS en FROM documents""")
def clean_prompts(spark, sf_dir):
    lang, font = F.col("lang"), F.col("source")
    return docs(spark, sf_dir).select("doc_id", prompts.clean_prompt(lang).alias("builder"), prompts.clean_prompt(lang, font).alias("zh"), prompts.clean_prompt(lang, font, "en").alias("en"))


@query("""SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'seed:' || lang WHEN 1 THEN 'general:' || source ELSE 'general:' || source END AS request FROM documents""")
def scene_requests(spark, sf_dir):
    """Requests from a seed or from the topic; a template topic counts as a general one."""
    kind = F.when(F.col("doc_id") % 3 == 0, "seed").when(F.col("doc_id") % 3 == 1, "general").otherwise("template")
    request = prompts.scene_request(kind, F.col("source"), F.col("lang"))
    seed, topic = (prompts.REQUESTS[n].split("{")[0] for n in ("scene_from_seed", "scene"))
    head = F.when(request.startswith(seed), F.concat(F.lit("seed:"), F.element_at(F.split(request, "种子："), -1))).otherwise(F.concat(F.lit("general:"), F.element_at(F.split(F.element_at(F.split(request, "描写一个以"), -1), "为主体"), 1)))
    return docs(spark, sf_dir).select("doc_id", head.alias("request"))


@query("SELECT k AS kind, count(*) AS asked, count(DISTINCT lang) AS answers FROM documents, (VALUES ('chat'), ('translate'), ('image'), ('ocr'), ('detect'), ('render'), ('quality'), ('page_image')) t(k) GROUP BY k")
def model_kinds(spark, sf_dir):
    """Every kind of model boundary, asked with the deterministic stub: answers depend on the request alone."""
    rows, out = docs(spark, sf_dir).select("lang"), None
    for kind in ("chat", "translate", "image", "ocr", "detect", "render", "quality", "page_image"):
        columns = {c: F.col("lang") for c in models.CONTRACTS[kind]}
        got = models.call_model(rows.withColumns(columns), kind).agg(F.lit(kind).alias("kind"), F.count("answer").alias("asked"), F.count_distinct("answer").alias("answers"))
        out = got if out is None else out.unionByName(got)
    return out


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN source ELSE 'zh2en:' || lang END AS en, 'zh2en:en2zh:' || source AS back FROM documents")
def translations(spark, sf_dir):
    """A missing side is translated, a given one stays; and a text there and back again."""
    def service(requests):
        return [f" {r['direction']}:{r['text']} " for r in requests]

    rows = docs(spark, sf_dir).select("doc_id", "lang", "source")
    rows = models.back_translated(models.translated(rows, "lang", "zh2en", "answer", service), "source", model=service)
    return rows.select("doc_id", pairs.fill_side(F.when(F.col("doc_id") % 3 == 0, F.col("source")), F.col("answer")).alias("en"), "back")


@query("SELECT vec_id, CASE WHEN vec_id % 4 = 0 THEN 0.0 ELSE round(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]), 6) END AS similarity FROM embeddings")
def blank_similarity(spark, sf_dir):
    """A blank text is like nothing."""
    rows = table(spark, sf_dir, "embeddings")
    text = F.when(F.col("vec_id") % 4 == 0, " \n").otherwise("a")
    return rows.select("vec_id", F.round(predicates.cross_similarity(text, F.lit("b"), F.col("embedding"), F.col("embedding")), 6).alias("similarity"))


@query("SELECT page_id, 'zh:' || page_id AS zh, 'en:' || page_id AS en FROM pages WHERE page_id % 4 <> 0 AND page_id % 5 <> 0")
def slide_descriptions(spark, sf_dir):
    """Slides described in both languages; one empty or failed answer drops the slide."""
    def service(requests):
        out = []
        for r in requests:
            n, zh = int(r["image_path"]), r["prompt"] == prompts.REQUESTS["slide_zh"]
            out.append(None if n % 4 == 0 and zh else " " if n % 5 == 0 and not zh else f"{'zh' if zh else 'en'}:{n}")
        return out

    rows = table(spark, sf_dir, "pages").select("page_id", F.col("page_id").cast("string").alias("image"))
    return models.described(rows, "image", {"zh": prompts.REQUESTS["slide_zh"], "en": prompts.REQUESTS["slide_en"]}, service).select("page_id", "zh", "en")


@query(f"""WITH d AS (SELECT doc_id, source, md5({COLLAPSED.format('text')}) AS m FROM documents) SELECT doc_id, 's' || doc_id AS id, CASE doc_id % 3 WHEN 0 THEN 'text,image' WHEN 1 THEN 'title,text' ELSE 'text' END AS kinds, m AS text FROM d""")
def normalized_documents(spark, sf_dir):
    """Documents in three forms: a single text with images, a title with items, and sections."""
    from glyphmill.operators.lineage import scratch
    from glyphmill.sources import readers

    path, n, id = scratch(spark, "documents") + ".jsonl", F.col("doc_id") % 3, F.concat(F.lit("s"), F.col("doc_id").cast("string"))
    d = docs(spark, sf_dir).select(id.alias("id"), F.when(n == 0, F.col("text")).alias("texts"), F.when(n == 0, F.array(F.lit(""), F.lit("a.png"))).alias("images"), F.when(n == 1, F.col("source")).alias("title"),
                                   F.when(n == 1, F.array(F.struct(F.lit("text").alias("kind"), F.col("text").alias("text")))).alias("items"), F.when(n == 2, F.array(F.struct(F.col("text").alias("text")))).alias("sections"))
    d.write.json(path)
    rows = readers.documents(spark, path)
    # an empty image path gives no image
    kinds = F.transform("sections", lambda s: F.coalesce(F.when(s["kind"] == "title", "title"), F.when(s["text"].isNotNull(), "text"), F.when(s["image"].isNotNull(), "image")))
    body = F.element_at(F.filter("sections", lambda s: s["text"].isNotNull() & (F.coalesce(s["kind"], F.lit("")) != "title")), 1)["text"]
    return rows.select(F.substring("id", 2, 20).cast("long").alias("doc_id"), "id", F.array_join(F.filter(kinds, lambda k: k.isNotNull()), ",").alias("kinds"), F.md5(T.normalize_text(body)).alias("text"))


@query(f"""WITH s AS (SELECT doc_id, {COLLAPSED.format('source')} AS t, least(1.0::DOUBLE, 928.0::DOUBLE / (n_chars % 900 + 1), 358.4::DOUBLE / (doc_id % 400 + 1)) AS scale, n_chars % 900 + 1 AS w, doc_id % 400 + 1 AS h, lang FROM documents),
 p AS (SELECT doc_id, t, lang, 48 + h * scale + 20 AS y FROM s)
SELECT doc_id, 2 AS boxes, round(y, 4) AS text_y, '生成一张中文图文混排页面，白色背景，保持以下阅读顺序：' || chr(10) || '图片：' || CASE WHEN doc_id % 2 = 0 THEN lang ELSE '与正文相关的配图' END || chr(10) || '文字：' || t AS prompt FROM p""")
def interleaved_pages(spark, sf_dir):
    """Pages of one section with an image and a text."""
    section = F.struct(F.lit(None).cast("string").alias("kind"), F.col("source").alias("text"), F.lit("a.png").alias("image"), F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("caption"), (F.col("n_chars") % 900 + 1).cast("double").alias("w"), (F.col("doc_id") % 400 + 1).cast("double").alias("h"))
    pages = pipelines.interleaved_pages(docs(spark, sf_dir).select(F.col("doc_id").cast("string").alias("id"), F.array(section).alias("sections")), SEED)
    inside = F.forall("boxes", lambda b: (b["x"] >= 48) & (b["x"] + b["w"] <= 976.5) & (b["y"] + b["h"] <= 976))
    return pages.select(F.col("source_id").cast("long").alias("doc_id"), F.when(inside, F.size("boxes")).alias("boxes"), F.round(F.get("boxes", F.lit(1))["y"], 4).alias("text_y"), "prompt")


@query("""WITH b AS (SELECT doc_id, doc_id % 2 = 0 AS img, doc_id % 3 = 0 AS title FROM documents) SELECT doc_id, concat_ws(',', CASE WHEN title THEN 'title' END, CASE WHEN img THEN 'figure' END, 'main') AS shown FROM b""")
def page_annotations(spark, sf_dir):
    """What a page shows: boxes with a payload, and images that can be read."""
    page = layout.article_page(F.when(F.col("doc_id") % 2 == 0, "a.png").otherwise("broken.png"), F.when(F.col("doc_id") % 3 == 0, "t"), F.lit(""), F.col("text"))
    shown = layout.annotations(page, F.array(F.lit("a.png")))
    return docs(spark, sf_dir).select("doc_id", F.array_join(F.transform(shown, lambda b: b["role"]), ",").alias("shown"))


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN source || '|' || lang ELSE '' END AS pairs, CASE WHEN doc_id % 4 = 1 THEN '' ELSE source || ',' || lang END AS pool FROM documents")
def text_pools(spark, sf_dir):
    """Answers with a JSON list of pairs, of which incomplete ones go, and with a numbered list; topics whose texts come from images have no pool."""
    source, lang = F.col("source"), F.col("lang")
    whole = F.to_json(F.array(F.struct(source.alias("zh"), lang.alias("en")), F.struct(F.lit("").alias("zh"), lang.alias("en"))))
    answer = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("```json\n"), whole, F.lit("```"))).otherwise("none")
    numbered = F.concat(F.lit("1. "), source, F.lit("\n2."), lang)
    pool = pairs.text_pool(numbered, F.when(F.col("doc_id") % 4 == 1, "vlm").otherwise("llm"))
    found = F.transform(pairs.answered_pairs(answer), lambda p: F.concat(p["zh"], F.lit("|"), p["en"]))
    return docs(spark, sf_dir).select("doc_id", F.array_join(found, ",").alias("pairs"), F.array_join(pool, ",").alias("pool"))
