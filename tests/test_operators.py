import json
import os
import random
import statistics
import tarfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from glyphmill.functions import layout, prompts
from glyphmill.functions import text as T
from glyphmill.operators import dedup, lineage, models, pairs, sampling, stats
from glyphmill.plans import pipelines
from glyphmill.sources import config, readers, writers
from glyphmill.streaming import valid_text


def test_first_kept_is_greedy(spark):
    rnd = random.Random(3)
    edges = sorted({tuple(sorted(rnd.sample(range(40), 2))) for _ in range(60)})
    kept = []
    for b in range(40):
        if not any((a, b) in edges for a in kept):
            kept.append(b)
    nodes = spark.range(40).withColumnRenamed("id", "ord")
    got = dedup.first_kept(nodes, spark.createDataFrame(edges, "a long, b long"))
    assert sorted(r.ord for r in got.collect()) == kept


def test_first_kept_decides_long_chains(spark):
    chain = spark.range(104).withColumnRenamed("id", "ord")
    got = dedup.first_kept(chain, chain.where("ord > 0").select((F.col("ord") - 1).alias("a"), F.col("ord").alias("b")))
    assert sorted(r.ord for r in got.collect()) == list(range(0, 104, 2))
    few = dedup.first_kept(chain.where("ord < 7"), chain.where("ord between 1 and 6").select((F.col("ord") - 1).alias("a"), F.col("ord").alias("b")), local=0)
    assert sorted(r.ord for r in few.collect()) == [0, 2, 4, 6]


def test_ocr_near_copies_are_judged_whole(spark, tmp_path):
    from glyphmill.plans import registry

    rnd = random.Random(17)
    start, tails = ("".join(rnd.choice("aeiourstln") for _ in range(n)) for n in (60, 200))
    turns = [(1, 0, start + tails[:100]), (2, 0, start + tails[100:]), (3, 0, start + tails[:100])]
    spark.createDataFrame(turns, "conv_id long, turn int, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    assert sorted(r.conv_id for r in registry.ocr_filter_near(spark, str(tmp_path)).collect()) == [1, 2]


def test_lexical_edges_by_brute_force(spark):
    rnd = random.Random(5)
    base = [rnd.choice("abcdefgh") * 2 for _ in range(60)]
    texts = [" ".join(base[: 60 - i % 3] + ["x"] * (i % 4)) for i in range(12)] + ["one two", "", "one two"]
    sets = [Counter(" ".join(t.split()[i : i + 4]) for i in range(len(t.split()) - 3)) if len(t.split()) >= 4 else Counter(t.split()) for t in texts]
    expected = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if sets[i] and sets[j] and 10 * sum((sets[i] & sets[j]).values()) >= 9 * sum((sets[i] | sets[j]).values())}
    rows = spark.createDataFrame(list(enumerate(texts)), "ord long, text string")
    assert {(r.a, r.b) for r in dedup.lexical_edges(rows, "text", "ord").collect()} == expected
    kept = []
    for i, grams in enumerate(sets):
        if grams and not any((k, i) in expected for k in kept):
            kept.append(i)
    for rounds in (0, 1, 3):
        assert sorted(r.ord for r in dedup.near_dedup(rows, "text", "ord", rounds=rounds).collect()) == kept


def test_near_dedup_follows_a_chain(spark):
    """Each text is near to the next only: every second one stays."""
    words = [f"w{i}" for i in range(190)]
    rows = spark.createDataFrame([(i, " ".join(words[4 * i : 4 * i + 100])) for i in range(20)], "ord long, text string")
    assert sorted(r.ord for r in dedup.near_dedup(rows, "text", "ord").collect()) == list(range(0, 20, 2))


def test_an_image_that_ends_at_the_margin_is_placed(spark, tmp_path):
    """34 and 210 high, the second scaled from 283 to a last place more than 210: with the text between them they end at the margin."""
    from glyphmill.plans import registry

    spark.createDataFrame([(33, "x", 282), (33 + 1200, "x", 283)], "doc_id long, text string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.boxes, r.image_end) for r in registry.page_flows(spark, str(tmp_path)).collect()}
    assert 210.0 / 283 * 283 > 210
    assert got == {33: (3, 552.0), 1233: (3, 552.0)}


def test_frequent_grams_make_no_candidates(spark, monkeypatch):
    """Unrelated texts of few words share most n-grams; only near copies are compared whole, and all of them are found."""
    rnd = random.Random(9)
    texts = [" ".join(rnd.choice("abcd") for _ in range(rnd.randrange(200, 900))) for _ in range(120)]
    for text in texts[:20]:
        words = text.split()
        for _ in range(rnd.randrange(1, 9)):
            words[rnd.randrange(len(words))] = rnd.choice("abcd")
        texts.append(" ".join(words[rnd.randrange(4) :]))
    sets = [Counter(tuple(t.split()[i : i + 4]) for i in range(len(t.split()) - 3)) for t in texts]
    expected = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if 10 * sum((sets[i] & sets[j]).values()) >= 9 * sum((sets[i] | sets[j]).values())}
    compared, verified = [], dedup._verified

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(dedup, "_verified", counted)
    rows = spark.createDataFrame(list(enumerate(texts)), "ord long, text string")
    assert {(r.a, r.b) for r in dedup.lexical_edges(rows, "text", "ord").collect()} == expected and len(expected) > 10
    assert sum(compared) <= 100  # of 9,730
    compared.clear()
    assert {r.ord for r in dedup.near_dedup(rows, "text", "ord").collect()} == set(range(len(texts))) - {b for _, b in expected}
    assert sum(compared) <= 100  # of 9,730


def test_text_folder_orders_languages_and_rows(spark, tmp_path):
    """Rows that come in another order, languages that begin alike, a missing one, null texts."""
    import duckdb

    from glyphmill.plans import registry

    rows = [(i, ["zh", "zh-Hans", None, "en", "only null"][i % 5], None if i % 5 == 4 or i == 20 else f"text {i}") for i in reversed(range(60))]
    spark.createDataFrame(rows, "doc_id long, lang string, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    expected = sorted(con.execute(registry.ORACLES["text_folder"]).fetchall())
    assert sorted((r.place, r.text) for r in registry.QUERIES["text_folder"](spark, str(tmp_path)).collect()) == expected and len(expected) == 5


def test_hash_edges_and_two_sides(spark):
    rnd = random.Random(7)
    codes = [rnd.getrandbits(64) - 2**63 for _ in range(30)]
    codes += [c ^ (1 << rnd.randrange(62)) ^ (1 << rnd.randrange(62)) for c in codes[:9]] + [codes[0]]
    expected = {(i, j) for i in range(40) for j in range(i + 1, 40) if ((codes[i] ^ codes[j]) & (2**64 - 1)).bit_count() <= 6}
    rows = spark.createDataFrame(list(enumerate(codes)), "ord long, code long")
    assert {(r.a, r.b) for r in dedup.hash_edges(rows, "code", "ord").collect()} == expected
    distinct = rows.select("code").distinct()
    assert dedup.code_links(distinct, block=4).count() == dedup.code_links(distinct).count() == len({frozenset((codes[a], codes[b])) for a, b in expected if codes[a] != codes[b]})
    for distance, n in ((0, 10), (6, 100), (6, 10**9), (14, 10**4)):
        edges, keys = dedup.band_keys(distance, n)
        assert edges[0] == 0 and edges[-1] == 64 and len(keys) <= 128
    # the second row fails on its en side but has recorded its zh side
    sides = spark.createDataFrame([(0, 0, 0, 0), (0, 1, 1023 << 20, 0), (0, 2, 1023 << 20, 1023)], "run int, ord long, zh long, en long")
    assert [r.ord for r in dedup.two_sided_dedup(sides, "run", "ord", "zh", "en").collect()] == [0]


def test_layouts(spark):
    rows = spark.createDataFrame([([(5.0, 1.0), (1.0, 1.0), (0.0, 0.0)],)], "b array<struct<x0:double,y0:double>>")
    rows = rows.withColumn("b", F.transform("b", lambda b: b.withField("reading_order", F.lit(0))))
    assert [(b.x0, b.reading_order) for b in rows.select(layout.order_by_corner(F.col("b")).alias("b")).first().b] == [(0.0, 0), (1.0, 1), (5.0, 2)]
    flow = spark.createDataFrame([([("text", "a", 0.0, 0.0), ("image", "", 2000.0, 1000.0), ("text", "b", 0.0, 0.0)],)], "s array<struct<kind:string,text:string,w:double,h:double>>")
    boxes = flow.select(layout.page_flow(F.col("s"), 1000, 1000).alias("b")).first().b
    assert [round(b.h) for b in boxes] == [220, 350, 220] and boxes[1].y == 288.0 and [b.reading_order for b in boxes] == [0, 1, 2]
    lines = spark.createDataFrame([("one two three\n\nfour", "江河湖海"), ("abcdefgh ij", None)], "a string, b string")
    wrapped = lines.select(layout.wrap_lines(F.col("a"), 8, by_words=True).alias("w"), layout.wrap_lines(F.col("b"), 3).alias("c")).collect()
    assert [(r.w, r.c) for r in wrapped] == [(["one two", "three", "", "four"], ["江河湖", "海"]), (["abcdefgh", "ij"], None)]
    assert spark.range(1).select(layout.fit_font_size(F.lit(10), 100.0, 30.0).alias("s")).first().s == 13


def test_prompts(spark):
    got = spark.range(1).select(prompts.fill_template("{scene_caption}:{rendered_text}", F.lit(" {rendered_text} "), F.lit("x")).alias("a"), prompts.fill_template("{z}", F.lit("s"), F.lit("t")).alias("b")).first()
    assert (got.a, got.b) == ("{rendered_text}:x", "s t")
    with pytest.raises(KeyError):
        prompts.fill_request("scene_from_seed", topic=F.lit("x"))


def test_samples(spark):
    rows = spark.range(500).withColumn("bin", F.when(F.col("id") < 5, 64).otherwise(128))
    got = sampling.stratified_bins(rows, "bin", "id", 50, 1)
    assert {r.bin: r["count"] for r in got.groupBy("bin").count().collect()} == {64: 5, 128: 10}
    again = sampling.stratified_bins(rows.repartition(7), "bin", "id", 50, 1)
    assert sorted(got.collect()) == sorted(again.collect())
    mixed = sampling.weighted_mix(rows.withColumn("c", F.when(F.col("id") % 2 == 0, "a").otherwise("b")), "c", "id", {"a": 3.0, "b": 1.0}, 5, 100)
    assert 60 <= mixed.where("c = 'a'").count() <= 90


def test_pairs(spark):
    zipped = spark.range(1).select(pairs.zip_sections(F.array(F.lit("t"), F.lit("")), F.array(F.lit("i"))).alias("z")).first().z
    assert [(z.text, z.image) for z in zipped] == [("t", "i"), ("", None)]
    boxes = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit("old").alias("payload")) for k in ("text", "image", "text")])
    got = spark.range(1).select(pairs.replace_texts(boxes, F.array(F.lit("new"))).alias("b")).first().b
    assert [b.payload for b in got] == ["new", "old", ""]
    assert spark.range(1).select(pairs.parallelism(F.lit("a"), F.lit("b")).alias("m")).first().m == "shared_layout"


def test_models_are_asked_once(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "prompt string")
    got = models.call_once(rows, "chat").collect()
    assert len(got) == 4 and len({r.answer for r in got}) == 3

    def broken(requests):
        raise RuntimeError("down")

    assert models.call_model(rows, "chat", broken, attempts=2).where("answer is null").count() == 4


def test_filter_ocr_end_to_end(spark, tmp_path):
    lines = [
        {"image": "a.png", "ocr": [{"text": "林间小路铺满落叶", "box": [0, 20, 10, 30]}, {"transcription": "远处传来一阵阵钟声响", "points": [[0, 0], [10, 0], [10, 10], [0, 10]]}], "caption": "展会"},
        {"path": "b.png", "text_blocks": [{"label": "远处传来一阵阵钟声响", "bbox": [0, 0, 9, 9]}, {"text": "林间小路铺满落叶", "bbox": [0, 50, 9, 60]}]},
        {"image": "c.png", "annotations": [{"text": "短"}]},
        {"image": "d.png", "ocr": [{"text": "北方的冬天ＰＣ２０３０"}, {"label": "湖面结了厚厚的冰"}], "source": "x"},
        {"image": "e.png", "ocr": [{"text": "北方的冬天PC2030"}, {"label": "湖面结了厚厚的冰"}]},
    ]
    path = tmp_path / "in.jsonl"
    path.write_text("\n\n".join(json.dumps(x, ensure_ascii=False) for x in lines), encoding="utf-8")
    records = readers.ocr_records(spark, str(path)).drop("raw")
    got = pipelines.filter_ocr(records, "book").collect()
    got = {r.image_path: r for r in got}
    assert sorted(got) == ["a.png", "d.png"]  # e.png is d.png after NFKC
    assert got["a.png"].text == "远处传来一阵阵钟声响 林间小路铺满落叶"
    assert got["a.png"].prompt == "展会。图中包含以下中文文字：远处传来一阵阵钟声响 林间小路铺满落叶"
    assert got["d.png"].prompt == "生成一张包含清晰中文长文本的真实场景图片，文字内容包括：北方的冬天PC2030 湖面结了厚厚的冰"
    assert json.loads(got["d.png"].metadata) == {"image": "d.png", "source": "x"}
    assert got["a.png"].sample_id.startswith("real_zh_") and len(pipelines.filter_ocr(records, "book", deduplicate=False).collect()) == 4


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "t.jsonl").write_text('{"text": ""}\n{"caption": "a  b"}\n\n{"prompt": "c"}\n')
    assert [r.text for r in readers.texts(spark, str(tmp_path / "t.jsonl")).collect()] == ["a b", "c"]
    (tmp_path / "d.json").write_text('{"data": [{"x": 1}, {"x": 2}]}')
    assert readers.json_documents(spark, str(tmp_path / "d.json")).count() == 2
    rows = spark.range(25).withColumn("v", F.lit("字"))
    assert writers.write_shards(rows, str(tmp_path / "s"), "id", 10) == 25
    files = sorted(p for p in os.listdir(tmp_path / "s") if not p.startswith("."))
    assert files == ["part-00000.jsonl", "part-00001.jsonl", "part-00002.jsonl"]
    assert [json.loads(x)["id"] for x in (tmp_path / "s" / files[1]).read_text(encoding="utf-8").splitlines()] == list(range(10, 20))
    assert writers.write_shards(rows.limit(0), str(tmp_path / "none"), "id", 10) == 0 and (tmp_path / "none" / "part-00000.jsonl").read_bytes() == b""
    writers.write_shards(rows.where("id < 20"), str(tmp_path / "full"), "id", 10)
    assert (tmp_path / "full" / "part-00002.jsonl").read_bytes() == b""  # the next shard was opened
    (tmp_path / "pic.png").write_bytes(b"png")
    samples = spark.createDataFrame([("a", str(tmp_path / "pic.png")), ("b", "/nowhere.png")], "sample_id string, image_path string")
    assert writers.pack(samples, str(tmp_path / "tar"), "webdataset") == 2
    with tarfile.open(tmp_path / "tar" / "00000.tar") as tar:
        assert tar.getnames() == ["a.png", "a.json", "b.json"] and json.load(tar.extractfile("a.json"))["sample_id"] == "a"
    assert writers.write_jsonl(rows, str(tmp_path / "j")) == 25 and writers.pack(rows, str(tmp_path / "q"), "parquet") == 25
    with pytest.raises(Exception, match="MALFORMED|malformed|parse"):
        (tmp_path / "bad.jsonl").write_text("{no json")
        readers.json_lines(spark, str(tmp_path / "bad.jsonl"), strict=True).collect()
    (tmp_path / "b").mkdir()
    for name in "cab":
        (tmp_path / "b" / f"{name}.jsonl").write_text("".join(f'{{"text": "{name}{i}"}}\n' for i in range(3)))
    ordered = readers.texts(spark, str(tmp_path / "b") + "/*.jsonl").orderBy("line").collect()
    assert [r.text for r in ordered] == ["a0", "a1", "a2", "b0", "b1", "b2", "c0", "c1", "c2"]
    with pytest.raises(ValueError):
        writers.pack(rows, str(tmp_path / "p"), "zip")
    (tmp_path / "c.json").write_text('{"a": {"b": null}}')
    loaded = config.load_config(str(tmp_path / "c.json"))
    assert config.nested(loaded, "a.b", 1) is None and config.nested(loaded, "a.c", 1) == 1
    (tmp_path / "v.json").write_text('{"a": ["$GLYPH_X/${GLYPH_X}", "$GLYPH_NONE"], "corpora": [{"name": "n", "sampling_weight": 2}]}')
    os.environ["GLYPH_X"] = "x"
    assert config.load_config(str(tmp_path / "v.json"))["a"] == ["x/x", "$GLYPH_NONE"] and config.load_config(None) == {}
    registry = config.load_registry(str(tmp_path / "v.json"))
    assert pairs.registry_table(spark, registry).first().weight == 2.0
    with pytest.raises(KeyError):
        pairs.spec_of(registry, "m")
    (tmp_path / "f").mkdir()
    for name in ("zz-NotoSerif.ttf", "aa.OTF", "SimHei.ttc", "x.txt"):
        (tmp_path / "f" / name).write_bytes(b"")
    fonts = config.find_fonts(str(tmp_path / "f"), str(tmp_path / "f"), str(tmp_path / "missing"))
    assert [f.rsplit("/", 1)[1] for f in fonts] == ["SimHei.ttc", "zz-NotoSerif.ttf", "aa.OTF"]
    assert config.random_font([], random.Random(1)) is None and config.random_font(fonts, random.Random(1)) in fonts
    with pytest.raises(FileNotFoundError):
        config.require_fonts([])


def test_topics(spark):
    rows = [(i, (["ice", "snow", "frost"] if i % 2 else ["sun", "sand", "heat"]) * 4) for i in range(30)]
    model, placed = stats.topics(spark.createDataFrame(rows, "id long, units array<string>"), "units", k=2, vocabulary=10, iterations=15)
    best = {r.id: max(range(2), key=lambda t: r.topicDistribution[t]) for r in placed.collect()}
    assert len({best[i] for i in range(0, 30, 2)}) == len({best[i] for i in range(1, 30, 2)}) == 1 and best[0] != best[1]


def test_clean_texts_job(spark, tmp_path):
    from glyphmill.plans import cli

    (tmp_path / "t.txt").write_text("第一行 ＰＣ\n\n  第二行文字  \n第三行\n", encoding="utf-8")
    assert cli.main(["clean-text", "--input", str(tmp_path / "t.txt"), "--output", str(tmp_path / "out"), "--max-units", "3", "--limit", "2"]) == 2
    got = {r.text: r for r in spark.read.json(str(tmp_path / "out")).collect()}
    assert sorted(got) == ["第一行", "第二行"] and all(r.prompt.endswith(t) and r.sample_id.startswith("clean_zh_") and 24 <= r.font_size <= 56 for t, r in got.items())


def test_model_calls_drop_and_cache(spark):
    rows = spark.createDataFrame([("a", None), ("b", "x"), (None, "y")], "url string, other string")
    got = models.fetched(rows, "fetch", lambda requests: [None if r["url"] == "a" else r["url"] for r in requests])
    assert [(r.url, r.answer) for r in got.collect()] == [("b", "b")]
    both = models.described(rows.withColumn("image", F.col("url")), "image", {"p": "one", "q": "two"}, lambda requests: [f" {r['prompt']} " for r in requests])
    assert sorted((r.url, r.p, r.q) for r in both.collect()) == [("a", "one", "two"), ("b", "one", "two")]
    assert models.missing_files(rows.select(F.col("url").alias("file"), F.col("other").alias("url")), spark.createDataFrame([("a",)], "file string"), force=True).count() == 3


def test_running_sums_and_medians(spark):
    rnd = random.Random(6)
    rows = [(rnd.choice(["a", "b", None]), i, rnd.randint(0, 9), rnd.choice([None, rnd.random()])) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, i long, n long, x double")
    total, expected = Counter(), {}
    for g, i, n, _ in rows:
        total[g] += n
        expected[i] = total[g]
    assert {r.i: r.s for r in lineage.running(df, ["g"], ["i"], F.col("n"), "s").collect()} == expected
    got = {r.g: (r.median_n, r.median_x) for r in stats.medians(df, "g", "n", "x").collect()}
    for g in ("a", "b", None):
        values = [[v[k] for v in rows if v[0] == g and v[k] is not None] for k in (2, 3)]
        assert got[g] == tuple(statistics.median(v) for v in values)


def test_streaming(spark, tmp_path):
    (tmp_path / "in").mkdir()
    text = "one two three four five six seven eight nine ten eleven"
    rows = [{"id": i, "text": t, "at": "2024-01-01T00:00:00"} for i, t in enumerate([text, text, "short"])]
    (tmp_path / "in" / "a.json").write_text("\n".join(map(json.dumps, rows)))
    stream = valid_text.valid_texts(valid_text.read_texts(spark, str(tmp_path / "in")))
    q = stream.writeStream.format("memory").queryName("valid").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination(60)
    assert spark.table("valid").count() == 1


def test_eval_split_and_pages_jobs(spark, tmp_path):
    from glyphmill.plans import cli

    topics = ["sky", {"name": "sky"}, {"name": "sea"}, None]
    rows = [{"sample_id": f"s{i}", "source_subset": "scenes" if i < 7 else "other", "metadata": {"topic": topics[i % 4], "length_bin": 64}} for i in range(8)]
    (tmp_path / "s.jsonl").write_text("\n".join(map(json.dumps, rows)))
    read = {r.sample_id: (r.topic, r.bin) for r in readers.samples(spark, str(tmp_path / "s.jsonl")).collect()}
    assert [read[f"s{i}"] for i in range(4)] == [("sky", 64), ("sky", 64), ("sea", 64), (None, 64)]
    cli.main(["eval-split", "--scenes", str(tmp_path / "s.jsonl"), "--clean", str(tmp_path / "s.jsonl"), "--subset", "scenes", "--output", str(tmp_path / "split")])
    got = spark.read.json(str(tmp_path / "split"))
    assert got.where("eval_split = 'eval' and needs_human_review").count() == 14 and got.select("sample_id").distinct().count() == 7
    assert {r.t for r in got.selectExpr("raw.metadata.length_bin as t").collect()} == {64}
    pair = {"pair_id": "p", "source_subset": "TextScenesHQ-Parallel", "alignment": {"bin_anchor": ""}, "shared": {"topic": "sky"}, "zh": {"image_path": "z", "rendered_text": "r", "prompt": "q"}, "en": {"image_path": "e", "rendered_text": "r", "prompt": "q"}}
    (tmp_path / "p.jsonl").write_text(json.dumps(pair))
    assert cli.main(["eval-pairs", "--scenes", str(tmp_path / "p.jsonl"), "--output", str(tmp_path / "pairs")]) == 1
    assert spark.read.json(str(tmp_path / "pairs" / "zh")).first().lang == "zh" and spark.read.json(str(tmp_path / "pairs" / "review")).first().image_en == "e"
    document = {"id": "d", "texts": ["第一段文字", "第二段"], "images": [{"path": "a.png", "caption": "湖面", "w": 2000, "h": 500}]}
    (tmp_path / "d.jsonl").write_text(json.dumps(document))
    assert cli.main(["interleave", "--input", str(tmp_path / "d.jsonl"), "--output", str(tmp_path / "inter"), "--limit", "1"]) == 1
    page = spark.read.json(str(tmp_path / "inter")).first()
    assert page.prompt == "生成一张中文图文混排页面，白色背景，保持以下阅读顺序：\n图片：湖面\n文字：第一段文字\n文字：第二段" and [b.kind for b in page.boxes] == ["image", "text", "text"]
    (tmp_path / "e.jsonl").write_text(json.dumps({"path": "s", "page": 0, "ord": 0, "kind": "text", "x0": 0, "y0": 0, "x1": 1, "y1": 1, "text": "t", "font": "f", "size": 9}))
    assert cli.main(["build", "slides", "--pairs", "--input", str(tmp_path / "e.jsonl"), "--output", str(tmp_path / "slides")]) == 1
    assert spark.read.json(str(tmp_path / "slides" / "en")).first().prompt.endswith("- text (f 9.0pt @[0.0, 0.0, 1.0, 1.0]): t")
    with pytest.raises(SystemExit):
        cli.main(["build", "papers", "--pairs", "--input", "x", "--output", "y"])
    spans = [{"path": "a", "page": p, "x0": x, "y0": 1.0, "x1": 2.0, "y1": 2.0, "text": t, "font": "f", "size": 9.0, "color": 255} for p, x, t in ((0, 5.0, "b"), (0, 1.0, "a"), (1, 0.0, "c"), (0, 0.0, ""))]
    (tmp_path / "spans.jsonl").write_text("\n".join(map(json.dumps, spans)))
    cli.main(["pages", "--input", str(tmp_path / "spans.jsonl"), "--output", str(tmp_path / "pages"), "--max-pages", "1"])
    assert [r.text for r in spark.read.json(str(tmp_path / "pages")).collect()] == ["ab"]
