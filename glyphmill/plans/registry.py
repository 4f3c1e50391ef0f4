"""Queries over the driver's tables and their DuckDB oracles: texts, deduplication, sampling, pairs and layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from glyphmill.functions import bins, layout, predicates, prompts
from glyphmill.functions import text as T
from glyphmill.operators import dedup, models, pairs, sampling, stats
from glyphmill.plans import pipelines, sample_queries, scan_queries
from glyphmill.plans.catalog import (
    BARE, BIN, CAP, CJK, CLEAN, COLLAPSED, DECIDED_PAIRS, FROM, ORACLES, PAIRS, QUERIES, SEED, STRIPPED, TO, UNIT, ZH, docs, gram_edges, greedy, pair_rows, query, table, units, wide_docs, widened, zh_docs,
)
from glyphmill.sources import readers, writers

__all__ = ["ORACLES", "QUERIES", "sample_queries", "scan_queries"]


_U = f"SELECT doc_id, lang, {ZH} AS zh, {units(ZH)} AS u FROM documents"
_U_RUN = f"""WITH d AS ({_U}), e AS (SELECT doc_id, unnest(u) AS x, generate_subscripts(u, 1) AS i FROM d),
 g AS (SELECT doc_id, x, i - row_number() OVER (PARTITION BY doc_id, x ORDER BY i) AS grp FROM e),
 r AS (SELECT doc_id, max(c) AS run FROM (SELECT doc_id, x, grp, count(*) AS c FROM g GROUP BY ALL) GROUP BY doc_id),
 s AS (SELECT d.doc_id, d.lang, len(u) AS n, len(list_distinct(u)) AS k, coalesce(run, 0) AS run FROM d LEFT JOIN r USING (doc_id))"""


@query(f"""{_U_RUN}
SELECT lang, count(*) AS docs, count(*) FILTER (WHERE n >= 10 AND k::DOUBLE / n >= 0.3 AND run <= 3) AS valid_docs, sum(n)::BIGINT AS units FROM s GROUP BY lang""")
def valid_long_text_by_lang(spark, sf_dir):
    rows = zh_docs(spark, sf_dir).select("lang", T.unit_profile(F.col("zh"))["units"].alias("n"), predicates.valid_long_text(F.col("zh")).alias("valid"))
    return rows.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"), F.count(F.when(F.col("valid"), 1)).alias("valid_docs"), F.sum("n").cast("long").alias("units"))


@query(f"{_U_RUN} SELECT doc_id, n::BIGINT AS n_units, k::BIGINT AS n_distinct, run::BIGINT AS longest_run FROM s")
def unit_counts(spark, sf_dir):
    rows = zh_docs(spark, sf_dir).select("doc_id", T.unit_profile(F.col("zh")).alias("p"))
    return rows.select("doc_id", F.col("p.units").cast("long").alias("n_units"), F.col("p.distinct").cast("long").alias("n_distinct"), F.col("p.run").cast("long").alias("longest_run"))


@query(f"""{_U_RUN}, b AS (SELECT doc_id, {BARE.format("zh")} AS bare FROM d)
SELECT s.doc_id, md5(bare) AS bare, md5(list_aggregate(u, 'string_agg', '|')) AS units, n >= 10 AND k::DOUBLE / n >= 0.3 AND run <= 3 AS valid,
 round(coalesce(len(regexp_extract_all(bare, '[{CJK}]'))::DOUBLE / nullif(len(replace(bare, ' ', '')), 0), 0), 6) AS cjk_ratio FROM s JOIN b USING (doc_id) JOIN d USING (doc_id)""")
def wide_texts(spark, sf_dir):
    """Full-width letters and digits count as the plain ones: the oracle reads the texts before they were widened."""
    wide = widened(F.col("zh"))
    return zh_docs(spark, sf_dir).select(
        "doc_id", F.md5(T.normalize_text(wide, keep_punctuation=False)).alias("bare"), F.md5(F.array_join(T.mixed_units(wide), "|")).alias("units"),
        predicates.valid_long_text(wide).alias("valid"), F.round(T.cjk_ratio(wide), 6).alias("cjk_ratio"),
    )


@query(r"SELECT doc_id, md5(trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g'))) AS kept, md5(trim(regexp_replace(regexp_replace(coalesce(text, ''), '[^\p{L}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g'))) AS bare FROM documents")
def normalized_text(spark, sf_dir):
    return wide_docs(spark, sf_dir).select("doc_id", F.md5(T.normalize_text(F.col("text"))).alias("kept"), F.md5(T.normalize_text(F.col("text"), keep_punctuation=False)).alias("bare"))


@query(f"""SELECT doc_id,
 round(coalesce(len(regexp_extract_all(p, '[{CJK}]'))::DOUBLE / nullif(len(replace(p, ' ', '')), 0), 0), 6) AS cjk_ratio,
 round(len(regexp_replace(zh, '[^{T.HAN}]', '', 'g'))::DOUBLE / len(zh), 6) AS chinese_ratio,
 round(len(list_distinct(string_split(zh, '')))::DOUBLE / len(zh), 6) AS unique_char_ratio
 FROM (SELECT doc_id, {ZH} AS zh, {BARE.format(ZH)} AS p FROM documents)""")
def char_ratios(spark, sf_dir):
    rows = zh_docs(spark, sf_dir).select("doc_id", T.cjk_ratio(F.col("zh")).alias("cjk"), T.char_profile(F.col("zh")).alias("p"))
    return rows.select("doc_id", F.round("cjk", 6).alias("cjk_ratio"), F.round(T.ratio(F.col("p.han"), F.col("p.chars")), 6).alias("chinese_ratio"), F.round(T.ratio(F.col("p.distinct"), F.col("p.chars")), 6).alias("unique_char_ratio"))




@query(f"SELECT doc_id, md5(c) AS cleaned, md5(left(c, 128)) AS cut FROM (SELECT doc_id, {CLEAN.format(ZH)} AS c FROM documents)")
def cleaned_text(spark, sf_dir):
    return zh_docs(spark, sf_dir).select("doc_id", F.md5(T.clean_text(F.col("zh"))).alias("cleaned"), F.md5(T.truncate_clean(F.col("zh"), 128)).alias("cut"))


_REASON = f"""WITH d AS (SELECT doc_id, {ZH} AS zh FROM documents), c AS (SELECT doc_id, zh, string_split(zh, '') AS a FROM d),
 e AS (SELECT doc_id, unnest(a) AS x, generate_subscripts(a, 1) AS i FROM c), g AS (SELECT doc_id, x, i - row_number() OVER (PARTITION BY doc_id, x ORDER BY i) AS grp FROM e),
 r AS (SELECT doc_id, max(n) AS run FROM (SELECT doc_id, x, grp, count(*) AS n FROM g GROUP BY ALL) GROUP BY doc_id),
 q AS (SELECT c.doc_id, CASE WHEN zh IS NULL OR zh = '' THEN 'empty' WHEN len(zh) < 7 THEN 'short' WHEN len(regexp_replace(zh, '[^{T.HAN}]', '', 'g'))::DOUBLE / len(zh) < 0.4 THEN 'script'
  WHEN len(list_distinct(a))::DOUBLE / len(zh) < 0.02 THEN 'repetitive' WHEN run > 3 THEN 'run' ELSE 'ok' END AS reason FROM c LEFT JOIN r USING (doc_id))"""


@query(f"{_REASON} SELECT reason, count(*) AS docs FROM q GROUP BY reason")
def text_quality(spark, sf_dir):
    rules = predicates.CharRules(min_chinese_ratio=0.4, min_unique_ratio=0.02)
    return zh_docs(spark, sf_dir).groupBy(predicates.quality_reason(F.col("zh"), rules).alias("reason")).agg(F.count(F.lit(1)).alias("docs"))


@query(f"SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY {BARE.format('text')} ORDER BY doc_id) AS n FROM documents) WHERE n = 1")
def exact_dedup(spark, sf_dir):
    key = T.normalize_text(F.col("text"), keep_punctuation=False)
    return dedup.exact_dedup(wide_docs(spark, sf_dir).select("doc_id", "text"), key, "doc_id").select("doc_id")


@query(f"SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY {BARE.format(ZH)} ORDER BY doc_id) AS n FROM documents) WHERE n = 1")
def wide_exact_dedup(spark, sf_dir):
    """Every text comes a second time in full-width letters, which is an exact copy after NFKC."""
    rows = zh_docs(spark, sf_dir).select("doc_id", "zh")
    both = rows.unionByName(rows.select((F.col("doc_id") + 1_000_000_000).alias("doc_id"), widened(F.col("zh")).alias("zh")))
    return dedup.exact_dedup(both, T.normalize_text(F.col("zh"), keep_punctuation=False), "doc_id").select("doc_id")


_GRAMS = f"""WITH RECURSIVE u AS (SELECT doc_id, list_transform(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}]+'), lambda x: lower(x)) AS u FROM documents), {gram_edges("u", "doc_id")}"""


@query(f'{_GRAMS} SELECT a, b, common, "union" FROM pairs')
def near_dup_edges(spark, sf_dir):
    return dedup.lexical_edges(wide_docs(spark, sf_dir).select("doc_id", "text"), "text", "doc_id")


@query(f"{_GRAMS}, {greedy('s', 'pairs')} SELECT id AS doc_id FROM chosen")
def near_dedup(spark, sf_dir):
    return dedup.near_dedup(wide_docs(spark, sf_dir).select("doc_id", "text"), "text", "doc_id").select("doc_id")


@query(f"{_GRAMS}, {greedy('s', 'pairs')} SELECT id AS doc_id FROM chosen")
def wide_near_dedup(spark, sf_dir):
    """As near_dedup, with every text a second time in full-width letters."""
    rows = wide_docs(spark, sf_dir).select("doc_id", "text")
    both = rows.unionByName(rows.select((F.col("doc_id") + 1_000_000_000).alias("doc_id"), widened(F.col("text")).alias("text")))
    return dedup.near_dedup(both, "text", "doc_id").select("doc_id")


@query(r"""SELECT doc_id, count(*) AS grams, max(c) AS most FROM (SELECT doc_id, x, count(*) AS c FROM (SELECT doc_id, unnest(list_transform(range(1, len(u) - 2), lambda i: list_aggregate(u[i:i+3], 'string_agg', ''))) AS x
 FROM (SELECT doc_id, list_transform(regexp_extract_all(text, '[\p{L}\p{N}]+'), lambda x: lower(x)) AS u FROM documents)) GROUP BY ALL) GROUP BY doc_id""")
def gram_counts(spark, sf_dir):
    rows = wide_docs(spark, sf_dir).select("doc_id", T.mixed_units(F.col("text")).alias("u")).where(F.size("u") >= 4)
    grams = rows.select("doc_id", F.explode(F.transform(F.sequence(F.lit(1), F.size("u") - 3), lambda i: F.array_join(F.slice("u", i, 4), ""))).alias("x"))
    return grams.groupBy("doc_id", "x").agg(F.count(F.lit(1)).alias("c")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("grams"), F.max("c").alias("most"))


def _dots() -> str:
    rows = ", ".join("[" + ", ".join(f"{v}::DOUBLE" for v in row) + "]" for row in dedup.projection(64).astype(float).tolist())
    return f"list_transform([{rows}], lambda r: CASE WHEN list_dot_product(v, r) > 0 THEN '1' ELSE '0' END)"


_HASHES = f"SELECT vec_id, list_aggregate({_dots()}, 'string_agg', '') AS bits FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)"


@query(_HASHES)
def semantic_hash(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", dedup.semantic_hash(F.col("embedding"), dedup.projection(64)).alias("code"))
    return rows.select("vec_id", F.reverse(F.lpad(F.bin("code"), 64, "0")).alias("bits"))


@query(f"WITH h AS ({_HASHES}) SELECT a.vec_id AS a, b.vec_id AS b, hamming(a.bits, b.bits)::INT AS distance FROM h a JOIN h b ON a.vec_id < b.vec_id WHERE hamming(a.bits, b.bits) <= 14")
def semantic_edges(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").withColumn("code", dedup.semantic_hash(F.col("embedding"), dedup.projection(64)))
    return dedup.hash_edges(rows, "code", "vec_id", 14)


#: Every vector comes a second time with its first components turned round, so that near codes are there: distance 6, the default.
_TWIN = "list_transform(embedding::DOUBLE[], lambda x, i: CASE WHEN i <= 3 THEN -x ELSE x END)"
_TWINS = f"SELECT vec_id, list_aggregate({_dots()}, 'string_agg', '') AS bits FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings UNION ALL SELECT vec_id + 1000000000, {_TWIN} FROM embeddings)"


def _with_twins(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.unionByName(rows.select((F.col("vec_id") + 1_000_000_000).alias("vec_id"), F.transform("embedding", lambda x, i: F.when(i < 3, -x).otherwise(x)).alias("embedding")))


@query(f"WITH h AS ({_TWINS}) SELECT a.vec_id AS a, b.vec_id AS b, hamming(a.bits, b.bits)::INT AS distance FROM h a JOIN h b ON a.vec_id < b.vec_id WHERE hamming(a.bits, b.bits) <= 6")
def semantic_twins(spark, sf_dir):
    rows = _with_twins(spark, sf_dir).withColumn("code", dedup.semantic_hash(F.col("embedding"), dedup.projection(64)))
    return dedup.hash_edges(rows, "code", "vec_id")


@query(f"WITH RECURSIVE h AS MATERIALIZED ({_TWINS}), k AS (SELECT vec_id AS id FROM h), e AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM h a JOIN h b ON a.vec_id < b.vec_id WHERE hamming(a.bits, b.bits) <= 6), {greedy('k', 'e')} SELECT id AS vec_id FROM chosen")
def semantic_dedup(spark, sf_dir):
    return dedup.semantic_dedup(_with_twins(spark, sf_dir), "embedding", "vec_id", 64).select("vec_id")




@query(f"SELECT {BIN.format('n_chars')} AS bin, count(*) AS docs FROM documents GROUP BY 1")
def length_bins(spark, sf_dir):
    return docs(spark, sf_dir).groupBy(bins.bin_for(F.col("n_chars")).alias("bin")).agg(F.count(F.lit(1)).alias("docs"))


@query(f"""{DECIDED_PAIRS} SELECT pair_id, bin, en_chars::INT AS en_chars, zh_chars::INT AS zh_chars, cut_en, CASE WHEN en_chars = 0 OR zh_chars = 0 THEN 'empty_side' WHEN zh_chars::DOUBLE / en_chars < 0.3 OR zh_chars::DOUBLE / en_chars > 1.2 THEN 'length_ratio_out_of_range:' || printf('%.2f', zh_chars::DOUBLE / en_chars) END AS drop_reason FROM k""")
def pair_lengths(spark, sf_dir):
    rows = pair_rows(spark, sf_dir).where("en is not null and zh is not null").withColumn("d", bins.decide_pair(F.col("en"), F.col("zh")))
    return rows.select("pair_id", "d.bin", "d.en_chars", "d.zh_chars", "d.cut_en", "d.drop_reason")


@query(f"""WITH p AS ({PAIRS}), r AS (SELECT *, [64, 128, 256, 512, 1024][(floor({UNIT.format(SEED, 'pair_id')} * 5) + 1)::INT] AS bin FROM p WHERE en IS NOT NULL AND zh IS NOT NULL),
 k AS (SELECT pair_id, bin, len(en) AS n, len(zh) AS m, least(len(en), bin) AS e, least(len(zh), {CAP}) AS z FROM r), q AS (SELECT *, CASE WHEN e > 0 THEN z::DOUBLE / e END AS share FROM k)
SELECT pair_id, bin, CASE bin WHEN 64 THEN 36 WHEN 128 THEN 72 WHEN 256 THEN 144 WHEN 512 THEN 288 ELSE 576 END AS zh_bin, n > bin AS cut_en, m > {CAP} AS cut_zh,
 CASE WHEN e = 0 OR z = 0 THEN 'empty_side' WHEN share < 0.3 OR share > 1.2 THEN 'length_ratio_out_of_range:' || printf('%.2f', share) END AS drop_reason FROM q""")
def pairs_at_bins(spark, sf_dir):
    rows = sampling.random_bin(pair_rows(spark, sf_dir).where("en is not null and zh is not null"), "pair_id", SEED)
    return rows.withColumn("d", bins.decide_pair(F.col("en"), F.col("zh"), F.col("bin"))).select("pair_id", "bin", "d.zh_bin", "d.cut_en", "d.cut_zh", "d.drop_reason")


_KEY = f"md5('{SEED}:' || doc_id)"


@query(f"SELECT doc_id, bin FROM (SELECT doc_id, bin, row_number() OVER (PARTITION BY bin ORDER BY {_KEY}, doc_id) AS n FROM (SELECT doc_id, {BIN.format('n_chars')} AS bin FROM documents)) WHERE n <= 40")
def stratified_bins(spark, sf_dir):
    rows = docs(spark, sf_dir).select("doc_id", bins.bin_for(F.col("n_chars")).alias("bin"))
    return sampling.stratified_bins(rows, "bin", "doc_id", 200, SEED)


@query(f"""WITH k AS (SELECT count(DISTINCT source) AS k FROM documents), p AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY {_KEY}, doc_id) AS n FROM documents)
 SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (ORDER BY md5('{SEED + 1}:' || doc_id), doc_id) AS t FROM p, k WHERE n <= greatest(1, 110 // k)) WHERE t <= 110""")
def stratified_topics(spark, sf_dir):
    return sampling.stratified_topics(docs(spark, sf_dir).select("doc_id", "source"), "source", "doc_id", 110, SEED)


@query(f"""SELECT doc_id, source, n FROM (SELECT doc_id, source, n_chars, row_number() OVER (PARTITION BY source ORDER BY t) AS n FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS t FROM documents) WHERE t <= 30 AND n_chars >= 1000) WHERE n <= 10""")
def attempt_budget(spark, sf_dir):
    rows = sampling.budget(docs(spark, sf_dir).select("doc_id", "source", "n_chars"), "source", "doc_id", F.col("n_chars") >= 1000, 10, 3)
    from pyspark.sql import Window as W

    return rows.withColumn("n", F.row_number().over(W.partitionBy("source").orderBy("doc_id")).cast("long")).drop("n_chars")


_WEIGHTS = {"src0": 0.5, "src1": 0.3, "src2": 0.2, "src3": 0.3}


@query(f"""WITH w AS (SELECT doc_id, source, -ln(1.0 - {UNIT.format(SEED, 'doc_id')}) / CASE source WHEN 'src0' THEN 0.5 WHEN 'src1' THEN 0.3 WHEN 'src2' THEN 0.2 ELSE 0.3 END AS gap FROM documents WHERE source IN ('src0', 'src1', 'src2', 'src3')),
 a AS (SELECT doc_id, source, sum(gap) OVER (PARTITION BY source ORDER BY md5('{SEED + 1}:' || doc_id), doc_id ROWS UNBOUNDED PRECEDING) AS arrival FROM w)
 SELECT doc_id, source, round(arrival, 6) AS arrival FROM a ORDER BY a.arrival, doc_id LIMIT 60""")
def weighted_mix(spark, sf_dir):
    rows = sampling.weighted_mix(docs(spark, sf_dir).select("doc_id", "source"), "source", "doc_id", _WEIGHTS, SEED, 60)
    return rows.withColumn("arrival", F.round("arrival", 6))


@query(f"""SELECT doc_id, ['a', 'b', 'c'][(floor({UNIT.format(SEED + 1, 'doc_id')} * 3) + 1)::INT] AS font, (floor({UNIT.format(SEED + 2, 'doc_id')} * 33) + 24)::INT AS font_size, CASE WHEN {UNIT.format(SEED, 'doc_id')} < 0.6 THEN '宋体' END AS family FROM documents""")
def seeded_attributes(spark, sf_dir):
    rows = sampling.seeded_attributes(docs(spark, sf_dir).select("doc_id"), "doc_id", SEED, ["a", "b", "c"])
    return sampling.preferred_family(rows, "doc_id", SEED, "宋体").select("doc_id", "font", "font_size", "family")


def _paired(spark, sf_dir):
    rows = pair_rows(spark, sf_dir).where("en is not null and zh is not null").withColumn("d", bins.decide_pair(F.col("en"), F.col("zh")))
    return pipelines.pair_samples(rows, F.col("pair_id"), "Pairs-Parallel")


_SIDES = f"""{DECIDED_PAIRS}, v AS (SELECT pair_id, l AS lang, CASE l WHEN 'en' THEN left(en, bin) ELSE left(zh, {CAP}) END AS rendered FROM k, (VALUES ('en'), ('zh')) t(l))"""


@query(f"{_SIDES} SELECT pair_id, lang, pair_id || '-' || lang AS sample_id, 'Pairs-Parallel/' || lang AS source_subset, md5(rendered) AS rendered FROM v")
def pair_views(spark, sf_dir):
    return pairs.long_view(_paired(spark, sf_dir)).select("pair_id", "lang", "sample_id", "source_subset", F.md5("rendered_text").alias("rendered"))


@query(f"{_SIDES} SELECT a.pair_id, md5(a.rendered) AS zh, md5(b.rendered) AS en FROM v a JOIN v b ON a.pair_id = b.pair_id AND a.lang = 'zh' AND b.lang = 'en'")
def pair_rejoin(spark, sf_dir):
    _, zh, en = pairs.split_views(_paired(spark, sf_dir))
    return pairs.rejoin(zh, en).select("pair_id", F.md5("zh.rendered_text").alias("zh"), F.md5("en.rendered_text").alias("en"))


@query("""SELECT doc_id, 'doc_' || left(sha1(source || chr(10) || lang || chr(10) || text), 16) AS lines_id FROM documents""")
def stable_ids(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", T.stable_id("doc_", "source", "lang", "text").alias("lines_id"))


@query(f"""SELECT doc_id, CASE WHEN floor({UNIT.format(SEED, 'doc_id')} * 2) = 1 THEN '画面为' || trim(source) || '，写有：' || {STRIPPED.format('text')} ELSE trim(source) || '，图上的文字是「' || {STRIPPED.format('text')} || '」。' END AS caption FROM documents""")
def template_captions(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", prompts.caption(F.col("source"), F.col("text"), SEED, F.col("doc_id")).alias("caption"))


#: Ten letters stand for all CJK characters here, so texts repeat more than real ones.
_OCR_RULES = predicates.UnitRules(min_unique_ratio=0.02, max_run=8)


def _ocr(spark, sf_dir):
    """Conversations as OCR records: a turn is a block with a box made from its number and length."""
    c = table(spark, sf_dir, "conversations").where("text is not null")
    zh = F.translate(F.lower("text"), FROM, TO)
    y, x = ((F.col("turn") * 7) % 3 * 20).cast("double"), ((F.col("turn") * 5 + F.length("text")) % 11).cast("double")
    box = F.struct(zh.alias("text"), x.alias("x0"), y.alias("y0"), (x + 100.0).alias("x1"), (y + 18.0).alias("y1"), F.lit(0).alias("reading_order"), F.col("turn").alias("turn"))
    grouped = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", box.alias("b")))).alias("r"))
    return grouped.select(F.col("conv_id").alias("line"), F.lit(None).cast("string").alias("sample_id"), F.concat(F.lit("img/"), F.col("conv_id").cast("string")).alias("image_path"), F.when(F.col("conv_id") % 2 == 0, "对话").alias("caption"), F.transform("r", lambda r: r["b"]).alias("blocks"))


def _ocr_twice(spark, sf_dir):
    """Each record a second time in full-width letters: a copy after NFKC."""
    rows = _ocr(spark, sf_dir)
    wide = F.transform("blocks", lambda b: b.withField("text", widened(b["text"])))
    return rows.unionByName(rows.withColumn("blocks", wide).withColumn("line", F.col("line") + 1_000_000_000))


_OCR_SQL = f"""l AS (SELECT conv_id, turn, {COLLAPSED.format(f"translate(lower(text), '{FROM}', '{TO}')")} AS t, (turn * 7) % 3 * 20.0 AS y, ((turn * 5 + len(text)) % 11)::DOUBLE AS x FROM conversations WHERE text IS NOT NULL),
 o AS (SELECT conv_id, string_agg(t, ' ' ORDER BY y, x, turn) FILTER (WHERE t <> '') AS t, string_agg(turn::VARCHAR, ',' ORDER BY y, x, turn) AS turns, min(x) AS x0, max(y) + 18.0 AS y1 FROM l GROUP BY conv_id)"""
_OCR_VALID = f"""{_OCR_SQL}, w AS (SELECT conv_id, t, {BARE.format('t')} AS bare FROM o), u AS (SELECT *, {units('t')} AS u FROM w), e AS (SELECT conv_id, unnest(u) AS x, generate_subscripts(u, 1) AS i FROM u),
 g AS (SELECT conv_id, x, i - row_number() OVER (PARTITION BY conv_id, x ORDER BY i) AS grp FROM e), r AS (SELECT conv_id, max(c) AS run FROM (SELECT conv_id, x, grp, count(*) AS c FROM g GROUP BY ALL) GROUP BY conv_id),
 v AS (SELECT *, row_number() OVER (PARTITION BY bare ORDER BY conv_id) AS n FROM u JOIN r USING (conv_id) WHERE len(u) >= 10 AND len(list_distinct(u))::DOUBLE / len(u) >= 0.02 AND run <= 8), first AS MATERIALIZED (SELECT * FROM v WHERE n = 1)"""


@query(f"WITH {_OCR_SQL} SELECT conv_id, turns, x0, y1 FROM o")
def reading_order(spark, sf_dir):
    rows = _ocr(spark, sf_dir).withColumn("b", layout.order_by_corner("blocks"))
    return rows.select(F.col("line").alias("conv_id"), F.array_join(F.transform("b", lambda b: b["turn"].cast("string")), ",").alias("turns"), layout.box_union(F.col("b"))["x0"].alias("x0"), layout.box_union(F.col("b"))["y1"].alias("y1"))


@query(f"""WITH {_OCR_VALID} SELECT conv_id, md5(bare) AS text, md5(CASE WHEN conv_id % 2 = 0 THEN '对话。图中包含以下中文文字：' ELSE '生成一张包含清晰中文长文本的真实场景图片，文字内容包括：' END || bare) AS prompt,
 'real_zh_' || left(sha1('talk' || chr(10) || 'img/' || conv_id || chr(10) || bare), 16) AS sample_id FROM first""")
def ocr_filter(spark, sf_dir):
    rows = pipelines.filter_ocr(_ocr_twice(spark, sf_dir), "talk", _OCR_RULES, near=False)
    return rows.select(F.col("line").alias("conv_id"), F.md5("text").alias("text"), F.md5("prompt").alias("prompt"), "sample_id")


@query(f"WITH RECURSIVE {_OCR_VALID}, {gram_edges('first', 'conv_id')}, k AS (SELECT conv_id AS id FROM first), {greedy('k', 'pairs')} SELECT id AS conv_id FROM chosen")
def ocr_filter_near(spark, sf_dir):
    return pipelines.filter_ocr(_ocr_twice(spark, sf_dir), "talk", _OCR_RULES).select(F.col("line").alias("conv_id"))


@query(f"""SELECT conv_id, string_agg(c, chr(10) ORDER BY turn) AS joined FROM (SELECT conv_id, turn, {CLEAN.format(f"translate(lower(text), '{FROM}', '{TO}')")} AS c FROM conversations WHERE text IS NOT NULL)
 WHERE len(c) > 1 AND len(regexp_replace(c, '[^{T.HAN}]', '', 'g'))::DOUBLE / len(c) >= 0.2 GROUP BY conv_id""")
def long_words_lines(spark, sf_dir):
    rows = _ocr(spark, sf_dir).withColumn("kept", predicates.long_words_lines(F.col("blocks"))).where(F.size("kept") > 0)
    return rows.select(F.col("line").alias("conv_id"), F.array_join(F.transform("kept", lambda b: b["text"]), "\n").alias("joined"))


@query(f"""SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS cut FROM (SELECT doc_id, w, i, sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS used FROM (SELECT doc_id, w, i, len(regexp_extract_all(w, '[\\p{{L}}\\p{{N}}]+')) AS n FROM
 (SELECT doc_id, unnest(a) AS w, generate_subscripts(a, 1) AS i FROM (SELECT doc_id, string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ') AS a FROM documents)))) WHERE used <= 40 GROUP BY doc_id""")
def truncated_units(spark, sf_dir):
    return wide_docs(spark, sf_dir).select("doc_id", T.truncate_by_units(widened(F.col("text")), 40).alias("cut"))


@query("""SELECT a.doc_id, round(CASE WHEN a.text = '' OR b.text = '' THEN 1.0 ELSE 1.0 - len(list_intersect(string_split(a.text, ''), string_split(b.text, '')))::DOUBLE / len(list_distinct(list_concat(string_split(a.text, ''), string_split(b.text, '')))) END, 6) AS divergence
 FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1""")
def divergence(spark, sf_dir):
    d = docs(spark, sf_dir).select("doc_id", "text")
    return d.alias("a").join(d.alias("b"), F.col("b.doc_id") == F.col("a.doc_id") + 1).select("a.doc_id", F.round(T.divergence(F.col("a.text"), F.col("b.text")), 6).alias("divergence"))


@query("SELECT item_id, round(levenshtein(regexp_replace(text, '[aeiou]', 'x', 'g'), text)::DOUBLE / len(text), 6) AS cer FROM benchmark")
def character_error_rate(spark, sf_dir):
    noisy = F.regexp_replace("text", "[aeiou]", "x")
    return table(spark, sf_dir, "benchmark").select("item_id", F.round(T.character_error_rate(noisy, F.col("text")), 6).alias("cer"))


@query("SELECT lang AS subset, count(*) AS samples, round(avg(n_chars), 4) AS mean_length FROM documents GROUP BY ROLLUP (lang)")
def corpus_stats(spark, sf_dir):
    return stats.corpus_stats(docs(spark, sf_dir).withColumnRenamed("lang", "subset"), "subset", "n_chars").withColumn("mean_length", F.round("mean_length", 4))


@query("SELECT lang, (n_chars // 500 * 500)::BIGINT AS bucket, count(*) AS n FROM documents GROUP BY ALL")
def joint_distribution(spark, sf_dir):
    return stats.joint_distribution(docs(spark, sf_dir), "lang", "n_chars", 500)


@query("SELECT lang, quantile_cont(n_chars, 0.5) AS median_n_chars FROM documents GROUP BY lang")
def length_medians(spark, sf_dir):
    return stats.medians(docs(spark, sf_dir), "lang", "n_chars")


@query("SELECT source, n, round(n / sum(n) OVER (), 8) AS share FROM (SELECT source, count(*) AS n FROM documents GROUP BY source)")
def topic_shares(spark, sf_dir):
    return stats.shares(docs(spark, sf_dir).select("source"), "source").withColumn("share", F.round("share", 8))


@query("SELECT CASE WHEN n_chars < 0 THEN 0 WHEN n_chars >= 20000 THEN 21 ELSE n_chars // 1000 + 1 END::BIGINT AS bucket, count(*) AS n FROM documents GROUP BY 1")
def length_histogram(spark, sf_dir):
    return stats.histogram(docs(spark, sf_dir), "n_chars", 0, 20000, 20)


@query("SELECT event_id, coalesce(nullif(json_extract_string(props, '$.missing'), ''), nullif(json_extract_string(props, '$.k'), ''), event_type) AS picked FROM events")
def alias_cascade(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("raw", F.try_parse_json("props"))
    return rows.select("event_id", F.coalesce(readers.field("raw", "missing", "k"), F.col("event_type")).alias("picked"))


@query("SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 300 AS shard, (row_number() OVER (ORDER BY doc_id) - 1) % 300 AS place FROM documents")
def shard_plan(spark, sf_dir):
    return writers.shard_plan(docs(spark, sf_dir).select("doc_id"), "doc_id", 300)


@query("SELECT doc_id FROM documents ORDER BY doc_id LIMIT 50")
def limit_prefix(spark, sf_dir):
    return sampling.first_n(docs(spark, sf_dir).select("doc_id"), "doc_id", 50)


@query("SELECT doc_id, lang FROM documents WHERE lang IN (SELECT DISTINCT left(role, 2) FROM conversations UNION SELECT 'en')")
def registry_semi_join(spark, sf_dir):
    files = table(spark, sf_dir, "conversations").select(F.left("role", F.lit(2)).alias("file")).unionByName(spark.createDataFrame([("en",)], "file string"))
    return pairs.installed(docs(spark, sf_dir).select("doc_id", F.col("lang").alias("file")), files).select("doc_id", F.col("file").alias("lang"))


@query(f"""WITH s AS (SELECT doc_id, floor({UNIT.format(SEED, 'doc_id')} * 6)::INT AS k FROM documents), t AS (SELECT doc_id, CASE k WHEN 0 THEN 'modern_sans' WHEN 1 THEN 'literary_serif' WHEN 5 THEN 'display' ELSE 'calligraphy' END AS style,
 CASE k WHEN 0 THEN ['hei-1', 'hei-2'] WHEN 1 THEN ['song-1'] ELSE ['hei-1', 'hei-2', 'song-1'] END AS z, CASE k WHEN 0 THEN ['sans-1'] WHEN 1 THEN ['serif-1', 'serif-2'] ELSE ['sans-1', 'serif-1', 'serif-2'] END AS e FROM s)
 SELECT doc_id, style, z[(floor({UNIT.format(SEED + 1, 'doc_id')} * len(z)) + 1)::INT] AS zh_font, e[(floor({UNIT.format(SEED + 2, 'doc_id')} * len(e)) + 1)::INT] AS en_font FROM t""")
def font_pairs(spark, sf_dir):
    zh = spark.createDataFrame([("黑体", "hei-1"), ("黑体", "hei-2"), ("宋体", "song-1")], "family string, file string")
    en = spark.createDataFrame([("sans", "sans-1"), ("serif", "serif-1"), ("serif", "serif-2")], "family string, file string")
    return pairs.font_pairs(docs(spark, sf_dir).select("doc_id"), "doc_id", zh, en, SEED)


@query("SELECT doc_id, n_chars > 4000 AS needs_human_review FROM documents WHERE n_chars > 4000")
def review_queue(spark, sf_dir):
    marked, _ = pipelines.review_queue(docs(spark, sf_dir).select("doc_id", "n_chars"), F.col("n_chars") > 4000)
    return marked.where("needs_human_review").select("doc_id", "needs_human_review")


@query(f"SELECT doc_id, CASE WHEN len(regexp_replace({ZH}, '[^{T.HAN}]', '', 'g'))::DOUBLE / len(text) >= 0.4 THEN 'zh' ELSE 'en' END AS source_lang, CASE WHEN doc_id % 3 = 0 THEN text ELSE '译' END AS filled FROM documents")
def source_routing(spark, sf_dir):
    given = F.when(F.col("doc_id") % 3 == 0, F.col("text")).otherwise(F.lit(""))
    return zh_docs(spark, sf_dir).select("doc_id", pairs.source_language(F.col("zh")).alias("source_lang"), pairs.fill_side(given, F.lit("译")).alias("filled"))


@query("""SELECT doc_id, '一本中文图书的封面，包含以下信息：' || concat_ws(' | ', 'T' || doc_id, CASE WHEN source <> '' THEN '作者：' || source END, CASE WHEN doc_id % 2 = 0 THEN '出版年：' || lang END) AS zh,
 'Cover of an English-edition book with the following metadata: ' || concat_ws(' | ', CASE WHEN source <> '' THEN 'Author: ' || source END, CASE WHEN doc_id % 2 = 0 THEN 'Year: ' || lang END) AS en, concat_ws(' ', 'T' || doc_id, nullif(source, '')) AS rendered FROM documents""")
def book_prompts(spark, sf_dir):
    title, fields = F.concat(F.lit("T"), F.col("doc_id").cast("string")), {"author": F.col("source"), "year": F.when(F.col("doc_id") % 2 == 0, F.col("lang"))}
    return docs(spark, sf_dir).select("doc_id", prompts.book_prompt(title, **fields).alias("zh"), prompts.book_prompt(F.lit(""), "en", **fields).alias("en"), prompts.present(title, F.col("source"), F.lit(None).cast("string")).alias("rendered"))


@query("""WITH n AS (SELECT doc_id, doc_id % 6 AS images, doc_id % 2 + 1 AS rows FROM documents), c AS (SELECT *, greatest(1, greatest(1, least(4, images)) // rows) AS cols FROM n)
SELECT doc_id, i, round(36.0::DOUBLE + (i % cols) * (960.0::DOUBLE / cols), 6) AS x, round(36.0::DOUBLE + (i // cols) * (460.8::DOUBLE / rows), 6) AS y, round(960.0::DOUBLE / cols - 8, 6) AS w, round(460.8::DOUBLE / rows - 8, 6) AS h, 'p' || (i + 1) AS payload
FROM (SELECT *, unnest(range(0, least(images, rows * cols))) AS i FROM c)""")
def image_grids(spark, sf_dir):
    n = (F.col("doc_id") % 6).cast("int")
    images = F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.concat(F.lit("p"), i.cast("string")))).otherwise(F.array().cast("array<string>"))
    rows = docs(spark, sf_dir).select("doc_id", F.posexplode(layout.image_grid(images, (F.col("doc_id") % 2 + 1).cast("int"))).alias("i", "b"))
    return rows.select("doc_id", F.col("i").cast("long").alias("i"), *[F.round(F.col(f"b.{c}"), 6).alias(c) for c in "xywh"], "b.payload")


@query("""WITH n AS (SELECT doc_id, text, doc_id % 9 AS k FROM documents), h AS (SELECT *, greatest(80.0::DOUBLE, (992.0::DOUBLE - 508.8::DOUBLE) / greatest(k, 1)) AS h FROM n)
SELECT doc_id, i, round(508.8::DOUBLE + i * (h + 6), 6) AS y, round(h, 6) AS h, md5(left(text, 200)) AS payload FROM (SELECT *, unnest(range(0, k)) AS i FROM h) WHERE 508.8::DOUBLE + i * (h + 6) + h <= 992.0::DOUBLE""")
def text_stacks(spark, sf_dir):
    texts = F.array_repeat("text", (F.col("doc_id") % 9).cast("int"))
    rows = docs(spark, sf_dir).select("doc_id", F.posexplode(F.filter(layout.image_page(F.lit(None).cast("array<string>"), texts, F.lit(1)), lambda b: b["kind"] == "text")).alias("i", "b"))
    return rows.select("doc_id", F.col("i").cast("long").alias("i"), F.round("b.y", 6).alias("y"), F.round("b.h", 6).alias("h"), F.md5("b.payload").alias("payload"))


@query("""WITH a AS (SELECT doc_id, text, source, CASE WHEN doc_id % 3 <> 0 THEN 70.0::DOUBLE ELSE 0.0::DOUBLE END AS t, CASE WHEN n_chars > 100 THEN 60.0::DOUBLE ELSE 0.0::DOUBLE END AS c, lang FROM documents),
 b AS (SELECT *, 48.0::DOUBLE + t AS iy, 48.0::DOUBLE + t + 409.6::DOUBLE + 16 AS cy FROM a)
SELECT doc_id, role, round(y, 6) AS y, round(h, 6) AS h, payload FROM (
 SELECT doc_id, 'title' AS role, 48.0::DOUBLE AS y, 60.0::DOUBLE AS h, md5(source) AS payload FROM b WHERE t > 0
 UNION ALL SELECT doc_id, 'figure', iy, 409.6::DOUBLE, md5('a.png') FROM b
 UNION ALL SELECT doc_id, 'caption', cy, 50.0::DOUBLE, md5(lang) FROM b WHERE c > 0
 UNION ALL SELECT doc_id, 'main', cy + c, 976.0::DOUBLE - (cy + c), md5(left(text, 600)) FROM b WHERE text <> '')""")
def article_stacks(spark, sf_dir):
    s = layout.article_page(F.lit("a.png"), F.when(F.col("doc_id") % 3 != 0, F.col("source")), F.when(F.col("n_chars") > 100, F.col("lang")), F.col("text"))
    rows = docs(spark, sf_dir).select("doc_id", F.explode(s).alias("b"))
    return rows.select("doc_id", "b.role", F.round("b.y", 6).alias("y"), F.round("b.h", 6).alias("h"), F.md5("b.payload").alias("payload"))


@query("""SELECT doc_id, [(color >> 16) & 255, (color >> 8) & 255, color & 255] AS rgb FROM (SELECT doc_id, (doc_id * 7919 % 16777216)::BIGINT AS color FROM documents)""")
def unpacked_colors(spark, sf_dir):
    c = T.rgb((F.col("doc_id") * 7919 % 16777216).cast("long"))
    return docs(spark, sf_dir).select("doc_id", F.array(c["r"], c["g"], c["b"]).alias("rgb"))


@query(r"""SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '\n?\s*\d+\.\s?'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS parts FROM (SELECT doc_id, replace(text, 'a', chr(10) || '7. ') AS text FROM documents)""")
def numbered_parts(spark, sf_dir):
    return wide_docs(spark, sf_dir).select("doc_id", T.split_numbered(F.replace("text", F.lit("a"), F.lit("\n7. "))).alias("parts"))


@query("""WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS t, range(0, doc_id % 5) AS p FROM documents), r AS (SELECT doc_id, t, p, unnest(range(1, greatest(len(t), len(p), 1) + 1)) AS i FROM l)
SELECT doc_id, i AS place, md5(coalesce(t[i], '')) AS text, CASE WHEN i <= len(p) THEN 'p' || p[i] END AS image FROM r""")
def zipped_sections(spark, sf_dir):
    n = (F.col("doc_id") % 5).cast("int")
    images = F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: F.concat(F.lit("p"), i.cast("string")))).otherwise(F.array().cast("array<string>"))
    zipped = pairs.zip_sections(F.split("text", "\n"), images)
    return docs(spark, sf_dir).select("doc_id", F.posexplode(zipped).alias("i", "s")).select("doc_id", (F.col("i") + 1).cast("long").alias("place"), F.md5(F.coalesce("s.text", F.lit(""))).alias("text"), "s.image")


@query("SELECT lang, count(*) AS docs, left(sha256('{\"prompt\":\"' || lang || '\"}'), 8) AS request FROM documents GROUP BY lang")
def model_requests(spark, sf_dir):
    rows = models.call_once(docs(spark, sf_dir).select(F.col("lang").alias("prompt")), "chat")
    return rows.where("answer is not null").groupBy(F.col("prompt").alias("lang")).agg(F.count(F.lit(1)).alias("docs")).withColumn("request", F.left(F.sha2(F.to_json(F.struct(F.col("lang").alias("prompt"))), 256), F.lit(8)))


def _lines(spark, sf_dir):
    """Conversations as lines with two corner points; some lie above the page's edge."""
    c = table(spark, sf_dir, "conversations").where("text is not null")
    y, x = ((F.col("turn") * 7) % 3 * 20 - 10).cast("double"), ((F.col("turn") * 5 + F.length("text")) % 11).cast("double")
    line = F.struct(F.array(F.struct(x.alias("x"), y.alias("y")), F.struct((x + 100.0).alias("x"), (y + 18.0 + F.col("turn") % 2).alias("y"))).alias("points"), F.col("turn").alias("turn"))
    return c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", line.alias("b")))).alias("r")).select("conv_id", F.transform("r", lambda r: r["b"]).alias("lines"))


_LINES = "WITH l AS (SELECT conv_id, turn, (turn * 7) % 3 * 20.0::DOUBLE - 10 AS y, ((turn * 5 + len(text)) % 11)::DOUBLE AS x, turn % 2 AS odd FROM conversations WHERE text IS NOT NULL)"


@query(f"{_LINES} SELECT conv_id, string_agg(turn::VARCHAR, ',' ORDER BY floor((y + 9 + odd / 2.0) / 12), x, turn) AS turns FROM l GROUP BY conv_id")
def row_order(spark, sf_dir):
    rows = _lines(spark, sf_dir).withColumn("o", layout.order_by_rows(F.col("lines")))
    return rows.select("conv_id", F.array_join(F.transform("o", lambda x: x["turn"].cast("string")), ",").alias("turns"))


@query(f"{_LINES} SELECT conv_id, turn, x AS x0, y AS y0, x + 100 AS x1, y + 18 + odd AS y1, true AS axis_aligned FROM l")
def polygon_boxes(spark, sf_dir):
    rows = _lines(spark, sf_dir).select("conv_id", F.explode("lines").alias("l")).withColumn("b", layout.polygon_box(F.col("l.points")))
    return rows.select("conv_id", "l.turn", "b.x0", "b.y0", "b.x1", "b.y1", predicates.axis_aligned(F.col("l.points")).alias("axis_aligned"))


@query(f"{_LINES} SELECT conv_id, turn, area FROM (SELECT conv_id, turn, 100 * (18.0::DOUBLE + odd) AS area, row_number() OVER (PARTITION BY conv_id ORDER BY odd DESC, turn) AS n FROM l) WHERE n = 1")
def largest_regions(spark, sf_dir):
    boxes = F.transform("lines", lambda x: F.struct(layout.polygon_box(x["points"]).alias("b"), x["turn"].alias("turn")))
    flat = F.transform(boxes, lambda s: F.struct(s["b"]["x0"].alias("x0"), s["b"]["y0"].alias("y0"), s["b"]["x1"].alias("x1"), s["b"]["y1"].alias("y1"), s["turn"].alias("turn")))
    rows = _lines(spark, sf_dir).withColumn("b", layout.largest_box(flat))
    return rows.select("conv_id", "b.turn", ((F.col("b.x1") - F.col("b.x0")) * (F.col("b.y1") - F.col("b.y0"))).alias("area"))


@query("""WITH s AS (SELECT doc_id, least(1.0::DOUBLE, 704.0::DOUBLE / (n_chars % 900 + 1), 210.0::DOUBLE / (doc_id % 400 + 1)) * (doc_id % 400 + 1) AS a, least(1.0::DOUBLE, 704.0::DOUBLE / (doc_id % 300 + 1), 210.0::DOUBLE / (n_chars % 300 + 1)) * (n_chars % 300 + 1) AS b FROM documents),
 f AS (SELECT doc_id, 68 + a AS text_y, 308 + a AS image_y, b, 308 + a + b <= 552 AS second FROM s)
SELECT doc_id, CASE WHEN NOT second THEN 2 WHEN 552 - (image_y + b + 20) >= 80 THEN 4 ELSE 3 END AS boxes, round(text_y, 6) AS text_y, CASE WHEN second THEN round(image_y + b, 6) END AS image_end FROM f""")
def page_flows(spark, sf_dir):
    def section(kind: str, text, w, h):
        return F.struct(F.lit(kind).alias("kind"), text.alias("text"), w.cast("double").alias("w"), h.cast("double").alias("h"))

    text, one = F.col("text"), F.lit(1)
    n, d = F.col("n_chars"), F.col("doc_id")
    sections = F.array(section("image", F.lit(""), n % 900 + 1, d % 400 + 1), section("text", text, one, one), section("image", F.lit(""), d % 300 + 1, n % 300 + 1), section("text", text, one, one))
    rows = docs(spark, sf_dir).withColumn("f", layout.page_flow(sections, 800, 600))
    third = F.get("f", F.lit(2))
    return rows.select("doc_id", F.size("f").alias("boxes"), F.round(F.get("f", F.lit(1))["y"], 6).alias("text_y"), F.round(third["y"] + third["h"], 6).alias("image_end"))


@query("""WITH a AS (SELECT doc_id, source, lang, CASE WHEN doc_id % 3 <> 0 THEN 70.0::DOUBLE ELSE 0.0::DOUBLE END AS t FROM documents), b AS (SELECT *, 48.0::DOUBLE + t AS y FROM a)
SELECT doc_id, CASE WHEN t > 0 THEN '- 文字（title@[48.0, 48.0, 976.0, 108.0]）: ' || source || chr(10) ELSE '' END || '- 图片（@[48.0, ' || y || ', 976.0, ' || (y + 409.6::DOUBLE) || ']）: ' || CASE WHEN doc_id % 2 = 0 THEN lang ELSE '（图像，无字幕）' END AS bullets FROM b""")
def box_bullets(spark, sf_dir):
    none = F.lit(None).cast("string")
    page = layout.article_page(F.lit("a.png"), F.when(F.col("doc_id") % 3 != 0, F.col("source")), none, none)
    boxes = F.transform(page, lambda b: b.withField("caption", F.when((b["kind"] == "image") & (F.col("doc_id") % 2 == 0), F.col("lang"))))
    return docs(spark, sf_dir).select("doc_id", prompts.bullets(boxes).alias("bullets"))


@query("""SELECT doc_id, concat_ws(chr(10), '生成一张中文图文混排页面，白色背景，保持以下阅读顺序：', '文字：' || text, '图片：' || CASE WHEN doc_id % 3 = 0 THEN lang ELSE '与正文相关的配图' END) AS prompt FROM documents""")
def interleaved_prompts(spark, sf_dir):
    blocks = F.array(F.struct(F.lit("text").alias("kind"), F.col("text").alias("text")), F.struct(F.lit("image").alias("kind"), F.when(F.col("doc_id") % 3 == 0, F.col("lang")).otherwise("").alias("text")))
    return docs(spark, sf_dir).select("doc_id", prompts.interleaved_prompt(blocks).alias("prompt"))


@query(r"""SELECT doc_id, flatten(list_transform(CASE WHEN text = '' THEN []::VARCHAR[] ELSE string_split(regexp_replace(text, '\n$', ''), chr(10)) END, lambda p: CASE WHEN regexp_full_match(p, '\s*') THEN [''] ELSE list_transform(range(0, ceil(len(p) / 12.0)::INT), lambda i: substr(p, i * 12 + 1, 12)) END)) AS lines FROM documents""")
def wrapped_lines(spark, sf_dir):
    return wide_docs(spark, sf_dir).select("doc_id", layout.wrap_lines(F.col("text"), 12).alias("lines"))


@query("""SELECT doc_id, coalesce(max(s) FILTER (WHERE ceil(n_chars / greatest(1.0::DOUBLE, floor(600.0::DOUBLE / s))) * floor(s * 1.15::DOUBLE) <= 400), 12)::INT AS size FROM documents, range(12, 201) t(s) GROUP BY doc_id""")
def font_fits(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", layout.fit_font_size(F.col("n_chars"), 600.0, 400.0).alias("size"))


@query(f"""WITH d AS (SELECT doc_id, lang, source, {BIN.format('n_chars')} AS bin FROM documents WHERE lang = 'en'),
 c AS (SELECT 'clean' AS part, doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY bin ORDER BY {_KEY}, doc_id) AS n FROM d) WHERE n <= 10),
 k AS (SELECT count(DISTINCT source) AS k FROM d), p AS (SELECT doc_id, row_number() OVER (PARTITION BY source ORDER BY {_KEY}, doc_id) AS n FROM d),
 t AS (SELECT 'styled' AS part, doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('{SEED + 1}:' || doc_id), doc_id) AS t FROM p, k WHERE n <= greatest(1, 45 // k)) WHERE t <= 45)
SELECT part, doc_id, 'eval' AS eval_split, true AS needs_human_review FROM c UNION ALL SELECT part, doc_id, 'eval', true FROM t""")
def eval_splits(spark, sf_dir):
    d = docs(spark, sf_dir).select("doc_id", "lang", "source", bins.bin_for(F.col("n_chars")).alias("bin"))
    inputs = {part: d.withColumn("part", F.lit(part)) for part in ("clean", "styled", "unplanned")}
    plan = {"clean": ("en", "bin", 50), "styled": ("en", "topic", 45)}
    rows = sampling.eval_split(inputs, SEED, plan=plan, subset="lang", id="doc_id", topic="source")
    return rows.select("part", "doc_id", "eval_split", "needs_human_review")


@query(f"""SELECT doc_id, bin, len(text) >= least(bin // 2, 32) AS long_enough, len(text) >= least(bin // 2, 16) AND len(source) >= 8 AS pair_long_enough FROM (SELECT *, [64, 128, 256, 512, 1024][(floor({UNIT.format(SEED, 'doc_id')} * 5) + 1)::INT] AS bin FROM documents)""")
def random_bins(spark, sf_dir):
    rows = sampling.random_bin(docs(spark, sf_dir), "doc_id", SEED)
    bin = F.col("bin")
    return rows.select("doc_id", "bin", predicates.min_clean_length(F.col("text"), bin).alias("long_enough"), predicates.min_pair_length(F.col("text"), F.col("source"), bin).alias("pair_long_enough"))


@query("""SELECT vec_id, round(s, 6) AS similarity, coalesce(s, 1) >= 0.78 AS similar, coalesce(s, 0) < 0.6 AS review FROM (SELECT a.vec_id, CASE WHEN a.vec_id % 10 <> 0 THEN list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) END AS s FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)""")
def cosine_gate(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    pair = e.alias("a").join(e.alias("b"), F.col("b.vec_id") == F.col("a.vec_id") + 1)
    rows = pair.select("a.vec_id", F.when(F.col("a.vec_id") % 10 != 0, F.col("a.embedding")).alias("u"), F.col("b.embedding").alias("v"))
    s = predicates.cosine(F.col("u"), F.col("v"))
    return rows.select("vec_id", F.round(s, 6).alias("similarity"), predicates.similar_enough(F.col("u"), F.col("v")).alias("similar"), predicates.needs_review(similarity=s).alias("review"))


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 AND source <> '' AND lang <> '' AND source <> lang THEN 'shared_layout' ELSE 'same_image' END AS mode FROM documents")
def cover_modes(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", pairs.parallelism(F.col("source"), F.when(F.col("doc_id") % 2 == 0, F.col("lang"))).alias("mode"))


@query("SELECT doc_id, [left(text, 200), 'picture', CASE WHEN doc_id % 2 = 0 THEN source ELSE '' END] AS payloads FROM documents")
def geometry_twins(spark, sf_dir):
    boxes = F.array(*[F.struct(F.lit(kind).alias("kind"), F.lit("picture").alias("payload")) for kind in ("text", "image", "text")])
    texts = F.when(F.col("doc_id") % 2 == 0, F.array("text", "source")).otherwise(F.array("text"))
    return docs(spark, sf_dir).select("doc_id", F.transform(pairs.replace_texts(boxes, texts), lambda b: b["payload"]).alias("payloads"))


@query(r"""SELECT conv_id, page, string_agg(t, '' ORDER BY y, x, t) AS joined FROM (SELECT conv_id, turn // 4 AS page, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t, (turn * 7) % 3 * 20 AS y, turn % 2 AS x FROM conversations) WHERE t <> '' GROUP BY conv_id, page""")
def page_span_texts(spark, sf_dir):
    y, x = ((F.col("turn") * 7) % 3 * 20).cast("double"), (F.col("turn") % 2).cast("double")
    spans = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("path"), F.floor(F.col("turn") / 4).alias("page"), x.alias("x0"), y.alias("y0"), (x + 9).alias("x1"), (y + 9).alias("y1"), "text",
        F.lit("f").alias("font"), F.lit(9.0).alias("size"), F.lit(255).alias("color"))
    return readers.page_texts(spans).select(F.col("path").alias("conv_id"), "page", F.col("text").alias("joined"))