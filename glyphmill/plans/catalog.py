"""What the query modules share: the catalogue itself, the driver's tables and pieces of SQL.

The tables hold no CJK text, so texts are transliterated letter by letter,
alike in both engines, before the operators that treat CJK characters. They
hold no full-width forms either: `widened` makes some, which NFKC takes back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.functions import text as T
from glyphmill.operators.lineage import spread

QUERIES: dict = {}
ORACLES: dict = {}

FROM, TO = "aeiourstln", "甲乙丙丁戊己庚辛壬癸"
SEED = 20260428


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def wide_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents for queries that spend their time in expressions over texts."""
    return spread(docs(spark, sf_dir))


def zh_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_docs(spark, sf_dir).withColumn("zh", F.translate(F.lower("text"), FROM, TO))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CJK = T.CJK
ZH = f"translate(lower(text), '{FROM}', '{TO}')"
UNITS = f"list_transform(regexp_extract_all(regexp_replace({{0}}, '([{CJK}])', ' \\1 ', 'g'), '[\\p{{{{L}}}}\\p{{{{N}}}}]+'), lambda x: lower(x))"


def units(text: str) -> str:
    return UNITS.format(text).replace("{{", "{").replace("}}", "}")


#: Letters that the transliteration leaves, and digits, with their full-width forms.
NARROW = "bcdfghjkmpqvwxyz0123456789"
WIDE = "".join(chr(ord(c) + 0xFEE0) for c in NARROW)


def widened(text: Column) -> Column:
    """The text with full-width letters and digits, which NFKC makes narrow again."""
    return F.translate(text, NARROW, WIDE)


BIN = "CASE WHEN {0} <= 64 THEN 64 WHEN {0} <= 128 THEN 128 WHEN {0} <= 256 THEN 256 WHEN {0} <= 512 THEN 512 ELSE 1024 END"
UNIT = "(('0x' || left(md5('{0}:' || {1}), 12))::UBIGINT::DOUBLE / 281474976710656.0)"
#: A text without punctuation, and with its white space collapsed.
BARE = f"trim(regexp_replace(regexp_replace({{0}}, '[^\\p{{{{L}}}}\\p{{{{N}}}}_{CJK}\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"
COLLAPSED = "trim(regexp_replace({0}, '\\s+', ' ', 'g'))"
STRIPPED = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"
CLEAN = f"trim(regexp_replace(regexp_replace({{0}}, '[^{T.CLEAN}\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"


def greedy(nodes: str, edges: str) -> str:
    """CTEs `chosen(kept)`: the ids of `edges` (a, b) that a pass in order keeps, where a row goes if a kept one before it is linked to it. Rows without a link stay."""
    return f"""linked AS (SELECT id, row_number() OVER (ORDER BY id) AS r FROM (SELECT a AS id FROM {edges} UNION SELECT b FROM {edges})),
 earlier AS (SELECT id, r, list(a) AS before FROM linked LEFT JOIN {edges} ON b = id GROUP BY id, r),
 walk(r, kept) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL SELECT e.r, CASE WHEN list_has_any(w.kept, e.before) THEN w.kept ELSE list_append(w.kept, e.id) END FROM walk w JOIN earlier e ON e.r = w.r + 1),
 chosen AS (SELECT id FROM {nodes} WHERE id NOT IN (SELECT id FROM linked) UNION ALL SELECT unnest(kept) FROM (SELECT kept FROM walk ORDER BY r DESC LIMIT 1))"""


def gram_edges(source: str, id: str) -> str:
    """CTEs `pairs(a, b, common, "union")`: rows of `source` (id, u) whose multisets of four units have a Jaccard similarity of 0.9."""
    return f"""grams AS (SELECT {id} AS id, unnest(CASE WHEN len(u) >= 4 THEN list_transform(range(1, len(u) - 2), lambda i: list_aggregate(u[i:i+3], 'string_agg', '')) ELSE u END) AS x FROM {source}),
 m AS (SELECT id, x, count(*) AS c FROM grams GROUP BY ALL), s AS (SELECT id, sum(c)::BIGINT AS n FROM m GROUP BY id),
 p AS (SELECT a.id AS a, b.id AS b, sum(least(a.c, b.c))::BIGINT AS k FROM m a JOIN m b ON a.x = b.x AND a.id < b.id GROUP BY ALL),
 pairs AS MATERIALIZED (SELECT a, b, k AS common, (s.n + t.n - k)::BIGINT AS "union" FROM p JOIN s ON s.id = a JOIN s t ON t.id = b WHERE 10 * k >= 9 * (s.n + t.n - k))"""


PAIRS = "SELECT u.conv_id * 1000 + u.turn AS pair_id, a.text AS en, u.text AS zh FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant'"


def pair_rows(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    u, a = c.where("role = 'user'"), c.where("role = 'assistant'")
    return u.alias("u").join(a.alias("a"), (F.col("a.conv_id") == F.col("u.conv_id")) & (F.col("a.turn") == F.col("u.turn") + 1)).select((F.col("u.conv_id") * 1000 + F.col("u.turn")).alias("pair_id"), F.col("a.text").alias("en"), F.col("u.text").alias("zh"))


CAP = "CASE bin WHEN 64 THEN 50 WHEN 128 THEN 100 WHEN 256 THEN 201 WHEN 512 THEN 403 ELSE 806 END"
DECIDED_PAIRS = f"""WITH p AS ({PAIRS}), b AS (SELECT *, {BIN.format('len(en)')} AS bin FROM p WHERE en IS NOT NULL AND zh IS NOT NULL), k AS (SELECT pair_id, bin, en, zh, least(len(en), bin) AS en_chars, least(len(zh), {CAP}) AS zh_chars, len(en) > bin AS cut_en FROM b)"""
