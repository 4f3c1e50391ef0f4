"""Readers: JSONL, JSON, text, Parquet and pre-extracted spans, with alias cascades."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.functions import text as T
from glyphmill.operators.pairs import spec_of
from glyphmill.sources import files


def first_of(*columns: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c.cast("string"), F.lit("")) for c in columns])


def _placed(lines: DataFrame) -> DataFrame:
    """Text files' lines with `line`, their place over all files: files in order of their path, a file's splits in order of their start.

    Ids are given inside a split and rise with it; ranking splits by their
    file makes them independent of how the scan was planned.
    """
    rows = lines.select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_id"))
    return rows.select("value", F.struct("_file", "_start", "_id").alias("line"))


def json_lines(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """(line, raw): the records of JSONL files (gzip by suffix) as variants, blank lines skipped.

    line is a struct that orders records as they stand in the files. A line
    that is no JSON is null, or an error if `strict`.
    """
    lines = _placed(spark.read.text(path)).where(T.collapse_ends(F.col("value")) != "")
    return lines.select("line", (F.parse_json if strict else F.try_parse_json)("value").alias("raw"))


def field(raw: str, *names: str) -> Column:
    """The first non-empty of some fields of a variant, as text; names may be dotted paths."""
    return first_of(*[F.try_variant_get(F.col(raw), f"$.{n}", "string") for n in names])


def json_documents(spark: SparkSession, path: str, wrapper: str = "data") -> DataFrame:
    """(line, raw) of a whole-file JSON: an array, an object with a wrapped array (none if `wrapper` is empty), or a single object."""
    whole = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v"))
    forms = [F.try_variant_get("v", "$", "array<variant>"), *([F.try_variant_get("v", f"$.{wrapper}", "array<variant>")] if wrapper else []), F.array("v")]
    items = F.coalesce(*forms)
    return whole.select(F.posexplode(items).alias("line", "raw")).withColumn("line", F.col("line").cast("long"))


def texts(spark: SparkSession, path: str) -> DataFrame:
    """(line, text): a JSONL file's text, caption or prompt, or a text file's lines; empty ones dropped, then normalised."""
    if path.rstrip("/").removesuffix(".gz").endswith(".jsonl"):
        rows = json_lines(spark, path).select("line", field("raw", "text", "caption", "prompt").alias("text")).where("text is not null")
    else:
        rows = _placed(spark.read.text(path)).select("line", T.collapse_ends(F.col("value")).alias("text")).where("text <> ''")
    return rows.withColumn("text", T.normalize_text(F.col("text")))


def text_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, text) of every .txt file below a folder, one row a file."""
    return spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.txt").select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")).orderBy("path")


def text_digests(spark: SparkSession, folder: str) -> DataFrame:
    """(path, md5) of every .txt file below a folder, in no order: workers read a file in pieces, so it may be larger than a row or a worker's memory."""

    def digest(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                found = hashlib.md5(usedforsecurity=False)
                for piece in files.pieces(path):
                    found.update(piece)
                yield pa.RecordBatch.from_pydict({"path": [path], "md5": [found.hexdigest()]})

    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").load(folder)
    return listed.select("path").mapInArrow(digest, "path string, md5 string")


def corpus(df: DataFrame, text: str, most: int | None = None, order: str | None = None) -> DataFrame:
    """A corpus's non-empty texts; `most` counts rows, in the given order, before empty ones are dropped."""
    if most is not None:
        if order is None:
            raise ValueError("a limit needs an order")
        df = df.orderBy(order).limit(most)
    return df.where(F.coalesce(F.col(text), F.lit("")) != "")


def registered_corpus(spark: SparkSession, registry: list[dict], name: str) -> DataFrame:
    """(corpus, text) of a registry's entry: a text field of Parquet or JSON files, or a folder of text files; another type is an error."""
    spec = spec_of(registry, name)
    if spec["type"] == "local":
        rows = text_files(spark, spec["path"]).select("text")
    elif spec["type"] in ("parquet", "json"):
        rows = corpus(spark.read.format(spec["type"]).load(spec["path"]).select(F.col(spec["field"]).alias("text")), "text")
    else:
        raise ValueError(f"unknown corpus type {spec['type']}")
    return rows.select(F.lit(name).alias("corpus"), "text")


def parallel_texts(df: DataFrame, en: str, zh: str, source: str | None = None) -> DataFrame:
    """Trimmed text pairs by (dotted) column, both sides present before trimming; with a source's name if given."""
    rows = df.where(F.col(en).isNotNull() & F.col(zh).isNotNull() & (F.col(en) != "") & (F.col(zh) != "")).select(T.collapse_ends(F.col(en)).alias("en"), T.collapse_ends(F.col(zh)).alias("zh"))
    return rows if source is None else rows.withColumn("source", F.lit(source))


def registered_pairs(df: DataFrame, registry: list[dict], name: str) -> DataFrame:
    """parallel_texts of a table with the fields that its registry entry names."""
    spec = spec_of(registry, name)
    return parallel_texts(df, spec["fields"]["en"], spec["fields"]["zh"], name)


def image_captions(df: DataFrame, image: str, en: str, zh: str, source: str) -> DataFrame:
    """(image, en, zh, source) rows that have all but the source; captions are trimmed after that."""
    rows = df.select(F.col(image).alias("image"), F.col(en).alias("en"), F.col(zh).alias("zh"), F.col(source).alias("source"))
    rows = rows.where(" and ".join(f"coalesce({c}, '') <> ''" for c in ("image", "en", "zh")))
    return rows.withColumns({c: T.collapse_ends(F.col(c)) for c in ("en", "zh")})


_NUMBERS, _RING = "array<double>", "array<array<double>>"


def _first_array(raw: Column, *names: str) -> Column:
    """The first field of a variant that is an array and not empty; an empty array otherwise."""
    found = [F.try_variant_get(raw, f"$.{n}", "array<variant>") for n in names]
    return F.coalesce(*[F.when(F.size(f) > 0, f) for f in found], F.array().cast("array<variant>"))


def ocr_records(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """OCR records under any of their names: line, sample_id, image_path, caption, blocks (normalised text and a box or a polygon's box), metadata and raw.

    Blocks without text are left out, those without a box have one of zeros.
    metadata is the record as text, without its blocks.
    """
    raw = json_lines(spark, path, strict)

    def block(v: Column) -> Column:
        def get(*names: str) -> Column:
            return first_of(*[F.try_variant_get(v, f"$.{n}", "string") for n in names])

        boxes = [F.try_variant_get(v, f"$.{n}", _NUMBERS) for n in ("bbox", "box")]
        flat = F.coalesce(*[F.when(F.size(b) == 4, b) for b in boxes])
        ring = F.coalesce(F.try_variant_get(v, "$.polygon", _RING), F.try_variant_get(v, "$.points", _RING))

        def side(i: int, best) -> Column:
            return F.coalesce(F.get(flat, F.lit(i)), best(F.transform(ring, lambda p: p[i % 2])), F.lit(0.0))

        return F.struct(get("text", "transcription", "label").alias("text"), side(0, F.array_min).alias("x0"), side(1, F.array_min).alias("y0"), side(2, F.array_max).alias("x1"), side(3, F.array_max).alias("y1"), F.lit(0).alias("reading_order"))

    fields = F.try_variant_get("raw", "$", "map<string,variant>")
    rest = F.map_filter(fields, lambda k, v: ~k.isin("text_blocks", "ocr", "annotations"))
    return raw.select(
        "line",
        field("raw", "sample_id", "id").alias("sample_id"),
        field("raw", "image_path", "image", "path").alias("image_path"),
        field("raw", "caption", "prompt", "description").alias("caption"),
        F.filter(F.transform(_first_array(F.col("raw"), "text_blocks", "ocr", "annotations"), block), lambda b: b["text"].isNotNull()).alias("blocks"),
        F.to_json(rest).alias("metadata"),
        "raw",
    )


def ocr_line_records(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """OCR records of lines: line, id, image_path, width, height, captions and texts of both languages, lines (text, points or null), meta."""
    raw = json_lines(spark, path, strict)

    def one(v: Column) -> Column:
        ring = F.try_variant_get(v, "$.bbox", _RING)
        points = F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
        return F.struct(F.coalesce(F.try_variant_get(v, "$.text", "string"), F.lit("")).alias("text"), points.alias("points"))

    texts = {n: field("raw", n) for n in ("id", "image_path", "caption", "caption_zh", "caption_en", "ocr_text_zh", "ocr_text_en")}
    sizes = {n: F.coalesce(F.try_variant_get("raw", f"$.{n}", "int"), F.lit(0)) for n in ("width", "height")}
    return raw.select("line", *[c.alias(n) for n, c in (texts | sizes).items()], F.transform(_first_array(F.col("raw"), "ocr_lines"), one).alias("lines"), F.to_json(F.try_variant_get("raw", "$.meta", "variant")).alias("meta"))


def documents(spark: SparkSession, path: str) -> DataFrame:
    """Interleaved documents (line, id, sections) of JSONL or JSON files, in any of their forms.

    A section is (kind, text, image, caption, w, h). Documents have sections,
    or a title and items, or texts (text_segments; a single text counts as a
    list) and images, paired by position. Without an id the id is the SHA-1 of
    the record.
    """
    jsonl = path.rstrip("/").removesuffix(".gz").endswith(".jsonl")
    rows = json_lines(spark, path) if jsonl else json_documents(spark, path, wrapper="")
    raw = F.col("raw")

    def get(v: Column, name: str) -> Column:
        return F.nullif(F.try_variant_get(v, f"$.{name}", "string"), F.lit(""))

    def section(kind: Column, text: Column, image: Column, caption: Column, v: Column | None = None) -> Column:
        def size(n: str) -> Column:
            return F.lit(None).cast("double") if v is None else F.try_variant_get(v, f"$.{n}", "double")

        return F.struct(kind.alias("kind"), text.alias("text"), image.alias("image"), caption.alias("caption"), size("w").alias("w"), size("h").alias("h"))

    none = F.lit(None).cast("string")
    own = F.transform(_first_array(raw, "sections"), lambda v: section(get(v, "kind"), get(v, "text"), get(v, "image"), get(v, "caption"), v))
    items = F.transform(_first_array(raw, "items"), lambda v: section(get(v, "kind"), get(v, "text"), get(v, "image_path"), get(v, "caption"), v))
    title = F.when(get(raw, "title").isNotNull(), F.array(section(F.lit("title"), get(raw, "title"), none, none)))
    lists = [F.try_variant_get(raw, f"$.{n}", "array<string>") for n in ("texts", "text_segments")]
    single = [F.when(l.isNull(), get(raw, n)) for l, n in zip(lists, ("texts", "text_segments"))]
    texts = F.coalesce(F.when(F.size(lists[0]) > 0, lists[0]), F.when(single[0].isNotNull(), F.array(single[0])), F.when(F.size(lists[1]) > 0, lists[1]), F.when(single[1].isNotNull(), F.array(single[1])), F.array().cast("array<string>"))
    images = _first_array(raw, "images")

    def paired(i: Column) -> Column:
        image = F.get(images, i)
        plain = F.schema_of_variant(image) == "STRING"
        return section(none, F.get(texts, i), F.when(plain, F.try_variant_get(image, "$", "string")).otherwise(get(image, "path")), F.when(~plain, get(image, "caption")), image)

    zipped = F.transform(F.sequence(F.lit(0), F.greatest(F.size(texts), F.size(images), F.lit(1)) - 1), paired)
    zipped = F.filter(zipped, lambda s: s["text"].isNotNull() | s["image"].isNotNull())
    sections = F.when(F.size(own) > 0, own).when(F.size(items) > 0, F.concat(F.coalesce(title, F.filter(items, lambda s: F.lit(False))), items)).otherwise(zipped)
    id = F.coalesce(F.try_variant_get(raw, "$.id", "string"), F.try_variant_get(raw, "$.doc_id", "string"), F.left(F.sha1(F.to_json(raw)), F.lit(16)))
    return rows.select("line", id.alias("id"), sections.alias("sections"))


def books(spark: SparkSession, path: str) -> DataFrame:
    """Book records, those with a cover's address: (line, cover_url, title, author, publisher, category, year, blurb, isbn) as text."""
    names = ("cover_url", "title", "author", "publisher", "category", "year", "blurb", "isbn")
    return json_lines(spark, path).select("line", *[field("raw", n).alias(n) for n in names]).where("cover_url is not null")


def samples(spark: SparkSession, path: str) -> DataFrame:
    """Sample rows (line, sample_id, source_subset, bin, topic, raw) of JSONL; a topic is a string or a struct with a name."""
    rows = json_lines(spark, path)
    plain = F.schema_of_variant(F.try_variant_get("raw", "$.metadata.topic", "variant")) == "STRING"
    topic = F.coalesce(field("raw", "metadata.topic.name"), F.when(plain, field("raw", "metadata.topic")))
    return rows.select("line", field("raw", "sample_id").alias("sample_id"), field("raw", "source_subset").alias("source_subset"), F.try_variant_get("raw", "$.metadata.length_bin", "int").alias("bin"), topic.alias("topic"), "raw")


def page_texts(spans: DataFrame, scale: float = 2.0, most_pages: int | None = None) -> DataFrame:
    """Pages of pre-extracted spans (path, page, x0, y0, x1, y1, text, font, size, color): texts normalised, empty spans dropped, boxes and sizes scaled, text in order of (y0, x0)."""
    rows = spans.withColumn("text", T.normalize_text(F.col("text"))).where("text <> ''")
    if most_pages is not None:
        rows = rows.where(F.col("page") < most_pages)
    box = [(F.col(c) * scale).alias(c) for c in ("y0", "x0", "x1", "y1")]
    grouped = rows.groupBy("path", "page").agg(F.array_sort(F.collect_list(F.struct(*box, "text", "font", (F.col("size") * scale).alias("size"), T.rgb(F.col("color")).alias("rgb")))).alias("spans"))
    return grouped.withColumn("text", F.array_join(F.transform("spans", lambda s: s["text"]), ""))


def paper_pages(spans: DataFrame, most_pages: int = 30) -> DataFrame:
    """A paper's first pages with their spans as they come (path, page, ord, ...): empty ones stay, texts are not normalised and joined by line feeds."""
    rows = spans.where(F.col("page") < most_pages)
    grouped = rows.groupBy("path", "page").agg(F.array_sort(F.collect_list(F.struct("ord", "x0", "y0", "x1", "y1", "text", "font", "size", T.rgb(F.col("color")).alias("rgb")))).alias("spans"))
    return grouped.withColumn("text", F.array_join(F.transform("spans", lambda s: F.coalesce(s["text"], F.lit(""))), "\n"))


def slide_pages(elements: DataFrame) -> DataFrame:
    """Slides of pre-extracted elements (path, page, ord, kind text or image, x0, y0, x1, y1, text, font, size, caption): elements in order, the texts' lines joined; a page without elements gives no row."""
    fields = ("ord", "kind", "x0", "y0", "x1", "y1", "text", "font", "size", "caption")
    grouped = elements.groupBy("path", "page").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("elements"))
    return grouped.withColumn("text", F.array_join(F.transform(F.filter("elements", lambda e: e["kind"] == "text"), lambda e: F.coalesce(e["text"], F.lit(""))), "\n"))
