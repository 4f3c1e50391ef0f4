"""Boxes, reading order and page plans over arrays of structs."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from glyphmill.functions.prompts import seeded_unit


def order_by_corner(blocks: Column) -> Column:
    """Blocks by (y0, x0), ties in input order, with reading_order renumbered from 0."""
    keyed = F.transform(blocks, lambda b, i: F.struct(b["y0"].alias("y"), b["x0"].alias("x"), i.alias("i"), b.alias("b")))
    return F.transform(F.array_sort(keyed), lambda k, n: k["b"].withField("reading_order", n))


def order_by_rows(lines: Column, tolerance: int = 12) -> Column:
    """Lines by (row of the centre, centre x), ties in input order; rows are `tolerance` high, counted downwards from floor. Lines without points come last."""
    def mean(points: Column, axis: str) -> Column:
        return F.aggregate(points, F.lit(0.0), lambda s, p: s + p[axis]) / F.size(points)

    keyed = F.transform(lines, lambda x, i: F.struct(x["points"].isNull().alias("lone"), F.floor(mean(x["points"], "y") / tolerance).alias("r"), mean(x["points"], "x").alias("c"), i.alias("i"), x.alias("v")))
    return F.transform(F.array_sort(keyed), lambda k: k["v"])


def order_mixed(*arrays: Column) -> Column:
    """One array of several, by reading_order (missing: 0), ties in input order."""
    keyed = F.transform(F.concat(*arrays), lambda b, i: F.struct(F.coalesce(b["reading_order"], F.lit(0)).alias("o"), i.alias("i"), b.alias("b")))
    return F.transform(F.array_sort(keyed), lambda k: k["b"])


def box_union(boxes: Column, margin: float = 64.0) -> Column:
    """The box around all boxes; a box at the margins if there is none."""
    def side(name: str, best) -> Column:
        return F.coalesce(best(F.transform(boxes, lambda b: b[name])), F.lit(margin))

    return F.struct(side("x0", F.array_min).alias("x0"), side("y0", F.array_min).alias("y0"), side("x1", F.array_max).alias("x1"), side("y1", F.array_max).alias("y1"))


def polygon_box(points: Column) -> Column:
    def side(axis: str, best) -> Column:
        return F.coalesce(best(F.transform(points, lambda p: p[axis])), F.lit(0.0))

    return F.struct(side("x", F.array_min).alias("x0"), side("y", F.array_min).alias("y0"), side("x", F.array_max).alias("x1"), side("y", F.array_max).alias("y1"))


def largest_box(boxes: Column) -> Column:
    keyed = F.transform(boxes, lambda b, i: F.struct(((b["x1"] - b["x0"]) * (b["y1"] - b["y0"])).alias("area"), (-i).alias("i"), b.alias("b")))
    return F.array_max(keyed)["b"]


def _box(kind: str, role: str, x, y, w, h, payload: Column) -> Column:
    def number(v):
        return (v if isinstance(v, Column) else F.lit(float(v))).cast("double")

    return F.struct(F.lit(kind).alias("kind"), F.lit(role).alias("role"), number(x).alias("x"), number(y).alias("y"), number(w).alias("w"), number(h).alias("h"), payload.alias("payload"))


def _texts(values: Column) -> Column:
    return F.coalesce(values, F.array().cast("array<string>"))


def image_grid(images: Column, rows: Column, width: float = 1024.0, height: float = 1024.0, margin: float = 32.0, inset: float = 4.0, band: float = 0.45) -> Column:
    """Boxes of images in `rows` rows of equal cells that fill the upper band of a page.

    The columns are those that up to four images need, rounded down, so images
    beyond rows * columns are left out.
    """
    images = _texts(images)
    cols = F.greatest(F.lit(1), F.floor(F.greatest(F.lit(1), F.least(F.lit(4), F.size(images))) / rows)).cast("int")
    w, h = F.lit(width - 2 * margin) / cols, F.lit(height * band) / rows
    shown = F.slice(images, 1, (rows * cols).cast("int"))
    return F.transform(shown, lambda p, i: _box("image", "", F.lit(margin + inset) + (i % cols) * w, F.lit(margin + inset) + F.floor(i / cols) * h, w - 2 * inset, h - 2 * inset, p))


def text_stack(texts: Column, top: Column, width: float = 1024.0, height: float = 1024.0, margin: float = 32.0, least: float = 80.0, gap: float = 6.0, chars: int = 200) -> Column:
    """Text boxes of equal height below `top`, as many as end above the lower margin."""
    texts = _texts(texts)
    h = F.greatest(F.lit(least), (F.lit(height - margin) - top) / F.greatest(F.size(texts), F.lit(1)))
    boxes = F.transform(texts, lambda t, i: _box("text", "", margin, top + i * (h + gap), width - 2 * margin, h, F.left(t, F.lit(chars))))
    return F.filter(boxes, lambda b: b["y"] + b["h"] <= height - margin)


def image_page(images: Column, texts: Column, rows: Column, width: float = 1024.0, height: float = 1024.0, margin: float = 32.0, band: float = 0.45) -> Column:
    """A page of an image grid with text boxes below it."""
    return F.concat(image_grid(images, rows, width, height, margin, band=band), text_stack(texts, F.lit(margin * 1.5 + height * band), width, height, margin))


def article_page(image: Column, title: Column, caption: Column, body: Column, width: float = 1024.0, height: float = 1024.0, margin: float = 48.0) -> Column:
    """Title, image, caption and body below each other over the whole width; absent texts take no room, and the body gets what is left."""
    full = width - 2 * margin

    def given(c: Column) -> Column:
        return F.coalesce(c, F.lit("")) != ""

    image_y = F.lit(margin) + F.when(given(title), 70.0).otherwise(0.0)
    caption_y = image_y + height * 0.4 + 16
    body_y = caption_y + F.when(given(caption), 60.0).otherwise(0.0)
    parts = F.array(
        F.when(given(title), _box("text", "title", margin, margin, full, 60, title)),
        _box("image", "figure", margin, image_y, full, height * 0.4, image),
        F.when(given(caption), _box("text", "caption", margin, caption_y, full, 50, caption)),
        F.when(given(body), _box("text", "main", margin, body_y, full, F.lit(height - margin) - body_y, F.left(body, F.lit(600)))),
    )
    return F.filter(parts, lambda b: b.isNotNull())


def annotations(boxes: Column, readable: Column | None = None) -> Column:
    """Boxes that a page shows: those with a payload; of images only those among the `readable` payloads, if given."""
    def shown(b: Column) -> Column:
        filled = F.coalesce(b["payload"], F.lit("")) != ""
        return filled if readable is None else filled & ((b["kind"] != "image") | F.array_contains(readable, b["payload"]))

    return F.filter(boxes, shown)


def flow_items(sections: Column) -> Column:
    """(kind, text, caption, w, h): of each section its image, where its size is known, then its text, where it is not blank."""
    def items(s: Column) -> Column:
        has_image = (F.coalesce(s["image"], F.lit("")) != "") & s["w"].isNotNull() & s["h"].isNotNull()
        image = F.struct(F.lit("image").alias("kind"), s["image"].alias("text"), s["caption"].alias("caption"), s["w"].cast("double").alias("w"), s["h"].cast("double").alias("h"))
        text = F.struct(F.lit("text").alias("kind"), s["text"].alias("text"), F.lit(None).cast("string").alias("caption"), F.lit(1.0).alias("w"), F.lit(1.0).alias("h"))
        return F.filter(F.array(F.when(has_image, image), F.when(F.coalesce(F.trim(s["text"]), F.lit("")) != "", text)), lambda x: x.isNotNull())

    return F.flatten(F.transform(sections, items))


def page_flow(items: Column, width: int, height: int, margin: int = 48, gap: int = 20, seed: int = 0, key: Column | None = None) -> Column:
    """Items (kind, text, w, h) placed downwards until one overflows the page.

    Images are scaled to the page and a third of its height, never up; texts
    get what is left, 80 to 220 high. With a key, images are moved to the right
    by a draw of their own; else they start at the margin.
    """
    box = "array<struct<kind:string,x:double,y:double,w:double,h:double,payload:string,reading_order:int>>"
    start = F.struct(F.lit(float(margin)).alias("y"), F.lit(False).alias("full"), F.array().cast(box).alias("boxes"))
    inner = float(width - 2 * margin)

    def step(acc: Column, s: Column) -> Column:
        scale = F.least(F.lit(1.0), F.lit(inner) / s["w"], F.lit(height * 0.35) / s["h"])
        bottom = F.lit(float(height - margin))
        room = bottom - acc["y"]
        image = s["kind"] == "image"
        h = F.when(image, s["h"] * scale).otherwise(F.greatest(F.lit(80.0), F.least(F.lit(220.0), room)))
        w = F.when(image, s["w"] * scale).otherwise(F.lit(inner))
        moved = F.lit(0.0) if key is None else F.when(image, seeded_unit(seed, key, F.size(acc["boxes"])) * F.greatest(F.lit(1.0), F.lit(inner) - w)).otherwise(F.lit(0.0))
        # an item's end is compared, not its height with the room: scaled heights are a last place off, which the sum rounds away
        stop = acc["full"] | (acc["y"] + h > bottom)
        placed = F.struct(s["kind"].alias("kind"), (F.lit(float(margin)) + moved).alias("x"), acc["y"].alias("y"), w.alias("w"), h.alias("h"), s["text"].alias("payload"), F.size(acc["boxes"]).alias("reading_order"))
        return F.struct(F.when(stop, acc["y"]).otherwise(acc["y"] + h + gap).alias("y"), stop.alias("full"), F.when(stop, acc["boxes"]).otherwise(F.array_append(acc["boxes"], placed)).cast(box).alias("boxes"))

    return F.aggregate(items, start, step, lambda acc: acc["boxes"])


def wrap_chars(text: Column, per_line: int) -> Column:
    """Greedy character wrap under a fixed advance: lines of `per_line` characters."""
    return F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.length(text) / per_line).cast("int") - 1, F.lit(0))), lambda i: F.substring(text, i * per_line + 1, F.lit(per_line)))


def wrap_lines(text: Column, per_line: int, by_words: bool = False) -> Column:
    """Lines of at most `per_line` characters under a fixed advance, paragraph by paragraph; a blank one is an empty line.

    Characters are filled greedily, or words that stand between single spaces;
    a word longer than a line has one of its own.
    """

    def characters(paragraph: str) -> list[str]:
        return [paragraph[i : i + per_line] for i in range(0, len(paragraph), per_line)]

    def words(paragraph: str) -> list[str]:
        lines, line = [], ""
        for word in paragraph.split(" "):
            longer = f"{line} {word}" if line else word
            if len(longer) > per_line and line:
                lines.append(line)
                longer = word
            line = longer
        return lines + [line] if line else lines

    fill = words if by_words else characters

    @F.arrow_udf(ArrayType(StringType()))
    def wrap(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else [line for p in t.splitlines() for line in (fill(p) if p.strip() else [""])] for t in texts.to_pylist()], pa.list_(pa.string()))

    return wrap(text)


def fit_font_size(n_chars: Column, width: float, height: float, low: int = 12, high: int = 200) -> Column:
    """Largest size whose wrapped lines fit, for characters as wide as high and lines 1.15 high; the smallest if none fits."""
    sizes = F.filter(F.sequence(F.lit(low), F.lit(high)), lambda s: F.ceil(n_chars / F.greatest(F.lit(1), F.floor(F.lit(width) / s))) * F.floor(s * 1.15) <= height)
    return F.coalesce(F.array_max(sizes), F.lit(low))
