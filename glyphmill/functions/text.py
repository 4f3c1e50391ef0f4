"""Text normalisation, units and ratios as Column expressions.

Lengths count code points. A unit is one CJK character or one maximal run of
other letters and digits, lower-cased.
"""

from __future__ import annotations

import re
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from glyphmill.functions import kernels

# The character ranges and signs that decide what a unit or a clean character is.
CJK = "㐀-䶿一-鿿豈-﫿"
HAN = "一-鿿"
CLEAN = HAN + "A-Za-z0-9，。、！？：；“”‘’（）《》〈〉【】「」〔〕\\-.,!?:;()\\[\\]"
#: Java's \s is ASCII only; these are all code points that count as white space.
SPACE = "\\s\\x1c-\\x1f\\x85\\p{Z}"
RUN = f"[\\p{{L}}\\p{{N}}&&[^{CJK}]]"
UNIT = f"(?:[{CJK}]|{RUN}++)"


@F.arrow_udf(StringType())
def _nfkc(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else kernels.nfkc(t) for t in texts.to_pylist()], pa.string())


def nfkc(text: Column) -> Column:
    """Unicode NFKC; only texts with a non-ASCII character go to Python."""
    return F.coalesce(_nfkc(F.when(~text.rlike("^\\p{ASCII}*$"), text)), text)


def _numbers(*names: str) -> StructType:
    return StructType([StructField(name, IntegerType()) for name in names])


def _struct(columns: dict) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(v, pa.int32()) for v in columns.values()], list(columns))


@F.arrow_udf(_numbers("units", "distinct", "run", "cjk", "plain"))
def unit_profile(texts: pa.Array) -> pa.Array:
    """After NFKC: units, distinct units, longest run of one unit, CJK characters, characters that are no punctuation or space. Null counts as empty."""
    return _struct(kernels.unit_profile(texts))


@F.arrow_udf(_numbers("chars", "han", "distinct", "run"))
def char_profile(texts: pa.Array) -> pa.Array:
    """Of the text as it is: characters, Han characters, distinct characters, longest run of one character. Null counts as empty."""
    return _struct(kernels.char_profile(texts))


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, f"[{SPACE}]+", " "))


def normalize_text(text: Column, keep_punctuation: bool = True, compatibility: bool = True) -> Column:
    """NFKC, one space for each run of white space, trimmed; null becomes empty. Without punctuation, all but word characters and CJK become spaces."""
    out = F.coalesce(nfkc(text) if compatibility else text, F.lit(""))
    if not keep_punctuation:
        out = F.regexp_replace(out, f"[^\\p{{L}}\\p{{N}}_{CJK}{SPACE}]", " ")
    return collapse(out)


def cjk_chars(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"[{CJK}]"), F.lit(0))


def mixed_units(text: Column) -> Column:
    """The units of a text in order, after NFKC. Case is folded after cutting, as folding may change a run's length."""
    found = F.regexp_extract_all(F.coalesce(nfkc(text), F.lit("")), F.lit(f"[{CJK}]|{RUN}+"), F.lit(0))
    return F.transform(found, F.lower)


def ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def cjk_ratio(text: Column) -> Column:
    """CJK characters among the characters of the text, after NFKC, without punctuation and spaces."""
    p = unit_profile(text)
    return ratio(p["cjk"], p["plain"])


def chinese_ratio(text: Column) -> Column:
    return ratio(F.length(F.regexp_replace(text, f"[^{HAN}]", "")), F.length(text))


def unique_ratio(items: Column) -> Column:
    return ratio(F.size(F.array_distinct(items)), F.size(items))


def unique_char_ratio(text: Column) -> Column:
    return F.when(F.length(text) > 0, unique_ratio(F.split(text, ""))).otherwise(F.lit(0.0))


def has_char_run(text: Column, longest: int = 3) -> Column:
    """Whether a character repeats more than `longest` times in a row."""
    return text.rlike(f"(?s)(.)\\1{{{longest}}}")


def has_item_run(items: Column, longest: int) -> Column:
    """Whether an item of an array of units repeats more than `longest` times in a row: one pattern over the joined units."""
    joined = F.concat(F.lit("\x01"), F.array_join(items, "\x01"), F.lit("\x01"))
    return (F.size(items) > 0) & joined.rlike(f"\x01([^\x01]*+)\x01(?:\\1\x01){{{longest}}}")


def longest_run(items: Column) -> Column:
    """Length of the longest run of equal neighbours in an array."""
    start = F.struct(F.lit("").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(acc: Column, x: Column) -> Column:
        run = F.when((x == acc["last"]) & (acc["run"] > 0), acc["run"] + 1).otherwise(F.lit(1))
        return F.struct(x.alias("last"), run.alias("run"), F.greatest(acc["best"], run).alias("best"))

    return F.aggregate(items, start, step, lambda acc: acc["best"])


_PY_UNIT = re.compile(f"[{CJK}]|[^\\W_{CJK}]+")


def _cut(text: str | None, most: int) -> str:
    """The chunks of a text up to the first that passes `most` units; nothing behind that chunk is looked at."""
    kept, left = [], most
    for chunk in re.finditer(r"\S+", kernels.nfkc(text)):
        ends = [m.end() for m in islice(_PY_UNIT.finditer(chunk.group()), left + 1)]
        if len(ends) > left:
            if left == most:  # the first chunk with units alone has too many: it is cut behind its last unit
                kept.append(chunk.group()[: ends[most - 1]])
            break
        kept.append(chunk.group())
        left -= len(ends)
    return " ".join(kept)


def truncate_by_units(text: Column, most: int) -> Column:
    """After NFKC, the longest prefix of whole white-space chunks with at most `most` units; only a first chunk that alone has more is cut inside."""

    @F.arrow_udf(StringType())
    def cut(texts: pa.Array) -> pa.Array:
        return pa.array([_cut(t, most) for t in texts.to_pylist()], pa.string())

    return cut(text) if most > 0 else F.lit("")


def truncate_all(texts: Column, most: int) -> Column:
    """truncate_by_units for every text of an array; a null in it stays."""

    @F.arrow_udf(ArrayType(StringType()))
    def cut(lists: pa.Array) -> pa.Array:
        return pa.array([None if ts is None else [None if t is None else _cut(t, most) for t in ts] for ts in lists.to_pylist()], pa.list_(pa.string()))

    return cut(texts) if most > 0 else F.transform(texts, lambda t: F.lit(""))


_PY_PUNCTUATION = re.compile(f"[^\\w\\s{CJK}]")


def normalize_all(texts: Column, keep_punctuation: bool = True) -> Column:
    """normalize_text for every text of an array; a null becomes empty."""

    def plain(t: str | None) -> str:
        t = kernels.nfkc(t)
        return " ".join((t if keep_punctuation else _PY_PUNCTUATION.sub(" ", t)).split())

    @F.arrow_udf(ArrayType(StringType()))
    def normalized(lists: pa.Array) -> pa.Array:
        return pa.array([None if ts is None else [plain(t) for t in ts] for ts in lists.to_pylist()], pa.list_(pa.string()))

    return normalized(texts)


def fixed(value: Column, digits: int) -> Column:
    """A double with so many decimals, rounded from its exact binary value, ties to even (format_string rounds its shortest decimal form half up)."""

    @F.arrow_udf(StringType())
    def written(values: pa.Array) -> pa.Array:
        return pa.array([None if v is None else f"{v:.{digits}f}" for v in values.to_pylist()], pa.string())

    return written(value.cast("double"))


def clean_text(text: Column) -> Column:
    """All but Han characters, ASCII letters and digits, the listed signs and white space become spaces."""
    return collapse(F.regexp_replace(text, f"[^{CLEAN}{SPACE}]", " "))


def truncate_clean(text: Column, target: Column | int) -> Column:
    return F.left(clean_text(text), target if isinstance(target, Column) else F.lit(target))


def token_estimate(text: Column) -> Column:
    """A text's length stands for its tokens where no tokenizer is plugged in."""
    return F.length(text)


def split_numbered(text: Column) -> Column:
    parts = F.split(text, f"\\n?[{SPACE}]*\\d+\\.[{SPACE}]?")
    return F.filter(F.transform(parts, collapse_ends), lambda x: x != "")


def collapse_ends(text: Column) -> Column:
    return F.regexp_replace(text, f"^[{SPACE}]+|[{SPACE}]+$", "")


def title_and_body(response: Column) -> Column:
    """`title`, a line feed and `body` of a JSON answer that may be fenced; an answer that is no object is used as it is."""
    bare = F.regexp_replace(response, f"^[{SPACE}`]+|[{SPACE}`]+$", "")
    bare = F.regexp_replace(bare, "^json", "")
    parsed = F.try_parse_json(bare)
    title, body = F.try_variant_get(parsed, "$.title", "string"), F.try_variant_get(parsed, "$.body", "string")
    return F.when(title.isNotNull() | body.isNotNull(), F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), F.coalesce(body, F.lit("")))).otherwise(response)


def rgb(color: Column) -> Column:
    return F.struct(F.shiftright(color, 16).bitwiseAND(255).alias("r"), F.shiftright(color, 8).bitwiseAND(255).alias("g"), color.bitwiseAND(255).alias("b"))


def divergence(a: Column, b: Column) -> Column:
    """1 minus the Jaccard similarity of two texts' character sets; 1 if either is empty."""
    x, y = F.split(a, ""), F.split(b, "")
    return F.when((F.length(a) > 0) & (F.length(b) > 0), 1.0 - ratio(F.size(F.array_intersect(x, y)), F.size(F.array_union(x, y)))).otherwise(F.lit(1.0))


def word_scores(found: Column, truth: Column, tolerance: float = 0.8) -> Column:
    """(accuracy, f1) of recognised words, whose texts are split at white space.

    A word of the truth is met by a word of the other side at an edit distance
    of at most `tolerance` of the longer one's length; accuracy is the share of
    the truth's words that are met, precision that of the found words, f1 their
    harmonic mean. Without words on a side its share is 0.
    """
    def words(t: Column) -> Column:
        return F.filter(F.split(collapse(F.coalesce(t, F.lit(""))), " "), lambda w: w != "")

    def share(these: Column, others: Column) -> Column:
        met = F.filter(these, lambda w: F.exists(others, lambda o: F.levenshtein(w, o) <= tolerance * F.greatest(F.length(w), F.length(o))))
        return ratio(F.size(met), F.size(these))

    accuracy, precision = share(words(truth), words(found)), share(words(found), words(truth))
    return F.struct(accuracy.alias("accuracy"), ratio(2 * accuracy * precision, accuracy + precision).alias("f1"))


def character_error_rate(found: Column, truth: Column) -> Column:
    return ratio(F.levenshtein(found, truth), F.length(truth))


def stable_id(prefix: str, *parts: Column) -> Column:
    """prefix and 16 hex digits of SHA-1 over the parts, one a line."""
    return F.concat(F.lit(prefix), F.left(F.sha1(F.concat_ws("\n", *parts).cast("binary")), F.lit(16)))


def longer_of(a: Column, b: Column) -> Column:
    """The longer of two texts, the first if they are as long; null counts as empty."""
    a, b = F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))
    return F.when(F.length(a) >= F.length(b), a).otherwise(b)


def stable_id0(*parts: Column) -> Column:
    """16 hex digits of SHA-1 over the parts, each followed by a zero byte; null counts as the word None."""
    zero = F.unhex(F.lit("00"))
    pieces = [x for p in parts for x in (F.coalesce(p.cast("string"), F.lit("None")).cast("binary"), zero)]
    return F.left(F.sha1(F.concat(*pieces)), F.lit(16))
