"""Quality predicates: a boolean Column, and the first reason to reject a text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from glyphmill.functions import text as T


@dataclass(frozen=True)
class UnitRules:
    min_units: int = 10
    min_unique_ratio: float = 0.3
    max_run: int = 3
    min_cjk_ratio: float = 0.0


@dataclass(frozen=True)
class CharRules:
    min_chinese_ratio: float = 0.95
    min_unique_ratio: float = 0.30
    max_run: int = 3
    min_chars: int = 7


def valid_long_text(text: Column, rules: UnitRules = UnitRules()) -> Column:
    """Whether a text, after NFKC, has enough units, enough different ones, no long run of one and, if asked for, enough CJK characters."""
    p = T.unit_profile(text)
    ok = (p["units"] >= rules.min_units) & (T.ratio(p["distinct"], p["units"]) >= rules.min_unique_ratio) & (p["run"] <= rules.max_run)
    return ok & (T.ratio(p["cjk"], p["plain"]) >= rules.min_cjk_ratio) if rules.min_cjk_ratio else ok


def quality_reason(text: Column, rules: CharRules = CharRules()) -> Column:
    """Why a text fails, or `ok`."""
    p = T.char_profile(text)
    return (
        F.when(p["chars"] == 0, "empty")
        .when(p["chars"] < rules.min_chars, "short")
        .when(T.ratio(p["han"], p["chars"]) < rules.min_chinese_ratio, "script")
        .when(T.ratio(p["distinct"], p["chars"]) < rules.min_unique_ratio, "repetitive")
        .when(p["run"] > rules.max_run, "run")
        .otherwise("ok")
    )


def passes_text_quality(text: Column, rules: CharRules = CharRules()) -> Column:
    return quality_reason(text, rules) == "ok"


def long_words_lines(lines: Column, min_chinese: float | None = 0.2) -> Column:
    """Cleaned lines (structs with `text`) of more than one character; min_chinese None keeps every script."""
    cleaned = F.transform(lines, lambda x: x.withField("text", T.clean_text(x["text"])))

    def stays(x: Column) -> Column:
        long = F.length(x["text"]) > 1
        return long if min_chinese is None else long & (T.chinese_ratio(x["text"]) >= min_chinese)

    return F.filter(cleaned, stays)


def long_words_valid(joined: Column, rules: CharRules = CharRules()) -> Column:
    return (F.length(joined) >= rules.min_chars) & (T.unique_char_ratio(joined) >= rules.min_unique_ratio) & ~T.has_char_run(joined, rules.max_run)


def min_clean_length(text: Column, target: Column) -> Column:
    return F.length(text) >= F.least(F.floor(target / 2), F.lit(32))


def min_pair_length(en: Column, zh: Column, target: Column) -> Column:
    return (F.length(en) >= F.least(F.floor(target / 2), F.lit(16))) & (F.length(zh) >= 8)


def total_chars(texts: Column) -> Column:
    """Characters of all texts of an array together; nulls count as empty."""
    return F.length(F.array_join(texts, ""))


def min_total_chars(texts: Column, least: int) -> Column:
    """Scenes need ten characters in all, slides five."""
    return total_chars(texts) >= least


# The detector's classes for which an image is dropped.
BANNED_CLASSES = ("FEMALE_BREAST_EXPOSED", "MALE_GENITALIA_EXPOSED")


def drop_image(classes: Column, banned=BANNED_CLASSES) -> Column:
    """Whether a detector found a banned class in an image; an image without an answer (null) stays."""
    return F.coalesce(F.exists(classes, lambda c: c.isin(*banned)), F.lit(False))


def not_blank(text: Column) -> Column:
    return T.collapse_ends(F.coalesce(text, F.lit(""))) != ""


def has_items(items: Column) -> Column:
    return F.coalesce(F.size(items), F.lit(0)) > 0


def similar_enough(a: Column, b: Column, least: float = 0.78) -> Column:
    """Cosine of unit vectors at least `least`; a missing vector passes."""
    return F.coalesce(cosine(a, b), F.lit(1.0)) >= least


def cross_similarity(text_a: Column, text_b: Column, a: Column, b: Column) -> Column:
    """Cosine of two texts' unit vectors, 0 where either text is blank."""
    return F.when(not_blank(text_a) & not_blank(text_b), cosine(a, b)).otherwise(F.lit(0.0))


def cosine(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def needs_review(divergence: Column | None = None, similarity: Column | None = None) -> Column:
    return divergence > 0.5 if divergence is not None else F.coalesce(similarity, F.lit(0.0)) < 0.6


def axis_aligned(points: Column) -> Column:
    def few(axis: str) -> Column:
        return F.size(F.array_distinct(F.transform(points, lambda p: F.bround(p[axis])))) <= 2

    return few("x") & few("y")
