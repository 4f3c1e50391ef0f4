"""Length bins and the length decision for text pairs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glyphmill.functions.text import fixed

# The bins of the first side, their mirrors on the second, its caps, and the ratio window.
EN_BINS = (64, 128, 256, 512, 1024)
ZH_BINS = (36, 72, 144, 288, 576)
ZH_CAPS = tuple(int(b * 1.4) for b in ZH_BINS)
RATIO = (0.30, 1.20)


def bin_for(length: Column) -> Column:
    """The smallest bin that holds a length; the last one for all longer."""
    out = F.lit(EN_BINS[-1])
    for b in reversed(EN_BINS[:-1]):
        out = F.when(length <= b, b).otherwise(out)
    return out


def by_bin(anchor: Column, values) -> Column:
    """The value that belongs to a bin; a number that is no bin is an error."""
    out = F.when(anchor.isNull(), F.lit(None).cast("int"))
    for b, value in zip(EN_BINS, values):
        out = out.when(anchor == b, value)
    return out.otherwise(F.raise_error(F.concat(F.lit("no length bin: "), anchor.cast("string"))).cast("int"))


def zh_cap(anchor: Column) -> Column:
    return by_bin(anchor, ZH_CAPS)


def decide_pair(en: Column, zh: Column, anchor: Column | None = None) -> Column:
    """A struct: bin, cut texts, actual lengths, which side was cut, the ratio after cutting and the reason to drop the pair, if any.

    Without an anchor, or with 0, the bin is that of the first text; an anchor
    that is no bin is an error.
    """
    bin_ = bin_for(F.length(en)) if anchor is None else F.when(F.coalesce(anchor, F.lit(0)) == 0, bin_for(F.length(en))).otherwise(anchor)
    cap = zh_cap(bin_)
    kept_en, kept_zh = F.left(en, bin_), F.left(zh, cap)
    share = F.try_divide(F.length(kept_zh).cast("double"), F.length(kept_en).cast("double"))
    out_of_range = (share < RATIO[0]) | (share > RATIO[1])
    reason = F.when((F.length(kept_en) == 0) | (F.length(kept_zh) == 0), "empty_side").when(out_of_range, F.concat(F.lit("length_ratio_out_of_range:"), fixed(F.when(out_of_range, share), 2)))
    return F.struct(bin_.alias("bin"), kept_en.alias("en"), kept_zh.alias("zh"), by_bin(bin_, ZH_BINS).alias("zh_bin"), F.length(kept_en).alias("en_chars"), F.length(kept_zh).alias("zh_chars"), (F.length(en) > bin_).alias("cut_en"), (F.length(zh) > cap).alias("cut_zh"), share.alias("ratio"), reason.alias("drop_reason"))
