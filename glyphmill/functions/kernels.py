"""Code-point kernels behind the text functions: a slice of an Arrow column at a time.

Texts are joined into one array of code points with the offset at which each
begins. A unit is one CJK character or one maximal run of other letters and
digits; classes come from Python's own tables.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np
import pyarrow as pa

#: Code points of texts that are looked at together, a dozen numbers each in every worker; a longer text is a slice of its own.
SLICE = 1 << 18
_OTHER, _CJK, _WORD, _LOW_LINE, _SPACE = range(5)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Base of the polynomial hashes, odd.
_BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """The finalising permutation of splitmix64, element by element."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


@functools.cache
def _classes() -> np.ndarray:
    kind = np.zeros(0x110000, np.uint8)
    for i in range(0x110000):
        c = chr(i)
        if c.isalnum():
            kind[i] = _WORD
        elif c.isspace():
            kind[i] = _SPACE
    kind[ord("_")] = _LOW_LINE
    for low, high in ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF)):
        kind[low : high + 1] = _CJK
    return kind


@functools.cache
def _lower() -> np.ndarray:
    """Lower case of each code point; U+0130, whose lower case is two, and U+03A3, whose lower case depends on its place, are for the caller."""
    lower = np.arange(0x110000, dtype=np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isupper() or c.istitle():
            small = c.lower()
            if len(small) == 1:
                lower[i] = ord(small)
    return lower


def nfkc(text: str | None) -> str:
    if text is None:
        return ""
    return text if text.isascii() or unicodedata.is_normalized("NFKC", text) else unicodedata.normalize("NFKC", text)


def slices(column: pa.Array, limit: int = SLICE, normal: bool = False):
    """Lists of texts with about `limit` code points together; a null counts as empty."""
    held, size = [], 0
    for text in column.to_pylist():
        text = nfkc(text) if normal else text or ""
        if held and size + len(text) > limit:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points, offsets) of texts."""
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), offsets


def unit_edges(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(class of each code point, start and end of every unit, first): text d's units are first[d] to first[d + 1] - 1."""
    kind = _classes()[codes]
    n = len(kind)
    if not n:
        return kind, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    head = np.zeros(n + 1, bool)
    head[offsets] = True
    word, cjk = kind == _WORD, kind == _CJK
    starts, stops = cjk.copy(), cjk.copy()
    starts[0] |= word[0]
    starts[1:] |= word[1:] & (~word[:-1] | head[1:-1])
    stops[-1] |= word[-1]
    stops[:-1] |= word[:-1] & (~word[1:] | head[1:-1])
    start, end = np.flatnonzero(starts), np.flatnonzero(stops) + 1
    return kind, start, end, np.searchsorted(start, offsets)


def _value(codes: np.ndarray) -> np.ndarray:
    return mix(codes.astype(np.uint64) + np.uint64(_BASE))


def unit_hashes(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, factor) of every unit in lower case: that of two units written together is hash0 + factor0 * hash1."""
    lead = codes[start]
    single = (end - start == 1) & (lead != 0x130) & (lead != 0x3A3)
    h, factor = np.empty(len(start), np.uint64), np.full(len(start), _BASE, np.uint64)
    h[single] = _value(_lower()[lead[single]])
    words = np.flatnonzero(~single)
    if not len(words):
        return h, factor
    start, size = start[words], (end - start)[words]
    before = np.concatenate(([0], np.cumsum(size)))
    inside = np.arange(before[-1]) - np.repeat(before[:-1], size)
    chosen = codes[np.repeat(start, size) + inside]
    low = _lower()[chosen]
    odd = np.flatnonzero((chosen == 0x130) | (chosen == 0x3A3))
    if len(odd):  # lower case that depends on the word or is longer: unit by unit
        units = np.unique(np.searchsorted(before, odd, side="right") - 1)
        parts, at = [], 0
        size = size.copy()
        for u in units.tolist():
            small = code_points([chosen[before[u] : before[u + 1]].tobytes().decode("utf-32-le", "surrogatepass").lower()])[0]
            parts += [low[at : before[u]], small]
            at, size[u] = before[u + 1], len(small)
        low = np.concatenate([*parts, low[at:]])
        before = np.concatenate(([0], np.cumsum(size)))
        inside = np.arange(before[-1]) - np.repeat(before[:-1], size)
    powers = np.full(int(size.max()) + 1, _BASE, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    h[words], factor[words] = np.add.reduceat(_value(low) * powers[inside], before[:-1]), powers[size]
    return h, factor


def longest_runs(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Of each text's values, the length of the longest run of equal neighbours."""
    texts, out = len(first) - 1, np.zeros(len(first) - 1, np.int64)
    if not len(values):
        return out
    owner = np.repeat(np.arange(texts), np.diff(first))
    heads = np.flatnonzero(np.concatenate(([True], (values[1:] != values[:-1]) | (owner[1:] != owner[:-1]))))
    np.maximum.at(out, owner[heads], np.diff(np.append(heads, len(values))))
    return out


def distinct(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """How many different values each text has. Each text's values are sorted by themselves, which stays in the cache."""
    if not len(values):
        return np.zeros(len(first) - 1, np.int64)
    values = values.copy()
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a > 1:
            values[a:b].sort()
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    new[first[:-1][first[:-1] < len(values)]] = True
    return per_text(new, first)


def per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    seen = np.concatenate(([0], np.cumsum(mask)))
    return seen[offsets[1:]] - seen[offsets[:-1]]


def unit_profile(column: pa.Array) -> dict[str, np.ndarray]:
    """After NFKC: units, distinct units, the longest run of one unit, CJK characters, and characters that are no punctuation or space."""
    parts = []
    for texts in slices(column, normal=True):
        codes, offsets = code_points(texts)
        kind, start, end, first = unit_edges(codes, offsets)
        h, _ = unit_hashes(codes, start, end)
        parts.append((np.diff(first), distinct(h, first), longest_runs(h, first), per_text(kind == _CJK, offsets), per_text((kind != _OTHER) & (kind != _SPACE), offsets)))
    names = ("units", "distinct", "run", "cjk", "plain")
    return {name: np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i, name in enumerate(names)}


def char_profile(column: pa.Array) -> dict[str, np.ndarray]:
    """Of the text as it is: characters, Han characters (4E00 to 9FFF), distinct characters and the longest run of one character."""
    parts = []
    for texts in slices(column):
        codes, offsets = code_points(texts)
        parts.append((np.diff(offsets), per_text((codes >= 0x4E00) & (codes <= 0x9FFF), offsets), distinct(codes, offsets), longest_runs(codes, offsets)))
    names = ("chars", "han", "distinct", "run")
    return {name: np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i, name in enumerate(names)}


def gram_tokens(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, first): sorted 64-bit tokens of each text's multiset of n-grams of units.

    A token is an n-gram, its units in lower case written together, and which
    of its occurrences it is, so that the overlap of multisets is that of
    sets. A text of fewer than n units has its units as they are.
    """
    codes, offsets = code_points(texts)
    _, start, end, first = unit_edges(codes, offsets)
    h, factor = unit_hashes(codes, start, end)
    units = np.diff(first)
    gram = h
    for i in range(1, n):  # gram of i + 1 units: the first one, then the gram of i units after it
        longer = h.copy()
        longer[: len(h) - 1] += factor[: len(h) - 1] * gram[1:] if len(h) else 0
        gram = longer
    long = np.repeat(units >= n, units)
    place = np.arange(len(h)) - np.repeat(first[:-1], units)
    kept = ~long | (place <= np.repeat(units, units) - n)
    gram = np.where(long, gram, h)[kept]
    size = np.where(units >= n, units - n + 1, units)
    owner = np.repeat(np.arange(len(texts)), size)
    order = np.lexsort((gram, owner))
    gram = gram[order]
    heads = np.concatenate(([True], (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1]))) if len(gram) else np.zeros(0, bool)
    at = np.flatnonzero(heads)
    again = np.arange(len(gram)) - np.repeat(at, np.diff(np.append(at, len(gram))))
    tokens = mix(gram + again.astype(np.uint64) * _M2)
    tokens = tokens[np.lexsort((tokens, owner))]
    return tokens, np.concatenate(([0], np.cumsum(size)))
