"""Benchmark leaks by q-gram lemma filtering and banded alignment.

A region within k edits of a pattern of m bytes shares at least
m - q + 1 - k * q of its q-grams, all on k + 1 neighbouring diagonals. Shared
q-grams are counted in diagonal bands that overlap by half, so one band holds
all of a region's; bands that reach the bound are verified by an alignment
inside the band.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphmill.llm._bytes import mix, ranges, slices, tidied, utf8

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[9:14] = 32


@dataclass(frozen=True)
class LeakParams:
    #: Edits allowed in a region, as a share of the pattern's bytes.
    edit_rate: float = 0.08
    #: Bytes of a q-gram: it is compared as one 64-bit integer.
    q: int = 8
    #: Longer items are cut into patterns of about this many bytes; shorter ones than min_bytes are sought as they are, between word ends.
    max_pattern: int = 512
    min_bytes: int = 32
    #: Whether an item of several patterns counts only where a text has a region of each, not of any.
    whole_items: bool = False
    #: Bytes of patterns in one index, and indexes that one pass over the texts searches for.
    index_bytes: int = 1 << 20
    indexes_per_pass: int = 16


def normalise(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets, place): A-Z folded and each run of white space made one space; place maps back to the input's bytes."""
    folded = _FOLD[data]
    space = folded == 32
    stay = np.ones(len(folded), bool)
    stay[1:] = ~(space[1:] & space[:-1])
    heads = offsets[:-1][offsets[:-1] < len(folded)]
    stay[heads] = True
    place = np.flatnonzero(stay)
    return folded[place], np.searchsorted(place, offsets), place


def qgram_codes(b: np.ndarray, q: int) -> np.ndarray:
    """Every q-gram (q up to 8) as one integer."""
    n = len(b) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    wide, size = b.astype(np.uint64), 1
    code, have = wide, 1
    while 2 * have <= q:
        m = len(code) - have
        code = code[:m] | code[have : have + m] << np.uint64(8 * have)
        have *= 2
    size = have
    while size < q:
        code = code[: len(b) - size] | wide[size:] << np.uint64(8 * size)
        size += 1
    return code[:n]


class ShortIndex:
    """Items too short for the lemma, found by an automaton of all of them: exact, and between word ends."""

    def __init__(self, items: list[tuple]):
        self.item = [(i, part, parts) for i, _, part, parts in items]
        own: dict[str, list[int]] = {}
        for n, (_, b, _, _) in enumerate(items):
            own.setdefault(b.decode("latin-1"), []).append(n)
        self.words = own

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for word, numbers in self.words.items():
            found.add_word(word, (len(word), numbers))
        found.make_automaton()
        return found


class PatternIndex:
    """q-grams of a block of patterns, with where they occur. Items are (key, bytes, part, parts)."""

    def __init__(self, items: list[tuple], p: LeakParams):
        self.q = p.q
        self.item = [(i, part, parts) for i, _, part, parts in items]
        self.pattern = [b for _, b, _, _ in items]
        self.m = np.array([len(b) for b in self.pattern], np.int64)
        # as many edits as the rate allows, fewer where the lemma would ask for no q-gram
        self.k = np.minimum((p.edit_rate * self.m).astype(np.int64), (self.m - p.q) // p.q)
        self.need = self.m - p.q + 1 - self.k * p.q
        self.width = self.k + 1
        codes = [qgram_codes(np.frombuffer(b, np.uint8), p.q) for b in self.pattern]
        all_, of = np.concatenate(codes), np.repeat(np.arange(len(codes)), [len(c) for c in codes])
        at = np.concatenate([np.arange(len(c)) for c in codes])
        order = np.argsort(all_, kind="stable")
        self.of, self.at = of[order], at[order]
        self.codes, self.first = np.unique(all_[order], return_index=True)
        self.first = np.append(self.first, len(all_))
        self.bits = 20
        self.present = np.zeros(1 << self.bits, bool)
        self.present[self._slot(self.codes)] = True
        # any region has a stretch of `stretch` bytes with `dense` shared q-grams (pigeonhole)
        reach = self.m + self.k
        self.stretch = int(reach.min())
        self.dense = max(1, int((self.need // -(-reach // self.stretch)).min()))
        self.reach = int(reach.max())

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return mix(codes) >> np.uint64(64 - self.bits)

    def bands(self, text: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pattern, text index, first diagonal) of the bands that reach the bound; owner is each byte's text."""
        none = np.zeros(0, np.int64)
        codes = qgram_codes(text, self.q)
        if not len(codes):
            return none, none, none
        maybe = np.flatnonzero(self.present[self._slot(codes)])
        place = np.minimum(np.searchsorted(self.codes, codes[maybe]), len(self.codes) - 1)
        real = self.codes[place] == codes[maybe]
        hits, place = maybe[real], place[real]
        # of the hits, those near a dense stretch
        lead = np.arange(len(hits)) + self.dense - 1
        dense = np.zeros(len(hits), bool)
        inside = lead < len(hits)
        dense[inside] = hits[lead[inside]] - hits[inside] < self.stretch
        starts = hits[dense]
        if not len(starts):
            return none, none, none
        near = np.searchsorted(starts, hits + self.reach, side="right") > np.searchsorted(starts, hits - 2 * self.reach)
        hits, place = hits[near], place[near]
        many = self.first[place + 1] - self.first[place]
        where = ranges(self.first[place], many)
        pattern, diagonal = self.of[where], np.repeat(hits, many) - self.at[where]
        text_of = owner[np.repeat(hits, many)].astype(np.int64)
        band = (diagonal + self.reach) // self.width[pattern]
        n_bands = int(band.max()) + 2
        key = (pattern * (int(owner[-1]) + 1) + text_of) * n_bands
        keys, counts = np.unique(np.concatenate((key + band, key + band - (band > 0))), return_counts=True)
        pattern = keys // n_bands // (int(owner[-1]) + 1)
        full = counts >= self.need[pattern]
        keys, pattern = keys[full], pattern[full]
        return pattern, keys // n_bands % (int(owner[-1]) + 1), keys % n_bands * self.width[pattern] - self.reach


def align(pattern: bytes, text: np.ndarray, first: int, diagonals: int) -> tuple[int, int, int]:
    """(edits, begin, end) of the best alignment of the whole pattern inside a band of `text`; the earliest of the best."""
    low = max(0, first)
    plain = text[low : first + diagonals + len(pattern)].tobytes().find(pattern)
    if plain >= 0:
        return 0, low + plain, low + plain + len(pattern)
    p = np.frombuffer(pattern, np.uint8).astype(np.int16)
    padded = np.full(diagonals + len(p) + 1, -1, np.int16)
    a, b = max(0, first), min(len(text), first + len(padded))
    if a < b:
        padded[a - first : b - first] = text[a:b]
    one = np.int64(1) << np.int64(32)  # high half: edits; low half: where the alignment begins
    ramp = np.arange(diagonals, dtype=np.int64)
    state = ramp.copy()
    for i in range(len(p)):
        kept = state + np.where(padded[i : i + diagonals] == p[i], 0, one)
        kept[:-1] = np.minimum(kept[:-1], state[1:] + one)
        state = np.minimum.accumulate(kept - ramp * one) + ramp * one
    best = int(np.argmin(state >> np.int64(32)))
    edits, begin = int(state[best] >> np.int64(32)), int(state[best] & (one - 1))
    return edits, max(0, first + begin), min(len(text), first + best + len(p))


def _patterns(rows, p: LeakParams):
    """(item, pattern, part, parts) of each benchmark row that has a character: long items in even parts."""
    for item, text in rows:
        raw = re.sub(rb"[\x20\x09-\x0D]+", b" ", (text or "").encode()).strip()
        raw = _FOLD[np.frombuffer(raw, np.uint8)].tobytes()
        if not raw:
            continue
        parts = -(-len(raw) // p.max_pattern)
        cuts = [len(raw) * i // parts for i in range(parts + 1)]
        yield from ((item, raw[a:b], i, parts) for i, (a, b) in enumerate(zip(cuts, cuts[1:])))


_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _short_regions(index: ShortIndex, automaton, text: np.ndarray, at: np.ndarray):
    """(text, item, begin, end) of every occurrence of a short item that neither begins nor ends inside a word."""
    for d in range(len(at) - 1):
        own = text[at[d] : at[d + 1]]
        for last, (size, numbers) in automaton.iter(own.tobytes().decode("latin-1")) if len(own) else ():
            a, b = last + 1 - size, last + 1
            if (a and _INSIDE[own[a - 1]] and _INSIDE[own[a]]) or (b < len(own) and _INSIDE[own[b]] and _INSIDE[own[b - 1]]):
                continue
            for n in numbers:
                yield d, index.item[n], a, b


def _regions(index: PatternIndex, text: np.ndarray, at: np.ndarray):
    """(text, item, begin, end, edits) of every verified region, in normalised bytes."""
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    step, found = 4 << 20, {}
    for a in range(0, max(1, len(text)), step):
        part = text[a : a + step + 2 * index.reach]
        for pattern, d, first in zip(*(x.tolist() for x in index.bands(part, owner[a : a + len(part)]))):
            own = text[at[d] : at[d + 1]]
            edits, begin, end = align(index.pattern[pattern], own, int(a + first - at[d]), 2 * int(index.width[pattern]))
            if edits <= index.k[pattern]:
                key = (d, pattern, begin // max(1, int(index.m[pattern])))
                found[key] = min(found.get(key, (edits, begin, end)), (edits, begin, end))
    for (d, pattern, _), (edits, begin, end) in sorted(found.items()):
        close = found.get((d, pattern, begin // max(1, int(index.m[pattern])) - 1))
        if close and close[2] > begin and close[0] <= edits:
            continue  # the same region, seen from the cell before
        yield d, index.item[pattern], begin, end, edits


def _search(indexes: list, automata: dict, data: np.ndarray, offsets: np.ndarray):
    """(text, item, part, parts, begin, end, edits) of every region of any index, in bytes of the texts."""
    text, at, place = normalise(data, offsets)
    for n, index in enumerate(indexes):
        if isinstance(index, ShortIndex):
            automata[n] = automata.get(n) or index.automaton()
            found = ((*r, 0) for r in _short_regions(index, automata[n], text, at))
        else:
            found = _regions(index, text, at)
        for d, (item, part, parts), begin, end, edits in found:
            base = offsets[d]
            yield d, item, part, parts, int(place[at[d] + begin] - base), int(place[at[d] + end - 1] - base) + 1, edits


def find_leaks(docs: DataFrame, benchmark: DataFrame, params: LeakParams = LeakParams(), key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, begin, end, edits) of every region of a text that is within the edit budget of an item.

    begin and end are UTF-8 byte offsets in the text. Case of A-Z and runs of
    white space do not count. Items of more than max_pattern bytes are sought
    in parts, and a region of any part is one of the item, or, with
    whole_items, only in texts that have a region of every part. Items under
    min_bytes are sought without edits, between word ends. Null or blank
    texts and items have no regions; repeated rows and items are reported
    each; a null key stays null; empty tables give no rows; other columns are
    ignored. Items are broadcast in indexes of at most index_bytes, several a
    pass, so a broadcast does not grow with the benchmark. Long texts are
    searched whole, in overlapping parts.
    """
    p, spark = params, docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t")).where("t is not null")
    schema = "doc_id long, item_id long, begin long, end long, edits int, part int, parts int"

    def one_pass(indexes: list) -> DataFrame:
        shared = spark.sparkContext.broadcast(indexes)

        def search(batches):
            automata: dict = {}
            for batch in batches:
                for part in slices(batch, "t", 2 << 20):
                    found = list(_search(shared.value, automata, *utf8(part.column("t"))))
                    if found:
                        d, item, number, parts, begin, end, edits = zip(*found)
                        yield pa.RecordBatch.from_arrays([part.column("k").take(pa.array(d)), pa.array(item, pa.int64()), pa.array(begin, pa.int64()), pa.array(end, pa.int64()), pa.array(edits, pa.int32()), pa.array(number, pa.int32()), pa.array(parts, pa.int32())], ["doc_id", "item_id", "begin", "end", "edits", "part", "parts"])

        return rows.mapInArrow(tidied(search), schema)

    out, indexes, short, held, size = None, [], [], [], 0

    def close(last: bool = False) -> None:
        nonlocal out, indexes
        if indexes and (last or len(indexes) >= p.indexes_per_pass):
            found = one_pass(indexes)
            out, indexes = found if out is None else out.unionByName(found), []

    # the driver holds the items of one pass at a time
    for item in _patterns(benchmark.select(F.col(item_key).cast("long"), item_text).orderBy(item_key, item_text).toLocalIterator(), p):
        block = short if len(item[1]) < p.min_bytes else held
        block.append(item)
        size += len(item[1])
        if size >= p.index_bytes:
            indexes += ([ShortIndex(short)] if short else []) + ([PatternIndex(held, p)] if held else [])
            short, held, size = [], [], 0
            close()
    indexes += ([ShortIndex(short)] if short else []) + ([PatternIndex(held, p)] if held else [])
    close(last=True)
    if out is None:
        return spark.createDataFrame([], schema).drop("part", "parts")
    if p.whole_items:
        whole = out.groupBy("doc_id", "item_id", "parts").agg(F.count_distinct("part").alias("n")).where("n = parts").select(F.col("doc_id").alias("d"), F.col("item_id").alias("i"))
        out = out.join(whole, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("item_id").eqNullSafe(F.col("i")), "left_semi")
    return out.drop("part", "parts")


def op4_benchmark_leaks(spark, sf_dir: str) -> DataFrame:
    return find_leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
