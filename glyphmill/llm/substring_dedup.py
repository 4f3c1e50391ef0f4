"""Removal of repeated passages by relative Lempel-Ziv parsing over words.

Documents are put in key order and cut into reference blocks. Every block is
indexed: its 20-word windows are hashed to 128 bits and kept with their place,
and the index is dealt out by hash, so that one exchange matches each block
against all the blocks before it and returns where each window starts first. A
document is then parsed greedily: a factor is a match at one place of one
reference block (or earlier in the own one), and runs on as long as the next
window's place is the next word there. Where a factor ends, the windows that
cross its boundary have been looked up one by one, and one that is repeated
begins the next factor, which may overlap this one. The union of the factors
is what is removed, judged on the input.

To keep the exchange small, a first exchange deals out anchors only: the
smallest 8-word hash inside each window. Equal windows have equal anchors, so
a window whose anchor occurs in no other block has no copy there.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphmill.llm._bytes import bucket_bits, bucket_runs, grams, hash_words, mix, split_words, tidied, tidied_group, utf8
from glyphmill.llm._spark import keep, open_folder, shared_dir


@dataclass(frozen=True)
class SubstringParams:
    #: Words of a window: a copied passage of at least this length is removed.
    window: int = 20
    #: Words of an anchor, at most `window`.
    anchor: int = 8
    #: UTF-8 bytes of text in a reference block, about.
    block_bytes: int = 6 << 20
    #: Index entries that a matching task gets, about.
    entries_per_bucket: int = 1 << 20
    #: Partitions of an exchange and folders of looked-up entries, at most; more buckets and blocks share them.
    max_partitions: int = 1 << 15
    max_folders: int = 1 << 12


def _sliding_min(x: np.ndarray, k: int) -> np.ndarray:
    """The smallest of every k consecutive values."""
    n, width = len(x) - k + 1, 1
    if n <= 0:
        return x[:0]
    while 2 * width <= k:
        x = np.minimum(x[: len(x) - width], x[width:])
        width *= 2
    return np.minimum(x[:n], x[k - width : k - width + n])


def _small(x: np.ndarray, below: int) -> np.ndarray:
    """Numbers under `below` in 32 bits if they fit."""
    return x.astype(np.int32) if below < 1 << 31 else x


#: Windows hashed at once, and UTF-8 bytes of text in a batch of results, about: what is beside a block's own arrays stays that small.
_PIECE = 1 << 16
_RESULT_BYTES = 1 << 20


class Block:
    """One reference block: its rows, words, windows and anchors. Window w starts at word at[w]."""

    def __init__(self, table: pa.Table, p: SubstringParams, windows: bool = True, anchors: bool = True):
        self.table, self.p = table, p
        self.data, self.offsets = utf8(table.column("t"))
        start, end, self.first = split_words(self.data, self.offsets)
        h = hash_words(self.data, start, end)
        self.start, self.end = _small(start, len(self.data)), _small(end, len(self.data))
        del start, end
        counts = np.maximum(0, np.diff(self.first) - p.window + 1)
        self.at = _small(np.flatnonzero(np.add.accumulate(self._steps(len(h), counts), dtype=np.int8)), len(h))
        if anchors:
            # minima are small numbers; mixed, they spread over the buckets
            self.anchor = self._hashed(lambda x: mix(_sliding_min(grams(x, p.anchor, 3), p.window - p.anchor + 1)), h)
        if windows:
            self.high, self.low = (self._hashed(lambda x, seed=seed: grams(x, p.window, seed), h) for seed in (1, 2))

    def _steps(self, words: int, counts: np.ndarray) -> np.ndarray:
        steps = np.zeros(words + 1, np.int8)  # a text's last window starts before the next text
        has = counts > 0
        steps[self.first[:-1][has]] = 1
        steps[self.first[:-1][has] + counts[has]] = -1
        return steps

    def _hashed(self, function, h: np.ndarray) -> np.ndarray:
        """What function gives for each window, from the hashes of its words; a piece of the windows at a time."""
        out = np.empty(len(self.at), np.uint64)
        for i in range(0, len(out), _PIECE):
            own = self.at[i : i + _PIECE]
            out[i : i + _PIECE] = function(h[own[0] : int(own[-1]) + self.p.window])[own - own[0]]
        return out

    def heads(self, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(windows, head): the windows at `among`, which ascend, sorted by hash and place, and of each the first of its content."""
        high, low = self.high[among], self.low[among]
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        new = np.ones(len(order), bool)
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        order = among[order]
        return order, order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]

    def twins(self, among: np.ndarray) -> np.ndarray:
        """Those of the windows at `among` that share the first half of their hash with another one of them."""
        high = self.high[among]
        order = np.argsort(high)
        high = high[order]
        same = high[1:] == high[:-1]
        twin = np.zeros(len(order), bool)
        twin[order[1:][same]] = True
        twin[order[:-1][same]] = True
        return among[twin]

    def places(self, windows: np.ndarray) -> np.ndarray:
        """Where windows start: the block's number and the word in it, as one integer."""
        return np.uint64(self.table.column("block")[0].as_py()) << np.uint64(32) | self.at[windows].astype(np.uint64)


#: A window that starts nowhere before.
NOWHERE = np.uint64(2**64 - 1)


def _deal(batches, prepare, bits: int):
    """Rows (bucket, block, entries) of each block's entries, sorted by their first column, one row a bucket."""
    for table in _blocks(batches):
        number = table.column("block")[0].as_py()
        entries = prepare(table, number)
        if not len(entries):
            continue
        full, cuts = bucket_runs(entries[:, 0], bits)
        yield pa.RecordBatch.from_arrays(
            [pa.array(full, pa.int64()), pa.array(np.full(len(full), number), pa.int64()), pa.array([x.tobytes() for x in np.split(entries, cuts)], pa.binary())],
            ["bucket", "block", "entries"],
        )


def _blocks(batches):
    """Tables of one whole block each, from batches in order of block."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        numbers = batch.column("block").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if held and held[-1].column("block")[0].as_py() != numbers[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _match(width: int, later_only: bool):
    """For a bucket's rows: to each block the entries that other blocks hold too.

    later_only: those that a smaller block holds, with the place there (the
    last column) in place of the block's own.
    """
    keys = width - 1 if later_only else width

    def match(table: pa.Table) -> pa.Table:
        blocks = table.column("block").to_numpy()
        parts = [np.frombuffer(raw.as_py(), np.uint64).reshape(-1, width) for raw in table.column("entries")]
        entries = np.concatenate(parts)
        owner = np.repeat(blocks, [len(x) for x in parts])
        order = np.lexsort((owner, *(entries[:, i] for i in reversed(range(keys)))))
        entries, owner = entries[order], owner[order]
        same = np.zeros(len(entries), bool)
        same[1:] = (entries[1:, :keys] == entries[:-1, :keys]).all(axis=1)
        shared = same.copy()
        if later_only:
            entries[:, -1] = entries[np.maximum.accumulate(np.where(same, 0, np.arange(len(entries)))), -1]
        else:
            shared[:-1] |= same[1:]
        entries, owner = entries[shared], owner[shared]
        order = np.argsort(owner, kind="stable")
        entries, owner = entries[order], owner[order]
        names, at = np.unique(owner, return_index=True)
        return pa.table({"block": pa.array(names, pa.int64()), "entries": pa.array([x.tobytes() for x in np.split(entries, at[1:])] if len(names) else [], pa.binary())})

    return match


class Side:
    """A written table (block, entries) in a bounded number of folders, in which the tasks that parse a block look it up."""

    def __init__(self, path: str, blocks: int, width: int, p: SubstringParams):
        self.path, self.blocks, self.width, self.folders = path, blocks, width, max(1, min(blocks, p.max_folders))

    def write(self, found: DataFrame) -> Side:
        # neighbouring blocks share a folder; rows of a block lie together, in row groups of a few megabytes
        rows = found.withColumn("slot", F.floor(F.col("block") * self.folders / self.blocks).cast("int"))
        rows.repartition(self.folders, "slot").sortWithinPartitions("slot", "block").write.partitionBy("slot").option("parquet.block.size", str(4 << 20)).parquet(self.path)
        return self

    def entries(self, block: int) -> np.ndarray:
        """The entries that were found for a block, sorted by their first column."""
        files, root = open_folder(self.path)
        listed = files.get_file_info(pafs.FileSelector(f"{root}/slot={block * self.folders // self.blocks}", allow_not_found=True))
        parts = []
        for info in listed:
            if not info.path.endswith(".parquet"):
                continue
            with files.open_input_file(info.path) as raw:
                file = pq.ParquetFile(raw)
                column = file.schema_arrow.get_field_index("block")
                for g in range(file.num_row_groups):
                    seen = file.metadata.row_group(g).column(column).statistics
                    if seen is None or not seen.has_min_max or seen.min <= block <= seen.max:
                        group = file.read_row_group(g, ["block", "entries"])
                        own = np.flatnonzero(group.column("block").to_numpy() == block)
                        parts += [np.frombuffer(x.as_py(), np.uint64).reshape(-1, self.width) for x in group.column("entries").take(pa.array(own))]
        entries = np.concatenate(parts) if parts else np.zeros((0, self.width), np.uint64)
        return entries[np.argsort(entries[:, 0], kind="stable")]


def _find(entries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The place that the entry of each (high, low) gives, or NOWHERE. Entries are sorted by high; equal highs are scanned."""
    found = np.full(len(high), NOWHERE)
    if not len(entries):
        return found
    at, stop = np.searchsorted(entries[:, 0], high), np.searchsorted(entries[:, 0], high, side="right")
    open_ = np.flatnonzero(at < stop)
    while len(open_):
        hit = entries[at[open_], 1] == low[open_]
        found[open_[hit]] = entries[at[open_[hit]], 2]
        open_ = open_[~hit]
        at[open_] += 1
        open_ = open_[at[open_] < stop[open_]]
    return found


def _sources(block: Block, entries: np.ndarray) -> np.ndarray:
    """Where each window's content stands first: in earlier blocks, by their entries, else in this one before it, or NOWHERE."""
    source = np.full(len(block.at), NOWHERE)
    for i in range(0, len(source), _PIECE):
        own = slice(i, i + _PIECE)
        source[own] = _find(entries, block.high[own], block.low[own])
    order, head = block.heads(block.twins(np.flatnonzero(source == NOWHERE)))
    again = order != head
    source[order[again]] = block.places(head[again])
    del block.high, block.low  # the texts need them no more
    return source


def parse_factors(source: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, words, place) of each factor, from the sorted starts of windows and where each starts before.

    A factor goes on while the next word's window starts at the next word of
    the same place, so it is one match; the next repeated window begins the
    next factor, even inside the words of this one.
    """
    repeated = np.flatnonzero(source != NOWHERE)
    starts, places = at[repeated], source[repeated]
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    begin = np.concatenate(([True], (np.diff(starts) != 1) | (np.diff(places) != 1)))
    heads = np.flatnonzero(begin)
    tails = np.append(heads[1:], len(starts)) - 1
    return starts[heads], starts[tails] - starts[heads] + window, places[heads]


def find_repeats(docs: DataFrame, params: SubstringParams = SubstringParams(), key: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, spans, kept_text) of every row.

    spans are the factors of a text: first word, words, and where the match
    lies, as a block of the input in key order and a word in it. kept_text is the
    text without the words of its factors: each run of removed words goes with
    the white space after it, and the rest stays as it was. kept_sha256 is
    that of the kept words joined by one space. A null text has no words and
    stays null. Rows are in the order of (key, text), null keys first, so of
    repeated rows the first keeps its words; an empty table gives no rows;
    other columns are ignored. A text longer than a block makes a block of
    its own. Windows are compared by 128-bit hashes. `carry` names columns that
    come along as a struct, `carried`.
    """
    p, spark = params, docs.sparkSession
    at = shared_dir(spark, "substring")
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    blocks = max(1, -(-size // p.block_bytes))
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"), *([F.struct(*carry).alias("carried")] if carry else []))
    rows = rows.repartitionByRange(blocks, "k").sortWithinPartitions("k", "t").withColumn("block", F.spark_partition_id().cast("long"))
    # one row group a file: a block is read by one task, in order
    store = keep(rows, f"{at}/blocks", **{"parquet.block.size": str(1 << 30), "compression": "zstd"})

    def anchors(table, number):
        return np.unique(Block(table, p, windows=False).anchor).reshape(-1, 1)

    def exchange(prepare, entries: int, width: int, later_only: bool) -> DataFrame:
        bits = bucket_bits(entries, p.entries_per_bucket)
        dealt = store.select("block", "t").mapInArrow(tidied(lambda it: _deal(it, prepare, bits)), "bucket long, block long, entries binary")
        return dealt.repartition(min(1 << bits, p.max_partitions), "bucket").groupBy("bucket").applyInArrow(tidied_group(_match(width, later_only)), "block long, entries binary")

    # a word has about six bytes, an anchor serves about seven windows
    shared = Side(f"{at}/anchors", blocks, 1, p).write(exchange(anchors, size // (6 * 7), 1, False))

    def candidates(block: Block, number: int) -> np.ndarray:
        known = shared.entries(number)[:, 0]
        if not len(known):
            return np.zeros(0, np.int64)
        place = np.minimum(np.searchsorted(known, block.anchor), len(known) - 1)
        return np.flatnonzero(known[place] == block.anchor)

    def windows(table, number):
        block = Block(table, p)
        among = candidates(block, number)
        del block.anchor
        order, head = block.heads(among)
        own = order[order == head]
        return np.stack((block.high[own], block.low[own], block.places(own)), axis=1)

    earlier = Side(f"{at}/windows", blocks, 3, p).write(exchange(windows, size // (6 * 2), 3, True))

    def parse(batches):
        for table in _blocks(batches):
            block = Block(table, p, anchors=False)
            yield from _results(block, _sources(block, earlier.entries(table.column("block")[0].as_py())), p)

    kind = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<first:int,words:int,block:long,word:int>>, kept_text string"
    return store.mapInArrow(tidied(parse), kind + (f", carried {store.schema['carried'].dataType.simpleString()}" if carry else ""))


def _results(block: Block, source: np.ndarray, p: SubstringParams):
    words = len(block.start)
    start, length, place = parse_factors(source, block.at, p.window)
    gone = np.zeros(words + 1, np.int32)
    np.add.at(gone, start, 1)
    np.add.at(gone, start + length, -1)
    gone = np.cumsum(gone, dtype=np.int32)[:words] > 0
    edges = np.searchsorted(start, block.first)  # a factor begins at a window, and windows lie inside a document
    n = np.diff(block.first)
    cuts = np.flatnonzero(np.diff(block.offsets[:-1] // _RESULT_BYTES)) + 1
    for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(n)]):
        table = block.table.slice(low, high - low).combine_chunks()
        column = table.column("t")
        sha, n_removed, kept_text = [], [], []
        for d in range(low, high):
            a, b = int(block.first[d]), int(block.first[d + 1])
            stay = a + np.flatnonzero(~gone[a:b])
            n_removed.append(b - a - len(stay))
            kept_text.append(_without(block, gone, a, b, column, d - low) if n_removed[-1] else column[d - low].as_py())
            sha.append(hashlib.sha256(_joined(block, stay)).hexdigest())
        w = slice(edges[low], edges[high])
        first = start[w] - np.repeat(block.first[low:high], np.diff(edges[low : high + 1]))
        factors = pa.StructArray.from_arrays([pa.array(first, pa.int32()), pa.array(length[w], pa.int32()), pa.array((place[w] >> np.uint64(32)).astype(np.int64)), pa.array((place[w] & np.uint64(0xFFFFFFFF)).astype(np.int32))], ["first", "words", "block", "word"])
        spans = pa.ListArray.from_arrays(pa.array(edges[low : high + 1] - edges[low], pa.int32()), factors)
        columns = {"doc_id": table.column("k"), "n_words": pa.array(n[low:high]), "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(sha), "spans": spans, "kept_text": pa.array(kept_text, pa.string())}
        if "carried" in table.column_names:
            columns["carried"] = table.column("carried")
        yield pa.RecordBatch.from_arrays([x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in columns.values()], list(columns))


def _joined(block: Block, words: np.ndarray) -> bytes:
    """These words joined by one space: the text's own bytes where words are neighbours by one space."""
    if not len(words):
        return b""
    start, end, data = block.start[words], block.end[words], block.data
    plain = np.zeros(len(words), bool)
    plain[1:] = (start[1:] == end[:-1] + 1) & (data[end[:-1]] == 0x20) if len(words) > 1 else plain[1:]
    heads = np.flatnonzero(~plain)
    tails = np.append(heads[1:], len(words)) - 1
    return b" ".join(data[start[x] : end[y]].tobytes() for x, y in zip(heads, tails))


def _without(block: Block, gone: np.ndarray, a: int, b: int, column, d: int) -> str:
    raw = column[d].as_py().encode()
    base = int(block.start[a]) - (len(raw) - len(raw.lstrip(b" \t\n\v\f\r")))
    out, at = [], 0
    flags = np.concatenate(([False], gone[a:b], [False]))
    heads, tails = np.flatnonzero(flags[1:] & ~flags[:-1]), np.flatnonzero(flags[:-1] & ~flags[1:])
    for x, y in zip(heads, tails):
        out.append(raw[at : int(block.start[a + x]) - base])
        at = int(block.start[a + y]) - base if a + y < b else len(raw)
    out.append(raw[at:])
    return b"".join(out).decode()


def op9_relative_lz(spark, sf_dir: str) -> DataFrame:
    return find_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_words", "n_removed", "kept_sha256")
