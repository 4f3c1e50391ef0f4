"""Token ids in bit-packed files: every id in the vocabulary's minimum number of bits.

A file holds blocks of BLOCK ids, each a whole number of 64-bit words, then a
footer with the documents' keys, their first ids and the blocks' byte offsets,
then a fixed trailer. Any id range is read from the blocks that cover it.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glyphmill.llm._bytes import slices, tidied, utf8
from glyphmill.llm._spark import keep, open_folder, shared_dir
from glyphmill.llm.tokens import forget_units, loaded, public_path

MAGIC = b"GMTOKEN1"
#: Ids in a block: a multiple of 64, so blocks end on words.
BLOCK = 8192
_TRAILER = struct.Struct("<8sIIqqq")


@dataclass(frozen=True)
class StoreParams:
    tokenizer: str = "byte_bpe_50k.json"
    end_id: int = 0
    #: UTF-8 bytes of text that a writing task gets, about, and ids after which it starts another file.
    bytes_per_task: int = 24 << 20
    ids_per_file: int = 16 << 20


def pack_bits(ids: np.ndarray, bits: int) -> np.ndarray:
    """64-bit words that hold the ids, `bits` each, low bits first; the last group is filled up with zeros."""
    groups = -(-len(ids) // 64)
    lanes = np.zeros((groups, 64), np.uint64)
    lanes.reshape(-1)[: len(ids)] = ids
    out = np.zeros((groups, bits), np.uint64)
    for i in range(64):
        word, shift = divmod(i * bits, 64)
        out[:, word] |= lanes[:, i] << np.uint64(shift)
        if shift + bits > 64:
            out[:, word + 1] |= lanes[:, i] >> np.uint64(64 - shift)
    return out.reshape(-1)


def unpack_bits(words: np.ndarray, bits: int, n: int) -> np.ndarray:
    """The first n ids of packed words, as uint32."""
    packed = words.reshape(-1, bits)
    out = np.empty((len(packed), 64), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for i in range(64):
        word, shift = divmod(i * bits, 64)
        lane = packed[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            lane = lane | packed[:, word + 1] << np.uint64(64 - shift)
        out[:, i] = lane & mask
    return out.reshape(-1)[:n]


def min_bits(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


class StoreWriter:
    """One file, written front to back under a temporary name and renamed when whole."""

    def __init__(self, folder: str, name: str, bits: int):
        self.files, self.root = open_folder(folder)
        self.name, self.bits = name, bits
        self.hidden = f"{self.root}/.{name}.{uuid.uuid4().hex}"
        self.out = self.files.open_output_stream(self.hidden)
        self.keys, self.sizes, self.blocks, self.at, self.rest, self.n = [], [], [], 0, np.zeros(0, np.uint32), 0

    def _write(self, ids: np.ndarray) -> None:
        for i in range(0, len(ids), BLOCK):
            raw = pack_bits(ids[i : i + BLOCK], self.bits).tobytes()
            self.blocks.append(self.at)
            self.out.write(raw)
            self.at += len(raw)

    def add(self, keys: list, sizes: np.ndarray, ids: np.ndarray) -> None:
        self.keys += keys
        self.sizes.append(sizes)
        self.n += len(ids)
        ids = np.concatenate((self.rest, ids))
        whole = len(ids) // BLOCK * BLOCK
        self._write(ids[:whole])
        self.rest = ids[whole:]

    def close(self) -> dict:
        self._write(self.rest)
        first = np.concatenate(([0], np.cumsum(np.concatenate(self.sizes) if self.sizes else [])))
        null = np.array([k is None for k in self.keys], np.uint8)
        footer = np.array([k if k is not None else 0 for k in self.keys], np.int64).tobytes() + null.tobytes() + first.astype(np.int64).tobytes() + np.array([*self.blocks, self.at], np.int64).tobytes()
        self.out.write(footer)
        self.out.write(_TRAILER.pack(MAGIC, self.bits, BLOCK, len(self.keys), self.n, self.at))
        self.out.close()
        self.files.move(self.hidden, f"{self.root}/{self.name}")
        return {"file": self.name, "ids": self.n, "docs": len(self.keys), "bytes": self.at + len(footer) + _TRAILER.size}


class StoreFile:
    """A file's content with random access by document."""

    def __init__(self, raw: bytes):
        magic, self.bits, self.block, docs, self.n, data = _TRAILER.unpack_from(raw, len(raw) - _TRAILER.size)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = data
        keys = np.frombuffer(raw, np.int64, docs, at)
        null = np.frombuffer(raw, np.uint8, docs, at + 8 * docs)
        self.keys = [None if z else int(k) for k, z in zip(keys, null)]
        self.first = np.frombuffer(raw, np.uint8, 8 * (docs + 1), at + 9 * docs).view(np.int64)
        blocks = -(-self.n // self.block)
        self.offsets = np.frombuffer(raw, np.uint8, 8 * (blocks + 1), at + 9 * docs + 8 * (docs + 1)).view(np.int64)
        self.raw = raw

    def ids(self, a: int, b: int) -> np.ndarray:
        """Ids a to b - 1, unpacked from the blocks that hold them."""
        if a >= b:
            return np.zeros(0, np.uint32)
        x, y = a // self.block, (b - 1) // self.block + 1
        words = np.frombuffer(self.raw, np.uint8, int(self.offsets[y] - self.offsets[x]), int(self.offsets[x])).view(np.uint64)
        return unpack_bits(words, self.bits, min(self.n, y * self.block) - x * self.block)[a - x * self.block : b - x * self.block]

    def document(self, d: int) -> np.ndarray:
        return self.ids(int(self.first[d]), int(self.first[d + 1]))


def write_token_store(docs: DataFrame, folder: str, params: StoreParams = StoreParams(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode all texts in ascending key order into bit-packed files; returns the manifest (file, ids, docs, bytes).

    Rows are range-partitioned by key, so files in order of name are in order
    of key. A null or empty text has the end id alone; null keys come first;
    rows with one key are ordered by text; an empty table makes no file; other
    columns are ignored. A repeated task writes the same bytes to the same
    name, and a file appears under its name only when whole.
    """
    path = public_path(params.tokenizer)
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    tasks = max(1, -(-size // params.bytes_per_task))
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    rows = rows.repartitionByRange(tasks, "k").sortWithinPartitions("k", "t")

    def write(batches):
        task, part, out, encoder = TaskContext.get().partitionId(), 0, None, None
        for batch in batches:
            for rows in slices(batch, "t", 2 << 20):
                encoder = encoder or loaded(path)
                data, offsets = utf8(rows.column("t"))
                ids, first = encoder.encode(data, offsets)
                sizes = np.diff(first) + 1
                ids = np.insert(ids, first[1:], params.end_id).astype(np.uint32)
                if out is None:
                    out = StoreWriter(folder, f"part-{task:06d}-{part:04d}.gmt", min_bits(encoder.size))
                out.add(rows.column("k").to_pylist(), sizes, ids)
                if out.n >= params.ids_per_file:
                    yield pa.RecordBatch.from_pylist([out.close()])
                    out, part = None, part + 1
        if out is not None:
            yield pa.RecordBatch.from_pylist([out.close()])
        forget_units()

    return keep(rows.mapInArrow(tidied(write), "file string, ids long, docs long, bytes long"), f"{folder}/_manifest")


def read_token_store(spark, folder: str, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, file) of every document, read back from the files that the manifest names."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gmt").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    offsets = manifest.select("file", F.coalesce(F.sum("ids").over(W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))

    def digest(batches):
        for batch in batches:
            for name, raw in zip(batch.column("file").to_pylist(), batch.column("content")):
                store = StoreFile(raw.as_py())
                step = 1 << 20
                crc, sizes = [], np.diff(store.first)
                d, docs = 0, len(store.keys)
                while d < docs:  # about a million ids at a time
                    e = max(d + 1, int(np.searchsorted(store.first, store.first[d] + step, side="right")) - 1)
                    ids = memoryview(np.ascontiguousarray(store.ids(int(store.first[d]), int(store.first[e])))).cast("B")
                    base = int(store.first[d])
                    crc += [zlib.crc32(ids[4 * (int(store.first[i]) - base) : 4 * (int(store.first[i + 1]) - base)]) for i in range(d, e)]
                    d = e
                yield pa.RecordBatch.from_arrays([pa.array(store.keys, pa.int64()), pa.array(store.first[:-1]), pa.array(sizes), pa.array(crc, pa.int64()), pa.array([name] * docs)], ["doc_id", "start", "n_tokens", "ids_crc32", "file"])

    rows = files.mapInArrow(tidied(digest), "doc_id long, start long, n_tokens long, ids_crc32 long, file string")
    return rows.join(offsets, "file").select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", "file")


def op8_token_bits(spark, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "tokens")
    manifest = write_token_store(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder)
    return read_token_store(spark, folder, manifest)
