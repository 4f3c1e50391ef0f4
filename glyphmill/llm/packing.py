"""Sequence packing by lexical retrieval.

Documents are encoded once into a written table. The table's parts are cut
into shards; each shard gets a BM25 inverted index over token ids (document
frequencies and the average length come from the whole corpus). A seed
document starts a window, the index returns its best unused neighbours, and
these fill the window: those that fit whole first, else the best one is cut
and its rest seeds the next window.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphmill.llm._bytes import ranges, slices, tidied, utf8
from glyphmill.llm._spark import keep, shared_dir
from glyphmill.llm.tokens import forget_units, loaded, public_path


@dataclass(frozen=True)
class PackParams:
    tokenizer: str = "byte_bpe_50k.json"
    end_id: int = 0
    window: int = 1024
    #: Ids in a shard of the index, about.
    ids_per_shard: int = 4 << 20
    #: Neighbours that are tried before the index is asked again.
    neighbours: int = 8
    #: Terms that more than one in so many of a shard's documents hold are scored by a matrix product, the others by lists.
    dense: int = 16
    #: Shards of at most so many documents have that product for all seeds at once (4 bytes for each pair).
    all_seeds: int = 4096
    k1: float = 1.2
    b: float = 0.75


def term_counts(ids: np.ndarray, sizes: np.ndarray, vocabulary: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, times) of every distinct term of each document, in that order."""
    kind = np.uint32 if len(sizes) * vocabulary < 1 << 32 else np.uint64  # narrow keys sort faster
    key = np.repeat(np.arange(len(sizes), dtype=kind) * kind(vocabulary), sizes) + ids.astype(kind)
    key.sort()
    heads = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    pair = key[heads].astype(np.int64)
    return pair // vocabulary, pair % vocabulary, np.diff(np.append(heads, len(key)))


class ShardIndex:
    """BM25 impacts of one shard's documents, with the corpus's statistics.

    A term that more than one in `dense` of the documents hold is a column of a
    matrix, any other a posting list. A seed's scores are a product of the
    matrix plus sums over lists: all its terms count, and none is skipped. The
    matrix has at most `dense` cells for each entry that lists would hold.
    """

    def __init__(self, ids: np.ndarray, first: np.ndarray, idf: np.ndarray, mean_length: float, params: PackParams):
        docs, vocabulary = len(first) - 1, len(idf)
        sizes = np.diff(first)
        owner, term, count = term_counts(ids, sizes, vocabulary)
        useful = idf[term] > 0
        owner, term, count = owner[useful], term[useful], count[useful]
        norm = params.k1 * (1 - params.b + params.b * sizes / max(1.0, mean_length))
        weight = (idf[term] * count * (params.k1 + 1) / (count + norm[owner])).astype(np.float32)
        self.docs, self.params = docs, params
        self.scored: tuple[int, np.ndarray] = (-1, np.zeros(0, np.float32))
        often = np.flatnonzero(np.bincount(term, minlength=vocabulary) * params.dense > docs)
        column = np.full(vocabulary, -1)
        column[often] = np.arange(len(often))
        wide = column[term] >= 0
        self.impacts = np.zeros((docs, len(often)), np.float32)
        self.impacts[owner[wide], column[term[wide]]] = weight[wide]
        #: Matrix part for all seeds at once, where it is small.
        self.common = (self.impacts > 0).astype(np.float32) @ self.impacts.T if docs <= params.all_seeds else None
        owner, term, weight = owner[~wide], term[~wide], weight[~wide]
        self.terms, self.term_at = term, np.searchsorted(owner, np.arange(docs + 1))
        by_term = np.argsort(term, kind="stable")
        self.posting, self.impact = owner[by_term], weight[by_term].astype(np.float64)
        self.list_at = np.searchsorted(term[by_term], np.arange(vocabulary + 1))

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document for all of the seed's terms; that of the last seed is kept, as a window asks for it again."""
        if self.scored[0] != seed:
            t = self.terms[self.term_at[seed] : self.term_at[seed + 1]]
            at = ranges(self.list_at[t], self.list_at[t + 1] - self.list_at[t])
            rare = np.bincount(self.posting[at], weights=self.impact[at], minlength=self.docs)
            common = self.common[seed] if self.common is not None else self.impacts @ (self.impacts[seed] > 0).astype(np.float32)
            self.scored = (seed, rare.astype(np.float32) + common)
        return self.scored[1]

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """The best unused documents that share a term with the seed, best score first; ties by position."""
        score = self.scores(seed)
        docs = np.flatnonzero(unused & (score > 0))
        most = self.params.neighbours
        if len(docs) > most:
            own = score[docs]
            docs = docs[own >= np.partition(own, -most)[-most]]
        return docs[np.argsort(-score[docs], kind="stable")[:most]]


def pack_shard(sizes: np.ndarray, index: ShardIndex, window: int) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece; only the last sequence may be short."""
    unused = np.ones(len(sizes), dtype=bool)
    pieces, sequence, room, following = [], 0, window, 0

    def put(doc: int, start: int, length: int) -> None:
        nonlocal sequence, room
        if room == 0:
            sequence, room = sequence + 1, window
        pieces.append((doc, start, length, sequence, window - room))
        room -= length

    carry = None  # a document that was cut, and where its rest begins
    while True:
        if carry is None:
            while following < len(sizes) and not unused[following]:
                following += 1
            if following == len(sizes):
                return pieces
            carry = (following, 0)
            unused[following] = False
        seed, start = carry
        carry = None
        size = int(sizes[seed])
        while start < size:
            if room == 0:
                sequence, room = sequence + 1, window
            length = min(room, size - start)
            put(seed, start, length)
            start += length
        while room:
            near = index.neighbours(seed, unused)
            if not len(near):
                break  # the next unused document goes on in this window
            fits = 0
            for doc in near:
                if sizes[doc] <= room:
                    put(int(doc), 0, int(sizes[doc]))
                    unused[doc] = False
                    fits += 1
            if room and not fits:
                doc, length = int(near[0]), room
                put(doc, 0, length)
                unused[doc] = False
                carry = (doc, length)


def encode_documents(docs: DataFrame, params: PackParams, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, ids): each text's ids with the end id, as little-endian unsigned integers of 16 or 32 bits."""
    path = public_path(params.tokenizer)

    def encode(batches):
        encoder = None
        for batch in batches:
            for rows in slices(batch, "t", 8 << 20):
                encoder = encoder or loaded(path)
                ids, first = encoder.encode(*utf8(rows.column("t")))
                ids = np.insert(ids, first[1:], params.end_id).astype(np.uint16 if encoder.size <= 1 << 16 else np.uint32)
                at = (first + np.arange(len(first))) * ids.itemsize
                raw = pa.BinaryArray.from_buffers(pa.binary(), rows.num_rows, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays([rows.column("k"), pa.array(np.diff(at) // ids.itemsize), raw], ["doc_id", "n", "ids"])
        forget_units()

    return docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t")).mapInArrow(tidied(encode), "doc_id long, n long, ids binary")


def pack_documents(docs: DataFrame, params: PackParams = PackParams(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every id lies in exactly one piece and only a shard's last sequence can be
    shorter than the window. A null or empty text is its end id alone; repeated
    rows are packed each; null keys stay null; an empty table gives no rows;
    other columns are ignored. A long text is cut at window ends. The encoded
    table is written to the shared folder, so a lost executor repeats only its
    own shards, and its parts fix the shards whatever runs them.
    """
    spark = docs.sparkSession
    encoded = keep(encode_documents(docs, params, key, text), shared_dir(spark, "packing") + "/ids", **{"compression": "zstd"})
    vocabulary = loaded(public_path(params.tokenizer)).size
    kind = np.uint16 if vocabulary <= 1 << 16 else np.uint32

    def frequencies(batches):
        total, docs_seen, length = np.zeros(vocabulary, np.int64), 0, 0
        for batch in batches:
            for rows in slices(batch, "ids"):
                data, at = utf8(rows.column("ids"))
                ids, sizes = data.view(kind), np.diff(at) // np.dtype(kind).itemsize
                total += np.bincount(term_counts(ids, sizes, vocabulary)[1], minlength=vocabulary)
                docs_seen, length = docs_seen + len(sizes), length + len(ids)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, [-1, -2])), pa.array(np.append(total[used], [docs_seen, length]))], ["term", "n"])

    counted = dict(encoded.select("ids").mapInArrow(tidied(frequencies), "term long, n long").groupBy("term").agg(F.sum("n")).toArrow().to_pandas().itertuples(index=False))  # at most the vocabulary and two rows
    n_docs, mean = counted.pop(-1, 0), counted.pop(-2, 0)
    idf = np.zeros(vocabulary)
    for term, n in counted.items():
        if term != params.end_id:  # it closes every document and is no part of a text
            idf[term] = np.log(1 + (n_docs - n + 0.5) / (n + 0.5))
    shared = spark.sparkContext.broadcast((idf, mean / max(1, n_docs)))

    def shard(rows: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
        idf, mean = shared.value
        table = pa.Table.from_batches(rows).combine_chunks()
        data, at = utf8(table.column("ids"))
        width = np.dtype(kind).itemsize
        ids, first = data.view(kind), at // width
        pieces = np.array(pack_shard(np.diff(first), ShardIndex(ids, first, idf, mean, params), params.window), np.int64).reshape(-1, 5)
        doc, start, length, sequence, offset = pieces.T
        wide = memoryview(np.ascontiguousarray(ids.astype("<u4"))).cast("B")
        begin = 4 * (first[doc] + start)
        crc = [zlib.crc32(wide[a:b]) for a, b in zip(begin.tolist(), (begin + 4 * length).tolist())]
        base = ((TaskContext.get().partitionId() << 16) + number) << 24
        return pa.RecordBatch.from_arrays(
            [table.column("doc_id").combine_chunks().take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(np.diff(first)[doc]), pa.array(base + sequence), pa.array(offset)],
            ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
        )

    def pack(batches):
        held, ids, number = [], 0, 0
        for batch in batches:
            for rows in slices(batch, "ids", 1 << 20):
                held.append(rows)
                ids += int(np.sum(rows.column("n").to_numpy()))
                if ids >= params.ids_per_shard:
                    yield shard(held, number)
                    held, ids, number = [], 0, number + 1
        if held:
            yield shard(held, number)

    return encoded.mapInArrow(tidied(pack), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def op6_retrieval_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
