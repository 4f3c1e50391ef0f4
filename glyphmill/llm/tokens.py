"""Exact byte-level BPE ids of whole columns of texts, at a multiple of the tokenizer's own speed.

A byte-level BPE with the usual splitting pattern never merges across the
place before a space that stands in front of an ASCII letter, digit or sign or
of a Latin letter (lead byte 0xC3): whatever precedes such a space, the
pattern starts a new piece there. The same holds between an ASCII letter and
an ASCII sign, and on both sides of a single line feed between a sign or
letter and an ASCII letter. Texts are cut at these places, equal units
are found with Arrow's dictionary encoding, each distinct unit of a batch is
encoded once with the tokenizers library and remembered, and ids are gathered
back. Strings of the file's added tokens are found first, as the library does:
each is its own id, and the text on either side is encoded by itself.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

from glyphmill.llm._bytes import ranges

_SAFE_NEXT = np.zeros(256, dtype=bool)
_SAFE_NEXT[0x21:0x7F] = True
_SAFE_NEXT[0xC3] = True
_ASCII_LETTER, _SIGN = 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[0x21:0x7F] = _SIGN
_KIND[48:58] = 0
_KIND[[*range(65, 91), *range(97, 123)]] = _ASCII_LETTER
_JOIN_BYTES = 1 << 15
#: Distinct units that a worker remembers; beyond this it starts anew.
CACHE_UNITS = 300_000


class UnitTokenizer:
    """Ids of text columns by a byte-level BPE tokenizer file of the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # units hold none: encode() takes their strings out
        self.added = {token.content.encode(): i for i, token in self.tokenizer.get_added_tokens_decoder().items()}
        if any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in self.tokenizer.get_added_tokens_decoder().values()):
            raise ValueError("added tokens that match by more than their string are not supported")
        self.find_added = re.compile(b"|".join(re.escape(c) for c in sorted(self.added, key=len, reverse=True)) or rb"(?!)")
        self.size = self.tokenizer.get_vocab_size()
        vocab = self.tokenizer.get_vocab()
        self.width = np.zeros(max(vocab.values()) + 1, np.int64)  # bytes of each id: one character of a piece stands for one byte
        for piece, i in vocab.items():
            self.width[i] = len(piece)
        self._forget()

    def _encode_units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first) of distinct units. Units that begin with a space are encoded many at a time and cut apart by bytes."""
        _, buffer, raw = units.buffers()
        at = np.frombuffer(buffer, np.int32)[units.offset : units.offset + len(units) + 1].astype(np.int64)
        data = np.frombuffer(raw, np.uint8)
        n, sizes = len(units), np.diff(at)
        lead = np.zeros(n, bool)
        some = sizes > 1
        lead[some] = (data[at[:-1][some]] == 0x20) & _SAFE_NEXT[data[at[:-1][some] + 1]]
        order = np.concatenate((np.flatnonzero(~lead), np.flatnonzero(lead)))
        alone = int((~lead).sum())
        moved = data[ranges(at[:-1][order], sizes[order])].tobytes()
        cut = np.concatenate(([0], np.cumsum(sizes[order])))
        texts = [moved[cut[i] : cut[i + 1]].decode() for i in range(alone)]
        joined = np.cumsum(sizes[order][alone:]) // _JOIN_BYTES
        edges = alone + np.concatenate(([0], np.flatnonzero(np.diff(joined)) + 1, [n - alone])) if n > alone else np.array([alone])
        texts += [moved[cut[a] : cut[b]].decode() for a, b in zip(edges[:-1], edges[1:])]
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.int64) for e in encoded]) if encoded else np.zeros(0, np.int64)
        ends = np.cumsum(self.width[ids])
        first_sorted = np.searchsorted(ends, cut[:-1], side="right") if len(ids) else np.zeros(n, np.int64)
        if len(ids) and ends[-1] != len(moved):
            raise ValueError("the tokenizer is not a lossless byte-level BPE")
        first_sorted = np.append(first_sorted, len(ids))
        counts = np.diff(first_sorted)
        # back to the units' own order
        size_of, start_of = np.empty(n, np.int64), np.empty(n, np.int64)
        size_of[order], start_of[order] = counts, first_sorted[:-1]
        return ids[ranges(start_of, size_of)], np.concatenate(([0], np.cumsum(size_of)))

    def _look_up(self, units: pa.Array) -> np.ndarray:
        """Each distinct unit's place in the pool; units not seen before are encoded and join it."""
        names = units.to_pylist()
        if len(self.known) + len(names) > CACHE_UNITS:
            self._forget()
        where = np.array([self.known.get(u, -1) for u in names], np.int64)
        new = np.flatnonzero(where < 0)
        if len(new):
            ids, first = self._encode_units(units.take(pa.array(new)))
            where[new] = len(self.starts) + np.arange(len(new))
            self.known.update(zip([names[i] for i in new], where[new].tolist()))
            self.starts = np.concatenate((self.starts, len(self.pool) + first[:-1]))
            self.sizes = np.concatenate((self.sizes, np.diff(first).astype(np.int32)))
            self.pool = np.concatenate((self.pool, ids.astype(np.uint32)))
        return where

    def _forget(self) -> None:
        self.known, self.pool = {}, np.zeros(0, np.uint32)
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids as uint32, first): text d's ids are ids[first[d]:first[d + 1]]; an empty text has none."""
        raw = np.ascontiguousarray(data).data
        if not len(data) or not self.find_added.search(raw):
            return self._encode_plain(data, offsets)
        # texts with a string of an added token: cut before and after each such string
        bounds, found = [], []
        for hit in self.find_added.finditer(raw):
            d = int(np.searchsorted(offsets, hit.start(), side="right")) - 1
            if found and found[-1] == d:
                continue
            found.append(d)
            bounds += [(int(offsets[d]) + m.start(), int(offsets[d]) + m.end(), self.added[m.group()]) for m in self.find_added.finditer(raw[offsets[d] : offsets[d + 1]])]
        begin, end, token = np.array(bounds, np.int64).reshape(-1, 3).T
        edges = np.sort(np.concatenate((offsets, begin, end)), kind="stable")
        ids, first = self._encode_plain(data, edges)
        whole = np.flatnonzero(np.diff(edges) > 0)
        special = whole[np.isin(edges[whole], begin)]  # in the order of begin: of equal edges only one starts a part
        start, size = first[:-1].copy(), np.diff(first)
        start[special], size[special] = len(ids) + np.arange(len(special)), 1
        out = np.concatenate((ids, token.astype(np.uint32)))[ranges(start, size)]
        return out, np.concatenate(([0], np.cumsum(size)))[np.searchsorted(edges, offsets)]

    def _encode_plain(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        texts = len(offsets) - 1
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(texts + 1, np.int64)
        cut = np.zeros(len(data) + 1, dtype=bool)
        kind = _KIND[data]
        a, b = kind[:-1], kind[1:]
        cut[:-2] |= (data[:-1] == 0x20) & _SAFE_NEXT[data[1:]]
        cut[1:-1] |= (a == _ASCII_LETTER) & (b == _SIGN)
        alone = np.flatnonzero((data[1:-1] == 0x0A) & ((a[:-1] == _ASCII_LETTER) | (a[:-1] == _SIGN)) & (b[1:] == _ASCII_LETTER)) + 1
        cut[alone] = cut[alone + 1] = True
        heads = offsets[offsets < len(data)]
        ends = heads[heads > 0] - 1
        cut[ends[data[ends] == 0x20]] = False  # what follows a text's last space is another text
        cut[offsets] = True
        cut[0] = cut[-1] = True
        edges = np.flatnonzero(cut)
        units = pa.BinaryArray.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])
        found = units.dictionary_encode()
        which = found.indices.to_numpy()
        where = self._look_up(found.dictionary)
        counts = self.sizes[where][which].astype(np.int64)
        out = self.pool[ranges(self.starts[where][which], counts)]
        before = np.concatenate(([0], np.cumsum(counts)))
        pa.default_memory_pool().release_unused()
        return out, before[np.searchsorted(edges, offsets)]


def public_path(name: str) -> str:
    """Where the installed package of public vocabularies keeps a file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def forget_units() -> None:
    """Empty the unit caches of this worker's tokenizers: a task's units are not worth an idle worker's memory."""
    for tokenizer in _LOADED.values():
        tokenizer._forget()


_LOADED: dict[str, UnitTokenizer] = {}


def loaded(path: str) -> UnitTokenizer:
    """This worker's tokenizer for a file: read once and kept."""
    if path not in _LOADED:
        _LOADED[path] = UnitTokenizer(path)
    return _LOADED[path]
