"""Byte-level BPE encoding and decoding by ranks, with a two-tier lookup.

A text is cut by the vocabulary's pattern. A piece that is a vocabulary entry is
resolved whole by a minimal perfect hash (tier one). Any other piece is merged from
its bytes: a heap holds the ranks of adjacent pairs of a doubly linked list of byte
runs, and the lowest rank, leftmost first, is merged until none is left (tier two).

Ids are worked out once for each distinct stretch of text between spaces (see
``units``), up to a bound; the pattern and both tiers run on these.
"""

from __future__ import annotations

import base64
from array import array
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from footfall.llm import arrow, units


def read_ranks(path: str) -> list[bytes]:
    """Vocabulary entries by rank, from a file of base64 entry and rank per line."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    entries = [b""] * len(pairs)
    for entry, rank in pairs:
        entries[int(rank)] = base64.b64decode(entry)
    return entries


class PerfectHash:
    """A minimal perfect hash of byte strings by hash and displace.

    A key's 64-bit hash gives its bucket, a start and a step. The displacement of a
    bucket of several keys scales the step so that each key gets a slot of its own;
    these buckets are placed first, largest first. A bucket of one key stores the
    free slot it is given, as a negative number. ``find`` compares the key stored in
    the slot, so a foreign key gives -1.
    """

    def __init__(self, keys: list[bytes]):
        self.n = n = max(1, len(keys))
        buckets: dict[int, list[tuple[int, int, int]]] = {}
        for i, key in enumerate(keys):
            bucket, start, step = self._places(key)
            buckets.setdefault(bucket, []).append((start, step, i))
        self.shift = [0] * n
        self.values = [-1] * n
        for bucket, members in sorted(buckets.items(), key=lambda x: (-len(x[1]), x[0])):
            if len(members) == 1:
                break
            shift = 0
            while True:
                shift += 1
                slots = [(start + shift * step) % n for start, step, _ in members]
                if len(set(slots)) == len(slots) and all(self.values[slot] < 0 for slot in slots):
                    break
                if shift > 64 * n:
                    raise ValueError("two keys have the same hash")
            self.shift[bucket] = shift
            for slot, (_, _, i) in zip(slots, members, strict=True):
                self.values[slot] = i
        free = (slot for slot in range(n) if self.values[slot] < 0)
        for bucket, members in sorted(buckets.items()):
            if len(members) == 1:
                slot = next(free)
                self.shift[bucket] = -slot - 1
                self.values[slot] = members[0][2]
        self.keys = [keys[i] if i >= 0 else None for i in self.values]

    def _places(self, key: bytes) -> tuple[int, int, int]:
        h, n = xxhash.xxh3_128_intdigest(key), self.n
        return (h & 0xFFFFFFFF) % n, (h >> 32 & 0xFFFFFFFFFF) % n, (h >> 72) % max(1, n - 1) + 1

    def find(self, key: bytes) -> int:
        """The key's position in the list it was built from, or -1."""
        bucket, start, step = self._places(key)
        shift = self.shift[bucket]
        slot = -shift - 1 if shift < 0 else (start + shift * step) % self.n
        return self.values[slot] if self.keys[slot] == key else -1


class TwoTier:
    """Encoder and decoder for one vocabulary of ranks and one pattern."""

    def __init__(self, entries: list[bytes], pattern: str):
        self.entries = entries
        self.whole = PerfectHash(entries)
        self.ranks = {entry: rank for rank, entry in enumerate(entries)}
        self.cut = regex.compile(pattern).findall
        self.texts = units.Stretches(self.encode, keeps_spaces=True)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a piece by lowest rank first over linked byte runs."""
        rank_of, n = self.ranks.get, len(piece)
        end = list(range(1, n + 1))  # of the run that starts here: also where the next one starts
        before = list(range(-1, n - 1))  # where the run before this one starts
        pair = [rank_of(piece[i : i + 2], -1) for i in range(n - 1)]  # rank of a run with the next one
        pair.append(-1)
        heap = [rank * n + i for i, rank in enumerate(pair) if rank >= 0]
        heapify(heap)
        while heap:
            rank, i = divmod(heappop(heap), n)
            if pair[i] != rank:  # one of the two has grown or been taken in since
                continue
            j = end[i]
            stop = end[i] = end[j]
            pair[i] = pair[j] = -1
            if stop < n:
                before[stop] = i
                grown = rank_of(piece[i : end[stop]])
                if grown is not None:
                    pair[i] = grown
                    heappush(heap, grown * n + i)
            h = before[i]
            if h >= 0:
                grown = pair[h] = rank_of(piece[h:stop], -1)
                if grown >= 0:
                    heappush(heap, grown * n + h)
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[piece[i : end[i]]])
            i = end[i]
        return ids

    def pieces(self, text: str) -> list[int]:
        ids: list[int] = []
        for piece in self.cut(text):
            body = piece.encode()
            found = self.whole.find(body)
            if found >= 0:
                ids.append(found)
            else:
                ids += self.merge(body)
        return ids

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a text."""
        return array("I", self.pieces(text)).tobytes()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.entries.__getitem__, ids))


_coders: dict[tuple[str, str], TwoTier] = {}


def coder(path: str, pattern: str) -> TwoTier:
    """One coder for each vocabulary, pattern and Python worker."""
    if (path, pattern) not in _coders:
        _coders[path, pattern] = TwoTier(read_ranks(path), pattern)
    return _coders[path, pattern]


def _list_of(found: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *map(len, found)]) // 4
    flat = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(found))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)


def encode(df: DataFrame, vocabulary: str, pattern: str, text: str = "text") -> DataFrame:
    """Append ``ids``, the token ids of every whole text; a null text has none.

    ``vocabulary`` is a file that every executor has. A column named ``ids`` gives
    way. Repeated rows are encoded each for itself.
    """
    fields = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def make():
        texts = coder(vocabulary, pattern).texts
        return lambda bodies: [_list_of(texts(arrow.texts_of(bodies)))]

    return arrow.add_columns(df, [text], fields, make)


def decode(df: DataFrame, vocabulary: str, ids: str = "ids") -> DataFrame:
    """Append ``decoded``, the bytes that the ids stand for; null ids have none."""
    fields = T.StructType([T.StructField("decoded", T.BinaryType())])

    def make():
        at = read_ranks(vocabulary).__getitem__
        return lambda column: [
            pa.array([b"".join(map(at, x.values.tolist())) if x.is_valid else b"" for x in column], pa.binary())
        ]

    return arrow.add_columns(df, [ids], fields, make)


def round_trip(df: DataFrame, vocabulary: str, pattern: str, text: str = "text") -> DataFrame:
    """``encode`` and ``decode`` in one pass over the rows: append ``ids`` and ``decoded``."""
    fields = T.StructType([
        T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType()),
    ])

    def make():
        both = coder(vocabulary, pattern)

        def compute(bodies):
            found = both.texts(arrow.texts_of(bodies))
            decoded = [both.decode(np.frombuffer(ids, "<u4").tolist()) for ids in found]
            return [_list_of(found), pa.array(decoded, pa.binary())]

        return compute

    return arrow.add_columns(df, [text], fields, make)
