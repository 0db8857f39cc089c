"""Token ids of many texts at once, worked out once for each distinct stretch.

Vocabularies of the byte-pair kind cut a text before they merge, and always cut
before a single space or line break after a sign. So a text's ids are the ids of its
stretches, each a run of signs with the space or break before it, in order. Stretches
repeat far more often than texts: those of a block are told apart by two independent
64-bit rolling hashes, each distinct one is encoded by the given function (or
remembered from earlier blocks), and the ids are laid out by numpy.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa

from footfall.llm import arrow, rolling

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs one task on each core

from tokenizers import Tokenizer  # noqa: E402

# Stretches a worker remembers before it starts anew; the same for words without the
# signs after them, and the longest such word kept.
REMEMBERED = 3 << 18
CORES = 1 << 17
LONGEST = 64
BLOCK_BYTES = 1 << 20
# Signs that are cut from a letter before them; an apostrophe is not always.
_SIGNS = '.,;:!?#*$%&|<>()"-'

_OTHER_SPACE = np.zeros(256, bool)
_OTHER_SPACE[[0x09, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F]] = True
_LEAD = np.zeros(256, bool)
_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_BEFORE = (b"", b" ", b"\n")
_SALT = rolling.mix(np.arange(7, 10, dtype=np.uint64))


def _wide_spaces(data: np.ndarray) -> np.ndarray:
    """Where a white-space sign of two or three bytes begins."""
    at = np.flatnonzero(_LEAD[data])
    tail = np.concatenate([data, np.zeros(2, np.uint8)])
    a, b, c = data[at], tail[at + 1], tail[at + 2]
    wide = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    wide |= (a == 0xE1) & (b == 0x9A) & (c == 0x80)
    wide |= (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
    wide |= (a == 0xE2) & (b == 0x81) & (c == 0x9F)
    wide |= (a == 0xE3) & (b == 0x80) & (c == 0x80)
    return at[wide]


class _Memory:
    """Ids by a pair of hashes, found many at a time.

    A young table takes what is new and is joined to the old one when it has grown to
    a quarter of it, so adding stays cheap.
    """

    def __init__(self):
        self.tables = [self._table(*(np.empty(0, np.uint64),) * 2, np.empty(0, np.int64), np.empty(0, np.int64))] * 2
        self.ids, self.n_ids = np.empty(1 << 16, "<u4"), 0

    @staticmethod
    def _table(first, other, begins, lengths):
        return pd.Index(first), first, other, begins, lengths

    def __len__(self) -> int:
        return sum(len(table[1]) for table in self.tables)

    def find(self, first: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(begin, length) of each pair's ids; a length of -1 if unknown, -2 if the second hash differs."""
        begins, lengths = np.zeros(len(first), np.int64), np.full(len(first), -1, np.int64)
        for index, _, others, table_begins, table_lengths in self.tables:
            if not len(others):
                continue
            at = index.get_indexer(pd.Index(first))
            hit = at >= 0
            begins[hit], lengths[hit] = table_begins[at[hit]], table_lengths[at[hit]]
            lengths[hit] = np.where(others[at[hit]] == other[hit], lengths[hit], -2)
        return begins, lengths

    def add(self, first: np.ndarray, other: np.ndarray, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        more = np.frombuffer(b"".join(found), "<u4")
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begins = self.n_ids + np.cumsum(lengths) - lengths
        if self.n_ids + len(more) > len(self.ids):
            grown = np.empty(2 * (self.n_ids + len(more)), "<u4")
            grown[: self.n_ids] = self.ids[: self.n_ids]
            self.ids = grown
        self.ids[self.n_ids : self.n_ids + len(more)] = more
        self.n_ids += len(more)
        old, young = self.tables
        young = self._table(*(np.concatenate(x) for x in zip(young[1:], (first, other, begins, lengths), strict=True)))
        if len(young[1]) > len(old[1]) // 4 + (1 << 16):
            old = self._table(*(np.concatenate(x) for x in zip(old[1:], young[1:], strict=True)))
            young = self._table(*(x[:0] for x in young[1:]))
        self.tables = [old, young]
        return begins, lengths


class Stretches:
    """Ids of whole texts from ``encode``, a function from a text to little-endian unsigned 32-bit ids.

    With ``keeps_spaces`` white space has ids of its own or belongs to what follows. A
    text with white space other than single spaces and line breaks between signs is
    then encoded in one call. Otherwise white space only separates. A text that holds one
    of ``marks`` (tokens that ``encode`` finds before it cuts a text) is encoded in one
    call too.
    """

    def __init__(self, encode: Callable[[str], bytes], keeps_spaces: bool, marks: tuple[bytes, ...] = ()):
        self.encode, self.keeps_spaces, self.marks = encode, keeps_spaces, marks
        self.memory = _Memory()
        self.cores: dict[str, bytes] = {}

    def _core(self, text: str) -> bytes:
        found = self.cores.get(text)
        if found is None:
            found = self.encode(text)
            if len(self.cores) >= CORES:
                self.cores.clear()
            if len(text) <= LONGEST:
                self.cores[text] = found
        return found

    def _stretch(self, text: str) -> bytes:
        core = text.rstrip(_SIGNS)
        if core and core != text and core[-1].lower()[-1].isalpha():  # a letter and a sign are always cut apart
            return self._core(core) + self._core(text[len(core) :])
        return self.encode(text)

    def _odd_texts(self, data: np.ndarray, offsets: np.ndarray, space: np.ndarray) -> np.ndarray:
        """Which texts hold white space that its neighbours may claim."""
        odd = np.zeros(len(offsets) - 1, bool)
        if not len(data):
            return odd
        full = offsets[1:] > offsets[:-1]
        odd[full] = space[offsets[:-1][full]] | space[offsets[1:][full] - 1]
        at = [np.flatnonzero(_OTHER_SPACE[data]), np.flatnonzero(space[1:] & space[:-1]), _wide_spaces(data)]
        odd[np.searchsorted(offsets, np.concatenate(at), side="right") - 1] = True
        return odd

    def _note_marks(self, odd: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
        """Set ``odd`` for the texts that hold a mark."""
        raw = data.tobytes() if self.marks else b""
        for mark in self.marks:
            at = raw.find(mark)
            while at >= 0:
                text = int(np.searchsorted(offsets, at, side="right")) - 1
                odd[text] |= at + len(mark) <= offsets[text + 1]
                at = raw.find(mark, at + 1)

    def _block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, end of each text's ids, texts left out)."""
        space = rolling.SPACE[data]
        odd = self._odd_texts(data, offsets, space) if self.keeps_spaces else np.zeros(len(offsets) - 1, bool)
        self._note_marks(odd, data, offsets)
        starts, ends, doc = rolling.word_spans(data, offsets)
        kind = np.zeros(len(starts), np.int64)
        if self.keeps_spaces:
            inner = starts > offsets[doc]
            kind[inner] = np.where(data[starts[inner] - 1] == 0x20, 1, 2)
        if odd.any():
            keep = ~odd[doc]
            starts, ends, doc, kind = starts[keep], ends[keep], doc[keep], kind[keep]
        salt = _SALT[kind]
        place, first = pd.factorize(rolling.span_hashes(rolling.byte_sums(data), starts, ends) ^ salt)
        first = np.asarray(first, np.uint64)
        at = np.empty(len(first), np.int64)
        at[place[::-1]] = np.arange(len(place))[::-1]
        others = rolling.span_hashes(rolling.byte_sums(data, 1), starts, ends, 1) ^ salt
        other = others[at]
        begins, lengths = self.memory.find(first, other)
        if (others != other[place]).any() or (lengths == -2).any():
            # two stretches of one hash: encode each text of the block whole
            return np.empty(0, "<u4"), np.zeros(len(odd), np.int64), np.ones(len(odd), bool)
        new = np.flatnonzero(lengths == -1)
        if len(new):
            raw, where = data.tobytes(), at[new]
            found = [
                self._stretch((_BEFORE[k] + raw[s:e]).decode())
                for s, e, k in zip(starts[where].tolist(), ends[where].tolist(), kind[where].tolist(), strict=True)
            ]
            begins[new], lengths[new] = self.memory.add(first[new], other[new], found)
        n = lengths[place]
        total = np.cumsum(n)
        ids = self.memory.ids[np.arange(total[-1] if len(n) else 0) + np.repeat(begins[place] - (total - n), n)]
        if len(self.memory) > REMEMBERED:
            self.memory = _Memory()
        per_text = np.bincount(doc, n, len(offsets) - 1).astype(np.int64)
        return ids, np.cumsum(per_text), odd

    def __call__(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        out = []
        for first, last, data, offsets in arrow.blocks(texts, BLOCK_BYTES):
            ids, ends, odd = self._block(data, offsets)
            raw, start = ids.tobytes(), 0
            for i, end in enumerate(ends.tolist()):
                out.append(self.encode(texts[first + i].as_py()) if odd[i] else raw[4 * start : 4 * end])
                start = end
        return out


def _byte_signs() -> dict[int, str]:
    """The printable sign that byte-level vocabularies write for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return {byte: chr(byte) for byte in shown} | {byte: chr(256 + i) for i, byte in enumerate(hidden)}


def encoder(path: str, keeps_spaces: bool) -> Stretches:
    """The tokenizers library's ids for the vocabulary in a file; one encoder per Python worker.

    The same as ``encode(text, add_special_tokens=False)``: a text that holds the content of
    an added token, such as an end mark, has that token's id there. A stretch of plain Latin letters is one piece of the pre-tokenizer and is given to
    the library's model at once; any other stretch goes through its whole pipeline.
    """
    if path not in _encoders:
        tokenizer = Tokenizer.from_file(path)
        marks = tuple(token.content.encode() for token in tokenizer.get_added_tokens_decoder().values())
        model, signs = tokenizer.model, _byte_signs()
        letters = re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")

        def encode(text: str) -> bytes:
            if letters.fullmatch(text):
                piece = text if keeps_spaces else text.lstrip(" ").lower()
                tokens = model.tokenize(piece.encode().decode("latin-1").translate(signs))
                return array("I", [token.id for token in tokens]).tobytes()
            return array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

        _encoders[path] = Stretches(encode, keeps_spaces, marks)
    return _encoders[path]


_encoders: dict[str, Stretches] = {}
