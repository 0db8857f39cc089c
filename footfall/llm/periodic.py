"""Periodic runs of words: stretches that repeat themselves four times or more.

A run is a stretch of words with smallest period q (words q apart are identical), at
least ``LEAST_WORDS`` and ``LEAST_TIMES`` periods long, that no neighbouring word
extends. All of them are found exactly:

1. The suffix tree of the text and that of its reversal are built by Ukkonen's rounds.
   A tour of the tree notes between two leaves how deep the node is that it passes, so
   the common extension of two places is a minimum over a stretch of the tour, which a
   table of powers of two answers in constant time.
2. The leaves' order ranks all suffixes. The longest Lyndon word that starts in a place
   ends before the next smaller suffix, or, by the reversed order, the next greater one.
   Every run has such a word of its period's length as a root.
3. Every root is extended to both sides, by the text's tree and by the reversal's.

Words that no run can hold come into the trees as one mark for a stretch of them: each
word of a run lies in a window of ``WINDOW`` words that the text has twice, one period
apart. A mark equals nothing, so no run is lost or changed by it.

Words are ``[^\\x20\\x09-\\x0D]+``. A null or empty text has no words and no runs. Rows
are taken one by one, so repeated rows and rows without an id have their own results,
and an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from footfall.llm import arrow, rolling

LEAST_WORDS = 6
LEAST_TIMES = 4
# A run of L >= max(6, 4q) words has at least L - q >= 5 words between a word and its
# like one period on, so windows of five words inside it occur again.
WINDOW = 5

RUN = T.StructType([T.StructField(name, T.LongType(), False) for name in ("start", "length", "period")])
FIELDS = T.StructType([
    T.StructField("runs", T.ArrayType(RUN, False)), T.StructField("collapsed", T.StringType()),
])


class Extensions:
    """The suffixes of a sequence in order, and how far any two of them agree."""

    def __init__(self, symbols: list[int]):
        order, between = _tour(symbols)
        self.rank = np.empty(len(order), np.int64)
        self.rank[order] = np.arange(len(order))
        self._lows = [np.array(between, np.int32)]
        width = 1
        while 2 * width <= len(order):
            low = self._lows[-1]
            self._lows.append(np.minimum(low[:-width], low[width:]))
            width *= 2

    def agree(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols from the places a and b (never the same) on are equal."""
        a, b = self.rank[a], self.rank[b]
        first, last = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp(last - first)[1] - 1
        out = np.empty(len(first), np.int64)
        for k in np.unique(level).tolist():
            some = level == k
            low = self._lows[k]
            out[some] = np.minimum(low[first[some]], low[last[some] - (1 << k)])
        return out


def suffix_tree(symbols: list[int]) -> tuple[list[int], list[int], list[int], list[dict[int, int]]]:
    """(first, last, suffix, children) of the nodes of the tree of ``symbols`` and an end mark.

    Ukkonen's construction: node 0 is the root, the symbols first to before last lead
    to a node, ``suffix`` is where a leaf's suffix starts, -1 for inner nodes. The end
    mark, -1, is smaller than all symbols.
    """
    text = [*symbols, -1]
    size = len(text)
    first, last, suffix, link, children = [0], [0], [-1], [0], [{}]
    node = edge = length = remaining = 0
    for i, symbol in enumerate(text):
        remaining += 1
        inner = 0
        while remaining:
            if not length:
                edge = i
            child = children[node].get(text[edge])
            if child is not None:
                span = min(last[child], i + 1) - first[child]
                if length >= span:
                    node, edge, length = child, edge + span, length - span
                    continue
                at = first[child] + length
                if text[at] == symbol:
                    length += 1
                    if inner:
                        link[inner] = node
                    break
                parent = len(first)
                first.append(first[child])
                last.append(at)
                suffix.append(-1)
                link.append(0)
                children.append({text[at]: child})
                children[node][text[edge]] = parent
                first[child] = at
            else:
                parent = node
            children[parent][symbol] = len(first)
            first.append(i)
            last.append(size)
            suffix.append(i - remaining + 1)
            link.append(0)
            children.append({})
            if inner:
                link[inner] = parent
            inner = parent if parent != node else 0
            remaining -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - remaining + 1
    return first, last, suffix, children


def _tour(symbols: list[int]) -> tuple[list[int], list[int]]:
    """Leaves in order, and the depth of the node that the tour passes before each of them."""
    first, last, suffix, children = suffix_tree(symbols)
    order, between = [], []
    stack = [(0, 0, 0)]
    while stack:
        node, depth, passed = stack.pop()
        if suffix[node] >= 0:
            order.append(suffix[node])
            between.append(passed)
            continue
        depth += last[node] - first[node]
        below = [child for _, child in sorted(children[node].items())]
        stack.extend((child, depth, depth) for child in below[:0:-1])
        stack.append((below[0], depth, passed))
    return order, between


def _next(rank: list[int]) -> tuple[list[int], list[int]]:
    """For every place the next one of smaller and the next one of greater rank, or their number."""
    size = len(rank)
    smaller, greater = [size] * size, [size] * size
    low, high = [], []
    for i, r in enumerate(rank):
        while low and rank[low[-1]] > r:
            smaller[low.pop()] = i
        while high and rank[high[-1]] < r:
            greater[high.pop()] = i
        low.append(i)
        high.append(i)
    return smaller, greater


def _runs_of(symbols: list[int]) -> np.ndarray:
    """Rows (start, length, period) of the runs of a sequence, in order."""
    size = len(symbols)
    ahead, back = Extensions(symbols), Extensions(symbols[::-1])
    smaller, greater = _next(ahead.rank[:size].tolist())
    root = np.tile(np.arange(size), 2)
    after = np.array(smaller + greater)
    root, after = root[after < size], after[after < size]
    period = after - root
    right = after + ahead.agree(root, after)
    left = root.copy()
    inside = root > 0
    left[inside] -= back.agree(size - root[inside], size - after[inside])
    length = right - left
    enough = length >= np.maximum(LEAST_WORDS, LEAST_TIMES * period)
    return np.unique(np.stack([left, period, length], axis=1)[enough], axis=0)[:, [0, 2, 1]]


def _suspects(words: np.ndarray) -> np.ndarray:
    """Which words lie in a window that the text has twice; windows are told apart by hashes."""
    count = len(words) - WINDOW + 1
    mixed = rolling.mix(words.astype(np.uint64) + np.uint64(1))
    key = np.zeros(count, np.uint64)
    for k in range(WINDOW):
        key = key * np.uint64(0xD1342543DE82EF95) + mixed[k : k + count]
    return rolling.covered(np.flatnonzero(rolling.repeated(key)), WINDOW, len(words))


def find_runs(words: list[bytes]) -> np.ndarray:
    """Rows (start, length, period) of all runs of a list of words, by start, then period."""
    none = np.empty((0, 3), np.int64)
    numbers: dict[bytes, int] = {}
    ids = [numbers.setdefault(word, len(numbers)) for word in words]
    if len(ids) < LEAST_WORDS or len(numbers) > len(ids) - LEAST_TIMES + 1:
        return none
    ids = np.array(ids)
    place = np.flatnonzero(_suspects(ids))
    if not len(place):
        return none
    # One mark of its own before every stretch of suspects but the first.
    gaps = np.flatnonzero(np.diff(place) > 1) + 1
    symbols = np.insert(ids[place], gaps, len(numbers) + np.arange(len(gaps)))
    place = np.insert(place, gaps, -1)
    found = _runs_of(symbols.tolist())
    found[:, 0] = place[found[:, 0]]
    return found


def collapse(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words but those that a run holds after its first period."""
    if not len(runs):
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.subtract.at(depth, runs[:, 0] + runs[:, 1], 1)
    return [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]


def with_runs(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``runs`` (start and length in words, period; by start, then period) and
    ``collapsed`` (the text's words, joined by one space, without what a run holds after
    its first period). Columns of these names give way.
    """

    def make():
        def compute(column: pa.Array) -> list:
            ends, found, texts = [0], [], []
            for first, last, data, offsets in arrow.blocks(arrow.texts_of(column)):
                for i in range(last - first):
                    words = data[offsets[i] : offsets[i + 1]].tobytes().split()
                    runs = find_runs(words)
                    ends.append(ends[-1] + len(runs))
                    found.append(runs)
                    texts.append(b" ".join(collapse(words, runs)))
            flat = np.concatenate(found) if found else np.empty((0, 3), np.int64)
            structs = pa.StructArray.from_arrays(
                [pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)],
                fields=[pa.field(name, pa.int64(), False) for name in RUN.names],
            )
            kind = pa.list_(pa.field("element", structs.type, False))
            return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs, type=kind),
                    pa.array(texts, pa.binary()).cast(pa.string())]

        return compute

    return arrow.add_columns(df, [text], FIELDS, make)
