"""Similarity join of documents by the Jaccard index of their word n-gram sets.

Documents link when 100 * |A and B| >= percent * |A or B|; linked documents form
components. Links between all different sets are found exactly, by a token-group
matrix:

1. Documents of equal sets become one node.
2. Nodes are partitioned into groups of similar ones: nodes that share one of a few
   minimum hashes, and agree in most of a short signature, are checked against the
   most typical of them, and those that link with it join its group.
3. Tokens have one global order, rare before frequent. Two nodes that link share a
   token among the first ones of both in this order, and where it stands bounds how
   much they can share. The matrix holds, for each such token, the groups whose union
   has it, with the sizes and places of their nodes. Two groups are opened for each
   other only if the bound of a shared token reaches what their sizes need. The bound
   knows sizes and places alone, so these are compared first, without the groups that
   have them: documents that share a passage but not enough of it cost one row each.
4. Only in opened groups are nodes compared, by their whole sets.

A group is connected already, so no pairs inside it are needed, however large it is;
a token that a group's nodes share costs one row per size, not one per pair. Word
n-grams that very many documents share come last in the order and fall outside the
compared beginnings of all but the nodes that consist of them.

The order comes from counts in a fixed number of buckets over all documents; any
order gives the same links, a good one fewer comparisons. What tasks get as a
broadcast (the order, and bitmaps of ids or tokens that are asked for) has a size that
``buckets`` and ``bits`` fix: raise them with the data, to some tenth of its distinct
tokens and ten times its groups; a smaller one opens more groups and loses no link.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. A text with fewer words than
n has its whole sequence as its only token; without words it has none, and is linked
with nothing. Rows without an id link with nothing. Rows that share an id are one
document, whose sets all count. Copies need no comparison with each other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm import arrow, rolling, store
from footfall.llm.components import components

# Buckets of the token counts (a power of two) and the rows they travel in.
BUCKETS = 1 << 21
SEGMENTS = 32
# Bits of a bitmap of asked-for ids or tokens (a power of two) and its rows.
BITS = 1 << 25
BIT_ROWS = 1 << 7
# Minimum hashes of a node's signature, those that name groups, and how many of the
# signature must agree before a node is checked against its group's most typical one.
BINS = 16
KEYS = (0, 5, 10)
AGREE = 9

# Documents: size and fingerprint of the set, the minimum hashes that name groups, a byte
# of each minimum hash, mean frequency of the tokens, and the first tokens in the order.
_NODES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()),
    T.StructField("s1", T.LongType()), T.StructField("s2", T.LongType()),
    T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("sign1", T.LongType()),
    T.StructField("sign2", T.LongType()), T.StructField("typical", T.FloatType()),
    T.StructField("first", T.ArrayType(T.LongType())),
])


# A part of an array of fixed size, on its way to the driver.
_ROWS = "row int, body binary"


class Rule(NamedTuple):
    words: int  # of a token
    percent: int  # of the union that two linked sets share at least
    buckets: int = BUCKETS
    bits: int = BITS

    def needed(self, n_a, n_b):
        """The smallest intersection with which sets of these sizes link."""
        return -((-self.percent * (n_a + n_b)) // (100 + self.percent))

    def beginning(self, n: int) -> int:
        """How many tokens of a set of n, in the global order, a linked set must meet."""
        if 100 * n < self.percent * (n + 1):
            return 0  # only an equal set links
        return n + (-self.percent * n) // 100 + 1


def token_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct token hashes of every text."""
    for first, last, data, offsets in arrow.blocks(texts):
        data = rolling.LOWER[data]
        starts, ends, doc = rolling.word_spans(data, offsets)
        sums = rolling.gram_sums(rolling.span_hashes(rolling.byte_sums(data), starts, ends))
        at, grams = rolling.gram_hashes(sums, doc, words)
        bounds = np.searchsorted(doc, np.arange(last - first + 1))
        gram_bounds = np.searchsorted(at, bounds)
        for i in range(last - first):
            low, high = bounds[i], bounds[i + 1]
            if 0 < high - low < words:
                yield rolling.sequence_hash(sums, low, high)
            else:
                yield np.unique(grams[gram_bounds[i] : gram_bounds[i + 1]])


def _rows(numbers, bodies) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(numbers, pa.int32()), pa.array(bodies, pa.binary())], names=["row", "body"]
    )


def _count_tokens(docs: DataFrame, rule: Rule) -> np.ndarray:
    """Logarithm of each bucket's count, over the tokens of all documents."""
    per_row = rule.buckets // SEGMENTS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(rule.buckets, np.uint32)
        for batch in batches:
            for tokens in token_sets(arrow.texts_of(batch.column(0)), rule.words):
                held[(tokens & np.uint64(rule.buckets - 1)).astype(np.int64)] += np.uint32(1)
        press = zstandard.ZstdCompressor(level=1).compress  # most counts of a task are small
        yield _rows(np.arange(SEGMENTS), [press(row.tobytes()) for row in held.reshape(SEGMENTS, per_row)])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        unpress = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for row, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held = total.setdefault(row, np.zeros(per_row, np.uint64))
                held += np.frombuffer(unpress(body.as_buffer()), np.uint32)
        yield _rows(list(total), [held.tobytes() for held in total.values()])

    parts = docs.select("text").mapInArrow(arrow.tidy(count), _ROWS).repartition("row")
    counts = np.zeros((SEGMENTS, per_row), np.uint64)
    for row in parts.mapInArrow(arrow.tidy(add), _ROWS).collect():  # a fixed number of rows
        counts[row["row"]] = np.frombuffer(row["body"], np.uint64)
    return np.frexp(counts.reshape(-1).astype(np.float64))[1].astype(np.uint8)


def _describe(docs: DataFrame, rule: Rule, levels: np.ndarray) -> DataFrame:
    """Size, fingerprint, signature and beginning of every document's set."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)
    starts = (np.arange(BINS, dtype=np.uint64) << np.uint64(64 - BINS.bit_length() + 1)).astype(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            out: dict[str, list] = {name: [] for name in _NODES.names[1:]}
            for tokens in token_sets(arrow.texts_of(batch.column(1)), rule.words):
                n = len(tokens)
                out["n"].append(n)
                level = known[(tokens & np.uint64(rule.buckets - 1)).astype(np.int64)].astype(np.uint64)
                out["s1"].append(rolling.mix(tokens).sum(dtype=np.uint64).astype(np.int64))
                out["s2"].append(rolling.mix(tokens ^ np.uint64(0x6A09E667F3BCC909)).sum(dtype=np.uint64).astype(np.int64))
                lowest = np.searchsorted(tokens, starts) % max(n, 1)  # of each range of hashes, or the next one's
                mins = tokens[lowest] if n else np.zeros(BINS, np.uint64)
                out["keys"].append(mins[list(KEYS)].astype(np.int64))
                sign = np.ascontiguousarray(rolling.mix(mins).view(np.uint8).reshape(BINS, 8)[:, 0]).view(np.int64)
                out["sign1"].append(sign[0])
                out["sign2"].append(sign[1])
                out["typical"].append(level.mean() if n else 0.0)
                order = np.argsort(level << np.uint64(58) | tokens >> np.uint64(6), kind="stable")
                out["first"].append(tokens[order[: rule.beginning(n)]].astype(np.int64))
            arrays = [batch.column(0)]
            for name in _NODES.names[1:]:
                if name in ("keys", "first"):
                    ends = np.cumsum([0, *map(len, out[name])])
                    flat = np.concatenate(out[name]) if out[name] else np.empty(0, np.int64)
                    arrays.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)))
                else:
                    arrays.append(pa.array(out[name], pa.float32() if name == "typical" else pa.int64()))
            yield pa.RecordBatch.from_arrays(arrays, names=_NODES.names)

    return docs.select("doc_id", "text").mapInArrow(arrow.tidy(run), _NODES)


def _bitmap(bits: DataFrame, size: int) -> np.ndarray:
    """A bitmap of the numbers (0 to ``size`` - 1) in the column ``bit``; its size is fixed.

    Each task marks its own numbers first, so one that very many rows have is sent once a task.
    """
    per_row = size // BIT_ROWS // 8

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.zeros(size // 8, np.uint8)
        for batch in batches:
            bit = np.unique(batch.column(0).to_numpy())
            if len(bit):
                place, first = np.unique(bit >> 3, return_index=True)
                marked[place] |= np.bitwise_or.reduceat((128 >> (bit & 7)).astype(np.uint8), first)
        rows = marked.reshape(BIT_ROWS, per_row)
        some = np.flatnonzero(rows.any(axis=1))
        press = zstandard.ZstdCompressor(level=1).compress
        yield _rows(some, [press(row.tobytes()) for row in rows[some]])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        unpress = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for row, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held = total.setdefault(row, np.zeros(per_row, np.uint8))
                held |= np.frombuffer(unpress(body.as_buffer()), np.uint8)
        yield _rows(list(total), [held.tobytes() for held in total.values()])

    parts = bits.select(F.col("bit").cast("long")).mapInArrow(arrow.tidy(mark), _ROWS).repartition("row")
    out = np.zeros((BIT_ROWS, per_row), np.uint8)
    for row in parts.mapInArrow(arrow.tidy(merge), _ROWS).collect():  # a fixed number of rows
        out[row["row"]] = np.frombuffer(row["body"], np.uint8)
    return out.reshape(-1)


def _marked(bitmap: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return (bitmap[bits >> 3] >> (7 - (bits & 7)).astype(np.uint8) & 1).astype(bool)


def _sets_of(docs: DataFrame, ids: DataFrame, rule: Rule) -> DataFrame:
    """(node, tokens): the token sets, as bytes, of the documents in ``ids`` (node).

    A bitmap of the ids leaves out other documents where they are read, so only the
    asked-for sets, and a few more by chance, are worked out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(ids.select(_bit_of("node", rule).alias("bit")), rule.bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.filter(pa.array(_marked(shared.value, batch.column(2).to_numpy())))
            sets = [tokens.tobytes() for tokens in token_sets(arrow.texts_of(some.column(1)), rule.words)]
            yield pa.RecordBatch.from_arrays([some.column(0), pa.array(sets, pa.binary())], names=["node", "tokens"])

    rows = docs.where("doc_id IS NOT NULL").select("doc_id", "text", _bit_of("doc_id", rule).alias("bit"))
    return store.written(rows.mapInArrow(arrow.tidy(run), "node long, tokens binary"), "sets", compression="none")


def _linked(pairs: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) of nodes whose whole sets link."""
    pairs = store.written(pairs, "pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("node"))
    sets = _sets_of(docs, ids, rule)
    sides = pairs.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("left")), "a")
    sides = sides.join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("right")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2), batch.column(3), strict=True):
                left, right = (np.frombuffer(x.as_buffer(), np.uint64) for x in (left, right))
                both = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(100 * both >= rule.percent * (len(left) + len(right) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    linked = sides.select("a", "b", "left", "right").mapInArrow(arrow.tidy(run), "a long, b long")
    return store.written(linked, "links")


def _similar_size(a: Column, b: Column, rule: Rule) -> Column:
    return 100 * F.least(a, b) >= rule.percent * F.greatest(a, b)


def _group_pairs(nodes: DataFrame, rule: Rule) -> DataFrame:
    """(a, b): each node with the most typical node of the groups its keys name."""
    named = nodes.select("node", "n", "sign1", "sign2", "typical", F.posexplode("keys").alias("bin", "least"))
    centre = F.max(F.struct("typical", (-F.col("node")).alias("away"), "n", "sign1", "sign2")).alias("centre")
    centres = named.groupBy("bin", "least").agg(centre, F.count("*").alias("size")).where("size > 1")
    both = named.join(centres.drop("size"), ["bin", "least"]).where(F.col("node") != -F.col("centre.away"))
    agree = F.lit(0)
    for name in ("sign1", "sign2"):
        differ = F.col(name).bitwiseXOR(F.col(f"centre.{name}"))
        for k in range(8):
            agree = agree + (F.shiftrightunsigned(differ, 8 * k).bitwiseAND(255) == 0).cast("int")
    near = both.where(_similar_size(F.col("n"), F.col("centre.n"), rule) & (agree >= AGREE))
    return near.select(F.col("node").alias("a"), (-F.col("centre.away")).alias("b")).distinct()


def _shared_tokens(nodes: DataFrame, rule: Rule) -> DataFrame:
    """(token, node, n, at): the beginnings' tokens that two nodes or more have."""
    # A node has a token once, so counting rows counts nodes.
    counts = nodes.select(F.explode("first").alias("token")).groupBy("token").count()
    shared = store.written(counts.where("count > 1").select("token"), "shared-tokens")
    bitmap = _bitmap(shared.select(F.pmod("token", F.lit(rule.bits)).alias("bit")), rule.bits)
    known = nodes.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = batch.column(2)
            lengths = np.diff(first.offsets.to_numpy())
            tokens = first.flatten().to_numpy()
            row = np.repeat(np.arange(len(lengths)), lengths)
            at = np.arange(len(tokens)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            hit = _marked(known.value, tokens % rule.bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens[hit]), batch.column(0).take(pa.array(row[hit])),
                 batch.column(1).take(pa.array(row[hit])), pa.array(at[hit])],
                names=["token", "node", "n", "at"],
            )

    found = nodes.select("node", "n", "first").mapInArrow(arrow.tidy(run), "token long, node long, n long, at long")
    return found.join(shared, "token", "left_semi")


def _side(df: DataFrame, side: str, *shared: str) -> DataFrame:
    """``df`` with all columns but the ``shared`` ones named for a side of a join."""
    return df.select(*(F.col(name) if name in shared else F.col(name).alias(f"{name}_{side}") for name in df.columns))


def _reaches(rule: Rule) -> Column:
    """Whether sets of these sizes may link that have a token at these places and none in common before."""
    needed = _needed(F.col("n_a"), F.col("n_b"), rule)
    return (
        _similar_size(F.col("n_a"), F.col("n_b"), rule)
        & (F.col("at_a") <= F.col("n_a") - needed) & (F.col("at_b") <= F.col("n_b") - needed)
    )


def _classes_that_reach(cells: DataFrame, rule: Rule) -> DataFrame:
    """token, n_a, at_a, n_b, at_b: the sizes and places that may link, whatever groups have them.

    They meet by token and band of sizes; sizes that may link lie in one band or in neighbouring ones.
    """
    width = math.log(100 / rule.percent) + 0.01
    classes = cells.groupBy("token", "n", "at").agg(F.min("group").alias("low"), F.max("group").alias("high"))
    classes = store.written(classes.withColumn("band", F.floor(F.log("n") / width)), "classes")
    near = classes.withColumn("band", F.explode(F.array(*(F.col("band") + step for step in (-1, 0, 1)))))
    both = _side(classes, "a", "token", "band").join(_side(near, "b", "token", "band"), ["token", "band"])
    both = both.where(F.col("low_a") < F.col("high_b")).where(_reaches(rule))
    return both.select("token", "n_a", "at_a", "n_b", "at_b")


def _open_pairs(nodes: DataFrame, groups: DataFrame, rule: Rule) -> DataFrame:
    """(a, b): nodes of different groups that the matrix's bound does not keep apart."""
    posted = _shared_tokens(nodes, rule).join(groups, "node", "left")
    posted = store.written(posted.withColumn("group", F.coalesce("component", "node")).drop("component"), "matrix")
    cells = posted.groupBy("token", "group", "n").agg(F.min("at").alias("at"))
    cells = store.written(cells, "cells")
    met = _classes_that_reach(cells, rule)
    for side in "ab":
        met = met.join(_side(cells, side, "token"), ["token", f"n_{side}", f"at_{side}"])
    met = met.where("group_a < group_b").select("token", "group_a", "group_b")
    opened = store.written(met.distinct(), "opened")
    # In opened groups, again sizes and places first, then the nodes that have them.
    kinds = posted.select("token", "group", "n", "at").distinct()
    pairs = opened
    for side in "ab":
        pairs = pairs.join(_side(kinds, side, "token"), ["token", f"group_{side}"])
    pairs = pairs.where(_reaches(rule))
    for side in "ab":
        pairs = pairs.join(_side(posted, side, "token"), ["token", f"group_{side}", f"n_{side}", f"at_{side}"])
    pairs = pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()
    return _with_enough_first(store.written(pairs, "opened-pairs"), nodes, rule)


def _needed(n_a: Column, n_b: Column, rule: Rule) -> Column:
    """``Rule.needed`` as a column; the small step back keeps whole quotients whole."""
    return F.ceil(rule.percent * (n_a + n_b) / F.lit(100.0 + rule.percent) - 1e-9)


def _with_enough_first(pairs: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """Pairs whose beginnings have enough tokens in common.

    Of two beginnings, the one that ends earlier in the order has all its common tokens
    in the other one too. So two sets share at most the tokens that their beginnings
    share and what lies behind the shorter-reaching beginning.
    """
    ids = pairs.select(F.explode(F.array("a", "b")).alias("node"))
    bitmap = _bitmap(ids.select(_bit_of("node", rule).alias("bit")), rule.bits)
    asked = _asked(nodes.select("node", "n", "first", _bit_of("node", rule).alias("bit")), bitmap)
    for side in ("a", "b"):
        pairs = pairs.join(asked.select(
            F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("first").alias(f"first_{side}")), side)
    behind = F.greatest(*(F.col(f"n_{side}") - F.size(f"first_{side}") for side in "ab"))
    common = F.size(F.array_intersect("first_a", "first_b"))
    return pairs.where(common + behind >= _needed(F.col("n_a"), F.col("n_b"), rule)).select("a", "b")


def _asked(rows: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """The rows whose column ``bit`` is set in the bitmap."""
    shared = rows.sparkSession.sparkContext.broadcast(bitmap)
    at = rows.columns.index("bit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_marked(shared.value, batch.column(at).to_numpy())))

    return rows.mapInArrow(arrow.tidy(run), rows.schema).drop("bit")


def _bit_of(name: str, rule: Rule) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(rule.bits))


def similar_documents(
    docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text",
    buckets: int | None = None, bits: int | None = None,
) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    ``component_id`` is the smallest id reachable by links, the row's own included; it
    is null for rows without an id whose set no row with an id has. Extra columns are
    left out. An empty table gives no rows. ``buckets`` and ``bits`` are powers of two.
    """
    arrow.small_batches(docs.sparkSession)
    rule = Rule(words, percent, buckets or BUCKETS, bits or BITS)
    docs = docs.select(arrow.column(doc_id).cast("long").alias("doc_id"), arrow.column(text).alias("text"))
    levels = _count_tokens(docs, rule)
    described = store.written(_describe(docs, rule, levels), "sets-described")
    same = ["n", "s1", "s2"]
    nodes = described.where("n > 0 AND doc_id IS NOT NULL").groupBy(*same).agg(
        F.min("doc_id").alias("node"),
        *(F.any_value(name).alias(name) for name in ("keys", "sign1", "sign2", "typical", "first")),
    )
    nodes = store.written(nodes, "nodes")
    # Rows that share an id are one document: its nodes are linked by it.
    links = described.where("n > 0 AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min(F.struct(*same)).alias("low"), F.max(F.struct(*same)).alias("high")
    )
    several = store.written(links.where("low <> high").select("doc_id"), "several")
    near = _linked(_group_pairs(nodes, rule), docs, rule)
    if not several.isEmpty():
        alias = described.join(several, "doc_id", "left_semi").select("doc_id", *same)
        by_id = alias.join(nodes.select("node", *same), same)
        near = near.unionByName(by_id.select(F.col("doc_id").alias("a"), F.col("node").alias("b")))
    groups = components(near)
    more = _linked(_open_pairs(nodes, groups, rule), docs, rule)
    # Groups are components already: what is left is to join those that a link connects.
    found = groups
    if not more.isEmpty():
        edges = groups.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)
        found = components(edges)
    classes = nodes.select("node", *same).join(found, "node", "left")
    classes = classes.select(*same, F.coalesce("component", "node").alias("component"))
    rows = described.select("doc_id", *same).join(classes, same, "left")
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def keep_one_of_each(docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with one of each component: that of the smallest id.

    Of rows that share this id one stays. Rows without an id stay.
    """
    found = similar_documents(docs, words, percent, doc_id, text)
    stay, copy = arrow.unused(docs, "stays"), arrow.unused(docs, "copy")
    stays = found.where("doc_id = component_id").select(F.col("doc_id").alias(stay)).distinct()
    name = arrow.column(doc_id)
    one = Window.partitionBy(name).orderBy(F.xxhash64(arrow.column(text)))
    kept = docs.where(name.isNotNull()).join(stays, name.cast("long") == F.col(stay), "left_semi")
    kept = kept.withColumn(copy, F.row_number().over(one)).where(F.col(copy) == 1).drop(copy)
    return kept.unionByName(docs.where(name.isNull()))
