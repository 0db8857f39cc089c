"""The trie of conversation prefixes, exact, with a count-min screen before the shuffle.

Two conversations share a node of depth d if their first d turns are equal in role and
text. Most prefixes belong to one conversation only, and these need no grouping:

1. Turns become digests of 16 bytes, ordered along their conversation; a prefix is named
   by two sums modulo 2**64 over its digests mixed with their places. A conversation may
   span partitions of the sort: what lies before a partition comes to it as one row.
2. Every task counts its prefixes in a count-min sketch of two rows; the sketches are
   added. Counts stop at two, as only one and more than one matter. A cell of one proves
   that a prefix is a singleton, and with it every longer one of its conversation: such
   a tail is a chain of nodes, which the task that reads it emits itself.
3. What may be shared is grouped exactly by (depth, sums), with partial aggregation, so
   a prefix of very many conversations is never gathered. A tail tells its first node's
   parent that it hangs there.
4. Leaves and saved code points are summed over subtrees by doubling: in round k every
   node adds what the nodes 2**k below it hold. Rounds grow with the logarithm of the
   deepest shared prefix.

The sketch has a few cells for each prefix up to ``MOST_CELLS`` in a row, which bounds
the broadcast. Beyond, fewer singletons are proved and more rows are grouped, with the
same result.

Null roles and texts count as empty. Rows without a conversation's id take no part.
Turns are ordered with null first; equal turns of a conversation (repeated rows too) all
count, in the order of their role, then of their digest. An empty table has no nodes.
Columns other than the four named ones are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm import arrow, rolling, store

CELLS_PER_PREFIX = 8
LEAST_CELLS, MOST_CELLS = 1 << 16, 1 << 26
# Rows in which a sketch of two rows travels.
SEGMENTS = 32
# Ids that travel as one piece of text on the way to a node's digest.
PIECE = 1 << 12

_SUMMED = "conv_id long, depth long, n_chars long, part int, row long, last boolean, s1 long, s2 long, m1 long, m2 long"


class Trie(NamedTuple):
    # conv_id (smallest member), depth, parent_conv_id, n_convs, n_ends, n_children, n_leaves, saved_tokens
    nodes: DataFrame
    # The node that each conversation ends in: member, conv_id, depth, n_convs
    ends: DataFrame


class Edge(NamedTuple):
    """What a partition of the sorted turns needs to know of those before and after it."""

    conv_id: int | None = None  # that started before it
    sums: tuple[int, int] = (0, 0)  # of this conversation until here
    open_row: int = -1  # its last row, if that conversation goes on behind it


def turn_digests(df: DataFrame, conv_id="conv_id", turn="turn", role="role", text="text") -> DataFrame:
    """(conv_id, depth, digest, n_chars): the turns of each conversation, numbered from 1."""
    role, text = (F.coalesce(arrow.column(name).cast("string"), F.lit("")) for name in (role, text))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = df.select(
        arrow.column(conv_id).cast("long").alias("conv_id"), arrow.column(turn).alias("turn"), role.alias("role"),
        F.unhex(F.md5(whole)).alias("digest"), F.length(text).cast("long").alias("n_chars"),
    ).where("conv_id IS NOT NULL")
    rows = store.written(rows, "turn-digests")
    ordered = rows.orderBy("conv_id", F.col("turn").asc_nulls_first(), "role", "digest").drop("turn", "role")
    ordered = ordered.select("conv_id", F.lit(0).cast("long").alias("depth"), "digest", "n_chars")
    counted = _along(ordered, lambda digest, depth: np.ones((2, len(depth)), np.uint64), keep_digest=True)
    return counted.select("conv_id", F.col("s1").alias("depth"), "digest", "n_chars")


def _place_mixes(digest: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Two numbers for each turn that depend on its digest and its place."""
    words = digest.view("<u8").reshape(-1, 2).T
    place = rolling.mix(depth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.stack([rolling.mix(words[0] + place), rolling.mix(words[1] ^ place) + words[0] * (place | np.uint64(1))])


def _along(ordered: DataFrame, values: Callable[[np.ndarray, np.ndarray], np.ndarray], keep_digest: bool = False) -> DataFrame:
    """Sums of two values of each row with those before it in its conversation.

    ``ordered`` (conv_id, depth, digest, n_chars) is sorted over all partitions. Adds
    s1 and s2, the row's own values m1 and m2, and whether it is its conversation's last.
    """
    schema = _SUMMED + (", digest binary" if keep_digest else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row, conv, sums, held = TaskContext.get().partitionId(), 0, None, np.zeros(2, np.uint64), None

        def done(columns: list, ids: np.ndarray, following: int | None) -> pa.RecordBatch:
            last = np.append(ids[1:] != ids[:-1], following is None or following != ids[-1])
            columns[5] = pa.array(last)
            return pa.RecordBatch.from_arrays(columns, schema=names)

        names = pa.schema([
            ("conv_id", pa.int64()), ("depth", pa.int64()), ("n_chars", pa.int64()), ("part", pa.int32()),
            ("row", pa.int64()), ("last", pa.bool_()), ("s1", pa.int64()), ("s2", pa.int64()),
            ("m1", pa.int64()), ("m2", pa.int64()), *([("digest", pa.binary())] if keep_digest else []),
        ])
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            ids, depth = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            digest = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8)
            own = values(digest, depth)
            total = np.cumsum(own, axis=1, dtype=np.uint64)
            first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
            before = np.where(first > 0, total[:, first - 1], np.uint64(0))
            if conv == ids[0]:
                before[:, 0] -= sums
            total -= np.repeat(before, np.diff(np.append(first, n)), axis=1)
            conv, sums = ids[-1], total[:, -1].copy()
            if held is not None:
                yield done(*held, int(ids[0]))
            held = [
                batch.column(0), batch.column(1), batch.column(3), pa.array(np.full(n, part, np.int32)),
                pa.array(np.arange(row, row + n)), None, *(pa.array(x.view(np.int64)) for x in (*total, *own)),
                *([batch.column(2)] if keep_digest else []),
            ], ids
            row += n
        if held is not None:
            yield done(*held, None)

    arrow.small_batches(ordered.sparkSession)
    summed = store.written(ordered.mapInArrow(arrow.tidy(run), schema), "along")
    edges = ordered.sparkSession.sparkContext.broadcast(_edges(summed))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, part, row = (batch.column(k).to_numpy() for k in (0, 3, 4))
            last = batch.column(5).to_numpy(zero_copy_only=False).copy()
            sums = [batch.column(k).to_numpy().view(np.uint64).copy() for k in (6, 7)]
            for p in np.unique(part).tolist():
                edge = edges.value[p]
                last[(part == p) & (row == edge.open_row)] = False
                if edge.conv_id is not None:
                    some = (part == p) & (ids == edge.conv_id)
                    for k in range(2):
                        sums[k][some] += np.uint64(edge.sums[k])
            columns = [batch.column(k) for k in range(batch.num_columns)]
            columns[5:8] = [pa.array(last), *(pa.array(x.view(np.int64)) for x in sums)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return summed.mapInArrow(arrow.tidy(joined), schema)


def _edges(summed: DataFrame) -> dict[int, Edge]:
    """What each partition needs of its neighbours; from one row per partition."""
    rows = summed.groupBy("part").agg(
        F.min("conv_id").alias("first"), F.max(F.struct("row", "conv_id", "s1", "s2")).alias("end")
    ).orderBy("part").collect()
    out: dict[int, Edge] = {}
    conv, sums = None, (0, 0)
    for i, row in enumerate(rows):
        follows = conv is not None and conv == row["first"]
        start = sums if follows else (0, 0)
        end = row["end"]
        goes_on = i + 1 < len(rows) and rows[i + 1]["first"] == end["conv_id"]
        out[row["part"]] = Edge(conv if follows else None, start, end["row"] if goes_on else -1)
        whole = follows and end["conv_id"] == conv
        conv = end["conv_id"]
        sums = tuple(((s if whole else 0) + x) % (1 << 64) for s, x in zip(start, (end["s1"], end["s2"]), strict=True))
    return out


def _cells(s1: np.ndarray, s2: np.ndarray, cells: int) -> np.ndarray:
    """The cell of each prefix in both rows of the sketch."""
    mixed = rolling.mix(s1.view(np.uint64)), rolling.mix(s2.view(np.uint64) ^ np.uint64(0x6A09E667F3BCC909))
    return np.stack([(x & np.uint64(cells - 1)).astype(np.int64) for x in mixed])


def _sketch(prefixes: DataFrame, cells: int) -> np.ndarray:
    """For both rows of the sketch, bits of the cells that count more than one prefix."""
    width = 2 * cells // SEGMENTS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, cells), np.uint8)
        for batch in batches:
            for k, at in enumerate(_cells(batch.column(0).to_numpy(), batch.column(1).to_numpy(), cells)):
                at, times = np.unique(at, return_counts=True)
                held[k, at] = np.minimum(held[k, at] + np.minimum(times, 2), 2)
        press = zstandard.ZstdCompressor(level=1).compress
        rows = held.reshape(SEGMENTS, width)
        some = np.flatnonzero(rows.any(axis=1))
        yield _rows(some, [press(rows[i].tobytes()) for i in some])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        unpress = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for row, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held = total.setdefault(row, np.zeros(width, np.uint8))
                np.minimum(held + np.frombuffer(unpress(body.as_buffer()), np.uint8), 2, out=held)
        yield _rows(list(total), [np.packbits(held > 1).tobytes() for held in total.values()])

    kind = "row int, body binary"
    parts = prefixes.select("s1", "s2").mapInArrow(arrow.tidy(count), kind).repartition("row")
    out = np.zeros((SEGMENTS, width // 8), np.uint8)
    for row in parts.mapInArrow(arrow.tidy(add), kind).collect():  # a fixed number of rows
        out[row["row"]] = np.frombuffer(row["body"], np.uint8)
    return out.reshape(2, -1)


def _rows(numbers, bodies) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(numbers, pa.int32()), pa.array(bodies, pa.binary())], names=["row", "body"]
    )


def _screened(prefixes: DataFrame, sketch: np.ndarray) -> DataFrame:
    """Prefixes with whether they are proved singletons, and the first ones of tails."""
    shared = prefixes.sparkSession.sparkContext.broadcast(sketch)
    kind = "conv_id long, depth long, n_chars long, last boolean, s1 long, s2 long, p1 long, p2 long, single boolean, top boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        cells = bits.shape[1] * 8
        before = (None, 0, False)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, depth, s1, s2, m1, m2 = (batch.column(k).to_numpy() for k in (0, 1, 4, 5, 6, 7))
            one = np.zeros(len(ids), bool)
            for row, at in zip(bits, _cells(s1, s2, cells), strict=True):
                one |= (row[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1) == 0
            place = np.arange(len(ids))
            starts = np.append(True, (ids[1:] != ids[:-1]) | (depth[1:] != depth[:-1] + 1))
            group = np.maximum.accumulate(np.where(starts, place, 0))
            follows = before[0] == ids[0] and before[1] + 1 == depth[0]
            if follows and before[2]:
                one[0] = True
            # What follows a singleton in its conversation is one.
            single = np.maximum.accumulate(np.where(one, place, -1)) >= group
            earlier = np.append(follows and before[2], single[:-1])
            earlier[1:] &= ~starts[1:]
            before = int(ids[-1]), int(depth[-1]), bool(single[-1])
            parents = [(s.view(np.uint64) - m.view(np.uint64)).view(np.int64) for s, m in ((s1, m1), (s2, m2))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(6)), *map(pa.array, (*parents, single, single & ~earlier))],
                names=["conv_id", "depth", "n_chars", "last", "s1", "s2", "p1", "p2", "single", "top"],
            )

    rows = prefixes.select("conv_id", "depth", "n_chars", "last", "s1", "s2", "m1", "m2")
    return store.written(rows.mapInArrow(arrow.tidy(run), kind), "screened")


def _subtree_sums(tree: DataFrame) -> DataFrame:
    """(conv_id, depth, leaves, saved) summed over subtrees, of rows that name their parent in ``up``."""
    deepest, step = tree.agg(F.max("depth")).first()[0] or 0, 1
    while step <= deepest:
        below = tree.where("up IS NOT NULL").groupBy(
            F.col("up").alias("conv_id"), (F.col("depth") - step).alias("depth")
        ).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        # A node this deep or less has nothing twice as far above it.
        next_up = tree.where("up IS NOT NULL").select(
            F.col("conv_id").alias("up"), (F.col("depth") + step).alias("depth"), F.col("up").alias("next_up")
        )
        far = tree.where(F.col("depth") > step).join(next_up, ["up", "depth"], "left")
        near = tree.where(F.col("depth") <= step).withColumn("next_up", F.lit(None).cast("long"))
        tree = far.unionByName(near).join(below, ["conv_id", "depth"], "left").select(
            "conv_id", "depth", F.col("next_up").alias("up"),
            (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
        )
        tree = store.written(tree, "subtrees")
        step *= 2
    return tree.drop("up")


def prefix_trie(turns: DataFrame, conversations: DataFrame, cells: int | None = None) -> Trie:
    """The trie of ``turns`` (as ``turn_digests`` gives them) and who ends where.

    ``conversations`` (conv_id) holds every conversation once, those without turns too.
    A node is named by its smallest member and its depth; ``n_ends`` of its members end
    in it; ``saved_tokens`` sums over its subtree each node's (members - 1) times the
    code points of its last text. ``cells`` of a sketch's row is a power of two.
    """
    spark = turns.sparkSession
    turns = store.written(turns.select("conv_id", "depth", "digest", "n_chars"), "turns")
    prefixes = _along(turns.orderBy("conv_id", "depth"), _place_mixes)
    if cells is None:
        wanted = max(LEAST_CELLS, CELLS_PER_PREFIX * turns.count())
        cells = min(MOST_CELLS, 1 << (wanted - 1).bit_length())
    rows = _screened(prefixes, _sketch(prefixes, cells))
    low, n = conversations.agg(F.min("conv_id"), F.count("conv_id")).first()
    turnless = conversations.join(rows.where("depth = 1").select("conv_id"), "conv_id", "left_anti")
    turnless = store.written(turnless.select("conv_id"), "turnless")

    exact = rows.where("NOT single").groupBy("depth", "s1", "s2").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.count_if("last").alias("n_ends"),
        *(F.any_value(name).alias(name) for name in ("n_chars", "p1", "p2")),
    )
    exact = store.written(exact, "shared-prefixes")
    names = exact.select(
        (F.col("depth") + 1).alias("depth"), F.col("s1").alias("p1"), F.col("s2").alias("p2"), F.col("conv_id").alias("up")
    )

    def with_parent(below: DataFrame) -> DataFrame:
        """Adds ``up``, the parent's name; null if the parent is a proved singleton."""
        first = below.where("depth = 1").withColumn("up", F.lit(low).cast("long"))
        return below.where("depth > 1").join(names, ["depth", "p1", "p2"], "left").unionByName(first)

    shared = store.written(with_parent(exact).drop("s1", "s2", "p1", "p2"), "shared-nodes")
    tops = store.written(with_parent(rows.where("top").select("conv_id", "depth", "p1", "p2")).drop("p1", "p2"), "tops")
    hung = shared.select("depth", "up", F.lit(0).alias("tail")).unionByName(tops.select("depth", "up", F.lit(1).alias("tail")))
    kids = hung.where("up IS NOT NULL").groupBy(F.col("up").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
        F.count("*").alias("n_children"), F.sum("tail").alias("tails")
    )
    root = spark.createDataFrame(
        [(0, low, n, turnless.count(), 0, None)] if n else [],
        "depth long, conv_id long, n_convs long, n_ends long, n_chars long, up long",
    )
    nodes = shared.unionByName(root).join(kids, ["conv_id", "depth"], "left").fillna(0, ["n_children", "tails"])
    nodes = store.written(nodes, "nodes")
    sums = _subtree_sums(nodes.select(
        "conv_id", "depth", "up", (F.col("tails") + F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("n_chars")).alias("saved"),
    ))
    grouped = nodes.join(sums, ["conv_id", "depth"]).select(
        "conv_id", "depth",
        # A parent that is not here is a singleton that its own task emitted.
        F.when(F.col("depth") > 0, F.coalesce("up", "conv_id")).alias("parent_conv_id"),
        "n_convs", "n_ends", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
    )
    tails = rows.where("single AND NOT top").withColumn("up", F.col("conv_id")).select("conv_id", "depth", "last", "up")
    heads = rows.where("top").select("conv_id", "depth", "last").join(tops, ["conv_id", "depth"])
    chains = tails.unionByName(heads).select(
        "conv_id", "depth", F.coalesce("up", "conv_id").alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"),
        F.col("last").cast("long").alias("n_ends"), (~F.col("last")).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
    )

    ended = rows.where("last AND NOT single").select(F.col("conv_id").alias("member"), "depth", "s1", "s2")
    ends = ended.join(exact.select("depth", "s1", "s2", "conv_id", "n_convs"), ["depth", "s1", "s2"])
    ends = ends.select("member", "conv_id", "depth", "n_convs").unionByName(
        turnless.select(F.col("conv_id").alias("member"), F.lit(low).cast("long").alias("conv_id"),
                        F.lit(0).cast("long").alias("depth"), F.lit(n).cast("long").alias("n_convs"))
    ).unionByName(rows.where("last AND single").select(
        F.col("conv_id").alias("member"), "conv_id", "depth", F.lit(1).cast("long").alias("n_convs")))
    return Trie(grouped.unionByName(chains), ends)


def member_digests(ends: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256) of nodes: SHA-256 of their members' ids, ascending, joined by commas.

    The ids are sorted over all tasks, which write them as pieces of text; a node's
    digest then reads its pieces one after the other, so of a node in which very many
    conversations end one task sees few rows and holds one piece.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, depth, member = (batch.column(k).to_numpy() for k in range(3))
            new = np.append(True, (node[1:] != node[:-1]) | (depth[1:] != depth[:-1]))[: len(node)]
            starts = np.flatnonzero(new | (np.arange(len(node)) % PIECE == 0))
            stops = np.append(starts[1:], len(node))
            texts = [",".join(map(str, member[a:b].tolist())) for a, b in zip(starts, stops, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[starts]), pa.array(depth[starts]), pa.array(member[starts]), pa.array(texts, pa.string())],
                names=["conv_id", "depth", "member", "ids"],
            )

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state = None, None
        for batch in batches:
            done = []
            for node, depth, _, ids in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if (node, depth) != name:
                    if name is not None:
                        done.append((*name, state.hexdigest()))
                    name, state = (node, depth), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield told(done)
        if name is not None:
            yield told([(*name, state.hexdigest())])

    def told(done: list) -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) or [(), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)], names=["conv_id", "depth", "ends_sha256"]
        )

    ordered = store.written(ends.select("conv_id", "depth", "member"), "ends").orderBy("conv_id", "depth", "member")
    texts = store.written(ordered.mapInArrow(arrow.tidy(pieces), "conv_id long, depth long, member long, ids string"), "pieces")
    dealt = texts.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "member")
    return dealt.mapInArrow(arrow.tidy(digests), "conv_id long, depth long, ends_sha256 string")
