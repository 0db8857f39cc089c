"""Links between vectors of large cosine, by descent over a graph of nearest neighbours.

Equal vectors are one node with a weight, so copies are never compared. Over the nodes:

1. Start: ``TABLES`` sign codes of random directions each put all nodes in one order,
   which is cut into blocks of ``BLOCK``; in a block every node finds its nearest. The
   order is dealt by ranges of (code, node), so equal codes are no hot key.
2. Descent: each node keeps a list of its ``LISTED`` nearest. In a round the nodes on a
   list, and those on whose lists its owner stands, meet in groups of at most about
   ``GROUP``, and what they find nearer than what they had enters their lists. Only
   pairs with a new entry meet. Entries further apart than twice the threshold's angle
   are left out: no neighbour of the one links with a neighbour of the other through it.
   Rounds end when hardly any entry within the threshold is new.
3. Saturation: a node whose whole list links may have more links than it lists. Its list
   is enlarged to its component, whose members meet block by block; a task holds two
   blocks and tells counts, not pairs.
4. Audit: the links of about ``AUDITED`` nodes are counted against all nodes. Below the
   wanted recall, the start is done again with other directions on top of what is known.

Steps 1 and 2 compare bytes, one for each component, with a proven bound on their error;
what may link by it is compared in double precision. So no link is below the threshold,
and none is lost but those that the lists never met, which the audit measures.

Null and zero vectors, those that hold a null or a non-finite component and those of
another length than most link with nothing, and neither do rows without an id, whose
component is null. Rows that repeat link with each other as different vectors do; an
empty table gives no rows. Other columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm import arrow, store
from footfall.llm.components import components

TABLES = 12
BLOCK = 256
LISTED = 8
# Nearest ones that a node takes from one block or group, besides those it may link with.
TAKEN = 3
GROUP = 64
# Members of a block of a component.
PART = 256
AUDITED = 512
RECALL = 0.99
# A round that adds less than this share of the listed links is the last.
SETTLED = 0.001
BITS = 48

_FOUND = "a long, b long, s float"


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _vectors(column: pa.Array, n: int) -> np.ndarray:
    return _unit(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1))


def codes_of(unit: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Bytes that stand for each vector, a byte a component and a scale, and the length of their error."""
    scale = (np.abs(unit).max(axis=1) / 127).astype(np.float32)
    short = np.rint(unit / scale[:, None]).clip(-127, 127).astype(np.int8)
    gap = unit - short * scale[:, None].astype(np.float64)
    return [a.tobytes() + b.tobytes() for a, b in zip(short, scale, strict=True)], np.sqrt((gap * gap).sum(axis=1))


def decoded(codes: list[bytes]) -> np.ndarray:
    body = np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1)
    scale = np.ascontiguousarray(body[:, -4:]).view(np.float32)
    return body[:, :-4].view(np.int8).astype(np.float32) * scale


def nearest_in(ids: np.ndarray, x: np.ndarray, new: np.ndarray, floor: float, links: float, all_of: int = LISTED):
    """(a, b, s): for each vector its best others, ``TAKEN`` of them above ``floor``, ``all_of`` above ``links``.

    Of two vectors at least one must be new. An id may come twice; it is no neighbour of itself.
    """
    s = x @ x.T
    s[(ids[:, None] == ids) | ~(new[:, None] | new)] = -2
    k = min(all_of, len(ids) - 1)
    if k < 1:
        return ids[:0], ids[:0], s[0, :0]
    best = np.argpartition(-s, k - 1, axis=1)[:, :k]
    score = np.take_along_axis(s, best, axis=1)
    order = np.argsort(-score, axis=1, kind="stable")
    best, score = (np.take_along_axis(y, order, axis=1) for y in (best, score))
    row, col = np.nonzero((score >= floor) & ((np.arange(k) < TAKEN) | (score >= links)))
    return ids[row], ids[best[row, col]], score[row, col]


def _found(parts: list[tuple]) -> pa.RecordBatch:
    a, b, s = (np.concatenate([p[k] for p in parts]) if parts else np.empty(0, np.int64) for k in range(3))
    return pa.RecordBatch.from_arrays(
        [pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64)), pa.array(s.astype(np.float32))], names=["a", "b", "s"]
    )


def _start(codes: DataFrame, seed: int, floor: float, links: float) -> DataFrame:
    """(a, b, s) of nodes that some order of random sign codes brings near each other."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = decoded(batch.column(1).to_pylist())
            if directions is None:
                directions = np.random.default_rng(seed).normal(size=(TABLES, x.shape[1], BITS)).astype(np.float32)
            for t, way in enumerate(directions):
                keys = ((x @ way > 0) @ (1 << np.arange(BITS, dtype=np.int64))).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), t, np.int32)), pa.array(keys), batch.column(0), batch.column(1)],
                    names=["t", "key", "node", "code"],
                )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, bytes]] = []
        for batch in batches:
            rows = [*held, *zip(*(batch.column(k).to_pylist() for k in (0, 2, 3)), strict=True)]
            parts, first = [], 0
            while first < len(rows):
                last = first
                while last < len(rows) and last - first < BLOCK and rows[last][0] == rows[first][0]:
                    last += 1
                if last == len(rows) and last - first < BLOCK:
                    break  # more of this block may come
                parts.append(block(rows[first:last]))
                first = last
            held = rows[first:]
            yield _found(parts)
        if held:
            yield _found([block(held)])

    def block(rows: list[tuple[int, int, bytes]]) -> tuple:
        ids = np.array([node for _, node, _ in rows], np.int64)
        return nearest_in(ids, decoded([code for *_, code in rows]), np.ones(len(ids), bool), floor, links)

    signed = codes.select("node", "code").mapInArrow(arrow.tidy(sign), "t int, key long, node long, code binary")
    return signed.orderBy("t", "key", "node").mapInArrow(arrow.tidy(meet), _FOUND)


def _listed(found: DataFrame, name: str) -> DataFrame:
    """(a, b, s, new): the ``LISTED`` nearest of every node; what was known (new = false) stays so."""
    # Pairs are met many times and a hub meets very many: both shrink before they are dealt by node.
    once = found.groupBy("a", "b").agg(F.max("s").alias("s"), F.min("new").alias("new"))
    best = Window.partitionBy("a").orderBy(F.desc("s"), "b")
    ranked = once.withColumn("place", F.row_number().over(best)).where(F.col("place") <= LISTED).drop("place")
    return store.written(ranked, name)


def _round(lists: DataFrame, codes: DataFrame, floor: float, links: float, seed: int) -> DataFrame:
    """(a, b, s) of nodes that meet over a common neighbour, of which one is new on a list there."""
    met = lists.select(F.col("a").alias("v"), F.col("b").alias("node"), "new").unionByName(
        lists.select(F.col("b").alias("v"), F.col("a").alias("node"), "new")
    )
    # A node that very many list is met in several groups, dealt anew in every round.
    hubs = met.groupBy("v").agg(F.count("*").alias("n")).where(F.col("n") > GROUP)
    met = met.join(hubs, "v", "left").withColumn(
        "part", F.pmod(F.xxhash64("node", F.lit(seed)), F.coalesce(F.ceil(F.col("n") / GROUP), F.lit(1)))
    ).drop("n")
    dealt = met.join(codes.select("node", "code"), "node").repartition("v", "part").sortWithinPartitions("v", "part")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            v, part = table["v"].to_numpy(), table["part"].to_numpy()
            starts = np.flatnonzero(np.append(True, (v[1:] != v[:-1]) | (part[1:] != part[:-1]))[: len(v)])
            stop = starts[-1] if len(starts) else 0
            yield groups(table.slice(0, stop), starts)
            rest = table.slice(stop).to_batches()
            held = rest[0] if rest else None
        if held is not None:
            yield groups(pa.Table.from_batches([held]), np.array([0, held.num_rows]))

    def groups(table: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        if not table.num_rows:
            return _found([])
        ids, new = table["node"].to_numpy(), table["new"].to_numpy(zero_copy_only=False)
        x = decoded(table["code"].to_pylist())
        some = [(a, b) for a, b in zip(starts[:-1], starts[1:], strict=True) if b - a > 1 and new[a:b].any()]
        return _found([nearest_in(ids[a:b], x[a:b], new[a:b], floor, links) for a, b in some])

    rows = dealt.select("v", "part", "node", "new", "code")
    return rows.mapInArrow(arrow.tidy(meet), _FOUND)


def _cosines(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of nodes whose cosine in double precision reaches the threshold."""
    for side in "ab":
        pairs = pairs.join(nodes.select(F.col("node").alias(side), F.col("vector").alias(f"v{side}")), side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (_vectors(batch.column(k), batch.num_rows) for k in (2, 3))
                batch = batch.filter(pa.array((x * y).sum(axis=1) >= threshold))
            yield batch.select([0, 1])

    return store.written(pairs.select("a", "b", "va", "vb").mapInArrow(arrow.tidy(run), "a long, b long"), "links")


def _block_counts(members: DataFrame, threshold: float) -> DataFrame:
    """(node, linked): the summed weight of what each member of a component links with, block by block."""
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / PART).alias("parts"))
    dealt = members.join(sizes, "component").withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    dealt = dealt.select(
        "component", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "node", "weight", "vector"
    )

    def count(rows: pa.Table) -> pa.Table:
        unit = _vectors(rows["vector"].combine_chunks(), rows.num_rows)
        own, x = rows["own"].to_numpy(), rows["x"].to_numpy()
        weight, total = rows["weight"].to_numpy(), np.zeros(rows.num_rows, np.int64)
        left = np.flatnonzero(own == x)
        right = np.flatnonzero(own == rows["y"].to_numpy())
        linked = unit[left] @ unit[right].T >= threshold
        if np.array_equal(left, right):
            np.fill_diagonal(linked, False)
            total[left] = linked @ weight[right]
        else:
            total[left] = linked @ weight[right]
            total[right] = linked.T @ weight[left]
        return pa.table({"node": rows["node"].cast(pa.int64()), "linked": pa.array(total)})

    counts = dealt.groupBy("component", "x", "y").applyInArrow(count, "node long, linked long")
    return counts.groupBy("node").agg(F.sum("linked").alias("linked"))


def _audit(nodes: DataFrame, counts: DataFrame, n: int, threshold: float) -> float:
    """The share of the links of some nodes, drawn by a hash, that were found."""
    share = min(1.0, AUDITED / n)
    drawn = F.pmod(F.xxhash64("low", "k1"), F.lit(1 << 30)) < int(share * (1 << 30))
    chosen = nodes.where(drawn).select("node", "vector").limit(2 * AUDITED).collect()
    if not chosen:
        return 1.0
    ids = np.array([row["node"] for row in chosen])
    shared = nodes.sparkSession.sparkContext.broadcast((ids, _unit(np.array([row["vector"] for row in chosen], np.float64))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, asked = shared.value
        total = np.zeros(len(ids), np.int64)
        for batch in batches:
            if batch.num_rows:
                linked = _vectors(batch.column(2), batch.num_rows) @ asked.T >= threshold
                linked &= batch.column(0).to_numpy()[:, None] != ids
                total += batch.column(1).to_numpy() @ linked
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], names=["node", "n"])

    rows = nodes.select("node", "weight", "vector").mapInArrow(arrow.tidy(run), "node long, n long")
    true = rows.groupBy("node").agg(F.sum("n").alias("n")).where("n > 0")
    both = true.join(counts, "node", "left").agg(F.sum("n"), F.sum(F.least("n", F.coalesce("linked", F.lit(0))))).first()
    return both[1] / both[0] if both[0] else 1.0


def link_vectors(
    df: DataFrame, threshold: float = 0.9, recall: float = RECALL, most_starts: int = 4,
    vec_id: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """vec_id, n_links (other vectors of a cosine of ``threshold`` or more), component_id and kept.

    ``component_id`` is the smallest id reachable by links, ``kept`` whether it is the
    row's own. The start is done ``most_starts`` times at most.
    """
    spark = df.sparkSession
    arrow.small_batches(spark)
    rows = df.select(arrow.column(vec_id).cast("long").alias("vec_id"), arrow.column(vector).alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    able = F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("size", F.when(able, F.size("vector")))
    # Adding zero makes both zeros one.
    whole = F.transform("vector", lambda x: x.cast("double") + F.lit(0.0))
    rows = rows.withColumn("k1", F.xxhash64(whole)).withColumn("k2", F.xxhash64(F.lit(1), whole))
    common = rows.where("size IS NOT NULL").groupBy("size").count().orderBy(F.desc("count"), "size").first()

    def alone(some: DataFrame) -> DataFrame:
        own = F.col("vec_id").alias("component_id")
        return some.select("vec_id", F.lit(0).cast("long").alias("n_links"), own, F.lit(True).alias("kept"))

    if common is None:
        return alone(rows)
    valid = F.col("size").isNotNull() & (F.col("size") == common["size"])
    classes = rows.where(valid).groupBy("k1", "k2").agg(
        F.min("vec_id").alias("low"), F.count("*").alias("weight"), F.any_value("vector").alias("vector")
    )
    nodes = store.written(classes.withColumn("node", F.monotonically_increasing_id()), "vectors")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, gap = codes_of(_vectors(batch.column(1), batch.num_rows)) if batch.num_rows else ([], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(codes, pa.binary()), pa.array(gap, pa.float64())], names=["node", "code", "gap"]
            )

    coded = nodes.select("node", "vector").mapInArrow(arrow.tidy(encode), "node long, code binary, gap double")
    codes = store.written(coded, "codes")
    n, gap = codes.agg(F.count("*"), F.max("gap")).first()
    # |xy - x'y'| <= |x - x'| |y| + |y - y'| |x'|; the rest is for sums in single precision.
    margin = gap + gap * (1 + gap) + 1e-4
    links = threshold - margin
    floor = math.cos(min(math.pi, 2 * math.acos(max(-1.0, min(1.0, threshold))))) - margin

    lists, counts, component = None, None, None
    for start in range(most_starts):
        found = _start(codes, 7919 * start + 1, floor, links).withColumn("new", F.lit(True))
        if lists is not None:
            found = found.unionByName(lists.withColumn("new", F.lit(False)))
        lists = _listed(found, "lists")
        for turn in range(1, 2 + math.ceil(math.log2(n + 1))):
            more = _round(lists, codes, floor, links, turn).withColumn("new", F.lit(True))
            lists = _listed(more.unionByName(lists.withColumn("new", F.lit(False))), "lists")
            near = lists.where(F.col("s") >= links).agg(F.count("*"), F.count_if("new")).first()
            if near[1] <= SETTLED * near[0]:
                break
        pairs = lists.where(F.col("s") >= links).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        edges = _cosines(store.written(pairs.distinct(), "near-pairs"), nodes, threshold)
        component = components(edges)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        degree = store.written(
            both.join(nodes.select(F.col("node").alias("b"), "weight"), "b").groupBy(F.col("a").alias("node"))
            .agg(F.count("*").alias("n"), F.sum("weight").alias("linked")), "degrees",
        )
        full = degree.where(F.col("n") >= LISTED).join(component, "node").select("component").distinct()
        grown = component.join(store.written(full, "saturated"), "component", "left_semi")
        grown = _block_counts(grown.join(nodes.select("node", "weight", "vector"), "node"), threshold)
        counts = degree.select("node", F.col("linked").alias("listed")).join(grown, "node", "left")
        counts = store.written(counts.select("node", F.coalesce("linked", "listed").alias("linked")), "counts")
        if start + 1 == most_starts or _audit(nodes, counts, n, threshold) >= recall:
            break

    lows = component.join(nodes.select("node", "low"), "node")
    lows = lows.join(lows.groupBy("component").agg(F.min("low").alias("lowest")), "component").select("node", "lowest")
    told = nodes.select("k1", "k2", "node", "weight", "low").join(lows, "node", "left").join(counts, "node", "left")
    told = told.select(
        "k1", "k2", (F.col("weight") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
        F.coalesce("lowest", "low").alias("component_id"),
    )
    linked = rows.where(valid).select("vec_id", "k1", "k2").join(told, ["k1", "k2"]).select(
        "vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept")
    )
    return linked.unionByName(alone(rows.where(~valid)))
