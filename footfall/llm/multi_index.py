"""Nearest neighbours by largest inner product over an inverted multi-index.

Vectors are cut into two halves, each quantised by its own codebook; the pair of
codes is a vector's cell. A query scores every code of both halves and takes cells in
the order of the summed scores from a heap, until the cells it has opened hold a
given share of all vectors. The vectors of the opened cells are scored exactly.

The index is dealt into groups of whole cells of about ``GROUP_ROWS`` vectors; a cell
larger than that (many equal vectors) spans several groups, its vectors dealt by
their id's hash. Queries are dealt into parts of about ``PART_ROWS``. A task joins
one part with one group and keeps each query's best, so no task holds more than
that, and a query goes only to groups of which it has opened a cell.

Vectors that are null, zero, of another length than most or that hold a null or
non-finite component take no part, and neither do rows without an id.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from heapq import heappop, heappush
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm import arrow, store

# The codebooks are fitted on so many vectors at most; every vector is indexed.
SAMPLE = 1 << 14
ITERATIONS = 12
# Share of all vectors in the cells that a query opens.
OPENED = 0.55
# A query opens at least so many vectors, if there are so many.
LEAST_OPENED = 384
GROUP_ROWS = 1 << 12
PART_ROWS = 1 << 12
# Queries whose cells one task walks, where there are tasks enough.
ROUTED = 64
MAX_CODES = 256

_CODED = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("cell", T.IntegerType()),
    T.StructField("vector", T.BinaryType()),
])


def n_codes(n: int) -> int:
    """Codes of a half: with the cube root of n, so cells grow more slowly than the heap's work."""
    return int(min(MAX_CODES, max(8, round(2.6 * n ** (1 / 3)))))


def fit_codes(x: np.ndarray, k: int, iterations: int = ITERATIONS) -> np.ndarray:
    """Codebook of ``k`` centroids by Lloyd's rounds; empty ones take the worst-served vectors."""
    centres = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(iterations):
        gap = (centres * centres).sum(axis=1) - 2 * x @ centres.T
        code = gap.argmin(axis=1)
        counts = np.bincount(code, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, code, x)
        full = counts > 0
        centres[full] = sums[full] / counts[full, None]
        if not full.all():
            far = np.argsort(-(gap.min(axis=1) + (x * x).sum(axis=1)), kind="stable")
            centres[~full] = x[far[: (~full).sum()]]
    return centres


def codes_of(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)


class Index(NamedTuple):
    """What tasks need besides the coded vectors; its size depends on the codebooks only."""

    books: tuple[np.ndarray, np.ndarray]
    counts: np.ndarray  # vectors of each cell
    first_group: np.ndarray  # of each cell
    n_groups: np.ndarray  # that each cell spans
    wanted: int  # vectors that a query opens


def open_cells(query: np.ndarray, index: Index) -> np.ndarray:
    """Which cells a query opens, best summed score first until they hold enough vectors."""
    left, right = index.books
    half = left.shape[1]
    scores = left @ query[:half], right @ query[half:]
    orders = [np.argsort(-s, kind="stable") for s in scores]
    a_scores, b_scores = (s[o].tolist() for s, o in zip(scores, orders, strict=True))
    a_codes, b_codes = (o.tolist() for o in orders)
    k, counts = len(right), index.counts
    opened = np.zeros(len(counts), bool)
    heap, got = [(-a_scores[0] - b_scores[0], 0, 0)], 0
    while heap and got < index.wanted:
        _, a, b = heappop(heap)
        cell = a_codes[a] * k + b_codes[b]
        if counts[cell]:
            opened[cell] = True
            got += counts[cell]
        if b + 1 < k:
            heappush(heap, (-a_scores[a] - b_scores[b + 1], a, b + 1))
        if b == 0 and a + 1 < len(a_scores):
            heappush(heap, (-a_scores[a + 1] - b_scores[0], a + 1, 0))
    return opened


def best_of(query_ids, queries, opened, ids, cells, vectors, top: int):
    """(query number, vector number, score) of each query's best vectors in opened cells.

    Equal scores go to smaller ids. Scores are summed component by component for each
    pair, so equal vectors have equal scores wherever they lie.
    """
    found = []
    for i in range(len(queries)):
        able = np.flatnonzero(opened[i, cells] & (ids != query_ids[i]))
        if not len(able):
            continue
        rough = vectors[able] @ queries[i]
        if len(able) > top:
            limit = np.partition(rough, len(able) - top)[len(able) - top]
            able = able[rough >= limit - 1e-9 * max(1.0, abs(limit))]
        score = (vectors[able] * queries[i]).sum(axis=1)
        order = np.lexsort((ids[able], -score))[:top]
        found.append((np.full(len(order), i), able[order], score[order]))
    if not found:
        return (np.empty(0, np.int64),) * 2 + (np.empty(0),)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _valid(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, vector) of the rows that take part, of any length."""
    rows = df.select(arrow.column(vec_id).cast("long").alias("vec_id"), arrow.column(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda x: x != 0))


def _fit(rows: DataFrame, n: int, k: int, sample: int) -> tuple[np.ndarray, np.ndarray]:
    # About twice the sample by a hash, so that few rows are ranked.
    drawn = F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(1 << 30)) <= int(min(1.0, 2 * sample / n) * (1 << 30))
    chosen = rows.where(drawn).orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample)

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        x = np.array(pd.concat(list(batches))["vector"].tolist(), np.float64)
        half = x.shape[1] // 2
        books = fit_codes(x[:, :half], min(k, len(x))), fit_codes(x[:, half:], min(k, len(x)))
        yield pd.DataFrame({"books": [pickle.dumps(books)]})

    return pickle.loads(chosen.repartition(1).mapInPandas(learn, "books binary").first()["books"])


def _code(rows: DataFrame, books: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = shared.value
        half = left.shape[1]
        for batch in batches:
            n = batch.num_rows
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(n, half + right.shape[1])
            cell = codes_of(x[:, :half], left) * len(right) + codes_of(x[:, half:], right)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cell.astype(np.int32)), pa.array([row.tobytes() for row in x], pa.binary())],
                names=_CODED.names,
            )

    return rows.select("vec_id", "vector").mapInArrow(arrow.tidy(run), _CODED)


def _deal(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first group, number of groups) of each cell: whole cells together, large ones spread."""
    first, spans = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64)
    group, held = 0, 0
    for cell, count in enumerate(counts.tolist()):
        if count > GROUP_ROWS:
            if held:
                group += 1
            first[cell], spans[cell] = group, math.ceil(count / GROUP_ROWS)
            group, held = group + int(spans[cell]), 0
            continue
        if held + count > GROUP_ROWS:
            group, held = group + 1, 0
        first[cell] = group
        held += count
    return first, spans


def search(
    df: DataFrame, is_query, top: int = 20, opened: float = OPENED, vec_id: str = "vec_id",
    vector: str = "embedding", sample: int = SAMPLE,
) -> DataFrame:
    """The ``top`` vectors of largest inner product for every query, best first.

    ``is_query`` is a condition on ``vec_id``; a query's own id is no candidate. Returns
    query_id, rank (from 1), vec_id and score (the inner product in double precision);
    equal scores go to smaller ids. A row that repeats is a candidate as often as it does,
    and as a query it is answered as often. At least ``top`` candidates are opened where there
    are so many. Without any valid vector there are no rows.
    """
    spark = df.sparkSession
    result = "asked long, query_id long, vec_id long, score double"
    rows = _valid(df, vec_id, vector)
    common = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size, n = common
    rows = rows.where(F.size("vector") == size)
    books = _fit(rows, n, n_codes(n), sample)
    coded = store.written(_code(rows, books), "coded")
    counts = np.zeros(len(books[0]) * len(books[1]), np.int64)
    for row in coded.groupBy("cell").count().collect():  # one row per cell at most
        counts[row["cell"]] = row["count"]
    first, spans = _deal(counts)
    index = Index(books, counts, first, spans, max(math.ceil(opened * n), LEAST_OPENED, 2 * top + 1))
    shared = spark.sparkContext.broadcast(index)
    # Rows that repeat are queries of their own.
    queries = coded.where(is_query).withColumn("asked", F.monotonically_increasing_id())
    n_queries = queries.count()
    parts = max(1, math.ceil(n_queries / PART_ROWS))
    walks = max(parts, min(math.ceil(n_queries / ROUTED), 4 * spark.sparkContext.defaultParallelism))

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for batch in batches:
            masks, groups = [], []
            for body in batch["vector"]:
                cells = open_cells(np.frombuffer(body), known)
                at = np.flatnonzero(cells)
                spread = [known.first_group[at]] + [
                    known.first_group[c] + np.arange(known.n_groups[c]) for c in at[known.n_groups[at] > 1]
                ]
                groups.append(np.unique(np.concatenate(spread)))
                masks.append(np.packbits(cells).tobytes())
            yield batch[["asked", "vec_id", "vector"]].assign(mask=masks, groups=groups)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for batch in batches:
            cell = batch["cell"].to_numpy()
            salt = (batch["vec_id"].to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            batch["part_of"] = known.first_group[cell] + (salt.astype(np.int64) % known.n_groups[cell])
            yield batch

    part = F.pmod(F.xxhash64("asked"), F.lit(parts))
    routed = (
        queries.repartition(walks, F.xxhash64("asked")).select("asked", "vec_id", "vector")
        .mapInPandas(route, "asked long, vec_id long, vector binary, mask binary, groups array<long>")
        .select(F.explode("groups").alias("group"), part.alias("part"), "asked", "vec_id", "vector", "mask")
    )
    dealt = (
        coded.mapInPandas(place, "vec_id long, cell int, vector binary, part_of long")
        .select(F.col("part_of").alias("group"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"),
                "vec_id", "cell", "vector")
    )

    def meet(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(held):
            return pd.DataFrame({"asked": [], "query_id": [], "vec_id": [], "score": []}, dtype=np.int64).astype({"score": float})
        n_cells = len(shared.value.counts)
        masks = np.frombuffer(b"".join(asked["mask"]), np.uint8).reshape(len(asked), -1)
        mask = np.unpackbits(masks, axis=1, count=n_cells).astype(bool)
        q = np.frombuffer(b"".join(asked["vector"])).reshape(len(asked), -1)
        x = np.frombuffer(b"".join(held["vector"])).reshape(len(held), -1)
        ids, query_ids = held["vec_id"].to_numpy(), asked["vec_id"].to_numpy()
        i, j, score = best_of(query_ids, q, mask, ids, held["cell"].to_numpy(), x, top)
        asked_ids = asked["asked"].to_numpy()
        return pd.DataFrame({"asked": asked_ids[i], "query_id": query_ids[i], "vec_id": ids[j], "score": score})

    near = routed.groupBy("group", "part").cogroup(dealt.groupBy("group", "part")).applyInPandas(meet, result)
    best = Window.partitionBy("asked").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")
