from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.llm import neighbours

VECTORS = "vec_id long, embedding array<float>"


def by_hand(rows, threshold=0.9):
    """{(id, links, component)} with repeats, of (id, list of floats or None)."""
    able = [i for i, (key, x) in enumerate(rows) if key is not None and x and None not in x and np.isfinite(x).all() and any(x)]
    x = np.array([rows[i][1] for i in able], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    linked = x @ x.T >= threshold
    np.fill_diagonal(linked, False)
    parent = list(range(len(able)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in zip(*np.nonzero(linked), strict=True):
        a, b = sorted((top(a), top(b)), key=lambda k: rows[able[k]][0])
        parent[b] = a
    out = [(key, 0, key) for i, (key, _) in enumerate(rows) if i not in set(able)]
    lows = {}
    for i in range(len(able)):
        lows[top(i)] = min(lows.get(top(i), math.inf), rows[able[i]][0])
    out += [(rows[able[i]][0], int(linked[i].sum()), lows[top(i)]) for i in range(len(able))]
    return sorted(out, key=repr)


def found_by(spark, rows, **how):
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    out = neighbours.link_vectors(df, **how).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in out), key=repr)


def clusters(seed, sizes, noise, size=32):
    """Vectors around random centres, numbered in random order."""
    pick = np.random.default_rng(seed)
    parts = []
    for n in sizes:
        centre = pick.normal(size=size)
        parts.append(centre + noise * np.linalg.norm(centre) / math.sqrt(size) * pick.normal(size=(n, size)))
    x = np.concatenate(parts).astype(np.float32)
    ids = pick.permutation(len(x))
    return [(int(i), row.tolist()) for i, row in zip(ids, x, strict=True)]


def test_small_and_large_groups_equal_all_pairs(spark):
    rows = clusters(1, [1] * 300 + [2] * 60 + [5] * 20 + [40, 700], 0.2)
    assert found_by(spark, rows) == by_hand(rows)


def test_links_near_the_threshold_are_found(spark):
    rows = clusters(2, [1] * 1500 + [2] * 300 + [4] * 100 + [90], 0.31)
    wanted = {key: (n, c) for key, n, c in by_hand(rows)}
    found = {key: (n, c) for key, n, c in found_by(spark, rows)}
    assert all(found[key][0] <= wanted[key][0] for key in wanted)
    true = sum(n for n, _ in wanted.values())
    assert true > 1000 and sum(n for n, _ in found.values()) >= 0.98 * true


def test_copies_are_one_node(spark):
    rows = clusters(3, [1] * 30 + [3], 0.1)
    rows += [(1000 + i, rows[0][1]) for i in range(2000)] + [(2000, rows[0][1]), (1, rows[1][1])]
    assert found_by(spark, rows) == by_hand(rows)


def test_odd_vectors_link_with_nothing(spark):
    good = [1.0, 2.0, 3.0]
    rows = [
        (1, good), (2, [2.0, 4.0, 6.0]), (3, None), (4, []), (5, [0.0, -0.0, 0.0]), (6, [1.0, None, 3.0]),
        (7, [1.0, float("nan"), 3.0]), (8, [float("inf"), 2.0, 3.0]), (None, good), (9, [-1.0, -2.0, -3.0]),
        (10, [1e30, 2e30, 3e30]), (11, [1e-30, 2e-30, 3e-30]), (12, [0.0, 1.0, 0.0]), (13, [-0.0, 1.0, -0.0]),
    ]
    wanted = by_hand([row for row in rows if row[0] is not None])
    found = [row for row in found_by(spark, [row for row in rows if row[0] is not None])]
    assert found == wanted and (1, 3, 1) in found and (13, 1, 12) in found
    out = neighbours.link_vectors(spark.createDataFrame(rows, VECTORS)).where("vec_id IS NULL").collect()
    assert [(r.n_links, r.component_id, r.kept) for r in out] == [(0, None, True)]


def test_lengths_other_than_most_and_clashing_columns(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [1.0, 2.0, 0.0]), (4, [1.0, 2.0, 0.0]), (5, [3.0, 6.0])]
    df = spark.createDataFrame(rows, VECTORS).withColumn("node", F.lit(1)).withColumn("n_links", F.lit(7)).withColumn("a.b", F.lit(1))
    found = neighbours.link_vectors(df)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, found.collect())) == [
        (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 2, 1, False),
    ]


def test_empty_tables(spark):
    assert found_by(spark, []) == []
    assert found_by(spark, [(1, None), (2, [0.0])]) == [(1, 0, 1), (2, 0, 2)]


def test_audit_counts_what_was_missed(spark):
    rows = clusters(4, [1] * 50 + [2] * 100, 0.1)
    df = spark.createDataFrame([(key, key, 1, key, x) for key, x in rows], "node long, low long, weight long, k1 long, vector array<float>")
    true = {key: n for key, n, _ in by_hand(rows)}
    half = [(key, n) for key, n in true.items() if n and key % 2]
    counts = spark.createDataFrame(half, "node long, linked long")
    share = neighbours._audit(df, counts, len(rows), 0.9)
    assert share == pytest.approx(sum(n for _, n in half) / sum(true.values()))


def test_codes_keep_their_error_bound():
    x = neighbours._unit(np.random.default_rng(0).normal(size=(200, 24)) ** 3)
    codes, gap = neighbours.codes_of(x)
    near = neighbours.decoded(codes).astype(float)
    bound = gap[:, None] + gap * (1 + gap[:, None]) + 1e-6
    assert (np.abs(near @ near.T - x @ x.T) <= bound).all()
