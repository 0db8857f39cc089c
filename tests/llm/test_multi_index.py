from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.llm import multi_index

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(n, d=12, seed=0):
    x = np.random.default_rng(seed).normal(size=(n, d)).astype(np.float32)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def best(ids, x, query, top):
    x = x.astype(np.float64)
    score = (x * x[ids.index(query)]).sum(axis=1)
    order = sorted((-s, i) for s, i in zip(score, ids, strict=True) if i != query)[:top]
    return [(i, -s) for s, i in order]


def answers(df, every=20, **options):
    out = {}
    for row in multi_index.search(df, F.col("vec_id") % every == 0, **options).orderBy("query_id", "rank").collect():
        out.setdefault(row.query_id, []).append((row["rank"], row.vec_id, row.score))
    return out


def test_recall_and_exact_scores(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "LEAST_OPENED", 1)
    monkeypatch.setattr(multi_index, "GROUP_ROWS", 100)
    monkeypatch.setattr(multi_index, "PART_ROWS", 20)
    x = vectors(1500)
    ids = list(range(1500))
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in zip(ids, x, strict=True)], SCHEMA)
    found = answers(df)
    assert sorted(found) == ids[::20]
    hits = 0
    for query, rows in found.items():
        assert [rank for rank, _, _ in rows] == list(range(1, 21))
        wanted = best(ids, x, query, 20)
        hits += len({i for i, _ in wanted} & {i for _, i, _ in rows})
        exact = (x[[i for _, i, _ in rows]].astype(float) * x[query].astype(float)).sum(axis=1)
        assert np.allclose([s for _, _, s in rows], exact, atol=1e-14)
    assert hits >= 0.9 * 20 * len(found)


def test_all_opened_is_brute_force_also_with_many_equal_vectors(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "GROUP_ROWS", 16)
    x = vectors(150)
    x[50:120] = x[50]  # one cell spans several groups
    ids = [3 * i for i in range(150)]
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in zip(ids, x, strict=True)], SCHEMA).repartition(6)
    found = answers(df, every=10, opened=1.0)
    for query, rows in found.items():
        assert [i for _, i, _ in rows] == [i for i, _ in best(ids, x, query, 20)]
    assert sorted(found) == [i for i in ids if i % 10 == 0]


def test_cells_open_in_the_order_of_summed_scores():
    rng = np.random.default_rng(3)
    books = rng.normal(size=(5, 3)), rng.normal(size=(5, 3))
    counts = rng.integers(0, 4, 25)
    for wanted in (1, 5, 20, 1000):
        index = multi_index.Index(books, counts, *multi_index._deal(counts), wanted)
        query = rng.normal(size=6)
        score = ((books[0] @ query[:3])[:, None] + (books[1] @ query[3:])[None, :]).reshape(-1)
        opened, got = set(), 0
        for cell in np.argsort(-score, kind="stable"):
            if got >= wanted:
                break
            if counts[cell]:
                opened.add(int(cell))
                got += counts[cell]
        assert set(np.flatnonzero(multi_index.open_cells(query, index)).tolist()) == opened


def test_rows_that_take_no_part(spark):
    good = [(i, v.tolist(), 0) for i, v in enumerate(vectors(8, 4))]
    bad = [(20, None, 0), (40, [0.0] * 4, 0), (60, [1.0, None, 0.0, 0.0], 0), (80, [float("nan"), 1.0, 1.0, 1.0], 0),
           (100, [float("inf"), 0.0, 0.0, 0.0], 0), (120, [1.0, 2.0], 0), (140, [], 0), (None, [1.0] * 4, 0)]
    df = spark.createDataFrame(good + bad, SCHEMA).withColumn("cell", F.lit("x")).withColumn("a.b", F.lit(1))
    found = answers(df)
    assert list(found) == [0] and sorted(i for _, i, _ in found[0]) == list(range(1, 8))


@pytest.mark.parametrize("rows", [[], [(0, None, 0)], [(0, [1.0, 2.0], 0)]])
def test_empty_and_single(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    found = multi_index.search(df, F.col("vec_id") % 20 == 0)
    assert found.columns == ["query_id", "rank", "vec_id", "score"] and found.count() == 0


def test_one_component_vectors(spark):
    df = spark.createDataFrame([(i, [float(i + 1)], 0) for i in range(5)], SCHEMA)
    assert [i for _, i, _ in answers(df)[0]] == [4, 3, 2, 1]


def test_repeated_rows_are_answered_each(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "GROUP_ROWS", 16)
    x = vectors(90)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    again = [rows[0], rows[0], rows[20], rows[33], rows[33]]
    df = spark.createDataFrame(rows + again, SCHEMA).repartition(5)
    found = multi_index.search(df, F.col("vec_id") % 20 == 0, opened=1.0).collect()
    held = [(i, np.array(v, np.float32).astype(float)) for i, v, _ in rows + again]
    for query in (0, 20, 40, 60, 80):
        own = x[query].astype(float)
        wanted = sorted((-(v * own).sum(), i) for i, v in held if i != query)[:20]
        copies = sum(i == query for i, _ in held)
        answered = sorted((r["rank"], r.vec_id) for r in found if r.query_id == query)
        assert answered == sorted((k + 1, i) for k, (_, i) in enumerate(wanted) for _ in range(copies))


def test_recall_without_the_floor(spark, monkeypatch):
    """The method itself, on the larger of the given tables."""
    monkeypatch.setattr(multi_index, "LEAST_OPENED", 1)
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    held = df.select("vec_id", "embedding").collect()
    ids, x = np.array([r.vec_id for r in held]), np.array([r.embedding for r in held], float)
    found = answers(df)
    hits = 0
    for query, rows in found.items():
        score = (x * x[ids == query]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != query][:20]
        hits += len(set(ids[order].tolist()) & {i for _, i, _ in rows})
    assert len(found) == 100 and hits >= 0.9 * 20 * len(found)
