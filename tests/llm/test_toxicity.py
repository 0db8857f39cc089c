from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from footfall.llm import arrow, toxicity

BAD = ["idiot", "moron", "worthless", "pathetic", "trash"]
STEM = "lowei"


def corpus(n, seed=1):
    pick = random.Random(seed)
    clean = ["".join(pick.choice("ka mo ti ra lu se".split()) for _ in range(3)) for _ in range(300)]
    out = []
    for i in range(n):
        words = [pick.choice(clean) for _ in range(pick.randint(10, 60))]
        kind = i % 6
        if kind == 0:
            for _ in range(3):
                words[pick.randrange(len(words))] = pick.choice(BAD).upper() + pick.choice(["", "!", "$$$"])
        if kind == 1:
            for _ in range(3):
                words[pick.randrange(len(words))] = STEM + pick.choice(clean)
        out.append((i, " ".join(words), int(kind < 2)))
    return out


@pytest.fixture(scope="module")
def rows():
    return corpus(600)


@pytest.fixture
def tables(spark, rows):
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    named = [(i, None if i % 7 == 1 else int(STEM not in t), y) for i, t, y in rows if i % 5]
    labels = spark.createDataFrame(named, "doc_id long, quality int, toxic int")
    return docs, labels


def test_unlabelled_documents_are_told_apart(tables, rows):
    docs, labels = tables
    found = toxicity.with_toxicity(docs, toxicity.fit(docs, labels)).collect()
    wrong = [r.doc_id for r in found if r.toxic != bool(rows[r.doc_id][2]) or r.kept == r.toxic]
    assert not wrong
    assert all(0 <= r[f"p_{name}"] <= 1 for r in found for name in toxicity.CATEGORIES)
    assert np.mean([(r.p_quality > 0.5) == (STEM not in rows[r.doc_id][1]) for r in found]) > 0.97


def test_categories_are_named_by_the_caller(tables):
    docs, labels = tables
    one = toxicity.with_toxicity(docs, toxicity.fit(docs, labels, categories=["toxic"]))
    assert one.columns == ["doc_id", "text", "p_toxic", "toxic", "kept"]
    turned = labels.selectExpr("doc_id", "toxic AS first", "1 - quality AS second").where("second IS NOT NULL")
    found = toxicity.with_toxicity(docs, toxicity.fit(docs, turned, categories=["first", "second"]))
    assert found.where("toxic").select("doc_id").exceptAll(one.where("toxic").select("doc_id")).count() == 0
    assert found.where("toxic").where(~F.col("text").contains(STEM)).count() == 0 < found.where("toxic").count()


def test_a_link_learns_from_known_labels_alone():
    pick = np.random.default_rng(2)
    x, fold = pick.normal(size=(120, 3)), np.arange(120) % 5
    labels = (pick.random((120, 2)) < 0.5).astype(float)
    labels[::4, 0] = np.nan
    known = ~np.isnan(labels[:, 0])
    links = toxicity.fit_chain(x, labels, fold)
    assert np.allclose(links[0], toxicity.fit_link(x[known], labels[known, 0]))
    labels[:, 0] = np.nan
    assert toxicity.run_chain(x, toxicity.fit_chain(x, labels, fold))[:, 0].max() < 1e-9


def test_links_see_earlier_probabilities_out_of_fold():
    pick = np.random.default_rng(0)
    x = pick.normal(size=(200, 5))
    labels = np.stack([pick.random(200) < 0.5, pick.random(200) < 0.5], axis=1).astype(float)
    fold = np.arange(200) % 5
    links = toxicity.fit_chain(x, labels, fold)
    assert [len(w) for w in links] == [6, 7]
    apart = np.empty(200)
    for held in range(5):
        rest = fold != held
        apart[~rest] = toxicity.probability(x[~rest], toxicity.fit_link(x[rest], labels[rest, 0]))
    assert np.allclose(links[1], toxicity.fit_link(np.column_stack([x, apart]), labels[:, 1]))
    found = toxicity.run_chain(x, links)
    assert np.allclose(found[:, 1], toxicity.probability(np.column_stack([x, found[:, 0]]), links[1]))


def test_a_link_is_the_minimum_of_its_loss():
    pick = np.random.default_rng(1)
    x, y = pick.normal(size=(300, 4)), (pick.random(300) < 0.3).astype(float)
    w = toxicity.fit_link(x, y, penalty=2.0)
    x1 = np.column_stack([x, np.ones(300)])
    gradient = x1.T @ (1 / (1 + np.exp(-x1 @ w)) - y) + np.array([2.0] * 4 + [1e-6]) * w
    assert np.abs(gradient).max() < 1e-4


def test_counts_cover_the_whole_text_and_see_through_signs():
    words = np.sort(np.array([toxicity.word_hash("idiot"), toxicity.word_hash("éa")], np.uint64))
    texts = ["x " * 30_000 + "Idiot", "idiot$$$ IDIOT, an idiotic", "éa", "", "idiot" * 2]
    found = np.expm1(toxicity.word_counts(arrow.texts_of(pa.array(texts)), words)).round().sum(axis=1)
    assert found.tolist() == [1, 2, 1, 0, 0]


def test_odd_rows_and_clashing_columns(tables, odd_docs):
    model = toxicity.fit(*tables)
    docs = odd_docs.withColumn("TOXIC", F.lit("x")).withColumn("kept", F.lit(1)).withColumn("a.b", F.lit(1))
    found = toxicity.with_toxicity(docs, model)
    assert found.count() == odd_docs.count() and "TOXIC" not in found.columns
    assert all(row.kept and not row.toxic for row in found.collect())
    kept = toxicity.keep_civil(docs, model)
    assert kept.dtypes == docs.dtypes and kept.count() == docs.count()


def test_odd_labels_and_no_labels(tables, spark):
    docs, labels = tables
    assert toxicity.fit(docs, labels.limit(0)) is None
    assert toxicity.fit(docs, labels.where("toxic = 0")) is None
    assert toxicity.fit(docs.limit(0), labels) is None
    found = toxicity.with_toxicity(docs, None).collect()
    assert all(row.kept and row.p_toxic == 0 for row in found)
    odd = spark.createDataFrame([(None, 1, 1), (1, 0, None), (10**9, None, 1)], "doc_id long, quality int, toxic int")
    more = labels.unionAll(labels).unionAll(odd).withColumn("text", F.lit("clash"))
    model = toxicity.fit(docs.withColumn("toxic", F.lit(9)), more)
    assert toxicity.keep_civil(docs, model).count() == 400
    assert toxicity.with_toxicity(docs.limit(0), model).count() == 0
