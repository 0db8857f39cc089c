from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from footfall.llm import jaccard
from footfall.llm.components import components


def token_set(text, n):
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    if 0 < len(words) < n:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def by_hand(rows, n, percent):
    """(doc_id, size, component) of rows (doc_id, text), from all pairs."""
    sets = [(i, token_set(text, n)) for i, text in rows]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    return sorted((i, len(a), root(i)) for i, a in sets)


def found(docs, n, percent):
    return sorted(tuple(row) for row in jaccard.similar_documents(docs, n, percent).collect())


def varied(pick, base, edits):
    words = base.split(" ")
    for _ in range(edits):
        at = pick.randrange(len(words))
        words[at : at + 1] = pick.choice([[f"new{pick.randrange(10**6)}"], [], [words[at], "more"]])
    return " ".join(words)


@pytest.fixture(scope="module")
def families():
    from tests.llm.conftest import prose

    pick = random.Random(5)
    texts = []
    for family in range(6):
        base = prose(60 + 40 * family, 1000 * family)
        texts += [base] * 3 + [varied(pick, base, pick.randint(0, 5)) for _ in range(12)]
    common = prose(40, 90_000)  # one passage that many otherwise different texts share
    texts += [common + " " + prose(pick.randint(1, 60), 10_000 + 100 * k) for k in range(25)]
    texts += [common, common.upper(), "", "a b", "A  b", "a", "a b c", "x y z w", "x y z w v"]
    pick.shuffle(texts)
    return texts


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80), (1, 60)])
def test_components_equal_all_pairs(make_docs, families, n, percent):
    ids = [7 * i % 1009 for i in range(len(families))]
    wanted = by_hand(list(zip(ids, families, strict=True)), n, percent)
    assert len({c for _, _, c in wanted}) < len(wanted) - 20
    assert found(make_docs(*families, ids=ids).repartition(5), n, percent) == wanted


def test_any_order_signature_and_bitmap_give_the_same_links(make_docs, families, monkeypatch):
    wanted = by_hand(list(enumerate(families)), 4, 85)
    monkeypatch.setattr(jaccard, "BUCKETS", 256)
    monkeypatch.setattr(jaccard, "BITS", 1 << 13)
    monkeypatch.setattr(jaccard, "AGREE", 99)  # no groups: all links come from the matrix
    assert found(make_docs(*families), 4, 85) == wanted
    rows = jaccard.similar_documents(make_docs(*families), 4, 85, buckets=1 << 12, bits=1 << 11).collect()
    assert sorted(map(tuple, rows)) == wanted


@pytest.mark.parametrize("percent", [60, 85, 100])
def test_classes_of_sizes_and_places_equal_all_pairs_of_cells(spark, percent):
    pick, rule = random.Random(percent), jaccard.Rule(4, percent)
    cells = {(pick.randrange(3), pick.randrange(40), pick.choice([1, 2, 3, 17, 20, 85, 100, 118])) for _ in range(300)}
    cells = [(*cell, pick.randrange(rule.beginning(cell[2]) + 1)) for cell in cells]
    wanted = {
        (a[0], a[2], a[3], b[2], b[3]) for a in cells for b in cells
        if a[0] == b[0] and a[1] < b[1] and rule.needed(a[2], b[2]) <= min(a[2] - a[3], b[2] - b[3], a[2], b[2])
        and 100 * min(a[2], b[2]) >= percent * max(a[2], b[2])
    }
    df = spark.createDataFrame(cells, "token long, group long, n long, at long")
    rows = [tuple(row) for row in jaccard._classes_that_reach(df, rule).collect()]
    assert wanted <= set(rows) and len(rows) == len(set(rows))
    # No others but for classes whose only groups meet in the other order or are one.
    assert all(rule.needed(n_a, n_b) <= min(n_a - at_a, n_b - at_b) for _, n_a, at_a, n_b, at_b in rows)


def test_a_passage_of_very_many_documents_opens_nothing(make_docs, monkeypatch):
    """One row for each document that has it, and no pair: these documents share too little to link."""
    from tests.llm.conftest import prose

    common = prose(100, 90_000)
    texts = [f"{common} {prose(12, 100_000 + 100 * k)}" for k in range(400)]
    opened = []
    kept = jaccard.store.written
    monkeypatch.setattr(jaccard.store, "written", lambda df, name, **more: opened.append((name, kept(df, name, **more))) or opened[-1][1])
    rows = found(make_docs(*texts), 4, 85)
    assert rows == [(k, 109, k) for k in range(400)]
    by_name = dict(opened)
    assert by_name["classes"].count() > 0 and by_name["cells"].count() >= 400 and by_name["opened"].count() == 0


def test_a_column_that_no_one_else_would_have_stays(make_docs, prose_of):
    docs = make_docs(prose_of(30), prose_of(30)).withColumn("stays", F.lit(1)).withColumn("COPY", F.lit(2))
    kept = jaccard.keep_one_of_each(docs, 4, 85)
    assert kept.dtypes == docs.dtypes and [(row.doc_id, row.stays, row.COPY) for row in kept.collect()] == [(0, 1, 2)]


def test_bitmap_equals_a_set(spark):
    bits = [0, 5, 5, 7, 8, 1023, 2047] + [64] * 500
    df = spark.createDataFrame([(bit,) for bit in bits], "bit long").repartition(4)
    bitmap = jaccard._bitmap(df, 2048)
    assert [k for k, hit in enumerate(jaccard._marked(bitmap, jaccard.np.arange(2048))) if hit] == sorted(set(bits))
    assert not jaccard._bitmap(df.limit(0), 2048).any()


def test_the_threshold_itself_links():
    rule = jaccard.Rule(4, 85)
    for n_a in range(1, 80):
        for n_b in range(1, 80):
            least = next((i for i in range(min(n_a, n_b) + 1) if 100 * i >= 85 * (n_a + n_b - i)), None)
            if least is not None:
                assert rule.needed(n_a, n_b) == least
                if n_a != n_b:
                    assert least >= n_a - rule.beginning(n_a) + 1
            elif n_a == n_b:
                raise AssertionError


def test_odd_rows(odd_docs):
    docs = odd_docs.withColumn("N_SHINGLES", F.lit("x")).withColumn("component", F.lit(1)).withColumn("a.b", F.lit(1))
    rows = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar_documents(docs, 4, 85).collect()}
    assert {(0, 0, 0), (1, 0, 1), (2, 0, 2), (3, 1, 3), (4, 37, 4), (5, 29_997, 5), (None, 1, None), (7, 1, 7)} == rows
    kept = jaccard.keep_one_of_each(docs, 4, 85)
    assert kept.dtypes == docs.dtypes
    assert sorted(str(row.doc_id) for row in kept.collect()) == ["0", "1", "2", "3", "4", "5", "7", "None"]


def test_a_row_without_an_id_has_the_component_of_its_copy(make_docs, prose_of):
    docs = make_docs(prose_of(30), prose_of(30), prose_of(30, 500), ids=[5, None, None])
    rows = jaccard.similar_documents(docs, 4, 85).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in rows) == [("5", "5"), ("None", "5"), ("None", "None")]


def test_rows_of_one_id_are_one_document(make_docs, prose_of):
    a, b = prose_of(30), prose_of(30, 500)
    rows = jaccard.similar_documents(make_docs(a, b, a, b, ids=[3, 3, 8, 9]), 4, 85).collect()
    assert {(r.doc_id, r.component_id) for r in rows} == {(3, 3), (8, 3), (9, 3)}
    assert jaccard.keep_one_of_each(make_docs(a, b, a, b, ids=[3, 3, 8, 9]), 4, 85).count() == 1


def test_empty_table(make_docs):
    assert jaccard.similar_documents(make_docs()).count() == 0
    assert jaccard.keep_one_of_each(make_docs()).count() == 0
    assert found(make_docs("", None), 4, 85) == [(0, 0, 0), (1, 0, 1)]


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(500, i) for i in range(501, 540)] + [(7, 7), (3, 2), (2, 3), (1, 3)]
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    wanted = {i: 100 for i in range(100, 141)} | {i: 500 for i in range(500, 540)} | {1: 1, 2: 1, 3: 1}
    assert len(rows) == len(wanted) and {row.node: row.component for row in rows} == wanted
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
