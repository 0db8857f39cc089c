from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from footfall.llm import packing


def best_fit_by_hand(lengths, capacity):
    fills, out = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        able = [fill for fill in fills if fill + lengths[i] <= capacity]
        if able:
            at = fills.index(max(able))
        else:
            at = len(fills)
            fills.append(0)
        out[i] = (fills[at], lengths[i])
        fills[at] += lengths[i]
    return fills


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_best_fit_equals_its_definition(lengths):
    number, place = packing.best_fit(np.array(lengths, np.int64), 20)
    fills = np.bincount(number, lengths, minlength=0).astype(int).tolist() if lengths else []
    assert sorted(fills) == sorted(best_fit_by_hand(lengths, 20))
    for b in set(number.tolist()):
        at = np.flatnonzero(number == b)
        at = at[np.argsort(place[at])]
        assert place[at].tolist() == [0, *np.cumsum(np.array(lengths)[at])[:-1].tolist()]


def valid(rows, capacity):
    by = {}
    for row in rows:
        by.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for placed in by.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("group", [1 << 18, 7])
def test_items_of_many_partitions_fill_few_sequences(spark, group):
    lengths = [(i * 37) % 90 + 1 for i in range(400)]
    items = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "id long, length long").repartition(13)
    rows = packing.pack(items, 100, 2, group=group).collect()
    assert sorted((row.id, row.length) for row in rows) == sorted(enumerate(lengths))
    n = valid(rows, 100)
    assert n <= len(best_fit_by_hand(lengths, 100)) * (1.1 if group > 7 else 1.3)


def test_equal_rows_are_placed_apart_and_columns_clash(spark):
    items = spark.createDataFrame([(7, 3)] * 10, "id long, length long")
    items = items.withColumn("Offset", F.lit("x")).withColumn("bin", F.lit(1)).withColumn("a.b", F.lit(2))
    found = packing.pack(items, 10, slack=0)
    assert found.columns == ["id", "length", "a.b", "sequence_id", "offset"]
    rows = found.collect()
    assert len(rows) == 10 and valid(rows, 10) == 4
    assert packing.pack(items.limit(0), 10).count() == 0
    one = packing.pack(items.limit(1), 10).collect()
    assert [(row.offset, row.length) for row in one] == [(0, 3)]


def test_pieces_are_the_whole_texts(odd_docs, vocabulary):
    path = vocabulary("word_bpe_49k.json")
    docs = odd_docs.withColumn("piece", F.lit("x")).withColumn("length", F.lit(-1))
    rows = packing.token_pieces(docs, path, 50).collect()
    tokenizer = Tokenizer.from_file(path)
    wanted = []
    for row in odd_docs.collect():
        ids = [*tokenizer.encode(row.text or "", add_special_tokens=False).ids, 0]
        wanted += [(row.doc_id, k, at, ids[at : at + 50]) for k, at in enumerate(range(0, len(ids), 50))]
    key = lambda row: (row[0] is None, *row)
    found = [(row.doc_id, row.piece, row.start, np.frombuffer(row.ids, "<u4").tolist()) for row in rows]
    assert sorted(map(key, found), key=str) == sorted(map(key, wanted), key=str)
    assert all(row.length == len(row.ids) // 4 for row in rows)
    assert packing.token_pieces(docs.limit(0), path).count() == 0


def test_windows_by_bytes_keep_all_items(spark, monkeypatch):
    items = spark.range(50).select("id", F.lit(30).cast("long").alias("length"), F.repeat(F.lit("x"), 100).alias("body"))
    monkeypatch.setattr(packing, "WINDOW_BYTES", 1)
    rows = packing.pack(items.repartition(4), 100).collect()
    assert sorted(row.id for row in rows) == list(range(50)) and all(len(row.body) == 100 for row in rows)
    assert valid(rows, 100) <= 25
