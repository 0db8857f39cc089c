from __future__ import annotations

from public_tokenizers import PATTERN
from pyspark.sql import functions as F

from footfall.llm import bpe


def test_rows_keep_their_columns_and_decode_to_their_text(odd_docs, vocabulary):
    path = vocabulary("byte_bpe_50k.tiktoken")
    docs = odd_docs.withColumn("IDS", F.lit("x")).withColumn("a.b", F.lit(1))
    coded = bpe.encode(docs, path, PATTERN)
    assert "IDS" not in coded.columns and "a.b" in coded.columns
    rows = bpe.decode(coded, path).collect()
    assert len(rows) == odd_docs.count()
    for row in rows:
        assert bytes(row.decoded) == (row.text or "").encode()
        assert (len(row.ids) == 0) == (not row.text)
    both = bpe.round_trip(docs, path, PATTERN)
    key = lambda row: (row.doc_id is None, row.doc_id)
    assert sorted([(r.doc_id is None, r.doc_id, r.ids, bytes(r.decoded)) for r in both.collect()]) == sorted(
        [(*key(r), r.ids, bytes(r.decoded)) for r in rows]
    )


def test_empty_table_and_null_ids(make_docs, spark, vocabulary):
    path = vocabulary("byte_bpe_50k.tiktoken")
    assert bpe.round_trip(make_docs(), path, PATTERN).count() == 0
    none = spark.createDataFrame([(None,)], "ids array<int>")
    assert bytes(bpe.decode(none, path).first().decoded) == b""
