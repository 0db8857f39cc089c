from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from footfall.llm import bitplanes

VALUES = [
    [], [0], [1, 2, 3], [2**32 - 1, 0, 5], list(range(50_000)), [7] * 1000, [65_536] * 9 + [255], list(range(17)),
]


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("block", [1, 8, 13, 4096])
@pytest.mark.parametrize("ids", VALUES, ids=len)
def test_chunks_round_trip(ids, block, bits):
    ids = np.array(ids[: 40 * block], "<u4")
    sizes, payload = bitplanes.pack_ids(ids, block, bits)
    assert len(sizes) == -(-len(ids) // block) * (32 if bits else 4) and sum(sizes) == len(payload)
    assert bitplanes.unpack_ids(sizes, payload, len(ids), block, bits).tolist() == ids.tolist()


def test_planes_hold_one_byte_or_bit_of_every_id():
    ids = np.array([0x0102, 0x0304, 0x8001], "<u4")
    assert bitplanes.planes_of(ids, False)[:2] == [bytes([2, 4, 1]), bytes([1, 3, 0x80])]
    bits = bitplanes.planes_of(ids, True)
    assert bits[0] == bytes([0b100]) and bits[15] == bytes([0b100]) and bits[1] == bytes([0b001])


@pytest.mark.parametrize("bits", [False, True])
def test_documents_come_back_in_order(odd_docs, vocabulary, bits):
    path = vocabulary("byte_bpe_50k.json")
    chunks = bitplanes.write_chunks(bitplanes.encode_chunks(odd_docs, path, block=100, chunk=500, bits=bits))
    rows = bitplanes.decode_chunks(chunks).orderBy("start").collect()
    assert [row.doc_id for row in rows] == [None, 0, 1, 2, 3, 4, 4, 5, 7]
    tokenizer = Tokenizer.from_file(path)
    texts = {row.doc_id: row.text or "" for row in odd_docs.collect()}
    before = 0
    for row in rows:
        ids = np.frombuffer(row.ids, "<u4").tolist()
        assert ids == [*tokenizer.encode(texts[row.doc_id], add_special_tokens=False).ids, 0]
        assert row.start == before
        before += len(ids)
    index = chunks.select("shard", "chunk", "first", "n_ids", "sizes").orderBy("shard", "chunk").collect()
    assert sum(row.n_ids for row in index) == before


def test_extra_columns_and_empty_tables(odd_docs, vocabulary):
    path = vocabulary("byte_bpe_50k.json")
    more = odd_docs.withColumn("shard", F.lit("x")).withColumn("ids", F.lit(1)).withColumn("a.b", F.lit(1))
    chunks = bitplanes.encode_chunks(more, path)
    assert bitplanes.decode_chunks(chunks).count() == odd_docs.count()
    none = bitplanes.write_chunks(bitplanes.encode_chunks(odd_docs.limit(0), path))
    assert bitplanes.decode_chunks(none).count() == 0
