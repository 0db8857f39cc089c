"""Ids by stretches equal one call of the tokenizer for each text."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from public_tokenizers import PATTERN

from footfall.llm import arrow, bpe, units

SIGNS = " \n\t'sab é9!?. ́ßİΣ中文😀\x1f<|endoftext|>   \r\x0b\u0085"
PLAIN = "ab Cd.é,'9\n -"


@pytest.fixture(scope="module")
def texts():
    pick = random.Random(3)
    odd = ["".join(pick.choice(SIGNS) for _ in range(pick.randint(0, 40))) for _ in range(4000)]
    plain = ["".join(pick.choice(PLAIN) for _ in range(pick.randint(0, 30))) for _ in range(4000)]
    marked = ["<|endoftext|> a <|startoftext|>", "a<|endoftext|>", "b <|endoftext|>c. <|endoftext|", "<|endoftext|>", "|>", "<|ENDOFTEXT|>"]
    return [*odd, *plain, "", " ", "  a", "a  ", *marked, "<|endoftext", "|>", "́ ́a", "a" * 5000]


@pytest.mark.parametrize(("name", "keeps"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_stretches_equal_whole_texts(texts, vocabulary, name, keeps):
    encode = units.encoder(vocabulary(name), keeps)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary(name))
    for _ in range(2):  # the second time from memory
        found = encode(arrow.texts_of(pa.array(texts)))
        assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == [
            tokenizer.encode(text, add_special_tokens=False).ids for text in texts
        ]


def test_two_tiers_equal_the_rank_library(texts, vocabulary):
    coder = bpe.TwoTier(bpe.read_ranks(vocabulary("byte_bpe_50k.tiktoken")), PATTERN)
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    wanted = [library.encode_ordinary(text) for text in texts]
    assert [coder.pieces(text) for text in texts] == wanted
    found = coder.texts(arrow.texts_of(pa.array(texts)))
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == wanted
    assert [coder.decode(ids) for ids in wanted] == [text.encode() for text in texts]


def test_memory_that_starts_anew_gives_the_same(texts, vocabulary, monkeypatch):
    monkeypatch.setattr(units, "REMEMBERED", 50)
    monkeypatch.setattr(units, "CORES", 10)
    monkeypatch.setattr(units, "BLOCK_BYTES", 2000)
    coder = bpe.TwoTier(bpe.read_ranks(vocabulary("byte_bpe_50k.tiktoken")), PATTERN)
    found = coder.texts(arrow.texts_of(pa.array(texts)))
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == [coder.pieces(text) for text in texts]


def test_equal_hashes_of_different_stretches_are_seen(vocabulary, monkeypatch):
    def same(sums, starts, ends, which=0):
        return np.zeros(len(starts), np.uint64) if which == 0 else hashes(sums, starts, ends, 1)

    hashes = units.rolling.span_hashes
    monkeypatch.setattr(units.rolling, "span_hashes", same)
    coder = bpe.TwoTier(bpe.read_ranks(vocabulary("byte_bpe_50k.tiktoken")), PATTERN)
    texts = ["a b c", "d", "", "b b"]
    for _ in range(2):
        found = coder.texts(arrow.texts_of(pa.array(texts)))
        assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == [coder.pieces(text) for text in texts]


def test_perfect_hash_is_minimal_and_knows_its_keys():
    for n in (0, 1, 2, 50, 3000):
        keys = [f"key{i}".encode() for i in range(n)]
        table = bpe.PerfectHash(keys)
        assert len(table.values) == max(1, n)
        assert [table.find(key) for key in keys] == list(range(n))
        assert table.find(b"other") == -1 and table.find(b"") == -1
