from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])

WORDS = [f"{a}{b}" for a in "the of and erst thin shed ou ingre".split() for b in "ly ed an ho mu ti".split()]


def prose(n: int, start: int = 0) -> str:
    """A text of n words that repeats no longer run of words."""
    out = []
    for i in range(start, start + n):
        out.append(f"{WORDS[i * 7 % len(WORDS)]}{i}")
    return " ".join(out)


@pytest.fixture(scope="session")
def prose_of():
    return prose


@pytest.fixture
def make_docs(spark):
    def make(*texts, ids=None, lang="en"):
        """Documents numbered from 0, or by ``ids``."""
        ids = list(range(len(texts))) if ids is None else ids
        return spark.createDataFrame(
            [(i, t, lang, "src", None if t is None else len(t)) for i, t in zip(ids, texts, strict=True)], DOCUMENTS
        )

    return make


@pytest.fixture
def odd_docs(make_docs):
    """Nulls, empty and very long texts, repeated rows."""
    long = prose(30_000)
    return make_docs(
        None, "", " \n\t ", "one", prose(40), prose(40), long, "é中\u00a0x\u2003y  z\r\n\x1f.", "?!",
        ids=[0, 1, 2, 3, 4, 4, 5, None, 7],
    )


@pytest.fixture(scope="session")
def vocabulary():
    return public_tokenizers.path
