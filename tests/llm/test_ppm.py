from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from footfall.llm import arrow, ppm

SYLLABLES = {"aa": "ka mo ti ra lu", "bb": "sch pf ung ein ö", "cc": "eau que é ion le"}


def speak(lang: str, n: int, seed: int) -> str:
    pick, parts = random.Random(f"{lang}{seed}"), SYLLABLES[lang].split()
    return " ".join("".join(pick.choice(parts) for _ in range(pick.randint(1, 4))) for _ in range(n))


def counted(learned: list[str]) -> list[dict]:
    """How often each byte followed each context, by order."""
    seen = [defaultdict(Counter) for _ in range(ppm.ORDER + 1)]
    for body in learned:
        raw = body.encode()
        for i, byte in enumerate(raw):
            for k in range(min(i, ppm.ORDER) + 1):
                seen[k][raw[i - k : i]][byte] += 1
    return seen


def walked(seen: list[dict], text: str) -> float:
    """Bits of a text by the definition, byte for byte."""
    bits, raw = 0.0, text.encode()
    for i, byte in enumerate(raw):
        for k in range(min(i, ppm.ORDER), -1, -1):
            followers = seen[k].get(raw[i - k : i])
            if not followers:
                continue
            room = sum(followers.values()) + len(followers)
            if followers[byte]:
                bits += math.log2(room / followers[byte])
                break
            bits += math.log2(room / len(followers))
        else:
            bits += 8
    return bits


def by_hand(learned: list[str], text: str) -> float:
    return walked(counted(learned), text)


def trees(texts):
    body = arrow.texts_of(pa.array(texts))
    (_, _, data, offsets), = arrow.blocks(body, 1 << 30)
    return ppm.learn(data, offsets)


def test_code_lengths_are_exact():
    learned = {lang: [speak(lang, 30, s) for s in range(3)] + ["", "x"] for lang in SYLLABLES}
    scorer = ppm.Scorer({lang: trees(texts) for lang, texts in learned.items()})
    texts = [speak("aa", 10, 9), speak("cc", 4, 8), "", "é", "\x00\x01 zzz", "ka", "k"]
    for _ in range(2):
        found = scorer.lengths(arrow.texts_of(pa.array(texts)))
        wanted = [[by_hand(learned[lang], text) for lang in scorer.languages] for text in texts]
        assert np.allclose(found, wanted, rtol=1e-5)


def test_memory_that_starts_anew_gives_the_same(monkeypatch):
    model = {lang: trees([speak(lang, 50, 1)]) for lang in SYLLABLES}
    texts = arrow.texts_of(pa.array([speak(lang, 20, s) for s in range(8) for lang in SYLLABLES]))
    whole = ppm.Scorer(model).lengths(texts)
    monkeypatch.setattr(ppm, "REMEMBERED", 10)
    monkeypatch.setattr(ppm, "BLOCK_BYTES", 300)
    assert np.allclose(ppm.Scorer(model).lengths(texts), whole)


@pytest.fixture
def spoken(spark):
    rows = [(i, speak(lang, 40, i), lang) for i in range(120) for lang in [sorted(SYLLABLES)[i % 3]]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_documents_are_named_right_and_not_learned_from(spoken):
    rows = spoken.withColumn("held", ppm.held_out(F.col("doc_id"))).collect()
    assert all(row.held == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1) for row in rows)
    wrong = spoken.withColumn("lang", F.when(ppm.held_out(F.col("doc_id")), "zz").otherwise(F.col("lang")))
    model = ppm.fit(wrong)
    assert sorted(model) == sorted(SYLLABLES)
    found = ppm.predict(spoken, model).collect()
    assert sum(row.lang_pred == row.lang for row in found) == len(found)
    assert all(0 <= row.score <= 1 for row in found)


def test_odd_rows(spoken, odd_docs):
    model = ppm.fit(spoken)
    docs = odd_docs.withColumn("Score", F.lit("x")).withColumn("a.b", F.lit(1))
    rows = ppm.predict(docs, model).collect()
    assert len(rows) == odd_docs.count()
    for row in rows:
        assert (row.lang_pred == "und" and row.score == 0) == (row.text is None or row.doc_id in (1, 2, 7))
    assert odd_docs.where("doc_id IS NULL").select(ppm.held_out(F.col("doc_id"))).first()[0] is True


def test_nothing_learned(spoken, make_docs):
    assert ppm.fit(make_docs()) == {}
    unlabelled = spoken.withColumn("lang", F.lit(None).cast("string"))
    rows = ppm.predict(spoken, ppm.fit(unlabelled)).collect()
    assert {(row.lang_pred, row.score) for row in rows} == {("und", 0.0)}
    assert ppm.predict(spoken.limit(0), ppm.fit(spoken)).count() == 0
