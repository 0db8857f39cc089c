from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from footfall.llm import periodic
from footfall.llm.queries import op12_periodic_runs


def by_hand(words):
    """Runs by trying every period; a stretch of a smaller period is that one's run."""
    found, n = [], len(words)
    for q in range(1, n // periodic.LEAST_TIMES + 1):
        i = 0
        while i < n - q:
            first = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            length = i - first + q
            inside = any(p < q and s <= first and s + m >= first + length for s, m, p in found)
            if i > first and length >= max(periodic.LEAST_WORDS, periodic.LEAST_TIMES * q) and not inside:
                found.append((first, length, q))
            i += 1
    return sorted(found, key=lambda run: (run[0], run[2]))


def without_runs(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(word for i, word in enumerate(words) if i not in gone)


def test_runs_equal_every_period_tried():
    pick = random.Random(7)
    for _ in range(3000):
        words, kinds = [], pick.choice([1, 2, 3, 5, 40])
        for _ in range(pick.randint(0, 12)):
            block = [str(pick.randrange(kinds)) for _ in range(pick.randint(1, 6))]
            words += block * pick.choice([1, 1, 2, 4, 5, 7])
        words = [word.encode() for word in words]
        assert list(map(tuple, periodic.find_runs(words).tolist())) == by_hand(words)


def test_extensions_equal_plain_comparison():
    pick = random.Random(3)
    symbols = [pick.randrange(2) for _ in range(60)]
    known = periodic.Extensions(symbols)
    for a in range(60):
        for b in range(a + 1, 60):
            agree = 0
            while b + agree < 60 and symbols[a + agree] == symbols[b + agree]:
                agree += 1
            assert known.agree([a], [b])[0] == agree
    ordered = sorted(range(60), key=lambda i: symbols[i:])
    assert [int(i) for i in sorted(range(60), key=lambda i: known.rank[i])] == ordered


def test_defined_results(odd_docs):
    found = periodic.with_runs(odd_docs.withColumn("RUNS", F.lit(1)).withColumn("a.b", F.lit(2)))
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "a.b", "runs", "collapsed"]
    rows = found.collect()
    assert len(rows) == odd_docs.count()
    assert all(row.runs == [] and row.collapsed == " ".join((row.text or "").encode().split() and
               [w.decode() for w in (row.text or "").encode().split()]) for row in rows)
    assert periodic.with_runs(odd_docs.limit(0)).collect() == []


def test_very_long_texts_and_repeated_rows(make_docs):
    docs = make_docs("x " * 50_000, "a b c " * 30_000, "y", "y", ids=[1, 2, 3, 3])
    found = sorted((row.doc_id, [tuple(r) for r in row.runs], row.collapsed) for row in periodic.with_runs(docs).collect())
    assert found == [(1, [(0, 50_000, 1)], "x"), (2, [(0, 90_000, 3)], "a b c"), (3, [], "y"), (3, [], "y")]


def test_query_equals_plain_python(spark, tmp_path, make_docs):
    pick = random.Random(11)
    texts = [" ".join(pick.choice("abcdefgh") for _ in range(pick.randint(0, 80))) for _ in range(300)]
    texts += [None, "", "  ", "q q q q q q", "é é é é é é é é"]
    make_docs(*texts).write.parquet(str(tmp_path / "documents.parquet"))
    wanted = set()
    for doc_id, text in enumerate(texts):
        words, h = [w.decode() for w in (text or "").encode().split()], zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        runs = by_hand(words)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        told = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        wanted.add((
            doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(told.encode()).hexdigest(),
            hashlib.sha256(without_runs(words, runs).encode()).hexdigest(),
        ))
    rows = op12_periodic_runs(spark, str(tmp_path)).collect()
    assert len(rows) == len(texts) and {tuple(row) for row in rows} == wanted
    assert sum(row.n_runs > 0 for row in rows) > 10


@pytest.mark.parametrize("text", ["a " * 5, "a b " * 3, "a b c " * 3 + "a b"])
def test_shorter_stretches_are_no_runs(text):
    assert len(periodic.find_runs(text.encode().split())) == 0
