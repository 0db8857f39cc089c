from __future__ import annotations

import re

from pyspark.sql import functions as F

from footfall.llm import quality


def by_hand(text):
    text = text or ""
    spans = [(m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    words = [text[a:b] for a, b in spans]
    found = {"n_words": len(words), "word_chars": sum(map(len, words)),
             "n_symbols": sum(text.count(c) for c in "#*$%&|<>")}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    chars = lambda line: len(re.sub(r"[\x20\x09-\x0D]", "", line))
    found["n_dup_lines"] = len(lines) - len(set(lines))
    found["line_chars"] = sum(chars(line) for line in lines if lines.count(line) > 1)
    for n in {*quality.GRAM_LIMITS, quality.REPEAT_WORDS}:
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        under = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(n)}
        found[f"gram{n}_chars"] = sum(len(words[i]) for i in under)
        if n == quality.REPEAT_WORDS:
            found["n_repeat_words"] = len(under)
    failed = found["n_words"] < 20 or 100 * found["n_repeat_words"] > 30 * found["n_words"]
    bad = 100 * found["line_chars"] > quality.LINE_LIMIT * found["word_chars"] or any(
        100 * found[f"gram{n}_chars"] > limit * found["word_chars"] for n, limit in quality.GRAM_LIMITS.items()
    )
    return found | {"base_failed": failed, "kept": not failed and not bad}


def test_figures_equal_a_plain_count(make_docs, prose_of):
    texts = [
        prose_of(60), prose_of(30) + "\n" + prose_of(30), "a b\na b\n\n \nc", "Ment " * 30 + prose_of(10),
        "é中 x# $%\x0b\x0c<b> | x", prose_of(19), prose_of(20), "x\u00a0y z", "\n\n", None, "",
        (prose_of(12) + " ") * 3 + prose_of(80, 500),
    ]
    found = quality.with_quality(make_docs(*texts)).orderBy("doc_id").collect()
    for row, text in zip(found, texts, strict=True):
        wanted = by_hand(text)
        assert {name: row[name] for name in quality.FIELDS.names} == {name: wanted[name] for name in quality.FIELDS.names}


def test_repeated_words_and_lines_are_rejected(make_docs, prose_of):
    kept = quality.keep_good(make_docs(
        prose_of(50), "Ment " * 60, (prose_of(8) + "\n") * 9, None, "", prose_of(5)
    ))
    assert [row.doc_id for row in kept.collect()] == [0]


def test_odd_rows(odd_docs):
    rows = quality.with_quality(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    empty = [row for row in rows if row.doc_id in (0, 1, 2)]
    assert all(row.n_words == 0 and row.base_failed and not row.kept for row in empty)
    assert sorted(row.doc_id for row in quality.keep_good(odd_docs).collect()) == [4, 4, 5]


def test_clashing_columns_give_way_and_the_filter_keeps_them(make_docs, prose_of):
    docs = make_docs(prose_of(50)).withColumn("KEPT", F.lit("x")).withColumn("a.b", F.lit(1)).withColumn("n_words", F.lit(0))
    row = quality.with_quality(docs).first()
    assert row["kept"] is True and row["a.b"] == 1 and row["n_words"] == 50
    assert quality.keep_good(docs).dtypes == docs.dtypes
    assert quality.keep_good(docs).first()["KEPT"] == "x"


def test_empty_table(make_docs):
    assert quality.with_quality(make_docs()).count() == 0
    assert quality.keep_good(make_docs()).count() == 0
