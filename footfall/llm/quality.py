"""Quality rules: how much of a text lies in repeated n-grams and lines.

Rolling hashes of several n-gram lengths mark the windows of words that appear
more than once in a text; the characters of the words under such windows are its
repetition coverage, one figure for each length. Lines that appear more than once
are measured the same way. Texts above a share of repeated characters are
rejected.

Words are ``[^\\x20\\x09-\\x0D]+``. A null or empty text has no words: all counts
are 0 and the base rule fails it. Every text is measured whole, in one task, in
memory proportional to that text. Repeated rows are measured each for itself.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from footfall.llm import arrow, rolling

# Most per cent of a text's word characters under repeated windows of so many words.
GRAM_LIMITS = {3: 50, 5: 40, 8: 35, 10: 35}
# Most per cent of a text's word characters in lines that appear more than once.
LINE_LIMIT = 40
MIN_WORDS = 20
REPEAT_WORDS = 8
REPEAT_LIMIT = 30

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

FIELDS = T.StructType(
    [T.StructField(name, T.LongType()) for name in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        *(f"gram{n}_chars" for n in GRAM_LIMITS), "line_chars")]
    + [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())]
)


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, text number) of the lines; each text has at least one."""
    breaks = np.flatnonzero(data == 10)
    starts = np.concatenate([offsets[:-1], breaks + 1])
    doc = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, side="right") - 1])
    order = np.argsort(doc * (len(data) + 2) + starts, kind="stable")
    starts, doc = starts[order], doc[order]
    ends = offsets[doc + 1].copy()
    same = doc[1:] == doc[:-1]
    ends[:-1][same] = starts[1:][same] - 1
    return starts, ends, doc


def measure_block(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The figures of every text of a block."""
    n_texts = len(offsets) - 1
    starts, ends, doc = rolling.word_spans(data, offsets)
    sums = rolling.byte_sums(data)
    char = (data & 0xC0) != 0x80
    chars_before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(char & ~rolling.SPACE[data], out=chars_before[1:])
    word_chars = chars_before[ends] - chars_before[starts]
    out = {
        "n_words": np.bincount(doc, minlength=n_texts),
        "word_chars": chars_before[offsets[1:]] - chars_before[offsets[:-1]],
        "n_symbols": rolling.sums_of(_SYMBOL[data], offsets),
    }

    line_starts, line_ends, line_doc = _lines(data, offsets)
    line_chars = chars_before[line_ends] - chars_before[line_starts]
    full = line_chars > 0
    line_starts, line_ends, line_doc, line_chars = (x[full] for x in (line_starts, line_ends, line_doc, line_chars))
    keys = rolling.per_text(line_doc, rolling.span_hashes(sums, line_starts, line_ends))
    out["n_dup_lines"] = np.bincount(line_doc[rolling.repeated(keys, "first")], minlength=n_texts)
    again = rolling.repeated(keys)
    out["line_chars"] = np.bincount(line_doc[again], line_chars[again], n_texts).astype(np.int64)

    grams = rolling.gram_sums(rolling.span_hashes(sums, starts, ends))
    for n in sorted({*GRAM_LIMITS, REPEAT_WORDS}):
        at, hashes = rolling.gram_hashes(grams, doc, n)
        at = at[rolling.repeated(rolling.per_text(doc[at], hashes))]
        under = rolling.covered(at, n, len(doc))
        if n in GRAM_LIMITS:
            out[f"gram{n}_chars"] = np.bincount(doc[under], word_chars[under], n_texts).astype(np.int64)
        if n == REPEAT_WORDS:
            out["n_repeat_words"] = np.bincount(doc[under], minlength=n_texts)
    return out


def judge(found: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Add the base rule and the verdict to the figures."""
    failed = (found["n_words"] < MIN_WORDS) | (100 * found["n_repeat_words"] > REPEAT_LIMIT * found["n_words"])
    repetitive = 100 * found["line_chars"] > LINE_LIMIT * found["word_chars"]
    for n, limit in GRAM_LIMITS.items():
        repetitive |= 100 * found[f"gram{n}_chars"] > limit * found["word_chars"]
    return found | {"base_failed": failed, "kept": ~failed & ~repetitive}


def _measure(texts) -> dict[str, np.ndarray]:
    parts = [
        measure_block(data, offsets)
        for _, _, data, offsets in arrow.blocks(arrow.texts_of(texts))
    ]
    names = [name for name in FIELDS.names if name not in ("base_failed", "kept")]
    none = np.empty(0, np.int64)
    return judge({name: np.concatenate([p[name] for p in parts]) if parts else none for name in names})


def with_quality(df: DataFrame, text: str = "text") -> DataFrame:
    """Append the repetition figures, the base rule and the verdict of every text.

    Columns of ``df`` named like a new one give way to it.
    """

    def make():
        return lambda texts: [found[name] for found in [_measure(texts)] for name in FIELDS.names]

    return arrow.add_columns(df, [text], FIELDS, make)


def keep_good(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text passes, with the columns of ``df`` unchanged."""
    return arrow.add_columns(df, [text], T.StructType(), lambda: lambda texts: _measure(texts)["kept"], keep=True)
