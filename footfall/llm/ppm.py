"""Language identification by prediction by partial matching over bytes.

Each language has byte context trees of orders 0 to ``ORDER``: how often each byte
followed each context. A byte is coded in its longest known context; an unseen byte
pays that context's escape (distinct followers over total plus distinct) and is
tried in the next shorter one, at last at one in 256. The statistics are frozen, so a
byte's code length depends on itself and at most ``ORDER`` bytes before it. A text's
code length is the exact sum over its bytes; the shortest one names its language.

Code lengths are worked out once for each distinct run of ``ORDER`` + 1 bytes and
summed by run, so the work per byte is one hash lookup.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm import arrow, samples

ORDER = 4
# Bound of each language's learning sample: texts, and characters of all its texts but the last.
SAMPLE_TEXTS = 400
SAMPLE_CHARS = 1_500_000
# Distinct runs whose code lengths a worker remembers before it starts anew.
REMEMBERED = 1 << 21
BLOCK_BYTES = 1 << 21
UNKNOWN = "und"


def runs(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each byte: itself lowest, the bytes before it in its text above, their number on top."""
    codes = data.astype(np.uint64)
    for k in range(1, min(ORDER + 1, len(data))):
        codes[k:] |= data[: len(data) - k].astype(np.uint64) << np.uint64(8 * k)
    depth = np.full(len(data), ORDER, np.uint64)
    for k in range(ORDER):  # the first bytes of a text have fewer before them
        at = offsets[:-1] + k
        at = at[at < offsets[1:]]
        depth[at] = k
        codes[at] &= np.uint64((1 << 8 * (k + 1)) - 1)
    return codes | depth << np.uint64(8 * (ORDER + 1))


def learn(data: np.ndarray, offsets: np.ndarray) -> list[dict[str, np.ndarray]]:
    """The context trees of one language, as sorted tables by order."""
    codes = runs(data, offsets)
    depth = codes >> np.uint64(8 * (ORDER + 1))
    tables = []
    for k in range(ORDER + 1):
        whole = codes[depth >= k] & np.uint64((1 << 8 * (k + 1)) - 1)
        grams, counts = np.unique(whole, return_counts=True)
        contexts, first = np.unique(grams >> np.uint64(8), return_index=True)
        totals = np.add.reduceat(counts, first) if len(first) else counts
        distinct = np.diff(np.append(first, len(grams)))
        room = np.log2(totals + distinct)
        parent = np.searchsorted(contexts, grams >> np.uint64(8))
        tables.append({
            "grams": grams, "bits": (room[parent] - np.log2(counts)).astype(np.float32),
            "contexts": contexts, "escape": (room - np.log2(distinct)).astype(np.float32),
        })
    return tables


def code_lengths(tables: list[dict[str, np.ndarray]], codes: np.ndarray) -> np.ndarray:
    """Bits to code the lowest byte of each run after the bytes above it."""
    depth = codes >> np.uint64(8 * (ORDER + 1))
    bits = np.zeros(len(codes))
    left = np.arange(len(codes))
    for k in range(ORDER, -1, -1):
        table = tables[k]
        if not len(table["grams"]):
            continue
        able = left[depth[left] >= k]
        gram = codes[able] & np.uint64((1 << 8 * (k + 1)) - 1)
        at = np.minimum(np.searchsorted(table["grams"], gram), len(table["grams"]) - 1)
        seen = table["grams"][at] == gram
        bits[able[seen]] += table["bits"][at[seen]]
        able, gram = able[~seen], gram[~seen]
        context = gram >> np.uint64(8)
        at = np.minimum(np.searchsorted(table["contexts"], context), len(table["contexts"]) - 1)
        known = table["contexts"][at] == context
        bits[able[known]] += table["escape"][at[known]]
        left = np.concatenate([left[depth[left] < k], able])
    bits[left] += 8.0
    return bits


class Scorer:
    """Code lengths of texts in every language, remembered by run."""

    def __init__(self, model: dict[str, list]):
        self.languages = sorted(model)
        self.trees = [model[name] for name in self.languages]
        self.forget()

    def forget(self) -> None:
        self.codes = np.empty(0, np.uint64)
        self.bits = np.empty((0, len(self.trees)))

    def _bits(self, codes: np.ndarray) -> np.ndarray:
        order = np.argsort(codes)
        codes = codes[order]
        at = np.searchsorted(self.codes, codes)
        known = np.zeros(len(codes), bool)
        inside = at < len(self.codes)
        known[inside] = self.codes[at[inside]] == codes[inside]
        fresh = codes[~known]
        found = np.empty((len(codes), len(self.trees)))
        found[known] = self.bits[at[known]]
        if len(fresh):
            found[~known] = np.stack([code_lengths(tree, fresh) for tree in self.trees], axis=1)
            if len(self.codes) > REMEMBERED:
                self.forget()
                at = np.zeros(len(codes), np.int64)
            self.codes = np.insert(self.codes, at[~known], fresh)
            self.bits = np.insert(self.bits, at[~known], found[~known], axis=0)
        back = np.empty_like(found)
        back[order] = found
        return back

    def lengths(self, texts: pa.Array) -> np.ndarray:
        """Bits of every text (rows) in every language (columns)."""
        out = np.zeros((len(texts), len(self.trees)))
        for first, last, data, offsets in arrow.blocks(texts, BLOCK_BYTES):
            if not len(data):
                continue
            place, codes = pd.factorize(runs(data, offsets))
            bits = self._bits(np.asarray(codes, np.uint64))
            full = np.flatnonzero(offsets[1:] > offsets[:-1])
            for k in range(len(self.trees)):
                out[first + full, k] = np.add.reduceat(bits[place, k], offsets[full])
        return out


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning; one without an id is."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(True))


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
        per_language: int = SAMPLE_TEXTS, max_chars: int = SAMPLE_CHARS) -> dict[str, list]:
    """Context trees by language, from a bounded sample of the documents not held out.

    The sample takes whole texts of each language in the order of their id's hash, so it
    does not depend on the table's layout, until there are ``per_language`` of them or
    they hold ``max_chars`` characters, and one at least. Rows that share an id are taken
    together. A table without labelled texts gives no languages.
    """
    named = docs.select(
        arrow.column(doc_id).alias("id"), arrow.column(lang).cast("string").alias("lang"),
        arrow.column(text).alias("text"),
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("id")))
    sizes = named.select("id", "lang", F.length("text").cast("long").alias("size"))
    ids = samples.bounded(sizes, "lang", per_language, max_chars)
    sample = named.join(F.broadcast(ids), "id", "left_semi")

    def trees(group: pd.DataFrame) -> pd.DataFrame:
        body = arrow.texts_of(pa.array(group["text"]))
        _, offsets, data = body.buffers()
        offsets = np.frombuffer(offsets, np.int64)[: len(body) + 1]
        tables = learn(np.frombuffer(data, np.uint8)[: offsets[-1]] if data else np.empty(0, np.uint8), offsets)
        return pd.DataFrame({"lang": [group["lang"].iloc[0]], "trees": [pickle.dumps(tables)]})

    found = sample.select("lang", "text").groupBy("lang").applyInPandas(trees, "lang string, trees binary")
    return {row["lang"]: pickle.loads(row["trees"]) for row in found.collect()}  # a row per language


FIELDS = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def predict(df: DataFrame, model: dict[str, list], text: str = "text") -> DataFrame:
    """Append ``lang_pred`` and ``score`` for every whole text.

    ``score`` is the language's share if all were equally likely beforehand: 2 to the
    power of minus its code length, over the sum of all. Equal code lengths go to the
    first name. A null text, or one without a letter, is ``und`` with score 0, and so
    is every text if nothing was learned. Columns named like a new one give way.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    lettered = arrow.unused(df, "has_letter")

    def make():
        scorer = Scorer(shared.value)
        names = np.array([*scorer.languages, UNKNOWN], object)

        def compute(texts, letters):
            body = arrow.texts_of(texts)
            known = letters.fill_null(False).to_numpy(zero_copy_only=False)
            if not scorer.languages:
                return [pa.array([UNKNOWN] * len(body), pa.string()), np.zeros(len(body))]
            bits = scorer.lengths(body)
            best = bits.argmin(axis=1)
            score = 1 / np.exp2(np.minimum(0, bits.min(axis=1)[:, None] - bits)).sum(axis=1)
            return [
                pa.array(names[np.where(known, best, len(names) - 1)], pa.string()),
                np.where(known, score, 0.0),
            ]

        return compute

    flagged = df.withColumn(lettered, arrow.column(text).rlike(r"\p{L}"))
    return arrow.add_columns(flagged, [text, lettered], FIELDS, make).drop(lettered)
