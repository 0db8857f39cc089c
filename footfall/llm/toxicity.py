"""Toxicity by a chain of linear classifiers over counts of words and word beginnings.

The chain predicts its categories in order. Each link is a logistic regression on
the counts of telling words and word beginnings (which inflected words share) and on the probabilities of all earlier categories. While
learning, those earlier probabilities come from models that did not see the row
(out-of-fold), so a later link does not trust an earlier one more than it will be
able to. Every category is a column of the labels; the last one decides.
The tables label the quality of a text and whether it is toxic.

Words are runs of letters (A-Z lower-cased, and all bytes of non-ASCII signs), so
signs stuck to a word do not hide it. Counts cover the whole text.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm import arrow, rolling, samples, store

# Bound of each label's learning sample: documents, and characters of all its texts but the last.
SAMPLE_DOCS = 4_000
SAMPLE_CHARS = 10_000_000
# Words and beginnings looked at for the last category and for each one before it, and in how
# many sampled texts one must be.
N_WORDS = 384
N_EARLIER = 96
MIN_TEXTS = 5
# Lengths in bytes of the beginnings that count besides the whole word.
BEGINNINGS = (3, 4, 5, 6, 8)
FOLDS = 5
PENALTY = 0.3
STEPS = 30
THRESHOLD = 0.5

# The categories in chain order, as the labels name them.
CATEGORIES = ("quality", "toxic")

_WHOLE = np.uint64(0x5851F42D4C957F2D)


def fields(categories: Sequence[str]) -> T.StructType:
    """The columns that a chain of ``categories`` appends."""
    return T.StructType(
        [T.StructField(f"p_{name}", T.DoubleType()) for name in categories]
        + [T.StructField("toxic", T.BooleanType()), T.StructField("kept", T.BooleanType())]
    )


def word_hash(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(words_in(data, np.array([0, len(data)]))[1][0])


def words_in(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of every word of a block, then of every beginning of one."""
    data = rolling.LOWER[data]
    starts, ends, doc = rolling.word_spans(data, offsets, rolling.NOT_LETTER)
    sums = rolling.byte_sums(data)
    docs, found = [doc], [rolling.span_hashes(sums, starts, ends) ^ _WHOLE]
    for length in BEGINNINGS:
        long = ends - starts >= length
        docs.append(doc[long])
        found.append(rolling.span_hashes(sums, starts[long], starts[long] + length))
    return np.concatenate(docs), np.concatenate(found)


def word_counts(texts: pa.Array, words: np.ndarray) -> np.ndarray:
    """log(1 + count) of each of the sorted ``words`` in every text."""
    out = np.zeros((len(texts), len(words)), np.float32)
    if not len(words):
        return out
    for first, last, data, offsets in arrow.blocks(texts):
        doc, found = words_in(data, offsets)
        at = np.minimum(np.searchsorted(words, found), len(words) - 1)
        hit = words[at] == found
        cells = np.bincount(doc[hit] * len(words) + at[hit], minlength=(last - first) * len(words))
        out[first:last] = np.log1p(cells.reshape(-1, len(words)))
    return out


def probability(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    z = x @ weights[:-1] + weights[-1]
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit_link(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = STEPS) -> np.ndarray:
    """Weights (intercept last) of a ridge logistic regression, by Newton steps."""
    x1 = np.column_stack([x.astype(np.float64), np.ones(len(x))])
    ridge = np.full(x1.shape[1], penalty)
    ridge[-1] = 1e-6
    weights = np.zeros(x1.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x1 @ weights, -35, 35)))
        gradient = x1.T @ (p - y) + ridge * weights
        curve = (x1.T * (p * (1 - p))) @ x1
        curve[np.diag_indices_from(curve)] += ridge + 1e-9
        step = np.linalg.solve(curve, gradient)
        weights -= step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return weights


def _link(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """A link learned from the rows whose label is known; one that says no if there are none."""
    known = ~np.isnan(y)
    return fit_link(x[known], y[known]) if known.any() else np.append(np.zeros(x.shape[1]), -35.0)


def fit_chain(x: np.ndarray, labels: np.ndarray, fold: np.ndarray) -> list[np.ndarray]:
    """One link per column of ``labels`` (NaN: unknown); earlier columns reach later links out of fold."""
    links = []
    for k in range(labels.shape[1]):
        y = labels[:, k]
        links.append(_link(x, y))
        if k + 1 == labels.shape[1]:
            break
        apart = np.empty(len(y))
        for held in np.unique(fold):
            rest = fold != held
            apart[~rest] = probability(x[~rest], _link(x[rest], y[rest]))
        x = np.column_stack([x, apart])
    return links


def run_chain(x: np.ndarray, links: list[np.ndarray]) -> np.ndarray:
    """Probabilities (columns) of all categories in chain order."""
    found = []
    for weights in links:
        p = probability(x, weights)
        found.append(p)
        x = np.column_stack([x, p])
    return np.stack(found, axis=1)


def count_words(texts: pa.Array, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, texts with each, positive texts with each), the last two by column of ``labels``.

    Texts of unknown label (NaN) count in no column of theirs. Counted block by block, so
    only distinct words are held.
    """
    known, positive = ~np.isnan(labels), np.nan_to_num(labels)
    kinds = labels.shape[1]
    held = [(np.empty(0, np.uint64), np.empty((0, 2 * kinds)))]

    def joined() -> tuple[np.ndarray, np.ndarray]:
        words, place = np.unique(np.concatenate([part[0] for part in held]), return_inverse=True)
        sums = np.zeros((len(words), 2 * kinds))
        np.add.at(sums, place, np.concatenate([part[1] for part in held]))
        return words, sums

    for first, _, data, offsets in arrow.blocks(texts):
        doc, found = words_in(data, offsets)
        pairs = pd.DataFrame({"doc": doc, "word": found}).drop_duplicates()
        words, place = np.unique(pairs["word"].to_numpy(), return_inverse=True)
        at = first + pairs["doc"].to_numpy()
        weights = [side[at, k] for side in (known, positive) for k in range(kinds)]
        held.append((words, np.stack([np.bincount(place, w, len(words)) for w in weights], axis=1)))
        if sum(len(part[0]) for part in held[1:]) > 1 << 20:
            held = [joined()]
    words, sums = joined()
    return words, sums[:, :kinds], sums[:, kinds:]


def telling_words(words: np.ndarray, size: np.ndarray, positive: np.ndarray, n: int, n_positive: float, most: int) -> np.ndarray:
    """The ``most`` words whose presence depends on a label most (chi-squared; ties by hash)."""
    often = size >= MIN_TEXTS
    words, size, a = words[often], size[often], positive[often]
    determinant = a * (n - n_positive - (size - a)) - (size - a) * (n_positive - a)
    below = size * (n - size) * n_positive * (n - n_positive)
    score = np.where(below > 0, n * determinant**2 / np.maximum(below, 1), 0)
    return words[np.lexsort((words, -score))[:most]]


def fit_texts(texts: pa.Array, labels: np.ndarray, fold: np.ndarray) -> dict:
    """The model of labelled texts: the words looked at and the links of the chain."""
    words, size, positive = count_words(texts, labels)
    last = labels.shape[1] - 1
    chosen = [
        telling_words(
            words, size[:, k], positive[:, k], np.sum(~np.isnan(labels[:, k])), np.nansum(labels[:, k]),
            N_WORDS if k == last else N_EARLIER,
        )
        for k in range(last + 1)
    ]
    words = np.unique(np.concatenate(chosen))
    return {"words": words, "links": fit_chain(word_counts(texts, words), labels, fold)}


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
    categories: Sequence[str] | None = None, per_label: int = SAMPLE_DOCS, max_chars: int = SAMPLE_CHARS,
) -> dict | None:
    """Learn from a bounded sample of labelled documents; None if there are none of either last label.

    ``categories`` are columns of ``labels`` in chain order, by default those of ``CATEGORIES``
    that it has; the last one decides, so it must be there. A document
    with several labels has a category if one says so. A null last label or id counts as
    none, and so do labels of documents that ``docs`` lacks; a null earlier label is
    unknown to its link alone. Of each last label whole texts are taken in the order of
    their id's hash until there are ``per_label`` of them or they hold ``max_chars``
    characters, and one at least.
    """
    if categories is None:
        held = {name.lower() for name in labels.columns}
        categories = [name for name in CATEGORIES if name in held or name == CATEGORIES[-1]]
    flags = [f"y{k}" for k in range(len(categories))]
    last = flags[-1]
    named = labels.select(
        arrow.column(doc_id).alias("id"),
        *((arrow.column(name).cast("int") != 0).cast("int").alias(flag) for name, flag in zip(categories, flags, strict=True)),
    )
    named = named.where(f"id IS NOT NULL AND {last} IS NOT NULL").groupBy("id").agg(*(F.max(flag).alias(flag) for flag in flags))
    bodies = docs.select(arrow.column(doc_id).alias("id"), F.coalesce(arrow.column(text), F.lit("")).alias("text"))
    sizes = bodies.select("id", F.length("text").cast("long").alias("size")).join(named, "id")
    sizes = store.written(sizes, "labelled")
    n_labels, n_toxic = sizes.agg(F.count("*"), F.coalesce(F.sum(last), F.lit(0))).first()
    chosen = samples.bounded(sizes, last, per_label, max_chars).join(named, "id")
    sample = bodies.join(F.broadcast(chosen), "id").select("id", "text", *flags)

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches) or [pd.DataFrame({name: [] for name in ("id", "text", *flags)})])
        rows = rows.sort_values(["id", "text"], ignore_index=True)
        known = rows[flags].to_numpy(float)
        y = known[:, -1]
        if 0 < y.sum() < len(y):
            fold = (rows["id"].to_numpy(np.int64) % 1_000_003 * 7919 % 104_729 % FOLDS).astype(int)
            model = fit_texts(arrow.texts_of(pa.array(rows["text"], pa.string())), known, fold)
            # The sample holds toxic texts more often than the labels do.
            odds, sampled = n_toxic / (n_labels - n_toxic), y.sum() / (len(y) - y.sum())
            model["links"][-1][-1] += np.log(odds / sampled)
            yield pd.DataFrame({"model": [pickle.dumps(model | {"categories": tuple(categories)})]})

    found = sample.repartition(1).mapInPandas(learn, "model binary").first()
    return pickle.loads(found["model"]) if found else None


def _categories(model: dict | None) -> Sequence[str]:
    return CATEGORIES if model is None else model["categories"]


def _judge(model: dict | None):
    names = _categories(model)

    def compute(texts) -> dict[str, np.ndarray]:
        body = arrow.texts_of(texts)
        if model is None or not len(body):
            p = np.zeros((len(body), len(names)))
        else:
            step = max(1, (1 << 19) // max(1, len(model["words"])))
            p = np.concatenate([
                run_chain(word_counts(body[at : at + step], model["words"]), model["links"])
                for at in range(0, len(body), step)
            ])
        toxic = p[:, -1] >= THRESHOLD
        return {f"p_{name}": p[:, k] for k, name in enumerate(names)} | {"toxic": toxic, "kept": ~toxic}

    return compute


def with_toxicity(df: DataFrame, model: dict | None, text: str = "text") -> DataFrame:
    """Append the probability of every category, ``toxic`` and ``kept`` for every whole text.

    A null text counts as empty. Without a model all probabilities are 0 and every
    row is kept. Columns of ``df`` named like a new one give way; an empty table gives none.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    added = fields(_categories(model))

    def make():
        judge = _judge(shared.value)
        return lambda texts: [found[name] for found in [judge(texts)] for name in added.names]

    return arrow.add_columns(df, [text], added, make)


def keep_civil(df: DataFrame, model: dict | None, text: str = "text") -> DataFrame:
    """The rows whose text is not toxic, with the columns of ``df`` unchanged."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        judge = _judge(shared.value)
        return lambda texts: judge(texts)["kept"]

    return arrow.add_columns(df, [text], T.StructType(), make, keep=True)
