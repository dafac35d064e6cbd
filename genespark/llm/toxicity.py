"""Toxicity by a classifier chain.

Categories are predicted one after the other by linear (logistic) models over the
words of a text and their beginnings and ends; each model also gets the probabilities of the categories before
it.  In training those are out-of-fold predictions: a document's earlier
probabilities come from models that haven't seen it, as they will at scoring time.

The models are fitted on at most ``TRAIN_ROWS`` labels (drawn by a hash of the id) on
the driver; scoring covers all rows, whole texts, in one pass.

Rows and cases: a null text has no word and gets the models' base rates, null
``doc_id`` is scored but can't be labelled, equal labels of an id count once and
differing ones each, of rows with the same id one text is learned (the one with the
least hash), null labels drop out, other columns are ignored (``keep`` passes them).
With no labelled row every probability is 0.
"""

from __future__ import annotations

import re
from array import array
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import storage

TRAIN_ROWS = 6000
#: A feature needs this many training documents; of those, the ones that tell a category best take part.
LEAST_DOCS = 4
#: Chi-square of a feature at least; chance alone reaches it once in ten thousand features.
LEAST_CHI = 15.1
FEATURES = 2048
FOLDS = 3
#: Words whose features a worker keeps.
CACHE_WORDS = 400_000
WORD = re.compile(r"\w+")


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def features_of(word: str) -> list[str]:
    """The word, its beginnings of three to five characters and its last four."""
    return [word, *(f"^{word[:n]}" for n in (3, 4, 5) if len(word) >= n), f"{word[-4:]}$"]


def choose(texts: list[set[str]], labels: np.ndarray) -> list[str]:
    """For each category, the FEATURES features with the largest chi-square."""
    number: dict[str, int] = {}
    index, sizes = array("i"), []
    for words in texts:
        own = {f for w in words for f in features_of(w)}
        index.extend(number.setdefault(f, len(number)) for f in own)
        sizes.append(len(own))
    at, row, n = np.frombuffer(index, dtype=np.int32), np.repeat(np.arange(len(texts), dtype=np.int32), sizes), len(texts)
    names, count = np.array(list(number), dtype=object), np.bincount(at, minlength=len(number))
    out: set[str] = set()
    for k in range(labels.shape[1]):
        rate = labels[:, k].mean() if n else 0.0
        if not 0 < rate < 1:
            continue
        both = np.bincount(at, labels[row, k], len(number))
        share = count / n
        chi = (both / n - share * rate) ** 2 / np.maximum(share * (1 - share) * rate * (1 - rate), 1e-12)
        chi[(count < LEAST_DOCS) | (both / n < share * rate) | (n * chi < LEAST_CHI)] = 0  # only what surely speaks for the category
        best = np.lexsort((names, -chi))[:FEATURES]
        out.update(names[best[chi[best] > 0]])
    return sorted(out)


@dataclass
class Bags:
    """Word numbers of documents, one after the other."""

    index: np.ndarray
    sizes: np.ndarray

    def sums(self, weights: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(weights[self.index])])
        ends = np.cumsum(self.sizes)
        return total[ends] - total[ends - self.sizes]

    def rows(self, which: np.ndarray) -> Bags:
        return Bags(self.index[np.repeat(which, self.sizes)], self.sizes[which])


@dataclass
class Linear:
    """Logistic model: word weights, weights of earlier probabilities, intercept."""

    words: np.ndarray
    earlier: np.ndarray
    bias: float

    def predict(self, bags: Bags, earlier: np.ndarray) -> np.ndarray:
        return sigmoid(bags.sums(self.words) + earlier @ self.earlier + self.bias)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(bags: Bags, earlier: np.ndarray, target: np.ndarray, n_words: int, ridge: float = 1e-4, steps: int = 100) -> Linear:
    """Full-batch Adam on the mean log loss with a ridge on the weights."""
    n, k = len(target), earlier.shape[1]
    theta = np.zeros(n_words + k + 1)
    rate = np.clip(target.mean() if n else 0.0, 1e-3, 1 - 1e-3)
    theta[-1] = np.log(rate / (1 - rate))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1 if n else 1):
        score = bags.sums(theta[:n_words]) + earlier @ theta[n_words:-1] + theta[-1]
        error = (sigmoid(score) - target) / n
        grad = np.concatenate([np.bincount(bags.index, np.repeat(error, bags.sizes), n_words), earlier.T @ error, [error.sum()]])
        grad[:-1] += ridge * theta[:-1]
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        theta -= 0.2 * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-5)
    return Linear(theta[:n_words], theta[n_words:-1], float(theta[-1]))


@dataclass
class Chain:
    """The fitted models in order, over one vocabulary."""

    categories: list[str]
    vocabulary: dict[str, int] = field(default_factory=dict)
    models: list[Linear] = field(default_factory=list)
    limits: list[float] = field(default_factory=list)
    known: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def word(self, word: str) -> tuple[int, ...]:
        """Numbers of a word's features."""
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        found = self.known[word] = tuple(i for f in features_of(word) if (i := self.vocabulary.get(f)) is not None)
        return found

    def bags(self, texts: list[set[str]]) -> Bags:
        found = []
        for words in texts:
            known = list(map(self.known.get, words))
            if None in known:
                known = [self.word(w) if k is None else k for w, k in zip(words, known, strict=True)]
            found.append(sorted(set(chain.from_iterable(known))))
        return Bags(np.array([i for x in found for i in x], dtype=np.int64), np.array([len(x) for x in found], dtype=np.int64))

    def predict(self, texts: list[set[str]]) -> np.ndarray:
        bags, out = self.bags(texts), np.zeros((len(texts), 0))
        for model in self.models:
            out = np.column_stack([out, model.predict(bags, out)])
        return out if self.models else np.zeros((len(texts), len(self.categories)))


def train(texts: list[set[str]], labels: np.ndarray, categories: list[str], folds: int = FOLDS) -> Chain:
    """Fit the chain; ``labels`` has a column for each category."""
    fitted = Chain(categories, {f: k for k, f in enumerate(choose(texts, labels))} if texts else {})
    if not texts:
        return fitted
    bags, n_words = fitted.bags(texts), len(fitted.vocabulary)
    fold = np.arange(len(texts)) % folds
    earlier = np.zeros((len(texts), 0))
    for k in range(len(categories)):
        target = labels[:, k].astype(np.float64)
        fitted.models.append(fit(bags, earlier, target, n_words))
        held_out = np.zeros(len(texts))
        for f in range(folds):
            rest, own = fold != f, fold == f
            model = fit(bags.rows(rest), earlier[rest], target[rest], n_words)
            held_out[own] = model.predict(bags.rows(own), earlier[own])
        fitted.limits.append(best_limit(held_out, target))
        earlier = np.column_stack([earlier, held_out])
    return fitted


def best_limit(predicted: np.ndarray, target: np.ndarray, precision: float = 0.98) -> float:
    """The limit with the best F1 among those precise enough on held-out predictions, else 0.5.

    It lies halfway between the two predictions around it.
    """
    order = np.argsort(-predicted, kind="stable")
    hits, n = np.cumsum(target[order]), np.arange(1, len(order) + 1)
    score = 2 * hits / (n + max(target.sum(), 1))
    score[:-1][predicted[order][:-1] == predicted[order][1:]] = -1  # equal predictions stay together
    score[hits < precision * n] = -1
    at = int(score.argmax())
    if score[at] <= 0 or at + 1 == len(order):
        return 0.5
    return float((predicted[order[at]] + predicted[order[at + 1]]) / 2)


#: Categories in the chain's order: an expression over the label columns for each.
CATEGORIES = {"low_quality": "1 - quality", "toxic": "toxic"}


def train_on(docs: DataFrame, labels: DataFrame, categories: dict[str, str] | None = None, rows: int = TRAIN_ROWS) -> Chain:
    """Fit on a bounded sample of labelled documents; its words and labels go to the driver."""
    categories = CATEGORIES if categories is None else categories
    storage.small_batches(docs.sparkSession)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), *(F.expr(f"cast({e} as double)").alias(f"y_{k}") for k, e in enumerate(categories.values()))).dropna()
    sample = known.distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)  # bounded, so it may be broadcast
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    names = [f"y_{k}" for k in range(len(categories))]
    # A repeated id may bring any number of rows: one of each id and text is enough, the first by its hash.
    texts = texts.groupBy("doc_id", *names).agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))

    def split(batches):
        for batch in batches:
            column = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
            found = [" ".join(sorted(words_of(t))) for t in column["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([column["doc_id"], pa.array(found, pa.string()), *(column[n] for n in names)], ["doc_id", "words", *names])

    got = texts.mapInArrow(storage.worker("toxicity", split), "doc_id long, words string, " + ", ".join(f"{n} double" for n in names)).toPandas()
    got = got.sort_values(["doc_id", "words", *names])
    return train([set(w.split(" ")) - {""} for w in got["words"]], got[names].to_numpy(), list(categories))


def score(docs: DataFrame, fitted: Chain) -> DataFrame:
    """doc_id and the probability of each category for every row."""
    storage.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(fitted)  # FEATURES features a category

    def run(batches):
        model = shared.value
        storage.hold("toxicity", model.known.clear)
        for batch in batches:
            found = model.predict(list(map(words_of, batch.column(1).to_pylist())))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(found[:, k]) for k in range(found.shape[1]))], ["doc_id", *model.categories])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(storage.worker("toxicity", run), "doc_id long, " + ", ".join(f"{c} double" for c in fitted.categories))


def keep(docs: DataFrame, fitted: Chain, category: str = "toxic") -> DataFrame:
    """The rows of ``docs`` whose probability stays under the category's limit, all columns unchanged."""
    storage.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(fitted)
    at, column = docs.columns.index("text"), fitted.categories.index(category)
    limit = fitted.limits[column] if fitted.limits else 1.0

    def run(batches):
        model = shared.value
        storage.hold("toxicity", model.known.clear)
        for batch in batches:
            found = model.predict(list(map(words_of, batch.column(at).to_pylist())))
            yield batch.filter(pa.array(found[:, column] < limit))

    return docs.mapInArrow(storage.worker("toxicity", run), docs.schema)
