"""Toxicity by a classifier chain of linear models.

The categories stand in a fixed order. Each has a logistic regression on hashed features of the words, and on the
probabilities of the categories before it. In training these are out-of-fold predictions, so a later model learns from
probabilities as uncertain as those it will get; in prediction the fitted models are used one after the other.

Features of a text: its white-space words (A-Z in lower case), their first 4 to 7 and last 3 bytes, each as
seen once, twice and four times. Of these every model uses the ``FEATURES`` that tell its category best from the rest.

Learning takes a bounded sample of the labelled rows, whose features Spark computes. Prediction covers whole texts.

Defined cases: a null text or one without words has probability 0 of everything, as all have if the sample holds only one
value of a category. Rows without a label for some category are not learned from. Null ids are predicted, not learned from; of
several labels of one id each counts as a row. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import new_name, one_thread
from tallyloom.llm.words import Words, mix, powers, split_words, word_hashes

BUCKET_BITS = 20
LEVELS = (1, 2, 4)
PREFIXES = (4, 5, 6, 7)
SUFFIX = 3
FEATURES = 2000
#: Texts of a sample that a feature must occur in.
LEAST_TEXTS = 3
SAMPLE_ROWS = 4000
FETCHES = 8
FOLDS = 3
PENALTY = 1e-5
ITERATIONS = 60
#: Missing a text costs more than looking at one in vain.
THRESHOLD = 0.25
BLOCK_TEXTS = 256


def _part_hashes(words: Words, at: np.ndarray, n: int, from_end: bool) -> np.ndarray:
    """Hash of the first or last ``n`` bytes of the words at ``at``, which have as many."""
    first = words.ends[at] - n if from_end else words.starts[at]
    out = np.full(len(at), n + 100 * from_end, np.uint64)
    for j, p in enumerate(powers(0xC6A4A7935BD1E995, n + 1)[1:]):
        out += (words.data[first + j].astype(np.uint64) + np.uint64(1)) * p
    return mix(out)


def codes(texts: Sequence[str | None], used: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, code) of the distinct features of a batch, sorted, and the number of words per text.

    A code is a bucket and a level. ``used`` is TRUE for the buckets of interest, if not all are.
    """
    words = split_words(texts, lower=True)
    text, lengths = words.text_of_word(), words.ends - words.starts
    keys = []

    def add(at: np.ndarray | slice, hashes: np.ndarray) -> None:
        bucket = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        of = text[at]
        if used is not None:
            hit = used[bucket]
            bucket, of = bucket[hit], of[hit]
        keys.append(of << BUCKET_BITS | bucket)

    add(slice(None), word_hashes(words))
    for n in PREFIXES:
        at = np.flatnonzero(lengths >= n)
        add(at, _part_hashes(words, at, n, False))
    at = np.flatnonzero(lengths >= SUFFIX)
    add(at, _part_hashes(words, at, SUFFIX, True))
    found, counts = np.unique(np.concatenate(keys), return_counts=True)
    rows, cols = [], []
    for level, least in enumerate(LEVELS):
        kept = found[counts >= least]
        rows.append(kept >> BUCKET_BITS)
        cols.append((kept & ((1 << BUCKET_BITS) - 1)) * len(LEVELS) + level)
    row, col = np.concatenate(rows), np.concatenate(cols)
    order = np.argsort(row, kind="stable")
    return row[order], col[order].astype(np.int32), words.counts()


@dataclass
class Linear:
    """Logistic regression: chosen codes and their weights, weights of earlier probabilities, intercept."""

    chosen: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    intercept: float

    def margins(self, row: np.ndarray, code: np.ndarray, n: int, earlier: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.chosen, code), max(len(self.chosen) - 1, 0))
        hit = self.chosen[at] == code if len(self.chosen) else np.zeros(len(code), bool)
        out = np.bincount(row[hit], self.weights[at[hit]], n) if len(code) else np.zeros(n)
        return out + earlier @ self.earlier + self.intercept


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def minimise(loss, start: np.ndarray, iterations: int = ITERATIONS, memory: int = 8) -> np.ndarray:
    """Minimum of a smooth convex function that gives (value, gradient), by limited-memory BFGS."""
    x, (value, gradient), steps = start, loss(start), []
    for _ in range(iterations):
        direction, alphas = gradient.copy(), []
        for s, y in reversed(steps):
            alphas.append(s @ direction / (y @ s))
            direction -= alphas[-1] * y
        if steps:
            s, y = steps[-1]
            direction *= (s @ y) / (y @ y)
        for (s, y), a in zip(steps, reversed(alphas)):
            direction += (a - y @ direction / (y @ s)) * s
        slope, size = gradient @ direction, 1.0
        while size > 1e-10:
            moved = x - size * direction
            new_value, new_gradient = loss(moved)
            if new_value <= value - 1e-4 * size * slope:
                break
            size /= 2
        else:
            break
        s, y = moved - x, new_gradient - gradient
        if s @ y > 1e-12:
            steps = [*steps[1 - memory :], (s, y)]
        done = value - new_value < 1e-7 * max(1.0, abs(value))
        x, value, gradient = moved, new_value, new_gradient
        if done:
            break
    return x


def choose(row: np.ndarray, code: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Codes whose presence differs most between the texts of a category and the rest."""
    size = int(code.max(initial=-1)) + 1
    total = np.bincount(code, minlength=size).astype(float)
    inside = np.bincount(code, wanted[row], size)
    yes, no = max(wanted.sum(), 1), max(len(wanted) - wanted.sum(), 1)
    a, b = inside / yes, (total - inside) / no
    score = np.where(total >= LEAST_TEXTS, np.abs(a - b) / np.sqrt(a + b + 1 / len(wanted)), -1)
    best = np.argsort(-score, kind="stable")[:FEATURES]
    return np.sort(best[score[best] > 0]).astype(np.int32)


def fit_linear(row: np.ndarray, code: np.ndarray, wanted: np.ndarray, earlier: np.ndarray) -> Linear:
    n = len(wanted)
    if wanted.min(initial=1) == wanted.max(initial=0):
        return Linear(np.empty(0, np.int32), np.empty(0), np.zeros(earlier.shape[1]), -50.0)
    chosen = choose(row, code, wanted)
    place = np.full(int(code.max(initial=0)) + 1, -1, np.int32)
    place[chosen] = np.arange(len(chosen), dtype=np.int32)
    hit = place[code] >= 0
    r, c, k = row[hit], place[code[hit]], len(chosen)

    def loss(p: np.ndarray) -> tuple[float, np.ndarray]:
        margin = np.bincount(r, p[c], n) + earlier @ p[k:-1] + p[-1]
        # log(1 + e^m) - y m, safe for large m
        value = (np.logaddexp(0, margin) - wanted * margin).sum()
        off = sigmoid(margin) - wanted
        gradient = np.concatenate([np.bincount(c, off[r], k), earlier.T @ off, [off.sum()]])
        gradient[:-1] += PENALTY * n * p[:-1]
        return value + PENALTY * n * (p[:-1] @ p[:-1]) / 2, gradient

    p = minimise(loss, np.zeros(k + earlier.shape[1] + 1))
    return Linear(chosen, p[:k], p[k:-1], float(p[-1]))


@dataclass
class Chain:
    categories: list[str]
    models: list[Linear]

    def buckets(self) -> np.ndarray:
        used = np.zeros(1 << BUCKET_BITS, bool)
        for model in self.models:
            used[model.chosen // len(LEVELS)] = True
        return used

    def predict(self, texts: Sequence[str | None], used: np.ndarray) -> np.ndarray:
        """Texts by categories: probabilities."""
        row, code, words = codes(texts, used)
        found = np.zeros((len(texts), 0))
        for model in self.models:
            p = sigmoid(model.margins(row, code, len(texts), found))
            found = np.hstack([found, np.where(words > 0, p, 0)[:, None]])
        return found


def fit_chain(categories: list[str], row: np.ndarray, code: np.ndarray, labels: np.ndarray, fold: np.ndarray) -> Chain:
    """Chain from the features of a sample, its labels (texts by categories) and the fold of each text."""
    models, earlier = [], np.zeros((len(labels), 0))
    for j in range(len(categories)):
        models.append(fit_linear(row, code, labels[:, j], earlier))
        if j + 1 == len(categories):
            break
        out = np.zeros(len(labels))
        for f in range(FOLDS):
            train, test = fold != f, fold == f
            if not test.any() or not train.any():
                continue
            in_train, in_test = train[row], test[row]
            place = np.cumsum(train) - 1
            model = fit_linear(place[row[in_train]], code[in_train], labels[train, j], earlier[train])
            place = np.cumsum(test) - 1
            out[test] = sigmoid(model.margins(place[row[in_test]], code[in_test], int(test.sum()), earlier[test]))
        earlier = np.hstack([earlier, out[:, None]])
    return Chain(categories, models)


def fit(docs: DataFrame, labels: DataFrame, categories: Mapping[str, str], text: str = "text", key: str = "doc_id") -> Chain:
    """Chain for ``categories``, in their order, each a condition (in SQL) on columns of ``labels``."""
    names = list(categories)
    marked = labels.select(F.col(key).alias("_key"), *[F.expr(c).alias(f"_{i}") for i, c in enumerate(categories.values())])
    # Labels that repeat an id and all marks count once, so an id has few rows, however often it stands there.
    known = marked.dropna().distinct()
    n = known.count()
    draw = F.pmod(F.xxhash64(F.lit("toxicity"), F.col("_key").cast("string")), F.lit(1 << 30))
    drawn = known.withColumn("_draw", draw).where(F.col("_draw") < int((1 << 30) * min(1.0, SAMPLE_ROWS / max(n, 1))) + 1)
    # At most about SAMPLE_ROWS short rows, so they can be sent to the texts.
    drawn = F.broadcast(drawn) if n else drawn
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).dropna().join(drawn, "_key")
    # A drawn id may have any number of texts: of these, too, only about as many are taken, and equal ones once.
    met = docs.select(F.col(key).alias("_key")).dropna().join(drawn.select("_key"), "_key", "left_semi").count() if n else 0
    if met > 2 * SAMPLE_ROWS:
        again = F.pmod(F.xxhash64(F.lit("again"), F.col("_key").cast("string"), F.col("_text")), F.lit(1 << 30))
        rows = rows.where(again < int((1 << 30) * SAMPLE_ROWS / met) + 1)
        rows = rows.groupBy("_key", "_draw", *[f"_{i}" for i in range(len(names))], F.xxhash64("_text").alias("_h")).agg(
            F.min("_text").alias("_text")
        ).drop("_h")

    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(0, len(batch), BLOCK_TEXTS):
                part = batch.iloc[i : i + BLOCK_TEXTS]
                row, code, _ = codes(list(part["_text"]))
                cuts = np.searchsorted(row, np.arange(1, len(part)))
                yield pd.DataFrame(
                    {
                        "draw": part["_draw"].to_numpy(),
                        "marks": [[bool(x) for x in m] for m in part[[f"_{j}" for j in range(len(names))]].to_numpy()],
                        "codes": [c.tobytes() for c in np.split(code, cuts)],
                    }
                )

    drawn = rows.mapInPandas(featured, "draw long, marks array<boolean>, codes binary")
    # Fetched in a few parts, one after the other, for the driver's memory.
    fetched = drawn.repartition(FETCHES).toLocalIterator()
    sample = sorted(((r["draw"], bytes(r["codes"]), r["marks"]) for r in fetched), key=lambda r: r[:2])
    if not sample:
        return Chain(names, [Linear(np.empty(0, np.int32), np.empty(0), np.zeros(j), -50.0) for j in range(len(names))])
    one_thread()
    marks = np.array([r[2] for r in sample], float)
    fold = np.array([r[0] % FOLDS for r in sample])
    features = [np.frombuffer(r[1], np.int32) for r in sample]
    row = np.repeat(np.arange(len(sample), dtype=np.int32), [len(f) for f in features])
    code = np.concatenate(features)
    # Most features are those of one text; they go first, and the rest is numbered, for the driver's memory.
    del sample, features
    counts = np.bincount(code, minlength=1).astype(np.int32)
    common = (counts >= max(LEAST_TEXTS, len(fold) // 1000))[code]
    row, code = row[common], code[common]
    del common, counts
    vocabulary = np.unique(code)
    chain = fit_chain(names, row, np.searchsorted(vocabulary, code).astype(np.int32), marks, fold)
    for model in chain.models:
        model.chosen = vocabulary[model.chosen]
    return chain


def probabilities(docs: DataFrame, chain: Chain, text: str = "text") -> Column:
    """Struct of the probabilities ``p_<category>`` of a text column."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    names = [f"p_{c}" for c in chain.categories]

    @F.pandas_udf(", ".join(f"{n} double" for n in names))
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        one_thread()
        used = shared.value.buckets()
        for batch in batches:
            parts = [
                shared.value.predict([t if isinstance(t, str) else None for t in batch.iloc[i : i + BLOCK_TEXTS]], used)
                for i in range(0, len(batch), BLOCK_TEXTS)
            ]
            yield pd.DataFrame(np.concatenate(parts) if parts else np.zeros((0, len(names))), columns=names)

    return scored(F.col(text))


def is_category(docs: DataFrame, chain: Chain, category: str, text: str = "text", threshold: float = THRESHOLD) -> Column:
    return probabilities(docs, chain, text)[f"p_{category}"] >= threshold


def predict(docs: DataFrame, chain: Chain, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``p_<category>`` and ``<category>`` (TRUE from ``threshold`` on) for each category.

    Columns of these names are replaced.
    """
    names = [f"p_{c}" for c in chain.categories]
    at = new_name("_scored", docs.columns)
    new = {n.lower() for n in (*names, *chain.categories)}
    found = docs.withColumn(at, probabilities(docs, chain, text))
    return found.select(
        *[F.col(c) for c in docs.columns if c.lower() not in new],
        *[F.col(at)[n].alias(n) for n in names],
        *[(F.col(at)[f"p_{c}"] >= threshold).alias(c) for c in chain.categories],
    )
