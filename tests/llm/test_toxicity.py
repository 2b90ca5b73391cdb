import random

import numpy as np
import pytest

from helpers import documents, empty, with_clashes
from tallyloom.llm import toxicity

CATEGORIES = {"junk": "junk = 1", "rude": "rude = 1"}


def corpus(n, seed):
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(500)]
    texts, labels = [], []
    for _ in range(n):
        text = rng.choices(words, k=rng.randrange(5, 80))
        junk, rude = rng.random() < 0.3, rng.random() < 0.3
        if junk:
            text = [w + "%%%" for w in text]
        if rude:
            text[1:1] = [rng.choice(["Idiot", "fool", "moron"]) + rng.choice(["", "s", ","]) for _ in range(3)]
        texts.append(" ".join(text))
        labels.append((int(junk), int(rude)))
    return texts, labels


def labels_table(spark, labels):
    rows = [(i, a, b) for i, (a, b) in enumerate(labels)]
    return spark.createDataFrame(rows, "doc_id long, junk int, rude int")


@pytest.fixture(scope="module")
def chain(spark):
    texts, labels = corpus(600, 12)
    docs = documents(spark, [*texts, "null label", None])
    table = labels_table(spark, labels).unionByName(spark.createDataFrame([(600, None, 1), (601, 1, 1), (None, 1, 1)], "doc_id long, junk int, rude int"))
    return toxicity.fit(docs, table, CATEGORIES)


def test_held_out_accuracy(spark, chain):
    texts, labels = corpus(300, 13)
    rows = toxicity.predict(with_clashes(documents(spark, texts)), chain).orderBy("doc_id").collect()
    for name, place in (("junk", 0), ("rude", 1)):
        right = [r[name] == bool(marks[place]) for r, marks in zip(rows, labels)]
        assert sum(right) >= 0.95 * len(right)
        assert all(r[name] == (r[f"p_{name}"] >= toxicity.THRESHOLD) for r in rows)


def test_later_models_take_earlier_probabilities(chain):
    assert [len(m.earlier) for m in chain.models] == [0, 1]


def test_chained_category_is_learned_from_out_of_fold_predictions():
    """The second category is the first one; its text features say nothing beyond that."""
    texts, labels = corpus(300, 14)
    row, code, _ = toxicity.codes(texts)
    y = np.array([[b, b] for _, b in labels], float)
    chain = toxicity.fit_chain(["a", "b"], row, code, y, np.arange(300) % toxicity.FOLDS)
    assert chain.models[1].earlier[0] > 1
    p = chain.predict(texts, chain.buckets())
    assert ((p[:, 1] > 0.5) == (y[:, 1] > 0.5)).mean() > 0.97


def test_features_against_one_by_one():
    texts = ["Ab ab abcd abcdefgh É", None, "", "a " * 5, "x" * 3]
    row, code, words = toxicity.codes(texts)
    assert words.tolist() == [5, 0, 0, 5, 1]
    expected = []
    for text in texts:
        seen = {}
        for w in (text or "").lower().encode().split():
            for part in [("w", w), *[("p", w[:n]) for n in toxicity.PREFIXES if len(w) >= n], *([("s", w[-3:])] if len(w) >= 3 else [])]:
                seen[part] = seen.get(part, 0) + 1
        expected.append(sum(sum(n >= level for level in toxicity.LEVELS) for n in seen.values()))
    assert np.bincount(row, minlength=len(texts)).tolist() == expected
    assert (np.diff(row) >= 0).all()


def test_minimum_of_a_quadratic():
    a = np.diag([1.0, 10.0, 100.0])
    b = np.array([1.0, -2.0, 3.0])
    found = toxicity.minimise(lambda x: (x @ a @ x / 2 - b @ x, a @ x - b), np.zeros(3))
    assert np.allclose(found, np.linalg.solve(a, b), atol=1e-3)


def test_awkward_texts_and_empty_tables(spark, chain):
    docs = documents(spark, [None, "", " \n", "idiot moron fool " * 5_000])
    rows = toxicity.predict(docs, chain).orderBy("doc_id").collect()
    assert [r["p_rude"] for r in rows[:3]] == [0, 0, 0] and rows[3]["rude"]
    assert toxicity.predict(empty(docs), chain).collect() == []
    none = toxicity.fit(docs, empty(labels_table(spark, [(0, 1)])), CATEGORIES)
    assert not any(r["rude"] for r in toxicity.predict(docs, none).collect())
    one_sided = toxicity.fit(docs, labels_table(spark, [(0, 1)] * 4), CATEGORIES)
    assert not any(r["rude"] for r in toxicity.predict(docs, one_sided).collect())
