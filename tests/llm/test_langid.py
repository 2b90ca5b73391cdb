import zlib

import numpy as np
import pytest

from helpers import documents, empty, with_clashes
from tallyloom.llm import langid


def plain_presence(text):
    """Places of a text's n-grams, one by one."""
    out = set()
    chars = [ord(c) if c.isalpha() or ord(c) > 0xFFFF else 32 for c in text.lower()] + [0] * (len(langid.ORDER_BITS) - 1)
    n = len(text.lower())
    for i in range(n):
        gram, first = 0, 0
        for order, bits in enumerate(langid.ORDER_BITS):
            gram = (gram * 0x9E3779B1 + chars[i + order] + 1) & 0xFFFFFFFF
            mixed = ((gram ^ (gram >> 15)) * 0x85EBCA6B) & 0xFFFFFFFF
            out.add((mixed >> (32 - bits)) + first)
            first += 1 << bits
    return out


def test_presence_against_one_by_one():
    texts = ["Hello, world", "", "Öl & Ñandú 12", "漢字 😀 Σς", "a" * 50]
    for row, text in zip(langid.presence(texts), texts):
        assert set(np.flatnonzero(row).tolist()) == plain_presence(text)


def test_kernel_of_a_text_with_itself_is_one():
    rows = langid.presence(["some text", "another one"]).astype(np.float32)
    k = langid.kernel(rows, rows)
    assert np.allclose(np.diag(k), 1) and np.allclose(k, k.T) and k.max() <= 1 + 1e-6


def test_held_out_accuracy_and_contract(spark, sample_dir):
    from tallyloom.llm.registry import QUERIES

    rows = QUERIES["op1_language_id"](spark, sample_dir).collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sample_dir}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    right = [r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in rows if r["held_out"]]
    assert sum(right) >= 0.95 * len(right)


@pytest.fixture(scope="module")
def model(spark):
    texts = ["the house is on the hill and it is red", "das haus steht auf dem berg und ist rot"] * 30
    docs = documents(spark, [f"{t} {i}" for i, t in enumerate(texts)]).selectExpr(
        "doc_id", "text", "case when doc_id % 2 = 0 then 'en' when doc_id < 50 then 'de' end as lang"
    )
    return langid.fit(docs)


def test_awkward_texts(spark, model):
    texts = [None, "", "123 ... !", "the red house", "das rote haus", "x", "das rote haus " * 5_000, "漢字"]
    rows = langid.predict(with_clashes(documents(spark, texts)), model).orderBy("doc_id").collect()
    found = [r["lang_pred"] for r in rows]
    assert found[:5] == ["und", "und", "und", "en", "de"] and found[6] == "de"
    assert [r["score"] for r in rows[:3]] == [0, 0, 0]


def test_nothing_to_learn_from(spark):
    docs = documents(spark, ["some text", None], lang=None)
    assert langid.fit(docs) is None and langid.fit(empty(docs)) is None
    assert [r["lang_pred"] for r in langid.predict(docs, None).collect()] == ["und", "und"]
    assert langid.predict(empty(docs), None).collect() == []
    letterless = documents(spark, ["...", "12"])
    assert langid.fit(letterless) is None
