import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from helpers import documents, empty, with_clashes
from tallyloom.llm import substrings


def plain(rows):
    """(words, removed, kept) by id, of (id, text) in the order of their ids."""
    seen, out = set(), []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(words)
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if window in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(window)
        out.append((len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)))
    return out


def texts():
    rng = random.Random(5)
    words = ["w%d" % i for i in range(400)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    passage, long = text(27), text(90)
    out = [text(rng.randrange(0, 120)) for _ in range(20)]
    out += [f"{text(rng.randrange(0, 15))} {passage}\n{text(rng.randrange(0, 15))}" for _ in range(15)]
    out += [" ".join(long.split()[a : a + 40]) for a in range(0, 50, 3)]
    out += [None, "", " \n", "a " * 400, "a " * 19, "a " * 20, "a " * 21, "a b " * 30, "É é ü " * 25]
    out += [passage, passage, text(19), out[3], out[3]]
    return out


@pytest.mark.parametrize("bundle_bytes", [300, 2_000_000])
def test_whole_result_against_brute_force(spark, monkeypatch, bundle_bytes):
    monkeypatch.setattr(substrings, "BUNDLE_BYTES", bundle_bytes)
    all_texts = texts()
    docs = with_clashes(documents(spark, all_texts)).repartition(5)
    rows = substrings.remove_repeats(docs).orderBy("doc_id").collect()
    assert [(r["n_words"], r["n_removed"], r["kept"]) for r in rows] == plain(list(enumerate(all_texts)))
    assert set(rows[0].asDict()) == {*docs.columns, "n_words", "n_removed", "kept"}


def test_texts_are_not_shuffled(spark):
    plan = substrings.remove_repeats(documents(spark, texts()))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Bucketed: true") == 3
    assert not [p for p in plan.split("\n") if "Exchange" in p and "_bundle" in p]


def test_null_and_equal_ids(spark):
    words = " ".join(f"w{i}" for i in range(30))
    docs = documents(spark, [words] * 4, ids=[None, 3, 3, None]).coalesce(1)
    rows = substrings.remove_repeats(docs).collect()
    assert sorted((r["doc_id"] or -1, r["n_removed"]) for r in rows) == [(-1, 30), (-1, 30), (3, 0), (3, 30)]


def test_documents_keep_their_columns(spark):
    words = " ".join(f"w{i}" for i in range(30))
    docs = with_clashes(documents(spark, [words, f"x  {words}\ty", "a  b\n"]))
    rows = substrings.dedup(docs).orderBy("doc_id").collect()
    assert [r["text"] for r in rows] == [words, "x y", "a  b\n"]
    assert [r["n_chars"] for r in rows] == [len(words), 3, 5]
    assert substrings.dedup(docs).schema.names == docs.schema.names


def test_empty_table(spark):
    assert substrings.remove_repeats(empty(documents(spark, ["a"]))).collect() == []


def test_query(spark, sample_dir):
    from tallyloom.llm.registry import QUERIES

    docs = spark.read.parquet(f"{sample_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    rows = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op8_substring_dedup"](spark, sample_dir).collect()}
    for (doc_id, _), (n, removed, kept) in zip(docs, plain([tuple(d) for d in docs])):
        assert rows[doc_id] == (n, removed, hashlib.sha256(kept.encode()).hexdigest())
