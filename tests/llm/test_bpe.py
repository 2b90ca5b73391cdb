import json

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from helpers import documents, empty, with_clashes
from tallyloom.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "plain words", "<|endoftext|> a<|endoftext|>b <|startoftext|>", "x\x1c y z é ́a 'S it's don't\r\n\tq", "ΑΣ ΟΔΟΣ'S",
    "İ ıI ſ K's I'S \x7f a\x7fb \x00 _a_ a_b 1_2 ¼² ªº µ \xa0\xad\x85", "a" * 70_000, ("abc " * 5 + "x" * 900 + "\n") * 200,
    "é" * 500 + " " + "漢字" * 40_000, "<|endoftext|>" * 9_000, "plain words", "word ab wordy wording words",
]


LIBRARY = Tokenizer.from_file(PATH)


@pytest.fixture
def plain():
    return LIBRARY


def check(plain, texts, found):
    for text, (ids, decoded) in zip(texts, found, strict=True):
        expected = plain.encode(text or "", add_special_tokens=False).ids
        assert bpe.unpacked(ids) == expected
        assert decoded == plain.decode(expected, skip_special_tokens=False)


def test_ids_and_texts_are_those_of_the_library(spark, plain):
    docs = with_clashes(documents(spark, ODD))
    rows = bpe.encode_decode(docs, PATH).orderBy("doc_id").collect()
    check(plain, ODD, [(bytes(r["ids"]), r["decoded"]) for r in rows])
    assert set(docs.columns) < set(rows[0].asDict())


def test_every_sample_document(spark, plain, sample_dir):
    docs = spark.read.parquet(f"{sample_dir}/documents.parquet").select("text")
    rows = bpe.encode_decode(docs, PATH).collect()
    check(plain, [r["text"] for r in rows], [(bytes(r["ids"]), r["decoded"]) for r in rows])


def test_columns_of_the_same_names_are_replaced(spark):
    row = bpe.encode_decode(documents(spark, ["ab"]).selectExpr("*", "1 as ids", "2 as decoded"), PATH).first()
    assert row["decoded"] == "ab</w>"


def test_empty_table(spark):
    assert bpe.encode_decode(empty(documents(spark, ["a"])), PATH).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="abtheinörst'sÉ \n\t1!漢<|>Σ", max_size=60), max_size=8))
def test_any_text(texts):
    check(LIBRARY, texts, bpe.encode_texts(bpe.load(PATH), texts))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_any_character(text):
    check(LIBRARY, [text], bpe.encode_texts(bpe.load(PATH), [text]))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aeinrst", min_size=1, max_size=40))
def test_long_words_take_their_own_branch(word):
    vocabulary = bpe.load(PATH)
    assert vocabulary.trie.encode_long(word, vocabulary) == vocabulary.trie.encode(word, vocabulary)


def test_shared_prefixes_are_encoded_once(monkeypatch):
    vocabulary = bpe.Vocabulary(PATH)
    vocabulary.trie.encode("zqxvkjb", vocabulary)
    nodes = len(vocabulary.trie.state)
    calls = []
    monkeypatch.setattr(vocabulary, "side_by_side", lambda a, b, f=vocabulary.side_by_side: calls.append((a, b)) or f(a, b))
    vocabulary.trie.encode("zqxvkjw", vocabulary)
    assert nodes == len(vocabulary.trie.state) == 6 and len(calls) <= vocabulary.longest


def test_memory_may_run_out(plain, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 3)
    texts = ["one two three four", "two five six", "one"]
    for part in (texts[:2], texts[2:], texts):
        check(plain, part, bpe.encode_texts(bpe.load(PATH), part))


def test_other_vocabularies_are_refused(tmp_path):
    spec = json.load(open(PATH, encoding="utf-8"))
    spec["model"]["dropout"] = 0.1
    (tmp_path / "v.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="not a BPE vocabulary"):
        bpe.Vocabulary(str(tmp_path / "v.json"))
