import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from helpers import documents, empty, with_clashes
from tallyloom.llm import tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "plain words", "<|endoftext|> a<|endoftext|>b <|startoftext|>", "x\x1c y z é ́a 'S it's don't\r\n\tq",
    "ΑΣ ΟΔΟΣ'S", "a" * 70_000, ("abc " * 5 + "x" * 900 + "\n") * 200, "é" * 500 + " " + "漢字" * 40_000, "<|endoftext|>" * 9_000,
    "plain words",
]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


def test_counts_are_those_of_the_library(spark, plain):
    docs = with_clashes(documents(spark, ODD))
    rows = tokens.count_tokens(docs, PATH, 2048).orderBy("doc_id").collect()
    assert len(rows) == len(ODD)
    for row, text in zip(rows, ODD):
        n = len(plain.encode(text or "", add_special_tokens=False))
        assert (row["n_tokens"], row["n_bytes"]) == (n, len((text or "").encode()))
        assert row["over_limit"] == (n > 2048)


def test_empty_table(spark):
    assert tokens.count_tokens(empty(documents(spark, ["a"])), PATH, 1).collect() == []


@pytest.mark.parametrize("overlap", [2, 16, 64])
def test_splices_equal_one_encoding(plain, overlap):
    for text in [t for t in ODD if t and len(t) < 30_000] + ["word " * 3_000, "wörd's 12,5 " * 400]:
        whole = plain.encode(text, add_special_tokens=False)
        found = tokens.encode_huge(plain, text, chunk=200, overlap=overlap)
        assert [t[0] for t in found] == whole.ids
        assert [t[1:] for t in found] == whole.offsets


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab'sé \n\t1!漢<|>Σ", max_size=300))
def test_splices_of_any_text(text):
    tokenizer, _ = tokens.load(PATH)
    whole = tokenizer.encode(text, add_special_tokens=False)
    assert [t[0] for t in tokens.encode_huge(tokenizer, text, chunk=24, overlap=4)] == whole.ids
    assert tokens.count_batch([text], PATH) == [len(whole.ids)]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="漢字かゞ゙がカー。、！，？：； a'Σσ\u0301é1<|\n\u3000", max_size=200))
def test_splices_without_spaces(text):
    tokenizer, _ = tokens.load(PATH)
    whole = tokenizer.encode(text, add_special_tokens=False)
    found = tokens.encode_huge(tokenizer, text, chunk=16, overlap=4)
    assert [t[0] for t in found] == whole.ids
    assert [t[1:] for t in found] == whole.offsets


def test_every_boundary_of_marks_and_letters_is_stable(plain):
    letters = [chr(c) for a, b in ((0x3041, 0x3097), (0x30A1, 0x30FB), (0x4E00, 0x4E40), (0x9FE0, 0xA000)) for c in range(a, b)]
    for mark in "、。！，：；？":
        for before in ("", "漢", "aΣ", "'", "1", "<|endoftext|>", "!"):
            for letter in letters:
                left, right = before + mark, letter + "字a"
                assert tokens.BOUNDARY.search(left + right, len(left), len(left) + 1).start() == len(left)
                parts = [plain.encode(t, add_special_tokens=False).ids for t in (left, right)]
                assert plain.encode(left + right, add_special_tokens=False).ids == parts[0] + parts[1]


class Counting:
    """A tokenizer that counts the characters it is given, and may be told to disagree with itself."""

    def __init__(self, tokenizer, unsteady=()):
        self.tokenizer, self.seen, self.calls, self.unsteady = tokenizer, 0, 0, unsteady

    def encode(self, text, add_special_tokens):
        self.seen += len(text)
        self.calls += 1
        if self.calls in self.unsteady:
            return self.tokenizer.encode(text.replace("a", "b"), add_special_tokens=False)
        return self.tokenizer.encode(text, add_special_tokens=add_special_tokens)


@pytest.mark.parametrize(
    "unit, most",
    [("ab" * 50_000, 1), ("漢字仮名" * 30 + "。", 1.1), ("a ", 1.1), ("word wörd\n", 1.1), ("<|endoftext|>", 1), ("。", 1), (" ", 1),
     ("x" * 70_000 + " ", 2)],  # a word longer than a chunk is the overlap of two
)
def test_work_is_linear(plain, unit, most):
    for size in (100_000, 400_000):
        text = (unit * (size // len(unit) + 1))[:size]
        counting = Counting(plain)
        found = tokens.encode_huge(counting, text)
        assert [t[0] for t in found] == plain.encode(text, add_special_tokens=False).ids
        assert counting.seen <= most * size


@pytest.mark.parametrize("unsteady", [{2}, {2, 3}, {2, 3, 4, 5}, {3}])
def test_overlaps_widen_where_encodings_differ(plain, unsteady):
    text = "banana bandana cabana " * 300
    whole = plain.encode(text, add_special_tokens=False)
    counting = Counting(plain, unsteady)
    found = tokens.encode_huge(counting, text, chunk=1000, overlap=30)
    # An encoding that was not taken leaves no trace.
    assert [t[0] for t in found] == whole.ids
    assert [t[1:] for t in found] == whole.offsets


def test_memory_of_words_may_run_out(plain, monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_WORDS", 3)
    texts = ["one two three four", "two five six", "one"]
    assert tokens.count_batch(texts, PATH) == [len(plain.encode(t, add_special_tokens=False)) for t in texts]
