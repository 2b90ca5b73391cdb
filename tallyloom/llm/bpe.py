"""BPE encoding and decoding of whole texts by a prefix-sharing trie.

Texts are cut into pieces the way the vocabulary file says: those of common Latin characters by one pattern, others by the library's own
normaliser and splitter, run between ASCII spaces and line feeds, which no piece, special string or normalisation reaches across. The
distinct new pieces of a batch go into a trie whose edges are symbols (the last symbol of a piece carries the end-of-word mark).
A depth-first walk gives every node its state, the last token of the encoding of the prefix that leads to it: what a prefix is encoded to doesn't depend on the words it belongs to, so it is worked out once
for all of them. A token can end a prefix if it is a suffix of it, and can stand after the last token of what lies before it; exactly one can.
Whether two tokens can stand side by side is read off the merges that made them: undone from the latest to the earliest, no pair across
the border may have a merge that comes before the one just undone. From the state at its end, a piece's tokens are read backwards.

The result per text is its ids, packed as little-endian unsigned 32-bit integers (as token files are), and the text they decode to.

Only vocabularies of the kind of ``word_bpe_49k.json`` are taken: bytes as symbols, an end-of-word suffix, every token made by one merge,
no truncation, padding, dropout or decoder; others raise an error.

Defined cases: a null or empty text has no ids and decodes to the empty text. Special strings in a text become their special token, as the
library does by default. The walk is linear in a piece's length, however long a text without spaces is. Rows, equal rows and
further columns stay; columns named ``ids`` or ``decoded`` are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from tallyloom.llm.common import new_name, one_thread

#: Pieces that a worker remembers, with their trie, before it starts anew; bounds its memory, not the result.
MEMO = 500_000
#: Prefixes up to this many symbols are nodes of the trie; longer words keep the states of their own branch only.
DEEPEST = 48
#: Texts that go through one trie.
TEXTS = 1000
#: Characters of texts that go through one trie, unless one text alone has more.
CHARS = 4_000_000
ID_BYTES = 4
NO_SYMBOL = "a symbol of the text is not in the vocabulary"
ENCODED = StructType([StructField("ids", BinaryType()), StructField("decoded", StringType())])


class Vocabulary:
    """Tokens and merges of a vocabulary file, and what has been found out about them."""

    def __init__(self, path: str):
        one_thread()
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ids: dict[str, int] = dict(model["vocab"])
        self.end: str = model.get("end_of_word_suffix") or ""
        plain = not (model.get("dropout") or model.get("continuing_subword_prefix") or model.get("ignore_merges") or spec.get("decoder"))
        made = [a + b if not self.end or not a.endswith(self.end) else None for a, b in merges]
        if not plain or not self.end or None in made or len(set(made)) != len(made) or any(m not in self.ids for m in made):
            raise ValueError(f"{path} is not a BPE vocabulary of the kind this operator takes")
        #: Rank and parts of the merge that makes a token; symbols have none.
        self.merge = {self.ids[t]: (rank, self.ids[a], self.ids[b]) for rank, (t, (a, b)) in enumerate(zip(made, merges))}
        self.rank = {(a, b): rank for rank, a, b in self.merge.values()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        # Lengths in symbols: the end mark belongs to the symbol before it.
        self.length = {i: len(t) - len(self.end) * t.endswith(self.end) for t, i in self.ids.items()}
        self.inner = {t: i for t, i in self.ids.items() if not t.endswith(self.end)}
        self.final = {t.removesuffix(self.end): i for t, i in self.ids.items() if t.endswith(self.end)}
        self.longest = max(self.length.values())
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        library = Tokenizer.from_file(path)
        self.normalise = library.normalizer.normalize_str
        self.pieces = library.pre_tokenizer.pre_tokenize_str
        self.forget()

    def forget(self) -> None:
        self.trie = Trie()
        self.fits: dict[tuple[int, int], bool] = {}
        #: Packed ids and decoded text of pieces and special tokens.
        self.known: dict[str | int, tuple[bytes, str]] = {}

    def side_by_side(self, left: int, right: int) -> bool:
        """Whether the text of both tokens together is encoded to just these two."""
        found = self.fits.get((left, right))
        if found is None:
            found = self.fits[left, right] = self._undo(left, right)
        return found

    def _undo(self, left: int, right: int) -> bool:
        # Merges run by rank, equal ones from the left: compare (rank, 0) on the left, (rank, 1) across and (rank, 2) on the right.
        last = (1 << 60, 0)
        while True:
            across = self.rank.get((left, right))
            if across is not None and (across, 1) < last:
                return False
            a, b = self.merge.get(left), self.merge.get(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and a[0] > b[0]):
                last, left = (a[0], 0), a[2]
            else:
                last, right = (b[0], 2), b[1]

    def has_special(self, text: str) -> bool:
        return any(special in text for special in self.special)

    def decode(self, ids: Iterable[int]) -> str:
        """What the library's ``decode`` gives: without a decoder, the tokens as they are, with spaces between."""
        return " ".join([self.text[i] for i in ids])


_loaded: dict[str, Vocabulary] = {}


def load(path: str) -> Vocabulary:
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


class Trie:
    """The trie of all words inserted so far, as a map from the path of each inner node (a prefix) to its state.

    Words are inserted in sorted order, which walks the trie depth first: each starts from the deepest node that is already there, and
    only the nodes below it get a state.
    """

    def __init__(self) -> None:
        self.state: dict[str, int] = {}

    def encodings(self, words: Iterable[str], vocabulary: Vocabulary) -> Iterator[tuple[str, list[int]]]:
        """Every word with its ids."""
        for word in sorted(words):
            yield word, (self.encode_long(word, vocabulary) if len(word) > DEEPEST else self.encode(word, vocabulary))

    def encode(self, word: str, vocabulary: Vocabulary) -> list[int]:
        state, inner, merge, length = self.state, vocabulary.inner, vocabulary.merge, vocabulary.length
        fits, undo, longest = vocabulary.fits, vocabulary.side_by_side, vocabulary.longest
        depth = len(word) - 1
        while depth and word[:depth] not in state:
            depth -= 1
        last = len(word) - 1
        while depth < last:
            depth += 1
            for size in range(min(depth, longest), 0, -1):
                token = inner.get(word[depth - size : depth])
                if token is None:
                    continue
                if size == depth:
                    if depth == 1 or token in merge:
                        break
                    continue
                pair = (state[word[: depth - size]], token)
                ok = fits.get(pair)
                if undo(*pair) if ok is None else ok:
                    break
            else:
                raise ValueError(NO_SYMBOL)
            state[word[:depth]] = token
        whole = len(word)
        for size in range(min(whole, longest), 0, -1):
            token = vocabulary.final.get(word[whole - size :])
            if token is None:
                continue
            if size == whole:
                return [token]
            pair = (state[word[: whole - size]], token)
            ok = fits.get(pair)
            if undo(*pair) if ok is None else ok:
                break
        else:
            raise ValueError(NO_SYMBOL)
        ids, at = [token], whole - size
        while at:
            token = state[word[:at]]
            ids.append(token)
            at -= length[token]
        ids.reverse()
        return ids

    def encode_long(self, word: str, vocabulary: Vocabulary) -> list[int]:
        """The same for a word that is too long for its prefixes to be kept: its states stand in a list by depth."""
        longest, whole = vocabulary.longest, len(word)
        states = [-1]
        for depth in range(1, whole + 1):
            tokens = vocabulary.final if depth == whole else vocabulary.inner
            for size in range(min(depth, longest), 0, -1):
                token = tokens.get(word[depth - size : depth])
                if token is not None and (size == depth or vocabulary.side_by_side(states[depth - size], token)):
                    states.append(token)
                    break
            else:
                raise ValueError(NO_SYMBOL)
        ids, at = [], whole
        while at:
            ids.append(states[at])
            at -= vocabulary.length[states[at]]
        ids.reverse()
        return ids


# White space and visible characters below U+0180: of texts of these, the normaliser changes capitals and white space only.
LATIN = re.compile("[\t\n\x0b\x0c\r\x20-\x7e\xa1-\xac\xae-\u012f\u0131-\u017f]*")
# In small letters, this cuts them into pieces.
LATIN_LETTER = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u017f"
LATIN_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
LATIN_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LATIN_LETTER}]+|[{LATIN_NUMBER}]|[^\\s{LATIN_LETTER}{LATIN_NUMBER}]+")


def byte_symbols() -> dict[int, str]:
    """The character that stands for each byte: visible ones of Latin-1 for themselves, the others from U+0100 on in turn."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in own]
    return {b: chr(0x100 + i) for i, b in enumerate(rest)}


BYTE_SYMBOLS = byte_symbols()


def symbols(piece: str) -> str:
    return piece if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(BYTE_SYMBOLS)


def plain_pieces(vocabulary: Vocabulary, text: str) -> list[str]:
    """Pieces of a text without special strings, before bytes become symbols."""
    if LATIN.fullmatch(text):
        return LATIN_PIECE.findall(text.lower())
    out: list[str] = []
    for chunk in text.replace("\n", " ").split(" "):
        if LATIN.fullmatch(chunk):
            out += LATIN_PIECE.findall(chunk.lower())
        else:
            normal = vocabulary.normalise(chunk)
            out += [normal[a:b] for _, (a, b) in vocabulary.pieces(normal)]
    return out


def cut(vocabulary: Vocabulary, text: str | None) -> list[str | int]:
    """Pieces of a text, and the ids of special strings between them."""
    if not text:
        return []
    if not vocabulary.has_special(text):
        return plain_pieces(vocabulary, text)
    out: list[str | int] = []
    for part in vocabulary.split_special.split(text):
        out += [vocabulary.special[part]] if part in vocabulary.special else plain_pieces(vocabulary, part)
    return out


def learn(vocabulary: Vocabulary, pieces: Iterable[str | int]) -> None:
    """Adds the ids and decoded text of new pieces to the memory."""
    known = vocabulary.known
    of_symbols = {symbols(piece): piece for piece in pieces if isinstance(piece, str)}
    for word, ids in vocabulary.trie.encodings(of_symbols, vocabulary):
        known[of_symbols[word]] = (packed(ids), vocabulary.decode(ids))
    for special in pieces:
        if isinstance(special, int):
            known[special] = (packed([special]), vocabulary.decode([special]))


def packed(ids: Iterable[int]) -> bytes:
    out = array("I", ids)
    assert out.itemsize == ID_BYTES
    if memoryview(b"\1\0\0\0").cast("I")[0] != 1:
        out.byteswap()
    return out.tobytes()


def unpacked(ids: bytes) -> list[int]:
    return [int.from_bytes(ids[i : i + ID_BYTES], "little") for i in range(0, len(ids), ID_BYTES)]


def encode_texts(vocabulary: Vocabulary, texts: list[str | None]) -> list[tuple[bytes, str]]:
    """Packed ids and decoded text of each text of a batch."""
    cuts = [cut(vocabulary, t) for t in texts]
    new = set().union(*cuts) - vocabulary.known.keys()
    if len(vocabulary.known) + len(new) > MEMO or len(vocabulary.trie.state) > 2 * MEMO:
        vocabulary.forget()
        new = set().union(*cuts)
    learn(vocabulary, new)
    of, out = vocabulary.known.__getitem__, []
    for pieces in cuts:
        found = list(map(of, pieces))
        out.append((b"".join([f[0] for f in found]), " ".join([f[1] for f in found])))
    return out


def encoded(text: Column, path: str) -> Column:
    """Struct of ``ids`` and ``decoded`` of a text column, by the vocabulary file at ``path`` (a place every executor has)."""

    @F.pandas_udf(ENCODED)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        vocabulary = load(path)
        for batch in batches:
            out: list[tuple[bytes, str]] = []
            group: list[str | None] = []
            chars = 0
            for t in batch:
                text = t if isinstance(t, str) else None
                if group and (len(group) >= TEXTS or chars + len(text or "") > CHARS):
                    out += encode_texts(vocabulary, group)
                    group, chars = [], 0
                group.append(text)
                chars += len(text or "")
            out += encode_texts(vocabulary, group)
            yield pd.DataFrame(out, columns=["ids", "decoded"])

    return run(text)


def encode_decode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (packed) and ``decoded``."""
    both = new_name("_encoded", docs.columns)
    return docs.withColumn(both, encoded(F.col(text), path)).withColumns(
        {"ids": F.col(both)["ids"], "decoded": F.col(both)["decoded"]}
    ).drop(both)


def token_count(ids: Column) -> Column:
    return F.floor(F.octet_length(ids) / ID_BYTES).cast("long")
