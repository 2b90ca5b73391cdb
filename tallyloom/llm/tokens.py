"""Token counts of whole texts by overlap resynchronisation.

A huge text is encoded in overlapping chunks, each with the offsets of its tokens, and the encodings are
spliced at a boundary that is proven stable. The tokenizer drops white space and matches its pieces within
runs that hold none; neither do its normaliser or its special strings reach across an ASCII space or line
feed. So the encoding of a text is that of what stands before such a character followed by that
of what stands after it, and two chunks that both contain the character agree from there on. The same holds between
a full-width punctuation mark and a kana or Han letter, as written without spaces: pieces are runs of letters or runs of
marks, no such pair composes into one character, neither of the two has case or is passed over when the form of a sigma is
chosen, and no special string holds either.

Chunks begin and end at boundaries, which are looked for in the text before anything is encoded. Two neighbours share a stretch
between two boundaries, and the splice checks that they have equal tokens there. If they don't, the
overlap is widened, in the end to the whole of both chunks; the next ones are then as long as what they came to, so
that the work stays in proportion to the text. A text that has no boundary, a single word of a million letters, is encoded whole, once.

Other texts need no splice. By the same rule their count is the sum over their space-separated words, and
the words of a batch are encoded once each and remembered.

Defined cases: a null or empty text has no tokens; rows, equal rows and further columns stay as they are;
an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tallyloom.llm.common import one_thread

HUGE_CHARS = 65_536
CHUNK_CHARS = 32_768
OVERLAP_CHARS = 256
#: Words that a worker remembers before it starts anew; bounds its memory, not the result.
MEMO_WORDS = 500_000

_loaded: dict[str, tuple[Any, dict[str, int]]] = {}


def load(path: str) -> tuple[Any, dict[str, int]]:
    """Tokenizer of a vocabulary file and this process's memory of word lengths."""
    if path not in _loaded:
        one_thread()
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _loaded[path] = (tokenizer, {"": 0})
    return _loaded[path]


def encode_chunk(tokenizer: Any, text: str, start: int, end: int) -> list[tuple[int, int, int]]:
    """(id, start, end) of the tokens of ``text[start:end]``, by offsets in the whole text."""
    found = tokenizer.encode(text[start:end], add_special_tokens=False)
    return [(i, a + start, b + start) for i, (a, b) in zip(found.ids, found.offsets)]


#: Places where encodings may be cut: after an ASCII space or line feed, and between a full-width mark and a letter. Letters
#: are hiragana, katakana and Han without those that compose with what stands before them.
BOUNDARY = re.compile("(?<=[ \\n])|(?<=[\u3001\u3002\uff01\uff0c\uff1a\uff1b\uff1f])(?=[\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fff])")


def chunk_ends(text: str, start: int, chunk: int, overlap: int) -> tuple[int, int]:
    """Where the chunk from ``start`` on ends, and where the next one begins.

    Both are boundaries with more than white space between them, the first at or behind ``start + chunk``. The end of
    the text twice, where there are no such boundaries.
    """
    target, size = start + chunk, len(text)
    if target >= size:
        return size, size
    back, seen, blank = None, 0, True
    for found in BOUNDARY.finditer(text, max(start + 1, target - overlap)):
        at = found.start()
        if back is None:
            back = at
        else:
            blank = blank and text[seen:at].isspace()
            if at >= target and not blank:
                return at, back
        seen = at
    return size, size


def splice_point(
    left: list[tuple[int, int, int]], right: list[tuple[int, int, int]], first: int, last: int
) -> tuple[int, int] | None:
    """How many tokens of ``left`` to keep and of ``right`` to drop, or None if the two don't align.

    They align if their tokens between the two boundaries are equal.
    """
    kept, dropped = 0, 0
    for kept in range(len(left), -1, -1):
        if kept == 0 or left[kept - 1][2] <= first:
            break
    while dropped < len(right) and right[dropped][2] <= first:
        dropped += 1
    shared = [t for t in left[kept:] if t[2] <= last]
    again = []
    for token in right[dropped:]:
        if token[2] > last:
            break
        again.append(token)
    return (kept, dropped) if shared and shared == again else None


def encode_huge(
    tokenizer: Any, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS
) -> list[tuple[int, int, int]]:
    """Tokens of a whole text with their offsets, encoded chunk by chunk."""
    settled: list[tuple[int, int, int]] = []  # all before the latest chunk
    start = 0
    end, begin = chunk_ends(text, start, chunk, overlap)
    tokens = encode_chunk(tokenizer, text, start, end)
    while end < len(text):
        stop, following = chunk_ends(text, begin, chunk, overlap)
        back, wide = begin, end - begin
        while True:
            more = encode_chunk(tokenizer, text, back, stop)
            cut = splice_point(tokens, more, back, end)
            if cut is not None:
                settled += tokens[: cut[0]]
                tokens, start = more[cut[1] :], back
                break
            wide *= 2
            found = BOUNDARY.search(text, max(start + 1, end - wide), back) if end - wide > start else None
            if found is None:  # as wide as the chunk itself: both become one
                tokens = encode_chunk(tokenizer, text, start, stop)
                chunk = max(chunk, stop - start)
                break
            back = found.start()
        end, begin = stop, following
    return settled + tokens


def count_batch(texts: list[str | None], path: str, huge: int = HUGE_CHARS) -> list[int]:
    """Tokens of each text of a batch."""
    tokenizer, memo = load(path)
    words = [None if t is None or len(t) >= huge else t.replace("\n", " ").split(" ") for t in texts]
    new = {w for of_text in words if of_text for w in of_text if w not in memo}
    if len(memo) + len(new) > MEMO_WORDS:
        memo.clear()
        memo[""] = 0
        new = {w for of_text in words if of_text for w in of_text if w}
    listed = list(new)
    for i in range(0, len(listed), 4096):
        part = listed[i : i + 4096]
        for word, found in zip(part, tokenizer.encode_batch_fast(part, add_special_tokens=False)):
            memo[word] = len(found)
    counts = []
    for text, of_text in zip(texts, words):
        if of_text is not None:
            counts.append(sum(map(memo.__getitem__, of_text)))
        else:
            counts.append(0 if text is None else len(encode_huge(tokenizer, text)))
    return counts


def token_count(text: Column, path: str, huge: int = HUGE_CHARS) -> Column:
    """Number of tokens of a text column by the vocabulary file at ``path`` (a place every executor has)."""

    @F.pandas_udf(LongType())
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out: list[int] = []
            for i in range(0, len(batch), 1000):
                out += count_batch([t if isinstance(t, str) else None for t in batch.iloc[i : i + 1000]], path, huge)
            yield pd.Series(out, dtype="int64")

    return counted(text)


def count_tokens(docs: DataFrame, path: str, limit: int, text: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``; columns of these names are replaced."""
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long")
    counted = docs.withColumns({"n_bytes": size, "n_tokens": token_count(F.col(text), path)})
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
