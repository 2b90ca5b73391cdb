"""Words of whole texts as arrays, for operators that slide windows over token sequences.

A batch of texts is joined into one byte buffer and split with array operations, so that no Python
object is made per word. Every word gets a 64-bit hash of its bytes, and a window of consecutive words
a hash of its word hashes; windows never cross from one text into the next.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

SPACES = (9, 10, 11, 12, 13, 32)
# Odd multipliers of the byte and window polynomials, one of each per independent hash.
BYTE_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
WINDOW_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def _space_table() -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(SPACES)] = True
    return table


def _lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def _mark_table() -> np.ndarray:
    """All of ASCII but digits and small letters (texts are lower-cased before it is used)."""
    table = np.zeros(256, bool)
    table[:128] = True
    table[48:58] = table[97:123] = False
    return table


IS_SPACE = _space_table()
IS_MARK = _mark_table()
LOWER = _lower_table()


@dataclass
class Words:
    """Words of a batch. ``starts`` and ``ends`` are byte offsets in ``data``; the words of text ``i``
    are those from ``first[i]`` up to ``first[i + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def of_text(self, i: int) -> list[bytes]:
        """Words of one text, as bytes."""
        raw = self.data
        return [
            raw[s:e].tobytes()
            for s, e in zip(self.starts[self.first[i] : self.first[i + 1]], self.ends[self.first[i] : self.first[i + 1]])
        ]


def split_words(texts: Sequence[str | None], lower: bool = False, between: np.ndarray = IS_SPACE) -> Words:
    """Maximal runs of bytes that are not ``between`` words (ASCII white space); a null text has none.

    ``lower`` turns A-Z into a-z first. Other letters stay as they are.
    """
    encoded = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join([*encoded, b""]) or b"\n", np.uint8)
    if lower:
        data = LOWER[data]
    begins = np.zeros(len(encoded) + 1, np.int64)
    np.cumsum([len(e) + 1 for e in encoded], out=begins[1:])
    space = between[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(data) and not space[0]:
        edge = np.concatenate(([0], edge))
    # The buffer ends with a separator, so runs come in pairs of start and end.
    starts, ends = edge[0::2], edge[1::2]
    return Words(data, starts, ends, np.searchsorted(starts, begins))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out) if n else out


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit hash over all others."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(words: Words, which: int = 0) -> np.ndarray:
    """64-bit hash of every word; ``which`` picks one of two independent families."""
    starts, ends = words.starts, words.ends
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = ends - starts
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    # Positions of all bytes that belong to words, and their place within the word.
    place = np.arange(total) - np.repeat(before, lengths)
    value = words.data[place + np.repeat(starts, lengths)].astype(np.uint64) + np.uint64(1)
    value *= powers(BYTE_BASES[which], int(lengths.max()))[place]
    return mix(np.add.reduceat(value, before) + lengths.astype(np.uint64))


def window_hashes(hashes: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """Hash of each run of ``size`` word hashes, by the position of its first word (across texts too)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j, p in enumerate(powers(WINDOW_BASES[which], size)):
        out += hashes[j : j + n] * p
    return mix(out)


def window_starts(words: Words, size: int) -> np.ndarray:
    """Numbers of the words at which a window of ``size`` words of one text starts."""
    counts = np.maximum(words.counts() - size + 1, 0)
    total = int(counts.sum())
    before = np.cumsum(counts) - counts
    return np.arange(total) - np.repeat(before, counts) + np.repeat(words.first[:-1], counts)
