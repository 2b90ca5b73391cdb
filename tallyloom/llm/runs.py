"""Periodic runs of words, by string synchronising sets.

A run is a stretch of at least 12 words, and at least two periods, that repeats with a smallest period and can't be extended either
way. All runs of a text are found, and the copies after each run's first period can be dropped.

*Highly periodic regions.* Periods below 12 are read off directly: words equal to the one q places on, in unbroken stretches. Stretches of three
periods and more also count as highly periodic regions of the scales above.

*Synchronising sets.* Scale t = 4, 8, 16, ... looks for periods from 3t up to 6t. Every place has a hash of the t words from there on; places
whose t words have a period of at most t/3 have none, as they lie in regions that are known by then. A place is
selected if the smallest hash of the t + 1 places from there on stands at the first or the last of them. So whether a place is
selected depends on its context of 2t words alone, and about two of t places are. Of a run with such a period, some selected place and
the one a period later have the same context: if all hashes were missing in the first period, its words would
have a period of at most t/3, and by Fine and Wilf so would the run.

*Pairs.* Selected places of equal context propose their distance if it is in the scale's range. Contexts aren't highly periodic, so the same one can't
recur within t/3 places, and a place has at most 18 partners in range. Word by word, a proposal is then extended to both sides as far as it holds. A
stretch that a smaller period explains has been found before.

Hashes only propose; what is compared are numbers that stand for words within a batch, so results are exact. The work is in
proportion to a text's words times the number of scales. A text is one unit of work; texts are spread over tasks as they lie.

Defined cases: a null or empty text, or one below 12 words, has no runs (its words still come back, joined by a space). Words are cut
at ASCII white space only and compared byte by byte. Rows, equal rows and further columns stay; columns named ``runs`` or
``collapsed`` are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tallyloom.llm.common import new_name
from tallyloom.llm.words import mix

MIN_WORDS = 12
FIRST_SCALE = 4
#: Texts of a batch have about this many characters together, unless one alone has more.
CHARS = 2_000_000
NONE = np.uint64(np.iinfo(np.uint64).max)
MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
RUN = StructType([StructField(c, LongType()) for c in ("start", "length", "period")])
FOUND = StructType([StructField("runs", ArrayType(RUN)), StructField("collapsed", StringType())])

Run = tuple[int, int, int]


def numbers(texts: list[list[bytes]]) -> np.ndarray:
    """The words of all texts as numbers, equal for equal words; after each text stands a number of its own."""
    distinct = {w: i for i, w in enumerate(set().union(*texts))}
    of, out, fresh = distinct.__getitem__, [], len(distinct)
    for words in texts:
        out += map(of, words)
        out.append(fresh)
        fresh += 1
    return np.array(out, np.int64)


def least(length: int, period: int) -> bool:
    return length >= max(MIN_WORDS, 2 * period)


class Batch:
    """Texts put together, with the stretches found so far as (first place, place after the last) -> smallest period."""

    def __init__(self, texts: list[list[bytes]]):
        self.words = numbers(texts)
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.sizes + 1)))[:-1]
        self.found: dict[tuple[int, int], int] = {}

    def add(self, start: int, end: int, period: int) -> None:
        self.found.setdefault((start, end), period)

    # small periods

    def small_periods(self) -> None:
        for q in range(1, 3 * FIRST_SCALE):
            same = np.flatnonzero(self.words[:-q] == self.words[q:])
            # As many equal pairs in a row as the shortest stretch has that is of use.
            need = min(max(3 * q, FIRST_SCALE), max(MIN_WORDS, 2 * q)) - q
            if len(same) < need:
                continue
            breaks = np.flatnonzero(np.diff(same) != 1) + 1
            starts, ends = np.concatenate(([0], breaks)), np.concatenate((breaks, [len(same)]))
            for i in np.flatnonzero(ends - starts >= need):
                self.add(int(same[starts[i]]), int(same[ends[i] - 1]) + 1 + q, q)

    # larger ones

    def scales(self) -> None:
        """All scales, each over the texts that have room for two of its periods."""
        kept = np.arange(len(self.sizes))
        places = np.arange(len(self.words))
        hashes = mix(self.words.astype(np.uint64) * MULTIPLIERS[0] + MULTIPLIERS[1])
        width, scale = 1, FIRST_SCALE
        while True:
            enough = self.sizes[kept] >= 6 * scale
            if not enough.any():
                return
            if not enough.all():
                stay = np.repeat(enough, self.sizes[kept] + 1)
                places, hashes, kept = places[stay], hashes[stay], kept[enough]
            while width < scale:
                hashes, width = doubled(hashes, width), 2 * width
            contexts = doubled(hashes, scale)
            self.propose(scale, kept, places, hashes, contexts)
            hashes, width, scale = contexts, 2 * width, 2 * scale

    def propose(self, scale: int, kept: np.ndarray, places: np.ndarray, hashes: np.ndarray, contexts: np.ndarray) -> None:
        ids = hashes
        regions = [(a, b) for (a, b), q in self.found.items() if 3 * q <= scale <= b - a]
        if regions:
            ids = hashes.copy()
            # Texts were left out, so places in what is left are counted anew; those of a text stay together.
            begin = np.concatenate(([0], np.cumsum(self.sizes[kept] + 1)))
            of_text = np.searchsorted(self.first, [a for a, _ in regions], "right") - 1
            at = np.searchsorted(kept, of_text)
            for (a, b), text, i in zip(regions, of_text, at):
                if i < len(kept) and kept[i] == text:
                    move = int(begin[i] - self.first[text])
                    ids[a + move : b - scale + 1 + move] = NONE
        chosen = selected(ids, scale)
        context = contexts[chosen]
        order = np.argsort(context, kind="stable")
        context, place = context[order], places[chosen][order]
        proposals = []
        lag = 1
        while lag < len(place):
            alike = np.flatnonzero(context[:-lag] == context[lag:])
            distance = place[alike + lag] - place[alike]
            near = distance < 6 * scale
            if not near.any():
                break
            good = near & (distance >= 3 * scale)
            proposals.append(np.stack((distance[good], place[alike[good]]), 1))
            lag += 1
        if proposals:
            self.extend(np.unique(np.concatenate(proposals), axis=0))

    def extend(self, proposals: np.ndarray) -> None:
        """Proposals (distance, place) in order, each extended word by word unless the stretch before already has it."""
        known, until = 0, -1
        for period, place in proposals.tolist():
            if period == known and place < until:
                continue
            start, end = stretch(self.words, place, period)
            known, until = period, end
            if least(end + period - start, period):
                self.add(start, end + period, period)

    def runs(self) -> list[list[Run]]:
        """Per text the runs (start, length, period), by start, then period."""
        out: list[list[Run]] = [[] for _ in self.sizes]
        listed = [(a, b - a, q) for (a, b), q in self.found.items() if least(b - a, q)]
        texts = np.searchsorted(self.first, [a for a, _, _ in listed], "right") - 1
        for (a, length, q), text in zip(listed, texts):
            out[text].append((a - int(self.first[text]), length, q))
        for found in out:
            found.sort(key=lambda r: (r[0], r[2]))
        return out


def doubled(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of twice as many words; at the end, where there are none, the single hashes."""
    out = hashes.copy()
    if len(hashes) > width:
        out[:-width] = mix(hashes[:-width] * MULTIPLIERS[0] + hashes[width:] * MULTIPLIERS[1])
    return out


def selected(ids: np.ndarray, scale: int) -> np.ndarray:
    """Places whose window of ``scale`` + 1 ids has its smallest at the first or the last of them."""
    if len(ids) <= scale:
        return np.empty(0, np.int64)
    lowest, width = ids, 1
    while width < scale:
        lowest, width = np.minimum(lowest[:-width], lowest[width:]), 2 * width
    last = ids[scale:]
    lowest = np.minimum(lowest[: len(last)], last)
    return np.flatnonzero(((lowest == ids[: len(last)]) | (lowest == last)) & (lowest != NONE))


def stretch(words: np.ndarray, place: int, period: int) -> tuple[int, int]:
    """The places around ``place``, as (first, after the last), whose word equals the one a period later."""
    end, step = place, 2 * period
    while end + period < len(words):
        stop = min(end + step, len(words) - period)
        differ = words[end:stop] != words[end + period : stop + period]
        if differ.any():
            end += int(differ.argmax())
            break
        end, step = stop, 2 * step
    start, step = place, 2 * period
    while start:
        stop = max(start - step, 0)
        differ = words[stop:start] != words[stop + period : start + period]
        if differ.any():
            start -= int(differ[::-1].argmax())
            break
        start, step = stop, 2 * step
    return start, max(start, end)


def kept_words(words: list[bytes], runs: Iterable[Run]) -> list[bytes]:
    """Words without those that stand in a run after its first period."""
    stay = None
    for start, length, period in runs:
        if stay is None:
            stay = np.ones(len(words), bool)
        stay[start + period : start + length] = False
    return words if stay is None else [words[i] for i in np.flatnonzero(stay)]


def run_batch(texts: list[str | None]) -> list[tuple[list[Run], str]]:
    # bytes.split() cuts at exactly the six ASCII characters of white space.
    words = [[] if t is None else t.encode("utf-8", "surrogatepass").split() for t in texts]
    batch = Batch(words)
    batch.small_periods()
    batch.scales()
    found = batch.runs()
    return [(r, b" ".join(kept_words(w, r)).decode("utf-8", "surrogatepass")) for w, r in zip(words, found)]


def with_runs(text: Column) -> Column:
    """Struct of ``runs`` and ``collapsed`` (the text without the copies in its runs) of a text column."""

    @F.pandas_udf(FOUND)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = RUN.names
        for batch in batches:
            out: list[tuple[list[Run], str]] = []
            group: list[str | None] = []
            chars = 0
            for t in batch:
                text = t if isinstance(t, str) else None
                if group and chars + len(text or "") > CHARS:
                    out += run_batch(group)
                    group, chars = [], 0
                group.append(text)
                chars += len(text or "")
            out += run_batch(group)
            listed = [[dict(zip(names, r)) for r in runs] for runs, _ in out]
            yield pd.DataFrame({"runs": listed, "collapsed": [c for _, c in out]})

    return run(text)


def find_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``runs`` (start, length and period in words, by start, then period) and ``collapsed``."""
    both = new_name("_runs", docs.columns)
    found = docs.withColumn(both, with_runs(F.col(text)))
    return found.withColumns({"runs": F.col(both)["runs"], "collapsed": F.col(both)["collapsed"]}).drop(both)


def longest(runs: Column) -> Column:
    """Start, length, period and ``exponent_milli`` of the longest run, the first and shortest-periodic of these; null if there is none."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    return F.when(
        F.size(runs) > 0,
        F.struct(
            (-best["s"]).alias("start"),
            best["l"].alias("length"),
            (-best["p"]).alias("period"),
            F.floor(best["l"] * 1000 / -best["p"]).cast("long").alias("exponent_milli"),
        ),
    )


def listing(runs: Column) -> Column:
    """``start,length,period`` and a line feed for each run."""
    line = lambda r: F.concat_ws(",", *[r[c].cast("string") for c in RUN.names])
    return F.concat_ws("", F.transform(runs, lambda r: F.concat(line(r), F.lit("\n"))))


def repeated_from(words: list[bytes], code: int) -> list[bytes]:
    """From some word on, a stretch whose length the code also sets, over and over."""
    n, g = len(words), code // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def planted(doc_id: Column, text: Column) -> Column:
    """The text, or for ids whose CRC-32 ten divides, the text with words repeated from one of its words on."""

    @F.pandas_udf(StringType())
    def plant(codes: pd.Series, texts: pd.Series) -> pd.Series:
        out = texts.copy()
        for i in np.flatnonzero((codes % 10 == 0) & (codes >= 0) & texts.notna()):
            words = texts.iat[i].encode("utf-8", "surrogatepass").split()
            if words:
                out.iat[i] = b" ".join(repeated_from(words, int(codes.iat[i]))).decode("utf-8", "surrogatepass")
        return out

    return plant(F.coalesce(F.crc32(doc_id.cast("string")), F.lit(-1).cast("long")), text)
