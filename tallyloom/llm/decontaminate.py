"""Benchmark decontamination by spaced-seed hashing.

A seed is a window of ``SPAN`` words of which a fixed mask ignores some, so that two windows have the same hash although the
ignored words differ. All seeds of the benchmark are an index table. All seeds of every document are looked up
first in a bitmap of the index, whose size is bounded whatever the benchmark's; what passes is joined with the index by
mask and hash. A hit gives the offset between document and item. Along it the words are compared one by one, and a stretch
is a leak if it has ``MIN_WORDS`` words, or all of the item if that has fewer, and at least ``MIN_SHARE`` of them are
equal. The stretch reported is the best one (an equal word counts 1, a differing one -3) if it is a leak, as it leaves out
what only surrounds a copy; otherwise the longest one of which enough words are equal.

Items of fewer words than a seed are looked up whole: by the hash of all their words, in windows of as many words. A document
that holds one of them is a leak if it has it word for word, and the first place of it is taken.

The masks find every stretch of 13 words or more of which at least ``MIN_SHARE`` are equal, wherever the others stand (up to 60 words by
tests of all patterns; longer ones have such a stretch in them or more equal words in a row than a seed has). Words are runs of digits, letters
a-z (A-Z in lower case) and characters beyond ASCII.

Defined cases: a null or empty text, and an item without words, has no leaks. Null ids and equal rows are
documents and items of their own. An empty benchmark or an empty table gives no rows. If the index outgrows the bitmap, more
seeds than needed are joined; the result is the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import keep, new_name
from tallyloom.llm.words import IS_MARK, WINDOW_BASES, mix, powers, split_words, window_hashes, window_starts, word_hashes

# 1 marks the words that count.
MASKS = ("00111111", "01101111", "11010111", "11111001", "10111010")
SPAN = len(MASKS[0])
MIN_WORDS = 13
MIN_SHARE = 0.8
MISMATCH = 3
#: Equal words that make up for a differing one at ``MIN_SHARE``.
MAKES_UP = 4
#: Parts that the items found in one document are dealt to.
ITEM_PARTS = 16
#: Places that a seed takes in the bitmap, places of the bitmap per seed, and its largest size (as a power of two).
PROBES = 3
PLACES_PER_SEED = 256
MAX_PLACE_BITS = 26


def seeds(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place in its words, hash per mask) of all windows of a batch."""
    words = split_words(texts, lower=True, between=IS_MARK)
    at = window_starts(words, SPAN)
    if not len(at):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty((len(MASKS), 0), np.uint64)
    hashes, weights = word_hashes(words), powers(WINDOW_BASES[0], SPAN)
    found = np.zeros((len(MASKS), len(at)), np.uint64)
    shifted = [hashes[at + j] * weights[j] for j in range(SPAN)]
    for m, mask in enumerate(MASKS):
        for j in range(SPAN):
            if mask[j] == "1":
                found[m] += shifted[j]
        found[m] = mix(found[m])
    text = words.text_of_word()[at]
    return text, at - words.first[text], found


def whole_windows(texts: list[str | None], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place in its words, hash) of all windows of ``size`` words of a batch, none of them left out."""
    words = split_words(texts, lower=True, between=IS_MARK)
    at = window_starts(words, size)
    text = words.text_of_word()[at]
    return text, at - words.first[text], window_hashes(word_hashes(words), size)[at]


def short_mask(size: int) -> int:
    """The number that stands for whole windows of ``size`` words, after those of the masks."""
    return len(MASKS) + size - 1


def seed_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(item, place, mask, hash) of the benchmark's seeds; an item shorter than a seed has one of all its words."""
    for batch in batches:
        texts = [t if isinstance(t, str) else None for t in batch["text"]]
        items = batch["item"].to_numpy()
        n_words = split_words(texts, lower=True, between=IS_MARK).counts()
        for size in range(1, SPAN):
            short = np.flatnonzero(n_words == size)
            if len(short):
                _, place, found = whole_windows([texts[i] for i in short], size)
                yield pd.DataFrame(
                    {"item": items[short], "place": place, "mask": np.int32(short_mask(size)), "hash": found.view(np.int64)}
                )
        text, place, found = seeds(texts)
        for m in range(len(MASKS)):
            yield pd.DataFrame(
                {"item": items[text], "place": place, "mask": np.int32(m), "hash": found[m].view(np.int64)}
            )


def place_shifts(bits: int) -> list[int]:
    """How far a hash is shifted right for each of its places, so that they come from different bits of it."""
    return [64 - bits - j * (64 - MAX_PLACE_BITS) // (PROBES - 1) for j in range(PROBES)]


def bitmap(index: DataFrame) -> np.ndarray:
    """Bits of the places that hashes of the index take; combined by Spark, so the driver gets the bitmap only."""
    wanted = max(index.count(), 1) * PLACES_PER_SEED
    bits = min(MAX_PLACE_BITS, max(16, int(wanted - 1).bit_length()))
    mask = F.lit((1 << bits) - 1).cast("long")
    places = F.array(*[F.shiftrightunsigned("hash", s).bitwiseAND(mask) for s in place_shifts(bits)])
    words = (
        index.select(F.explode(places).alias("place"))
        .groupBy(F.shiftrightunsigned("place", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, int(place % 64)))").alias("bits"))
        .toPandas()
    )
    out = np.zeros((1 << bits) // 64, np.int64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return out


def passes(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """TRUE for hashes all of whose places are taken."""
    bits = (len(table) * 64).bit_length() - 1
    flat = hashes.reshape(-1)
    out, alive = np.zeros(flat.shape, bool), np.arange(flat.size)
    for s in place_shifts(bits):
        place = ((flat[alive] >> np.uint64(s)) & np.uint64((1 << bits) - 1)).view(np.int64)
        alive = alive[(table[place >> 6] >> (place & 63)) & 1 == 1]
    out[alive] = True
    return out.reshape(hashes.shape)


def passing(
    table: np.ndarray, text: np.ndarray, place: np.ndarray, hashes: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kept = passes(table, hashes)
    return text[kept], place[kept], hashes[kept]


def first_of_each(text: np.ndarray, place: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first place of each hash in each text, as a word may stand in a text many times; windows come in their order."""
    order = np.lexsort((place, hashes, text))
    text, place, hashes = text[order], place[order], hashes[order]
    fresh = np.ones(len(text), bool)
    fresh[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    return text[fresh], place[fresh], hashes[fresh]


def best_stretch(equal: np.ndarray) -> tuple[int, int]:
    """(start, end) of the stretch with the largest sum of 1 per equal word and -MISMATCH per other; the first of equal ones."""
    total = np.concatenate(([0], np.cumsum(np.where(equal, 1, -MISMATCH))))
    gain = total - np.minimum.accumulate(total)
    end = int(gain.argmax())
    # The start is the last place before the end where the sum was as low as it gets.
    start = int(np.flatnonzero(total[: end + 1] == total[end] - gain[end])[-1])
    return start, end


def longest_stretch(equal: np.ndarray) -> tuple[int, int]:
    """(start, end) of the longest stretch with at least ``MIN_SHARE`` equal words; the first of equally long ones."""
    total = np.concatenate(([0], np.cumsum(np.where(equal, 1, -MAKES_UP))))
    # A stretch has the share if the sum does not fall over it. The first place as low as its end starts the longest.
    starts = np.searchsorted(-np.minimum.accumulate(total), -total)
    end = int((np.arange(len(total)) - starts).argmax())
    return int(starts[end]), end


def verify(doc: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int, int] | None:
    """(start in the document, start in the item, words, equal words) of the leak along ``shift``, or None."""
    low, high = max(0, -shift), min(len(item), len(doc) - shift)
    if high <= low:
        return None
    equal = item[low:high] == doc[low + shift : high + shift]
    if len(item) < SPAN:
        whole = len(equal) == len(item) and equal.all()
        return (low + shift, low, len(item), len(item)) if whole else None
    for stretch in (best_stretch, longest_stretch):
        start, end = stretch(equal)
        n, same = end - start, int(equal[start:end].sum())
        if n >= min(MIN_WORDS, len(item)) and same >= MIN_SHARE * n:
            return low + shift + start, low + start, n, same
    return None


def word_numbers(text: str, known: dict[bytes, int]) -> np.ndarray:
    """Words as numbers, equal for equal words; ``known`` has those so far."""
    words = split_words([text], lower=True, between=IS_MARK).of_text(0)
    return np.array([known.setdefault(w, len(known)) for w in words], np.int64)


def best_leak(doc: np.ndarray, item: np.ndarray, shifts: np.ndarray) -> tuple[int, int, int, int] | None:
    """The leak with the most equal words, the first of these, over all shifts of an item."""
    least = MIN_SHARE * min(MIN_WORDS, len(item))
    best = None
    for shift in shifts.tolist():
        low, high = max(0, -shift), min(len(item), len(doc) - shift)
        # Most shifts have no more in common than the seed that led to them.
        if high - low < least or np.count_nonzero(item[low:high] == doc[low + shift : high + shift]) < least:
            continue
        found = verify(doc, item, shift)
        if found and (best is None or (-found[3], found[0]) < (-best[3], best[0])):
            best = found
    return best


def verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ("doc_start", "item_start", "n_words", "n_equal")
    for batch in batches:
        rows = []
        for row, text, candidates in zip(batch["row"], batch["text"], batch["candidates"]):
            known: dict[bytes, int] = {}
            doc = word_numbers(text, known)
            for candidate in candidates:
                item = word_numbers(candidate["item_text"], known)
                found = best_leak(doc, item, np.asarray(candidate["shifts"], np.int64))
                if found:
                    rows.append((row, int(candidate["item"]), *found))
        yield pd.DataFrame(rows, columns=["row", "item", *names]).astype("int64")


def leaks(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(key, item, doc_start, item_start, n_words, n_equal): the best leak of every pair of a document and an item."""
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(text).alias("text"))
    found = row_leaks(numbered, benchmark, item_text, item)
    return found.select(
        F.col("key").alias(key), F.col("name").alias(item), "doc_start", "item_start", "n_words", "n_equal"
    )


def row_leaks(numbered: DataFrame, benchmark: DataFrame, item_text: str, item: str) -> DataFrame:
    """Leaks by row number, from (row, key, text); each row number must belong to its row for good or be used once."""
    items = keep(
        benchmark.where(F.col(item_text).isNotNull()).select(
            F.monotonically_increasing_id().alias("item"), F.col(item).alias("name"), F.col(item_text).alias("text")
        ),
        "items",
    )
    index = keep(items.select("item", "text").mapInPandas(seed_rows, "item long, place long, mask int, hash long"), "seeds")
    table = numbered.sparkSession.sparkContext.broadcast(bitmap(index))
    masks = {r["mask"] for r in index.where(F.col("mask") >= len(MASKS)).select("mask").distinct().collect()}
    short_sizes = [size for size in range(1, SPAN) if short_mask(size) in masks]

    def suspects(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(0, len(batch), 256):
                part = batch.iloc[i : i + 256]
                texts = [t if isinstance(t, str) else None for t in part["text"]]
                text, place, found = seeds(texts)
                mask, window = np.nonzero(passes(table.value, found))
                text, place, found = text[window], place[window], found[mask, window]
                for size in short_sizes:
                    of, at, hashes = first_of_each(*passing(table.value, *whole_windows(texts, size)))
                    text, place, found = np.append(text, of), np.append(place, at), np.append(found, hashes)
                    mask = np.append(mask, np.full(len(of), short_mask(size)))
                if not len(mask):
                    continue
                order = np.argsort(text, kind="stable")
                mask, place, found = mask[order], place[order], found[order]
                hit, starts = np.unique(text[order], return_index=True)
                cuts = starts[1:]
                rows = part.iloc[hit].copy()
                rows["masks"] = np.split(mask.astype(np.int32), cuts)
                rows["hashes"] = np.split(found.view(np.int64), cuts)
                rows["places"] = np.split(place, cuts)
                yield rows

    kind = numbered.schema["key"].dataType.simpleString()
    fields = f"row long, key {kind}, text string, masks array<int>, hashes array<long>, places array<long>"
    known = keep(numbered.select("row", "key", "text").mapInPandas(suspects, fields), "suspects")
    hits = known.select("row", F.inline(F.arrays_zip("masks", "hashes", "places"))).toDF("row", "mask", "hash", "at")
    # Each shift of an item once, and an item's text once however many shifts it has in a document.
    shifts = hits.join(index, ["mask", "hash"]).groupBy("row", "item").agg(
        F.collect_set(F.col("at") - F.col("place")).alias("shifts")
    )
    texts = items.select("item", F.col("text").alias("item_text"))
    # A document with many items is verified in parts, so that no row holds more than some items' texts.
    listed = shifts.join(texts, "item").groupBy("row", F.pmod(F.col("item"), F.lit(ITEM_PARTS)).alias("part")).agg(
        F.collect_list(F.struct("item", "shifts", "item_text")).alias("candidates")
    )
    checked = known.select("row", "text").join(listed.drop("part"), "row").mapInPandas(
        verified, "row long, item long, doc_start long, item_start long, n_words long, n_equal long"
    )
    return checked.join(known.select("row", "key"), "row").join(items.select("item", "name"), "item")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id") -> DataFrame:
    """``docs`` without the documents that hold a leak, all columns as they are."""
    row = new_name("_row", docs.columns)
    known = keep(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    numbered = known.select(F.col(row).alias("row"), F.lit(None).cast("long").alias("key"), F.col(text).alias("text"))
    bad = row_leaks(numbered, benchmark, "text", item).select(F.col("row").alias(row)).distinct()
    return known.join(bad, row, "left_anti").drop(row)
