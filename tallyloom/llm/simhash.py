"""Near-duplicates by SimHash fingerprints and pivot distance tables.

A fingerprint bit is set where more than half of the text's shingle hashes have it. Fingerprints
link at ``MAX_BITS`` or fewer differing bits, and components of linked fingerprints are groups of near copies.

* Equal fingerprints are one class from the start, so copies are never paired.
* Which pairs can link at all: the 64 bits are cut into 6 blocks, and two fingerprints that differ in 3 bits
  agree in at least 3 blocks. Every distinct fingerprint is dealt to the 20 triples of blocks by the bits it
  has there. Within a deal it is written down how far each fingerprint is from many reference fingerprints (the
  pivots); by the triangle inequality a pair whose distances to any pivot differ by more than 3 can't link
  and is discarded. What survives is compared bit by bit.
* Linked fingerprints of a deal are reduced to one link each before they are passed on, so the number of links
  stays in proportion to the fingerprints. Links and components are never gathered on the driver.

A deal of very many fingerprints is dealt again by the bits it does not share yet, within its task, until at most
``CELL`` are left together; those are compared in blocks. A link differs in 3 of these bits at most, so it agrees in one of any 4 blocks
of them and none is lost. A task holds the fingerprints of one deal, some 50 bytes each with their distances. There
are no limits on partners or candidates.

Why the deal: fingerprints of unlike texts lie 32 +- 4 bits from any pivot, so that a range of
+-3 around a distance still holds more than half of them. Distances alone can discard pairs, but can't place
fingerprints so that only near ones meet.

Defined cases: a text that is null or has no words has fingerprint zero, and links like any other; one of fewer words
than a shingle has one shingle of all its words. A null id takes no part in finding the smallest id; a group of
null ids only has a null ``component_id``. Equal rows are copies of each other. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tallyloom.llm.common import keep, new_name
from tallyloom.llm.components import components
from tallyloom.llm.words import split_words

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 3
BLOCK_BITS = (11, 11, 11, 11, 10, 10)
AGREEING = len(BLOCK_BITS) - MAX_BITS
PIVOTS = 24
#: Pivots that are tried before survivors are gathered.
FIRST_PIVOTS = 3
#: Parts that the members of a large component are spread over.
SALTS = 32
#: Side of the square of pairs that is looked at at once.
SQUARE = 1024
#: Fingerprints of a deal that are compared with each other without dealing them again.
CELL = 4096


def shingle_hashes(words: list[bytes], size: int = SHINGLE_WORDS) -> np.ndarray:
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(b" ".join(words), SEED)], np.uint64)
    # Slices of the joined words are the space-joined shingles.
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    ends = (starts + lengths)[size - 1 :].tolist()
    hashes = [digest(joined[s:e], SEED) for s, e in zip(starts.tolist(), ends)]
    return np.array(hashes, np.uint64)


def majority(hashes: np.ndarray) -> int:
    """Number whose bits are those that over half of the hashes have."""
    total = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65_536):
        part = hashes[i : i + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1).sum(0, dtype=np.int32)
    bits = np.packbits(2 * total > len(hashes))
    return int.from_bytes(bits.tobytes(), "big")


def fingerprints(texts: Sequence[str | None]) -> np.ndarray:
    """Signed 64-bit fingerprints of a batch of texts."""
    words = split_words(texts, lower=True)
    raw, out = words.data.tobytes(), np.zeros(len(texts), np.uint64)
    starts, ends = words.starts.tolist(), words.ends.tolist()
    for i, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist())):
        if b > a:
            out[i] = majority(shingle_hashes([raw[s:e] for s, e in zip(starts[a:b], ends[a:b])]))
    return out.view(np.int64)


@F.pandas_udf(LongType())
def fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        parts = [
            fingerprints([t if isinstance(t, str) else None for t in batch.iloc[i : i + 256]])
            for i in range(0, len(batch), 256)
        ]
        yield pd.Series(np.concatenate(parts) if parts else [], dtype="int64")


def deals() -> list[int]:
    """Bit masks of all choices of ``AGREEING`` blocks."""
    shifts = np.cumsum((0, *BLOCK_BITS))
    masks = [((1 << int(n)) - 1) << int(s) for n, s in zip(BLOCK_BITS, shifts)]
    return [sum(chosen) for chosen in combinations(masks, AGREEING)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def deal_column(fp: Column) -> Column:
    """Structs of the number of a deal and the bits that a fingerprint has in it."""
    return F.array(
        *[
            F.struct(F.lit(i).alias("deal"), fp.bitwiseAND(F.lit(_signed(mask)).cast("long")).alias("bits"))
            for i, mask in enumerate(deals())
        ]
    )


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: a fixed pseudo-random choice, so that every task has the same ones."""
    return np.random.default_rng(SEED).integers(0, 1 << 64, n, dtype=np.uint64)


def distances(fps: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Table of the Hamming distances of fingerprints (rows) to pivots (columns)."""
    return np.bitwise_count(fps[:, None] ^ reference[None, :]).astype(np.int8)


def near_pairs(left: np.ndarray, right: np.ndarray, left_table: np.ndarray, right_table: np.ndarray, same: bool):
    """Positions (i, j) of all pairs within ``MAX_BITS``; of i < j only, if both sides are the same."""
    open_ = np.ones((len(left), len(right)), bool)
    for p in range(FIRST_PIVOTS):
        open_ &= np.abs(left_table[:, p, None] - right_table[None, :, p]) <= MAX_BITS
    i, j = np.nonzero(np.triu(open_, 1) if same else open_)
    for p in range(FIRST_PIVOTS, left_table.shape[1]):
        if len(i) < SQUARE:
            break
        stay = np.abs(left_table[i, p] - right_table[j, p]) <= MAX_BITS
        i, j = i[stay], j[stay]
    close = np.bitwise_count(left[i] ^ right[j]) <= MAX_BITS
    return i[close], j[close]


class Groups:
    """Disjoint sets over positions."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.find(i), self.find(j)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def cells(fps: np.ndarray, rows: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Subsets of ``rows`` of at most ``most`` (distinct) fingerprints, such that every pair that can link is in one of them.

    The bits in which the fingerprints differ at all are cut into one block more than a link may differ in. A link agrees in
    one of them, so the rows are dealt by each block in turn, and again where that leaves too many together.
    A cell has fewer such bits than what it was cut from, so this ends.
    """
    if len(rows) <= most:
        yield rows
        return
    here = fps[rows]
    apart = int(np.bitwise_or.reduce(here ^ here[0]))
    open_bits = [1 << n for n in range(64) if apart >> n & 1]
    for block in range(MAX_BITS + 1):
        shared = here & np.uint64(sum(open_bits[block :: MAX_BITS + 1]))
        order = np.argsort(shared, kind="stable")
        edge = np.flatnonzero(np.diff(shared[order])) + 1
        for part in np.split(rows[order], edge):
            if len(part) > 1:
                yield from cells(fps, part, most)


def links_of_deal(fps: np.ndarray, reference: np.ndarray, most: int = CELL) -> list[tuple[int, int]]:
    """One link to the first of its group for every fingerprint that has a near one among ``fps``, which are distinct."""
    table, groups = distances(fps, reference), Groups(len(fps))
    for rows in cells(fps, np.arange(len(fps)), max(most, 1 << MAX_BITS)):
        for a in range(0, len(rows), SQUARE):
            for b in range(a, len(rows), SQUARE):
                p, q = rows[a : a + SQUARE], rows[b : b + SQUARE]
                i, j = near_pairs(fps[p], fps[q], table[p], table[q], a == b)
                for x, y in zip(p[i].tolist(), q[j].tolist()):
                    groups.join(x, y)
    return [(i, r) for i in range(len(fps)) if (r := groups.find(i)) != i]


def link_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links from rows (deal, bits, fp) that come sorted by deal and bits; a deal may span batches."""
    reference = pivots()
    held: list[np.ndarray] = []  # parts of the deal that may go on
    held_key: tuple[int, int] | None = None

    def links(fps: np.ndarray) -> list[tuple[int, int]]:
        if len(fps) == 2:
            return [(1, 0)] if int(fps[0] ^ fps[1]).bit_count() <= MAX_BITS else []
        return links_of_deal(fps, reference) if len(fps) > 2 else []

    def frame(found: list[tuple[np.ndarray, list[tuple[int, int]]]]) -> pd.DataFrame:
        u = [fps[i] for fps, pairs in found for i, _ in pairs]
        v = [fps[r] for fps, pairs in found for _, r in pairs]
        return pd.DataFrame({"u": np.array(u, np.uint64).view(np.int64), "v": np.array(v, np.uint64).view(np.int64)})

    for rows in batches:
        if not len(rows):
            continue
        fps = rows["fp"].to_numpy(np.int64).view(np.uint64)
        key = rows[["deal", "bits"]].to_numpy(np.int64)
        edge = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
        bounds = np.array([0, *edge.tolist(), len(fps)])
        done = []
        if held_key is not None and held_key != tuple(key[0].tolist()):
            done.append(np.concatenate(held))
            held = []
        held.append(fps[: bounds[1]].copy())
        if len(bounds) > 2:
            done.append(np.concatenate(held))
            full = np.flatnonzero(np.diff(bounds[1:-1]) > 1) + 1
            done += [fps[bounds[n] : bounds[n + 1]] for n in full.tolist()]
            held = [fps[bounds[-2] :].copy()]
        held_key = tuple(key[-1].tolist())
        yield frame([(deal, links(deal)) for deal in done])
    if held:
        deal = np.concatenate(held)
        yield frame([(deal, links(deal))])


def fingerprint_links(distinct: DataFrame) -> DataFrame:
    """Links (u, v) among distinct fingerprints (column ``fp``); their components are those of all pairs within ``MAX_BITS``."""
    dealt = distinct.select("fp", F.inline(deal_column(F.col("fp"))))
    # Most fingerprints are alone in a deal. The sort brings the others together without a group per key.
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = dealt.repartition(parts, "deal", "bits").sortWithinPartitions("deal", "bits")
    return sorted_.mapInPandas(link_batches, "u long, v long")


def fingerprint_classes(known: DataFrame, fp: str, key: str) -> DataFrame:
    """(fp, least) for every distinct fingerprint of ``known``: the smallest key of its component."""
    classes = known.groupBy(F.col(fp).alias("fp")).agg(F.min(key).alias("own"))
    roots = components(fingerprint_links(classes.select("fp")))
    members = roots.select(F.col("node").alias("fp"), "root").unionByName(
        roots.select(F.col("root").alias("fp"), "root").distinct()
    )
    owned = members.join(classes, "fp")
    # A component may hold a large share of the fingerprints; its smallest key goes out once per salt.
    salt = F.pmod(F.xxhash64("fp"), F.lit(SALTS)).cast("int")
    least = owned.groupBy("root").agg(F.min("own").alias("least"))
    least = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    linked = owned.withColumn("salt", salt).join(least, ["root", "salt"]).select("fp", "least")
    return classes.join(linked, "fp", "left").select("fp", F.coalesce("least", "own").alias("least"))


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, fingerprint, component_id) of every row: 16 hex digits, and the smallest key of its group.

    The fingerprints are computed once and kept with the keys; texts are read once and never moved.
    """
    known = keep(docs.select(F.col(key).alias("key"), fingerprint(F.col(text)).alias("fp")), "fingerprints")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    # Both sides of the last join are plain reads, so that a fingerprint with very many rows can be split.
    classes = keep(fingerprint_classes(known, "fp", "key"), "classes")
    return known.join(classes, "fp").select(
        F.col("key").alias(key), digits.alias("fingerprint"), F.col("least").alias("component_id")
    )


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One document of each group of near copies: that of the smallest key (nulls last), with all its columns.

    Of several rows with that key one stays. Rows are numbered once, when they are kept with their
    fingerprints, so that a rerun of a task finds the same ones.
    """
    row, fp = new_name("_row", docs.columns), new_name("_fp", docs.columns)
    known = keep(docs.withColumns({row: F.monotonically_increasing_id(), fp: fingerprint(F.col(text))}), "numbered")
    place = F.struct(F.col(key).isNull().alias("last"), F.col(key).alias("key"), F.col(row).alias("row"))
    rows = known.select(F.col(row).alias("row"), F.col(fp).alias("fp"), place.alias("place"))
    best = fingerprint_classes(rows, "fp", "place").groupBy(F.col("least.row").alias("row")).agg(F.lit(1).alias("one"))
    return known.join(best.select(F.col("row").alias(row)), row, "left_semi").drop(row, fp)
