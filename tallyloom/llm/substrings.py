"""Exact substring dedup by fixed-block anchors.

A window of 20 words repeats if its words also start earlier: in a document of a smaller id, or further ahead in the same. All words
that repeating windows cover are removed. Any window of 20 words holds one of the non-overlapping blocks of 10 words that
its document is cut into, so wherever a window repeats, the later place shows a block of the earlier one at some offset.

1. The documents are written once, in bundles of about ``BUNDLE_BYTES``, as a table bucketed by bundle. Every later step reads that table
   where it lies: texts are never shuffled.
2. Blocks are the index, and every rolling window of 10 words is a probe. Of each distinct probe a bundle sends a short hash, whether it is
   a block there, and whether it occurs twice. Probes that equal a block and occur elsewhere come back as hits.
3. Hits are extended: the windows of 20 words that hold a hit are compared by 96-bit hashes, plus the bits that deal them. A bundle sends the
   first place of each; all but the first of all places come back as repeats. What runs on unbroken is one maximal repeat.
4. Covered words are removed from each document.

Repeats are combined within a bundle before anything is sent, so a passage that fills a third of all rows is at most one
entry per bundle. No pairs are made, and no partner is dropped. Two different windows are taken for equal only if two independent hashes
collide, which for 10^13 windows has a chance of about one in ten thousand.

Defined cases: a null or empty text has no words. A null id sorts last. Rows with equal ids (so also equal rows) are ordered by
where they lie in the table; all but the first of several equal rows lose what repeats. A document of fewer than 20 words
is left alone. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tallyloom.llm.common import new_name
from tallyloom.llm.words import Words, split_words, window_hashes, window_starts, word_hashes
from tallyloom.session import fresh_dir

WINDOW = 20
BLOCK = 10
BUNDLE_BYTES = 2_000_000
# Spark's own limit of buckets per table.
MOST_BUCKETS = 100_000
#: Entries that a task gets at once, about (as a power of two).
BUCKET_BITS = 20
KEY_BITS = 30
LAST = np.iinfo(np.int64).max


# 1. bundles


def bundles(docs: DataFrame, text: str, bundle: str, seq: str) -> DataFrame:
    """``docs`` with the bundle of each row and its number there, as a table bucketed by bundle."""
    spark = docs.sparkSession
    schema = StructType([*docs.schema.fields, StructField(bundle, LongType()), StructField(seq, IntegerType())])
    at = docs.columns.index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            sizes = [len(t.as_py() or "") for t in batch.column(at)]
            start, size = 0, 0
            for i, n in enumerate([*sizes, BUNDLE_BYTES]):
                if i > start and (i == len(sizes) or size + n > BUNDLE_BYTES):
                    part = batch.slice(start, i - start)
                    columns = [*part.columns, pa.array([number] * len(part), pa.int64()), pa.array(range(len(part)), pa.int32())]
                    yield pa.RecordBatch.from_arrays(columns, names=schema.names)
                    number, start, size = number + 1, i, 0
                size += n

    name = f"bundles_{uuid.uuid4().hex}"
    buckets = min(MOST_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    (
        docs.mapInArrow(cut, schema)
        .write.bucketBy(buckets, bundle)
        .option("compression", "zstd")
        .option("path", fresh_dir(spark, "bundles"))
        .saveAsTable(name)
    )
    return spark.table(name)


class Bundle:
    """Words of a bundle's documents in their global order: by id (null last), then by number."""

    def __init__(self, ids: list[int | None], seqs: list[int], texts: list[str | None]) -> None:
        order = [LAST if i is None or i != i else int(i) for i in ids]
        self.rows = np.lexsort((np.array(seqs, np.int64), np.array(order, np.int64)))
        self.ids = np.array(order, np.int64)[self.rows]
        self.words: Words = split_words([texts[i] for i in self.rows])
        self.hashes = word_hashes(self.words)

    def probes(self, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Start of every rolling window of BLOCK words, its place among the distinct codes, these (sorted), and their flags.

        A code is the bucket and the key of a window; flags are 1 for a block, 2 for more than one place.
        """
        at = window_starts(self.words, BLOCK)
        if not len(at):
            empty = np.empty(0, np.int64)
            return at, empty, np.empty(0, np.uint64), empty
        codes = window_hashes(self.hashes, BLOCK)[at] >> np.uint64(64 - bits - KEY_BITS)
        is_block = (at - self.words.first[self.words.text_of_word()[at]]) % BLOCK == 0
        distinct, place, counts = np.unique(codes, return_inverse=True, return_counts=True)
        flags = 2 * (counts > 1)
        flags[place[is_block]] |= 1
        return at, place, distinct, flags


def per_bucket(buckets: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of equal numbers in a sorted array."""
    if len(buckets):
        edge = np.flatnonzero(buckets[1:] != buckets[:-1]) + 1
        for a, b in zip((0, *edge.tolist()), (*edge.tolist(), len(buckets))):
            yield int(buckets[a]), slice(a, b)


# 2. probes and hits


def probe_rows(bundle: Bundle, bits: int) -> list[tuple[int, bytes]]:
    """(bucket, entries) of a bundle; an entry is the key with two flag bits."""
    _, _, distinct, flags = bundle.probes(bits)
    entries = ((distinct & np.uint64((1 << KEY_BITS) - 1)) << np.uint64(2) | flags.astype(np.uint64)).astype(np.uint32)
    return [(b, entries[s].tobytes()) for b, s in per_bucket((distinct >> np.uint64(KEY_BITS)).astype(np.int64))]


def find_hits(entries: list[bytes]) -> list[bytes]:
    """For the entries of each bundle in one bucket, one bit each: TRUE if it is a block somewhere and occurs elsewhere too."""
    arrays = [np.frombuffer(e, np.uint32) for e in entries]
    joined = np.concatenate(arrays)
    order = np.argsort(joined >> np.uint32(2), kind="stable")
    keys, flags = joined[order] >> np.uint32(2), joined[order] & np.uint32(3)
    begins = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1))
    counts = np.diff(np.append(begins, len(keys)))
    any_flags = np.bitwise_or.reduceat(flags, begins)
    live = ((any_flags & 1) > 0) & ((counts > 1) | ((any_flags & 2) > 0))
    out = np.empty(len(joined), bool)
    out[order] = np.repeat(live, counts)
    cuts = np.cumsum([len(a) for a in arrays])[:-1]
    return [np.packbits(part).tobytes() for part in np.split(out, cuts)]


# 3. windows around hits


def candidates(bundle: Bundle, bits: int, hits: dict[int, bytes]) -> np.ndarray:
    """Starts of the windows of WINDOW words that hold a hit."""
    at, place, distinct, _ = bundle.probes(bits)
    live = np.zeros(len(distinct), bool)
    for b, s in per_bucket((distinct >> np.uint64(KEY_BITS)).astype(np.int64)):
        if b in hits:
            live[s] = np.unpackbits(np.frombuffer(hits[b], np.uint8), count=s.stop - s.start)
    total = np.zeros(len(bundle.hashes) + 1, np.int64)
    total[at[live[place]] + 1] = 1
    total = np.cumsum(total)
    starts = window_starts(bundle.words, WINDOW)
    # Blocks within a window start at its first up to its (WINDOW - BLOCK)th word.
    return starts[total[starts + WINDOW - BLOCK + 1] > total[starts]]


ENTRY = np.dtype([("high", "<u8"), ("low", "<u4"), ("doc", "<u4"), ("pos", "<u4")])
SPAN = np.dtype([("doc", "<u4"), ("start", "<u4"), ("end", "<u4")])


def spans(docs: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Maximal runs of covered words, from windows sorted by document and position."""
    out = np.empty(0, SPAN)
    if len(docs):
        new = np.concatenate(([True], (docs[1:] != docs[:-1]) | (positions[1:] > positions[:-1] + WINDOW)))
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(docs)) - 1
        out = np.empty(len(first), SPAN)
        out["doc"], out["start"], out["end"] = docs[first], positions[first], positions[last] + WINDOW
    return out


def window_rows(bundle: Bundle, bits: int, hits: dict[int, bytes]) -> tuple[list[tuple[int, bytes, bytes]], np.ndarray]:
    """(bucket, entries, ids of all documents up to the last one used) and the spans that repeat within the bundle."""
    starts = candidates(bundle, bits, hits)
    if not len(starts):
        return [], np.empty(0, SPAN)
    high = window_hashes(bundle.hashes, WINDOW)[starts]
    low = (window_hashes(word_hashes(bundle.words, 1), WINDOW, 1)[starts] >> np.uint64(32)).astype(np.uint32)
    docs = bundle.words.text_of_word()[starts]
    positions = starts - bundle.words.first[docs]
    order = np.lexsort((starts, low, high))
    again = np.concatenate(([False], (high[order][1:] == high[order][:-1]) & (low[order][1:] == low[order][:-1])))
    repeated = np.sort(order[again])
    firsts = np.sort(order[~again])
    buckets = (high[firsts] >> np.uint64(64 - bits)).astype(np.int64)
    by_bucket = np.argsort(buckets, kind="stable")
    firsts, buckets = firsts[by_bucket], buckets[by_bucket]
    rows = []
    for b, s in per_bucket(buckets):
        at = firsts[s]
        used, local = np.unique(docs[at], return_inverse=True)
        entries = np.empty(len(at), ENTRY)
        entries["high"], entries["low"], entries["doc"], entries["pos"] = high[at], low[at], local, positions[at]
        # Field by field, which compresses better than entry by entry.
        packed = b"".join(np.ascontiguousarray(entries[f]).tobytes() for f in ENTRY.names)
        names = np.stack([used.astype(np.int64), bundle.ids[used]])
        rows.append((b, packed, names.tobytes()))
    return rows, spans(docs[repeated], positions[repeated])


def unpack(packed: bytes) -> np.ndarray:
    n, at = len(packed) // ENTRY.itemsize, 0
    out = np.empty(n, ENTRY)
    for field in ENTRY.names:
        kind = ENTRY[field]
        out[field] = np.frombuffer(packed, kind, n, at)
        at += n * kind.itemsize
    return out


def find_repeats(bundle_ids: np.ndarray, packed: list[bytes], names: list[bytes]) -> list[bytes]:
    """For each bundle's entries in one bucket, the (document, position) of those whose window starts earlier elsewhere."""
    arrays = [unpack(p) for p in packed]
    known = [np.frombuffer(n, np.int64).reshape(2, -1) for n in names]
    entries = np.concatenate(arrays)
    source = np.repeat(np.arange(len(arrays)), [len(a) for a in arrays])
    docs = np.concatenate([k[0][a["doc"]] for k, a in zip(known, arrays)])
    ids = np.concatenate([k[1][a["doc"]] for k, a in zip(known, arrays)])
    order = np.lexsort((entries["pos"], docs, bundle_ids[source], ids, entries["low"], entries["high"]))
    high, low = entries["high"][order], entries["low"][order]
    later = np.concatenate(([False], (high[1:] == high[:-1]) & (low[1:] == low[:-1])))
    hit = np.zeros(len(entries), bool)
    hit[order[later]] = True
    out = []
    for i, part in enumerate(np.split(np.arange(len(entries)), np.cumsum([len(a) for a in arrays])[:-1])):
        at = part[hit[part]]
        out.append(np.stack([docs[at], entries["pos"][at]]).astype(np.uint32).tobytes())
    return out


# 4. removal


def covered(bundle: Bundle, repeats: list[bytes], known: list[bytes]) -> np.ndarray:
    """TRUE for every word of the bundle that a repeating window covers."""
    change = np.zeros(len(bundle.hashes) + 1, np.int64)
    for r in repeats:
        doc, pos = np.frombuffer(r, np.uint32).reshape(2, -1).astype(np.int64)
        start = bundle.words.first[doc] + pos
        np.add.at(change, start, 1)
        np.add.at(change, start + WINDOW, -1)
    for k in known:
        s = np.frombuffer(k, SPAN)
        np.add.at(change, bundle.words.first[s["doc"]] + s["start"], 1)
        np.add.at(change, bundle.words.first[s["doc"]] + s["end"], -1)
    return np.cumsum(change[:-1]) > 0


def join_words(words: Words, kept: np.ndarray) -> list[str]:
    """The kept words of every text, joined by one space."""
    starts, ends = words.starts[kept], words.ends[kept]
    lengths = ends - starts + 1  # with the separator that follows every word
    before = np.cumsum(lengths) - lengths
    total = int(lengths.sum())
    raw = words.data[np.arange(total) - np.repeat(before - starts, lengths)]
    raw[before + lengths - 1] = 32
    count = np.concatenate(([0], np.cumsum(kept)))[words.first]
    edges = np.append(before, total)[count]
    data = raw.tobytes()
    return [data[a : max(a, b - 1)].decode("utf-8", "surrogatepass") for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept`` (the words left, joined by one space).

    Columns of these names are replaced; all others stay as they are.
    """
    spark = docs.sparkSession
    bundle, seq = new_name("_bundle", docs.columns), new_name("_seq", docs.columns)
    table = bundles(docs, text, bundle, seq)
    size = table.agg(F.sum(F.octet_length(text))).first()[0] or 0
    # About six bytes a word; buckets hold about 2^BUCKET_BITS of them.
    bits = max(4, (int(size) // 6 >> BUCKET_BITS).bit_length())
    slim = table.select(F.col(bundle).alias("bundle"), F.col(seq).alias("seq"), F.col(key).cast("long").alias("id"), F.col(text).alias("text"))

    def open_bundle(rows: pd.DataFrame) -> Bundle:
        texts = [t if isinstance(t, str) else None for t in rows["text"]]
        return Bundle([None if pd.isna(i) else int(i) for i in rows["id"]], list(rows["seq"]), texts)

    def send_probes(rows: pd.DataFrame) -> pd.DataFrame:
        sent = probe_rows(open_bundle(rows), bits)
        return pd.DataFrame({"bucket": [b for b, _ in sent], "bundle": rows["bundle"].iloc[0], "entries": [e for _, e in sent]})

    def answer_probes(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"bundle": rows["bundle"], "bucket": rows["bucket"], "hits": find_hits(list(rows["entries"]))})

    probes = slim.groupBy("bundle").applyInPandas(send_probes, "bucket int, bundle long, entries binary")
    hits = probes.groupBy("bucket").applyInPandas(answer_probes, "bundle long, bucket int, hits binary")
    hits = hits.select(F.col("bundle").alias("of"), "bucket", "hits")

    def send_windows(rows: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows):
            sent, own = window_rows(open_bundle(rows), bits, dict(zip(found["bucket"], found["hits"])))
            number = int(rows["bundle"].iloc[0])
            out = [(b, number, e, n, None) for b, e, n in sent]
            if len(own):
                out.append((number % (1 << bits), number, None, None, own.tobytes()))
        return pd.DataFrame(out, columns=["bucket", "bundle", "entries", "names", "known"])

    def answer_windows(rows: pd.DataFrame) -> pd.DataFrame:
        own = rows[rows["known"].notna()]
        sent = rows[rows["entries"].notna()]
        parts = [pd.DataFrame({"of": own["bundle"], "repeats": None, "known": own["known"]})]
        if len(sent):
            found = find_repeats(sent["bundle"].to_numpy(), list(sent["entries"]), list(sent["names"]))
            parts.append(pd.DataFrame({"of": sent["bundle"], "repeats": found, "known": None}))
        return pd.concat([p for p in parts if len(p)] or parts[:1])

    windows = (
        slim.groupBy("bundle")
        .cogroup(hits.groupBy("of"))
        .applyInPandas(send_windows, "bucket int, bundle long, entries binary, names binary, known binary")
    )
    repeats = windows.groupBy("bucket").applyInPandas(answer_windows, "of long, repeats binary, known binary")

    kept_columns = [c for c in docs.columns if c.lower() not in ("n_words", "n_removed", "kept")]
    schema = StructType(
        [
            *[docs.schema[c] for c in kept_columns],
            StructField("n_words", LongType()),
            StructField("n_removed", LongType()),
            StructField("kept", StringType()),
        ]
    )

    def finish(rows: pa.Table, found: pa.Table) -> pa.Table:
        read = Bundle(rows.column(key).to_pylist(), rows.column(seq).to_pylist(), rows.column(text).to_pylist())
        gone = covered(
            read,
            [r for r in found.column("repeats").to_pylist() if r is not None],
            [k for k in found.column("known").to_pylist() if k is not None],
        )
        total = np.concatenate(([0], np.cumsum(gone)))
        removed = total[read.words.first[1:]] - total[read.words.first[:-1]]
        out = rows.take(pa.array(read.rows)).select(kept_columns)
        out = out.append_column("n_words", pa.array(read.words.counts(), pa.int64()))
        out = out.append_column("n_removed", pa.array(removed, pa.int64()))
        return out.append_column("kept", pa.array(join_words(read.words, ~gone), pa.string()))

    return table.groupBy(bundle).cogroup(repeats.groupBy("of")).applyInArrow(finish, schema)


def dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", length: str = "n_chars") -> DataFrame:
    """``docs`` with repeats removed from their texts; texts that lose nothing stay as they are. ``length`` follows the text."""
    found = remove_repeats(docs, text, key)
    changed = found.withColumn(text, F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col(text)))
    if length in docs.columns:
        kind = docs.schema[length].dataType
        changed = changed.withColumn(length, F.when(F.col("n_removed") > 0, F.length(text).cast(kind)).otherwise(F.col(length)))
    return changed.select(*docs.columns)
