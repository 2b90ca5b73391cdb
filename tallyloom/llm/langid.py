"""Language of whole texts by a string kernel.

The kernel of two texts is the number of character n-grams of one to four characters present in both, over
the root of the product of their own numbers (a blended-spectrum presence kernel). N-grams are hashed to a
fixed number of places per order. Letters are lower-cased; what is no letter counts as a space, save characters
beyond the basic plane, which stay as they are.

Learning: a bounded sample of the labelled rows is turned into presence bits by Spark tasks. A few of them,
the same number for each language, are the landmarks. The Nystroem map takes a text to its kernel values
with the landmarks times the inverse root of their kernel matrix, and ridge regression on these features is
solved in closed form for one language against the rest. Predicting is two matrix products per
block of texts: presence bits times those of the landmarks, then kernel values times the coefficients.

Defined cases: a null text and one without letters are ``und`` with score 0, as is every text if
there is nothing to learn from. Languages with the same score: the one that sorts first. Rows with a null id or null
language are predicted like others; a row with a null id is not learned from.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import new_name, one_thread

#: Hash places (as powers of two) of n-grams of 1, 2, 3 and 4 characters.
ORDER_BITS = (8, 12, 13, 13)
PLACES = sum(1 << b for b in ORDER_BITS)
UNKNOWN = "und"

#: Bounds of what is learned from: rows per language, and rows in all unless there are too many languages for that.
ROWS_PER_LANGUAGE = 400
MAX_ROWS = 8192
#: Rows of a language that are learned from, however many languages there are.
LEAST_ROWS = 2
LANDMARKS = 96
RIDGE = 1e-3

BLOCK_TEXTS = 64
BLOCK_CHARS = 1_000_000
GAP = "\x00" * (len(ORDER_BITS) - 1)


def _letter_table() -> np.ndarray:
    """Each character of the basic plane by itself if it is a letter, else a space. Others stay."""
    return np.array([c if chr(c).isalpha() else 32 for c in range(0x10000)], np.uint32)


LETTERS = _letter_table()


def has_letters(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def presence(texts: Sequence[str]) -> np.ndarray:
    """Texts by places, TRUE where the text holds an n-gram of that place."""
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer((GAP.join(lowered) + GAP).encode("utf-32-le", "surrogatepass"), np.uint32)
    of_text = np.repeat(np.arange(len(lowered)), [len(t) + len(GAP) for t in lowered])
    inside = np.ones(len(codes), bool)
    ends = np.cumsum([len(t) + len(GAP) for t in lowered])
    for back in range(1, len(GAP) + 1):
        inside[ends - back] = False
    at = np.flatnonzero(inside)
    chars = np.where(codes < 0x10000, LETTERS[np.minimum(codes, 0xFFFF)], codes)
    chars[~inside] = 0
    found = np.zeros((len(lowered), PLACES), bool)
    flat, row = found.reshape(-1), of_text[at] * PLACES
    gram, first = np.zeros(len(at), np.uint32), 0
    for order, bits in enumerate(ORDER_BITS):
        gram = gram * np.uint32(0x9E3779B1) + chars[at + order] + np.uint32(1)
        mixed = (gram ^ (gram >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        flat[row + (mixed >> np.uint32(32 - bits)) + first] = True
        first += 1 << bits
    return found


def blocks(texts: Sequence[str]) -> Iterator[slice]:
    """Runs of texts that are few and short enough to be handled at once."""
    start, chars = 0, 0
    for i, text in enumerate(texts):
        if i > start and (i - start >= BLOCK_TEXTS or chars + len(text) > BLOCK_CHARS):
            yield slice(start, i)
            start, chars = i, 0
        chars += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


def kernel(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Kernel matrix of two sets of presence rows (as floats)."""
    norm = np.sqrt(np.maximum(left.sum(1), 1))[:, None] * np.sqrt(np.maximum(right.sum(1), 1))[None, :]
    return (left @ right.T) / norm


@dataclass
class Model:
    """``landmarks`` are packed presence bits; ``weights`` has a row per landmark and, last, the intercept."""

    languages: list[str]
    landmarks: np.ndarray
    weights: np.ndarray

    def scores(self, texts: Sequence[str], landmarks: np.ndarray) -> np.ndarray:
        values = kernel(presence(texts).astype(np.float32), landmarks)
        return values @ self.weights[:-1] + self.weights[-1]

    def unpacked(self) -> np.ndarray:
        return np.unpackbits(self.landmarks, axis=1, count=PLACES).astype(np.float32)


def learned_from(doc_id: str = "doc_id") -> Column:
    """Rows a prediction may be learned from: by the crc32 of the id, three of four."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4)) != 2


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Model | None:
    """Model of a bounded sample of the rows with text, language and key; None if there are none."""
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & F.col(key).isNotNull())
    # One short entry per language.
    known = {r["lang"]: r["count"] for r in rows.groupBy(F.col(lang).alias("lang")).count().collect()}
    if not known:
        return None
    each = max(LEAST_ROWS, min(ROWS_PER_LANGUAGE, MAX_ROWS // len(known)))
    spark = labelled.sparkSession
    rates = F.broadcast(
        spark.createDataFrame([(k, min(1.0, each / n)) for k, n in known.items()], "_lang string, _rate double")
    )
    # By the row's content, so reruns and other partitionings learn from the same rows; equal rows are drawn as one.
    draw = F.pmod(F.xxhash64(F.lit("langid"), F.col(key).cast("string"), F.col(text)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = (
        rows.select(F.col(text).alias("_text"), F.col(lang).alias("_lang"), draw.alias("_draw"))
        .join(rates, "_lang")
        .where(F.col("_draw") < F.col("_rate"))
        .groupBy("_lang", "_draw")
        .agg(F.min("_text").alias("_text"))
    )

    def bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[np.array([has_letters(t) for t in batch["_text"]], bool)]
            if not len(batch):
                continue
            texts = list(batch["_text"])
            packed = [np.packbits(presence(texts[b]), axis=1) for b in blocks(texts)]
            rows = [r.tobytes() for p in packed for r in p]
            yield pd.DataFrame({"lang": list(batch["_lang"]), "draw": list(batch["_draw"]), "bits": rows})

    drawn = sample.mapInPandas(bits, "lang string, draw double, bits binary").collect()
    return solve([(r["lang"], r["draw"], bytes(r["bits"])) for r in drawn])


def solve(drawn: list[tuple[str, float, bytes]]) -> Model | None:
    """Landmarks and ridge coefficients from (language, draw, packed presence bits)."""
    if not drawn:
        return None
    one_thread()
    drawn = sorted(drawn)
    languages = sorted({d[0] for d in drawn})
    # In turns, so that every language has a landmark before one has two, and the first LANDMARKS do.
    turns: dict[str, int] = {}
    ranked = []
    for d in drawn:
        turns[d[0]] = turns.get(d[0], -1) + 1
        ranked.append((turns[d[0]], d))
    chosen = [np.frombuffer(d[2], np.uint8) for _, d in sorted(ranked)[: max(LANDMARKS, 2)]]
    landmarks = np.array(chosen)
    unpacked = np.unpackbits(landmarks, axis=1, count=PLACES).astype(np.float32)
    values = []
    for i in range(0, len(drawn), 256):
        part = np.array([np.frombuffer(d[2], np.uint8) for d in drawn[i : i + 256]])
        values.append(kernel(np.unpackbits(part, axis=1, count=PLACES).astype(np.float32), unpacked))
    among, vectors = np.linalg.eigh(kernel(unpacked, unpacked).astype(np.float64))
    use = among > 1e-6 * among.max()
    root = vectors[:, use] / np.sqrt(among[use])
    features = np.concatenate(values).astype(np.float64) @ root
    wanted = np.array([[d[0] == language for language in languages] for d in drawn], float)
    # Rows weigh so that each language counts the same; the intercept is not penalised.
    weight = 1.0 / np.maximum(wanted.sum(0), 1)[[languages.index(d[0]) for d in drawn]]
    weight /= weight.sum()
    design = np.hstack([features, np.ones((len(features), 1))])
    penalty = np.diag([RIDGE] * features.shape[1] + [1e-9])
    solved = np.linalg.solve((design * weight[:, None]).T @ design + penalty, (design * weight[:, None]).T @ wanted)
    weights = np.vstack([root @ solved[:-1], solved[-1:]]).astype(np.float32)
    return Model(languages, landmarks, weights)


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1); columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        one_thread()
        known = shared.value
        landmarks = None if known is None else known.unpacked()
        for batch in batches:
            names, best = np.full(len(batch), UNKNOWN, object), np.zeros(len(batch))
            at = [] if known is None else [i for i, t in enumerate(batch) if isinstance(t, str) and has_letters(t)]
            texts = [batch.iloc[i] for i in at]
            for part in blocks(texts):
                found = known.scores(texts[part], landmarks)
                names[at[part]] = [known.languages[j] for j in found.argmax(1)]
                best[at[part]] = np.clip(found.max(1), 0, 1)
            yield pd.DataFrame({"lang_pred": names, "score": best})

    at = new_name("_scored", docs.columns)
    found = docs.withColumn(at, scored(F.col(text)))
    kept = [F.col(c) for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    return found.select(*kept, F.col(at)["lang_pred"].alias("lang_pred"), F.col(at)["score"].alias("score"))
