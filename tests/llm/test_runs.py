import hashlib
import random
import re
import zlib

from pyspark.sql import functions as F

from helpers import by_key, documents, empty, with_clashes
from tallyloom.llm import registry, runs


def brute(words):
    """Runs by trying every period at every place."""
    n, seen = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q) and j > i:
                seen.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((a, b - a, q) for (a, b), q in seen.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for start, length, q in found for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic(rng):
    """Words in which runs touch, overlap and hold smaller runs."""
    letters = "abcdefgh"[: rng.randint(1, 8)]
    words = [rng.choice(letters) for _ in range(rng.randint(0, 60))]
    for _ in range(rng.randint(0, 4)):
        unit = [rng.choice(letters) for _ in range(rng.choice([1, 2, 3, 5, 13, 17, 24, 30, 50, 70]))]
        if rng.random() < 0.4:
            unit = ["a"] * rng.randint(1, 40) + unit
        if rng.random() < 0.3:
            unit = unit[:3] * rng.randint(1, 9) + unit
        words += unit * rng.randint(1, 5) + unit[: rng.randint(0, len(unit))]
        words += [rng.choice(letters + "xyz") for _ in range(rng.randint(0, 5))]
    return words


def test_runs_are_those_of_brute_force():
    rng = random.Random(5)
    seen = 0
    for _ in range(150):
        texts = [periodic(rng) for _ in range(rng.randint(1, 6))]
        for words, (found, text) in zip(texts, runs.run_batch([" ".join(w) for w in texts])):
            expected = brute(words)
            assert [tuple(r) for r in found] == expected
            assert text == collapsed(words, expected)
            seen += len(expected)
    assert seen > 1500


def test_large_periods_in_long_texts():
    words = [f"w{i}" for i in range(9000)]
    text = " ".join(["x"] * 5000 + words * 2 + words[:100] + ["y"])
    ((found, kept),) = runs.run_batch([text])
    assert found == [(0, 5000, 1), (5000, 18100, 9000)]
    assert kept == " ".join(["x", *words, "y"])


def test_selected_places_depend_on_their_context_alone():
    import numpy as np

    rng = np.random.default_rng(1)
    part = rng.integers(0, 2**63, 400).astype(np.uint64)
    scale = 16
    whole = np.concatenate((rng.integers(0, 2**63, 55).astype(np.uint64), part, part))
    chosen = set(runs.selected(whole, scale).tolist())
    first = {c - 55 for c in chosen if 55 <= c < 455 - scale}
    assert first == {c - 455 for c in chosen if 455 <= c < 855 - scale}
    assert all(any(i + j in chosen for j in range(scale)) for i in range(len(whole) - 2 * scale))


def test_nulls_empty_short_and_equal_texts(spark):
    loop = "a b c " * 6
    texts = [None, "", " \n\t ", "one", loop, loop, "é x " * 12, "a " * 11, "a " * 12]
    docs = with_clashes(documents(spark, texts))
    rows = by_key(runs.find_runs(docs).collect())
    for i, text in enumerate(texts):
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
        expected = brute(words)
        assert [tuple(r) for r in rows[i]["runs"]] == expected
        assert rows[i]["collapsed"] == collapsed(words, expected)
    assert rows[8]["runs"] and not rows[7]["runs"]
    assert runs.find_runs(empty(docs)).collect() == []


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(9)
    texts = [None, "", "z"] + [" ".join(periodic(rng)) for _ in range(80)]
    ids = list(range(len(texts) - 1)) + [None]
    documents(spark, texts, ids=ids).write.parquet(f"{tmp_path}/documents.parquet")
    rows = by_key(registry.op13_periodic_runs(spark, str(tmp_path)).collect())
    planted = 0
    for i, text in zip(ids, texts):
        words = (text or "").split()
        n = len(words)
        if i is not None and zlib.crc32(str(i).encode()) % 10 == 0 and n:
            g = zlib.crc32(str(i).encode()) // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[j] if j < a else words[a + (j - a) % p] for j in range(n)]
            planted += 1
        expected = brute(words)
        row = rows[i]
        listing = "".join(f"{s},{length},{q}\n" for s, length, q in expected)
        assert row["n_runs"] == len(expected)
        assert row["runs_sha256"] == hashlib.sha256(listing.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(collapsed(words, expected).encode()).hexdigest()
        best = min(expected, key=lambda r: (-r[1], r[0], r[2]), default=None)
        found = tuple(row[c] for c in ("start", "length", "period", "exponent_milli"))
        assert found == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
    assert planted > 3

