import itertools
import random

import numpy as np
import pytest

from helpers import documents, empty, with_clashes
from tallyloom.llm import decontaminate as D


def stretch_score(equal):
    """Best stretch by trying all."""
    best = (0, 0, 0)
    for a in range(len(equal)):
        total = 0
        for b in range(a, len(equal)):
            total += 1 if equal[b] else -D.MISMATCH
            if total > best[0]:
                best = (total, a, b + 1)
    return best[1:]


def test_best_stretch_against_all():
    rng = random.Random(6)
    for _ in range(300):
        equal = np.array([rng.random() < 0.7 for _ in range(rng.randrange(1, 25))])
        a, b = D.best_stretch(equal)
        x, y = stretch_score(equal)
        value = lambda s, e: sum(1 if v else -D.MISMATCH for v in equal[s:e])
        assert value(a, b) == value(x, y)


def least_substitutions(n):
    """Substitutions that it takes, wherever they stand, to leave no seed in ``n`` words; all patterns are tried window by window."""
    missed = [
        w
        for w in range(1 << D.SPAN)
        if all(any(m == "1" and w >> (D.SPAN - 1 - j) & 1 for j, m in enumerate(mask)) for mask in D.MASKS)
    ]
    cost = {w: w.bit_count() for w in missed}
    for _ in range(n - D.SPAN):
        after = {}
        for w, c in cost.items():
            for bit in (0, 1):
                x = (w << 1 | bit) & ((1 << D.SPAN) - 1)
                if x in missed:
                    after[x] = min(after.get(x, n), c + bit)
        cost = after
    return min(cost.values())


def test_every_stretch_of_enough_equal_words_has_a_seed():
    assert all(least_substitutions(n) > n // 5 for n in range(D.MIN_WORDS, 61))


def test_a_document_that_repeats_words_of_many_items(spark):
    """Few words of 40 items over and over: many shifts, no leak, but for the one item that stands there whole."""
    rng = random.Random(3)
    items = [" ".join(f"i{n}w{j}" for j in range(60)) for n in range(40)]
    parts = [" ".join(item.split()[:8]) for item in items]
    body = " ".join(rng.choice(parts) + f" z{i}" for i in range(2000))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = D.leaks(documents(spark, [body, f"{body} {items[7]}"]), bench).collect()
    assert [(r["doc_id"], r["item_id"], r["n_words"]) for r in rows] == [(1, 7, 60)]


@pytest.mark.parametrize("n,k", [(13, 2), (16, 3)])
def test_masks_find_every_pattern_of_substitutions(n, k):
    for pattern in itertools.combinations(range(n), k):
        assert any(
            all(mask[j] == "0" or a + j not in pattern for j in range(D.SPAN))
            for a in range(n - D.SPAN + 1)
            for mask in D.MASKS
        )


def test_longest_stretch_against_all():
    rng = random.Random(8)
    for _ in range(300):
        equal = np.array([rng.random() < 0.7 for _ in range(rng.randrange(1, 30))])
        a, b = D.longest_stretch(equal)
        lengths = [
            y - x for x in range(len(equal)) for y in range(x + 1, len(equal) + 1) if 5 * int(equal[x:y].sum()) >= 4 * (y - x)
        ]
        assert b - a == max(lengths, default=0) and 5 * int(equal[a:b].sum()) >= 4 * (b - a)


@pytest.mark.parametrize("n,k", [(13, 2), (15, 3), (16, 3)])
def test_every_pattern_of_substitutions_is_a_leak(spark, n, k):
    """A passage in the middle of a longer item, in documents that share nothing else with it."""
    passage = [f"p{i}" for i in range(n)]
    around = lambda name: " ".join(f"{name}{i}" for i in range(20))
    item = f"{around('a')} {' '.join(passage)} {around('b')}"
    texts = []
    for pattern in itertools.combinations(range(n), k):
        changed = ["other" if i in pattern else w for i, w in enumerate(passage)]
        texts.append(f"{around('c')} {' '.join(changed)} {around('d')}")
    few = [around("c"), " ".join(passage[:10]), f"{around('c')} {' '.join(passage[:10])} {around('d')}"]
    bench = spark.createDataFrame([(0, item)], "item_id long, text string")
    rows = D.leaks(documents(spark, texts + few), bench).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    assert all(r["n_words"] >= 13 and r["n_equal"] >= 0.8 * r["n_words"] for r in rows)


def fixture(spark):
    rng = random.Random(7)
    words = ["w%d" % i for i in range(2000)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    items = [text(rng.choice([9, 13, 20, 45])) for _ in range(12)] + [None, "", "too short", text(7)]
    items.append(items[2])  # an equal item
    docs, expected = [], set()
    for i in range(60):
        docs.append(text(rng.randrange(0, 80)))
    for i in range(12):
        given = items[i].split()
        changed = list(given)
        for p in rng.sample(range(len(given)), len(given) // 10):
            changed[p] = "other"
        for body in (" ".join(given), ", ".join(w.upper() for w in given), " ".join(changed)):
            expected.add((len(docs), i))
            docs.append(f"{text(5)}. {body}! {text(30)}")
        docs.append(" ".join(given[: min(7, len(given) // 2)]))  # too little of it
    expected |= {(d, 16) for d, i in expected if i == 2}
    docs += [None, "", f"{text(3)} {items[5]} {text(4)} {items[5]}"]
    expected.add((len(docs) - 1, 5))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return docs, bench, expected


def test_leaks_against_what_was_planted(spark):
    docs, bench, expected = fixture(spark)
    rows = D.leaks(with_clashes(documents(spark, docs)), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == expected and len(rows) == len(expected)


def test_a_small_bitmap_changes_nothing(spark, monkeypatch):
    docs, bench, expected = fixture(spark)
    monkeypatch.setattr(D, "PLACES_PER_SEED", 1)
    rows = D.leaks(documents(spark, docs), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == expected


def test_leaking_documents_go(spark):
    docs, bench, expected = fixture(spark)
    table = with_clashes(documents(spark, docs))
    table = table.unionByName(table.where("doc_id in (0, 60)"))
    kept = D.drop_leaks(table, bench)
    assert kept.columns == table.columns
    clean = [i for i in range(len(docs)) if i not in {d for d, _ in expected}]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted([0, *clean])


def test_empty_tables(spark):
    docs, bench, _ = fixture(spark)
    table = documents(spark, docs)
    assert D.leaks(empty(table), bench).collect() == [] and D.leaks(table, empty(bench)).collect() == []
    assert D.drop_leaks(table, empty(bench)).count() == len(docs)


def test_query_finds_every_whole_item(spark, sample_dir):
    from tallyloom.llm.registry import QUERIES

    clean = lambda t: " " + " ".join("".join(c if c.isalnum() else " " for c in (t or "").lower()).split()) + " "
    items = spark.read.parquet(f"{sample_dir}/benchmark.parquet").select("item_id", "text").collect()
    docs = spark.read.parquet(f"{sample_dir}/documents.parquet").select("doc_id", "text").collect()
    whole = {(d[0], i[0]) for d in docs for i in items if clean(i[1]) in clean(d[1])}
    found = {(r["doc_id"], r["item_id"]) for r in QUERIES["op4_decontamination"](spark, sample_dir).collect()}
    assert whole and found == whole


def test_items_shorter_than_a_seed(spark):
    words = [f"s{i}" for i in range(7)]
    items = [" ".join(words[:n]) for n in range(1, 8)] + ["Common", "", "漢字"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = [" ".join(["x", *words[:n], "y", *words[:n]]) for n in range(8)]
    docs += ["common " * 3000, "s0 s1 other s3 s4 s5 s6", ", ".join(w.upper() for w in words), None, "", "漢字"]
    clean = lambda t: " " + " ".join((t or "").lower().replace(",", "").split()) + " "
    expected = {(d, i) for d, t in enumerate(docs) for i, item in enumerate(items) if item and clean(item) in clean(t)}
    rows = D.leaks(documents(spark, docs), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == expected and len(rows) == len(expected)
    assert all(r["n_words"] == r["n_equal"] == len(items[r["item_id"]].split()) for r in rows)
    assert {r["doc_start"] for r in rows if r["doc_id"] < 8} == {1}
