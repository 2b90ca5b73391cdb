import math
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import topk

NAN, INF = float("nan"), float("inf")


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def plain(rows, is_query, k):
    good = [
        (i, [math.floor(64.0 * x) for x in v])
        for i, v, _ in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, q in good:
        if is_query(i):
            scored = [(-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i and len(v) == len(q)]
            out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def rows():
    rng = random.Random(8)
    out = [(i, [rng.choice([rng.uniform(-1, 1), 0.5, 0.0]) for _ in range(24)], 0) for i in range(400)]
    out += [(i, out[5][1], 0) for i in range(400, 460)]  # equal vectors, so ties
    out += [(500, None, 0), (505, [1.0, None], 0), (510, [NAN] * 24, 0), (515, [INF] * 24, 0), (None, [0.1] * 24, 0)]
    out += [(520, [], 0), (521, [], 0), (525, [0.5, -0.25], 0), (526, [-0.015625, 3.0], 0), (1000, [0.3] * 24, 0)]
    return out


@pytest.mark.parametrize("blocks", [(1024, 4096), (7, 50)])
def test_whole_result_against_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", blocks[1])
    monkeypatch.setattr(topk, "SAMPLE", blocks[1] // 2)
    given = rows()
    vectors = table(spark, given).withColumn("row", F.lit(1)).withColumn("id", F.lit("x"))
    found = topk.top_k(vectors, F.col("vec_id") % 5 == 0, k=7).collect()
    single = [[(i, [float(F_) if F_ is not None else None for F_ in v] if v is not None else None, n)] for i, v, n in given]
    import numpy as np

    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], n) for [(i, v, n)] in single]
    assert sorted(tuple(r) for r in found) == plain(exact, lambda i: i % 5 == 0, 7)


def test_bounds_never_fall_below_scores():
    import numpy as np

    rng = np.random.default_rng(9)
    for n in (1, 3, 16, 50):
        a, b = rng.integers(-80, 80, (30, n)), rng.integers(-80, 80, (30, n))
        exact = topk.scores(a, b)
        for left, right in zip(topk.levels(a.astype(float)), topk.levels(b.astype(float))):
            assert (left @ right.T >= exact - 1e-6).all()


def plain_block(query_ids, queries, ids, vectors, k):
    out = []
    for at, q in enumerate(queries):
        scored = sorted((-int(q @ v), int(ids[j]), j) for j, v in enumerate(vectors) if ids[j] != query_ids[at])
        out += [(at, j, -s) for s, _, j in scored[:k]]
    return out


@pytest.mark.parametrize("floors", ["none", "true", "low"])
@pytest.mark.parametrize("kind", ["random", "clustered", "equal"])
def test_blocks_against_brute_force(monkeypatch, floors, kind):
    import numpy as np

    monkeypatch.setattr(topk, "QUERIES_AT_ONCE", 16)
    monkeypatch.setattr(topk, "CANDIDATES_AT_ONCE", 50)
    rng = np.random.default_rng(4)
    if kind == "clustered":
        centres = rng.integers(-60, 60, (6, 40))
        vectors = centres[rng.integers(0, 6, 300)] + rng.integers(-3, 4, (300, 40))
    else:
        vectors = rng.integers(-60, 60, (300, 40))
    if kind == "equal":
        vectors[rng.integers(0, 300, 120)] = vectors[0]
    ids = rng.permutation(300)
    queries, query_ids = vectors[:35], ids[:35]
    expected = plain_block(query_ids, queries, ids, vectors, 5)
    last = np.array([min(s for at, _, s in expected if at == i) for i in range(35)], float)
    given = {"none": np.full(35, -np.inf), "true": last, "low": last - 500}[floors]
    found = topk.search_block(query_ids, queries, given, ids, vectors, 5)
    assert sorted(zip(*(x.tolist() for x in found))) == sorted(expected)


def test_levels_discard_clustered_pairs():
    """Vectors of clusters whose segments differ in mean: coarse levels leave little more than the pairs within clusters."""
    import numpy as np

    rng = np.random.default_rng(6)
    centres = np.repeat(rng.integers(-60, 60, (20, 16)), 4, axis=1)
    vectors = centres[rng.integers(0, 20, 3000)] + rng.integers(-4, 5, (3000, 64))
    queries, ids = vectors[:200], np.arange(3000)
    floors = topk.floors_of(ids[:200], queries, ids[200:1200], vectors[200:1200], 10)
    seen = []
    topk.search_block(ids[:200], queries, floors, ids, vectors, 10, seen)
    assert 0 < sum(left for level, _, left in seen if level == 2) < 0.1 * 200 * 3000


def test_fine_levels_discard_random_pairs():
    import numpy as np

    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(6000, 64))
    vectors = np.floor(64 * vectors / np.linalg.norm(vectors, axis=1)[:, None]).astype(np.int64)
    ids = np.arange(6000)
    floors = topk.floors_of(ids[:300], vectors[:300], ids[:4096], vectors[:4096], 20)
    seen = []
    topk.search_block(ids[:300], vectors[:300], floors, ids, vectors, 20, seen)
    left = {}
    for level, _, n in seen:
        left[level] = left.get(level, 0) + n
    assert left[max(left)] < 0.15 * 300 * 6000


def test_large_numbers_are_exact_or_refused():
    import numpy as np

    big = np.array([[2_000_000_011, 1]], np.int64)
    assert topk.scores(big, big)[0, 0] == 2_000_000_011**2 + 1
    with pytest.raises(ValueError):
        topk.scores(big * 100, big)


def test_empty_and_too_few(spark):
    assert topk.top_k(table(spark, []), F.col("vec_id") % 5 == 0).collect() == []
    found = topk.top_k(table(spark, [(0, [1.0], 0), (1, [2.0], 0)]), F.col("vec_id") % 5 == 0).collect()
    assert [tuple(r) for r in found] == [(0, 1, 1, 64 * 128)]
    assert topk.top_k(table(spark, [(1, [1.0], 0)]), F.col("vec_id") % 5 == 0).collect() == []


def test_repeated_candidates_count_each(spark):
    given = [(0, [1.0], 0), (1, [2.0], 0), (1, [2.0], 0), (0, [5.0], 0)]
    found = topk.top_k(table(spark, given), F.col("vec_id") == 0, k=2).collect()
    assert sorted((r["query_id"], r["vec_id"], r["score"]) for r in found) == [(0, 1, 8192)] * 2 + [(0, 1, 40960)] * 2
