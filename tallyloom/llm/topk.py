"""Exact top-k inner products with bounds from segment statistics at several resolutions.

Every component x becomes floor(scale * x), and the score of a query and a candidate is their integer inner product. As
``2 * score = |q|^2 + |c|^2 - distance^2``, a lower bound of the distance is an upper bound of the score. The vectors are
cut into segments; from a segment's mean and standard deviation on both sides follows a lower bound of its
share of the distance, tighter the finer the cut. The levels go from 1 segment to 4, 16, half and three quarters of the components.

A pair survives a level if its bound reaches the k-th best score that the query is known to have. That floor is found once per query
row, in a bounded sample of the candidates, and rises while a block of candidates is searched piece by piece. Bounds of a piece are one
matrix product per level over the queries and candidates that still have survivors. A level whose bounds would discard little, as a few
queries show, is passed over for the next. Survivors get their exact score, singly where they are few. Bounds only discard pairs that
can't be among the first k, so the result is exact whatever the floors.

Every block of queries meets every block of candidates, as a stated set of queries is searched against all rows;
blocks are of fixed size and dealt by a hash of the id, so equal vectors spread. Of each meeting at most k rows per
query go on.

Defined cases: a vector that is null, or holds null or a non-finite component, takes no part; only vectors of the same length
are compared, empty ones among each other with score 0. A candidate with the query's own id is left out, whatever its
vector. Repeated candidates count as often as they occur; of several queries with one id, each gets its own rows. Scores
are whole numbers up to 2^63; a vector whose scores could be larger raises an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import keep, one_thread

SCALE = 64
QUERY_BLOCK = 8192
CANDIDATE_BLOCK = 8192
#: Queries and candidates whose pairs are looked at together.
QUERIES_AT_ONCE = 1024
CANDIDATES_AT_ONCE = 2048
#: Candidates that give queries their first floor, and their components together; bounds of the broadcast, not of the search.
SAMPLE = 4096
SAMPLE_COMPONENTS = 1 << 20
#: Queries that show whether a level is worth while, and the share of pairs that it has to discard.
TRIED = 32
WORTH = 0.1
#: Below this share of pairs, survivors are looked at one by one.
FEW = 0.02
EXACT_FLOAT = float(1 << 53)


def usable(vector: Column) -> Column:
    """TRUE where a vector holds finite numbers only."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return vector.isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False))


def floored(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Per vector, segment by segment, mean and deviation times the root of the segment's length.

    The inner product of two such rows bounds the inner product of the vectors.
    """
    n = vectors.shape[1]
    out = []
    for part in np.array_split(np.arange(n), min(segments, max(n, 1))):
        values = vectors[:, part]
        root = np.sqrt(max(len(part), 1))
        mean = values.sum(1) / max(len(part), 1)
        spread = np.sqrt(np.maximum(((values - mean[:, None]) ** 2).sum(1), 0))
        out.append(mean * root)
        if len(part) > 1:
            out.append(spread)
    return np.stack(out, 1)


def cuts(dim: int) -> list[int]:
    """Numbers of segments from coarse to fine; as many as there are components would be the score itself."""
    return sorted({n for n in (1, 4, 16, dim // 2, 3 * dim // 4) if 0 < n < dim})


def levels(vectors: np.ndarray) -> list[np.ndarray]:
    return [statistics(vectors, n) for n in cuts(vectors.shape[1])]


def scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of two integer matrices."""
    limit = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * max(left.shape[1], 1)
    if limit < EXACT_FLOAT:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    if limit < 2.0**63:
        return left @ right.T
    raise ValueError("inner products of these vectors don't fit in 64 bits")


def slack_of(queries: np.ndarray, candidates: np.ndarray) -> float:
    """What rounding may take from a bound."""
    most = lambda x: float(np.abs(x).sum(1).max(initial=0))
    return 1e-9 * most(queries) * most(candidates) + 1e-6


def surviving(
    queries: list[np.ndarray], candidates: list[np.ndarray], floors: np.ndarray, seen: list[list[int]] | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs, as two lists of places, that no level discards. ``seen`` gets (level, pairs it looked at, pairs it left)."""
    rows, columns = np.arange(len(floors)), np.arange(len(candidates[0]))
    alive: np.ndarray | None = None
    pairs: tuple[np.ndarray, np.ndarray] | None = None
    share = 1.0
    for level, (q, c) in enumerate(zip(queries, candidates)):
        slack = slack_of(q, c)
        if pairs is not None:
            kept = np.einsum("ij,ij->i", q[pairs[0]], c[pairs[1]]) + slack >= floors[pairs[0]]
            if seen is not None:
                seen.append([level, len(kept), int(kept.sum())])
            pairs = pairs[0][kept], pairs[1][kept]
            continue
        tried = rows[:: max(1, len(rows) // TRIED)]
        would = q[tried] @ c[columns].T + slack >= floors[tried, None]
        if would.mean() > (1 - WORTH) * share:
            continue
        left = q[rows] @ c[columns].T + slack >= floors[rows, None]
        looked = left.size if alive is None else int(alive.sum())
        alive = left if alive is None else alive & left
        # Queries and candidates without a survivor go.
        some_rows, some_columns = alive.any(1), alive.any(0)
        if some_rows.mean() * some_columns.mean() < 0.7:
            rows, columns, alive = rows[some_rows], columns[some_columns], alive[np.ix_(some_rows, some_columns)]
        if seen is not None:
            seen.append([level, looked, int(alive.sum())])
        share = float(alive.mean()) if alive.size else 0.0
        if share < FEW:
            at = np.nonzero(alive)
            pairs = rows[at[0]], columns[at[1]]
    if pairs is None:
        if alive is None:
            return np.repeat(rows, len(columns)), np.tile(columns, len(rows))
        at = np.nonzero(alive)
        pairs = rows[at[0]], columns[at[1]]
    return pairs


def exact(queries: np.ndarray, candidates: np.ndarray, at: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Scores of pairs."""
    if len(at[0]) > FEW * len(queries) * len(candidates):
        return scores(queries, candidates)[at]
    limit = float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0)) * max(queries.shape[1], 1)
    if limit >= 2.0**63:
        raise ValueError("inner products of these vectors don't fit in 64 bits")
    return np.einsum("ij,ij->i", queries[at[0]], candidates[at[1]])


def first_k(of: np.ndarray, ids: np.ndarray, found: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best per query: highest score, then smallest id; in order."""
    order = np.lexsort((ids, -found, of))
    starts = np.searchsorted(of[order], of[order], "left")
    return order[np.arange(len(order)) - starts < k]


def search_block(
    query_ids: np.ndarray,
    queries: np.ndarray,
    floors: np.ndarray,
    ids: np.ndarray,
    vectors: np.ndarray,
    k: int,
    seen: list[list[int]] | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query's place, candidate's place, score) of up to k candidates per query that reach its floor."""
    of_queries, of_vectors = levels(queries.astype(np.float64)), levels(vectors.astype(np.float64))
    found = []
    for a in range(0, len(queries), QUERIES_AT_ONCE):
        some = slice(a, a + QUERIES_AT_ONCE)
        floor = floors[some].astype(np.float64)
        best = (np.empty(0, np.int64),) * 3
        for b in range(0, len(vectors), CANDIDATES_AT_ONCE):
            part = slice(b, b + CANDIDATES_AT_ONCE)
            if of_queries:
                at = surviving([q[some] for q in of_queries], [c[part] for c in of_vectors], floor, seen)
            else:
                at = tuple(x.ravel() for x in np.indices((len(floor), len(vectors[part]))))
            score = exact(queries[some], vectors[part], at)
            good = (score >= floor[at[0]]) & (query_ids[some][at[0]] != ids[part][at[1]])
            best = tuple(np.concatenate(x) for x in zip(best, (at[0][good], at[1][good] + b, score[good])))
            first = first_k(best[0], ids[best[1]], best[2], k)
            best = tuple(x[first] for x in best)
            # A query that has k rows can only be interested in scores from its last one on.
            last = np.flatnonzero(np.bincount(best[0], minlength=len(floor)) == k)
            ends = np.searchsorted(best[0], last, "right") - 1
            floor[last] = np.maximum(floor[last], best[2][ends])
        found.append((best[0] + a, best[1], best[2]))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 3


def floors_of(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> np.ndarray:
    """k-th best score of each query among the sample, or minus infinity if it is smaller than that."""
    out = np.full(len(queries), -np.inf)
    if len(ids) <= k:
        return out
    for a in range(0, len(queries), QUERIES_AT_ONCE):
        some = slice(a, a + QUERIES_AT_ONCE)
        found = scores(queries[some], vectors).astype(np.float64)
        found[query_ids[some][:, None] == ids[None, :]] = -np.inf
        out[some] = np.partition(found, -k, axis=1)[:, -k]
    return out


def matrix(listed: pd.Series) -> np.ndarray:
    return np.array([np.asarray(x, np.int64) for x in listed]).reshape(len(listed), -1)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
) -> DataFrame:
    """(query_id, rank, key, score): the k best other rows of every row for which ``is_query`` holds."""
    rows = keep(
        vectors.where(usable(F.col(vector)) & F.col(key).isNotNull()).select(
            F.col(key).cast("long").alias("id"),
            floored(F.col(vector), scale).alias("v"),
            F.size(vector).alias("dim"),
            F.coalesce(is_query, F.lit(False)).alias("query"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "vectors",
    )
    counts = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.count_if("query").alias("queries"))
    blocks = F.broadcast(
        counts.select(
            F.col("dim").alias("d"),
            F.ceil(F.col("n") / CANDIDATE_BLOCK).cast("int").alias("candidate_blocks"),
            F.ceil(F.col("queries") / QUERY_BLOCK).cast("int").alias("query_blocks"),
        )
    )
    longest = rows.agg(F.max("dim")).first()[0] or 1
    size = max(1, min(SAMPLE, SAMPLE_COMPONENTS // max(longest, 1)))
    sample = [(r["id"], r["v"]) for r in rows.orderBy(F.xxhash64("row")).select("id", "v").limit(size).collect()]
    shared = vectors.sparkSession.sparkContext.broadcast(sample)

    def with_floors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one_thread()
        for batch in batches:
            batch["floor"] = -np.inf
            for dim in batch["dim"].unique():
                alike = [(i, v) for i, v in shared.value if len(v) == dim]
                of_dim = batch["dim"] == dim
                if alike:
                    known = np.array([v for _, v in alike], np.int64).reshape(len(alike), -1)
                    floors = floors_of(
                        batch.loc[of_dim, "id"].to_numpy(), matrix(batch.loc[of_dim, "v"]), np.array([i for i, _ in alike]), known, k
                    )
                    batch.loc[of_dim, "floor"] = floors
            yield batch

    place = F.xxhash64("id", "row")
    candidates = (
        rows.join(blocks, F.col("dim") == F.col("d"))
        .where("query_blocks > 0")
        .withColumn("cb", F.pmod(place, F.col("candidate_blocks")).cast("int"))
        .withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)))
    )
    floored_queries = rows.where("query").select("id", "v", "dim", "row").mapInPandas(
        with_floors, "id long, v array<long>, dim int, row long, floor double"
    )
    queries = (
        floored_queries.join(blocks, F.col("dim") == F.col("d"))
        .withColumn("qb", F.pmod(place, F.col("query_blocks")).cast("int"))
        .withColumn("cb", F.explode(F.sequence(F.lit(0), F.col("candidate_blocks") - 1)))
    )

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        one_thread()
        if not len(left) or not len(right):
            return pd.DataFrame({"query_row": [], "query_id": [], "id": [], "score": []}).astype("int64")
        ids, query_ids = right["c_id"].to_numpy(), left["id"].to_numpy()
        at, of, score = search_block(query_ids, matrix(left["v"]), left["floor"].to_numpy(), ids, matrix(right["c_v"]), k)
        return pd.DataFrame(
            {"query_row": left["row"].to_numpy()[at], "query_id": query_ids[at], "id": ids[of], "score": score.astype(np.int64)}
        )

    cell = ["dim", "qb", "cb"]
    met = (
        queries.select(*cell, "row", "id", "v", "floor")
        .groupBy(*cell)
        .cogroup(candidates.select(*[F.col(c).alias(f"c_{c}") for c in (*cell, "id", "v")]).groupBy(*[f"c_{c}" for c in cell]))
        .applyInPandas(meet, "query_row long, query_id long, id long, score long")
    )
    order = Window.partitionBy("query_row", "query_id").orderBy(F.desc("score"), "id")
    return (
        met.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(key), "score")
    )


ORACLE_SQL = f"""
with v as (
  select vec_id, list_transform(embedding, lambda x: floor({SCALE}.0::double * x::double)::bigint) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and vec_id is not null
), scored as (
  select q.vec_id as query_id, c.vec_id as vec_id,
    list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
  where q.vec_id % 20 = 0
)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
from scored
qualify row_number() over (partition by query_id order by score desc, vec_id) <= 20
"""
