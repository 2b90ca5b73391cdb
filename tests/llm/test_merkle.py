import hashlib
import random

import pytest
from pyspark.sql import functions as F

from helpers import by_key, documents, empty, with_clashes
from tallyloom.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row):
    return h(*[field(row[f]) for f in merkle.FIELDS])


def levels_of(nodes):
    levels = [nodes]
    while len(nodes) > 1:
        nodes = [h(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
        levels.append(nodes)
    return levels


def siblings(levels, rank):
    out = []
    for nodes in levels[:-1]:
        start = rank // 16 * 16
        out += [(nodes[start:rank], nodes[rank + 1 : start + 16])]
        rank //= 16
    return out


def brute(rows):
    """Per (source, id, leaf): subroot, root and the siblings level by level."""
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        of = [((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)), r) for r in rows if r["source"] == s]
        of.sort(key=lambda x: x[0])
        trees[s] = ([r for _, r in of], levels_of([k[2] for k, _ in of]))
    top = levels_of([trees[s][1][-1][0] for s in sources])
    out = []
    for i, s in enumerate(sources):
        for rank, r in enumerate(trees[s][0]):
            path = siblings(trees[s][1], rank) + siblings(top, i)
            out.append((r["doc_id"], leaf(r), trees[s][1][-1][0], top[-1][0], ["".join(a + b) for a, b in path]))
    return out


def proofs(docs, **options):
    return merkle.prove(merkle.build(docs, **options))


def as_rows(found):
    listed = found.select("doc_id", "leaf", "subroot", "root", "steps").collect()
    return [(r[0], r[1], r[2], r[3], [s["left"] + s["right"] for s in r[4]]) for r in listed]


def varied(spark, sizes, seed=0):
    rng = random.Random(seed)
    rows = []
    for source, n in sizes.items():
        for i in rng.sample(range(10 * n + 1), n):
            rows.append((i, f"Text {i} Ä", rng.choice(["en", None]), source, rng.choice([None, 7])))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 1},
        {"a": 2, None: 1},
        {"a": 16, "b": 17, "c": 33},
        {"hot": 300, **{f"s{i}": 1 + i % 3 for i in range(20)}, "é": 5, "z": 2},
    ],
)
def test_proofs_are_those_of_plain_trees(spark, sizes):
    docs = varied(spark, sizes)
    found = as_rows(proofs(with_clashes(docs)))
    assert sorted(found) == sorted(brute(docs.collect()))


def test_a_proof_leads_to_the_root_and_a_changed_leaf_does_not(spark):
    docs = varied(spark, {"a": 40, "b": 3, None: 1})
    found = proofs(docs, carry={"small": merkle.tampered_leaf()})
    folded = found.select(
        "root", merkle.folded(F.col("leaf"), F.col("steps")).alias("same"), merkle.folded(F.col("small"), F.col("steps")).alias("other")
    ).collect()
    assert all(r["same"] == r["root"] for r in folded) and all(r["other"] != r["root"] for r in folded)


def test_only_what_is_asked_for_is_proved(spark):
    manifest = merkle.build(varied(spark, {"a": 300, "b": 20, "c": 1}))
    whole = by_key(merkle.prove(manifest).collect(), "leaf")
    wanted = manifest.rows.where("rank in (0, 17, 299)").select("tree", "rank")
    some = merkle.prove(manifest, wanted).collect()
    assert len(some) == wanted.count() > 3
    assert all(r["steps"] == whole[r["leaf"]]["steps"] for r in some)


def test_nulls_empty_texts_ties_and_equal_rows(spark):
    rows = [(None, None, None, None, None), (1, "", "", "", 0), (1, "", "", "", 0), (1, "x", "", "", 0), (None, "A" * 100_000, None, "", None)]
    rows += [(7, "copy", "en", "s", 4)] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = as_rows(proofs(docs))
    assert sorted(found, key=repr) == sorted(brute(docs.collect()), key=repr)


def test_equal_rows_are_spread(spark):
    docs = spark.range(4000).select(F.lit(7).alias("doc_id"), F.lit("t").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).alias("n_chars"))
    hashed = docs.select(F.col("doc_id").alias("key"), "source", merkle.leaf_of(*[F.col(f) for f in merkle.FIELDS]).alias("leaf"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tied = hashed.repartition(8).withColumn("tie", F.monotonically_increasing_id())
        parts = merkle.numbered(tied, ["source", "key", "leaf", "tie"], "ties").groupBy("part").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(parts) == 4 and max(r["count"] for r in parts) < 2000
    assert merkle.by_source(hashed).agg(F.countDistinct("rank"), F.max("rank")).first() == (4000, 3999)


def test_equal_subtrees_share_a_record(spark):
    docs = spark.createDataFrame([(1, "t", "en", "s", 1)] * 64, "doc_id long, text string, lang string, source string, n_chars long")
    manifest = merkle.build(docs)
    assert manifest.sources.levels[0].count() == 4 and manifest.sources.records(1).count() == 1


def test_empty_table(spark):
    assert proofs(empty(varied(spark, {"a": 2}))).collect() == []


def test_heights(spark):
    counts = [1, 2, 16, 17, 256, 257, 4096, 4097, 16**10]
    found = spark.createDataFrame([(c,) for c in counts], "n long").select(merkle.height_of(F.col("n"))).collect()
    assert [r[0] for r in found] == [0, 1, 1, 2, 2, 3, 3, 4, 10]


def broadcast_columns(plan):
    """Columns of all that a physical plan broadcasts in its hash joins."""
    children = [plan.children().apply(i) for i in range(plan.children().size())]
    found = {c for child in children for c in broadcast_columns(child)}
    if plan.nodeName().startswith("Broadcast"):
        side = plan.left() if plan.buildSide().toString() == "BuildLeft" else plan.right()
        found |= {side.output().apply(i).name() for i in range(side.output().size())}
    return found


def test_paths_and_leaves_are_not_broadcast_whatever_their_files_take(spark, monkeypatch):
    plans, kept = [], merkle.keep
    monkeypatch.setattr(merkle, "keep", lambda df, name: plans.append(df) or kept(df, name))
    docs = varied(spark, {"hot": 300, **{f"s{i}": 1 + i % 3 for i in range(40)}})
    plans.append(proofs(docs))
    sent = [broadcast_columns(p._jdf.queryExecution().sparkPlan()) for p in plans]
    assert any(sent) and not any({"path", "leaf"} & columns for columns in sent)
    assert not {"rank", "block"} & sent[-1]


def test_roots_are_a_table(spark):
    manifest = merkle.build(varied(spark, {"a": 40, "b": 3, "c": 1}))
    for forest in (manifest.sources, manifest.top):
        assert "Union" not in forest.roots._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r["tree"], r["height"]) for r in manifest.sources.roots.collect()) == [(0, 2), (1, 1), (2, 0)]


def test_a_sort_brings_few_rows_to_the_driver(spark, monkeypatch):
    name, seen, kept = "spark.sql.execution.rangeExchange.sampleSizePerPartition", [], merkle.keep
    monkeypatch.setattr(merkle, "keep", lambda df, to: seen.append((to, int(spark.conf.get(name)))) or kept(df, to))
    before = spark.conf.get(name)
    merkle.build(varied(spark, {"a": 40, "b": 3}))
    assert {to: n for to, n in seen if to in ("leaves", "sources")} == {"leaves": 20, "sources": 20}
    assert spark.conf.get(name) == before
