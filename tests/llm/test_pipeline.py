import pytest

import corpus_pipeline
from helpers import documents, empty, with_clashes
from tallyloom.llm.common import keep


@pytest.fixture(scope="module")
def steps(spark, sample_dir):
    """Each stage's rows, by its name, and the documents at first."""
    docs = spark.read.parquet(f"{sample_dir}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = keep(stage(spark, docs, sample_dir), name)
        out.append((name, docs))
    return out


def ids(df):
    return [r["doc_id"] for r in df.select("doc_id").collect()]


def test_stages_in_order(steps):
    assert [n for n, _ in steps[1:]] == ["toxicity", "simhash_near_dedup", "substring_dedup", "decontamination", "mixing"]
    columns = steps[0][1].columns
    for _, df in steps[:-1]:
        assert df.columns == columns
    assert steps[-1][1].columns[: len(columns)] == columns


def test_each_stage_works_on_what_is_left(steps):
    for (_, before), (name, after) in zip(steps, steps[1:]):
        was, now = ids(before), ids(after)
        assert len(now) == len(set(now)) and set(now) <= set(was), name
        if name in ("substring_dedup", "mixing"):
            assert sorted(was) == sorted(now), name


def test_stages_against_brute_force(steps):
    """What near-dedup and substring dedup leave, found by comparing everything."""
    from test_simhash import plain_components, plain_fingerprint
    from test_substrings import plain

    by_name = dict(steps)
    given = sorted((r["doc_id"], r["text"]) for r in by_name["toxicity"].collect())
    roots = set(plain_components([plain_fingerprint(t) for _, t in given]))
    assert sorted(ids(by_name["simhash_near_dedup"])) == [given[i][0] for i in sorted(roots)]
    given = sorted((r["doc_id"], r["text"]) for r in by_name["simhash_near_dedup"].collect())
    left = {r["doc_id"]: r for r in by_name["substring_dedup"].collect()}
    for (doc_id, text), (_, removed, kept) in zip(given, plain(given)):
        assert left[doc_id]["text"] == (kept if removed else text) and left[doc_id]["n_chars"] == len(left[doc_id]["text"])


def test_the_mix_comes_near_its_targets(steps):
    sources = {}
    for r in steps[-1][1].collect():
        assert r["taken"] == r["copies"] * r["size"] and r["copies"] <= 3
        s = sources.setdefault(r["source"], [0, r["target"], 0])
        s[0] += r["taken"]
        s[2] = max(s[2], r["size"])
    assert all(abs(taken - target) <= longest for taken, target, longest in sources.values())


def test_run_gives_the_last_stage(spark, sample_dir, steps):
    same = lambda df: sorted(repr(tuple(r)) for r in df.collect())
    assert same(corpus_pipeline.run(spark, sample_dir)) == same(steps[-1][1])


def test_awkward_documents(spark, sample_dir):
    text = " ".join(f"w{i}" for i in range(40))
    docs = documents(spark, [None, "", text, text, text + " x", " \n", "漢字"], ids=[1, 2, 3, 3, None, None, 9])
    docs = with_clashes(docs)
    for given in (docs, empty(docs)):
        left = given
        for name, stage in corpus_pipeline.STAGES:
            left = keep(stage(spark, left, sample_dir), name)
            if name != "mixing":
                assert left.columns == docs.columns
        # Texts without words are one group of near copies; so are the three long ones.
        assert left.count() == (0 if given is not docs else 3)


def test_the_corpus_holds_every_document_as_often_as_the_mix_takes_it(spark, sample_dir, steps, monkeypatch):
    import __spark_entry__ as entry

    mixed = steps[-1][1]
    monkeypatch.setattr(corpus_pipeline, "run", lambda spark, sf_dir: mixed)
    found = entry.queries()["pipeline"](spark, sample_dir)
    assert found.columns == mixed.columns
    rows = mixed.collect()
    assert {r["copies"] for r in rows} - {1}
    expected = sorted(repr(tuple(r)) for r in rows for _ in range(r["copies"]))
    assert sorted(repr(tuple(r)) for r in found.collect()) == expected
    words = {}
    for r in found.collect():
        words[r["source"]] = words.get(r["source"], 0) + r["size"]
    taken = {}
    for r in rows:
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    assert words == {s: n for s, n in taken.items() if n}


def test_rows_without_copies_go(spark):
    mixed = spark.createDataFrame([(1, 0), (2, 1), (2, 1), (None, 3)], "doc_id long, copies long")
    assert sorted(ids(corpus_pipeline.repeated(mixed)), key=str) == [2, 2, None, None, None]
