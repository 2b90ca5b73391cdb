import random
import re

from helpers import documents, empty, with_clashes
from tallyloom.llm import licenses

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(licenses.WORD, (text or "").translate(LOW))


def plain_base(text):
    """(words, places, first, last, labels) of the base phrases, place by place."""
    found = words(text)
    hits = []
    for phrase, label in licenses.BASE:
        p = phrase.split()
        hits += [(i, label) for i in range(len(found)) if found[i : i + len(p)] == p]
    at = [i for i, _ in hits]
    return len(found), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({h for _, h in hits}))


def texts():
    rng = random.Random(10)
    bits = ["cc", "by", "CC BY", "general", "public", "license", "All rights", "reserved", "x", "nc", "K", "É", "mit", "-", "\n", "GNU General Public License"]
    out = [rng.choice([" ", ", "]).join(rng.choices(bits, k=rng.randrange(0, 40))) for _ in range(150)]
    return out + [None, "", "...", "cc by " * 20_000, "CC BY-NC 4.0", "cc", "ALL RIGHTS RESERVED."]


def test_base_against_brute_force(spark):
    all_texts = texts()
    docs = with_clashes(documents(spark, all_texts))
    docs = docs.unionByName(docs.where("doc_id = 1"))
    rows = licenses.scan(docs).orderBy("doc_id").collect()
    assert len(rows) == len(all_texts) + 1
    for r in rows:
        found = (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])
        assert found == plain_base(all_texts[r["doc_id"]])
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def test_long_wordings_with_words_changed_put_in_and_left_out(spark):
    grant = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
    texts = [
        grant,
        grant.replace("hereby ", ""),
        grant.replace("any person", "any other natural person"),
        grant.replace("granted", "given"),
        " ".join(grant.split()[:6]),
        " ".join(reversed(grant.split())),
    ]
    rows = licenses.scan(documents(spark, texts)).orderBy("doc_id").collect()
    assert [r["labels"] for r in rows] == ["mit", "mit", "mit", "mit", "", ""]
    assert rows[0]["score"] == 1 and 0.7 < rows[1]["score"] < 1 and rows[5]["score"] == 0


def changed(text, rng, share):
    """The words with about a share of them changed, left out or followed by another."""
    out = []
    for word in text.split():
        draw = rng.random() / share
        out += [word] if draw >= 1 else [["zz"], [], [word, "qq"]][int(draw * 3)]
    return " ".join(out)


def test_whole_license_texts(spark):
    rng = random.Random(4)
    noise = "the software is in the copies of the software and or the use of the license with this notice in all of it "
    plain, marked = [], []
    for text, label in licenses.WHOLE:
        plain += [f"{noise * 30}{text} {noise * 30}", f"{noise * 3}{changed(text, rng, 0.06)} {noise * 3}", f"{text} {text}"]
        marked += [label] * 3
        # Half of a text, or its words in another order, is not the text.
        words = text.split()
        plain += [" ".join(rng.sample(words, len(words)))]
        marked += [None]
    rows = licenses.scan(documents(spark, [*plain, noise * 200])).orderBy("doc_id").collect()
    for r, label in zip(rows, marked):
        assert (label in r["labels"].split(",")) if label else r["labels"] == "", (r, label)
    assert rows[-1]["labels"] == "" and rows[-1]["score"] == 0


def test_templates_from_a_table(spark, monkeypatch):
    rng = random.Random(8)
    long = " ".join(f"w{rng.randrange(400)}" for _ in range(500))
    table = spark.createDataFrame(
        [("long", long, None, 1), ("short", "one two", True, 2), ("short", "One, two", True, 3), ("again", "one two", False, 4),
         ("single", "one", True, 5), (None, "one two", True, 6), ("none", None, True, 7)],
        "label string, text string, base boolean, words int",
    )
    texts = [f"x y {long} z", changed(long, rng, 0.08), " ".join(long.split()[:250]), "one two one two", "one", "", None]
    docs = with_clashes(documents(spark, texts))

    def found():
        return [
            (r["labels"], r["base_labels"], r["n_base"], r["first_word"], r["last_word"])
            for r in licenses.scan(docs, templates=table).orderBy("doc_id").collect()
        ]

    nothing = ("", "", 0, None, None)
    expected = [("long", "", 0, None, None)] * 2 + [nothing, ("again,short", "short", 2, 0, 2)] + [nothing] * 3
    assert found() == expected
    # Too many for a broadcast, and none at all.
    monkeypatch.setattr(licenses, "BROADCAST_GRAMS", 0)
    assert found() == expected
    table = empty(table)
    assert found() == [nothing] * 7


def test_null_ids_and_empty_table(spark):
    rows = licenses.scan(documents(spark, ["cc by", "cc by", None], ids=[None, None, None])).collect()
    assert sorted(r["n_base"] for r in rows) == [0, 1, 1]
    assert licenses.scan(empty(documents(spark, ["a"]))).collect() == []


def test_no_python_in_the_plan(spark):
    plan = licenses.scan(documents(spark, ["cc by"]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
