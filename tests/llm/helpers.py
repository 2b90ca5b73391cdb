"""Small fixtures with the awkward cases that every operator must take."""

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, lang="en", source="s", ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, lang, source, None if t is None else len(t)) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOCS)


def with_clashes(docs):
    """Further columns whose names operators like to use themselves."""
    names = ("_row", "_fp", "_bundle", "_seq", "_scored", "_toxic", "row", "key", "bundle", "of", "id", "words", "pos")
    return docs.withColumns({n: F.lit(i) for i, n in enumerate(names)})


def empty(df):
    return df.where("false")


def by_key(rows, key="doc_id"):
    return {r[key]: r for r in rows}
