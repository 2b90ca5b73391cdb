"""License scans by diagonal voting, in DataFrame functions only.

Every pair of consecutive words of every text is joined by its hash to the places it has in the templates
(the words themselves are compared too). A hit votes for the diagonal ``place in text - place in template``; votes are
combined before the shuffle into one bit mask per 63 places of a template, text and diagonal. A diagonal with all
places is a verbatim copy that starts where the diagonal says. For longer templates, neighbouring diagonals
are merged, so that a few words put in, left out or changed don't hide a copy; what covers enough of the template, over
a span that is not much longer than it, is a verified match. Diagonals with fewer than ``LEAST_VOTES`` votes that are also for less than a
``1 / LEAST_PART`` of the template are chance hits of common pairs and are not merged.

Templates are short phrases and whole license texts, or a table of (label, text) of any length and number.

Defined cases: a null or empty text has no words and no labels (empty text, null places, score 0). Equal rows
and null ids are rows of their own; further columns play no part. An empty table gives an empty result. Templates without label or
of fewer than two words are never found; those of equal label and words count once.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import keep

#: Diagonals at most this far apart are merged.
NEIGHBOURS = 2
#: Share of a template's grams that a merged match must cover; templates of up to EXACT_WORDS words must be verbatim.
COVERAGE = 0.75
EXACT_WORDS = 5
#: A diagonal needs this many votes, or votes for this part of a template's grams, to be merged with others.
LEAST_VOTES, LEAST_PART = 4, 20
#: Places per bit mask: those of a long that leave the sign alone.
MASK_PLACES = 63
#: Tables of templates with up to this many grams (about 100 bytes each) are broadcast.
BROADCAST_GRAMS = 200_000

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Phrases that are counted, and their labels.
BASE = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)
# Wordings of common licenses.
FURTHER = (
    ("cc by nc", "cc-by-nc"),
    ("cc by sa", "cc-by-sa"),
    ("cc by nd", "cc-by-nd"),
    ("mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("apache license", "apache"),
    ("you may not use this file except in compliance with the license", "apache"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("lesser general public license", "lgpl"),
    ("affero general public license", "agpl"),
    ("mozilla public license", "mpl"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("no part of this publication may be reproduced without the prior written permission of the publisher", "reserved"),
)
# Whole license texts.
WHOLE = (
    (
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software.
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
        WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
        COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
        OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
        "mit",
    ),
    (
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met:
        1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
        disclaimer.
        2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
        disclaimer in the documentation and/or other materials provided with the distribution.
        THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
        INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
        DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
        SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
        LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
        CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
        SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
        "bsd",
    ),
    (
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.
        THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
        IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
        INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
        ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
        THIS SOFTWARE.""",
        "isc",
    ),
    (
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
        the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
        "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
        language governing permissions and limitations under the License.""",
        "apache",
    ),
)
SHIPPED = [(i, label, i < len(BASE), text) for i, (text, label) in enumerate((*BASE, *FURTHER, *WHOLE))]


def words_of(text: Column) -> Column:
    """Words of a text with A-Z in lower case; never null.

    ``lower`` also turns other letters into small ones, which no word boundary depends on. The Kelvin sign would become
    an ASCII k, so it is put out of the way first.
    """
    low = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u0138")))
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(0))


def numbered(spark: SparkSession, templates: DataFrame | None) -> DataFrame:
    """(template, label, base, text): the given table, or the templates that come with the module."""
    if templates is None:
        return spark.createDataFrame(SHIPPED, "template long, label string, base boolean, text string")
    base = F.coalesce(F.col("base"), F.lit(False)) if "base" in templates.columns else F.lit(False)
    text = F.array_join(words_of(F.col("text")), " ")
    given = templates.select("label", base.alias("base"), text.alias("text")).where(F.col("label").isNotNull()).distinct()
    # Numbers must not change between the uses of the table.
    return keep(given.select(F.monotonically_increasing_id().alias("template"), "label", "base", "text"), "templates")


def grams(templates: DataFrame) -> DataFrame:
    """One row per place of a template, with its gram and the gram's hash, and the number of the template's grams."""
    split = templates.withColumn("words", words_of(F.col("text"))).where(F.size("words") >= 2)
    placed = split.select(
        "template", "label", "base", (F.size("words") - 1).alias("grams"), "words",
        F.explode(F.sequence(F.lit(0), F.size("words") - 2)).alias("place"),
    )
    return placed.select(
        "template",
        "label",
        "base",
        "grams",
        "place",
        F.floor(F.col("place") / MASK_PLACES).cast("int").alias("chunk"),
        F.expr(f"shiftleft(1L, place % {MASK_PLACES})").alias("bit"),
        F.get("words", F.col("place")).alias("w1"),
        F.get("words", F.col("place") + 1).alias("w2"),
    ).withColumn("hash", F.xxhash64("w1", "w2"))


def hits(docs: DataFrame, text: str, key: str, known: DataFrame) -> DataFrame:
    """(row, key, n_words, template and its facts, chunk, diagonal, places); a row without template for texts without a hit."""
    split = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), words_of(F.col(text)).alias("words")
    )
    zipped = F.arrays_zip("words", F.slice("words", 2, F.greatest(F.size("words"), F.lit(1))).alias("next"))
    rolling = split.select("row", "key", F.size("words").cast("long").alias("n_words"), F.posexplode_outer(zipped).alias("pos", "gram"))
    hashed = rolling.select("row", "key", "n_words", "pos", F.col("gram")["words"].alias("a"), F.col("gram")["next"].alias("b"))
    joined = hashed.join(
        known,
        (F.xxhash64("a", "b") == F.col("hash")) & (F.col("a") == F.col("w1")) & (F.col("b") == F.col("w2")),
        "left",
    )
    # The first word stands for texts in which nothing hits.
    return (
        joined.where(F.col("template").isNotNull() | F.col("pos").isNull() | (F.col("pos") == 0))
        .withColumn("diagonal", F.col("pos") - F.col("place"))
        .groupBy("row", "key", "n_words", "template", "label", "base", "grams", "chunk", "diagonal")
        .agg(F.bit_or("bit").alias("places"))
    )


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id", templates: DataFrame | None = None) -> DataFrame:
    """(key, n_words, n_base, first_word, last_word, base_labels, labels, score) of every text.

    ``templates`` has columns ``label``, ``text`` and, if phrases are to be counted, ``base``. A table of them is broadcast
    if its size, which is measured, allows; else the pairs of words are shuffled to it.
    """
    known = grams(numbered(docs.sparkSession, templates))
    if templates is None or known.count() <= BROADCAST_GRAMS:
        known = F.broadcast(known)
    # By row alone, which all steps that follow can use as it is.
    found = hits(docs, text, key, known).repartition("row")

    votes = F.sum(F.bit_count("places")).over(Window.partitionBy("row", "template", "diagonal"))
    enough = (F.col("votes") >= LEAST_VOTES) | (F.col("votes") * LEAST_PART >= F.col("grams"))
    strong = F.coalesce(enough, F.lit(False))
    by_diagonal = Window.partitionBy("row", "template", "strong").orderBy("diagonal", "chunk")
    step = F.col("diagonal") - F.lag("diagonal").over(by_diagonal)
    cluster = F.sum(F.when(F.col("step") <= NEIGHBOURS, 0).otherwise(1)).over(by_diagonal)
    merged = (
        found.withColumn("votes", votes)
        .withColumn("strong", strong)
        .withColumn("step", step)
        .withColumn("cluster", F.when(F.col("strong"), cluster).otherwise(0))
    )
    whole = F.col("votes") == F.col("grams")
    facts = ["row", "key", "n_words", "template", "label", "base", "grams", "strong", "cluster"]
    masks = merged.groupBy(*facts, "chunk").agg(
        F.count_if(whole & (F.col("chunk") == 0)).alias("verbatim"),
        F.min(F.when(whole, F.col("diagonal"))).alias("first"),
        F.max(F.when(whole, F.col("diagonal"))).alias("last"),
        F.bit_count(F.bit_or("places")).alias("covered"),
        F.min("diagonal").alias("lowest"),
        F.max("diagonal").alias("highest"),
    )
    clusters = masks.groupBy(*facts).agg(
        F.sum("verbatim").alias("verbatim"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.sum("covered").alias("covered"),
        (F.max("highest") - F.min("lowest")).alias("drift"),
    )
    share = F.col("covered") / F.col("grams")
    inexact = F.col("strong") & (F.col("grams") >= EXACT_WORDS)
    near = inexact & (share >= COVERAGE) & (F.col("drift") <= F.col("grams"))
    matched = (F.col("verbatim") > 0) | F.coalesce(near, F.lit(False))
    base = F.col("base") & (F.col("verbatim") > 0)
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return (
        clusters.groupBy("row", "key", "n_words")
        .agg(
            F.sum(F.when(F.col("base"), F.col("verbatim")).otherwise(0)).alias("n_base"),
            F.min(F.when(base, F.col("first"))).cast("long").alias("first_word"),
            F.max(F.when(base, F.col("last"))).cast("long").alias("last_word"),
            joined(F.when(base, F.col("label"))).alias("base_labels"),
            joined(F.when(matched, F.col("label"))).alias("labels"),
            F.coalesce(F.max(F.when(matched, F.when(F.col("verbatim") > 0, 1.0).otherwise(share))), F.lit(0.0)).alias("score"),
        )
        .select(F.col("key").alias(key), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    )


def _oracle() -> str:
    quoted = lambda s: "'" + s + "'"
    split = [(t, label, base, re.findall(WORD, text.lower())) for t, label, base, text in SHIPPED]
    grams_ = ", ".join(f"({t}, {p}, {quoted(a)}, {quoted(b)})" for t, _, _, w in split for p, (a, b) in enumerate(zip(w, w[1:])))
    facts_ = ", ".join(
        f"({t}, {quoted(label)}, {str(base).lower()}, {len(w) - 1}, {str(len(w) <= EXACT_WORDS).lower()})"
        for t, label, base, w in split
    )
    return f"""
with split as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') as words
  from documents
), gram(template, place, w1, w2) as (values {grams_}),
fact(template, label, base, grams, exact) as (values {facts_}),
rolling as (
  select doc_id, unnest(range(len(words) - 1)) as pos, unnest(words[:len(words) - 1]) as a, unnest(words[2:]) as b
  from split where len(words) >= 2
), voted as (
  select doc_id, template, pos - place as diagonal, count(distinct place) as n, list(distinct place) as places
  from rolling join gram on a = w1 and b = w2 group by all
), strong as (
  select voted.* from voted join fact using (template) where n >= {LEAST_VOTES} or n * {LEAST_PART} >= grams
), stepped as (
  select *, case when diagonal - lag(diagonal) over w <= {NEIGHBOURS} then 0 else 1 end as fresh
  from strong window w as (partition by doc_id, template order by diagonal)
), numbered as (
  select *, sum(fresh) over (partition by doc_id, template order by diagonal) as cluster from stepped
), clusters as (
  select doc_id, template, cluster, label, base, grams, exact, count(*) filter (n = grams) as verbatim,
    min(diagonal) filter (n = grams) as first, max(diagonal) filter (n = grams) as last,
    len(list_distinct(flatten(list(places)))) as covered, max(diagonal) - min(diagonal) as drift
  from numbered join fact using (template) group by all
), judged as (
  select *, verbatim > 0 or (not exact and covered / grams >= {COVERAGE} and drift <= grams) as matched,
    base and verbatim > 0 as counted
  from clusters
), summed as (
  select doc_id, sum(case when base then verbatim else 0 end) as n_base,
    min(first) filter (counted) as first_word, max(last) filter (counted) as last_word,
    array_to_string(list_sort(list_distinct(list(label) filter (counted))), ',') as base_labels,
    array_to_string(list_sort(list_distinct(list(label) filter (matched))), ',') as labels,
    max(case when matched then case when verbatim > 0 then 1.0::double else covered / grams end end) as score
  from judged group by doc_id
)
select s.doc_id, len(words)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word,
  last_word::bigint as last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
  coalesce(score, 0.0)::double as score
from split s left join summed using (doc_id)
"""


ORACLE_SQL = _oracle()
