"""License phrases and notices in texts, found by votes for diagonals.

Every run of k words of a text is hashed and joined to its places in the templates.  Such a meeting votes
for a diagonal, the distance between its place in the text and its place in the template; a copy of
a template is a diagonal with many votes, or a few neighbouring ones where words were added or left
out.  Neighbours are merged into a span, and a span counts where the words it shares with the
template make up enough of both.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stage

#: What stands between words: ASCII other than letters and digits, after A-Z was lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class Template(NamedTuple):
    """A text to look for; ``drift`` words more or less, at a time, do not end a copy of it."""

    label: str
    text: str
    base: bool = False
    gram: int = 2
    drift: int = 0
    least: float = 1.0

    @property
    def words(self) -> list[str]:
        return [w for w in re.split(SEPARATORS, self.text.lower()) if w]


#: Fixed by the contract: phrases and labels of the base columns.
BASE = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)
#: Further phrases, by the names that the licenses go by.
PHRASES = (
    ("agpl", "gnu affero general public license"),
    ("lgpl", "gnu lesser general public license"),
    ("lgpl", "gnu library general public license"),
    ("gpl", "spdx license identifier gpl"),
    ("apache", "spdx license identifier apache"),
    ("mit", "spdx license identifier mit"),
    ("bsd", "spdx license identifier bsd"),
    ("bsd", "bsd license"),
    ("bsd", "bsd 2 clause"),
    ("bsd", "bsd 3 clause"),
    ("cc-by", "creative commons attribution"),
    ("cc-by-nc", "cc by nc"),
    ("cc-by-nd", "cc by nd"),
    ("cc-by-sa", "cc by sa"),
    ("epl", "eclipse public license"),
    ("isc", "isc license"),
    ("mpl", "mozilla public license"),
)
#: The notices that licenses ask authors to put into their files.
NOTICES = (
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions",
    ),
    (
        "apache",
        "you may not use this file except in compliance with the License. You may obtain a copy of the "
        "License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
        "is hereby granted, provided that the above copyright notice and this permission notice appear in "
        "all copies",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
        "MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain",
    ),
)
#: Words of a notice's runs, the words that may be added or missing in one place, and the share of
#: words that a copy has in common with the notice.
NOTICE = {"gram": 5, "drift": 8, "least": 0.8}

TEMPLATES = (
    *(Template(label, text, base=True) for label, text in BASE),
    *(Template(label, text) for label, text in PHRASES),
    *(Template(label, text, **NOTICE) for label, text in NOTICES),
)


def folded(text: Column) -> Column:
    """``text`` with A-Z in lower case; beyond ASCII only what words are told apart by stays certain.

    Only the Kelvin sign has an ASCII letter alone for its lower case; it becomes another letter first.
    """
    return F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u0138")))


def _hash(words: Column, at: Column, gram: int) -> Column:
    return F.xxhash64(*(F.get(words, at + i) for i in range(gram)))


def template_grams(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """``hash, gram, template, place``: the runs of all templates, as many rows as these have words."""
    every: DataFrame | None = None
    for size in sorted({t.gram for t in templates}):
        rows = [
            (t.words[i : i + size], number, i)
            for number, t in enumerate(templates)
            if t.gram == size
            for i in range(len(t.words) - size + 1)
        ]
        frame = spark.createDataFrame(rows, "gram array<string>, template int, place int")
        frame = frame.select(_hash(F.col("gram"), F.lit(0), size).alias("hash"), "*")
        every = frame if every is None else every.unionByName(frame)
    return every


def votes(documents: DataFrame, templates: tuple[Template, ...]) -> DataFrame:
    """Each meeting of a text's run of words with a template's, as ``template, place, at``, and one row
    without a template per document, as ``doc_id, row, n_words``.

    The runs never leave the task: they meet the templates' in a hash join with the latter broadcast,
    whose size follows from the templates alone.  Words are compared too, so hashes need not differ.
    """
    grams = template_grams(documents.sparkSession, templates)
    words = F.array_remove(F.split(folded(F.col("text")), SEPARATORS), F.lit(""))
    # An empty word in front stands for the document itself.
    told = documents.select(
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        F.concat(F.array(F.lit("")), words).alias("words"),
    )
    sizes = sorted({t.gram for t in templates})
    runs = told.select("*", F.posexplode("words").alias("at", "word"))
    hashes = F.array(*(_hash(F.col("words"), F.col("at"), k) for k in sizes))
    runs = runs.select("*", F.posexplode(hashes).alias("which", "run_hash"))
    met = (F.col("run_hash") == F.col("hash")) & (
        F.slice("words", F.col("at") + 1, F.size("gram")) == F.col("gram")
    )
    itself = (F.col("at") == 0) & (F.col("which") == 0)
    joined = runs.join(F.broadcast(grams), met, "left").filter(F.col("template").isNotNull() | itself)
    return joined.select(
        "doc_id", "row", (F.size("words") - 1).cast("long").alias("n_words"), "template", "place",
        (F.col("at") - 1).alias("at"),
    )


def _of(templates: tuple[Template, ...], value) -> Column:
    """A template's value by its number."""
    return F.get(F.array(*(F.lit(value(t)) for t in templates)), F.col("template"))


def spans(met: DataFrame, templates: tuple[Template, ...]) -> DataFrame:
    """Verified copies of templates: ``row, template, label, base, start, end, score``.

    ``score`` is the number of the template's words that the span has in runs, against the longer of the
    span and the template.  A document's votes are gathered by its row number, so that a text
    with any number of copies is the most that one group holds.
    """
    diagonal = (F.col("at") - F.col("place")).alias("diagonal")
    by_diagonal = (
        met.filter(F.col("template").isNotNull())
        .repartition("row")
        .groupBy("row", "template", diagonal)
        .agg(F.collect_set("place").alias("places"), F.min("at").alias("start"), F.max("at").alias("last"))
    )
    in_text = Window.partitionBy("row", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(in_text)
    apart = F.coalesce(gap > _of(templates, lambda t: t.drift), F.lit(True))
    merged = (
        by_diagonal.withColumn("apart", apart.cast("int"))
        .withColumn("span", F.sum("apart").over(in_text))
        .groupBy("row", "template", "span")
        .agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("places")))).alias("places"),
            F.min("start").alias("start"),
            F.max("last").alias("last"),
        )
    )
    gram, length = _of(templates, lambda t: t.gram), _of(templates, lambda t: len(t.words))
    # A run covers its words up to where the next run begins.
    covered = F.aggregate(
        F.sequence(F.lit(1), F.size("places")),
        F.lit(0),
        lambda so_far, i: so_far + F.least(F.coalesce(F.get("places", i), length) - F.get("places", i - 1), gram),
    )
    end = F.col("last") + gram
    scored = merged.withColumns({"end": end, "covered": covered}).withColumn(
        "score", F.col("covered").cast("double") / F.greatest(F.col("end") - F.col("start"), length)
    )
    return scored.filter(F.col("score") >= _of(templates, lambda t: t.least)).select(
        "row", "template", _of(templates, lambda t: t.label).alias("label"),
        _of(templates, lambda t: t.base).alias("base"), "start", "end", "score",
    )


def scan(documents: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """One row per document with what was found in it; see ``op12_license_scan`` for the columns.

    Rows are told apart by their own number, so that null and repeated ids have a row each.  A null
    or empty text has no words and no labels; a phrase at a text's end counts, one across two texts
    does not.  Texts of any length are scanned whole, by a list of their words.  Columns other than
    ``doc_id`` and ``text`` are not read.
    """
    met = stage(votes(documents, templates), "votes")
    base = F.col("base")
    listed = lambda label: F.array_join(F.array_sort(F.collect_set(label)), ",")
    found = spans(met, templates).groupBy(F.col("row").alias("_row")).agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        listed(F.when(base, F.col("label"))).alias("base_labels"),
        listed(F.col("label")).alias("labels"),
        F.max("score").alias("score"),
    )
    documents_ = met.filter(F.col("at") == -1)
    return documents_.join(found, F.col("row") == F.col("_row"), "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def op12_license_scan(spark, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def sql(templates: tuple[Template, ...] = TEMPLATES) -> str:
    """The query in DuckDB's SQL, with the templates as rows."""
    rows = ",\n  ".join(
        f"({i}, '{t.label}', {t.base}, {t.gram}, {t.drift}, {t.least}::DOUBLE, {t.words})"
        for i, t in enumerate(templates)
    )
    return rf"""
WITH templates(template, label, base, k, drift, least, tw) AS (VALUES
  {rows}
),
body AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
template_grams AS (
  SELECT template, k, i AS place, array_to_string(tw[i + 1 : i + k], ' ') AS gram
  FROM templates, range(0, len(tw) - k + 1) t(i)
),
text_grams AS (
  SELECT r, k, i AS pos, array_to_string(w[i + 1 : i + k], ' ') AS gram
  FROM body, (SELECT DISTINCT k FROM templates), range(0, len(w) - k + 1) t(i)
),
diagonals AS (
  SELECT r, template, pos - place AS diagonal, list(DISTINCT place) AS places, min(pos) AS start_word,
    max(pos) AS last_run
  FROM text_grams JOIN template_grams USING (k, gram) GROUP BY ALL
),
cut AS (
  SELECT d.*, coalesce(diagonal - lag(diagonal) OVER w > drift, true)::INT AS apart
  FROM diagonals d JOIN templates USING (template)
  WINDOW w AS (PARTITION BY r, template ORDER BY diagonal)
),
numbered AS (
  SELECT *, sum(apart) OVER (PARTITION BY r, template ORDER BY diagonal) AS span FROM cut
),
merged AS (
  SELECT r, template, span, list_sort(list_distinct(flatten(list(places)))) AS places, min(start_word) AS start_word,
    max(last_run) AS last_run
  FROM numbered GROUP BY ALL
),
scored AS (
  SELECT r, label, base, least, start_word,
    list_sum(list_transform(range(1, len(places) + 1),
      lambda i: least(coalesce(places[i + 1], len(tw)) - places[i], k)))::DOUBLE
      / greatest(last_run + k - start_word, len(tw)) AS score
  FROM merged JOIN templates USING (template)
),
found AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(start_word) FILTER (base) AS first_word,
    max(start_word) FILTER (base) AS last_word,
    array_to_string(list_sort(list(DISTINCT label) FILTER (base)), ',') AS base_labels,
    array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(score) AS score
  FROM scored WHERE score >= least GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
FROM body LEFT JOIN found USING (r)
"""


SQL = sql()
