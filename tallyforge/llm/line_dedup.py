"""Removal of repeated runs of lines, by a suffix array over sequences of lines.

The lines of a document that hold a word are its sequence.  Prefix doubling gives every position, round by
round, the rank of the 1, 2, 4, ... lines that start there among all such runs: the pairs of two ranks
are sorted and numbered by a distributed sort.  A position whose run is found nowhere else has its
place in the suffix array and leaves; one that stays belongs to an interval of suffixes with a common
prefix of at least that many lines.  The first position of an interval (by doc_id, then by place) is the
original, all others are later copies.

A run of m lines that occurs earlier is covered by the runs of 2^k <= m lines within it, which all occur earlier
as well; so the intervals of the powers of two find every line of every repeated run.  Positions that
follow each other and point to lines that follow each other make up the maximal runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered, same, stage, word_count

#: A run counts if it has two lines or more, or one line of so many words.
LEAST_WORDS = 10

#: Numbers of removed lines are broadcast up to this size, and joined beyond it.
BROADCAST_BYTES = 64_000_000


def lines_with_words(text: Column) -> Column:
    r"""The \n-separated lines that hold a word, as they are; none for null."""
    listed = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    return F.filter(listed, lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def _lines(documents: DataFrame) -> DataFrame:
    """doc (id and key of the text), line, two hashes and the words of every line."""
    doc = F.struct("doc_id", F.xxhash64("text").alias("text_key")).alias("doc")
    listed = documents.select(doc, F.posexplode(lines_with_words(F.col("text"))).alias("line", "body"))
    lines = stage(
        listed.select(
            "doc",
            "line",
            F.xxhash64("body").alias("h"),
            F.xxhash64(F.lit("line"), "body").alias("g"),
            word_count(F.col("body")).alias("words"),
        ),
        "lines",
    )
    again = lines.filter("line = 0").groupBy("doc").count().filter("count > 1")
    if again.isEmpty():
        return lines
    return stage(lines.dropDuplicates(["doc", "line"]), "lines")  # rows repeated with id and text


def _ranked(runs: DataFrame, keys: list[str], level: int) -> DataFrame:
    """Positions whose run (named by ``keys``) is found twice or more, with its rank and first place."""
    place = F.struct("doc", "line")
    classes = runs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
    ranks = numbered(classes.filter("n > 1").drop("n"), [], keys, "rank")
    return stage(
        runs.join(ranks, keys).select("doc", "line", "words", "rank", "first"), f"rank{level}"
    )


def later_copies(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All lines, and the positions that start a later copy: ``length`` lines, and the ``first`` place.

    The length is the largest power of two for which an earlier copy exists.
    """
    lines = _lines(documents)
    ranked, level, found = _ranked(lines, ["h", "g"], 0), 0, None
    while not ranked.isEmpty():
        here = ranked.filter(F.struct("doc", "line") != F.col("first")).select(
            "doc", "line", "words", F.lit(2**level).alias("length"), "first"
        )
        found = here if found is None else found.union(here)
        onward = ranked.select(
            "doc", (F.col("line") - 2**level).alias("line"), F.col("rank").alias("onward")
        )
        pairs = ranked.select("doc", "line", "words", "rank").join(onward, ["doc", "line"])
        ranked = _ranked(
            pairs.withColumnRenamed("rank", "lead").select("doc", "line", "words", "lead", "onward"),
            ["lead", "onward"],
            level + 1,
        )
        level += 1
    if found is None:
        place = F.struct("doc", "line").alias("first")
        return lines, lines.select("doc", "line", "words", F.lit(1).alias("length"), place).limit(0)
    top = F.max(F.struct("length", "first")).alias("top")
    copies = found.groupBy("doc", "line", "words").agg(top).select("doc", "line", "words", "top.*")
    return lines, stage(copies, "copies")


def repeated_runs(documents: DataFrame, least_words: int = LEAST_WORDS) -> tuple[DataFrame, DataFrame]:
    """All lines, and the runs to delete: doc, ``start``, ``end`` (excluded) and the ``first`` place.

    Runs may overlap; each is a maximal stretch along one earlier copy.
    """
    lines, copies = later_copies(documents)
    wanted = copies.filter((F.col("length") > 1) | (F.col("words") >= least_words))
    ahead = Window.partitionBy("doc").orderBy("line")
    aligned = (
        (F.lag("line").over(ahead) == F.col("line") - 1)
        & (F.lag("first.doc").over(ahead) == F.col("first.doc"))
        & (F.lag("first.line").over(ahead) == F.col("first.line") - 1)
    )
    marked = wanted.withColumn("new", F.when(aligned, 0).otherwise(1))
    chained = marked.withColumn("chain", F.sum("new").over(ahead))
    runs = chained.groupBy("doc", "chain").agg(
        F.min("line").alias("start"),
        F.max(F.col("line") + F.col("length")).alias("end"),
        F.min(F.struct("line", "first"))["first"].alias("first"),
    )
    return lines, runs.drop("chain")


def removed_lines(documents: DataFrame, least_words: int = LEAST_WORDS) -> tuple[DataFrame, DataFrame]:
    """All lines, and doc and line of those to delete, each once."""
    lines, runs = repeated_runs(documents, least_words)
    each = F.explode(F.sequence(F.col("start"), F.col("end") - 1)).alias("line")
    return lines, stage(runs.select("doc", each).distinct(), "removed")


def _cut(text: Column, gone: Column) -> Column:
    """``text`` without those of its lines with words whose numbers are in ``gone``; in linear time."""

    def of_lines(lines: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(lines) - 1)
        holding = F.filter(every, lambda i: F.get(lines, i).rlike(r"[^\x20\x09-\x0D]"))

        def of_places(places: Column) -> Column:
            dropped = F.transform(gone, lambda g: F.get(places, g))
            kept = F.array_except(every, dropped)
            return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")

        return F.get(F.transform(F.array(holding), of_places), F.lit(0))

    # A bound variable each, so that lines and places are found once.
    return F.get(F.transform(F.array(F.split(text, "\n", -1)), of_lines), F.lit(0))


def without_lines(documents: DataFrame, removed: DataFrame) -> DataFrame:
    """``documents`` with the lines of a stored ``removed`` (see ``removed_lines``) cut from ``text``."""
    gone = removed.groupBy("doc").agg(F.collect_set("line").alias("_llm_gone"))
    gone = stage(gone.select("doc.doc_id", F.col("doc.text_key").alias("_llm_key"), "_llm_gone"), "gone")
    weight = gone.agg(F.sum(64 + 4 * F.size("_llm_gone"))).first()[0] or 0
    keyed = documents.withColumn("_llm_key", F.xxhash64("text"))
    listed = F.broadcast(gone) if weight <= BROADCAST_BYTES else gone
    joined = keyed.join(listed, same(keyed, gone, ["doc_id", "_llm_key"]), "left")
    others = [keyed[c] for c in documents.columns if c != "text"]
    whole = F.col("_llm_gone").isNull()
    new = F.when(whole, keyed["text"]).otherwise(_cut(keyed["text"], F.col("_llm_gone"))).alias("text")
    return joined.select(*others, new).select(documents.columns)


def without_repeated_lines(documents: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """The documents with later copies of repeated runs cut from ``text``; other columns as given.

    Lines without words stay.  A null text stays null; a text all of whose lines go becomes the
    lines without words that are left, or empty.  Rows repeated with id and text are one document
    and stay alike.  Texts of any length are cut as a whole.  An empty table gives no rows.
    """
    return without_lines(documents, removed_lines(documents, least_words)[1])


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    """For every document: lines with words, those removed, the stretches they form, words kept, and the
    SHA-256 and bytes of the text that is left (of a null text: of nothing)."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    lines, removed = removed_lines(documents)
    before = Window.partitionBy("doc").orderBy("line")
    starts = F.when(F.lag("line").over(before) == F.col("line") - 1, 0).otherwise(1)
    stretches = removed.withColumn("starts", starts).groupBy("doc").agg(F.sum("starts").alias("n_runs"))
    gone = removed.withColumn("gone", F.lit(1))
    counts = (
        lines.join(gone, ["doc", "line"], "left")
        .groupBy("doc")
        .agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.count("gone").alias("n_removed"),
            F.sum(F.when(F.col("gone").isNull(), F.col("words")).otherwise(0)).alias("kept_words"),
        )
    )
    found = counts.join(stretches, "doc", "left").select("doc.*", "n_lines", "n_removed", "n_runs", "kept_words")
    found = stage(found, "counts")
    kept = F.coalesce(F.col("text"), F.lit(""))
    # The cut text beside the key of the whole one, which the counts have.
    marked = documents.withColumn("text_key", F.xxhash64("text"))
    rows = without_lines(marked, removed).select(
        "doc_id",
        "text_key",
        F.octet_length(kept).cast("long").alias("kept_bytes"),
        F.sha2(kept.cast("binary"), 256).alias("kept_sha256"),
    )
    none = F.lit(0).cast("long")
    return rows.join(found, same(rows, found, ["doc_id", "text_key"]), "left").select(
        rows["doc_id"],
        *(F.coalesce(found[c], none).alias(c) for c in ("n_lines", "n_removed", "n_runs", "kept_words")),
        "kept_bytes",
        "kept_sha256",
    )


SQL = r"""
WITH docs AS (SELECT DISTINCT doc_id, text FROM documents),
numbered AS (SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, text) AS d, doc_id, text FROM docs),
listed AS (
  SELECT d, doc_id, text, string_split(coalesce(text, ''), chr(10)) AS every, list_filter(every,
    lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM numbered
),
lines AS (
  SELECT d, i, ls[i] AS body, ls[i + 1] AS following,
    len(regexp_extract_all(ls[i], '[^\x20\x09-\x0D]+')) AS words
  FROM listed, unnest(range(1, len(ls) + 1)) AS t(i)
),
copies AS (
  SELECT *, row_number() OVER (PARTITION BY body ORDER BY d, i) > 1 AS one,
    following IS NOT NULL AND row_number() OVER (PARTITION BY body, following ORDER BY d, i) > 1 AS two
  FROM lines
),
marked AS (
  SELECT d, i, words,
    (one AND words >= 10) OR two OR coalesce(lag(two) OVER (PARTITION BY d ORDER BY i), false) AS gone
  FROM copies
),
stretched AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY d ORDER BY i), false) AS starts FROM marked
),
counted AS (
  SELECT d, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, count(*) FILTER (starts) AS n_runs,
    coalesce(sum(words) FILTER (NOT gone), 0)::BIGINT AS kept_words
  FROM stretched GROUP BY d
),
spread AS (
  SELECT d, j, every[j] AS line, regexp_matches(every[j], '[^\x20\x09-\x0D]') AS has
  FROM listed, unnest(range(1, len(every) + 1)) AS t(j)
),
placed AS (SELECT *, sum(has::INT) OVER (PARTITION BY d ORDER BY j) AS i FROM spread),
left_over AS (
  SELECT p.d, string_agg(line, chr(10) ORDER BY j) FILTER (NOT (has AND coalesce(gone, false))) AS body
  FROM placed p LEFT JOIN marked m ON p.d = m.d AND p.i = m.i GROUP BY p.d
)
SELECT o.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
  coalesce(n_runs, 0) AS n_runs, coalesce(kept_words, 0) AS kept_words,
  octet_length(encode(coalesce(body, '')))::BIGINT AS kept_bytes, sha256(coalesce(body, '')) AS kept_sha256
FROM documents o
JOIN numbered n ON o.doc_id IS NOT DISTINCT FROM n.doc_id AND o.text IS NOT DISTINCT FROM n.text
LEFT JOIN counted c USING (d) LEFT JOIN left_over USING (d)
"""
