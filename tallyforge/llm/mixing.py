"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies, its source's target over its
size.  Their prefix sum runs over the documents in order of size; with one random offset for the
source, a document is emitted once for each whole number its stretch crosses.  The order by size
spreads the copies evenly over short and long documents, which keeps the words taken within about
one document of the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered, same, small, stage, word_count

#: Fixed by the contract: weights of the sources in order, and the most copies of a document.
WEIGHTS = (5, 2, 1)
MOST = 3


def source_targets(
    totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST
) -> DataFrame:
    """Add ``target`` (double) to ``source`` and ``source_size``, one row each.

    Sources by code point, null last, take ``weights`` in turn and share the sum of all sizes; a
    target stops at ``most`` times its source's size and what is over goes to the others by weight.
    Each round of the water level is an aggregate of one row; sources stay on the executors.
    """
    ordered = numbered(
        totals.withColumn("_llm_last", F.col("source").isNull()), [], ["_llm_last", "source"], "place"
    )
    choice = F.array(*(F.lit(w) for w in weights))
    table = stage(
        ordered.withColumn("weight", F.element_at(choice, (F.col("place") % len(weights) + 1).cast("int"))),
        "sources",
    )
    full = F.col("source_size") * most
    level, capped = None, -1
    while True:
        over = F.lit(False) if level is None else full < F.col("weight") * F.lit(level)
        row = table.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(over, full)).alias("stopped"),
            F.sum(F.when(~over, F.col("weight"))).alias("shares"),
            F.count(F.when(over, 1)).alias("capped"),
        ).first()
        if row["capped"] == capped or not row["shares"]:
            break
        level, capped = (row["all"] - (row["stopped"] or 0)) / row["shares"], row["capped"]
    share = F.col("weight") * F.lit(level or 0.0)
    target = F.when(full < share, full.cast("double")).otherwise(share)
    return table.select("source", "source_size", target.alias("target"))


def offset(source: Column, seed: int) -> Column:
    """The source's random offset: a 20-bit fraction in [0, 1) from md5 of seed and name."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), source), F.lit("null")))
    return F.conv(F.substring(F.md5(name), 1, 5), 16, 10).cast("double") / 1048576


def copies(
    df: DataFrame,
    tie: list[str],
    seed: int = 0,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
) -> DataFrame:
    """Add ``source_size``, ``target`` and ``copies`` to rows that have ``source`` and ``size``.

    A null source is a source of its own; null sizes count as 0; rows of a source without words
    get no copy.  Equal rows are told apart by position only, reruns agree on the multiset of
    results.  Columns with the result's names are replaced; an empty table stays empty.
    """
    df = df.drop("source_size", "target", "copies").withColumn(
        "size", F.coalesce(F.col("size"), F.lit(0)).cast("long")
    )
    totals = df.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stage(source_targets(totals, weights, most), "targets")
    placed = numbered(df, ["source"], ["size", *tie], "_llm_at")
    joined = placed.join(small(targets), same(placed, targets, ["source"])).select(
        placed["*"], "source_size", "target"
    )
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    start, at = offset(F.col("source"), seed), F.col("_llm_at")
    crossed = F.floor(start + expected * (at + 1)) - F.floor(start + expected * at)
    return joined.withColumn("copies", F.least(crossed, F.lit(most).cast("long"))).drop("_llm_at")


def emit(df: DataFrame) -> DataFrame:
    """Each row as often as its ``copies`` says; the column goes."""
    often = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return df.filter(F.col("copies") > 0).withColumn("_llm_copy", often).drop("copies", "_llm_copy")


def mixed(documents: DataFrame) -> DataFrame:
    """The documents of the mix, each as often as it is taken; columns as given."""
    row = F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("_llm_doc")
    sized = documents.select(row, "source", "doc_id", word_count(F.col("text")).alias("size"))
    return emit(copies(sized, ["doc_id"])).select("_llm_doc.*")


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    """The mix of all documents as words taken from each."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sizes = stage(
        documents.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes"
    )
    mixed = copies(sizes, ["doc_id"])
    return mixed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "source",
        "copies",
    )


SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT] AS weight
  FROM totals
),
filled AS (
  SELECT *, row_number() OVER o AS k,
    (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0))::DOUBLE
      / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
  FROM weighed
  WINDOW o AS (ORDER BY 3.0 * source_size / weight, source IS NULL, source),
    before AS (ORDER BY 3.0 * source_size / weight, source IS NULL, source
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
first_free AS (SELECT k, level FROM filled WHERE level * weight <= 3 * source_size ORDER BY k LIMIT 1),
targets AS (
  SELECT f.source, f.source_size,
    CASE WHEN f.k < x.k THEN (3 * f.source_size)::DOUBLE ELSE f.weight * x.level END AS target,
    ('0x' || substr(md5('0:' || coalesce('s' || f.source, 'null')), 1, 5))::BIGINT::DOUBLE / 1048576 AS start
  FROM filled f, first_free x
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS FIRST) - 1 AS place FROM sized
),
drawn AS (
  SELECT p.*, t.source_size, t.target, t.start,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END::DOUBLE AS expected
  FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source
),
counted AS (
  SELECT *, least(floor(start + expected * (place + 1)) - floor(start + expected * place), 3)::BIGINT AS copies
  FROM drawn
)
SELECT doc_id, size, source_size, target, copies * size AS taken, source, copies FROM counted
"""
