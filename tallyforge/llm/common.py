"""Shared helpers: staged tables, gapless numbering, broadcasts of checked size, word patterns."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word is a run of characters outside ASCII white space (all other characters count as word).
WORD = r"[^\x20\x09-\x0D]+"

#: A side is broadcast only up to this many rows of a few dozen bytes (some tens of megabytes);
#: beyond it the same join runs as a shuffle join.
BROADCAST_ROWS = 500_000


def work_folder(spark: SparkSession) -> str:
    """The shared folder the session names in ``spark.checkpoint.dir``.

    Without that setting a local session gets a temporary folder of its own; a cluster gets an
    error, because a folder of one machine would not be seen by the others.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tallyforge-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the work folder and read it back: computed once, safe from lost executors.

    A task writes one file, whatever the session says of rows in a file: ``numbered`` counts on it.
    """
    spark = df.sparkSession
    path = f"{work_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("maxRecordsPerFile", 0).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, marked for broadcast if it has at most ``rows`` rows; give a staged frame."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def as_text(df: DataFrame, *ids: str) -> DataFrame:
    """``df`` with ``ids`` as text, for the way through pandas, where a null would turn them into floats."""
    return df.withColumns({c: F.col(c).cast("string") for c in ids})


def as_long(df: DataFrame, *ids: str) -> DataFrame:
    """The way back of ``as_text``."""
    return df.withColumns({c: F.col(c).cast("long") for c in ids})


def same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    """Null-safe equality on all ``names``."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def lowered(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """Add the gapless position ``name`` (long, from 0) of each row in its group, by ``order``.

    The rows are range-partitioned by group and order, with a running number as last key so
    that even equal rows are split over tasks, sorted and stored.  Each stored file is then one
    stretch of the global order: a position is the row's place in the file plus the sizes of the
    group's earlier files, which is one small table.  No group is ever gathered in one task.

    Null keys sort first; rows equal in all keys are numbered in any order.
    """
    tie = "_llm_tie"
    keys = [F.col(c).asc_nulls_first() for c in [*group, *order, tie]]
    ranged = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*keys)
    stored = stage(ranged.sortWithinPartitions(*keys).drop(tie), "numbered")
    file = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long")
    placed = stored.select(
        "*", file.alias("_llm_file"), F.col("_metadata.row_index").alias("_llm_row")
    )
    stretches = placed.groupBy(*group, "_llm_file").agg(
        F.count(F.lit(1)).alias("_llm_n"), F.min("_llm_row").alias("_llm_first")
    )
    earlier = Window.partitionBy(*group).orderBy("_llm_file").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = stage(
        stretches.withColumn("_llm_offset", F.coalesce(F.sum("_llm_n").over(earlier), F.lit(0))),
        "offsets",
    )
    joined = placed.join(small(offsets), same(placed, offsets, [*group, "_llm_file"]))
    return joined.select(
        *(placed[c] for c in df.columns),
        (placed["_llm_row"] - offsets["_llm_first"] + offsets["_llm_offset"]).alias(name),
    )
