"""One trustworthy name per key from a dimension with repeated and conflicting rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.values import blank

# Every executor holds a copy; a shuffle of the fact costs far more than this.
BROADCAST_BYTES = 256 * 1024 * 1024


def _clean(frame: DataFrame, key: str, name: str) -> DataFrame:
    value = F.col(name)
    return frame.select(F.col(key), F.when(~blank(value), F.trim(value)).alias("_name"))


def canonical_names(frame: DataFrame, key: str, name: str, missing_key: str) -> DataFrame:
    """One row per key: the only distinct non-blank name, or the key itself.

    The smallest and the largest name tell none, one and several names apart, so the state per
    key is two values however many rows and names a key has.
    """
    spread = _clean(frame, key, name).groupBy(key).agg(
        F.min("_name").alias("_low"), F.max("_name").alias("_high")
    )
    several = F.coalesce(F.col("_low") != F.col("_high"), F.lit(False))
    return spread.select(
        key,
        F.when(F.col(key).isNull(), F.lit(missing_key))
        .when(F.col("_low").isNull() | several, F.col(key))
        .otherwise(F.col("_low"))
        .alias(name),
        several.alias(f"{name}_ambiguous"),
    )


def conflicting_names(frame: DataFrame, key: str, name: str) -> DataFrame:
    """One row for each distinct non-blank name of a key that has several: key and ``nonblank_name``.

    Two values per key tell which keys those are; the names of all others are dropped before any
    names are told apart.
    """
    cleaned = _clean(frame, key, name).filter(F.col("_name").isNotNull())
    spread = cleaned.groupBy(F.col(key).alias("_key")).agg(
        F.min("_name").alias("_low"), F.max("_name").alias("_high")
    )
    several = spread.filter(F.col("_low") != F.col("_high")).select("_key")
    kept = cleaned.join(several, F.col(key).eqNullSafe(F.col("_key")), "left_semi")
    return kept.distinct().withColumnRenamed("_name", "nonblank_name")


def name_conflicts(names: DataFrame, key: str) -> DataFrame:
    """``conflicting_names`` as one row per key, with the names in order: a view for reading."""
    return names.groupBy(key).agg(
        F.sort_array(F.collect_list("nonblank_name")).alias("nonblank_names"),
        F.count("nonblank_name").alias("distinct_name_count"),
    )


def text_bytes(frame: DataFrame) -> int:
    """Upper estimate of the in-memory size of a narrow lookup, from its actual text lengths."""
    texts = [c for c, kind in frame.dtypes if kind == "string"]
    row = F.lit(64)
    for c in texts:
        row = row + F.coalesce(F.octet_length(c), F.lit(0))
    return frame.agg(F.coalesce(F.sum(row.cast("bigint")), F.lit(0)).alias("bytes")).first()[0]


def require_one_row(lookup: DataFrame, key: str) -> DataFrame:
    """``lookup``, in which a key that stands in several rows ends whatever reads it.

    The check is part of the key, so that no plan can leave it out, and it rests on the partitions
    that a merge join by the key needs anyway.  Null keys meet nothing and may repeat.
    """
    several = F.count(F.lit(1)).over(Window.partitionBy(key)) > 1
    text = F.concat(F.lit(f"lookup has more than one row for {key} "), F.col(key).cast("string"))
    kind = lookup.schema[key].dataType
    checked = F.when(several & F.col(key).isNotNull(), F.raise_error(text).cast(kind)).otherwise(F.col(key))
    return lookup.withColumn("_checked", checked).withColumn(key, F.col("_checked")).drop("_checked")


def attach(
    fact: DataFrame, lookup: DataFrame, key: str, broadcast: bool = False, proven: bool = False
) -> DataFrame:
    """Left join of a large fact to a lookup that has one row per key; null keys stay unmatched.

    That it has is checked while the join runs, without another pass over the fact: a lookup with a
    double key fails instead of multiplying rows.  ``proven`` leaves the check out, for a lookup
    that an aggregate by the key makes in the same plan: Spark knows of such that it has one row, and
    drops the whole join where none of its columns is wanted.

    ``broadcast`` is for callers that have measured the lookup (``text_bytes``).  Otherwise Spark
    decides by its own threshold, and where it merges, both sides are plain shuffles, which is
    what adaptive execution needs to split the partition of a key that holds much of the fact.
    """
    checked = lookup if proven else require_one_row(lookup, key)
    return fact.join(F.broadcast(checked) if broadcast else checked, key, "left")
