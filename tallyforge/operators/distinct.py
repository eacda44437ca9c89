"""Exact distinct counts that add up: bit maps by group, which later roll up to any coarser group.

A number has its bit in the map of its bucket of 32,768 numbers, which Spark's bitmap functions place.  A
summary of maps answers for every coarser grain without the rows, as a union of maps counts a number
once wherever it occurs.  Text keys are numbered first, densely and frequent ones first, so that
small groups need few maps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.ranking import rank_by_measure


def numbered_keys(frame: DataFrame, key: str, weight: Column | None = None, number: str = "number") -> DataFrame:
    """``key, number``: the distinct non-null keys of ``frame`` from 1, by falling weight, then key."""
    weight = F.count(F.lit(1)) if weight is None else weight
    keys = frame.filter(F.col(key).isNotNull()).groupBy(key).agg(weight.alias("_weight"))
    return rank_by_measure(keys, "_weight", [F.asc(key)], number).select(key, F.col(number).cast("long"))


def distinct_maps(frame: DataFrame, dimensions: Sequence[Column | str], number: str) -> DataFrame:
    """One row per group and bucket: ``bucket`` and ``members``, the map of the group's numbers.

    A map has four kilobytes, and is built before rows are shuffled.  Null numbers are not counted, and a
    group of nothing else has no row.
    """
    placed = frame.filter(F.col(number).isNotNull())
    bucket = F.bitmap_bucket_number(F.col(number)).alias("bucket")
    return placed.groupBy(*dimensions, bucket).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col(number))).alias("members")
    )


def roll_up_maps(maps: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Maps of coarser groups, as ``distinct_maps`` would make them of the rows."""
    return maps.groupBy(*dimensions, "bucket").agg(F.bitmap_or_agg("members").alias("members"))


def distinct_counts(maps: DataFrame, dimensions: Sequence[str], name: str = "distinct_count") -> DataFrame:
    """The number of distinct members by ``dimensions``; one row, also of nothing, without dimensions."""
    union = roll_up_maps(maps, dimensions)
    counted = F.coalesce(F.sum(F.bitmap_count("members")), F.lit(0)).alias(name)
    return union.groupBy(*dimensions).agg(counted) if dimensions else union.agg(counted)
