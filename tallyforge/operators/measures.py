"""Additive measures by dimension, and rates that build on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEASURES = ["all_attempt_amount", "all_attempt_count", "approved_amount", "approved_count"]


def _aggregates(amount: str, accepted: Column) -> list[Column]:
    return [
        F.sum(amount).alias("all_attempt_amount"),
        F.count(F.lit(1)).alias("all_attempt_count"),
        F.sum(F.when(accepted, F.col(amount)).otherwise(F.lit(0))).alias("approved_amount"),
        F.count_if(accepted).alias("approved_count"),
    ]


def measures(
    frame: DataFrame, dimensions: Sequence[Column | str], amount: str, accepted: Column
) -> DataFrame:
    """Amount and count of all rows and of accepted rows per combination of dimensions."""
    return frame.groupBy(*dimensions).agg(*_aggregates(amount, accepted))


def measures_by_sets(
    frame: DataFrame,
    dimensions: Mapping[str, Column],
    sets: Sequence[Sequence[str]],
    amount: str,
    accepted: Column,
    set_name: str = "grouping_set",
) -> DataFrame:
    """The same measures for several sets of dimensions in a single pass over ``frame``.

    ``set_name`` tells the sets apart, e.g. ``city_id+category``; dimensions outside a row's set
    are null.
    """
    names = list(dimensions)
    prepared = frame.select(
        *(column.alias(name) for name, column in dimensions.items()),
        F.col(amount).alias("_amount"),
        accepted.alias("_accepted"),
    )
    grouped = prepared.groupingSets(
        [[F.col(c) for c in wanted] for wanted in sets], *(F.col(c) for c in names)
    ).agg(F.grouping_id().alias("_gid"), *_aggregates("_amount", F.col("_accepted")))

    label = F.lit(None).cast("string")
    for wanted in sets:
        # grouping_id has one bit per dimension, first dimension highest, set where it is absent.
        absent = sum(1 << (len(names) - 1 - i) for i, c in enumerate(names) if c not in wanted)
        label = F.when(F.col("_gid") == absent, "+".join(wanted)).otherwise(label)
    return grouped.select(label.alias(set_name), *names, *MEASURES)


def roll_up(summary: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Reduce a summary with the four measures to fewer dimensions."""
    return summary.groupBy(*dimensions).agg(*(F.sum(c).alias(c) for c in MEASURES))


def exposure_rate(
    daily: DataFrame,
    day: str,
    period: Column,
    period_name: str,
    rate: str = "approved_amount_per_observed_day",
) -> DataFrame:
    """Roll a daily summary up to periods, with the observed days as exposure.

    ``daily`` has one row per observed day, so counting its rows is the exact number of
    distinct days.
    """
    periods = daily.groupBy(period.alias(period_name)).agg(
        *(F.sum(c).alias(c) for c in MEASURES),
        F.min(day).alias("first_observed_date"),
        F.max(day).alias("last_observed_date"),
        F.count(day).alias("observed_days"),
    )
    return periods.withColumn(rate, F.try_divide("approved_amount", "observed_days"))
