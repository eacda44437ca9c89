"""Measures of the attempts at any grain the business questions ask for.

The questions only need additive measures, so they do not care where these come from: straight
from the attempts, or from two stored summaries that the batch job makes with one scan each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions import values as v
from tallyforge.operators.distinct import distinct_counts, distinct_maps, numbered_keys
from tallyforge.operators.measures import measures, measures_by_sets, roll_up

# by("city_id", "hour") -> one row per city and hour with the four measures
Summaries = Callable[..., DataFrame]

# Grains of the stored summaries.
SMALL_SETS = (
    ("city_id", "category"),
    ("city_id", "year_month"),
    ("category", "hour"),
    ("day",),
    ("plan_installments",),
)
MERCHANT_GRAIN = ("year_month", "city_id", "state_id", "merchant_id", "merchant_name")


def dimension(name: str) -> Column:
    """A dimension of the attempts: derived from date or installments, or a plain column.

    Months are grouped as dates and named afterwards, which is cheaper per attempt than text.
    """
    if name == "year_month":
        return F.trunc("purchase_date", "month")
    if name == "day":
        return F.to_date("purchase_date")
    if name == "hour":
        return F.hour("purchase_date")
    if name == "plan_installments":
        return v.plan_size(F.col("installments"))
    return F.col(name)


def _accepted() -> Column:
    return v.approved(F.col("authorized_flag"))


def summaries_of(attempts: DataFrame) -> Summaries:
    """Summaries computed from the attempts themselves, one scan per question."""

    def by(*names: str) -> DataFrame:
        keys = [dimension(name).alias(name) for name in names]
        grouped = measures(attempts, keys, "purchase_amount", _accepted())
        if "year_month" in names:
            return grouped.withColumn("year_month", v.year_month(F.col("year_month")))
        return grouped

    return by


def small_summary(attempts: DataFrame) -> DataFrame:
    """All low-cardinality grains in one pass."""
    names = list(dict.fromkeys(name for wanted in SMALL_SETS for name in wanted))
    grouped = measures_by_sets(
        attempts,
        {name: dimension(name) for name in names},
        SMALL_SETS,
        "purchase_amount",
        _accepted(),
    )
    return grouped.withColumn("year_month", v.year_month(F.col("year_month")))


def merchant_summary(attempts: DataFrame) -> DataFrame:
    """The finest grain any merchant question needs, in one pass."""
    return summaries_of(attempts)(*MERCHANT_GRAIN)


# Who was active, as bit maps: distinct counts at any coarser grain come from these two.
CITY_MAP_GRAIN = ("year_month",)
MERCHANT_MAP_GRAIN = ("year_month", "city_id")


def city_maps(by: Summaries) -> DataFrame:
    """Maps of the cities with attempts per month; a city's id is its number."""
    return distinct_maps(by("year_month", "city_id"), CITY_MAP_GRAIN, "city_id")


def merchant_numbers(by: Summaries) -> DataFrame:
    """``merchant_id, number``: all merchants, those with the most attempts first."""
    return numbered_keys(by("merchant_id"), "merchant_id", F.sum("all_attempt_count"))


def merchant_maps(by: Summaries, numbers: DataFrame) -> DataFrame:
    """Maps of the merchants with attempts per month and city."""
    met = by(*MERCHANT_MAP_GRAIN, "merchant_id").join(numbers, "merchant_id")
    return distinct_maps(met, MERCHANT_MAP_GRAIN, "number")


def active_counts(cities: DataFrame, merchants: DataFrame, *names: str) -> DataFrame:
    """Distinct cities and merchants by ``names`` of the cities' grain, or over all without any."""
    counts = [
        distinct_counts(maps, names, name)
        for maps, name in ((cities, "city_count"), (merchants, "merchant_count"))
    ]
    both = counts[0].unionByName(counts[1], allowMissingColumns=True)
    totals = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("city_count", "merchant_count")]
    return both.groupBy(*names).agg(*totals)


def stored_summaries(small: DataFrame, merchant: DataFrame) -> Summaries:
    """Summaries rolled up from the two stored ones."""

    def by(*names: str) -> DataFrame:
        for wanted in SMALL_SETS:
            if set(names) <= set(wanted):
                chosen = small.filter(F.col("grouping_set") == "+".join(wanted))
                return roll_up(chosen, names)
        return roll_up(merchant, names)

    return by
