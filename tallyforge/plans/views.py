"""Bounded result views over the published tables."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions import labels
from tallyforge.functions.values import UNKNOWN_CATEGORY
from tallyforge.operators.dimension import name_conflicts
from tallyforge.operators.ranking import rank_small


def preview(frame: DataFrame, n: int) -> list[dict[str, Any]]:
    """The first n rows as dictionaries, for the edge of an application."""
    return [row.asDict(recursive=True) for row in frame.limit(n).collect()]


# Q1

def q1_first_rows(q1: DataFrame, n: int = 5) -> DataFrame:
    return q1.orderBy("year_month", F.asc_nulls_first("city_id"), "rank").limit(n)


def q1_months(q1: DataFrame) -> DataFrame:
    """Months to choose from."""
    return q1.filter(F.col("year_month").isNotNull()).select("year_month").distinct().orderBy(
        "year_month"
    )


def q1_cities(q1: DataFrame, month: str) -> DataFrame:
    """Cities to choose from in a month."""
    return (
        q1.filter((F.col("year_month") == month) & F.col("city_id").isNotNull())
        .select("city_id")
        .distinct()
        .orderBy("city_id")
    )


def q1_slice(q1: DataFrame, month: str, city: int) -> DataFrame:
    """The ranking of one month and city."""
    return (
        q1.filter((F.col("year_month") == month) & (F.col("city_id") == city))
        .orderBy("rank")
        .select(
            "rank",
            labels.month_label(F.col("year_month")).alias("month"),
            "city_id",
            "merchant_name",
            "total_amount",
            labels.money_label(F.col("total_amount")).alias("total_label"),
            "attempt_count",
        )
    )


# Q2

def q2_leaders(q2: DataFrame, n: int = 5) -> DataFrame:
    """The first places of the published ranking."""
    return leading(q2, n)


# Q3

def q3_listing(q3: DataFrame) -> DataFrame:
    """All categories with their leading hours, in order."""
    return q3.orderBy("category", "rank")


# Q4

def q4_ordered(q4: DataFrame) -> DataFrame:
    """Each popular merchant's cities, numbered from the one with the most attempts."""
    inside = Window.partitionBy("global_rank").orderBy(
        F.desc("city_attempt_count"), F.asc_nulls_last("city_id")
    )
    return q4.withColumn("position", F.row_number().over(inside))


def merchant_city_stack(q4: DataFrame) -> DataFrame:
    """Attempts of each popular merchant by city, merchants by rank, larger cities first."""
    return (
        q4.groupBy("merchant_name", F.col("city_id").cast("string").alias("city_label"))
        .agg(
            F.min("global_rank").alias("merchant_order"),
            F.sum("city_attempt_count").alias("attempts"),
        )
        .orderBy("merchant_order", F.desc("attempts"), F.asc_nulls_last("city_label"))
    )


# Q5

def leading(ranked: DataFrame, n: int, rank: str = "rank") -> DataFrame:
    return ranked.orderBy(rank).limit(n)


def leading_known_categories(categories: DataFrame, n: int = 2) -> DataFrame:
    return leading(categories.filter(F.col("category") != UNKNOWN_CATEGORY), n)


def months_in_order(months: DataFrame) -> DataFrame:
    return rank_small(months, [F.asc("year_month")], "position").select(
        "position",
        "year_month",
        labels.month_label(F.col("year_month")).alias("month"),
        "approved_amount_per_observed_day",
        "observed_days",
    )


def hours_in_order(hours: DataFrame) -> DataFrame:
    return rank_small(hours, [F.asc("hour")], "position").select(
        "position",
        "hour",
        labels.hour_label(F.col("hour")).alias("hour_label"),
        "approved_amount",
        "approved_count",
        "approved_share",
    )


def midnight(hours: DataFrame) -> DataFrame:
    return hours.filter(F.col("hour") == 0)


def charted_plans(installments: DataFrame, largest: int) -> DataFrame:
    """Plans with approved exposure and from one to ``largest`` payments, the range of the chart."""
    return (
        installments.filter(
            F.col("plan_installments").between(1, largest) & (F.col("approved_amount") > 0)
        )
        .orderBy("plan_installments")
        .select("plan_installments", "expected_profit_rate_monthly", "monthly_profitability")
    )


def installment_report(installments: DataFrame) -> DataFrame:
    """Plan table as text; plans outside the model are marked as excluded."""
    def modelled(text):
        return labels.or_excluded(text)

    return installments.orderBy(F.asc_nulls_first("plan_installments")).select(
        "installment_plan",
        labels.money_label(F.col("approved_amount")).alias("approved_exposure"),
        labels.money_label(F.col("all_attempt_amount")).alias("all_attempt_exposure"),
        modelled(labels.percent_label(F.col("expected_profit_rate_monthly"))).alias(
            "monthly_rate"
        ),
        modelled(
            labels.money_label(F.col("expected_profit_monthly").cast("decimal(38,2)"))
        ).alias("monthly_profit"),
        modelled(
            labels.money_label(F.col("expected_profit_flat_lifetime").cast("decimal(38,2)"))
        ).alias("flat_profit"),
    )


def recommended_plan_limit(installments: DataFrame) -> DataFrame:
    """The largest plan up to which every plan keeps a positive expected profit."""
    known = installments.filter(F.col("expected_profit_rate_monthly").isNotNull())
    return known.agg(
        F.max(F.when(F.col("monthly_profitability") == "Positive", F.col("plan_installments")))
        .alias("largest_positive_plan"),
        F.min(F.when(F.col("monthly_profitability") == "Negative", F.col("plan_installments")))
        .alias("smallest_negative_plan"),
    )


def overview_text(overview: DataFrame) -> DataFrame:
    """Headline figures as text."""
    return overview.select(
        labels.count_label(F.col("recorded_attempts")).alias("attempts"),
        labels.money_label(F.col("recorded_amount")).alias("amount"),
        labels.money_label(F.col("average_recorded_amount").cast("decimal(32,2)")).alias("average"),
        labels.count_label(F.col("city_count")).alias("cities"),
        labels.count_label(F.col("month_count")).alias("months"),
        labels.count_label(F.col("approved_attempts")).alias("approved"),
        labels.percent_label(F.col("approval_rate"), 1).alias("approval_rate"),
        labels.money_label(F.col("approved_amount")).alias("approved_amount"),
        labels.count_label(F.col("not_approved_attempts")).alias("not_approved"),
    )


def interval_text(interval: DataFrame) -> DataFrame:
    """The recommended hours as text; no row when there is no interval."""
    return interval.select(
        labels.hour_label(F.col("start_hour")).alias("opens"),
        labels.hour_label(F.col("end_hour")).alias("closes"),
        "hours",
        labels.money_label(F.col("covered_amount")).alias("covered"),
        labels.percent_label(F.col("share"), 1).alias("share"),
    )


def association_text(association: DataFrame) -> DataFrame:
    """Cramer's V with the population behind it, as text."""
    return association.select(
        F.format_string("%.4f", F.col("cramers_v")).alias("cramers_v"),
        labels.count_label(F.col("population")).alias("attempts"),
        labels.count_label(F.col("city_count")).alias("cities"),
        labels.count_label(F.col("category_count")).alias("categories"),
    )


# Quality

def metric_value(summary: DataFrame, check_name: str) -> DataFrame:
    return summary.filter(F.col("check_name") == check_name).select("result_count", "result_rate")


def sampled_checks(samples: DataFrame) -> DataFrame:
    return samples.select("check_name").distinct().orderBy("check_name")


def samples_of(samples: DataFrame, check_name: str) -> DataFrame:
    return samples.filter(F.col("check_name") == check_name).orderBy("sample_rank")


def conflict_listing(names: DataFrame) -> DataFrame:
    """Conflicting merchants with their names in one line."""
    conflicts = name_conflicts(names, "merchant_id")
    return conflicts.orderBy(F.asc_nulls_last("merchant_id")).select(
        "merchant_id",
        F.array_join("nonblank_names", " | ").alias("source_names"),
        "distinct_name_count",
    )


# Exploration

def peek(frame: DataFrame, columns: list[str], n: int = 10, order: list[str] | None = None) -> DataFrame:
    """n rows of the chosen columns: whichever come first, or by ``order`` and then all chosen columns,
    so that it is the same rows every time."""
    if order is None:
        return frame.select(*columns).limit(n)
    keys = [*order, *(c for c in columns if c not in order)]
    return frame.orderBy(*(F.asc_nulls_last(c) for c in keys)).limit(n).select(*columns)


def by_authorization(silver: DataFrame) -> DataFrame:
    return (
        silver.groupBy("authorized_flag")
        .agg(
            F.count(F.lit(1)).alias("attempt_count"),
            F.sum("purchase_amount").alias("total_amount"),
        )
        .orderBy(F.asc_nulls_first("authorized_flag"))
    )
