"""Strength of association between two categorical variables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cramers_v(
    contingency: DataFrame,
    a: str,
    b: str,
    weight: str,
    a_count: str = "a_count",
    b_count: str = "b_count",
) -> DataFrame:
    """Chi-square and Cramer's V of a table of non-empty cells, as one row.

    With row totals r, column totals c and N cases, chi-square is N * sum_a(sum_b(n^2 / c) / r) - N,
    so the cells meet only one set of totals in a join and are then reduced by the other variable.
    Absent cells add nothing.  All of it is double: the product of two totals can exceed bigint.
    A null category counts as cases but not as a category, and adds nothing to chi-square.
    """
    # The joins are null-safe and every branch reads the same columns, so that Spark computes
    # ``contingency`` once and reuses it.
    b_totals = contingency.groupBy(b).agg(F.sum(weight).alias("_b_total"))
    named_totals = b_totals.select(F.col(b).alias("_b"), "_b_total")
    n = F.col(weight).cast("double")
    scaled = F.when(F.col(b).isNotNull(), F.try_divide(n * n, F.col("_b_total").cast("double")))
    a_rows = (
        contingency.join(named_totals, F.col(b).eqNullSafe(F.col("_b")))
        .groupBy(a)
        .agg(F.sum(weight).alias("_a_total"), F.sum(scaled).alias("_scaled"))
        .select(
            F.lit(None).cast("bigint").alias("_cases"),
            F.col(a).isNotNull().alias("_is_a"),
            F.lit(False).alias("_is_b"),
            F.try_divide("_scaled", F.col("_a_total").cast("double")).alias("_term"),
        )
    )
    b_rows = b_totals.select(
        F.col("_b_total").alias("_cases"),
        F.lit(False).alias("_is_a"),
        F.col(b).isNotNull().alias("_is_b"),
        F.lit(None).cast("double").alias("_term"),
    )
    parts = a_rows.unionByName(b_rows).agg(
        F.sum("_cases").alias("population"),
        F.count_if("_is_a").alias(a_count),
        F.count_if("_is_b").alias(b_count),
        F.sum("_term").alias("_terms"),
    )
    cases = F.col("population").cast("double")
    chi_square = F.greatest(cases * F.col("_terms") - cases, F.lit(0.0))
    free = cases * (F.least(a_count, b_count) - 1)
    return parts.select(
        "population",
        a_count,
        b_count,
        chi_square.alias("chi_square"),
        F.when(free > 0, F.sqrt(chi_square / free)).otherwise(F.lit(0.0)).alias("cramers_v"),
    )
