"""Exact comparison of a source with an aggregate of it."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _compared(sides: DataFrame) -> DataFrame:
    """One row from the sides' rows ``side, n, a``."""

    def pick(side: str, column: str):
        return F.max(F.when(F.col("side") == side, F.col(column)))

    both = sides.agg(
        pick("silver", "n").alias("silver_count"),
        pick("gold", "n").alias("gold_count"),
        pick("silver", "a").alias("silver_amount"),
        pick("gold", "a").alias("gold_amount"),
    )
    agrees = F.col("silver_count").eqNullSafe(F.col("gold_count")) & F.col(
        "silver_amount"
    ).eqNullSafe(F.col("gold_amount"))
    return both.select(agrees.alias("passed"), *both.columns)


def _gold(aggregate: DataFrame, count_column: str, amount_column: str) -> DataFrame:
    return aggregate.agg(
        F.lit("gold").alias("side"),
        F.sum(count_column).alias("n"),
        F.sum(amount_column).alias("a"),
    )


def reconcile(
    source: DataFrame, aggregate: DataFrame, amount: str, count_column: str, amount_column: str
) -> DataFrame:
    """One row: rows and amount of both sides, and whether they agree exactly."""
    left = source.agg(
        F.lit("silver").alias("side"), F.count(F.lit(1)).alias("n"), F.sum(amount).alias("a")
    )
    return _compared(left.unionByName(_gold(aggregate, count_column, amount_column)))


def reconcile_counts(
    count: int, amount: Decimal | None, aggregate: DataFrame, count_column: str, amount_column: str
) -> DataFrame:
    """The same with the source's side as it was recorded when the source was written."""
    right = _gold(aggregate, count_column, amount_column)
    left = aggregate.sparkSession.range(1).select(
        F.lit("silver").alias("side"),
        F.lit(count).cast("long").alias("n"),
        F.lit(None if amount is None else str(amount)).cast(right.schema["a"].dataType).alias("a"),
    )
    return _compared(left.unionByName(right))


def require_reconciled(result: DataFrame) -> dict:
    """Evaluate the one-row result and raise unless it passed."""
    row = result.first().asDict()
    if not row["passed"]:
        raise ValueError(f"reconciliation failed: {row}")
    return row
