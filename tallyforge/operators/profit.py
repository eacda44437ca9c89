"""Expected profit of payment plans under a default model."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.values import ratio


def expected_profit(
    frame: DataFrame,
    plan: str,
    exposure: str,
    margin: float = 0.25,
    loss_share: float = 0.5,
    default_rate: float = 0.229,
) -> DataFrame:
    """Add default probabilities, expected profits and their rates to one row per plan.

    Monthly reading: each of the n payments defaults independently with ``default_rate``.  Flat
    reading: the rate applies once over the plan.  A default loses ``loss_share`` of the value;
    ``margin`` is earned.  A null plan has no probability and no profit.
    """
    # Decimal arithmetic on the parameters keeps e.g. 1 - 0.229 at exactly 0.771.
    exact_margin, exact_loss, exact_rate = (
        Decimal(str(v)) for v in (margin, loss_share, default_rate)
    )
    survival = float(1 - exact_rate)
    flat_margin = float(exact_margin - exact_loss * exact_rate)
    known = F.col(plan).isNotNull()
    amount = F.col(exposure).cast("double")
    positive = F.col(exposure) > 0
    modelled = frame.withColumns(
        {
            "monthly_default_probability": 1.0 - F.pow(F.lit(survival), F.col(plan)),
            "flat_lifetime_default_probability": F.when(known, F.lit(float(default_rate))),
        }
    ).withColumns(
        {
            "expected_profit_monthly": amount
            * (F.lit(float(margin)) - float(loss_share) * F.col("monthly_default_probability")),
            "expected_profit_flat_lifetime": F.when(known, amount * flat_margin),
        }
    )
    rates = {
        f"expected_profit_rate_{kind}": F.when(
            positive, ratio(F.col(f"expected_profit_{kind}"), amount, when_empty=None)
        )
        for kind in ("monthly", "flat_lifetime")
    }
    rate = F.col("expected_profit_rate_monthly")
    return modelled.withColumns(rates).withColumn(
        "monthly_profitability", F.when(rate >= 0, "Positive").when(rate < 0, "Negative")
    )
