"""Parsing and classification of raw attempt values.

Every function takes and returns a ``Column``.  Parsing never fails under ANSI mode: text that
does not parse becomes null, and the contract check counts the nulls.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(28, 2)
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Labels and sentinels of the attempt data.
UNKNOWN_CATEGORY = "Unknown category"
UNKNOWN_MERCHANT = "Unknown merchant"
APPROVED = "Y"
DENIED = "N"
UNKNOWN_ID = -1
UNKNOWN_INSTALLMENTS = 999


def parse_money(value: Column) -> Column:
    """Amount rounded half-up to cents; null for text, NaN and infinities."""
    return value.try_cast(MONEY)


def parse_timestamp(value: Column, pattern: str = TIMESTAMP_FORMAT) -> Column:
    return F.try_to_timestamp(value, F.lit(pattern))


def blank(value: Column) -> Column:
    """Null or only spaces; other whitespace counts as content."""
    return value.isNull() | (F.length(F.trim(value)) == 0)


def or_label(value: Column, label: str) -> Column:
    """``label`` for blank values, the untrimmed value otherwise."""
    return F.when(blank(value), F.lit(label)).otherwise(value)


def unknown_id(value: Column) -> Column:
    return value.isNull() | (value == UNKNOWN_ID)


def unknown_installments(value: Column) -> Column:
    return value.isNull() | (value < 0) | (value == UNKNOWN_INSTALLMENTS)


def approved(flag: Column) -> Column:
    """True for approved attempts, false (never null) for every other flag."""
    return flag.eqNullSafe(APPROVED)


def denied(flag: Column) -> Column:
    return flag.eqNullSafe(DENIED)


def unknown_authorization(flag: Column) -> Column:
    return ~(approved(flag) | denied(flag))


def year_month(instant: Column) -> Column:
    return F.date_format(instant, "yyyy-MM")


def plan_size(installments: Column) -> Column:
    """Number of payments: 0 and 1 are one payment, sentinels and negatives are null."""
    return F.when(
        ~unknown_installments(installments), F.greatest(installments, F.lit(1)).cast("bigint")
    )


def plan_label(plan: Column) -> Column:
    return (
        F.when(plan.isNull(), "Unknown")
        .when(plan == 1, "Baseline (0/1)")
        .otherwise(F.concat(plan.cast("string"), F.lit(" payments")))
    )


def ratio(part: Column, whole: Column, when_empty: float | None = 0.0) -> Column:
    """``part / whole`` as double, ``when_empty`` where the whole is null or zero."""
    quotient = F.try_divide(part.cast("double"), whole.cast("double"))
    return quotient if when_empty is None else F.coalesce(quotient, F.lit(when_empty))
