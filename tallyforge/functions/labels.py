"""Display labels for result views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def money_label(amount: Column) -> Column:
    """``-$1,234.50`` style text."""
    sign = F.when(amount < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, F.lit("$"), F.format_number(F.abs(amount), 2))


def month_label(year_month: Column) -> Column:
    """``2017-10`` becomes ``Oct 2017``."""
    return F.date_format(F.to_date(year_month, "yyyy-MM"), "MMM yyyy")


def hour_code(hour: Column) -> Column:
    """``7`` becomes ``0700``."""
    return F.format_string("%02d00", hour)


def hour_label(hour: Column) -> Column:
    """``7`` becomes ``07:00``."""
    return F.format_string("%02d:00", hour)


def percent_label(rate: Column, digits: int = 2) -> Column:
    return F.concat(F.format_number(rate * 100, digits), F.lit("%"))


def count_label(count: Column) -> Column:
    return F.format_number(count, 0)


def or_excluded(label: Column) -> Column:
    """``Excluded`` where a modelled value does not exist."""
    return F.coalesce(label, F.lit("Excluded"))


def titled(frame: DataFrame) -> DataFrame:
    """Rename snake_case columns to title-case headings."""
    return frame.withColumnsRenamed({c: c.replace("_", " ").title() for c in frame.columns})
