"""Validated, normalised and name-enriched attempts."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions import values as v
from tallyforge.operators.contract import require_columns
from tallyforge.operators.dimension import attach, canonical_names, conflicting_names

ATTEMPT_COLUMNS = (
    "merchant_id",
    "purchase_date",
    "purchase_amount",
    "city_id",
    "state_id",
    "category",
    "installments",
    "authorized_flag",
)
MERCHANT_COLUMNS = ("merchant_id", "merchant_name")


class Silver(NamedTuple):
    transactions: DataFrame
    merchant_lookup: DataFrame
    merchant_conflicts: DataFrame


def typed_attempts(attempts: DataFrame) -> DataFrame:
    """Parsed date and amount, labelled category; every source row is kept.

    Unusable dates and amounts come out null, which the contract counts.
    """
    require_columns(attempts, ATTEMPT_COLUMNS, "transaction source")
    kept = [c for c in attempts.columns if c not in ("merchant_id", "purchase_date", "purchase_amount")]
    category = v.or_label(F.col("category"), v.UNKNOWN_CATEGORY)
    return attempts.select(
        "merchant_id",
        *(category.alias(c) if c == "category" else F.col(c) for c in kept),
        v.parse_timestamp(F.col("purchase_date")).alias("purchase_date"),
        v.parse_money(F.col("purchase_amount")).alias("purchase_amount"),
    )


def contract_counts() -> list[Column]:
    """Counters over typed attempts; usable as aggregates and as observed metrics."""
    return [
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("purchase_date").isNull()).alias("invalid_date"),
        F.count_if(F.col("purchase_amount").isNull()).alias("invalid_amount"),
    ]


def contract_report(typed: DataFrame) -> DataFrame:
    return typed.agg(*contract_counts())


def enforce_contract(counts: dict) -> None:
    if counts["invalid_date"] or counts["invalid_amount"]:
        raise ValueError(
            "transaction source holds invalid/null values: "
            f"{counts['invalid_date']} dates, {counts['invalid_amount']} amounts"
        )
    if not counts["row_count"]:
        raise ValueError("transaction source is empty")


def merchant_lookup(merchants: DataFrame) -> DataFrame:
    require_columns(merchants, MERCHANT_COLUMNS, "merchant source")
    return canonical_names(
        merchants, "merchant_id", "merchant_name", v.UNKNOWN_MERCHANT
    ).withColumn("merchant_lookup_matched", F.lit(True))


def merchant_conflicts(merchants: DataFrame) -> DataFrame:
    """One row per conflicting merchant and name."""
    require_columns(merchants, MERCHANT_COLUMNS, "merchant source")
    return conflicting_names(merchants, "merchant_id", "merchant_name")


def enrich(
    typed: DataFrame, lookup: DataFrame, broadcast: bool = False, proven: bool = False
) -> DataFrame:
    """Attach the display name and both flags; unmatched attempts are named by their id.

    A lookup with a double key ends the query (see ``attach``, also for ``proven``).
    """
    joined = attach(typed, lookup, "merchant_id", broadcast, proven)
    return joined.withColumns(
        {
            "merchant_name": F.coalesce("merchant_name", "merchant_id", F.lit(v.UNKNOWN_MERCHANT)),
            "merchant_name_ambiguous": F.coalesce("merchant_name_ambiguous", F.lit(False)),
            "merchant_lookup_matched": F.coalesce("merchant_lookup_matched", F.lit(False)),
        }
    )


def to_silver(attempts: DataFrame, merchants: DataFrame, validate: bool = True) -> Silver:
    """Silver frames; with ``validate`` one aggregate checks the whole source first.

    The batch job passes ``validate=False`` and checks the same counters on the rows it writes,
    before it publishes them.
    """
    typed = typed_attempts(attempts)
    lookup = merchant_lookup(merchants)
    if validate:
        enforce_contract(contract_report(typed).first().asDict())
    return Silver(enrich(typed, lookup, proven=True), lookup, merchant_conflicts(merchants))
