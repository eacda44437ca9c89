"""Data-quality counters, summary and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions import values as v
from tallyforge.operators.ranking import top_k_per_group


def _conditions() -> dict[str, Column]:
    """What each row-level counter counts."""
    return {
        "missing_merchant_id": F.col("merchant_id").isNull(),
        "unmatched_merchant_lookup": ~F.col("merchant_lookup_matched"),
        "unknown_category": F.col("category") == v.UNKNOWN_CATEGORY,
        "unknown_city": v.unknown_id(F.col("city_id")),
        "unknown_state": v.unknown_id(F.col("state_id")),
        "denied": v.denied(F.col("authorized_flag")),
        "unknown_authorization": v.unknown_authorization(F.col("authorized_flag")),
        "nonpositive_amount": F.col("purchase_amount") <= 0,
        "unknown_installments": v.unknown_installments(F.col("installments")),
    }


# Check name, counter and description of the published summary, in its order.
# The counters come from the metrics row, except rows_dropped, which needs the Gold row count.
CHECKS = (
    ("Rows processed", "row_count", "Silver rows evaluated by the quality checks."),
    ("Rows dropped", "rows_dropped", "Rows not conserved between Silver and reconciled Gold."),
    (
        "Missing merchant ID",
        "missing_merchant_id",
        "Transactions without a merchant identifier; name falls back to Unknown merchant.",
    ),
    (
        "Unmatched merchant lookup",
        "unmatched_merchant_lookup",
        "Transactions without a matching merchant metadata row; merchant ID is used as the name.",
    ),
    (
        "Merchant identity collisions",
        "ambiguous_merchant_ids",
        "Merchant IDs associated with more than one nonblank source name.",
    ),
    (
        "Unknown category",
        "unknown_category",
        "Null or blank categories retained as Unknown category.",
    ),
    ("Unknown city", "unknown_city", "Null or -1 transaction city identifiers."),
    ("Unknown state", "unknown_state", "Null or -1 transaction state identifiers."),
    (
        "Denied authorization",
        "denied",
        "Valid denied attempts retained for recorded-attempt analysis.",
    ),
    ("Unknown authorization", "unknown_authorization", "Authorization values outside Y and N."),
    ("Nonpositive amount", "nonpositive_amount", "Purchase amounts less than or equal to zero."),
    (
        "Unknown installments",
        "unknown_installments",
        "Null, negative, or sentinel 999 installment values.",
    ),
)
# Checks that only inform, and the one that does not count rows.
INFORMATIONAL = ("row_count", "denied")
NOT_ROW_LEVEL = ("ambiguous_merchant_ids",)
# Checks whose rows are sampled, and the columns shown.
SAMPLED = (
    "missing_merchant_id",
    "unmatched_merchant_lookup",
    "unknown_category",
    "unknown_state",
    "unknown_installments",
)
SAMPLE_COLUMNS = (
    "merchant_id",
    "merchant_name",
    "purchase_date",
    "city_id",
    "state_id",
    "category",
    "installments",
    "authorized_flag",
    "purchase_amount",
)


def quality_counts() -> list[Column]:
    """The counters over Silver rows; usable as aggregates and as observed metrics."""
    return [
        F.count(F.lit(1)).alias("row_count"),
        *(F.count_if(condition).alias(name) for name, condition in _conditions().items()),
        F.sum("purchase_amount").alias("total_amount"),
    ]


def quality_metrics(silver: DataFrame, conflicts: DataFrame) -> DataFrame:
    """One row: all counters, the total amount and the number of conflicting merchants."""
    rows = silver.agg(*quality_counts())
    collisions = conflicts.agg(F.count_distinct("merchant_id").alias("ambiguous_merchant_ids"))
    return (
        rows.unionByName(collisions, allowMissingColumns=True)
        .agg(*(F.max(c).alias(c) for c in [*rows.columns, *collisions.columns]))
    )


def quality_summary(metrics: DataFrame, reconciliation: DataFrame) -> DataFrame:
    """One row per check from the one-row metrics and the one-row reconciliation."""
    counters = [c for _, c, _ in CHECKS if c != "rows_dropped"]
    both = (
        metrics.select(*counters)
        .unionByName(reconciliation.select("gold_count"), allowMissingColumns=True)
        .agg(*(F.max(c).alias(c) for c in [*counters, "gold_count"]))
        .withColumn("rows_dropped", F.col("row_count") - F.col("gold_count"))
    )

    def line(position: int, name: str, counter: str, description: str) -> Column:
        count = F.col(counter).cast("bigint")
        status = F.when(F.lit(counter in INFORMATIONAL), "Informational").otherwise(
            F.when(count == 0, "Passed").otherwise("Warning")
        )
        population = F.lit(None) if counter in NOT_ROW_LEVEL else F.col("row_count")
        return F.struct(
            F.lit(position).alias("position"),
            F.lit(name).alias("check_name"),
            status.alias("status"),
            count.alias("result_count"),
            population.cast("bigint").alias("population_count"),
            F.lit(description).alias("description"),
        )

    lines = F.array(*(line(i, *check) for i, check in enumerate(CHECKS)))
    return both.select(F.inline(lines)).orderBy("position").select(
        "check_name",
        "status",
        "result_count",
        "population_count",
        v.ratio(F.col("result_count"), F.col("population_count"), when_empty=None).alias(
            "result_rate"
        ),
        "description",
    )


def warning_samples(silver: DataFrame, k: int = 5) -> DataFrame:
    """The first k rows of each sampled check, in one scan.

    The order covers every shown column, so rows that tie are identical and the samples are the
    same on every run.
    """
    names = {counter: name for name, counter, _ in CHECKS}
    conditions = _conditions()
    # Checks are numbered while rows are sorted, and named when few are left.
    matched = F.array_compact(
        F.array(*(F.when(conditions[c], F.lit(i)) for i, c in enumerate(SAMPLED)))
    )
    tagged = silver.select(F.explode(matched).alias("_check"), *SAMPLE_COLUMNS)
    first = ["merchant_id", "purchase_date", "city_id", "state_id"]
    rest = [c for c in SAMPLE_COLUMNS if c not in first]
    order = [F.asc_nulls_last(c) for c in [*first, *rest]]
    check_name = F.get(F.array(*(F.lit(names[c]) for c in SAMPLED)), F.col("_check"))
    return (
        top_k_per_group(tagged, ["_check"], order, k, rank="sample_rank")
        .withColumn("check_name", check_name)
        .orderBy("check_name", "sample_rank")
        .select("check_name", "sample_rank", *SAMPLE_COLUMNS)
    )
