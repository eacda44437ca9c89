"""Every operator as a named query over a folder of driver tables.

Types are aligned for comparison with SQL: decimals become doubles, integers bigint, dates text,
arrays joined text; modelled doubles are rounded.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions import values as v
from tallyforge.operators.association import cramers_v
from tallyforge.operators.dimension import canonical_names, conflicting_names, name_conflicts
from tallyforge.operators.interval import shortest_circular_interval
from tallyforge.operators.measures import exposure_rate, measures
from tallyforge.operators.ranking import (
    rank_and_share,
    rank_selected_in_group,
    top_k,
    top_k_per_group,
)
from tallyforge.operators.reconcile import reconcile
from tallyforge.plans import gold, job, quality, silver, summaries, views
from tallyforge.sources import provenance, quarantine, tables, versions
from tallyforge.testbed import binding

Query = Callable[[SparkSession, str], DataFrame]

# Digits kept when comparing doubles: column name -> digits.
ROUNDED = {
    "approved_share": 12,
    "city_share": 12,
    "share": 12,
    "approval_rate": 12,
    "result_rate": 12,
    "average_recorded_amount": 6,
    "average_amount": 6,
    "approved_amount_per_observed_day": 6,
    "chi_square": 6,
    "cramers_v": 9,
    "monthly_default_probability": 12,
    "flat_lifetime_default_probability": 12,
    "expected_profit_monthly": 4,
    "expected_profit_flat_lifetime": 4,
    "expected_profit_rate_monthly": 12,
    "expected_profit_rate_flat_lifetime": 12,
}


def comparable(frame: DataFrame) -> DataFrame:
    def align(name: str, kind: str) -> Column:
        column = F.col(name)
        if kind.startswith("decimal"):
            column = column.cast("double")
        elif kind in ("int", "smallint", "tinyint"):
            column = column.cast("bigint")
        elif kind == "date":
            column = column.cast("string")
        elif kind == "timestamp":
            column = F.date_format(column, v.TIMESTAMP_FORMAT)
        elif kind.startswith("array"):
            column = F.array_join(column, " | ")
        if name in ROUNDED and kind != "string":
            column = F.round(column, ROUNDED[name])
        return column.alias(name)

    return frame.select(*(align(name, kind) for name, kind in frame.dtypes))


def _on_silver(make: Callable[[silver.Silver], DataFrame]) -> Query:
    return lambda spark, folder: comparable(make(binding.silver(spark, folder)))


def _on_summaries(make: Callable[[summaries.Summaries], DataFrame]) -> Query:
    """Questions about named merchants, over Silver."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        attempts = binding.silver(spark, folder).transactions
        return comparable(make(summaries.summaries_of(attempts)))

    return run


def _on_attempts(make: Callable[[summaries.Summaries], DataFrame]) -> Query:
    """Questions that name no merchant; for them Silver is the typed attempts."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return comparable(make(summaries.summaries_of(binding.attempts(spark, folder))))

    return run


def _on_merchants(make: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: comparable(make(binding.raw_merchants(spark, folder)))


def _authorization_summary(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(views.by_authorization(binding.attempts(spark, folder)))


def _reconcile_cities(attempts: DataFrame) -> DataFrame:
    cities = summaries.summaries_of(attempts)("city_id")
    return reconcile(
        attempts, cities, "purchase_amount", "all_attempt_count", "all_attempt_amount"
    )


def _reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_reconcile_cities(binding.attempts(spark, folder)))


def _quality_metrics(s: silver.Silver) -> DataFrame:
    return quality.quality_metrics(s.transactions, s.merchant_conflicts)


def _quality_summary(s: silver.Silver) -> DataFrame:
    return quality.quality_summary(_quality_metrics(s), _reconcile_cities(s.transactions))


def _contract_report(spark: SparkSession, folder: str) -> DataFrame:
    return silver.contract_report(binding.attempts(spark, folder))


def _text_attempts(spark: SparkSession, folder: str) -> DataFrame:
    """Events as raw attempts whose date and amount are free text, most of it neither."""
    events = binding.table(spark, folder, "events")
    text = F.when(F.col("event_id") % 3 == 0, F.col("props")).when(
        F.col("event_id") % 3 == 1, F.date_format("ts", v.TIMESTAMP_FORMAT)
    )
    money = F.when(F.col("event_id") % 5 == 0, F.col("props")).when(
        F.col("event_id") % 5 < 4, (F.col("event_id") % 1000).cast("string")
    )
    return silver.typed_attempts(
        events.select(
            F.concat(F.lit("M_"), "user_id").alias("merchant_id"),
            text.alias("purchase_date"),
            money.alias("purchase_amount"),
            F.lit(1).cast("long").alias("city_id"),
            F.lit(1).cast("long").alias("state_id"),
            F.col("event_type").alias("category"),
            F.lit(1).cast("long").alias("installments"),
            F.lit("Y").alias("authorized_flag"),
        )
    )


def _contract_of_unparsed_text(spark: SparkSession, folder: str) -> DataFrame:
    return silver.contract_report(_text_attempts(spark, folder))


def _rows_rejected(spark: SparkSession, folder: str) -> DataFrame:
    """Rejected rows by category."""
    typed = _text_attempts(spark, folder)
    rejected = typed.filter(F.col("purchase_date").isNull() | F.col("purchase_amount").isNull())
    return comparable(rejected.groupBy("category").agg(F.count(F.lit(1)).alias("rejected")))


def _peek_attempts(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["purchase_date", "merchant_id", "purchase_amount", "city_id", "category"]
    return comparable(views.peek(binding.attempts(spark, folder), columns, 10, ["purchase_date"]))


def _order_row_digests(spark: SparkSession, folder: str) -> DataFrame:
    orders = binding.table(spark, folder, "orders").withColumns(
        {
            "o_totalprice": F.col("o_totalprice").cast("decimal(28,2)"),
            "o_orderdate": F.col("o_orderdate").cast("date"),
        }
    )
    return provenance.row_digests(orders, "o_orderstatus", orders.columns)


# Delimited text made of the events, with lines that cannot be read.

EVENT_LINES = "event_id bigint, user_id bigint, event_type string, value decimal(18,2)"


def _checked_events(spark: SparkSession, folder: str) -> quarantine.Checked:
    events, id_ = binding.table(spark, folder, "events"), F.col("event_id")
    fields = [
        id_.cast("string"),
        F.concat(F.when(id_ % 17 == 0, "x").otherwise(""), F.col("user_id").cast("string")),
        F.when(id_ % 5 == 0, F.concat(F.lit('"'), "event_type", F.lit(', again"'))).otherwise(F.col("event_type")),
        F.when(id_ % 7 != 0, F.when(id_ % 13 == 0, "n/a").otherwise(F.col("value").cast("decimal(18,2)").cast("string"))),
        F.when((id_ % 11 == 0) & (id_ % 7 != 0), "more"),
    ]
    path = f"{binding.work_folder(spark)}/events.csv"
    events.select(F.concat_ws(",", *fields)).write.text(path)
    return quarantine.read_checked_csv(spark, path, EVENT_LINES, header=False)


def _csv_rejected_by_reason(spark: SparkSession, folder: str) -> DataFrame:
    rejected = _checked_events(spark, folder).rejected
    return rejected.groupBy("reason").agg(
        F.count(F.lit(1)).alias("line_count"), F.min("record").alias("first_line")
    )


def _csv_accepted_by_type(spark: SparkSession, folder: str) -> DataFrame:
    accepted = _checked_events(spark, folder).accepted
    return comparable(
        accepted.groupBy("event_type").agg(F.count(F.lit(1)).alias("line_count"), F.sum("value").alias("value"))
    )


def _grouping_sets(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(summaries.small_summary(binding.attempts(spark, folder)))


def _stored(make: Callable[[summaries.Summaries], DataFrame]) -> Query:
    """The same questions answered from the two summaries, stored as the batch job stores them."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        attempts = binding.silver(spark, folder).transactions
        work = binding.work_folder(spark)
        summaries.small_summary(attempts).write.partitionBy("grouping_set").parquet(f"{work}/small")
        summaries.merchant_summary(attempts).write.parquet(f"{work}/merchant")
        stored = (tables.read_parquet(spark, f"{work}/{n}") for n in ("small", "merchant"))
        return comparable(make(summaries.stored_summaries(*stored)))

    return run


def _stored_q1_slice(spark: SparkSession, folder: str) -> DataFrame:
    """One month and city of the first question's table, as the batch job writes it."""
    question = gold.QUESTIONS[0]
    by = summaries.summaries_of(binding.silver(spark, folder).transactions)
    path = f"{binding.work_folder(spark)}/{question.name}"
    tables.write_clustered(question.ask(by), path, question.cluster)
    return comparable(views.q1_slice(tables.read_parquet(spark, path), "1998-06", 3))


def _activity(by: summaries.Summaries) -> tuple[DataFrame, DataFrame]:
    return summaries.city_maps(by), summaries.merchant_maps(by, summaries.merchant_numbers(by))


def _active(*names: str) -> Query:
    return _on_attempts(lambda by: summaries.active_counts(*_activity(by), *names))


def _stored_active(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct counts per month from maps that were stored per month, and month and city."""
    work = binding.work_folder(spark)
    stored = []
    for name, maps in zip(("cities", "merchants"), _activity(summaries.summaries_of(binding.attempts(spark, folder)))):
        tables.write_parquet(maps, f"{work}/{name}")
        stored.append(tables.read_parquet(spark, f"{work}/{name}"))
    return comparable(summaries.active_counts(*stored, "year_month"))


def _batch_job_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """The quality metrics that the whole batch job leaves beside its tables, from raw files to Gold."""
    layers = [f"{binding.work_folder(spark)}/{name}" for name in ("raw", "bronze", "silver", "gold")]
    attempts, merchants = binding.raw_attempts(spark, folder), binding.raw_merchants(spark, folder)
    tables.write_parquet(attempts, f"{layers[0]}/historical_transactions.parquet")
    merchants.write.option("header", True).csv(f"{layers[0]}/merchants.csv")
    job.run_all(spark, *layers)
    path = versions.table_path(spark, layers[2], "dq.json")
    return comparable(tables.read_json(spark, path, job.METRICS_SCHEMA))


def _manifest(spark: SparkSession, folder: str) -> DataFrame:
    names = ("lineitem", "orders", "customer", "nation", "supplier")
    return provenance.manifest(spark, {n: f"{folder}/{n}.parquet" for n in names})


def _load_metadata(spark: SparkSession, folder: str) -> DataFrame:
    loaded_at = datetime(2026, 1, 2, 3, 4, 5, tzinfo=timezone.utc)
    read = binding.table(spark, folder, "lineitem")
    marked = tables.with_load_metadata(read, "bronze", loaded_at, source_file=True)
    return comparable(
        marked.groupBy("source_file_name", "bronze_load_timestamp").agg(
            F.count(F.lit(1)).alias("row_count")
        )
    )


# The generic operators on a second schema: the events table.


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return binding.table(spark, folder, "events").select(
        "user_id",
        "event_type",
        F.col("value").cast("decimal(28,2)").alias("value"),
        F.to_date("ts").alias("day"),
        F.hour("ts").alias("hour"),
    )


def _event_measures(spark: SparkSession, folder: str, *names: str) -> DataFrame:
    is_purchase = F.col("event_type") == "purchase"
    return measures(_events(spark, folder), names, "value", is_purchase)


def _events_top_users(spark: SparkSession, folder: str) -> DataFrame:
    per_user = _event_measures(spark, folder, "event_type", "user_id")
    order = [F.desc("all_attempt_amount"), F.asc("user_id")]
    return comparable(
        top_k_per_group(per_user, ["event_type"], order, 3).select(
            "event_type", "user_id", "rank", "all_attempt_amount", "all_attempt_count"
        )
    )


def _events_user_rank(spark: SparkSession, folder: str) -> DataFrame:
    per_user = _event_measures(spark, folder, "user_id")
    ranked = rank_and_share(per_user, "all_attempt_amount", "user_id")
    return comparable(
        ranked.select("user_id", "all_attempt_amount", "rank", "approved_share")
    )


def _events_leader_rank_by_type(spark: SparkSession, folder: str) -> DataFrame:
    """The five users with the most events and their place in each event type."""
    per_type = _event_measures(spark, folder, "event_type", "user_id").select(
        "event_type", "user_id", F.col("all_attempt_count").alias("events")
    )
    overall = per_type.groupBy("user_id").agg(F.sum("events").alias("all_events"))
    leaders = top_k(overall, [F.desc("all_events"), F.asc("user_id")], 5, rank="overall_rank")
    placed = per_type.join(F.broadcast(leaders), "user_id")
    return comparable(
        rank_selected_in_group(
            per_type, placed, "event_type", "events", "user_id", "rank_in_type"
        )
    )


def _events_association(spark: SparkSession, folder: str) -> DataFrame:
    cells = _events(spark, folder).groupBy("event_type", "hour").agg(
        F.count(F.lit(1)).alias("n")
    )
    return comparable(cramers_v(cells, "event_type", "hour", "n", "type_count", "hour_count"))


def _events_interval(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(shortest_circular_interval(_events(spark, folder), "hour", "value"))


def _events_by_minute(spark: SparkSession, folder: str) -> DataFrame:
    """The shortest part of the day with 80 % of the value, to the minute."""
    events = binding.table(spark, folder, "events").select(
        (60 * F.hour("ts") + F.minute("ts")).alias("minute"), F.col("value").cast("decimal(28,2)").alias("value")
    )
    names = {"start": "start_minute", "end": "end_minute", "length": "minutes"}
    return comparable(shortest_circular_interval(events, "minute", "value", period=1440, **names))


def _events_exposure(spark: SparkSession, folder: str) -> DataFrame:
    daily = _event_measures(spark, folder, "day")
    return comparable(exposure_rate(daily, "day", F.weekday("day"), "weekday"))


def _names_of_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Canonical segment per nation: many rows and several names per key."""
    customer = binding.table(spark, folder, "customer").select(
        F.col("c_nationkey").cast("string").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
    )
    named = canonical_names(customer, "nation", "segment", "none")
    conflicts = name_conflicts(conflicting_names(customer, "nation", "segment"), "nation")
    return comparable(named.join(conflicts, "nation", "left"))


def _q1_slice(by: summaries.Summaries) -> DataFrame:
    return views.q1_slice(gold.q1_top_merchants(by), "1998-06", 3)


def _q1_cities(by: summaries.Summaries) -> DataFrame:
    return views.q1_cities(gold.q1_top_merchants(by), "1998-06")


def queries() -> dict[str, Query]:
    named, by, on = _on_summaries, _on_attempts, _on_silver
    return {
        "q1_top_merchants": named(gold.q1_top_merchants),
        "silver_enriched": on(lambda s: s.transactions),
        "merchant_lookup": _on_merchants(silver.merchant_lookup),
        "merchant_conflicts": _on_merchants(
            lambda m: name_conflicts(silver.merchant_conflicts(m), "merchant_id")
        ),
        "merchant_conflict_names": _on_merchants(silver.merchant_conflicts),
        "contract_report": _contract_report,
        "contract_of_unparsed_text": _contract_of_unparsed_text,
        "rows_rejected": _rows_rejected,
        "peek_attempts": _peek_attempts,
        "order_row_digests": _order_row_digests,
        "q2_merchant_state": named(gold.q2_merchant_state),
        "q3_category_hours": by(gold.q3_category_hours),
        "q4_popular_merchants": named(gold.q4_popular_merchants),
        "q4_city_category": by(gold.q4_city_category),
        "q4_association": by(lambda b: gold.q4_association(gold.q4_city_category(b))),
        "q5_overview": by(gold.q5_overview),
        "q5_cities": by(gold.q5_cities),
        "q5_categories": by(gold.q5_categories),
        "q5_months": by(gold.q5_months),
        "q5_hours": by(gold.q5_hours),
        "q5_opening_hours": by(lambda b: gold.q5_opening_hours(gold.q5_hours(b))),
        "q5_installments": by(gold.q5_installments),
        "quality_metrics": on(_quality_metrics),
        "quality_summary": on(_quality_summary),
        "warning_samples": on(lambda s: quality.warning_samples(s.transactions)),
        "reconciliation": _reconciliation,
        "measures_grouping_sets": _grouping_sets,
        "stored_q1_top_merchants": _stored(gold.q1_top_merchants),
        "stored_q4_popular_merchants": _stored(gold.q4_popular_merchants),
        "stored_q5_overview": _stored(gold.q5_overview),
        "stored_q5_months": _stored(gold.q5_months),
        "authorization_summary": _authorization_summary,
        "q1_first_rows": named(lambda b: views.q1_first_rows(gold.q1_top_merchants(b))),
        "q1_months": named(lambda b: views.q1_months(gold.q1_top_merchants(b))),
        "q1_cities_of_month": named(_q1_cities),
        "q1_city_month_slice": named(_q1_slice),
        "stored_q1_city_month_slice": _stored_q1_slice,
        "active_by_month": _active("year_month"),
        "active_overall": _active(),
        "stored_active_by_month": _stored_active,
        "csv_rejected_by_reason": _csv_rejected_by_reason,
        "csv_accepted_by_type": _csv_accepted_by_type,
        "q4_hundred_merchants": named(lambda b: gold.q4_popular_merchants(b, 100)),
        "q2_leaders": named(lambda b: views.q2_leaders(gold.q2_merchant_state(b))),
        "q2_hundred_leaders": named(lambda b: views.q2_leaders(gold.q2_merchant_state(b), 100)),
        "q3_listing": by(lambda b: views.q3_listing(gold.q3_category_hours(b))),
        "q4_ordered": named(lambda b: views.q4_ordered(gold.q4_popular_merchants(b))),
        "association_text": by(
            lambda b: views.association_text(gold.q4_association(gold.q4_city_category(b)))
        ),
        "merchant_city_stack": named(
            lambda b: views.merchant_city_stack(gold.q4_popular_merchants(b))
        ),
        "leading_cities": by(lambda b: views.leading(gold.q5_cities(b), 5)),
        "ten_leading_cities": by(lambda b: views.leading(gold.q5_cities(b), 10)),
        "ten_leading_categories": by(lambda b: views.leading(gold.q5_categories(b), 10)),
        "leading_categories": by(
            lambda b: views.leading_known_categories(gold.q5_categories(b))
        ),
        "leading_months": by(
            lambda b: views.leading(gold.q5_months(b), 5, "exposure_adjusted_rank")
        ),
        "months_in_order": by(lambda b: views.months_in_order(gold.q5_months(b))),
        "hours_in_order": by(lambda b: views.hours_in_order(gold.q5_hours(b))),
        "midnight_bucket": by(lambda b: views.midnight(gold.q5_hours(b))),
        "charted_plans": by(lambda b: views.charted_plans(gold.q5_installments(b), 12)),
        "positive_plan_limit": by(
            lambda b: views.recommended_plan_limit(gold.q5_installments(b))
        ),
        "installment_report": by(lambda b: views.installment_report(gold.q5_installments(b))),
        "overview_text": by(lambda b: views.overview_text(gold.q5_overview(b))),
        "interval_text": by(
            lambda b: views.interval_text(gold.q5_opening_hours(gold.q5_hours(b)))
        ),
        "quality_check_value": on(
            lambda s: views.metric_value(_quality_summary(s), "Unknown state")
        ),
        "sampled_checks": on(
            lambda s: views.sampled_checks(quality.warning_samples(s.transactions))
        ),
        "samples_of_check": on(
            lambda s: views.samples_of(quality.warning_samples(s.transactions), "Unknown state")
        ),
        "conflict_listing": _on_merchants(
            lambda m: views.conflict_listing(silver.merchant_conflicts(m))
        ),
        "load_metadata": _load_metadata,
        "batch_job_metrics": _batch_job_metrics,
        "source_manifest": _manifest,
        "events_top_users_by_type": _events_top_users,
        "events_user_rank": _events_user_rank,
        "events_leader_rank_by_type": _events_leader_rank_by_type,
        "events_type_hour_association": _events_association,
        "events_busiest_hours": _events_interval,
        "events_busiest_minutes": _events_by_minute,
        "events_weekday_exposure": _events_exposure,
        "customer_segment_names": _names_of_customers,
    }
