from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F
from tests.helpers import rows, silver_frame

from tallyforge.functions import labels
from tallyforge.plans import gold, quality, summaries, views

METRICS = (
    "row_count long, missing_merchant_id long, unmatched_merchant_lookup long, "
    "unknown_category long, unknown_city long, unknown_state long, denied long, "
    "unknown_authorization long, nonpositive_amount long, unknown_installments long, "
    "ambiguous_merchant_ids long"
)


def summary_of(spark, gold_count, **counts):
    values = [counts.get(part.split()[0], 0) for part in METRICS.split(", ")]
    metrics = spark.createDataFrame([tuple(values)], METRICS)
    reconciliation = spark.createDataFrame([(gold_count,)], "gold_count long")
    return quality.quality_summary(metrics, reconciliation)


def test_summary_lines(spark):
    got = rows(
        summary_of(spark, 100, row_count=100, missing_merchant_id=2, ambiguous_merchant_ids=1,
                   denied=7)
    )
    assert [r["check_name"] for r in got] == [name for name, _, _ in quality.CHECKS]
    lines = {r["check_name"]: r for r in got}

    def line(name):
        r = lines[name]
        return r["status"], r["result_count"], r["population_count"], r["result_rate"]

    assert line("Rows processed") == ("Informational", 100, 100, 1.0)
    assert line("Rows dropped") == ("Passed", 0, 100, 0.0)
    assert line("Missing merchant ID") == ("Warning", 2, 100, 0.02)
    assert line("Merchant identity collisions") == ("Warning", 1, None, None)
    assert line("Denied authorization") == ("Informational", 7, 100, 0.07)


def test_summary_of_nothing_and_of_a_loss(spark):
    empty = {r["check_name"]: r for r in rows(summary_of(spark, 0))}
    assert empty["Unknown city"]["result_rate"] is None
    lossy = {r["check_name"]: r for r in rows(summary_of(spark, 9, row_count=10))}
    assert (lossy["Rows dropped"]["status"], lossy["Rows dropped"]["result_count"]) == (
        "Warning", 1,
    )


def test_metrics(spark):
    frame = silver_frame(
        spark,
        [
            {},
            {"merchant_id": None, "merchant_lookup_matched": False, "city_id": -1},
            {"category": "Unknown category", "city_id": None, "state_id": -1},
            {"authorized_flag": "N", "installments": 999},
            {"authorized_flag": "X", "installments": -1, "purchase_amount": Decimal("0.00")},
            {"authorized_flag": None, "installments": None, "state_id": None},
        ],
    )
    conflicts = spark.createDataFrame(
        [("a", "x"), ("a", "y"), ("b", "x"), ("b", "z"), ("c", "u"), ("c", "v")],
        "merchant_id string, nonblank_name string",
    )
    (got,) = rows(quality.quality_metrics(frame, conflicts))
    assert got == {
        "row_count": 6,
        "missing_merchant_id": 1,
        "unmatched_merchant_lookup": 1,
        "unknown_category": 1,
        "unknown_city": 2,
        "unknown_state": 2,
        "denied": 1,
        "unknown_authorization": 2,
        "nonpositive_amount": 1,
        "unknown_installments": 3,
        "total_amount": Decimal("37.50"),
        "ambiguous_merchant_ids": 3,
    }


def test_samples_do_not_depend_on_partitioning(spark):
    # all rows tie on the leading order columns; the hot check holds every row
    attempts = [
        {"merchant_id": None, "merchant_lookup_matched": i % 2 == 0, "installments": i % 5,
         "purchase_amount": Decimal(i)}
        for i in range(300)
    ]
    frame = silver_frame(spark, attempts)
    first = quality.warning_samples(frame.repartition(1)).collect()
    assert first == quality.warning_samples(frame.repartition(13, "purchase_amount")).collect()
    counts = {}
    for r in first:
        counts[r["check_name"]] = counts.get(r["check_name"], 0) + 1
    assert counts == {"Missing merchant ID": 5, "Unmatched merchant lookup": 5}


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_labels(spark):
    money = lambda text, kind="decimal(38,2)": one(
        spark, labels.money_label(F.lit(text).cast(kind))
    )
    assert money("-1234.5") == "-$1,234.50"
    assert money("146228071619.26") == "$146,228,071,619.26"
    assert money("0") == "$0.00"
    assert one(spark, labels.month_label(F.lit("2023-02"))) == "Feb 2023"
    assert one(spark, labels.hour_code(F.lit(7))) == "0700"
    assert one(spark, labels.hour_label(F.lit(23))) == "23:00"
    assert one(spark, labels.percent_label(F.lit(0.1355))) == "13.55%"
    assert one(spark, labels.or_excluded(F.lit(None).cast("string"))) == "Excluded"
    assert labels.titled(spark.range(1).select(F.lit(1).alias("city_rank"))).columns == ["City Rank"]


def test_views(spark):
    attempts = [
        {"merchant_id": f"m{i % 6}", "merchant_name": f"M{i % 6}", "city_id": i % 7 or None,
         "category": ["A", "B", "Unknown category"][i % 3], "installments": i % 4,
         "purchase_amount": Decimal(i + 1)}
        for i in range(90)
    ]
    frame = silver_frame(spark, attempts)
    by = summaries.summaries_of(frame)
    q1 = gold.q1_top_merchants(by)
    assert [r["rank"] for r in rows(views.q1_slice(q1, "2018-03", 2))] == [1, 2, 3, 4, 5]
    assert rows(views.q1_cities(q1, "2018-03")) == [{"city_id": c} for c in range(1, 7)]
    assert rows(views.q1_months(q1)) == [{"year_month": "2018-03"}]
    assert views.q1_first_rows(q1).count() == 5
    leading = rows(views.leading_known_categories(gold.q5_categories(by)))
    assert [r["category"] for r in leading] == ["B", "A"]
    assert [r["rank"] for r in rows(views.leading(gold.q5_cities(by), 3))] == [1, 2, 3]
    q4 = gold.q4_popular_merchants(by, k=2)
    ranks = [r["global_rank"] for r in rows(views.q4_ordered(q4))]
    assert ranks == sorted(ranks)
    first = [r for r in rows(views.q4_ordered(q4)) if r["global_rank"] == 1]
    by_position = sorted(first, key=lambda r: r["position"])
    attempts_there = [r["city_attempt_count"] for r in by_position]
    assert attempts_there == sorted(attempts_there, reverse=True)
    stack = rows(views.merchant_city_stack(q4))
    assert sum(r["attempts"] for r in stack) == 30
    plans = gold.q5_installments(by)
    assert [r["plan_installments"] for r in rows(views.charted_plans(plans, 12))] == [1, 2, 3]
    assert [r["plan_installments"] for r in rows(views.charted_plans(plans, 2))] == [1, 2]
    (limit,) = rows(views.recommended_plan_limit(plans))
    assert limit == {"largest_positive_plan": 2, "smallest_negative_plan": 3}
    report = rows(views.installment_report(plans))
    assert [r["installment_plan"] for r in report] == [
        "Baseline (0/1)", "2 payments", "3 payments",
    ]
    assert report[0]["monthly_rate"] == "13.55%"
    assert rows(views.midnight(gold.q5_hours(by))) == []
    assert len(views.preview(frame, 3)) == 3
    (flags,) = rows(views.by_authorization(frame))
    assert flags["attempt_count"] == 90


def test_listing_shows_every_category(spark):
    attempts = [
        {"category": c, "purchase_date": datetime(2017, 3, 4, h), "purchase_amount": Decimal(h)}
        for c in "PQRST" for h in (5, 9, 14, 22)
    ]
    by = summaries.summaries_of(silver_frame(spark, attempts))
    listed = rows(views.q3_listing(gold.q3_category_hours(by)))
    assert [(r["category"], r["rank"], r["hour"]) for r in listed] == [
        (c, rank, hour) for c in "PQRST" for rank, hour in ((1, "2200"), (2, "1400"), (3, "0900"))
    ]


def test_report_marks_unknown_plans(spark):
    frame = silver_frame(spark, [{"installments": 999}])
    (row,) = rows(views.installment_report(gold.q5_installments(summaries.summaries_of(frame))))
    assert row["monthly_profit"] == row["flat_profit"] == row["monthly_rate"] == "Excluded"


def test_days_are_dates(spark):
    by = summaries.summaries_of(silver_frame(spark, [{}]))
    assert by("day").first()["day"] == date(2018, 3, 4)
