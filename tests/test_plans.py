"""Plans of the business questions: what they read, shuffle and reuse."""

import pytest
from pyspark.sql import functions as F
from tests.helpers import final_plan, scans

from tallyforge.plans import gold, quality, summaries
from tallyforge.testbed import binding

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("silver") / "transactions")
    binding.silver(spark, FOLDER).transactions.write.parquet(path)
    return spark.read.parquet(path)


NAMES = [q.name for q in gold.QUESTIONS]


@pytest.fixture(scope="module")
def plans(stored):
    by = summaries.summaries_of(stored)
    return {q.name: final_plan(q.ask(by)) for q in gold.QUESTIONS}


def test_questions_run_nothing_before_they_are_read(spark, stored):
    by = summaries.summaries_of(stored)
    spark.sparkContext.setJobGroup("asking", "")
    try:
        asked = [q.ask(by) for q in gold.QUESTIONS]
        assert len(asked) == 13
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("asking")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("name", NAMES)
def test_one_scan_and_no_cross_join(plans, name):
    assert scans(plans[name]) == 1
    assert "CartesianProduct" not in plans[name]
    assert "BroadcastNestedLoopJoin" not in plans[name]
    assert "Python" not in plans[name]


def test_only_needed_columns_are_read(plans):
    assert "ReadSchema: struct<city_id:bigint,category:string>" in plans["q4_city_category"]
    assert "merchant" not in plans["q5_hours"]
    assert "PushedFilters: [IsNotNull(city_id)" in plans["q4_association"]


def test_top_k_is_cut_before_the_shuffle(plans):
    assert plans["q1_top_merchants"].count("WindowGroupLimit") == 2
    assert "TakeOrderedAndProject" in plans["q4_popular_merchants"]


def test_samples_take_one_scan(stored):
    plan = final_plan(quality.warning_samples(stored))
    assert scans(plan) == 1
    assert plan.count("WindowGroupLimit") == 2


def test_stored_summaries_prune_partitions(spark, stored, tmp_path):
    path = str(tmp_path / "small")
    summaries.small_summary(stored).write.partitionBy("grouping_set").parquet(path)
    by = summaries.stored_summaries(spark.read.parquet(path), summaries.merchant_summary(stored))
    plan = final_plan(by("hour"))
    assert "PartitionFilters: [isnotnull(grouping_set" in plan
    assert scans(plan) == 1


def test_unused_lookup_is_not_joined(spark):
    attempts = binding.silver(spark, FOLDER).transactions
    plan = final_plan(attempts.groupBy("category").agg(F.sum("purchase_amount")))
    assert "supplier" not in plan


@pytest.fixture(scope="module")
def rolled(spark, stored, tmp_path_factory):
    folder = tmp_path_factory.mktemp("summaries")
    small, merchant = f"{folder}/small", f"{folder}/merchant"
    summaries.small_summary(stored).write.partitionBy("grouping_set").parquet(small)
    summaries.merchant_summary(stored).write.parquet(merchant)
    by = summaries.stored_summaries(spark.read.parquet(small), spark.read.parquet(merchant))
    return {q.name: q.ask(by) for q in gold.QUESTIONS}


@pytest.mark.parametrize("name", NAMES)
def test_stored_summaries_are_read_once(rolled, name):
    plan = final_plan(rolled[name])
    assert scans(plan) == 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
