"""The operators against brute force in plain Python, and on skewed data."""

from __future__ import annotations

import itertools
import math
import random
import time
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests.helpers import final_plan, rows

from tallyforge.operators.association import cramers_v
from tallyforge.operators.dimension import (
    attach,
    canonical_names,
    conflicting_names,
    name_conflicts,
)
from tallyforge.operators.interval import shortest_circular_interval
from tallyforge.operators.measures import MEASURES, measures, measures_by_sets
from tallyforge.operators.profit import expected_profit
from tallyforge.operators.ranking import (
    rank_and_share,
    rank_by_measure,
    rank_selected_in_group,
    top_k,
    top_k_per_group,
)
from tallyforge.operators.reconcile import reconcile, require_reconciled

few = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


# Dimension


def test_a_lookup_with_a_double_key_fails_without_the_job(spark):
    """In one pass over the fact, merged or broadcast; null keys may repeat."""
    fact = spark.range(100).select((F.col("id") % 7).cast("string").alias("k"), "id")
    names = [(str(i), f"name {i}") for i in range(7)] + [(None, "x"), (None, "y")]
    unique = spark.createDataFrame(names, "k string, name string")
    double = spark.createDataFrame([*names, ("3", "again")], "k string, name string")
    for broadcast in (False, True):
        assert attach(fact, unique, "k", broadcast).count() == 100
        plan = final_plan(attach(fact, unique, "k", broadcast))
        assert plan.count("Range (0, 100") == 1
        with pytest.raises(Exception, match="more than one row for k 3"):
            attach(fact, double, "k", broadcast).count()


def test_a_proven_lookup_is_not_checked(spark):
    fact = spark.range(10).withColumnRenamed("id", "k")
    lookup = spark.range(10).groupBy(F.col("id").alias("k")).agg(F.max("id").alias("x"))
    assert "raise_error" not in final_plan(attach(fact, lookup, "k", proven=True))
    assert "raise_error" in final_plan(attach(fact, lookup, "k"))


# Association


def v_of(spark, cells):
    frame = spark.createDataFrame(cells, "a long, b string, n long")
    (row,) = rows(cramers_v(frame, "a", "b", "n"))
    return row


def brute_v(cells):
    r, c = Counter(), Counter()
    for a, b, n in cells:
        r[a] += n
        c[b] += n
    total = sum(r.values())
    chi = max(sum(n * n / (r[a] * c[b] / total) for a, b, n in cells if n) - total, 0.0)
    free = total * min(len(r) - 1, len(c) - 1)
    return chi, math.sqrt(chi / free) if free > 0 else 0.0


def test_independent_and_perfect_tables(spark):
    proportional = [(a, b, a * n) for a in (3, 5, 8) for b, n in zip("pqrs", (2, 7, 1, 4))]
    assert v_of(spark, proportional)["cramers_v"] == pytest.approx(0.0, abs=1e-9)
    one_each = [(a, b, n if i == j else 0) for i, (a, n) in enumerate([(3, 6), (5, 11), (8, 2)]) for j, b in enumerate("pqr")]
    got = v_of(spark, one_each)
    assert got["cramers_v"] == pytest.approx(1.0)
    assert (got["population"], got["a_count"], got["b_count"]) == (19, 3, 3)


def test_one_group_has_no_association(spark):
    assert v_of(spark, [(1, "x", 5), (1, "y", 7)])["cramers_v"] == 0.0


def test_large_totals_do_not_overflow(spark):
    big = 4_000_000_000_000_000_000
    got = v_of(spark, [(1, "x", big), (2, "y", big)])
    assert got["cramers_v"] == pytest.approx(1.0)


def test_null_category_counts_as_cases_only(spark):
    cells = [(1, "x", 10), (2, "y", 10), (1, None, 5)]
    got = v_of(spark, cells)
    assert (got["population"], got["b_count"]) == (25, 2)


@few
@given(
    st.dictionaries(
        st.tuples(st.integers(1, 4), st.sampled_from("xyz")), st.integers(1, 50), min_size=1
    )
)
def test_association_by_brute_force(spark, table):
    cells = [(a, b, n) for (a, b), n in table.items()]
    got = v_of(spark, cells)
    chi, v = brute_v(cells)
    assert got["chi_square"] == pytest.approx(chi, abs=1e-8)
    assert got["cramers_v"] == pytest.approx(v, abs=1e-6)


# Interval


def brute_interval(weights, period, target):
    total = sum(weights.values())
    if total <= 0:
        return None
    for length in range(1, period + 1):
        for start in range(period):
            covered = sum(weights.get((start + i) % period, 0) for i in range(length))
            if covered / total >= target:
                return start, (start + length) % period, length, covered
    return None


def interval_of(spark, weights, **options):
    frame = spark.createDataFrame(list(weights.items()), "hour int, w long")
    got = rows(shortest_circular_interval(frame, "hour", "w", **options))
    return got[0] if got else None


def test_even_day(spark):
    got = interval_of(spark, {h: 1 for h in range(24)})
    assert (got["start_hour"], got["end_hour"], got["hours"]) == (0, 20, 20)


def test_whole_cycle_ends_where_it_starts(spark):
    got = interval_of(spark, {h: 1 for h in range(24)}, target_share=1.0)
    assert (got["start_hour"], got["end_hour"], got["hours"]) == (0, 0, 24)


@pytest.mark.parametrize("kind", ["even", "random", "negative"])
def test_the_minutes_of_a_day(spark, kind):
    """A cycle of 1,440 slots, found in a moment, and equal to prefix sums tried for every start and end."""
    chance = random.Random(kind)
    least, most = {"even": (7, 7), "random": (0, 900), "negative": (-300, 500)}[kind]
    weights = [chance.randint(least, most) for _ in range(1440)]
    interval_of(spark, {0: 1}, period=1440)
    started = time.perf_counter()
    got = interval_of(spark, dict(enumerate(weights)), period=1440)
    took = time.perf_counter() - started
    sums = [0, *itertools.accumulate(weights * 2)]
    want = next(
        (start, (start + n) % 1440, n, sums[start + n] - sums[start])
        for n in range(1, 1441)
        for start in range(1440)
        if (sums[start + n] - sums[start]) / sums[1440] >= 0.8
    )
    assert (got["start_hour"], got["end_hour"], got["hours"], got["covered_amount"]) == want
    assert took < 5, took  # most of it is Spark's planning


def test_no_weight_gives_no_interval(spark):
    assert interval_of(spark, {3: 0}) is None


@few
@given(
    st.dictionaries(st.integers(0, 9), st.integers(-6, 20), min_size=1),
    st.sampled_from([0.3, 0.5, 0.8, 1.0]),
)
def test_interval_by_brute_force(spark, weights, target):
    got = interval_of(spark, weights, period=10, target_share=target)
    want = brute_interval(weights, 10, target)
    assert want == (
        got and (got["start_hour"], got["end_hour"], got["hours"], got["covered_amount"])
    )


# Ranking


def skewed(spark, n=3000, parts=7):
    """Two thirds of the rows in group 0, many ties, some null groups and keys."""
    return (
        spark.range(0, n, 1, parts)
        .select(
            F.when(F.col("id") % 3 < 2, F.lit(0)).when(F.col("id") % 50 != 2, F.col("id") % 7)
            .alias("g"),
            F.when(F.col("id") % 11 != 5, F.concat(F.lit("k"), F.col("id"))).alias("k"),
            (F.col("id") * 7919 % 13).alias("m"),
            "id",
        )
    )


def order_key(row):
    return (-row["m"], row["k"] is None, row["k"] or "", row["id"])


def order():
    return [F.desc("m"), F.asc_nulls_last("k"), F.asc("id")]


def test_top_k_per_group_by_brute_force(spark):
    frame = skewed(spark)
    groups = defaultdict(list)
    for row in rows(frame):
        groups[row["g"]].append(row)
    want = {
        (g, i + 1, row["id"])
        for g, members in groups.items()
        for i, row in enumerate(sorted(members, key=order_key)[:4])
    }
    result = top_k_per_group(frame, ["g"], order(), 4)
    assert {(r["g"], r["rank"], r["id"]) for r in rows(result)} == want
    assert "WindowGroupLimit" in final_plan(result)


def test_top_k_needs_no_full_sort(spark):
    result = top_k(skewed(spark), order(), 5)
    plan = final_plan(result)
    assert "TakeOrderedAndProject" in plan
    want = [r["id"] for r in sorted(rows(skewed(spark)), key=order_key)[:5]]
    assert [r["id"] for r in sorted(rows(result), key=lambda r: r["rank"])] == want


@pytest.mark.parametrize("parts", [1, 7])
def test_rank_by_measure_by_brute_force(spark, parts):
    frame = skewed(spark, parts=parts).withColumn("m", F.col("m") * F.col("m") * 1000 - 20000)
    ties = [F.asc_nulls_last("k"), F.asc("id")]
    by_rank = sorted(rows(rank_by_measure(frame, "m", ties, total="whole")), key=lambda r: r["rank"])
    want = sorted(rows(frame), key=order_key)
    assert [r["rank"] for r in by_rank] == list(range(1, len(want) + 1))
    assert [r["id"] for r in by_rank] == [r["id"] for r in want]
    assert {r["whole"] for r in by_rank} == {sum(r["m"] for r in want)}


def test_ranks_beyond_measures(spark):
    nothing = spark.createDataFrame([], "k string, m long")
    assert rows(rank_by_measure(nothing, "m", [F.asc("k")])) == []
    some = spark.createDataFrame([("a", None), ("b", -1), ("c", 0), ("d", None)], "k string, m long")
    got = sorted((r["rank"], r["k"]) for r in rows(rank_by_measure(some, "m", [F.asc("k")])))
    assert got == [(1, "c"), (2, "b"), (3, "a"), (4, "d")]
    assert dict(rank_by_measure(some, "m", [F.asc("k")]).dtypes)["rank"] == "bigint"


@pytest.mark.parametrize("measure", ["1000", "1000 + id / 1e6", "null"])
def test_ranks_of_like_measures_are_spread(spark, measure):
    """Equal measures, close ones and nulls: no task has the bulk of the rows, and ranks are right."""
    frame = spark.range(4000).selectExpr("id", f"cast({measure} as double) m")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = rank_by_measure(frame, "m", [F.desc("id")]).withColumn("task", F.spark_partition_id())
        found = rows(ranked)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(Counter(r["task"] for r in found).values()) < 2000
    assert sorted((r["rank"], r["id"]) for r in found) == [(i + 1, 3999 - i) for i in range(4000)]


def test_ranking_runs_nothing_before_it_is_read(spark):
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "")
    try:
        rank_and_share(skewed(spark), "m", "k")
        assert list(jobs.getJobIdsForGroup("planning")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_rank_and_share(spark):
    frame = spark.createDataFrame([("a", 1), ("b", 3), (None, 3)], "k string, m long")
    got = {r["k"]: (r["rank"], r["approved_share"]) for r in rows(rank_and_share(frame, "m", "k"))}
    assert got == {"b": (1, 3 / 7), None: (2, 3 / 7), "a": (3, 1 / 7)}


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_rank_of_selected_by_brute_force(spark, broadcast):
    frame = skewed(spark).select("g", "k", "m")
    selected = frame.filter(F.col("k").isin([f"k{i}" for i in (0, 1, 2, 3, 4, 11, 29)]))
    members = defaultdict(list)
    for row in rows(frame):
        members[row["g"]].append((-row["m"], row["k"] is None, row["k"] or ""))
    want = {
        r["k"]: 1 + sum(other < (-r["m"], False, r["k"]) for other in members[r["g"]])
        for r in rows(selected)
    }
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = rank_selected_in_group(frame, selected, "g", "m", "k", "place")
        assert {r["k"]: r["place"] for r in rows(got)} == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_too_many_selected_rows_are_refused(spark):
    frame = skewed(spark).select("g", "k", "m").filter("k is not null")
    with pytest.raises(Exception, match="more than 3 selected rows in group"):
        rank_selected_in_group(frame, frame, "g", "m", "k", "place", most=3).collect()


# Measures


def test_grouping_sets_equal_single_groupings(spark):
    frame = skewed(spark).withColumn("h", F.col("id") % 4)
    accepted = F.col("id") % 2 == 0
    together = measures_by_sets(
        frame, {"g": F.col("g"), "h": F.col("h")}, [("g",), ("h",), ("g", "h")], "m", accepted
    )
    for names in (["g"], ["h"], ["g", "h"]):
        alone = measures(frame, names, "m", accepted)
        part = together.filter(F.col("grouping_set") == "+".join(names))
        columns = [*names, *MEASURES]
        assert sorted(map(str, part.select(columns).collect())) == sorted(
            map(str, alone.select(columns).collect())
        )


# Dimension


def test_canonical_names_with_a_hot_key(spark):
    # one key holds most rows under one name; another has many names
    frame = spark.range(4000).select(
        F.when(F.col("id") % 4 != 0, F.lit("hot")).otherwise(F.lit("many")).alias("k"),
        F.when(F.col("id") % 4 != 0, F.lit(" One "))
        .otherwise(F.concat(F.lit("n"), F.col("id") % 16))
        .alias("name"),
    )
    named = {r["k"]: (r["name"], r["name_ambiguous"])
             for r in rows(canonical_names(frame, "k", "name", "none"))}
    assert named == {"hot": ("One", False), "many": ("many", True)}
    names = conflicting_names(frame, "k", "name")
    assert {r["k"] for r in rows(names)} == {"many"}
    (conflict,) = rows(name_conflicts(names, "k"))
    assert conflict["nonblank_names"] == ["n0", "n12", "n4", "n8"]
    assert conflict["distinct_name_count"] == 4


def test_large_lookup_joins_by_sort_merge_and_splits_hot_keys(spark, tmp_path):
    changed = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    fact = str(tmp_path / "fact")
    spark.range(0, 40000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 500))
        .alias("k"),
        "id",
    ).write.parquet(fact)
    lookup = spark.range(400).select(
        F.when(F.col("id") == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id")))
        .alias("k"),
        F.concat(F.lit("name"), F.col("id")).alias("name"),
    )
    for key, value in changed.items():
        spark.conf.set(key, value)
    try:
        merged = attach(spark.read.parquet(fact), lookup.hint("merge"), "k")
        plan = final_plan(merged)
        assert "SortMergeJoin(skew=true)" in plan
        assert "BroadcastHashJoin" not in plan
        want = attach(spark.read.parquet(fact), lookup, "k", broadcast=True)
        assert "BroadcastHashJoin" in final_plan(want)
        assert merged.count() == 40000
        assert merged.exceptAll(want).isEmpty() and want.exceptAll(merged).isEmpty()
    finally:
        for key in changed:
            spark.conf.unset(key)


# Profit and reconciliation


def test_profit_parameters(spark):
    plans = spark.createDataFrame([(1, 100.0), (2, 0.0)], "n long, amount double")
    got = {r["n"]: r for r in rows(
        expected_profit(plans, "n", "amount", margin=0.5, loss_share=1.0, default_rate=0.1)
    )}
    assert got[1]["expected_profit_monthly"] == pytest.approx(40)
    assert got[1]["expected_profit_flat_lifetime"] == pytest.approx(40)
    assert got[2]["expected_profit_rate_monthly"] is None


def test_reconciliation_notices_a_lost_row(spark):
    source = spark.createDataFrame([("a", 5), ("a", 7), ("b", 1)], "k string, m long")
    whole = source.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("m").alias("s"))
    assert require_reconciled(reconcile(source, whole, "m", "n", "s"))["passed"]
    lost = source.limit(2).groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("m").alias("s"))
    with pytest.raises(ValueError, match="reconciliation failed"):
        require_reconciled(reconcile(source, lost, "m", "n", "s"))
    empty = source.filter("false")
    nothing = whole.filter("false")
    result = rows(reconcile(empty, nothing, "m", "n", "s"))[0]
    assert result["silver_count"] == 0
