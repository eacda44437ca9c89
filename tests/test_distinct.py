"""Exact distinct counts that roll up from stored bit maps."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from tests.helpers import final_plan

from tallyforge.operators.distinct import distinct_counts, distinct_maps, numbered_keys, roll_up_maps

NUMBERS = [-40_000, -32_769, -32_768, -2, -1, 0, 1, 2, 32_767, 32_768, 32_769, 65_536, 2**40, 2**62, None]


@pytest.fixture(scope="module")
def frame(spark):
    chance = random.Random(11)
    rows = [
        (chance.choice("abc"), chance.choice([1, 2, None]), chance.choice(NUMBERS + list(range(100_000, 100_400))))
        for _ in range(6_000)
    ]
    kept = spark.createDataFrame(rows, "a string, b int, number long").repartition(5).persist()
    yield kept
    kept.unpersist(blocking=True)


@pytest.mark.parametrize("names", [["a", "b"], ["a"], ["b"], []])
def test_any_coarser_grain(frame, names):
    maps = distinct_maps(frame, ["a", "b"], "number")
    wanted = F.count_distinct("number").alias("distinct_count")
    want = frame.groupBy(*names).agg(wanted) if names else frame.agg(wanted)
    got = distinct_counts(maps, names)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_maps_rolled_up_are_those_of_the_rows(frame):
    kept = lambda maps: sorted((r["a"], r["bucket"], bytes(r["members"])) for r in maps.collect())
    assert kept(roll_up_maps(distinct_maps(frame, ["a", "b"], "number"), ["a"])) == kept(distinct_maps(frame, ["a"], "number"))


def test_nothing_and_nulls(spark):
    none = spark.createDataFrame([("x", None)], "a string, number long")
    maps = distinct_maps(none, ["a"], "number")
    assert maps.collect() == [] and distinct_counts(maps, []).first()[0] == 0


def test_keys_are_numbered_densely_and_frequent_ones_first(spark):
    frame = spark.createDataFrame([(k,) for k in "bbbaac" + "d" * 9] + [(None,)], "k string")
    got = {r["k"]: r["number"] for r in numbered_keys(frame, "k").collect()}
    assert got == {"d": 1, "b": 2, "a": 3, "c": 4}


def test_maps_are_built_before_the_shuffle(frame):
    plan = final_plan(distinct_maps(frame, ["a"], "number"))
    assert "partial_bitmap_construct_agg" in plan
