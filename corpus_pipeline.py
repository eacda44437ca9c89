"""A training corpus from raw documents: five stages, each the operator of its name.

A stage takes the Spark session, the documents the stage before has kept and the folder of the tables, and
returns the documents it keeps, with their columns.  The last adds shard, grown_shard and slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyforge.llm import decontamination, mixing, near_duplicates, quality_rules, sharding
from tallyforge.llm.common import stage

#: Percent of the union that near copies share; op6_minhash has a limit of its own.
NEAR = 80


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or their host's verdict reject go."""
    return quality_rules.passing(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, of similarity 0.8 or more, stays."""
    return near_duplicates.one_of_each(docs, percent=NEAR)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.without_contaminated(docs, benchmark)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out or repeated so that sources reach their target weights."""
    return mixing.mixed(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets its shard and its place there."""
    return sharding.sharded(docs)


STAGES = [
    ("quality rules", apply_quality_rules),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

#: SQL has no MinHash, so that the rows of a run are tested against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
