"""Ranks, top-k and shares.

Every order passed in should be total (end with a key that is unique in the ranked set), so that
the result does not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.values import ratio


def top_k_per_group(
    frame: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """The first ``k`` rows of each group with their rank.

    The ``rank <= k`` filter makes Spark cut every group to k rows per task before the shuffle,
    so a group that holds most of the rows still sends only k rows per task.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return frame.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def top_k(frame: DataFrame, order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of the whole frame with their rank."""
    leaders = frame.orderBy(*order).limit(k)
    return leaders.withColumn(rank, F.row_number().over(Window.orderBy(*order)))


def _ranges(frame: DataFrame) -> int:
    """Ranges of a whole order: two for each shuffle partition, so that their hashes fill tasks more evenly,
    but one where that makes over 1,024, as every range tells its size to all later ones."""
    partitions = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(2 * partitions, max(partitions, 1024))


def rank_by_measure(
    frame: DataFrame, measure: str, ties: Sequence[Column], rank: str = "rank", total: str | None = None
) -> DataFrame:
    """Rank every row by ``measure`` descending, nulls last, then by ``ties``.

    Rows are dealt out in ranges of the whole order, ties included, by Spark's own sample of the rows, and
    numbered inside their range.  The first row of each range sends the range's size to all later ones, where
    the sizes are added up.  So neither equal measures nor ones that lie close together meet in one task,
    and nothing runs before the result is asked for.  There is one exchange by range in the plan, so that all numbers
    rest on the same ranges.  ``total`` names a column for the sum of the measure over all rows.
    """
    order = [F.desc_nulls_last(measure), *ties]
    ranges = _ranges(frame)
    ranged = frame.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id())
    inside = Window.partitionBy("_range")
    counted = ranged.withColumns(
        {
            "_at": F.row_number().over(inside.orderBy(*order)),
            "_size": F.count(F.lit(1)).over(inside),
            "_sum": F.sum(measure).over(inside),
        }
    )

    def note(to: Column, size: Column, part: Column, own: bool) -> Column:
        return F.struct(
            to.alias("to"), size.cast("long").alias("size"), part.alias("sum"), F.lit(own).alias("own")
        )

    none = F.lit(None).cast(counted.schema["_sum"].dataType)
    itself = F.array(note(F.col("_range"), F.lit(0), none, True))
    notes = F.transform(
        F.sequence(F.lit(0), F.lit(ranges - 1)),
        lambda to: note(to, F.when(to > F.col("_range"), F.col("_size")).otherwise(0), F.col("_sum"), False),
    )
    if not total:
        notes = F.filter(notes, lambda x: x["to"] > F.col("_range"))
    sent = counted.withColumn(
        "_note", F.explode(F.when(F.col("_at") == 1, F.concat(itself, notes)).otherwise(itself))
    ).withColumn("_to", F.col("_note.to"))
    there = Window.partitionBy("_to")
    placed = sent.withColumn("_before", F.sum("_note.size").over(there))
    if total:
        placed = placed.withColumn("_total", F.sum("_note.sum").over(there))
    placed = placed.filter("_note.own").withColumn(rank, F.col("_at") + F.col("_before"))
    if total:
        placed = placed.withColumn(total, F.col("_total"))
    return placed.drop("_range", "_at", "_size", "_sum", "_note", "_to", "_before", "_total")


def rank_small(frame: DataFrame, order: Sequence[Column], rank: str = "rank") -> DataFrame:
    """Rank the rows of a frame of proven small size, such as the months of a calendar."""
    return frame.withColumn(rank, F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def rank_and_share(
    frame: DataFrame, measure: str, key: str, rank: str = "rank", share: str = "approved_share"
) -> DataFrame:
    """Rank by ``measure`` descending (``key`` breaks ties) and add each row's share of the total."""
    ranked = rank_by_measure(frame, measure, [F.asc_nulls_last(key)], rank, total="_whole")
    return ranked.withColumn(share, ratio(F.col(measure), F.col("_whole"))).drop("_whole")


def share_in_small_frame(frame: DataFrame, measure: str, share: str) -> DataFrame:
    """Share of the total for a frame of proven small size, such as the 24 hours of a day."""
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return frame.withColumn(share, ratio(F.col(measure), F.sum(measure).over(everything)))


def rank_selected_in_group(
    frame: DataFrame,
    selected: DataFrame,
    group: str,
    measure: str,
    key: str,
    rank: str,
    most: int = 64,
) -> DataFrame:
    """Rank the ``selected`` rows among *all* rows of ``frame`` that share their group.

    Order: ``measure`` descending, then ``key`` ascending with nulls last.  The rank is the number
    of rows at or before the selected row, so no group is sorted or gathered: the selected rows of a
    group travel as one short array, each row of the group meets that array once, and the hits
    are added up before they are shuffled.  ``selected`` is a subset of ``frame`` with non-null keys; more
    than ``most`` rows in a group end the query with an error.
    """
    columns = selected.columns
    chosen = F.struct(*columns)
    marks = selected.groupBy(F.col(group).alias("_of")).agg(
        F.count(F.lit(1)).alias("_n"), F.collect_list(chosen).alias("_marks")
    )
    text = F.concat(F.lit(f"more than {most} selected rows in group "), F.col("_of").cast("string"))
    checked = marks.select(
        "_of",
        F.when(F.col("_n") <= most, F.col("_marks"))
        .otherwise(F.raise_error(F.coalesce(text, F.lit("null"))).cast(marks.schema["_marks"].dataType))
        .alias("_marks"),
    )
    rivals = frame.select(
        F.col(group).alias("_group"), F.col(measure).alias("_measure"), F.col(key).alias("_key")
    )

    def reached(mark: Column) -> Column:
        level = F.col("_measure") == mark[measure]
        return (F.col("_measure") > mark[measure]) | (level & (F.col("_key") <= mark[key]))

    met = rivals.join(checked, F.col("_group").eqNullSafe(F.col("_of")))
    hits = met.select(F.explode(F.filter("_marks", reached)).alias("_mark"))
    return hits.groupBy("_mark").agg(F.count(F.lit(1)).alias(rank)).select(
        *(F.col("_mark")[c].alias(c) for c in columns), rank
    )
