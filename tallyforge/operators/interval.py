"""Shortest stretch of a repeating cycle that covers a target share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _prefix_sums(weights: Column, number: DataType) -> Column:
    """Sums before each place of ``weights``, and that of all: one more than there are weights."""
    return F.aggregate(
        weights,
        F.array(F.lit(0).cast(number)),
        lambda sums, w: F.array_append(sums, (F.element_at(sums, -1) + w).cast(number)),
    )


def _shortest_run(prefix: Column, period: int, reached: Callable[[Column], Column]) -> Column:
    """``start`` and ``best``, the length, of the shortest run whose sum is ``reached``; the earliest of those.

    ``prefix`` has the prefix sums of two turns.  Ends are looked at one after the other.  Starts wait in a
    queue of rising prefix sums, as a later start with a sum no larger beats those before it.  The first
    in the queue therefore covers the most: if it does not reach, none does, and a start that has
    reached leaves, as it can only grow longer.  Starts older than the best run leave too.  So each
    start enters and leaves once, also where weights are negative.  Without a run, ``best`` is above
    ``period``.
    """

    def step(state: Column, end: Column) -> Column:
        here = F.get(prefix, end)
        reaches = lambda start: reached(here - F.get(prefix, start))
        waiting, first = state["queue"], F.get(state["queue"], F.lit(0))
        aged = F.when(end - first >= state["best"], F.slice(waiting, 2, F.size(waiting))).otherwise(waiting)

        def after(queue: Column, best: Column, start: Column) -> Column:
            return F.struct(queue.alias("queue"), best.alias("best"), start.alias("start"))

        def ended(queue: Column) -> Column:
            def taken(done: Column) -> Column:
                last = F.element_at(done, -1)
                shorter = end - last < state["best"]
                return after(
                    F.slice(queue, F.size(done) + 1, F.size(queue)),
                    F.when(shorter, end - last).otherwise(state["best"]),
                    F.when(shorter, last).otherwise(state["start"]),
                )

            some = reaches(F.get(queue, F.lit(0)))
            return F.when(some, _let(F.filter(queue, reaches), taken)).otherwise(
                after(queue, state["best"], state["start"])
            )

        def joined(now: Column) -> Column:
            queue = now["queue"]
            beaten = F.get(prefix, F.get(queue, F.size(queue) - 1)) >= here
            left = F.when(beaten, F.filter(queue, lambda x: F.get(prefix, x) < here)).otherwise(queue)
            return after(
                F.when(end < period, F.array_append(left, end)).otherwise(left), now["best"], now["start"]
            )

        return _let(_let(aged, ended), joined)

    begin = F.struct(
        F.array(F.lit(0)).alias("queue"), F.lit(period + 1).alias("best"), F.lit(0).alias("start")
    )
    return F.aggregate(F.sequence(F.lit(1), F.lit(2 * period)), begin, step)


def shortest_circular_interval(
    frame: DataFrame,
    slot: str,
    weight: str,
    period: int = 24,
    target_share: float = 0.8,
    start: str = "start_hour",
    end: str = "end_hour",
    length: str = "hours",
    covered: str = "covered_amount",
    total: str = "total_approved_amount",
) -> DataFrame:
    """The shortest run of consecutive slots (wrapping around) reaching ``target_share``.

    Among runs of the same length the earliest start wins.  No row is returned if the total is not
    positive.  The weights are first added per slot, so what is gathered into one array is at most
    ``period`` numbers, whatever the size of ``frame``, and the search passes over two turns once.
    """
    inside = F.col(slot).between(0, period - 1)
    slots = frame.groupBy(slot).agg(F.sum(weight).alias("_weight"))
    number = slots.schema["_weight"].dataType
    if isinstance(number, DecimalType):
        number = DecimalType(38, number.scale)
    zero = F.lit(0).cast(number)
    cycle = slots.agg(
        F.map_from_entries(
            F.collect_list(F.when(inside, F.struct(F.col(slot).cast("int"), F.col("_weight"))))
        ).alias("_by_slot"),
        F.sum("_weight").cast(number).alias(total),
    ).filter(F.col(total) > 0)

    # Two turns of the cycle in a row, so that a run past the end is a difference of two sums.
    turns = F.transform(
        F.sequence(F.lit(0), F.lit(2 * period - 1)),
        lambda i: F.coalesce(F.try_element_at("_by_slot", F.pmod(i, F.lit(period))), zero).cast(number),
    )
    whole = F.col(total).cast("double")
    reached = lambda s: s.cast("double") / whole >= F.lit(float(target_share))
    run = _shortest_run(F.col("_prefix"), period, reached)
    summed = cycle.select(total, _prefix_sums(turns, number).alias("_prefix"))
    # A generator, unlike a filter, is never moved below the sums, where each look at one would add them anew.
    any_run = F.filter(F.array(run), lambda x: x["best"] <= period)
    found = summed.select(total, "_prefix", F.explode(any_run).alias("_run"))
    first, size = F.col("_run.start"), F.col("_run.best")
    amount = (F.get("_prefix", first + size) - F.get("_prefix", first)).cast(number)
    return found.select(
        first.alias(start),
        F.pmod(first + size, F.lit(period)).alias(end),
        size.alias(length),
        amount.alias(covered),
        total,
        (amount.cast("double") / whole).alias("share"),
        F.lit(float(target_share)).alias("target_share"),
    )
