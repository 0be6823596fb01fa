"""Join building blocks used by several operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions) if conditions else F.lit(True)


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions) if conditions else F.lit(False)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join on ``keys`` where null equals null; the keys come from the left."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    joined = left.join(renamed, all_of([F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]), how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"__r_{k}" for k in keys])


def broadcast_if_small(df: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """Marks a stored DataFrame for broadcast if it has at most ``max_rows`` rows.

    Runs a count, so pass a checkpoint or a table scan of a few narrow columns.
    Larger ones are returned as they are and joined by shuffle.
    """
    few = df.count() <= max_rows
    return F.broadcast(df) if few else df


def interval_overlap_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    slot: str = "DAY",
) -> DataFrame:
    """Pairs of rows with equal ``keys`` whose half-open time spans overlap.

    Both sides are laid out over the time slots they touch, so the join is an
    equi-join on (keys, slot) and a hot key spreads over its slots. A pair that
    shares several slots is emitted in the later of the two first slots only.
    Empty spans count as one instant.
    """

    def slots(df: DataFrame, span: tuple[str, str], name: str) -> DataFrame:
        start, end = F.col(span[0]).cast("timestamp"), F.col(span[1]).cast("timestamp")
        first = F.date_trunc(slot, start)
        last = F.greatest(first, F.date_trunc(slot, end - F.expr("interval 1 microsecond")))
        step = F.expr(f"interval 1 {slot}")
        return df.withColumn(name, first).withColumn("__slot", F.explode(F.sequence(first, last, step)))

    a = slots(left, left_span, "__first_l")
    b = slots(right, right_span, "__first_r")
    ls, le = (F.col(c) for c in left_span)
    rs, re = (F.col(c) for c in right_span)
    return (
        a.join(b, [*keys, "__slot"])
        .filter(F.col("__slot") == F.greatest("__first_l", "__first_r"))
        .filter((ls == rs) | ((ls < re) & (rs < le)))
        .drop("__slot", "__first_l", "__first_r")
    )
