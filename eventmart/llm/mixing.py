"""Mixing sources to target weights.

Targets come from capped water-filling. Every source may be repeated
``max_epochs`` times at most; sources whose share is above that are clamped,
and what they leave is dealt to the others by weight, until none is above.
A document is then taken whole as often as its source's target holds the
source, and once more while the seeded order of the source has room.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.storage import materialize, unused

WORD = r"[^\x20\x09-\x0D]+"
#: Hex digits of the seeded order that cut a source into slices: no task orders more than a slice.
SLICE_DIGITS = 3


def n_words(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cycled_weights(sources: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """Sources (one row each) with ``weight``: the given numbers in turn, by code point, null last.

    The window holds one row per source, not per document.
    """
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    return sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("long"))


def water_level(sources: DataFrame, total: float, max_epochs: int) -> float:
    """Words per unit of weight of every source that is not clamped; infinite if all are.

    ``sources``: source_size, weight. Each round reads the (small) table once and
    clamps the sources above the level of the round before.
    """
    cap, level, clamped = F.col("source_size") * max_epochs, 0.0, -1
    while True:
        held = cap <= F.col("weight") * F.lit(level)
        n, used, weight = sources.agg(
            F.count_if(held), F.coalesce(F.sum(F.when(held, cap)), F.lit(0)), F.coalesce(F.sum(F.when(~held, F.col("weight"))), F.lit(0))
        ).first()
        if not weight:
            return math.inf
        if n == clamped:
            return level
        clamped, level = n, (total - used) / weight


def targets(sources: DataFrame, share: float, max_epochs: int) -> DataFrame:
    """Adds ``target`` to (source, source_size, weight); together they hold ``share`` times all words, if the caps allow it."""
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * share
    level, cap = water_level(sources, total, max_epochs), (F.col("source_size") * max_epochs).cast("double")
    return sources.withColumn("target", cap if math.isinf(level) else F.least(cap, F.col("weight") * F.lit(level)))


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
    max_epochs: int = 2,
    seed: str = "mix",
) -> DataFrame:
    """What the mix takes of every row of ``docs`` (doc_id, text, source).

    Returns doc_id, source, size, source_size, target, repeats, taken
    (size * repeats). A source's taken words differ from its target by half a
    document at most. The seeded order is md5 of seed and doc_id, so reruns agree.

    A null source is a source of its own. Null and wordless texts have size 0
    and repeats like any other. Rows with one doc_id are ordered by size and
    counted one by one; a null doc_id is ordered as the empty text. An empty
    table gives an empty result. Other columns are not looked at.
    """
    order = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    sized = materialize(
        docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), order.alias("_order")), "mix-sizes"
    )
    piece = F.substring("_order", 1, SLICE_DIGITS)
    pieces = materialize(sized.groupBy("source", piece.alias("_piece")).agg(F.sum("size").alias("_words")), "mix-pieces")
    sources = materialize(
        cycled_weights(pieces.groupBy("source").agg(F.sum("_words").alias("source_size")), weights), "mix-sources"
    )
    goal = targets(sources, share, max_epochs).withColumn(
        "_whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    )
    goal = goal.withColumn("_extra", F.col("target") - F.col("_whole") * F.col("source_size"))
    before = Window.partitionBy("source").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    base = pieces.withColumn("_before", F.coalesce(F.sum("_words").over(before), F.lit(0))).join(
        goal, pieces["source"].eqNullSafe(goal["source"])
    ).select(pieces["source"].alias("_source"), F.col("_piece").alias("_at"), "_before", "source_size", "target", "_whole", "_extra")
    here = Window.partitionBy("source", "_piece").orderBy("_order", "size").rowsBetween(Window.unboundedPreceding, 0)
    ranked = sized.withColumn("_piece", piece).withColumn("_sum", F.sum("size").over(here))
    joined = ranked.join(base, ranked["source"].eqNullSafe(base["_source"]) & (ranked["_piece"] == base["_at"]))
    room = 2 * (F.col("_before") + F.col("_sum")) - F.col("size") <= 2 * F.col("_extra")
    repeats = F.col("_whole") + F.when(room & (F.col("_whole") < max_epochs), 1).otherwise(0)
    return joined.withColumn("repeats", repeats.cast("long")).select(
        "doc_id", "source", "size", "source_size", "target", "repeats", (F.col("size") * F.col("repeats")).alias("taken")
    )


def repeat_rows(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """Every document as often as the mix takes it, with the columns of ``docs``; documents taken 0 times go.

    Rows that repeat a doc_id are each taken as often as the most taken of them.
    """
    key, times, copy = unused("_id", docs), unused("_times", docs), unused("_copy", docs)
    taken = mixed.groupBy(F.col("doc_id").alias(key)).agg(F.max("repeats").alias(times)).where(F.col(times) > 0)
    repeated = docs.join(taken, F.col("doc_id").eqNullSafe(F.col(key)))
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col(times)))
    return repeated.withColumn(copy, each).drop(key, times, copy)
