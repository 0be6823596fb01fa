"""Order-dependent operators that hold when one key owns much of the data.

A window per key sorts that key's rows in one task. Keys with few rows keep
that plain window. Rows of hot keys are cut into ranges of (key, order) of a
bounded size, whatever the type of the order; the value that crosses a border
comes from a small table of the ranges' edges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventmart.operators.joins import broadcast_if_small, null_safe_join
from eventmart.session import ensure_checkpoint_dir

# Rows per key one task may sort.
HOT_ROWS = 5_000_000


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows, and their number of rows; reads only the key columns."""
    return df.groupBy(F.struct(*keys).alias("__key")).count().filter(F.col("count") > hot_rows)


def split_hot(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], hot_rows: int = HOT_ROWS, counted: DataFrame | None = None
) -> list[DataFrame]:
    """The rows with ``__key`` (a never-null struct); those of hot keys apart, with ``__chunk``.

    One count over the keys of ``counted`` (by default ``df``; it must have as
    many rows per key or more) decides. Usually no key is hot, then there is one
    part and its plan has no trace of this. A chunk is a range of (key, order)
    from Spark's range partitioning, numbered along the order, of half of
    ``hot_rows`` on average; rows with equal order share one. The hot rows are
    stored, so that a lost executor cannot move a border.
    """
    keyed = df.withColumn("__key", F.struct(*keys))
    ensure_checkpoint_dir(df.sparkSession)
    hot = hot_keys(df if counted is None else counted, keys, hot_rows).checkpoint()
    rows = hot.agg(F.sum("count")).first()[0]
    if not rows:
        return [keyed]
    found = broadcast_if_small(hot.select("__key"))
    chunks = -(-2 * rows // max(1, hot_rows))
    ranged = keyed.join(found, "__key", "left_semi").repartitionByRange(chunks, "__key", *order)
    return [keyed.join(found, "__key", "left_anti"), ranged.withColumn("__chunk", F.spark_partition_id()).checkpoint()]


def neighbour(
    df: DataFrame, order: Sequence[str], value: Column, name: str, following: bool = False
) -> DataFrame:
    """Adds the previous (or following) row's ``value`` struct as ``name``.

    ``df`` is a part of :func:`split_hot`. Equal to ``lag``/``lead`` over the
    whole key. Rows stay partitioned by key (and chunk), so several calls and a
    grouping on the same columns need one shuffle together.
    """
    shift = F.lead if following else F.lag
    if "__chunk" not in df.columns:
        return df.withColumn(name, shift(value).over(Window.partitionBy("__key").orderBy(*order)))
    window = Window.partitionBy("__key", "__chunk").orderBy(*order)
    inside = df.withColumn("__v", value).withColumn(name, shift("__v").over(window))
    edge = F.min if following else F.max
    per_chunk = df.withColumn("__v", value).groupBy("__key", "__chunk").agg(edge(F.struct(*order, "__v")).alias("__edge"))
    along = Window.partitionBy("__key").orderBy("__chunk")
    crossing = per_chunk.select(
        "__key", "__chunk", shift(F.col("__edge")["__v"]).over(along).alias("__outer")
    )
    return (
        inside.join(crossing, ["__key", "__chunk"], "left")
        .withColumn(name, F.coalesce(name, "__outer"))
        .drop("__v", "__outer")
    )


def drop_chunks(df: DataFrame) -> DataFrame:
    return df.drop("__key", "__chunk")


def new_values(values: DataFrame, keys: Sequence[str], bucket: str, value: str) -> DataFrame:
    """Per (keys, bucket): how many values the key shows for the first time; a null counts as a value."""
    return (
        values.groupBy(*keys, value)
        .agg(F.min(bucket).alias(bucket))
        .groupBy(*keys, bucket)
        .agg(F.count("*").alias("new_values"))
    )


def running_distinct(df: DataFrame, keys: Sequence[str], bucket: str, value: str, name: str) -> DataFrame:
    """Distinct non-null values of a key up to and including each bucket.

    Stands for ``count(distinct value) over (partition by keys order by bucket)``
    at (keys, bucket) grain. A value counts in its first bucket; the window only
    sees one row per bucket.
    """
    window = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
    buckets = df.select(*keys, bucket, F.lit(0).cast("long").alias("new_values"))
    return (
        buckets.distinct()
        .unionByName(new_values(df.filter(F.col(value).isNotNull()), keys, bucket, value))
        .repartition(*keys)
        .groupBy(*keys, bucket)
        .agg(F.sum("new_values").alias("new_values"))
        .select(*keys, bucket, F.sum("new_values").over(window).alias(name))
    )


def rank_by_value(df: DataFrame, group: Sequence[str], value: str, name: str) -> DataFrame:
    """``rank() over (partition by group order by value desc)`` by ranking distinct values.

    Meant for coarse values (few distinct ones per group): the window holds one
    row per distinct value instead of one per row. The join back is on
    (group, value); its small side is sized by AQE at run time.
    """
    ahead = Window.partitionBy(*group).orderBy(F.desc(value)).rowsBetween(Window.unboundedPreceding, -1)
    ranks = (
        df.groupBy(*group, value)
        .count()
        .select(*group, value, (F.coalesce(F.sum("count").over(ahead), F.lit(0)) + 1).cast("int").alias(name))
    )
    return null_safe_join(df, ranks, [*group, value], "left")


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group; Spark trims to one row per group before the shuffle."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(window)).filter("__rn = 1").drop("__rn")
