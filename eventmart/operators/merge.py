"""Upsert, delete and erasure as pure functions of the old and the new rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventmart.operators.joins import all_of, null_safe_join


def assert_unique(df: DataFrame, keys: Sequence[str], nulls_equal: bool = True) -> DataFrame:
    """The same rows; the job fails if two of them share a key.

    Unless ``nulls_equal``, keys with a null are never duplicates of each other.
    """
    if not nulls_equal:
        # Rows with a null key need no window, where all of them would meet in one task.
        whole = all_of([F.col(k).isNotNull() for k in keys])
        return assert_unique(df.filter(whole), keys).unionByName(df.filter(~whole))
    window = Window.partitionBy(*keys).orderBy(*keys)
    fine = F.row_number().over(window) == 1
    message = F.concat(F.lit("more than one source row for key "), F.to_json(F.struct(*keys)))
    return (
        df.withColumn("__one", fine)
        .filter(F.when(F.col("__one"), F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
        .drop("__one")
    )


def _without(target: DataFrame, found: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    if null_safe:
        return null_safe_join(target, found, keys, "left_anti")
    return target.join(found, list(keys), "left_anti")


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    null_safe: bool = False,
    on_duplicate: str = "error",
) -> DataFrame:
    """Target rows without a match, and every source row.

    With ``null_safe`` a null key matches a null key; otherwise it matches
    nothing, so such source rows are added. Duplicate source keys fail the job
    unless ``on_duplicate`` is "keep" (the caller knows the keys are unique).
    """
    if on_duplicate not in ("error", "keep"):
        raise ValueError("on_duplicate is 'error' or 'keep'")
    checked = assert_unique(source, keys, null_safe) if on_duplicate == "error" else source
    return _without(target, source.select(*keys), keys, null_safe).unionByName(checked.select(*target.columns))


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is not true."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def replace_keys(target: DataFrame, rows: DataFrame, affected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of the affected keys give way to ``rows``."""
    return _without(target, affected, keys, null_safe=True).unionByName(rows.select(*target.columns))


def erase_subjects(
    tables: dict[str, tuple[DataFrame, str]], subjects: DataFrame, key: str = "user_id"
) -> dict[str, DataFrame]:
    """Each table without the rows of the given subjects, in the order given.

    ``tables`` maps a name to a DataFrame and its subject column; list gold
    tables before silver ones so that nothing is rebuilt from erased rows.
    """
    gone = subjects.select(F.col(key).alias("__subject"))
    return {
        name: df.join(gone, F.col(column) == F.col("__subject"), "left_anti")
        for name, (df, column) in tables.items()
    }
