"""Bounded samples of labelled rows for training."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def key_remainder(n: int, key: str = "doc_id"):
    """crc32 of the key as text, modulo ``n``; that of the empty text for a null key."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def per_label(rows: DataFrame, label: str, most: int, key: str = "doc_id", seed: int = 7) -> DataFrame:
    """At most ``most`` rows of each label, in a seeded order of the key. Rows without a key are left out."""
    order = Window.partitionBy(label).orderBy(F.xxhash64(F.lit(seed), key), key)
    return rows.where(F.col(key).isNotNull()).withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= most).drop("_n")
