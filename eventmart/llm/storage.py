"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from eventmart.session import shared_folder


def materialize(df: DataFrame, name: str, *by: str, **options: str) -> DataFrame:
    """Writes ``df`` as Parquet under ``spark.checkpoint.dir``, in folders by the columns ``by``, and reads it back.

    This cuts the lineage, so a lost executor costs no more than the running
    step. The table is left in that folder, as results may be read later.
    """
    path = shared_folder(df.sparkSession, name)
    # The table replaces the shuffle files it was made from; this has Spark drop them when the write ends.
    # Another query of the session that runs meanwhile would at worst compute a stage again.
    spark, setting = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, "false")
    spark.conf.set(setting, "true")
    try:
        df.write.partitionBy(*by).options(**options).parquet(path)
    finally:
        spark.conf.set(setting, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(name: str, df: DataFrame) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
