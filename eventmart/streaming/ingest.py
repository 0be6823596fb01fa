"""Streams from landing files to bronze and from bronze to silver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from eventmart.operators.history import BUCKET, BUCKETS, with_bucket
from eventmart.operators.project import typed_select
from eventmart.operators.quality import Rule, accepted, clean, store_counters
from eventmart.sources.landing import csv_lines, csv_records, read_landing_json

# Partition column of folders whose micro-batches are batch jobs.
INGEST_BATCH = "ingest_batch"


def run_ingest(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    continuous: str | None = None,
    partition_by: Sequence[str] = (),
    query_name: str | None = None,
) -> StreamingQuery:
    """Appends a stream to a Parquet folder, exactly once by its checkpoint.

    Takes what is there and stops, or with ``continuous`` (such as "1 minute")
    keeps going at that interval.
    """
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(processingTime=continuous) if continuous else writer.trigger(availableNow=True)
    return writer.start(path)


def _write_batch(df: DataFrame, folder: str, batch_id: int) -> None:
    """Writes a micro-batch to its own partition of a folder, whole or not at all; one that comes again replaces it."""
    batch = df.withColumn(INGEST_BATCH, F.lit(batch_id).cast("bigint"))
    batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(INGEST_BATCH).parquet(folder)


def ingest_landing(
    spark: SparkSession,
    landing: str,
    fmt: str,
    schema: StructType,
    bronze: str,
    checkpoint: str,
    continuous: str | None = None,
    files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Landing JSON or CSV files to a bronze folder.

    CSV lines are read by the header of their own file, which a stream cannot
    join; so each micro-batch is a batch job, kept in its own partition
    (``ingest_batch``), which a repeated batch replaces.
    """
    if fmt == "json":
        stream = read_landing_json(spark, landing, schema, streaming=True, files_per_trigger=files_per_trigger)
        return run_ingest(stream, bronze, checkpoint, continuous)
    if fmt != "csv":
        raise ValueError("fmt is 'csv' or 'json'")

    def take_in(lines: DataFrame, batch_id: int) -> None:
        _write_batch(csv_records(lines, schema), bronze, batch_id)

    stream = csv_lines(spark, landing, streaming=True, files_per_trigger=files_per_trigger)
    writer = stream.writeStream.foreachBatch(take_in).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=continuous) if continuous else writer.trigger(availableNow=True)
    return writer.start()


def count_folder(
    spark: SparkSession,
    bronze: str,
    bronze_schema: StructType,
    silver_schema: StructType,
    rules: Sequence[Rule],
    counters: str,
    stream: str,
    checkpoint: str,
    update_id: str = "",
    continuous: str | None = None,
) -> StreamingQuery:
    """Counts what every rule says to the rows :func:`clean_folder` takes in, into a folder of counters.

    A stream beside the cleaning one: a counter is stored with its batch or the
    batch is counted again, so none is lost or doubled.
    """

    def take_in(batch: DataFrame, batch_id: int) -> None:
        store_counters(typed_select(accepted(batch), silver_schema), rules, counters, stream, batch_id, update_id)

    writer = spark.readStream.schema(bronze_schema).parquet(bronze).writeStream.foreachBatch(take_in)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=continuous) if continuous else writer.trigger(availableNow=True)
    return writer.start()


def clean_folder(
    spark: SparkSession,
    bronze: str,
    bronze_schema: StructType,
    silver: str,
    silver_schema: StructType,
    rules: Sequence[Rule],
    checkpoint: str,
    observation_name: str | None = None,
    continuous: str | None = None,
    bucket_keys: Sequence[str] = (),
    date_of: str | None = None,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Bronze folder to silver folder with the same rules as the batch path.

    Counters of warn and drop rules reach listeners as an observed metric of
    each progress event; :func:`count_folder` keeps them in a table.
    With ``bucket_keys`` the silver folder is partitioned by their hash bucket,
    as staged changes for a history should be (in as many ``buckets``); with ``date_of`` by the local
    date of that column (``event_date``), as events should be.
    """
    stream = spark.readStream.schema(bronze_schema).parquet(bronze)
    cleaned = clean(stream, silver_schema, rules, observation_name)
    parts = []
    if bucket_keys:
        cleaned = with_bucket(cleaned, bucket_keys, buckets)
        parts.append(BUCKET)
    if date_of:
        cleaned = cleaned.withColumn("event_date", F.to_date(date_of))
        parts.append("event_date")
    return run_ingest(cleaned, silver, checkpoint, continuous, parts)
