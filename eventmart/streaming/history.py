"""Type-2 history kept up to date from a stream of staged changes."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from eventmart.operators.history import BUCKET, BUCKETS, scd2, scd2_extend, sequence_state, with_bucket
from eventmart.operators.incremental import of_keys
from eventmart.operators.joins import broadcast_if_small
from eventmart.session import ensure_checkpoint_dir
from eventmart.sources.catalog import keep_buckets, overwrite_partitions, read_table, table_exists


# Suffixes of the tables with the last sequence of each key and with the staged files that were taken in.
STATE = "__last"
FILES = "__files"
# A path has this or not, by where it is asked for.
EMPTY_HOST = re.compile(r"^(\w+):///")


def state_table(table: str) -> str:
    return f"{table}{STATE}"


def apply_batch(
    batch: DataFrame,
    staged: DataFrame | Callable[[], DataFrame],
    table: str,
    keys: Sequence[str],
    sequence_by: str | Sequence[str],
    track: Sequence[str] | None = None,
    buckets: int = BUCKETS,
    location: str | None = None,
) -> None:
    """Takes one micro-batch into the history table.

    The table is partitioned by a hash bucket of the key; only buckets with a
    key of the batch are read and rewritten. A table beside it keeps the last
    sequence of each key. Keys whose changes come in order are extended from
    their open version; ``staged`` is read for late and repeated ones only, and
    for the batch that creates the table, and then only its buckets if it has
    that partition column. Running it again changes nothing, also if it stopped
    between the two tables. ``location`` is where a new table's files go, if not
    to the warehouse.
    """
    spark = batch.sparkSession
    ensure_checkpoint_dir(spark)
    exists = table_exists(spark, table)
    if exists:
        keep_buckets(spark, table, buckets)
    if BUCKET in batch.columns:
        # Staged in another number of buckets, a key's changes would be looked for in the wrong one.
        placed = with_bucket(batch.select(*keys, F.col(BUCKET).alias("__staged")), keys, buckets)
        if placed.filter(F.col(BUCKET) != F.col("__staged")).take(1):
            raise ValueError(f"changes are not staged in {buckets} buckets")
    stored = with_bucket(batch.select(*keys).distinct(), keys, buckets).checkpoint()
    # At most ``buckets`` rows; Spark prunes partitions by them.
    used = F.broadcast(stored.select(BUCKET).distinct())

    def changes() -> DataFrame:
        found = staged() if callable(staged) else staged
        return found.join(used, BUCKET, "left_semi").drop(BUCKET) if BUCKET in found.columns else found

    def of_buckets(name: str) -> DataFrame:
        return read_table(spark, name).join(used, BUCKET, "left_semi").drop(BUCKET)

    last, rows = state_table(table), batch.drop(BUCKET)
    if exists:
        if table_exists(spark, last):
            state = of_buckets(last)
        else:
            state = sequence_state(rows, keys, sequence_by).limit(0)
        history, state = scd2_extend(of_buckets(table), state, changes, rows, keys, sequence_by, track)
        # Both are read from the stored tables, so the state is fixed before the history changes.
        state = state.checkpoint()
        overwrite_partitions(_in_few_files(with_bucket(history, keys, buckets)), table)
    else:
        whole = of_keys(changes(), broadcast_if_small(stored.select(*keys)), keys)
        history, state = scd2(whole, keys, sequence_by, track), sequence_state(whole, keys, sequence_by)
        writer = _in_few_files(with_bucket(history, keys, buckets)).write.partitionBy(BUCKET)
        (writer.option("path", location) if location else writer).saveAsTable(table)
        keep_buckets(spark, table, buckets)
    state = _in_few_files(with_bucket(state, keys, buckets))
    if table_exists(spark, last):
        overwrite_partitions(state, last)
    else:
        writer = state.write.partitionBy(BUCKET)
        (writer.option("path", f"{location}{STATE}") if location else writer).saveAsTable(last)


def _in_few_files(df: DataFrame) -> DataFrame:
    """Rows of a bucket meet in tasks of about the advised size, so that it is a few files, however large it is."""
    return df.hint("rebalance", BUCKET)


def run_history(
    spark: SparkSession,
    staged_folder: str,
    schema: StructType,
    table: str,
    checkpoint: str,
    keys: Sequence[str],
    sequence_by: str | Sequence[str],
    track: Sequence[str] | None = None,
    continuous: str | None = None,
    files_per_trigger: int | None = None,
    buckets: int = BUCKETS,
    location: str | None = None,
) -> StreamingQuery:
    """Streams the staged folder into the history table, one micro-batch at a time.

    Taking changes in rewrites every bucket they touch, so a micro-batch with
    new files takes in all files that wait in the folder, not its own only: a
    backlog costs one rewrite, not one for each of its micro-batches. A table
    beside the history names the files taken in; micro-batches of such files
    alone change nothing.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    taken: set[str] | None = None

    def take_in(batch: DataFrame, _: int) -> None:
        nonlocal taken
        session = batch.sparkSession

        def staged() -> DataFrame:
            return session.read.schema(schema).parquet(staged_folder)

        if not table_exists(session, table):
            taken = None
        elif taken is None:
            taken = _names(read_table(session, f"{table}{FILES}"), "file") if table_exists(session, f"{table}{FILES}") else set()
        new = _names(batch, "__file")
        if taken is not None:
            new -= taken
            if not new:
                return
        # Names of files only; the stream's own log of them is in the driver, too.
        found = {EMPTY_HOST.sub(r"\1:/", f) for f in staged().inputFiles()}
        if not new <= found:
            raise LookupError(f"staged files are gone: {sorted(new - found)[:3]}")
        waiting = sorted(found - (taken or set()))
        rows = staged().where(_file().isin(waiting)) if taken else staged()
        apply_batch(rows, staged, table, keys, sequence_by, track, buckets, location)
        writer = session.createDataFrame([(f,) for f in waiting], "file string").coalesce(1).write.mode("append" if taken else "overwrite")
        (writer.option("path", f"{location}{FILES}") if location else writer).saveAsTable(f"{table}{FILES}")
        taken = {*(taken or ()), *waiting}

    rows = reader.parquet(staged_folder).select("*", _file().alias("__file"))
    writer = rows.writeStream.foreachBatch(take_in).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=continuous) if continuous else writer.trigger(availableNow=True)
    return writer.start()


def _file() -> Column:
    """The path of a row's file."""
    return F.regexp_replace("_metadata.file_path", EMPTY_HOST.pattern, "$1:/")


def _names(df: DataFrame, column: str) -> set[str]:
    return {r[0] for r in df.select(column).distinct().collect()}
