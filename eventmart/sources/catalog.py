"""Catalog tables: existence, creation, replacement, upsert and statistics."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventmart.operators.joins import all_of, broadcast_if_small, null_safe_join
from eventmart.operators.merge import assert_unique, delete_where, merge_upsert
from eventmart.session import ensure_checkpoint_dir, remove_folder

# Formats whose tables Spark can change by row.
ROW_LEVEL_FORMATS = ("delta", "iceberg", "hudi")
# Suffix of the folder that holds later versions of an unpartitioned table, and the table property with the version before.
VERSIONS = "__versions"
PREVIOUS_PROPERTY = "eventmart.previous"


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """The table as it is now, also if another session (such as a stream's) rewrote its files."""
    spark.catalog.refreshTable(table)
    return spark.table(table)


def table_names(spark: SparkSession, database: str | None = None, prefix: str = "") -> DataFrame:
    """Names of a database's tables that start with ``prefix``, as a DataFrame."""
    clause = f" in {database}" if database else ""
    pattern = f" like '{prefix}*'" if prefix else ""
    return spark.sql(f"show tables{clause}{pattern}").filter(~F.col("isTemporary")).select(
        F.col("namespace").alias("table_schema"), F.col("tableName").alias("table_name")
    )


def append_table(df: DataFrame, table: str) -> None:
    """Inserts by column name, creating the table if need be."""
    if table_exists(df.sparkSession, table):
        columns = df.sparkSession.table(table).columns
        df.select(*columns).write.mode("append").insertInto(table)
    else:
        df.write.saveAsTable(table)


def drop_table(spark: SparkSession, table: str) -> None:
    """Drops a table with all its versions."""
    if not table_exists(spark, table):
        return
    folders = [] if partition_columns(spark, table) else _version_folders(spark, table)
    spark.sql(f"drop table {table}")
    for folder in folders:
        remove_folder(spark, folder)


BUCKETS_PROPERTY = "eventmart.buckets"


def keep_buckets(spark: SparkSession, table: str, buckets: int) -> None:
    """Stores the number of buckets a table is laid out in; fails if it was laid out in another.

    With another number the same key would lie in two partitions.
    """
    found = spark.sql(f"show tblproperties {table}").filter(F.col("key") == BUCKETS_PROPERTY).take(1)
    if not found:
        spark.sql(f"alter table {table} set tblproperties ('{BUCKETS_PROPERTY}' = '{int(buckets)}')")
    elif int(found[0]["value"]) != buckets:
        raise ValueError(f"{table} has {found[0]['value']} buckets, not {buckets}")


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _version_folders(spark: SparkSession, table: str) -> list[str]:
    """The folder of the table's later versions, and the version before the present one, if it was ever replaced."""
    previous = spark.sql(f"show tblproperties {table}").filter(F.col("key") == PREVIOUS_PROPERTY).take(1)
    location = table_location(spark, table)
    return [location.split(VERSIONS)[0] + VERSIONS, previous[0]["value"]] if previous else []


def replace_table(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrites a table with rows that may be computed from it, or creates it.

    An unpartitioned table gets a folder per version. The new one is written in
    full, then the catalog's location, the pointer, moves to it: a reader sees
    the old rows or the new ones and the table is never missing. The version
    before stays for readers that began with it, until the next replacement; one
    that was not finished is never pointed to. Of a partitioned table all
    partitions are rewritten.
    """
    spark = df.sparkSession
    if not table_exists(spark, table):
        df.write.partitionBy(*partition_by).saveAsTable(table)
        return
    parts = partition_columns(spark, table)
    if parts:
        rewrite_partitions(df, table, read_table(spark, table).select(*parts).distinct())
        return
    old, folders = table_location(spark, table), _version_folders(spark, table)
    new = f"{old.split(VERSIONS)[0]}{VERSIONS}/{uuid.uuid4().hex}"
    columns = spark.table(table).columns
    df.select(*columns).write.format(_provider(spark, table)).save(new)
    spark.sql(f"alter table {table} set tblproperties ('{PREVIOUS_PROPERTY}' = '{old}')")
    spark.sql(f"alter table {table} set location '{new}'")
    spark.catalog.refreshTable(table)
    if folders and folders[1] != old:
        remove_folder(spark, folders[1])


def table_location(spark: SparkSession, table: str) -> str:
    return table_details(spark, table).select("Location").first()[0]


def _provider(spark: SparkSession, table: str) -> str:
    return (table_details(spark, table).select("Provider").first()[0] or "").lower()


def table_details(spark: SparkSession, table: str) -> DataFrame:
    """One row: catalog, database, table, provider, location and statistics text of a table."""
    wanted = ["Catalog", "Database", "Table", "Provider", "Location", "Statistics", "Created Time"]
    return (
        spark.sql(f"describe table extended {table}")
        .filter(F.col("col_name").isin(wanted))
        .groupBy()
        .pivot("col_name", wanted)
        .agg(F.first("data_type"))
    )


def _row_level(spark: SparkSession, table: str) -> bool:
    return _provider(spark, table) in ROW_LEVEL_FORMATS


def upsert_table(
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    null_safe: bool = False,
    partition_by: Sequence[str] = (),
) -> None:
    """Merges ``source`` into a catalog table by key, creating it on first use.

    Tables of a format with row-level changes use Spark's MERGE. Others are
    rewritten; with ``partition_by`` (a subset of the keys) only the partitions
    the source touches are read and rewritten.
    """
    spark = source.sparkSession
    if not set(partition_by) <= set(keys):
        raise ValueError("partition columns must be merge keys, else a row could move away from its match")
    if not table_exists(spark, table):
        assert_unique(source, keys, null_safe).write.partitionBy(*partition_by).saveAsTable(table)
        return
    if _row_level(spark, table):
        name = table.split(".")[-1]
        pairs = [(F.col(f"{name}.{k}"), F.col(f"source.{k}")) for k in keys]
        match = all_of([a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])
        rows = assert_unique(source, keys, null_safe).alias("source")
        rows.mergeInto(table, match).whenMatched().updateAll().whenNotMatched().insertAll().merge()
        return

    # The merge reads the source twice; a checkpoint keeps its plan from running twice.
    ensure_checkpoint_dir(spark)
    rows = source.checkpoint()
    target = read_table(spark, table)
    if not partition_by:
        replace_table(merge_upsert(target, rows, keys, null_safe), table)
        return
    touched = broadcast_if_small(rows.select(*partition_by).distinct())
    same = all_of([target[c].eqNullSafe(touched[c]) for c in partition_by])
    merged = merge_upsert(target.join(touched, same, "left_semi"), rows, keys, null_safe)
    overwrite_partitions(merged, table)


def overwrite_partitions(df: DataFrame, table: str) -> set[Row]:
    """Replaces exactly the partitions present in ``df``, which may be read from the table itself; gives their values.

    The files are written by path with a write option, so no setting of the
    session changes while other writes run; new partitions are then added to
    the catalog.
    """
    spark = df.sparkSession
    parts = partition_columns(spark, table)
    written = Observation()
    rows = df.select(*spark.table(table).columns).observe(written, F.collect_set(F.struct(*parts)).alias("found"))
    writer = rows.write.format(_provider(spark, table)).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*parts).save(table_location(spark, table))
    found = {Row(**r.asDict()) for r in written.get["found"]}
    specs = " ".join(f"partition ({_partition_spec(values)})" for values in found)
    if found:
        spark.sql(f"alter table {table} add if not exists {specs}")
    spark.catalog.refreshTable(table)
    return found


def _partition_spec(values: Row) -> str:
    def literal(value) -> str:
        if value is None or isinstance(value, (int, float)):
            return "null" if value is None else str(value)
        return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"

    return ", ".join(f"`{name}` = {literal(value)}" for name, value in values.asDict().items())


def rewrite_partitions(df: DataFrame, table: str, touched: DataFrame) -> None:
    """Replaces the touched partitions of a table by ``df``, which may leave some of them empty.

    ``touched`` holds their distinct partition values, one row each. The write
    does not overwrite a partition that came out empty, so that one is dropped.
    """
    spark = df.sparkSession
    parts = partition_columns(spark, table)
    wanted = set(touched.select(*parts).collect())
    for values in wanted - overwrite_partitions(df, table):
        spark.sql(f"alter table {table} drop if exists partition ({_partition_spec(values)})")


def delete_rows(spark: SparkSession, table: str, condition: Column) -> None:
    """Deletes the rows for which the condition is true.

    Only partitions with such a row are rewritten, and nothing if there is none.
    """
    old = read_table(spark, table)
    hit = old.filter(F.coalesce(condition, F.lit(False)))
    parts = partition_columns(spark, table)
    if not hit.take(1):
        return
    if not parts:
        replace_table(delete_where(old, condition), table)
        return
    ensure_checkpoint_dir(spark)
    touched = hit.select(*parts).distinct().checkpoint()
    rewrite_partitions(delete_where(null_safe_join(old, F.broadcast(touched), parts, "left_semi"), condition), table, touched)


def delete_matches(spark: SparkSession, table: str, gone: DataFrame, column: str, key: str) -> None:
    """Deletes the rows whose ``column`` is among ``gone``'s ``key``.

    Tables of a format with row-level changes use Spark's MERGE. Of others only
    the partitions that hold such rows are rewritten, and nothing if none does.
    """
    subjects = gone.select(F.col(key).alias("__subject")).distinct()
    if _row_level(spark, table):
        name = table.split(".")[-1]
        subjects.mergeInto(table, F.col(f"{name}.{column}") == F.col("__subject")).whenMatched().delete().merge()
        return
    old = read_table(spark, table)
    hit = old.join(subjects, F.col(column) == F.col("__subject"), "left_semi")
    parts = partition_columns(spark, table)
    ensure_checkpoint_dir(spark)
    if not parts:
        if hit.take(1):
            replace_table(old.join(subjects, F.col(column) == F.col("__subject"), "left_anti"), table)
        return
    # One row per partition: as few as the table's folders.
    touched = hit.select(*parts).distinct().checkpoint()
    if touched.take(1):
        of_parts = null_safe_join(old, F.broadcast(touched), parts, "left_semi")
        rewrite_partitions(of_parts.join(subjects, F.col(column) == F.col("__subject"), "left_anti"), table, touched)


def _plain(path: Column) -> Column:
    """A path without the forms a local scheme may have, and without a closing slash."""
    return F.rtrim(F.regexp_replace(path, "^file:/*", "/"), F.lit("/"))


def folder_stats(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """Count, bytes, newest and oldest time of the data files of many folders, by their names.

    One listing, which Spark spreads over tasks if there are many folders; the
    files' contents are not read. A file belongs to the innermost folder.
    """
    places = spark.createDataFrame(list(folders.items()), "name string, location string").withColumn("location", _plain(F.col("location")))
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "[!_.]*")
        .load(sorted(set(folders.values())))
        .select(_plain(F.col("path")).alias("path"), "length", "modificationTime")
        .distinct()
    )
    return places.join(_of_places(listed, places), "name", "left").groupBy("name").agg(
        F.count("path").alias("num_files"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("size_bytes"),
        F.max("modificationTime").alias("last_modified"),
        F.min("modificationTime").alias("created_at"),
    )


def _of_places(files: DataFrame, places: DataFrame) -> DataFrame:
    """Files (``path``) with the ``name`` of the place with the longest location that is the file or a folder above it."""
    steps = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, F.lit(1), n), "/"))
    found = files.withColumn("location", F.explode(above)).join(places, "location")
    inner = found.groupBy("path").agg(F.max(F.struct(F.length("location"), "name"))["name"].alias("name"))
    return files.join(inner, "path")


def footer_counts(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """name and num_rows of Parquet folders or files; no column is read, the counts are in the footers."""
    places = spark.createDataFrame(list(folders.items()), "name string, location string").withColumn("location", _plain(F.col("location")))
    per_file = (
        spark.read.schema(StructType([]))
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "[!_.]*")
        .parquet(*sorted(set(folders.values())))
        .groupBy(F.col("_metadata.file_path").alias("path"))
        .count()
        .select(_plain(F.col("path")).alias("path"), "count")
    )
    sums = _of_places(per_file.groupBy("path").agg(F.max("count").alias("count")), places).groupBy("name").agg(F.sum("count").alias("num_rows"))
    return places.select("name").join(sums, "name", "left").select("name", F.coalesce("num_rows", F.lit(0).cast("long")).alias("num_rows"))


def many_table_details(spark: SparkSession, tables: Sequence[str]) -> DataFrame:
    """name (as given), table_catalog, table_schema, table_name, provider, location and statistics text of many tables.

    One catalog command per database.
    """
    current, wanted = spark.catalog.currentDatabase(), {}
    for table in tables:
        *database, name = table.replace("`", "").split(".")
        wanted.setdefault(".".join(database) or current, {})[name] = table
    catalog, parts = spark.catalog.currentCatalog(), []
    for database, names in wanted.items():
        given = spark.createDataFrame(list(names.items()), "tableName string, name string")

        def of(key: str) -> Column:
            return F.nullif(F.regexp_extract("information", rf"(?m)^{key}: (.*)$", 1), F.lit(""))

        rows = spark.sql(f"show table extended in {database} like '{'|'.join(names)}'").filter(~F.col("isTemporary"))
        parts.append(
            given.join(rows, "tableName").select(
                "name", F.coalesce(of("Catalog"), F.lit(catalog)).alias("table_catalog"), F.col("namespace").alias("table_schema"),
                F.col("tableName").alias("table_name"), of("Provider").alias("provider"), of("Location").alias("location"), of("Statistics").alias("statistics"),
            )
        )
    return reduce(DataFrame.unionByName, parts)
