"""Readers and writers for landing files: JSON lines and CSV with rescue and lineage."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from eventmart.operators.joins import broadcast_if_small
from eventmart.session import ensure_checkpoint_dir

RESCUED = "_rescued_data"
# Column of a line whose number of fields is not that of its header, while it is read.
_BAD_LINE = "__bad_line"
# Different header lines one read may meet.
MOST_HEADERS = 200
# Landing folders below a landing root.
LANDING_GLOBS = {"events": "events/batch_*/*.json", "users": "users/*.csv", "ads": "ads/*.csv"}


def landing_path(root: str, entity: str) -> str:
    return f"{root.rstrip('/')}/{LANDING_GLOBS[entity]}"


def _lineage() -> list:
    return [
        F.col("_metadata.file_name").alias("source_file_name"),
        F.col("_metadata.file_path").alias("source_file_path"),
    ]


def rescue(df: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """Parses JSON text into the schema's columns; what does not fit goes to ``_rescued_data``.

    Unknown keys, and values that cannot be cast to their column's type, are kept
    there as a JSON object. Text that is no JSON object is kept there whole. Each
    line is parsed once, to a map.
    """
    known = [f.name for f in schema]
    raw = {f.name: F.try_element_at("__fields", F.lit(f.name)) for f in schema}
    typed = {
        f.name: raw[f.name] if isinstance(f.dataType, StringType) else raw[f.name].try_cast(f.dataType)
        for f in schema
    }
    misfits = [
        F.when(raw[n].isNotNull() & typed[n].isNull(), F.lit(n))
        for n, f in zip(known, schema)
        if not isinstance(f.dataType, StringType)
    ]
    unknown = F.array_except(F.map_keys("__fields"), F.array(*[F.lit(n) for n in known]))
    odd = F.concat(unknown, F.array_compact(F.array(*misfits))) if misfits else unknown
    kept = F.to_json(F.map_filter("__fields", lambda k, _: F.array_contains("__odd", k)))
    others = [f"`{c}`" for c in df.columns if c != value and c not in known]
    rescued = F.when(F.col("__fields").isNull(), F.col(value)).when(F.size("__odd") > 0, kept)
    record = F.struct(*[typed[n].alias(n) for n in known], rescued.alias(RESCUED))
    # As a generated row, the record is computed once: later filters on its
    # columns are not pushed below it, where they would parse the text again.
    return (
        df.filter(F.length(F.trim(value)) > 0)
        .withColumn("__fields", F.from_json(value, "map<string,string>"))
        .withColumn("__odd", odd)
        .select(*others, F.inline(F.array(record)))
        .select(*[f"`{n}`" for n in known], *others, RESCUED)
    )


def with_audit(df: DataFrame) -> DataFrame:
    """Adds the ingestion and update time as local wall-clock time."""
    now = F.current_timestamp().cast("timestamp_ntz")
    return df.withColumns({"ingestion_timestamp": now, "update_timestamp": now})


def _bronze_order(df: DataFrame, schema: StructType) -> DataFrame:
    return df.select(
        *[f"`{f.name}`" for f in schema],
        "source_file_name",
        "source_file_path",
        "ingestion_timestamp",
        "update_timestamp",
        RESCUED,
    )


def read_landing_json(
    spark: SparkSession, path: str, schema: StructType, streaming: bool = False, files_per_trigger: int | None = None
) -> DataFrame:
    """Bronze rows of JSON-lines files under a path or glob."""
    reader = spark.readStream if streaming else spark.read
    if streaming and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    lines = reader.format("text").load(path).select("value", *_lineage())
    return _bronze_order(with_audit(rescue(lines, schema)), schema)


def csv_lines(
    spark: SparkSession, path: str, streaming: bool = False, files_per_trigger: int | None = None
) -> DataFrame:
    """Lines of CSV files as they are, with their file and their place in it."""
    reader = spark.readStream if streaming else spark.read
    if streaming and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    start = F.col("_metadata.file_block_start").alias("__start")
    return reader.format("text").load(path).select("value", *_lineage(), start)


def file_headers(lines: DataFrame) -> DataFrame:
    """The header of each file: source_file_path and ``__header``, its first line that is not blank.

    Only the first block of a file is looked at; inside a task, lines come in
    the file's order.
    """
    first = lines.filter((F.col("__start") == 0) & (F.length(F.trim("value")) > 0))
    numbered = first.select("source_file_path", F.struct(F.monotonically_increasing_id().alias("at"), "value").alias("__line"))
    return numbered.groupBy("source_file_path").agg(F.min("__line")["value"].alias("__header"))


def _header_schema(header: str, schema: StructType) -> StructType:
    """Text fields in the order of a header line; a name of the schema in any case is that column, a repeated one is not."""
    known = {f.name.lower(): f.name for f in schema}
    names: list[str] = []
    for i, cell in enumerate(next(csv.reader([header]))):
        name = known.get(cell.strip().lower(), cell.strip() or f"column_{i + 1}")
        names.append(name if name not in names else f"{name}_{i + 1}")
    return StructType([StructField(n, StringType()) for n in [*names, _BAD_LINE]])


def csv_records(lines: DataFrame, schema: StructType) -> DataFrame:
    """Bronze rows of :func:`csv_lines`, every line read by the header of its own file.

    Columns may come in any order; one that a file lacks is null. Fields of
    unknown columns, and values that cannot be cast to their column's type, are
    kept in ``_rescued_data`` as a JSON object; a line with too few or too many
    fields is kept there whole. Lines equal to their file's header are headers.
    One pass over the first blocks finds the headers. Their distinct forms come
    to the driver, at most ``MOST_HEADERS``.
    """
    spark = lines.sparkSession
    ensure_checkpoint_dir(spark)
    headers = file_headers(lines).checkpoint()
    forms = [r[0] for r in headers.select("__header").distinct().take(MOST_HEADERS + 1)]
    if len(forms) > MOST_HEADERS:
        raise ValueError(f"more than {MOST_HEADERS} different headers; do the files have any?")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD_LINE}
    as_json = F.lit(None).cast("string")
    for form in sorted(forms):
        of_form = F.to_json(F.from_csv("value", _header_schema(form, schema).toDDL(), options))
        as_json = F.when(F.col("__header") == form, of_form).otherwise(as_json)
    rows = (
        lines.join(broadcast_if_small(headers), "source_file_path")
        .filter((F.col("value") != F.col("__header")) & (F.length(F.trim("value")) > 0))
        .select(as_json.alias("value"), "source_file_name", "source_file_path")
    )
    found = rescue(rows, StructType([*schema.fields, StructField(_BAD_LINE, StringType())]))
    return _bronze_order(with_audit(found.withColumn(RESCUED, F.coalesce(_BAD_LINE, RESCUED))), schema)


def read_landing_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Bronze rows of CSV files with a header each; see :func:`csv_records`."""
    return csv_records(csv_lines(spark, path), schema)


def infer_csv_schema(spark: SparkSession, path: str, share: float = 1.0) -> StructType:
    """One-off schema inference, to be stored and passed on. A smaller share of the lines may miss the values that decide a type."""
    return (
        spark.read.option("header", True).option("inferSchema", True).option("samplingRatio", share).csv(path).schema
    )


def landing_counts(spark: SparkSession, root: str, entities: dict[str, str] | None = None) -> DataFrame:
    """Files, bytes and records per entity under a landing root.

    ``entities`` maps an entity to its glob below the root. Records are
    non-empty lines; a CSV file's header line is not one.
    """

    def one(entity: str, glob: str) -> DataFrame:
        # A landing file never splits a record over lines, so lines are records.
        header = 1 if glob.endswith(".csv") else 0
        per_file = (
            spark.read.text(f"{root.rstrip('/')}/{glob}")
            .select("value", "_metadata.file_path", "_metadata.file_size")
            .filter(F.length("value") > 0)
            .groupBy("file_path", "file_size")
            .count()
        )
        return per_file.agg(
            F.count("*").alias("n_files"),
            F.coalesce(F.sum("file_size"), F.lit(0)).alias("n_bytes"),
            F.coalesce(F.sum(F.col("count") - header), F.lit(0)).alias("n_records"),
        ).select(F.lit(entity).alias("entity"), "n_files", "n_bytes", "n_records")

    parts = [one(e, g) for e, g in (entities or LANDING_GLOBS).items()]
    return reduce(DataFrame.unionByName, parts)


def export_files(df: DataFrame, path: str, fmt: str) -> None:
    """Appends JSON-lines or CSV (with header) files, one per task."""
    writer = df.write.mode("append")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "json":
        writer.json(path)
    else:
        raise ValueError("fmt is 'csv' or 'json'")
