"""Inferred schemas, kept in versions at a place of their own and widened as files change.

A version is a folder ``version=n`` with one line, the schema as JSON. A new one
is written only when a file does not fit the last; versions are never changed.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

# Each whole number type fits in those after it.
_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]


def widest(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that values of both fit in; text if there is no other."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widest(a.elementType, b.elementType))
    if a in _WHOLE and b in _WHOLE:
        return _WHOLE[max(_WHOLE.index(a), _WHOLE.index(b))]
    if {type(a), type(b)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return _widest_number(a, b)
    return T.StringType()


def _widest_number(a: T.DataType, b: T.DataType) -> T.DataType:
    def digits(t: T.DataType) -> tuple[int, int] | None:
        """Digits before and after the point, if the type has a fixed number of them."""
        if isinstance(t, T.DecimalType):
            return t.precision - t.scale, t.scale
        return (19 if isinstance(t, T.LongType) else 10, 0) if t in _WHOLE else None

    x, y = digits(a), digits(b)
    if x and y and max(x[0], y[0]) + max(x[1], y[1]) <= 38:
        before, after = max(x[0], y[0]), max(x[1], y[1])
        return T.DecimalType(before + after, after)
    # a fraction holds whole numbers of up to 15 digits
    return T.StringType() if T.LongType() in (a, b) else T.DoubleType()


def merged(old: T.StructType, new: T.StructType) -> T.StructType:
    """The columns of both, by name in any case, the old ones first; every type is the widest of the two."""
    fields = {f.name.lower(): f for f in old}
    for f in new:
        was = fields.get(f.name.lower())
        fields[f.name.lower()] = T.StructField(was.name, widest(was.dataType, f.dataType)) if was else T.StructField(f.name, f.dataType)
    return T.StructType([T.StructField(f.name, f.dataType) for f in fields.values()])


def versions(spark: SparkSession, location: str) -> DataFrame:
    """version and value (JSON) of all kept schemas; empty if there is none."""
    try:
        return spark.read.schema("value string, version int").text(location)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "value string, version int")


def last_schema(spark: SparkSession, location: str) -> tuple[int, T.StructType] | None:
    """Number and schema of the newest version, or None. Reads one small folder."""
    row = versions(spark, location).agg(F.max(F.struct("version", "value"))).first()[0]
    return row and (row["version"], T.StructType.fromJson(json.loads(row["value"])))


def keep_schema(spark: SparkSession, location: str, schema: T.StructType) -> T.StructType:
    """Merges a schema into the newest version; writes a new one only if that changed. Gives the schema now in effect.

    Of two writers of one version the second fails and may try again.
    """
    last = last_schema(spark, location)
    number, now = (last[0] + 1, merged(last[1], schema)) if last else (0, merged(T.StructType(), schema))
    if not last or now != last[1]:
        spark.createDataFrame([(now.json(),)], "value string").coalesce(1).write.mode("errorifexists").text(f"{location}/version={number}")
    return now


def remembered_schema(spark: SparkSession, path: str, location: str, fmt: str = "csv", new_files: bool = False) -> T.StructType:
    """The schema of landing files: the kept one, or if there is none (or with ``new_files``) inferred from all lines and kept.

    Give ``new_files`` and the path of the files just arrived to widen the kept
    schema by them; without it, files are not read once a schema is kept.
    """
    last = last_schema(spark, location)
    if last and not new_files:
        return last[1]
    reader = spark.read.option("inferSchema", True)
    found = {"csv": reader.option("header", True).csv, "json": reader.json}[fmt](path).schema
    return keep_schema(spark, location, found)
