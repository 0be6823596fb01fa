"""Watermarked slices and recomputation of the keys they touch."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.operators.joins import any_of, null_safe_join
from eventmart.operators.merge import delete_where, merge_upsert

WATERMARK_SCHEMA = "entity_name string, watermark_value timestamp"
LATE = "30 minutes"


def watermark_value(watermarks: DataFrame | None, entity: str) -> dt.datetime | None:
    """The stored watermark of an entity, or None. Reads one row."""
    if watermarks is None:
        return None
    rows = watermarks.filter(F.col("entity_name") == entity).select("watermark_value").take(1)
    return rows[0][0] if rows else None


def incremental_slice(
    df: DataFrame, watermark: dt.datetime | None, ts_col: str = "updated_at", late: str = LATE
) -> DataFrame:
    """Rows newer than the watermark less the late buffer; everything without a watermark.

    The bound is a constant, so the filter reaches the Parquet scan.
    """
    if watermark is None:
        return df
    return df.filter(F.col(ts_col) > F.lit(watermark) - F.expr(f"interval {late}"))


def touched_days(rows: DataFrame, ts_col: str = "timestamp") -> list[dt.date | None]:
    """The local days of ``rows``, in order; None for rows without a time. One value per calendar day at most."""
    days = [r[0] for r in rows.select(F.to_date(ts_col)).distinct().collect()]
    return sorted((d for d in days if d is not None)) + [None] * (None in days)


def _ranges(days: Sequence[dt.date], most: int) -> list[tuple[dt.date, dt.date]]:
    """Runs of days as half-open ranges; beyond ``most`` of them the nearest ones are joined."""
    day, runs = dt.timedelta(days=1), []
    for d in days:
        if runs and runs[-1][1] == d:
            runs[-1] = (runs[-1][0], d + day)
        else:
            runs.append((d, d + day))
    while len(runs) > most:
        gaps = [b[0] - a[1] for a, b in zip(runs, runs[1:])]
        i = gaps.index(min(gaps))
        runs[i : i + 2] = [(runs[i][0], runs[i + 1][1])]
    return runs


def in_days(df: DataFrame, days: Sequence[dt.date | None], ts_col: str = "timestamp", most_ranges: int = 64) -> DataFrame:
    """Rows of the given local days (None: rows without a time).

    Days that follow each other are one range of constants, which reaches the
    Parquet scan; so a late record costs its own day, not all days since.
    """
    known = [d for d in days if d is not None]
    spans = [(F.col(ts_col) >= F.lit(a).cast("timestamp")) & (F.col(ts_col) < F.lit(b).cast("timestamp")) for a, b in _ranges(known, most_ranges)]
    if None in days:
        spans.append(F.col(ts_col).isNull())
    if not spans:
        return df.filter(F.lit(False))
    found = df.filter(any_of(spans))
    if len(_ranges(known, len(known) or 1)) > most_ranges:  # the joined ranges hold other days, too
        exact = F.to_date(ts_col).isin(known)
        found = found.filter(exact | F.col(ts_col).isNull() if None in days else exact)
    return found


def affected_keys(slices: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Distinct keys over one or more slices."""
    first, *rest = [s.select(*keys) for s in slices]
    for other in rest:
        first = first.unionByName(other)
    return first.distinct()


def of_keys(source: DataFrame, affected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of ``source`` that belong to the affected keys; null is a key too.

    Unless the caller has marked ``affected`` as small, both sides are shuffled
    and AQE splits the rows of a hot key.
    """
    return null_safe_join(source, affected, keys, "left_semi")


def advance_watermark(watermarks: DataFrame, entity: str, value: dt.datetime) -> DataFrame:
    """The watermark table with the entity's value set."""
    row = watermarks.sparkSession.createDataFrame([(entity, value)], WATERMARK_SCHEMA)
    return merge_upsert(watermarks, row, ["entity_name"])


def reset_watermark(watermarks: DataFrame, entity: str) -> DataFrame:
    """The watermark table without the entity."""
    return delete_where(watermarks, F.col("entity_name") == entity)


def empty_watermarks(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], WATERMARK_SCHEMA)
