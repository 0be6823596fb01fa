"""Masked and filtered views of personal data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from eventmart.functions.privacy import _roles, mask, mask_sql, row_visible, visible_sql


def _kind(column: str) -> str:
    return "email" if column == "email" else "text"


def privacy_view(
    df: DataFrame, pii: Sequence[str], roles: Sequence[str], country_col: str = "country"
) -> DataFrame:
    """The rows the caller may see, with the personal columns masked.

    The filter tests the stored country, also when that column is masked.
    """
    masked = [mask(c, _kind(c), roles).alias(c) if c in pii else df[f"`{c}`"] for c in df.columns]
    return df.filter(row_visible(country_col, roles)).select(*masked)


def create_privacy_view(
    spark: SparkSession,
    table: str,
    view: str,
    pii: Sequence[str],
    roles: Sequence[str],
    country_col: str = "country",
) -> None:
    """The same as a lasting catalog view, one per set of roles."""
    held = _roles(roles)
    items = [
        f"{mask_sql(f'cast(`{c}` as string)', repr(_kind(c)), held)} as `{c}`" if c in pii else f"`{c}`"
        for c in spark.table(table).columns
    ]
    where = visible_sql(f"`{country_col}`", held)
    spark.sql(f"create or replace view {view} as select {', '.join(items)} from {table} where {where}")
