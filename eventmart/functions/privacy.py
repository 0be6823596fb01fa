"""Masking of values and visibility of rows by the caller's roles.

Both are plain SQL expressions, so the same text serves DataFrames, SQL
functions and views, and Spark folds it once the roles are known.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Roles, countries and masks.
ADMIN = "admin"
COUNTRY_ANALYSTS = {"UK": "analyst_UK", "US": "analyst_US"}
TIER_ANALYSTS = [
    "analyst_all_tiers",
    "analyst_free_tiers",
    "analyst_premium_tiers",
    "analyst_business_tiers",
]
EMAIL_MASK = "*****@****.***"
TEXT_MASK = "*****"
TAIL_MASK = "***"


_ROLE = re.compile(r"[A-Za-z0-9_-]+")


def _roles(roles: Sequence[str]) -> str:
    """The roles as SQL text. Names that could end a literal are refused, not escaped."""
    for role in roles:
        if not _ROLE.fullmatch(role):
            raise ValueError(f"not a role name: {role!r}")
    quoted = ",".join(f"'{r}'" for r in roles)
    return f"cast(array({quoted}) as array<string>)"


def _any_role(roles: str, names: Sequence[str]) -> str:
    wanted = ",".join(f"'{n}'" for n in names)
    return f"arrays_overlap({roles}, array({wanted}))"


def mask_sql(value: str, kind: str, roles: str) -> str:
    """SQL text: clear for admins, first letter (and mail host) for analysts, else hidden."""
    host = f"if({kind} = 'email' and locate('@', {value}) > 0, substring({value}, locate('@', {value})), '')"
    return (
        f"case when {_any_role(roles, [ADMIN])} then {value} "
        f"when {_any_role(roles, list(COUNTRY_ANALYSTS.values()))} "
        f"then concat(left({value}, 1), '{TAIL_MASK}', {host}) "
        f"when {kind} = 'email' then '{EMAIL_MASK}' else '{TEXT_MASK}' end"
    )


def visible_sql(country: str, roles: str) -> str:
    """SQL text: admins see all rows; a country's analyst with a tier role sees that country."""
    own = " or ".join(
        f"({_any_role(roles, [role])} and coalesce({country} = '{name}', false))"
        for name, role in COUNTRY_ANALYSTS.items()
    )
    return f"({_any_role(roles, [ADMIN])} or (({own}) and {_any_role(roles, TIER_ANALYSTS)}))"


def mask(column: str, kind: str = "text", roles: Sequence[str] = ()) -> Column:
    """The column masked for a caller with these roles; ``kind`` is "email" or "text"."""
    return F.expr(mask_sql(f"cast(`{column}` as string)", f"'{kind}'", _roles(roles)))


def row_visible(country: str, roles: Sequence[str] = ()) -> Column:
    """Whether a caller with these roles may see the row of that country."""
    return F.expr(visible_sql(f"`{country}`", _roles(roles)))


def register_functions(spark: SparkSession) -> None:
    """Makes ``data_mask(value, kind, roles)`` and ``row_filter(country, roles)`` usable in SQL."""
    spark.sql(
        "create or replace temporary function data_mask(value string, kind string, roles array<string>) "
        f"returns string return {mask_sql('value', 'kind', 'roles')}"
    )
    spark.sql(
        "create or replace temporary function row_filter(country string, roles array<string>) "
        f"returns boolean return {visible_sql('country', 'roles')}"
    )
