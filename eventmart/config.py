"""Configuration tables: project properties and the rule catalogue.

They are small by nature (a few rows per entity); only their matching rows
ever come to the driver.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventmart.schemas import ENTITIES, bronze_schema, ddl, silver_schema
from eventmart.sources.landing import landing_path
from eventmart.sources.schema_store import remembered_schema

PROPERTIES_SCHEMA = (
    "env string, entity string, quality string, field_key string, field_value string, "
    "load_timestamp timestamp, is_active boolean"
)
RULES_SCHEMA = (
    "rule_id string, entity string, field_name string, rule_expression string, action_type string, "
    "is_active boolean, effective_from date, effective_to date, reprocess_scope string"
)

# Personal columns, pipeline names and rules per entity.
PII_COLUMNS = {"events": "user_id,ip_address,user_agent", "users": "user_id, username, email, full_name"}
PIPELINES = {"ads": "batch", "events": "streaming", "users": "batch"}
NOT_NULL_RULES = {
    "users": {"drop": ["user_id", "updated_at", "is_active"], "warn": ["tier", "signup_date", "country"]},
    "events": {"drop": ["event_id", "updated_at", "timestamp", "user_id"], "warn": ["event_type", "country"]},
    "ads": {
        "drop": ["ad_id", "updated_at", "start_date", "is_active"],
        "warn": ["target_country", "target_tier"],
    },
}
# is_active is text in silver; a malformed value must count as not active.
OTHER_RULES = [("ads", "end_date", "try_cast(is_active as boolean) = true OR end_date IS NOT NULL", "drop")]


def properties(spark: SparkSession, rows: list[tuple[str, str, str, str, str]]) -> DataFrame:
    """Property rows (env, entity, quality, key, value) with load time and active flag set."""
    given = spark.createDataFrame(rows, "env string, entity string, quality string, field_key string, field_value string")
    return given.withColumns({"load_timestamp": F.current_timestamp(), "is_active": F.lit(True)})


def default_properties(spark: SparkSession, landing_root: str, schema_root: str, env: str = "dev") -> DataFrame:
    """Landing paths, schema locations, schemas, pipeline names and personal columns of all entities."""
    rows = []
    for entity in ENTITIES:
        rows += [
            (env, entity, "bronze", "landing_path", landing_path(landing_root, entity)),
            (env, entity, "bronze", "schema_location_path", f"{schema_root.rstrip('/')}/{entity}"),
            (env, entity, "bronze", "schema", ddl(bronze_schema(entity))),
            (env, entity, "silver", "schema", ddl(silver_schema(entity))),
            (env, entity, "bronze", "pipeline", PIPELINES[entity]),
        ]
    rows += [(env, entity, "bronze", "pii_columns", text) for entity, text in PII_COLUMNS.items()]
    return properties(spark, rows)


def default_rules(spark: SparkSession, effective_from: dt.date | None = None) -> DataFrame:
    """The rule catalogue, in effect from the given day (default today)."""
    rows = [
        (entity, field, f"{field} IS NOT NULL", action)
        for entity, actions in NOT_NULL_RULES.items()
        for action, fields in actions.items()
        for field in fields
    ] + OTHER_RULES
    given = spark.createDataFrame(rows, "entity string, field_name string, rule_expression string, action_type string")
    day = F.current_date() if effective_from is None else F.lit(effective_from)
    return given.select(
        F.concat_ws("-", "entity", "field_name", "action_type").alias("rule_id"),
        *given.columns,
        F.lit(True).alias("is_active"),
        day.alias("effective_from"),
        F.lit(None).cast("date").alias("effective_to"),
        F.lit("N").alias("reprocess_scope"),
    )


def create_config_tables(spark: SparkSession, properties_table: str, rules_table: str, fmt: str = "parquet") -> None:
    """Creates both tables, empty, with their types and comments."""
    spark.sql(
        f"create table if not exists {properties_table} ({PROPERTIES_SCHEMA}) using {fmt} "
        "comment 'paths, schemas and other settings per entity'"
    )
    spark.sql(
        f"create table if not exists {rules_table} ({RULES_SCHEMA}) using {fmt} "
        "comment 'data-quality rules per entity'"
    )


def property_value(config: DataFrame, entity: str, key: str, quality: str = "bronze", env: str = "dev") -> str:
    rows = (
        config.filter(
            (F.col("env") == env)
            & (F.col("entity") == entity)
            & (F.col("quality") == quality)
            & (F.col("field_key") == key)
            & F.col("is_active")
        )
        .select("field_value")
        .take(2)
    )
    if len(rows) != 1:
        raise LookupError(f"{len(rows) or 'no'} values of {key} for {entity} ({quality}, {env})")
    return rows[0][0]


def schema_for(config: DataFrame, entity: str, quality: str, env: str = "dev") -> StructType:
    return StructType.fromDDL(property_value(config, entity, "schema", quality, env))


def landing_schema(config: DataFrame, entity: str, fmt: str = "csv", new_files: str | None = None, env: str = "dev") -> StructType:
    """The remembered schema of an entity's landing files, kept at its configured place; ``new_files`` widen it."""
    where = {k: property_value(config, entity, k, env=env) for k in ("landing_path", "schema_location_path")}
    path = new_files or where["landing_path"]
    return remembered_schema(config.sparkSession, path, where["schema_location_path"], fmt, new_files is not None)


def pii_columns(config: DataFrame, entity: str, env: str = "dev") -> list[str]:
    return [c.strip() for c in property_value(config, entity, "pii_columns", "bronze", env).split(",")]


def pipeline_names(config: DataFrame, env: str) -> DataFrame:
    """Distinct names of the active pipelines of an environment, as column ``name``."""
    return (
        config.filter(
            (F.col("env") == env)
            & (F.col("quality") == "bronze")
            & (F.col("field_key") == "pipeline")
            & ~F.col("field_value").like("New%")
            & F.col("is_active")
        )
        .select(F.col("field_value").alias("name"))
        .distinct()
    )
