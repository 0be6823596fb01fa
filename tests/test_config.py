from __future__ import annotations

import uuid

import pytest

from eventmart import config
from eventmart.schemas import bronze_schema, silver_schema
from eventmart.sources.catalog import append_table


def test_properties_round_trip(spark):
    props = config.default_properties(spark, "/land", "/schemas/")
    assert config.schema_for(props, "events", "bronze").simpleString() == bronze_schema("events").simpleString()
    assert config.schema_for(props, "ads", "silver").simpleString() == silver_schema("ads").simpleString()
    assert config.property_value(props, "events", "landing_path") == "/land/events/batch_*/*.json"
    assert config.property_value(props, "users", "schema_location_path") == "/schemas/users"
    assert config.pii_columns(props, "users") == ["user_id", "username", "email", "full_name"]
    assert sorted(r.name for r in config.pipeline_names(props, "dev").collect()) == ["batch", "streaming"]
    assert config.pipeline_names(props, "prod").count() == 0
    with pytest.raises(LookupError):
        config.property_value(props, "ads", "pii_columns")


def test_new_pipelines_and_decimals(spark):
    props = config.properties(
        spark,
        [
            ("dev", "x", "bronze", "pipeline", "New Pipeline 1"),
            ("dev", "x", "bronze", "pipeline", "x"),
            ("dev", "x", "silver", "schema", "a:decimal(10,2), b:string"),
        ],
    )
    assert [r.name for r in config.pipeline_names(props, "dev").collect()] == ["x"]
    assert config.schema_for(props, "x", "silver").simpleString() == "struct<a:decimal(10,2),b:string>"


def test_tables(spark):
    tag = uuid.uuid4().hex[:8]
    p, r = f"properties_{tag}", f"rules_{tag}"
    config.create_config_tables(spark, p, r)
    config.create_config_tables(spark, p, r)
    append_table(config.default_properties(spark, "/l", "/s"), p)
    append_table(config.default_rules(spark), r)
    assert spark.table(r).count() == 19
    assert spark.table(p).filter("is_active and load_timestamp is not null").count() == 17
