"""Column names and types of the bronze and silver entity tables."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# Silver columns per entity, in table order.
EVENTS_SILVER = (
    "event_id string, user_id string, session_id string, event_type string, "
    "content_id string, content_type string, ad_id string, platform string, "
    "device_type string, country string, city string, user_agent string, "
    "ip_address string, timestamp timestamp, duration_ms int, scroll_depth double, "
    "updated_at timestamp, batch_id string"
)
USERS_SILVER = (
    "user_id string, username string, email string, full_name string, age string, "
    "gender string, country string, city string, platform string, tier string, "
    "followers string, following string, posts_count string, is_active string, "
    "signup_date date, updated_at timestamp"
)
ADS_SILVER = (
    "ad_id string, campaign_id string, ad_name string, ad_type string, "
    "target_country string, target_tier string, is_active string, start_date date, "
    "end_date date, cpc double, cpm double, budget_usd double, spend_usd double, "
    "updated_at timestamp"
)
AUDIT = (
    "source_file_name string, source_file_path string, "
    "ingestion_timestamp timestamp_ntz, update_timestamp timestamp_ntz, _rescued_data string"
)

ENTITIES = {"events": EVENTS_SILVER, "users": USERS_SILVER, "ads": ADS_SILVER}
AUDIT_COLUMNS = [part.split()[0] for part in AUDIT.split(", ")]


def source_schema(entity: str) -> StructType:
    """Landing columns of an entity: the silver names, all as strings."""
    silver = StructType.fromDDL(ENTITIES[entity])
    return StructType([StructField(f.name, StringType()) for f in silver])


def bronze_schema(entity: str) -> StructType:
    return StructType(source_schema(entity).fields + StructType.fromDDL(AUDIT).fields)


def silver_schema(entity: str) -> StructType:
    return StructType(StructType.fromDDL(ENTITIES[entity]).fields + StructType.fromDDL(AUDIT).fields)


def ddl(schema: StructType) -> str:
    """Compact ``name:type`` text, the form kept in the configuration table."""
    return ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in schema)
