"""Registered queries on landing files and streams, with their SQL twins.

Landing files are written from the given tables to the session's shared folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from eventmart.catalogue.changes import EVENT_CHANGES_SQL, EVENT_HISTORY_SQL
from eventmart.catalogue.tables import EVENTS_SQL, events, table, with_sql
from eventmart.operators.history import BUCKET
from eventmart.operators.quality import accepted, rejected, Rule
from eventmart.schemas import AUDIT
from eventmart.session import shared_folder
from eventmart.sources.catalog import read_table
from eventmart.sources.landing import (
    export_files,
    landing_counts,
    read_landing_csv,
    read_landing_json,
    rescue,
)
from eventmart.sources.schema_store import remembered_schema
from eventmart.streaming.history import run_history
from eventmart.streaming.ingest import clean_folder, ingest_landing


def _text_schema(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


EVENT_FIELDS = ["event_id", "user_id", "event_type", "country", "timestamp"]
RAW_EVENTS = _text_schema(*EVENT_FIELDS)


def _lines(spark, sf):
    """Events as landing text: good records, records with an unknown or misfit field, and non-JSON."""
    e = table(spark, sf, "events")
    def record(user, *rest):
        return F.concat(
            F.lit('{"event_id":"'), "event_id", F.lit(f'","user_id":"{user}'), "user_id",
            F.lit('","kind":"'), "event_type", F.lit('"'), *rest, F.lit("}"),
        )

    good, misfit, extra = record(""), record("u"), record("", F.lit(',"note":'), "props")
    kind = F.col("event_type")
    return e.select(
        F.when(kind == "error", F.concat(F.lit("not json "), "props"))
        .when(kind == "signup", extra)
        .when(kind == "purchase", misfit)
        .otherwise(good)
        .alias("value")
    )


def _rescued(spark, sf):
    return rescue(_lines(spark, sf), StructType.fromDDL("event_id string, user_id bigint, kind string"))


def _export_events(spark, sf, name):
    """Landing JSON of all events in two batch folders."""
    root = shared_folder(spark, name)
    rows = events(spark, sf).select(*[F.col(c).cast("string").alias(c) for c in EVENT_FIELDS])
    clicks = F.col("event_type").isin("like", "share", "comment")
    export_files(rows.filter(clicks), f"{root}/events/batch_001", "json")
    export_files(rows.filter(~clicks), f"{root}/events/batch_002", "json")
    return root


def _export_users(spark, sf, name):
    root = shared_folder(spark, name)
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("username"), F.col("c_mktsegment").alias("tier")
    )
    export_files(rows, f"{root}/users", "csv")
    return root


USERS = _text_schema("user_id", "username", "tier")


def _export_changing_users(spark, sf, name):
    """Users in files of three headers: as agreed; reordered without a column; with a new column and ids that do not fit."""
    root = shared_folder(spark, name)
    users = table(spark, sf, "customer")
    key, named, tier = F.col("c_custkey"), F.col("c_name").alias("username"), F.col("c_mktsegment").alias("tier")
    export_files(users.filter(key % 3 == 0).select(key.alias("user_id"), named, tier), f"{root}/users", "csv")
    export_files(users.filter(key % 3 == 1).select(tier, key.alias("User_Id")), f"{root}/users", "csv")
    odd = F.concat(F.lit("u"), key).alias("user_id")
    export_files(users.filter(key % 3 == 2).select(F.concat(F.lit("n, "), key).alias("note"), odd, named, tier), f"{root}/users", "csv")
    return root


TYPED_USERS = StructType([StructField("user_id", LongType()), *_text_schema("username", "tier").fields])
CHANGING_USERS_SQL = """
select case when c_custkey % 3 <> 2 then c_custkey end as user_id, case when c_custkey % 3 <> 1 then c_name end as username,
  c_mktsegment as tier,
  case when c_custkey % 3 = 2 then concat('{"note":"n, ', c_custkey, '","user_id":"u', c_custkey, '"}') end as _rescued_data
from customer"""


def _stream_changing_users(spark, sf):
    root = _export_changing_users(spark, sf, "stream")
    bronze = f"{root}/bronze"
    ingest_landing(
        spark, f"{root}/users/*.csv", "csv", TYPED_USERS, bronze, f"{root}/cp", files_per_trigger=2
    ).awaitTermination()
    return spark.read.parquet(bronze).select("user_id", "username", "tier", "_rescued_data")


def _remembered(spark, sf):
    """The users read by a schema that was inferred from the first files and widened by the rest."""
    root = shared_folder(spark, "remembered")
    users = table(spark, sf, "customer")
    columns = [F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("tier")]
    first, rest = f"{root}/users/first", f"{root}/users/rest"
    export_files(users.filter("c_custkey % 2 = 0").select(*columns), first, "csv")
    remembered_schema(spark, first, f"{root}/schema")
    export_files(users.filter("c_custkey % 2 = 1").select(*columns, (F.col("c_acctbal") * 1).alias("balance")), rest, "csv")
    schema = remembered_schema(spark, rest, f"{root}/schema", new_files=True)
    return read_landing_csv(spark, f"{root}/users/*", schema).select("user_id", "tier", "balance", "_rescued_data")


def _batch_events(spark, sf):
    root = _export_events(spark, sf, "landing")
    return read_landing_json(spark, f"{root}/events/batch_*/*.json", RAW_EVENTS)


def _counts(spark, sf):
    root = _export_events(spark, sf, "landing")
    users = _export_users(spark, sf, "landing")
    counts = landing_counts(spark, root, {"events": "events/batch_*/*.json"})
    return counts.unionByName(landing_counts(spark, users, {"users": "users/*.csv"})).select("entity", "n_records")


def _stream_events(spark, sf):
    """Landing JSON to bronze to silver, both as streams; returns the silver rows."""
    root = _export_events(spark, sf, "stream")
    bronze, silver = f"{root}/bronze", f"{root}/silver"
    ingest_landing(
        spark, f"{root}/events/batch_*/*.json", "json", RAW_EVENTS, bronze, f"{root}/cp_bronze", files_per_trigger=4
    ).awaitTermination()
    bronze_type = StructType(RAW_EVENTS.fields + StructType.fromDDL(AUDIT).fields)
    silver_type = StructType.fromDDL("event_id bigint, user_id bigint, event_type string, country string, timestamp timestamp")
    rules = [
        Rule("events-event_id-drop", "event_id", "event_id IS NOT NULL", "drop"),
        Rule("events-country-drop", "country", "country IS NOT NULL", "drop"),
        Rule("events-event_type-warn", "event_type", "event_type <> 'like'", "warn"),
    ]
    clean_folder(
        spark, bronze, bronze_type, silver, silver_type, rules, f"{root}/cp_silver", observation_name="rules"
    ).awaitTermination()
    return spark.read.schema(silver_type).parquet(silver)


def _stream_users(spark, sf):
    root = _export_users(spark, sf, "stream")
    bronze = f"{root}/bronze"
    ingest_landing(spark, f"{root}/users/*.csv", "csv", USERS, bronze, f"{root}/cp").awaitTermination()
    return accepted(spark.read.parquet(bronze)).select("user_id", "username", "tier")


def _stream_history(spark, sf):
    """Staged changes in several files, streamed into a history table."""
    root = shared_folder(spark, "history")
    staged = f"{root}/staged"
    changes = table(spark, sf, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id", "event_type")
    for part in (F.col("event_type").isin("view", "error"), ~F.col("event_type").isin("view", "error")):
        changes.filter(part).write.mode("append").parquet(staged)
    name = f"history_{uuid.uuid4().hex}"
    run_history(
        spark, staged, changes.schema, name, f"{root}/cp", ["user_id"], ["ts", "event_id"], ["event_type"],
        files_per_trigger=1, buckets=4, location=f"{root}/history",
    ).awaitTermination()
    return read_table(spark, name).drop(BUCKET)


QUERIES = {
    "rescue_csv": (
        lambda spark, sf: read_landing_csv(
            spark, f"{_export_changing_users(spark, sf, 'landing')}/users/*.csv", TYPED_USERS
        ).select("user_id", "username", "tier", "_rescued_data"),
        CHANGING_USERS_SQL,
    ),
    "stream_rescue_csv": (lambda spark, sf: _stream_changing_users(spark, sf), CHANGING_USERS_SQL),
    "remembered_schema": (
        lambda spark, sf: _remembered(spark, sf),
        """
select cast(c_custkey as int) as user_id, c_mktsegment as tier, case when c_custkey % 2 = 1 then c_acctbal end as balance,
  cast(null as varchar) as _rescued_data
from customer""",
    ),
    "rescue_json": (
        lambda spark, sf: _rescued(spark, sf),
        """
select case when event_type <> 'error' then cast(event_id as varchar) end as event_id,
  case when event_type not in ('error', 'purchase') then user_id end as user_id,
  case when event_type <> 'error' then event_type end as kind,
  case event_type when 'error' then concat('not json ', props)
    when 'purchase' then concat('{"user_id":"u', user_id, '"}')
    when 'signup' then concat('{"note":', to_json(replace(props, ' ', '')), '}') end as _rescued_data
from events""",
    ),
    "rescued_rows_rejected": (
        lambda spark, sf: rejected(_rescued(spark, sf)).groupBy("kind").agg(F.count("*").alias("n")),
        """
select case when event_type <> 'error' then event_type end as kind, count(*) as n
from events where event_type in ('error', 'purchase', 'signup') group by 1""",
    ),
    "landing_json": (
        lambda spark, sf: _batch_events(spark, sf).select(*EVENT_FIELDS, "_rescued_data"),
        with_sql(
            EVENTS_SQL,
            query="""
select cast(event_id as varchar) as event_id, cast(user_id as varchar) as user_id, event_type, country,
  rtrim(rtrim(strftime("timestamp", '%Y-%m-%d %H:%M:%S.%f'), '0'), '.') as timestamp, cast(null as varchar) as _rescued_data
from ev""",
        ),
    ),
    "landing_csv": (
        lambda spark, sf: read_landing_csv(
            spark, f"{_export_users(spark, sf, 'landing')}/users/*.csv", USERS
        ).select("user_id", "username", "tier", "_rescued_data"),
        """
select cast(c_custkey as varchar) as user_id, c_name as username, c_mktsegment as tier,
  cast(null as varchar) as _rescued_data from customer""",
    ),
    "landing_counts": (
        lambda spark, sf: _counts(spark, sf),
        """
select 'events' as entity, count(*) as n_records from events
union all select 'users', count(*) from customer""",
    ),
    "stream_ingest": (
        lambda spark, sf: _stream_events(spark, sf),
        with_sql(
            EVENTS_SQL,
            query="""select event_id, user_id, event_type, country, "timestamp" from ev where country is not null""",
        ),
    ),
    "stream_ingest_csv": (
        lambda spark, sf: _stream_users(spark, sf),
        "select cast(c_custkey as varchar) as user_id, c_name as username, c_mktsegment as tier from customer",
    ),
    "stream_scd2": (
        lambda spark, sf: _stream_history(spark, sf),
        with_sql(EVENT_CHANGES_SQL, query=EVENT_HISTORY_SQL),
    ),
}
