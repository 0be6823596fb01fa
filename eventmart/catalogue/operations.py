"""Registered queries on catalog tables, configuration and rule actions, with their SQL twins.

Tables made here have names of their own; their rows come from the given tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Observation
from pyspark.sql import functions as F

from eventmart import config
from eventmart.catalogue.checks import ANALYST, FEED_SCHEMA, FEED_SQL, PEOPLE_SQL, RULE_DAY, _feed, _people, _rules, _typed
from eventmart.catalogue.changes import HOURLY_SQL, WATERMARK
from eventmart.catalogue.ingestion import _batch_events
from eventmart.catalogue.marts import QUERIES as MART_QUERIES
from eventmart.catalogue.tables import EVENTS_SQL, events, table, with_sql
from eventmart.operators.project import typed_select
from eventmart.operators.quality import Rule, expect_fail, expect_warn
from eventmart.plans import runner
from eventmart.plans.monitors import event_log_tables, table_growth
from eventmart.plans.privacy_views import privacy_view
from eventmart.sources import catalog


def _name(kind: str) -> str:
    return f"{kind}_{uuid.uuid4().hex}"


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def _replaced(spark, sf):
    """A table replaced twice by rows computed from itself."""
    name = _name("orders")
    catalog.replace_table(_orders(spark, sf), name)
    for status in ("F", "O"):
        catalog.replace_table(catalog.read_table(spark, name).filter(F.col("o_orderstatus") != status), name)
    return catalog.read_table(spark, name)


def _appended(spark, sf):
    """Rows inserted by column name, in two orders of the columns."""
    name = _name("orders")
    rows = _orders(spark, sf)
    catalog.append_table(rows.filter("o_orderkey % 2 = 0"), name)
    catalog.append_table(rows.filter("o_orderkey % 2 = 1").select(*reversed(rows.columns)), name)
    return catalog.read_table(spark, name)


def _deleted(spark, sf):
    """Orders by status without some customers' ones, taken out partition by partition."""
    name = _name("orders")
    catalog.replace_table(_orders(spark, sf), name, ["o_orderstatus"])
    catalog.delete_rows(spark, name, (F.col("o_orderstatus") == "P") & (F.col("o_custkey") % 2 == 0))
    gone = table(spark, sf, "customer").filter("c_acctbal < 0")
    runner.erase_from_tables(spark, [(name, "o_custkey")], gone, "c_custkey")
    return catalog.read_table(spark, name)


def _run_twice(spark, sf, mart, refresh="incremental"):
    """A mart's table after a run up to the watermark and one over the later events."""
    silver, target, marks = _name("silver"), _name("mart"), _name("marks")
    every = events(spark, sf)
    for part in (every.filter(F.col("updated_at") <= F.lit(WATERMARK)), every.filter(F.col("updated_at") > F.lit(WATERMARK))):
        catalog.append_table(part, silver)
        runner.run_mart(spark, "mart", mart, [silver], target, marks, refresh=refresh, buckets=4)
    return runner.read_mart(spark, target)


def _pipelines_of(spark, sf):
    """Customers as rows of the property table: the segment is the pipeline's name."""
    fresh = F.col("c_custkey") % 5 == 0
    return table(spark, sf, "customer").select(
        F.when(F.col("c_nationkey") % 2 == 0, "dev").otherwise("prod").alias("env"),
        F.lit("users").alias("entity"),
        F.when(F.col("c_custkey") % 7 == 0, "silver").otherwise("bronze").alias("quality"),
        F.when(F.col("c_custkey") % 3 == 0, "pipeline").otherwise("landing_path").alias("field_key"),
        F.when(fresh, F.concat(F.lit("New "), "c_mktsegment")).otherwise(F.col("c_mktsegment")).alias("field_value"),
        F.current_timestamp().alias("load_timestamp"),
        (F.col("c_acctbal") > 9000).alias("is_active"),
    )


def _configured(spark):
    """Stored property and rule tables with the feed's schema and personal columns."""
    props, rules = _name("properties"), _name("rules")
    config.create_config_tables(spark, props, rules)
    given = [("dev", "users", "silver", "schema", FEED_SCHEMA), ("dev", "users", "bronze", "pii_columns", "user_id, email ,full_name")]
    catalog.append_table(config.properties(spark, given), props)
    catalog.append_table(config.default_rules(spark, RULE_DAY), rules)
    return catalog.read_table(spark, props)


def _private(spark, sf):
    """People by a view over a view, masked in the columns that the configuration names."""
    people, name = _name("people"), _name("people_table")
    _people(spark, sf).write.saveAsTable(name)
    spark.sql(f"create view {people} as select * from {name}")
    spark.table(people).createOrReplaceTempView(f"{people}_now")
    return privacy_view(spark.table(f"{people}_now"), config.pii_columns(_configured(spark), "users"), ANALYST)


def _warned(spark, sf):
    """Rows that break each warn and drop rule, as the observation of a pass over the rows counts them."""
    seen = Observation()
    expect_warn(_typed(spark, sf), _rules(spark), seen).write.format("noop").mode("overwrite").save()
    counted = seen.get
    rows = [(k.removeprefix("failed_"), v, counted["total_records"]) for k, v in counted.items() if k.startswith("failed_")]
    return spark.createDataFrame(rows, "rule_id string, failed_records long, total_records long")


def _statistics(spark, sf):
    name = _name("orders")
    _orders(spark, sf).write.saveAsTable(name)
    spark.sql(f"analyze table {name} compute statistics")
    found = catalog.table_details(spark, name)
    rows = F.regexp_extract("Statistics", r"(\d+) rows", 1).cast("long")
    return found.select(F.col("Database").alias("table_schema"), F.col("Provider").alias("provider"), rows.alias("num_rows"))


def _listed(spark, sf):
    """Tables found by the start of their names."""
    prefix = _name("listed")
    for given in ("nation", "region", "part"):
        table(spark, sf, given).limit(1).write.saveAsTable(f"{prefix}_{given}")
    found = catalog.table_names(spark, "default", prefix)
    return found.select("table_schema", F.regexp_replace("table_name", f"^{prefix}_", "").alias("table_name"))


def _grown(spark, sf):
    names = {given: _name(given) for given in ("orders", "customer", "events")}
    for given, name in names.items():
        table(spark, sf, given).repartition(2).write.saveAsTable(name)
    found = table_growth(spark, list(names.values()), F.lit(RULE_DAY))
    given = F.regexp_extract("table_name", "^([a-z]+)_", 1).alias("table_name")
    return found.select(given, "num_rows", "num_files", (F.col("size_bytes") > 0).alias("has_bytes"), "snapshot_date")


def _log_tables(spark, sf):
    customers = table(spark, sf, "customer")
    pipelines = customers.select(F.col("c_custkey").cast("string").alias("pipeline_id"), F.col("c_mktsegment").alias("name"))
    tables = customers.filter("c_custkey % 3 = 0").select(F.lit("logs").alias("table_schema"), F.concat(F.lit("event_log_"), "c_custkey").alias("table_name"))
    return event_log_tables(pipelines, tables, ["BUILDING", "MACHINERY"])


BROKEN_SQL = f"""with {FEED_SQL},
rules as (
  select * from (values ('user_id', 'drop'), ('updated_at', 'drop'), ('is_active', 'drop'), ('tier', 'warn'),
    ('signup_date', 'warn'), ('country', 'warn')) as r(field_name, action_type))
select concat_ws('-', 'users', field_name, action_type) as rule_id,
  count(*) - count(case r.field_name when 'user_id' then user_id when 'tier' then tier
      when 'is_active' then is_active when 'country' then country when 'updated_at' then cast(updated_at as varchar)
      else cast(signup_date as varchar) end) as failed_records, count(*) as total_records
from rules r, typed group by 1, field_name"""

QUERIES = {
    "table_replaced": (
        lambda spark, sf: _replaced(spark, sf),
        "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders where o_orderstatus not in ('F', 'O')",
    ),
    "table_appended": (
        lambda spark, sf: _appended(spark, sf),
        "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders",
    ),
    "table_deleted": (
        lambda spark, sf: _deleted(spark, sf),
        """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders
where not (o_orderstatus = 'P' and o_custkey % 2 = 0) and o_custkey not in (select c_custkey from customer where c_acctbal < 0)""",
    ),
    "mart_by_watermark": (
        lambda spark, sf: _run_twice(spark, sf, runner.session_mart()),
        MART_QUERIES["user_session_summary"][1],
    ),
    "mart_full_refresh": (
        lambda spark, sf: _run_twice(spark, sf, runner.hourly_mart(), "full"),
        with_sql(EVENTS_SQL, query=HOURLY_SQL.format(source="ev")),
    ),
    "pipeline_names": (
        lambda spark, sf: config.pipeline_names(_pipelines_of(spark, sf), "dev"),
        """
select distinct c_mktsegment as name from customer
where c_nationkey % 2 = 0 and c_custkey % 7 <> 0 and c_custkey % 3 = 0 and c_custkey % 5 <> 0 and c_acctbal > 9000""",
    ),
    "schema_from_config": (
        lambda spark, sf: typed_select(_feed(spark, sf), config.schema_for(_configured(spark), "users", "silver")),
        f"with {FEED_SQL} select * from typed",
    ),
    "privacy_view_from_config": (
        lambda spark, sf: _private(spark, sf),
        f"""with {PEOPLE_SQL}
select concat(left(cast(user_id as varchar), 1), '***') as user_id, concat(left(full_name, 1), '***') as full_name,
  concat(left(email, 1), '***@', split_part(email, '@', 2)) as email, country, balance
from people where country = 'UK'""",
    ),
    "warn_counters": (lambda spark, sf: _warned(spark, sf), BROKEN_SQL),
    "expect_fail": (
        lambda spark, sf: expect_fail(_typed(spark, sf), [Rule("users-user_id-fail", "user_id", "user_id IS NOT NULL", "fail")]),
        f"with {FEED_SQL} select * from typed",
    ),
    "landing_lineage": (
        lambda spark, sf: _batch_events(spark, sf).select(
            "event_id",
            F.regexp_extract("source_file_path", r"/events/(batch_\d+)/[^/]+\.json$", 1).alias("folder"),
            F.col("source_file_path").endswith(F.col("source_file_name")).alias("same_file"),
            (F.col("ingestion_timestamp") == F.col("update_timestamp")).alias("same_time"),
        ),
        with_sql(
            EVENTS_SQL,
            query="""
select cast(event_id as varchar) as event_id, true as same_file, true as same_time,
  case when event_type in ('like', 'share', 'comment') then 'batch_001' else 'batch_002' end as folder
from ev""",
        ),
    ),
    "table_statistics": (
        lambda spark, sf: _statistics(spark, sf),
        "select 'default' as table_schema, 'parquet' as provider, count(*) as num_rows from orders",
    ),
    "tables_by_name": (
        lambda spark, sf: _listed(spark, sf),
        "select 'default' as table_schema, unnest(['nation', 'region', 'part']) as table_name",
    ),
    "table_growth_by_catalog": (
        lambda spark, sf: _grown(spark, sf),
        " union all ".join(
            f"select '{t}' as table_name, count(*) as num_rows, cast(2 as bigint) as num_files, true as has_bytes, "
            f"timestamp '{RULE_DAY}' as snapshot_date from {t}"
            for t in ("orders", "customer", "events")
        ),
    ),
    "event_log_tables": (
        lambda spark, sf: _log_tables(spark, sf),
        """
select cast(c_custkey as varchar) as pipeline_id, c_mktsegment as pipeline_name, concat('logs.`event_log_', c_custkey, '`') as full_name
from customer where c_custkey % 3 = 0 and c_mktsegment in ('BUILDING', 'MACHINERY')""",
    ),
    "literal_rows": (
        lambda spark, sf: table(spark, sf, "region").join(
            spark.sql("select * from values (0, 'zero'), (1, 'one'), (9, null) as t(r_regionkey, word)"), "r_regionkey"
        ).select("r_regionkey", "r_name", "word"),
        "select r_regionkey, r_name, word from region join (values (0, 'zero'), (1, 'one'), (9, null)) as t(k, word) on r_regionkey = k",
    ),
    "first_rows": (
        lambda spark, sf: _orders(spark, sf).orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10),
        "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10",
    ),
}
