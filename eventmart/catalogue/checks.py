"""Registered queries on rules, typed projection, privacy and JSON, with their SQL twins."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventmart.catalogue.tables import table
from eventmart.config import default_rules
from eventmart.functions.privacy import mask, row_visible
from eventmart.operators.project import typed_select
from eventmart.operators.quality import counter_events, expect_drop, load_rules, read_counters, rule_metrics, store_counters
from eventmart.plans.monitors import rule_outcomes
from eventmart.plans.privacy_views import privacy_view
from eventmart.session import shared_folder

FEED_SCHEMA = (
    "user_id string, tier string, country string, is_active string, signup_date date, followers int, "
    "score double, updated_at timestamp"
)
RULE_DAY = dt.date(2024, 1, 1)


def _feed(spark, sf):
    """Orders as untyped user records, some with missing or malformed fields."""
    o = table(spark, sf, "orders")
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return o.select(
        F.col("o_orderkey").alias("record_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.when(priority != "4-NOT SPECIFIED", priority).alias("tier"),
        F.when(priority != "3-MEDIUM", F.lit("UK")).alias("country"),
        F.when(status != "P", status).alias("is_active"),
        F.when(priority == "5-LOW", "n/a").otherwise(day).alias("signup_date"),
        F.when(status == "O", "many").otherwise(F.col("o_custkey").cast("string")).alias("followers"),
        F.when(status == "F", "").otherwise(F.format_string("%d.5", "o_custkey")).alias("score"),
        F.when(priority == "1-URGENT", "soon").otherwise(F.concat(day, F.lit(" 12:30:00"))).alias("updated_at"),
    )


FEED_SQL = """
feed as (
  select o_orderkey as record_id, cast(o_custkey as varchar) as user_id,
    case when o_orderpriority <> '4-NOT SPECIFIED' then o_orderpriority end as tier,
    case when o_orderpriority <> '3-MEDIUM' then 'UK' end as country,
    case when o_orderstatus <> 'P' then o_orderstatus end as is_active,
    case when o_orderpriority = '5-LOW' then 'n/a' else strftime(o_orderdate, '%Y-%m-%d') end as signup_date,
    case when o_orderstatus = 'O' then 'many' else cast(o_custkey as varchar) end as followers,
    case when o_orderstatus = 'F' then '' else concat(o_custkey, '.5') end as score,
    case when o_orderpriority = '1-URGENT' then 'soon' else strftime(o_orderdate, '%Y-%m-%d 12:30:00') end as updated_at
  from orders),
typed as (
  select user_id, tier, country, is_active, try_cast(signup_date as date) as signup_date,
    try_cast(followers as integer) as followers, try_cast(score as double) as score,
    try_cast(updated_at as timestamp) as updated_at
  from feed)"""


def _typed(spark, sf):
    return typed_select(_feed(spark, sf), StructType.fromDDL(FEED_SCHEMA))


def _rules(spark):
    return load_rules(default_rules(spark, RULE_DAY), "users", RULE_DAY)


def _people(spark, sf):
    """Customers as users: a name, a mail address and a country."""
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    country = (
        F.when(F.col("n_name") == "NATION_0", "UK").when(F.col("n_name") == "NATION_1", "US").otherwise(F.col("n_name"))
    )
    return (
        table(spark, sf, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey").alias("user_id"),
            F.col("c_name").alias("full_name"),
            F.concat(F.lower("c_mktsegment"), F.lit("."), "c_custkey", F.lit("@example.com")).alias("email"),
            country.alias("country"),
            F.col("c_acctbal").alias("balance"),
        )
    )


PEOPLE_SQL = """
people as (
  select c_custkey as user_id, c_name as full_name,
    concat(lower(c_mktsegment), '.', c_custkey, '@example.com') as email,
    case n_name when 'NATION_0' then 'UK' when 'NATION_1' then 'US' else n_name end as country,
    c_acctbal as balance
  from customer left join nation on c_nationkey = n_nationkey)"""



def _counter_outcomes(spark, sf):
    """Rules counted per micro-batch, one of them twice, and read back as the rule monitor's report of one run."""
    folder = shared_folder(spark, "counters")
    typed = _typed(spark, sf)
    for batch in (0, 1, 2, 1):
        part = typed.filter(F.pmod(F.crc32(F.coalesce("user_id", F.lit(""))), F.lit(3)) == batch)
        store_counters(part, _rules(spark), folder, "users", batch, "run_1")
    log = counter_events(read_counters(spark, folder), "people")
    pipelines = table(spark, sf, "region").filter("r_regionkey = 0").select(F.col("r_regionkey").alias("pipeline_id"), F.lit("people").alias("name"))
    at = F.lit(RULE_DAY).cast("timestamp")
    runs = pipelines.select("pipeline_id", F.lit("run_1").alias("update_id"), at.alias("period_start_time"), at.alias("period_end_time"))
    return rule_outcomes(pipelines, runs, log, None, at, at).drop("run_start_time", "run_end_time")


# Callers in the privacy queries.
ANALYST = ["analyst_UK", "analyst_free_tiers"]

QUERIES = {
    "typed_select": (
        lambda spark, sf: _typed(spark, sf),
        f"with {FEED_SQL} select * from typed",
    ),
    "quality_drop": (
        lambda spark, sf: expect_drop(_typed(spark, sf), _rules(spark)),
        f"""with {FEED_SQL}
select * from typed where user_id is not null and updated_at is not null and is_active is not null""",
    ),
    "quality_metrics": (
        lambda spark, sf: rule_metrics(_typed(spark, sf), _rules(spark)),
        f"""with {FEED_SQL},
rules as (
  select * from (values ('user_id', 'drop'), ('updated_at', 'drop'), ('is_active', 'drop'), ('tier', 'warn'),
    ('signup_date', 'warn'), ('country', 'warn')) as r(field_name, action_type)),
outcomes as (
  select r.*, count(*) as total_records, count(case r.field_name when 'user_id' then user_id when 'tier' then tier
      when 'is_active' then is_active when 'country' then country when 'updated_at' then cast(updated_at as varchar)
      else cast(signup_date as varchar) end) as passed_records
  from rules r, typed group by all)
select concat_ws('-', 'users', field_name, action_type) as rule_id, field_name, action_type, passed_records,
  total_records - passed_records as failed_records, total_records,
  cast(round(cast(passed_records / total_records as decimal(18,10)), 2) as double) * 100 as pass_percentage
from outcomes""",
    ),
    "rule_outcomes_from_counters": (
        lambda spark, sf: _counter_outcomes(spark, sf),
        f"""with {FEED_SQL},
rules as (
  select * from (values ('user_id', 'drop'), ('updated_at', 'drop'), ('is_active', 'drop'), ('tier', 'warn'),
    ('signup_date', 'warn'), ('country', 'warn')) as r(field_name, action_type)),
outcomes as (
  select r.*, count(*) as total, count(case r.field_name when 'user_id' then user_id when 'tier' then tier
      when 'is_active' then is_active when 'country' then country when 'updated_at' then cast(updated_at as varchar)
      else cast(signup_date as varchar) end) as passed
  from rules r, typed group by all)
select 'people' as pipeline_name, r_regionkey as pipeline_id, 'users' as flow_name,
  concat_ws('-', 'users', field_name, action_type) as expectations_name, cast(passed as varchar) as passed_records,
  cast(total - passed as varchar) as failed_records, cast(total as varchar) as total_rows,
  cast((200 * passed + total) // (2 * total) as decimal(19,2)) as pass_percentage, 'run_1' as update_id
from outcomes, region where r_regionkey = 0""",
    ),
    "json_extract": (
        lambda spark, sf: table(spark, sf, "events").select(
            "event_id",
            F.get_json_object("props", "$.k").alias("k_text"),
            F.from_json("props", "k int")["k"].alias("k"),
            F.get_json_object("props", "$.missing").alias("missing"),
        ),
        """
select event_id, json_extract_string(props, '$.k') as k_text,
  cast(json_extract_string(props, '$.k') as integer) as k, json_extract_string(props, '$.missing') as missing
from events""",
    ),
    "mask_values": (
        lambda spark, sf: _people(spark, sf).select(
            "user_id",
            mask("email", "email", ["admin"]).alias("admin_email"),
            mask("email", "email", ["analyst_US"]).alias("analyst_email"),
            mask("full_name", "text", ["analyst_UK"]).alias("analyst_name"),
            mask("email", "email", ["analyst_free_tiers"]).alias("other_email"),
            mask("full_name", "text", []).alias("other_name"),
        ),
        f"""with {PEOPLE_SQL}
select user_id, email as admin_email, concat(left(email, 1), '***@', split_part(email, '@', 2)) as analyst_email,
  concat(left(full_name, 1), '***') as analyst_name, '*****@****.***' as other_email, '*****' as other_name
from people""",
    ),
    "row_visible": (
        lambda spark, sf: _people(spark, sf).select(
            "user_id",
            row_visible("country", ["admin"]).alias("to_admin"),
            row_visible("country", ANALYST).alias("to_uk_analyst"),
            row_visible("country", ["analyst_UK"]).alias("to_analyst_without_tier"),
            row_visible("country", ["analyst_UK", "analyst_US", "analyst_all_tiers"]).alias("to_both"),
        ),
        f"""with {PEOPLE_SQL}
select user_id, true as to_admin, coalesce(country = 'UK', false) as to_uk_analyst, false as to_analyst_without_tier,
  coalesce(country in ('UK', 'US'), false) as to_both
from people""",
    ),
    "privacy_view": (
        lambda spark, sf: privacy_view(_people(spark, sf), ["user_id", "email", "full_name"], ANALYST),
        f"""with {PEOPLE_SQL}
select concat(left(cast(user_id as varchar), 1), '***') as user_id, concat(left(full_name, 1), '***') as full_name,
  concat(left(email, 1), '***@', split_part(email, '@', 2)) as email, country, balance
from people where country = 'UK'""",
    ),
}
