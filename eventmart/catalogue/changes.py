"""Registered queries on history, slices, merges and erasure, with their SQL twins."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from eventmart.catalogue.marts import ADDRESSES, NOW, SPIKE
from eventmart.catalogue.marts import QUERIES as MART_QUERIES
from eventmart.catalogue.tables import (
    EVENTS_SQL,
    USER_CHANGES_SQL,
    ads,
    events,
    table,
    user_changes,
    with_sql,
)
from eventmart.operators.history import current_rows, scd2, scd2_apply, scd2_extend, sequence_state
from eventmart.operators.incremental import incremental_slice, of_keys, touched_days
from eventmart.operators.merge import delete_where, erase_subjects, merge_upsert
from eventmart.operators.ordering import rank_by_value, top_per_group
from eventmart.plans import ads as ad_plans
from eventmart.plans import content, hourly, runner, sessions

WATERMARK = dt.datetime(2024, 1, 20, 12, 0)
WM = "timestamp '2024-01-20 12:00:00'"
LATE = f"({WM} - interval 30 minutes)"


def _event_changes(spark, sf):
    return table(spark, sf, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id", "event_type")


def _until_watermark(df):
    return df.filter(F.col("updated_at") <= F.lit(WATERMARK))


def _refreshed(mart, spark, sf, *sources):
    """A mart built up to the watermark, then refreshed with the slice after it."""
    old = mart.build(*[mart.prepare(_until_watermark(s) if "updated_at" in s.columns else s) for s in sources])
    changing = [s for s in sources if "updated_at" in s.columns]
    touched = runner.touched_keys(mart, changing, WATERMARK)
    if not mart.partial:
        return runner.refresh_rows(mart, old, sources, touched)
    days = touched_days(incremental_slice(sources[0], WATERMARK))
    partials = runner.refresh_partials(mart, runner.day_partials(mart, _until_watermark(sources[0])), sources[0], days)
    return runner.refresh_rows(mart, old, sources, touched, partials)


def _ad_changes(spark, sf):
    """Order lines as changes of ads (one ad per part)."""
    return table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("ad_id"),
        F.col("l_suppkey").alias("campaign_id"),
        F.col("l_extendedprice").alias("budget_usd"),
        F.col("l_quantity").alias("spend_usd"),
        F.col("l_shipdate").cast("timestamp").alias("updated_at"),
        F.col("l_orderkey").alias("change_order"),
        F.col("l_linenumber").alias("change_line"),
    )


def _scd2_sql(source, key, order, tracked, valid, columns):
    return f"""
, seen as (
  select *, lag({tracked}) over w as before, row_number() over w as rn
  from {source} window w as (partition by {key} order by {order})),
versions as (select * from seen where rn = 1 or {tracked} is distinct from before)
select {columns}, {valid} as valid_from,
  lead({valid}) over (partition by {key} order by {order}) as valid_to,
  lead({valid}) over (partition by {key} order by {order}) is null as is_current
from versions"""


EVENT_HISTORY_SQL = _scd2_sql(
    "changes", "user_id", "ts, event_id", "event_type", "ts", "user_id, ts, event_id, event_type"
)
EVENT_CHANGES_SQL = "\nchanges as (select user_id, ts, event_id, event_type from events)"

HOURLY_SQL = """
select strftime("timestamp", '%Y-%m-%d') as date, strftime("timestamp", '%H') as hour, platform, country,
  count(distinct user_id) as unique_users, count(event_id) as total_events,
  count(distinct session_id) as new_sessions
from {source} group by 1, 2, 3, 4"""


CONTENT_SQL = MART_QUERIES["content_engagement"][1]
AD_SQL = MART_QUERIES["ad_performance"][1]


def _spend_by_customer(orders, states):
    """Order totals per customer over the orders in the given states."""
    return (
        orders.filter(F.col("o_orderstatus").isin(states))
        .groupBy(F.col("o_custkey").alias("user_id"))
        .agg(F.count("*").alias("n_orders"), F.max("o_orderdate").alias("last_order"))
    )


def _erased(spark, sf, name):
    ev = events(spark, sf)
    subjects = table(spark, sf, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("user_id"))
    tables = {"sessions": (sessions.user_session_summary(ev), "user_id"), "events": (ev, "user_id")}
    return erase_subjects(tables, subjects)[name]


QUERIES = {
    "scd2_history": (
        lambda spark, sf: scd2(_event_changes(spark, sf), ["user_id"], ["ts", "event_id"], ["event_type"]),
        with_sql(EVENT_CHANGES_SQL, query=EVENT_HISTORY_SQL),
    ),
    "scd2_users": (
        lambda spark, sf: scd2(user_changes(spark, sf), ["user_id"], ["updated_at", "change_id"]),
        with_sql(
            USER_CHANGES_SQL,
            query=_scd2_sql(
                "user_changes", "user_id", "updated_at, change_id", "(tier, is_active)", "updated_at",
                "user_id, tier, is_active, updated_at, change_id",
            ),
        ),
    ),
    "scd2_current": (
        lambda spark, sf: current_rows(
            scd2(_event_changes(spark, sf), ["user_id"], ["ts", "event_id"], ["event_type"])
        ).select("user_id", "event_type", "valid_from"),
        with_sql(
            EVENT_CHANGES_SQL,
            query="""
, seen as (
  select *, lag(event_type) over w as before, row_number() over w as rn
  from changes window w as (partition by user_id order by ts, event_id)),
versions as (select * from seen where rn = 1 or event_type <> before),
latest as (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as back from versions)
select user_id, event_type, ts as valid_from from latest where back = 1""",
        ),
    ),
    "scd2_apply": (
        lambda spark, sf: _applied(spark, sf),
        with_sql(EVENT_CHANGES_SQL, query=EVENT_HISTORY_SQL),
    ),
    "scd2_extend": (
        lambda spark, sf: _extended(spark, sf),
        with_sql(EVENT_CHANGES_SQL, query=EVENT_HISTORY_SQL),
    ),
    "ad_performance_history": (
        lambda spark, sf: ad_plans.ad_performance(
            events(spark, sf),
            current_rows(scd2(_ad_changes(spark, sf), ["ad_id"], ["updated_at", "change_order", "change_line"])),
        ),
        with_sql(
            EVENTS_SQL,
            query="""
, counts as (
  select ad_id, count(*) filter (where event_type = 'ad_click') as ad_clicks_count,
    count(*) filter (where event_type = 'ad_impression') as ad_impressions_count
  from ev where ad_id is not null group by 1),
seen as (
  select l_partkey as ad_id, l_suppkey as campaign_id, l_extendedprice as budget_usd, l_quantity as spend_usd,
    l_shipdate, l_orderkey, l_linenumber,
    lag((l_suppkey, l_extendedprice, l_quantity)) over w as before, row_number() over w as rn
  from lineitem window w as (partition by l_partkey order by l_shipdate, l_orderkey, l_linenumber)),
versions as (
  select *, row_number() over (partition by ad_id order by l_shipdate desc, l_orderkey desc, l_linenumber desc) as back
  from seen where rn = 1 or (campaign_id, budget_usd, spend_usd) is distinct from before),
current_ads as (select * from versions where back = 1)
select ad_id, campaign_id, ad_clicks_count, ad_impressions_count,
  case when ad_impressions_count > 0 then
    cast(round(cast(ad_clicks_count / ad_impressions_count as decimal(18,10)), 2) as double) end as ctr,
  coalesce(cast(round(cast(spend_usd / nullif(budget_usd, 0) * 100 as decimal(18,10)), 2) as double), 0) as spend_percentage
from counts join current_ads using (ad_id)""",
        ),
    ),
    "incremental_slice": (
        lambda spark, sf: incremental_slice(events(spark, sf), WATERMARK).select("event_id", "user_id", "updated_at"),
        with_sql(EVENTS_SQL, query=f"select event_id, user_id, updated_at from ev where updated_at > {LATE}"),
    ),
    "affected_keys_recompute": (
        lambda spark, sf: _refreshed(runner.session_mart(), spark, sf, events(spark, sf)),
        MART_QUERIES["user_session_summary"][1],
    ),
    "hourly_refresh": (
        lambda spark, sf: _refreshed(runner.hourly_mart(), spark, sf, events(spark, sf)),
        with_sql(EVENTS_SQL, query=HOURLY_SQL.format(source="ev")),
    ),
    "content_refresh": (
        lambda spark, sf: content.rank_content(_refreshed(runner.content_mart(), spark, sf, events(spark, sf))),
        CONTENT_SQL,
    ),
    "ad_refresh": (
        lambda spark, sf: _refreshed(runner.ad_mart(), spark, sf, events(spark, sf), ads(spark, sf)),
        AD_SQL,
    ),
    "anomaly_refresh": (
        lambda spark, sf: _refreshed(
            runner.anomaly_mart("day", spike_gt=SPIKE, ip_gt=ADDRESSES, now=F.lit(NOW).cast("timestamp")), spark, sf, events(spark, sf)
        ),
        MART_QUERIES["anomaly_flags"][1],
    ),
    "semi_join_active_users": (
        lambda spark, sf: of_keys(
            events(spark, sf), incremental_slice(events(spark, sf), WATERMARK).select("user_id").distinct(), ["user_id"]
        ).select("event_id", "user_id", "event_type"),
        with_sql(
            EVENTS_SQL,
            query=f"""
select event_id, user_id, event_type from ev
where user_id in (select user_id from ev where updated_at > {LATE})""",
        ),
    ),
    "union_by_name": (
        lambda spark, sf: events(spark, sf)
        .filter(F.col("ad_id").isNotNull())
        .select("event_id", "user_id", "event_type")
        .unionByName(incremental_slice(events(spark, sf), WATERMARK).select("event_type", "user_id", "event_id")),
        with_sql(
            EVENTS_SQL,
            query=f"""
select event_id, user_id, event_type from ev where ad_id is not null
union all select event_id, user_id, event_type from ev where updated_at > {LATE}""",
        ),
    ),
    "distinct_keys": (
        lambda spark, sf: top_per_group(
            table(spark, sf, "orders"), ["o_custkey", "o_orderpriority"], [F.desc("o_orderdate"), F.desc("o_orderkey")]
        ),
        """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from (
  select *, row_number() over (partition by o_custkey, o_orderpriority order by o_orderdate desc, o_orderkey desc) as rn
  from orders) where rn = 1""",
    ),
    "distinct_rows": (
        lambda spark, sf: table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag").distinct(),
        "select distinct l_partkey, l_suppkey, l_returnflag from lineitem",
    ),
    "rank_by_value": (
        lambda spark, sf: rank_by_value(
            table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity"),
            ["l_returnflag"], "l_quantity", "quantity_rank",
        ),
        """
select l_orderkey, l_linenumber, l_returnflag, l_quantity,
  cast(rank() over (partition by l_returnflag order by l_quantity desc) as integer) as quantity_rank
from lineitem""",
    ),
    "merge_upsert": (
        lambda spark, sf: merge_upsert(
            _spend_by_customer(table(spark, sf, "orders"), ["F", "O"]),
            _spend_by_customer(table(spark, sf, "orders"), ["P"]),
            ["user_id"],
        ),
        """
with totals as (
  select o_custkey as user_id, o_orderstatus = 'P' as fresh, count(*) as n_orders, max(o_orderdate) as last_order
  from orders group by 1, 2)
select user_id, n_orders, last_order from totals t
where fresh or not exists (select 1 from totals s where s.fresh and s.user_id = t.user_id)""",
    ),
    "merge_upsert_null_keys": (
        lambda spark, sf: merge_upsert(
            hourly.hourly_active_users(_until_watermark(events(spark, sf))),
            hourly.hourly_active_users(incremental_slice(events(spark, sf), WATERMARK)),
            hourly.KEYS,
            null_safe=True,
        ),
        with_sql(
            EVENTS_SQL,
            f"\nold as ({HOURLY_SQL.format(source=f'(select * from ev where updated_at <= {WM})')})",
            f"\nfresh as ({HOURLY_SQL.format(source=f'(select * from ev where updated_at > {LATE})')})",
            query="""
select * from fresh
union all
select o.* from old o where not exists (
  select 1 from fresh f where f.date = o.date and f.hour = o.hour
    and f.platform is not distinct from o.platform and f.country is not distinct from o.country)""",
        ),
    ),
    "merge_delete": (
        lambda spark, sf: delete_where(
            _spend_by_customer(table(spark, sf, "orders"), ["F", "O", "P"]), F.col("n_orders") < 8
        ),
        """
select o_custkey as user_id, count(*) as n_orders, max(o_orderdate) as last_order
from orders group by 1 having count(*) >= 8""",
    ),
    "erase_subjects": (
        lambda spark, sf: _erased(spark, sf, "events").select("event_id", "user_id", "session_id", "event_type"),
        with_sql(
            EVENTS_SQL,
            query="""
select event_id, user_id, session_id, event_type from ev
where user_id not in (select c_custkey from customer where c_acctbal < 0)""",
        ),
    ),
    "erase_subjects_gold": (
        lambda spark, sf: _erased(spark, sf, "sessions").select("user_id", "total_events_per_user"),
        with_sql(
            EVENTS_SQL,
            query="""
select user_id, count(session_id) as total_events_per_user from ev
where user_id not in (select c_custkey from customer where c_acctbal < 0) group by 1""",
        ),
    ),
    "pivot_first": (
        lambda spark, sf: table(spark, sf, "orders")
        .groupBy("o_custkey")
        .pivot("o_orderstatus", ["F", "O", "P"])
        .agg(F.max("o_orderdate")),
        """
select o_custkey, max(o_orderdate) filter (where o_orderstatus = 'F') as "F",
  max(o_orderdate) filter (where o_orderstatus = 'O') as "O",
  max(o_orderdate) filter (where o_orderstatus = 'P') as "P"
from orders group by 1""",
    ),
}


def _applied(spark, sf):
    """The event history taken in as two batches, the second with late changes."""
    changes = _event_changes(spark, sf)
    late = F.col("event_type") == "purchase"
    first, second = changes.filter(~late), changes.filter(late)
    rule = (["user_id"], ["ts", "event_id"], ["event_type"])
    history = scd2_apply(None, first, first, *rule)
    return scd2_apply(history, changes, second, *rule)


def _extended(spark, sf):
    """The event history up to the watermark, extended by the later events; some of the early ones arrive with these."""
    changes = _event_changes(spark, sf)
    early = (F.col("ts") <= F.lit(WATERMARK)) & (F.col("event_id") % 50 > 0)
    first, second = changes.filter(early), changes.filter(~early)
    rule = (["user_id"], ["ts", "event_id"], ["event_type"])
    history, state = scd2(first, *rule), sequence_state(first, *rule[:2])
    return scd2_extend(history, state, changes, second, *rule)[0]
