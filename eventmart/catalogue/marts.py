"""Registered mart queries with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventmart.catalogue.tables import ADS_SQL, EVENTS_SQL, ads, events, with_sql
from eventmart.operators.ordering import running_distinct
from eventmart.plans import ads as ad_plans
from eventmart.plans import anomalies, content, hourly, sessions

# The test events are sparser than one a minute, so days stand for minutes.
SPIKE, ADDRESSES = 7, 5
NOW = "2024-02-01 00:00:00"


def _flags(spark, sf, **options):
    return anomalies.anomaly_flags(
        events(spark, sf), bucket="day", spike_gt=SPIKE, ip_gt=ADDRESSES,
        now=F.lit(NOW).cast("timestamp"), **options,
    )


SIGNALS_SQL = f"""
day_events as (select *, date_trunc('day', "timestamp") as bucket from ev),
steps as (
  select *, lag(country) over (partition by user_id order by "timestamp", country nulls first, event_id) as prev_country,
    lag("timestamp") over (partition by user_id order by "timestamp", country nulls first, event_id) as prev_timestamp
  from day_events),
flagged_events as (
  select s.*, coalesce(prev_country <> country, false) as suspicious,
    count(distinct event_id) over (partition by user_id, bucket) as number_of_events,
    count(distinct ip_address) over (partition by user_id order by bucket) as running_addresses
  from steps s),
per_event as (
  select *, number_of_events > {SPIKE} as spike, running_addresses > {ADDRESSES} as bot from flagged_events)"""

CASES_SQL = (
    SIGNALS_SQL
    + """,
cases as (
  select *,
    case when spike and suspicious and bot then 7 when suspicious and bot then 6 when spike and bot then 5
      when spike and suspicious then 4 when bot then 3 when suspicious then 2 when spike then 1 else 0 end as case_severity,
    strftime(min("timestamp") over (partition by user_id, bucket), '%Y-%m-%d %H:%M:%S') as first_seen,
    strftime(max("timestamp") over (partition by user_id, bucket), '%Y-%m-%d %H:%M:%S') as last_seen
  from per_event where spike or bot or suspicious),
labelled as (
  select *,
    case case_severity when 1 then 'spike' when 2 then 'suspicious' when 3 then 'bot' when 4 then 'spike_suspicious'
      when 5 then 'spike_bot' when 6 then 'suspicious_bot' else 'spike_suspicious_bot' end as flag_type,
    concat_ws(';', case when spike then 'unusual network traffic observed' end,
      case when suspicious then 'multiple different geo location login detected' end,
      case when bot then 'multiple IP with same user-id' end) as flag_reason,
    case when case_severity <= 2 then 'low' when case_severity <= 4 then 'medium' else 'high' end as severity
  from cases)"""
)

_FLAG_COLUMNS = f"""l.user_id, strftime(l.bucket, '%Y-%m-%d') as event_timestamp,
  cast(l.case_severity as integer) as case_severity, l.flag_type, l.flag_reason, l.number_of_events,
  l.first_seen, l.last_seen, l.severity, '{NOW}' as detection_timestamp"""

QUERIES = {
    "hourly_active_users": (
        lambda spark, sf: hourly.hourly_active_users(events(spark, sf)),
        with_sql(
            EVENTS_SQL,
            query="""
select strftime("timestamp", '%Y-%m-%d') as date, strftime("timestamp", '%H') as hour, platform, country,
  count(distinct user_id) as unique_users, count(event_id) as total_events,
  count(distinct session_id) as new_sessions
from ev group by 1, 2, 3, 4""",
        ),
    ),
    "session_durations": (
        lambda spark, sf: sessions.session_durations(events(spark, sf)),
        with_sql(
            EVENTS_SQL,
            query="""
select user_id, session_id,
  cast(floor(epoch(max("timestamp"))) - floor(epoch(min("timestamp"))) as bigint) as session_duration
from ev group by 1, 2""",
        ),
    ),
    "most_used_platform": (
        lambda spark, sf: sessions.most_used_platform(events(spark, sf)),
        with_sql(
            EVENTS_SQL,
            query="""
select user_id, platform as most_used_platform from (
  select user_id, platform, row_number() over (partition by user_id order by count(session_id) desc, platform nulls last) as rn
  from ev group by user_id, platform) where rn = 1""",
        ),
    ),
    "user_session_summary": (
        lambda spark, sf: sessions.user_session_summary(events(spark, sf)),
        with_sql(
            EVENTS_SQL,
            query="""
, lengths as (
  select user_id, session_id,
    cast(floor(epoch(max("timestamp"))) - floor(epoch(min("timestamp"))) as bigint) as len
  from ev group by 1, 2),
per_user as (select user_id, cast(sum(len) as bigint) as s, count(session_id) as c from lengths group by 1),
fav as (
  select user_id, platform, row_number() over (partition by user_id order by count(session_id) desc, platform nulls last) as rn
  from ev group by user_id, platform),
seen as (select user_id, max("timestamp") as last_ts, count(session_id) as n from ev group by 1)
select user_id, c as total_session_per_user,
  cast(cast((200 * s + c) // (2 * c) as double) / 100 as decimal(11,2)) as avg_session_duration_in_seconds,
  platform as most_used_platform, last_ts as last_seen_timestamp_in_IST, n as total_events_per_user
from per_user join fav using (user_id) join seen using (user_id) where rn = 1""",
        ),
    ),
    "content_engagement": (
        lambda spark, sf: content.content_engagement(events(spark, sf)),
        with_sql(
            EVENTS_SQL,
            query="""
, counts as (
  select content_id, content_type,
    count(*) filter (where event_type in ('story_view', 'video_play', 'page_view')) as views_count,
    count(*) filter (where event_type = 'like') as likes_count,
    count(*) filter (where event_type = 'share') as shares_count,
    count(*) filter (where event_type = 'comment') as comment_count
  from ev group by 1, 2),
scored as (
  select *, least(case when views_count = 0 then 0.0::double else
      cast(round(cast((likes_count + shares_count + comment_count) / views_count as decimal(18,10)), 2) as double) * 100 end,
      100.0::double) as engagement_score
  from counts)
select *, cast(rank() over (partition by content_type order by engagement_score desc) as integer) as content_rank
from scored""",
        ),
    ),
    "ad_event_counts": (
        lambda spark, sf: ad_plans.ad_event_counts(events(spark, sf)),
        with_sql(
            EVENTS_SQL,
            query="""
, counts as (
  select ad_id, count(*) filter (where event_type = 'ad_click') as ad_clicks_count,
    count(*) filter (where event_type = 'ad_impression') as ad_impressions_count
  from ev where ad_id is not null group by 1)
select *, case when ad_impressions_count > 0 then
    cast(round(cast(ad_clicks_count / ad_impressions_count as decimal(18,10)), 2) as double) end as ctr
from counts""",
        ),
    ),
    "ad_performance": (
        lambda spark, sf: ad_plans.ad_performance(events(spark, sf), ads(spark, sf)),
        with_sql(
            EVENTS_SQL,
            ADS_SQL,
            query="""
, counts as (
  select ad_id, count(*) filter (where event_type = 'ad_click') as ad_clicks_count,
    count(*) filter (where event_type = 'ad_impression') as ad_impressions_count
  from ev where ad_id is not null group by 1)
select ad_id, campaign_id, ad_clicks_count, ad_impressions_count,
  case when ad_impressions_count > 0 then
    cast(round(cast(ad_clicks_count / ad_impressions_count as decimal(18,10)), 2) as double) end as ctr,
  coalesce(cast(round(cast(spend_usd / nullif(budget_usd, 0) * 100 as decimal(18,10)), 2) as double), 0) as spend_percentage
from counts join ads using (ad_id)""",
        ),
    ),
    "events_per_bucket": (
        lambda spark, sf: anomalies.events_per_bucket(events(spark, sf), "hour"),
        with_sql(
            EVENTS_SQL,
            query="""
select user_id, date_trunc('hour', "timestamp") as bucket, count(distinct event_id) as number_of_events,
  min("timestamp") as first_ts, max("timestamp") as last_ts
from ev group by 1, 2""",
        ),
    ),
    "running_distinct_ips": (
        lambda spark, sf: running_distinct(
            events(spark, sf).withColumn("bucket", F.date_trunc("day", "timestamp")),
            ["user_id"], "bucket", "ip_address", "running_addresses",
        ),
        with_sql(
            EVENTS_SQL,
            query="""
, b as (select *, date_trunc('day', "timestamp") as bucket from ev)
select distinct user_id, bucket,
  count(distinct ip_address) over (partition by user_id order by bucket) as running_addresses
from b""",
        ),
    ),
    "country_changes": (
        lambda spark, sf: anomalies.country_steps(events(spark, sf)),
        with_sql(
            EVENTS_SQL,
            query="""
, s as (select user_id, "timestamp", country, count(*) as n_events from ev group by 1, 2, 3),
p as (
  select *, lag(country) over w as prev_country, lag("timestamp") over w as prev_timestamp
  from s window w as (partition by user_id order by "timestamp", country nulls first))
select *, coalesce(prev_country <> country, false) as suspicious from p""",
        ),
    ),
    "country_changes_within_gap": (
        lambda spark, sf: anomalies.country_steps(events(spark, sf), country_gap="12 hours"),
        with_sql(
            EVENTS_SQL,
            query="""
, s as (select user_id, "timestamp", country, count(*) as n_events from ev group by 1, 2, 3),
p as (
  select *, lag(country) over w as prev_country, lag("timestamp") over w as prev_timestamp
  from s window w as (partition by user_id order by "timestamp", country nulls first))
select *, coalesce(prev_country <> country and "timestamp" - prev_timestamp < interval 12 hours, false) as suspicious
from p""",
        ),
    ),
    "anomaly_signals": (
        lambda spark, sf: anomalies.bucket_signals(events(spark, sf), "day"),
        with_sql(
            EVENTS_SQL,
            SIGNALS_SQL,
            query="""
select user_id, bucket, any_value(number_of_events) as number_of_events, min("timestamp") as first_ts,
  max("timestamp") as last_ts, count(*) filter (where suspicious) as suspicious_events,
  count(*) filter (where not suspicious) as other_events,
  min("timestamp") filter (where suspicious) as first_suspicious,
  max("timestamp") filter (where suspicious) as last_suspicious,
  cast(any_value(running_addresses) as bigint) as running_addresses
from per_event group by 1, 2""",
        ),
    ),
    "anomaly_flags": (
        lambda spark, sf: _flags(spark, sf),
        with_sql(
            EVENTS_SQL,
            CASES_SQL,
            query=f"""
, ips as (select distinct user_id, bucket, ip_address from day_events where ip_address is not null)
select distinct i.ip_address, {_FLAG_COLUMNS}
from labelled l join ips i on i.user_id = l.user_id and i.bucket = l.bucket""",
        ),
    ),
    "anomaly_flags_outer": (
        lambda spark, sf: _flags(spark, sf, explode_outer=True),
        with_sql(
            EVENTS_SQL,
            CASES_SQL,
            query=f"""
, ips as (select distinct user_id, bucket, ip_address from day_events where ip_address is not null)
select distinct i.ip_address, {_FLAG_COLUMNS}
from labelled l left join ips i on i.user_id = l.user_id and i.bucket = l.bucket""",
        ),
    ),
    "first_last_seen": (
        lambda spark, sf: anomalies.anomaly_cases(
            events(spark, sf), bucket="day", spike_gt=SPIKE, ip_gt=ADDRESSES
        ).select("user_id", "bucket", "case_severity", "first_seen", "last_seen"),
        with_sql(
            EVENTS_SQL,
            CASES_SQL,
            query="""
select distinct user_id, bucket, cast(case_severity as integer) as case_severity, first_seen, last_seen
from labelled""",
        ),
    ),
}
