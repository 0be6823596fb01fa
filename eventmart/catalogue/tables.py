"""The given test tables seen as the toolkit's inputs, for both engines.

Each view exists twice: as a DataFrame and as the SQL text the second engine
runs. Both read the whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # The second engine has zone-less timestamps, so local time must be UTC here.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw events as silver events."""
    raw = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    k, kind, content = F.col("k"), F.col("event_type"), F.col("event_id") % 97
    return raw.select(
        "event_id",
        "user_id",
        F.concat(F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "yyyyMMdd")).alias("session_id"),
        F.when(kind == "view", F.when(k < 50, "page_view").otherwise("video_play"))
        .when(kind == "click", F.when(k < 34, "like").when(k < 67, "share").otherwise("comment"))
        .when(kind == "purchase", "ad_click")
        .when(kind == "signup", "ad_impression")
        .otherwise("story_view")
        .alias("event_type"),
        content.alias("content_id"),
        F.when(content % 3 == 0, "post").when(content % 3 == 1, "video").otherwise("reel").alias("content_type"),
        F.when(kind.isin("purchase", "signup"), k % 50).alias("ad_id"),
        F.when(k % 4 == 0, "iOS").when(k % 4 == 1, "Android").when(k % 4 == 2, "Web").otherwise("Desktop").alias("platform"),
        F.when(k % 10 == 9, None).when(k % 7 < 5, "IN").when(k % 7 == 5, "US").otherwise("UK").alias("country"),
        F.when(k % 11 == 0, None)
        .otherwise(F.concat(F.lit("10.0.0."), (k % 6).cast("string")))
        .alias("ip_address"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("ts").cast("timestamp").alias("updated_at"),
    )


EVENTS_SQL = """
ev0 as (select *, cast(json_extract_string(props, '$.k') as int) as k from events),
ev as (
  select event_id, user_id,
    concat(cast(user_id as varchar), '-', strftime(ts, '%Y%m%d')) as session_id,
    case event_type
      when 'view' then case when k < 50 then 'page_view' else 'video_play' end
      when 'click' then case when k < 34 then 'like' when k < 67 then 'share' else 'comment' end
      when 'purchase' then 'ad_click' when 'signup' then 'ad_impression' else 'story_view' end as event_type,
    event_id % 97 as content_id,
    case (event_id % 97) % 3 when 0 then 'post' when 1 then 'video' else 'reel' end as content_type,
    case when event_type in ('purchase', 'signup') then k % 50 end as ad_id,
    case k % 4 when 0 then 'iOS' when 1 then 'Android' when 2 then 'Web' else 'Desktop' end as platform,
    case when k % 10 = 9 then null when k % 7 < 5 then 'IN' when k % 7 = 5 then 'US' else 'UK' end as country,
    case when k % 11 = 0 then null else concat('10.0.0.', cast(k % 6 as varchar)) end as ip_address,
    ts as "timestamp", ts as updated_at
  from ev0)"""


def ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as the current row of an ad."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ad_id"),
        (F.col("p_partkey") % 10).alias("campaign_id"),
        F.col("p_retailprice").alias("budget_usd"),
        F.col("p_size").cast("double").alias("spend_usd"),
    )


ADS_SQL = """
ads as (
  select p_partkey as ad_id, p_partkey % 10 as campaign_id, p_retailprice as budget_usd,
    cast(p_size as double) as spend_usd
  from part)"""


def user_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a change feed of users: one change per order."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderpriority").alias("tier"),
        F.col("o_orderstatus").alias("is_active"),
        F.col("o_orderdate").cast("timestamp").alias("updated_at"),
        F.col("o_orderkey").alias("change_id"),
    )


USER_CHANGES_SQL = """
user_changes as (
  select o_custkey as user_id, o_orderpriority as tier, o_orderstatus as is_active,
    o_orderdate as updated_at, o_orderkey as change_id
  from orders)"""


def with_sql(*views: str, query: str) -> str:
    """Joins the view texts and a query into one statement."""
    text = query.lstrip()
    return "with " + ",".join(views) + (text if text.startswith(",") else "\n" + text)
