"""Engagement and rank of content."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.operators.ordering import rank_by_value

# Event types that count as a view.
VIEW_EVENTS = ["story_view", "video_play", "page_view"]
KEYS = ["content_id", "content_type"]


COUNTS = ["views_count", "likes_count", "shares_count", "comment_count"]


def content_partials(events: DataFrame, *by: str) -> DataFrame:
    """Mergeable counts per (``by``, content): views, likes, shares and comments."""
    kind = F.col("event_type")
    kinds = [kind.isin(VIEW_EVENTS), kind == "like", kind == "share", kind == "comment"]
    return events.groupBy(*by, *KEYS).agg(*[F.count_if(k).alias(c) for k, c in zip(kinds, COUNTS)])


def _with_score(counts: DataFrame) -> DataFrame:
    # The counts are named in the order they are aggregated. Ranking reads this
    # plan twice; in equal order both readers share one aggregation of the events.
    views = F.col("views_count")
    reactions = F.col("likes_count") + F.col("shares_count") + F.col("comment_count")
    ratio = F.when(views > 0, F.round(F.try_divide(reactions, views), 2)).otherwise(0.0)
    return counts.withColumn("engagement_score", F.least(ratio * 100, F.lit(100.0)))


def content_counts(events: DataFrame) -> DataFrame:
    """Views, likes, shares and comments per content, with the engagement score 0..100."""
    return _with_score(content_partials(events))


def rank_content(counts: DataFrame) -> DataFrame:
    """Rank by score within each content type. Scores take at most 101 values."""
    return rank_by_value(counts.drop("content_rank"), ["content_type"], "engagement_score", "content_rank")


def content_engagement(events: DataFrame) -> DataFrame:
    return rank_content(content_counts(events))


def fold_content(partials: DataFrame) -> DataFrame:
    """The mart from :func:`content_partials` of any days."""
    return rank_content(_with_score(partials.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in COUNTS])))
