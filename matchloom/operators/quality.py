"""Data-quality tables: coverage, pivots, mappings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def coverage(rated: DataFrame) -> DataFrame:
    """(metric, value) rows over the rated match sides, from one pass."""
    have, both = F.col("player_points").isNotNull(), F.col("player_points").isNotNull() & F.col("opponent_points").isNotNull()
    one = rated.agg(
        F.countDistinct("match_id").cast("double").alias("matches"),
        F.count("*").cast("double").alias("rows"),
        F.countDistinct("player_id").cast("double").alias("players"),
        F.round(F.avg(have.cast("double")), 6).alias("rating_coverage"),
        F.round(F.avg(both.cast("double")), 6).alias("both_rated"),
    )
    return one.unpivot([], one.columns, "metric", "value")


def rank_pivot(ratings: DataFrame, groups: dict[str, str]) -> DataFrame:
    """Snapshots by date and age group, zero where there is none."""
    return ratings.groupBy("classification_date").agg(*[F.count_if(F.col("age_group") == k).alias(v) for k, v in groups.items()])


def rni_mapping(ratings: DataFrame) -> DataFrame:
    """Per player: first date as text, last date, distinct dates, sorted age groups."""
    return ratings.groupBy("player_id").agg(
        F.min(F.date_format("classification_date", "dd.MM.yyyy")).alias("first_text"),
        F.max("classification_date").alias("last_date"),
        F.countDistinct("classification_date").alias("n_dates"),
        F.array_join(F.array_sort(F.collect_set("age_group")), "; ").alias("groups"),
    )


def row_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows by key, null keys included."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"))
