"""Queries of boosting with missing values, on matches with both sides' newest ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import boosting as B
from ..operators import evaluate as E
from ..operators.stored import stored
from .registry import RATED_LONG, _rated, register

FEATURES = ["player_points", "opponent_points", "player_rank", "opponent_rank", "player_counting", "opponent_counting", "diff_points"]


def _rows(spark: SparkSession, d: str) -> DataFrame:
    """Both perspectives of all matches; a side without a rating has missing features."""
    return _rated(spark, d).withColumn("diff_points", F.col("player_points") - F.col("opponent_points"))


def _entry(i: int, f: str) -> str:
    return f"{{'feature': {i}, 'bin': case when r.{f} is null then 0 else 1 + len(list_filter(e.{f}, lambda v: v < r.{f})) end}}"


_EDGES = ", ".join(f"list_distinct(quantile_cont(cast({f} as double), [{', '.join(str(i / 16) for i in range(1, 16))}])) as {f}" for f in FEATURES)


@register(
    "boosting_histogram",
    f"""with {RATED_LONG}, r as (select cast(win as double) as y, * exclude (win), player_points - opponent_points as diff_points from rated), e as (select {_EDGES} from r),
 b as (select y, unnest([{', '.join(_entry(i, f) for i, f in enumerate(FEATURES))}], recursive := true) from r, e)
 select cast(feature as int) as feature, cast(bin as int) as bin, cast(sum(0.5 - y) * {B.UNIT} as bigint) as g, cast(count(*) * {B.UNIT // 4} as bigint) as h, count(*) as n from b group by 1, 2""",
)
def boosting_histogram(spark: SparkSession, d: str) -> DataFrame:
    """The sums that a first tree's first level is made of: derivatives at even odds by feature and bin, the missing in bin 0."""
    rows = stored(_rows(spark, d).select("win", *FEATURES))
    ready = B.with_bins(rows.withColumnRenamed("win", "y"), FEATURES, B.bin_edges(rows, FEATURES, 16))
    return B.histogram(ready.withColumns({"w": F.lit(1.0), "m": F.lit(0.0)}), len(FEATURES), 17).select("feature", "bin", "g", "h", "n")


@register("boosted_symmetric")
def boosted_symmetric(spark: SparkSession, d: str) -> DataFrame:
    """A model of twelve trees, fitted on all rows before the split date: figures before and after it."""
    split = E.temporal_split(stored(_rows(spark, d).select("match_id", "perspective", "match_date", "win", *FEATURES)))
    model = B.fit(split.where("is_test = 0"), FEATURES, rounds=12, step=0.3)
    return E.metrics(stored(B.score(model, split).select("is_test", "win", "p")), ["is_test"], "win")
