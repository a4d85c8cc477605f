"""The enriched match table: validity, ids, both sides' ratings, deduplication, row ids; audits made from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import normalize_age_group, normalize_text, normalize_tournament_name
from .keyed import asof_join, duplicates, first_by_key
from .matching import attach_ids

#: What makes two enriched matches one, and two rows of the match table one.
SAME_MATCH = ["match_date", "player1_raw", "player2_raw", "result_sets", "summary_score_raw", "winner_player1", "tournament_name", "tournament_city", "tournament_age_category"]
SAME_ROW = ["match_date", "player1_id", "player2_id", "result_sets", "winner_player1", "tournament_name_norm", "tournament_city", "tournament_age_category"]


def split_valid(matches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and those without a name, a date or a winner."""
    wrong = (normalize_text(F.col("player1_raw")) == "") | (normalize_text(F.col("player2_raw")) == "") | F.col("match_date").isNull() | F.col("winner_player1").isNull()
    return matches.where(~wrong), matches.where(wrong)


def attach_ratings(matches: DataFrame, ratings: DataFrame) -> DataFrame:
    """Both sides' newest rating of the match's age group at or before its date, and the differences."""
    matches = matches.withColumn("_age", normalize_age_group(F.col("tournament_age_category")))
    for side in ("player1", "player2"):
        names = {"classification_date": f"{side}_rating_date_pre", "points": f"{side}_points_pre", "place": f"{side}_rank_pre"}
        right = ratings.select(F.col("player_id").cast("string").alias(f"{side}_id"), normalize_age_group(F.col("age_group")).alias("_age"), *[F.col(a).alias(b) for a, b in names.items()], F.col("age_group").alias(f"{side}_rating_age_group_pre"))
        matches = asof_join(matches, right, [f"{side}_id", "_age"], "match_date", names["classification_date"], [*list(names.values())[1:], f"{side}_rating_age_group_pre"])
    diff = lambda c: F.col(f"player1_{c}_pre") - F.col(f"player2_{c}_pre")
    return matches.withColumns({"points_diff_pre": diff("points"), "rank_diff_pre": diff("rank")}).drop("_age")


def matches_enriched(matches: DataFrame, audit: DataFrame, ratings: DataFrame, order: Sequence[Column | str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Enriched matches without repeats (the first in ``order`` stays), the invalid rows, and all rows that repeat."""
    good, bad = split_valid(matches)
    rated = attach_ratings(attach_ids(good, audit), ratings)
    same = [c for c in SAME_MATCH if c in rated.columns]
    return first_by_key(rated, same, order), bad, duplicates(rated, same)


def row_ids(df: DataFrame, first: str, rest: Sequence[Column | str], name: str = "row_id") -> DataFrame:
    """Rows numbered from 0 in the total order (first, rest): within each value of ``first`` by itself, plus the rows of all
    values before it. Only one row a value of ``first`` (a date, say) is summed in one place.
    """
    counts = df.groupBy(first).agg(F.count("*").alias("_n"))
    before = counts.select(F.col(first).alias("_first"), (F.sum("_n").over(Window.orderBy(F.col(first).asc())) - F.col("_n")).alias("_before"))
    local = df.withColumn("_at", F.row_number().over(Window.partitionBy(first).orderBy(*rest)))
    return local.join(before, F.col(first).eqNullSafe(F.col("_first"))).withColumn(name, (F.col("_at") - 1 + F.col("_before")).cast("long")).drop("_at", "_before", "_first")


def match_table(enriched: DataFrame, rest: Sequence[Column | str]) -> DataFrame:
    """One row a match (eight columns make a match, the first by date and ``rest`` stays), numbered in that order."""
    named = enriched.withColumn("tournament_name_norm", normalize_tournament_name(F.col("tournament_name")))
    return row_ids(first_by_key(named, [c for c in SAME_ROW if c in named.columns], ["match_date", *rest]), "match_date", rest)


def players_without_rating(enriched: DataFrame, columns: Sequence[str]) -> DataFrame:
    return enriched.where("player1_points_pre is null or player2_points_pre is null").select(*columns).distinct()


def age_group_check(enriched: DataFrame) -> DataFrame:
    """A row for each match and side: does the rating's age group agree with the tournament's? No rating counts as agreeing."""
    side = lambda s: F.struct(F.lit(s).alias("side"), F.col(f"{s}_raw").alias("raw"), F.col(f"{s}_id").alias("player_id"), F.col(f"{s}_rating_age_group_pre").alias("rating_age_group"), F.col(f"{s}_points_pre").alias("points"))
    keys = ["match_id", "match_date", "tournament_age_category"]
    rows = enriched.select(*keys, F.explode(F.array(side("player1"), side("player2"))).alias("_s")).select(*keys, "_s.*")
    agrees = F.coalesce(normalize_age_group(F.col("rating_age_group")) == normalize_age_group(F.col("tournament_age_category")), F.lit(False))
    return rows.withColumn("age_group_match", agrees | F.col("points").isNull())


def opponent_side(long: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``long`` with the other side's ``columns`` (``opponent_<column>``) and the differences; one exchange by match."""
    both = Window.partitionBy("match_id")
    for c in columns:
        of = lambda side, c=c: F.max(F.when(F.col("perspective") == side, F.col(c))).over(both)
        long = long.withColumn(f"opponent_{c}", F.when(F.col("perspective") == "player1", of("player2")).otherwise(of("player1")))
        long = long.withColumn(f"diff_{c}", F.col(c) - F.col(f"opponent_{c}"))
    return long


def null_safe_merge(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """A join on keys of which nulls equal nulls; right's key columns go."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def one_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """A merge that fails at run time where a key repeats on either side."""

    def once(df: DataFrame, side: str) -> DataFrame:
        n = F.count("*").over(Window.partitionBy(*keys))
        return df.withColumn("_n", n).withColumn("_ok", F.when(F.col("_n") > 1, F.raise_error(F.lit(f"{side} keys repeat")).cast("boolean")).otherwise(True)).where("_ok").drop("_n", "_ok")

    return once(left, "left").join(once(right, "right"), list(keys), how)


def top_per_row(df: DataFrame, columns: Sequence[str], k: int, keep: Sequence[str]) -> DataFrame:
    """The k named values of each row that are greatest in size, ties by name, without an exchange."""
    cells = F.filter(F.array(*[F.struct((-F.abs(F.col(c))).cast("double").alias("o"), F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns]), lambda x: x["value"].isNotNull())
    top = F.slice(F.array_sort(cells), 1, k)
    return df.select(*keep, F.posexplode(top).alias("_p", "_x")).select(*keep, (F.col("_p") + 1).cast("long").alias("place"), F.col("_x.name").alias("name"), F.col("_x.value").alias("value"))


def seeded_sample(df: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """n rows by a hash of seed and key: the same rows whatever the partitions."""
    return df.withColumn("_h", F.md5(F.concat(F.lit(seed), F.col(key).cast("string")))).orderBy("_h", key).limit(n).drop("_h")
