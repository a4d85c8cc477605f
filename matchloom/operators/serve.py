"""Point-in-time reports of players and pairs; history ends before the asked date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import normalize_player_name
from .history import elo_until
from .keyed import rating_snapshot


def history_until(long: DataFrame, at: str) -> DataFrame:
    return long.where(F.col("match_date") < F.lit(at).cast("date"))


def _latest_first(long: DataFrame) -> DataFrame:
    w = Window.partitionBy("player_id").orderBy(F.desc("match_date"), F.desc("match_id"))
    return long.withColumn("_rn", F.row_number().over(w))


def player_profiles(long: DataFrame, at: str) -> DataFrame:
    h = _latest_first(history_until(long, at))
    form = lambda n: F.round(F.avg(F.when(F.col("_rn") <= n, F.col("win"))), 6)
    return h.groupBy("player_id").agg(
        F.count("*").alias("matches"), F.sum("win").cast("long").alias("wins"), F.round(F.avg("win"), 6).alias("win_rate"), form(10).alias("form10"), form(5).alias("form5"),
        F.max("match_date").alias("last_date"), F.countDistinct("opponent_id").alias("opponents"),
    )


def rated_profiles(matches: DataFrame, ratings: DataFrame, at: str) -> DataFrame:
    """Every player who played before ``at``: record, form, rest, rating by one replay, strength of the last five opponents,
    and the newest ranking (of any age group) on that date."""
    day = F.lit(at).cast("date")
    rows = elo_until(matches, day)
    played = F.col("match_id").isNotNull()
    w = Window.partitionBy("player_id").orderBy(played, F.desc("match_date"), F.desc("match_id"))
    rows = rows.withColumn("_rn", F.row_number().over(w) - 1)  # the row without a match is first
    last = lambda c, n: F.avg(F.when(played & (F.col("_rn") <= n), F.col(c)))
    known = rows.groupBy("player_id").agg(
        F.count("match_id").alias("matches"), F.sum("win").cast("long").alias("wins"), F.avg("win").alias("win_rate"), last("win", 5).alias("form5"), last("win", 10).alias("form10"),
        F.max(F.when(played, F.col("match_date"))).alias("last_date"), last("opponent_elo", 5).alias("opponent_elo_last5"), F.max(F.when(~played, F.col("elo"))).alias("elo"),
    ).withColumn("rest_days", F.datediff(day, "last_date"))
    asked = known.select(F.col("player_id").alias("request_id"), "player_id", day.alias("at"), F.lit(None).cast("string").alias("age"))
    ranked = rating_snapshot(asked, ratings).select("player_id", F.col("place").alias("rank"), "points", F.col("classification_date").alias("rating_date"), F.col("age_group").alias("rating_age_group"))
    return known.join(ranked, "player_id", "left")


def meetings(long: DataFrame, one: object, two: object, at: str) -> DataFrame:
    """A pair's matches before ``at``, a row for each side."""
    sides = h2h_detail(long, one, two, at).unionByName(h2h_detail(long, two, one, at))
    return sides.distinct().orderBy("match_date", "match_id", "player_id")


def meeting_summary(matches: DataFrame, at: str) -> DataFrame:
    """Every pair that met before ``at``, smaller id first: matches, wins of either, difference of games, last date and its winner."""
    low = F.col("player1_id") < F.col("player2_id")
    turned = history_until(matches, at).where("player1_id is not null and player2_id is not null").select(
        F.least("player1_id", "player2_id").alias("player_id"), F.greatest("player1_id", "player2_id").alias("opponent_id"), "match_date", "match_id",
        F.when(low, F.col("winner_player1")).otherwise(1 - F.col("winner_player1")).alias("win"), F.when(low, F.col("games_diff")).otherwise(-F.col("games_diff")).alias("games"),
    )
    return turned.groupBy("player_id", "opponent_id").agg(
        F.count("*").alias("matches"), F.sum("win").cast("long").alias("wins"), F.sum(1 - F.col("win")).cast("long").alias("losses"), F.sum("games").alias("games_diff"), F.max("match_date").alias("last_date"),
        F.max_by(F.when(F.col("win") == 1, F.col("player_id")).when(F.col("win") == 0, F.col("opponent_id")), F.struct("match_date", "match_id")).alias("last_winner"),
    )


def recent_matches(long: DataFrame, at: str, n: int = 10) -> DataFrame:
    return _latest_first(history_until(long, at)).where(F.col("_rn") <= n).select("player_id", "match_date", "match_id", "opponent_id", "win")


def h2h_detail(long: DataFrame, player: object, opponent: object, at: str) -> DataFrame:
    pair = (F.col("player_id") == F.lit(player)) & (F.col("opponent_id") == F.lit(opponent))
    return history_until(long, at).where(pair).select("match_id", "match_date", "player_id", "opponent_id", "win")


def common_opponents_report(long: DataFrame, player: object, opponent: object, at: str, fold_days: float = 180.0) -> DataFrame:
    """Each opponent of both: matches and wins of either, the edge of win rates, its weight."""
    h = history_until(long, at)

    def side(who: object, other: object, tag: str) -> DataFrame:
        mine = h.where((F.col("player_id") == F.lit(who)) & (F.col("opponent_id") != F.lit(other)))
        return mine.groupBy(F.col("opponent_id").alias("common_id")).agg(F.count("*").alias(f"{tag}_matches"), F.sum("win").cast("long").alias(f"{tag}_wins"), F.max("match_date").alias(f"{tag}_last"))

    j = side(player, opponent, "player").join(side(opponent, player, "opponent"), "common_id")
    days = F.datediff(F.lit(at).cast("date"), F.greatest("player_last", "opponent_last"))
    edge = F.col("player_wins") / F.col("player_matches") - F.col("opponent_wins") / F.col("opponent_matches")
    weight = F.exp(-days / F.lit(fold_days)) * F.sqrt(F.least("player_matches", "opponent_matches").cast("double"))
    return j.select("common_id", "player_matches", "player_wins", "opponent_matches", "opponent_wins", F.round(edge, 6).alias("edge"), F.round(weight, 6).alias("weight"))


def signal(report: DataFrame) -> DataFrame:
    """The weighted edge of a report and its pseudo-probability."""
    edge = F.try_divide(F.sum(F.col("edge") * F.col("weight")), F.sum("weight"))
    return report.agg(F.count("*").alias("n_common"), edge.alias("weighted_edge")).withColumn("pseudo_probability", F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.5 + 0.5 * F.col("weighted_edge"))))


def probability_timeline(long: DataFrame, player: object, opponent: object, first: str, last: str) -> DataFrame:
    """Both players' win rates before each month start, and the pseudo-probability; all dates in one job."""
    dates = long.sparkSession.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 month"))).alias("on_date"))
    two = long.where(F.col("player_id").isin(player, opponent))
    rate = lambda who: F.avg(F.when(F.col("player_id") == F.lit(who), F.col("win")))
    # the dates are a handful by construction
    j = two.join(F.broadcast(dates), F.col("match_date") < F.col("on_date")).groupBy("on_date").agg(rate(player).alias("a"), rate(opponent).alias("b"))
    return j.select("on_date", F.round("a", 6).alias("player1_rate"), F.round("b", 6).alias("player2_rate"), F.round(0.5 + 0.5 * (F.col("a") - F.col("b")), 6).alias("p1"))


def resolve_names(people: DataFrame, asked: str, most: int = 10) -> DataFrame:
    """Exact matches of the lower-cased name first, else names that contain it."""
    name, want = F.lower(F.trim("full_name")), asked.strip().lower()
    return people.where(name.contains(want)).withColumn("exact", (name == want).cast("int")).orderBy(F.desc("exact"), "full_name", "player_id").limit(most)


def latest_of_names(directory: DataFrame, asked: Sequence[str]) -> DataFrame:
    """For each asked name the player (player_id, player_name, match_date) of that name, else of one that contains it, who played last; how many
    players come into question. Ties of the date go to the greater id; a name that nobody has gives a row without a player."""
    names = sorted({a.strip() for a in asked if a and a.strip()})
    norm = normalize_player_name(F.col("player_name"))
    wanted = directory.sparkSession.createDataFrame([(n,) for n in names], "asked string")
    known = F.array(*[F.struct(F.lit(n).alias("asked"), normalize_player_name(F.lit(n)).alias("norm")) for n in names]) if names else F.array().cast("array<struct<asked string, norm string>>")
    hits = directory.withColumn("_name", norm).select("player_id", "player_name", "match_date", "_name", F.explode(F.filter(known, lambda k: F.col("_name").contains(k["norm"]))).alias("_k"))
    # one row a name, player and kind of hit goes to the exchange, however many matches a player has
    found = hits.groupBy(F.col("_k.asked").alias("asked"), (F.col("_name") == F.col("_k.norm")).alias("exact"), "player_id").agg(F.max(F.struct("match_date", "player_name")).alias("_last"))
    best = found.groupBy("asked", "exact").agg(F.max(F.struct(F.col("_last.match_date").alias("match_date"), "player_id", F.col("_last.player_name").alias("player_name"))).alias("_b"), F.count("*").alias("candidates"))
    one = best.groupBy("asked").agg(F.max_by(F.struct("_b", "candidates"), "exact").alias("_o"), F.max("exact").alias("exact"))
    return wanted.join(one, "asked", "left").select("asked", "exact", F.col("_o._b.player_id").alias("player_id"), F.col("_o._b.player_name").alias("player_name"), F.col("_o._b.match_date").alias("match_date"), F.coalesce("_o.candidates", F.lit(0)).alias("candidates"))


def factor_contributions(rows: DataFrame, medians: dict[str, float], score, features: list[str]) -> DataFrame:
    """Score change when each feature is set to its median; ``score`` maps a DataFrame to one with ``p``. All are scored at once."""
    ablated = rows.withColumn("feature", F.explode(F.array(F.lit(""), *[F.lit(f) for f in features])))
    ablated = ablated.withColumns({f: F.when(F.col("feature") == f, F.lit(float(medians[f]))).otherwise(F.col(f)) for f in features})
    p = score(ablated).groupBy("feature").agg(F.avg("p").alias("p"))
    base = p.where("feature = ''").select(F.col("p").alias("base"))
    return p.where("feature <> ''").crossJoin(F.broadcast(base)).select("feature", (F.col("base") - F.col("p")).alias("effect")).orderBy(F.desc(F.abs("effect")), "feature")
