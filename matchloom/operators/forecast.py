"""Model forecasts of a pair: point-in-time rows of both sides, score, symmetrised chance, contributions.

A request is (request_id, on_date, age); all requests of a pair are built and scored together. History ends
before ``on_date``, ratings at it. Columns are named as in :func:`assemble.long_features`, on which models train.
"""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import repair_month_start
from . import history as H
from .assemble import OPPONENT_SIDE, rating_columns
from .enrich import opponent_side
from .evaluate import symmetrised
from .keyed import rating_snapshot
from .models import with_score
from .serve import factor_contributions

REQUEST = "request_id long, on_date date, age string"


def rating_history(ratings: DataFrame, players: list) -> DataFrame:
    """All distinct ratings of the players, oldest first."""
    mine = ratings.where(F.col("player_id").isin(*players)).withColumn("classification_date", repair_month_start(F.col("classification_date")))
    keep = mine.select("player_id", "classification_date", "age_group", F.col("place").alias("rank"), "points", *[c for c in ("total_tournaments", "counting_tournaments") if c in ratings.columns])
    return keep.where("classification_date is not null").distinct().orderBy("player_id", "classification_date", "age_group")


def _elo_at(matches: DataFrame, requests: DataFrame, one: object, two: object) -> DataFrame:
    """request_id and both sides' ratings by one replay of all matches; asked pairs have no result and come first on their date."""
    kinds = dict(matches.dtypes)
    cols = lambda real, i, request: F.struct(F.lit(real).alias("real"), i.cast(kinds["match_id"]).alias("id"), request.cast("long").alias("request_id")).alias("match_id")
    none = F.lit(None)
    rest = ("player1_id", "player2_id", "winner_player1", "games_diff", "match_date")
    games = F.col("games_diff") if "games_diff" in kinds else none.cast("double")
    played = matches.select(cols(1, F.col("match_id"), none), "player1_id", "player2_id", F.col("winner_player1").cast("double").alias("winner_player1"), games.cast("double").alias("games_diff"), "match_date")
    asked = requests.select(cols(0, none, F.col("request_id")), F.lit(one).cast(kinds["player1_id"]), F.lit(two).cast(kinds["player2_id"]), none.cast("double"), none.cast("double"), "on_date").toDF("match_id", *rest)
    out = H.elo(played.union(asked), preset=H.SERVE_ELO).where("match_id.real = 0")
    return out.select(F.col("match_id.request_id").alias("request_id"), "elo1_pre", "elo2_pre", "expected1")


def pair_rows(matches: DataFrame, ratings: DataFrame, one: object, two: object, requests: DataFrame) -> DataFrame:
    """Two rows a request, one for each side, with the features known on its date."""
    id_kind = dict(matches.dtypes)["player1_id"]
    side = lambda name, a, b: F.struct(F.lit(name).alias("perspective"), F.lit(a).cast(id_kind).alias("player_id"), F.lit(b).cast(id_kind).alias("opponent_id"))
    rows = requests.select("*", F.explode(F.array(side("player1", one, two), side("player2", two, one))).alias("_s")).select("request_id", "on_date", "age", "_s.*")
    long = H.perspectives(matches)
    mine = H.with_elo(long.where(F.col("player_id").isin(one, two)), H.elo(matches))
    # requests are a handful by construction
    past = mine.join(F.broadcast(requests.select("request_id", "on_date")), F.col("match_date") < F.col("on_date"))

    newest = past.withColumn("_rn", F.row_number().over(Window.partitionBy("request_id", "player_id").orderBy(F.desc("match_date"), F.desc("match_id"))))
    last = lambda c, n: F.avg(F.when(F.col("_rn") <= n, F.col(c)))
    known = newest.groupBy("request_id", "player_id").agg(
        F.count("*").alias("matches_pre"), F.avg("win").alias("win_rate_pre"), F.max("match_date").alias("_last"), F.when(F.count("*") >= 10, last("win", 10)).alias("form10_full"), last("win", 5).alias("form5_partial"),
        last("elo_opp_pre", 10).alias("_strength"), last("elo_opp_pre", 5).alias("_last5"),
    )
    met = past.where(F.col("opponent_id").isin(one, two)).groupBy("request_id", "player_id").agg(F.count("*").alias("h2h_matches_before"), F.sum("win").cast("long").alias("h2h_wins_before"))
    out = rows.join(known, ["request_id", "player_id"], "left").join(met, ["request_id", "player_id"], "left").join(_elo_at(matches, requests, one, two), "request_id")
    first = F.col("perspective") == "player1"
    pick = lambda a, b: F.when(first, F.col(a)).otherwise(F.col(b))
    out = out.withColumns(
        {
            "match_id": F.col("request_id"), "match_date": F.col("on_date"), "matches_pre": F.coalesce("matches_pre", F.lit(0)), "rest_days": F.datediff("on_date", "_last"),
            "h2h_matches_before": F.coalesce("h2h_matches_before", F.lit(0)), "h2h_wins_before": F.coalesce("h2h_wins_before", F.lit(0)),
            "h2h_win_rate_before": F.coalesce(F.col("h2h_wins_before") / F.col("h2h_matches_before"), F.lit(0.5)),
            "elo_pre": pick("elo1_pre", "elo2_pre"), "elo_opp_pre": pick("elo2_pre", "elo1_pre"), "elo_expected": F.when(first, F.col("expected1")).otherwise(1 - F.col("expected1")),
        }
    ).withColumn("elo_diff", F.col("elo_pre") - F.col("elo_opp_pre"))
    out = out.withColumns({"schedule_strength": F.coalesce("_strength", "elo_pre"), "opp_elo_last_5": F.coalesce("_last5", "elo_opp_pre")}).drop("_last", "_strength", "_last5", "elo1_pre", "elo2_pre", "expected1")

    asked = rows.select(F.concat_ws(":", "request_id", "perspective").alias("request_id"), "player_id", F.col("on_date").alias("at"), "age", F.col("request_id").alias("_r"))
    dated = ratings.where(F.col("player_id").isin(one, two)).withColumn("classification_date", repair_month_start(F.col("classification_date")))
    rated = rating_snapshot(asked, dated, more=["counting_tournaments"])
    for who in ("player", "opponent"):
        r = rated.select(F.col("_r").alias("request_id"), F.col("player_id").alias(f"{who}_id"), F.col("classification_date").alias(f"{who}_rating_date"), F.col("points").alias(f"{who}_points_pre"), F.col("place").alias(f"{who}_rank_pre"), F.col("counting_tournaments").alias(f"{who}_counting"))
        out = out.join(r, ["request_id", f"{who}_id"], "left")
    out = rating_columns(out)

    states = past.groupBy("request_id", "on_date", "player_id", "opponent_id").agg(F.count("*").alias("n"), F.sum("win").alias("w"), F.max("match_date").alias("d")).where(~F.col("opponent_id").isin(one, two))
    a = states.select("request_id", F.col("on_date").alias("match_date"), "player_id", F.col("opponent_id").alias("s_opp"), F.col("n").alias("n_a"), F.col("w").alias("w_a"), F.col("d").alias("d_a"))
    b = states.select("request_id", F.col("player_id").alias("_other"), F.col("opponent_id").alias("s_opp"), F.col("n").alias("n_b"), F.col("w").alias("w_b"), F.col("d").alias("d_b"))
    both = a.join(b, ["request_id", "s_opp"]).where("player_id <> _other")
    common = H.opponent_totals(both, ["request_id", "player_id"])
    counts = [c for c in common.columns if c.endswith(("_count", "_sum", "_available")) and c != "common_opp_weight_sum"]
    out = opponent_side(out, OPPONENT_SIDE)
    return out.join(common, ["request_id", "player_id"], "left").fillna(0, subset=counts)


def model_features(model: PipelineModel) -> dict[str, float | None]:
    """Each feature of a saved model with the median that fills it."""
    imputer = model.stages[0]
    fill = imputer.surrogateDF.first()
    return {f: fill[f] for f in imputer.getInputCols()}


def _typed(rows: DataFrame, features: list[str]) -> DataFrame:
    return rows.withColumns({f: F.col(f).cast("double") for f in features})


def timeline_dates(long: DataFrame, one: object, two: object, end: dt.date, periods: int = 12) -> list[dt.date]:
    """Evenly spaced days from the later of both first matches to ``end``; none if either never played."""
    firsts = [r[1] for r in long.where(F.col("player_id").isin(one, two)).groupBy("player_id").agg(F.min("match_date")).collect()]
    if len(firsts) < 2 or None in firsts:
        return []
    start = max(firsts)
    if start >= end:
        return [end]
    span = (end - start).days
    return sorted({start + dt.timedelta(days=span * i // max(1, periods - 1)) for i in range(periods)} | {end})


def forecast(matches: DataFrame, ratings: DataFrame, model: PipelineModel, one: object, two: object, on: dt.date, age: str | None = None, periods: int = 12) -> dict[str, DataFrame | None]:
    """``forecast``: p1 and p2 on the date; ``rows``: both sides' features and scores; ``timeline``: p1 and p2 at earlier dates;
    ``contributions``: change of p1 when a feature of both sides is set to its median, greatest first."""
    spark = matches.sparkSession
    dates = timeline_dates(H.perspectives(matches), one, two, on, periods)
    requests = spark.createDataFrame([(0, on, age), *((i + 1, d, None) for i, d in enumerate(dates))], REQUEST)
    medians = model_features(model)
    features = list(medians)
    scored = with_score(model, _typed(pair_rows(matches, ratings, one, two, requests), features)).drop("rawPrediction", "probability", "prediction", "raw_features", "features", *[f"{f}__filled" for f in features]).cache()
    chances = symmetrised(scored)
    p = chances.join(requests.withColumnRenamed("request_id", "match_id"), "match_id").select("match_id", "on_date", F.col("p1"), (1 - F.col("p1")).alias("p2"), F.col("gap"))
    asked = scored.where("request_id = 0")

    def sides(ablated: DataFrame) -> DataFrame:
        side: Column = F.when(F.col("perspective") == "player1", F.col("p")).otherwise(1 - F.col("p"))
        return with_score(model, ablated.drop("p")).withColumn("p", side)

    return {
        "forecast": p.where("match_id = 0").drop("match_id"),
        "rows": asked,
        "timeline": p.where("match_id > 0").drop("match_id", "gap").orderBy("on_date"),
        "contributions": factor_contributions(asked, {f: m for f, m in medians.items() if m is not None}, sides, [f for f in features if medians[f] is not None]),
    }
