"""Command line: players, model training, pair prediction, table status; JSON on stdout.

python -m matchloom.plans.cli players --tables DIR
python -m matchloom.plans.cli train --tables DIR --model PATH
python -m matchloom.plans.cli predict --tables DIR --player1 A --player2 B --date 2025-01-01 [--model PATH] [--age GROUP] [--periods 12]
python -m matchloom.plans.cli status --tables DIR [--write-manifest]
python -m matchloom.plans.cli build --tables DIR [--pages DIR] [--archive ZIP] [--rankings CSV] [--skip-matches] [--skip-rankings] [--skip-dataset] [--skip-training] [--check-only]
python -m matchloom.plans.cli bootstrap --source CSV --output DIR

DIR is a workbook folder with the tables ``players`` (player_id, full_name), ``matches`` and ``ratings``; only training and
forecasts by a model need the last. Without ``--model`` there is no forecast, only the history of both players.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ..operators import forecast as P
from ..operators import history as H
from ..operators import models as M
from ..operators import serve as S
from ..operators.assemble import long_features
from ..sources.tables import manifest, read_sheet, records_json
from .build import STEPS, bootstrap, build


def _records(df: DataFrame) -> list:
    """All rows, in order; fetched a partition at a time."""
    return [json.loads(r[0]) for r in records_json(df).toLocalIterator()]


def train(spark: SparkSession, folder: str, path: str) -> list:
    """Fits the logistic model on all matches before the last three months, saves it at ``path``; its metrics after them."""
    long = long_features(read_sheet(spark, folder, "matches"), read_sheet(spark, folder, "ratings"))
    model, quality = M.train_and_evaluate(long, M.BASELINE, M.logistic(M.BASELINE))
    model.write().overwrite().save(path)
    return _records(quality)


def predict(spark: SparkSession, folder: str, one: str, two: str, date: str, model: str | None = None, age: str | None = None, periods: int = 12) -> dict:
    """Profiles, matches, ratings, meetings, common opponents and the pair's pseudo-probability before ``date``; candidates where a name isn't unique.

    With the path of a saved ``model`` also its forecast, feature rows, contributions and the timeline of forecasts at earlier dates.
    """
    people = read_sheet(spark, folder, "players")
    found = []
    for name in (one, two):
        best = S.resolve_names(people, name).collect()
        exact = [r for r in best if r.exact]
        if len(exact) != 1 and len(best) != 1:
            return {"error": "name not resolved", "name": name, "candidates": [r.full_name for r in best]}
        found.append((exact or best)[0].player_id)
    matches = read_sheet(spark, folder, "matches")
    long = H.perspectives(matches)
    both = long.where(S.F.col("player_id").isin(*found))
    try:
        ratings = read_sheet(spark, folder, "ratings")
    except AnalysisException:
        if model:
            raise
        ratings = None
    report = S.common_opponents_report(long, *found, date)
    out = {
        "players": found,
        "profiles": _records(S.player_profiles(long, date).where(S.F.col("player_id").isin(*found))),
        "recent": _records(S.recent_matches(both, date)),
        "history": _records(S.history_until(both, date).select("player_id", "match_date", "match_id", "opponent_id", "win").orderBy("player_id", "match_date", "match_id")),
        "rating_history": [] if ratings is None else _records(P.rating_history(ratings, found)),
        "rated_profiles": [] if ratings is None else _records(S.rated_profiles(matches, ratings, date).where(S.F.col("player_id").isin(*found)).orderBy("player_id")),
        "head_to_head": _records(S.h2h_detail(long, *found, date).orderBy("match_date", "match_id")),
        "head_to_head_summary": _records(S.meeting_summary(matches.where(S.F.col("player1_id").isin(*found) & S.F.col("player2_id").isin(*found)), date)),
        "common_opponents": _records(report.orderBy(S.F.desc("weight"), "common_id")),
        "signal": _records(S.signal(report)),
    }
    if model:
        got = P.forecast(matches, ratings, PipelineModel.load(model), *found, dt.date.fromisoformat(date), age, periods)
        chance = got["forecast"].first()
        out |= {"p_player1_win": chance.p1, "p_player2_win": chance.p2, **{k: _records(got[k]) for k in ("rows", "timeline", "contributions")}}
    return out


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="matchloom")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("players", "train", "predict", "status"):
        c = commands.add_parser(name)
        c.add_argument("--tables", required=True)
        if name == "status":
            c.add_argument("--write-manifest", action="store_true")
        if name == "train":
            c.add_argument("--model", required=True)
        if name == "predict":
            for option in ("--player1", "--player2", "--date"):
                c.add_argument(option, required=True)
            c.add_argument("--model")
            c.add_argument("--age")
            c.add_argument("--periods", type=int, default=12)
    c = commands.add_parser("build")
    c.add_argument("--tables", required=True)
    for option in ("--pages", "--archive", "--rankings"):
        c.add_argument(option)
    for step in STEPS:
        c.add_argument(f"--skip-{step}", action="store_true")
    c.add_argument("--check-only", action="store_true")
    c = commands.add_parser("bootstrap")
    c.add_argument("--source", required=True)
    c.add_argument("--output", required=True)
    a = parser.parse_args(argv)
    spark = SparkSession.builder.appName("matchloom").getOrCreate()
    if a.command == "players":
        out = _records(read_sheet(spark, a.tables, "players").select("player_id", "full_name").orderBy("full_name", "player_id"))
    elif a.command == "train":
        out = train(spark, a.tables, a.model)
    elif a.command == "predict":
        out = predict(spark, a.tables, a.player1, a.player2, a.date, a.model, a.age, a.periods)
    elif a.command == "build":
        out = build(spark, a.tables, a.pages, a.rankings, tuple(x for x in STEPS if getattr(a, f"skip_{x}")), a.check_only, a.archive)
    elif a.command == "bootstrap":
        out = {"master": bootstrap(spark, a.source, a.output)}
    else:
        out = json.loads(manifest({t: read_sheet(spark, a.tables, t) for t in ("players", "matches")}))
        if a.write_manifest:
            spark.createDataFrame([(json.dumps(out, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(f"{a.tables}/manifest")
    json.dump(out, sys.stdout, ensure_ascii=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
