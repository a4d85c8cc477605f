"""From saved pages and ranking files to the workbook that prediction reads, in steps that can be left out."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import parse_date
from ..functions.score import score_features
from ..operators import enrich as N
from ..operators.master import legacy_master, merge_master
from ..operators.matching import ambiguous_names, match_names
from ..sources import pages as P
from ..sources import tables as S
from ..sources import versions as V

STEPS = ("matches", "rankings", "dataset", "training")


def raw_matches(pages: DataFrame) -> DataFrame:
    """Match records of all pages with their tournament and the score's features, numbered within their page."""
    rows = P.page_matches(pages).join(P.page_metadata(pages), "page_id")
    named = rows.select(
        "page_id", F.col("number").cast("int").alias("number"), F.coalesce(parse_date(F.col("date")), parse_date(F.col("tournament_start_text"))).alias("match_date"), F.col("player1").alias("player1_raw"), F.col("player2").alias("player2_raw"),
        F.col("score").alias("score_raw"), F.col("detail").alias("detailed_raw"), F.col("draw").alias("draw_type"), "status", "tournament_name", "tournament_city", "tournament_age_category",
    )
    return score_features(named).withColumns({"result_sets": F.col("detailed_raw"), "summary_score_raw": F.col("score_raw")})


def _exists(read) -> bool:
    try:
        read()
        return True
    except AnalysisException:
        return False


def build(spark: SparkSession, folder: str, pages: str | None = None, rankings: str | None = None, skip: tuple[str, ...] = (), check_only: bool = False, archive: str | None = None) -> dict[str, str]:
    """Runs the steps that aren't skipped and says what became of each; ``check_only`` says which could run."""
    can = {
        "matches": pages is not None and _exists(lambda: S.read_saved_pages(spark, pages, archive or pages)),
        "rankings": rankings is not None and _exists(lambda: S.read_rankings(spark, rankings)),
    }
    have = {t: _exists(lambda t=t: S.read_sheet(spark, folder, t)) for t in ("matches_raw", "ratings", "matches")}
    can["dataset"] = (have["matches_raw"] or can["matches"]) and (have["ratings"] or can["rankings"])
    can["training"] = have["matches"] or can["dataset"]
    report = {}
    for step in STEPS:
        if step in skip or not can[step]:
            report[step] = "skipped" if step in skip else "no input"
            continue
        report[step] = "ready" if check_only else "done"
        if check_only:
            continue
        if step == "matches":
            S.write_workbook({"matches_raw": raw_matches(S.read_saved_pages(spark, pages, archive or pages))}, folder)
        elif step == "rankings":
            S.write_workbook({"ratings": S.read_rankings(spark, rankings).withColumn("player_id", F.col("rni"))}, folder)
        elif step == "dataset":
            dataset(spark, folder)
        else:
            from .cli import train

            train(spark, folder, f"{folder}/model")
    return report


def dataset(spark: SparkSession, folder: str) -> None:
    """The enriched matches and their audits, and the tables that prediction reads."""
    raw, ratings = S.read_sheet(spark, folder, "matches_raw"), S.read_sheet(spark, folder, "ratings")
    people = ratings.groupBy("player_id").agg(F.max_by("full_name", "classification_date").alias("full_name"))
    names = raw.select(F.explode(F.array("player1_raw", "player2_raw")).alias("raw_name"))
    S.write_workbook({"players": people, "player_matching": match_names(names, people)}, folder)
    audit = S.read_sheet(spark, folder, "player_matching")
    enriched, bad, twice = N.matches_enriched(raw, audit, ratings, ["match_date", "page_id", "number"])
    S.write_workbook({"matches_enriched": enriched, "dropped_invalid": bad, "dropped_duplicates": twice, "ambiguous_players": ambiguous_names(audit)}, folder)
    kept = S.read_sheet(spark, folder, "matches_enriched")
    known = kept.where("player1_id is not null and player2_id is not null")
    table = N.match_table(known, ["page_id", "number"]).select(F.col("row_id").alias("match_id"), "match_date", "player1_id", "player2_id", "winner_player1", "games_diff", F.col("tournament_age_category").alias("age_category"))
    without = N.players_without_rating(kept, ["match_date", "tournament_name", "player1_raw", "player1_id", "player2_raw", "player2_id"])
    check = N.age_group_check(kept.withColumn("match_id", F.concat_ws(":", "page_id", "number")))
    S.write_workbook({"matches": table, "players_without_rating": without, "age_group_check": check}, folder)


def bootstrap(spark: SparkSession, source: str, output: str) -> int:
    """The rows of an older list merged into the master table in ``output``, as its next version; the number of its rows."""
    where, now = f"{output}/master", F.lit(datetime.now(UTC).isoformat()).cast("timestamp")
    before = V.current_version(spark, where)
    incoming = legacy_master(spark.read.option("header", True).csv(source), source.rstrip("/").rpartition("/")[2], now)
    V.publish(merge_master(V.read_version(spark, where, before) if before else None, incoming, now), where, before)
    return V.read_version(spark, where).count()
