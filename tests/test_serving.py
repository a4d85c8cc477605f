import datetime as dt
import json
import zipfile

from pyspark.sql import functions as F

from matchloom.operators import evaluate as E
from matchloom.operators import history as H
from matchloom.operators import models, serve
from matchloom.operators.assemble import long_features
from matchloom.plans.cli import main, predict
from matchloom.sources import tables
from matchloom.streaming.windows import event_windows, running_pairs

D = dt.date


def sample(spark, n=60):
    rows = [(i, D(2025, 1, 1) + dt.timedelta(days=i), i % 5, (i + 1 + i % 3) % 5, int(i % 4 != 0), float(i % 7 - 3)) for i in range(n) if i % 5 != (i + 1 + i % 3) % 5]
    return spark.createDataFrame(rows, "match_id long, match_date date, player1_id long, player2_id long, winner_player1 int, games_diff double")


def test_predict_payload(spark, tmp_path):
    people = spark.createDataFrame([(i, f"Player {'ABCDE'[i]}") for i in range(5)], "player_id long, full_name string")
    tables.write_workbook({"players": people, "matches": sample(spark)}, str(tmp_path))
    out = predict(spark, str(tmp_path), "player a", "Player B", "2025-02-15")
    assert out["players"] == [0, 1] and len(out["profiles"]) == 2 and len(out["signal"]) == 1
    assert "candidates" in predict(spark, str(tmp_path), "player", "Player B", "2025-02-15")
    assert json.loads(tables.manifest({"players": people}))["players"]["rows"] == 5


def test_lists_are_whole(spark, tmp_path):
    people = spark.createDataFrame([(i, f"Player {i:03d}") for i in range(303)], "player_id long, full_name string")
    meetings = [(i, D(2024, 1, 1) + dt.timedelta(days=i), 0, 1, i % 2, 1.0) for i in range(150)]
    others = [(1000 + 2 * k + side, D(2024, 1, 1), side, k, 1, 1.0) for k in range(2, 152) for side in (0, 1)]
    matches = spark.createDataFrame(meetings + others, "match_id long, match_date date, player1_id long, player2_id long, winner_player1 int, games_diff double")
    tables.write_workbook({"players": people, "matches": matches}, str(tmp_path))
    out = predict(spark, str(tmp_path), "Player 000", "Player 001", "2025-02-15")
    assert [r["match_id"] for r in out["head_to_head"]] == list(range(150))
    assert len(out["common_opponents"]) == 150 == out["signal"][0]["n_common"]


def test_players_are_whole(spark, tmp_path, capsys):
    tables.write_workbook({"players": spark.range(100_001).selectExpr("id as player_id", "concat('Player ', id) as full_name")}, str(tmp_path))
    assert main(["players", "--tables", str(tmp_path)]) == 0
    assert len(json.loads(capsys.readouterr().out)) == 100_001


def test_model_forecasts(spark, tmp_path):
    matches = sample(spark, 120).withColumn("age_category", F.lit("u17"))
    rated = [(p, "u17", D(2024, 12, 1) + dt.timedelta(days=30 * m), 100.0 * (p + 1) + 7 * m * (p % 2), p + 1, 9, 4) for p in range(4) for m in range(5)]
    ratings = spark.createDataFrame(rated, "player_id long, age_group string, classification_date date, points double, place int, total_tournaments int, counting_tournaments int")
    people = spark.createDataFrame([(i, f"Player {'ABCDE'[i]}") for i in range(5)], "player_id long, full_name string")
    tables.write_workbook({"players": people, "matches": matches, "ratings": ratings}, str(tmp_path / "t"))
    # a pair that meets on the asked date: the feature table's own row knows just what the forecast may know
    long = long_features(matches, ratings)
    meeting = long.where("perspective = 'player1' and match_date > date '2025-03-10' and player_id < 4 and opponent_id < 4").orderBy("match_date").first()
    features = ["elo_diff", "diff_points_pre_observed_only", "h2h_win_rate_before", "common_opp_weighted_edge"]
    model, _ = models.train_and_evaluate(long, features, models.logistic(features), months=1)
    model.write().overwrite().save(str(tmp_path / "m"))
    out = predict(spark, str(tmp_path / "t"), f"Player {'ABCDE'[meeting.player_id]}", f"Player {'ABCDE'[meeting.opponent_id]}", str(meeting.match_date), str(tmp_path / "m"), "u17")
    rows = {r["perspective"]: r for r in out["rows"]}
    same = ["matches_pre", "win_rate_pre", "rest_days", "form5_partial", "form10_full", "h2h_matches_before", "h2h_wins_before", "opp_elo_last_5", "schedule_strength", "player_points_pre", "opponent_rank_pre", "player_points_per_counting_pre", "both_points_observed_pre"]
    for want in long.where(F.col("match_id") == meeting.match_id).collect():
        for c in [*same, *(c for c in long.columns if c.startswith(("common_opp", "diff_", "rel_")))]:
            a, b = rows[want.perspective][c], want[c]
            assert (a is None and b is None) or abs(a - b) < 1e-9, (c, a, b)
    served = H.elo(matches, preset=H.SERVE_ELO).where(F.col("match_id") == meeting.match_id).first()
    assert abs(rows["player1"]["elo_pre"] - served.elo1_pre) < 1e-9 and abs(rows["player2"]["elo_pre"] - served.elo2_pre) < 1e-9
    p = (rows["player1"]["p"] + 1 - rows["player2"]["p"]) / 2
    assert abs(out["p_player1_win"] - p) < 1e-12 and abs(out["p_player1_win"] + out["p_player2_win"] - 1) < 1e-12
    assert {c["feature"] for c in out["contributions"]} == set(features) and any(c["effect"] for c in out["contributions"])
    assert 2 <= len(out["timeline"]) <= 12 and len({t["p1"] for t in out["timeline"]}) > 1
    assert out["timeline"][-1]["on_date"] == str(meeting.match_date) and abs(out["timeline"][-1]["p1"] - p) < 1e-12
    assert len(out["rating_history"]) == 10 and len(out["history"]) == rows["player1"]["matches_pre"] + rows["player2"]["matches_pre"]


def test_history_ends_before_the_date(spark):
    long = H.perspectives(sample(spark))
    assert serve.history_until(long, "2025-01-10").agg(F.max("match_date")).first()[0] < D(2025, 1, 10)


def test_readers(spark, tmp_path):
    (tmp_path / "r.csv").write_text("place,fio,rni,points,age_group_filter,ranking_date\n7,Иванов Петр,42.0,10,до17,01.02.2025\n3,Иванов Петр,42,11,до 17,01.02.2025\n1,Нет Ид,,5,до 17,01.02.2025\n", encoding="utf-8")
    r = tables.read_rankings(spark, str(tmp_path / "r.csv")).collect()
    assert [(x.rni, x.place, x.name_key, x.classification_date) for x in r] == [("42", 3.0, "иванов п", D(2025, 2, 1))]
    with zipfile.ZipFile(tmp_path / "p.zip", "w") as z:
        z.writestr("b.html", "<p>x")
        z.writestr("c.txt", "no")
    assert [x.html for x in tables.read_zipped_pages(spark, str(tmp_path / "p.zip")).collect()] == ["<p>x"]


def test_logistic_model(spark):
    long = H.with_elo(H.head_to_head(H.player_windows(H.perspectives(sample(spark, 200)))), H.elo(sample(spark, 200)))
    _, m = models.train_and_evaluate(long, ["elo_diff", "h2h_win_rate_before", "win_rate_pre"], models.logistic(["elo_diff", "h2h_win_rate_before", "win_rate_pre"]))
    assert {r.level for r in m.collect()} == {"row", "match"} and all(0 <= r.roc_auc <= 1 for r in m.collect())


def test_symmetrised_sums_to_one(spark):
    df = spark.createDataFrame([(1, "player1", 0.7), (1, "player2", 0.4)], "match_id int, perspective string, p double")
    r = E.symmetrised(df).first()
    assert abs(r.p1 - 0.65) < 1e-12 and abs(r.gap - 0.1) < 1e-12


def test_streams_equal_batch(spark, tmp_path):
    events = spark.createDataFrame([(i, dt.datetime(2025, 1, 1, i % 5, 0), i % 3, "a", 1.0) for i in range(50)], "event_id long, ts timestamp, user_id long, event_type string, value double")
    events.write.parquet(str(tmp_path / "e"))
    q = event_windows(spark.readStream.schema(events.schema).parquet(str(tmp_path / "e"))).writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sum(r.n for r in spark.table("w").collect()) == 50
    m = sample(spark)
    m.write.parquet(str(tmp_path / "m"))
    q = running_pairs(spark.readStream.schema(m.schema).parquet(str(tmp_path / "m"))).writeStream.format("memory").queryName("pairs").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    want = {r.match_id: r.h2h_matches_before for r in H.head_to_head(H.perspectives(m)).collect()}
    assert {r.match_id: r.matches_before for r in spark.table("pairs").collect()} == want


def test_rated_profiles_equal_a_plain_replay(spark):
    matches = sample(spark)
    ratings = spark.createDataFrame(
        [(0, "u15", D(2025, 1, 1), 10.0, 3), (0, "u17", D(2025, 2, 1), 20.0, 2), (0, "u15", D(2025, 3, 1), 99.0, 1), (1, "u15", D(2025, 1, 1), 5.0, 9)],
        "player_id long, age_group string, classification_date date, points double, place long",
    )
    got = {r.player_id: r for r in serve.rated_profiles(matches, ratings, "2025-02-10").collect()}
    past = sorted((r for r in matches.collect() if r.match_date < D(2025, 2, 10)), key=lambda r: (r.match_date, r.match_id))
    before = {r.match_id: r for r in H.elo(matches, preset=H.SERVE_ELO).collect()}
    assert set(got) == {p for r in past for p in (r.player1_id, r.player2_id)}
    for p, r in got.items():
        mine = [m for m in past if p in (m.player1_id, m.player2_id)]
        wins = [m.winner_player1 if m.player1_id == p else 1 - m.winner_player1 for m in mine]
        against = [before[m.match_id].elo2_pre if m.player1_id == p else before[m.match_id].elo1_pre for m in mine]
        assert (r.matches, r.wins, r.last_date, r.rest_days) == (len(mine), sum(wins), mine[-1].match_date, (D(2025, 2, 10) - mine[-1].match_date).days)
        assert abs(r.form5 - sum(wins[-5:]) / len(wins[-5:])) < 1e-9 and abs(r.opponent_elo_last5 - sum(against[-5:]) / len(against[-5:])) < 1e-9
        later = [m for m in matches.collect() if m.match_date >= D(2025, 2, 10) and p in (m.player1_id, m.player2_id)]
        first = min(later, key=lambda m: (m.match_date, m.match_id))  # its rating then is the one by the asked date
        assert abs(r.elo - (before[first.match_id].elo1_pre if first.player1_id == p else before[first.match_id].elo2_pre)) < 1e-9
    assert (got[0].points, got[0].rank, got[0].rating_age_group) == (20.0, 2, "u17") and got[1].rank == 9 and got[2].rank is None
    assert serve.rated_profiles(matches, ratings, "2020-01-01").count() == 0


def test_meetings_of_a_pair(spark):
    matches = sample(spark)
    past = [r for r in matches.collect() if r.match_date < D(2025, 2, 10) and {r.player1_id, r.player2_id} == {0, 1}]
    rows = serve.meetings(H.perspectives(matches), 1, 0, "2025-02-10").collect()
    assert len(rows) == 2 * len(past) and sum(r.win for r in rows) == len(past) and [r.match_date for r in rows] == sorted(r.match_date for r in rows)
    one = serve.meeting_summary(matches, "2025-02-10").where("player_id = 0 and opponent_id = 1").first()
    wins = [(r.winner_player1 == 1) == (r.player1_id == 0) for r in past]
    assert (one.matches, one.wins, one.losses) == (len(past), sum(wins), len(past) - sum(wins))
    newest = max(range(len(past)), key=lambda i: (past[i].match_date, past[i].match_id))
    assert one.last_winner == (0 if wins[newest] else 1)


def test_names_go_to_who_played_last(spark):
    rows = [(1, "Anna Bell", D(2025, 1, 1)), (2, "ANNA  BELL", D(2025, 3, 1)), (1, "Anna Bell", D(2025, 2, 1)), (3, "Anna Bella", D(2025, 9, 1)), (4, None, D(2025, 9, 1)), (5, "Zoe", None)]
    df = spark.createDataFrame(rows, "player_id long, player_name string, match_date date")
    got = {r.asked: r for r in serve.latest_of_names(df, ["anna bell", " BELL", "zoe", "nobody", ""]).collect()}
    assert (got["anna bell"].player_id, got["anna bell"].exact, got["anna bell"].candidates) == (2, True, 2)  # not the one whose name only contains it
    assert (got["BELL"].player_id, got["BELL"].exact, got["BELL"].candidates) == (3, False, 3)
    assert got["zoe"].player_id == 5 and got["nobody"].player_id is None and got["nobody"].candidates == 0 and len(got) == 4
    assert serve.latest_of_names(df, []).count() == 0


def test_scales_need_ten_rows_and_both_classes(spark):
    few = spark.createDataFrame([(float(i), float(i % 2)) for i in range(9)], "diff double, y double")
    one = spark.createDataFrame([(float(i), 1.0) for i in range(20)], "diff double, y double")
    enough = spark.createDataFrame([(float(i), float(i % 2)) for i in range(10)], "diff double, y double")
    assert E.scale_grid(few, "diff", [10.0]).count() == 0 and E.scale_grid(one, "diff", [10.0]).count() == 0 and E.scale_grid(enough, "diff", [10.0, 20.0]).count() == 2


def test_long_features_exchange_wide_rows_by_player_and_by_match(spark):
    ratings = spark.createDataFrame([(1, "u17", D(2024, 12, 1), 5.0, 1, 9, 4)], "player_id long, age_group string, classification_date date, points double, place int, total_tournaments int, counting_tournaments int")
    out = long_features(sample(spark, 40).withColumn("age_category", F.lit("u17")), ratings)
    plan = [line for line in out._jdf.queryExecution().executedPlan().toString().splitlines() if " Exchange " in line]
    assert not any("hashpartitioning(_low" in line or "perspective" in line for line in plan)
    assert len([line for line in plan if "hashpartitioning(player_id" in line and "REPARTITION_BY_COL" in line]) == 1 and out.count() == 80
