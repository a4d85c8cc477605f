import datetime as dt
import math
import re

import pytest
from pyspark.sql import functions as F

from matchloom.functions import ratings as R
from matchloom.functions import text as T
from matchloom.functions.dates import parse_date, repair_month_start
from matchloom.functions.score import score_features
from matchloom.operators import evaluate as E
from matchloom.operators import history as H
from matchloom.operators import keyed as K
from matchloom.operators.matching import match_names
from matchloom.sources import pages as P

D = dt.date


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "score,detail,winner,n_sets,g1,g2,tb,dominance",
    [("2-0", "6-4,7-6(5)", 1, 2, 13, 10, 5, 3 / 23), ("1-2", "6-3,4-6,[8-10]", 0, 3, 10, 9, 18, 1 / 19), ("1-1", "6-4,4-6", None, 2, 10, 10, None, 0), ("2-0", "", 1, None, None, None, None, None)],
)
def test_score_grammar(spark, score, detail, winner, n_sets, g1, g2, tb, dominance):
    r = score_features(spark.createDataFrame([(score, detail)], "score_raw string, detailed_raw string")).first()
    assert (r.winner_player1, r.n_sets, r.total_games_p1, r.total_games_p2, r.total_points_tiebreak) == (winner, n_sets, g1, g2, tb)
    assert r.dominance_index == (None if dominance is None else pytest.approx(dominance))


def test_text(spark):
    assert one(spark, T.surname_initials_key, "Ёлкина А.Б.") == "елкина а б"
    assert one(spark, T.surname_initials_key, "Ёлкина Анна Борисовна") == "елкина а б"
    assert [one(spark, T.normalize_rni, x) for x in ("42749", "42749.0", "RNI:42749", "abc")] == ["42749", "42749", "42749", None]
    assert one(spark, T.normalize_text, " a \t b ") == "a b"
    assert one(spark, T.normalize_age_group, "до17") == "до 17 лет"
    assert one(spark, T.longest_digits, "/p/12/345/678") == "345"


def test_dates(spark):
    assert one(spark, parse_date, "с 01.02.2025 по 03.02.2025") == D(2025, 2, 1)
    assert one(spark, parse_date, "5 марта 2025 г.") == D(2025, 3, 5)
    assert one(spark, parse_date, "2025-02-01") == D(2025, 2, 1)
    assert [one(spark, repair_month_start, x, "date") for x in (D(2025, 1, 2), D(2025, 1, 1), D(2025, 1, 13))] == [D(2025, 2, 1), D(2025, 1, 1), D(2025, 1, 13)]


def test_relative_diff(spark):
    df = spark.createDataFrame([(150.0, 100.0), (100.0, 150.0), (0.0, 5.0), (None, 5.0)], "a double, b double")
    assert [r[0] for r in df.select(R.relative_diff(F.col("a"), F.col("b"))).collect()] == [50, -50, None, None]


def test_asof(spark):
    left = spark.createDataFrame([(1, "a", "U17", D(2025, 1, 9)), (2, "a", "U17", D(2025, 1, 10)), (3, "a", "U17", D(2025, 3, 1)), (4, "a", "U19", D(2025, 3, 1)), (5, None, "U17", D(2025, 3, 1)), (6, "a", "U17", None)], "m int, p string, g string, d date")
    right = spark.createDataFrame([("a", "U17", D(2025, 1, 10), 10), ("a", "U17", D(2025, 2, 1), None), (None, "U17", D(2025, 1, 1), 7)], "p string, g string, c date, points int")
    got = {r.m: (r.c, r.points) for r in K.asof_join(left, right, ["p", "g"], "d", "c", ["points"]).collect()}
    assert got == {1: (None, None), 2: (D(2025, 1, 10), 10), 3: (D(2025, 2, 1), None), 4: (None, None), 5: (None, None), 6: (None, None)}


def test_upsert_is_idempotent(spark):
    e = spark.createDataFrame([("1", "X", "t0"), ("2", "X", "t0")], "id string, city string, created string")
    i = spark.createDataFrame([("1", None, "t1"), ("2", "Y", "t1"), ("3", "Z", "t1")], "id string, city string, created string")
    once = K.upsert(e, i, "id", ["city", "created"], keep_existing=["created"])
    assert sorted(map(tuple, once.collect())) == [("1", "X", "t0"), ("2", "Y", "t0"), ("3", "Z", "t1")]
    assert sorted(map(tuple, K.upsert(once, i, "id", ["city", "created"], keep_existing=["created"]).collect())) == sorted(map(tuple, once.collect()))


def matches(spark, rows):
    return spark.createDataFrame([(i, D(2025, 1, 1) + dt.timedelta(days=d), a, b, w, g) for i, (d, a, b, w, g) in enumerate(rows)], "match_id long, match_date date, player1_id string, player2_id string, winner_player1 int, games_diff double")


def test_elo_first_match(spark):
    r = sorted(H.elo(matches(spark, [(0, "A", "B", 1, 3.0), (1, "A", "B", 1, 0.0)])).collect())
    k = 24 * (1 + 0.3 * math.log(4))
    assert r[0].expected1 == 0.5
    assert (r[1].elo1_pre, r[1].elo2_pre) == (pytest.approx(1500 + k / 2), pytest.approx(1500 - k / 2))


def test_history_is_leak_free(spark):
    rows = [(0, "A", "B", 1, 2.0), (1, "B", "A", 1, 1.0), (2, "A", "B", 1, 1.0), (2, "A", "C", 0, 1.0)]
    features = lambda m: {(r.match_id, r.perspective): r for r in H.head_to_head(H.player_windows(H.perspectives(m))).collect()}
    some, more = features(matches(spark, rows[:3])), features(matches(spark, rows))
    assert all(more[k] == r for k, r in some.items())
    third = some[2, "player1"]
    assert (third.h2h_matches_before, third.h2h_wins_before, third.h2h_win_rate_before) == (2, 1, 0.5)
    assert some[0, "player1"].h2h_win_rate_before == 0.5 and some[0, "player1"].win_rate_pre is None


def test_common_opponents(spark):
    m = matches(spark, [(0, "B", "C", 0, 1.0), (30, "A", "C", 1, 1.0), (40, "A", "B", 1, 1.0)])
    r = H.common_opponents(H.perspectives(m)).where("match_id = 2 and perspective = 'player1'").first()
    assert (r.common_opp_count, r.common_opp_winrate_edge_mean) == (1, 1.0)
    assert r.common_opp_weighted_edge == 1.0 and r.common_opp_weight_sum == pytest.approx(math.exp(-10 / 180))


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(1, 0.8), (0, 0.8), (1, 0.4), (0, 0.2), (1, None)], "y int, p double").withColumn("g", F.lit(1))
    r = E.metrics(df, ["g"]).first()
    assert (r.n, r.roc_auc) == (4, 0.625)


def test_split_and_profile(spark):
    df = spark.createDataFrame([(D(2026, 5, 11),), (D(2026, 2, 11),), (D(2026, 2, 10),)], "match_date date")
    assert sorted(r.is_test for r in E.temporal_split(df).collect()) == [0, 1, 1]
    p = E.column_profile(spark.createDataFrame([(1.0,), (None,), (3.0,)], "x double"), ["x"]).first()
    assert (p.mean, p.std, p.min, p.max) == (2, pytest.approx(2**0.5), 1, 3) and p.missing == pytest.approx(1 / 3)


def test_matching_status(spark):
    people = spark.createDataFrame([("1", "Ivanov Pavel"), ("2", "Ivanov Petr"), ("3", "Sidorov Oleg")], "player_id string, full_name string")
    names = spark.createDataFrame([("Ivanov P.",), ("Sidorov O.",), ("Nobody N.",)], "raw_name string")
    o = spark.createDataFrame([("Ivanov P.", "2")], "raw_name string, override_id string")
    assert {r.raw_name: (r.status, r.player_id) for r in match_names(names, people).collect()} == {"Ivanov P.": ("ambiguous", None), "Sidorov O.": ("matched", "3"), "Nobody N.": ("unmatched", None)}
    assert {r.raw_name: r.player_id for r in match_names(names, people, o).collect()}["Ivanov P."] == "2"


def test_page_parsers(spark):
    head = "".join(f"<td>{x}</td>" for x in (*P.HEADER, "Стадия"))
    rec = "".join(f"<div>{x}</div>" for x in ("1", "A B.", "C D.", "2-0", "6-4,6-1", "финал", "Дата", "01.02.2025"))
    page = f"<table><tr>{head}</tr></table>{rec}<p>noise</p>" + "".join(f"<div>{x}</div>" for x in ("2", "E F.", "G H.", "0-2", "1-6,2-6", "полуфинал"))
    df = spark.createDataFrame([(1, page), (2, None), (3, "<script>")], "page_id int, html string")
    got = sorted((r.number, r.player1, r.date) for r in P.page_matches(df).collect())
    assert got == [("1", "A B.", "01.02.2025"), ("2", "E F.", None)]
    assert P.html_tables("<table><tr><td>a<td>b<tr><td>c</table>") == [[["a", "b"], ["c"]]]
    assert dict(P.flatten({"a": [1, {"b": None}]})) == {"a.0": "1", "a.1.b": ""}
    assert P.table_cells(df).where("row_no = 0").count() == 5


def test_common_opponents_of_hot_players_and_rows_exchanged(spark, monkeypatch):
    import random

    rng = random.Random(3)
    rows = [(i // 3, *rng.sample("ABCDEFGHIJ", 2), rng.choice([0, 1, None]), 1.0) for i in range(150)]
    cells = lambda: sorted(tuple(round(x, 9) + 0.0 if isinstance(x, float) else x for x in r) for r in H.common_opponents(H.perspectives(matches(spark, rows))).collect())
    light = cells()
    monkeypatch.setattr(H, "HOT", 28)  # some players are hot
    some = cells()
    monkeypatch.setattr(H, "HOT", 0)  # a row an opponent for all
    assert len(light) > 200 and light == some == cells()


def test_common_opponents_exchange_a_row_a_match(spark):
    n = 400
    plan = H.common_opponents(H.perspectives(matches(spark, [(i, f"p{i % 20}", f"p{(i * 7 + 1) % 20 + 20}", 1, 1.0) for i in range(n)])))
    assert "BUCKET" not in plan.columns and "explode(sequence" not in plan._jdf.queryExecution().optimizedPlan().toString().lower().replace(" ", "")


def test_common_opponents_exchange_a_players_row_once_a_block(spark, monkeypatch):
    import random

    rng = random.Random(5)
    rows = [(i // 3, *rng.sample("ABCDEFGHIJ", 2), rng.choice([0, 1, None]), 1.0) for i in range(120)] + [(41, "A", None, 1, 1.0)]
    found = lambda: H.common_opponents(H.perspectives(matches(spark, rows)))
    cells = lambda: sorted(tuple(round(x, 9) + 0.0 if isinstance(x, float) else x for x in r) for r in found().collect())
    plan = found()._jdf.queryExecution().optimizedPlan().toString()
    assert "CoGroup" in plan and "Join" not in plan  # a join with players' rows gives each match one
    whole = cells()
    monkeypatch.setattr(H, "BLOCK", 60)
    monkeypatch.setattr(H, "MEET", 9)
    assert len(whole) > 150 and whole == cells()


def test_both_sides_take_one_asof_join(spark):
    long = H.perspectives(matches(spark, [(0, "A", "B", 1, 1.0), (30, "B", "C", 0, 1.0), (60, "A", "C", 1, 1.0)])).withColumn("age_category", F.lit("U17"))
    rated = spark.createDataFrame([("A", "U17", D(2025, 1, 20), 7.0), ("B", "U17", D(2025, 1, 1), 5.0), ("B", "U17", D(2025, 2, 1), None)], "player_id string, age_group string, classification_date date, points double")
    out = K.asof_sides(long, rated, {"points": "points"}, "rating_date")
    got = {(r.match_id, r.perspective): (r.player_points, r.opponent_points, r.opponent_rating_date) for r in out.collect()}
    assert got[0, "player1"] == (None, 5.0, D(2025, 1, 1)) and got[0, "player2"] == (5.0, None, None) and got[2, "player2"] == (None, 7.0, D(2025, 1, 20))
    assert got[1, "player1"] == (5.0, None, None) and got[1, "player2"] == (None, 5.0, D(2025, 1, 1))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Union") == 1


def test_elo_in_spans(spark, monkeypatch):
    import random

    rng = random.Random(4)
    m = matches(spark, [(i // 4, *rng.sample("ABCDEF", 2), rng.choice([0, 1, None]), rng.choice([None, 2.0, -3.0])) for i in range(60)])
    whole = sorted(map(tuple, H.elo(m).collect()))
    monkeypatch.setattr(H, "SPAN", 14)
    assert len(H._spans([(i, 4) for i in range(15)], 14)) == 5
    assert whole == sorted(map(tuple, H.elo(m).collect())) and len(whole) == 60


def test_text_lines_of_plain_and_odd_pages():
    assert P.text_lines("<p>a&nbsp; b</p>c\xa0\n d<STYLE>x</style>&lt;i&gt;<br>&#10;<script>1") == ["a b", "c", "d", "<i>", "1"]


def test_order_pages_exchange_columns_not_markup(spark):
    from matchloom.plans import more

    plan = more._order_pages(spark, "/root/testdata/sf0.001")._jdf.queryExecution().analyzed().toString()
    assert re.search(r"collect_list\(struct\([^()]*l_shipdate", plan)
