import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchloom.functions import text as T
from matchloom.operators import enrich as N
from matchloom.operators import evaluate as E
from matchloom.operators import models as M
from matchloom.sources import pages as P
from matchloom.sources import tables as S


def test_quantiles_are_exact(spark):
    rng = random.Random(1)
    for values in ([rng.gauss(0, 50) for _ in range(30_000)], [1.0] * 25_000 + [2.0] * 3, [rng.choice([1e-9, 1.0, 1e9]) for _ in range(999)], [5.0]):
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
        shares = [0.0, 0.125, 0.5, 0.9, 1.0]
        assert np.allclose(E.exact_quantiles(df, "v", shares), np.quantile(values, shares), rtol=1e-12)
    assert E.exact_quantiles(spark.createDataFrame([], "v double"), "v", [0.5]) == [None]


@pytest.mark.parametrize("ascending", [True, False])
def test_running_sums_by_ranges(spark, ascending):
    rng = random.Random(2)
    rows = [(g, s / 997, rng.randint(1, 9)) for g in "ab" for s in rng.sample(range(998), 300)]
    out = E.running_by_score(spark.createDataFrame(rows, "g string, p double, c int"), ["g"], "p", F.col("c"), "upto", ascending).collect()
    for r in out:
        assert r.upto == sum(c for g, p, c in rows if g == r.g and (p <= r.p if ascending else p >= r.p))


def test_row_ids_ties_and_nulls(spark):
    rows = [(None, 2), (None, 1), (3, 1), (3, 0), (1, 9)]
    out = {(r.a, r.b): r.row_id for r in N.row_ids(spark.createDataFrame(rows, "a int, b int"), "a", ["b"]).collect()}
    assert out == {(None, 1): 0, (None, 2): 1, (1, 9): 2, (3, 0): 3, (3, 1): 4}


def test_one_to_one_refuses_repeats(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(1, 5), (1, 6)], "k int, w int")
    assert N.one_to_one(a, b.where("w = 5"), ["k"]).count() == 2
    with pytest.raises(Exception, match="right keys repeat"):
        N.one_to_one(a, b, ["k"]).collect()


def test_discovery_resume_and_page_series(spark, tmp_path):
    (tmp_path / "a.csv").write_text("fio,points\nx,1\n")
    (tmp_path / "b.csv").write_text('"fio";"rni"; points\n')
    found = [r.path.rsplit("/", 1)[1] for r in S.discover(spark, str(tmp_path / "*.csv"), ["fio", "rni"]).collect()]
    assert found == ["b.csv"]
    wanted = spark.createDataFrame([("2025-01-01", "a"), ("2025-01-01", "b"), ("2025-02-01", "a")], "d string, g string")
    assert S.to_do(wanted, wanted.where("g = 'a'").limit(1), ["d", "g"]).count() == 2
    pages = spark.createDataFrame([("s", 1, "x"), ("s", 2, "y"), ("s", 3, "y"), ("s", 4, "z"), ("t", 1, "x"), ("t", 2, ""), ("t", 3, "q")], "series string, page_no int, html string")
    assert sorted((r.series, r.page_no) for r in S.distinct_pages(pages, ["series"]).collect()) == [("s", 1), ("s", 2), ("t", 1)]
    S.write_csv(wanted, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 3
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "1.html").write_text("<p>1</p>")
    assert S.read_saved_pages(spark, str(tmp_path / "pages"), "none.zip").count() == 1


def test_text_rules(spark):
    row = spark.createDataFrame([("&#1046;&#x41; &amp;#65; &laquo;x&raquo; &lt;b&gt;<p>t</p>", "Иванов А.Б.", "Матч отменён", "", "2 - 1", " 12. x/y:._ ")], "h string, n string, s string, a string, r string, f string")
    out = row.select(T.strip_html(F.col("h")), T.is_player_like(F.col("n")), T.is_cancelled(F.col("s")), T.serving_age_group(F.col("a")), T.is_summary_score(F.col("r")), T.sanitize_file_name(F.col("f"))).first()
    assert tuple(out) == ("ЖA &#65; «x» <b> t", True, True, "unknown", True, "12. x_y")


def test_records_stop_at_the_footer():
    head = ["№", "Участник 1 РНИ", "Участник 2", "Счет игры", "Этап"]
    lines = ["x", *head, "1", "A", "B", "2 - 0", "6-0,6-0", "OT", "Статус матча", "ok", "Начало", "10:00", "77", "junk", "2", "C", "D", "0:2", "", "OT", "2026 ©", "3", "E", "F", "2-0", "", "OT"]
    out = P.match_records(lines)
    assert [r["number"] for r in out] == ["1", "2"] and out[0]["status"] == "ok" and out[0]["time"] == "10:00" and "date" not in out[0]
    assert P.match_records(["1", "A", "B", "2-0", "", "x"]) == []


def test_modes_refit_and_bundle(spark, tmp_path):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        x = rng.gauss(0, 1)
        rows.append((i, f"2025-{1 + i // 40:02d}-{1 + i % 28:02d}", x, None if i % 9 == 0 else rng.random(), int(x + rng.gauss(0, 0.5) > 0)))
    long = spark.createDataFrame(rows, "match_id int, match_date string, x double, z double, win int").withColumn("match_date", F.to_date("match_date"))
    small = {"light": (6, 2, 0.2, 0.9, 5), "power": (12, 4, 0.2, 0.9, 2)}
    mode, model, table = M.boosted_modes(long, ["x", "z"], small)
    assert mode in small and {r.model for r in table.collect()} == set(small) and all(r.test_roc_auc > 0.8 for r in table.collect())
    forest = M.random_forest(["x", "z"], trees=5).fit(M.balanced(long.withColumn("win", F.col("win").cast("double"))))
    assert M.with_score(forest, long.withColumn("weight", F.lit(1.0))).where("p between 0 and 1").count() == 400
    M.save_bundle(M.refit(long, ["x", "z"], M.logistic(["x", "z"])), ["x", "z"], table, str(tmp_path / "bundle"))
    again, fill, quality = M.load_bundle(spark, str(tmp_path / "bundle"))
    rows = M.backfilled(long.select("match_id", "x", F.lit(1.0).alias("weight"), F.col("win").cast("double").alias("win")), fill)
    assert M.with_score(again, rows).where("p is not null").count() == 400 and set(fill) == {"x", "z"} and quality.count() == 2
