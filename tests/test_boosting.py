"""Boosting held against a plain version, row by row, and against Spark's own boosting."""

import json
import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from matchloom.operators import boosting as B
from matchloom.operators import models as M

SCHEMA = "match_id int, perspective string, x double, z double, c int, win int"


def rows_of(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        x, z = round(rng.gauss(0, 1), 1), rng.choice([None, math.nan, 0.0, 1.0, 2.0])
        lean = x if z is not None and z == z else 1.5  # a missing value says much
        out.append((i, "player1", None if i % 11 == 0 else x, z, None, int(lean + rng.gauss(0, 1) > 0.4)))
    return out


def gone(v):
    return v is None or v != v


def plain_fit(rows, edges, rounds, depth, step, l2, least):
    """Every split tried on every row."""
    bins = [[0 if gone(v) else 1 + sum(e < v for e in es) for v, es in zip(r[2:5], edges)] for r in rows]
    y = [r[5] for r in rows]
    prior = sum(y) / len(y)
    m = [math.log(prior / (1 - prior))] * len(y)
    for _ in range(rounds):
        p = [1 / (1 + math.exp(-v)) for v in m]
        g = [round((a - b) * B.UNIT) / B.UNIT for a, b in zip(p, y)]
        h = [round(a * (1 - a) * B.UNIT) / B.UNIT for a in p]
        leaf = [0] * len(y)

        def worth(at):
            sums = {}
            for i, k in enumerate(at):
                s = sums.setdefault(k, [0.0, 0.0])
                s[0] += g[i]
                s[1] += h[i]
            return sum(a * a / (b + l2) for a, b in sums.values()), sums

        for level in range(depth):
            best = None
            for f, es in enumerate(edges):
                for cut in range(len(es) + 1):
                    for miss in (0, 1):
                        side = [miss if b[f] == 0 else int(b[f] > cut) for b in bins]
                        if min(sum(side), len(side) - sum(side)) < least:
                            continue
                        gain = worth([k + (s << level) for k, s in zip(leaf, side)])[0] - worth(leaf)[0]
                        if gain > 1e-9 and (best is None or gain > best[0] + 1e-12):
                            best = (gain, side)
            if best is None:
                break
            leaf = [k + (s << level) for k, s in zip(leaf, best[1])]
        value = {k: -step * a / (b + l2) for k, (a, b) in worth(leaf)[1].items()}
        m = [v + value[k] for v, k in zip(m, leaf)]
    return [1 / (1 + math.exp(-v)) for v in m]


def test_equals_plain_boosting(spark):
    rows = rows_of(240, 5)
    df = spark.createDataFrame(rows, SCHEMA)
    model = B.fit(df, ["x", "z", "c"], rounds=5, depth=3, step=0.3, min_rows=7, bins=8, every=2)
    want = plain_fit(rows, model.edges, 5, 3, 0.3, 1.0, 7)
    got = {r.match_id: r.p for r in B.score(B.Boosted.loads(model.dumps()), df.repartition(5)).collect()}
    assert len(model.trees) == 5 and model.edges[2] == []
    assert all(abs(got[i] - w) < 1e-9 for i, w in enumerate(want))


def test_same_model_for_any_partitioning(spark):
    df = spark.createDataFrame(rows_of(400, 6), SCHEMA)
    one, many = (B.fit(df.repartition(n), ["x", "z"], rounds=4, depth=2, share=0.7, every=3) for n in (1, 7))
    assert json.loads(one.dumps()) == json.loads(many.dumps())


def test_missing_values_are_no_worse_than_imputed_boosting(spark):
    df = spark.createDataFrame(rows_of(3000, 7), SCHEMA).withColumn("win", F.col("win").cast("double"))
    fit, held = df.where("match_id < 2000"), df.where("match_id >= 2000")
    model = B.fit(fit, ["x", "z"], rounds=12, depth=3, step=0.2)
    ready = fit.replace(float("nan"), None).withColumn("weight", F.lit(1.0))
    like = M.boosted_trees(["x", "z"], 12)
    like.getStages()[-1].setStepSize(0.2).setSubsamplingRate(1.0)
    other = like.fit(ready)
    loss = lambda scored: scored.agg(F.avg(-F.log(F.when(F.col("win") == 1, F.col("p")).otherwise(1 - F.col("p"))))).first()[0]
    assert loss(B.score(model, held)) <= loss(M.with_score(other, held.replace(float("nan"), None))) + 0.005


def test_edges_of_the_fit(spark):
    none = spark.createDataFrame([], SCHEMA)
    model = B.fit(none, ["x", "z"])
    assert model.trees == [] and B.score(model, spark.createDataFrame(rows_of(3, 1), SCHEMA)).where("p = 0.5").count() == 3
    wins = spark.createDataFrame([(i, "a", float(i), None, None, 1) for i in range(30)] + [(99, "a", None, None, None, None)], SCHEMA)
    sure = B.fit(wins, ["x", "z"], rounds=2)
    assert B.score(sure, wins.drop("z")).where("p > 0.99").count() == 31


def test_modes_stop_by_later_dates_and_importances(spark):
    df = spark.createDataFrame(rows_of(600, 8), SCHEMA).withColumn("match_date", F.date_add(F.lit("2025-01-01").cast("date"), (F.col("match_id") / 10).cast("int")))
    chosen, fitted, table = B.fit_modes(df, ["x", "z"], modes={"light": (6, 2, 0.3, 0.9, 5), "power": (40, 3, 0.8, 0.9, 2)})
    assert chosen in fitted and len(fitted["power"].trees) < 40 and {r.model for r in table.collect()} == set(fitted)
    ranked = B.importances(spark, fitted).collect()
    assert [r.place for r in ranked] == [1, 2] and all(abs(sum(r[m] for r in ranked) - 1) < 1e-9 for m in fitted)


def test_histogram_equals_sql(spark):
    con, d = duckdb.connect(), "/root/testdata/sf0.001"
    for t in "region nation customer supplier part orders lineitem events".split():
        con.execute(f"create view {t} as select * from '{d}/{t}.parquet'")
    want = con.execute(entry.oracle_sql()["boosting_histogram"]).df()
    got = entry.queries()["boosting_histogram"](spark, d).toPandas()
    columns = ["feature", "bin", "g", "h", "n"]
    assert sorted(map(tuple, got[columns].astype(int).values.tolist())) == sorted(map(tuple, want[columns].astype(int).values.tolist()))
    assert (got["bin"] == 0).any()


def test_query_has_both_sides(spark):
    out = entry.queries()["boosted_symmetric"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(r.is_test for r in out) == [0, 1] and all(0.4 < r.roc_auc <= 1 for r in out)


def test_a_task_gives_its_sums_alone(spark):
    df = spark.createDataFrame([([i % 3, i % 2], float(i % 2), 1.0, 0.0) for i in range(1000)], "bins array<int>, y double, w double, m double").repartition(2)
    out = B.histogram(df, 2, 3)
    assert "Generate" not in out._jdf.queryExecution().optimizedPlan().toString()  # no row for each feature
    got = {(r.feature, r.bin): (r.g, r.n) for r in out.collect()}
    assert got[1, 0] == (B.UNIT // 2 * 500, 500) and got[1, 1] == (-B.UNIT // 2 * 500, 500) and sum(n for (f, _), (_, n) in got.items() if f == 0) == 1000
