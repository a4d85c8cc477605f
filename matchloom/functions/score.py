"""The score grammar as Column expressions: no Python per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import normalize_text

SUMMARY = r"^(\d+)[-–—:](\d+)$"
SET = r"(\d+)[-–—:](\d+)(?:\((\d+)\))?"


def score_features(df: DataFrame, score: str = "score_raw", detailed: str = "detailed_raw") -> DataFrame:
    """``df`` with sets, games, tie-breaks, winner, and the derived differences."""
    d = df.withColumns({"_s": normalize_text(F.col(score)), "_d": normalize_text(F.col(detailed))})
    take = lambda c, g, p=SET: F.regexp_extract(c, p, g)
    parts = F.filter(F.transform(F.split("_d", ","), lambda x: F.trim(x)), lambda x: x != "")

    def part(x: Column) -> Column:
        final = x.startswith("[") & x.endswith("]")
        return F.struct(x.alias("raw"), final.alias("final"), take(x, 1).cast("int").alias("a"), take(x, 2).cast("int").alias("b"), F.nullif(take(x, 3), F.lit("")).cast("int").alias("tb"))

    d = d.withColumn("_parts", parts).withColumn("_all", F.transform(F.filter("_parts", lambda x: x.rlike(SET)), part))
    d = d.withColumns({"_sets": F.filter("_all", lambda x: ~x["final"]), "_final": F.filter("_all", lambda x: x["final"])})
    total = lambda arr, f: F.aggregate(arr, F.lit(0), lambda acc, x: acc + f(x))
    have = F.size("_sets") > 0
    one, two = F.when(F.col("_s").rlike(SUMMARY), take(F.col("_s"), 1, SUMMARY).cast("int")), F.when(F.col("_s").rlike(SUMMARY), take(F.col("_s"), 2, SUMMARY).cast("int"))
    points = total("_final", lambda x: x["a"] + x["b"]) + total("_sets", lambda x: F.coalesce(x["tb"], F.lit(0)))
    d = d.withColumns({"_g1": F.when(have, total("_sets", lambda x: x["a"])), "_g2": F.when(have, total("_sets", lambda x: x["b"])), "_one": one, "_two": two, "_points": points})
    new = {
        "match_sets_score": F.concat_ws("-", "_one", "_two"),
        "match_sets_diff": F.col("_one") - F.col("_two"),
        "winner_player1": F.when(F.col("_one") != F.col("_two"), (F.col("_one") > F.col("_two")).cast("int")),
        "final_tb_score": F.get("_final", F.size("_final") - 1)["raw"],
        "has_final_tb": (F.size("_final") > 0).cast("int"),
        "n_sets": F.when(F.size("_parts") > 0, F.size("_sets") + (F.size("_final") > 0).cast("int")),
        "total_games_p1": F.col("_g1").cast("double"),
        "total_games_p2": F.col("_g2").cast("double"),
        "games_diff": (F.col("_g1") - F.col("_g2")).cast("double"),
        "total_points_tiebreak": F.when(F.col("_points") > 0, F.col("_points").cast("double")),
        "games_diff_per_set": F.when(have, (F.col("_g1") - F.col("_g2")) / F.size("_sets")),
        "dominance_index": F.when(F.col("_g1") + F.col("_g2") > 0, (F.col("_g1") - F.col("_g2")) / (F.col("_g1") + F.col("_g2"))),
    }
    for i in (1, 2, 3):
        s = F.get("_sets", F.lit(i - 1))
        new |= {f"set{i}_score": F.concat_ws("-", s["a"], s["b"]), f"set{i}_tb": s["tb"].cast("double"), f"set{i}_has_tb": s["tb"].isNotNull().cast("int")}
    new = {k: F.nullif(v, F.lit("")) if k.endswith("_score") else v for k, v in new.items()}
    return d.withColumns(new).drop("_s", "_d", "_parts", "_all", "_sets", "_final", "_g1", "_g2", "_one", "_two", "_points")
