"""Name resolution: candidates by surname and initials, status, overrides, audit; ids attached to both sides of matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import contains_any, normalize_lower, normalize_player_key, normalize_text, surname_initials_key

#: Markers of the genders that count as candidates; a blank one counts too.
FEMALE = ("девушка", "женщина", "юниорка")


def candidate_gender(c: Column, markers: tuple[str, ...] = FEMALE) -> Column:
    t = normalize_lower(c)
    return (t == "") | contains_any(t, markers)


def match_names(names: DataFrame, people: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """Each distinct raw_name with appearances, candidates and status: matched, ambiguous or unmatched.

    A raw name is met by its plain key, a candidate by surname and initials. ``people`` has full_name and player_id, and may
    have a gender (:func:`candidate_gender` keeps candidates); ``overrides`` name_key (or a raw_name of it)
    and override_id, which win.
    """
    if "gender" in people.columns:
        people = people.where(candidate_gender(F.col("gender")))
    candidates = people.select(surname_initials_key(F.col("full_name")).alias("name_key"), F.col("player_id").cast("string").alias("player_id")).groupBy("name_key").agg(F.array_sort(F.collect_set("player_id")).alias("candidates"))
    seen = names.where("raw_name is not null").groupBy(normalize_text(F.col("raw_name")).alias("raw_name")).agg(F.count("*").alias("appearances")).withColumn("name_key", normalize_player_key(F.col("raw_name")))
    out = seen.join(candidates, "name_key", "left").withColumn("n_candidates", F.when(F.col("candidates").isNull(), 0).otherwise(F.size("candidates")))
    if overrides is not None:
        if "name_key" not in overrides.columns:
            overrides = overrides.select(normalize_player_key(F.col("raw_name")).alias("name_key"), "override_id").distinct()
        out = out.join(overrides, "name_key", "left")
    else:
        out = out.withColumn("override_id", F.lit(None).cast("string"))
    matched = F.when(F.col("n_candidates") == 1, F.get("candidates", F.lit(0)))
    status = F.when(F.col("override_id").isNotNull() | (F.col("n_candidates") == 1), "matched").when(F.col("n_candidates") > 1, "ambiguous").otherwise("unmatched")
    return out.select("raw_name", "name_key", F.col("appearances").cast("long").alias("appearances"), F.col("n_candidates").cast("long").alias("n_candidates"), F.array_join("candidates", "; ").alias("candidates"), F.coalesce("override_id", matched).alias("player_id"), status.alias("status"))


def ambiguous_names(audit: DataFrame) -> DataFrame:
    return audit.where("status = 'ambiguous'")


def attach_ids(matches: DataFrame, audit: DataFrame, sides: tuple[str, ...] = ("player1", "player2")) -> DataFrame:
    """``matches`` with ``<side>_id`` and ``<side>_match_status`` of each ``<side>_raw`` name."""
    for side in sides:
        known = audit.select(F.col("raw_name").alias("_raw"), F.col("player_id").alias(f"{side}_id"), F.col("status").alias(f"{side}_match_status"))
        matches = matches.join(known, normalize_text(F.col(f"{side}_raw")) == F.col("_raw"), "left").drop("_raw")
    return matches
