"""Extension: windowed counts and running pair records on unbounded input."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def event_windows(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events, users and value by type and tumbling window; rows later than ``late`` are left out."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return timed.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.approx_count_distinct("user_id").alias("users"), F.sum("value").alias("value"))


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """User sessions that end after ``gap`` without an event."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return timed.groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))


def _pair_rows(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    n, wins = state.get if state.exists else (0, 0)
    out = []
    for rows in (pd.concat(list(frames)).sort_values(["match_date", "match_id"]),):
        for r in rows.itertuples(index=False):
            out.append((r.match_id, r.low_id, r.high_id, n, wins))
            n, wins = n + 1, wins + int(r.low_won)
    state.update((n, wins))
    yield pd.DataFrame(out, columns=["match_id", "low_id", "high_id", "matches_before", "low_wins_before"])


def running_pairs(matches: DataFrame) -> DataFrame:
    """Meetings of each pair before each arriving match, emitted before the state moves on."""
    first_low = F.col("player1_id") <= F.col("player2_id")
    pairs = matches.select("match_id", "match_date", F.least("player1_id", "player2_id").alias("low_id"), F.greatest("player1_id", "player2_id").alias("high_id"), F.when(first_low, F.col("winner_player1")).otherwise(1 - F.col("winner_player1")).alias("low_won"))
    return pairs.groupBy("low_id", "high_id").applyInPandasWithState(_pair_rows, "match_id long, low_id long, high_id long, matches_before long, low_wins_before long", "n long, wins long", "append", GroupStateTimeout.NoTimeout)
