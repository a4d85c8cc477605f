"""Leak-free history features of matches, one row for each match and side."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stored import stored

TRAIN_ELO = {"k": 24.0, "margin": 0.30, "recency_days": 90.0, "base": 1500.0}
SERVE_ELO = {"k": 32.0, "margin": 0.08, "recency_days": 45.0, "base": 1500.0}
ORDER = ("match_date", "match_id")


def perspectives(matches: DataFrame) -> DataFrame:
    """Two rows a match from one scan: each side as the player, the other as the opponent."""
    rest = [c for c in matches.columns if c not in ("player1_id", "player2_id", "winner_player1", "games_diff")]
    diff = F.col("games_diff") if "games_diff" in matches.columns else F.lit(None).cast("double")
    side = lambda name, a, b, win, g: F.struct(F.lit(name).alias("perspective"), F.col(a).alias("player_id"), F.col(b).alias("opponent_id"), win.alias("win"), g.alias("games_diff"))
    both = F.array(side("player1", "player1_id", "player2_id", F.col("winner_player1"), diff), side("player2", "player2_id", "player1_id", 1 - F.col("winner_player1"), -diff))
    return matches.select(*rest, F.explode(both).alias("_side")).select(*rest, "_side.*")


def player_windows(long: DataFrame) -> DataFrame:
    """Career win rate, rest days, experience and recent form before each match; one exchange by player."""
    w = Window.partitionBy("player_id").orderBy(*ORDER)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    last = lambda n: w.rowsBetween(-n, -1)
    return long.withColumns(
        {
            "win_rate_pre": F.avg("win").over(before),
            "rest_days": F.datediff("match_date", F.lag("match_date").over(w)),
            "matches_pre": (F.row_number().over(w) - 1).cast("long"),
            "form10_full": F.when(F.count("*").over(last(10)) == 10, F.avg("win").over(last(10))),
            "form5_partial": F.avg("win").over(last(5)),
            "form10_curve": F.avg("win").over(w.rowsBetween(-9, 0)),
        }
    )


def head_to_head(long: DataFrame) -> DataFrame:
    """Earlier meetings of the pair, and the player's wins in them; half where there is none."""
    pair = long.withColumns({"_low": F.least("player_id", "opponent_id"), "_high": F.greatest("player_id", "opponent_id")})
    w = Window.partitionBy("_low", "_high", "player_id").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)
    n, wins = F.count("*").over(w), F.coalesce(F.sum("win").over(w), F.lit(0))
    return pair.withColumns({"h2h_matches_before": n.cast("long"), "h2h_wins_before": wins.cast("long"), "h2h_win_rate_before": F.when(n > 0, wins / n).otherwise(F.lit(0.5))}).drop("_low", "_high")


def _elo_rows(p: dict[str, float], states: bool = False):
    """Rows of ratings; ``states``: a pool's rows without a match come first and hold players' ratings and last days, and so do rows at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rating: dict[object, float] = {}
        last: dict[object, int] = {}
        pool: object = None
        kinds = None
        for batch in batches:
            kinds = batch.schema
            pools = batch.column("pool").to_pylist()
            one, two = batch.column("player1_id").to_pylist(), batch.column("player2_id").to_pylist()
            days = batch.column("day").to_pylist()
            won, diff = batch.column("winner_player1").to_pylist(), batch.column("games_diff").to_pylist()
            held = batch.column("held").to_pylist() if states else None
            a_pre, b_pre, chance, real = [], [], [], []
            for i, (q, a, b, day, w, g) in enumerate(zip(pools, one, two, days, won, diff, strict=True)):
                if q != pool:
                    pool, rating, last = q, {}, {}
                if held is not None and held[i] is not None:
                    rating[a] = held[i]
                    if day is not None:
                        last[a] = day
                    continue
                ra, rb = rating.get(a, p["base"]), rating.get(b, p["base"])
                e = 1.0 / (1.0 + 10.0 ** ((rb - ra) / 400.0))
                a_pre.append(ra)
                b_pre.append(rb)
                chance.append(e)
                real.append(i)
                if w is None:
                    continue
                k = p["k"] * (1.0 if g is None else 1.0 + p["margin"] * math.log1p(abs(g)))
                fresh = lambda x: 1.0 if x not in last else 2.0 - math.exp(-max(day - last[x], 0) / p["recency_days"])  # noqa: B023, E731
                ka, kb = k * fresh(a), k * fresh(b)
                rating[a], rating[b] = ra + ka * (w - e), rb + kb * (e - w)
                last[a] = last[b] = day
            out = [batch.column("match_id") if len(real) == batch.num_rows else batch.column("match_id").take(pa.array(real, pa.int64())), pa.array(a_pre, pa.float64()), pa.array(b_pre, pa.float64()), pa.array(chance, pa.float64())]
            names = ["match_id", "elo1_pre", "elo2_pre", "expected1"]
            if states:
                none = lambda n: pa.nulls(len(real), kinds.field(n).type)  # noqa: B023, E731
                out, names = [*out, none("player1_id"), pa.nulls(len(real), pa.float64()), pa.nulls(len(real), pa.int32())], [*names, "player_id", "held", "day"]
            yield pa.RecordBatch.from_arrays(out, names)
        if states and rating:
            people, n = list(rating), len(rating)
            empty = [pa.nulls(n, kinds.field("match_id").type), *[pa.nulls(n, pa.float64())] * 3]
            yield pa.RecordBatch.from_arrays([*empty, pa.array(people, kinds.field("player1_id").type), pa.array(list(rating.values()), pa.float64()), pa.array([last.get(x) for x in people], pa.int32())], ["match_id", "elo1_pre", "elo2_pre", "expected1", "player_id", "held", "day"])

    return run


#: The global pool is replayed in spans of whole days of about so many matches, so no task sorts more.
SPAN = 4_000_000


def elo(matches: DataFrame, pool: str | None = None, preset: dict[str, float] = TRAIN_ELO) -> DataFrame:
    """match_id, both sides' ratings before each match, and side 1's expected score.

    A rating depends on all earlier matches of its pool, so a pool is one sequence: it streams through a
    task in order, with one number a player held. Pools run in parallel; ``pool=None`` is one global pool. Where that has more than SPAN matches,
    spans of days are replayed one after the other: each ends with a row a player, with which the next begins.
    """
    rows = matches.select(
        "match_id", "player1_id", "player2_id", F.col("winner_player1").cast("double").alias("winner_player1"), F.col("games_diff").cast("double").alias("games_diff"), "match_date",
        F.unix_date("match_date").alias("day"), (F.col(pool).cast("string") if pool else F.lit("all")).alias("pool"),
    )
    kind = dict(matches.dtypes)["match_id"]
    found = f"match_id {kind}, elo1_pre double, elo2_pre double, expected1 double"
    if pool:
        return rows.repartition("pool").sortWithinPartitions("pool", *ORDER).mapInArrow(_elo_rows(preset), found)
    rows = stored(rows.drop("pool"))
    # a row a day comes to the driver
    spans = _spans([tuple(r) for r in rows.groupBy("day").count().collect()], SPAN)
    if len(spans) == 1:
        # the fold alone is serial: what comes before it isn't pulled into its task
        return rows.withColumn("pool", F.lit("all")).repartition(1).sortWithinPartitions(*ORDER).mapInArrow(_elo_rows(preset), found)
    person = dict(rows.dtypes)["player1_id"]
    parts, state = [], None
    for low, high in spans:
        here = F.lit(True)
        if low is not None:
            here = here & (F.col("day") >= low)
        if high is not None:
            here = here & ((F.col("day") < high) if low is not None else (F.col("day").isNull() | (F.col("day") < high)))
        span = rows.where(here).withColumns({"pool": F.lit("all"), "held": F.lit(None).cast("double"), "_first": F.lit(1)})
        if state is not None:
            kinds = dict(rows.dtypes)
            span = span.unionByName(state.select(*[F.col(c) if c in ("day", "held") else F.col("player_id").alias(c) if c == "player1_id" else F.lit("all").alias(c) if c == "pool" else F.lit(0).alias(c) if c == "_first" else F.lit(None).cast(kinds[c]).alias(c) for c in span.columns]))
        out = stored(span.repartition(1).sortWithinPartitions("_first", *ORDER).drop("_first", "match_date").mapInArrow(_elo_rows(preset, True), f"{found}, player_id {person}, held double, day int"))
        parts.append(out.where("held is null").drop("player_id", "held", "day"))
        state = out.where("held is not null").select("player_id", "held", "day")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _spans(counts: list[tuple[int | None, int]], most: int) -> list[tuple[int | None, int | None]]:
    """(first day, first day of the next) of spans of whole days that hold ``most`` matches or a day; None where they are open."""
    starts, held = [], 0
    for day, n in sorted(counts, key=lambda x: (x[0] is not None, x[0] or 0)):
        if held and held + n > most and day is not None:
            starts.append(day)
            held = 0
        held += n
    return list(zip([None, *starts], [*starts, None], strict=True))


def elo_until(matches: DataFrame, at: Column, preset: dict[str, float] = SERVE_ELO) -> DataFrame:
    """One replay of the matches before ``at``: two rows a match (a side, its opponent, both ratings before it) and one row a player
    without a match, dated ``at``, with its rating by then."""
    kinds = dict(matches.dtypes)
    past = matches.where(F.col("match_date") < at)
    side = lambda c: F.col(c).cast(kinds["player1_id"])
    one = lambda i, a, b, w, on: F.struct(i.alias("id"), a.alias("player1_id"), b.alias("player2_id"), w.cast("int").alias("win"), on.alias("on_date")).alias("match_id")
    games = F.col("games_diff") if "games_diff" in kinds else F.lit(None)
    cols = ("match_id", "player1_id", "player2_id", "winner_player1", "games_diff", "match_date")
    played = past.select(one(F.col("match_id"), side("player1_id"), side("player2_id"), F.col("winner_player1"), F.col("match_date")), side("player1_id"), side("player2_id"), F.col("winner_player1").cast("double"), games.cast("double"), "match_date").toDF(*cols)
    people = past.select(F.explode(F.array("player1_id", "player2_id")).alias("p")).where("p is not null").distinct()
    last = people.select(one(F.lit(None).cast(kinds["match_id"]), F.col("p"), F.lit(None).cast(kinds["player1_id"]), F.lit(None), at.cast("date")), F.col("p"), F.col("p"), F.lit(None).cast("double"), F.lit(None).cast("double"), at.cast("date")).toDF(*cols)
    # a day that no match of the past has puts the players' rows last
    out = elo(played.unionByName(last), preset=preset)
    m = F.col("match_id")
    row = lambda who, other, win, own, opp: F.struct(who.alias("player_id"), other.alias("opponent_id"), win.alias("win"), own.alias("elo"), opp.alias("opponent_elo"))
    first = row(m["player1_id"], m["player2_id"], m["win"], F.col("elo1_pre"), F.col("elo2_pre"))
    second = row(m["player2_id"], m["player1_id"], 1 - m["win"], F.col("elo2_pre"), F.col("elo1_pre"))
    sides = F.when(m["id"].isNull(), F.array(first)).otherwise(F.array(first, second))
    return out.select(m["id"].alias("match_id"), m["on_date"].alias("match_date"), F.explode(sides).alias("_s")).select("match_id", "match_date", "_s.*")


def with_elo(long: DataFrame, ratings: DataFrame) -> DataFrame:
    """Each side's and its opponent's rating before the match, the difference, and the expected score."""
    return elo_sides(long.join(ratings, "match_id"))


def elo_sides(long: DataFrame) -> DataFrame:
    """:func:`with_elo` of rows that have their match's columns of :func:`elo`."""
    first = F.col("perspective") == "player1"
    return long.withColumns(
        {
            "elo_pre": F.when(first, F.col("elo1_pre")).otherwise(F.col("elo2_pre")),
            "elo_opp_pre": F.when(first, F.col("elo2_pre")).otherwise(F.col("elo1_pre")),
            "elo_expected": F.when(first, F.col("expected1")).otherwise(1 - F.col("expected1")),
        }
    ).withColumn("elo_diff", F.col("elo_pre") - F.col("elo_opp_pre")).drop("elo1_pre", "elo2_pre", "expected1")


def schedule_strength(long_elo: DataFrame) -> DataFrame:
    """Mean opponent rating of the last 10 (full window, else own rating) and the last 5 (else the opponent's)."""
    w = Window.partitionBy("player_id").orderBy(*ORDER)

    def full(n: int):
        last = w.rowsBetween(-n, -1)
        return F.when(F.count("*").over(last) == n, F.avg("elo_opp_pre").over(last))

    return long_elo.withColumns({"schedule_strength": F.coalesce(full(10), F.col("elo_pre")), "opp_elo_last_5": F.coalesce(full(5), F.col("elo_opp_pre"))})


#: Opponents of a player are dealt to so many buckets, so no task meets all matches of a hot player with all opponents.
BUCKETS = 32


def _carried(rows: DataFrame, states: DataFrame, x: str) -> DataFrame:
    """``rows`` (``p_x``, ``c``, ``at``) with the newest state (n_x, w_x, d_x) of the same player and opponent that is older than ``at``, null where there is none.

    One exchange by (player, opponent): states and rows are unioned and the state is carried forward in order of time.
    """
    names = [f"n_{x}", f"w_{x}", f"d_{x}"]
    state, asked = F.struct(*names), F.struct(*rows.columns)
    s = states.select(F.col("p").alias("_p"), F.col("c").alias("_c"), F.col("since").alias("_at"), F.lit(1).alias("_side"), F.struct(*[F.col(o).alias(n) for o, n in zip("nwd", names, strict=True)]).alias("_s"))
    kind = rows.select(asked).schema[0].dataType
    r = rows.select(F.col(f"p_{x}").alias("_p"), F.col("c").alias("_c"), F.col("at").alias("_at"), F.lit(0).alias("_side"), F.lit(None).cast(s.schema["_s"].dataType).alias("_s"), asked.alias("_r"))
    both = r.unionByName(s.withColumn("_r", F.lit(None).cast(kind)))
    # at one time the row comes before the state that its own match leaves
    w = Window.partitionBy("_p", "_c").orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return both.withColumn("_s", F.last("_s", ignorenulls=True).over(w)).where("_side = 0").select("_r.*", *[F.col(f"_s.{n}").alias(n) for n in names])


#: A player with more matches is hot: no row holds all of them.
HOT = 2048
TOTALS = {
    "common_opp_count": "long", "common_opp_player_matches_sum": "long", "common_opp_opponent_matches_sum": "long", "common_opp_player_wins_sum": "long", "common_opp_opponent_wins_sum": "long",
    "common_opp_player_winrate_mean": "double", "common_opp_opponent_winrate_mean": "double", "common_opp_winrate_edge_mean": "double", "common_opp_weighted_edge": "double", "common_opp_weight_sum": "double",
    "common_opp_min_pair_matches_sum": "long", "common_opp_available": "int",
}


def common_opponents(long: DataFrame, fold_days: float = 180.0) -> DataFrame:
    """Twelve features of the opponents that both sides met before each match, for both sides."""
    sides = common_sides(long, fold_days)
    return sides.select(F.explode("sides").alias("_s")).select("_s.match_id", "_s.perspective", *[f"_s.{c}" for c in TOTALS])


def common_sides(long: DataFrame, fold_days: float = 180.0) -> DataFrame:
    """:func:`common_opponents` in one row a match: match_id, sides (of player1, of player2).

    A player's matches are one row of arrays in order of time. Both sides' rows are met by blocks of players: what is exchanged is a row a match and a player's row
    a block (:func:`_totals_by_row`), not one an opponent. Matches of hot
    players take a row an opponent instead (:func:`_opponent_rows`), so no row holds all matches of such a player. The other side's features are these swapped.
    """
    mine = Window.partitionBy("player_id")
    # written once: it is read for the pairs and for both sides
    placed = stored(long.select("match_id", "match_date", "perspective", "player_id", "opponent_id", "win", F.row_number().over(mine.orderBy(*ORDER)).alias("pos"), F.count("*").over(mine).alias("total")))
    of = lambda c, side: F.max(F.when(F.col("perspective") == side, F.col(c)))
    pairs = placed.groupBy("match_id").agg(
        F.max("match_date").alias("match_date"), *[of(c, side).alias(n) for side, s in (("player1", "a"), ("player2", "b")) for c, n in (("player_id", f"p_{s}"), ("pos", f"pos_{s}"), ("total", f"total_{s}"))]
    )
    hot = F.greatest("total_a", "total_b") > HOT
    one = _totals_by_row(pairs.where(~hot & (F.col("pos_a") > 1) & (F.col("pos_b") > 1)), placed, fold_days)
    if not placed.where(F.col("total") > HOT).isEmpty():
        rows = _opponent_rows(pairs.where(hot), placed)
        one = one.unionByName(opponent_totals(rows, ["match_id"], fold_days).withColumn("common_opp_available", F.lit(1)).select(*[F.col(c).cast(TOTALS[c]).alias(c) if c in TOTALS else c for c in one.columns]))
    one = one.withColumn("perspective", F.lit("player1"))
    other = {}
    for c in one.columns:
        swapped = c.replace("_player_", "_x_").replace("_opponent_", "_player_").replace("_x_", "_opponent_")
        other[c] = -F.col(c) if c.endswith(("edge_mean", "weighted_edge")) else F.lit("player2") if c == "perspective" else F.col(swapped)
    return one.select("match_id", F.array(F.struct(*one.columns), F.struct(*[v.alias(c) for c, v in other.items()])).alias("sides"))


#: A block holds about so many earlier matches, so a task's memory is bounded; about so many are met at once.
BLOCK, MEET = 12_000_000, 1_000_000


def _totals_by_row(pairs: DataFrame, placed: DataFrame, fold_days: float) -> DataFrame:
    """The twelve features of player1 by match, from both sides' matches before it.

    Players are dealt to groups and matches to the block of their sides' groups. A player's row goes once to each block that it plays in, however many of its matches that holds.
    """
    spark = placed.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(math.ceil(math.sqrt(2 * tasks)), -(-2 * placed.count() // BLOCK))
    group = lambda c: F.pmod(F.xxhash64(c), F.lit(groups)).cast("int")
    block = lambda x, y: (F.least(x, y) * groups + F.greatest(x, y)).alias("block")
    entry = F.struct("pos", F.col("opponent_id").alias("c"), F.col("win").alias("w"), F.unix_date("match_date").alias("d"))
    rows = placed.where((F.col("total") <= HOT) & F.col("player_id").isNotNull()).groupBy("player_id").agg(F.array_sort(F.collect_list(entry)).alias("h"))
    lines = rows.select("player_id", *[F.col(f"h.{x}").alias(x) for x in "cwd"], F.explode(F.array_distinct(F.transform("h", lambda x: group(x["c"])))).alias("other"))
    lines = lines.select(block(group("player_id"), F.col("other")), "player_id", "c", "w", "d").repartition(tasks, "block")
    asked = pairs.where("p_a is not null and p_b is not null").select(block(group("p_a"), group("p_b")), "match_id", F.unix_date("match_date").alias("day"), "p_a", "p_b", "pos_a", "pos_b").repartition(tasks, "block")
    kind = dict(placed.dtypes)["match_id"]
    return lines.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(_met(fold_days), f"match_id {kind}, " + ", ".join(f"{n} {t}" for n, t in TOTALS.items()))


def _met(fold_days: float):
    """Twelve features a match of a block from its players' rows; matches without a common opponent go."""
    arrow = {"long": pa.int64(), "double": pa.float64(), "int": pa.int32()}

    def run(lines: pa.Table, asked: pa.Table) -> pa.Table:
        schema = pa.schema([asked.schema.field("match_id"), *[(n, arrow[t]) for n, t in TOTALS.items()]])
        if not lines.num_rows or not asked.num_rows:
            return schema.empty_table()
        of = lambda t, c: t.column(c).combine_chunks()
        parts = [of(lines, "player_id"), of(lines, "c").flatten(), of(asked, "p_a"), of(asked, "p_b")]
        coded = pa.chunked_array(parts).combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        who, code, *sides = np.split(coded, np.cumsum([len(x) for x in parts])[:-1])
        width = int(coded.max()) + 1
        size = np.diff(of(lines, "c").offsets.to_numpy())
        first = np.cumsum(size) - size
        row = np.full(width, -1)
        row[who] = np.arange(len(who))
        # each row by opponent, in order of time: what a match sees of an opponent is the last state before it
        line = np.repeat(np.arange(len(size)), size)
        order = np.argsort(line * (width + 1) + code, kind="stable")
        code, pos = code[order], (np.arange(len(line)) - first[line] + 1)[order]
        w, d = (of(lines, x).flatten().to_numpy(zero_copy_only=False).astype(float)[order] for x in "wd")
        if len(code):
            new = np.r_[True, (code[1:] != code[:-1]) | (line[1:] != line[:-1])]
            start = np.flatnonzero(new)[np.cumsum(new) - 1]
            so_far = lambda v: (total := np.r_[0.0, np.cumsum(v)])[1:] - total[start]
            n, won, known = (np.arange(len(code)) - start + 1).astype(float), so_far(np.nan_to_num(w)), so_far(~np.isnan(w))
        ra, rb = row[sides[0]], row[sides[1]]
        pos_a, pos_b, day = (of(asked, c).to_numpy(zero_copy_only=False) for c in ("pos_a", "pos_b", "day"))
        day = day.astype(float)

        def states(at: np.ndarray, of: np.ndarray, upto: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """(match and opponent, place of its last state) of one side of the matches ``at``, by match and opponent."""
            held = size[of[at]]
            each = np.repeat(np.arange(len(at)), held)
            place = np.arange(len(each)) - np.repeat(np.cumsum(held) - held - first[of[at]], held)
            own = code[place]
            seen = (pos[place] < np.repeat(upto[at], held)) & (own >= 0) & (own != np.repeat(sides[0][at], held)) & (own != np.repeat(sides[1][at], held))
            key, place = (each * width + own)[seen], place[seen]
            last = np.r_[key[1:] != key[:-1], True][: len(key)]
            return key[last], place[last]

        found = []
        here = np.flatnonzero((ra >= 0) & (rb >= 0))
        cut = np.cumsum(size[ra[here]] + size[rb[here]]) // MEET
        for at in np.split(here, np.flatnonzero(np.diff(cut)) + 1) if len(here) else []:
            (ka, a), (kb, b) = states(at, ra, pos_a), states(at, rb, pos_b)
            if not len(ka) or not len(kb):
                continue
            near = np.minimum(np.searchsorted(kb, ka), len(kb) - 1)
            both = kb[near] == ka
            if not both.any():
                continue
            met, a, b = ka[both] // width, a[both], b[near[both]]
            days = np.nan_to_num(np.maximum(day[at][met] - np.fmax(d[a], d[b]), 0))
            least = np.minimum(n[a], n[b])
            weight = np.exp(-days / fold_days) * np.sqrt(least)
            rate = lambda x: np.where(known[x] > 0, won[x] / n[x], np.nan)
            edge = rate(a) - rate(b)
            total = lambda v: np.bincount(met, np.nan_to_num(v), len(at))  # noqa: B023, E731
            count = lambda v: np.bincount(met, ~np.isnan(v), len(at))  # noqa: B023, E731
            with np.errstate(divide="ignore", invalid="ignore"):
                mean = lambda v: total(v) / count(v)  # noqa: B023, E731
                weights = total(weight)
                edges = np.where((weights > 0) & (count(edge) > 0), total(weight * edge) / weights, np.nan)
                out = [total(n[a] * 0 + 1), total(n[a]), total(n[b]), *[np.where(count(rate(x)) > 0, total(won[x]), np.nan) for x in (a, b)], mean(rate(a)), mean(rate(b)), mean(edge), edges, weights, total(least)]
            held = np.unique(met)
            columns = [pa.array(v[held], pa.float64(), from_pandas=True).cast(arrow[t]) for v, t in zip(out, list(TOTALS.values())[:-1], strict=True)]
            found.append(pa.Table.from_arrays([of(asked, "match_id").take(pa.array(at[held])), *columns, pa.array(np.ones(len(held), np.int32))], schema=schema))
        return pa.concat_tables(found) if found else schema.empty_table()

    return run


def _opponent_rows(pairs: DataFrame, placed: DataFrame) -> DataFrame:
    """A row for each common opponent of these matches: states (n, w, d) of both sides by then.

    Each meeting leaves a running state of (player, opponent). A match asks for the opponents that player1 has met before
    by then: an equality join on (player, bucket of opponents) with one row a pair, not one a meeting. Those rows take the other
    side's state of the same opponent, then player1's, each carried forward by (player, opponent).
    """
    w = Window.partitionBy("player_id", "opponent_id").orderBy(*ORDER)
    key = F.struct(*ORDER)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bucket = F.pmod(F.xxhash64("opponent_id"), F.lit(BUCKETS)).cast("int")
    met = placed.groupBy("player_id", "opponent_id").agg(F.min(key).alias("first")).withColumn("bucket", bucket).withColumnsRenamed({"player_id": "p_a", "opponent_id": "c"})
    states = placed.select(F.col("player_id").alias("p"), F.col("opponent_id").alias("c"), key.alias("since"), F.count("*").over(upto).alias("n"), F.sum("win").over(upto).alias("w"), F.col("match_date").alias("d"))
    asked = pairs.select("match_id", "match_date", key.alias("at"), "p_a", "p_b", F.explode(F.sequence(F.lit(0), F.lit(BUCKETS - 1))).alias("bucket"))
    known = asked.join(met, ["p_a", "bucket"]).where((F.col("first") < F.col("at")) & (F.col("c") != F.col("p_b")) & (F.col("c") != F.col("p_a"))).drop("first", "bucket")
    shared = _carried(known, states, "b").where("n_b is not null")
    return _carried(shared, states, "a")


def opponent_totals(both: DataFrame, keys: list[str], fold_days: float = 180.0) -> DataFrame:
    """The twelve features by ``keys``, from a row for each common opponent: matches, wins and last date of side a and side b."""
    ra, rb = F.col("w_a") / F.col("n_a"), F.col("w_b") / F.col("n_b")
    days = F.greatest(F.datediff("match_date", F.greatest("d_a", "d_b")), F.lit(0))
    weight = F.exp(-days / F.lit(fold_days)) * F.sqrt(F.least("n_a", "n_b").cast("double"))
    x = both.withColumns({"ra": ra, "rb": rb, "edge": ra - rb, "weight": weight})
    agg = x.groupBy(*keys).agg(
        F.count("*").alias("common_opp_count"), F.sum("n_a").alias("common_opp_player_matches_sum"), F.sum("n_b").alias("common_opp_opponent_matches_sum"),
        F.sum("w_a").alias("common_opp_player_wins_sum"), F.sum("w_b").alias("common_opp_opponent_wins_sum"),
        F.avg("ra").alias("common_opp_player_winrate_mean"), F.avg("rb").alias("common_opp_opponent_winrate_mean"), F.avg("edge").alias("common_opp_winrate_edge_mean"),
        F.try_divide(F.sum(F.col("weight") * F.col("edge")), F.sum("weight")).alias("common_opp_weighted_edge"), F.sum("weight").alias("common_opp_weight_sum"),
        F.sum(F.least("n_a", "n_b")).alias("common_opp_min_pair_matches_sum"),
    )
    return agg.withColumn("common_opp_available", F.lit(1))
