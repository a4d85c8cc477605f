"""Registered queries over the derived views, each with the SQL it is held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ratings as R
from ..functions import text as T
from ..functions.dates import format_dotted, parse_date, repair_month_start
from ..functions.score import score_features
from ..operators import evaluate as E
from ..operators import history as H
from ..operators import keyed as K
from ..operators.matching import match_names
from ..operators.quality import coverage, rank_pivot, rni_mapping
from ..operators.stored import stored
from ..operators.serve import common_opponents_report, h2h_detail, player_profiles, probability_timeline, recent_matches
from ..sources.pages import anchors, json_paths
from ..sources.views import table, view, with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = with_views(sql)
        return f

    return put


def r6(c: str) -> F.Column:
    return F.round(F.col(c).cast("double"), 6).alias(c)


def _long(spark: SparkSession, d: str) -> DataFrame:
    return H.perspectives(view(spark, d, "matches"))


LONG = """long as (select match_id, match_date, age_category, 'player1' as perspective, player1_id as player_id, player2_id as opponent_id, winner_player1 as win, games_diff from matches
union all select match_id, match_date, age_category, 'player2', player2_id, player1_id, 1 - winner_player1, -games_diff from matches)"""
RATED_LONG = f"""{LONG}, rated as (select l.*, a.points as player_points, a.place as player_rank, a.counting_tournaments as player_counting,
 b.points as opponent_points, b.place as opponent_rank, b.counting_tournaments as opponent_counting
 from long l asof left join ratings a on l.player_id = a.player_id and l.age_category = a.age_group and l.match_date >= a.classification_date
 asof left join ratings b on l.opponent_id = b.player_id and l.age_category = b.age_group and l.match_date >= b.classification_date)"""


_RATING = {"points": "points", "place": "rank", "counting_tournaments": "counting"}


def _rated(spark: SparkSession, d: str, names: dict[str, str] = _RATING) -> DataFrame:
    """Both sides' newest rating at or before the match, of its age category; ratings travel whole, so ``names`` are those that are read."""
    return K.asof_sides(_long(spark, d), view(spark, d, "ratings"), names, "rating_date")


@register(
    "flagship_history",
    f"""with {RATED_LONG} select match_id, perspective, player_id, opponent_id, win, round(player_points, 4) as player_points, round(player_points - opponent_points, 4) as points_diff,
 cast(player_rank as bigint) as player_rank,
 round(avg(win) over (partition by player_id order by match_date, match_id rows between unbounded preceding and 1 preceding), 6) as win_rate_pre,
 cast(date_diff('day', lag(match_date) over (partition by player_id order by match_date, match_id), match_date) as bigint) as rest_days,
 row_number() over (partition by player_id order by match_date, match_id) - 1 as matches_pre from rated""",
)
def flagship_history(spark: SparkSession, d: str) -> DataFrame:
    out = H.player_windows(_rated(spark, d))
    return out.select("match_id", "perspective", "player_id", "opponent_id", F.col("win").cast("int").alias("win"), F.round("player_points", 4).alias("player_points"), F.round(F.col("player_points") - F.col("opponent_points"), 4).alias("points_diff"), F.col("player_rank").cast("long").alias("player_rank"), r6("win_rate_pre"), F.col("rest_days").cast("long").alias("rest_days"), "matches_pre")


@register(
    "asof_rating",
    """select m.match_id, m.player1_id, r.classification_date as rating_date, round(r.points, 4) as points, cast(r.place as bigint) as place
 from matches m asof left join ratings r on m.player1_id = r.player_id and m.age_category = r.age_group and m.match_date >= r.classification_date""",
)
def asof_rating(spark: SparkSession, d: str) -> DataFrame:
    right = view(spark, d, "ratings").withColumnsRenamed({"player_id": "player1_id", "age_group": "age_category"})
    out = K.asof_join(view(spark, d, "matches"), right, ["player1_id", "age_category"], "match_date", "classification_date", ["points", "place"])
    return out.select("match_id", "player1_id", F.col("classification_date").alias("rating_date"), F.round("points", 4).alias("points"), F.col("place").cast("long").alias("place"))


@register(
    "rating_snapshot_fallback",
    """select request_id, classification_date, age_group, round(points, 4) as points, cast(place as bigint) as place from (
 select m.match_id as request_id, r.*, row_number() over (partition by m.match_id order by (r.age_group = '1-URGENT') desc, r.classification_date desc, r.age_group desc) as rn
 from matches m join ratings r on m.player2_id = r.player_id and r.classification_date <= m.match_date) where rn = 1""",
)
def rating_snapshot_fallback(spark: SparkSession, d: str) -> DataFrame:
    asked = view(spark, d, "matches").select(F.col("match_id").alias("request_id"), F.col("player2_id").alias("player_id"), F.col("match_date").alias("at"), F.lit("1-URGENT").alias("age"))
    out = K.rating_snapshot(asked, view(spark, d, "ratings"))
    return out.select("request_id", "classification_date", "age_group", F.round("points", 4).alias("points"), F.col("place").cast("long").alias("place"))


@register(
    "rating_dedup",
    "select player_id, classification_date, age_group, cast(place as bigint) as place, round(points, 4) as points from (select *, row_number() over (partition by player_id, classification_date order by place, age_group) as rn from ratings) where rn = 1",
)
def rating_dedup(spark: SparkSession, d: str) -> DataFrame:
    out = K.first_by_key(view(spark, d, "ratings"), ["player_id", "classification_date"], ["place", "age_group"])
    return out.select("player_id", "classification_date", "age_group", F.col("place").cast("long").alias("place"), F.round("points", 4).alias("points"))


@register("dup_report", "select l_orderkey, l_linenumber, l_partkey, count(*) over (partition by l_orderkey, l_linenumber) as copies from lineitem qualify copies > 1")
def dup_report(spark: SparkSession, d: str) -> DataFrame:
    return K.duplicates(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey", "l_linenumber"])


@register(
    "upsert_master",
    """select coalesce(e.tour_id, i.tour_id) as tour_id, coalesce(i.start_date, e.start_date) as start_date, coalesce(i.city, e.city) as city, coalesce(i.status, e.status) as status
 from master_existing e full join master_incoming i on e.tour_id = i.tour_id""",
)
def upsert_master(spark: SparkSession, d: str) -> DataFrame:
    return K.upsert(view(spark, d, "master_existing"), view(spark, d, "master_incoming"), "tour_id", ["start_date", "city", "status"])


@register("key_sets", "select 'new' as what, count(*) as n from (select tour_id from master_incoming except select tour_id from master_existing) union all select 'changed', count(*) from (select tour_id from master_incoming intersect select tour_id from master_existing) union all select 'kept', count(*) from (select tour_id from master_existing except select tour_id from master_incoming)")
def key_sets(spark: SparkSession, d: str) -> DataFrame:
    e, i = view(spark, d, "master_existing").select("tour_id"), view(spark, d, "master_incoming").select("tour_id")
    of = lambda what, df: df.agg(F.count("*").alias("n")).select(F.lit(what).alias("what"), "n")
    return of("new", i.join(e, "tour_id", "left_anti").distinct()).unionByName(of("changed", i.join(e, "tour_id", "left_semi").distinct())).unionByName(of("kept", e.join(i, "tour_id", "left_anti").distinct()))


@register("perspective_unpivot", f"with {LONG} select match_id, perspective, player_id, opponent_id, win, games_diff from long")
def perspective_unpivot(spark: SparkSession, d: str) -> DataFrame:
    return _long(spark, d).select("match_id", "perspective", "player_id", "opponent_id", "win", "games_diff")


@register("perspective_cardinality", f"with {LONG} select rows_per_match, count(*) as n from (select match_id, count(*) as rows_per_match from long group by 1) group by 1")
def perspective_cardinality(spark: SparkSession, d: str) -> DataFrame:
    return _long(spark, d).groupBy("match_id").agg(F.count("*").alias("rows_per_match")).groupBy("rows_per_match").agg(F.count("*").alias("n"))


_SETS = "[x for x in string_split(detailed_raw, ',') if x not like '[%']"


@register(
    "score_grammar",
    f"""with p as (select *, {_SETS} as sets, [x for x in string_split(detailed_raw, ',') if x like '[%'] as fin from match_scores),
 q as (select *, list_sum([cast(regexp_extract(x, '(\\d+)-(\\d+)', 1) as int) for x in sets]) as g1, list_sum([cast(regexp_extract(x, '(\\d+)-(\\d+)', 2) as int) for x in sets]) as g2,
 list_sum([coalesce(try_cast(regexp_extract(x, '\\((\\d+)\\)', 1) as int), 0) for x in sets]) + coalesce(list_sum([cast(regexp_extract(x, '(\\d+)-(\\d+)', 1) as int) + cast(regexp_extract(x, '(\\d+)-(\\d+)', 2) as int) for x in fin]), 0) as tbp from p)
 select match_id, score_raw as match_sets_score, cast(score_raw[1] as int) - cast(score_raw[3] as int) as match_sets_diff, cast(score_raw[1] > score_raw[3] as int) as winner_player1,
 fin[1] as final_tb_score, cast(len(fin) > 0 as int) as has_final_tb, cast(len(sets) + cast(len(fin) > 0 as int) as int) as n_sets, cast(g1 as double) as total_games_p1, cast(g2 as double) as total_games_p2,
 cast(g1 - g2 as double) as games_diff, case when tbp > 0 then cast(tbp as double) end as total_points_tiebreak, round(cast(g1 - g2 as double) / len(sets), 6) as games_diff_per_set,
 round(cast(g1 - g2 as double) / nullif(g1 + g2, 0), 6) as dominance_index, regexp_extract(sets[1], '\\d+-\\d+') as set1_score, regexp_extract(sets[2], '\\d+-\\d+') as set2_score, try_cast(regexp_extract(sets[2], '\\((\\d+)\\)', 1) as double) as set2_tb from q""",
)
def score_grammar(spark: SparkSession, d: str) -> DataFrame:
    s = score_features(view(spark, d, "match_scores"))
    return s.select("match_id", "match_sets_score", "match_sets_diff", "winner_player1", "final_tb_score", "has_final_tb", F.col("n_sets").cast("int").alias("n_sets"), "total_games_p1", "total_games_p2", "games_diff", "total_points_tiebreak", r6("games_diff_per_set"), r6("dominance_index"), "set1_score", "set2_score", "set2_tb")


@register(
    "name_keys",
    """select player_id, regexp_replace(lower(full_name), '[^a-z0-9]+', ' ', 'g') as player_key,
 array_to_string(list_concat(string_split(lower(full_name), ' ')[1:1], [x[1] for x in string_split(lower(full_name), ' ')[2:3]]), ' ') as full_key,
 trim(regexp_replace(lower(raw_name), '[^a-z0-9]+', ' ', 'g')) as raw_key, concat('RNI:', cast(player_id as varchar)) as rni, regexp_replace(lower(full_name), '[^0-9a-z]+', '_', 'g') as slug from players""",
)
def name_keys(spark: SparkSession, d: str) -> DataFrame:
    p = view(spark, d, "players")
    return p.select("player_id", T.normalize_player_key(F.col("full_name")).alias("player_key"), T.surname_initials_key(F.col("full_name")).alias("full_key"), T.surname_initials_key(F.col("raw_name")).alias("raw_key"), T.safe_rni_id(F.concat(F.col("player_id").cast("string"), F.lit(".0"))).alias("rni"), T.slugify(F.col("full_name")).alias("slug"))


_KEYS = """people as (select array_to_string(list_concat(string_split(lower(full_name), ' ')[1:1], [x[1] for x in string_split(lower(full_name), ' ')[2:3]]), ' ') as name_key, cast(player_id as varchar) as player_id from players),
 cand as (select name_key, list_sort(list(distinct player_id)) as c from people group by 1),
 seen as (select raw_name, trim(regexp_replace(lower(raw_name), '[^a-z0-9]+', ' ', 'g')) as name_key, count(*) as appearances from players group by 1, 2)"""


@register("name_match_audit", f"with {_KEYS} select raw_name, seen.name_key, appearances, coalesce(len(c), 0)::bigint as n_candidates, array_to_string(c, '; ') as candidates, case when len(c) = 1 then c[1] end as player_id, case when len(c) = 1 then 'matched' when len(c) > 1 then 'ambiguous' else 'unmatched' end as status from seen left join cand using (name_key)")
def name_match_audit(spark: SparkSession, d: str) -> DataFrame:
    p = view(spark, d, "players")
    return match_names(p.select("raw_name"), p)


@register(
    "name_match_override",
    f"""with {_KEYS}, o as (select trim(regexp_replace(lower(raw_name), '[^a-z0-9]+', ' ', 'g')) as name_key, cast(min(player_id) as varchar) as override_id from players where player_id % 7 = 0 group by 1)
 select raw_name, coalesce(override_id, case when len(c) = 1 then c[1] end) as player_id, case when override_id is not null or len(c) = 1 then 'matched' when len(c) > 1 then 'ambiguous' else 'unmatched' end as status
 from seen left join cand using (name_key) left join o using (name_key)""",
)
def name_match_override(spark: SparkSession, d: str) -> DataFrame:
    p = view(spark, d, "players")
    o = p.where("player_id % 7 = 0").groupBy(T.normalize_player_key(F.col("raw_name")).alias("name_key")).agg(F.min("player_id").cast("string").alias("override_id"))
    return match_names(p.select("raw_name"), p, o).select("raw_name", "player_id", "status")


@register(
    "coverage",
    f"""with {RATED_LONG}, a as (select count(distinct match_id) as matches, count(*) as n, count(distinct player_id) as players, round(avg(case when player_points is null then 0.0 else 1.0 end), 6) as rated,
 round(avg(case when player_points is not null and opponent_points is not null then 1.0 else 0.0 end), 6) as both_rated from rated)
 select 'matches' as metric, cast(matches as double) as value from a union all select 'rows', cast(n as double) from a union all select 'players', cast(players as double) from a union all select 'rating_coverage', rated from a union all select 'both_rated', both_rated from a""",
)
def coverage_query(spark: SparkSession, d: str) -> DataFrame:
    return coverage(_rated(spark, d))


@register(
    "player_windows",
    f"""with {LONG} select match_id, perspective, round(avg(win) over b, 6) as win_rate_pre, row_number() over w - 1 as matches_pre, cast(date_diff('day', lag(match_date) over w, match_date) as bigint) as rest_days,
 case when count(*) over l10 = 10 then round(avg(win) over l10, 6) end as form10_full, round(avg(win) over l5, 6) as form5_partial, round(avg(win) over c10, 6) as form10_curve from long
 window w as (partition by player_id order by match_date, match_id), b as (partition by player_id order by match_date, match_id rows between unbounded preceding and 1 preceding),
 l10 as (partition by player_id order by match_date, match_id rows between 10 preceding and 1 preceding), l5 as (partition by player_id order by match_date, match_id rows between 5 preceding and 1 preceding),
 c10 as (partition by player_id order by match_date, match_id rows between 9 preceding and current row)""",
)
def player_windows(spark: SparkSession, d: str) -> DataFrame:
    return H.player_windows(_long(spark, d)).select("match_id", "perspective", r6("win_rate_pre"), "matches_pre", F.col("rest_days").cast("long").alias("rest_days"), r6("form10_full"), r6("form5_partial"), r6("form10_curve"))


@register(
    "h2h_running",
    f"""with {LONG} select match_id, perspective, count(*) over h as h2h_matches_before, cast(coalesce(sum(win) over h, 0) as bigint) as h2h_wins_before,
 round(case when count(*) over h > 0 then cast(sum(win) over h as double) / count(*) over h else 0.5 end, 6) as h2h_win_rate_before from long
 window h as (partition by least(player_id, opponent_id), greatest(player_id, opponent_id), player_id order by match_date, match_id rows between unbounded preceding and 1 preceding)""",
)
def h2h_running(spark: SparkSession, d: str) -> DataFrame:
    return H.head_to_head(_long(spark, d)).select("match_id", "perspective", "h2h_matches_before", "h2h_wins_before", r6("h2h_win_rate_before"))


def _elo_steps(pool: str, k: float, margin: float, days: float, only: str = "") -> str:
    """Ratings by recursion over the matches in order, with one state map a pool."""
    return f"""with recursive o as (select *, row_number() over (partition by {pool} order by match_date, match_id) as i, {pool} as pool from matches{only}),
 s as (select cast(0 as bigint) as i, pool, cast(null as bigint) as match_id, 0.0::double as ra, 0.0::double as rb, 0.0::double as ex, map([]::bigint[], []::double[]) as st, map([]::bigint[], []::date[]) as ld from (select distinct pool from o)
 union all
 select i, pool, match_id, ra, rb, ex, map_concat(st, map([p1, p2], [ra + kk * wa * (w - ex), rb + kk * wb * (ex - w)])), map_concat(ld, map([p1, p2], [dt, dt])) from (
  select *, 1.0 / (1.0 + power(10.0::double, (rb - ra) / 400.0)) as ex from (
  select o.i, o.pool, o.match_id, o.player1_id as p1, o.player2_id as p2, o.match_date as dt, cast(o.winner_player1 as double) as w, s.st, s.ld,
   coalesce(element_at(s.st, o.player1_id)[1], 1500.0::double) as ra, coalesce(element_at(s.st, o.player2_id)[1], 1500.0::double) as rb,
   {k}::double * (1.0 + {margin}::double * ln(1.0::double + abs(o.games_diff))) as kk,
   coalesce(2.0 - exp(-cast(date_diff('day', element_at(s.ld, o.player1_id)[1], o.match_date) as double) / {days}::double), 1.0::double) as wa,
   coalesce(2.0 - exp(-cast(date_diff('day', element_at(s.ld, o.player2_id)[1], o.match_date) as double) / {days}::double), 1.0::double) as wb
  from s join o on o.i = s.i + 1 and o.pool = s.pool)))"""


def _elo_sql(pool: str, k: float, margin: float, days: float) -> str:
    return f"""{_elo_steps(pool, k, margin, days)}
 select match_id, round(ra, 5) as elo1_pre, round(rb, 5) as elo2_pre, round(ex, 6) as expected1 from s where i > 0"""


def _elo_out(df: DataFrame) -> DataFrame:
    return df.select("match_id", F.round("elo1_pre", 5).alias("elo1_pre"), F.round("elo2_pre", 5).alias("elo2_pre"), r6("expected1"))


@register("elo_global", _elo_sql("'all'", 24.0, 0.3, 90.0))
def elo_global(spark: SparkSession, d: str) -> DataFrame:
    return _elo_out(H.elo(view(spark, d, "matches")))


@register("elo_by_category", _elo_sql("age_category", 24.0, 0.3, 90.0))
def elo_by_category(spark: SparkSession, d: str) -> DataFrame:
    return _elo_out(H.elo(view(spark, d, "matches"), pool="age_category"))


@register("elo_serving", _elo_sql("'all'", 32.0, 0.08, 45.0))
def elo_serving(spark: SparkSession, d: str) -> DataFrame:
    return _elo_out(H.elo(view(spark, d, "matches"), preset=H.SERVE_ELO))


_COMMON = f"""{LONG}, past as materialized (select l.match_id, l.perspective, l.player_id = h.player_id as own, h.opponent_id as c, count(*) as n, sum(h.win) as wins, max(h.match_date) as last_date
  from (select *, unnest([player_id, opponent_id]) as who from long) l join long h on h.player_id = l.who and (h.match_date, h.match_id) < (l.match_date, l.match_id) and h.opponent_id not in (l.player_id, l.opponent_id) group by 1, 2, 3, 4),
 x as (select a.match_id, a.perspective, a.n as na, b.n as nb, a.wins as wa, b.wins as wb, cast(a.wins as double) / a.n as ra, cast(b.wins as double) / b.n as rb,
  exp(-cast(greatest(date_diff('day', greatest(a.last_date, b.last_date), l.match_date), 0) as double) / cast(180 as double)) * sqrt(cast(least(a.n, b.n) as double)) as wt
  from past a join past b on a.match_id = b.match_id and a.perspective = b.perspective and a.c = b.c and a.own and not b.own join long l on l.match_id = a.match_id and l.perspective = a.perspective)"""


@register(
    "common_opponents",
    f"""with {_COMMON} select match_id, perspective, count(*) as common_opp_count, cast(sum(na) as bigint) as common_opp_player_matches_sum, cast(sum(nb) as bigint) as common_opp_opponent_matches_sum,
 cast(sum(wa) as bigint) as common_opp_player_wins_sum, cast(sum(wb) as bigint) as common_opp_opponent_wins_sum, round(avg(ra), 10) as common_opp_player_winrate_mean, round(avg(rb), 10) as common_opp_opponent_winrate_mean,
 round(avg(ra - rb), 10) + 0.0::double as common_opp_winrate_edge_mean, round(sum(wt * (ra - rb)) / sum(wt), 6) + 0.0::double as common_opp_weighted_edge, round(sum(wt), 6) as common_opp_weight_sum, cast(sum(least(na, nb)) as bigint) as common_opp_min_pair_matches_sum, 1 as common_opp_available from x group by 1, 2""",
)
def common_opponents(spark: SparkSession, d: str) -> DataFrame:
    out = H.common_opponents(_long(spark, d))
    digits = {"common_opp_player_winrate_mean": 10, "common_opp_opponent_winrate_mean": 10, "common_opp_winrate_edge_mean": 10, "common_opp_weighted_edge": 6, "common_opp_weight_sum": 6}
    return out.withColumns({c: F.round(c, n) + F.lit(0.0) for c, n in digits.items()})  # no negative zero


@register(
    "rating_features",
    f"""with {RATED_LONG}, x as (select *, case when player_counting > 0 then player_points / player_counting end as ppc, case when opponent_counting > 0 then opponent_points / opponent_counting end as opc from rated)
 select match_id, perspective, round(ppc, 4) as player_points_per_counting, round(opc, 4) as opponent_points_per_counting,
 round(case when player_points is not null and opponent_points is not null and least(player_points, opponent_points) > 0 then 100 * (player_points - opponent_points) / least(player_points, opponent_points) end, 4) as rel_diff_points_pct,
 round(case when ppc is not null and opc is not null and least(ppc, opc) > 0 then 100 * (ppc - opc) / least(ppc, opc) end, 4) as rel_diff_per_counting_pct,
 cast(player_points is null as int) as player_points_missing_pre, cast(opponent_points is null as int) as opponent_points_missing_pre, cast(player_points is not null and opponent_points is not null as int) as both_points_observed_pre,
 round(player_points - opponent_points, 4) as diff_points_pre_observed_only, cast(player_rank - opponent_rank as bigint) as diff_rank_pre_observed_only, round(ln(1 + player_points), 6) as log_points from x""",
)
def rating_features(spark: SparkSession, d: str) -> DataFrame:
    x = _rated(spark, d).withColumns({"ppc": R.per_counting(F.col("player_points"), F.col("player_counting")), "opc": R.per_counting(F.col("opponent_points"), F.col("opponent_counting"))})
    flags = R.observed_only(F.col("player_points"), F.col("opponent_points"), "points")
    rank = R.observed_only(F.col("player_rank"), F.col("opponent_rank"), "rank")["diff_rank_pre_observed_only"]
    return x.select(
        "match_id", "perspective", F.round("ppc", 4).alias("player_points_per_counting"), F.round("opc", 4).alias("opponent_points_per_counting"),
        F.round(R.relative_diff(F.col("player_points"), F.col("opponent_points")), 4).alias("rel_diff_points_pct"), F.round(R.relative_diff(F.col("ppc"), F.col("opc")), 4).alias("rel_diff_per_counting_pct"),
        *[(F.round(c, 4) if k.startswith("diff") else c).alias(k) for k, c in flags.items()], rank.cast("long").alias("diff_rank_pre_observed_only"), F.round(F.log1p("player_points"), 6).alias("log_points"),
    )


@register("flag_violations", f"with {RATED_LONG} select count(*) as n, cast(coalesce(sum(case when (player_points is null or opponent_points is null) and (player_points - opponent_points) is not null then 1 else 0 end), 0) as bigint) as violations from rated")
def flag_violations(spark: SparkSession, d: str) -> DataFrame:
    x = _rated(spark, d).withColumns(R.observed_only(F.col("player_points"), F.col("opponent_points"), "points"))
    wrong = (F.col("both_points_observed_pre") == 0) & F.col("diff_points_pre_observed_only").isNotNull()
    return x.agg(F.count("*").alias("n"), F.coalesce(F.sum(wrong.cast("long")), F.lit(0)).alias("violations"))


@register("temporal_split", "select is_test, count(*) as n, min(match_date) as first_date, max(match_date) as last_date from (select *, cast(match_date >= (select cast(max(match_date) - interval 3 month as date) from matches) as int) as is_test from matches) group by 1")
def temporal_split(spark: SparkSession, d: str) -> DataFrame:
    return E.temporal_split(view(spark, d, "matches")).groupBy("is_test").agg(F.count("*").alias("n"), F.min("match_date").alias("first_date"), F.max("match_date").alias("last_date"))


@register(
    "dev_valid_split",
    """with dts as (select match_date, row_number() over (order by match_date) as rk from (select distinct match_date from matches)), n as (select count(*) as c from dts)
 select is_valid, count(*) as n, min(match_date) as first_date from (select m.match_date, cast(rk > greatest(1, least(c - 1, cast(floor(c * 0.8::double) as bigint))) as int) as is_valid from matches m join dts using (match_date) cross join n) group by 1""",
)
def dev_valid_split(spark: SparkSession, d: str) -> DataFrame:
    return E.dev_valid_split(view(spark, d, "matches")).groupBy("is_valid").agg(F.count("*").alias("n"), F.min("match_date").alias("first_date"))


_SCORED = "scored as (select match_id, winner_player1 as y, games_diff as gd, round(1 / (1 + exp(-games_diff / cast(20 as double))), 2) as p, case when qa % 3 = 0 then 'a' when qa % 3 = 1 then 'b' else 'c' end as model from matches)"


def _scored(spark: SparkSession, d: str) -> DataFrame:
    m = view(spark, d, "matches")
    return m.select("match_id", F.col("winner_player1").alias("y"), F.col("games_diff").alias("gd"), F.round(1 / (1 + F.exp(-F.col("games_diff") / 20)), 2).alias("p"), F.expr("case when qa % 3 = 0 then 'a' when qa % 3 = 1 then 'b' else 'c' end").alias("model"))


def _metric_sql(source: str, by: str) -> str:
    return f"""c as (select *, greatest(1e-6, least(1 - 1e-6, p)) as q from {source} where p is not null and y is not null),
 k as (select *, rank() over (partition by {by} order by q) + (count(*) over (partition by {by}, q) - 1) / 2.0::double as rk from c),
 m as (select {by}, count(*) as n, round(avg(-(y * ln(q) + (1 - y) * ln(1 - q))), 6) as logloss, round(avg((q - y) * (q - y)), 6) as brier, round(avg(case when cast(q >= 0.5 as int) = y then 1.0::double else 0.0 end), 6) as accuracy,
 round((sum(case when y = 1 then rk else 0 end) - sum(y) * (sum(y) + 1) / 2.0::double) / (sum(y) * (count(*) - sum(y))), 6) as roc_auc from k group by {by})"""


@register("metrics_by_model", f"with {_SCORED}, {_metric_sql('scored', 'model')} select * from m")
def metrics_by_model(spark: SparkSession, d: str) -> DataFrame:
    m = E.metrics(_scored(spark, d), ["model"])
    return m.select("model", "n", r6("logloss"), r6("brier"), r6("accuracy"), r6("roc_auc"))


GRID = (5.0, 10.0, 20.0, 40.0, 80.0, 160.0)


@register("scale_grid", f"with {_SCORED}, g as (select gd, y, s as scale, 1 / (1 + exp(-gd / s * ln(10.0::double))) as p from scored, unnest({list(GRID)}::double[]) as u(s)), {_metric_sql('g', 'scale')} select *, row_number() over (order by logloss, brier, roc_auc desc) as place from m")
def scale_grid(spark: SparkSession, d: str) -> DataFrame:
    m = E.scale_grid(_scored(spark, d), "gd", GRID)
    return m.select("scale", "n", r6("logloss"), r6("brier"), r6("accuracy"), r6("roc_auc"), F.col("place").cast("long").alias("place"))


@register("calibration_bins", f"with {_SCORED}, e as (select quantile_cont(p, [0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875]) as edges from scored) select cast(len([x for x in edges if x < p]) as int) as bin, count(*) as n, round(avg(p), 6) as mean_pred, round(avg(y), 6) as frac_pos from scored, e group by 1")
def calibration_bins(spark: SparkSession, d: str) -> DataFrame:
    return E.calibration_bins(_scored(spark, d)).select(F.col("bin").cast("int").alias("bin"), "n", r6("mean_pred"), r6("frac_pos"))


@register("roc_points", f"with {_SCORED}, t as (select p as threshold, sum(y) as pos, count(*) - sum(y) as neg from scored group by 1) select threshold, round(cast(sum(pos) over w as double) / sum(pos) over (), 6) as tpr, round(cast(sum(neg) over w as double) / sum(neg) over (), 6) as fpr from t window w as (order by threshold desc)")
def roc_points(spark: SparkSession, d: str) -> DataFrame:
    return E.roc_points(_scored(spark, d)).select("threshold", r6("tpr"), r6("fpr"))


@register("confusion", f"with {_SCORED} select cast(y as int) as fact, cast(p >= 0.5 as int) as predicted, count(*) as n from scored group by 1, 2")
def confusion(spark: SparkSession, d: str) -> DataFrame:
    return E.confusion(_scored(spark, d))


@register("symmetrised", f"with {LONG}, s as (select match_id, perspective, round(1 / (1 + exp(-games_diff / cast(20 as double) - 0.1::double)), 6) as p from long), w as (select match_id, max(case when perspective = 'player1' then p end) as p_ab, max(case when perspective = 'player2' then p end) as p_ba from s group by 1) select match_id, p_ab, p_ba, round((p_ab + 1 - p_ba) / 2, 8) as p1, round(abs(p_ab - (1 - p_ba)), 8) as gap from w")
def symmetrised(spark: SparkSession, d: str) -> DataFrame:
    scored = _long(spark, d).withColumn("p", F.round(1 / (1 + F.exp(-F.col("games_diff") / 20 - 0.1)), 6))
    return E.symmetrised(scored).select("match_id", "p_ab", "p_ba", F.round("p1", 8).alias("p1"), F.round("gap", 8).alias("gap"))


@register("mode_selection", f"with {_SCORED}, {_metric_sql('scored', 'model')}, g as (select model as mode, logloss, round(abs(accuracy - roc_auc), 6) as gap from m) select * from g where logloss <= (select min(logloss) from g) + 0.0025 order by gap, logloss, mode limit 1")
def mode_selection(spark: SparkSession, d: str) -> DataFrame:
    m = metrics_by_model(spark, d).select(F.col("model").alias("mode"), "logloss", F.round(F.abs(F.col("accuracy") - F.col("roc_auc")), 6).alias("gap"))
    return E.select_mode(m)


@register("column_profile", "select 'qa' as feature, 0.0::double as missing, round(avg(qa), 6) as mean, round(stddev_samp(qa), 6) as std, cast(min(qa) as double) as min, cast(max(qa) as double) as max from matches union all select 'games_diff', round(avg(case when games_diff is null then 1.0 else 0.0 end), 6), round(avg(games_diff), 6), round(stddev_samp(games_diff), 6), min(games_diff), max(games_diff) from matches")
def column_profile(spark: SparkSession, d: str) -> DataFrame:
    return E.column_profile(view(spark, d, "matches"), ["qa", "games_diff"]).select("feature", r6("missing"), r6("mean"), r6("std"), "min", "max")


@register("median_impute", f"with {RATED_LONG}, m as (select median(player_points) as a, median(opponent_points) as b from rated) select match_id, perspective, round(coalesce(player_points, a), 4) as player_points, round(coalesce(opponent_points, b), 4) as opponent_points from rated, m")
def median_impute(spark: SparkSession, d: str) -> DataFrame:
    cols = ["player_points", "opponent_points"]
    x = stored(_rated(spark, d, {"points": "points"}).select("match_id", "perspective", *cols))  # read for the medians' passes and for the result
    return E.impute(x, E.medians(x, cols), cols).select("match_id", "perspective", *[F.round(c, 4).alias(c) for c in cols])


@register("rank_pivot", "select classification_date, count(*) filter (age_group = '1-URGENT') as urgent, count(*) filter (age_group = '2-HIGH') as high, count(*) filter (age_group = '5-LOW') as low from ratings group by 1")
def rank_pivot_query(spark: SparkSession, d: str) -> DataFrame:
    return rank_pivot(view(spark, d, "ratings"), {"1-URGENT": "urgent", "2-HIGH": "high", "5-LOW": "low"})


@register("rni_mapping", "select player_id, min(strftime(classification_date, '%d.%m.%Y')) as first_text, max(classification_date) as last_date, count(distinct classification_date) as n_dates, array_to_string(list_sort(list(distinct age_group)), '; ') as groups from ratings group by 1")
def rni_mapping_query(spark: SparkSession, d: str) -> DataFrame:
    return rni_mapping(view(spark, d, "ratings"))


@register("player_profiles", f"with {LONG}, h as (select * from long where match_date < date '1997-06-01'), r as (select *, row_number() over (partition by player_id order by match_date desc, match_id desc) as rn from h) select player_id, count(*) as matches, cast(sum(win) as bigint) as wins, round(avg(win), 6) as win_rate, round(avg(case when rn <= 10 then win end), 6) as form10, round(avg(case when rn <= 5 then win end), 6) as form5, max(match_date) as last_date, count(distinct opponent_id) as opponents from r group by 1")
def player_profiles_query(spark: SparkSession, d: str) -> DataFrame:
    return player_profiles(_long(spark, d), "1997-06-01")


@register("recent_matches", f"with {LONG}, r as (select *, row_number() over (partition by player_id order by match_date desc, match_id desc) as rn from long where match_date < date '1997-06-01') select player_id, match_date, match_id, opponent_id, win from r where rn <= 10")
def recent_matches_query(spark: SparkSession, d: str) -> DataFrame:
    return recent_matches(_long(spark, d), "1997-06-01", 10)


@register("h2h_detail", f"with {LONG} select match_id, match_date, player_id, opponent_id, win from long where match_date < date '1997-06-01' and player_id = 1 and opponent_id = 2")
def h2h_detail_query(spark: SparkSession, d: str) -> DataFrame:
    return h2h_detail(_long(spark, d), 1, 2, "1997-06-01")


@register("common_opponents_report", f"with {LONG}, h as (select * from long where match_date < date '1997-06-01'), a as (select opponent_id as c, count(*) as na, sum(win) as wa, max(match_date) as da from h where player_id = 1 and opponent_id <> 2 group by 1), b as (select opponent_id as c, count(*) as nb, sum(win) as wb, max(match_date) as db from h where player_id = 2 and opponent_id <> 1 group by 1) select c as common_id, na as player_matches, cast(wa as bigint) as player_wins, nb as opponent_matches, cast(wb as bigint) as opponent_wins, round(cast(wa as double) / na - cast(wb as double) / nb, 6) as edge, round(exp(-cast(date_diff('day', greatest(da, db), date '1997-06-01') as double) / 180) * sqrt(cast(least(na, nb) as double)), 6) as weight from a join b using (c)")
def common_opponents_report_query(spark: SparkSession, d: str) -> DataFrame:
    return common_opponents_report(_long(spark, d), 1, 2, "1997-06-01")


@register("timeline", f"with {LONG}, t as (select cast(x as date) as on_date from generate_series(date '1996-01-01', date '1996-12-01', interval 1 month) g(x)), h as (select t.on_date, l.player_id, sum(l.win) as w, count(*) as n from t join long l on l.match_date < t.on_date and l.player_id in (1, 2) group by 1, 2), p as (select on_date, max(case when player_id = 1 then cast(w as double) / n end) as a, max(case when player_id = 2 then cast(w as double) / n end) as b from h group by 1) select on_date, round(a, 6) as player1_rate, round(b, 6) as player2_rate, round(0.5 + 0.5 * (a - b), 6) as p1 from p")
def timeline(spark: SparkSession, d: str) -> DataFrame:
    return probability_timeline(_long(spark, d), 1, 2, "1996-01-01", "1996-12-01")


@register("page_anchors", r"select page_id, unnest(list_distinct(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1))) as href from pages")
def page_anchors(spark: SparkSession, d: str) -> DataFrame:
    return anchors(table(spark, d, "pages"))


@register("page_text", r"select page_id, length(trim(regexp_replace(regexp_replace(regexp_replace(html, '<(?:script|style)\b[^>]*>[^<]*(?:</p>[^<]*)?</(?:script|style)>', ' ', 'gi'), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))) > 0 as has_text, regexp_extract(html, '<h1>([^<]*)', 1) as heading, regexp_replace(url, '[?#].*$', '') as clean_url from pages")
def page_text(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "pages")
    return p.select("page_id", (F.length(T.strip_html(F.col("html"))) > 0).alias("has_text"), F.regexp_extract("html", "<h1>([^<]*)", 1).alias("heading"), T.without_query(F.col("url")).alias("clean_url"))


@register("json_paths", "select event_id, 'k' as path, json_extract_string(props, '$.k') as value from events")
def json_paths_query(spark: SparkSession, d: str) -> DataFrame:
    return json_paths(table(spark, d, "events"), "event_id", "props")


@register("date_functions", "select o_orderkey, strftime(o_orderdate, '%d.%m.%Y') as dotted, cast(o_orderdate as date) as parsed, case when month(o_orderdate) = 1 and day(o_orderdate) between 2 and 12 then make_date(year(o_orderdate), day(o_orderdate), 1) else cast(o_orderdate as date) end as repaired from orders")
def date_functions(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return o.select("o_orderkey", format_dotted(F.col("day")).alias("dotted"), parse_date(F.concat(F.lit("с "), format_dotted(F.col("day")))).alias("parsed"), repair_month_start(F.col("day")).alias("repaired"))


@register("worklist", "select action, count(*) as n from (select case when o_orderstatus = 'P' then 'cancelled' when o_orderdate > timestamp '1998-01-01' then 'future' when o_orderkey % 4 = 0 then 'cached' else 'process' end as action from orders) group by 1")
def worklist(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    action = F.when(F.col("o_orderstatus") == "P", "cancelled").when(F.col("o_orderdate") > F.lit("1998-01-01").cast("timestamp"), "future").when(F.col("o_orderkey") % 4 == 0, "cached").otherwise("process")
    return o.groupBy(action.alias("action")).agg(F.count("*").alias("n"))


@register("value_counts", "select age_category, count(*) as n, count(distinct player1_id) as players from matches group by 1 order by n desc, age_category")
def value_counts(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "matches").groupBy("age_category").agg(F.count("*").alias("n"), F.countDistinct("player1_id").alias("players")).orderBy(F.desc("n"), "age_category")


@register("top_k", "select match_id, games_diff from matches order by games_diff desc, match_id limit 120")
def top_k(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "matches").select("match_id", "games_diff").orderBy(F.desc("games_diff"), "match_id").limit(120)


@register("conversation_lag", "select conv_id, turn, lag(role) over w as previous_role, row_number() over w as position, count(*) over (partition by conv_id) as turns from conversations window w as (partition by conv_id order by turn)")
def conversation_lag(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn")
    return table(spark, d, "conversations").select("conv_id", "turn", F.lag("role").over(w).alias("previous_role"), F.row_number().over(w).cast("long").alias("position"), F.count("*").over(Window.partitionBy("conv_id")).alias("turns"))


@register("long_features")
def long_features(spark: SparkSession, d: str) -> DataFrame:
    """All history features of each match and side in one table."""
    from ..operators.assemble import long_features as build

    return build(view(spark, d, "matches"), view(spark, d, "ratings"))


from . import learned, more, scans  # noqa: E402, F401  register their queries
