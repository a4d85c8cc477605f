"""Further registered queries: the enriched match table and its audits, merges, page records, dates, model tables.

Queries over pages write the page's markup from table rows and parse it again, so their SQL is the rows themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as T
from ..operators import enrich as N
from ..operators import evaluate as E
from ..operators import history as H
from ..operators import keyed as K
from ..operators import master as M
from ..operators import serve as S
from ..operators.matching import ambiguous_names, attach_ids, match_names
from ..operators.forecast import pair_rows, rating_history
from ..sources import pages as P
from ..sources.views import table, view
from .registry import _elo_steps, _KEYS, LONG, _long, _metric_sql, _scored, _SCORED, r6, register

#: Matches by name as a page gives them: some twice, some without a name or a winner.
RAW = """raw as (select m.match_id, m.match_date, case when m.match_id % 97 = 0 then '' else a.raw_name end as player1_raw, b.raw_name as player2_raw, s.detailed_raw as result_sets, s.score_raw as summary_score_raw,
 case when m.match_id % 89 = 0 then null else m.winner_player1 end as winner_player1, 'Cup' as tournament_name, m.age_category as tournament_age_category, u.copy
 from matches m join match_scores s on s.match_id = m.match_id join players a on a.player_id = m.player1_id join players b on b.player_id = m.player2_id cross join (select 0 as copy union all select 1) u where u.copy = 0 or m.match_id % 11 = 0)"""


def _raw(spark: SparkSession, d: str) -> DataFrame:
    m, s, p = view(spark, d, "matches"), view(spark, d, "match_scores"), view(spark, d, "players").select("player_id", "raw_name")
    named = lambda side: p.withColumnsRenamed({"player_id": f"{side}_id", "raw_name": f"{side}_raw"})
    both = m.join(s, "match_id").join(named("player1"), "player1_id").join(named("player2"), "player2_id")
    copies = both.withColumn("copy", F.explode(F.when(F.col("match_id") % 11 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return copies.select(
        "match_id", "match_date", F.when(F.col("match_id") % 97 == 0, "").otherwise(F.col("player1_raw")).alias("player1_raw"), "player2_raw", F.col("detailed_raw").alias("result_sets"), F.col("score_raw").alias("summary_score_raw"),
        F.when(F.col("match_id") % 89 != 0, F.col("winner_player1")).alias("winner_player1"), F.lit("Cup").alias("tournament_name"), F.col("age_category").alias("tournament_age_category"), "copy",
    )


_VALID = "good as (select * from raw where player1_raw <> '' and winner_player1 is not null)"
_IDS = f"{_KEYS}, ids as (select raw_name, case when len(c) = 1 then c[1] end as player_id, case when len(c) = 1 then 'matched' when len(c) > 1 then 'ambiguous' else 'unmatched' end as status from seen left join cand using (name_key))"
_RATED = f"""{RAW}, {_VALID}, {_IDS}, named as (select g.*, a.player_id as player1_id, a.status as player1_match_status, b.player_id as player2_id, b.status as player2_match_status from good g left join ids a on a.raw_name = g.player1_raw left join ids b on b.raw_name = g.player2_raw),
 r as (select cast(player_id as varchar) as player_id, lower(age_group) as age, age_group, classification_date, points, place from ratings),
 enriched as (select n.*, a.points as player1_points_pre, a.place as player1_rank_pre, a.age_group as player1_rating_age_group_pre, b.points as player2_points_pre, b.place as player2_rank_pre, b.age_group as player2_rating_age_group_pre from named n
 asof left join r a on n.player1_id = a.player_id and lower(n.tournament_age_category) = a.age and n.match_date >= a.classification_date
 asof left join r b on n.player2_id = b.player_id and lower(n.tournament_age_category) = b.age and n.match_date >= b.classification_date)"""
_SAME = "match_date, player1_raw, player2_raw, result_sets, summary_score_raw, winner_player1, tournament_name, tournament_age_category"


def _enriched(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    people = view(spark, d, "players")
    return N.matches_enriched(_raw(spark, d), match_names(people.select("raw_name"), people), view(spark, d, "ratings"), ["match_id", "copy"])


@register(
    "matches_enriched",
    f"""with {_RATED} select match_id, player1_raw, player2_raw, player1_id, player2_id, player1_match_status, player2_match_status, round(player1_points_pre, 4) as player1_points_pre, round(player2_points_pre, 4) as player2_points_pre,
 round(player1_points_pre - player2_points_pre, 4) as points_diff_pre, cast(player1_rank_pre - player2_rank_pre as bigint) as rank_diff_pre from (select *, row_number() over (partition by {_SAME} order by match_id, copy) as rn from enriched) where rn = 1""",
)
def matches_enriched(spark: SparkSession, d: str) -> DataFrame:
    out, _, _ = _enriched(spark, d)
    points = [F.round(c, 4).alias(c) for c in ("player1_points_pre", "player2_points_pre", "points_diff_pre")]
    return out.select("match_id", "player1_raw", "player2_raw", "player1_id", "player2_id", "player1_match_status", "player2_match_status", *points, F.col("rank_diff_pre").cast("long").alias("rank_diff_pre"))


@register("matches_dropped", f"with {_RATED} select 'invalid' as why, match_id, copy from raw where player1_raw = '' or winner_player1 is null union all select 'repeated', match_id, copy from (select *, count(*) over (partition by {_SAME}) as n from enriched) where n > 1")
def matches_dropped(spark: SparkSession, d: str) -> DataFrame:
    _, bad, twice = _enriched(spark, d)
    of = lambda why, df: df.select(F.lit(why).alias("why"), "match_id", "copy")
    return of("invalid", bad).unionByName(of("repeated", twice))


@register(
    "match_table",
    f"with {RAW}, {_VALID}, one as (select *, row_number() over (partition by {_SAME.replace('player1_raw, player2_raw, ', 'player1_raw, player2_raw, ')} order by match_date, match_id, copy) as rn from good) select row_number() over (order by match_date, match_id, copy) - 1 as row_id, match_id, copy from one where rn = 1",
)
def match_table(spark: SparkSession, d: str) -> DataFrame:
    good, _ = N.split_valid(_raw(spark, d))
    named = good.withColumnsRenamed({"player1_raw": "player1_id", "player2_raw": "player2_id"})
    return N.match_table(named, ["match_id", "copy"]).select("row_id", "match_id", "copy")


@register("players_without_rating", f"with {_RATED} select distinct match_date, player1_raw, player1_id, player2_raw, player2_id from enriched where player1_points_pre is null or player2_points_pre is null")
def players_without_rating(spark: SparkSession, d: str) -> DataFrame:
    out, _, _ = _enriched(spark, d)
    return N.players_without_rating(out, ["match_date", "player1_raw", "player1_id", "player2_raw", "player2_id"])


@register(
    "age_group_check",
    f"""with {_RATED}, one as (select * from (select *, row_number() over (partition by {_SAME} order by match_id, copy) as rn from enriched) where rn = 1), sides as (select match_id, 'player1' as side, player1_id as player_id, player1_rating_age_group_pre as rating_age_group, tournament_age_category, player1_points_pre as points from one
 union all select match_id, 'player2', player2_id, player2_rating_age_group_pre, tournament_age_category, player2_points_pre from one) select match_id, side, player_id, rating_age_group, coalesce(lower(rating_age_group) = lower(tournament_age_category), false) or points is null as age_group_match from sides""",
)
def age_group_check(spark: SparkSession, d: str) -> DataFrame:
    return N.age_group_check(_enriched(spark, d)[0]).select("match_id", "side", "player_id", "rating_age_group", "age_group_match")


@register("ids_attached", f"with {RAW}, {_IDS} select match_id, copy, a.player_id as player1_id, b.player_id as player2_id from raw left join ids a on a.raw_name = player1_raw left join ids b on b.raw_name = player2_raw")
def ids_attached(spark: SparkSession, d: str) -> DataFrame:
    people = view(spark, d, "players")
    return attach_ids(_raw(spark, d), match_names(people.select("raw_name"), people)).select("match_id", "copy", "player1_id", "player2_id")


@register("ambiguous_names", f"with {_KEYS} select raw_name, appearances, array_to_string(c, '; ') as candidates from seen join cand using (name_key) where len(c) > 1")
def ambiguous_names_query(spark: SparkSession, d: str) -> DataFrame:
    people = view(spark, d, "players")
    return ambiguous_names(match_names(people.select("raw_name"), people)).select("raw_name", "appearances", "candidates")


@register(
    "candidate_gender",
    """with g as (select player_id, full_name, raw_name, case player_id % 4 when 0 then 'юноша' when 1 then 'Девушка' when 2 then '' else null end as gender from players),
 cand as (select array_to_string(list_concat(string_split(lower(full_name), ' ')[1:1], [x[1] for x in string_split(lower(full_name), ' ')[2:3]]), ' ') as name_key, list_sort(list(distinct cast(player_id as varchar))) as c from g where gender is null or gender <> 'юноша' group by 1)
 select raw_name, coalesce(len(c), 0)::bigint as n_candidates from (select distinct raw_name, trim(regexp_replace(lower(raw_name), '[^a-z0-9]+', ' ', 'g')) as name_key from players) left join cand using (name_key)""",
)
def candidate_gender_query(spark: SparkSession, d: str) -> DataFrame:
    p = view(spark, d, "players")
    k = F.col("player_id") % 4
    return match_names(p.select("raw_name"), p.withColumn("gender", F.when(k == 0, "юноша").when(k == 1, "Девушка").when(k == 2, ""))).select("raw_name", "n_candidates")


@register(
    "opponent_side",
    f"""with {LONG}, w as (select match_id, perspective, avg(win) over b as win_rate_pre, cast(date_diff('day', lag(match_date) over o, match_date) as bigint) as rest_days, row_number() over o - 1 as matches_pre from long
 window o as (partition by player_id order by match_date, match_id), b as (partition by player_id order by match_date, match_id rows between unbounded preceding and 1 preceding))
 select x.match_id, x.perspective, round(y.win_rate_pre, 6) as opponent_win_rate_pre, round(x.win_rate_pre - y.win_rate_pre, 6) + 0.0::double as diff_win_rate_pre, y.rest_days as opponent_rest_days, x.rest_days - y.rest_days as diff_rest_days,
 y.matches_pre as opponent_matches_pre, x.matches_pre - y.matches_pre as diff_matches_pre from w x join w y on x.match_id = y.match_id and x.perspective <> y.perspective""",
)
def opponent_side(spark: SparkSession, d: str) -> DataFrame:
    cols = ["win_rate_pre", "rest_days", "matches_pre"]
    out = N.opponent_side(H.player_windows(_long(spark, d)), cols)
    rate = [(F.round(c, 6) + F.lit(0.0)).alias(c) for c in ("opponent_win_rate_pre", "diff_win_rate_pre")]
    return out.select("match_id", "perspective", *rate, *[F.col(f"{x}_{c}").cast("long").alias(f"{x}_{c}") for c in cols[1:] for x in ("opponent", "diff")])


@register("null_safe_merge", "with a as (select o_orderkey, o_custkey % 50 as k1, case when o_orderkey % 3 = 0 then null else o_orderstatus end as k2 from orders), b as (select k1, k2, count(*) as n from a group by 1, 2) select o_orderkey, n from a left join b on a.k1 is not distinct from b.k1 and a.k2 is not distinct from b.k2")
def null_safe_merge(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 50).alias("k1"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")).alias("k2"))
    return N.null_safe_merge(a, a.groupBy("k1", "k2").agg(F.count("*").alias("n")), ["k1", "k2"]).select("o_orderkey", "n")


@register("one_to_one", "select o_orderkey, lines from orders left join (select l_orderkey, count(*) as lines from lineitem group by 1) on o_orderkey = l_orderkey")
def one_to_one(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("lines"))
    return N.one_to_one(table(spark, d, "orders").select("o_orderkey"), lines, ["o_orderkey"])


@register("pair_count", "select count(*) as pairs from (select distinct least(player1_id, player2_id), greatest(player1_id, player2_id) from matches)")
def pair_count(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "matches").select(F.least("player1_id", "player2_id").alias("a"), F.greatest("player1_id", "player2_id").alias("b")).distinct().agg(F.count("*").alias("pairs"))


@register("row_ids", "select o_orderkey, row_number() over (order by o_orderdate, o_orderkey) - 1 as row_id from orders")
def row_ids(spark: SparkSession, d: str) -> DataFrame:
    return N.row_ids(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", ["o_orderkey"]).select("o_orderkey", "row_id")


@register(
    "top_per_row",
    """with x as (select o_orderkey, unnest([{'name': 'a_price', 'v': floor(cast(o_totalprice as double) / 100)}, {'name': 'b_customer', 'v': -cast(o_custkey as double)}, {'name': 'c_key', 'v': cast(o_orderkey % 1000 as double)}]) as c from orders),
 r as (select *, row_number() over (partition by o_orderkey order by abs(c.v) desc, c.name) as place from x) select o_orderkey, place, c.name as name, c.v as value from r where place <= 2""",
)
def top_per_row(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    o = o.withColumns({"a_price": F.floor(F.col("o_totalprice").cast("double") / 100).cast("double"), "b_customer": -F.col("o_custkey").cast("double"), "c_key": (F.col("o_orderkey") % 1000).cast("double")})
    return N.top_per_row(o, ["a_price", "b_customer", "c_key"], 2, ["o_orderkey"])


@register("seeded_sample", "select o_orderkey from orders order by md5(concat('23', cast(o_orderkey as varchar))), o_orderkey limit 1000")
def seeded_sample(spark: SparkSession, d: str) -> DataFrame:
    return N.seeded_sample(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 1000, "23")


@register("text_date_sort", "select place, dotted from (select dotted, row_number() over (order by d) as place from (select distinct cast(o_orderdate as date) as d, strftime(o_orderdate, '%d.%m.%Y') as dotted from orders)) where place <= 500")
def text_date_sort(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    days = table(spark, d, "orders").select(D.format_dotted(F.col("o_orderdate").cast("date")).alias("dotted")).distinct()
    return days.withColumn("place", F.row_number().over(Window.orderBy(D.parse_date(F.col("dotted")))).cast("long")).where("place <= 500").select("place", "dotted")


_NOW = "2026-01-02 03:04:05"
_CONSTANTS = ", ".join(f"'{v}' as {n}" for n, v in M.LEGACY_CONSTANTS.items())


@register(
    "legacy_master",
    f"""with o as (select '/tours/' || (o_orderkey // 2) || '/matches' as url, o_orderkey, o_orderpriority as city, cast(o_orderdate as date) as day from orders where o_orderkey % 5 <> 0)
 select cast(o_orderkey // 2 as varchar) as tour_id, 'Cup ' || o_orderkey as tournament_name, city, day as start_date, url as matches_url, {_CONSTANTS}, false as matches_page_saved, 'old.xlsx' as source_file, timestamp '{_NOW}' as created_at
 from (select *, row_number() over (partition by url order by o_orderkey) as n from o) where n = 1""",
)
def legacy_master(spark: SparkSession, d: str) -> DataFrame:
    """An older list with two rows of most tournaments, some without a link."""
    k = F.col("o_orderkey")
    old = table(spark, d, "orders").select(
        F.concat(F.lit("Cup "), k.cast("string")).alias("Турнир"), F.col("o_orderpriority").alias("Город"), F.date_format("o_orderdate", "dd.MM.yyyy").alias("Дата начала"),
        F.when(k % 5 != 0, F.concat(F.lit("/tours/"), F.expr("o_orderkey div 2").cast("string"), F.lit("/matches"))).alias("Ссылка на страницу с матчами"), k.alias("line"),
    )
    out = M.legacy_master(old, "old.xlsx", F.lit(_NOW), ["line"])
    return out.select("tour_id", "tournament_name", "city", "start_date", "matches_url", *M.LEGACY_CONSTANTS, "matches_page_saved", "source_file", "created_at")


@register(
    "master_merge",
    f"""with e as (select tour_id, start_date, city, status, case when cast(tour_id as bigint) % 3 = 0 then null else timestamp '2020-01-01' end as created_at, timestamp '2020-01-01' as updated_at from master_existing),
 i as (select tour_id, start_date, city, status, timestamp '2025-05-05' as at from master_incoming)
 select coalesce(e.tour_id, i.tour_id) as tour_id, coalesce(i.start_date, e.start_date) as start_date, coalesce(i.city, e.city) as city, coalesce(i.status, e.status) as status,
  case when e.tour_id is null then i.at when i.tour_id is null then e.created_at else coalesce(e.created_at, timestamp '{_NOW}') end as created_at, case when e.tour_id is null then i.at when i.tour_id is null then e.updated_at else timestamp '{_NOW}' end as updated_at
 from e full join i on e.tour_id = i.tour_id""",
)
def master_merge(spark: SparkSession, d: str) -> DataFrame:
    """Ids with a decimal point, rows that come twice, missing columns and missing times of creation."""
    stamp = lambda t: F.lit(t).cast("timestamp")
    e, i = view(spark, d, "master_existing"), view(spark, d, "master_incoming")
    old = e.select(F.concat("tour_id", F.lit(".0")).alias("tour_id"), "start_date", "city", "status", F.when(F.col("tour_id").cast("long") % 3 != 0, stamp("2020-01-01")).alias("created_at"), stamp("2020-01-01").alias("updated_at"), F.lit(0).alias("line"))
    twice = old.unionByName(old.withColumns({"status": F.lit("later copy"), "line": F.lit(1)}))
    new = i.withColumns({"created_at": stamp("2025-05-05"), "updated_at": stamp("2025-05-05"), "line": F.lit(0)})
    return M.merge_master(twice, new.unionByName(new.withColumns({"city": F.lit("copy"), "line": F.lit(1)})), F.lit(_NOW), ["line"], ["line"]).select("tour_id", "start_date", "city", "status", "created_at", "updated_at")


@register("side_audit", "select 'player1' as side, player1_id as player_id, count(*) as n, cast(sum(winner_player1) as bigint) as wins from matches group by 2 union all select 'player2', player2_id, count(*), cast(sum(1 - winner_player1) as bigint) from matches group by 2")
def side_audit(spark: SparkSession, d: str) -> DataFrame:
    side = lambda s, win: F.struct(F.lit(s).alias("side"), F.col(f"{s}_id").alias("player_id"), win.alias("win"))
    rows = view(spark, d, "matches").select(F.explode(F.array(side("player1", F.col("winner_player1")), side("player2", 1 - F.col("winner_player1")))).alias("x"))
    return rows.groupBy("x.side", "x.player_id").agg(F.count("*").alias("n"), F.sum("x.win").alias("wins"))


@register("rating_history", "select distinct player_id, case when month(d) = 1 and day(d) between 2 and 12 then make_date(year(d), day(d), 1) else d end as classification_date, age_group, cast(place as bigint) as rank, round(points, 4) as points from (select *, classification_date + 2 as d from ratings where player_id in (3, 7))")
def rating_history_query(spark: SparkSession, d: str) -> DataFrame:
    r = view(spark, d, "ratings").withColumn("classification_date", F.date_add("classification_date", 2))
    return rating_history(r, [3, 7]).select("player_id", "classification_date", "age_group", F.col("rank").cast("long").alias("rank"), F.round("points", 4).alias("points"))


@register(
    "pair_rows",
    f"""with {LONG}, q as (select * from (values (0, date '1997-06-01', '1-URGENT'), (1, date '1995-01-15', '5-LOW')) t(request_id, on_date, age)),
 s as (select q.*, p.perspective, p.player_id, p.opponent_id from q cross join (values ('player1', 1, 2), ('player2', 2, 1)) p(perspective, player_id, opponent_id)),
 h as (select s.request_id, s.perspective, l.*, row_number() over (partition by s.request_id, s.perspective order by l.match_date desc, l.match_id desc) as rn from s join long l on l.player_id = s.player_id and l.match_date < s.on_date),
 a as (select request_id, perspective, count(*) as matches_pre, avg(win) as win_rate_pre, avg(case when rn <= 5 then win end) as form5_partial, count(case when opponent_id in (1, 2) then 1 end) as met from h group by 1, 2),
 r as (select s.request_id, s.perspective, r.points, row_number() over (partition by s.request_id, s.perspective order by (r.age_group = s.age) desc, r.classification_date desc, r.age_group desc) as rn from s join ratings r on r.player_id = s.player_id and r.classification_date <= s.on_date)
 select s.request_id, s.perspective, s.player_id, coalesce(matches_pre, 0) as matches_pre, round(win_rate_pre, 6) as win_rate_pre, round(form5_partial, 6) as form5_partial, coalesce(met, 0) as h2h_matches_before, round(points, 4) as player_points_pre
 from s left join a using (request_id, perspective) left join (select * from r where rn = 1) r on r.request_id = s.request_id and r.perspective = s.perspective""",
)
def pair_rows_query(spark: SparkSession, d: str) -> DataFrame:
    requests = spark.sql("select cast(0 as bigint) as request_id, date '1997-06-01' as on_date, '1-URGENT' as age union all select 1, date '1995-01-15', '5-LOW'")
    out = pair_rows(view(spark, d, "matches"), view(spark, d, "ratings"), 1, 2, requests)
    return out.select("request_id", "perspective", "player_id", "matches_pre", r6("win_rate_pre"), r6("form5_partial"), "h2h_matches_before", F.round("player_points_pre", 4).alias("player_points_pre"))


@register("best_model", f"with {_SCORED}, {_metric_sql('scored', 'model')} select * from m order by logloss, brier, roc_auc desc, model limit 1")
def best_model(spark: SparkSession, d: str) -> DataFrame:
    m = E.metrics(_scored(spark, d), ["model"])
    return E.best_model(m.select("model", "n", r6("logloss"), r6("brier"), r6("accuracy"), r6("roc_auc")))


_THREE = "wide as (select match_id, winner_player1 as y, round(1 / (1 + exp(-games_diff / cast(20 as double))), 2) as a, round(1 / (1 + exp(-games_diff / cast(5 as double))), 2) as b, case when qa % 2 = 0 then cast(0.7 as double) end as c from matches), tall as (select y, 'a' as model, a as p from wide union all select y, 'b', b from wide union all select y, 'c', c from wide)"


@register("metric_table", f"with {_THREE}, {_metric_sql('tall', 'model')} select * from m")
def metric_table(spark: SparkSession, d: str) -> DataFrame:
    m = view(spark, d, "matches")
    logit = lambda s: F.round(1 / (1 + F.exp(-F.col("games_diff") / s)), 2)
    wide = m.select(F.col("winner_player1").alias("y"), logit(20).alias("a"), logit(5).alias("b"), F.when(F.col("qa") % 2 == 0, F.lit(0.7)).alias("c"))
    out = E.metric_table(wide, ["a", "b", "c"])
    return out.select("model", "n", r6("logloss"), r6("brier"), r6("accuracy"), r6("roc_auc"))


@register("split_diagnostics", f"with {_SCORED}, s as (select scored.*, model || cast(match_id % 5 = 0 as int) as part from scored), {_metric_sql('s', 'part')} select a.part[1] as model, a.logloss as train_logloss, b.logloss as test_logloss, a.roc_auc as train_roc_auc, b.roc_auc as test_roc_auc from m a join m b on a.part[1] = b.part[1] and a.part[2] = '0' and b.part[2] = '1'")
def split_diagnostics(spark: SparkSession, d: str) -> DataFrame:
    out = E.split_diagnostics(_scored(spark, d).withColumn("is_test", (F.col("match_id") % 5 == 0).cast("int")))
    return out.select("model", *[r6(c) for c in ("train_logloss", "test_logloss", "train_roc_auc", "test_roc_auc")])


@register("quality_report", "select age_group, count(*) as n, count(distinct player_id) as ids, count(distinct classification_date) as dates, min(classification_date) as first_date, max(classification_date) as last_date, cast(sum(case when points <= 0 then 1 else 0 end) as bigint) as without_points, round(avg(counting_tournaments), 6) as mean_counting from ratings group by 1")
def quality_report(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "ratings").groupBy("age_group").agg(
        F.count("*").alias("n"), F.countDistinct("player_id").alias("ids"), F.countDistinct("classification_date").alias("dates"), F.min("classification_date").alias("first_date"), F.max("classification_date").alias("last_date"),
        F.sum((F.col("points") <= 0).cast("long")).alias("without_points"), F.round(F.avg("counting_tournaments"), 6).alias("mean_counting"),
    )


@register("command_dates", "select o_orderkey, cast(o_orderdate as date) as day, cast(o_orderdate as date) - 14 as start, len([x for x in generate_series(cast(date_trunc('month', o_orderdate) as date), cast(o_orderdate as date), interval 1 month) if x >= date '1995-01-01']) as months from orders")
def command_dates(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    k = F.col("o_orderkey") % 3
    text = F.when(k == 0, F.date_format("d", "yyyy-MM-dd")).when(k == 1, F.date_format("d", "dd.MM.yyyy")).otherwise(F.date_format("d", "dd/MM/yyyy"))
    day = o.select("o_orderkey", D.command_date(text).alias("day"))
    months = D.dates_from(D.month_starts(F.col("day"), F.col("day")), F.lit("1995-01-01").cast("date"))
    return day.select("o_orderkey", "day", D.default_start(F.col("day")).alias("start"), F.size(months).cast("long").alias("months"))


@register("day_first_dates", "select o_orderkey, cast(o_orderdate as date) as day from orders")
def day_first_dates(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    k = F.col("o_orderkey") % 4
    text = F.when(k == 0, F.date_format("d", "d/M/yyyy")).when(k == 1, F.date_format("d", "dd-MM-yyyy")).when(k == 2, F.concat(F.lit("с "), F.date_format("d", "d.M.yyyy"), F.lit(" по"))).otherwise(F.date_format("d", "yyyy-MM-dd HH:mm"))
    return o.select("o_orderkey", D.parse_date(text).alias("day"))


@register("guess_city", "select c_custkey, case c_custkey % 4 when 0 then c_name when 1 then c_name when 2 then c_name end as city from customer")
def guess_city(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    k = F.col("c_custkey") % 4
    line = F.when(k == 0, F.concat("c_name", F.lit(", Область, Центральный ФО, Россия"))).when(k == 1, F.concat(F.lit("Место проведения: "), F.col("c_name"))).when(k == 2, F.concat(F.lit("г. "), F.col("c_name"))).otherwise(F.lit("ничего"))
    return c.select("c_custkey", T.guess_city(F.array(F.lit("Кубок весны"), line)).alias("city"))


@register("tournament_names", "select c_custkey, case c_custkey % 3 when 2 then 'Кубок ' || c_custkey else c_name end as name from customer")
def tournament_names(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    k = F.col("c_custkey") % 3
    anchor = F.when(k == 0, F.col("c_name")).when(k == 1, F.lit("Подробнее")).otherwise(F.concat(F.lit("Кубок "), F.col("c_custkey").cast("string")))
    return c.select("c_custkey", T.tournament_name(anchor, F.array(F.lit("01.02.2024 - 03.02.2024"), F.lit("Основной турнир ОТ: 24"), F.col("c_name"))).alias("name"))


@register("tournament_metadata", "select o_orderkey, 'Кубок ' || o_orderkey as tournament_name, o_orderstatus || 'град' as tournament_city, strftime(o_orderdate, '%d.%m.%Y') as tournament_start_text, 'до ' || (15 + 2 * (o_orderkey % 3)) || ' лет' as tournament_age_category, o_orderpriority as tournament_category from orders")
def tournament_metadata(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    name, day = F.concat(F.lit("Кубок "), F.col("o_orderkey").cast("string")), F.date_format("o_orderdate", "dd.MM.yyyy")
    head = F.when(F.col("o_orderkey") % 2 == 0, F.array(F.concat(F.lit("Матчи турнира "), name))).otherwise(F.array(F.lit("Карточка турнира"), F.lit("---"), name))
    more = F.array(F.lit("Место проведения:"), F.concat("o_orderstatus", F.lit("град, Корты")), F.concat(day, F.lit(" - "), day), F.lit("возрастная группа"), F.concat(F.lit("До "), (15 + 2 * (F.col("o_orderkey") % 3)).cast("string"), F.lit(" лет")), F.lit("Категория турнира"), F.col("o_orderpriority"))
    found = T.tournament_metadata(F.concat(head, more))
    return o.select("o_orderkey", *[found[c].alias(c) for c in ("tournament_name", "tournament_city", "tournament_start_text", "tournament_age_category", "tournament_category")])


def _order_pages(spark: SparkSession, d: str) -> DataFrame:
    """A page an order with its lines as match records: status, date and time where they have one, and one record after the footer."""
    li = table(spark, d, "lineitem")
    block = lambda *cells: F.concat(*[x for c in cells for x in (F.lit("<div>"), c, F.lit("</div>"))])
    record = lambda x: F.concat(
        block(x["l_linenumber"].cast("string"), F.concat(F.lit("Part "), x["l_partkey"].cast("string")), F.concat(F.lit("Supp "), x["l_suppkey"].cast("string")), F.lit("2 : 1"), F.lit("6-4,3-6,[10-8]"), x["l_returnflag"]),
        F.when(x["l_linenumber"] % 2 == 0, block(F.lit("Статус матча"), x["l_linestatus"])).otherwise(F.lit("")), F.when(x["l_linenumber"] % 3 == 0, block(F.lit("Дата"), F.date_format(x["l_shipdate"], "dd.MM.yyyy"))).otherwise(F.lit("")),
    )
    # columns are exchanged, not markup
    lines = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate")))
    rows = li.groupBy("l_orderkey").agg(F.array_join(F.transform(lines, record), "<p>junk</p>").alias("body"))
    head = block(*[F.lit(x) for x in ("№", "Участник 1 (РНИ)", "Участник 2 (РНИ)", "Счет", "Этап турнира")])
    foot = F.concat(block(F.lit("2026 ©")), block(*[F.lit(x) for x in ("9", "Nobody", "No one", "2-0", "6-0,6-0", "x")]))
    return rows.select(F.col("l_orderkey").alias("page_id"), F.concat(F.lit("<html><script>1</script><body>"), head, F.col("body"), foot, F.lit("</body></html>")).alias("html"))


@register("page_records", "select l_orderkey as page_id, cast(l_linenumber as varchar) as number, 'Part ' || l_partkey as player1, 'Supp ' || l_suppkey as player2, '2 : 1' as score, l_returnflag as draw, case when l_linenumber % 2 = 0 then l_linestatus end as status, case when l_linenumber % 3 = 0 then strftime(l_shipdate, '%d.%m.%Y') end as date from lineitem")
def page_records(spark: SparkSession, d: str) -> DataFrame:
    return P.page_matches(_order_pages(spark, d)).select("page_id", "number", "player1", "player2", "score", "draw", "status", "date")


@register("ranking_tables", "select s_suppkey as page_id, cast(s_suppkey as varchar) as rni, s_name as fio, cast(s_nationkey as varchar) as points, cast(s_suppkey % 9 as varchar) as counting_tournaments from supplier")
def ranking_tables(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    cell = lambda tag, *xs: F.concat(*[x for c in xs for x in (F.lit(f"<{tag}>"), c, F.lit(f"</{tag}>"))])
    other = F.lit("<table><tr><th>x</th><th>y</th></tr><tr><td>1</td><td>2</td></tr></table>")
    head = cell("th", *[F.lit(x) for x in ("ФИО", "Рейтинг?", "РНИ", "Из них зачётных", "Очки")])
    row = cell("td", F.col("s_name"), F.lit("-"), F.concat(F.lit(" <a href='/p'>"), F.col("s_suppkey").cast("string"), F.lit("</a>")), (F.col("s_suppkey") % 9).cast("string"), F.col("s_nationkey").cast("string"))
    page = F.concat(other, F.lit("<table><tr>"), head, F.lit("</tr><tr>"), row, F.lit("</tr></table>"))
    return P.header_rows(P.table_cells(s.select(F.col("s_suppkey").alias("page_id"), page.alias("html")))).select("page_id", "rni", "fio", "points", "counting_tournaments")


_DOC = """concat('{"tour": {"id": ', cast(o_orderkey as {s}), ', "rows": [{"player": {"name": "P', cast(o_custkey as {s}), '"}, "result": "2-', cast(o_orderkey % 2 as {s}), '", "tags": ["x", null]}, {"player": {"name": "Q"}, "note": true}]}}')"""


def _json_rows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.expr(_DOC.replace("{s}", "string")).alias("doc"))


@register("json_leaves", "with k as (select o_orderkey as id, o_custkey from orders) select id, 'tour.id' as path, cast(id as varchar) as value from k union all select id, 'tour.rows.0.player.name', 'P' || o_custkey from k union all select id, 'tour.rows.0.result', '2-' || (id % 2) from k union all select id, 'tour.rows.0.tags.0', 'x' from k union all select id, 'tour.rows.0.tags.1', '' from k union all select id, 'tour.rows.1.player.name', 'Q' from k union all select id, 'tour.rows.1.note', 'True' from k")
def json_leaves(spark: SparkSession, d: str) -> DataFrame:
    return P.json_leaves(_json_rows(spark, d), "id", "doc").select("id", "path", "value")


@register("json_rows", "select o_orderkey as id, 'tour.rows.0' as element, 'P' || o_custkey as name, '2-' || (o_orderkey % 2) as result from orders union all select o_orderkey, 'tour.rows.1', 'Q', null from orders")
def json_rows(spark: SparkSession, d: str) -> DataFrame:
    leaves = P.json_leaves(_json_rows(spark, d), "id", "doc")
    return P.grouped_leaves(leaves, "id", {"name": r"^player\.name$", "result": "^result$"}).select("id", "element", "name", "result")


@register("file_names", r"select c_custkey, lpad(cast(c_custkey as varchar), 9, '0') || '_' || trim(regexp_replace(c_name || ' / <a>: ', '[\\/:*?\"<>|]+', '_', 'g'), ' ._') as base, cast(c_custkey as varchar) as from_name, '/x/matches' as url from customer")
def file_names(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    url = F.when(F.col("c_custkey") % 2 == 0, "/x/matches/?a=1").otherwise("/x/#b")
    return c.select("c_custkey", T.output_base(F.col("c_custkey"), 9, F.concat("c_name", F.lit(" / <a>: "))).alias("base"), T.tour_id(F.concat(F.lit("tour_"), F.col("c_custkey").cast("string"), F.lit("_matches.html"))).alias("from_name"), T.matches_url(url).alias("url"))


_AT = "1997-06-01"


@register(
    "rated_profiles",
    f"""{_elo_steps("'all'", 32.0, 0.08, 45.0, f" where match_date < date '{_AT}'")},
 fin as (select unnest(map_keys(st)) as player_id, unnest(map_values(st)) as elo from (select st from s order by i desc limit 1)),
 l as (select o.match_id, o.match_date, o.player1_id as player_id, o.winner_player1 as win, s.rb as opp from s join o on o.i = s.i
  union all select o.match_id, o.match_date, o.player2_id, 1 - o.winner_player1, s.ra from s join o on o.i = s.i),
 r as (select *, row_number() over (partition by player_id order by match_date desc, match_id desc) as rn from l),
 g as (select player_id, count(*) as matches, cast(sum(win) as bigint) as wins, round(avg(win), 6) as win_rate, round(avg(case when rn <= 5 then win end), 6) as form5, round(avg(case when rn <= 10 then win end), 6) as form10,
  max(match_date) as last_date, cast(date_diff('day', max(match_date), date '{_AT}') as bigint) as rest_days, round(avg(case when rn <= 5 then opp end), 4) as opponent_elo_last5 from r group by 1),
 k as (select *, row_number() over (partition by player_id order by classification_date desc, age_group desc) as rn from ratings where classification_date <= date '{_AT}')
 select g.*, round(fin.elo, 4) as elo, cast(k.place as bigint) as rank, round(k.points, 4) as points, k.classification_date as rating_date, k.age_group as rating_age_group
 from g join fin using (player_id) left join k on k.player_id = g.player_id and k.rn = 1""",
)
def rated_profiles(spark: SparkSession, d: str) -> DataFrame:
    p = S.rated_profiles(view(spark, d, "matches"), view(spark, d, "ratings"), _AT)
    r4 = lambda c: F.round(c, 4).alias(c)
    return p.select("player_id", "matches", "wins", r6("win_rate"), r6("form5"), r6("form10"), "last_date", F.col("rest_days").cast("long").alias("rest_days"), r4("opponent_elo_last5"), r4("elo"), F.col("rank").cast("long").alias("rank"), r4("points"), "rating_date", "rating_age_group")


@register(
    "meeting_summary",
    f"""with t as (select least(player1_id, player2_id) as player_id, greatest(player1_id, player2_id) as opponent_id, match_date, match_id,
 case when (winner_player1 = 1) = (player1_id < player2_id) then 1 else 0 end as win, case when player1_id < player2_id then games_diff else -games_diff end as games from matches where match_date < date '{_AT}')
 select player_id, opponent_id, count(*) as matches, cast(sum(win) as bigint) as wins, cast(sum(1 - win) as bigint) as losses, cast(sum(games) as double) as games_diff, max(match_date) as last_date,
 arg_max(case when win = 1 then player_id else opponent_id end, row(match_date, match_id)) as last_winner from t group by 1, 2""",
)
def meeting_summary(spark: SparkSession, d: str) -> DataFrame:
    return S.meeting_summary(view(spark, d, "matches"), _AT).withColumn("games_diff", F.col("games_diff").cast("double"))


#: One whole name, one that many names contain, and a surname.
_NAMES = ("Surname15 Bname Cpatron", "bname c", "surname7")


@register(
    "latest_of_names",
    f"""with a as (select unnest({list(_NAMES)}) as asked), l as (select player1_id as player_id, match_date from matches union all select player2_id, match_date from matches),
 h as (select a.asked, lower(p.full_name) = lower(a.asked) as exact, p.player_id, p.full_name as player_name, max(l.match_date) as match_date
  from l join players p on p.player_id = l.player_id join a on contains(lower(p.full_name), lower(a.asked)) group by 1, 2, 3, 4),
 r as (select *, row_number() over (partition by asked order by exact desc, match_date desc, player_id desc) as rn, count(*) over (partition by asked, exact) as candidates from h)
 select a.asked, cast(r.exact as bigint) as exact, r.player_id, r.player_name, r.match_date, coalesce(r.candidates, 0) as candidates from a left join r on r.asked = a.asked and r.rn = 1""",
)
def latest_of_names(spark: SparkSession, d: str) -> DataFrame:
    people = view(spark, d, "players").select("player_id", F.col("full_name").alias("player_name"))
    return S.latest_of_names(_long(spark, d).select("player_id", "match_date").join(people, "player_id"), _NAMES).withColumn("exact", F.col("exact").cast("long"))
