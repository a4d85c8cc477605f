"""Match, rating, score and player views over the star-schema tables.

The same SQL text runs in Spark and in DuckDB.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from .shipping import ship_package

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "labels", "conversations", "benchmark", "embeddings")

MATCHES = """
select o.o_orderkey as match_id, cast(o.o_orderdate as date) as match_date, o.o_orderpriority as age_category,
       s1 as player1_id, s2 as player2_id, cast(e1 > e2 as int) as winner_player1,
       q1 - q2 as games_diff, cast(q1 as int) as qa, cast(q2 as int) as qb
from (select l_orderkey, max(case when rn = 1 then l_suppkey end) as s1, max(case when rn = 2 then l_suppkey end) as s2,
             max(case when rn = 1 then l_extendedprice end) as e1, max(case when rn = 2 then l_extendedprice end) as e2,
             max(case when rn = 1 then l_quantity end) as q1, max(case when rn = 2 then l_quantity end) as q2
      from (select l_orderkey, l_suppkey, l_quantity, l_extendedprice,
                   row_number() over (partition by l_orderkey order by l_linenumber, l_suppkey, l_partkey, l_extendedprice, l_quantity) as rn
            from lineitem) x where rn <= 2 group by l_orderkey) a
join orders o on o.o_orderkey = a.l_orderkey
where s1 <> s2"""

RATINGS = """
select s.*, row_number() over (partition by age_group, classification_date order by points desc, player_id) as place
from (select l.l_suppkey as player_id, o.o_orderpriority as age_group,
             cast(date_trunc('month', l.l_shipdate) as date) as classification_date,
             cast(sum(cast(l.l_extendedprice as decimal(18,2))) as double) as points,
             count(*) as total_tournaments, sum(case when l.l_returnflag = 'R' then 0 else 1 end) as counting_tournaments
      from lineitem l join orders o on o.o_orderkey = l.l_orderkey group by 1, 2, 3) s"""

MATCH_SCORES = """
select match_id,
  case when qb % 4 = 0 then case when winner_player1 = 1 then '2-1' else '1-2' end
       else case when winner_player1 = 1 then '2-0' else '0-2' end end as score_raw,
  concat(
    case when winner_player1 = 1 then concat('6-', cast(qa % 5 as varchar(9))) else concat(cast(qa % 5 as varchar(9)), '-6') end, ',',
    case when qb % 4 = 0 and winner_player1 = 1 then concat(cast(qb % 5 as varchar(9)), '-6,[10-', cast(qa % 9 as varchar(9)), ']')
         when qb % 4 = 0 then concat('6-', cast(qb % 5 as varchar(9)), ',[', cast(qa % 9 as varchar(9)), '-10]')
         when qb % 4 = 1 and winner_player1 = 1 then concat('7-6(', cast(qb % 7 as varchar(9)), ')')
         when qb % 4 = 1 then concat('6-7(', cast(qb % 7 as varchar(9)), ')')
         when winner_player1 = 1 then concat('6-', cast(qb % 5 as varchar(9)))
         else concat(cast(qb % 5 as varchar(9)), '-6') end) as detailed_raw
from matches"""

PLAYERS = """
select s_suppkey as player_id,
  concat('Surname', cast(s_suppkey % 20 as varchar(9)), ' ', chr(65 + cast(s_nationkey % 3 as int)), 'name ', chr(65 + cast(s_suppkey % 3 as int)), 'patron') as full_name,
  concat('Surname', cast(s_suppkey % 20 as varchar(9)), ' ', chr(65 + cast(s_nationkey % 3 as int)), '.', chr(65 + cast(s_suppkey % 3 as int)), '.') as raw_name
from supplier"""

MASTER_EXISTING = """
select cast(o_orderkey as varchar(20)) as tour_id, cast(o_orderdate as date) as start_date,
       case when o_orderkey % 5 = 0 then null else o_orderpriority end as city, 'old' as status
from orders where o_orderkey % 10 < 7"""

MASTER_INCOMING = """
select cast(o_orderkey as varchar(20)) as tour_id, cast(o_orderdate as date) as start_date,
       case when o_orderkey % 3 = 0 then null else concat('c', o_orderpriority) end as city,
       case when o_orderkey % 2 = 0 then null else 'new' end as status
from orders where o_orderkey % 10 >= 5"""

#: In order: later ones read earlier ones.
VIEWS = {"matches": MATCHES, "ratings": RATINGS, "match_scores": MATCH_SCORES, "players": PLAYERS, "master_existing": MASTER_EXISTING, "master_incoming": MASTER_INCOMING}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived view as a DataFrame; no name is left in the session's catalogue."""
    named = re.compile(rf"\b(from|join) ({'|'.join([*TABLES, *VIEWS])})\b")
    text = VIEWS[name]
    used = {m[2]: view(spark, sf_dir, m[2]) if m[2] in VIEWS else table(spark, sf_dir, m[2]) for m in named.finditer(text)}
    return spark.sql(named.sub(r"\1 {\2}", text), **used)


def with_views(sql: str) -> str:
    """DuckDB SQL whose WITH clause defines the views that ``sql`` names."""
    used = [v for v in VIEWS if v in sql or (v == "matches" and "match_scores" in sql)]
    head = ", ".join(f"{v} as ({VIEWS[v]})" for v in used)
    sql = sql.strip()
    if not head:
        return sql
    if sql.lower().startswith("with recursive"):
        return f"with recursive {head}, {sql[14:]}"
    return f"with {head}, {sql[5:]}" if sql.lower().startswith("with ") else f"with {head} {sql}"
