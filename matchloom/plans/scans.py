"""Queries of the page scans. Each writes markup from table rows, with what a scan must cope with, and reads it again; the SQL is the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import dom
from ..sources.views import table
from .registry import register


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _name(c: str, initials: str) -> Column:
    """A surname without digits and two initials."""
    return _text("S", F.translate(F.col(c).cast("string"), "0123456789", "abcdefghij"), " ", initials)


def _name_sql(c: str, initials: str) -> str:
    return f"'S' || translate(cast({c} as varchar), '0123456789', 'abcdefghij') || ' {initials}'"


def _dealt(rows: DataFrame, key: str) -> DataFrame:
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def _page(rows: DataFrame, item: Column, key: str = "l_orderkey", order: str = "l_linenumber", between: str = "") -> DataFrame:
    """Items of one key, joined in order; items of one number by their text. Columns are dealt, not markup, to as many tasks as are set: reading pages costs more than their size tells."""
    rows = _dealt(rows, key)
    items = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), item.alias("x"))))
    return rows.groupBy(F.col(key).alias("page_id")).agg(F.array_join(F.transform(items, lambda r: r["x"]), between).alias("body"))


def _whole(found: DataFrame) -> DataFrame:
    """Rows of a scan whose result has no column for errors: a page that can't be read stops the query, instead of giving a row like others or none."""
    return found.withColumn("page_id", F.when(F.col("parse_error").isNull(), F.col("page_id")).otherwise(F.raise_error(F.col("parse_error"))))


_CARDS = f"""c as (select l_orderkey as page_id, l_linenumber as ln, {_name_sql('l_partkey', 'A.B.')} as p1, {_name_sql('l_suppkey', 'C.D.')} as p2, l_linenumber || ':' || (l_linenumber % 3) as s from lineitem),
 t as (select *, p1 || ' ' || p2 || ' ' || s as text, page_id % 3 = 0 as unclosed, page_id % 2 = 0 as long from c),
 a as (select page_id, min_by(p1, (ln, text)) as p1, min_by(p2, (ln, text)) as p2, min_by(s, (ln, text)) as s, string_agg(text, ' ' order by ln, text) as text, bool_or(long) as long from t group by 1)"""


@register(
    "dom_cards",
    f"""with {_CARDS} select page_id, p1 as player1, p2 as player2, s as score, case when unclosed then string_agg(text, ' ') over (partition by page_id order by ln, text rows between current row and unbounded following) else text end as raw_row from t
 union all select page_id, p1, p2, s, text from a where not long""",
)
def dom_cards(spark: SparkSession, d: str) -> DataFrame:
    """Cards in a section; list items that nobody closes hold all later ones; a section of more than 700 characters is none."""
    li = table(spark, d, "lineitem")
    inner = _text("<b>", _name("l_partkey", "A.B."), "</b><!-- No One --><script>x('Nobody X.Y. 9:9')</script>\n ", _name("l_suppkey", "C.D."), "</i><br/>", F.col("l_linenumber"), ":", F.col("l_linenumber") % 3)
    pages = _page(li, F.when(F.col("l_orderkey") % 3 == 0, _text("<li>", inner)).otherwise(_text("<div class='card'>", inner, "</div>")))
    long = F.when(F.col("page_id") % 2 == 0, _text("<p>", "w" * 701, "</p>")).otherwise("")
    return _whole(dom.dom_cards(pages.select("page_id", _text("<body><section>", long, F.col("body"), "</section><p>Some One, Any One 1:1</p></body>").alias("html")))).select("page_id", "player1", "player2", "score", "raw_row")


@register(
    "calendar_scan",
    """select cast(c_custkey as varchar) as tour_id, 'Cup ' || c_name as tournament_name, c_mktsegment as city, cast(date '2024-01-01' + cast(c_custkey % 300 as int) as date) as start_date, cast(date '2024-01-03' + cast(c_custkey % 300 as int) as date) as end_date,
 'https://example.org/public/tours/' || c_custkey || '/dashboard' as calendar_url from customer""",
)
def calendar_scan(spark: SparkSession, d: str) -> DataFrame:
    """A page a nation; each event is linked once or twice, by its name, a dull word or a description of the draw, in nested or unclosed elements, on two pages."""
    c = table(spark, d, "customer")
    k, name = F.col("c_custkey") % 4, _text("Cup ", F.col("c_name"))
    first, last = (F.date_format(F.date_add(F.lit(day).cast("date"), (F.col("c_custkey") % 300).cast("int")), "dd.MM.yyyy") for day in ("2024-01-01", "2024-01-03"))
    link = lambda text: _text("<a href='/public/tours/", F.col("c_custkey"), "/dashboard'>", text, "</a>")
    city, days = _text("Город: ", F.col("c_mktsegment")), _text(first, " - ", last)
    event = (
        F.when(k == 0, _text("<div class=row><div>", link(name), "</div><p>", days, "</p><i>", city, "</i></div>"))
        .when(k == 1, _text("<div class=row>", link("Подробнее"), days, "<b>", name, "</b><i>", city, "</i>", link("Заявка"), "</div>"))
        .when(k == 2, _text("<ul><li>", link("Основной турнир ОТ: 24"), "<b>", name, "</b><p>", city, "<p>", days, "</ul>"))
        .otherwise(_text("<table><tr><td>", link(_text("  Cup\n", F.col("c_name"), "&nbsp;")), "<td>", city, "</td><td>", days, "</td></tr></table>"))
    )
    page = _page(c, event, "c_nationkey", "c_custkey").select("page_id", _text("<html><body><a href='/public/news/7'>News 2020-01-01</a>", F.col("body"), "</body></html>").alias("html"))
    again = page.select((F.col("page_id") + 100).alias("page_id"), F.replace("html", F.lit("Cup "), F.lit("Old ")).alias("html"))
    return dom.calendar(page.unionByName(again)).drop("page_id")


@register(
    "calendar_details",
    """select o_orderkey as page_id, 'Cup ' || o_orderkey as tournament_name, cast(o_orderdate as date) as start_date, case o_orderkey % 3 when 0 then o_orderstatus || 'град' when 1 then o_orderstatus || 'ск' end as city, case when o_orderkey % 3 = 0 then 'Центральный ФО' end as federal_district,
 o_orderpriority as age_category, case when o_orderkey % 2 = 0 then 'Парный' end as draw_type, case o_orderkey % 4 when 0 then 'Турнир завершен' when 1 then 'Подача поздних заявок' when 2 then 'Подача заявок' end as status from orders""",
)
def calendar_details(spark: SparkSession, d: str) -> DataFrame:
    """Names and dates by class, pairs of columns (some with a third, some without a value), states: the more specific one wins."""
    o = _dealt(table(spark, d, "orders"), "o_orderkey")  # a row group of narrow orders is far more than one task's pages
    k = F.col("o_orderkey")
    pair = lambda label, value: _text("<div class='x two-columns'><div>", label, ":</div><span><div>inner</div></span><div>", value, "</div><div>third</div></div>")
    place = F.when(k % 3 == 0, pair("Место проведения", _text(F.col("o_orderstatus"), "град, Корты, Центральный ФО, Россия"))).when(k % 3 == 1, pair("Место проведения", _text(F.col("o_orderstatus"), "ск, Корты"))).otherwise(pair("Место проведения", ""))
    state = F.when(k % 4 == 0, "Подача заявок Турнир завершен").when(k % 4 == 1, "Подача поздних заявок").when(k % 4 == 2, "Подача заявок").otherwise("<script>Подача заявок</script>")
    html = _text("<h1 class='big name'>Cup <b>", k, "</b></h1><p class='name'>Other</p><p class='small-name'>", F.date_format("o_orderdate", "dd.MM.yyyy"), " - 31.12.2030</p>", place, pair("Возрастная группа", F.col("o_orderpriority")), F.when(k % 2 == 0, pair("Разряд турнира", "Парный")).otherwise(""), "<p>", state)
    return _whole(dom.tournament_details(o.select(k.alias("page_id"), html.alias("html")))).select("page_id", "tournament_name", "start_date", "city", "federal_district", "age_category", "draw_type", "status")


def _tables(spark: SparkSession, d: str) -> DataFrame:
    """A table an order: columns in three orders, with headers, foreign headers, or none; stages of two words; a nested table; spans."""
    li = table(spark, d, "lineitem")
    k = F.col("l_orderkey") % 3
    td = lambda *cells: _text(*[x for c in cells for x in ("<td>", c, "</td>")])
    no, one, two = F.col("l_linenumber").cast("string"), _name("l_partkey", "A.B."), _name("l_suppkey", "C.D.")
    score, stage = F.when(F.col("l_linenumber") % 5 == 4, "").otherwise(_text(F.col("l_linenumber"), "-", F.col("l_linenumber") % 3, " 6:4")), F.lit("Round of sixteen")
    row = _text("<tr>", F.when(k == 0, td(no, one, two, score, stage)).when(k == 1, td(stage, score, one, two, no)).otherwise(td(one, score, no, stage, two)), "</tr>")
    head = F.when(F.col("page_id") % 3 == 0, "<thead><tr><th>№<th>Игрок 1<th>Игрок 2<th>Счет<th>Этап</tr></thead>").when(F.col("page_id") % 3 == 1, "<tr><th>Стадия</th><th colspan=2>Итог</th><th>B</th><th>C</th></tr>").otherwise("")
    other = "<table><tr><td>menu<table><tr><td>1-0</td></tr></table></td><td rowspan=2>plain</td></tr><tr><td>x</td></tr></table>"
    return _page(li, row).select("page_id", _text(other, "<table>", head, F.col("body"), "</table>").alias("html"))


_ROWS = f"""r as (select l_orderkey as page_id, l_linenumber as ln, l_orderkey % 3 as k, {_name_sql('l_partkey', 'A.B.')} as one, {_name_sql('l_suppkey', 'C.D.')} as two, case when l_linenumber % 5 = 4 then '' else l_linenumber || '-' || (l_linenumber % 3) || ' 6:4' end as score, 'Round of sixteen' as stage from lineitem),
 g as (select page_id, 0 as table_no, null as ln, '' as player1, '' as player2, '1-0' as score, '' as round from (select distinct page_id from r))"""


@register(
    "table_matches",
    f"""with {_ROWS} select page_id, case when k = 1 then stage else one end as player1, case k when 0 then two when 1 then one else stage end as player2, score, cast(null as varchar) as parse_error from r union all select page_id, 'menu 1-0 plain', '', '', null from g where false union all select page_id, player1, player2, score, null from g""",
)
def table_matches(spark: SparkSession, d: str) -> DataFrame:
    """By cell: a stage of two words counts as a name where it comes first. A page that can't be read is a row with its error."""
    return dom.table_matches(_tables(spark, d)).select("page_id", "player1", "player2", "score", "parse_error")


@register("table_matches_by_role", f"with {_ROWS} select page_id, case when k = 2 then one else one end as player1, two as player2, score, case when k < 2 then stage else '' end as round from r where k < 2 union all select page_id, one, stage, score, '' from r where k = 2 union all select page_id, player1, player2, score, round from g")
def table_matches_by_role(spark: SparkSession, d: str) -> DataFrame:
    """By role: the column of stages is told by its header; without one its words vote as names do."""
    return _whole(dom.table_matches(_tables(spark, d), "role")).select("page_id", "player1", "player2", "score", "round")


@register(
    "script_matches",
    f"""with r as (select l_orderkey as page_id, l_linenumber as ln, {_name_sql('l_partkey', 'A.B.')} as one, {_name_sql('l_suppkey', 'C.D.')} as two, l_linenumber || ':' || (l_linenumber % 3) as score, l_linestatus as st from lineitem)
 select page_id, 'tour.matches.' || (row_number() over (partition by page_id order by ln, one, two) - 1) as element, one as player1, two as player2, score, 'final' as round, st as status, '' as winner from r
 union all select o_orderkey, '0', '', '', '7-5', '', '', 'W' from orders where o_orderkey in (select page_id from r)""",
)
def script_matches(spark: SparkSession, d: str) -> DataFrame:
    """State that scripts assign, with brackets and quotes in strings and code after it, a whole JSON script, and broken ones."""
    li = table(spark, d, "lineitem")
    item = _text('{"round": "final", "player1": {"name": "', _name("l_partkey", "A.B."), '"}, "note": "}; {\\" [", "player2": {"name": "', _name("l_suppkey", "C.D."), '"}, "score": "', F.col("l_linenumber"), ":", F.col("l_linenumber") % 3, '", "status": "', F.col("l_linestatus"), '"}')
    body = _page(li, item, between=", ")
    names = F.element_at(F.array(*[F.lit(n) for n in ("window.__INITIAL_STATE__", "var __data", "window.__NUXT__")]), (F.col("page_id") % 3 + 1).cast("int"))
    html = _text("<script>", names, ' = {"tour": {"id": 1, "matches": [', F.col("body"), ']}} ; if (x) { y("}") }</script><script type="application/ld+json">[{"score": "7-5", "winner": "W"}]</script><script type="application/json">{broken</script><script>__data = {"a": [1, {"score": "1-1"}</script>')
    found = _whole(dom.script_matches(body.select("page_id", html.alias("html"))))
    element = F.regexp_extract("raw_row", r'"([^"]*?\d+)\.', 1)
    return found.select("page_id", element.alias("element"), "player1", "player2", "score", "round", "status", "winner")
