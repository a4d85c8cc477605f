"""Page scans, versioned tables, resumed parts and paged series against plain expectations."""

import pytest
from pyspark.sql import functions as F

from matchloom.operators.master import merge_master
from matchloom.sources import dom, paged, versions
from matchloom.sources import pages as P

PAGE = """<html><script>window.__INITIAL_STATE__ = {"matches":[{"player1":{"name":"Ivanova A.B."},"player2":{"name":"Petrova C.D."},"score":"6:4 6:2","round":"1/2","note":"}; {"},{"player1":{"name":"Q"}}]}; var x = {a:1};</script>
<table><tr><th>№</th><th>Игрок 1</th><th>Игрок 2</th><th>Счет</th></tr><tr><td rowspan=2>1</td><td>Ivanova A.B.</td><td>Petrova C.D.</td><td>6:4 6:2</td></tr><tr><td>Xa B</td><td></td><td>bad</td></tr></table>
<section><div>Ivanova A.B. <b>Petrova C.D.</b> 6:4 6:2<div>short</div></div><div>Ivanova A.B. <b>Petrova C.D.</b> 6:4 6:2<div>short</div></div></section>"""


def test_rows_of_tables_scripts_and_cards(spark, monkeypatch):
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, ""), (4, "<li>7-6 6-1 yes")], "page_id long, html string")
    rows = dom.page_match_rows(df).collect()
    one = [r for r in rows if r["page_id"] == 1]
    assert [r["source_parser"] for r in sorted(one, key=lambda r: (r["source_parser"], r["place"]))] == ["dom_cards"] * 3 + ["html_table", "script_json"]
    assert {(r["player1"], r["player2"], r["score"]) for r in one} == {("Ivanova A.B.", "Petrova C.D.", "6:4 6:2")}
    assert [(r["score"], r["raw_row"]) for r in rows if r["page_id"] == 4] == [("7-6 6-1", "7-6 6-1 yes")]
    assert {r["page_id"] for r in rows} == {1, 4}


def test_a_bad_page_is_a_row(spark):
    def broken(p):
        if "bad" in p.strings:
            raise ValueError("no")
        return [(len(p.tag),)]

    import pyarrow as pa

    df = spark.createDataFrame([(1, "<p>good"), (2, "bad"), (3, None)], "page_id long, html string")
    got = {r["page_id"]: (r["n"], r["parse_error"]) for r in dom.scan(df, broken, [("n", pa.int32(), "int")]).collect()}
    assert got == {1: (1, None), 2: (None, "parse_error: no")}


def test_values_end_with_their_brackets(spark):
    odd = ['{"a": "}\\"{"} more }', '{"a": [1, {"b": 2}]}', '{"a": "' + '\\\\' * 100_000 + '"}; x', '{"open": [', "{}", '{"a": "never']
    got = [r[0] for r in spark.createDataFrame([(x,) for x in odd], "t string").select(dom.balanced(F.col("t"))).collect()]
    assert got == ['{"a": "}\\"{"}', '{"a": [1, {"b": 2}]}', odd[2][:-3], None, "{}", None]


def test_tree_rule():
    p = dom.Page("<div class='a b'>x<br>y</span><p>z</div>w<div>v")
    assert [(p.tag[n], p.text(n)) for n in p.select()] == [("div", "x y z"), ("br", ""), ("p", "z"), ("div", "v")]
    assert list(p.select(None, "b")) == [0] and list(p.select(frozenset(("p",)), None, 0)) == [2] and p.strings[-2:] == ["w", "v"]
    deep = dom.Page("<div>" * 30_000 + "t")
    assert deep.length(0) == 1 and deep.end[0] == 30_000


def test_spans_fill_the_grid(spark):
    html = "<table><tr><th colspan=2>h<th>i<tr><td rowspan=2>a<td>b<td>c<tr><td colspan=2>d<table><tr><td>in</table></table>"
    rows = dom.table_grid(spark.createDataFrame([(1, html)], "page_id int, html string")).orderBy("table_no", "row_no", "column_no").collect()
    assert [(r["table_no"], r["row_no"], r["heading"], r["text"]) for r in rows] == [(0, 0, True, "h"), (0, 0, True, "h"), (0, 0, True, "i"), (0, 1, False, "a"), (0, 1, False, "b"), (0, 1, False, "c"), (0, 2, False, "a"), (0, 2, False, "d in"), (0, 2, False, "d in"), (1, 0, False, "in")]


def test_versions_are_whole(spark, tmp_path):
    at = f"file:{tmp_path}/t"
    assert versions.read_version(spark, at) is None and versions.current_version(spark, at) == 0
    assert versions.publish(spark.range(3), at) == 1
    assert versions.publish(versions.read_version(spark, at).selectExpr("id + 1 as id"), at, 1) == 2
    with pytest.raises(versions.StaleVersion):
        versions.publish(spark.range(9), at, 1)
    # a writer that died: data without a pointer, and a pointer without content
    spark.range(50).write.parquet(f"{at}/dead")
    (tmp_path / "t" / "_versions" / "000000000003").write_text("")
    assert sorted(r[0] for r in versions.read_version(spark, at).collect()) == [1, 2, 3] and versions.read_version(spark, at, 1).count() == 3
    assert versions.publish(spark.range(1), at) == 4 and versions.read_version(spark, at).count() == 1


def test_a_broken_run_goes_on(spark, tmp_path):
    wanted = spark.createDataFrame([(d, g) for d in ("2025-01-01", "2025-02-01") for g in ("a", "b/ c")], "day string, grp string")
    asked = []

    def fetch(fail):
        def run(keys):
            asked.append(sorted(tuple(r) for r in keys.collect()))
            rows = keys.withColumn("n", F.explode(F.array(F.lit(1), F.lit(2))))
            return rows.withColumn("n", F.when(F.lit(fail) & (F.col("grp") == "a"), F.raise_error("gone")).otherwise(F.col("n")).cast("int"))

        return run

    with pytest.raises(Exception):
        versions.fetch_missing(wanted, str(tmp_path / "x"), ["day", "grp"], fetch(True))
    versions.fetch_missing(wanted.where("grp = 'a'"), str(tmp_path / "x"), ["day", "grp"], fetch(False))
    out = versions.fetch_missing(wanted, str(tmp_path / "x"), ["day", "grp"], fetch(False))
    assert out.count() == 8 and asked[-1] == [("2025-01-01", "b/ c"), ("2025-02-01", "b/ c")]
    again = versions.fetch_missing(wanted, str(tmp_path / "x"), ["day", "grp"], fetch(False))
    assert again.count() == 8 and asked[-1] == []


def test_merging_twice_changes_times_only(spark):
    new = spark.createDataFrame([("1", "A", None), ("2", None, "x"), ("2", "late", "y")], "tour_id string, city string, status string")
    now = lambda day: F.lit(f"2026-01-0{day}")
    order = [F.col("status").asc_nulls_first()]
    once = merge_master(None, new, now(1), incoming_order=order)
    twice = merge_master(once, new, now(2), incoming_order=order)
    cells = lambda df: sorted((r["tour_id"], r["city"], r["status"]) for r in df.collect())
    assert cells(once) == cells(twice) == [("1", "A", None), ("2", None, "x")]
    assert {str(r["created_at"])[:10] for r in twice.collect()} == {"2026-01-02"}


def paged_series(tmp_path):
    def page(*rows):
        return "<table><tr><th>h</th></tr>" + "".join(f"<tr><td>{r}</td></tr>" for r in rows) + "</table>"

    series = {"a/x": [page(1, 2, 3, 4), page(5), page(5), page(6)], "b": [page(1), page(2), page(), page(3)], "c": [page(1, 2, 3, 9), page(1, 2, 3, 8)], "d": [page(7)]}
    for name, found in series.items():
        (tmp_path / name).mkdir(parents=True)
        for i, html in enumerate(found):
            (tmp_path / name / f"{i + 1}.html").write_text(html)
    (tmp_path / "d" / "3.html").write_text(page(8))
    return {("a/x", 1), ("a/x", 2), ("b", 1), ("b", 2), ("c", 1), ("d", 1)}


def test_series_end_where_they_stall(spark, tmp_path):
    want = paged_series(tmp_path / "s")
    paged.register(spark)
    got = {(r["series"], r["page_no"]): r["n_rows"] for r in spark.read.format("page_series").load(str(tmp_path / "s")).collect()}
    assert got.keys() == want and got["a/x", 1] == 4
    assert {(r["series"], r["page_no"]) for r in spark.read.format("page_series").option("most_pages", 1).load(f"file://{tmp_path}/s").collect()} == {k for k in want if k[1] == 1}
    assert P.table_cells(spark.read.format("page_series").load(str(tmp_path / "s")).selectExpr("concat(series, '#', page_no) as page_id", "html")).where("row_no > 0").count() == 4 + 1 + 1 + 1 + 4 + 1


def test_a_stream_of_series_resumes(spark, tmp_path):
    paged_series(tmp_path / "s")
    paged.register(spark)

    def run():
        stream = spark.readStream.format("page_series").option("pages_per_batch", 1).load(str(tmp_path / "s"))
        q = stream.select("series", "page_no").writeStream.format("parquet").option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="0 seconds").start()
        try:
            q.processAllAvailable()
        finally:
            q.stop()
        return sorted((r["series"], r["page_no"]) for r in spark.read.parquet(str(tmp_path / "o")).collect())

    first = run()
    assert first == [("a/x", 1), ("a/x", 2), ("a/x", 4), ("b", 1), ("b", 2), ("b", 4), ("c", 1), ("d", 1)]
    (tmp_path / "s" / "d" / "2.html").write_text("<table><tr><td>2</td></tr></table>")
    assert run() == sorted([*first, ("d", 2), ("d", 3)])


@pytest.mark.parametrize("few,sketch", [(5_000, 10_000), (3, 10_000), (3, 20)])
def test_quantiles_of_all_columns_at_once(spark, monkeypatch, few, sketch):
    import numpy as np

    from matchloom.operators import evaluate as E

    rng = np.random.default_rng(2)
    cols = {"a": rng.normal(size=3000), "b": rng.integers(0, 4, 3000).astype(float), "c": 10 ** rng.uniform(-300, 300, 3000), "e": np.full(3000, 7.0), "f": np.where(rng.random(3000) < 0.9, 1.5, rng.normal(size=3000))}
    rows = [tuple(float(v[i]) if rng.random() > 0.1 else None for v in cols.values()) for i in range(3000)] + [(float("nan"), None, None, None, None)]
    df = spark.createDataFrame([(*r, None) for r in rows], "a double, b double, c double, e double, f double, nothing double").repartition(3)
    monkeypatch.setattr(E, "FEW", few)
    monkeypatch.setattr(E, "SKETCH", sketch)
    shares = [0.0, 0.1, 0.5, 0.999, 1.0]
    passes = []
    look = E._look
    monkeypatch.setattr(E, "_look", lambda *a: passes.append(1) or look(*a))
    got = E.quantiles(df, {c: shares for c in [*cols, "nothing"]})
    for k, c in enumerate(cols):
        held = [r[k] for r in rows if r[k] is not None and r[k] == r[k]]
        assert np.allclose(got[c], np.quantile(held, shares), rtol=1e-12), c
    assert got["nothing"] == [None] * 5 and (few < 5_000 or len(passes) == 1)


@pytest.mark.parametrize("by,want", [("cell", [("Ivanova A.B.", "Petrova C.D.", "1-0 6:4", ""), ("Round one", "Ivanova A.B.", "", "")]), ("role", [("Ivanova A.B.", "Petrova C.D.", "1-0 6:4", "x"), ("Ivanova A.B.", "Petrova C.D.", "", "Round one")])])
def test_tables_are_read_without_an_exchange(spark, by, want):
    html = "<table><tr><th>Этап<th>Игрок<th>B<th>C</tr><tr><td>x<td>Ivanova A.B.<td>Petrova C.D.<td>1-0 6:4</tr><tr><td>Round one<td>Ivanova A.B.<td>Petrova C.D.<td></tr><tr><td>Only one<td><td>no<td></tr></table>"
    html = html.replace("<th>B", "<th>player 2").replace("<th>C", "<th>счёт")
    out = dom.table_matches(spark.createDataFrame([(1, html)], "page_id int, html string"), by)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert [(r["player1"], r["player2"], r["score"], r["round"]) for r in out.orderBy("place").collect()] == want


def test_scripts_are_read_without_an_exchange(spark):
    html = """<script>__data = {"m": [{"player1": {"name": "Ivanova A.B."}, "p": [1], "player2": "Petrova C.D.", "Score": "6:4"}, {"score": "x"}], "a.1": {"b": [{"score": "7-5"}]}}</script><script type="application/json">[</script>"""
    out = dom.script_matches(spark.createDataFrame([(1, html)], "page_id int, html string"))
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert [(r["place"], r["player1"], r["player2"], r["score"]) for r in out.orderBy("place").collect()] == [("000000.000000.000000000", "Ivanova A.B.", "Petrova C.D.", "6:4"), ("000000.000000.000000005", "", "", "7-5")]


def test_plain_markup_gives_the_parsers_tree(monkeypatch):
    pages = ["<table><tr><td colspan=2>a<td>b<tr><th>c</table>x&amp;y<br/><p class='a b'>q", "<li>a<!-- c -->b<script>x('1')</script><template>no</template></i>z", "<a href='/x?a=1&b=2'>l</a><script>1<2</script>t", "a<b<div/>c"]
    tree = lambda p: [getattr(p, k) for k in ("tag", "attrs", "parent", "end", "first", "last", "strings", "size")]
    fast = [tree(dom.Page(h)) for h in pages]
    read = dom.Page._plain
    assert [read(dom.Page.__new__(dom.Page), h) for h in pages] == [True, True, False, False]
    monkeypatch.setattr(dom.Page, "_plain", lambda self, html: False)
    assert fast == [tree(dom.Page(h)) for h in pages]


def test_empty_scripts_and_comments_give_the_parsers_tree(monkeypatch):
    pages = ["<script />x</script>y", "a<!-- b -->c<p>d<!---->e", "<style a=1>q</style >r", "<!DOCTYPE html><p>x", "<a title='<!-- c -->'>t"]
    tree = lambda p: [getattr(p, k) for k in ("tag", "attrs", "parent", "end", "first", "last", "strings", "size")]
    fast = [tree(dom.Page(h)) for h in pages]
    monkeypatch.setattr(dom.Page, "_plain", lambda self, html: False)
    assert fast == [tree(dom.Page(h)) for h in pages]


def test_pairs_are_the_first_children_of_their_own():
    html = "<div class='two-columns x'><b><div>no</div></b><div>A:<div>in</div></div><i></i><div>v</div><div>w</div></div><p class=name></p><p class='name'>late</p>"
    html += "<div class=two-columns><div>B:</div><div class=two-columns><div>C:</div><div>c</div></div></div>"
    assert dom._details(dom.Page(html)) == [(None, None, [("A: in", "v"), ("B", "C: c"), ("C", "c")], None)]


def test_narrow_orders_are_dealt_before_their_pages_are_read(spark, tmp_path):
    from matchloom.plans import scans

    spark.range(40).selectExpr("id as o_orderkey", "'F' as o_orderstatus", "timestamp '2025-01-01' as o_orderdate", "'1-URGENT' as o_orderpriority").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    out = scans.calendar_details(spark, str(tmp_path))
    assert out.rdd.getNumPartitions() == 4 and out.count() == 40


def test_items_are_dealt_before_they_become_markup(spark, tmp_path):
    from matchloom.plans import scans

    spark.range(40).selectExpr("id div 4 as l_orderkey", "id as l_partkey", "id % 3 as l_suppkey", "cast(id % 4 as int) as l_linenumber").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    out = scans.dom_cards(spark, str(tmp_path))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "concat" not in plan[plan.index("Exchange") :] and out.count() > 40


def test_tables_that_cannot_be_read_are_no_results(spark, monkeypatch, tmp_path):
    from pyspark.errors import PySparkException

    from matchloom.plans import scans

    def broken(p):
        if "bad" in p.strings:
            raise ValueError("no")
        return good(p)

    good = dom._matches("cell")
    monkeypatch.setattr(dom, "_matches", lambda by: broken)
    html = "<table><tr><td>Ivanova A.B.<td>Petrova C.D.<td>1-0</tr></table>"
    df = spark.createDataFrame([(1, html), (2, "<p>bad</p>"), (3, None), (4, "<p>none</p>")], "page_id int, html string")
    got = {r["page_id"]: r for r in dom.table_matches(df).collect()}
    assert sorted(got) == [1, 2] and got[1]["parse_error"] is None and got[1]["source_parser"] == "html_table"
    assert (got[2]["source_parser"], got[2]["player1"], got[2]["status"], got[2]["parse_error"]) == ("parse_error", "", "parse_error: no", "parse_error: no")
    assert [(r["page_id"], r["source_parser"]) for r in dom.page_match_rows(df).where("parse_error is not null").collect()] == [(2, "parse_error")]

    def unread(p):
        raise ValueError("no")

    monkeypatch.setattr(dom, "_matches", lambda by: unread)
    spark.range(40).selectExpr("id div 4 as l_orderkey", "id as l_partkey", "id % 3 as l_suppkey", "cast(id % 4 as int) as l_linenumber").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    rows = scans.table_matches(spark, str(tmp_path)).collect()
    assert len(rows) == 10 and {r["parse_error"] for r in rows} == {"parse_error: no"}
    with pytest.raises(PySparkException, match="parse_error: no"):
        scans.table_matches_by_role(spark, str(tmp_path)).collect()


def test_scripts_become_records_where_the_page_is_read(spark):
    state = """{"m": [{"Player": {"name": "Ivanova\u00a0 A.B."}, "player2": "Petrova C.D.", "Score": "6:4", "score": " 7-5 ", "note": "}; {\\" [\\u0001", "stage": ""}, {"x": "a match", "score": "1-0"}, {"score": "none"}]}"""
    htmls = {
        1: f"<script>window.__NUXT__ = {state} ; if (x) {{ y('}}') }}</script>", 2: f"<SCRIPT type='application/ld+json'>\n{state}\n</script >", 3: """<script>__data = {"a": [{"score": "1-0", "score": "2-0"}]}</script>""",
        4: """<script>__data = {"a": [{"score": "1-0", "n": NaN}]}</script>""", 5: """<script type="application/json">[{"score": "1-0"}] x</script>""", 6: None, 7: """<script>__data = {"a": """ + "[" * 5000 + "]" * 5000 + "}</script>", 8: """<script>__data = {"a": [{"score": "1-0", "x": "\\ud800"}]}</script>""",
    }
    out = dom.script_matches(spark.createDataFrame(list(htmls.items()), "page_id int, html string"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "regexp_extract_all" not in plan and "aggregate(" not in plan  # tokens and leaves aren't rows of lambdas
    rows = sorted(out.collect(), key=lambda r: (r["page_id"], r["place"] or ""))
    one = [tuple(r)[2:10] for r in rows if r["page_id"] == 1]
    assert one == [tuple(r)[2:10] for r in rows if r["page_id"] == 2] and len(one) == 2
    assert one[0][:7] == ("000000.000000.000000000", "Ivanova A.B.", "Petrova C.D.", "6:4", "", "", "") and one[1][3] == "1-0"
    assert one[0][7] == r'{"m.0.player.name":"Ivanova A.B.","m.0.player2":"Petrova C.D.","m.0.score":"6:4","m.0.score":"7-5","m.0.note":"}; {\" [\u0001","m.0.stage":""}'
    assert {r["page_id"]: r["source_parser"] for r in rows if r["page_id"] > 2} == {7: "parse_error", 8: "parse_error"}
