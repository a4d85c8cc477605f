"""Scans of web pages and embedded documents: anchors, tables, label/value text, match lines, JSON."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import HEADERS, header_column, strip_html, tour_id, tournament_metadata, value_after_label


def anchors(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """Distinct link targets of each page."""
    return pages.select(page_id, F.explode(F.array_distinct(F.regexp_extract_all(html, F.lit('href="([^"]*)"'), 1))).alias("href"))


def tour_anchors(pages: DataFrame) -> DataFrame:
    """Links to tournaments, one row an id."""
    return anchors(pages).withColumn("tour_id", tour_id(F.col("href"))).where("tour_id is not null").groupBy("tour_id").agg(F.min("href").alias("href"))


def label_values(pages: DataFrame, labels: dict[str, str], html: str = "html") -> DataFrame:
    """Columns from the text line that follows each label."""
    text = F.regexp_replace(F.col(html), r"(?i)<(?:br|/p|/div|/li|/td|/th|/tr|/h\d|/dt|/dd|/span)[^>]*>", "\n")
    lines = F.filter(F.transform(F.split(text, "\n"), strip_html), lambda x: x != "")
    return pages.withColumn("_lines", lines).select("*", *[value_after_label(F.col("_lines"), label).alias(name) for name, label in labels.items()]).drop("_lines")


def json_paths(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, dotted path, text) of each leaf of a JSON column, without Python."""
    flat = df.select(key, F.explode(F.from_json(column, "map<string,string>")).alias("path", "value"))
    return flat


def json_leaves(df: DataFrame, key: str, column: str, ordered: bool = False) -> DataFrame:
    """(key, dotted path, text) of each leaf at any depth; a document that can't be read gives one row with the error.

    ``ordered``: with ``pos``, the leaf's place in its document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    rows += [(k, path, leaf, None, i) for i, (path, leaf) in enumerate(flatten(json.loads(text)))] if text is not None else []
                except ValueError as error:
                    rows.append((k, None, None, str(error), None))
            if rows:
                kinds = (batch.schema.field(0).type, pa.string(), pa.string(), pa.string(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], [key, "path", "value", "parse_error", "pos"])

    out = df.select(key, F.col(column).cast("string")).mapInArrow(run, f"{key} {dict(df.dtypes)[key]}, path string, value string, parse_error string, pos int")
    return out if ordered else out.drop("pos")


def grouped_leaves(leaves: DataFrame, key: str, fields: dict[str, str]) -> DataFrame:
    """Leaves of one list element in one row: grouped by the path up to its last number, a column for each field whose pattern
    the rest of the path matches; elements with none of them go."""
    parts = leaves.withColumn("element", F.regexp_extract("path", r"^(.*\.?\d+)(?:\.[^.]*[^.\d][^.]*)*$", 1)).where("element <> ''")
    rest = F.substring(F.col("path"), F.length("element") + 2, F.length("path"))
    out = parts.groupBy(key, "element").agg(*[F.min(F.when(rest.rlike(p), F.col("value"))).alias(name) for name, p in fields.items()])
    return out.where(" or ".join(f"{name} is not null" for name in fields))


def header_rows(cells: DataFrame, least: int = 2) -> DataFrame:
    """Tables of :func:`table_cells` whose first row has known headers: a row for each further line, by column name."""
    named = cells.where("row_no = 0").select("page_id", "table_no", "column_no", header_column(F.col("text")).alias("name")).where("name is not null")
    good = named.groupBy("page_id", "table_no").agg(F.count("*").alias("n")).where(F.col("n") >= least).drop("n")
    body = cells.where("row_no > 0").join(named, ["page_id", "table_no", "column_no"]).join(good, ["page_id", "table_no"])
    return body.groupBy("page_id", "table_no", "row_no").pivot("name", list(dict.fromkeys(HEADERS.values()))).agg(F.first("text"))


def flatten(value: object, prefix: str = "") -> Iterator[tuple[str, str]]:
    """Dotted paths of all leaves."""
    if isinstance(value, dict):
        for k, v in value.items():
            yield from flatten(v, f"{prefix}.{k}" if prefix else str(k))
    elif isinstance(value, list):
        for i, v in enumerate(value):
            yield from flatten(v, f"{prefix}.{i}" if prefix else str(i))
    else:
        yield prefix, "" if value is None else str(value)


SCRIPT_JSON = re.compile(r"<script[^>]*type=[\"']application/(?:ld\+)?json[\"'][^>]*>(.*?)</script>", re.S | re.I)
ASSIGNED_JSON = re.compile(r"(?:window\.__\w+__|__NEXT_DATA__|initialState|initialData)\s*=\s*(\{.*?\})\s*;?\s*</script>", re.S)


def script_json(page: str) -> Iterator[tuple[str, str]]:
    """Leaves of all JSON documents that a page's scripts hold; broken ones are skipped."""
    for found in (*SCRIPT_JSON.findall(page), *ASSIGNED_JSON.findall(page)):
        try:
            yield from flatten(json.loads(found))
        except ValueError:
            continue


class _Tables(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list[str]]] = []
        self.open: list[int] = []
        self.cell: list[str] | None = None
        self.links: dict[tuple[int, int, int], str] = {}

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "table":
            self.tables.append([])
            self.open.append(len(self.tables) - 1)
        elif self.open and tag == "tr":
            self._close()
            self.tables[self.open[-1]].append([])
        elif self.open and tag in ("td", "th"):
            self._close()
            if not self.tables[self.open[-1]]:
                self.tables[self.open[-1]].append([])
            self.cell = []
        elif self.open and tag == "a" and self.cell is not None:
            t = self.open[-1]
            self.links[t, len(self.tables[t]) - 1, len(self.tables[t][-1])] = dict(attrs).get("href") or ""

    def _close(self) -> None:
        if self.cell is not None and self.open:
            self.tables[self.open[-1]][-1].append(" ".join("".join(self.cell).split()))
        self.cell = None

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th", "tr", "table"):
            self._close()
        if tag == "table" and self.open:
            self.open.pop()

    def handle_data(self, data: str) -> None:
        if self.cell is not None:
            self.cell.append(data)


def html_tables(page: str) -> list[list[list[str]]]:
    """Rows of cell texts of each table."""
    p = _Tables()
    p.feed(page)
    p.close()
    return p.tables


def table_cells(pages: DataFrame, page_id: str = "page_id") -> DataFrame:
    """(page, table, row, column, text) of all cells; a page that can't be read gives one row with the error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, page in zip(batch.column("page_id").to_pylist(), batch.column("html").to_pylist(), strict=True):
                try:
                    rows += [(i, t, r, c, text, None) for t, table in enumerate(html_tables(page or "")) for r, row in enumerate(table) for c, text in enumerate(row)]
                except Exception as error:
                    rows.append((i, None, None, None, None, str(error)))
            if rows:
                cols = list(zip(*rows, strict=True))
                kinds = (batch.schema.field("page_id").type, pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["page_id", "table_no", "row_no", "column_no", "text", "parse_error"])

    kind = dict(pages.dtypes)[page_id]
    return pages.select(F.col(page_id).alias("page_id"), "html").mapInArrow(run, f"page_id {kind}, table_no int, row_no int, column_no int, text string, parse_error string")


NUMBER, SUMMARY = re.compile(r"\d{1,4}"), re.compile(r"\d+\s*[-–—:]\s*\d+")
#: The header cells before the stage column (each is held by its line), how the labels of optional pairs begin, and
#: the lines that end the block.
HEADER = ("№", "Участник 1", "Участник 2", "Счет")
LABELS = {"Статус": "status", "Дата": "date", "Начало": "time"}
FOOTERS = frozenset(("2026 ©", "Карточка турнира", "Напишите нам, мы онлайн!"))
FIELDS = ("number", "player1", "player2", "score", "detail", "draw", "status", "date", "time")


def match_records(lines: list[str]) -> list[dict[str, str]]:
    """Match records after the first header: six lines each, then label pairs in order; a bad line is passed over, a footer ends."""
    starts = (i + 5 for i in range(len(lines) - 4) if lines[i] == HEADER[0] and all(h in lines[i + k] for k, h in enumerate(HEADER)))
    i = next(starts, len(lines))
    out: list[dict[str, str]] = []
    while i + 6 <= len(lines):
        if lines[i] in FOOTERS:
            break
        six = lines[i : i + 6]
        if not (NUMBER.fullmatch(six[0]) and SUMMARY.fullmatch(six[3])):
            i += 1
            continue
        record = dict(zip(FIELDS, six, strict=False))
        i += 6
        for label, field in LABELS.items():
            if i >= len(lines):
                break
            if lines[i].startswith(label):
                record[field] = lines[i + 1] if i + 1 < len(lines) else ""
                i += 2
        out.append(record)
    return out


_HIDDEN, _TAG = re.compile(r"<(script|style)\b.*?</\1>", re.I | re.S), re.compile(r"<[^>]+>")
#: Where one of these tags may begin, in any case that a page may write (the long s folds to s).
_MAY_HIDE = re.compile(r"<[sS\u017f]")


def text_lines(page: str) -> list[str]:
    """The page's text, one line a run between tags."""
    text = _HIDDEN.sub("\n", page) if _MAY_HIDE.search(page) else page
    runs = _TAG.sub("\n", text).split("\n")
    lines = (unescape(t) if "&" in t else t for t in runs if t)
    return [x for t in lines if (x := " ".join(t.split()))]


def page_matches(pages: DataFrame, page_id: str = "page_id") -> DataFrame:
    """Match records of all pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, r) for i, p in zip(batch.column("page_id").to_pylist(), batch.column("html").to_pylist(), strict=True) for r in match_records(text_lines(p or ""))]
            if rows:
                cols = [pa.array([i for i, _ in rows], batch.schema.field("page_id").type), *(pa.array([r.get(f) for _, r in rows], pa.string()) for f in FIELDS)]
                yield pa.RecordBatch.from_arrays(cols, ["page_id", *FIELDS])

    kind = dict(pages.dtypes)[page_id]
    return pages.select(F.col(page_id).alias("page_id"), "html").mapInArrow(run, f"page_id {kind}, " + ", ".join(f"{f} string" for f in FIELDS))


def page_metadata(pages: DataFrame, page_id: str = "page_id") -> DataFrame:
    """The tournament of each page: name, place, age group, category, first day, and its id by the page's name."""
    text = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>", "\n"), r"<[^>]+>", "\n")
    lines = F.filter(F.transform(F.split(text, "\n"), strip_html), lambda x: x != "")
    found = tournament_metadata(F.col("_lines"))
    return pages.withColumn("_lines", lines).select(F.col(page_id).alias("page_id"), tour_id(F.col(page_id).cast("string")).alias("tour_id"), *[c.alias(n) for n, c in found.items()])
