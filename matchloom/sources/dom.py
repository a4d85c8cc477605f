"""Element trees of pages, and what is read from them: blocks, cards, calendar links, details of a tournament, tables.

One tree rule for all scans: a start tag nests in the element that is open, an end tag closes up to its nearest open namesake, an end tag
without one is passed over, void elements hold nothing; a table's cell or row also ends where the next one begins. Python reads a page into a tree and gives flat records; which of
them are matches, and their fields, are Column expressions.

A null page has no elements; a page that can't be read gives one row with ``parse_error`` and no other page is affected.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.dates import parse_date

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Strings in them are no text of the elements around.
HIDDEN = frozenset(("script", "style", "template"))
_TABLE, _ROW, _CELL = frozenset(("table",)), frozenset(("tr",)), frozenset(("td", "th"))
TOUR = re.compile(r"/tours/(\d+)")

#: Plain markup, between ``<`` and the next ``>``: end tags, and start tags with plain attributes.
_END = re.compile(r"/([a-zA-Z][a-zA-Z0-9]*)[ \t\n\r\f]*")
_START = re.compile(r"""([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n\r\f]+[a-zA-Z_:][-a-zA-Z0-9_:.]*(?:=(?:"[^"<>&]*"|'[^'<>&]*'|[^ \t\n\r\f"'=<>`/&]+))?)*)[ \t\n\r\f]*(/?)""")
#: Plain comments, and an empty one that stands for them.
_COMMENT, _NOTHING = re.compile(r"<!--(?:[^->][^-]*)?-->"), "<!>"
_ATTR = re.compile(r"""([a-zA-Z_:][-a-zA-Z0-9_:.]*)(?:=(?:"([^"]*)"|'([^']*)'|([^ \t\n\r\f"'=<>`/]+)))?""")
#: Elements whose content a parser may read in a way of its own.
_OWN_CONTENT = frozenset(("script", "style", "textarea", "title", "iframe", "noembed", "noframes", "noscript", "xmp", "plaintext"))


_COMES, _STANDS, _GOES, _WHOLE = range(4)  # opens an element, is one, ends one, is a script or style


@lru_cache(maxsize=4096)
def _markup(text: str) -> tuple[int, str, dict[str, str]] | None:
    """What stands between ``<`` and ``>``: its kind, name (none: nothing of the tree) and attributes; None where it isn't plain."""
    if text == "!" or (text[:1] == "!" and text[1:].lower() == "doctype html" and text.endswith("html")):
        return _STANDS, "", {}
    if m := _END.fullmatch(text):
        name = m[1].lower()
        return None if name in _OWN_CONTENT else (_GOES, name, {})
    if not (m := _START.fullmatch(text)):
        return None
    name, attrs = m[1].lower(), {k.lower(): a or b or c for k, a, b, c in _ATTR.findall(m[2])}
    if name in _OWN_CONTENT:
        return (_WHOLE, name, attrs) if m[1] in ("script", "style") and not m[3] else None
    return _STANDS if m[3] or name in VOID else _COMES, name, attrs


class Page(HTMLParser):
    """A page's elements in document order: an element's subtree is a range of elements, its text a range of strings."""

    def __init__(self, html: str) -> None:
        if not self._plain(html):
            self._clear()
            super().__init__(convert_charrefs=True)
            self.feed(html)
            self.close()
            self._text()
            while self._open:
                self._close()
        #: Characters of the strings before each, with a space after each.
        self.size = [0, *accumulate([len(s) + 1 for s in self.strings])]

    def _clear(self) -> None:
        self.tag: list[str] = []
        self.attrs: list[dict[str, str]] = []
        self.parent: list[int] = []
        self.end: list[int] = []
        self.first: list[int] = []
        self.last: list[int] = []
        self.strings: list[str] = []
        self._open: list[int] = []
        self._names: dict[str, int] = {}
        self._pending: list[str] = []

    def _plain(self, html: str) -> bool:
        """Reads plain markup tag by tag, to the tree that the parser's events give; False, with a part read, where other markup comes."""
        self._clear()
        tag, attrs, parent, end, first, last, strings, opened, names = self.tag, self.attrs, self.parent, self.end, self.first, self.last, self.strings, self._open, self._names
        hidden, tables = 0, 0
        parts = iter((_COMMENT.sub(_NOTHING, html) if "<!--" in html else html).split("<"))
        pending = next(parts)
        if "&" in pending:
            pending = unescape(pending)
        for part in parts:
            inside, closed, text = part.partition(">")
            if not closed or (read := _markup(inside)) is None:
                return False
            kind, name, given = read
            if name:
                if pending:
                    if not hidden and (pending := " ".join(pending.split())):
                        strings.append(pending)
                    pending = ""
                if kind == _GOES:
                    if names.get(name):
                        at = ""
                        while at != name:
                            n = opened.pop()
                            at = tag[n]
                            names[at] -= 1
                            if at == "template":
                                hidden -= 1
                            elif at == "table":
                                tables -= 1
                            end[n] = len(tag)
                            last[n] = len(strings)
                else:
                    if tables and (name == "td" or name == "tr" or name == "th"):
                        same = _ROW if name == "tr" else _CELL
                        for k in range(len(opened) - 1, -1, -1):
                            at = tag[opened[k]]
                            if at == "table" or (name != "tr" and at == "tr"):
                                break
                            if at in same:
                                for n in opened[k:]:
                                    names[tag[n]] -= 1
                                    hidden -= tag[n] == "template"
                                    end[n], last[n] = len(tag), len(strings)
                                del opened[k:]
                                break
                    n = len(tag)
                    tag.append(name)
                    attrs.append(given)
                    parent.append(opened[-1] if opened else -1)
                    first.append(len(strings))
                    end.append(n + 1)
                    last.append(len(strings))
                    if kind == _COMES:
                        opened.append(n)
                        names[name] = names.get(name, 0) + 1
                        if name == "template":
                            hidden += 1
                        elif name == "table":
                            tables += 1
                    elif kind == _WHOLE:
                        inside, closed, text = next(parts, "").partition(">")
                        if not closed or inside.rstrip(" \t\n\r\f") != f"/{name}":
                            return False
            if text:
                pending += unescape(text) if "&" in text else text
        if not hidden and (pending := " ".join(pending.split())):
            strings.append(pending)
        for n in opened:
            end[n], last[n] = len(tag), len(strings)
        opened.clear()
        return True

    def _text(self) -> None:
        text = " ".join("".join(self._pending).split())
        self._pending.clear()
        if text and not any(self._names.get(h) for h in HIDDEN):
            self.strings.append(text)

    def _close(self) -> None:
        n = self._open.pop()
        self._names[self.tag[n]] -= 1
        self.end[n], self.last[n] = len(self.tag), len(self.strings)

    def _end_cell(self, tag: str) -> None:
        """Closes the cell (row) of the innermost table that is still open where another begins."""
        same = _ROW if tag == "tr" else _CELL
        for n in reversed(self._open):
            if self.tag[n] == "table" or (tag != "tr" and self.tag[n] == "tr"):
                return
            if self.tag[n] in same:
                while self._open[-1] != n:
                    self._close()
                self._close()
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._text()
        if tag in ("td", "th", "tr") and self._names.get("table"):
            self._end_cell(tag)
        n = len(self.tag)
        self.tag.append(tag)
        self.attrs.append({k: v or "" for k, v in attrs})
        self.parent.append(self._open[-1] if self._open else -1)
        self.first.append(len(self.strings))
        self.end.append(n + 1)
        self.last.append(len(self.strings))
        if tag not in VOID:
            self._open.append(n)
            self._names[tag] = self._names.get(tag, 0) + 1

    def handle_endtag(self, tag: str) -> None:
        self._text()
        if self._names.get(tag):
            while self.tag[self._open[-1]] != tag:
                self._close()
            self._close()

    def handle_data(self, data: str) -> None:
        self._pending.append(data)

    def length(self, n: int) -> int:
        return max(0, self.size[self.last[n]] - self.size[self.first[n]] - 1)

    def lines(self, n: int) -> list[str]:
        return self.strings[self.first[n] : self.last[n]]

    def text(self, n: int) -> str:
        return " ".join(self.lines(n))

    def classes(self, n: int) -> list[str]:
        return self.attrs[n].get("class", "").split()

    def above(self, n: int) -> Iterator[int]:
        n = self.parent[n]
        while n >= 0:
            yield n
            n = self.parent[n]

    def select(self, tags: frozenset[str] | None = None, class_: str | None = None, within: int | None = None) -> Iterator[int]:
        """Elements by tag and class, of the whole page or below one element, in document order."""
        for n in range(0 if within is None else within + 1, len(self.tag) if within is None else self.end[within]):
            if (tags is None or self.tag[n] in tags) and (class_ is None or class_ in self.classes(n)):
                yield n

    def nearest(self, n: int, tags: frozenset[str]) -> int:
        return next((a for a in self.above(n) if self.tag[a] in tags), -1)


#: A scan hands on its rows when it has so many, or has read so many characters.
MOST_ROWS, MOST_CHARACTERS = 4096, 1 << 22


def scan(pages: DataFrame, read: Callable[[Page], list[tuple]], fields: list[tuple[str, pa.DataType, str]], page_id: str = "page_id", tree: Callable[[str], object] = Page) -> DataFrame:
    """``read``'s records of each page as rows: page_id, ``fields`` (name, Arrow type, Spark type), parse_error. ``tree``: what is made of the page's text for ``read``."""
    kind = dict(pages.dtypes)[page_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = pa.schema([batch.schema.field(0), *[(name, t) for name, t, _ in fields], ("parse_error", pa.string())])
            out: list[tuple] = []
            size, at = 0, batch.num_rows - 1
            for k, (i, html) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1), strict=True)):
                text = html.as_py()
                if text is not None:
                    try:
                        out += [(i, *r, None) for r in read(tree(text))]
                    except Exception as error:
                        out.append((i, *[None] * len(fields), f"parse_error: {error}"))
                    size += len(text)
                if out and (k == at or len(out) >= MOST_ROWS or size >= MOST_CHARACTERS):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                    out, size = [], 0

    return pages.select(F.col(page_id).alias("page_id"), F.col("html").cast("string").alias("html")).mapInArrow(run, f"page_id {kind}, " + ", ".join(f"{name} {s}" for name, _, s in fields) + ", parse_error string")


_STRINGS = pa.list_(pa.string())
BLOCKS = frozenset(("div", "li", "tr", "section", "article"))


def elements(pages: DataFrame, tags: frozenset[str] = BLOCKS, least: int = 0, most: int = 1 << 30) -> DataFrame:
    """Elements of the ``tags`` with ``least`` to ``most`` characters of text: node, the nearest of them above (parent), tag, classes, text."""

    def read(p: Page) -> list[tuple]:
        return [(n, above if (above := p.nearest(n, tags)) >= 0 else None, p.tag[n], p.classes(n), p.text(n)) for n in p.select(tags) if least <= p.length(n) <= most]

    return scan(pages, read, [("node", pa.int32(), "int"), ("parent", pa.int32(), "int"), ("tag", pa.string(), "string"), ("classes", _STRINGS, "array<string>"), ("text", pa.string(), "string")])


#: Sets of a score, and names of two players, in a card's text; a card has 10 to 700 characters.
CARD_SCORE = r"(\d+:\d+(?:\s+\d+:\d+){0,4}|\d+-\d+(?:\s+\d+-\d+){0,4})"
CARD_NAME = r"([А-ЯA-Z][а-яa-z\-']+\s+[А-ЯA-Z]\.[А-ЯA-Z]\.|[А-ЯA-Z][а-яa-z\-']+\s+[А-ЯA-Z][а-яa-z\-']+)"
CARD_LEAST, CARD_MOST = 10, 700
MATCH_FIELDS = ("source_parser", "place", "player1", "player2", "score", "round", "status", "winner", "raw_row", "parse_error")


def _of(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _cards(p: Page) -> list[tuple]:
    size, first, last = p.size, p.first, p.last
    return [(n, p.text(n)) for n, tag in enumerate(p.tag) if tag in BLOCKS and CARD_LEAST <= size[last[n]] - size[first[n]] - 1 <= CARD_MOST]


def dom_cards(pages: DataFrame) -> DataFrame:
    """Blocks that name two players or hold a score, nested ones each: a row each in the order of the page."""
    cards = scan(pages, _cards, [("node", pa.int32(), "int"), ("text", pa.string(), "string")])
    names, score = F.regexp_extract_all("text", F.lit(CARD_NAME), 1), F.regexp_extract("text", CARD_SCORE, 1)
    read = cards.withColumns({"_names": F.when(F.col("text").isNotNull(), names), "score": _of(score)}).where("parse_error is not null or score <> '' or size(_names) >= 2")
    nth = lambda i: _of(F.get("_names", F.lit(i)))
    return read.select(
        "page_id", F.when(F.col("parse_error").isNull(), "dom_cards").otherwise("parse_error").alias("source_parser"), F.lpad(F.col("node").cast("string"), 9, "0").alias("place"),
        nth(0).alias("player1"), nth(1).alias("player2"), "score", F.lit("").alias("round"), _of(F.col("parse_error")).alias("status"), F.lit("").alias("winner"), _of(F.col("text")).alias("raw_row"), "parse_error",
    )


# --- calendar

#: Fixed value: classes of the elements that hold one event.
EVENT_CLASS = re.compile(r"tour|tournament|event|calendar|card|row|item", re.I)
_SCOPE_END = frozenset(("body", "html"))


def _calendar(p: Page) -> list[tuple]:
    links = [(n, m[1]) for n in p.select(frozenset("a")) if (m := TOUR.search(p.attrs[n].get("href", "")))]
    at = [n for n, _ in links]
    other = [len(links)] * len(links)  # the first later link to another tournament
    for i in range(len(links) - 2, -1, -1):
        other[i] = other[i + 1] if links[i][1] == links[i + 1][1] else i + 1

    def one(n: int) -> bool:
        """Links to one tournament alone lie below."""
        lo, hi = bisect_left(at, n), bisect_left(at, p.end[n])
        return lo < hi <= other[lo]

    out, seen = [], set()
    for n, tour in links:
        if tour in seen:
            continue
        seen.add(tour)
        alone = []
        for a in p.above(n):
            if p.tag[a] in _SCOPE_END or p.length(a) > 2000 or not one(a):
                break
            if p.length(a):
                alone.append(a)
        near = alone[0] if alone else next((a for a in p.above(n) if p.tag[a] in ("tr", "li") or (p.length(a) > 20 and EVENT_CLASS.search(p.attrs[a].get("class", "")))), p.parent[n])
        box = p.lines(near) if near >= 0 else p.lines(n)
        out.append((len(out), tour, p.attrs[n]["href"], p.text(n), box, p.lines(alone[-1]) if alone else box))
    return out


def calendar_links(pages: DataFrame) -> DataFrame:
    """Links to tournaments, the first of each on its page: anchor text, lines of the nearest element that holds no other tournament, and of the widest."""
    return scan(pages, _calendar, [("place", pa.int32(), "int"), ("tour_id", pa.string(), "string"), ("href", pa.string(), "string"), ("anchor", pa.string(), "string"), ("box", _STRINGS, "array<string>"), ("around", _STRINGS, "array<string>")])


def calendar(pages: DataFrame, base: str = "https://example.org") -> DataFrame:
    """One row a tournament: id, name, city, first and last day, URLs. The first page (by id) and link that names it counts."""
    found = calendar_links(pages).where("tour_id is not null")
    dates = F.regexp_extract_all(F.array_join("around", " \n "), F.lit(r"(\d{1,2}\.\d{1,2}\.\d{4}|\d{4}-\d{2}-\d{2}|\d{1,2} \p{L}+ \d{4})"), 1)
    days = F.filter(F.transform(dates, parse_date), lambda x: x.isNotNull())
    w = Window.partitionBy("tour_id").orderBy(F.asc_nulls_last("page_id"), "place")
    first = found.withColumn("_n", F.row_number().over(w)).where("_n = 1")
    link = T.absolute_url(F.col("href"), base)
    return first.select("tour_id", T.tournament_name(F.col("anchor"), F.col("box")).alias("tournament_name"), T.guess_city(F.col("around")).alias("city"), F.get(days, F.lit(0)).alias("start_date"), F.get(days, F.lit(1)).alias("end_date"), link.alias("calendar_url"), "page_id")


#: Classes and labels of a tournament's page, and its states in the order in which they are looked for.
NAME_CLASS, DATES_CLASS, PAIR_CLASS, PLACE_LABEL = "name", "small-name", "two-columns", "Место проведения"
DETAIL_LABELS = {"Пол игроков": "gender", "Возрастная группа": "age_category", "Разряд турнира": "draw_type", "Категория турнира": "category", "Система проведения": "system"}
STATES = ("Турнир завершен", "В процессе проведения", "Подача поздних заявок", "Подача заявок")
DISTRICT = "Центральный ФО"


def _details(p: Page) -> list[tuple]:
    first: dict[str, str] = {}
    labels: dict[str, str] = {}
    for n, attrs in enumerate(p.attrs):
        classes = attrs.get("class", "").split() if attrs else ()
        for c in classes:
            if c == PAIR_CLASS:
                pair, below = [], n + 1
                while below < p.end[n] and len(pair) < 2:
                    if p.tag[below] == "div":
                        pair.append(p.text(below))
                    below = p.end[below]
                if len(pair) == 2 and (label := pair[0].rstrip(":")) and pair[1]:
                    labels[label] = pair[1]
            elif (c == NAME_CLASS or c == DATES_CLASS) and c not in first:
                first[c] = p.text(n)
    whole = " ".join(p.strings)
    return [(first.get(NAME_CLASS) or None, first.get(DATES_CLASS), list(labels.items()), next((s for s in STATES if s in whole), None))]


def tournament_details(pages: DataFrame) -> DataFrame:
    """A tournament's page: name and dates by class, labelled pairs, state; null where the page doesn't say."""
    found = scan(pages, _details, [("name", pa.string(), "string"), ("dates", pa.string(), "string"), ("labels", pa.map_(pa.string(), pa.string()), "map<string,string>"), ("status", pa.string(), "string")])
    label = lambda x: F.try_element_at("labels", F.lit(x))
    place = label(PLACE_LABEL)
    city = F.coalesce(T.guess_city(F.array(place)), F.nullif(F.trim(F.get(F.split(place, ","), F.lit(0))), F.lit("")))
    return found.select(
        "page_id", F.col("name").alias("tournament_name"), parse_date(F.col("dates")).alias("start_date"), F.when(place.isNotNull(), city).alias("city"), F.when(place.contains(DISTRICT), DISTRICT).alias("federal_district"),
        *[label(x).alias(c) for x, c in DETAIL_LABELS.items()], "status", "parse_error",
    )


# --- tables

#: A span longer than that is read as this long.
MOST_SPAN = 1000


def _lines(p: Page) -> list[tuple[int, int, bool, list[str]]]:
    """(table, row, heading, texts) of all rows of the page's tables, spans filled in."""
    tables = {n: i for i, n in enumerate(p.select(_TABLE))}
    if not tables:
        return []
    above: list[tuple[int, int]] = []  # of each element: the nearest table and row over it, itself included
    rows: dict[int, list[int]] = {}
    cells: dict[int, list[int]] = {}
    for n, (tag, up) in enumerate(zip(p.tag, p.parent, strict=True)):
        table, row = above[up] if up >= 0 else (-1, -1)
        if tag == "tr":
            rows.setdefault(table, []).append(n)
            row = n
        elif tag == "td" or tag == "th":
            if row >= 0 and above[row][0] == table:
                cells.setdefault(row, []).append(n)
        elif tag == "table":
            table = n
        above.append((table, row))
    span = lambda n, k: min(MOST_SPAN, int(v)) if (v := p.attrs[n].get(k, "1")).isdecimal() and int(v) else 1
    out = []
    for table, no in tables.items():
        held: dict[int, tuple[int, bool, str]] = {}  # cells that reach down: column -> rows left, header, text
        heading = True
        for r, row in enumerate(x for x in rows.get(table, []) if cells.get(x) or held):
            line: list[tuple[bool, str]] = []
            below: dict[int, tuple[int, bool, str]] = {}

            def reached(line: list = line, below: dict = below, held: dict = held) -> None:
                while (h := held.get(len(line))) is not None:
                    if h[0] > 1:
                        below[len(line)] = (h[0] - 1, *h[1:])
                    line.append(h[1:])

            for c in cells.get(row, []):
                if held:
                    reached()
                cell = (p.tag[c] == "th", p.text(c))
                if not p.attrs[c]:
                    line.append(cell)
                    continue
                for _ in range(span(c, "colspan")):
                    if span(c, "rowspan") > 1:
                        below[len(line)] = (span(c, "rowspan") - 1, *cell)
                    line.append(cell)
            if held:
                reached()
            held = below
            heading = heading and all(h for h, _ in line)
            out.append((no, r, heading, [text for _, text in line]))
    return out


def _cells(p: Page) -> list[tuple]:
    return [(no, r, k, heading, text) for no, r, heading, texts in _lines(p) for k, text in enumerate(texts)]


def table_grid(pages: DataFrame) -> DataFrame:
    """(page, table, row, column, heading, text) of all cells, spans filled in; nested tables are tables of their own. ``heading``: the
    leading rows of header cells alone."""
    return scan(pages, _cells, [("table_no", pa.int32(), "int"), ("row_no", pa.int32(), "int"), ("column_no", pa.int32(), "int"), ("heading", pa.bool_(), "boolean"), ("text", pa.string(), "string")])


#: What header cells of each role hold, in the order in which the roles are tried.
ROLE_WORDS = {
    "winner": ("побед", "winner"), "player": ("игрок", "участник", "player", "фио"), "score": ("счет", "счёт", "score"), "round": ("этап", "стади", "раунд", "round", "stage"),
    "status": ("статус", "status"), "date": ("дата", "date"), "number": ("№", "#"),
}
#: A cell's text has single spaces alone, so these are text.score_cell, is_match_number and player_cell of it.
_SCORE, _NUMBER, _DIGIT = re.compile(r"[0-9]+[:-][0-9]+(?: [0-9]+[:-][0-9]+){0,4}"), re.compile(r"[0-9]{1,4}"), re.compile(r"[0-9]")
_INITIALS, _LETTER = re.compile(r"[А-ЯA-Z][а-яa-z\-']+ [А-ЯA-Z]\.[А-ЯA-Z]\."), re.compile(r"[А-ЯA-Zа-яa-z]")


def _is_player(text: str) -> bool:
    return len(text) >= 3 and bool((text.count(" ") in (1, 2) and _LETTER.search(text)) or _INITIALS.search(text))


@lru_cache(maxsize=4096)
def _word_role(text: str) -> str | None:
    low = text.lower()
    return next((role for role, words in ROLE_WORDS.items() if any(w in low for w in words)), None)


def _looks(text: str) -> str | None:
    """What a cell of a column without a telling header looks like."""
    if _SCORE.fullmatch(text):
        return "score"
    if _NUMBER.fullmatch(text):
        return "number"
    return "player" if _is_player(text) and not _DIGIT.search(text) else None


def _roles(lines: list[tuple[int, int, bool, list[str]]]) -> dict[int, str]:
    """Roles of one table's columns: their header's word, else what more than half of their filled cells look like."""
    said: dict[int, str] = {}
    filled: dict[int, int] = {}
    votes: dict[tuple[int, str], int] = {}
    for _, _, heading, texts in lines:
        for k, text in enumerate(texts):
            if heading:
                if (role := _word_role(text)) and role > said.get(k, ""):
                    said[k] = role
            elif text and k not in said:
                filled[k] = filled.get(k, 0) + 1
                if role := _looks(text):
                    votes[k, role] = votes.get((k, role), 0) + 1
    return {k: role for (k, role), n in votes.items() if n * 2 > filled[k]} | said


def _by_table(p: Page) -> Iterator[tuple[int, list[tuple[int, int, bool, list[str]]]]]:
    tables: dict[int, list[tuple[int, int, bool, list[str]]]] = {}
    for line in _lines(p):
        tables.setdefault(line[0], []).append(line)
    yield from tables.items()


def _column_roles(p: Page) -> list[tuple]:
    out = []
    for no, lines in _by_table(p):
        nth: dict[str, int] = {}
        for k, role in sorted(_roles(lines).items()):
            nth[role] = nth.get(role, 0) + 1
            out.append((no, k, role, nth[role]))
    return out


def table_roles(pages: DataFrame) -> DataFrame:
    """(page, table, column, role, nth): each column's role by its header, else by a vote of its cells; ``nth`` of that role in its table. A page that can't be read gives its error alone."""
    return scan(pages, _column_roles, [("table_no", pa.int32(), "int"), ("column_no", pa.int32(), "int"), ("role", pa.string(), "string"), ("nth", pa.int32(), "int")])


#: Roles of which a row's first filled cell is a field of its own, by role alone.
_ONE_EACH = ("round", "status", "winner")


def _matches(by: str) -> Callable[[Page], list[tuple]]:
    """Per row of a page's tables: players, score and the other fields, names of columns and texts; rows with two players or a score."""

    def read(p: Page) -> list[tuple]:
        out = []
        for no, lines in _by_table(p):
            roles = _roles(lines) if by == "role" else {}
            head = lines[0][3] if lines[0][2] else []
            for _, r, heading, texts in lines:
                if heading:
                    continue
                of: dict[str, list[str]] = {}
                for k, text in enumerate(texts):
                    if text and (role := roles.get(k) if by == "role" else "score" if _SCORE.fullmatch(text) else "player" if _is_player(text) else None):
                        of.setdefault(role, []).append(text)
                players = of.get("player", [])
                if len(players) < 2 and "score" not in of:
                    continue
                pad = [*players[:2], "", ""]
                names = [head[k] if k < len(head) else str(k) for k in range(len(texts))]
                out.append((f"{no:06d}.{r:09d}", pad[0], pad[1], of.get("score", [""])[0], *[of[x][0] if x in of else "" for x in _ONE_EACH], names, texts))
        return out

    return read


def table_matches(pages: DataFrame, by: str = "cell") -> DataFrame:
    """Rows of tables that name two players or hold a score; a page's tables are read where the page is, without an exchange. A page that can't be read gives one row, as in :func:`dom_cards`.

    ``by="cell"``: in each row the first two cells that look like players and the first that looks like a score, whatever their columns.
    ``by="role"``: the cells of the table's columns with these roles (:func:`table_roles`), so rounds or courts of two words are no players.
    """
    text = lambda n: (n, pa.string(), "string")
    found = scan(pages, _matches(by), [*map(text, ("place", "player1", "player2", "score", *_ONE_EACH)), ("names", _STRINGS, "array<string>"), ("texts", _STRINGS, "array<string>")])
    row = F.to_json(F.transform(F.arrays_zip("names", "texts"), lambda x: F.struct(x["names"].alias("column"), x["texts"].alias("text"))))
    read = F.col("parse_error").isNull()
    filled = {c: _of(F.col(c)) for c in ("player1", "player2", "score", *_ONE_EACH)} | {"status": F.coalesce("parse_error", "status")}
    return found.select("page_id", F.when(read, "html_table").otherwise("parse_error").alias("source_parser"), "place", *[v.alias(c) for c, v in filled.items()], _of(row).alias("raw_row"), "parse_error")


# --- JSON in scripts

#: Variables that pages assign their data to.
STATE_NAMES = ("__INITIAL_STATE__", "__NUXT__", "__NEXT_DATA__", "__data")


def script_documents(pages: DataFrame, page_id: str = "page_id") -> DataFrame:
    """JSON documents of a page's scripts (page, script and part number, text, doc as VARIANT): whole JSON scripts, and values assigned to known names.

    A value ends where its brackets are balanced, whatever code follows and whatever brackets stand in its strings; what isn't JSON is passed over.
    """
    script = r"(?is)<script\b([^>]*)>(.*?)</script\s*>"
    kinds, bodies = F.regexp_extract_all("html", F.lit(script), 1), F.regexp_extract_all("html", F.lit(script), 2)
    each = pages.select(F.col(page_id).alias("page_id"), F.posexplode(F.arrays_zip(kinds.alias("kind"), bodies.alias("body"))).alias("script_no", "s")).select("page_id", "script_no", "s.kind", "s.body")
    head = rf"(?s)(?:{'|'.join(STATE_NAMES)})\s*=\s*(?=\{{)"
    whole = F.when(F.col("kind").rlike(r"(?i)application/(?:ld\+)?json"), F.array(F.trim("body", F.lit(" \t\r\n"))))
    # what follows each assignment, up to the script's end
    parts = F.slice(F.split("body", head), 2, 1 << 30)
    texts = each.select("page_id", "script_no", F.posexplode(F.concat(F.coalesce(whole, F.array().cast("array<string>")), F.transform(parts, balanced))).alias("part_no", "text"))
    return texts.withColumn("doc", F.try_parse_json("text")).where("doc is not null")


def balanced(c: Column) -> Column:
    """The leading JSON object of a text, by its brackets: strings are blanked first, so theirs don't count; null if it never ends."""
    # tokens: strings with their escapes, brackets, and what lies between
    tokens = F.regexp_extract_all(c, F.lit(r'(?s)("[^"\\]*+(?:\\.[^"\\]*+)*+"|[{}\[\]]|[^"{}\[\]]++|")'), 1)
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("n"), F.lit(False).alias("done"))

    def step(s: Column, t: Column) -> Column:
        depth = s["depth"] + F.when(t.isin("{", "["), 1).when(t.isin("}", "]"), -1).otherwise(0)
        return F.when(s["done"], s).otherwise(F.struct(depth.alias("depth"), (s["n"] + 1).alias("n"), (depth <= 0).alias("done")))

    end = F.aggregate(tokens, start, step)
    return F.when(end["done"], F.array_join(F.slice(tokens, F.lit(1), end["n"]), ""))


#: Words of the paths that name players, and words of which a record needs one.
PLAYER_PATHS = ("player", "participant", "competitor", "name")
RECORD_WORDS = ("player", "score", "match", "winner", "participant")


#: A leaf's list element: its path up to the first number that stands alone.
_ELEMENT = re.compile(r"((?:[^.]*[^.0-9][^.]*\.|\.)*[0-9]+)(?:\.|(?:\r\n|[\n\r\u0085\u2028\u2029])?\Z)")


_SCRIPT = re.compile(r"<script\b([^>]*)>(.*?)</script\s*>", re.A | re.I | re.S)
_JSON_KIND = re.compile(r"application/(?:ld\+)?json", re.A | re.I)
_ASSIGNED = re.compile(rf"(?:{'|'.join(STATE_NAMES)})\s*=\s*(?=\{{)", re.A)
#: White space of text.normalize_text.
_SPACES = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_ESCAPE = re.compile(r"\\(u00..|.)", re.S)


def _no_constant(name: str) -> None:
    raise ValueError(name)


def _object(pairs: list[tuple[str, object]]) -> dict[str, object]:
    if len(found := dict(pairs)) < len(pairs):
        raise ValueError("a key twice")
    return found


#: As VARIANT reads JSON: no NaN, no key twice.
_DECODER = json.JSONDecoder(object_pairs_hook=_object, parse_constant=_no_constant)


def _documents(html: str) -> Iterator[tuple[int, int, object]]:
    """Script and part number and value of each JSON document, as in :func:`script_documents`."""
    for script, (kind, body) in enumerate(_SCRIPT.findall(html)):
        whole = [body.strip(" \t\r\n")] if _JSON_KIND.search(kind) else []
        for part, text in enumerate([*whole, *_ASSIGNED.split(body)[1:]]):
            try:
                # a value that is assigned ends where it is read to its end
                yield script, part, _DECODER.decode(text) if part < len(whole) else _DECODER.raw_decode(text)[0]
            except ValueError:
                continue


def _quoted(text: str) -> str:
    """A JSON string as to_json writes it."""
    out = json.encoder.encode_basestring(text)
    return _ESCAPE.sub(lambda m: "\\u" + m[1][1:].upper() if m[1][0] == "u" else m[0], out) if "\\u00" in out else out


_PLAYER, _SCORES, _RECORD = 1, 2, 4
_OTHER = (("round", "stage"), ("status",), ("winner",))


@lru_cache(maxsize=4096)
def _path(path: str) -> tuple[str | None, str, int, tuple[bool, ...]]:
    """A path's list element, the path in lower case as a JSON string, what it may name, and which other fields."""
    low = path.lower()
    says = lambda words: any(w in low for w in words)
    m = _ELEMENT.match(path)
    return m and m[1], _quoted(low), _PLAYER * says(PLAYER_PATHS) | _SCORES * ("score" in low) | _RECORD * says(RECORD_WORDS), tuple(map(says, _OTHER))


def _leaves(value: object, prefix: str, out: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """pages.flatten's leaves, as a list."""
    if isinstance(value, dict):
        for k, v in value.items():
            _leaves(v, f"{prefix}.{k}" if prefix else k, out)
    elif isinstance(value, list):
        for i, v in enumerate(value):
            _leaves(v, f"{prefix}.{i}" if prefix else str(i), out)
    else:
        out.append((prefix, "" if value is None else str(value)))
    return out


def _plain_text(v: str) -> str:
    """text.normalize_text; a space is the only white space that prints."""
    return v if v.isprintable() and "  " not in v and v[:1] != " " != v[-1:] else _SPACES.sub(" ", v).strip(" ")


def _records(html: str) -> list[tuple]:
    """Records of a page's JSON: the list elements with two players or a score, in the order of the documents."""
    out = []
    for script, part, value in _documents(html):
        elements: dict[str, list[tuple]] = {}
        for pos, (path, leaf) in enumerate(_leaves(value, "", [])):
            element, *of = _path(path)
            if element is not None:
                elements.setdefault(element, []).append((pos, *of, _plain_text(leaf)))
        for leaves in elements.values():
            players, score, other, record = [], "", ["", "", ""], False
            for _, _, names, others, v in leaves:
                record = record or names & _RECORD
                if v:
                    if names & _PLAYER and _is_player(v):
                        players.append(v)
                    if names & _SCORES and not score and _SCORE.fullmatch(v):
                        score = v
                    if True in others:
                        for i, it in enumerate(others):
                            if it and not other[i]:
                                other[i] = v
            if len(players) < 2 and not score:
                continue
            if not record and not any(w in leaf[-1].lower() for leaf in leaves for w in RECORD_WORDS):
                continue
            raw = "{" + ",".join([f"{low}:{_quoted(v)}" for _, low, _, _, v in leaves]) + "}"
            raw.encode()  # half a surrogate pair is an error of its page
            out.append((f"{script:06d}.{part:06d}.{leaves[0][0]:09d}", *[*players[:2], "", ""][:2], score, *other, raw))
    return out


def script_matches(pages: DataFrame) -> DataFrame:
    """Match records of the JSON in a page's scripts, read where the page is, without an exchange. A page that can't be read gives one row, as in :func:`dom_cards`."""
    names = ("player1", "player2", "score", "round", "status", "winner", "raw_row")
    found = scan(pages, _records, [(n, pa.string(), "string") for n in ("place", *names)], tree=str)
    filled = {c: _of(F.col(c)) for c in names} | {"status": _of(F.coalesce("parse_error", "status"))}
    return found.select("page_id", F.when(F.col("parse_error").isNull(), "script_json").otherwise("parse_error").alias("source_parser"), "place", *[v.alias(c) for c, v in filled.items()], "parse_error")


def page_match_rows(pages: DataFrame, by: str = "cell") -> DataFrame:
    """What tables, scripts and cards of each page say of matches, and an error row for each page that can't be read; copies on one page once.

    Copies: rows of one page with equal players, score, round and first 250 characters of the raw row; tables come before scripts, those before cards.
    """
    rows = table_matches(pages, by).withColumn("_from", F.lit(0)).unionByName(script_matches(pages).withColumn("_from", F.lit(1))).unionByName(dom_cards(pages).withColumn("_from", F.lit(2)))
    same = Window.partitionBy("page_id", "player1", "player2", "score", "round", F.substring("raw_row", 1, 250)).orderBy("_from", "place")
    return rows.withColumn("_n", F.row_number().over(same)).where("_n = 1").select("page_id", *MATCH_FIELDS)
