"""Series of saved pages as a Spark data source: ``spark.read.format("page_series").load(folder)``, or ``readStream``.

A folder has a folder for each series, with files ``1.html``, ``2.html`` and so on. Each series is a partition and is read in order, one page held at a
time, until a page is missing, has no rows, or begins with the same rows as the page before (a site shows its last page again when there is no next);
``most_pages`` bounds a series (default 10000). A stream's offset is how many pages of each series have been read; a batch reads at most
``pages_per_batch`` more of each, and a series that has stalled gives nothing more until a page differs from the one before. Files are opened with
``pyarrow.fs`` by the folder's URI or path.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from .dom import Page

SCHEMA = "series string, page_no int, n_rows int, html string"
#: Rows of which a page's signature is made.
SIGNATURE_ROWS = 3


def signature(html: str) -> tuple[int, tuple[str, ...]]:
    """How many table rows with cells a page has, and the texts of the first of them."""
    p = Page(html)
    cells = frozenset(("td",))
    rows = [n for n in p.select(frozenset(("tr",))) if next(p.select(cells, None, n), None) is not None]
    return len(rows), tuple(p.text(n) for n in rows[:SIGNATURE_ROWS])


def _open(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if folder.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + folder[5:].lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(folder) if "://" in folder else (pyarrow.fs.LocalFileSystem(), folder)


def _listed(folder: str) -> dict[str, int]:
    """Pages of each series, counted from 1 up to the first that is missing."""
    files, root = _open(folder)
    found: dict[str, set[int]] = {}
    for f in files.get_file_info(pyarrow.fs.FileSelector(root, recursive=True)):
        series, _, name = f.path[len(root) :].strip("/").rpartition("/")
        number = name.removesuffix(".html")
        if f.is_file and series and name.endswith(".html") and number.isdecimal():
            found.setdefault(series, set()).add(int(number))
    out = {}
    for series, numbers in found.items():
        n = 0
        while n + 1 in numbers:
            n += 1
        out[series] = n
    return out


@dataclass
class Pages(InputPartition):
    """Pages ``first`` to ``last`` of a series."""

    series: str
    first: int
    last: int


def _read(folder: str, part: Pages, whole: bool) -> Iterator[tuple]:
    """Rows of the part; ``whole``: the series ends at the first page that stalls, else such pages are left out."""
    files, root = _open(folder)

    def page(n: int) -> tuple[str, int, tuple[str, ...]]:
        with files.open_input_stream(f"{root}/{part.series}/{n}.html") as f:
            html = f.read().decode("utf-8", "replace")
        return html, *signature(html)

    before = page(part.first - 1)[2] if part.first > 1 else None
    for n in range(part.first, part.last + 1):
        html, rows, mark = page(n)
        if not rows or mark == before:
            if whole:
                return
        else:
            yield part.series, n, rows, html
        before = mark


class _Reader(DataSourceReader):
    def __init__(self, folder: str, most: int) -> None:
        self.folder, self.most = folder, most

    def partitions(self) -> list[InputPartition]:
        return [Pages(s, 1, min(n, self.most)) for s, n in sorted(_listed(self.folder).items()) if n] or [Pages("", 1, 0)]

    def read(self, partition: Pages) -> Iterator[tuple]:
        return _read(self.folder, partition, True)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, folder: str, most: int, step: int) -> None:
        self.folder, self.most, self.step = folder, most, step
        self.at: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        self.at = {s: min(n, self.most, self.at.get(s, 0) + self.step) for s, n in _listed(self.folder).items()}
        return self.at

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.at = {**self.at, **{s: max(n, self.at.get(s, 0)) for s, n in end.items()}}
        return [Pages(s, start.get(s, 0) + 1, n) for s, n in sorted(end.items()) if n > start.get(s, 0)]

    def read(self, partition: Pages) -> Iterator[tuple]:
        return _read(self.folder, partition, False)


class PageSeries(DataSource):
    @classmethod
    def name(cls) -> str:
        return "page_series"

    def schema(self) -> str:
        return SCHEMA

    def _option(self, name: str, default: int) -> int:
        return int(self.options.get(name, default))

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], self._option("most_pages", 10_000))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(self.options["path"], self._option("most_pages", 10_000), self._option("pages_per_batch", 100))


def register(spark: SparkSession) -> None:
    """Makes the format known to the session."""
    spark.dataSource.register(PageSeries)
