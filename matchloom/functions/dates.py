"""Date parsing and repair as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Genitive month names.
MONTHS = {"января": 1, "февраля": 2, "марта": 3, "апреля": 4, "мая": 5, "июня": 6, "июля": 7, "августа": 8, "сентября": 9, "октября": 10, "ноября": 11, "декабря": 12}


def parse_date(c: Column) -> Column:
    """dd.mm.yyyy anywhere in the text, else d <genitive month> yyyy, else ISO, else day first with / or -."""
    dotted = F.regexp_extract(c, r"(\d{1,2}\.\d{1,2}\.\d{4})", 1)
    month = F.create_map(*[F.lit(x) for kv in MONTHS.items() for x in kv])
    named = F.regexp_extract(F.lower(c), r"(\d{1,2})\s+(\p{L}+)\s+(\d{4})", 1), F.regexp_extract(F.lower(c), r"(\d{1,2})\s+(\p{L}+)\s+(\d{4})", 2), F.regexp_extract(c, r"(\d{1,2})\s+(\p{L}+)\s+(\d{4})", 3)
    spelled = F.concat_ws("-", named[2], F.lpad(F.try_element_at(month, named[1]).cast("string"), 2, "0"), F.lpad(named[0], 2, "0")).try_cast("date")
    return F.coalesce(F.try_to_timestamp(dotted, F.lit("d.M.yyyy")).cast("date"), spelled, F.when(c.rlike(r"^\s*\d{4}-"), F.substring(F.trim(c), 1, 10).try_cast("date")), F.try_to_timestamp(F.regexp_extract(F.translate(c, "/", "-"), r"^\s*(\d{1,2}-\d{1,2}-\d{4})", 1), F.lit("d-M-yyyy")).cast("date"))


def format_dotted(c: Column) -> Column:
    return F.date_format(c, "dd.MM.yyyy")


def repair_month_start(c: Column) -> Column:
    """Snapshots are monthly: 2 to 12 January is a swapped first of a month."""
    return F.when((F.month(c) == 1) & F.day(c).between(2, 12), F.make_date(F.year(c), F.day(c), F.lit(1))).otherwise(c)


def month_starts(first: Column, last: Column) -> Column:
    return F.sequence(F.trunc(first, "month"), last, F.expr("interval 1 month"))


def command_date(c: Column) -> Column:
    """A date given on the command line: yyyy-mm-dd, dd.mm.yyyy or dd/mm/yyyy."""
    return F.coalesce(F.try_to_timestamp(c, F.lit("yyyy-MM-dd")), F.try_to_timestamp(c, F.lit("dd.MM.yyyy")), F.try_to_timestamp(c, F.lit("dd/MM/yyyy"))).cast("date")


def dates_from(dates: Column, start: Column) -> Column:
    """Those of an array of dates that aren't before ``start``, sorted; all where it is null."""
    return F.array_sort(F.filter(dates, lambda d: start.isNull() | (d >= start)))


def default_start(last_known: Column, days: int = 14) -> Column:
    return F.date_sub(last_known, days)
