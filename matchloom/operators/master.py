"""The master table of tournaments: rows of older lists, and merging what is new."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_date
from ..functions.text import tour_id
from .keyed import first_available, first_by_key

#: The table's columns, the headers of older lists, and what is the same for all their rows.
COLUMNS = {
    "tour_id": "string", "tournament_name": "string", "age_category": "string", "gender": "string", "draw_type": "string", "federal_district": "string", "city": "string", "start_date": "date", "status": "string",
    "category": "string", "system": "string", "matches_url": "string", "calendar_url": "string", "matches_page_saved": "boolean", "source": "string", "source_file": "string", "created_at": "timestamp", "updated_at": "timestamp",
}
LEGACY = {
    "tournament_name": ("Турнир", "tournament_name", "name", "title"), "age_category": ("Возрастная категория", "age_category"), "start_date": ("Дата начала", "start_date", "date", "date_start"),
    "city": ("Город", "city", "tournament_city"), "matches_url": ("Ссылка на страницу с матчами", "matches_url", "url"),
}
LEGACY_CONSTANTS = {"gender": "Женский", "draw_type": "Одиночный", "federal_district": "Центральный ФО", "status": "unknown", "category": "Все", "system": "Все", "source": "legacy_excel"}


def _first_of_id(df: DataFrame, key: Column, order: Sequence[Column | str] | None) -> DataFrame:
    """The first row of each id that isn't null, in ``order`` or that of the files."""
    placed = df.withColumns({"_id": key, "_seen": F.monotonically_increasing_id()}).where("_id is not null")
    return first_by_key(placed, ["_id"], order or ["_seen"])


def legacy_master(old: DataFrame, source_file: str, now: Column, order: Sequence[Column | str] | None = None) -> DataFrame:
    """Master rows of an older list: columns by any of their names, the id from the list or its link; rows without one go, the first of an id
    in ``order`` (by default that of the files) stays."""
    found = {n: first_available(old, list(c)) for n, c in LEGACY.items()}
    ids = F.coalesce(first_available(old, ["tour_id", "id", "tournament_id"]), tour_id(found["matches_url"]))
    return _first_of_id(old, ids, order).select(
        F.col("_id").alias("tour_id"), *[(parse_date(c) if n == "start_date" else c).alias(n) for n, c in found.items()], *[F.lit(v).alias(n) for n, v in LEGACY_CONSTANTS.items()], F.lit(None).cast("string").alias("calendar_url"),
        F.lit(False).alias("matches_page_saved"), F.lit(source_file).alias("source_file"), now.cast("timestamp").alias("created_at"), now.cast("timestamp").alias("updated_at"),
    ).select(*COLUMNS)


def _whole(df: DataFrame, order: Sequence[Column | str] | None) -> DataFrame:
    """All master columns, null where there are none; the first row of each id, written without a decimal point."""
    first = _first_of_id(df, F.regexp_replace(F.col("tour_id").cast("string"), r"^(\d+)\.0$", "$1"), order)
    return first.select(F.col("_id").alias("tour_id"), *[(F.col(c).cast(t) if c in df.columns else F.lit(None).cast(t)).alias(c) for c, t in COLUMNS.items() if c != "tour_id"])


def merge_master(existing: DataFrame | None, incoming: DataFrame, now: Column, existing_order: Sequence[Column | str] | None = None, incoming_order: Sequence[Column | str] | None = None) -> DataFrame:
    """Incoming rows merged into the master table: new ids as they come; in known ones values that aren't null win, ``created_at`` stays (``now``
    where it was missing) and ``updated_at`` is ``now``; ids that don't come stay as they are."""
    new = _whole(incoming, incoming_order)
    if existing is None:
        return new
    e, i = (df.select(*[F.col(c).alias(f"{side}_{c}") for c in COLUMNS]) for side, df in (("e", _whole(existing, existing_order)), ("i", new)))
    both = e.join(i, F.col("e_tour_id") == F.col("i_tour_id"), "full")
    known, came = F.col("e_tour_id").isNotNull(), F.col("i_tour_id").isNotNull()

    def merged(c: str) -> Column:
        if c == "created_at":
            return F.when(known & came, F.coalesce("e_created_at", now.cast("timestamp"))).otherwise(F.coalesce("e_created_at", "i_created_at"))
        if c == "updated_at":
            return F.when(known & came, now.cast("timestamp")).otherwise(F.coalesce("e_updated_at", "i_updated_at"))
        return F.coalesce(f"i_{c}", f"e_{c}")

    return both.select(*[merged(c).alias(c) for c in COLUMNS])
