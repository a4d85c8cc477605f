"""Text, name and identifier normalisers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_text(c: Column) -> Column:
    """No-break spaces to spaces, runs collapsed, trimmed; null to ''."""
    return F.trim(F.regexp_replace(F.translate(F.coalesce(c.cast("string"), F.lit("")), " ", " "), r"(?U)\s+", " "))


def normalize_lower(c: Column) -> Column:
    return F.translate(F.lower(normalize_text(c)), "ё", "е")


def normalize_tournament_name(c: Column) -> Column:
    quoted = F.translate(normalize_text(c), "“”«»", '""""')
    return F.trim(F.regexp_replace(F.replace(quoted, F.lit('Турнир "Турнир '), F.lit('Турнир "')), r"\s+", " "))


def contains_any(c: Column, parts: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | c.contains(p)
    return out


def normalize_player_key(c: Column) -> Column:
    return F.trim(F.regexp_replace(normalize_lower(c), "[^а-яa-z0-9]+", " "))


def surname_initials_key(c: Column) -> Column:
    """Surname and the first letters of the next two words."""
    parts = F.split(normalize_player_key(c), " ")
    initials = F.transform(F.slice(parts, 2, 2), lambda x: F.substring(x, 1, 1))
    return F.array_join(F.concat(F.slice(parts, 1, 1), initials), " ")


def normalize_age_group(c: Column) -> Column:
    t = normalize_lower(c)
    for n in ("15", "17", "19"):
        t = F.replace(t, F.lit(f"до{n}"), F.lit(f"до {n}"))
    out = F.when(t.contains("15"), "до 15 лет").when(t.contains("17"), "до 17 лет").when(t.contains("19"), "до 19 лет")
    return out.when(t.contains("взрос"), "взрослые").otherwise(t)


def serving_age_group(c: Column) -> Column:
    """As asked at serving: a label, ``unknown`` for nothing, or the text itself."""
    t = normalize_age_group(c)
    return F.when(t == "", "unknown").when(t.contains("adult"), "взрослые").otherwise(t)


def normalize_player_name(c: Column) -> Column:
    return normalize_lower(c)


def is_cancelled(c: Column) -> Column:
    return contains_any(normalize_lower(c), ("отмен", "cancel"))


def is_completed(c: Column) -> Column:
    return contains_any(normalize_lower(c), ("заверш", "окончен", "complete", "finished"))


def is_player_like(c: Column) -> Column:
    """Letters, at least two words or an initial, and no digits."""
    t = normalize_text(c)
    return t.rlike(r"(?U)^[^\d]*\p{L}{2,}[ .]+\p{L}[^\d]*$")


def player_cell(c: Column) -> Column:
    """A cell that may name a player: three characters or more, a surname with two initials in it or two or three words with a letter."""
    t = normalize_text(c)
    initials = t.rlike(r"[А-ЯA-Z][а-яa-z\-']+\s+[А-ЯA-Z]\.[А-ЯA-Z]\.")
    return (F.length(t) >= 3) & (initials | (F.size(F.split(t, " ")).isin(2, 3) & t.rlike("[А-ЯA-Zа-яa-z]")))


def score_cell(c: Column) -> Column:
    """A cell of one to five set scores, a:b or a-b."""
    return normalize_text(c).rlike(r"^(?:\d+[:-]\d+)(?:\s+\d+[:-]\d+){0,4}$")


def normalize_rni(c: Column) -> Column:
    """The digits of an id written 42749, 42749.0 or RNI:42749; null without any."""
    return F.nullif(F.regexp_extract(F.trim(c.cast("string")), r"(\d+)", 1), F.lit(""))


def safe_rni_id(c: Column) -> Column:
    return F.concat(F.lit("RNI:"), normalize_rni(c))


def safe_id(c: Column, fallback: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(c.cast("string")), F.lit("")), fallback)


def slugify(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(normalize_lower(c), "[^0-9a-zа-я]+", "_"), "^_+|_+$", "")


def sanitize_file_name(c: Column, most: int = 180) -> Column:
    """Illegal characters to underscores; no blanks, dots or underscores at the ends."""
    return F.substring(F.trim(F.regexp_replace(normalize_text(c), r'[\\/:*?"<>|]+', "_"), F.lit(" ._")), 1, most)


def output_base(number: Column, width: int, name: Column) -> Column:
    """A zero-padded number and a safe name."""
    return F.concat(F.lpad(number.cast("string"), width, "0"), F.lit("_"), sanitize_file_name(name))


def longest_digits(c: Column) -> Column:
    """The longest digit run, the first of equals; null without any."""
    runs = F.regexp_extract_all(c, F.lit(r"(\d+)"), 1)
    return F.nullif(F.reduce(runs, F.lit(""), lambda a, x: F.when(F.length(x) > F.length(a), x).otherwise(a)), F.lit(""))


def tour_id(c: Column) -> Column:
    """From a URL, or from a file name that names one."""
    return F.coalesce(F.nullif(F.regexp_extract(c, r"/tours/(\d+)", 1), F.lit("")), F.nullif(F.regexp_extract(c, r"(?i)tours?[_-]?(\d+)", 1), F.lit("")))


def matches_url(c: Column) -> Column:
    """A tournament's page of matches: without query, with the suffix once."""
    plain = F.regexp_replace(without_query(c), "/+$", "")
    return F.when(plain.endswith("/matches"), plain).otherwise(F.concat(plain, F.lit("/matches")))


#: Table headers and the columns they name.
HEADERS = {
    "место": "place", "фио": "fio", "пол игрока": "gender", "рни": "rni", "дата рождения": "birth_date", "город": "city", "всего турниров": "total_tournaments",
    "из них зачетных": "counting_tournaments", "возрастная группа": "age_group_in_table", "очки": "points",
}


def header_column(c: Column) -> Column:
    """The column that a table header names; null for an unknown one."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in HEADERS.items() for x in kv]), normalize_lower(c))


def guess_city(lines: Column) -> Column:
    """The place before a district and country on one line, else the line with a city marker, without it."""
    place = F.transform(lines, lambda x: F.regexp_extract(normalize_text(x), r"(?i)^(.+?),\s*(?:[^,]+,\s*)?Центральный ФО,\s*Россия$", 1))
    marked = F.filter(F.transform(lines, normalize_text), lambda x: contains_any(F.lower(x), ("г.", "город", "место проведения")))
    cleaned = F.trim(F.regexp_replace(F.get(marked, F.lit(0)), r"(?iu)^(г\.|город|место проведения)\s*[:.-]?\s*", ""))
    return F.coalesce(F.get(F.filter(place, lambda x: x != ""), F.lit(0)), F.nullif(cleaned, F.lit("")))


def draw_description(c: Column) -> Column:
    t = normalize_lower(c)
    return t.startswith("основной турнир") | contains_any(t, ("по рейтингу", " поэ:", " ск:"))


def tournament_name(anchor: Column, lines: Column) -> Column:
    """The first of the anchor's text and the lines that can be a name, else the first line."""
    dull = ("подробнее", "заявка", "матчи", "турнир", "dashboard")
    every = F.filter(F.transform(F.concat(F.array(anchor), lines), normalize_text), lambda x: x != "")
    fit = F.filter(every, lambda x: (F.length(x) >= 3) & ~F.lower(x).isin(*dull) & ~draw_description(x) & ~x.rlike(r"^\d{1,2}\.\d{1,2}\.\d{4}.*$"))
    return F.coalesce(F.get(fit, F.lit(0)), F.nullif(normalize_text(F.get(lines, F.lit(0))), F.lit("")), F.nullif(normalize_text(anchor), F.lit("")), F.lit("RTT tournament"))


def absolute_url(c: Column, base: str) -> Column:
    return F.when(c.rlike("^https?://"), c).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), F.regexp_replace(c, "^/+", "")))


def without_query(c: Column) -> Column:
    return F.regexp_replace(c, r"[?#].*$", "")


def strip_html(c: Column) -> Column:
    """Tags, scripts and styles out; common and numeric character references decoded."""
    t = F.regexp_replace(c, r"(?is)<(script|style)\b.*?</\1>", " ")
    t = F.regexp_replace(t, r"<[^>]+>", " ")
    for a, b in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&laquo;", "«"), ("&raquo;", "»"), ("&ndash;", "–"), ("&mdash;", "—")):
        t = F.replace(t, F.lit(a), F.lit(b))
    pieces = F.regexp_extract_all(t, F.lit(r"(&#x?[0-9a-fA-F]+;|[^&]+|&)"), 1)
    code = lambda x: F.when(x.rlike("^&#[xX]"), F.conv(F.regexp_extract(x, "^&#[xX]([0-9a-fA-F]+);$", 1), 16, 10)).otherwise(F.regexp_extract(x, r"^&#(\d+);$", 1)).try_cast("int")
    point = lambda n: F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    t = F.when(t.contains("&#"), F.array_join(F.transform(pieces, lambda x: F.when(x.startswith("&#") & code(x).between(1, 0x10FFFF), point(code(x))).otherwise(x)), "")).otherwise(t)
    t = F.replace(t, F.lit("&amp;"), F.lit("&"))
    return normalize_text(t)


def number(c: Column) -> Column:
    """Digits with spaces between and a decimal comma, as a double; null if none."""
    return F.translate(F.translate(c, "  ", ""), ",", ".").try_cast("double")


def truthy(c: Column) -> Column:
    return F.lower(F.trim(c.cast("string"))).isin("1", "true", "yes", "y", "да")


def is_summary_score(c: Column) -> Column:
    return c.rlike(r"^\d+\s*[-–—:]\s*\d+$")


def is_match_number(c: Column) -> Column:
    return c.rlike(r"^\d{1,4}$")


def value_after_label(lines: Column, label: str) -> Column:
    """The line after the first one that is ``label``; case and a colon at the end don't count."""
    plain = F.transform(lines, lambda x: F.lower(F.trim(F.regexp_replace(x, ":+$", ""))))
    at = F.array_position(plain, label.rstrip(":").strip().lower())
    return F.when(at > 0, F.try_element_at(lines, (at + 1).cast("int")))


def tournament_metadata(lines: Column) -> dict[str, Column]:
    """Name, place, first day's text, age group and category of a tournament's page lines."""
    titled = F.get(F.filter(lines, lambda x: x.startswith("Матчи турнира")), F.lit(0))
    card = F.array_position(lines, "Карточка турнира")
    below = F.get(F.filter(F.slice(lines, F.greatest(card, F.lit(0)).cast("int") + 1, 5), lambda x: x != "---"), F.lit(0))
    name = F.coalesce(F.nullif(normalize_text(F.replace(titled, F.lit("Матчи турнира"), F.lit(""))), F.lit("")), F.when(card > 0, below), F.lit(""))
    place = F.coalesce(value_after_label(lines, "Место проведения"), F.lit(""))
    span = F.get(F.filter(lines, lambda x: x.rlike(r"\d{2}\.\d{2}\.\d{4}\s*-\s*\d{2}\.\d{2}\.\d{4}")), F.lit(0))
    return {
        "tournament_name": normalize_tournament_name(name), "tournament_city": F.trim(F.get(F.split(place, ","), F.lit(0))), "tournament_location_full": place,
        "tournament_age_category": normalize_age_group(F.coalesce(value_after_label(lines, "Возрастная группа"), F.lit(""))),
        "tournament_start_text": F.regexp_extract(span, r"(\d{2}\.\d{2}\.\d{4})\s*-", 1), "tournament_category": F.coalesce(value_after_label(lines, "Категория турнира"), F.lit("")),
    }
