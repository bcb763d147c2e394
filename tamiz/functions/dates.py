"""Date parsing and calendar attributes as native column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamiz.functions.numeric import round_half_even
from tamiz.functions.text import strip_spaces

__all__ = [
    "DATE_FORMATS", "DAY_FIRST", "DAY_NAMES", "MONTH_NAMES", "calendar_attributes", "duration_days",
    "duration_months", "duration_years", "is_weekend", "localized_day", "localized_month",
    "mixed_formats", "parse_dates", "parse_mixed_dates", "truncate_day",
]

# How cleaners and reports read a date that fits day first and month first alike.
DAY_FIRST = True

# Accepted spellings, tried in this order. Day-first is a choice: pass another
# list for month-first data.
DATE_FORMATS = (
    "yyyy-MM-dd",
    "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
    "dd/MM/yyyy",
    "dd/MM/yyyy HH:mm:ss",
    "yyyyMMdd",
)

# Spanish month and day names, January and Monday first.
MONTH_NAMES = (
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio",
    "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
)
DAY_NAMES = ("Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo")


# Pattern letters: the digits they stand for, and their place in an ISO date.
_FIELDS = {
    "yyyy": (r"\d{4}", "y"), "yy": (r"\d{2}", "y"), "MM": (r"\d{2}", "M"), "M": (r"\d{1,2}", "M"),
    "dd": (r"\d{2}", "d"), "d": (r"\d{1,2}", "d"), "HH": (r"\d{2}", "H"),
    "mm": (r"\d{2}", "m"), "ss": (r"\d{2}", "s"),
}


def _numeric_shape(pattern: str) -> tuple[str, str] | None:
    """Regex of an all-digits pattern and the replacement that makes it ISO.

    None for patterns with names, zones or optional parts other than a fraction.
    """
    fraction = pattern.endswith("[.SSSSSS]")
    body = pattern.removesuffix("[.SSSSSS]").replace("'T'", "T")
    regex, groups = "", {}
    for piece in re.findall(r"y+|M+|d+|H+|m+|s+|.", body):
        if piece in _FIELDS:
            digits, place = _FIELDS[piece]
            if place in groups:
                return None
            # Two digits mean a year of this century.
            groups[place] = f"{'20' if piece == 'yy' else ''}${len(groups) + 1}"
            regex += f"({digits})"
        elif piece.isalpha() and piece != "T" or piece in "[]'":
            return None
        else:
            regex += re.escape(piece)
    if not {"y", "M", "d"} <= groups.keys():
        return None
    iso = f"{groups['y']}-{groups['M']}-{groups['d']}"
    if {"H", "m", "s"} <= groups.keys():
        iso += f" {groups['H']}:{groups['m']}:{groups['s']}"
        if fraction:
            iso += f"${len(groups) + 1}"
            regex += r"(?:(\.\d{1,6})\d{0,3})?"
    elif {"H", "m"} == groups.keys() - {"y", "M", "d"} and not fraction:
        iso += f" {groups['H']}:{groups['m']}:00"
    elif fraction or len(groups) > 3:
        return None
    return f"^{regex}$", iso


def parse_dates(col: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Timestamp without zone from the first format that fits, else null.

    A text is compared with the shapes of the all-digits formats, turned into
    ISO and cast once: no parser exception is raised and caught for every other
    spelling. Formats with names or zones go through Spark's own parser.
    """
    text = strip_spaces(col)
    tries: list[Column] = []
    shapes: dict[str, str] = {}

    def close() -> None:
        if shapes:
            iso_text = F.lit(None).cast("string")
            # Shapes in a row that are ISO as they stand are one comparison; others need their own groups.
            tried: list[tuple[str, str]] = []
            for regex, iso in shapes.items():
                if tried and not iso and not tried[-1][1]:
                    tried[-1] = (f"{tried[-1][0]}|{regex}", "")
                else:
                    tried.append((regex, iso))
            for regex, iso in reversed(tried):
                rewritten = F.regexp_replace(text, regex, iso) if iso else text
                iso_text = F.when(text.rlike(regex), rewritten).otherwise(iso_text)
            tries.append(iso_text.try_cast("timestamp_ntz"))
            shapes.clear()

    for pattern in formats:
        shape = _numeric_shape(pattern)
        if shape is None or shape[0] in shapes:
            close()
        if shape is None:
            tries.append(_parse_named(text, pattern))
        else:
            # Year first and dashes: the text is ISO as it stands.
            is_iso = pattern.startswith("yyyy-MM-dd") and not pattern.endswith("HH:mm")
            shapes[shape[0]] = "" if is_iso else shape[1]
    close()
    return F.coalesce(*tries)


def _parse_named(text: Column, pattern: str) -> Column:
    """Spark's own parser for a pattern with names or a zone; texts without any of these do not reach it.

    A time with a zone is given as the clock in UTC shows it, whatever the session's zone.
    """
    clock = F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")
    if "X" in pattern:
        clock = F.convert_timezone(F.current_timezone(), F.lit("UTC"), clock)
    return F.when(text.rlike(r"[A-Za-z+]|:\d\d-\d\d"), clock)


def mixed_formats(day_first: bool = False) -> list[str]:
    """A longer list of spellings; day and month may swap where only one order is a date."""
    orders = ["d{0}M{0}yyyy", "M{0}d{0}yyyy"]
    if not day_first:
        orders.reverse()
    times = ["", " HH:mm:ss[.SSSSSS]", " HH:mm"]
    year_first = [f"yyyy{sep}MM{sep}dd{time}" for sep in "-/." for time in times]
    single_digits = [f"yyyy{sep}M{sep}d{time}" for sep in "-/." for time in times]
    year_last = [order.format(sep) + time for order in orders for sep in "/-." for time in times]
    short_years = [order.format("/").replace("yyyy", "yy") for order in orders]
    named = ["d-MMM-yyyy", "d MMM yyyy", "MMM d, yyyy", "MMMM d, yyyy", "d MMMM yyyy", "d-MMM-yyyy HH:mm"]
    named += [f"{date} HH:mm[:ss]" for date in ("MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy")]
    halves = [f"{date} h:mm{seconds} a" for date in ("yyyy-MM-dd", "yyyy/MM/dd", *(o.format("/") for o in orders))
              for seconds in ("", ":ss")]
    zones = ["yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS][.SSSSSS][.SSS]XXX", "yyyy-MM-dd HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ssXX"]
    return [
        *year_first, "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]", "yyyyMMdd", "yyyyMMddHHmmss", *year_last, *single_digits, *short_years,
        *named, *halves, *zones,
    ]


def parse_mixed_dates(col: Column, day_first: bool = False) -> Column:
    """Each value in whatever known spelling it has; month first if both orders fit."""
    return parse_dates(col, mixed_formats(day_first))


def truncate_day(col: Column) -> Column:
    return col.cast("date")


def _name(position: Column, names: Sequence[str]) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), position)


def localized_month(date: Column) -> Column:
    return _name(F.month(date), MONTH_NAMES)


def _iso_weekday(date: Column) -> Column:
    return F.weekday(date) + 1


def localized_day(date: Column) -> Column:
    return _name(_iso_weekday(date), DAY_NAMES)


def is_weekend(date: Column) -> Column:
    return F.weekday(date) >= 5


def calendar_attributes(date: Column) -> dict[str, Column]:
    """The calendar columns of a date dimension, by name."""
    quarter = F.quarter(date)
    return {
        "anio": F.year(date),
        "mes": F.month(date),
        "dia": F.dayofmonth(date),
        "trimestre": quarter,
        "semestre": F.when(quarter <= 2, 1).otherwise(2),
        "dia_semana": _iso_weekday(date),
        "nombre_mes": localized_month(date),
        "nombre_dia": localized_day(date),
        "es_fin_semana": is_weekend(date),
    }


def duration_days(start: Column, end: Column) -> Column:
    """Whole days from start to end, rounded down, without any time zone.

    Each date is named once: a parsed date that a filter copies stays one parse.
    """
    span = end.cast("timestamp_ntz") - start.cast("timestamp_ntz")
    seconds = span.cast("interval second").cast("decimal(24,6)")
    return F.floor(seconds / 86_400).cast("int")


def duration_months(days: Column) -> Column:
    return round_half_even(days / 30.44, 1)


def duration_years(days: Column) -> Column:
    return round_half_even(days / 365.25, 2)
