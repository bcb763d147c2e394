"""Numeric cleaning and binning as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamiz.functions.text import strip_spaces

__all__ = [
    "bin_duration", "bin_duration_order", "categorize_experience", "fill_default",
    "percent_of", "round_half_even", "safe_ratio", "to_number",
    "DURATION_BINS", "EXPERIENCE_CLASSES",
]

# Upper bounds in months (lower bound open, upper closed) and labels.
DURATION_BINS = (
    (3.0, "0-3 meses"), (6.0, "3-6 meses"), (12.0, "6-12 meses"), (24.0, "1-2 años"),
    (36.0, "2-3 años"), (60.0, "3-5 años"), (120.0, "5-10 años"), (float("inf"), ">10 años"),
)

# Classes of required experience, from none to unreadable.
EXPERIENCE_CLASSES = (
    "0. Sin experiencia", "1. Hasta 1 año", "2. 1-2 años", "3. 2-5 años",
    "4. Más de 5 años", "5. Datos inválidos",
)

_NUMBER = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf(inity)?))$"


def to_number(col: Column) -> Column:
    """Double, or null for text that is not a plain decimal number."""
    text = strip_spaces(col.cast("string"))
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def round_half_even(col: Column, digits: int) -> Column:
    """Scale, round half to even, scale back."""
    scale = float(10**digits)
    return F.rint(col * scale) / scale


def percent_of(part: Column, total: Column) -> Column:
    """part / total * 100, and 0 for an empty total."""
    return F.when(total > 0, part / total * 100.0).otherwise(F.lit(0.0))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio in which a zero denominator counts as one."""
    return numerator / F.when(denominator == 0, F.lit(1.0)).otherwise(denominator)


def fill_default(col: Column, default: object) -> Column:
    return F.coalesce(col, F.lit(default))


def _duration_case(months: Column, results: list[Column]) -> Column:
    # The first branch keeps zero and negative spans out of every bin.
    case = F.when(months <= 0, None)
    for (upper, _), result in zip(DURATION_BINS, results):
        case = case.when(months <= upper, result)
    return case


def bin_duration(months: Column) -> Column:
    """Label of the span's bin; null for spans of zero or less."""
    return _duration_case(months, [F.lit(label) for _, label in DURATION_BINS])


def bin_duration_order(months: Column) -> Column:
    """Position of the span's bin, for sorting by length."""
    return _duration_case(months, [F.lit(i + 1) for i in range(len(DURATION_BINS))])


def categorize_experience(no_experience: Column, amount: Column, unit: Column) -> Column:
    """Class of required experience from a flag, an amount and a time unit."""
    none, upto1, upto2, upto5, above, invalid = (F.lit(c) for c in EXPERIENCE_CLASSES)
    time = to_number(amount)
    kind = F.coalesce(F.upper(unit.cast("string")), F.lit("NAN"))

    def by_limits(one: int, two: int, five: int) -> Column:
        return (
            F.when(time <= one, upto1).when(time <= two, upto2)
            .when(time <= five, upto5).otherwise(above)
        )

    years = kind.contains("AÑO") | kind.contains("YEAR")
    months = kind.contains("MES") | kind.contains("MONTH")
    return (
        F.when(no_experience == "SI", none)
        .when(time.isNull(), invalid)
        .when(years, by_limits(1, 2, 5))
        .when(months, by_limits(12, 24, 60))
        .otherwise(upto1)
    )
