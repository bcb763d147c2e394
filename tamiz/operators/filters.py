"""Row filters and value predicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions import percent_of, to_number, valid_or_null


def drop_null_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.dropna(subset=list(keys))


def drop_all_null_rows(df: DataFrame) -> DataFrame:
    return df.dropna(how="all")


def all_null_row_report(df: DataFrame) -> DataFrame:
    """Rows in total and rows that are null in every column."""
    filled = F.coalesce(*[F.col(c).cast("string") for c in df.columns])
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(filled.isNull()).alias("all_null_rows")
    )


def drop_any_null(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(how="any", subset=list(subset) if subset else None)


def filter_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows with low <= value <= high; nulls go."""
    return df.filter(F.col(column).between(low, high))


def filter_valid_values(df: DataFrame, column: str, valid: Sequence[object]) -> DataFrame:
    """Null the values outside the list; no row goes."""
    return df.withColumn(column, valid_or_null(F.col(column), valid))


def filter_positive_duration(
    df: DataFrame, days: str, months: str | None = None, max_months: float | None = None
) -> DataFrame:
    """Spans longer than zero days, optionally up to ``max_months``."""
    out = df.filter(F.col(days) > 0)
    if max_months is not None:
        out = out.filter(F.col(months) <= max_months)
    return out


def filter_plausible_experience(
    df: DataFrame, column: str, low: float = 0, high: float = 50
) -> DataFrame:
    """Rows whose value is a number between the limits, now as a double."""
    return df.withColumn(column, to_number(F.col(column))).filter(
        F.col(column).between(low, high)
    )


def experience_conversion_report(
    df: DataFrame, column: str, low: float = 0, high: float = 50
) -> DataFrame:
    """Counts of rows, of values that are no number, and of plausible values."""
    value = to_number(F.col(column))
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(value.isNull()).alias("unconvertible"),
        F.count_if(value.between(low, high)).alias("plausible"),
    )


def count_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that satisfy a condition, and their share in percent."""
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(condition).alias("matching")
    )
    return counted.withColumn("pct", percent_of(F.col("matching"), F.col("rows")))


def clean_numeric(
    df: DataFrame,
    column: str,
    valid_range: tuple[float, float] | None = None,
    drop_invalid: bool = True,
) -> DataFrame:
    """Turn a column into doubles and optionally keep a closed range only."""
    out = df.withColumn(column, to_number(F.col(column)))
    if valid_range and drop_invalid:
        out = filter_range(out, column, *valid_range)
    return out


def numeric_cleaning_report(
    df: DataFrame, column: str, valid_range: tuple[float, float] | None = None
) -> DataFrame:
    """What ``clean_numeric`` would do: nulls and out-of-range rows apart."""
    value = to_number(F.col(column))
    outside = ~value.between(*valid_range) if valid_range else F.lit(False)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(value.isNull()).alias("nulls"),
        F.count_if(outside).alias("out_of_range"),
    )
