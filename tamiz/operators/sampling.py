"""First, last and sampled rows in a stated order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def head(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order_by).limit(n)


def tail(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """Last ``n`` rows, in ascending order."""
    return df.orderBy(*[F.desc(c) for c in order_by]).limit(n).orderBy(*order_by)


def sample_n(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows chosen by a seeded hash of the key: the same on any layout."""
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}")))
    return df.orderBy(digest, key).limit(n)


def sorted_unique_dates(df: DataFrame, column: str) -> DataFrame:
    days = df.select(F.col(column).cast("date").alias(column)).dropna().distinct()
    return days.orderBy(column)
