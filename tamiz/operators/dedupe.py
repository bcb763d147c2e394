"""Distinct rows, first row per key, key validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.functions import short_key

_RANK = "__rank"


def _as_columns(order_by: str | Column | Sequence[str | Column]) -> list[Column]:
    items = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
    return [F.col(c) if isinstance(c, str) else c for c in items]


def dedupe_keep_first(
    df: DataFrame, keys: Sequence[str], order_by: str | Column | Sequence[str | Column]
) -> DataFrame:
    """One row per key, the first in ``order_by``; null keys form one group.

    The rank-equals-one filter lets Spark keep one row per key inside each map
    task, so a hot key sends one row per task through the shuffle.
    """
    window = Window.partitionBy(*keys).orderBy(*_as_columns(order_by))
    return (
        df.withColumn(_RANK, F.row_number().over(window))
        .filter(F.col(_RANK) == 1)
        .drop(_RANK)
    )


def first_per_key(
    df: DataFrame,
    keys: Sequence[str],
    priority: Column,
    order_by: str | Column | Sequence[str | Column],
) -> DataFrame:
    """As ``dedupe_keep_first``, with sources ranked by ``priority`` first."""
    return dedupe_keep_first(df, keys, [priority, *_as_columns(order_by)])


def drop_exact_duplicates(df: DataFrame, order_column: str | None = None) -> DataFrame:
    """Distinct rows; an order column is not compared, and its minimum is kept."""
    if order_column is None or order_column not in df.columns:
        return df.distinct()
    compared = [c for c in df.columns if c != order_column]
    return df.groupBy(*compared).agg(F.min(order_column).alias(order_column)).select(*df.columns)


def distinct_values(df: DataFrame, *columns: str, keep_null: bool = True) -> DataFrame:
    """Distinct values of the columns, with or without null ones."""
    values = df.select(*columns)
    if not keep_null:
        values = values.dropna()
    return values.distinct()


def first_non_null(df: DataFrame, key: str, attribute: str, order_by: str | Column) -> DataFrame:
    """First non-null attribute per non-null key."""
    known = df.filter(F.col(key).isNotNull() & F.col(attribute).isNotNull())
    order = _as_columns(order_by)[0]
    return known.groupBy(key).agg(F.min_by(attribute, order).alias(attribute))


def validate_primary_key(
    df: DataFrame,
    key: str,
    order_by: str | Column | Sequence[str | Column],
    drop_duplicates: bool = True,
    drop_nulls: bool = True,
) -> DataFrame:
    """First row per key, then no null keys.

    With both steps on, the nulls go before the shuffle: the result is the same.
    """
    out = df
    if drop_nulls:
        out = out.dropna(subset=[key])
    if drop_duplicates:
        out = dedupe_keep_first(out, [key], order_by)
    return out


def primary_key_report(df: DataFrame, *keys: str) -> DataFrame:
    """Rows, null keys and repeated rows of one key (nulls equal each other)."""
    any_null = F.lit(False)
    for key in keys:
        any_null = any_null | F.col(key).isNull()
    # Only counts are asked for, so long texts are grouped by what stands for them.
    texts = [key for key in keys if isinstance(df.schema[key].dataType, T.StringType)]
    df = df.select(*(short_key(F.col(k)).alias(k) if k in texts else F.col(k) for k in keys))
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(any_null, F.col("n"))), F.lit(0)).alias("null_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
    )


def duplicate_profile(df: DataFrame, *keys: str) -> DataFrame:
    """Count and share of repeated rows, over all columns or over the keys."""
    report = primary_key_report(df, *(keys or df.columns))
    share = F.when(F.col("rows") > 0, F.col("duplicates") / F.col("rows") * 100.0)
    return report.select("rows", "duplicates", F.coalesce(share, F.lit(0.0)).alias("pct"))


def duplicate_examples(df: DataFrame, key: str, k: int = 10) -> DataFrame:
    """The most repeated keys."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .orderBy(F.desc("n"), key)
        .limit(k)
    )
