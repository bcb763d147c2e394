"""Frequencies, top values, records per entity, cross tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions import percent_of


def row_total(df: DataFrame):
    """The number of rows as a scalar subquery."""
    return df.agg(F.count(F.lit(1)).alias("total")).scalar()


def value_counts(
    df: DataFrame, column: str, sort: str = "freq", k: int | None = None
) -> DataFrame:
    """Frequency of each non-null value, with its share of all rows.

    ``sort="freq"`` puts the most frequent first (ties by value);
    ``sort="value"`` orders by value.
    """
    counts = (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("pct", percent_of(F.col("n"), row_total(df)))
    )
    order = [F.asc("value")] if sort == "value" else [F.desc("n"), F.asc("value")]
    counts = counts.orderBy(*order)
    return counts if k is None else counts.limit(k)


def top_k_values(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    return value_counts(df, column, k=k)


def entity_counts(df: DataFrame, key: str) -> DataFrame:
    """Records of each non-null key."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("records"))


def top_k_entities(df: DataFrame, key: str, k: int = 5) -> DataFrame:
    """Keys with most records (ties by key)."""
    return entity_counts(df, key).orderBy(F.desc("records"), key).limit(k)


def count_of_counts(df: DataFrame, key: str) -> DataFrame:
    """How many entities have 1, 2, 3 ... records, with their share."""
    per_entity = entity_counts(df, key)
    sizes = per_entity.groupBy("records").agg(F.count(F.lit(1)).alias("entities"))
    total = per_entity.agg(F.count(F.lit(1)).alias("total")).scalar()
    return sizes.withColumn("pct", percent_of(F.col("entities"), total)).orderBy("records")


def records_per_entity(df: DataFrame, key: str) -> DataFrame:
    """Entities, and the least, most, mean and median number of their records.

    The median works on the histogram of record counts: n records in all give
    fewer than sqrt(2n) different counts.
    """
    sizes = entity_counts(df, key).groupBy("records").agg(F.count(F.lit(1)).alias("entities"))
    return sizes.agg(
        F.coalesce(F.sum("entities"), F.lit(0)).alias("entities"),
        F.min("records").alias("min_records"),
        F.max("records").alias("max_records"),
        (F.sum(F.col("records") * F.col("entities")) / F.sum("entities")).alias("mean_records"),
        F.percentile("records", F.lit(0.5), F.col("entities")).alias("median_records"),
    )


def _pair_counts(df: DataFrame, row: str, column: str) -> DataFrame:
    return (
        df.filter(F.col(row).isNotNull() & F.col(column).isNotNull())
        .groupBy(F.col(row).cast("string").alias("__r"), F.col(column).cast("string").alias("__c"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def crosstab(df: DataFrame, row: str, column: str) -> DataFrame:
    """Two-way counts ``row, column, n`` of the pairs that occur, with totals named ``All``.

    In long form there may be any number of values on either side.
    """
    def label(name: str) -> Column:
        return F.when(F.grouping(name) == 1, F.lit("All")).otherwise(F.col(name))

    cells = _pair_counts(df, row, column).cube("__r", "__c").agg(
        label("__r").alias("__row"), label("__c").alias("__column"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")
    )
    return cells.select(F.col("__row").alias(row), F.col("__column").alias(column), "n")


def crosstab_wide(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Two-way counts with a column for each of the given values, and totals named ``All``.

    The totals count all values, listed or not.
    """
    cells = [
        F.coalesce(F.sum(F.when(F.col("__c") == v, F.col("n"))), F.lit(0)).alias(v) for v in values
    ]
    label = F.when(F.grouping("__r") == 1, F.lit("All")).otherwise(F.col("__r"))
    return (
        _pair_counts(df, row, column).rollup("__r")
        .agg(F.grouping("__r").alias("__last"), label.alias("__label"), *cells,
             F.coalesce(F.sum("n"), F.lit(0)).alias("All"))
        .orderBy("__last", "__label")
        .select(F.col("__label").alias(row), *[F.col(f"`{v}`") for v in values], "All")
    )
