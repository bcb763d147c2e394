"""Data-quality checks. Each returns a report, and raises only where its name says assert."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions import percent_of
from tamiz.operators.dedupe import primary_key_report
from tamiz.operators.orphans import orphan_stats
from tamiz.operators.profile import table_counts
from tamiz.session import materialize


def _stack(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def assert_unique_not_null(df: DataFrame, *keys: str) -> DataFrame:
    """The frame, stored once; an error if one of the keys repeats or is null."""
    df = materialize(df, "asserted")
    report = check_unique_not_null({"": df}, {"": keys})
    bad = report.filter(~F.col("ok")).collect()
    if bad:
        problems = [f"{r['column']}: {r['duplicates']} repeated, {r['nulls']} null" for r in bad]
        raise ValueError("; ".join(problems))
    return df


def check_unique_not_null(
    tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]
) -> DataFrame:
    """table, column, repeated rows, nulls, ok: for each single-column key."""
    parts = []
    for table, columns in keys.items():
        for column in columns:
            report = primary_key_report(tables[table], column)
            parts.append(report.select(
                F.lit(table).alias("table"), F.lit(column).alias("column"), "rows", "duplicates",
                F.col("null_keys").alias("nulls"),
                ((F.col("duplicates") == 0) & (F.col("null_keys") == 0)).alias("ok"),
            ))
    return _stack(parts)


def surrogate_key_of(df: DataFrame) -> str:
    """The first column that ends in ``_sk``."""
    for column in df.columns:
        if column.endswith("_sk"):
            return column
    raise ValueError("the dimension has no _sk column")


def check_surrogate_keys(dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Every dimension's surrogate key is there, unique and never null."""
    keys = {name: [surrogate_key_of(df)] for name, df in dimensions.items()}
    return check_unique_not_null(dimensions, keys)


def check_foreign_key_nulls(facts: Mapping[str, DataFrame], limit_pct: float = 10.0) -> DataFrame:
    """Share of nulls in each ``_sk`` column, and whether it is below the limit."""
    parts = []
    for name, df in facts.items():
        columns = [c for c in df.columns if c.endswith("_sk")]
        counted = df.agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
        )
        cells = [
            F.struct(F.lit(name).alias("table"), F.lit(c).alias("column"),
                     F.col("rows").alias("rows"), F.col(c).alias("nulls"))
            for c in columns
        ]
        parts.append(counted.select(F.inline(F.array(*cells))))
    share = percent_of(F.col("nulls"), F.col("rows"))
    return _stack(parts).select("*", share.alias("pct"), (share < limit_pct).alias("ok"))


def check_referential_integrity(
    facts: Mapping[str, DataFrame],
    dimensions: Mapping[str, DataFrame],
    references: Sequence[tuple[str, str, str, str]],
) -> DataFrame:
    """Distinct fact keys that the dimension lacks.

    ``references`` holds (fact, fact column, dimension, dimension column).
    """
    parts = []
    for fact, column, dim, key in references:
        stats = orphan_stats(facts[fact], dimensions[dim], column, key)
        parts.append(stats.select(
            F.lit(fact).alias("fact"), F.lit(column).alias("column"), F.lit(dim).alias("dimension"),
            F.col("total").alias("distinct_keys"), "orphans", (F.col("orphans") == 0).alias("ok"),
        ))
    return _stack(parts)


def _column_report(df: DataFrame, table: str, checks: Mapping[str, Column], measure: str) -> DataFrame:
    counted = df.agg(*[check.alias(c) for c, check in checks.items()])
    cells = [
        F.struct(F.lit(table).alias("table"), F.lit(c).alias("column"), F.col(c).alias(measure))
        for c in checks
    ]
    return counted.select(F.inline(F.array(*cells)))


def check_not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    report = _column_report(df, table, {c: F.count_if(F.col(c).isNull()) for c in columns}, "nulls")
    return report.withColumn("ok", F.col("nulls") == 0)


def check_unique(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Repeated rows per column; nulls do not count as repeats of each other."""
    parts = []
    for c in columns:
        report = primary_key_report(df.filter(F.col(c).isNotNull()), c)
        parts.append(report.select(
            F.lit(table).alias("table"), F.lit(c).alias("column"), "duplicates",
            (F.col("duplicates") == 0).alias("ok"),
        ))
    return _stack(parts)


def check_max_length(df: DataFrame, table: str, limits: Mapping[str, int]) -> DataFrame:
    """Longest text and number of texts over the limit, per column."""
    checks = {
        c: F.struct(
            F.coalesce(F.max(F.length(c)), F.lit(0)).alias("longest"),
            F.count_if(F.length(c) > n).alias("too_long"), F.lit(n).alias("limit"),
        )
        for c, n in limits.items()
    }
    report = _column_report(df, table, checks, "m")
    return report.select("table", "column", "m.limit", "m.longest", "m.too_long",
                         (F.col("m.too_long") == 0).alias("ok"))


def apply_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill nulls by column, adding the columns that are absent."""
    return df.withColumns({
        c: F.coalesce(F.col(c), F.lit(v)) if c in df.columns else F.lit(v)
        for c, v in defaults.items()
    })


def check_non_empty(tables: Mapping[str, DataFrame], expected: Sequence[str] | None = None) -> DataFrame:
    """Rows of each expected table; absent ones count as empty."""
    counts = table_counts(tables).select("name", "rows", F.lit(True).alias("present"))
    spark = next(iter(tables.values())).sparkSession
    absent = [name for name in (expected or []) if name not in tables]
    if absent:
        rows = spark.createDataFrame(
            [(name, 0, False) for name in absent], "name string, rows long, present boolean"
        )
        counts = counts.unionByName(rows)
    return counts.withColumn("ok", F.col("rows") > 0)


def check_expected_total(counts: DataFrame, expected: int, tolerance: int = 100) -> DataFrame:
    """Compare the sum of a ``rows`` column with an expected total."""
    total = counts.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("total"))
    return total.select(
        "total", F.lit(expected).cast("long").alias("expected"),
        (F.col("total") - expected).alias("difference"),
        (F.abs(F.col("total") - expected) <= tolerance).alias("ok"),
    )
