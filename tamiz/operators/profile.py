"""Whole-table profiles and reports, each from one aggregation per table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.functions import percent_of, strip_spaces
from tamiz.operators.columns import columns_of_type


def _measures(df: DataFrame, columns: list[str], measures: dict) -> DataFrame:
    """A row per column: its position, type, the row count and some measures."""
    cells = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(columns):
        cells += [make(c).alias(f"{i}__{name}") for name, make in measures.items()]
    types = dict(df.dtypes)
    rows = [
        F.struct(
            F.lit(c).alias("column"), F.lit(types[c]).alias("type"), F.col("__rows").alias("rows"),
            *[F.col(f"{i}__{name}").alias(name) for name in measures],
        )
        for i, c in enumerate(columns)
    ]
    return df.agg(*cells).select(F.inline(F.array(*rows)))


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls and their share per column, most nulls first."""
    counted = _measures(df, df.columns, {"nulls": lambda c: F.count_if(F.col(c).isNull())})
    return counted.select(
        "column", "nulls", percent_of(F.col("nulls"), F.col("rows")).alias("pct")
    ).orderBy(F.desc("nulls"), "column")


def cardinality_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct non-null values, type and share of rows per column."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    counted = _measures(df, df.columns, {"distinct": lambda c: count(F.col(c))})
    return counted.select(
        "column", "type", "distinct", percent_of(F.col("distinct"), F.col("rows")).alias("pct")
    ).orderBy(F.desc("distinct"), "column")


def count_distinct(df: DataFrame, *columns: str, approximate: bool = False) -> DataFrame:
    """Distinct non-null values of each column, in one row."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(F.col(c)).alias(c) for c in columns])


def low_variability_columns(df: DataFrame, limit: float = 0.01) -> DataFrame:
    """Columns with more than one value but few values for their rows."""
    profile = cardinality_profile(df)
    return profile.filter((F.col("distinct") > 1) & (F.col("pct") < limit * 100.0))


def blank_profile(df: DataFrame) -> DataFrame:
    """Cells that hold white space only, per text column."""
    counted = _measures(
        df, columns_of_type(df, "text"),
        {"blanks": lambda c: F.count_if(strip_spaces(F.col(c)) == "")},
    )
    return counted.select(
        "column", "blanks", percent_of(F.col("blanks"), F.col("rows")).alias("pct")
    )


def cleaning_report(original: DataFrame, cleaned: DataFrame, dataset: str) -> DataFrame:
    """Rows before and after cleaning, in one row."""
    counts = original.agg(F.count(F.lit(1)).alias("registros_originales")).withColumn(
        "registros_finales", cleaned.agg(F.count(F.lit(1)).alias("n")).scalar()
    )
    before, after = F.col("registros_originales"), F.col("registros_finales")
    return counts.select(
        F.lit(dataset).alias("dataset"), before, after,
        (before - after).alias("registros_eliminados"),
        percent_of(after, before).alias("porcentaje_retenido"),
        F.lit(len(cleaned.columns)).alias("columnas"),
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each named table."""
    out = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows")
        out = row if out is None else out.unionByName(row)
    if out is None:
        raise ValueError("no tables given")
    return out


def dataset_summary(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, number of columns and column list of each dataset."""
    counts = table_counts(datasets)
    width, names = F.lit(None).cast("int"), F.lit(None).cast("string")
    for name, df in datasets.items():
        here = F.col("name") == name
        width = F.when(here, F.lit(len(df.columns))).otherwise(width)
        names = F.when(here, F.lit(", ".join(df.columns))).otherwise(names)
    return counts.select("name", "rows", width.alias("n_columns"), names.alias("columns"))


def warehouse_summary(
    dimensions: Mapping[str, DataFrame], facts: Mapping[str, DataFrame]
) -> DataFrame:
    """Rows per table, plus the totals of dimensions and of facts."""
    parts = []
    for kind, tables in (("dimension", dimensions), ("fact", facts)):
        if tables:
            rows = table_counts(tables).withColumn("kind", F.lit(kind))
            total = rows.agg(F.sum("rows").alias("rows")).select(
                F.lit("TOTAL").alias("name"), "rows", F.lit(kind).alias("kind")
            )
            parts += [rows, total]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("kind", "name", "rows")
