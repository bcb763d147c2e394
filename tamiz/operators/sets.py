"""Stacking sources and set differences."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.operators.joins import orphan_keys


def union_sources(
    sources: Mapping[str, DataFrame], columns: Sequence[str], tag: str = "fuente"
) -> DataFrame:
    """Stack the columns of several sources with the source's name and rank."""
    out = None
    for rank, (name, df) in enumerate(sources.items()):
        part = df.select(*columns).withColumns({tag: F.lit(name), f"{tag}_rank": F.lit(rank)})
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no sources given")
    return out


def union_all_dates(sources: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Every non-null day in the given date columns of the given tables."""
    out = None
    for df, columns in sources:
        present = [F.col(c).cast("date") for c in columns if c in df.columns]
        if not present:
            continue
        days = df.select(F.explode(F.array(*present)).alias("fecha")).filter("fecha is not null")
        out = days if out is None else out.unionByName(days)
    if out is None:
        raise ValueError("no date columns given")
    return out


def append_placeholders(parent: DataFrame, placeholders: DataFrame) -> DataFrame:
    """Parent rows and placeholder rows; columns a side lacks are null."""
    return parent.unionByName(placeholders, allowMissingColumns=True)


def key_difference(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None) -> DataFrame:
    return orphan_keys(left, right, key, right_key)
