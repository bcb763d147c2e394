"""Choosing and naming columns from the schema alone."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def columns_matching(df: DataFrame, *tokens: str, match_all: bool = False) -> list[str]:
    """Columns whose upper-cased name holds any (or every) token."""
    test = all if match_all else any
    return [c for c in df.columns if test(t.upper() in c.upper() for t in tokens)]


def columns_of_type(df: DataFrame, kind: str) -> list[str]:
    """Columns that are ``"text"`` or ``"numeric"``."""
    types = {"text": T.StringType, "numeric": T.NumericType}
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types[kind])]


def select_available(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in wanted if c in df.columns])


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def add_literal(df: DataFrame, name: str, value: object) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def drop_column(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """The frame itself, or an error naming the columns it lacks."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return df


def normalize_headers(df: DataFrame, remove: str = "") -> DataFrame:
    """Strip and upper-case the names, without the characters in ``remove``."""
    gone = str.maketrans("", "", remove)
    return df.toDF(*[c.translate(gone).strip().upper() for c in df.columns])
