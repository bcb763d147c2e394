"""Stored sketches of columns: approximate quantiles and distinct counts that merge without a rescan.

A sketch table has one row per group and column, with the sketches as binary cells. It is written like any
table, for example one per partition of the data, and merging reads only the sketches. Quantiles are those of
a KLL sketch of size ``k``: the rank of an answer is off by no more than ``rank_error(k)`` of the values with
99 % confidence. Distinct counts are those of a HyperLogLog sketch of ``2^lg`` buckets, with a standard error
of ``distinct_error(lg)``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUANTILE_SIZE, DISTINCT_BITS = 400, 14
SKETCHES = ("quantiles", "distinct")


def rank_error(k: int = QUANTILE_SIZE) -> float:
    """Largest error of a single rank, as a share of the values, that 99 of 100 sketches keep to."""
    return 2.296 / math.pow(k, 0.9021)


def distinct_error(lg: int = DISTINCT_BITS) -> float:
    """Relative standard error of a merged distinct count."""
    return 1.04 / math.sqrt(1 << lg)


def sketch_columns(
    df: DataFrame, numeric: Sequence[str] = (), distinct: Sequence[str] = (), by: Sequence[str] = (),
    k: int = QUANTILE_SIZE, lg: int = DISTINCT_BITS,
) -> DataFrame:
    """by..., column, rows, values, min, max, quantiles and distinct sketches, from one scan.

    ``numeric`` columns get a quantile sketch over their non-null, non-NaN values, ``distinct`` columns one
    of their distinct values as text; a column may be in both.
    """
    names = list(dict.fromkeys([*numeric, *distinct]))
    aggregates: list[Column] = [F.count(F.lit(1)).alias("__rows")]
    none = F.lit(None)
    for i, c in enumerate(names):
        number = F.nanvl(F.col(c).cast("double"), none.cast("double")) if c in numeric else none.cast("double")
        aggregates += [
            F.count(F.col(c)).alias(f"{i}__values"), F.min(number).alias(f"{i}__min"), F.max(number).alias(f"{i}__max"),
        ]
        if c in numeric:
            aggregates.append(F.kll_sketch_agg_double(number, F.lit(k)).alias(f"{i}__quantiles"))
        if c in distinct:
            aggregates.append(F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg)).alias(f"{i}__distinct"))
    empty = none.cast("binary")
    cells = [
        F.struct(
            F.lit(c).alias("column"), F.col("__rows").alias("rows"),
            *[F.col(f"{i}__{m}").alias(m) for m in ("values", "min", "max")],
            (F.col(f"{i}__quantiles") if c in numeric else empty).alias("quantiles"),
            (F.col(f"{i}__distinct") if c in distinct else empty).alias("distinct"),
        )
        for i, c in enumerate(names)
    ]
    return df.groupBy(*by).agg(*aggregates).select(*by, F.inline(F.array(*cells)))


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per group of ``by`` and column, from sketch rows of finer groups or of several tables."""
    merged = sketches.groupBy(*by, "column").agg(
        F.sum("rows").alias("rows"), F.sum("values").alias("values"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"), F.hll_union_agg("distinct").alias("distinct"),
        *(F.count(s).alias(f"__{s}") for s in SKETCHES),
    )
    # A merge of nothing is an empty sketch, not a missing one.
    return merged.select(
        *by, "column", "rows", "values", "min", "max", *(F.when(F.col(f"__{s}") > 0, F.col(s)).alias(s) for s in SKETCHES)
    )


def approximate_quantiles(sketches: DataFrame, probabilities: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """by..., column, probability, value of every column that has a quantile sketch and values."""
    ranks = F.array(*[F.lit(float(p)) for p in probabilities])
    known = sketches.filter(F.col("quantiles").isNotNull() & F.col("max").isNotNull())
    found = F.arrays_zip(ranks.alias("probability"), F.kll_sketch_get_quantile_double("quantiles", ranks).alias("value"))
    return known.select(*by, "column", F.inline(found)).toDF(*by, "column", "probability", "value")


def approximate_ranks(sketches: DataFrame, value: Column, by: Sequence[str] = ()) -> DataFrame:
    """by..., column, share of the values that are not above ``value``."""
    known = sketches.filter(F.col("quantiles").isNotNull() & F.col("max").isNotNull())
    return known.select(*by, "column", F.kll_sketch_get_rank_double("quantiles", value).alias("rank"))


def approximate_profile(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """by..., column, rows, nulls and estimated distinct values of every column that has a distinct sketch."""
    return sketches.filter(F.col("distinct").isNotNull()).select(
        *by, "column", "rows", (F.col("rows") - F.col("values")).alias("nulls"),
        F.hll_sketch_estimate("distinct").alias("distinct"),
    )
