"""Descriptive statistics of numeric, text and date columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions import bin_duration, bin_duration_order, percent_of, round_half_even, safe_ratio
from tamiz.operators.quantiles import ValueRuns


def _number(column: str) -> Column:
    """The column as a double, with NaN as null."""
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


def _long_form(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One (column, value) row per cell, values as doubles."""
    return df.select(*[_number(c).alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value"
    )


def _one_row_to_long(row: DataFrame, columns: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Turn a single row of ``column__measure`` cells into a row per column."""
    cells = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}__{m}`").alias(m) for m in measures])
        for c in columns
    ]
    return row.select(F.inline(F.array(*cells)))


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max of each column, all from one scan."""
    runs = ValueRuns.of(_long_form(df, columns), "value", ["column"])
    moments = runs.moments(("count", "mean", "std", "min", "max"))
    quartiles = runs.quantiles((0.25, 0.5, 0.75), ("p25", "p50", "p75"))
    found = moments.join(quartiles, "column", "left").select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )
    # A table without rows has no cells, yet each column is described.
    names = df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, columns))).alias("column"))
    return names.join(found, "column", "left").withColumn("count", F.coalesce("count", F.lit(0)))


def describe_categorical(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, unique, most frequent value (ties: the smallest) and its frequency."""
    cells = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value"
    )
    frequencies = cells.groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    known = F.col("value").isNotNull()
    seen = F.when(known, F.col("n"))
    return frequencies.groupBy("column").agg(
        F.coalesce(F.sum(seen), F.lit(0)).alias("count"),
        F.count_if(known).alias("unique"),
        F.min_by("value", F.when(known, F.struct(-F.col("n"), F.col("value")))).alias("top"),
        F.coalesce(F.max(seen), F.lit(0)).alias("freq"),
    )


def numeric_summary(df: DataFrame, column: str) -> DataFrame:
    """min, max, mean, median, std, sum and number of nulls of one column, from one scan."""
    runs = ValueRuns.of(df, column)
    moments = runs.moments(("count", "nulls", "min", "max", "mean", "std", "sum"))
    return moments.withColumn("median", runs.quantiles((0.5,), ("median",)).scalar())


def ratio_summary(df: DataFrame, numerator: str, denominator: str) -> DataFrame:
    """Mean, median and maximum of a ratio in which a zero divisor counts as one."""
    ratios = df.select(safe_ratio(F.col(numerator), F.col(denominator)).alias("ratio"))
    return numeric_summary(ratios, "ratio").select("mean", "median", "max")


def group_stats(
    df: DataFrame, by: str, column: str, digits: int = 2,
    measures: Sequence[str] = ("mean", "median", "std", "count"),
) -> DataFrame:
    """Mean, median, standard deviation and count per non-null group, rounded; only what ``measures`` names."""
    grouped = df.filter(F.col(by).isNotNull()).select(by, _number(column).alias("value"))
    aggregates = {
        "mean": F.avg("value"), "std": F.stddev_samp("value"), "count": F.count("value"),
    }
    wanted = [aggregates[m].alias(m) for m in measures if m in aggregates]
    out = grouped.groupBy(by).agg(*wanted) if wanted else None
    if "median" in measures:
        medians = ValueRuns.of(grouped, "value", [by]).quantiles((0.5,), ("median",))
        # A group without values has no median, but is a group.
        out = (out if out is not None else grouped.select(by).distinct()).join(medians, by, "left")
    return out.select(by, *[F.col(m) if m == "count" else round_half_even(F.col(m), digits).alias(m) for m in measures])


def text_length_stats(
    df: DataFrame, columns: Sequence[str], null_as_zero: bool = False
) -> DataFrame:
    """Shortest, longest, mean and median text length per column."""
    def length(c: str) -> Column:
        text = F.coalesce(F.col(c), F.lit("")) if null_as_zero else F.col(c)
        return F.length(text)

    lengths = df.select(*[length(c).alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value"
    )
    # Lengths are pre-counted: the statistics then read the short histogram.
    histogram = lengths.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    return histogram.groupBy("column").agg(
        F.min("value").cast("long").alias("min_length"),
        F.max("value").cast("long").alias("max_length"),
        (F.sum(F.col("value").cast("long") * F.col("n")) / F.sum("n")).alias("mean_length"),
        F.percentile("value", F.lit(0.5), F.col("n")).alias("median_length"),
    )


def date_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Non-null, null, earliest, latest and distinct values per date column."""
    aggregates = []
    for c in columns:
        aggregates += [
            F.count(c).alias(f"{c}__non_null"), F.count_if(F.col(c).isNull()).alias(f"{c}__nulls"),
            F.min(c).cast("string").alias(f"{c}__min"), F.max(c).cast("string").alias(f"{c}__max"),
            F.count_distinct(c).alias(f"{c}__distinct"),
        ]
    return _one_row_to_long(
        df.agg(*aggregates), columns, ["non_null", "nulls", "min", "max", "distinct"]
    )


def date_parse_report(df: DataFrame, raw: str, parsed: Column) -> DataFrame:
    """Non-null texts, parsed dates and the share of all rows that parsed."""
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"), F.count(raw).alias("non_null"),
        F.count(parsed).alias("parsed"),
    )
    return counted.withColumn("pct_parsed", percent_of(F.col("parsed"), F.col("rows")))


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Counts in equal-width bins; the maximum belongs to the last bin.

    A column with a single value gets a range of one around it.
    """
    value = _number(column)
    limits = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    limits = limits.select(
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    frame = limits.select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", "hi",
        ((F.col("hi") - F.col("lo")) / bins).alias("step"),
    ).filter(F.col("lo").isNotNull()).select(
        "bin", (F.col("lo") + F.col("bin") * F.col("step")).alias("bin_start"),
        F.when(F.col("bin") == bins - 1, F.col("hi"))
        .otherwise(F.col("lo") + (F.col("bin") + 1) * F.col("step")).alias("bin_end"),
    )

    lo, hi = limits.select("lo").scalar(), limits.select("hi").scalar()
    placed = df.select(value.alias("x")).filter(F.col("x").isNotNull())
    placed = placed.withColumn("lo", lo).withColumn("hi", hi)
    step = (F.col("hi") - F.col("lo")) / bins
    raw = F.least(
        F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1)
    ).cast("int")
    placed = placed.withColumn("raw", raw)
    # The quotient can miss an edge by one rounding step: compare with the edges.
    below = F.col("x") < F.col("lo") + F.col("raw") * step
    above = (F.col("x") >= F.col("lo") + (F.col("raw") + 1) * step) & (F.col("raw") < bins - 1)
    placed = placed.select(
        (F.col("raw") - F.when(below, 1).otherwise(0) + F.when(above, 1).otherwise(0)).alias("bin")
    )
    counts = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    return frame.join(counts, "bin", "left").select(
        "bin", "bin_start", "bin_end", F.coalesce("n", F.lit(0)).alias("n")
    )


def box_stats(df: DataFrame, column: str, by: str | None = None, reach: float = 1.5) -> DataFrame:
    """Quartiles, whisker ends and number of outliers, overall or per group.

    A whisker ends at the last value within ``reach`` times the quartile range.
    """
    group = F.lit("all").alias("group") if by is None else F.col(by).alias("group")
    values = df.select(group, _number(column).alias("x")).filter(
        F.col("group").isNotNull() & F.col("x").isNotNull()
    )
    # Equal values share their fate: the stored counts meet the fences.
    runs = ValueRuns.of(values, "x", [] if by is None else ["group"])
    names = ("q1", "median", "q3")
    quartiles, counted = runs.quantiles((0.25, 0.5, 0.75), names), runs.values("x", "n")
    if by is None:
        whole = quartiles.select(F.struct(*names).alias("q")).scalar()
        fenced = counted.select(group, "x", "n", whole.alias("q")).select("*", "q.*")
    else:
        fenced = counted.join(quartiles, "group")
    fence = (F.col("q3") - F.col("q1")) * reach
    inside = F.col("x").between(F.col("q1") - fence, F.col("q3") + fence)
    return (
        fenced.groupBy("group", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("x"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
            F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("outliers"),
            F.sum("n").alias("count"),
        )
    )


def duration_summary(df: DataFrame, days: str) -> DataFrame:
    """count, min, max, mean and median of the spans longer than zero days."""
    return numeric_summary(df.filter(F.col(days) > 0), days).select(
        "count", "min", "max", "mean", "median"
    )


def duration_distribution(df: DataFrame, months: str) -> DataFrame:
    """Spans per bin in bin order, with the share of all given spans."""
    binned = df.select(
        bin_duration_order(F.col(months)).alias("position"), bin_duration(F.col(months)).alias("label")
    )
    total = df.agg(F.count(F.lit(1)).alias("total")).scalar()
    # The test for a bin is on a count: a test on the label would be copied,
    # with the whole computation of the span, into the scan.
    return (
        binned.groupBy("position").agg(F.max("label").alias("label"), F.count("label").alias("n"))
        .filter(F.col("n") > 0)
        .withColumn("pct", percent_of(F.col("n"), total))
        .orderBy("position")
    )
