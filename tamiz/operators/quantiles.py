"""Exact quantiles and moments without gathering a group in one task, from one scan of the input.

Values are counted per group, the counts are sorted across the cluster and
written once. Each sorted partition then holds a contiguous run of ranks, so
the few partitions that hold a wanted rank are enough to read it off. Moments
and further quantiles come from the stored counts as well.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.session import materialize

_VALUE, _COUNT, _BLOCK = "__value", "__count", "__block"
_TOTAL, _START, _BLOCK_COUNT, _SEEN = "__total", "__start", "__block_count", "__seen"
MOMENTS = ("count", "nulls", "min", "max", "mean", "std", "sum")


def _position(p: float, total: Column) -> Column:
    return F.lit(float(p)) * (total - 1)


@dataclass(frozen=True)
class ValueRuns:
    """Stored counts of each group's values; ``of`` makes them, the rest reads them.

    ``table`` holds the groups, ``__value`` (a double, null for null and NaN) and ``__count``.
    """

    table: DataFrame
    by: tuple[str, ...]

    @classmethod
    def of(
        cls, df: DataFrame, value: str | Column, by: Sequence[str] = (), weight: str | None = None
    ) -> ValueRuns:
        """One scan of ``df``. ``weight`` names a count of repetitions; groups must not be null."""
        number = (F.col(value) if isinstance(value, str) else value).cast("double")
        repeats = F.count(F.lit(1)) if weight is None else F.sum(weight)
        counts = df.select(
            *by, F.nanvl(number, F.lit(None).cast("double")).alias(_VALUE), *([weight] if weight else []),
        ).groupBy(*by, _VALUE).agg(repeats.alias(_COUNT))
        runs = materialize(
            counts.orderBy(*by, _VALUE).withColumn(_BLOCK, F.spark_partition_id()), "quantiles"
        )
        return cls(runs, tuple(by))

    def values(self, value: str = "value", count: str = "n") -> DataFrame:
        """Distinct non-null values of each group and how often each is there."""
        known = self.table.filter(F.col(_VALUE).isNotNull())
        return known.select(*self.by, F.col(_VALUE).alias(value), F.col(_COUNT).alias(count))

    def moments(self, measures: Sequence[str] = MOMENTS) -> DataFrame:
        """One row per group of ``measures``, weighted by the counts; a row also without any values if ungrouped.

        The deviations are taken from the mean, in a second pass over the counts, so they do not cancel out.
        """
        by, v, n = list(self.by), F.col(_VALUE), F.col(_COUNT)
        known = v.isNotNull()
        counted = self.table.groupBy(*by).agg(
            F.coalesce(F.sum(F.when(known, n)), F.lit(0)).alias("count"),
            F.coalesce(F.sum(F.when(~known, n)), F.lit(0)).alias("nulls"),
            F.min(v).alias("min"), F.max(v).alias("max"), F.sum(v * n).alias("sum"),
        ).withColumn("mean", F.when(F.col("count") > 0, F.col("sum") / F.col("count")))
        if "std" in measures:
            if by:
                means = counted.select(*by, F.col("mean").alias("__mean"))
                placed = self.table.join(means, by)
            else:
                placed = self.table.withColumn("__mean", counted.select("mean").scalar())
            squares = placed.groupBy(*by).agg(F.sum(F.pow(v - F.col("__mean"), 2) * n).alias("__squares"))
            if by:
                counted = counted.join(squares, by)
            else:
                counted = counted.withColumn("__squares", squares.scalar())
            counted = counted.withColumn(
                "std", F.when(F.col("count") > 1, F.sqrt(F.col("__squares") / (F.col("count") - 1)))
            )
        return counted.select(*by, *measures)

    def quantiles(self, probabilities: Sequence[float], names: Sequence[str] | None = None) -> DataFrame:
        """Linearly interpolated quantiles of each group; a group without values gives no row."""
        return _quantiles(self.table.filter(F.col(_VALUE).isNotNull()), list(self.by), probabilities, names)


def exact_quantiles(
    df: DataFrame,
    value: str | Column,
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    weight: str | None = None,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles of ``value`` for each group of ``by``.

    Null and NaN values are ignored and groups must not be null. ``weight``
    names a count of repetitions. A group without values gives no row.
    """
    return ValueRuns.of(df, value, by, weight).quantiles(probabilities, names)


def _quantiles(
    runs: DataFrame, by: list[str], probabilities: Sequence[float], names: Sequence[str] | None
) -> DataFrame:
    names = list(names) if names else [f"q{i}" for i in range(len(probabilities))]
    # One row per group and sorted partition: where its ranks start.
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    earlier = group.orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        runs.groupBy(*by, _BLOCK)
        .agg(F.sum(_COUNT).alias(_BLOCK_COUNT))
        .withColumn(_START, F.coalesce(F.sum(_BLOCK_COUNT).over(earlier), F.lit(0)))
        .withColumn(_TOTAL, F.sum(_BLOCK_COUNT).over(group))
    )
    total = F.col(_TOTAL)
    wanted = F.array(*[
        F.struct(
            F.lit(i).alias("i"), F.lit(side).alias("side"),
            edge(_position(p, total)).cast("long").alias("rank"),
        )
        for i, p in enumerate(probabilities)
        for side, edge in enumerate((F.floor, F.ceil))
    ])
    targets = (
        blocks.select("*", F.explode(wanted).alias("t"))
        .filter(
            (F.col("t.rank") >= F.col(_START))
            & (F.col("t.rank") < F.col(_START) + F.col(_BLOCK_COUNT))
        )
        .select(*by, _BLOCK, _START, _TOTAL, "t.*")
    )

    # Running counts only inside the partitions that hold a wanted rank.
    keys = [*by, _BLOCK]
    inside = Window.partitionBy(*keys).orderBy(_VALUE).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    seen = runs.join(targets.select(*keys).distinct(), keys, "left_semi").withColumn(
        _SEEN, F.sum(_COUNT).over(inside)
    )
    found = seen.join(targets, keys).filter(
        (F.col("rank") >= F.col(_START) + F.col(_SEEN) - F.col(_COUNT))
        & (F.col("rank") < F.col(_START) + F.col(_SEEN))
    )
    picks = [
        F.max(F.when((F.col("i") == i) & (F.col("side") == side), F.col(_VALUE))).alias(f"__{i}_{side}")
        for i in range(len(probabilities))
        for side in (0, 1)
    ]
    grouped = found.groupBy(*by, _TOTAL).agg(*picks)
    out = []
    for i, (p, name) in enumerate(zip(probabilities, names)):
        low, high = F.col(f"__{i}_0"), F.col(f"__{i}_1")
        fraction = _position(p, total) - F.floor(_position(p, total))
        # Equal ends are taken as they are: infinities would otherwise give NaN.
        out.append(
            F.when(low == high, low).otherwise(low + (high - low) * fraction).alias(name)
        )
    return grouped.select(*by, *out)
