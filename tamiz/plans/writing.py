"""Cleaning and writing in one job, with the reports taken from the rows as they pass."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tamiz.functions import percent_of
from tamiz.plans.cleaning import ROW_ORDER, UNIQUE_KEYS, clean_dataset
from tamiz.session import build_together
from tamiz.sources.zones import write_cleaned


@dataclass(frozen=True)
class Written:
    """What a cleaning job read, wrote and left null. Counts of the job itself, not of a second scan."""

    name: str
    path: str
    read: int
    written: int
    nulls: Mapping[str, int]

    @property
    def row(self) -> tuple[str, int, int, int, int]:
        return (self.name, self.read, self.written, self.read - self.written, len(self.nulls))


def clean_and_write(name: str, raw: DataFrame, folder: str, order_by: str = ROW_ORDER, **options: object) -> Written:
    """Clean a raw dataset, write it below ``folder`` and report on both ends, in one job.

    A key that has to be unique is made so by the cleaner, which keeps one row per key; nulls of it are an
    error after the write, as the table then is not what it should be.
    """
    before, after = Observation(f"{name} read"), Observation(f"{name} written")
    seen = raw.observe(before, F.count(F.lit(1)).alias("rows"))
    cleaned = clean_dataset(name, seen, order_by, **options)
    columns = [c for c in cleaned.columns if c != order_by]
    counted = cleaned.observe(
        after, F.count(F.lit(1)).alias("rows"), *(F.count_if(F.col(f"`{c}`").isNull()).alias(f"null {c}") for c in columns)
    )
    path = write_cleaned(counted, folder, f"{name}_clean", drop=[order_by])
    kept = after.get
    nulls = {c: kept.get(f"null {c}") or 0 for c in columns}
    broken = [c for c in UNIQUE_KEYS.get(name, ()) if nulls.get(c)]
    if broken:
        raise ValueError(f"{path} holds rows without {', '.join(broken)}")
    return Written(name, path, before.get["rows"], kept["rows"], nulls)


def clean_zone(raw: Mapping[str, DataFrame], folder: str, **options: Mapping[str, object]) -> dict[str, Written]:
    """Clean and write all datasets side by side, a job each; ``options`` go to the cleaner of that name."""
    spark = next(iter(raw.values())).sparkSession
    return build_together(spark, {
        name: lambda name=name, df=df: clean_and_write(name, df, folder, **options.get(name, {})) for name, df in raw.items()
    })


def zone_report(written: Mapping[str, Written], spark) -> DataFrame:
    """The rows of ``cleaning_report`` for every dataset of a zone."""
    rows = spark.createDataFrame(
        [w.row for w in written.values()],
        "dataset string, registros_originales long, registros_finales long, registros_eliminados long, columnas int",
    )
    share = percent_of(F.col("registros_finales"), F.col("registros_originales"))
    return rows.select(
        "dataset", "registros_originales", "registros_finales", "registros_eliminados",
        share.alias("porcentaje_retenido"), "columnas",
    )


def zone_nulls(written: Mapping[str, Written], spark) -> DataFrame:
    """dataset, column, nulls of all that was written."""
    rows = [(w.name, c, n) for w in written.values() for c, n in w.nulls.items()]
    return spark.createDataFrame(rows, "dataset string, column string, nulls long")
