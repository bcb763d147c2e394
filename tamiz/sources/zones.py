"""Zones: folders that hold one table per dataset."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tamiz.session import COMPACT, shuffles_dropped


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on the file system it names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def missing_inputs(spark: SparkSession, folder: str, names: Sequence[str]) -> list[str]:
    """Those names without a table in the folder."""
    return [name for name in names if not path_exists(spark, f"{folder}/{name}")]


def check_inputs_exist(spark: SparkSession, folder: str, names: Sequence[str]) -> None:
    missing = missing_inputs(spark, folder, names)
    if missing:
        raise FileNotFoundError(f"missing in {folder}: {', '.join(missing)}")


def load_zone(
    spark: SparkSession, folder: str, names: Mapping[str, str] | Sequence[str]
) -> dict[str, DataFrame]:
    """Every dataset of a zone; an error if a table is missing or empty.

    ``names`` maps a dataset to its folder name when the two differ.
    """
    named = dict(names) if isinstance(names, Mapping) else {n: n for n in names}
    check_inputs_exist(spark, folder, list(named.values()))
    tables = {name: spark.read.parquet(f"{folder}/{sub}") for name, sub in named.items()}
    empty = [name for name, df in tables.items() if df.isEmpty()]
    if empty:
        raise ValueError(f"empty datasets: {', '.join(empty)}")
    return tables


def write_cleaned(
    df: DataFrame, folder: str, name: str, csv: bool = False, drop: Sequence[str] = ()
) -> str:
    """Write one table of a zone as Parquet, or as CSV for other tools."""
    path = f"{folder}/{name}"
    out = df.drop(*drop)
    with shuffles_dropped(df.sparkSession):
        if csv:
            out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
        else:
            out.write.mode("overwrite").options(**COMPACT).parquet(path)
    return path


def write_integrated(
    tables: Mapping[str, DataFrame], folder: str, csv: bool = False
) -> dict[str, str]:
    """Write every warehouse table to its own place in a zone."""
    return {name: write_cleaned(df, folder, name, csv=csv) for name, df in tables.items()}


def write_bucketed(
    tables: Mapping[str, DataFrame], database: str, folder: str, buckets: Mapping[str, tuple[str, int]]
) -> dict[str, str]:
    """Write tables to a zone and to the catalog, those in ``buckets`` hashed and sorted by a column.

    ``buckets`` maps a table to (column, number). Tables with the same number, bucketed by the columns that
    they are joined on, are joined without a shuffle (``lookup_key`` with ``salt=None``). A value that a large
    part of the rows share, null included, is in one bucket: bucket by columns without such values.
    """
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{folder}/{name}"
        writer = df.write.mode("overwrite").format("parquet").option("path", paths[name])
        if name in buckets:
            column, number = buckets[name]
            # Rows are dealt like the buckets first, so that a task writes one file and not one per bucket.
            writer = df.repartition(number, column).write.mode("overwrite").format("parquet").option("path", paths[name])
            writer = writer.bucketBy(number, column).sortBy(column)
        writer.saveAsTable(f"{database}.{name}")
    return paths
