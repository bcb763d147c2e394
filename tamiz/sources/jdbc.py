"""Relational sources and sinks over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str, user: str | None = None, password: str | None = None,
    driver: str = "org.postgresql.Driver", batch_size: int = 1000, fetch_size: int = 10_000,
) -> dict[str, str]:
    """Connection options; inserts go in batches of ``batch_size`` rows."""
    options = {
        "url": url, "driver": driver, "batchsize": str(batch_size), "fetchsize": str(fetch_size),
        "reWriteBatchedInserts": "true",
    }
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    return options


def write_jdbc(
    df: DataFrame, table: str, options: dict[str, str], mode: str = "append",
    connections: int = 8,
) -> None:
    """Insert the rows over at most ``connections`` parallel connections."""
    (
        df.write.format("jdbc").options(**options)
        .option("dbtable", table).option("numPartitions", connections)
        .mode(mode).save()
    )


def read_jdbc_query(
    spark: SparkSession, query: str, options: dict[str, str]
) -> DataFrame:
    """The rows of a query that the database runs."""
    return spark.read.format("jdbc").options(**options).option("query", query).load()


def read_jdbc_table(
    spark: SparkSession, table: str, options: dict[str, str], partition_column: str,
    lower: int, upper: int, partitions: int,
) -> DataFrame:
    """A table read in parallel by ranges of a numeric column.

    The limits only set the ranges; rows outside them are read too.
    """
    return (
        spark.read.format("jdbc").options(**options)
        .option("dbtable", table).option("partitionColumn", partition_column)
        .option("lowerBound", lower).option("upperBound", upper)
        .option("numPartitions", partitions).load()
    )
