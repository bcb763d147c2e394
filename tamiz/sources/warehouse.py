"""The warehouse in the session catalog: create, load in order, validate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.operators.quality import check_max_length, check_not_null, check_unique
from tamiz.schemas import LOAD_ORDER, WAREHOUSE, Table, conform, conform_rejects
from tamiz.session import COMPACT, drop_stored, materialize

# What a load can be held to: values fit their types, no nulls, no repeats, no over-long texts.
RULES = ("casts", "not_null", "unique", "max_length")


def create_tables(
    spark: SparkSession, database: str, location: str | None = None,
    tables: Sequence[Table] | None = None,
) -> None:
    """Drop and re-create empty typed tables, facts dropped first."""
    tables = list(tables) if tables else list(WAREHOUSE.values())
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    for table in reversed(tables):
        spark.sql(f"DROP TABLE IF EXISTS {database}.{table.name}")
    options = ", ".join(f"'{k}' '{v}'" for k, v in COMPACT.items())
    for table in tables:
        columns = ", ".join(
            f"{c.name} {c.type.simpleString()}{' NOT NULL' if c.not_null else ''}"
            for c in table.columns
        )
        spark.sql(f"CREATE TABLE {database}.{table.name} ({columns}) USING parquet OPTIONS ({options})")


def load_violations(tables: Mapping[str, DataFrame], rules: Sequence[str] = RULES) -> DataFrame:
    """table, column, rule, rows: what of the known tables breaks which rule."""
    parts = []
    for name, df in tables.items():
        table = WAREHOUSE[name]
        if "casts" in rules:
            parts.append(conform_rejects(df, table).withColumnRenamed("rejects", "rows").withColumn("rule", F.lit("casts")))
        data = conform(df, table)
        not_null, unique = table.names(not_null=True), table.names(unique=True)
        lengths = {c.name: c.max_length for c in table.columns if c.max_length is not None}
        for rule, columns, check, count in (
            ("not_null", not_null, check_not_null, "nulls"), ("unique", unique, check_unique, "duplicates"),
            ("max_length", lengths, check_max_length, "too_long"),
        ):
            if rule in rules and columns:
                report = check(data, name, columns).withColumnRenamed(count, "rows")
                parts.append(report.withColumn("rule", F.lit(rule)))
    out = None
    for part in parts:
        part = part.select("table", "column", "rule", F.col("rows").cast("long").alias("rows"))
        out = part if out is None else out.unionByName(part)
    return out.filter("rows > 0")


def load_warehouse(
    spark: SparkSession,
    database: str,
    tables: Mapping[str, DataFrame],
    order: Sequence[str] = LOAD_ORDER,
    rules: Sequence[str] = RULES,
) -> list[str]:
    """Append the given tables in load order; an error if one is missing or breaks one of ``rules``.

    All tables are stored and checked before the first one is written, so a bad
    value leaves the warehouse as it was. The catalog has no transactions: a failure while
    tables are written can leave some of them loaded. ``versions.VersionedWarehouse`` has none of that.
    """
    missing = [name for name in order if name not in tables]
    if missing:
        raise ValueError(f"tables missing from the load: {', '.join(missing)}")
    stored = {name: materialize(tables[name], f"load-{name}", **COMPACT) for name in order}
    known = {name: df for name, df in stored.items() if name in WAREHOUSE}
    if known and rules:
        bad = load_violations(known, rules).collect()  # a row per column and rule at most
        if bad:
            lines = [f"{r['table']}.{r['column']}: {r['rows']} rows break {r['rule']}" for r in bad]
            raise ValueError("nothing was loaded; " + "; ".join(sorted(lines)))
    for name in order:
        df = conform(stored[name], WAREHOUSE[name]) if name in WAREHOUSE else stored[name]
        df.write.mode("append").format("parquet").options(**COMPACT).saveAsTable(f"{database}.{name}")
        drop_stored(stored[name])
    return list(order)


def truncate_table(spark: SparkSession, database: str, table: str) -> None:
    spark.sql(f"TRUNCATE TABLE {database}.{table}")


def list_tables(spark: SparkSession, database: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def table_exists(spark: SparkSession, database: str, table: str) -> bool:
    return spark.catalog.tableExists(f"{database}.{table}")


def table_count(spark: SparkSession, database: str, table: str) -> int:
    return spark.table(f"{database}.{table}").count()


def run_query(spark: SparkSession, query: str, **args: object) -> DataFrame:
    """A SQL query over catalog tables, with named parameters."""
    return spark.sql(query, args=args or None)


def validate_warehouse_structure(
    spark: SparkSession, database: str, expected: Sequence[str] = LOAD_ORDER
) -> DataFrame:
    """table, status (found, missing or extra), ok and rows (null if missing); ``v_`` views are ignored."""
    found = {t for t in list_tables(spark, database) if not t.startswith("v_")}
    rows = []
    for name in sorted(found | set(expected)):
        status = "found" if name in found and name in expected else (
            "missing" if name in expected else "extra"
        )
        rows.append((name, status, status == "found"))
    report = spark.createDataFrame(rows, "table string, status string, ok boolean")
    return report.join(table_stats(spark, database).select("table", "rows"), "table", "left")


def table_stats(spark: SparkSession, database: str) -> DataFrame:
    """Rows and kind (Dimension, Fact or Other, by prefix) of each table."""
    out = None
    for name in list_tables(spark, database):
        row = spark.table(f"{database}.{name}").agg(F.count(F.lit(1)).alias("rows"))
        kind = "Dimension" if name.startswith("dim_") else (
            "Fact" if name.startswith("hechos_") else "Other"
        )
        row = row.select(F.lit(name).alias("table"), F.lit(kind).alias("kind"), "rows")
        out = row if out is None else out.unionByName(row)
    if out is None:
        return spark.createDataFrame([], "table string, kind string, rows long")
    return out
