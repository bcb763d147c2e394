"""Loads into a warehouse of versions, key maps and quarantine, compared by contents."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import query, table
from registry.bindings import sources, with_cleaned
from registry.warehouse import DATASETS, DAYS, DIMS_SQL, FACTS_SQL, MONTHS, RUN_DATE, _reconciled
from tamiz.operators.keys import extend_keys
from tamiz.operators.quality import check_foreign_key_nulls, check_referential_integrity
from tamiz.operators.quarantine import quarantine
from tamiz.plans import constellation as c
from tamiz.schemas import WAREHOUSE, references
from tamiz.session import fresh_path
from tamiz.sources.versions import VersionedWarehouse

SOURCES = [n for n in DATASETS if n != "discapacidad"]
KEYS = {n: (t.columns[0].name, t.columns[1].name) for n, t in WAREHOUSE.items() if t.kind == "Dimension"}
# What the first of two loads holds: a part of each dataset, by what its rows say.
FIRST_PART = {
    "postulante": "SEXO = 'M'", "educacion": "INSTITUCION IS NOT NULL", "experiencias": "SECTOR <> '5-LOW'",
    "vacantes": "ACTIVO = 'SI'", "competencias": "NIVEL = 'AVANZADO'",
}


def _named(name: str) -> str:
    """Columns of a table as DuckDB builds it; the natural key of the calendar is called f."""
    return "f" if name == "dim_tiempo" else KEYS[name][1]


def _first_load_sql() -> str:
    parts = [f"{n}_a AS (SELECT * FROM {n} WHERE {cond})" for n, cond in FIRST_PART.items()]
    inner = ", ".join(f"{n} AS (SELECT * FROM {n}_a)" for n in FIRST_PART)
    parts.append(f"vac_a AS (WITH {inner}, {_reconciled('before_dims')} SELECT * FROM vac)")
    for name, text in DIMS_SQL.items():
        parts.append(f"a_{name} AS (WITH {inner}, vac AS (SELECT * FROM vac_a), {text} SELECT * FROM {name})")
    return ", ".join(parts)


def _dimension_sql(name: str, loads: int) -> str:
    """A dimension with key -1 for the missing member, which joins of nulls then find; known keys stay."""
    sk, _ = KEYS[name]
    nat = _named(name)
    whole = f"b_{name} AS (WITH {DIMS_SQL[name]} SELECT * FROM {name})"
    if loads == 1:
        return f"""{whole}, {name} AS (
            SELECT * REPLACE (CASE WHEN {nat} IS NULL THEN -1 ELSE {sk} END AS {sk}) FROM b_{name})"""
    return f"""{whole}, {name} AS (
        SELECT * FROM a_{name} WHERE {nat} IS NOT NULL UNION ALL BY NAME
        SELECT * REPLACE (row_number() OVER (ORDER BY {nat}) + (SELECT count({nat}) FROM a_{name}) AS {sk})
        FROM b_{name} WHERE {nat} IS NOT NULL AND {nat} NOT IN (SELECT {nat} FROM a_{name} WHERE {nat} IS NOT NULL)
        UNION ALL BY NAME SELECT * REPLACE (-1 AS {sk}) FROM b_{name} WHERE {nat} IS NULL)"""


def _warehouse_sql(loads: int) -> str:
    first = [_first_load_sql()] if loads == 2 else []
    return ", ".join([
        with_cleaned(*SOURCES), _reconciled("before_dims"), *first,
        *(_dimension_sql(n, loads) for n in DIMS_SQL), *FACTS_SQL.values(),
    ])


UNKNOWN = {
    "dim_tiempo": f"""-1, '1900-01-01', 1900, 1, 1, 1, 1, 1, {MONTHS}[1], {DAYS}[1], false""",
    "dim_ubicacion": "-1, 'SIN_DATO', 'SIN_ESPECIFICAR', 'SIN_ESPECIFICAR', 'SIN_ESPECIFICAR', NULL",
    "dim_postulante": "-1, 'SIN_DATO', NULL, NULL, NULL, NULL", "dim_carrera": "-1, 'SIN_DATO', NULL",
    "dim_institucion": "-1, 'SIN_DATO'", "dim_vacante": "-1, 'SIN_DATO', NULL, 0, NULL, NULL, false, 0.0",
    "dim_empresa": "-1, 'SIN_DATO'", "dim_competencia": "-1, 'SIN_DATO'",
}


def _final_sql(name: str) -> str:
    """Rows of a table of the warehouse, columns in its order."""
    columns = [x.name for x in WAREHOUSE[name].columns]
    if name in KEYS:
        listed = ", ".join(columns)
        return f"SELECT {listed} FROM {name} WHERE {_named(name)} IS NOT NULL UNION ALL SELECT {UNKNOWN[name]}"
    return "SELECT " + ", ".join(f"coalesce({x}, -1) AS {x}" if x.endswith("_sk") else x for x in columns) + f" FROM {name}"


def contents_sql(loads: int) -> str:
    """table, digest, n: how often each row of each table is there, as the digest of its cells."""
    parts = []
    for name, t in WAREHOUSE.items():
        cells = ", ".join(f"coalesce(CAST({x.name} AS VARCHAR), '~')" for x in t.columns)
        parts.append(f"""SELECT '{name}' AS "table", md5(concat_ws('|', {cells})) AS digest FROM ({_final_sql(name)})""")
    return f"""{_warehouse_sql(loads)}
        SELECT "table", digest, count(*) AS n FROM ({' UNION ALL '.join(parts)}) GROUP BY ALL"""


def contents(tables):
    out = None
    for name, t in WAREHOUSE.items():
        cells = [F.coalesce(F.col(x.name).cast("string"), F.lit("~")) for x in t.columns]
        part = tables[name].select(F.lit(name).alias("table"), F.md5(F.concat_ws("|", *cells)).alias("digest"))
        out = part if out is None else out.unionByName(part)
    # Digests are shuffled as bytes, half as long as in hexadecimal.
    counted = out.groupBy("table", F.unhex("digest").alias("digest")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("table", F.lower(F.hex("digest")).alias("digest"), "n")


def unknown_member(spark, sf):
    return c.build_constellation(sources(spark, sf), RUN_DATE, unknown_member=c.UNKNOWN_MEMBER)


def _violations_sql() -> str:
    rows = []
    for fact, column, dim, key in references():
        rows.append(f"""SELECT '{fact}' AS fact, '{column}' AS "column", count(*) AS rows,
            count(*) FILTER (coalesce({column}, -1) = -1) AS unknown, 0::BIGINT AS nulls, 0::BIGINT AS orphans FROM {fact}""")
    return f"{_warehouse_sql(1)} {' UNION ALL '.join(rows)}"


@query("constellation_unknown_member", _violations_sql())
def _(spark, sf):
    """Every foreign key: its rows, those that point to the unknown member, nulls and keys without a member."""
    built = unknown_member(spark, sf).stored()
    nulls = check_foreign_key_nulls(built.facts).select("table", "column", "rows", "nulls")
    orphans = check_referential_integrity(built.facts, built.dimensions, references()).select("fact", "column", "orphans")
    counts = None
    for name, fact in built.facts.items():
        keys = [x for x in fact.columns if x.endswith("_sk")]
        cells = [F.struct(F.lit(k).alias("column"), F.count_if(F.col(k) == -1).alias("unknown")) for k in keys]
        part = fact.agg(F.array(*cells).alias("cells")).select(F.lit(name).alias("fact"), F.inline("cells"))
        counts = part if counts is None else counts.unionByName(part)
    joined = counts.join(nulls.withColumnRenamed("table", "fact"), ["fact", "column"]).join(orphans, ["fact", "column"])
    return joined.select("fact", "column", "rows", "unknown", "nulls", "orphans")


@query("load_versions", contents_sql(1))
def _(spark, sf):
    """All 13 tables loaded with all rules on, and the same load once more; contents row by row."""
    warehouse = VersionedWarehouse(spark, fresh_path(spark, "versions"))
    data = sources(spark, sf)
    for _ in range(2):
        c.load_constellation(warehouse, "load-1", data, RUN_DATE)
    return contents(warehouse.tables())


@query("load_second", contents_sql(2))
def _(spark, sf):
    """A part of the data, then all of it: known members keep their keys, facts are there once."""
    warehouse = VersionedWarehouse(spark, fresh_path(spark, "versions"))
    data = sources(spark, sf)
    first = {n: df.filter(FIRST_PART[n]) for n, df in data.items()}
    c.load_constellation(warehouse, "first", first, RUN_DATE)
    c.load_constellation(warehouse, "second", data, RUN_DATE)
    return contents(warehouse.tables())


@query("extend_keys", """
    WITH a AS (SELECT p_name AS name, min(p_size) AS size FROM part WHERE p_size < 25 GROUP BY p_name),
    known AS (SELECT row_number() OVER (ORDER BY name) AS sk, * FROM a UNION ALL SELECT -1, NULL, NULL),
    later AS (SELECT p_name AS name, min(p_size) AS size FROM part WHERE p_size >= 25 GROUP BY p_name)
    SELECT sk, k.name, coalesce(l.size, k.size) AS size FROM known k LEFT JOIN later l ON l.name = k.name UNION ALL
    SELECT row_number() OVER (ORDER BY name) + (SELECT count(*) FROM a), name, size FROM later
    WHERE name NOT IN (SELECT name FROM a)""")
def _(spark, sf):
    """Part names of two loads: small parts first, then large ones, whose size is taken over."""
    def members(condition):
        rows = table(spark, sf, "part").filter(condition).groupBy(F.col("p_name").alias("name"))
        return rows.agg(F.min("p_size").alias("size"))

    empty = members("false").select(F.lit(0).cast("long").alias("sk"), "name", "size")
    first = extend_keys(empty, members("p_size < 25"), "name", "sk").members
    none = spark.range(1).select(
        F.lit(-1).cast("long").alias("sk"), F.lit(None).cast("string").alias("name"), F.lit(None).cast(first.schema["size"].dataType).alias("size")
    )
    return extend_keys(first.unionByName(none), members("p_size >= 25"), "name", "sk", changed="update").members


# Vacancy facts made of line items, with faults of every kind among them.
_LINES_SQL = """
    WITH v AS (
      SELECT l_orderkey * 10 + l_linenumber AS id,
             CASE WHEN l_linenumber = 7 THEN 'x' || l_orderkey ELSE CAST(l_orderkey AS VARCHAR) END AS vacante_sk,
             CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN NULL ELSE l_suppkey END AS empresa_sk,
             CASE WHEN l_quantity > 48 THEN NULL ELSE l_partkey END AS ubicacion_sk, l_linenumber AS fecha_publicacion_sk,
             l_extendedprice AS price, l_linenumber AS line
      FROM lineitem
    ), judged AS (
      SELECT *, list_filter([
          CASE WHEN line = 7 THEN 'casts:vacante_sk' END, CASE WHEN ubicacion_sk IS NULL THEN 'not_null:ubicacion_sk' END,
          CASE WHEN empresa_sk IS NULL THEN 'not_null:empresa_sk' END], lambda x: x IS NOT NULL) AS broken
      FROM v
    ), placed AS (
      SELECT *, CASE WHEN len(broken) = 0 THEN row_number() OVER (
                  PARTITION BY vacante_sk, len(broken) = 0 ORDER BY line, id, price, ubicacion_sk, empresa_sk) END AS place
      FROM judged
    ), done AS (
      SELECT * REPLACE (list_concat(broken, list_sort(list_filter([
          CASE WHEN place > 1 THEN 'unique:vacante_sk' END,
          CASE WHEN empresa_sk NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0) THEN 'references:empresa_sk' END],
          lambda x: x IS NOT NULL))) AS broken)
      FROM placed
    )"""


def _lines(spark, sf):
    lines = table(spark, sf, "lineitem")
    key = F.col("l_orderkey").cast("string")
    line, returned = F.col("l_linenumber"), F.col("l_returnflag")
    return lines.select(
        (F.col("l_orderkey") * 10 + line).alias("id"), F.when(line == 7, F.concat(F.lit("x"), key)).otherwise(key).alias("vacante_sk"),
        F.when(~((returned == "R") & (F.col("l_linestatus") == "O")), F.col("l_suppkey")).alias("empresa_sk"),
        F.when(~(F.col("l_quantity") > 48), F.col("l_partkey")).alias("ubicacion_sk"), line.alias("fecha_publicacion_sk"),
        F.col("l_extendedprice").alias("price"), line.alias("line"),
    )


def _quarantined(spark, sf):
    suppliers = table(spark, sf, "supplier").filter("s_acctbal >= 0").select(F.col("s_suppkey").alias("empresa_sk"))
    order = ["line", "id", "price", "ubicacion_sk", "empresa_sk"]
    return quarantine(
        _lines(spark, sf), WAREHOUSE["hechos_vacante"], order_by=order, parents={"dim_empresa": suppliers}
    )


@query("quarantine", _LINES_SQL + """
    SELECT true AS good, CAST(vacante_sk AS BIGINT) AS vacante_sk, CAST(empresa_sk AS BIGINT) AS empresa_sk,
           CAST(ubicacion_sk AS BIGINT) AS ubicacion_sk, NULL::BIGINT AS id, '' AS broken FROM done WHERE len(broken) = 0
    UNION ALL SELECT false, try_cast(vacante_sk AS BIGINT), CAST(empresa_sk AS BIGINT), CAST(ubicacion_sk AS BIGINT),
           CAST(id AS BIGINT), array_to_string(broken, ', ') FROM done WHERE len(broken) > 0""")
def _(spark, sf):
    """Every row of a fact: loaded, or kept apart with the rules it breaks."""
    split = _quarantined(spark, sf)
    keys = [F.col(x).try_cast("bigint").alias(x) for x in ("vacante_sk", "empresa_sk", "ubicacion_sk")]
    good = split.good.select(F.lit(True).alias("good"), *keys, F.lit(None).cast("long").alias("id"), F.lit("").alias("broken"))
    bad = split.rejects.select(
        F.lit(False).alias("good"), *keys, F.col("id").cast("long").alias("id"), F.array_join("broken", ", ").alias("broken")
    )
    return good.unionByName(bad)


@query("quarantine_report", _LINES_SQL + """
    SELECT split_part(rule, ':', 1) AS rule, split_part(rule, ':', 2) AS "column", count(*) AS rows
    FROM (SELECT unnest(broken) AS rule FROM done) GROUP BY ALL""")
def _(spark, sf):
    return _quarantined(spark, sf).report()

