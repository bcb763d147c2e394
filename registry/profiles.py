"""Date formats, sketches, cleaners by column name, and tables written with reports or in buckets."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from registry.base import query, table
from registry.bindings import raw, with_cleaned
from registry.storage import _COLUMNS
from registry.warehouse import DATASETS
from tamiz.operators import sketches as sk
from tamiz.operators.date_formats import infer_date_formats, parse_inferred_dates
from tamiz.operators.joins import lookup_key
from tamiz.plans import cleaning as cl
from tamiz.plans.writing import clean_zone, zone_nulls, zone_report
from tamiz.session import fresh_path, materialize
from tamiz.sources.zones import write_bucketed

# ---- date formats ---------------------------------------------------------

# Columns of text dates: each in one format, with other spellings and junk among them.
_SPELLED = {
    "iso": ("CASE o_orderstatus WHEN 'P' THEN 'sin fecha' ELSE {0} END", "%Y-%m-%d"),
    "day_first": ("CASE o_orderpriority WHEN '5-LOW' THEN NULL ELSE {0} END", "%d/%m/%Y"),
    "month_first": ("CASE o_orderstatus WHEN 'P' THEN '' ELSE {0} END", "%m/%d/%Y"),
    "compact": ("{0}", "%Y%m%d"), "clock": ("' ' || {0}", "%Y-%m-%dT%H:%M:%S"),
    "early": ("CASE WHEN day(o_orderdate) > 12 THEN 'n.d.' ELSE {0} END", "%d-%m-%Y"),
    "nothing": ("CASE WHEN {0} IS NULL THEN NULL ELSE '?' END", "%Y"),
}
_JAVA = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss", "T": "'T'"}


def _spelled_sql() -> str:
    cells = ", ".join(text.format(f"strftime(o_orderdate, '{f}')") + f" AS {c}" for c, (text, f) in _SPELLED.items())
    return f"SELECT o_orderkey, {cells} FROM orders"


def _spelled(spark, sf):
    cells = []
    for c, (text, pattern) in _SPELLED.items():
        for old, new in _JAVA.items():
            pattern = pattern.replace(old, new)
        quoted = pattern.replace("'", "\\'")
        cells.append(F.expr(text.format(f"date_format(o_orderdate, '{quoted}')")).alias(c))
    return table(spark, sf, "orders").select("o_orderkey", *cells)


def _vote_sql(column: str, shape: str, one: int, two: int, order: str, pattern: str) -> str:
    """Counts for the format that wins: two numbers at places ``one`` and ``two``, the month first in ``mdy`` and ``ymd``."""
    a, b = (f"CAST(substr(trim({column}), {i}, 2) AS INT)" for i in (one, two))
    month, day = (b, a) if order == "dmy" else (a, b)
    fits = f"{month} BETWEEN 1 AND 12 AND {day} BETWEEN 1 AND 31"
    swapped = f"{day} BETWEEN 1 AND 12 AND {month} BETWEEN 1 AND 31" if order != "ymd" else "false"
    shaped = f"regexp_full_match(trim({column}), '{shape}')"
    counted = lambda test: f"count(*) FILTER (CASE WHEN {shaped} THEN {test} ELSE false END)"
    return f"""SELECT '{column}' AS "column", '{pattern}' AS format, '{order}' AS "order",
        count(*) FILTER (trim({column}) <> '') AS "values", {counted(fits)} AS fitting,
        round({counted(fits)} * 100.0 / count(*) FILTER (trim({column}) <> ''), 6) AS pct,
        {counted(f'({fits}) AND ({swapped})')} AS ambiguous, {counted(f'NOT ({fits}) AND ({swapped})')} AS contrary FROM spelled"""


_VOTES = [
    _vote_sql("iso", r"\d{4}-\d\d-\d\d", 6, 9, "ymd", "yyyy-MM-dd"),
    _vote_sql("day_first", r"\d\d/\d\d/\d{4}", 1, 4, "dmy", "dd/MM/yyyy"),
    _vote_sql("month_first", r"\d\d/\d\d/\d{4}", 1, 4, "mdy", "MM/dd/yyyy"),
    _vote_sql("compact", r"\d{8}", 5, 7, "ymd", "yyyyMMdd"),
    _vote_sql("clock", r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d", 6, 9, "ymd", "yyyy-MM-dd''T''HH:mm:ss"),
    _vote_sql("early", r"\d\d-\d\d-\d{4}", 1, 4, "dmy", "dd-MM-yyyy"),
]


@query("infer_date_format", f"""WITH spelled AS ({_spelled_sql()}) {' UNION ALL '.join(_VOTES)}
    UNION ALL SELECT 'nothing', NULL, NULL, count(nothing), 0, 0.0, 0, 0 FROM spelled""")
def _(spark, sf):
    """Seven columns of text dates: two whose order only the values tell, one where either order fits, one of none."""
    found = infer_date_formats(_spelled(spark, sf), list(_SPELLED))
    return found.withColumn("pct", F.round("pct", 6))


@query("parse_inferred_dates", f"""WITH spelled AS ({_spelled_sql()})
    SELECT o_orderkey, {', '.join(f"CAST(try_strptime(trim({c}), '{f}') AS VARCHAR) AS {c}" for c, (_, f) in _SPELLED.items() if c != 'nothing')},
           NULL::VARCHAR AS nothing FROM spelled""")
def _(spark, sf):
    """Each column read in the one format found for it, as the cleaners do with ``formats="infer"``."""
    read = parse_inferred_dates(_spelled(spark, sf), list(_SPELLED))
    return read.select("o_orderkey", *[F.col(c).cast("string").alias(c) for c in _SPELLED])


@query("clean_vacancies_inferred", f"""{with_cleaned('vacantes')}
    SELECT AVISOID, CAST(FECHAINICIO AS VARCHAR) AS FECHAINICIO, CAST(FECHAFIN AS VARCHAR) AS FECHAFIN,
           CAST(FECHACREACION AS VARCHAR) AS FECHACREACION FROM vacantes""")
def _(spark, sf):
    out = cl.clean_vacancies(materialize(raw(spark, sf, "vacantes"), "raw"), formats="infer")
    return out.select("AVISOID", *[F.col(c).cast("string").alias(c) for c in ("FECHAINICIO", "FECHAFIN", "FECHACREACION")])


# ---- sketches -------------------------------------------------------------

_NUMBERS = ["l_quantity", "l_extendedprice", "l_partkey", "l_discounted"]
_POINTS = (0.01, 0.25, 0.5, 0.9, 0.999)


def _discounted(spark, sf):
    lines = table(spark, sf, "lineitem")
    return lines.withColumn("l_discounted", F.when(F.col("l_returnflag") != "A", F.col("l_extendedprice") * F.col("l_discount")))


@query("approximate_quantiles", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST(unnest({list(_POINTS)}) AS DOUBLE) AS probability, n AS "values", true AS within
        FROM (SELECT count({c}) AS n FROM (SELECT *, CASE WHEN l_returnflag <> 'A' THEN l_discount END AS l_discounted FROM lineitem))"""
    for c in _NUMBERS))
def _(spark, sf):
    """A sketch per return flag and line status, stored, merged, and its answers held against exact ranks."""
    lines = _discounted(spark, sf)
    parts = materialize(sk.sketch_columns(lines, numeric=_NUMBERS, by=["l_returnflag", "l_linestatus"]), "sketches")
    whole = materialize(sk.merge_sketches(parts), "merged")
    answers = sk.approximate_quantiles(whole, _POINTS).collect()  # a row per column and probability
    error, cells = sk.rank_error(), []
    for a in answers:
        value = F.col(a["column"])
        n = F.count(value)
        low, high = F.count_if(value < a["value"]) / n, F.count_if(value <= a["value"]) / n
        within = (low - error <= a["probability"]) & (high + error >= a["probability"])
        cells.append(F.struct(
            F.lit(a["column"]).alias("column"), F.lit(a["probability"]).alias("probability"), n.alias("values"), within.alias("within")
        ))
    return lines.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


_COUNTED = ["user_id", "event_type", "props", "event_id", "kind"]


@query("approximate_distinct", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS exact, true AS close
        FROM (SELECT *, CASE WHEN event_type = 'error' THEN NULL ELSE event_type || user_id END AS kind FROM events)""" for c in _COUNTED))
def _(spark, sf):
    """Sketches per event type, merged; estimates within four standard errors of the exact counts."""
    kind = F.when(F.col("event_type") != "error", F.concat("event_type", F.col("user_id").cast("string")))
    events = table(spark, sf, "events").withColumn("kind", kind)
    parts = materialize(sk.sketch_columns(events, distinct=_COUNTED, by=["event_type"]), "sketches")
    estimated = sk.approximate_profile(sk.merge_sketches(parts))
    cells = [F.struct(F.lit(c).alias("column"), F.count_distinct(c).alias("exact")) for c in _COUNTED]
    exact = events.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
    off = F.abs(F.col("distinct") - F.col("exact")) <= F.greatest(F.lit(1.0), 4 * sk.distinct_error() * F.col("exact"))
    return estimated.join(exact, "column").select("column", "rows", "nulls", "exact", off.alias("close"))


# ---- cleaners that find their columns by name -----------------------------

@query("clean_salary", """
    SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE floor(o_totalprice) END AS "SALARIO_MIN",
           CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_custkey AS DOUBLE) END AS "Sueldo mensual",
           o_orderstatus AS "OTRO" FROM orders""")
def _(spark, sf):
    priority, whole = F.col("o_orderpriority"), F.floor("o_totalprice").cast("bigint").cast("string")
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.when(priority == "5-LOW", "a tratar").otherwise(F.concat(F.lit(" "), whole, F.lit(".0 "))).alias("SALARIO_MIN"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast("string")).alias("Sueldo mensual"),
        F.col("o_orderstatus").alias("OTRO"),
    )
    return cl.clean_salary(rows)


@query("clean_duration", """
    SELECT event_id, CAST(user_id AS DOUBLE) AS "DURACION", CASE WHEN event_type = 'view' THEN NULL ELSE user_id / 4.0 END AS "MESES_CARGO",
           event_type AS "NOTA" FROM events""")
def _(spark, sf):
    rows = table(spark, sf, "events").select(
        "event_id", F.concat(F.lit("\t"), F.col("user_id").cast("string")).alias("DURACION"),
        F.when(F.col("event_type") == "view", "varios").otherwise((F.col("user_id") / 4.0).cast("string")).alias("MESES_CARGO"),
        F.col("event_type").alias("NOTA"),
    )
    return cl.clean_duration(rows)


@query("clean_required_experience", """
    SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS DOUBLE) END AS "EXPERIENCIA_MESES",
           CASE l_returnflag WHEN 'A' THEN 'SENIOR' WHEN 'N' THEN NULL ELSE 'R' END AS "EXPERIENCIA" FROM lineitem""")
def _(spark, sf):
    flag = F.col("l_returnflag")
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_linestatus") == "O", F.col("l_quantity").cast("string")).otherwise("min.").alias("EXPERIENCIA_MESES"),
        F.when(flag == "A", " senior ").when(flag == "N", "nan").otherwise(F.lower(flag)).alias("EXPERIENCIA"),
    )
    return cl.clean_required_experience(rows)


# ---- written with reports, and in buckets ---------------------------------

@query("clean_and_write", with_cleaned(*DATASETS) + " UNION ALL ".join(f"""
    SELECT '{n}' AS dataset, (SELECT count(*) FROM raw_{n}) AS registros_originales, count(*) AS registros_finales,
           (SELECT count(*) FROM raw_{n}) - count(*) AS registros_eliminados,
           round(count(*) * 100.0 / (SELECT count(*) FROM raw_{n}), 6) AS porcentaje_retenido,
           {len(c.split(', ')) - 1}::INTEGER AS columnas FROM {n}""" for n, c in _COLUMNS.items()))
def _(spark, sf):
    """All six datasets cleaned and written; the report is of the writing jobs themselves."""
    written = clean_zone({n: raw(spark, sf, n) for n in DATASETS}, fresh_path(spark, "zone"))
    return zone_report(written, spark).withColumn("porcentaje_retenido", F.round("porcentaje_retenido", 6))


@query("clean_and_write_nulls", with_cleaned(*DATASETS) + " UNION ALL ".join(
    f"""SELECT '{n}' AS dataset, '{c}' AS "column", count(*) - count({c}) AS nulls FROM {n}"""
    for n, columns in _COLUMNS.items() for c in columns.split(", ") if c != "_row_order"))
def _(spark, sf):
    return zone_nulls(clean_zone({n: raw(spark, sf, n) for n in DATASETS}, fresh_path(spark, "zone")), spark)


@query("write_bucketed", """
    SELECT c_nationkey AS nation, count(*) AS orders, round(sum(o_totalprice), 2) AS total
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey GROUP BY c_nationkey""")
def _(spark, sf):
    """Orders and customers in eight buckets each, joined bucket by bucket."""
    name, folder = f"buckets_{uuid.uuid4().hex[:12]}", fresh_path(spark, "buckets")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}'")
    tables = {"orders": table(spark, sf, "orders"), "customer": table(spark, sf, "customer")}
    write_bucketed(tables, name, folder, {"orders": ("o_custkey", 8), "customer": ("c_custkey", 8)})
    fact, dim = (spark.table(f"{name}.{n}") for n in ("orders", "customer"))
    found = lookup_key(fact, dim, "o_custkey", "c_custkey", "c_nationkey", as_name="nation", salt=None)
    return found.groupBy("nation").agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))

