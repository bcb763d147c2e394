"""Frequencies, statistics and whole-table profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import query, table
from registry.bindings import cleaned, with_cleaned
from tamiz.operators import dedupe, frequency, profile, stats

_EVENTS = "(SELECT *, nullif(event_type, 'error') AS kind FROM events)"


def _events(spark, sf):
    return table(spark, sf, "events").withColumn("kind", F.nullif("event_type", F.lit("error")))


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


# ---- frequencies ----------------------------------------------------------

_COUNTS = f"""SELECT kind AS value, count(*) AS n,
    round(count(*) * 100.0 / (SELECT count(*) FROM events), 6) AS pct
    FROM {_EVENTS} WHERE kind IS NOT NULL GROUP BY kind"""


@query("value_counts", _COUNTS)
def _(spark, sf):
    return rounded(frequency.value_counts(_events(spark, sf), "kind"), "pct")


@query("value_counts_by_value", """
    SELECT p_size AS value, count(*) AS n,
           round(count(*) * 100.0 / (SELECT count(*) FROM part), 6) AS pct
    FROM part GROUP BY p_size ORDER BY p_size""")
def _(spark, sf):
    return rounded(frequency.value_counts(table(spark, sf, "part"), "p_size", sort="value"), "pct")


@query("top_k_values", """
    SELECT p_name AS value, count(*) AS n,
           round(count(*) * 100.0 / (SELECT count(*) FROM part), 6) AS pct
    FROM part GROUP BY p_name ORDER BY n DESC, p_name LIMIT 15""")
def _(spark, sf):
    return rounded(frequency.top_k_values(table(spark, sf, "part"), "p_name", 15), "pct")


@query("top_k_entities", """
    SELECT o_custkey, count(*) AS records FROM orders GROUP BY o_custkey
    ORDER BY records DESC, o_custkey LIMIT 5""")
def _(spark, sf):
    return frequency.top_k_entities(table(spark, sf, "orders"), "o_custkey")


@query("records_per_entity", """
    SELECT count(*) AS entities, min(n) AS min_records, max(n) AS max_records,
           round(avg(n), 6) AS mean_records, median(n) AS median_records
    FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey)""")
def _(spark, sf):
    return rounded(frequency.records_per_entity(table(spark, sf, "orders"), "o_custkey"), "mean_records")


@query("count_of_counts", """
    WITH c AS (SELECT count(*) AS records FROM lineitem GROUP BY l_orderkey)
    SELECT records, count(*) AS entities,
           round(count(*) * 100.0 / (SELECT count(*) FROM c), 6) AS pct FROM c GROUP BY records""")
def _(spark, sf):
    return rounded(frequency.count_of_counts(table(spark, sf, "lineitem"), "l_orderkey"), "pct")


@query("duplicate_profile", """
    SELECT count(*) AS rows, count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicates,
           round((count(*) - count(DISTINCT (l_orderkey, l_linenumber))) * 100.0 / count(*), 6) AS pct
    FROM lineitem""")
def _(spark, sf):
    out = dedupe.duplicate_profile(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")
    return rounded(out, "pct")


@query("duplicate_rows_profile", """
    WITH d AS (SELECT DISTINCT user_id, event_type, props FROM events)
    SELECT (SELECT count(*) FROM events) AS rows,
           (SELECT count(*) FROM events) - count(*) AS duplicates,
           round(((SELECT count(*) FROM events) - count(*)) * 100.0 / (SELECT count(*) FROM events), 6) AS pct
    FROM d""")
def _(spark, sf):
    out = dedupe.duplicate_profile(table(spark, sf, "events").select("user_id", "event_type", "props"))
    return rounded(out, "pct")


@query("duplicate_examples", """
    SELECT text, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1
    ORDER BY n DESC, text LIMIT 10""")
def _(spark, sf):
    return dedupe.duplicate_examples(table(spark, sf, "documents"), "text")


@query("crosstab", """
    SELECT CASE WHEN grouping(p_type) = 1 THEN 'All' ELSE p_type END AS p_type,
           CASE WHEN grouping(p_name) = 1 THEN 'All' ELSE p_name END AS p_name, count(*) AS n
    FROM part GROUP BY CUBE (p_type, p_name)""")
def _(spark, sf):
    """Many values on one side: every part name."""
    return frequency.crosstab(table(spark, sf, "part"), "p_type", "p_name")


@query("crosstab_wide", """
    SELECT * FROM (
      SELECT coalesce(p_type, 'All') AS p_type,
             count(*) FILTER (WHERE half = 'large') AS large, count(*) FILTER (WHERE half = 'small') AS small,
             count(*) AS "All"
      FROM (SELECT p_type, CASE WHEN p_size > 25 THEN 'large' ELSE 'small' END AS half FROM part)
      GROUP BY ROLLUP (p_type))""")
def _(spark, sf):
    parts = table(spark, sf, "part").withColumn(
        "half", F.when(F.col("p_size") > 25, "large").otherwise("small")
    )
    return frequency.crosstab_wide(parts, "p_type", "half", ["large", "small"])


@query("crosstab_disability", f"""{with_cleaned('discapacidad')}
    SELECT coalesce(CAUSA, 'All') AS CAUSA, count(*) FILTER (WHERE band = '0') AS "0",
           count(*) FILTER (WHERE band = '1') AS "1", count(*) AS "All"
    FROM (SELECT CAUSA, CASE WHEN DSCORE < 50 THEN '0' ELSE '1' END AS band FROM discapacidad
          WHERE CAUSA IS NOT NULL AND DSCORE IS NOT NULL) GROUP BY ROLLUP (CAUSA)""")
def _(spark, sf):
    band = F.when(F.col("DSCORE") < 50, "0").when(F.col("DSCORE") >= 50, "1")
    banded = cleaned(spark, sf, "discapacidad").withColumn("band", band)
    return frequency.crosstab_wide(banded, "CAUSA", "band", ["0", "1"])


@query("count_distinct", """
    SELECT count(DISTINCT l_partkey) AS l_partkey, count(DISTINCT l_suppkey) AS l_suppkey FROM lineitem""")
def _(spark, sf):
    return profile.count_distinct(table(spark, sf, "lineitem"), "l_partkey", "l_suppkey")


# ---- statistics -----------------------------------------------------------

_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_linenumber")


def _describe_sql(source: str, columns) -> str:
    return " UNION ALL ".join(f"""
        SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean,
               round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min,
               round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS p25,
               round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS p50,
               round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS p75,
               CAST(max({c}) AS DOUBLE) AS max FROM {source}""" for c in columns)


@query("describe_numeric", _describe_sql("lineitem", _NUMBERS))
def _(spark, sf):
    out = stats.describe_numeric(table(spark, sf, "lineitem"), _NUMBERS)
    return rounded(rounded(out, "mean", "std", digits=4), "p25", "p50", "p75")


def _categorical_sql(source: str, columns) -> str:
    return " UNION ALL ".join(f"""
        SELECT '{c}' AS "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique",
               arg_min(v, (-n, v)) AS top, max(n) AS freq
        FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM {source}
              WHERE {c} IS NOT NULL GROUP BY 1)""" for c in columns)


@query("describe_categorical", _categorical_sql("part", ("p_name", "p_brand", "p_type")))
def _(spark, sf):
    return stats.describe_categorical(table(spark, sf, "part"), ["p_name", "p_brand", "p_type"])


@query("numeric_summary", """
    SELECT count(v) AS count, count(*) - count(v) AS nulls, min(v) AS min, max(v) AS max,
           round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, round(sum(v), 2) AS sum,
           round(median(v), 6) AS median
    FROM (SELECT CASE WHEN event_type <> 'error' THEN value END AS v FROM events)""")
def _(spark, sf):
    values = table(spark, sf, "events").select(
        F.when(F.col("event_type") != "error", F.col("value")).alias("v")
    )
    return rounded(rounded(stats.numeric_summary(values, "v"), "mean", "std", "median"), "sum", digits=2)


@query("group_stats", """
    SELECT event_type, round(avg(value), 2) AS mean, round(median(value), 2) AS median,
           round(stddev_samp(value), 2) AS std, count(value) AS count
    FROM events GROUP BY event_type""")
def _(spark, sf):
    return stats.group_stats(table(spark, sf, "events"), "event_type", "value")


@query("group_stats_by_customer", """
    SELECT o_custkey, round_even(avg(o_totalprice), 2) AS mean,
           round_even(stddev_samp(o_totalprice), 2) AS std,
           count(o_totalprice) AS count, median(o_orderkey) AS median_key
    FROM orders GROUP BY o_custkey""")
def _(spark, sf):
    orders = table(spark, sf, "orders")
    keys = stats.group_stats(orders, "o_custkey", "o_orderkey", 1, ["median"]).withColumnRenamed("median", "median_key")
    out = stats.group_stats(orders, "o_custkey", "o_totalprice", measures=["mean", "std", "count"])
    return out.join(keys, "o_custkey")


@query("text_length_stats", """
    SELECT 'lang' AS "column", min(length(lang)) AS min_length, max(length(lang)) AS max_length,
           round(avg(length(lang)), 6) AS mean_length, median(length(lang)) AS median_length FROM documents
    UNION ALL SELECT 'text', min(length(text)), max(length(text)), round(avg(length(text)), 6),
           median(length(text)) FROM documents""")
def _(spark, sf):
    return rounded(stats.text_length_stats(table(spark, sf, "documents"), ["lang", "text"]), "mean_length")


@query("text_length_stats_null_as_zero", """
    SELECT 'kind' AS "column", min(n) AS min_length, max(n) AS max_length, round(avg(n), 6) AS mean_length,
           median(n) AS median_length
    FROM (SELECT length(coalesce(nullif(event_type, 'error'), '')) AS n FROM events)""")
def _(spark, sf):
    return rounded(stats.text_length_stats(_events(spark, sf), ["kind"], null_as_zero=True), "mean_length")


@query("date_profile", """
    SELECT 'o_orderdate' AS "column", count(o_orderdate) AS non_null,
           count(*) - count(o_orderdate) AS nulls, CAST(min(o_orderdate) AS VARCHAR) AS min,
           CAST(max(o_orderdate) AS VARCHAR) AS max, count(DISTINCT o_orderdate) AS "distinct" FROM orders
    UNION ALL SELECT 'open_date', count(d), count(*) - count(d), CAST(min(d) AS VARCHAR),
           CAST(max(d) AS VARCHAR), count(DISTINCT d)
    FROM (SELECT CASE WHEN o_orderstatus = 'O' THEN o_orderdate END AS d FROM orders)""")
def _(spark, sf):
    orders = table(spark, sf, "orders").withColumn(
        "open_date", F.when(F.col("o_orderstatus") == "O", F.col("o_orderdate"))
    )
    return stats.date_profile(orders, ["o_orderdate", "open_date"])


@query("histogram", """
    WITH b AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
    k AS (SELECT least(floor((l_extendedprice - lo) / (hi - lo) * 30), 29) AS k, l_extendedprice AS x, lo,
                 (hi - lo) / 30 AS step FROM lineitem, b),
    c AS (SELECT CAST(k - CASE WHEN x < lo + k * step THEN 1 ELSE 0 END
                   + CASE WHEN k < 29 AND x >= lo + (k + 1) * step THEN 1 ELSE 0 END AS INTEGER) AS bin,
                 count(*) AS n FROM k GROUP BY 1)
    SELECT CAST(i AS INTEGER) AS bin, round(lo + i * (hi - lo) / 30, 4) AS bin_start,
           round(lo + (i + 1) * (hi - lo) / 30, 4) AS bin_end, coalesce(n, 0) AS n
    FROM b, range(30) t(i) LEFT JOIN c ON c.bin = i""")
def _(spark, sf):
    out = stats.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 30)
    return rounded(out, "bin_start", "bin_end", digits=4)


def _box_sql(group: str, source: str, x: str) -> str:
    return f"""
    WITH q AS (SELECT {group} AS "group", quantile_cont({x}, 0.25) AS q1, median({x}) AS median,
                      quantile_cont({x}, 0.75) AS q3 FROM {source} GROUP BY 1)
    SELECT q."group", round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
           min(x) FILTER (WHERE x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
           max(x) FILTER (WHERE x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
           count(*) FILTER (WHERE x NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers,
           count(*) AS count
    FROM q JOIN (SELECT {group} AS g, {x} AS x FROM {source}) ON g = q."group"
    GROUP BY q."group", q1, median, q3"""


@query("box_stats", _box_sql("event_type", "(SELECT event_type, value * value AS v FROM events)", "v"))
def _(spark, sf):
    events = table(spark, sf, "events").select("event_type", (F.col("value") * F.col("value")).alias("v"))
    return rounded(stats.box_stats(events, "v", "event_type"), "q1", "median", "q3")


@query("box_stats_overall", _box_sql("'all'", "lineitem", "l_extendedprice"))
def _(spark, sf):
    out = stats.box_stats(table(spark, sf, "lineitem"), "l_extendedprice")
    return rounded(out, "q1", "median", "q3")


# ---- whole-table profiles -------------------------------------------------

_PROFILED = ("event_id", "user_id", "event_type", "value", "props", "kind")


@query("null_profile", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count({c}) AS nulls,
        round((count(*) - count({c})) * 100.0 / count(*), 6) AS pct FROM {_EVENTS}"""
    for c in _PROFILED))
def _(spark, sf):
    return rounded(profile.null_profile(_events(spark, sf).select(*_PROFILED)), "pct")


_TYPES = {"event_id": "bigint", "user_id": "bigint", "value": "double"}


def _cardinality_sql(where: str = "") -> str:
    union = " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{_TYPES.get(c, 'string')}' AS type, count(DISTINCT {c}) AS "distinct",
            round(count(DISTINCT {c}) * 100.0 / count(*), 6) AS pct FROM {_EVENTS}""" for c in _PROFILED)
    return f"SELECT * FROM ({union}) {where}"


@query("cardinality_profile", _cardinality_sql())
def _(spark, sf):
    return rounded(profile.cardinality_profile(_events(spark, sf).select(*_PROFILED)), "pct")


@query("low_variability_columns", _cardinality_sql('WHERE "distinct" > 1 AND pct < 1'))
def _(spark, sf):
    return rounded(profile.low_variability_columns(_events(spark, sf).select(*_PROFILED)), "pct")


@query("blank_profile", """
    SELECT 'lang' AS "column", count(*) FILTER (WHERE lang = 'de') AS blanks,
           round(count(*) FILTER (WHERE lang = 'de') * 100.0 / count(*), 6) AS pct FROM documents
    UNION ALL SELECT 'source', 0, 0.0""")
def _(spark, sf):
    documents = table(spark, sf, "documents").select(
        F.when(F.col("lang") == "de", " \t ").otherwise(F.col("lang")).alias("lang"), "source"
    )
    return rounded(profile.blank_profile(documents), "pct")


@query("cleaning_report", f"""
    WITH kept AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
    SELECT 'lineitem' AS dataset, (SELECT count(*) FROM lineitem) AS registros_originales,
           count(*) AS registros_finales, (SELECT count(*) FROM lineitem) - count(*) AS registros_eliminados,
           round(count(*) * 100.0 / (SELECT count(*) FROM lineitem), 6) AS porcentaje_retenido,
           11 AS columnas FROM kept""")
def _(spark, sf):
    lines = table(spark, sf, "lineitem")
    kept = dedupe.dedupe_keep_first(lines, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])
    return rounded(profile.cleaning_report(lines, kept, "lineitem"), "porcentaje_retenido")


@query("dataset_summary", """
    SELECT 'orders' AS name, count(*) AS rows, 6 AS n_columns,
           'o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority' AS columns
    FROM orders UNION ALL
    SELECT 'labels', count(*), 3, 'doc_id, quality, toxic' FROM labels""")
def _(spark, sf):
    return profile.dataset_summary({n: table(spark, sf, n) for n in ("orders", "labels")})
