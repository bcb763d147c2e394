"""Filters, distinct rows, samples, stacked sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import query, table
from registry.bindings import raw, raw_sql
from tamiz.operators import dedupe, filters, sampling, sets

_KIND = "nullif(event_type, 'error')"


def _events(spark, sf):
    """Events whose type is missing for errors and whose value is missing below 5."""
    return table(spark, sf, "events").select(
        "event_id", "user_id", F.nullif("event_type", F.lit("error")).alias("kind"),
        F.when(F.col("value") >= 5, F.col("value")).alias("value"),
    )


_EVENTS = f"""(SELECT event_id, user_id, {_KIND} AS kind, CASE WHEN value >= 5 THEN value END AS value
    FROM events)"""


@query("drop_null_keys", f"SELECT * FROM {_EVENTS} WHERE kind IS NOT NULL")
def _(spark, sf):
    return filters.drop_null_keys(_events(spark, sf), "kind")


@query("filter_range", "SELECT p_partkey, p_size FROM part WHERE p_size BETWEEN 16 AND 40")
def _(spark, sf):
    return filters.filter_range(table(spark, sf, "part"), "p_size", 16, 40).select("p_partkey", "p_size")


@query("drop_all_null_rows", f"""
    SELECT kind, value, count(*) AS n FROM {_EVENTS}
    WHERE kind IS NOT NULL OR value IS NOT NULL GROUP BY kind, value""")
def _(spark, sf):
    rows = filters.drop_all_null_rows(_events(spark, sf).select("kind", "value"))
    return rows.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n"))


@query("all_null_row_report", f"""
    SELECT count(*) AS rows, count(*) FILTER (WHERE kind IS NULL AND value IS NULL) AS all_null_rows
    FROM {_EVENTS}""")
def _(spark, sf):
    return filters.all_null_row_report(_events(spark, sf).select("kind", "value"))


@query("drop_any_null", f"SELECT * FROM {_EVENTS} WHERE kind IS NOT NULL AND value IS NOT NULL")
def _(spark, sf):
    return filters.drop_any_null(_events(spark, sf))


@query("filter_valid_values", """
    SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderpriority END
      AS o_orderpriority FROM orders""")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return filters.filter_valid_values(orders, "o_orderpriority", ["1-URGENT", "2-HIGH"])


@query("filter_positive_duration", """
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(days AS INTEGER) AS days, months FROM (
      SELECT *, round(days / 30.44, 1) AS months FROM (
        SELECT l_orderkey, l_linenumber, l_partkey,
               date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS days
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey)) WHERE days > 0 AND months <= 2""")
def _(spark, sf):
    from tamiz.functions import duration_days, duration_months

    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    spans = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        "l_orderkey", "l_linenumber", "l_partkey",
        duration_days(F.col("o_orderdate"), F.col("l_shipdate")).alias("days"),
    ).withColumn("months", duration_months(F.col("days")))
    return filters.filter_positive_duration(spans, "days", "months", 2)


@query("filter_plausible_experience", f"""
    SELECT AVISOID, _row_order, try_cast(TIEMPOEXPERIENCIA AS DOUBLE) AS TIEMPOEXPERIENCIA
    FROM ({raw_sql('vacantes')}) WHERE try_cast(TIEMPOEXPERIENCIA AS DOUBLE) BETWEEN 0 AND 30""")
def _(spark, sf):
    vacancies = raw(spark, sf, "vacantes").select("AVISOID", "_row_order", "TIEMPOEXPERIENCIA")
    return filters.filter_plausible_experience(vacancies, "TIEMPOEXPERIENCIA", 0, 30)


@query("experience_conversion_report", f"""
    SELECT count(*) AS rows, count(*) FILTER (WHERE t IS NULL) AS unconvertible,
           count(*) FILTER (WHERE t BETWEEN 0 AND 30) AS plausible
    FROM (SELECT try_cast(TIEMPOEXPERIENCIA AS DOUBLE) AS t FROM ({raw_sql('vacantes')}))""")
def _(spark, sf):
    return filters.experience_conversion_report(raw(spark, sf, "vacantes"), "TIEMPOEXPERIENCIA", 0, 30)


@query("count_where", f"""
    SELECT count(*) AS rows, count(*) FILTER (WHERE ESPCD = 'SI') AS matching,
           round(count(*) FILTER (WHERE ESPCD = 'SI') * 100.0 / count(*), 6) AS pct
    FROM (SELECT CASE o_orderstatus WHEN 'O' THEN 'SI' ELSE 'NO' END AS ESPCD FROM orders)""")
def _(spark, sf):
    orders = table(spark, sf, "orders")
    flag = F.when(F.col("o_orderstatus") == "O", "SI").otherwise("NO")
    return filters.count_where(orders, flag == "SI").withColumn("pct", F.round("pct", 6))


@query("numeric_cleaning_report", """
    SELECT count(*) AS rows, count(*) FILTER (WHERE n IS NULL) AS nulls,
           count(*) FILTER (WHERE n NOT BETWEEN 10 AND 60) AS out_of_range
    FROM (SELECT CASE WHEN event_type = 'error' THEN NULL ELSE value END AS n FROM events)""")
def _(spark, sf):
    events = table(spark, sf, "events").select(
        F.when(F.col("event_type") == "error", "n.d.").otherwise(F.col("value").cast("string")).alias("n")
    )
    return filters.numeric_cleaning_report(events, "n", (10, 60))


# ---- distinct rows --------------------------------------------------------

_LINE = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate"


@query("dedupe_keep_first", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE}) AS rn
      FROM lineitem) WHERE rn = 1""")
def _(spark, sf):
    out = dedupe.dedupe_keep_first(
        table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], _LINE.split(", ")
    )
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@query("validate_primary_key", f"""
    SELECT user_key, event_id FROM (
      SELECT user_id AS user_key, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
      FROM events WHERE event_type <> 'error') WHERE rn = 1""")
def _(spark, sf):
    events = table(spark, sf, "events").select(
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_key"), "event_id", "ts"
    )
    return dedupe.validate_primary_key(events, "user_key", ["ts", "event_id"]).select("user_key", "event_id")


@query("primary_key_report", """
    WITH k AS (SELECT CASE WHEN event_type <> 'error' THEN user_id END AS user_key FROM events)
    SELECT count(*) AS rows, count(*) FILTER (WHERE user_key IS NULL) AS null_keys,
           count(*) - (SELECT count(*) FROM (SELECT DISTINCT user_key FROM k)) AS duplicates FROM k""")
def _(spark, sf):
    events = table(spark, sf, "events").select(
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_key")
    )
    return dedupe.primary_key_report(events, "user_key")


@query("drop_exact_duplicates", "SELECT DISTINCT lang, source, text FROM documents")
def _(spark, sf):
    return dedupe.drop_exact_duplicates(table(spark, sf, "documents").select("lang", "source", "text"))


@query("drop_exact_duplicates_keep_order", """
    SELECT user_id, event_type, props, min(event_id) AS event_id FROM events
    GROUP BY user_id, event_type, props""")
def _(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_type", "props", "event_id")
    return dedupe.drop_exact_duplicates(events, "event_id")


@query("distinct_values", f"SELECT DISTINCT kind FROM {_EVENTS}")
def _(spark, sf):
    return dedupe.distinct_values(_events(spark, sf), "kind")


@query("distinct_values_not_null", f"SELECT DISTINCT kind FROM {_EVENTS} WHERE kind IS NOT NULL")
def _(spark, sf):
    return dedupe.distinct_values(_events(spark, sf), "kind", keep_null=False)


@query("first_non_null", f"""
    SELECT user_id, arg_min(kind, event_id) AS kind FROM {_EVENTS} WHERE kind IS NOT NULL GROUP BY user_id""")
def _(spark, sf):
    return dedupe.first_non_null(_events(spark, sf), "user_id", "kind", "event_id")


@query("first_per_key", """
    SELECT code, name, source FROM (
      SELECT *, row_number() OVER (PARTITION BY code ORDER BY src, id) AS rn FROM (
        SELECT c_nationkey AS code, c_name AS name, 'customer' AS source, 0 AS src, c_custkey AS id FROM customer
        UNION ALL SELECT s_nationkey, s_name, 'supplier', 1, s_suppkey FROM supplier)) WHERE rn = 1""")
def _(spark, sf):
    stacked = sets.union_sources(_named_sources(spark, sf), ["code", "name", "id"], "source")
    first = dedupe.first_per_key(stacked, ["code"], F.col("source_rank"), "id")
    return first.select("code", "name", "source")


def _named_sources(spark, sf):
    return {
        "customer": table(spark, sf, "customer").selectExpr(
            "c_nationkey as code", "c_name as name", "c_custkey as id"),
        "supplier": table(spark, sf, "supplier").selectExpr(
            "s_nationkey as code", "s_name as name", "s_suppkey as id"),
    }


@query("union_sources", """
    SELECT c_nationkey AS code, c_name AS name, c_custkey AS id, 'customer' AS source,
           0 AS source_rank FROM customer UNION ALL
    SELECT s_nationkey, s_name, s_suppkey, 'supplier', 1 FROM supplier""")
def _(spark, sf):
    return sets.union_sources(_named_sources(spark, sf), ["code", "name", "id"], "source")


@query("union_all_dates", """
    SELECT CAST(d AS VARCHAR) AS fecha, count(*) AS n FROM (
      SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION ALL
      SELECT CAST(l_shipdate AS DATE) FROM lineitem UNION ALL
      SELECT CAST(ts AS DATE) FROM events) GROUP BY 1""")
def _(spark, sf):
    days = sets.union_all_dates([
        (table(spark, sf, "orders"), ["o_orderdate", "o_missing"]),
        (table(spark, sf, "lineitem"), ["l_shipdate"]), (table(spark, sf, "events"), ["ts"]),
    ])
    return days.groupBy(F.col("fecha").cast("string").alias("fecha")).agg(F.count(F.lit(1)).alias("n"))


@query("append_placeholders", """
    SELECT r_regionkey, r_name FROM region UNION ALL
    SELECT DISTINCT 100 + n_nationkey, CAST(NULL AS VARCHAR) FROM nation""")
def _(spark, sf):
    extra = table(spark, sf, "nation").select((F.col("n_nationkey") + 100).alias("r_regionkey"))
    return sets.append_placeholders(table(spark, sf, "region"), extra)


@query("key_difference", """
    SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels""")
def _(spark, sf):
    return sets.key_difference(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")


# ---- order and samples ----------------------------------------------------

@query("head", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 10")
def _(spark, sf):
    return sampling.head(table(spark, sf, "orders"), ["o_orderkey"], 10).select("o_orderkey", "o_custkey")


@query("tail", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey DESC LIMIT 10")
def _(spark, sf):
    return sampling.tail(table(spark, sf, "orders"), ["o_orderkey"], 10).select("o_orderkey", "o_custkey")


@query("sample_n", """
    SELECT o_orderkey, o_totalprice FROM orders
    ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '-42'), o_orderkey LIMIT 25""")
def _(spark, sf):
    return sampling.sample_n(table(spark, sf, "orders"), "o_orderkey", 25).select("o_orderkey", "o_totalprice")


@query("sorted_unique_dates", """
    SELECT CAST(d AS VARCHAR) AS day FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events) ORDER BY d""")
def _(spark, sf):
    days = sampling.sorted_unique_dates(table(spark, sf, "events"), "ts")
    return days.select(F.col("ts").cast("string").alias("day"))
