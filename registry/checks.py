"""Data-quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import query, table
from registry.warehouse import constellation_sql, full
from tamiz.operators import quality
from tamiz.operators.keys import assign_surrogate_key
from tamiz.plans.constellation import constraint_reports
from tamiz.schemas import WAREHOUSE, references


@query("check_surrogate_keys", """
    SELECT 'customer' AS "table", 'customer_sk' AS "column", count(*) AS rows, 0::BIGINT AS duplicates,
           0::BIGINT AS nulls, true AS ok FROM customer UNION ALL
    SELECT 'nation', 'nation_sk', count(*), count(*) - count(DISTINCT n_regionkey),
           count(*) FILTER (WHERE n_regionkey IS NULL), false FROM nation""")
def _(spark, sf):
    customers = assign_surrogate_key(table(spark, sf, "customer").select("c_custkey"), "customer_sk", ["c_custkey"])
    nations = table(spark, sf, "nation").select(F.col("n_regionkey").alias("nation_sk"), "n_name")
    return quality.check_surrogate_keys({"customer": customers, "nation": nations})


@query("check_foreign_key_nulls", """
    WITH f AS (SELECT o_custkey AS customer_sk, CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS order_sk
               FROM orders)
    SELECT 'orders' AS "table", 'customer_sk' AS "column", count(*) AS rows,
           count(*) - count(customer_sk) AS nulls, 0.0::DOUBLE AS pct, true AS ok FROM f UNION ALL
    SELECT 'orders', 'order_sk', count(*), count(*) - count(order_sk),
           round((count(*) - count(order_sk)) * 100.0 / count(*), 6),
           (count(*) - count(order_sk)) * 100.0 / count(*) < 10 FROM f""")
def _(spark, sf):
    fact = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("customer_sk"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("order_sk"),
    )
    return quality.check_foreign_key_nulls({"orders": fact}).withColumn("pct", F.round("pct", 6))


@query("check_referential_integrity", """
    SELECT 'lineitem' AS fact, 'l_orderkey' AS "column", 'orders' AS dimension,
           count(DISTINCT l_orderkey) AS distinct_keys,
           count(DISTINCT l_orderkey) FILTER (WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS orphans,
           count(*) FILTER (WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)) = 0 AS ok
    FROM lineitem UNION ALL
    SELECT 'documents', 'doc_id', 'labels', count(DISTINCT doc_id),
           count(DISTINCT doc_id) FILTER (WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
           count(*) FILTER (WHERE doc_id NOT IN (SELECT doc_id FROM labels)) = 0 FROM documents""")
def _(spark, sf):
    named = lambda *names: {n: table(spark, sf, n) for n in names}
    return quality.check_referential_integrity(
        named("lineitem", "documents"), named("orders", "labels"),
        [("lineitem", "l_orderkey", "orders", "o_orderkey"), ("documents", "doc_id", "labels", "doc_id")],
    )


@query("check_not_null", """
    SELECT 'events' AS "table", 'event_id' AS "column", 0::BIGINT AS nulls, true AS ok UNION ALL
    SELECT 'events', 'kind', count(*) FILTER (WHERE event_type = 'error'), false FROM events""")
def _(spark, sf):
    events = table(spark, sf, "events").withColumn("kind", F.nullif("event_type", F.lit("error")))
    return quality.check_not_null(events, "events", ["event_id", "kind"])


@query("check_unique", """
    SELECT 'orders' AS "table", 'o_orderkey' AS "column",
           count(*) - count(DISTINCT o_orderkey) AS duplicates, true AS ok FROM orders UNION ALL
    SELECT 'orders', 'o_custkey', count(*) - count(DISTINCT o_custkey), false FROM orders""")
def _(spark, sf):
    return quality.check_unique(table(spark, sf, "orders"), "orders", ["o_orderkey", "o_custkey"])


@query("check_max_length", """
    SELECT 'documents' AS "table", 'text' AS "column", 2000 AS "limit",
           CAST(max(length(text)) AS INTEGER) AS longest, count(*) FILTER (WHERE length(text) > 2000) AS too_long,
           max(length(text)) <= 2000 AS ok FROM documents UNION ALL
    SELECT 'documents', 'lang', 10, CAST(max(length(lang)) AS INTEGER),
           count(*) FILTER (WHERE length(lang) > 10), max(length(lang)) <= 10 FROM documents""")
def _(spark, sf):
    return quality.check_max_length(table(spark, sf, "documents"), "documents", {"text": 2000, "lang": 10})


@query("apply_defaults", """
    SELECT o_orderkey, coalesce(nullif(o_orderpriority, '5-LOW'), 'SIN_ESPECIFICAR') AS o_orderpriority,
           true AS activo FROM orders""")
def _(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority")
    )
    return quality.apply_defaults(orders, {"o_orderpriority": "SIN_ESPECIFICAR", "activo": True})


@query("assert_unique_not_null", "SELECT c_custkey, c_name FROM customer")
def _(spark, sf):
    return quality.assert_unique_not_null(table(spark, sf, "customer").select("c_custkey", "c_name"), "c_custkey", "c_name")


@query("check_non_empty", """
    SELECT 'orders' AS name, count(*) AS rows, true AS present, count(*) > 0 AS ok FROM orders UNION ALL
    SELECT 'expensive', count(*), true, count(*) > 0 FROM orders WHERE o_totalprice > 1e12 UNION ALL
    SELECT 'absent', 0, false, false""")
def _(spark, sf):
    orders = table(spark, sf, "orders")
    tables = {"orders": orders, "expensive": orders.filter("o_totalprice > 1e12")}
    return quality.check_non_empty(tables, ["orders", "expensive", "absent"])


@query("check_expected_total", """
    SELECT (SELECT count(*) FROM orders) + (SELECT count(*) FROM part) AS total, 17000::BIGINT AS expected,
           (SELECT count(*) FROM orders) + (SELECT count(*) FROM part) - 17000 AS difference,
           abs((SELECT count(*) FROM orders) + (SELECT count(*) FROM part) - 17000) <= 100 AS ok""")
def _(spark, sf):
    from tamiz.operators.profile import table_counts

    counts = table_counts({n: table(spark, sf, n) for n in ("orders", "part")})
    return quality.check_expected_total(counts, 17000)


# ---- the built warehouse --------------------------------------------------

def _references_sql() -> str:
    parts = []
    for fact, column, dim, key in references():
        orphan = f"{column} NOT IN (SELECT {key} FROM {dim})"
        parts.append(f"""SELECT '{fact}' AS fact, '{column}' AS "column", '{dim}' AS dimension,
            count(DISTINCT {column}) AS distinct_keys, count(DISTINCT {column}) FILTER (WHERE {orphan}) AS orphans,
            count(DISTINCT {column}) FILTER (WHERE {orphan}) = 0 AS ok FROM {fact}""")
    return f"{constellation_sql()} " + " UNION ALL ".join(parts)


@query("constellation_references", _references_sql())
def _(spark, sf):
    w = full(spark, sf).stored()
    return quality.check_referential_integrity(w.facts, w.dimensions, references())


def _not_null_sql() -> str:
    parts = []
    for name, t in WAREHOUSE.items():
        for c in t.names(not_null=True):
            parts.append(f"""SELECT '{name}' AS "table", '{c}' AS "column",
                count(*) FILTER (WHERE {c} IS NULL) AS nulls, count(*) FILTER (WHERE {c} IS NULL) = 0 AS ok
                FROM {name}""")
    return f"{constellation_sql()} " + " UNION ALL ".join(parts)


@query("constellation_not_null", _not_null_sql())
def _(spark, sf):
    return constraint_reports(full(spark, sf).stored().tables)["not_null"]
