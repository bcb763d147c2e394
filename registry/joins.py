"""Key lookups, orphans, attribute joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import query, table
from tamiz.operators import joins, orphans
from tamiz.operators.keys import assign_surrogate_key
from tamiz.plans.dimensions import build_calendar, build_dimension


def _labels(spark, sf):
    return assign_surrogate_key(table(spark, sf, "labels").select("doc_id", "quality"), "label_sk", ["doc_id"])


_LABELS = "(SELECT row_number() OVER (ORDER BY doc_id) AS label_sk, doc_id FROM labels)"


@query("lookup_key_left", f"""
    SELECT d.doc_id, d.source, coalesce(label_sk, -1) AS label_sk
    FROM documents d LEFT JOIN {_LABELS} l ON l.doc_id = d.doc_id""")
def _(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "source")
    return joins.lookup_key(documents, _labels(spark, sf), "doc_id", "doc_id", "label_sk", default_sk=-1)


@query("lookup_key_inner", f"""
    SELECT d.doc_id, d.source, label_sk FROM documents d JOIN {_LABELS} l ON l.doc_id = d.doc_id""")
def _(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "source")
    return joins.lookup_key(documents, _labels(spark, sf), "doc_id", "doc_id", "label_sk", "inner")


@query("lookup_key_null_safe", """
    WITH e AS (SELECT event_id, nullif(event_type, 'error') AS kind FROM events),
    d AS (SELECT row_number() OVER (ORDER BY kind NULLS LAST) AS kind_sk, kind FROM e GROUP BY kind)
    SELECT event_id, kind_sk FROM e JOIN d ON e.kind IS NOT DISTINCT FROM d.kind""")
def _(spark, sf):
    events = table(spark, sf, "events").select("event_id", F.nullif("event_type", F.lit("error")).alias("kind"))
    kinds = build_dimension(events, "kind", (), "kind_sk", keep_null_member=True)
    return joins.lookup_key(events, kinds, "kind", "kind", "kind_sk", "inner", null_safe=True).select(
        "event_id", "kind_sk"
    )


@query("lookup_date_key", """
    WITH d AS (SELECT row_number() OVER (ORDER BY d) AS fecha_sk, d FROM (
        SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders))
    SELECT l_orderkey, l_linenumber, l_partkey, coalesce(fecha_sk, 1) AS ship_sk
    FROM lineitem LEFT JOIN d ON d = CAST(l_shipdate AS DATE)""")
def _(spark, sf):
    days = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("fecha")).distinct()
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    return joins.lookup_date_key(lines, build_calendar(days), "l_shipdate", "ship_sk").drop("l_shipdate")


@query("attach_attributes", """
    SELECT user_id, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
    WHERE rn = 1""")
def _(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_type", "value", "ts", "event_id")
    keys = events.select("user_id").distinct()
    order = F.struct("ts", "event_id")
    return joins.attach_attributes(keys, events, "user_id", order).drop("ts", "event_id")


@query("attach_group_attribute", """
    SELECT c_custkey, c_name, status FROM customer LEFT JOIN (
      SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS status FROM orders
      WHERE o_orderstatus = 'P' GROUP BY o_custkey) ON o_custkey = c_custkey""")
def _(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).alias("status")
    )
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    return joins.attach_group_attribute(customers, orders, "c_custkey", "o_custkey", "status", "o_orderkey")


@query("orphan_keys", """
    SELECT DISTINCT doc_id FROM documents d
    WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def _(spark, sf):
    return joins.orphan_keys(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")


@query("matching_keys", """
    SELECT DISTINCT l_orderkey FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def _(spark, sf):
    closed = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
    return joins.matching_keys(table(spark, sf, "lineitem"), closed, "l_orderkey", "o_orderkey")


@query("orphan_stats", """
    SELECT count(*) FILTER (WHERE l.doc_id IS NULL) AS orphans, count(*) AS total,
           round(count(*) FILTER (WHERE l.doc_id IS NULL) * 100.0 / count(*), 6) AS pct,
           count(*) FILTER (WHERE l.doc_id IS NULL) * 100.0 / count(*) <= 5 AS ok
    FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def _(spark, sf):
    out = orphans.orphan_stats(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")
    return out.withColumn("pct", F.round("pct", 6))


@query("reconcile_orphans", """
    SELECT doc_id, quality, toxic FROM labels UNION ALL
    SELECT DISTINCT doc_id, -1, 0 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def _(spark, sf):
    return orphans.reconcile_orphans(
        table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id",
        {"quality": -1, "toxic": 0, "absent": "x"},
    )
