"""Files, zones and the warehouse catalog: written, read back and compared."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from registry.base import query, table
from registry.bindings import stored, with_cleaned
from registry.loads import _final_sql, _warehouse_sql, contents, contents_sql, unknown_member
from registry.warehouse import DATASETS
from tamiz.operators.profile import dataset_summary
from tamiz.operators.quality import check_expected_total
from tamiz.schemas import LOAD_ORDER, WAREHOUSE, conform, conform_rejects
from tamiz.session import fresh_path
from tamiz.sources import warehouse as w
from tamiz.sources.csv import normalize_null_tokens, read_raw_csv
from tamiz.sources.zones import load_zone, write_cleaned, write_integrated


@query("read_raw_csv", """
    SELECT CAST(p_partkey AS VARCHAR) AS "P_PARTKEY", p_name || ', "' || p_type || '"' AS "NAME",
           nullif(p_brand, 'Brand#2') AS "BRAND" FROM part""")
def _(spark, sf):
    """Quoted commas and quotes, and a missing-value text in one brand."""
    path = fresh_path(spark, "csv")
    table(spark, sf, "part").select(
        "p_partkey", F.concat("p_name", F.lit(', "'), "p_type", F.lit('"')).alias(" name"),
        F.when(F.col("p_brand") == "Brand#2", "N/A").otherwise(F.col("p_brand")).alias("brand "),
    ).write.option("header", True).option("escape", '"').csv(path)
    return read_raw_csv(spark, path)


@query("read_raw_csv_multiline", """
    SELECT CAST(doc_id AS VARCHAR) AS "DOC_ID", md5(text) AS digest FROM documents""")
def _(spark, sf):
    """Whole texts with line breaks inside quoted cells."""
    path = fresh_path(spark, "csv")
    table(spark, sf, "documents").select("doc_id", "text").write.options(
        header=True, escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)
    return read_raw_csv(spark, path).select("DOC_ID", F.md5("TEXT").alias("digest"))


@query("read_raw_csv_encoding", r"""
    SELECT CAST(conv_id AS VARCHAR) AS "CONV_ID", CAST(turn AS VARCHAR) AS "TURN",
           md5(regexp_replace(text, '[^\x00-\xFF]', '.', 'g')) AS digest FROM conversations""")
def _(spark, sf):
    """Latin-1 files with line breaks in cells, found not to be UTF-8 and read again."""
    path = fresh_path(spark, "csv")
    table(spark, sf, "conversations").select(
        "conv_id", "turn", F.regexp_replace("text", r"[^\x00-\xFF]", ".").alias("text")
    ).write.options(
        header=True, escape='"', quoteAll=True, encoding="ISO-8859-1",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)
    out = read_raw_csv(spark, path, encodings=("UTF-8", "ISO-8859-1"))
    return out.select("CONV_ID", "TURN", F.md5("TEXT").alias("digest"))


@query("read_raw_csv_bad_lines", """
    SELECT CAST(c_custkey AS VARCHAR) AS "ID", c_name AS "NAME",
           nullif(c_mktsegment, 'MACHINERY') AS "SEGMENT" FROM customer WHERE c_mktsegment <> 'BUILDING'""")
def _(spark, sf):
    """Lines with a cell too many are left out, lines that stop early are padded."""
    path = fresh_path(spark, "csv")
    segment = F.col("c_mktsegment")
    start = F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name")
    line = (
        F.when(segment == "BUILDING", F.concat(start, F.lit(",x,")))
        .when(segment == "MACHINERY", start).otherwise(F.concat_ws(",", start, segment))
    )
    # The separator of the writer occurs nowhere, so lines and header are written as they are.
    table(spark, sf, "customer").select(line.alias("ÿid,name,segment")).write.options(
        header=True, sep="\u0001", encoding="ISO-8859-1"
    ).csv(path)
    return read_raw_csv(
        spark, path, encodings=["ISO-8859-1"], bad_lines="skip", remove_from_header="ÿŸ"
    )


@query("normalize_null_tokens", """
    SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'click' THEN NULL ELSE event_type END AS kind
    FROM events""")
def _(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") == "error", "#N/A").when(F.col("event_type") == "click", "")
        .otherwise(F.col("event_type")).alias("kind")
    )
    return normalize_null_tokens(events)


@query("write_cleaned", """
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS VARCHAR) AS ship FROM lineitem""")
def _(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("helper", F.lit(1))
    folder = fresh_path(spark, "zone")
    path = write_cleaned(lines, folder, "lineitem_clean", drop=["helper"])
    return spark.read.parquet(path).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").cast("string").alias("ship")
    )


@query("load_zone", """
    SELECT 'orders' AS name, count(*) AS rows, 6 AS n_columns FROM orders UNION ALL
    SELECT 'customers', count(*), 5 FROM customer""")
def _(spark, sf):
    folder = fresh_path(spark, "zone")
    write_cleaned(table(spark, sf, "orders"), folder, "orders_clean")
    write_cleaned(table(spark, sf, "customer"), folder, "customers_clean")
    zone = load_zone(spark, folder, {"orders": "orders_clean", "customers": "customers_clean"})
    return dataset_summary(zone).drop("columns")


@query("write_integrated", contents_sql(1))
def _(spark, sf):
    """The 13 tables written to a zone and compared row by row there."""
    built = unknown_member(spark, sf)
    folder = fresh_path(spark, "integrated")
    write_integrated({n: conform(df, WAREHOUSE[n]) for n, df in built.tables.items()}, folder)
    return contents(load_zone(spark, folder, LOAD_ORDER))


def _loaded(spark, sf) -> str:
    """A new database with the 13 tables, and one more; each query loads its own, whatever ran before it."""
    name = f"dw_{uuid.uuid4().hex[:12]}"
    w.create_tables(spark, name, fresh_path(spark, name))
    w.load_warehouse(spark, name, unknown_member(spark, sf).tables)
    table(spark, sf, "orders").write.saveAsTable(f"{name}.notas")
    return name


@query("load_warehouse", contents_sql(1))
def _(spark, sf):
    """The 13 tables created, checked by all rules, loaded in order and compared row by row in the catalog."""
    name = _loaded(spark, sf)
    return contents({n: spark.table(f"{name}.{n}") for n in LOAD_ORDER})


def _counts_sql() -> str:
    parts = [
        f"""SELECT '{n}' AS "table", '{t.kind}' AS kind, count(*) AS rows FROM ({_final_sql(n)})""" for n, t in WAREHOUSE.items()
    ]
    return f"""{_warehouse_sql(1)}, counts AS ({' UNION ALL '.join(parts)}
        UNION ALL SELECT 'notas', 'Other', count(*) FROM orders)"""


@query("conform_rejects", """
    SELECT 'dim_vacante' AS "table", c AS "column", n AS rejects FROM (
      SELECT 'vacante_sk' AS c, count(*) FILTER (WHERE o_orderkey % 10 = 3) AS n FROM orders UNION ALL
      SELECT 'num_vacantes', count(*) FILTER (WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')) FROM orders)""")
def _(spark, sf):
    """Keys that are no numbers; counts with a fraction or beyond the type."""
    priority = F.col("o_orderpriority")
    key = F.when(F.col("o_orderkey") % 10 == 3, F.concat(F.lit("x"), F.col("o_orderkey")))
    count = F.when(priority == "1-URGENT", "3.7").when(priority == "2-HIGH", "9999999999").otherwise("12")
    rows = table(spark, sf, "orders").select(
        F.coalesce(key, F.col("o_orderkey").cast("string")).alias("vacante_sk"), count.alias("num_vacantes")
    )
    return conform_rejects(rows, WAREHOUSE["dim_vacante"])


@query("table_stats", f"{_counts_sql()} SELECT * FROM counts")
def _(spark, sf):
    return w.table_stats(spark, _loaded(spark, sf))


@query("validate_warehouse_structure", f"""{_counts_sql()}
    SELECT "table", CASE WHEN kind = 'Other' THEN 'extra' ELSE 'found' END AS status, kind <> 'Other' AS ok, rows FROM counts
    UNION ALL SELECT 'dim_fuente', 'missing', false, NULL""")
def _(spark, sf):
    """The loaded 13 tables with their rows, one that is not expected and one that is not there."""
    return w.validate_warehouse_structure(spark, _loaded(spark, sf), [*LOAD_ORDER, "dim_fuente"])


@query("run_query", f"""{_warehouse_sql(1)}
    SELECT u.departamento, count(*) AS n, count(*) FILTER (h.activo) AS activas
    FROM ({_final_sql('hechos_vacante')}) h JOIN ({_final_sql('dim_ubicacion')}) u USING (ubicacion_sk)
    JOIN ({_final_sql('dim_empresa')}) e USING (empresa_sk)
    WHERE e.id_empresa_original <> '7' GROUP BY u.departamento""")
def _(spark, sf):
    name = _loaded(spark, sf)
    return w.run_query(
        spark, f"""SELECT u.departamento, count(*) AS n, count_if(h.activo) AS activas FROM {name}.hechos_vacante h
            JOIN {name}.dim_ubicacion u USING (ubicacion_sk) JOIN {name}.dim_empresa e USING (empresa_sk)
            WHERE e.id_empresa_original <> :company GROUP BY u.departamento""", company="7",
    )


@query("loaded_total", f"""{_counts_sql()}, summed AS (SELECT CAST(sum(rows) AS BIGINT) AS total FROM counts)
    SELECT total, 15000::BIGINT AS expected, total - 15000 AS difference, abs(total - 15000) <= 200 AS ok FROM summed""")
def _(spark, sf):
    return check_expected_total(w.table_stats(spark, _loaded(spark, sf)), 15000, 200)


_COLUMNS = {
    "postulante": "ID_POSTULANTE, DOC_ID, EDAD, SEXO, DEPARTAMENTO, PROVINCIA, DISTRITO, UBIGEO,"
                  " ESTADO_CONADIS, _row_order",
    "discapacidad": "DBIDPOSTULANTE, CAUSA, DSCORE, _row_order",
    "educacion": "ID_POSTULANTE, CARRERA, INSTITUCION, NIVEL_EDUCATIVO, GRADO, ESTADO, FECHAINICIO,"
                 " FECHAFIN, _row_order",
    "experiencias": "ID_POSTULANTE, CARGO, EMPRESA, SECTOR, FECHAINICIO, FECHAFIN, _row_order",
    "vacantes": "AVISOID, IDEMPRESA, NOMBREAVISO, SECTOR, VACANTES, POSTULANTES, SINEXPERIENCIA,"
                " TIEMPOEXPERIENCIA, TIPOTIEMPOEXPERIENCIA, ACTIVO, DEPARTAMENTO, PROVINCIA, DISTRITO,"
                " UBIGEO, FECHAINICIO, FECHAFIN, FECHACREACION, _row_order",
    "competencias": "AVISOID, NOMBRECOMPETENCIA, NIVEL, _row_order",
}


@query("cleaned_zone_summary", with_cleaned(*DATASETS) + " UNION ALL ".join(
    f" SELECT '{n}' AS name, count(*) AS rows, {len(c.split(', '))} AS n_columns, '{c}' AS columns FROM {n}"
    for n, c in _COLUMNS.items()))
def _(spark, sf):
    """All six cleaned datasets: names, rows and columns."""
    return dataset_summary(stored(spark, sf, *DATASETS))
