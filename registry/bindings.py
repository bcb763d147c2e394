"""The six raw datasets, derived from the driver tables.

Each text is plain SQL that Spark and DuckDB read alike. All cells are text,
with stray blanks, mixed case, unparsable numbers and dates, missing values and
repeated keys, so that the cleaners have work to do on every row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from registry.base import table
from tamiz.plans.cleaning import ROW_ORDER, clean_dataset
from tamiz.session import COMPACT, build_together, looked_up, materialize


def _day_first(expr: str) -> str:
    iso = f"CAST(CAST({expr} AS DATE) AS STRING)"
    return f"substr({iso}, 9, 2) || '/' || substr({iso}, 6, 2) || '/' || substr({iso}, 1, 4)"


def _iso(expr: str) -> str:
    return f"CAST(CAST({expr} AS DATE) AS STRING)"


def _whole(expr: str) -> str:
    return f"CAST(CAST(floor({expr}) AS BIGINT) AS STRING)"


LINE_ORDER = (
    "CAST(l.l_linenumber AS BIGINT) * 1000000000000000 + l.l_partkey * 100000000"
    " + CAST(floor(l.l_extendedprice * 100) AS BIGINT)"
)

UBIGEO = (
    "CASE WHEN n.n_nationkey > 22 THEN '1501011' WHEN n.n_nationkey = 0 THEN NULL"
    " ELSE CAST(10101 * n.n_nationkey AS STRING) END"
)

RAW: dict[str, tuple[tuple[str, ...], str]] = {
    "postulante": (("orders", "customer", "nation", "region"), f"""
        SELECT CASE WHEN o.o_orderstatus = 'P' AND o.o_orderpriority = '5-LOW' THEN NULL
                    ELSE 'P' || CAST(o.o_custkey AS STRING) END AS ID_POSTULANTE,
               CASE WHEN c.c_acctbal < 0 THEN NULL
                    ELSE 'D' || {_whole('c.c_acctbal * 10')} END AS DOC_ID,
               CASE WHEN o.o_orderpriority = '3-MEDIUM' AND o.o_orderstatus = 'P' THEN 'abc'
                    ELSE ' ' || {_whole('o.o_totalprice / 4000')} END AS EDAD,
               CASE o.o_orderpriority WHEN '1-URGENT' THEN 'masculino' WHEN '2-HIGH' THEN ' F '
                    WHEN '3-MEDIUM' THEN 'X' WHEN '4-NOT SPECIFIED' THEN NULL
                    ELSE 'Mujer' END AS SEXO,
               ' ' || lower(r.r_name) AS DEPARTAMENTO, n.n_name AS PROVINCIA,
               nullif(c.c_mktsegment, 'MACHINERY') AS DISTRITO, {UBIGEO} AS UBIGEO,
               CASE o.o_orderstatus WHEN 'F' THEN 'nan' WHEN 'O' THEN ' vigente '
                    ELSE 'No registrado' END AS ESTADO_CONADIS,
               o.o_orderkey AS _row_order
        FROM {{orders}} o JOIN {{customer}} c ON c.c_custkey = o.o_custkey
        JOIN {{nation}} n ON n.n_nationkey = c.c_nationkey
        JOIN {{region}} r ON r.r_regionkey = n.n_regionkey"""),
    "discapacidad": (("events",), """
        SELECT 'P' || CAST(user_id AS STRING) AS DBIDPOSTULANTE,
               CASE event_type WHEN 'view' THEN 'nan' ELSE ' ' || event_type END AS CAUSA,
               CASE event_type WHEN 'signup' THEN 'n.d.'
                    ELSE replace(replace(props, '{{"k": ', ''), '}}', '') END AS DSCORE,
               event_id AS _row_order
        FROM {events}"""),
    "educacion": (("documents", "orders"), f"""
        SELECT 'P' || CAST(d.doc_id AS STRING) AS ID_POSTULANTE, d.text AS CARRERA,
               CASE WHEN d.lang = 'de' THEN NULL
                    ELSE 'Universidad  de ' || d.source || ' - ' || d.lang END AS INSTITUCION,
               d.lang AS NIVEL_EDUCATIVO,
               CASE WHEN d.n_chars > 2000 THEN 'Bachiller' WHEN d.n_chars > 500 THEN 'Técnico'
                    ELSE NULL END AS GRADO,
               CASE d.lang WHEN 'es' THEN 'nan' ELSE ' concluido' END AS ESTADO,
               {_iso('o.o_orderdate')} AS FECHAINICIO, {_day_first('o.o_orderdate')} AS FECHAFIN,
               d.doc_id AS _row_order
        FROM {{documents}} d LEFT JOIN {{orders}} o ON o.o_orderkey = d.doc_id"""),
    "experiencias": (("lineitem", "orders"), f"""
        SELECT 'P' || CAST(o.o_custkey AS STRING) AS ID_POSTULANTE,
               CASE l.l_returnflag WHEN 'A' THEN ' analista ' WHEN 'R' THEN 'NaN'
                    ELSE 'Operario' END AS CARGO,
               'empresa ' || CAST(l.l_suppkey AS STRING) AS EMPRESA,
               lower(o.o_orderpriority) AS SECTOR,
               CASE WHEN l.l_linenumber > 6 THEN 'sin fecha' ELSE {_iso('o.o_orderdate')} END
                    AS FECHAINICIO,
               CASE WHEN l.l_returnflag = 'N' THEN NULL ELSE {_day_first('l.l_shipdate')} END
                    AS FECHAFIN,
               {LINE_ORDER} AS _row_order
        FROM {{lineitem}} l JOIN {{orders}} o ON o.o_orderkey = l.l_orderkey"""),
    "vacantes": (("lineitem", "orders", "part", "supplier", "nation", "region"), f"""
        SELECT CAST(l.l_orderkey AS STRING) AS AVISOID,
               CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'O' THEN NULL
                    ELSE CAST(l.l_suppkey AS STRING) END AS IDEMPRESA,
               p.p_name AS NOMBREAVISO, p.p_type AS SECTOR,
               {_whole('l.l_quantity')} AS VACANTES, CAST(p.p_size AS STRING) AS POSTULANTES,
               CASE l.l_returnflag WHEN 'A' THEN 'Si' WHEN 'R' THEN 'NO' ELSE '1' END
                    AS SINEXPERIENCIA,
               CASE l.l_linestatus WHEN 'F' THEN CAST(p.p_size AS STRING) ELSE 'varios' END
                    AS TIEMPOEXPERIENCIA,
               CASE WHEN l.l_linenumber < 3 THEN 'Años' WHEN l.l_linenumber < 6 THEN 'meses'
                    ELSE 'otro' END AS TIPOTIEMPOEXPERIENCIA,
               CASE o.o_orderstatus WHEN 'F' THEN 'NO' WHEN 'O' THEN 'SI' ELSE NULL END AS ACTIVO,
               r.r_name AS DEPARTAMENTO, lower(n.n_name) AS PROVINCIA,
               nullif(p.p_brand, 'Brand#2') AS DISTRITO, {UBIGEO} AS UBIGEO,
               {_iso('l.l_shipdate')} AS FECHAINICIO, {_day_first('l.l_shipdate')} AS FECHAFIN,
               CASE p.p_type WHEN 'PROMO' THEN 'sin fecha' ELSE {_iso('o.o_orderdate')} END
                    AS FECHACREACION,
               {LINE_ORDER} AS _row_order
        FROM {{lineitem}} l JOIN {{orders}} o ON o.o_orderkey = l.l_orderkey
        JOIN {{part}} p ON p.p_partkey = l.l_partkey
        JOIN {{supplier}} s ON s.s_suppkey = l.l_suppkey
        JOIN {{nation}} n ON n.n_nationkey = s.s_nationkey
        JOIN {{region}} r ON r.r_regionkey = n.n_regionkey"""),
    "competencias": (("events",), """
        SELECT CASE WHEN event_type = 'error' AND value < 2 THEN NULL
                    ELSE CAST(CAST(floor(event_id / 3) AS BIGINT) AS STRING) END AS AVISOID,
               CASE event_type WHEN 'error' THEN NULL WHEN 'click' THEN ' Trabajo en equipo'
                    WHEN 'view' THEN 'trabajo en equipo ' ELSE event_type END
                    AS NOMBRECOMPETENCIA,
               CASE WHEN value < 10 THEN 'básico' ELSE ' Avanzado' END AS NIVEL,
               event_id AS _row_order
        FROM {events}"""),
}


# The joins of a dataset as Spark takes them; the rows are those of ``RAW``. Orders are met by the text that becomes the
# row's id: where they are too many to broadcast, their shuffle also serves the comparison of rows by that id.
_JOINS = {
    "educacion": """FROM {documents} d LEFT JOIN {orders} o
        ON 'P' || CAST(o.o_orderkey AS STRING) = 'P' || CAST(d.doc_id AS STRING)""",
    "vacantes": """FROM {lineitem} l JOIN {part} p ON p.p_partkey = l.l_partkey
        JOIN {orders} o ON CAST(o.o_orderkey AS STRING) = CAST(l.l_orderkey AS STRING)
        JOIN {supplier} s ON s.s_suppkey = l.l_suppkey
        JOIN {nation} n ON n.n_nationkey = s.s_nationkey
        JOIN {region} r ON r.r_regionkey = n.n_regionkey""",
}


def raw(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One raw dataset as a lazy frame. The tables after the first are looked up."""
    tables, text = RAW[name]
    if name in _JOINS:
        text = text[:text.index("FROM {")] + _JOINS[name]
    frames = {t: table(spark, folder, t) for t in tables}
    return spark.sql(text, **{t: df if t == tables[0] else looked_up(df) for t, df in frames.items()})


def cleaned(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return clean_dataset(name, raw(spark, folder, name))


def _at_once(spark: SparkSession, folder: str, names: Sequence[str]) -> int:
    """One dataset at a time where a table's scan fills the cluster by itself: side by side nothing would be
    faster, and the shuffle files of all datasets would be there at once."""
    scans = (table(spark, folder, t).select("*").rdd.getNumPartitions() for t in {t for n in names for t in RAW[n][0]})
    return 1 if max(scans) > spark.sparkContext.defaultParallelism else 8


def stored(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    """Cleaned datasets, each written once and read by several builders."""
    return build_together(spark, {
        n: lambda n=n: materialize(cleaned(spark, folder, n), f"cleaned-{n}", **COMPACT) for n in names
    }, _at_once(spark, folder, names))


def sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The cleaned datasets that the warehouse is built from. No builder asks which record of experience came first."""
    names = [n for n in RAW if n != "discapacidad"]
    return build_together(spark, {
        n: lambda n=n: materialize(
            cleaned(spark, folder, n).drop(*([ROW_ORDER] if n == "experiencias" else [])), f"cleaned-{n}", **COMPACT
        ) for n in names
    }, _at_once(spark, folder, names))


def raw_sql(name: str) -> str:
    """The raw dataset for DuckDB."""
    tables, text = RAW[name]
    return text.format(**{t: t for t in tables})


def _text(column: str) -> str:
    return f"nullif(upper(trim({column})), 'NAN') AS {column}"


def _date(column: str) -> str:
    return (
        f"coalesce(try_strptime({column}, '%Y-%m-%d'), try_strptime({column}, '%d/%m/%Y'))"
        f" AS {column}"
    )


def _code(column: str) -> str:
    return (
        f"CASE WHEN length(trim({column})) <= 6 THEN lpad(trim({column}), 6, '0') END AS {column}"
    )


def name_sql(expr: str, stopwords: tuple[str, ...] = ()) -> str:
    """Normalised name in DuckDB, which upper-cases one letter differently."""
    out = f"strip_accents(nullif(upper(trim(replace({expr}, 'ß', 'SS'))), 'NAN'))"
    for word in stopwords:
        out = f"replace({out}, ' {word} ', ' ')"
    out = f"trim(regexp_replace({out}, '\\s+', ' ', 'g'))"
    return f"nullif(regexp_replace({out}, '[^A-Z0-9 ]', '', 'g'), '')"


def _first(source: str, key: str) -> str:
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key}"
        f" ORDER BY _row_order) AS rn FROM {source} WHERE {key} IS NOT NULL) WHERE rn = 1"
    )


_STOP = ("DE", "EN", "Y", "E", "LA", "DEL", "LAS", "LOS", "PARA")



CLEANED_SQL: dict[str, str] = {
    "postulante": f"""
        raw_postulante AS ({raw_sql('postulante')}),
        postulante_1 AS ({_first('raw_postulante', 'ID_POSTULANTE')}),
        postulante_2 AS ({_first('postulante_1', 'DOC_ID')}),
        postulante AS (
          SELECT ID_POSTULANTE, DOC_ID, try_cast(trim(EDAD) AS DOUBLE) AS EDAD,
                 CASE upper(trim(SEXO)) WHEN 'MASCULINO' THEN 'M' WHEN 'MUJER' THEN 'F'
                      WHEN 'F' THEN 'F' END AS SEXO,
                 {_text('DEPARTAMENTO')}, {_text('PROVINCIA')}, {_text('DISTRITO')},
                 {_code('UBIGEO')}, {_text('ESTADO_CONADIS')}, _row_order
          FROM postulante_2 WHERE try_cast(trim(EDAD) AS DOUBLE) BETWEEN 16 AND 100)""",
    "discapacidad": f"""
        raw_discapacidad AS ({raw_sql('discapacidad')}),
        discapacidad AS (
          SELECT DBIDPOSTULANTE, CAUSA, DSCORE, min(_row_order) AS _row_order FROM (
            SELECT DBIDPOSTULANTE, {_text('CAUSA')}, try_cast(DSCORE AS DOUBLE) AS DSCORE,
                   _row_order FROM raw_discapacidad) GROUP BY ALL)""",
    "educacion": f"""
        raw_educacion AS ({raw_sql('educacion')}),
        educacion AS (
          SELECT * EXCLUDE (_row_order), min(_row_order) AS _row_order FROM (
            SELECT ID_POSTULANTE, {name_sql('CARRERA', _STOP)} AS CARRERA,
                   {name_sql('INSTITUCION')} AS INSTITUCION, {_text('NIVEL_EDUCATIVO')}, GRADO,
                   {_text('ESTADO')}, {_date('FECHAINICIO')}, {_date('FECHAFIN')}, _row_order
            FROM raw_educacion) GROUP BY ALL)""",
    "experiencias": f"""
        raw_experiencias AS ({raw_sql('experiencias')}),
        experiencias AS (
          SELECT * EXCLUDE (_row_order), min(_row_order) AS _row_order FROM (
            SELECT ID_POSTULANTE, {_text('CARGO')}, {_text('EMPRESA')}, {_text('SECTOR')},
                   {_date('FECHAINICIO')}, {_date('FECHAFIN')}, _row_order
            FROM raw_experiencias) GROUP BY ALL)""",
    "vacantes": f"""
        raw_vacantes AS ({raw_sql('vacantes')}),
        vacantes_1 AS ({_first('raw_vacantes', 'AVISOID')}),
        vacantes AS (
          SELECT AVISOID, {_text('IDEMPRESA')}, NOMBREAVISO, SECTOR,
                 try_cast(VACANTES AS DOUBLE) AS VACANTES,
                 try_cast(POSTULANTES AS DOUBLE) AS POSTULANTES, SINEXPERIENCIA,
                 TIEMPOEXPERIENCIA, TIPOTIEMPOEXPERIENCIA, ACTIVO, {_text('DEPARTAMENTO')},
                 {_text('PROVINCIA')}, {_text('DISTRITO')}, {_code('UBIGEO')},
                 {_date('FECHAINICIO')}, {_date('FECHAFIN')}, {_date('FECHACREACION')}, _row_order
          FROM vacantes_1)""",
    "competencias": f"""
        raw_competencias AS ({raw_sql('competencias')}),
        competencias AS (
          SELECT AVISOID, NOMBRECOMPETENCIA, NIVEL, min(_row_order) AS _row_order FROM (
            SELECT AVISOID, {_text('NOMBRECOMPETENCIA')}, {_text('NIVEL')}, _row_order
            FROM raw_competencias WHERE AVISOID IS NOT NULL) GROUP BY ALL)""",
}


def with_cleaned(*names: str) -> str:
    """``WITH`` clauses that define the cleaned datasets in DuckDB."""
    return "WITH " + ",".join(CLEANED_SQL[n] for n in names)
