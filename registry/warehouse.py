"""Cleaned datasets, dimensions, facts and the whole constellation."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from registry.base import query, table
from registry.bindings import cleaned, raw, sources, stored, with_cleaned
from tamiz.operators.joins import lookup_key
from tamiz.operators.keys import assign_surrogate_key
from tamiz.operators.profile import warehouse_summary
from tamiz.plans import constellation as c
from tamiz.plans import dimensions as d
from tamiz.plans import facts as f
from tamiz.plans.cleaning import ROW_ORDER, verify_cleaned

RUN_DATE = datetime.date(2024, 1, 1)
DATASETS = ("postulante", "discapacidad", "educacion", "experiencias", "vacantes", "competencias")
_CLEAN_NAMES = {
    "postulante": "clean_applicants", "discapacidad": "clean_disability",
    "educacion": "clean_education", "experiencias": "clean_experience",
    "vacantes": "clean_vacancies", "competencias": "clean_skills",
}


def _plain(df):
    """Dates as text, so that both engines show them alike."""
    return df.select(*[
        F.col(n).cast("string").alias(n) if t in ("timestamp_ntz", "timestamp", "date") else F.col(n)
        for n, t in df.dtypes
    ])


_DATES = {
    "educacion": "FECHAINICIO FECHAFIN", "experiencias": "FECHAINICIO FECHAFIN",
    "vacantes": "FECHAINICIO FECHAFIN FECHACREACION",
}

for _dataset, _name in _CLEAN_NAMES.items():
    _star = "* EXCLUDE (_row_order)"
    if _dataset in _DATES:
        _replace = ", ".join(f"CAST({x} AS VARCHAR) AS {x}" for x in _DATES[_dataset].split())
        _star += f" REPLACE ({_replace})"

    def _clean(spark, sf, dataset=_dataset):
        out = verify_cleaned(dataset, cleaned(spark, sf, dataset))
        return _plain(out.drop(ROW_ORDER))

    query(_name, f"{with_cleaned(_dataset)} SELECT {_star} FROM {_dataset}")(_clean)


# ---- dimensions -----------------------------------------------------------

MONTHS = "['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre','Noviembre','Diciembre']"
DAYS = "['Lunes','Martes','Miércoles','Jueves','Viernes','Sábado','Domingo']"


def _calendar_sql(day: str) -> str:
    return f"""CAST({day} AS VARCHAR) AS fecha, CAST(year({day}) AS INTEGER) AS anio,
        CAST(month({day}) AS INTEGER) AS mes, CAST(day({day}) AS INTEGER) AS dia,
        CAST(quarter({day}) AS INTEGER) AS trimestre,
        CAST(CASE WHEN quarter({day}) <= 2 THEN 1 ELSE 2 END AS INTEGER) AS semestre,
        CAST(isodow({day}) AS INTEGER) AS dia_semana, {MONTHS}[month({day})] AS nombre_mes,
        {DAYS}[isodow({day})] AS nombre_dia, isodow({day}) IN (6, 7) AS es_fin_semana"""


def _reconciled(mode: str) -> str:
    """CTE ``vac``: vacancies, with placeholders for the orphans of the skills."""
    if mode == "stats_only":
        return "vac AS (SELECT * FROM vacantes)"
    day = f"TIMESTAMP '{RUN_DATE}'"
    return f"""vac AS (SELECT * FROM vacantes UNION ALL BY NAME
        SELECT DISTINCT AVISOID, 'REGISTRO_HUERFANO_PRESERVADO' AS NOMBREAVISO,
               CAST(0 AS DOUBLE) AS VACANTES, 'SIN_CLASIFICAR' AS SECTOR, '000000' AS UBIGEO,
               'NO' AS SINEXPERIENCIA, '0' AS TIEMPOEXPERIENCIA, '0' AS IDEMPRESA,
               'SIN_ESPECIFICAR' AS DEPARTAMENTO, 'SIN_ESPECIFICAR' AS PROVINCIA,
               'SIN_ESPECIFICAR' AS DISTRITO, {day} AS FECHAINICIO, {day} AS FECHAFIN,
               {day} AS FECHACREACION, 'false' AS ACTIVO
        FROM competencias k WHERE NOT EXISTS
          (SELECT 1 FROM vacantes v WHERE v.AVISOID = k.AVISOID))"""


DIMS_SQL = {
    "dim_tiempo": f"""dim_tiempo AS (
        SELECT row_number() OVER (ORDER BY f) AS fecha_sk, f, {_calendar_sql('f')} FROM (
          SELECT DISTINCT CAST(f AS DATE) AS f FROM (
            SELECT unnest([FECHAINICIO, FECHAFIN, FECHACREACION]) AS f FROM vac UNION ALL
            SELECT unnest([FECHAINICIO, FECHAFIN]) FROM educacion) WHERE f IS NOT NULL))""",
    "dim_ubicacion": f"""dim_ubicacion AS (
        SELECT row_number() OVER (ORDER BY UBIGEO NULLS LAST) AS ubicacion_sk,
               coalesce(DEPARTAMENTO, 'SIN_ESPECIFICAR') AS departamento,
               coalesce(PROVINCIA, 'SIN_ESPECIFICAR') AS provincia,
               coalesce(DISTRITO, 'SIN_ESPECIFICAR') AS distrito, UBIGEO AS ubigeo, fuente
        FROM (SELECT *, row_number() OVER (PARTITION BY UBIGEO ORDER BY src, ord NULLS FIRST) AS rn
              FROM (SELECT DEPARTAMENTO, PROVINCIA, DISTRITO, UBIGEO, 'postulante' AS fuente,
                           0 AS src, _row_order AS ord FROM postulante
                    UNION ALL SELECT DEPARTAMENTO, PROVINCIA, DISTRITO, UBIGEO, 'vacante', 1,
                           _row_order FROM vac)) WHERE rn = 1)""",
    "dim_postulante": """dim_postulante AS (
        SELECT row_number() OVER (ORDER BY ID_POSTULANTE) AS postulante_sk,
               ID_POSTULANTE AS id_postulante_original, CAST(EDAD AS INTEGER) AS edad,
               SEXO AS sexo, UBIGEO AS ubigeo, ESTADO_CONADIS AS estado_conadis FROM postulante)""",
    "dim_carrera": """dim_carrera AS (
        SELECT row_number() OVER (ORDER BY CARRERA) AS carrera_sk, CARRERA AS nombre_carrera,
               arg_min(GRADO, _row_order) FILTER (WHERE GRADO IS NOT NULL) AS nivel_educativo
        FROM educacion WHERE CARRERA IS NOT NULL GROUP BY CARRERA)""",
    "dim_institucion": """dim_institucion AS (
        SELECT row_number() OVER (ORDER BY INSTITUCION) AS institucion_sk,
               INSTITUCION AS nombre_institucion
        FROM educacion WHERE INSTITUCION IS NOT NULL GROUP BY INSTITUCION)""",
    "dim_vacante": """dim_vacante AS (
        SELECT row_number() OVER (ORDER BY AVISOID) AS vacante_sk, AVISOID AS id_vacante_original,
               NOMBREAVISO AS nombre_aviso, CAST(coalesce(VACANTES, 0) AS INTEGER) AS num_vacantes,
               SECTOR AS sector, UBIGEO AS ubigeo,
               coalesce(upper(SINEXPERIENCIA) IN ('SI', 'S', '1'), false) AS sin_experiencia,
               coalesce(try_cast(TIEMPOEXPERIENCIA AS DOUBLE), 0.0) AS tiempo_experiencia
        FROM vac)""",
    "dim_empresa": """dim_empresa AS (
        SELECT row_number() OVER (ORDER BY IDEMPRESA NULLS LAST) AS empresa_sk,
               IDEMPRESA AS id_empresa_original FROM vac GROUP BY IDEMPRESA)""",
    "dim_competencia": """dim_competencia AS (
        SELECT row_number() OVER (ORDER BY NOMBRECOMPETENCIA NULLS LAST) AS competencia_sk,
               NOMBRECOMPETENCIA AS nombre_competencia FROM competencias GROUP BY NOMBRECOMPETENCIA)""",
}

FACTS_SQL = {
    "hechos_postulante": """hechos_postulante AS (
        SELECT DISTINCT postulante_sk, ubicacion_sk,
               (SELECT min(fecha_sk) FROM dim_tiempo) AS fecha_registro_sk
        FROM postulante p LEFT JOIN dim_postulante d ON d.id_postulante_original = p.ID_POSTULANTE
        LEFT JOIN dim_ubicacion u ON u.ubigeo IS NOT DISTINCT FROM p.UBIGEO)""",
    "hechos_formacion": """hechos_formacion AS (
        SELECT DISTINCT postulante_sk, carrera_sk, institucion_sk
        FROM educacion e JOIN dim_postulante d ON d.id_postulante_original = e.ID_POSTULANTE
        LEFT JOIN dim_carrera c ON c.nombre_carrera = e.CARRERA
        LEFT JOIN dim_institucion i ON i.nombre_institucion = e.INSTITUCION)""",
    "hechos_experiencia": """hechos_experiencia AS (
        SELECT DISTINCT postulante_sk FROM experiencias e
        JOIN dim_postulante d ON d.id_postulante_original = e.ID_POSTULANTE)""",
    "hechos_vacante": """hechos_vacante AS (
        SELECT DISTINCT vacante_sk, ubicacion_sk, empresa_sk,
               coalesce(fecha_sk, (SELECT min(fecha_sk) FROM dim_tiempo)) AS fecha_publicacion_sk,
               CASE WHEN upper(ACTIVO) IN ('NO', 'FALSE') THEN false ELSE true END AS activo
        FROM vac v JOIN dim_vacante d ON d.id_vacante_original = v.AVISOID
        LEFT JOIN dim_ubicacion u ON u.ubigeo IS NOT DISTINCT FROM v.UBIGEO
        LEFT JOIN dim_empresa m ON m.id_empresa_original IS NOT DISTINCT FROM v.IDEMPRESA
        LEFT JOIN dim_tiempo t ON t.f = CAST(v.FECHACREACION AS DATE)
        WHERE ubicacion_sk IS NOT NULL AND empresa_sk IS NOT NULL)""",
    "hechos_competencia_requerida": """hechos_competencia_requerida AS (
        SELECT vacante_sk, competencia_sk FROM competencias k
        JOIN dim_vacante d ON d.id_vacante_original = k.AVISOID
        JOIN dim_competencia c ON c.nombre_competencia IS NOT DISTINCT FROM k.NOMBRECOMPETENCIA)""",
}


def constellation_sql(mode: str = "before_dims") -> str:
    names = [n for n in DATASETS if n != "discapacidad"]
    return ", ".join([
        with_cleaned(*names), _reconciled(mode), *DIMS_SQL.values(), *FACTS_SQL.values(),
    ])


def _dim_sql(name: str, *datasets: str) -> str:
    vac = ", " + _reconciled("stats_only") if "vacantes" in datasets else ""
    star = "* EXCLUDE (f)" if name == "dim_tiempo" else "*"
    return f"{with_cleaned(*datasets)}{vac}, {DIMS_SQL[name]} SELECT {star} FROM {name}"


@query("build_dim_date", _dim_sql("dim_tiempo", "vacantes", "educacion"))
def _(spark, sf):
    return _plain(d.build_dim_date({n: cleaned(spark, sf, n) for n in ("vacantes", "educacion")}))


@query("build_dim_location", _dim_sql("dim_ubicacion", "postulante", "vacantes"))
def _(spark, sf):
    return d.build_dim_location({n: cleaned(spark, sf, n) for n in ("postulante", "vacantes")})


@query("build_dim_applicant", _dim_sql("dim_postulante", "postulante"))
def _(spark, sf):
    return d.build_dim_applicant({"postulante": cleaned(spark, sf, "postulante")})


@query("build_dim_company", _dim_sql("dim_empresa", "vacantes"))
def _(spark, sf):
    return d.build_dim_company({"vacantes": cleaned(spark, sf, "vacantes")})


@query("build_dim_vacancy", _dim_sql("dim_vacante", "vacantes"))
def _(spark, sf):
    return d.build_dim_vacancy({"vacantes": cleaned(spark, sf, "vacantes")})


@query("build_dim_skill", _dim_sql("dim_competencia", "competencias"))
def _(spark, sf):
    return d.build_dim_skill({"competencias": cleaned(spark, sf, "competencias")})


@query("build_dim_career", _dim_sql("dim_carrera", "educacion"))
def _(spark, sf):
    return d.build_dim_career(stored(spark, sf, "educacion"))


@query("build_dim_institution", _dim_sql("dim_institucion", "educacion"))
def _(spark, sf):
    return d.build_dim_institution({"educacion": cleaned(spark, sf, "educacion")})


# ---- facts ----------------------------------------------------------------

def _fact_sql(name: str, datasets: tuple[str, ...], dims: tuple[str, ...]) -> str:
    parts = [with_cleaned(*datasets)]
    if "vacantes" in datasets:
        parts.append(_reconciled("stats_only"))
    return ", ".join([*parts, *[DIMS_SQL[x] for x in dims], FACTS_SQL[name]]) + f" SELECT * FROM {name}"


@query("build_fact_applicant", _fact_sql(
    "hechos_postulante", ("postulante", "vacantes", "educacion"),
    ("dim_tiempo", "dim_ubicacion", "dim_postulante")))
def _(spark, sf):
    data = stored(spark, sf, "postulante", "vacantes", "educacion")
    dims = {
        "dim_tiempo": d.build_dim_date(data), "dim_ubicacion": d.build_dim_location(data),
        "dim_postulante": d.build_dim_applicant(data),
    }
    return f.build_fact_applicant(data, dims)


@query("build_fact_education", _fact_sql(
    "hechos_formacion", ("postulante", "educacion"),
    ("dim_postulante", "dim_carrera", "dim_institucion")))
def _(spark, sf):
    data = stored(spark, sf, "postulante", "educacion")
    dims = {
        "dim_postulante": d.build_dim_applicant(data), "dim_carrera": d.build_dim_career(data),
        "dim_institucion": d.build_dim_institution(data),
    }
    return f.build_fact_education(data, dims)


@query("build_fact_experience", _fact_sql(
    "hechos_experiencia", ("postulante", "experiencias"), ("dim_postulante",)))
def _(spark, sf):
    data = {n: cleaned(spark, sf, n) for n in ("postulante", "experiencias")}
    return f.build_fact_experience(data, {"dim_postulante": d.build_dim_applicant(data)})


@query("build_fact_vacancy", _fact_sql(
    "hechos_vacante", ("postulante", "vacantes", "educacion"),
    ("dim_tiempo", "dim_ubicacion", "dim_vacante", "dim_empresa")))
def _(spark, sf):
    data = stored(spark, sf, "postulante", "vacantes", "educacion")
    dims = {
        "dim_tiempo": d.build_dim_date(data), "dim_ubicacion": d.build_dim_location(data),
        "dim_vacante": d.build_dim_vacancy(data), "dim_empresa": d.build_dim_company(data),
    }
    return f.build_fact_vacancy(data, dims)


@query("build_fact_required_skill", _fact_sql(
    "hechos_competencia_requerida", ("vacantes", "competencias"),
    ("dim_vacante", "dim_competencia")))
def _(spark, sf):
    data = stored(spark, sf, "vacantes", "competencias")
    dims = {"dim_vacante": d.build_dim_vacancy(data), "dim_competencia": d.build_dim_skill(data)}
    return f.build_fact_required_skill(data, dims)


# ---- the whole warehouse --------------------------------------------------

def full(spark, sf, reconcile: str = "before_dims"):
    return c.build_constellation(sources(spark, sf), RUN_DATE, reconcile)


def _summary_sql(mode: str) -> str:
    dims = " UNION ALL ".join(f"SELECT 'dimension' AS kind, '{n}' AS name, count(*) AS rows FROM {n}" for n in DIMS_SQL)
    facts = " UNION ALL ".join(f"SELECT 'fact', '{n}', count(*) FROM {n}" for n in FACTS_SQL)
    return f"""{constellation_sql(mode)}, counts AS ({dims} UNION ALL {facts})
        SELECT kind, name, rows FROM counts UNION ALL
        SELECT kind, 'TOTAL', CAST(sum(rows) AS BIGINT) FROM counts GROUP BY kind"""


@query("build_constellation", _summary_sql("before_dims"))
def _(spark, sf):
    return full(spark, sf).summary()


@query("build_constellation_stats_only", _summary_sql("stats_only"))
def _(spark, sf):
    return full(spark, sf, "stats_only").summary()


@query("warehouse_required_skills", f"""{constellation_sql()}
    SELECT v.sector, v.nombre_aviso, coalesce(c.nombre_competencia, '') AS competencia,
           count(*) AS n, CAST(sum(v.num_vacantes) AS BIGINT) AS vacantes
    FROM hechos_competencia_requerida h JOIN dim_vacante v USING (vacante_sk)
    JOIN dim_competencia c USING (competencia_sk) GROUP BY ALL""")
def _(spark, sf):
    w = full(spark, sf)
    fact, dims = w.facts["hechos_competencia_requerida"], w.dimensions
    return (
        fact.join(dims["dim_vacante"], "vacante_sk").join(dims["dim_competencia"], "competencia_sk")
        .groupBy("sector", "nombre_aviso", F.coalesce("nombre_competencia", F.lit("")).alias("competencia"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("num_vacantes").alias("vacantes"))
    )


@query("warehouse_summary", """
    SELECT 'dimension' AS kind, 'customer' AS name, count(*) AS rows FROM customer UNION ALL
    SELECT 'dimension', 'part', count(*) FROM part UNION ALL
    SELECT 'dimension', 'TOTAL', (SELECT count(*) FROM customer) + (SELECT count(*) FROM part)
    UNION ALL SELECT 'fact', 'orders', count(*) FROM orders UNION ALL
    SELECT 'fact', 'lineitem', count(*) FROM lineitem UNION ALL
    SELECT 'fact', 'TOTAL', (SELECT count(*) FROM orders) + (SELECT count(*) FROM lineitem)""")
def _(spark, sf):
    named = lambda *names: {n: table(spark, sf, n) for n in names}
    return warehouse_summary(named("customer", "part"), named("orders", "lineitem"))


@query("talent_gap", f"""{with_cleaned('postulante', 'vacantes')}
    SELECT count(*) AS vacancies, (SELECT count(*) FROM postulante) AS applicants,
           count(*) - (SELECT count(*) FROM postulante) AS gap FROM vacantes""")
def _(spark, sf):
    return c.talent_gap(cleaned(spark, sf, "vacantes"), cleaned(spark, sf, "postulante"))


SEGMENTS_SQL = """
    WITH dim AS (SELECT row_number() OVER (ORDER BY c_custkey) AS customer_sk, c_custkey,
                        upper(trim(c_mktsegment)) AS segment FROM customer)
    SELECT segment, count(*) AS orders, count(DISTINCT customer_sk) AS customers,
           round(sum(o_totalprice), 2) AS total
    FROM orders JOIN dim ON c_custkey = o_custkey GROUP BY segment"""


@query("customer_segments", SEGMENTS_SQL)
def customer_segments(spark, sf):
    """Clean, deduplicate, number, look up, count: the smallest whole path."""
    customers = d.build_dimension(
        table(spark, sf, "customer").withColumn("segment", d.clean_text(F.col("c_mktsegment"))),
        "c_custkey", ["segment"], "customer_sk", [F.col("c_name")],
    )
    fact = lookup_key(table(spark, sf, "orders"), customers, "o_custkey", "c_custkey", "customer_sk", "inner")
    return (
        fact.join(customers.select("customer_sk", "segment"), "customer_sk")
        .groupBy("segment").agg(
            F.count(F.lit(1)).alias("orders"), F.count_distinct("customer_sk").alias("customers"),
            F.round(F.sum("o_totalprice"), 2).alias("total"),
        )
    )


@query("assign_surrogate_key", """
    SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
             l_extendedprice, l_shipdate) AS line_sk,
           l_orderkey, l_linenumber, l_partkey FROM lineitem""")
def _(spark, sf):
    lines = table(spark, sf, "lineitem")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    return assign_surrogate_key(lines.select(*order), "line_sk", order).select(
        "line_sk", "l_orderkey", "l_linenumber", "l_partkey"
    )
