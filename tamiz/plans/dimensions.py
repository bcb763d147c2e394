"""The eight dimensions.

Every builder returns a dimension whose keys are fixed on disk. Keys ascend
with the natural key, nulls last. ``keep_null_member`` keeps the row of the
null natural key, which null fact keys then point to.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions import calendar_attributes, clean_text, map_values, to_number
from tamiz.operators.dedupe import dedupe_keep_first, distinct_values
from tamiz.operators.keys import assign_surrogate_key
from tamiz.operators.quality import apply_defaults
from tamiz.operators.sets import union_all_dates, union_sources
from tamiz.plans.cleaning import ROW_ORDER
from tamiz.schemas import WAREHOUSE, conform

Datasets = Mapping[str, DataFrame]

UNKNOWN_PLACE = "SIN_ESPECIFICAR"
PLACE_COLUMNS = ("DEPARTAMENTO", "PROVINCIA", "DISTRITO", "UBIGEO")

# What the no-experience flag may say.
NO_EXPERIENCE_FLAG = {
    "SI": True, "S": True, "1": True, "NO": False, "N": False, "0": False,
}
VACANCY_DATES = ("FECHAINICIO", "FECHAFIN", "FECHACREACION")
EDUCATION_DATES = ("FECHAINICIO", "FECHAFIN")


def source_order(df: DataFrame) -> list[Column]:
    """What decides which row comes first: the source order, else all columns."""
    return [F.col(c) for c in ([ROW_ORDER] if ROW_ORDER in df.columns else df.columns)]


def build_dimension(
    df: DataFrame,
    key: str,
    attributes: Sequence[str],
    sk_name: str,
    order_by: Sequence[Column] | None = None,
    keep_null_member: bool = False,
) -> DataFrame:
    """One row per natural key, from the first source row, with a surrogate key."""
    if not keep_null_member:
        df = df.filter(F.col(key).isNotNull())
    wanted = [c for c in (key, *attributes) if c in df.columns]
    if len(wanted) == 1:
        members = distinct_values(df, key)
    else:
        order = source_order(df) if order_by is None else order_by
        members = dedupe_keep_first(df, [key], order).select(*wanted)
    return assign_surrogate_key(members, sk_name, [key])


def build_dim_date(datasets: Datasets) -> DataFrame:
    sources = []
    if "vacantes" in datasets:
        sources.append((datasets["vacantes"], VACANCY_DATES))
    if "educacion" in datasets:
        sources.append((datasets["educacion"], EDUCATION_DATES))
    return build_calendar(union_all_dates(sources).distinct())


def build_calendar(days: DataFrame, column: str = "fecha", sk_name: str = "fecha_sk") -> DataFrame:
    """Calendar dimension over distinct days."""
    keyed = assign_surrogate_key(days.select(column), sk_name, [column])
    return keyed.select(
        sk_name, column,
        *[c.alias(name) for name, c in calendar_attributes(F.col(column)).items()],
    )


def build_dim_location(datasets: Datasets, keep_null_member: bool = True) -> DataFrame:
    """Places by code: those of applicants first, then those of vacancies only."""
    firsts = {}
    for dataset, tag in (("postulante", "postulante"), ("vacantes", "vacante")):
        df = datasets.get(dataset)
        if df is None or any(c not in df.columns for c in PLACE_COLUMNS):
            continue
        if not keep_null_member:
            df = df.filter(F.col("UBIGEO").isNotNull())
        carried = [ROW_ORDER] if ROW_ORDER in df.columns else []
        places = df.select(*PLACE_COLUMNS, *carried)
        firsts[tag] = dedupe_keep_first(places, ["UBIGEO"], source_order(places))
    stacked = union_sources(firsts, PLACE_COLUMNS)
    members = dedupe_keep_first(stacked, ["UBIGEO"], "fuente_rank")
    names = {c: UNKNOWN_PLACE for c in PLACE_COLUMNS if c != "UBIGEO"}
    keyed = assign_surrogate_key(
        apply_defaults(members, names).drop("fuente_rank"), "ubicacion_sk", ["UBIGEO"]
    )
    return keyed.select("ubicacion_sk", *[
        F.col(c.upper()).alias(c) for c in ("departamento", "provincia", "distrito", "ubigeo")
    ], "fuente")


def build_dim_applicant(datasets: Datasets) -> DataFrame:
    keyed = build_dimension(
        datasets["postulante"], "ID_POSTULANTE",
        ("EDAD", "SEXO", "UBIGEO", "ESTADO_CONADIS"), "postulante_sk",
    )
    renamed = keyed.withColumnsRenamed({
        "ID_POSTULANTE": "id_postulante_original", "EDAD": "edad", "SEXO": "sexo",
        "UBIGEO": "ubigeo", "ESTADO_CONADIS": "estado_conadis",
    })
    return conform(renamed, WAREHOUSE["dim_postulante"])


def build_dim_company(datasets: Datasets, keep_null_member: bool = True) -> DataFrame:
    keyed = build_dimension(
        datasets["vacantes"], "IDEMPRESA", (), "empresa_sk", keep_null_member=keep_null_member
    )
    return keyed.withColumnRenamed("IDEMPRESA", "id_empresa_original")


def no_experience_flag(col: Column) -> Column:
    """True or False from the usual spellings; anything else counts as False."""
    return map_values(clean_text(col), NO_EXPERIENCE_FLAG, default=False)


def build_dim_vacancy(datasets: Datasets) -> DataFrame:
    keyed = build_dimension(
        datasets["vacantes"], "AVISOID",
        ("NOMBREAVISO", "VACANTES", "SECTOR", "UBIGEO", "SINEXPERIENCIA", "TIEMPOEXPERIENCIA"),
        "vacante_sk",
    )
    if "TIEMPOEXPERIENCIA" in keyed.columns:
        keyed = keyed.withColumn("TIEMPOEXPERIENCIA", to_number(F.col("TIEMPOEXPERIENCIA")))
    if "SINEXPERIENCIA" in keyed.columns:
        keyed = keyed.withColumn("SINEXPERIENCIA", no_experience_flag(F.col("SINEXPERIENCIA")))
    renamed = keyed.withColumnsRenamed({
        "AVISOID": "id_vacante_original", "NOMBREAVISO": "nombre_aviso",
        "VACANTES": "num_vacantes", "SECTOR": "sector", "UBIGEO": "ubigeo",
        "SINEXPERIENCIA": "sin_experiencia", "TIEMPOEXPERIENCIA": "tiempo_experiencia",
    })
    return conform(renamed, WAREHOUSE["dim_vacante"])


def build_dim_skill(datasets: Datasets, keep_null_member: bool = True) -> DataFrame:
    keyed = build_dimension(
        datasets["competencias"], "NOMBRECOMPETENCIA", (), "competencia_sk",
        keep_null_member=keep_null_member,
    )
    return keyed.withColumnRenamed("NOMBRECOMPETENCIA", "nombre_competencia")


def build_dim_career(datasets: Datasets) -> DataFrame:
    """Careers with the first degree stated for each."""
    source = datasets["educacion"]
    if "GRADO" in source.columns:
        # Members and their degree from one aggregation: the names, which may be long, are not joined with themselves.
        first = F.when(F.col("GRADO").isNotNull(), F.struct(*source_order(source)))
        members = source.filter(F.col("CARRERA").isNotNull()).groupBy("CARRERA").agg(F.min_by("GRADO", first).alias("GRADO"))
        keyed = assign_surrogate_key(members, "carrera_sk", ["CARRERA"])
    else:
        keyed = build_dimension(source, "CARRERA", (), "carrera_sk")
    renamed = keyed.withColumnsRenamed({"CARRERA": "nombre_carrera", "GRADO": "nivel_educativo"})
    return conform(renamed, WAREHOUSE["dim_carrera"])


def build_dim_institution(datasets: Datasets) -> DataFrame:
    keyed = build_dimension(datasets["educacion"], "INSTITUCION", (), "institucion_sk")
    return keyed.withColumnRenamed("INSTITUCION", "nombre_institucion")
