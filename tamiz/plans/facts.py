"""The five fact tables.

``null_keys`` says what happens to rows with a missing foreign key: they are
kept ("keep"), left out ("drop"), or point to a number that stands for the
unknown member.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions import clean_text, map_values
from tamiz.operators.joins import first_key, lookup_date_key, lookup_key
from tamiz.plans.dimensions import Datasets

Tables = Mapping[str, DataFrame]

# What the active flag may say.
ACTIVE_FLAG = {
    "SI": True, "S": True, "1": True, "TRUE": True, "ACTIVO": True,
    "NO": False, "N": False, "0": False, "FALSE": False, "INACTIVO": False,
}


def settle_null_keys(fact: DataFrame, null_keys: str | int) -> DataFrame:
    keys = [c for c in fact.columns if c.endswith("_sk")]
    if null_keys == "keep":
        return fact
    if null_keys == "drop":
        return fact.dropna(subset=keys)
    return fact.fillna(int(null_keys), subset=keys)


def build_fact_applicant(
    datasets: Datasets, dims: Tables, registration_date_sk: int | Column | None = None,
    null_keys: str | int = "keep",
) -> DataFrame:
    """A row per applicant; the source has no registration date, so one key serves all."""
    source = datasets["postulante"].select("ID_POSTULANTE", "UBIGEO")
    fact = lookup_key(
        source, dims["dim_postulante"], "ID_POSTULANTE", "id_postulante_original", "postulante_sk"
    )
    fact = lookup_key(fact, dims["dim_ubicacion"], "UBIGEO", "ubigeo", "ubicacion_sk", null_safe=True)
    date_key = registration_date_sk
    if date_key is None:
        date_key = first_key(dims["dim_tiempo"], "fecha_sk")
    elif not isinstance(date_key, Column):
        date_key = F.lit(date_key).cast("long")
    fact = fact.select("postulante_sk", "ubicacion_sk").distinct()
    return settle_null_keys(fact.withColumn("fecha_registro_sk", date_key), null_keys)


def build_fact_education(
    datasets: Datasets, dims: Tables, null_keys: str | int = "keep"
) -> DataFrame:
    source = datasets["educacion"].select("ID_POSTULANTE", "CARRERA", "INSTITUCION")
    fact = lookup_key(
        source, dims["dim_postulante"], "ID_POSTULANTE", "id_postulante_original",
        "postulante_sk", "inner",
    )
    fact = lookup_key(fact, dims["dim_carrera"], "CARRERA", "nombre_carrera", "carrera_sk")
    fact = lookup_key(
        fact, dims["dim_institucion"], "INSTITUCION", "nombre_institucion", "institucion_sk"
    )
    # Natural and surrogate keys match one to one, and the numbers are shorter to compare.
    return settle_null_keys(fact.select("postulante_sk", "carrera_sk", "institucion_sk").distinct(), null_keys)


def build_fact_experience(datasets: Datasets, dims: Tables, grain: str = "applicant") -> DataFrame:
    """A row per applicant with experience, or per record with ``grain="record"``."""
    source = datasets["experiencias"].select("ID_POSTULANTE")
    if grain == "applicant":
        source = source.distinct()
    elif grain != "record":
        raise ValueError(f"grain must be applicant or record, not {grain!r}")
    fact = lookup_key(
        source, dims["dim_postulante"], "ID_POSTULANTE", "id_postulante_original",
        "postulante_sk", "inner",
    )
    return fact.select("postulante_sk")


def active_flag(col: Column) -> Column:
    """True or False from the usual spellings; active if not stated."""
    return map_values(clean_text(col), ACTIVE_FLAG, default=True)


def build_fact_vacancy(
    datasets: Datasets, dims: Tables, missing_date_sk: int | Column | None = None,
    null_keys: str | int = "drop",
) -> DataFrame:
    source = datasets["vacantes"]
    active = active_flag(F.col("ACTIVO")) if "ACTIVO" in source.columns else F.lit(True)
    source = source.select(
        "AVISOID", "UBIGEO", "IDEMPRESA", "FECHACREACION", active.alias("activo")
    )
    fact = lookup_key(
        source, dims["dim_vacante"], "AVISOID", "id_vacante_original", "vacante_sk", "inner"
    )
    fact = lookup_key(fact, dims["dim_ubicacion"], "UBIGEO", "ubigeo", "ubicacion_sk", null_safe=True)
    fact = lookup_key(
        fact, dims["dim_empresa"], "IDEMPRESA", "id_empresa_original", "empresa_sk", null_safe=True
    )
    fact = lookup_date_key(
        fact, dims["dim_tiempo"], "FECHACREACION", "fecha_publicacion_sk",
        default_sk=missing_date_sk,
    )
    fact = fact.select(
        "vacante_sk", "ubicacion_sk", "empresa_sk", "fecha_publicacion_sk", "activo"
    ).distinct()
    return settle_null_keys(fact, null_keys)


def build_fact_required_skill(
    datasets: Datasets, dims: Tables, null_keys: str | int = "drop"
) -> DataFrame:
    """A row per required skill; repeated requirements stay."""
    source = datasets["competencias"].select("AVISOID", "NOMBRECOMPETENCIA")
    fact = lookup_key(
        source, dims["dim_vacante"], "AVISOID", "id_vacante_original", "vacante_sk", "inner"
    )
    fact = lookup_key(
        fact, dims["dim_competencia"], "NOMBRECOMPETENCIA", "nombre_competencia",
        "competencia_sk", "inner" if null_keys == "drop" else "left", null_safe=True,
    )
    return settle_null_keys(fact.select("vacante_sk", "competencia_sk"), null_keys)
