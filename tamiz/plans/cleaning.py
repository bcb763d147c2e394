"""The six dataset cleaners.

Each takes a raw table with upper-case headers (see ``read_raw_csv``) and
returns the cleaned one, lazily. Where rows repeat, the first in ``order_by``
stays; the column is carried through and never compared.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.functions import (
    DATE_FORMATS, clean_category, clean_text, normalize_career, normalize_institution,
    parse_dates, to_number, zero_pad_code,
)
from tamiz.operators.columns import columns_matching, require_columns
from tamiz.operators.date_formats import parse_inferred_dates
from tamiz.operators.dedupe import drop_exact_duplicates, validate_primary_key
from tamiz.operators.filters import drop_null_keys, filter_range
from tamiz.operators.profile import cleaning_report, null_profile
from tamiz.operators.quality import assert_unique_not_null

ROW_ORDER = "_row_order"

# Spellings of the two sexes.
SEX_SPELLINGS = {
    "M": "M", "MASCULINO": "M", "HOMBRE": "M", "F": "F", "FEMENINO": "F", "MUJER": "F",
}
SEXES = ("M", "F")
AGE_RANGE = (16, 100)
PLACE_TOKENS = ("DEPARTAMENTO", "PROVINCIA", "DISTRITO", "UBIGEO")


def clean_text_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: clean_text(F.col(c)) for c in present}) if present else df


def clean_number_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: to_number(F.col(c)) for c in present}) if present else df


def clean_dates(
    df: DataFrame, columns: Sequence[str], formats: Sequence[str] | str = DATE_FORMATS
) -> DataFrame:
    """Parse text columns; columns that are dates already only change type.

    With ``formats="infer"`` each column is looked at first, and read with the one format that most of its
    values fit (see ``date_formats``).
    """
    present = [c for c in columns if c in df.columns]
    texts = [c for c in present if isinstance(df.schema[c].dataType, T.StringType)]
    if formats == "infer":
        df, texts, present = parse_inferred_dates(df, texts), [], [c for c in present if c not in texts]
    out = {c: parse_dates(F.col(c), formats) if c in texts else F.col(c).cast("timestamp_ntz") for c in present}
    return df.withColumns(out) if out else df


def clean_location(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Place names as clean text, place codes padded to six characters."""
    columns = columns_matching(df, *PLACE_TOKENS) if columns is None else columns
    return df.withColumns({
        c: zero_pad_code(F.col(c)) if "UBIGEO" in c.upper() else clean_text(F.col(c))
        for c in columns if c in df.columns
    })


def clean_age(df: DataFrame, column: str = "EDAD") -> DataFrame:
    return filter_range(clean_number_columns(df, [column]), column, *AGE_RANGE)


def clean_sex(df: DataFrame, column: str = "SEXO") -> DataFrame:
    return df.withColumn(column, clean_category(F.col(column), SEXES, SEX_SPELLINGS))


def clean_score(df: DataFrame, column: str = "DSCORE") -> DataFrame:
    """Numbers where possible; rows without a score stay."""
    return clean_number_columns(df, [column])


def clean_salary(df: DataFrame) -> DataFrame:
    return clean_number_columns(df, columns_matching(df, "SALARIO", "SUELDO", "REMUNERACION"))


def clean_vacancy_count(
    df: DataFrame, columns: Sequence[str] = ("VACANTES", "POSTULANTES")
) -> DataFrame:
    named = columns_matching(df, "VACANTE", "NUMERO", match_all=True)
    return clean_number_columns(df, [*named, *[c for c in columns if c not in named]])


def clean_duration(df: DataFrame) -> DataFrame:
    return clean_number_columns(df, columns_matching(df, "DURACION", "MESES", "AÑOS"))


def clean_required_experience(df: DataFrame) -> DataFrame:
    """Numbers if the name states a time unit, otherwise clean text."""
    columns = columns_matching(df, "EXPERIENCIA")
    timed = [c for c in columns if any(t in c.upper() for t in ("AÑOS", "MESES", "AÑO"))]
    return clean_text_columns(
        clean_number_columns(df, timed), [c for c in columns if c not in timed]
    )


def clean_applicants(df: DataFrame, order_by: str = ROW_ORDER) -> DataFrame:
    """One row per applicant id and per document id, ages 16 to 100.

    Both ids are unique afterwards, so no further comparison of whole rows.
    """
    out = validate_primary_key(df, "ID_POSTULANTE", order_by)
    out = validate_primary_key(out, "DOC_ID", order_by)
    out = clean_location(clean_sex(clean_age(out)))
    return clean_text_columns(out, ["ESTADO_CONADIS"])


def clean_disability(df: DataFrame, order_by: str = ROW_ORDER) -> DataFrame:
    require_columns(df, ["DBIDPOSTULANTE", "CAUSA", "DSCORE"])
    out = drop_null_keys(df, "DBIDPOSTULANTE")
    out = clean_score(clean_text_columns(out, ["CAUSA"]))
    return drop_exact_duplicates(out, order_by)


def clean_education(
    df: DataFrame, order_by: str = ROW_ORDER, formats: Sequence[str] | str = DATE_FORMATS
) -> DataFrame:
    out = drop_null_keys(df, "ID_POSTULANTE")
    out = clean_text_columns(out, ["NIVEL_EDUCATIVO", "ESTADO"])
    names = {"CARRERA": normalize_career, "INSTITUCION": normalize_institution}
    out = out.withColumns({c: f(F.col(c)) for c, f in names.items() if c in out.columns})
    out = clean_dates(out, columns_matching(out, "FECHA"), formats)
    return drop_exact_duplicates(out, order_by)


def clean_experience(
    df: DataFrame, order_by: str = ROW_ORDER, formats: Sequence[str] | str = DATE_FORMATS,
    date_columns: Sequence[str] | None = None,
) -> DataFrame:
    out = drop_null_keys(df, "ID_POSTULANTE")
    out = clean_text_columns(
        out, columns_matching(out, "CARGO", "PUESTO", "EMPRESA", "SECTOR", "INDUSTRIA")
    )
    dates = columns_matching(out, "FECHA") if date_columns is None else date_columns
    out = clean_duration(clean_dates(out, dates, formats))
    return drop_exact_duplicates(out, order_by)


def clean_vacancies(
    df: DataFrame, order_by: str = ROW_ORDER, formats: Sequence[str] | str = DATE_FORMATS
) -> DataFrame:
    """One row per vacancy id, so no further comparison of whole rows."""
    out = validate_primary_key(df, "AVISOID", order_by)
    out = clean_text_columns(out, columns_matching(out, "PUESTO", "CARGO", "EMPRESA", "ESTADO"))
    out = clean_vacancy_count(clean_salary(clean_location(out)))
    return clean_dates(out, columns_matching(out, "FECHA"), formats)


def clean_skills(df: DataFrame, order_by: str = ROW_ORDER) -> DataFrame:
    out = drop_null_keys(df, "AVISOID")
    out = clean_text_columns(out, columns_matching(out, "COMPETENCIA", "TIPO", "NIVEL"))
    return drop_exact_duplicates(clean_required_experience(out), order_by)


CLEANERS: dict[str, Callable[..., DataFrame]] = {
    "postulante": clean_applicants,
    "discapacidad": clean_disability,
    "educacion": clean_education,
    "experiencias": clean_experience,
    "vacantes": clean_vacancies,
    "competencias": clean_skills,
}

UNIQUE_KEYS = {"postulante": ("ID_POSTULANTE", "DOC_ID")}


def clean_dataset(name: str, raw: DataFrame, order_by: str = ROW_ORDER, **options: object) -> DataFrame:
    return CLEANERS[name](raw, order_by, **options)


def verify_cleaned(name: str, cleaned: DataFrame) -> DataFrame:
    """The frame, or an error if a key that has to be unique is not."""
    keys = UNIQUE_KEYS.get(name)
    return assert_unique_not_null(cleaned, *keys) if keys else cleaned


def cleaning_reports(name: str, raw: DataFrame, cleaned: DataFrame) -> dict[str, DataFrame]:
    """Row counts before and after, and the nulls that remain."""
    data = cleaned.drop(ROW_ORDER)
    return {
        "rows": cleaning_report(raw.drop(ROW_ORDER), data, name), "nulls": null_profile(data),
    }
