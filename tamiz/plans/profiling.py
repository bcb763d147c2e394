"""The exploratory reports of a dataset, as named lazy frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.functions import (
    DAY_FIRST, categorize_experience, duration_days, duration_months, duration_years, parse_mixed_dates,
)
from tamiz.operators import frequency, profile, stats
from tamiz.operators.columns import columns_of_type
from tamiz.operators.dedupe import duplicate_profile
from tamiz.operators.filters import experience_conversion_report, filter_positive_duration


def profile_dataset(df: DataFrame, key: str | None = None) -> dict[str, DataFrame]:
    """Nulls, duplicates, cardinality, blanks and column statistics."""
    text, numeric = columns_of_type(df, "text"), columns_of_type(df, "numeric")
    out = {
        "nulls": profile.null_profile(df), "duplicates": duplicate_profile(df),
        "cardinality": profile.cardinality_profile(df),
        "low_variability": profile.low_variability_columns(df),
    }
    if key:
        out["key_duplicates"] = duplicate_profile(df, key)
        out["records_per_key"] = frequency.records_per_entity(df, key)
        out["count_of_counts"] = frequency.count_of_counts(df, key)
    if numeric:
        out["numeric"] = stats.describe_numeric(df, numeric)
    if text:
        out["categorical"] = stats.describe_categorical(df, text)
        out["blanks"] = profile.blank_profile(df)
        out["text_length"] = stats.text_length_stats(df, text)
    return out


def top_values(df: DataFrame, columns: Sequence[str], k: int = 10) -> dict[str, DataFrame]:
    return {c: frequency.top_k_values(df, c, k) for c in columns}


def disability_analysis(df: DataFrame) -> dict[str, DataFrame]:
    """Scores by cause, and disabilities per applicant."""
    return {
        "score": stats.numeric_summary(df, "DSCORE"),
        "cause_by_score": frequency.crosstab(df, "CAUSA", "DSCORE"),
        "score_by_cause": stats.group_stats(df, "CAUSA", "DSCORE"),
        "score_box": stats.box_stats(df, "DSCORE", "CAUSA"),
        "per_applicant": frequency.count_of_counts(df, "DBIDPOSTULANTE"),
    }


def with_durations(
    df: DataFrame, start: str = "FECHAINICIO", end: str = "FECHAFIN", day_first: bool = DAY_FIRST
) -> DataFrame:
    """Parsed dates, and the span between them in days, months and years."""
    types = dict(df.dtypes)
    dated = df.withColumns({
        f"{c}_parsed": parse_mixed_dates(F.col(c), day_first) if types[c] == "string"
        else F.col(c).cast("timestamp_ntz")
        for c in (start, end)
    })
    days = duration_days(F.col(f"{start}_parsed"), F.col(f"{end}_parsed"))
    return dated.withColumn("duracion_dias", days).withColumns({
        "duracion_meses": duration_months(F.col("duracion_dias")),
        "duracion_anos": duration_years(F.col("duracion_dias")),
    })


def experience_analysis(df: DataFrame, day_first: bool = DAY_FIRST) -> dict[str, DataFrame]:
    """How many dates parse, and the spans they give."""
    spans = with_durations(df, day_first=day_first)
    valid = filter_positive_duration(spans, "duracion_dias")
    short = filter_positive_duration(spans, "duracion_dias", "duracion_meses", 60)
    return {
        **{
            f"parsed_{c}": stats.date_parse_report(spans, c, F.col(f"{c}_parsed"))
            for c in ("FECHAINICIO", "FECHAFIN")
        },
        "duration": stats.duration_summary(spans, "duracion_dias"),
        "duration_bins": stats.duration_distribution(valid, "duracion_meses"),
        "histogram_to_60_months": stats.histogram(short, "duracion_meses", 50),
        "box_to_60_months": stats.box_stats(short, "duracion_meses"),
    }


def vacancy_analysis(df: DataFrame) -> dict[str, DataFrame]:
    """Vacancies and applicants per notice, and the experience asked for."""
    category = categorize_experience(
        F.col("SINEXPERIENCIA"), F.col("TIEMPOEXPERIENCIA"), F.col("TIPOTIEMPOEXPERIENCIA")
    )
    return {
        "vacancies": stats.numeric_summary(df, "VACANTES"),
        "applicants": stats.numeric_summary(df, "POSTULANTES"),
        "ratio": stats.ratio_summary(df, "POSTULANTES", "VACANTES"),
        "experience": experience_conversion_report(df, "TIEMPOEXPERIENCIA"),
        "experience_classes": frequency.value_counts(
            df.withColumn("categoria_experiencia", category), "categoria_experiencia", sort="value"
        ),
    }
