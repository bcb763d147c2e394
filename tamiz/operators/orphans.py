"""Child keys without a parent: counting them and giving them a parent."""

from __future__ import annotations

import datetime
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.functions import percent_of
from tamiz.operators.joins import orphan_keys
from tamiz.operators.sets import append_placeholders

_UNKNOWN_PLACE = "SIN_ESPECIFICAR"


def orphan_stats(
    child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None,
    limit_pct: float = 5.0,
) -> DataFrame:
    """Orphan keys, distinct child keys, share, and whether it is within the limit."""
    own = child.filter(F.col(key).isNotNull()).select(key).distinct()
    other = parent.select(F.col(parent_key or key).alias("__parent")).filter(
        "__parent is not null"
    ).distinct()
    flagged = own.join(other, own[key] == other["__parent"], "left")
    counted = flagged.agg(
        F.count_if(F.col("__parent").isNull()).alias("orphans"), F.count(F.lit(1)).alias("total")
    )
    share = percent_of(F.col("orphans"), F.col("total"))
    return counted.select("orphans", "total", share.alias("pct"), (share <= limit_pct).alias("ok"))


def vacancy_placeholder(run_date: datetime.date) -> dict[str, object]:
    """Values of the vacancy row that stands in for an unknown one."""
    # What marks a placeholder vacancy.
    return {
        "NOMBREAVISO": "REGISTRO_HUERFANO_PRESERVADO", "VACANTES": 0, "SECTOR": "SIN_CLASIFICAR",
        "UBIGEO": "000000", "SINEXPERIENCIA": "NO", "TIEMPOEXPERIENCIA": 0, "IDEMPRESA": 0,
        "DEPARTAMENTO": _UNKNOWN_PLACE, "PROVINCIA": _UNKNOWN_PLACE, "DISTRITO": _UNKNOWN_PLACE,
        "FECHAINICIO": run_date, "FECHAFIN": run_date, "FECHACREACION": run_date, "ACTIVO": False,
    }


def orphan_placeholders(
    child: DataFrame, parent: DataFrame, key: str, defaults: Mapping[str, object]
) -> DataFrame:
    """One labelled parent row for each orphan key of the child.

    Defaults take the parent's column types; columns the parent lacks are left out.
    """
    types = dict(parent.dtypes)
    return orphan_keys(child, parent, key).select(
        F.col(key).cast(types[key]).alias(key),
        *[F.lit(v).cast(types[c]).alias(c) for c, v in defaults.items() if c in types],
    )


def reconcile_orphans(
    child: DataFrame, parent: DataFrame, key: str, defaults: Mapping[str, object]
) -> DataFrame:
    """The parent together with the placeholders of the child's orphan keys."""
    return append_placeholders(parent, orphan_placeholders(child, parent, key, defaults))
