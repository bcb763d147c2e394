"""Dimensions, orphan handling and facts as one warehouse."""

from __future__ import annotations

import datetime
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.functions import calendar_attributes
from tamiz.operators.keys import extend_keys
from tamiz.operators.orphans import orphan_placeholders, orphan_stats, vacancy_placeholder
from tamiz.operators.profile import warehouse_summary
from tamiz.operators.quality import (
    check_foreign_key_nulls, check_max_length, check_not_null, check_referential_integrity,
    check_surrogate_keys, check_unique,
)
from tamiz.operators.sets import append_placeholders
from tamiz.plans import dimensions as d
from tamiz.plans import facts as f
from tamiz.schemas import DATE, TEXT, WAREHOUSE, conform, references
from tamiz.session import COMPACT, build_together, materialize
from tamiz.sources.versions import Version, VersionedWarehouse, each_owner_once

UNKNOWN_MEMBER = -1
UNKNOWN_TEXT, UNKNOWN_DAY = "SIN_DATO", datetime.date(1900, 1, 1)


@dataclass(frozen=True)
class Constellation:
    """``added`` holds the members that are new where the build went on from known dimensions."""

    dimensions: dict[str, DataFrame]
    facts: dict[str, DataFrame]
    orphans: DataFrame
    added: dict[str, DataFrame] = field(default_factory=dict)

    @property
    def tables(self) -> dict[str, DataFrame]:
        return {**self.dimensions, **self.facts}

    def stored(self) -> Constellation:
        """The same with the facts written once, for the checks that read them often."""
        spark = self.orphans.sparkSession
        facts = build_together(spark, {
            name: lambda name=name, df=df: materialize(df, name, **COMPACT) for name, df in self.facts.items()
        })
        return Constellation(self.dimensions, facts, self.orphans, self.added)

    def summary(self) -> DataFrame:
        return warehouse_summary(self.dimensions, self.facts)

    def checks(self) -> dict[str, DataFrame]:
        """The integrity reports of the whole warehouse."""
        return {
            "surrogate_keys": check_surrogate_keys(self.dimensions),
            "foreign_key_nulls": check_foreign_key_nulls(self.facts),
            "references": check_referential_integrity(
                self.facts, self.dimensions, references(list(self.facts))
            ),
            **constraint_reports(self.tables),
        }


def constraint_reports(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """NOT NULL, UNIQUE and length reports for the known tables."""
    out: dict[str, DataFrame] = {}

    def add(name: str, report: DataFrame) -> None:
        out[name] = report if name not in out else out[name].unionByName(report)

    for name, df in tables.items():
        table = WAREHOUSE.get(name)
        if table is None:
            continue
        required, unique = table.names(not_null=True), table.names(unique=True)
        limits = {c.name: c.max_length for c in table.columns if c.max_length}
        if required:
            add("not_null", check_not_null(df, name, required))
        if unique:
            add("unique", check_unique(df, name, unique))
        if limits:
            add("max_length", check_max_length(df, name, limits))
    return out


def reconciled_datasets(datasets: d.Datasets, run_date: datetime.date) -> dict[str, DataFrame]:
    """The datasets, with a placeholder vacancy for each unknown one that skills name.

    Only the placeholders are stored: several builders read them.
    """
    vacancies = datasets["vacantes"]
    placeholders = materialize(
        orphan_placeholders(
            datasets["competencias"], vacancies, "AVISOID", vacancy_placeholder(run_date)
        ),
        "placeholders", **COMPACT,
    )
    return {**datasets, "vacantes": append_placeholders(vacancies, placeholders)}


def build_dimensions(datasets: d.Datasets, keep_null_member: bool = True) -> dict[str, DataFrame]:
    keep = keep_null_member
    return build_together(datasets["vacantes"].sparkSession, {
        "dim_tiempo": lambda: d.build_dim_date(datasets),
        "dim_ubicacion": lambda: d.build_dim_location(datasets, keep),
        "dim_postulante": lambda: d.build_dim_applicant(datasets),
        "dim_carrera": lambda: d.build_dim_career(datasets),
        "dim_institucion": lambda: d.build_dim_institution(datasets),
        "dim_vacante": lambda: d.build_dim_vacancy(datasets),
        "dim_empresa": lambda: d.build_dim_company(datasets, keep),
        "dim_competencia": lambda: d.build_dim_skill(datasets, keep),
    })


def unknown_row(dim: DataFrame, name: str, sk: int = UNKNOWN_MEMBER) -> DataFrame:
    """The member that stands for a missing one: defaults, and where a value is needed, a text or day that says so."""
    table = WAREHOUSE[name]
    calendar = calendar_attributes(F.lit(UNKNOWN_DAY)) if name == "dim_tiempo" else {}
    needed = {TEXT: F.lit(UNKNOWN_TEXT), DATE: F.lit(UNKNOWN_DAY)}
    cells = []
    for c in table.columns:
        value = F.lit(sk) if c.name == table.columns[0].name else calendar.get(c.name, F.lit(c.default))
        if c.not_null and c.default is None and c.type in needed:
            value = needed[c.type]
        cells.append(value.cast(c.type).alias(c.name))
    return dim.sparkSession.range(1).select(*cells)


def with_unknown_member(dim: DataFrame, name: str, sk: int = UNKNOWN_MEMBER) -> DataFrame:
    return conform(dim, WAREHOUSE[name]).unionByName(unknown_row(dim, name, sk))


def natural_key(name: str) -> str:
    """The column of a dimension that its source names it by: the one after the surrogate key."""
    return WAREHOUSE[name].columns[1].name


def build_facts(
    datasets: d.Datasets, dims: f.Tables, null_keys: str | int = "keep",
    experience_grain: str = "applicant",
) -> dict[str, DataFrame]:
    """``null_keys="keep"`` keeps nulls of the applicant star; vacancy rows need all keys."""
    vacancy_nulls = "drop" if null_keys == "keep" else null_keys
    return {
        "hechos_postulante": f.build_fact_applicant(datasets, dims, null_keys=null_keys),
        "hechos_formacion": f.build_fact_education(datasets, dims, null_keys=null_keys),
        "hechos_experiencia": f.build_fact_experience(datasets, dims, experience_grain),
        "hechos_vacante": f.build_fact_vacancy(datasets, dims, null_keys=vacancy_nulls),
        "hechos_competencia_requerida": f.build_fact_required_skill(datasets, dims, null_keys=vacancy_nulls),
    }


def build_constellation(
    datasets: d.Datasets,
    run_date: datetime.date,
    reconcile: str = "before_dims",
    null_keys: str | int = "keep",
    keep_null_member: bool = True,
    experience_grain: str = "applicant",
    unknown_member: int | None = None,
    known: Mapping[str, DataFrame] | None = None,
    changed: str = "keep",
) -> Constellation:
    """All 13 tables from the cleaned datasets.

    ``unknown_member`` is the key of a row that every dimension then has for missing members; facts with
    a missing one point to it, and no dimension has a row without a name (``null_keys`` and
    ``keep_null_member`` say nothing then). ``known`` holds the dimensions of an earlier load: their
    members keep their keys, new ones follow (see ``extend_keys``, also for ``changed``).

    ``reconcile="before_dims"`` lets placeholder vacancies enter the warehouse;
    ``"stats_only"`` only counts the orphans. The cleaned datasets should be
    stored tables: each of them is read by several builders.
    """
    if reconcile not in ("before_dims", "stats_only"):
        raise ValueError(f"unknown reconcile mode {reconcile!r}")
    orphans = orphan_stats(datasets["competencias"], datasets["vacantes"], "AVISOID")
    if reconcile == "before_dims":
        datasets = reconciled_datasets(datasets, run_date)
    if unknown_member is not None:
        keep_null_member, null_keys = False, unknown_member
    dims = build_dimensions(datasets, keep_null_member)
    added = dims
    if known is not None:
        maps = build_together(orphans.sparkSession, {
            name: lambda name=name, dim=dim: extend_keys(
                known[name], conform(dim, WAREHOUSE[name]), natural_key(name), WAREHOUSE[name].columns[0].name, changed
            ) for name, dim in dims.items()
        })
        dims = {name: found.members for name, found in maps.items()}
        added = {name: found.added for name, found in maps.items()}
    # Lookups see the real members only, so that a default is never the unknown one.
    real = {n: dim.filter(F.col(WAREHOUSE[n].columns[0].name) > 0) for n, dim in dims.items()} if known else dims
    facts = build_facts(datasets, real, null_keys, experience_grain)
    if unknown_member is not None:
        new = not known
        dims = {n: with_unknown_member(dim, n, unknown_member) if new else dim for n, dim in dims.items()}
        added = dims if new else added
    return Constellation(dims, facts, orphans, added)


def load_constellation(
    warehouse: VersionedWarehouse,
    load_id: str,
    datasets: d.Datasets,
    run_date: datetime.date,
    unknown_member: int = UNKNOWN_MEMBER,
    changed: str = "keep",
    on_violation: str = "refuse",
    **options: object,
) -> Version:
    """Build the 13 tables from cleaned datasets and add them to a warehouse, on top of what it holds.

    Members that are there keep their keys. Facts of an applicant or vacancy that comes again give way to
    the new ones, so loading overlapping data changes nothing twice. A load id that is there already does
    nothing at all.
    """
    base = warehouse.version()
    if load_id in base.loads:
        return base
    names = [n for n, t in WAREHOUSE.items() if t.kind == "Dimension"]
    known = {n: warehouse.table(n, base) for n in names} if base.number else None
    built = build_constellation(
        datasets, run_date, unknown_member=unknown_member, known=known, changed=changed, **options
    )
    replaced = known is not None and changed == "update"
    tables = dict(built.dimensions if replaced else built.added)
    modes = dict.fromkeys(tables, "replace" if replaced else "append")
    for name, fact in built.facts.items():
        fact = conform(fact, WAREHOUSE[name])
        tables[name] = each_owner_once(warehouse.table(name, base), fact, fact.columns[0]) if known else fact
        modes[name] = "replace"
    return warehouse.load(load_id, tables, modes, order=list(WAREHOUSE), on_violation=on_violation)


def talent_gap(vacancies: DataFrame, applicants: DataFrame) -> DataFrame:
    """Vacancies, applicants, and how many vacancies stay without one."""
    counted = vacancies.agg(F.count(F.lit(1)).alias("vacancies")).withColumn(
        "applicants", applicants.agg(F.count(F.lit(1)).alias("n")).scalar()
    )
    return counted.withColumn("gap", F.col("vacancies") - F.col("applicants"))

