"""Raw column lists and the typed warehouse tables with their constraints."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The six datasets, their raw file names and cleaned names.
RAW_FILES = {
    "postulante": "Dataset_POSTULANTE.csv",
    "discapacidad": "Dataset_DISCAPACIDAD.csv",
    "educacion": "DataSet_EDUCACION.csv",
    "experiencias": "Dataset_EXPERIENCIASLABORALES.csv",
    "vacantes": "Dataset_VACANTES.csv",
    "competencias": "DataSet_COMPETENCIAS.csv",
}
CLEANED_NAMES = {name: f"{name}_clean" for name in RAW_FILES}

LONG, INT, TEXT, DATE = T.LongType(), T.IntegerType(), T.StringType(), T.DateType()
BOOL, DOUBLE = T.BooleanType(), T.DoubleType()


@dataclass(frozen=True)
class Column:
    """A warehouse column with what the table demands of it."""

    name: str
    type: T.DataType
    not_null: bool = False
    unique: bool = False
    max_length: int | None = None
    default: object = None


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    references: dict[str, tuple[str, str]] = field(default_factory=dict)

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type, not c.not_null) for c in self.columns])

    @property
    def kind(self) -> str:
        return "Dimension" if self.name.startswith("dim_") else "Fact"

    def names(self, **traits: object) -> list[str]:
        return [c.name for c in self.columns if all(getattr(c, k) == v for k, v in traits.items())]


def _key(name: str) -> Column:
    return Column(name, LONG, not_null=True, unique=True)


def _ref(name: str) -> Column:
    return Column(name, LONG, not_null=True)


_PLACE = "SIN_ESPECIFICAR"

# The 13 tables in load order, dimensions before facts.
WAREHOUSE: dict[str, Table] = {t.name: t for t in (
    Table("dim_tiempo", (
        _key("fecha_sk"), Column("fecha", DATE, True, True), Column("anio", INT, True),
        Column("mes", INT, True), Column("dia", INT, True), Column("trimestre", INT, True),
        Column("semestre", INT, True), Column("dia_semana", INT, True),
        Column("nombre_mes", TEXT, max_length=20), Column("nombre_dia", TEXT, max_length=20),
        Column("es_fin_semana", BOOL, True, default=False),
    )),
    Table("dim_ubicacion", (
        _key("ubicacion_sk"), Column("ubigeo", TEXT, True, True, 10),
        Column("departamento", TEXT, True, max_length=100, default=_PLACE),
        Column("provincia", TEXT, True, max_length=100, default=_PLACE),
        Column("distrito", TEXT, True, max_length=100, default=_PLACE),
        Column("fuente", TEXT, max_length=20),
    )),
    Table("dim_postulante", (
        _key("postulante_sk"), Column("id_postulante_original", TEXT, True, True, 100),
        Column("edad", INT), Column("sexo", TEXT, max_length=10),
        Column("ubigeo", TEXT, max_length=10), Column("estado_conadis", TEXT, max_length=50),
    )),
    Table("dim_carrera", (
        _key("carrera_sk"), Column("nombre_carrera", TEXT, True),
        Column("nivel_educativo", TEXT, max_length=100),
    )),
    Table("dim_institucion", (_key("institucion_sk"), Column("nombre_institucion", TEXT, True))),
    Table("dim_vacante", (
        _key("vacante_sk"), Column("id_vacante_original", TEXT, True, True),
        Column("nombre_aviso", TEXT), Column("num_vacantes", INT, default=0),
        Column("sector", TEXT, max_length=200), Column("ubigeo", TEXT, max_length=10),
        Column("sin_experiencia", BOOL, default=False),
        Column("tiempo_experiencia", DOUBLE, default=0.0),
    )),
    Table("dim_empresa", (
        _key("empresa_sk"), Column("id_empresa_original", TEXT, True, True, 100),
    )),
    Table("dim_competencia", (_key("competencia_sk"), Column("nombre_competencia", TEXT, True))),
    Table("hechos_postulante", (
        Column("postulante_sk", LONG, True, True), _ref("ubicacion_sk"), _ref("fecha_registro_sk"),
    ), {
        "postulante_sk": ("dim_postulante", "postulante_sk"),
        "ubicacion_sk": ("dim_ubicacion", "ubicacion_sk"),
        "fecha_registro_sk": ("dim_tiempo", "fecha_sk"),
    }),
    Table("hechos_formacion", (_ref("postulante_sk"), _ref("carrera_sk"), _ref("institucion_sk")), {
        "postulante_sk": ("dim_postulante", "postulante_sk"),
        "carrera_sk": ("dim_carrera", "carrera_sk"),
        "institucion_sk": ("dim_institucion", "institucion_sk"),
    }),
    Table("hechos_experiencia", (_ref("postulante_sk"),), {
        "postulante_sk": ("dim_postulante", "postulante_sk"),
    }),
    Table("hechos_vacante", (
        Column("vacante_sk", LONG, True, True), _ref("ubicacion_sk"), _ref("empresa_sk"),
        _ref("fecha_publicacion_sk"), Column("activo", BOOL, default=True),
    ), {
        "vacante_sk": ("dim_vacante", "vacante_sk"),
        "ubicacion_sk": ("dim_ubicacion", "ubicacion_sk"),
        "empresa_sk": ("dim_empresa", "empresa_sk"),
        "fecha_publicacion_sk": ("dim_tiempo", "fecha_sk"),
    }),
    Table("hechos_competencia_requerida", (_ref("vacante_sk"), _ref("competencia_sk")), {
        "vacante_sk": ("dim_vacante", "vacante_sk"),
        "competencia_sk": ("dim_competencia", "competencia_sk"),
    }),
)}

LOAD_ORDER = tuple(WAREHOUSE)


def references(facts: list[str] | None = None) -> list[tuple[str, str, str, str]]:
    """(fact, column, dimension, key) for every foreign key."""
    return [
        (table.name, column, dim, key)
        for table in WAREHOUSE.values()
        if facts is None or table.name in facts
        for column, (dim, key) in table.references.items()
    ]


def conform(df: DataFrame, table: Table, fill_defaults: bool = True) -> DataFrame:
    """The table's columns in its order and types, with its defaults."""
    columns = []
    for c in table.columns:
        value = F.col(c.name).try_cast(c.type) if c.name in df.columns else F.lit(None).cast(c.type)
        if fill_defaults and c.default is not None:
            value = F.coalesce(value, F.lit(c.default).cast(c.type))
        columns.append(value.alias(c.name))
    return df.select(*columns)


def conform_rejects(df: DataFrame, table: Table) -> DataFrame:
    """table, column, rejects: cells that hold a value which the column's type cannot take unchanged.

    Text that does not read as the type is rejected, and so is a number that the
    type would round or cut.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    counts = []
    for c in table.columns:
        if c.name not in kinds:
            continue
        value, taken = F.col(c.name), F.col(c.name).try_cast(c.type)
        lost = taken.isNull()
        if isinstance(kinds[c.name], T.NumericType) and isinstance(c.type, T.NumericType):
            lost = lost | (taken != value)
        counts.append(F.struct(F.lit(c.name).alias("column"), F.count_if(value.isNotNull() & lost).alias("rejects")))
    rows = df.agg(F.array(*counts).alias("cells")).select(F.inline("cells"))
    return rows.select(F.lit(table.name).alias("table"), "column", "rejects")
