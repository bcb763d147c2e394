"""Rows that break a table's rules, told apart from those that may be loaded, with the rules they break."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.functions import short_key
from tamiz.schemas import Table
from tamiz.session import drop_stored, looked_up, materialize

ROW_RULES = ("casts", "not_null", "max_length", "valid")
ALL_RULES = (*ROW_RULES, "unique", "references")
_ROW, _BROKEN, _CELLS, _GIVEN, _PLACE = "__row", "broken", "__cells", "__given", "__place"


@dataclass(frozen=True)
class Quarantine:
    """``good``: rows in the table's types, with its defaults. ``rejects``: rows as given, and ``broken``.

    ``stored`` are the tables that both read; ``drop`` deletes them once good rows and rejects are written.
    """

    good: DataFrame
    rejects: DataFrame
    stored: tuple[DataFrame, ...] = ()

    def drop(self) -> None:
        drop_stored(*self.stored)

    def report(self) -> DataFrame:
        """rule, column, rows: how many rejects break what."""
        parts = F.split("rule", ":", 2)
        return self.rejects.select(F.explode(_BROKEN).alias("rule")).groupBy(
            parts[0].alias("rule"), F.coalesce(F.get(parts, 1), F.lit("")).alias("column")
        ).agg(F.count(F.lit(1)).alias("rows"))


def _cells(df: DataFrame, table: Table, place: str = "") -> tuple[list[Column], list[Column]]:
    """The table's cells, and for each column what a value that does not fit its type is called.

    ``place`` is what stands before the names of ``df`` where its rows are held in a struct.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    cells, lost = [], []
    for c in table.columns:
        given = F.col(place + c.name) if c.name in kinds else F.lit(None).cast(c.type)
        taken = given.try_cast(c.type)
        bad = given.isNotNull() & taken.isNull()
        if isinstance(kinds.get(c.name), T.NumericType) and isinstance(c.type, T.NumericType):
            bad = bad | (given.isNotNull() & (taken != given))
        lost.append(F.when(bad, f"casts:{c.name}"))
        default = F.when(given.isNull(), F.lit(c.default).cast(c.type)) if c.default is not None else F.lit(None)
        cells.append(F.coalesce(taken, default.cast(c.type)).alias(c.name))
    return cells, lost


def judge(
    df: DataFrame, table: Table, rules: Sequence[str] = ROW_RULES, valid: Mapping[str, Column] | None = None
) -> DataFrame:
    """The rows with ``broken``: names of the row rules each breaks, found in the scan of the rows alone.

    ``valid`` names further conditions over the table's columns; a condition that is null counts as met.
    """
    cells, lost = _cells(df, table)
    held = df.select(F.struct("*").alias(_GIVEN), F.struct(*cells).alias(_CELLS), F.array(*lost).alias("__lost"))
    found = [F.col("__lost")] if "casts" in rules else []
    checks = []
    for c in table.columns:
        value = F.col(f"{_CELLS}.{c.name}")
        missing = value.isNull() & ~F.array_contains(F.array_compact("__lost"), f"casts:{c.name}")
        if c.not_null and "not_null" in rules:
            checks.append(F.when(missing, f"not_null:{c.name}"))
        if c.max_length is not None and "max_length" in rules:
            checks.append(F.when(F.length(value) > c.max_length, f"max_length:{c.name}"))
    if checks:
        found.append(F.array(*checks))
    broken = F.array_compact(F.concat(*found)) if found else F.array().cast("array<string>")
    judged = held.select(_GIVEN, _CELLS, broken.alias(_BROKEN))
    if valid and "valid" in rules:
        flat = judged.select("*", f"{_CELLS}.*")
        more = [F.when(~condition, f"valid:{name}") for name, condition in valid.items()]
        joined = F.concat(_BROKEN, F.array_compact(F.array(*more)))
        judged = flat.select(_GIVEN, _CELLS, joined.alias(_BROKEN))
    return judged


def quarantine(
    df: DataFrame,
    table: Table,
    rules: Sequence[str] = ALL_RULES,
    order_by: Sequence[str] = (),
    known: DataFrame | None = None,
    parents: Mapping[str, DataFrame] | None = None,
    valid: Mapping[str, Column] | None = None,
) -> Quarantine:
    """Split the rows of ``df`` by the rules of ``table``.

    Row rules are judged in one scan, whose result is stored. Of sound rows with an equal unique value the
    first in ``order_by`` stays (without it, by all columns), and none whose value is in ``known``, the rows
    loaded before. ``parents`` holds the dimensions that references point to: a key that its dimension lacks
    is broken, a null one is a matter of ``not_null``. A row that breaks several rules names them all.

    Uniqueness is a count per value, and where one repeats the first row of it, joined back on row numbers; the
    rows are joined and stored once more only where one breaks such a rule. References meet their dimension by
    distinct keys. So a value that a third of the rows share is neither gathered nor multiplied.
    """
    used: list[DataFrame] = []

    def keep(frame: DataFrame, label: str) -> DataFrame:
        used.append(materialize(frame, label))
        return used[-1]

    # Rows are stored as given; cells are made of them again wherever they are read.
    in_types = F.struct(*_cells(df, table, f"{_GIVEN}.")[0]).alias(_CELLS)
    judged = judge(df, table, rules, valid).select(_GIVEN, _BROKEN, F.monotonically_increasing_id().alias(_ROW))
    stored = keep(judged, f"judged-{table.name}").select("*", in_types)
    cells = stored.select(_ROW, F.size(_BROKEN).alias("__n"), f"{_CELLS}.*")
    faults = []
    unique = table.names(unique=True) if "unique" in rules else []
    if unique:
        order = [F.col(f"{_GIVEN}.{c}") for c in (order_by or df.columns)]
        sound = stored.filter(F.size(_BROKEN) == 0)
        for c in unique:
            cell, text = F.col(f"{_CELLS}.{c}"), isinstance(table_type(table, c), T.StringType)
            held = sound.filter(cell.isNotNull()).withColumn("__value", short_key(cell) if text else cell)
            # Whole rows are compared only where a value repeats.
            counted = held.groupBy("__value").agg(F.count(F.lit(1)).alias("n"))
            repeated = keep(counted.filter("n > 1").select("__value"), f"repeated-{c}")
            broken = []
            if not repeated.isEmpty():
                repeated = looked_up(repeated)
                rows = held.select("__value", F.struct(*order, _ROW).alias(_PLACE), _ROW).join(repeated, "__value", "left_semi")
                firsts = rows.groupBy("__value").agg(F.min(_PLACE).alias(_PLACE))
                kept = firsts.select(F.col(f"{_PLACE}.{_ROW}").alias(_ROW))
                broken.append(rows.select(_ROW).join(kept, _ROW, "left_anti"))
            if known is not None:
                earlier = F.col(c).cast(table_type(table, c))
                taken = known.select((short_key(earlier) if text else earlier).alias("__value")).distinct()
                broken.append(held.select("__value", _ROW).join(looked_up(taken, known.count()), "__value", "left_semi").select(_ROW))
            if broken:
                faults.append(reduce(DataFrame.unionByName, broken).distinct().withColumn("rule", F.lit(f"unique:{c}")))
    if "references" in rules:
        for c, (parent, key) in table.references.items():
            if parents is None or parent not in parents:
                continue
            members = looked_up(parents[parent].select(F.col(key).cast(table_type(table, c)).alias(c)))
            lacking = cells.filter(F.col(c).isNotNull()).select(c).distinct().join(members, c, "left_anti")
            lacking = keep(lacking, f"lacking-{c}")
            if lacking.isEmpty():
                continue
            hit = cells.select(_ROW, c).join(looked_up(lacking), c, "left_semi")
            faults.append(hit.select(_ROW, F.lit(f"references:{c}").alias("rule")))
    if faults:
        every = reduce(DataFrame.unionByName, faults)
        more = every.groupBy(_ROW).agg(F.sort_array(F.collect_list("rule")).alias("__more"))
        more = keep(more, f"faults-{table.name}")
        if more.isEmpty():
            faults = []
    if faults:
        both = F.concat(_BROKEN, F.coalesce("__more", F.array().cast("array<string>")))
        joined = stored.join(looked_up(more), _ROW, "left").select(_GIVEN, both.alias(_BROKEN))
        stored = keep(joined, f"quarantine-{table.name}").select("*", in_types)
    fine = F.size(_BROKEN) == 0
    return Quarantine(
        stored.filter(fine).select(f"{_CELLS}.*"), stored.filter(~fine).select(f"{_GIVEN}.*", _BROKEN), tuple(used)
    )


def table_type(table: Table, column: str) -> T.DataType:
    return next(c.type for c in table.columns if c.name == column)
