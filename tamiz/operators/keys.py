"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.functions import short_key
from tamiz.session import COMPACT, looked_up, materialize

_POSITION, _KNOWN, _OWN = "__position", "__known", "__own"
_ROW_BITS = 33  # monotonically_increasing_id: partition above, row below


def assign_surrogate_key(
    df: DataFrame, sk_name: str, order_by: Sequence[str], start: int = 1
) -> DataFrame:
    """Dense keys ``start, start + 1, ...`` by ascending ``order_by``, nulls last.

    The rows are sorted across the cluster and written once together with their
    position, so no task sees the whole table and a later re-read cannot
    renumber. Only one count per sorted partition reaches the driver.
    ``order_by`` has to be unique for the keys to be reproducible. Joins that look up the result do not
    broadcast it where it has too many rows (see ``looked_up``).
    """
    ordered = df.orderBy(*[F.col(c).asc_nulls_last() for c in order_by])
    placed = materialize(
        ordered.withColumn(_POSITION, F.monotonically_increasing_id()), f"keys-{sk_name}", **COMPACT
    )
    block = F.shiftright(_POSITION, _ROW_BITS).cast("int")
    sizes = {
        row["block"]: row["n"]
        for row in placed.groupBy(block.alias("block")).agg(F.count(F.lit(1)).alias("n")).collect()
    }
    offsets, before = [], start
    for i in range(max(sizes, default=-1) + 1):
        offsets.append(str(before))
        before += sizes.get(i, 0)
    # One constant array; a long chain of literals would bloat the plan.
    first_keys = F.split(F.lit(",".join(offsets or [str(start)])), ",").cast("array<bigint>")
    row_in_block = F.col(_POSITION).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    numbered = placed.select(
        (F.get(first_keys, block) + row_in_block).alias(sk_name), *df.columns
    )
    return looked_up(numbered, before - start)


@dataclass(frozen=True)
class KeyMap:
    """``members``: all rows of the dimension. ``added``: those that came with this load."""

    members: DataFrame
    added: DataFrame


def extend_keys(
    known: DataFrame, incoming: DataFrame, key: str, sk_name: str, changed: str = "keep"
) -> KeyMap:
    """Members of a dimension that was loaded before, with those of a later load.

    A member that is known keeps its surrogate key; the others get the next ones, dense and by ascending
    ``key`` (nulls equal each other and come last). ``changed="keep"`` also keeps the known attributes,
    ``"update"`` takes those of the later load. ``incoming`` has one row per ``key``; its own surrogate
    keys, if there, are not looked at. Keys below 1, as of an unknown member, do not count as the last one.
    """
    if changed not in ("keep", "update"):
        raise ValueError(f"changed must be keep or update, not {changed!r}")
    attributes = [c for c in known.columns if c not in (sk_name, key)]
    later = incoming.select(key, *[c for c in attributes if c in incoming.columns])
    texts = all(isinstance(df.schema[key].dataType, T.StringType) for df in (known, incoming))
    short = short_key if texts else lambda col: col
    held = known.agg(F.greatest(F.coalesce(F.max(sk_name), F.lit(0)), F.lit(0)).alias("last"), F.count(F.lit(1)).alias("rows")).first()
    mine = looked_up(known.select(short(F.col(key)).alias(_KNOWN)), held["rows"])
    named = later.withColumn(_OWN, short(F.col(key)))
    new = named.join(mine, named[_OWN].eqNullSafe(mine[_KNOWN]), "left_anti").drop(_OWN)
    added = assign_surrogate_key(new, sk_name, [key], start=int(held["last"]) + 1)
    added = known.limit(0).unionByName(added, allowMissingColumns=True)
    if changed == "keep" or not attributes:
        return KeyMap(looked_up(known.unionByName(added)), added)
    present = [c for c in attributes if c in incoming.columns]
    other = later.select(F.col(key).alias(_KNOWN), F.lit(True).alias(_POSITION), *[F.col(c).alias(f"__{c}") for c in present])
    joined = known.join(other, known[key].eqNullSafe(other[_KNOWN]), "left")
    updated = joined.select(*[
        F.when(F.col(_POSITION), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in present else F.col(c)
        for c in known.columns
    ])
    return KeyMap(looked_up(updated.unionByName(added), held["rows"] + added.count()), added)
