"""Key lookups, semi and anti joins, attribute joins.

No join carries a broadcast hint. Spark broadcasts a side whose measured size
is below ``spark.sql.autoBroadcastJoinThreshold`` (dimensions are read back
from files, so their size is known) and otherwise shuffles, splitting skewed
partitions at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.functions import short_key

_KEY, _SALT, _OWN = "__lookup_key", "__lookup_salt", "__lookup_own"
_SALTS = 64  # parts that the rows without a key are dealt over


def _comparable(df: DataFrame, key: str) -> Column:
    """A key as joins compare it: texts by ``short_key``, so that long ones are not shuffled whole."""
    return short_key(F.col(key)) if isinstance(df.schema[key].dataType, T.StringType) else F.col(key)


def _both_texts(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> bool:
    return all(isinstance(df.schema[k].dataType, T.StringType) for df, k in ((left, left_key), (right, right_key)))


def lookup_key(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    sk_name: str,
    how: str = "left",
    null_safe: bool = False,
    default_sk: int | Column | None = None,
    as_name: str | None = None,
    salt: str | Sequence[str] | None = "*",
) -> DataFrame:
    """Add the surrogate key of the dimension row with the fact's natural key.

    ``how="left"`` keeps unmatched rows, with ``default_sk`` if given;
    ``how="inner"`` drops them. ``null_safe`` lets null match null. Rows without a
    key carry a salt, so that a shuffle does not send all of them to one task; the
    dimension's null member is there once per salt. The salt is a hash of all columns, or of those that
    ``salt`` names; with ``salt=None`` there is none, and tables bucketed by the keys meet without a shuffle.
    Texts meet by ``short_key``; a long one that is not needed afterwards stays out of the shuffle.
    """
    target = as_name or sk_name
    if salt is None:
        side = dim.select(F.col(dim_key).alias(_KEY), F.col(sk_name).alias(target))
        own, other = fact[fact_key], side[_KEY]
        out = fact.join(side, own.eqNullSafe(other) if null_safe else own == other, how).drop(_KEY)
        return _defaulted(out, target, default_sk)
    none, zero = F.col(fact_key).isNull(), F.lit(0).cast("long")
    hashed = [f.name for f in fact.schema.fields if not f.dataType.simpleString().count("map<")]
    if salt != "*":
        hashed = [salt] if isinstance(salt, str) else list(salt)
    salt = F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in hashed)), F.lit(_SALTS).cast("long"))
    texts = _both_texts(fact, fact_key, dim, dim_key)
    own = _comparable(fact, fact_key) if texts else F.col(fact_key)
    fact = fact.withColumns({_SALT: F.when(none, salt).otherwise(zero), _OWN: own})
    named = _comparable(dim, dim_key) if texts else F.col(dim_key)
    side = dim.select(named.alias(_KEY), F.col(sk_name).alias(target))
    if null_safe:
        every = F.sequence(zero, F.lit(_SALTS - 1).cast("long"))
        side = side.withColumn(_SALT, F.explode(F.when(F.col(_KEY).isNull(), every).otherwise(F.array(zero))))
    else:
        side = side.withColumn(_SALT, zero)
    own, other = fact[_OWN], side[_KEY]
    condition = own.eqNullSafe(other) if null_safe else own == other
    out = fact.join(side, condition & (fact[_SALT] == side[_SALT]), how).drop(_KEY, _SALT, _OWN)
    return _defaulted(out, target, default_sk)


def _defaulted(out: DataFrame, target: str, default_sk: int | Column | None) -> DataFrame:
    if default_sk is not None:
        default = default_sk if isinstance(default_sk, Column) else F.lit(default_sk)
        out = out.withColumn(target, F.coalesce(target, default))
    return out


def lookup_date_key(
    fact: DataFrame,
    dim_date: DataFrame,
    column: str,
    as_name: str,
    date_column: str = "fecha",
    sk_name: str = "fecha_sk",
    default_sk: int | Column | None = None,
) -> DataFrame:
    """Calendar key of a timestamp's day; without a match the first calendar key."""
    if default_sk is None:
        default_sk = first_key(dim_date, sk_name)
    day = "__day"
    dated = fact.withColumn(day, F.col(column).cast("date"))
    return lookup_key(
        dated, dim_date, day, date_column, sk_name, "left", default_sk=default_sk, as_name=as_name
    ).drop(day)


def first_key(dim: DataFrame, sk_name: str) -> Column:
    """The smallest surrogate key, as a scalar subquery."""
    return dim.agg(F.min(sk_name).alias("first")).scalar()


def attach_attributes(
    keys: DataFrame, source: DataFrame, key: str, order_by: str | Column
) -> DataFrame:
    """Wide attributes of the first source row of each key; null keys match."""
    from tamiz.operators.dedupe import dedupe_keep_first

    first = dedupe_keep_first(source, [key], order_by)
    side = first.withColumnRenamed(key, _KEY)
    return keys.join(side, keys[key].eqNullSafe(side[_KEY]), "left").drop(_KEY)


def attach_group_attribute(
    dim: DataFrame, source: DataFrame, dim_key: str, source_key: str, attribute: str,
    order_by: str | Column,
) -> DataFrame:
    """First non-null attribute of each key's group, null where there is none."""
    from tamiz.operators.dedupe import first_non_null

    if not _both_texts(dim, dim_key, source, source_key):
        side = first_non_null(source, source_key, attribute, order_by).withColumnRenamed(source_key, _KEY)
        return dim.join(side, dim[dim_key] == side[_KEY], "left").drop(_KEY)
    side = first_non_null(source.withColumn(_KEY, _comparable(source, source_key)), _KEY, attribute, order_by)
    own = dim.withColumn(_OWN, _comparable(dim, dim_key))
    return own.join(side, own[_OWN] == side[_KEY], "left").drop(_KEY, _OWN)


def _distinct_keys(df: DataFrame, key: str, alias: str) -> DataFrame:
    # Distinct before the join: a hot key then is one row on either side.
    return df.filter(F.col(key).isNotNull()).select(F.col(key).alias(alias)).distinct()


def orphan_keys(
    child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None
) -> DataFrame:
    """Distinct non-null child keys that the parent lacks."""
    return _distinct_keys(child, key, key).join(
        _distinct_keys(parent, parent_key or key, key), key, "left_anti"
    )


def matching_keys(
    child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None
) -> DataFrame:
    """Distinct non-null child keys that the parent has."""
    return _distinct_keys(child, key, key).join(
        _distinct_keys(parent, parent_key or key, key), key, "left_semi"
    )
