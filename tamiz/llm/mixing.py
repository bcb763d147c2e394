"""Mix sources to target weights by pivotal dependent rounding.

A source's target over its size is the fractional number of copies of each of its documents. The
whole part is taken at once. The fractional parts are rounded by pivotal sampling: two documents
meet, mass moves from one to the other at random, so that the expected words of each and the sum
of words of both stay, until one of them has a whole number of copies; the other meets the next.
Groups of documents are reduced in parallel, each leaves one fractional document, and these
residuals meet in further rounds of a tree, until one is left for each source. It is rounded to
the nearer side, so that a source misses its target by at most half of one document.

Defined results: a null text has size 0 and a null source is a source of its own, last in order;
a source of size 0 has target 0; documents of size 0 follow the rounding of copies without
changing any sum (whole copies of the source's ratio only). An empty table gives an empty result.
Repeated rows are documents of their own.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.llm.base import WORD, keyed_rows
from tamiz.operators.keys import assign_surrogate_key
from tamiz.session import materialize

GROUP_ROWS = 4096  # documents that one reduction takes at most, on average
FAN_IN = 64  # residuals that one further reduction takes
_ROW = "mix_row"


def word_count(text: str = "text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, source: str, weights: tuple[int, ...], share: float, most: float
) -> DataFrame:
    """One row per source: ``source_size``, ``weight`` and ``target``.

    ``sizes`` has the columns ``source`` and ``size``. Weights repeat over the sources in code point
    order, null last. Targets sum to ``share`` of all words; none exceeds ``most`` times its source:
    what is above is shared out again by weight, until nothing is above.
    """
    totals = sizes.groupBy(source).agg(F.sum("size").alias("source_size"), F.count("*").alias("peers"))
    ranked = assign_surrogate_key(totals, "mix_rank", [source])
    cycle = F.array(*(F.lit(int(w)) for w in weights))
    ranked = ranked.withColumn(
        "weight", F.element_at(cycle, (F.pmod(F.col("mix_rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    )
    ranked = materialize(ranked.drop("mix_rank"), "mix-sources")
    most_words = F.col("source_size") * F.lit(most)
    # Every round settles the sources that the present rate takes above their most; the rate only grows.
    rate, settled = 0.0, -1
    while True:
        over = most_words < F.col("weight") * F.lit(rate)
        row = ranked.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(over, F.col("source_size")).otherwise(0)).alias("full"),
            F.sum(F.when(over, 0).otherwise(F.col("weight"))).alias("open"),
            F.count_if(over).alias("n"),
        ).first()
        if row["all"] is None or not row["open"] or row["n"] == settled:
            break
        settled = row["n"]
        rate = (share * row["all"] - most * row["full"]) / row["open"]
    return ranked.withColumn("target", F.least(most_words.cast("double"), F.col("weight") * F.lit(float(rate))))


def _reduce(sizes, parts, seed):
    """Round all but one of the fractional ``parts``; returns copies and the place left open (or -1)."""
    copies = np.zeros(len(sizes), np.int64)
    draws = np.random.Generator(np.random.PCG64(seed)).random(len(sizes))
    held, p = -1, 0.0
    for i in range(len(sizes)):
        if held < 0:
            held, p = i, parts[i]
            continue
        a, b, q = float(sizes[held]), float(sizes[i]), parts[i]
        # Words move from i to held (up) or from held to i (down) until one side is whole.
        up, down = min(a * (1 - p), b * q), min(a * p, b * (1 - q))
        if draws[i] * (up + down) < down:
            full, empty = a * (1 - p) <= b * q, b * q <= a * (1 - p)
            p, q = p + up / a, q - up / b
            first_done, first, second_done, second = full, 1, empty, 0
        else:
            empty, full = a * p <= b * (1 - q), b * (1 - q) <= a * p
            p, q = p - down / a, q + down / b
            first_done, first, second_done, second = empty, 0, full, 1
        if first_done:
            copies[held] = first
            held, p = i, q
            if second_done:
                copies[i], held = second, -1
        else:
            copies[i] = second
    return copies, held, p


def pivotal_round(docs: DataFrame, source: str, doc_id: str, seed: int = 0) -> DataFrame:
    """Give each row a whole number ``copies`` (0 or 1) for its fractional ``part``.

    ``docs`` has, besides others that stay: ``source``, ``doc_id``, ``size`` (above 0), ``part`` (between 0 and 1)
    and ``peers``, the number of documents of its source.
    """
    # The number of groups of a source follows its number of documents; ids spread over them evenly.
    groups = F.ceil(F.col("peers") / F.lit(GROUP_ROWS))
    open_rows = docs.withColumn("salt", F.pmod(F.xxhash64(doc_id, "size"), groups).cast("long"))
    schema = T.StructType(open_rows.schema.fields + [T.StructField("copies", T.LongType())])

    def reducer(level):
        def run(rows: pa.Table) -> pa.Table:
            # Large documents meet first, so that the one left open tends to be small.
            rows = rows.sort_by([("size", "descending"), (doc_id, "ascending")])
            salt = rows.column("salt")
            key = f"{seed}|{level}|{rows.column(source)[0].as_py()}|{salt[0].as_py()}"
            parts = rows.column("part").to_numpy().copy()
            copies, held, p = _reduce(rows.column("size").to_numpy(), parts, zlib.crc32(key.encode()))
            open_one = np.arange(len(parts)) == held
            parts[open_one] = p
            out = rows.set_column(rows.schema.get_field_index("part"), "part", pa.array(parts))
            out = out.set_column(out.schema.get_field_index("salt"), "salt", pc.divide(salt, FAN_IN))
            return out.append_column("copies", pa.array(copies, pa.int64(), mask=open_one))
        return run

    parts, level, more = [], 0, True
    while more:
        rounded = open_rows.groupBy(source, "salt").applyInArrow(reducer(level), schema)
        rounded = materialize(rounded, f"mix-level-{level}")
        parts.append(rounded.filter(F.col("copies").isNotNull()))
        left = rounded.filter(F.col("copies").isNull())
        more = not left.groupBy(source).count().filter("count > 1").isEmpty()
        open_rows, level = left.drop("copies"), level + 1
    parts.append(left.withColumn("copies", F.when(F.col("part") >= 0.5, 1).otherwise(0).cast("long")))
    out = parts[0]
    for other in parts[1:]:
        out = out.unionByName(other)
    return out.drop("salt")


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 0,
    row: str | None = None,
) -> DataFrame:
    """How often a mix takes each document.

    Returns ``doc_id, size, source_size, target, copies, taken``, one row per row of ``docs``; other columns
    are left out, but for ``row``, which may name a number of the rows. ``taken`` is ``copies * size`` and at
    most ``most`` times ``size``.
    """
    kept = [F.col(row)] if row else []
    narrow = docs.select(
        F.col(source).alias("source"), F.col(doc_id).alias("doc_id"), word_count(text).alias("size"), *kept
    )
    narrow = materialize(narrow, "mix-sizes")
    targets = source_targets(narrow, "source", weights, share, most)
    named = targets.withColumnRenamed("source", "of")
    joined = narrow.join(named, narrow["source"].eqNullSafe(named["of"])).drop("of")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = joined.withColumn("ratio", ratio).withColumn("base", F.floor("ratio"))
    joined = joined.withColumn("part", F.col("ratio") - F.col("base")).drop("ratio", "weight")
    to_round = (F.col("part") > 0) & (F.col("size") > 0)
    rounded = pivotal_round(joined.filter(to_round), "source", "doc_id", seed)
    plain = joined.filter(~to_round).withColumn("copies", F.lit(0).cast("long"))
    done = rounded.unionByName(plain).withColumn("copies", F.col("copies") + F.col("base"))
    return done.select(
        "doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), *kept
    )


def copies_of(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options
) -> DataFrame:
    """The mix itself: every document repeated as often as it is taken, with the columns of ``docs``.

    Documents without words are kept once. Rows that share an id, or have none, are documents of their own.
    """
    # Each row meets its own copies, whatever its id.
    keyed, key = keyed_rows(docs, doc_id, _ROW)
    taken = mix(keyed, doc_id, text, source, row=None if key == doc_id else key, **options)
    times = F.when(F.col("size") == 0, 1).otherwise(F.col("copies")).cast("int")
    mine = taken.select(F.col("doc_id" if key == doc_id else key).alias("mix_key"), times.alias("mix_times"))
    joined = keyed.join(mine, keyed[key] == mine["mix_key"])
    return joined.withColumn("mix_copy", F.explode(F.array_repeat(F.lit(1), F.col("mix_times")))).select(
        *(keyed[c] for c in docs.columns)
    )
